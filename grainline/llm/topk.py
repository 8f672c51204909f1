"""Exact top-k by inner product in three phases with one threshold for all shards.

A shard is a group of candidates of bounded size, and blocks of queries stream
through every shard.  First every shard sends the k best scores of its local list;
the k-th best of those is a score that the answer can't fall below.  That cutoff
goes out with the queries, and shards send only entries that reach it.  What they
sent is ranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.llm.common import stored

SCALE = 1024
EVERY = 100
#: Candidates of a shard, on average, and queries scored at once.
SHARD, QUERY_BLOCK = 32_768, 64
LOWEST = np.iinfo(np.int64).min


def as_integers(vectors: DataFrame, scale: int = SCALE, *more: str) -> DataFrame:
    """vec_id, floor(scale * x) of each component, and the columns `more`; vectors that are null or
    hold a null or non-finite component, and rows without a vec_id, are left out.
    """
    x = F.col("embedding").cast("array<double>")

    def usable(c: Column) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))

    return vectors.where(F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, usable)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * scale)).alias("ints"),
        *more,
    )


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integers, cut or filled up with zeros to `width`."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    held = at < width
    out[row[held], at[held]] = flat[held]
    return out


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point where every sum fits its 53 bits."""
    most = lambda x: float(np.abs(x.astype(np.float64)).max(initial=0))
    if most(queries) * most(rows) * queries.shape[1] < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return queries @ rows.T


def _packed(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = matrix(batch.column(1), width)
        vectors = pa.array([x.tobytes() for x in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), vectors], ["vec_id", "vector"])


def _scored(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], np.ndarray, np.ndarray]]:
    """Each block of queries with a shard's ids and the scores (queries by rows).

    Rows come by shard, its candidates in the order of their ids before the
    blocks.  A query's own rows have the lowest score.
    """
    now, held, shard = None, [], None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for number, vec_id, vector, block in zip(*columns, strict=True):
            if number != now:
                now, held, shard = number, [], None
            if block is None:
                held.append((vec_id, vector))
                continue
            if not held:
                continue
            if shard is None:
                ids = np.array([r[0] for r in held], np.int64)
                shard = ids, np.frombuffer(b"".join(r[1] for r in held), np.int64).reshape(len(ids), width)
            queries = np.zeros((len(block), width), np.int64)
            for i, query in enumerate(block):
                queries[i, : len(query["ints"])] = query["ints"]
            scores = products(queries, shard[1])
            asked = np.array([q["vec_id"] for q in block], np.int64)
            scores[asked[:, None] == shard[0][None, :]] = LOWEST
            yield block, shard[0], scores


def _best_scores(width: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase one: the k best scores of a shard for each query."""
    for block, ids, scores in _scored(width, batches):
        best = np.partition(scores, len(ids) - k, axis=1)[:, -k:] if len(ids) > k else scores
        query, column = np.nonzero(best != LOWEST)
        asked = np.array([q["vec_id"] for q in block], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(asked[query]), pa.array(best[query, column])], ["query_id", "score"]
        )


def _sufficient(width: int, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase two: entries above the cutoff; of those at it, the k smallest ids."""
    for block, ids, scores in _scored(width, batches):
        asked = np.array([q["vec_id"] for q in block], np.int64)
        cutoff = np.array([LOWEST if q["cutoff"] is None else q["cutoff"] for q in block], np.int64)
        usable = scores != LOWEST
        equal = usable & (scores == cutoff[:, None])
        equal &= np.cumsum(equal, axis=1) <= k
        query, column = np.nonzero((usable & (scores > cutoff[:, None])) | equal)
        yield pa.RecordBatch.from_arrays(
            [pa.array(asked[query]), pa.array(ids[column]), pa.array(scores[query, column])],
            ["query_id", "vec_id", "score"],
        )


def _through(candidates: DataFrame, queries: DataFrame, blocks: int, shards: int, run, schema: str) -> DataFrame:
    """Every block of queries against every shard of candidates, in one job."""
    held = queries.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).agg(
        F.collect_list(F.struct("vec_id", "ints", "cutoff")).alias("block")
    )
    kind = held.schema["block"].dataType
    rows = candidates.select("number", "vec_id", "vector", F.lit(None).cast(kind).alias("block"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("vec_id", "long"), ("vector", "binary"))]
    both = rows.union(held.select(every.alias("number"), *nothing, "block")).repartitionByRange(shards, "number")
    return both.sortWithinPartitions("number", F.col("vec_id").asc_nulls_last()).mapInArrow(run, schema)


def search(vectors: DataFrame, k: int = 10, every: int = EVERY, scale: int = SCALE) -> DataFrame:
    """The k highest scores of each query row against all other rows.

    Queries are the rows whose vec_id is divisible by `every`; they are dealt to
    the shards in blocks, so the plan has one size and a task holds one shard and
    one block.  Of query rows with one vec_id the least vector counts.  Every
    candidate row counts on its own, also repeated ones; rows with the query's
    vec_id are the query's own.  Components that one of two vectors lacks count
    as zero.  Ties go to the smaller vec_id.  Without queries or candidates the
    result is empty.  Scores are exact below 2^63.
    """
    spark = vectors.sparkSession
    rows = as_integers(vectors, scale)
    is_query = F.col("vec_id") % every == 0
    found = rows.agg(F.count("*"), F.max(F.size("ints")), F.count_if(is_query)).first()
    n, width, asked = found[0], max(found[1] or 0, 1), found[2]
    shards = max(-(-n // SHARD), spark.sparkContext.defaultParallelism)
    blocks = max(-(-asked // QUERY_BLOCK), 1)
    # Rows that share a vec_id are told apart by their vector, or are equal.
    number = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int")
    packed = rows.select("vec_id", "ints").mapInArrow(partial(_packed, width), "vec_id long, vector binary")
    candidates = stored(packed.withColumn("number", number))
    queries = stored(rows.where(is_query).groupBy("vec_id").agg(F.min("ints").alias("ints")))

    none = queries.withColumn("cutoff", F.lit(None).cast("long"))
    run = partial(_best_scores, width, k)
    local = _through(candidates, none, blocks, shards, run, "query_id long, score long")
    ranked = local.withColumn("_at", F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc())))
    cutoffs = ranked.where(F.col("_at") == k).select("query_id", F.col("score").alias("cutoff"))
    known = stored(queries.join(cutoffs, F.col("vec_id") == F.col("query_id"), "left").drop("query_id"))

    run = partial(_sufficient, width, k)
    enough = _through(candidates, known, blocks, shards, run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        enough.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
