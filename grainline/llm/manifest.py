"""A Merkle manifest of documents, built by aligned appends with growing witnesses.

The documents of a language are leaves in the order of their ids.  Leaves are
appended one after another to a frontier of open subtrees.  Each subtree keeps
the witnesses of its leaves as far as they are known; when its sibling is
complete, the witnesses of both are extended by the other's digest.  A block of
leaves that starts at a multiple of its size is a whole subtree, so blocks are
built in parallel, and their roots are the appends of the next frontier.  The
subroots of the languages are the appends of the last one.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.llm.common import remainder, stored

#: A block holds 2**HEIGHT nodes.
HEIGHT = 12
EVERY = 7

#: A witness is a row of steps from a node up: a sibling's digest with the side
#: it stands on, or a node that is alone in its run.
LEFT, RIGHT, ALONE = b"L", b"R", b"N"
DIGEST = 64

PLACED = "g string, pos long, n long, digest string"
WITNESSED = (
    "doc_id long, leaf string, claim string, witness binary, subroot string, root string"
)
RESULT = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def digest_of(*parts: bytes) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


class Frontier:
    """Open subtrees of the leaves appended so far, and the witnesses they have."""

    def __init__(self, witnesses: bool = True):
        self.open: list[tuple[int, bytes, int, int]] = []
        self.paths: list[bytearray] = []
        self.count = 0
        self.witnesses = witnesses

    def append(self, digest: bytes) -> None:
        if self.witnesses:
            self.paths.append(bytearray())
        self.open.append((0, digest, self.count, self.count + 1))
        self.count += 1
        self._complete()

    def close(self, height: int) -> bytes:
        """The root at `height`; a last node without a sibling is hashed alone."""
        while len(self.open) > 1 or self.open[0][0] < height:
            level, digest, start, end = self.open.pop()
            self._extend(start, end, ALONE)
            self.open.append((level + 1, digest_of(digest), start, end))
            self._complete()
        return self.open[0][1]

    def _complete(self) -> None:
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            level, right, middle, end = self.open.pop()
            _, left, start, _ = self.open.pop()
            self._extend(start, middle, RIGHT + right)
            self._extend(middle, end, LEFT + left)
            self.open.append((level + 1, digest_of(left, right), start, end))

    def _extend(self, start: int, end: int, step: bytes) -> None:
        if self.witnesses:
            for path in self.paths[start:end]:
                path += step


def steps(witness: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(side, sibling) from the leaf up; the sibling of a node alone is empty."""
    at = 0
    while at < len(witness):
        side = witness[at : at + 1]
        size = 0 if side == ALONE else DIGEST
        yield side, witness[at + 1 : at + 1 + size]
        at += 1 + size


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that `leaf` and the siblings of `witness` make."""
    for side, sibling in steps(witness):
        leaf = digest_of(sibling, leaf) if side == LEFT else digest_of(leaf, sibling)
    return leaf


def _height(n: int) -> int:
    """Levels of the subtree that a block of a group of `n` nodes makes."""
    return HEIGHT if n > 1 << HEIGHT else (n - 1).bit_length()


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows with equal first `keys` columns, which are neighbours."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for rows in _grouped(batches, 2):
        g, block, _, n, _ = rows[0]
        frontier = Frontier(witnesses=False)
        for row in rows:
            frontier.append(row[4].encode())
        out.append((g, block, -(-n // (1 << HEIGHT)), frontier.close(_height(n)).decode()))
        if len(out) == 1000:
            yield _batch(out, ["g", "pos", "n", "digest"])
            out = []
    if out:
        yield _batch(out, ["g", "pos", "n", "digest"])


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with their witnesses up to the root of their group.

    The first row of a block carries the witness of the block's root.
    """
    for rows in _grouped(batches, 2):
        above = rows[0][5]
        frontier = Frontier()
        for row in rows[1:]:
            frontier.append(row[4].encode())
        frontier.close(_height(rows[1][3]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows[1:]]),
                pa.array([r[2] for r in rows[1:]], pa.int64()),
                pa.array([bytes(p) + above for p in frontier.paths], pa.binary()),
            ],
            ["g", "pos", "witness"],
        )


def _block() -> Column:
    return F.shiftright("pos", HEIGHT).alias("block")


def positions(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """`rows`, stored, with `pos` from 0 in its group and the group's size `n`.

    Rows are sorted by ranges, so a group may take many tasks; what comes before
    a task's rows of a group is a sum over one row for each task and group.
    Rows that are equal in all of `order` are told apart by where they were read.
    """
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(group, *order, "_salt").sortWithinPartitions(group, *order, "_salt")
    placed = stored(ordered.drop("_salt").withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftrightunsigned("_at", 33)
    counts = placed.groupBy(F.col(group).alias("_g"), task.alias("_task")).agg(
        F.count("*").alias("_n"), F.min("_at").alias("_first")
    )
    of_group = W.partitionBy("_g")
    before = F.coalesce(F.sum("_n").over(of_group.orderBy("_task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(
        "_g", "_task", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(of_group).alias("n")
    )
    found = placed.join(counts, (F.col(group) == F.col("_g")) & (task == F.col("_task")))
    return found.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_g", "_task", "_shift", "_at")


def _dealt(nodes: DataFrame, *extra: str) -> DataFrame:
    """Nodes by block, in order."""
    rows = nodes.select("g", _block(), "pos", "n", "digest", *extra)
    return rows.repartition("g", "block").sortWithinPartitions("g", "block", "pos")


def tree(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of placed nodes (g, pos, n, digest): the witness of each block's root up to
    the group's root as (g, block, witness), and the groups' roots (g, digest).

    Every round is a table of 1/4096 of the rows of the one before.
    """
    levels = [stored(_dealt(nodes).mapInArrow(_roots, PLACED))]
    while (levels[-1].agg(F.max("n")).first()[0] or 1) > 1:
        levels.append(stored(_dealt(levels[-1]).mapInArrow(_roots, PLACED)))
    roots = levels.pop()
    above = roots.select("g", F.col("pos").alias("block"), F.lit(b"").alias("witness"))
    for nodes in reversed(levels):
        above = _with_above(nodes.withColumn("witness", F.lit(None).cast("binary")), above).mapInArrow(
            _extended, "g string, pos long, witness binary"
        )
        above = stored(above.withColumnRenamed("pos", "block"))
    return above, roots.select("g", "digest")


def _with_above(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Nodes by block in order, each block led by its row of `above`.

    The witness of a block is sent once, not with each of its nodes.
    """
    kinds = dict(nodes.dtypes)
    rest = [c for c in nodes.columns if c not in ("g", "pos", "n", "digest")]
    rows = nodes.select("g", _block(), "pos", "n", "digest", *rest)
    lead = above.select(
        "g",
        "block",
        F.lit(-1).cast("long").alias("pos"),
        *[(F.col(c) if c in above.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in ("n", "digest", *rest)],
    )
    both = rows.union(lead)
    return both.repartition("g", "block").sortWithinPartitions("g", "block", "pos")


def _witnessed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _grouped(batches, 2):
        _, _, _, _, _, _, _, above, top, subroot, root = rows[0]
        rows = rows[1:]
        frontier = Frontier()
        for row in rows:
            frontier.append(row[4].encode())
        frontier.close(_height(rows[0][3]))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[5] for r in rows], pa.int64()),
                pa.array([r[4] for r in rows]),
                pa.array([r[6] for r in rows]),
                pa.array([bytes(p) + above + top for p in frontier.paths], pa.binary()),
                pa.array([subroot] * len(rows)),
                pa.array([root] * len(rows)),
            ],
            ["doc_id", "leaf", "claim", "witness", "subroot", "root"],
        )


def leaf_of(n_chars: Column) -> Column:
    """Digest of a row's fields, each with its length in bytes; null is `-`."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        whole = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        return F.when(text.isNull(), "-").otherwise(whole)

    fields = [F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text")]
    return F.sha2(F.concat(*map(field, fields)), 256)


def witnesses(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """doc_id, leaf, claim, witness, subroot and root of every row of `docs`.

    Leaves of a language (null is one, too) are ordered by doc_id, a null doc_id
    last, then by leaf; rows that are wholly equal are leaves of their own.
    Subroots are ordered by language, null first.  `claim` is the leaf with the
    value `claimed` instead of n_chars, for checks; without it, the leaf.  Texts
    are hashed where they are read and not moved.  An empty table has no root.
    Columns beyond the five that are hashed are not used.
    """
    claimed = F.col("n_chars") if claimed is None else claimed
    changed = ~claimed.eqNullSafe(F.col("n_chars"))
    # A key that is never null and sorts as the languages do.
    key = F.when(F.col("lang").isNull(), "0").otherwise(F.concat(F.lit("1"), F.col("lang")))
    leaves = docs.select(
        key.alias("g"),
        F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(F.col("n_chars")).alias("digest"),
        F.when(changed, leaf_of(claimed)).alias("claim"),
    ).withColumn("claim", F.coalesce("claim", "digest"))
    leaves = stored(positions(leaves, "g", [F.col("doc_id").asc_nulls_last(), F.col("digest")]))
    above, subroots = tree(leaves)
    ends = positions(subroots.select(F.lit("").alias("all"), F.col("g").alias("lang"), "digest"), "all", [F.col("lang")])
    ends = stored(ends.select(F.col("all").alias("g"), "pos", "n", "digest", "lang"))
    top, root = tree(ends)
    path = _with_above(ends.select("g", "pos", "n", "digest", F.lit(None).cast("binary").alias("witness")), top)
    path = path.mapInArrow(_extended, "g string, pos long, witness binary")
    ends = ends.join(path.select("pos", F.col("witness").alias("top")), "pos")
    whole = root.select(F.col("g").alias("_all"), F.col("digest").alias("_root"))
    ends = ends.join(whole, F.col("g") == F.col("_all")).select(
        F.col("lang").alias("_lang"), "top", F.col("digest").alias("subroot"), F.col("_root").alias("root")
    )
    lead = above.join(ends, F.col("g") == F.col("_lang")).drop("_lang").withColumnRenamed("witness", "above")
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in lead.dtypes if c not in ("g", "block")]
    rows = _with_above(leaves.select("g", "pos", "n", "digest", "doc_id", "claim", *nothing), lead)
    rows = rows.select("g", "block", "pos", "n", "digest", "doc_id", "claim", "above", "top", "subroot", "root")
    return rows.mapInArrow(_witnessed, WITNESSED)


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
        proofs = [sha256(b"".join(s for _, s in steps(r[3]))).hexdigest() for r in rows]
        ends = [folded(r[2].encode(), r[3]).decode() for r in rows]
        good = [e == r[5] for e, r in zip(ends, rows, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "leaf", "subroot", "root")), *map(pa.array, (proofs, ends, good))],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        )


def proved(manifest: DataFrame) -> DataFrame:
    """Digest of each witness, the root that the claim folds to, and whether it is the root."""
    return manifest.select(*(c.split()[0] for c in WITNESSED.split(", "))).mapInArrow(_proved, RESULT)


def tampered(every: int = EVERY) -> Column:
    """n_chars, one more in rows whose doc_id has a crc32 divisible by `every`."""
    hit = F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), every) == 0)
    return F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
