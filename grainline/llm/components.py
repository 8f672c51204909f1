"""Connected components of a graph in a table, by forests of stretches of its edges
and alternating stars between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import stored

#: Edges that a task joins at once.
EDGES = 1 << 15


def least_reached(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """The least node that each of 0 .. nodes - 1 reaches by the links a - b."""
    root = np.arange(nodes)
    while (root[a] != root[b]).any():
        one, two = root[a], root[b]
        np.minimum.at(root, np.maximum(one, two), np.minimum(one, two))
        while (root[root] != root).any():
            root = root[root]
    return root


def _forest(table: pa.Table) -> pa.RecordBatch:
    """Links of every node of (u, v) to the least one it reaches."""
    ends = pa.concat_arrays([table.column(i).combine_chunks() for i in (0, 1)])
    fields = ends.flatten() if pa.types.is_struct(ends.type) else [ends]
    values = [f.to_numpy() for f in fields]
    order = np.lexsort(values[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([v[order][1:] != v[order][:-1] for v in values], axis=0)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    half, place = len(table), order[new]
    root = least_reached(rank[:half], rank[half:], len(place))
    moved = np.flatnonzero(root != np.arange(len(root)))
    sides = [ends.take(pa.array(place[x])) for x in (moved, root[moved])]
    return pa.RecordBatch.from_arrays(sides, ["u", "v"])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= EDGES:
            yield _forest(pa.Table.from_batches(held))
            held = []
    if sum(map(len, held)):
        yield _forest(pa.Table.from_batches(held))


def _thinned(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components: of each stretch of edges a forest, in
    which every node is linked to the least one it reaches within the stretch."""
    return edges.mapInArrow(_forests, edges.schema)


def _toward(edges: DataFrame, larger: bool) -> DataFrame:
    """Link each node's neighbours to its least neighbour: the larger ones, or
    the smaller ones together with the node itself.

    The least is a partial aggregate, and the join to it can be split, so a node
    with very many neighbours gathers in no task.
    """
    if larger:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy(F.col("u").alias("n")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        linked = near.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("n"))
        out = linked.select(F.col("m").alias("v"), F.col("v").alias("u"))
    else:
        least = edges.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m"))
        linked = edges.join(least, F.col("u") == F.col("n"))
        out = linked.select(F.col("m").alias("v"), F.col("v").alias("u")).union(
            least.select(F.col("m").alias("v"), F.col("n").alias("u"))
        )
    return out.where(F.col("u") > F.col("v")).select("u", "v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour and that one has none."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    ends = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(pairs: DataFrame) -> DataFrame:
    """`node` and `root`, the least node of its component, for every node of
    `pairs` (a, b) other than the roots themselves.  Nodes are whole numbers or
    structs of them, without nulls.

    Stretches of EDGES edges are thinned to forests, one or few to a task.  Rounds of
    stars join what spans several stretches, until every node is linked to its root;
    their number grows with the logarithm of the longest chain.  Each round is
    written, as the next one reads it more than once.
    """
    edges = stored(
        _thinned(
            pairs.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        )
    )
    while True:
        stretches = -(-edges.count() // EDGES)
        edges = stored(_thinned(edges.coalesce(max(1, stretches))))
        if stretches <= 1 or _settled(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = stored(_toward(_toward(edges, larger=True), larger=False))
