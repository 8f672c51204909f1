"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its share of all tokens to a power.  The exponent is
searched so that the weights reach a target entropy, as far as a limit on
repetition allows.  A source's tokens are then drawn in passes over its
documents: in each pass its blocks come in a new order, and so do the documents
of a block; the last pass ends where the source's budget does.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.llm.common import id_or_last, stored

#: Fixed by the token's definition: words.
WORD = r"[^\x20\x09-\x0D]+"
#: Halvings of the interval of exponents: it ends shorter than 1e-8.
HALVINGS = 27


@dataclass(frozen=True)
class Mix:
    """Production parameters.

    `entropy` is the target's place between the entropy that the sources have (0)
    and the largest possible one (1), `repetition` the most passes over any
    source, `budget` the tokens to draw as a part of all tokens, and `block` the
    mean number of documents in a block.
    """

    entropy: float = 0.5
    repetition: float = 2.0
    budget: float = 1.0
    block: int = 4096
    seed: int = 42


def token_counts(docs: DataFrame) -> DataFrame:
    """doc_id, d, h, source and n_tokens of every row; a null text has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        id_or_last(F.col("doc_id")).alias("d"),
        F.xxhash64(text).alias("h"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
    )


def by_source(counts: DataFrame) -> DataFrame:
    """Tokens and rows of each source; null is a source of its own."""
    return counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))


def exponent(sources: DataFrame, mix: Mix) -> float:
    """The exponent between 0 and 1 that `mix` asks for, by bisection.

    Entropy falls as the exponent rises from 0, where all weights are equal, to
    1, where they are the shares; the most often repeated source, a small one,
    is repeated less.  So it is the largest exponent that reaches the target
    entropy, or if a source would be repeated too often, the smallest one that
    keeps within the limit.  A step is one aggregate over the sources.
    """
    some = sources.where("tokens > 0")
    whole = some.agg(F.sum("tokens").alias("all"), F.count("*").alias("n")).first()
    if not whole["n"]:
        return 1.0
    everything = float(whole["all"])
    share = F.col("tokens") / everything

    def at(a: float) -> tuple[float, float]:
        """Entropy of the weights, and passes over the source repeated most."""
        powered = F.pow(share, F.lit(a))
        sums = some.agg(
            F.sum(powered).alias("z"),
            F.sum(powered * F.ln(share)).alias("e"),
            F.max(powered / F.col("tokens")).alias("most"),
        ).first()
        return log(sums["z"]) - a * sums["e"] / sums["z"], sums["most"] * everything * mix.budget / sums["z"]

    own, highest = at(1.0)[0], log(whole["n"])
    target = own + mix.entropy * (highest - own)
    # Up to here the target is reached, beyond it isn't; shares that are equal reach it anywhere.
    low, high = (1.0, 1.0) if target <= own + 1e-12 else (0.0, 1.0)
    for _ in range(HALVINGS if low < high else 0):
        middle = (low + high) / 2
        low, high = (middle, high) if at(middle)[0] >= target else (low, middle)
    if at(low)[1] <= mix.repetition + 1e-9:
        return low
    high = 1.0
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        low, high = (low, middle) if at(middle)[1] <= mix.repetition else (middle, high)
    return high


def budgets(sources: DataFrame, mix: Mix) -> DataFrame:
    """Weight, budget in tokens and blocks of each source."""
    some = sources.where("tokens > 0")
    whole = some.agg(F.sum("tokens").alias("all")).first()["all"] or 0
    a = exponent(sources, mix)
    powered = F.pow(F.col("tokens") / float(whole or 1), F.lit(a))
    total = some.agg(F.sum(powered).alias("z")).first()["z"] or 1.0
    weight = F.when(F.col("tokens") > 0, powered / total).otherwise(F.lit(0.0))
    return (
        sources.withColumn("budget", F.floor(weight * F.lit(float(whole * mix.budget)) + 1e-6))
        .withColumn("weight", F.round(weight, 12))
        .withColumn("blocks", F.ceil(F.col("rows") / F.lit(mix.block)).cast("long"))
    )


def _order(mix: Mix, *columns: str | Column) -> Column:
    return F.xxhash64(F.lit(mix.seed), *[F.col(c) if isinstance(c, str) else c for c in columns])


def _block(mix: Mix, d: str, h: str) -> Column:
    return F.pmod(_order(mix, d, h), F.col("s.blocks"))


def plan(counts: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """Budgets of the sources, and for each block how often it is drawn.

    `passes` is the number of whole passes; in the pass after them a block is
    drawn whole (`last` = 1), up to the document with order key `cut`
    (`last` = 2), or not at all (0).  Windows run over one row for each block,
    and over the documents of one block for each source.
    """
    sources = stored(budgets(stored(by_source(counts)), mix))
    same = F.col("c.source").eqNullSafe(F.col("s.source"))
    placed = counts.alias("c").join(sources.alias("s"), same).select(
        "c.source", "d", "h", "n_tokens", "s.tokens", "s.budget", _block(mix, "d", "h").alias("block")
    )
    passes = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0))
    blocks = (
        placed.groupBy("source", "block")
        .agg(
            F.sum("n_tokens").alias("n"),
            F.first(passes).alias("passes"),
            F.first(F.when(F.col("tokens") > 0, F.col("budget") - passes * F.col("tokens")).otherwise(0)).alias("rest"),
        )
    )
    order = W.partitionBy("source").orderBy(_order(mix, "passes", "source", "block"), "block")
    before = F.sum("n").over(order) - F.col("n")
    ranked = blocks.withColumn("left", F.col("rest") - before).withColumn(
        "last",
        F.when(F.col("left") <= 0, 0).when(F.col("left") >= F.col("n"), 1).otherwise(2),
    )
    ranked = stored(ranked.select("source", "block", "passes", "left", "last"))
    # The documents of the block in which a source's budget ends.
    edge = ranked.where("last = 2").alias("b")
    inside = placed.alias("p").join(
        edge, F.col("p.source").eqNullSafe(F.col("b.source")) & (F.col("p.block") == F.col("b.block"))
    )
    key = _order(mix, "b.passes", "p.d", "p.h")
    inside = inside.select(F.col("p.source").alias("source"), "p.n_tokens", "b.left", key.alias("key"))
    reached = F.sum("n_tokens").over(W.partitionBy("source").orderBy("key"))
    cuts = (
        inside.withColumn("reached", reached)
        .where("reached <= left")
        .groupBy(F.col("source").alias("cut_source"))
        .agg(F.max("key").alias("cut"))
    )
    planned = ranked.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
        "source", "block", "passes", "last", F.when(F.col("last") == 2, F.col("cut")).alias("cut")
    )
    return sources, stored(planned)


def drawn(rows: DataFrame, sources: DataFrame, blocks: DataFrame, mix: Mix) -> DataFrame:
    """`rows` with one copy for each pass that draws them, and `_pass`, `_block`, `_at`.

    Sorted by `_pass`, by the block's order key and by `_at`, a source's rows
    are its block permutation.  The plan is joined to the rows as they are.
    """
    s, b = sources.alias("s"), blocks.alias("_b")
    at = rows.alias("_r").join(s, F.col("_r._source").eqNullSafe(F.col("s.source")))
    at = at.select("_r.*", F.col("s.weight").alias("_weight"), _block(mix, "_r._d", "_r._h").alias("_block"))
    at = at.alias("_r").join(
        b, F.col("_r._source").eqNullSafe(F.col("_b.source")) & (F.col("_r._block") == F.col("_b.block"))
    )
    key = _order(mix, "_b.passes", "_r._d", "_r._h")
    more = (F.col("_b.last") == 1) | ((F.col("_b.last") == 2) & (key <= F.col("_b.cut")))
    times = F.col("_b.passes") + F.coalesce(more, F.lit(False)).cast("long")
    at = at.where(times > 0).select("_r.*", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("_pass"))
    return at.withColumn("_at", _order(mix, "_pass", "_d", "_h"))


def mixture(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The draws of the mixture: one row for each document and pass.

    A source's documents that lie beyond its budget aren't drawn; a source
    without tokens has weight zero.  Documents with a null source make up a
    source.  Repeated rows are drawn alike.  `block` numbers the blocks of a
    source and `place` orders the rows of a block in a pass.  Further columns
    are not returned.  Without documents there are no draws.
    """
    counts = stored(token_counts(docs))
    sources, blocks = plan(counts, mix)
    rows = counts.select(
        "doc_id", "n_tokens", F.col("source").alias("_source"), F.col("d").alias("_d"), F.col("h").alias("_h")
    )
    return drawn(rows, sources, blocks, mix).select(
        "doc_id",
        F.col("_source").alias("source"),
        "n_tokens",
        F.col("_weight").alias("weight"),
        F.col("_pass").alias("pass"),
        F.col("_block").alias("block"),
        F.col("_at").alias("place"),
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The rows of `docs` as the mixture draws them, with all their columns; a
    row drawn in several passes comes as often.
    """
    counts = stored(token_counts(docs))
    sources, blocks = plan(counts, mix)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("source").cast("string").alias("_source"),
        id_or_last(F.col("doc_id")).alias("_d"),
        F.xxhash64(text).alias("_h"),
    )
    return drawn(rows, sources, blocks, mix).select("_row.*")
