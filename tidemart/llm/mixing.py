"""Mixing sources: temperature weights and budgeted block permutations.

Weights: source shares of the tokens are raised to an exponent and normalised. An exponent of 1 keeps the natural
shares, 0 makes all sources equal. Entropy of the weights falls and the number of repetitions of the smallest source
falls as the exponent rises, so bisection finds the exponent that meets a target entropy and, from there on upwards, the
first that keeps all repetitions within a limit. Each round evaluates a grid of exponents over the table of sources in
Spark, with sums in decimals, so the order of rows does not matter.

Realisation: with a token budget each source gets its weight's part of it. A source repeats its documents in copies;
each copy is a permutation of its own (by a hash of seed, copy and id), and the last one is cut where the source's
quota is met. By default the budget is the least for which every document appears once. The stream of each source is
cut into the same number of blocks, so every block holds all sources by their weights, in the order of ``place``.
Positions are running sums of tokens per source and copy: sums of about sqrt(n) chunks of the permutation, then inside
each chunk, so the rows of one source never meet in one task.

A document has as many tokens as words and one end. A null text has one token; null sources form a source of their own;
rows that repeat source and id form one unit and stay together; a null id is an id. An empty table gives no rows.
"""

from __future__ import annotations

import math
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from collections.abc import Iterator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import saved

TARGET_ENTROPY = 0.98  # of the largest possible, log(number of sources)
MOST_REPEATS = 4.0
BLOCK_TOKENS = 1_000_000
SEED = 17
GRID, ROUNDS = 32, 8
#: Up to so many sources their table is broadcast; beyond it the join is shuffled, rows of a source dealt over SALT.
BROADCAST_SOURCES, SALT = 100_000, 64


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [len((t or b"").split()) + 1 for t in pc.cast(batch.column(2), pa.large_binary()).to_pylist()]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(words, pa.int64())], names=["doc_id", "source", "tokens"])


def units(docs: DataFrame) -> DataFrame:
    """doc_id, source, tokens: one row per distinct pair of id and source."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_counted, "doc_id long, source string, tokens long")
    return counted.groupBy("doc_id", "source").agg(F.sum("tokens").alias("tokens"))


def exponent(sources: DataFrame, target_entropy: float, most_repeats: float, budget: float | None = None) -> tuple[float, float]:
    """(exponent, sum of the shares raised to it) for ``sources`` (share). Without a budget the largest source appears
    once, so the repeats of source i are (share_i / share_max) ^ (exponent - 1)."""
    ends = sources.agg(F.count("*").alias("n"), F.min("share").alias("least"), F.max("share").alias("most")).first()
    wanted = target_entropy * math.log(ends["n"])

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        power = [F.pow("share", F.lit(a)) for a in exponents]
        total = [F.sum(p.cast("decimal(38,18)")) for p in power]
        logs = [F.sum((p * F.log("share")).cast("decimal(38,18)")) for p in power]
        row = sources.agg(*[x.alias(f"c{i}") for i, x in enumerate(total + logs)]).first()
        values = [float(x or Decimal(0)) for x in row]
        return list(zip(values[: len(power)], values[len(power) :]))

    def flat_enough(a: float, z: float, zl: float) -> bool:
        return math.log(z) - a * zl / z >= wanted

    def seldom_enough(a: float, z: float, zl: float) -> bool:
        if budget is None:
            return (ends["least"] / ends["most"]) ** (a - 1) <= most_repeats
        return budget * ends["least"] ** (a - 1) / z <= most_repeats

    def bisect(low: float, high: float, low_side) -> float:
        """The border between exponents where ``low_side`` holds (from ``low`` on) and where it does not."""
        for _ in range(ROUNDS):
            grid = [low + (high - low) * k / GRID for k in range(GRID + 1)]
            holds = [low_side(a, *s) for a, s in zip(grid, sums(grid))]
            if not holds[0]:
                return low
            if all(holds):
                return high
            k = holds.index(False)
            low, high = grid[k - 1], grid[k]
        return low

    a = bisect(0.0, 1.0, flat_enough)
    if not seldom_enough(a, *sums([a])[0]):
        a = bisect(a, 1.0, lambda *x: not seldom_enough(*x))
    return a, sums([a])[0][0]


def plan(docs_units: DataFrame, target_entropy: float = TARGET_ENTROPY, most_repeats: float = MOST_REPEATS, budget: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Per source: n, tokens, weight, quota (tokens of the mixture), blocks (of the whole mixture)."""
    sums = docs_units.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    total = sums.agg(F.sum("tokens")).first()[0]
    if not total:
        return sums.select("source", "n", "tokens", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("quota"), F.lit(1).cast("long").alias("blocks"))
    sources = saved(sums.withColumn("share", F.col("tokens") / F.lit(total)), "sources")
    a, z = exponent(sources, target_entropy, most_repeats, None if budget is None else budget / total)
    weighted = sources.withColumn("weight", F.pow("share", F.lit(a)) / F.lit(z))
    if budget is None:
        budget = math.ceil(weighted.agg(F.max(F.col("tokens") / F.col("weight"))).first()[0])
    quota = F.round(F.col("weight") * F.lit(budget)).cast("long")
    return weighted.select("source", "n", "tokens", "weight", quota.alias("quota"), F.lit(max(1, math.ceil(budget / block_tokens))).cast("long").alias("blocks"))


def _with_plan(docs_units: DataFrame, sources: DataFrame) -> DataFrame:
    right = sources.select(F.col("source").alias("_source"), "n", F.col("tokens").alias("of_source"), "quota", "blocks")
    if sources.count() <= BROADCAST_SOURCES:
        return docs_units.join(F.broadcast(right), F.col("source").eqNullSafe(F.col("_source")))
    left = docs_units.withColumn("_s", F.expr(f"CAST(pmod(xxhash64(doc_id), {SALT}) AS INT)"))
    right = right.withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_s") == F.col("_t")))


def mixture(docs_units: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, tokens, copy (from 0), start (tokens of the source's stream before it), block, place (order in
    the block). ``docs_units`` and ``sources`` are read several times; save them first."""
    planned = _with_plan(docs_units, sources)
    copies = F.greatest(F.lit(1), F.ceil(F.col("quota") / F.col("of_source"))).cast("int")
    rows = planned.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    rows = rows.withColumn("place", F.xxhash64(F.lit(seed), "copy", "doc_id"))
    chunk = F.expr("CAST(pmod(shiftright(place, 20) + 8796093022208, ceil(sqrt(n))) AS LONG)")
    rows = rows.select("doc_id", "source", "tokens", "copy", "place", "of_source", "quota", "blocks", chunk.alias("chunk"))
    sums = rows.groupBy("source", "copy", "chunk").agg(F.sum("tokens").alias("of_chunk"))
    ahead = Window.partitionBy("source", "copy").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col("source").alias("_source"), F.col("copy").alias("_copy"), F.col("chunk").alias("_chunk"), F.coalesce(F.sum("of_chunk").over(ahead), F.lit(0)).alias("before"))
    joined = rows.join(before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("copy") == F.col("_copy")) & (F.col("chunk") == F.col("_chunk")))
    inside = Window.partitionBy("source", "copy", "chunk").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("copy") * F.col("of_source") + F.col("before") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    placed = joined.withColumn("start", start).filter("start < quota")
    # Tokens times blocks is beyond a long from some trillions of tokens on.
    block = F.least(F.expr("CAST(start AS DECIMAL(20, 0)) * CAST(blocks AS DECIMAL(18, 0)) DIV quota"), F.col("blocks") - 1)
    return placed.select("doc_id", "source", "tokens", "copy", "start", block.cast("long").alias("block"), F.col("place"))


def mixed(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, most_repeats: float = MOST_REPEATS, budget: int | None = None) -> DataFrame:
    """The mixture of whole rows: every row of ``docs`` as often as its unit is in the mixture, with its columns, in no order. Who
    wants the order of blocks takes it from ``mixture``: bringing every copy of a text to its block moves the whole mixture once more."""
    found = saved(units(docs), "mixing-units")
    chosen = mixture(found, saved(plan(found, target_entropy, most_repeats, budget), "mixing-plan"))
    times = chosen.groupBy("doc_id", "source").agg(F.count("*").cast("int").alias("_times")).select(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), "_times")
    own = docs.withColumns({"_own_id": F.col("doc_id").cast("long"), "_own_source": F.col("source").cast("string")})
    joined = own.join(times, F.col("_own_id").eqNullSafe(F.col("_mix_id")) & F.col("_own_source").eqNullSafe(F.col("_mix_source")))
    return joined.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*docs.columns)
