"""SimHash fingerprints and their near-duplicate groups by the generalised pigeonhole principle.

Fingerprints: a bit is 1 if it is set in more than half of the hashes of the word shingles. Groups: connected
components of the fingerprints that differ in at most ``max_distance`` bits, found without comparing all pairs:

1. equal fingerprints become one row, so copies cost nothing further;
2. bits that go together over the whole corpus are put into the same partition (64 x 64 counts, summed in Spark);
3. the generalised pigeonhole principle: with partitions 1..m and thresholds summing to ``max_distance - m + 1``, two
   fingerprints within the distance agree up to the threshold in one partition. Number of partitions and thresholds
   come from dynamic programming over estimated candidate counts;
4. every fingerprint is filed under its value in each partition and probes the values within that partition's
   threshold; candidates are verified by their bit distance;
5. a bucket too large for pairs is resolved exactly in linear work: its members, and whatever probes it, meet at the
   values halfway between them (``halfway_keys``), and each such value links its members to its smallest one.

Nulls: a null text is empty; an empty text has fingerprint zero, which links like any other; a null doc_id never
becomes a component id. Repeated rows stay. Other columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemart.operators.sampling import hash_border

from .components import SALT, smallest_reachable
from .tables import saved, texts_of, texts_of_series

BITS = 64
SEED = 42
#: Shingles hashed at once; bounds the memory for one long text.
CHUNK = 1 << 15
#: Pairs of a bucket are compared if it has at most so many fingerprints; larger ones go the halfway keys.
PAIRED_BUCKET = 128
#: Fingerprints that the estimate of candidate counts looks at. It only steers cost, never the result.
ESTIMATE_SAMPLE = 2048
#: A fingerprint with at least one HEAVY-th of all rows is joined by broadcast; there are at most HEAVY such.
HEAVY = 1000


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit fingerprint of a UTF-8 text."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = (starts + lengths)[width - 1 :].tolist()
    starts = starts[: len(ends)].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(ends), CHUNK):
        cut = map(joined.__getitem__, map(slice, starts[at : at + CHUNK], ends[at : at + CHUNK]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(SEED)), np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(ends), bitorder="little")
    return int(packed.view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter((fingerprint(t, shingle) for t in texts_of(batch.column(1))), np.int64, batch.num_rows)
        yield pa.record_batch([batch.column(0), pa.array(values)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id and its fingerprint as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), "doc_id long, fp long")


# --- partitions and thresholds -------------------------------------------------------------------------------------


def _bit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often bits i and j are 1 together, one row per pair of bits and task."""
    both = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        bits = _bits(np.asarray(batch.column(0)))
        for at in range(0, len(bits), CHUNK):
            x = bits[at : at + CHUNK].astype(np.float32)
            both += (x.T @ x).astype(np.int64)
    yield pa.record_batch([pa.array(np.arange(BITS * BITS)), pa.array(both.ravel())], names=["at", "n"])


def _bits(fps: np.ndarray) -> np.ndarray:
    """(n, 64) zeros and ones, lowest bit first."""
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlation(fps: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of fingerprints, share of ones per bit, and absolute correlation of the bits, over all of them."""
    sums = fps.select("fp").mapInArrow(_bit_counts, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS)
    for row in sums.collect():  # at most 64 * 64 rows
        both[row["at"]] = row["n"]
    both = both.reshape(BITS, BITS)
    n = fps.count()
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    return n, p, np.abs(np.divide(cov, spread, out=np.zeros_like(cov), where=spread > 0))


def grouped_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into ``parts`` groups of nearly equal size; each grows by the free bit closest to it."""
    free, groups = list(range(BITS)), []
    for left in range(parts, 0, -1):
        size = math.ceil(len(free) / left) if left > 1 else len(free)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < size:
            near = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(near)
            free.remove(near)
        groups.append(sorted(group))
    return groups


def _chance_within(p: np.ndarray, group: list[int], sample: np.ndarray, most: int) -> list[float]:
    """Estimated chance that two fingerprints differ in at most 0..most bits of the group: the larger of what
    independent bits and what pairs of the sample say."""
    differ = [2 * p[b] * (1 - p[b]) for b in group]
    exactly = np.zeros(len(group) + 1)
    exactly[0] = 1
    for d in differ:
        exactly[1:] = exactly[1:] * (1 - d) + exactly[:-1] * d
        exactly[0] *= 1 - d
    if len(sample) > 1:
        x = sample[:, group].astype(np.float32)
        apart = x @ (1 - x).T
        apart = (apart + apart.T)[np.triu_indices(len(x), 1)]
        seen = [float((apart <= t + 0.5).mean()) for t in range(most + 1)]
    else:
        seen = [0.0] * (most + 1)
    return [max(float(exactly[: t + 1].sum()), s) for t, s in zip(range(most + 1), seen)]


def allotted(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds (-1: partition not probed, its cost is 0) that sum to ``total`` at the least cost.
    costs[i][t]: of partition i at threshold t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, chosen) in best.items():
            for t in range(-1, len(cost)):
                now = (c + (cost[t] if t >= 0 else 0.0), [*chosen, t])
                if spent + t not in step or now < step[spent + t]:
                    step[spent + t] = now
        best = step
    return best[total]


def search_plan(fps: DataFrame, max_distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each probed partition, at the least estimated cost."""
    n, p, corr = correlation(fps)
    hashed = F.xxhash64("fp")
    picked = fps.filter(hashed <= hash_border(fps, hashed, ESTIMATE_SAMPLE)).orderBy(hashed, "fp").limit(ESTIMATE_SAMPLE).collect()
    sample = _bits(np.array([r["fp"] for r in picked], np.int64)) if picked else np.zeros((0, BITS), np.uint8)
    plans = []
    for parts in range(1, max_distance + 2):
        groups = grouped_bits(corr, parts)
        costs = []
        for g in groups:
            chance = _chance_within(p, g, sample, max_distance)
            probes = np.cumsum([math.comb(len(g), k) for k in range(max_distance + 1)])
            costs.append([n * (n - 1) / 2 * c + n * float(k) for c, k in zip(chance, probes)])
        plans.append((*allotted(costs, max_distance - parts + 1), groups))
    _, thresholds, groups = min(plans, key=lambda x: x[0])
    return [(g, t) for g, t in zip(groups, thresholds) if t >= 0]


# --- candidates ----------------------------------------------------------------------------------------------------


def _mask(bits: Iterable[int]) -> int:
    """The bits set, as a signed long."""
    mask = sum(1 << b for b in bits)
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _flips(bits: list[int], most: int) -> list[int]:
    return [_mask(c) for k in range(most + 1) for c in combinations(bits, k)]


def halfway_keys(fps: DataFrame, max_distance: int) -> DataFrame:
    """(bit, key, fp) such that two fingerprints share a (bit, key) just if they differ in at most ``max_distance`` bits.

    Even distance 2r: all values within r bits; two within 2r have one halfway. Odd distance: one bit is masked besides.
    """
    keys = fps.select("fp", F.explode(F.lit(_flips(list(range(BITS)), max_distance // 2))).alias("flip"))
    keys = keys.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("key"))
    if max_distance % 2 == 0:
        return keys.select(F.lit(-1).alias("bit"), "key", "fp")
    masked = F.array(*[F.struct(F.lit(b).alias("bit"), F.col("key").bitwiseAND(F.lit(~_mask([b]))).alias("key")) for b in range(BITS)])
    return keys.select("fp", F.explode(masked).alias("m")).select("m.bit", "m.key", "fp").distinct()


def links(fps: DataFrame, max_distance: int, paired_bucket: int = PAIRED_BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect just what lies within ``max_distance`` bits of each other."""
    plan = search_plan(fps, max_distance)
    parts = [F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(_mask(g))).alias("value")) for i, (g, _) in enumerate(plan)]
    filed = fps.select("fp", F.explode(F.array(*parts)).alias("v")).select("v.part", "v.value", "fp")
    flips = F.element_at(F.array(*[F.lit(_flips(g, t)) for g, t in plan]), F.col("part") + 1)
    exact = all(t == 0 for _, t in plan)
    probes = filed if exact else filed.select("part", F.explode(F.transform(flips, lambda m: F.col("value").bitwiseXOR(m))).alias("value"), "fp")
    large = saved(filed.groupBy("part", "value").count().filter(F.col("count") > paired_bucket).select("part", "value"), "buckets")
    a = probes.join(large, ["part", "value"], "left_anti").withColumnRenamed("fp", "a")
    b = filed.withColumnRenamed("fp", "b")
    verified = (F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
    if exact:
        verified = (F.col("a") < F.col("b")) & verified
    ordinary = a.alias("a").join(b.alias("b"), (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value")) & verified)
    crowded = probes.join(large, ["part", "value"], "left_semi").select("fp").distinct()
    keys = halfway_keys(crowded, max_distance)
    hubs = keys.groupBy("bit", "key").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).filter("first <> last")
    starred = keys.join(hubs, ["bit", "key"]).select(F.col("fp").alias("a"), F.col("first").alias("b"))
    return ordinary.select("a", "b").union(starred).filter("a <> b")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, paired_bucket: int = PAIRED_BUCKET) -> DataFrame:
    """doc_id, fp (signed long) and component_id (smallest doc_id reachable) for every row of ``docs``."""
    marked = saved(fingerprints(docs, shingle), "fingerprints")
    fps = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("rows")), "distinct")
    roots = smallest_reachable(links(fps.select("fp"), max_distance, paired_bucket))
    roots = roots.select(F.col("node").alias("fp"), "root")
    grouped = fps.join(roots, "fp", "left").select("fp", "first_id", "rows", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return _with_component(marked, _component_of(grouped, ids))


def _component_of(grouped: DataFrame, ids: DataFrame) -> DataFrame:
    """fp, rows, component_id; only components of several fingerprints are joined, one root may hold very many."""
    alone = grouped.filter("fp = root")
    joined = grouped.filter("fp <> root").withColumn("_s", F.expr(f"CAST(pmod(xxhash64(fp), {SALT}) AS INT)"))
    spread = grouped.filter("fp <> root").select("root").distinct().join(ids, "root")
    spread = spread.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    several = joined.join(spread, ["root", "_s"]).select("fp", "rows", "component_id")
    first = alone.join(ids, "root").select("fp", "rows", "component_id")
    return saved(first.union(several), "components")


def _with_component(marked: DataFrame, named: DataFrame) -> DataFrame:
    """Joins by fingerprint. At most HEAVY fingerprints hold a HEAVY-th of all rows each; these are broadcast and
    joined on the map side, the rest is shuffled."""
    total = marked.count()
    heavy = named.filter(F.col("rows") * HEAVY >= total)
    by_map = marked.join(F.broadcast(heavy), "fp")
    rest = marked.join(F.broadcast(heavy.select("fp")), "fp", "left_anti").join(named, "fp")
    return by_map.select("doc_id", "fp", "component_id").union(rest.select("doc_id", "fp", "component_id"))


def without_near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of ``docs`` per component, with its columns: the one with the smallest doc_id, a null one only if no other has an
    id. Of rows that share that id, one stays. The rows are written once with their fingerprint, so none is computed twice."""

    @F.pandas_udf(LongType())
    def mark(text: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts_of_series(text)], dtype="int64")

    rows = saved(docs.withColumns({"__near_fp": mark(F.col("text").cast("string")), "__near_row": F.monotonically_increasing_id()}), "marked-rows")
    doc_id = F.col("doc_id").cast("long")
    first = F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("doc_id"), F.col("__near_row").alias("row")))
    fps = saved(rows.groupBy(F.col("__near_fp").alias("fp")).agg(first.alias("first")), "distinct")
    roots = smallest_reachable(links(fps.select("fp"), max_distance)).select(F.col("node").alias("fp"), "root")
    grouped = fps.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
    stay = grouped.agg(F.min("first").alias("first")).select(F.col("first.row").alias("__near_row"))
    return rows.join(stay, "__near_row", "left_semi").select(*docs.columns)


def fingerprint_text() -> F.Column:
    return F.lower(F.lpad(F.hex("fp"), 16, "0"))
