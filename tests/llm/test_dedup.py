from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemart.llm import exact_dedup, simhash
from tidemart.llm.components import smallest_reachable


def normal(text):
    return (text or "").encode().lower()


def test_exact_duplicates_match_brute_force(awkward, rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[normal(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), sha256(t).hexdigest()) for i in ids)
    for k in (1, 3, 1023):  # few counters, so that the broadcast side and the shuffled side both have rows
        got = exact_dedup.exact_duplicates(awkward, k).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in got) == want
        kept = Counter(r["digest"] for r in got if r["kept"])
        assert len(kept) == len(groups) and set(kept.values()) == {1}
        assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_misra_gries_keeps_what_is_frequent():
    rng = np.random.default_rng(1)
    keys = rng.zipf(1.3, 20_000) % 500
    k, summary = 20, {}
    for part in np.array_split(keys, 7):
        values, counts = np.unique(part, return_counts=True)
        exact_dedup.add_to_summary(summary, values.tolist(), counts.tolist(), k)
    true = Counter(keys.tolist())
    assert len(summary) <= k
    for key, n in true.items():
        assert 0 <= n - summary.get(key, 0) <= len(keys) / (k + 1)


def test_frequent_digests_are_bounded_and_complete(spark):
    df = spark.range(4000).select(F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 5 = 0 THEN 'warm' ELSE CAST(id AS STRING) END").cast("binary").alias("digest")).repartition(5)
    found = {bytes(r["digest"]) for r in exact_dedup.frequent(df, 10).collect()}
    assert {b"hot"} <= found and len(found) <= 11


def test_exact_stage_keeps_rows_and_columns(awkward, rows):
    out = exact_dedup.without_exact_duplicates(awkward)
    assert out.columns == awkward.columns
    assert Counter(normal(r["text"]) for r in out.collect()) == Counter({normal(t): 1 for _, t, _ in rows})


def fingerprint(text, width=3):
    words = normal(text).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(values, most):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if bin(values[i] ^ values[j]).count("1") <= most:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("paired_bucket", [0, 128])
def test_near_duplicates_match_brute_force(awkward, rows, paired_bucket):
    fps = [fingerprint(t) for _, t, _ in rows]
    roots = components(fps, 2)
    least = {}
    for (i, _, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = Counter((i, f, least.get(r)) for (i, _, _), f, r in zip(rows, fps, roots))
    got = simhash.near_duplicates(awkward, 3, 2, paired_bucket).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == want


@pytest.mark.parametrize("most", [0, 1, 2, 3])
@pytest.mark.parametrize("paired_bucket", [0, 20, 10_000])
def test_links_lose_nothing(spark, most, paired_bucket):
    """A crowd around one value, chains and strangers; pairs, halfway keys and both together give the same groups."""
    rng = np.random.default_rng(most)
    centre = int(rng.integers(0, 2**63))
    values = {centre} | {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (60, 2))}
    values |= {int(x) for x in rng.integers(0, 2**63, 60)}
    at = int(rng.integers(0, 2**63))
    for b in range(0, 30, 2):
        at ^= 3 << b
        values.add(at)
    values = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    links = simhash.links(fps, most, paired_bucket)
    pairs = links.collect()
    assert all(bin((a ^ b) % 2**64).count("1") <= most for a, b in pairs)
    found = {r["node"]: r["root"] for r in smallest_reachable(links).collect()}
    roots = components([v % 2**64 for v in values], most)
    groups = defaultdict(list)
    for v, r in zip(values, roots):
        groups[r].append(v)
    assert {v: min(g) for g in groups.values() for v in g if len(g) > 1} == found


def test_thresholds_follow_costs():
    assert simhash.allotted([[5.0, 9.0], [1.0, 2.0]], 1)[1] == [0, 1]
    assert simhash.allotted([[5.0, 6.0], [1.0, 9.0]], 1)[1] == [1, 0]
    corr = np.eye(64)
    corr[0, 63] = corr[63, 0] = 0.9
    groups = simhash.grouped_bits(corr, 3)
    assert sorted(b for g in groups for b in g) == list(range(64)) and any({0, 63} <= set(g) for g in groups)


def test_near_stage_keeps_one_row_per_component(awkward):
    out = simhash.without_near_duplicates(awkward)
    got = simhash.near_duplicates(awkward)
    assert out.columns == awkward.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert set(ids) - {None} == {r["component_id"] for r in got.collect()} - {None}


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5, 4)]
    got = {r["node"]: r["root"] for r in smallest_reachable(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}


def test_empty_tables(nothing):
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    assert simhash.near_duplicates(nothing).count() == 0
    assert exact_dedup.without_exact_duplicates(nothing).count() == 0


def test_texts_leave_a_batch_a_few_at_a_time():
    """A batch's texts are never all held a second time, from Arrow or from pandas."""
    import tracemalloc

    import pandas as pd
    import pyarrow as pa
    import pyarrow.compute as pc

    from tidemart.llm.tables import texts_of, texts_of_series

    texts = [None if i % 100 == 7 else f"Text {i} " + "x" * 10_000 for i in range(3000)]
    for read in (lambda: texts_of(pa.array(texts)), lambda: texts_of_series(pd.Series(texts), pc.ascii_lower)):
        plain = [(t or "").encode() for t in texts]
        tracemalloc.start()
        for found, wanted in zip(read(), plain, strict=True):
            assert found.lower() == wanted.lower()
        _, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert most < 8_000_000
