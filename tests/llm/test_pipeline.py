"""Mixing and the whole pipeline against plain recomputations."""

import math
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
import xxhash

from tests.llm.test_dedup import components, fingerprint, normal
from tests.llm.test_text import WORDS, base_counts, grams_of, xxh64_long
from tidemart.llm import mixing, pii, quality, simhash, tables


def plain_exponent(shares, target=mixing.TARGET_ENTROPY, most=mixing.MOST_REPEATS):
    def entropy(a):
        w = np.array(shares) ** a
        w /= w.sum()
        return -(w * np.log(w)).sum()

    low, high = 0.0, 1.0
    if entropy(1.0) >= target * math.log(len(shares)) - 1e-12:
        low = 1.0
    else:
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if entropy(mid) >= target * math.log(len(shares)) else (low, mid)
    spread = min(shares) / max(shares)
    if spread ** (low - 1) > most:
        low = 1 + math.log(most) / math.log(spread)
    return low


def place_of(copy, doc_id, seed=mixing.SEED):
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    h = xxhash.xxh64_intdigest(copy.to_bytes(4, "little"), h)
    h = h if doc_id is None else xxh64_long(doc_id % 2**64, h)
    return h - 2**64 if h >= 2**63 else h


def plain_mixture(units, quotas, blocks):
    """(doc_id, source, copy, start, block), and the same in the order of blocks and places."""
    out = []
    sources = defaultdict(list)
    for doc_id, source, tokens in units:
        sources[source].append((doc_id, tokens))
    for source, rows in sources.items():
        total, chunks, at, copy = sum(t for _, t in rows), math.ceil(math.sqrt(len(rows))), 0, 0
        while copy * total < quotas[source] or copy == 0:
            order = sorted(rows, key=lambda r: (((place_of(copy, r[0]) >> 20) + 8796093022208) % chunks, place_of(copy, r[0]), r[0] is not None, r[0]))
            for doc_id, tokens in order:
                if at < quotas[source]:
                    out.append((doc_id, source, copy, at, min(at * blocks // quotas[source], blocks - 1), place_of(copy, doc_id)))
                at += tokens
            copy += 1
    return out


def test_mixture_matches_a_plain_recomputation(awkward, rows):
    counted = Counter()
    for i, t, s in rows:
        counted[i, s] += len(WORDS.findall(t or "")) + 1
    units = [(i, s, n) for (i, s), n in counted.items()]
    found = mixing.units(awkward).cache()
    assert sorted(map(str, found.collect())) == sorted(f"Row(doc_id={i}, source={s!r}, tokens={n})" for i, s, n in units)
    plan = {r["source"]: r for r in mixing.plan(found, block_tokens=500).collect()}
    of = Counter()
    for _, s, n in units:
        of[s] += n
    shares = {s: n / sum(of.values()) for s, n in of.items()}
    a = plain_exponent(list(shares.values()))
    z = sum(x**a for x in shares.values())
    budget = max(n * z / shares[s] ** a for s, n in of.items())
    for s in of:
        assert plan[s]["weight"] == pytest.approx(shares[s] ** a / z, rel=1e-6)
        assert plan[s]["quota"] == pytest.approx(budget * shares[s] ** a / z, rel=1e-4, abs=1.5)
    blocks = plan[None]["blocks"]
    assert blocks == math.ceil(math.ceil(max(of[s] / plan[s]["weight"] for s in of)) / 500)
    want = plain_mixture(units, {s: r["quota"] for s, r in plan.items()}, blocks)
    got = mixing.mixture(found, mixing.plan(found, block_tokens=500).cache()).collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "source", "copy", "start", "block", "place")) for r in got) == Counter(want)


def test_mixed_rows_appear_as_often_as_in_the_mixture(awkward, rows):
    units = mixing.units(awkward).cache()
    chosen = mixing.mixture(units, mixing.plan(units).cache()).collect()
    repeated = Counter((i, s) for i, _, s in rows)
    want = Counter((r["doc_id"], r["source"]) for r in chosen for _ in range(repeated[r["doc_id"], r["source"]]))
    assert Counter((r["doc_id"], r["source"]) for r in mixing.mixed(awkward).collect()) == want


def test_blocks_of_more_tokens_than_a_long_can_multiply(spark):
    units = spark.createDataFrame([(i, f"s{i % 2}", 1_200_000_000_000) for i in range(20)], "doc_id long, source string, tokens long")
    plan = mixing.plan(units).cache()
    assert plan.first()["blocks"] == 24_000_000
    got = mixing.mixture(units, plan).collect()
    assert sorted(r["start"] for r in got) == sorted(2 * [k * 1_200_000_000_000 for k in range(10)])
    assert all(r["block"] == r["start"] * 24_000_000 // 12_000_000_000_000 for r in got)


def test_folders_without_the_cluster_setting(monkeypatch):
    local = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="local[2]"))
    assert tables.new_folder(local, "x") != tables.new_folder(local, "x")
    with pytest.raises(ValueError):
        tables.new_folder(SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn")), "x")


def test_addresses_with_very_long_parts():
    zeros = "0" * 5000
    assert pii.base_spans(f"x {zeros}.0.0.1") == [(2, 1, 5008)]
    assert pii.base_spans(".".join([zeros] * 4)) == [(0, 1, 20_003)]
    assert pii.base_spans("1" * 5000 + ".0.0.1") == []
    assert not pii.plausible(1, f"{zeros}9 . 256 . 1 . 1") and pii.plausible(1, f"{zeros}9 dot 25 dot 1 dot 1")


def test_one_row_per_near_group_also_without_or_with_repeated_ids(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    text = " ".join(words)
    near = " ".join(words[:-1])
    assert bin(fingerprint(text) ^ fingerprint(near)).count("1") <= 2
    other = [" ".join(rng.choices(words, k=60)) for _ in range(3)]
    rows = [(7, text), (7, near), (9, text), (None, text), (None, other[0]), (None, other[0]), (3, other[1]), (3, other[1]), (4, other[2])]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int").repartition(4)
    got = [(r["doc_id"], r["text"]) for r in simhash.without_near_duplicates(docs).collect()]
    assert Counter(i for i, _ in got) == {7: 1, None: 1, 3: 1, 4: 1}
    assert {t for _, t in got} - {text, near} == set(other)


# --- the whole pipeline --------------------------------------------------------------------------------------------


def plain_quality(rows, good):
    raw, trusted = Counter(), Counter()
    for r in rows:
        grams = Counter(grams_of(WORDS.findall(r[1] or "")))
        raw += grams
        if r[0] in good:
            trusted += grams
    share = sum(trusted.values()) / sum(raw.values())
    ratio = {b: round(1e6 * math.log((trusted[b] + quality.PRIOR * share) / ((raw[b] + quality.PRIOR) * share))) for b in raw}

    def kept(text):
        n, *_, repeated = base_counts(text)
        grams = grams_of(WORDS.findall(text or ""))
        return n >= 50 and 100 * repeated <= 50 * n and sum(ratio[b] for b in grams) >= round(quality.LEAST_RATIO * 1e6) * len(grams)

    return [r for r in rows if kept(r[1])]


def plain_exact(rows):
    last = {}
    for r in rows:
        last[normal(r[1])] = max(last.get(normal(r[1]), r), r, key=lambda x: x[0])
    return list(last.values())


def plain_near(rows):
    first = {}
    for r, root in zip(rows, components([fingerprint(r[1]) for r in rows], 2)):
        first[root] = min(first.get(root, r), r, key=lambda x: x[0])
    return list(first.values())


def test_pipeline_matches_brute_force(spark, tmp_path):
    """All five stages over made-up documents: clean ones, short and repetitive ones, foreign vocabulary, copies and near copies."""
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    rng = random.Random(21)
    clean = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    junk = [f"zq{i}" for i in range(30)]
    texts = [" ".join(rng.choices(clean, k=rng.randrange(60, 200))) for _ in range(40)]
    texts += [" ".join(rng.choices(junk, k=120)) for _ in range(8)]
    texts += ["too short", "", "same words again " * 40, texts[0].upper(), texts[1], texts[1]]
    long = [rng.choice(clean) for _ in range(600)]
    texts += [" ".join(long), " ".join(long[:-1]), " ".join(long[1:])]
    rows = [(i, t, "en", f"src{0 if i % 3 else i % 5}", len(t)) for i, t in enumerate(texts)]
    good = set(range(0, 40, 2))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i in good), 0) for i in range(len(rows))], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    after = plain_quality(rows, good)
    assert {r[0] for r in after} >= set(range(40)) and not {r[0] for r in after} & set(range(40, 51))
    exact = plain_exact(after)
    near = plain_near(exact)
    assert len(rows) > len(after) > len(exact) > len(near) >= 40
    units = [(r[0], r[3], len(WORDS.findall(r[1])) + 1) for r in near]
    plan = mixing.plan(spark.createDataFrame(units, "doc_id long, source string, tokens long")).collect()
    times = Counter(u[0] for u in plain_mixture(units, {r["source"]: r["quota"] for r in plan}, plan[0]["blocks"]))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter({(r[0], tuple(library.encode(r[1], add_special_tokens=False).ids)): times[r[0]] for r in near})
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got) and len(want) == len(near)
