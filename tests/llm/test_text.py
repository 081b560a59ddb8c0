"""Quality rules, URL rules, toxicity, language model, mixing, personal data and the pipeline against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemart.llm import kneser_ney, mixing, pii, quality, toxicity, url_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def key(row):
    return tuple((v is not None, v) for v in row)


# --- quality rules -------------------------------------------------------------------------------------------------


def xxh64_long(value: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed)


def grams_of(words):
    """Buckets of unigrams and bigrams; the chained hash takes the hash so far as its seed."""
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    pairs = [xxh64_long(b, xxh64_long(a, 42)) for a, b in zip(hashes, hashes[1:])]
    return [h % quality.BUCKETS for h in hashes + pairs]


def base_counts(text):
    words = WORDS.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + d for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_quality_rules_match_brute_force(awkward, rows, labels):
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and r["doc_id"] is not None}
    raw, trusted = Counter(), Counter()
    for i, t, _ in rows:
        grams = Counter(grams_of(WORDS.findall(t or "")))
        raw += grams
        if i in good:
            trusted += grams
    share = sum(trusted.values()) / sum(raw.values())
    ratio = {b: round(1e6 * math.log((trusted[b] + quality.PRIOR * share) / ((raw[b] + quality.PRIOR) * share))) for b in raw}
    want = []
    for i, t, _ in rows:
        counts = base_counts(t)
        grams = grams_of(WORDS.findall(t or ""))
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        enough = sum(ratio[b] for b in grams) >= round(quality.LEAST_RATIO * 1e6) * len(grams)
        want.append((i, *counts, failed, not failed and enough))
    found = quality.judged(awkward, quality.trusted_ids(labels)).select("doc_id", "__q.*").drop("ratio")
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    kept = quality.good_documents(awkward, quality.trusted_ids(labels))
    assert kept.columns == awkward.columns and kept.count() == sum(w[-1] for w in want) > 5


def test_quality_rules_without_rows_or_trust(awkward, nothing, labels):
    assert quality.judged(nothing, quality.trusted_ids(labels)).count() == 0
    untrusted = quality.judged(awkward, quality.trusted_ids(labels.limit(0))).select("__q.*").collect()
    assert all(not r["ratio"] and r["kept"] != r["base_failed"] for r in untrusted)


# --- URL rules -----------------------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/es/x", "https://www.example.org/en/1?q#f", "https://a.org", "https://a.org/b",
    "http://x.com/fr/", "http://x.com/de/a?b", "http://com/fr/", "http://notexample.org/es/", "http://my.casino.net/", "http://mycasino.net/",
    "http://best-casino.net:80/a", "http://x.net/casino", "ftp://a://b.org/c", "https://casino", "http://é.com/fr/é", "http://x.org#/y",
    "http://x.com/FR/", "http://spam.org/a", "http://www.example.org/e\n/es/", "https://example.org/en/1" + "0" * 5000,
]


def parts(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def verdict_of(url):
    host, path = parts(url)
    best = (-1, None, None)
    for r in url_rules.LISTED_RULES:
        name = r.pattern[2:]
        domain, start = name.split("/", 1)
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + start):
            best = max(best, (len(name), name, r.verdict))
    if best[1]:
        return host, path, best[1], best[2]
    unwanted = any(w in re.split("[^A-Za-z0-9]", host) for w in url_rules.UNWANTED_HOST_WORDS)
    return host, path, None, "block" if unwanted else "allow"


def test_url_rules_match_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS + URLS[:6])] + [(None, URLS[4], "x", "y")], "page_id long, url string, token string, host string")
    got = url_rules.judged(pages, url_rules.LISTED_RULES + url_rules.PATTERN_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(i, *verdict_of(u)) for i, u in enumerate(URLS + URLS[:6])] + [(None, *verdict_of(URLS[4]))]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert url_rules.judged(pages.limit(0), url_rules.LISTED_RULES).count() == 0
    with pytest.raises(ValueError):
        url_rules.rule_table(pages, (url_rules.UrlRule("*casino*", "block"),))


# --- toxicity ------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_texts(spark):
    rng = random.Random(3)
    calm, rude = "river stone lamp green home walk cloud tree".split(), "idiot moron scum".split()
    texts = [(i, " ".join(rng.choices(calm, k=30) + (rng.choices(rude, k=2) if i % 3 == 0 else []))) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts] + [(None, None, "x"), (900, "", "x"), (3, texts[3][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)] + [(None, 1), (7, None), (8, 5)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = defaultdict(list)
    for r in toxicity.scored(docs, model).collect():
        assert 0 <= r["score"] <= 1
        got[r["doc_id"]].append(r["score"])
    assert sum(map(len, got.values())) == 303 and len(got[3]) == 2 and len(set(got[3])) == 1
    assert all((got[i][0] >= 0.7) == (i % 3 == 0) for i in range(200, 300))
    assert toxicity.fit(docs, labels.filter("toxic = 1")).score(b"any") == 1.0
    assert toxicity.fit(docs, labels.limit(0)).score(b"any") == 0.0
    assert toxicity.scored(docs.limit(0), model).count() == 0


def test_toxicity_finds_one_rude_word_in_long_held_out_texts(spark):
    rng = random.Random(8)
    syllables = "th er an in re on at nd st es en of ed it ou ea hi is or ti as te et ng ha ble tion ing ly sh wh".split()
    rude = "idiot moron scum clown pathetic worthless stupid loser".split()

    def text(i):
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(60, 400))]
        for _ in range(rng.randint(1, 3) if i % 8 == 0 else 0):
            words.insert(rng.randrange(len(words)), rng.choice(rude))
        return " ".join(words)

    docs = spark.createDataFrame([(i, text(i)) for i in range(1600)], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(1000)], "doc_id long, toxic int")
    scores = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.fit(docs, labels)).filter("doc_id >= 1000").collect()}
    assert sum(scores[i] >= 0.7 for i in range(1000, 1600, 8)) >= 68  # of 75
    assert sum(s >= 0.7 for i, s in scores.items() if i % 8) <= 10  # of 525


def test_toxicity_learns_from_every_row(spark, monkeypatch):
    seen = []
    real = toxicity.regression
    monkeypatch.setattr(toxicity, "regression", lambda rows, ratio, weight: seen.append(int(weight.sum())) or real(rows, ratio, weight))
    docs = spark.range(3400).selectExpr("id AS doc_id", "concat(IF(id % 2 = 0, 'rude ', 'calm '), id) AS text")
    toxicity.fit(docs, docs.selectExpr("doc_id", "CAST(doc_id % 2 = 0 AS int) AS toxic"))
    assert max(seen) == 3400


def test_features_of_pieces_are_those_of_the_whole(monkeypatch):
    text = ("Ünder the Bridge " * 40 + "end").encode()
    whole = toxicity.features(text)
    monkeypatch.setattr(toxicity, "CHUNK", 37)
    assert np.array_equal(toxicity.features(text), whole)


# --- language model ------------------------------------------------------------------------------------------------


def tokens_of(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def discounts_of(values):
    n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    return kneser_ney.discounts(n)


def test_language_model_matches_brute_force(awkward):
    train = awkward.filter("doc_id IS NULL OR doc_id % 4 <> 0")
    pairs, counts = Counter(), Counter()
    for r in train.collect():
        words = tokens_of(r["text"])
        counts.update(words)
        pairs.update(zip(["<start>", *words], words))
    n, v = sum(counts.values()), len(counts)
    before = Counter(w for _, w in pairs)
    followers = defaultdict(list)
    for (a, _), c in pairs.items():
        followers[a].append(c)
    high, low = discounts_of(pairs.values()), discounts_of(before.values())
    less = lambda d, c: d[min(c, 3)]
    kinds = sum(before.values())
    spare = sum(less(low, c) for c in before.values()) / kinds

    def unigram(w):
        seen = (before[w] - less(low, before[w])) / kinds if w in before else 0.0
        return seen + spare / (v + 1)

    def bigram(a, w):
        if a not in followers:
            return unigram(w)
        total = sum(followers[a])
        c = pairs[a, w]
        return ((c - less(high, c)) / total if c else 0.0) + sum(less(high, x) for x in followers[a]) / total * unigram(w)

    model = kneser_ney.build(train, shards=3)
    assert model.tokens == n
    got = kneser_ney.scored(awkward, model).collect()
    want = defaultdict(list)
    for r in awkward.collect():
        words = tokens_of(r["text"])
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        score = sum(math.log10(bigram(a, w)) for a, w in zip(["<start>", *words], words))
        want[r["doc_id"]].append((len(words), sum(counts[w] > 0 for w in words), base, score))
    assert len(got) == awkward.count()
    for r in got:
        assert any(r["n_tokens"] == t and r["n_known"] == k and r["base_score"] == pytest.approx(b, rel=1e-9) and r["score"] == pytest.approx(s, rel=1e-6) for t, k, b, s in want[r["doc_id"]]), r["doc_id"]


def test_language_model_without_training_rows(awkward, nothing):
    model = kneser_ney.build(nothing)
    assert {round(r["score"], 9) for r in kneser_ney.scored(awkward, model).collect()} == {0.0}
    assert kneser_ney.scored(nothing, model).count() == 0


# --- mixing --------------------------------------------------------------------------------------------------------


def test_mixture_streams_and_weights(awkward, rows):
    units = mixing.units(awkward).cache()
    sizes = Counter()
    for i, t, s in rows:
        sizes[i, s] += len(WORDS.findall(t or "")) + 1
    assert {(r["doc_id"], r["source"]): r["tokens"] for r in units.collect()} == sizes
    plan = mixing.plan(units, block_tokens=2000).cache()
    by_source = {r["source"]: r for r in plan.collect()}
    assert sum(r["weight"] for r in by_source.values()) == pytest.approx(1)
    entropy = -sum(r["weight"] * math.log(r["weight"]) for r in by_source.values())
    repeats = [r["quota"] / r["tokens"] for r in by_source.values()]
    assert max(repeats) <= mixing.MOST_REPEATS + 0.01 and min(repeats) >= 1 - 1e-9
    assert entropy == pytest.approx(mixing.TARGET_ENTROPY * math.log(len(by_source)), abs=0.01) or max(repeats) > mixing.MOST_REPEATS - 0.1
    streams = defaultdict(list)
    for r in mixing.mixture(units, plan).collect():
        streams[r["source"]].append(r)
    for source, stream in streams.items():
        stream.sort(key=lambda r: r["start"])
        want = by_source[source]
        at = 0
        for r in stream:  # the stream has no gap and no overlap
            assert r["start"] == at < want["quota"]
            assert r["block"] == min(r["start"] * want["blocks"] // want["quota"], want["blocks"] - 1)
            at += r["tokens"]
        assert at >= want["quota"]
        assert {r["doc_id"] for r in stream if r["copy"] == 0} == {i for i, s in sizes if s == source}
        assert max(Counter((r["doc_id"], r["copy"]) for r in stream).values()) == 1


def test_small_budget_and_empty_mixture(awkward, nothing):
    units = mixing.units(awkward).cache()
    total = units.agg(F.sum("tokens")).first()[0]
    plan = mixing.plan(units, budget=total // 3)
    assert plan.agg(F.sum("quota")).first()[0] == pytest.approx(total // 3, abs=3)
    empty = mixing.units(nothing)
    assert mixing.mixture(empty, mixing.plan(empty)).count() == 0
    assert mixing.mixed(nothing).count() == 0
    mixed = mixing.mixed(awkward)
    assert mixed.columns == awkward.columns and mixed.count() >= awkward.count()
    assert mixed.exceptAll(awkward).join(awkward.select("text").distinct(), "text", "left_anti").filter("text IS NOT NULL").count() == 0


# --- personal data -------------------------------------------------------------------------------------------------

# The patterns of the personal-data query.
PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(s))) % 10 == 0

    tests = (
        lambda s: True,
        lambda s: all(int(p) <= 255 for p in s.split(".")),
        lambda s: 12 <= len(digits(s)) <= 19 and luhn(digits(s)),
        lambda s: 9 <= len(digits(s)) <= 15,
    )
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if tests[k](m[0]))


def test_fixed_patterns_match_plain_search():
    rng = random.Random(9)
    assert plain_base("a@b.c, 10.0.0.1, 4111 1111 1111 1111, +1 (617) 555-0100") == [(0, 0, 5), (7, 1, 15), (17, 2, 36), (38, 3, 55)]
    for alphabet in ("a@.b- ", "0125. -", "+19 ().-", "a1@. +-(%é\n4"):
        for _ in range(4000):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
            assert pii.base_spans(text) == plain_base(text), text


def small_network():
    net = pii.Network.fresh(np.random.default_rng(1), 4)
    chars = np.random.default_rng(2).integers(0, 20, (9, 3)).astype(np.uint8)
    tags = np.random.default_rng(3).integers(0, 5, (9, 3)).astype(np.int8)
    return net, chars, tags


def test_gradient_of_the_network():
    net, chars, tags = small_network()
    loss, gradient = pii.loss_and_gradient(net, chars, tags)
    for name, g in gradient.items():
        values = net.p[name]
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, step = values[at], 1e-2
        ends = []
        for sign in (1, -1):
            values[at] = kept + sign * step
            ends.append(pii.loss_and_gradient(net, chars, tags)[0])
        values[at] = kept
        assert (ends[0] - ends[1]) / (2 * step) == pytest.approx(g[at], rel=0.1, abs=1e-3), name


def test_personal_data_query(awkward, rows, nothing):
    net = pii.train([t for _, t, _ in rows if t and len(t) < 5000], windows=96, epochs=1)
    got = pii.found(awkward, net).collect()
    want = Counter((i, pii.spans_text(plain_base(t or ""))) for i, t, _ in rows)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got) == Counter({(i, sha256(s.encode()).hexdigest()): n for (i, s), n in want.items()})
    texts = defaultdict(list)
    for i, t, _ in rows:
        texts[i].append(t or "")
    assert len(got) == len(rows)
    for r in got:  # base spans stay
        spans = set(filter(None, r["spans"].split(",")))
        assert any(set(filter(None, pii.spans_text(plain_base(t)).split(","))) <= spans for t in texts[r["doc_id"]])
    assert pii.found(nothing, net).count() == 0


@pytest.mark.parametrize("scale", [1, 40])  # 40: gates that are shut or open all the way
def test_network_equals_a_plain_one_without_its_slow_function(scale, monkeypatch):
    rng = np.random.default_rng(scale)
    net = pii.Network.fresh(rng)
    net.p |= {k: (net.p[k] * scale).astype(np.float32) for k in ("xf", "xb", "bf", "bb")}
    net.p["t"] = rng.normal(0, 1, net.p["t"].shape).astype(np.float32)
    chars = rng.integers(0, pii.CLASSES, (40, 30)).astype(np.uint8)
    p, n = {k: v.astype(float) for k, v in net.p.items()}, pii.HIDDEN
    want = np.repeat(p["eb"][None], 40, axis=0) + np.zeros((1, 1, 30))
    for d, order, e in (("f", range(40), p["e"][:, :n]), ("b", range(39, -1, -1), p["e"][:, n:])):
        h = c = np.zeros((n, 30))
        for t in order:
            x = p["x" + d][:, chars[t]] + p["u" + d] @ h + p["b" + d]
            i, f, o = (0.5 + 0.5 * np.tanh(x[k * n : (k + 1) * n] / 2) for k in range(3))
            c = f * c + i * np.tanh(x[3 * n :])
            h = o * np.tanh(c)
            want[t] += e @ h
    evaluated = []
    tanh = np.tanh
    monkeypatch.setattr(np, "tanh", lambda x, *a, **k: evaluated.append(np.size(x)) or tanh(x, *a, **k))
    got = net.emissions(chars)
    assert not evaluated
    assert np.abs(got - want).max() < 1e-4
    best, ways = got[0], []
    for t in range(1, 40):
        sums = best[:, None] + net.p["t"][:, :, None]
        ways.append(sums.argmax(axis=0))
        best = got[t] + sums.max(axis=0)
    path = [best.argmax(axis=0)]
    for way in reversed(ways):
        path.append(way[path[-1], np.arange(30)])
    assert (net.decode(chars) == np.stack(path[::-1])).all()


def test_windows_are_joined_over_the_whole_text():
    class Marks:
        """Tags every digit as part of a phone number."""

        def decode(self, chars):
            return np.isin(chars, np.unique(pii.classes("0123456789"))).astype(np.int8) * 4

    text = "a" * 200 + "5" * 400 + "b" * 300
    assert pii.read_spans(pii.tag_texts(Marks(), [text, ""])[0]) == [(200, 3, 600)]


# --- pipeline ------------------------------------------------------------------------------------------------------


def test_pipeline_stages_hand_on_whole_rows(spark, awkward, labels, tmp_path):
    import corpus_pipeline

    docs = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        assert after.join(docs, docs.columns[:2], "left_anti").count() == 0, name
        docs = after.cache()
    ids = {r["doc_id"] for r in docs.collect()}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == ids and all(r["n_tokens"] == len(r["ids"]) > 0 for r in out)
