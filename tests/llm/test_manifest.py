import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, difference
from tidemart.llm import merkle, prefix_free, spelling
from tidemart.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_merkle", "op12_repeated_passages", "op13_spelling"])
def test_queries_match_sql(spark, name):
    assert not difference(QUERIES[name](spark, SMALL), connect(SMALL), ORACLES[name])


# ---- Merkle manifest


def H(text):
    return sha256(text.encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(nodes, at, own):
    """(proof, digest) of the node at a place, with its own digest replaced."""
    proof = ""
    while len(nodes) > 1:
        begin = at - at % 16
        run = nodes[begin : begin + 16]
        proof += "".join(run[: at - begin] + run[at - begin + 1 :])
        own = H("".join(run[: at - begin] + [own] + run[at - begin + 1 :]))
        nodes = [H("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at //= 16
    return proof, own, nodes[0]


def manifest(rows, tamper):
    """rows: doc_id, source, lang, n_chars, text."""
    order = lambda x: (x is not None, x)
    trees = defaultdict(list)
    for r in rows:
        trees[r[1]].append((order(r[0]), H("".join(map(field, r))), H("".join(map(field, (*r[:4], tamper(r))))), r[0]))
    sources = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(trees[s]) for s in sources}
    subroots = [climb([x[1] for x in leaves[s]], 0, leaves[s][0][1])[2] for s in sources]
    root = climb(subroots, 0, subroots[0])[2] if subroots else None
    out = Counter()
    for k, s in enumerate(sources):
        nodes = [x[1] for x in leaves[s]]
        for i, (_, leaf, changed, doc_id) in enumerate(leaves[s]):
            proof, top, _ = climb(nodes, i, changed)
            onward, top, _ = climb(subroots, k, top)
            out[doc_id, leaf, subroots[k], root, H(proof + onward), top, top == root] += 1
    return out


def as_manifest(df):
    names = ("leaf", "subroot", "root")
    return Counter((r["doc_id"], *(r[c].hex() for c in names), H(r["proof"].hex()), r["folded_root"].hex(), r["verified"]) for r in df.collect())


def tamper(r):
    return r[4].lower() if r[4] is not None and r[0] is not None and r[0] % 3 == 0 else r[4]


def test_manifest_matches_brute_force_on_awkward_rows(awkward):
    rows = [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in awkward.collect()]
    rows = [r for r in rows if r[4] is None or r[4].isascii()]  # F.lower is wider than the tampering of the query
    tampered = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    some = awkward.filter(F.col("text").isNull() | ~F.col("text").rlike(r"[^\x00-\x7F]"))
    assert as_manifest(merkle.proofs(some, tampered)) == manifest(rows, tamper)


@pytest.mark.parametrize("sizes", [[1], [16, 17], [300, 1, 16, 257], [2] * 40])
def test_manifest_of_trees_of_many_shapes(spark, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "CLIMBERS", 3)  # many copies of upper nodes
    rng = random.Random(3)
    rows = [(i, None if k == 0 else f"s{k}", rng.choice(["en", None]), i, rng.choice(["Text", "text", None, "Ä"]) ) for k, n in enumerate(sizes) for i in rng.sample(range(10_000), n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    ascii_lower = F.when(F.col("doc_id") % 3 == 0, F.translate("text", "T", "t")).otherwise(F.col("text"))
    want = manifest(rows, lambda r: r[4].replace("T", "t") if r[4] and r[0] % 3 == 0 else r[4])
    assert as_manifest(merkle.proofs(docs, ascii_lower)) == want


def test_manifest_of_nothing_and_untouched_rows(spark, nothing, awkward):
    assert merkle.proofs(nothing).collect() == []
    assert all(r["verified"] for r in merkle.proofs(awkward).collect())
    assert int(spark.conf.get("spark.sql.cteRecursionRowLimit")) > 0  # the setting is back


# ---- repeated passages


def removed(texts, width):
    """texts: (order, bytes) of distinct documents; returns order -> spans."""
    first, spans = {}, {}
    for key, t in sorted(texts):
        covered = set()
        for p in range(len(t) - width + 1):
            if first.setdefault(t[p : p + width], (key, p)) != (key, p):
                covered.update(range(p, p + width))
        runs = [[x for _, x in g] for _, g in groupby(enumerate(sorted(covered)), lambda e: e[1] - e[0])]
        spans[key] = [[r[0], r[-1] + 1] for r in runs]
    return spans


def check_repeats(docs, rows, width):
    import xxhash

    key = lambda i, t: (i is not None, i or 0, xxhash.xxh3_64_intdigest(t))
    texts = [(i, (t or "").encode()) for i, t in rows]
    spans = removed({(key(i, t), t) for i, t in texts}, width)
    want = Counter()
    for i, t in texts:
        own = spans[key(i, t)]
        rest = b"".join(t[a:b] for a, b in zip([0] + [s[1] for s in own], [s[0] for s in own] + [len(t)]))
        want[i, len(t), len(t) - len(rest), len(own), str(own), sha256(rest).hexdigest()] += 1
    got = prefix_free.without_repeats(docs, width).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], str(r["spans"]), r["kept_sha256"]) for r in got) == want


def test_repeats_of_awkward_rows(awkward, rows):
    small = awkward.filter("coalesce(length(text), 0) < 30000")
    check_repeats(small, [(i, t) for i, t, _ in rows if len(t or "") < 30_000], 100)


@pytest.mark.parametrize("width, held", [(100, 1 << 20), (40, 50), (124, 500)])
def test_repeats_match_brute_force(spark, monkeypatch, width, held):
    """Shared passages of all lengths around the width, hot lines, copies, runs of one letter and overlapping repeats."""
    monkeypatch.setattr(prefix_free, "HELD_ROWS", held)
    rng = random.Random(width)
    letters = "abcdefgh ÄΩ"
    noise = lambda n: "".join(rng.choices(letters, k=n))
    passages = [noise(n) for n in (width // 2, width - 2, width - 1, width, width + 1, 2 * width, 5 * width)]
    line = noise(width - 15)
    texts = [None, "", "x" * (3 * width), "ab" * width, noise(width - 1)]
    for k in range(60):
        parts = [noise(rng.randrange(0, width)) + rng.choice([*passages, line, line, "z" * rng.randrange(width, 2 * width)]) for _ in range(rng.randrange(1, 5))]
        texts.append("".join(parts) + noise(rng.randrange(20)))
    texts += [texts[7], texts[8] + "tail", texts[9][: len(texts[9]) // 2]]
    rows = [(i if i % 11 else None, t) for i, t in enumerate(texts)] + [(8, "same id " + texts[12]), (12, texts[12])]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check_repeats(docs, rows, width)


def test_repeats_in_a_text_of_several_stretches(spark, monkeypatch):
    monkeypatch.setattr(prefix_free, "STRETCH", 2000)
    prefix_free._powers.cache_clear()
    rng = random.Random(2)
    long = "".join(rng.choices("abcdef", k=9000))
    rows = [(1, long), (2, "head " + long[1500:7000] + "tail"), (3, long[:50] + long[3900:4010])]
    batches = [__import__("pyarrow").record_batch([[i for i, _ in rows], [t for _, t in rows]], names=["doc", "text"])]
    parts = list(prefix_free._stretches(iter(batches), 100))
    assert all(sum(len(p[3]) for p in part) <= 2000 for part in parts)
    starts = Counter((p[0], p[2] + k) for part in parts for p in part for k in range(len(p[3]) - 99))
    assert set(starts.values()) == {1} and len(starts) == sum(len(t) - 99 for _, t in rows)
    prefix_free._powers.cache_clear()


def test_every_window_has_one_row_and_equal_windows_equal_triggers():
    import numpy as np

    rng = random.Random(5)
    text = "".join(rng.choices("ab ", k=3000)) + "c" * 500
    text = (text + text[1000:2500]).encode()
    first, windows, q, seed, right, left = prefix_free._phrases(np.frombuffer(text, np.uint8), [(0, len(text))], 100)
    at = np.repeat(q - first, windows) - np.concatenate([np.arange(n) for n in windows])
    assert windows.sum() == len(text) - 99 and (np.diff(first) == windows[:-1]).all()
    assert at.min() >= 0 and at.max() <= 100 - prefix_free.TRIGGER
    known = {}
    assert all(known.setdefault(text[p : p + 100], at[p]) == at[p] for p in range(len(at)))


def test_repeats_of_nothing_and_wrong_widths(nothing):
    assert prefix_free.without_repeats(nothing).collect() == []
    with pytest.raises(ValueError):
        prefix_free.without_repeats(nothing, 20)


# ---- spelling variants


def near_words(words):
    """All pairs at one edit, by comparing everything."""

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return len(b) - len(a) <= 1 and a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :])

    return {(a, b) for a in words for b in words if abs(len(a) - len(b)) <= 1 and one_edit(a, b)}


def spelled(counts, ratio=10):
    near = defaultdict(list)
    for a, b in near_words(counts):
        near[a].append(b)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    root = {}
    for w in counts:
        last = w
        while form[last] is not None:
            last = form[last]
        root[w] = last
    return {(w, form[w], root[w], n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


@pytest.mark.parametrize("alphabet, block", [(None, 64), (2, 1), (26, 5)])
def test_variants_match_brute_force(spark, monkeypatch, alphabet, block):
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(9)
    counts = {}
    for _ in range(25):
        word = "".join(rng.choices("abeéß÷", k=rng.randrange(5, 9)))
        n = 100_000
        for _ in range(12):  # a chain of edits with falling counts
            counts.setdefault(word, n)
            n = max(1, n // rng.choice([1, 5, 10, 30]))
            k = rng.randrange(len(word))
            word = word[:k] + rng.choice(["" if len(word) > 3 else "a", word[k] + "e", "é"]) + word[k + 1 :]
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(4)
    got = spelling.variants(words, alphabet=alphabet).collect()
    assert {tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in got} == spelled(counts)
    assert len(got) == len(counts)


def test_words_are_counted_and_damaged_as_defined(awkward, rows, monkeypatch):
    import re

    monkeypatch.setattr(spelling, "COUNTED", 5)
    want = Counter()
    for i, t, _ in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (t or "").encode().lower().decode()):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(word) >= 4:
                want[word] += 1
    got = {r["word"]: r["n"] for r in spelling.word_counts(awkward, least_length=4).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}


def test_spelling_of_nothing(nothing):
    assert spelling.variants(spelling.word_counts(nothing)).collect() == []
