"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from memory-mapped sorted hash arrays.

Building is one Spark job with two shuffles:

1. tasks hash words (XXH64) and fold the bigrams of some million tokens into (context, word, count), dealt into shards by
   context. The few contexts that hold much of the text (found in a sample; the sample steers the dealing only) are
   dealt by the pair instead, so no context gathers in one task;
2. each shard adds up its counts and writes one file: sorted 64-bit hashes of the bigrams with their counts. It passes
   on, per word, its count and number of distinct predecessors, and, per context, its total and how many followers it
   has seen once, twice, ...;
3. these meet by word in a second set of shards, each again one file of sorted hashes with columns. Only the sums of
   the columns, a handful of numbers per shard, reach the driver; discounts follow from them.

Scoring maps the files into memory (read where they lie on a shared disk; from another store each machine copies them
once) and looks up the distinct words and bigrams of a few hundred documents at a time. The model grows with the
corpus; nothing is pruned.

Tokens: words of the text with A-Z lower-cased, then one end token. The start is a context only. An unseen context
leaves the unigram probability, that of continuation counts interpolated with 1 / (distinct tokens + 1), which is also
what an unseen word gets. Discounts are held between 0.1 and their count, also where counts of counts are missing.

A null text counts as empty and is its end token; repeated rows stay and count each; without training rows every
token has probability 1 / (0 + 1), that is score 0. Ids play no part in the model.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import new_folder, texts_of

#: Tokens hashed and looked up at once, and tokens folded before they are passed on.
SLICE, FOLD = 400_000, 3_000_000
REMEMBERED = 400_000
#: Share of the sampled tokens from which a context is dealt by pair; at most 1 / HOT_SHARE contexts reach it.
HOT_SHARE, SAMPLED = 0.001, 0.02
#: Names of the start and end that no word can have, because they hold a blank.
START, END = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b" start", b" end"))
WORD_COLUMNS = ("count", "before", "total", "one", "two", "three", "four", "more")


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = WordHashes()


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = context * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def token_slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, hashes, lengths): for a run of rows the hashes of start, words and end of each, one after the other, and
    the number of tokens (words and end) of each."""
    for batch in batches:
        words, lengths, first, size = [], [], 0, 0
        for at, text in enumerate(texts_of(batch.column(column))):
            found = text.lower().split()
            words.append(found)
            lengths.append(len(found) + 1)
            size += len(found) + 1
            if size >= SLICE:
                yield batch.slice(first, at + 1 - first), _sequence(words), np.array(lengths)
                words, lengths, first, size = [], [], at + 1, 0
        if words:
            yield batch.slice(first), _sequence(words), np.array(lengths)


def _sequence(texts: list[list[bytes]]) -> np.ndarray:
    if len(_hashes) >= REMEMBERED:
        _hashes.clear()
    sizes = np.array([len(t) + 2 for t in texts])
    out = np.empty(sizes.sum(), np.uint64)
    starts = np.cumsum(sizes) - sizes
    inner = np.ones(len(out), bool)
    inner[starts] = inner[starts + sizes - 1] = False
    out[starts], out[starts + sizes - 1] = START, END
    out[inner] = np.fromiter((_hashes[w] for t in texts for w in t), np.uint64, int(inner.sum()))
    return out


def _targets(lengths: np.ndarray) -> np.ndarray:
    """Positions in the sequence of what is predicted: all but the starts."""
    mask = np.ones(int(lengths.sum()) + len(lengths), bool)
    mask[np.cumsum(lengths + 1) - lengths - 1] = False
    return np.flatnonzero(mask)


def folded(context: np.ndarray, word: np.ndarray, count: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(hash, context, word, count) of the distinct pairs, by hash."""
    key = pair_hash(context, word)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    if count is None:
        sums = np.diff(np.append(first, len(key)))
    else:
        sums = np.add.reduceat(count[order], first) if len(key) else count
    return key[first], context[order[first]], word[order[first]], sums.astype(np.uint64)


# --- counting ------------------------------------------------------------------------------------------------------


def _frequent_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, sequence, _ in token_slices(batches, 0):
        h, n = np.unique(sequence, return_counts=True)
        some = np.argsort(-n)[: int(1 / HOT_SHARE)]
        yield pa.record_batch([pa.array(h[some].view(np.int64)), pa.array(n[some]), pa.array(np.full(len(some), len(sequence)))], names=["h", "n", "of"])


def hot_contexts(texts: DataFrame) -> np.ndarray:
    """Hashes of contexts with at least HOT_SHARE of the tokens of a sample of the texts."""
    found = texts.sample(fraction=SAMPLED, seed=7).mapInArrow(_frequent_words, "h long, n long, of long")
    sums = found.groupBy("h").agg(F.sum("n").alias("n"))
    total = found.select(F.sum(F.col("n")).alias("n")).first()["n"] or 0
    rows = sums.filter(F.col("n") >= HOT_SHARE * total).orderBy(F.desc("n"), "h").limit(int(1 / HOT_SHARE)).collect()
    return np.sort(np.array([r["h"] for r in rows], np.int64).view(np.uint64))


def _held(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)] == values


def _shard(context: np.ndarray, key: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    deal = np.where(_held(hot, context), key, context)
    return ((deal >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def _blobs(shard: np.ndarray, columns: list[np.ndarray], shards: int) -> pa.RecordBatch:
    """One row per shard that has anything: its number and each column's slice as bytes."""
    order = np.argsort(shard, kind="stable")
    ends = np.cumsum(np.bincount(shard, minlength=shards))
    starts = ends - np.bincount(shard, minlength=shards)
    used = np.flatnonzero(ends > starts)
    sorted_columns = [c[order] for c in columns]
    cut = [pa.array([c[a:b].tobytes() for a, b in zip(starts[used], ends[used])], pa.binary()) for c in sorted_columns]
    return pa.record_batch([pa.array(used.astype(np.int32)), *cut], names=["shard", *(f"c{i}" for i in range(len(cut)))])


def _by_context(shard: np.ndarray, context: np.ndarray, word: np.ndarray, count: np.ndarray, shards: int) -> pa.RecordBatch:
    """Blobs of the pairs of each shard: distinct contexts, how many pairs each has, words, counts."""
    order = np.lexsort((context, shard))
    shard, context, word, count = shard[order], context[order], word[order], count[order]
    fresh = np.concatenate([[True], (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])])
    at = np.flatnonzero(fresh)
    sizes = np.diff(np.append(at, len(context))).astype(np.uint32)
    groups = _blobs(shard[at], [context[at], sizes], shards)
    pairs = _blobs(shard, [word, count.astype(np.uint32)], shards)
    return pa.record_batch([groups.column(0), groups.column(1), groups.column(2), pairs.column(1), pairs.column(2)], names=["shard", "context", "size", "word", "n"])


def _count(batches: Iterator[pa.RecordBatch], hot: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    waiting, size = [], 0

    def fold() -> pa.RecordBatch:
        key, context, word, n = folded(*(np.concatenate(c) for c in zip(*waiting)))
        return _by_context(_shard(context, key, hot, shards), context, word, n, shards)

    for _, sequence, lengths in token_slices(batches, 0):
        at = _targets(lengths)
        waiting.append((sequence[at - 1], sequence[at]))
        size += len(at)
        if size >= FOLD:
            yield fold()
            waiting, size = [], 0
    if waiting:
        yield fold()


def _per_shard(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(shard, columns) of a partition sorted by shard."""
    current, parts = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != current and parts:
                yield current, [np.concatenate(c) for c in zip(*parts)]
                parts = []
            current = row[0]
            parts.append([np.frombuffer(x, k) for x, k in zip(row[1:], kinds)])
    if parts:
        yield current, [np.concatenate(c) for c in zip(*parts)]


def _write_arrays(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Number and sizes in bytes of the arrays, then the arrays, each at a multiple of 8; renamed when whole."""
    system, root = pafs.FileSystem.from_uri(folder)
    draft = f"{root}/.draft-{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8").tobytes())
        for a in arrays:
            out.write(a.tobytes() + bytes(-a.nbytes % 8))
    system.move(draft, f"{root}/{name}")


def _mapped(path: str, kinds: list) -> list[np.ndarray]:
    raw = np.memmap(path, np.uint8, "r")
    n = int(raw[:8].view("<i8")[0])
    sizes = raw[8 : 8 + 8 * n].view("<i8").tolist()
    out, at = [], 8 + 8 * n
    for size, kind in zip(sizes, kinds):
        out.append(raw[at : at + size].view(kind))
        at += size + -size % 8
    return out


def _sums_by(key: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], [np.add.reduceat(c[order], first) for c in columns]


def _bigram_shard(batches: Iterator[pa.RecordBatch], folder: str, shards: int) -> Iterator[pa.RecordBatch]:
    """Writes the file of a shard of bigrams; passes on the sums by word and by context."""
    for shard, (context, size, word, n) in _per_shard(batches, [np.uint64, np.uint32, np.uint64, np.uint32]):
        key, context, word, n = folded(np.repeat(context, size), word, n.astype(np.uint64))
        large = np.flatnonzero(n >= 255)
        _write_arrays(folder, f"pairs-{shard:06d}", [key, np.minimum(n, 255).astype(np.uint8), large.astype(np.uint64), n[large]])
        classes = [(n == k).astype(np.uint64) for k in (1, 2, 3, 4)] + [(n > 4).astype(np.uint64)]
        words, as_word = _sums_by(word, [n, np.ones_like(n)])
        contexts, as_context = _sums_by(context, [n, *classes])
        none_w, none_c = [np.zeros(len(words), np.uint64)] * 6, [np.zeros(len(contexts), np.uint64)] * 2
        columns = [np.concatenate(c) for c in zip([*as_word, *none_w], [*none_c, *as_context])]
        both, columns = _sums_by(np.concatenate([words, contexts]), columns)
        yield _blobs(((both >> np.uint64(20)) % np.uint64(shards)).astype(np.int64), [both, *columns], shards)


def _word_shard(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Writes the file of a shard of words; returns the sums of its columns and its counts of continuation counts."""
    for shard, (key, *columns) in _per_shard(batches, [np.uint64] * (1 + len(WORD_COLUMNS))):
        key, columns = _sums_by(key, columns)
        _write_arrays(folder, f"words-{shard:06d}", [key, *columns])
        before, count = columns[1], columns[0]
        sums = [int(c.sum()) for c in columns] + [int((count > 0).sum())] + [int((before == k).sum()) for k in (1, 2, 3, 4)] + [int((before > 4).sum())]
        yield pa.record_batch([pa.array([shard], pa.int32()), pa.array([sums], pa.list_(pa.int64()))], names=["shard", "sums"])


def discounts(counts: list[int]) -> np.ndarray:
    """Of counts 0, 1, 2 and 3 or more, from how many counts are 1, 2, 3, 4."""
    n1, n2, n3, n4 = counts
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [k - (k + 1) * y * b / a if a else 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(x, 0.1), k) for k, x in enumerate(d, 1))])


@dataclass
class Model:
    folder: str
    shards: int
    hot: np.ndarray
    tokens: int
    distinct: int
    pairs: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    spread: float  # share of the continuation probability that goes to all words evenly


def build(texts: DataFrame, folder: str | None = None, shards: int | None = None) -> Model:
    """Counts the ``text`` column and writes the model below ``folder`` (in the shared folder by default)."""
    spark = texts.sparkSession
    texts = texts.select(F.col("text").cast("string").alias("text"))
    folder = folder or new_folder(spark, "language-model")
    system, root = pafs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_contexts(texts)
    counted = texts.mapInArrow(partial(_count, hot=hot, shards=shards), "shard int, context binary, size binary, word binary, n binary")
    dealt = counted.repartitionById(shards, "shard").sortWithinPartitions("shard")
    layout = "shard int, " + ", ".join(f"c{i} binary" for i in range(1 + len(WORD_COLUMNS)))
    sums = dealt.mapInArrow(partial(_bigram_shard, folder=folder, shards=shards), layout)
    words = sums.repartitionById(shards, "shard").sortWithinPartitions("shard")
    rows = words.mapInArrow(partial(_word_shard, folder=folder), "shard int, sums array<long>").collect()  # one per shard
    total = [sum(r["sums"][i] for r in rows) for i in range(len(WORD_COLUMNS) + 6)] if rows else [0] * (len(WORD_COLUMNS) + 6)
    count, before, _, one, two, three, four, _, distinct, *once = total
    word_discounts = discounts(once[:4])
    classes = np.array([once[0], once[1], sum(once[2:])])
    spread = float((word_discounts[1:] * classes).sum() / before) if before else 1.0
    return Model(folder, shards, hot, count, distinct, before, discounts([one, two, three, four]), word_discounts, spread)


# --- scoring -------------------------------------------------------------------------------------------------------


def _discounted(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.maximum(n - d[np.minimum(n, 3).astype(np.int64)], 0.0)


class Scorer:
    """Looks up the mapped files of a model."""

    def __init__(self, model: Model):
        self.model = model
        system, root = pafs.FileSystem.from_uri(model.folder)
        self.words, self.pairs = {}, {}
        copy = not isinstance(system, pafs.LocalFileSystem)
        if copy:  # one copy per worker process, in its own temporary folder
            local = tempfile.mkdtemp(prefix="language-model-")
        for info in system.get_file_info(pafs.FileSelector(root)):
            kind, _, number = info.base_name.partition("-")
            if kind not in ("words", "pairs"):
                continue
            path = info.path
            if copy:
                path = os.path.join(local, info.base_name)
                with system.open_input_stream(info.path) as source, open(path, "wb") as out:
                    shutil.copyfileobj(source, out)
            kinds = [np.uint64] * (1 + len(WORD_COLUMNS)) if kind == "words" else [np.uint64, np.uint8, np.uint64, np.uint64]
            (self.words if kind == "words" else self.pairs)[int(number)] = _mapped(path, kinds)

    def _look_up(self, files: dict, shard: np.ndarray, key: np.ndarray, take: Callable) -> None:
        """Calls take(rows of the request, positions in the file, file) for what is found; key ascends."""
        order = np.argsort(shard, kind="stable")
        numbers, starts = np.unique(shard[order], return_index=True)
        for number, a, b in zip(numbers.tolist(), starts, np.append(starts[1:], len(order))):
            if number in files:
                rows = order[a:b]
                held = files[number][0]
                at = np.minimum(np.searchsorted(held, key[rows]), len(held) - 1)
                hit = held[at] == key[rows]
                take(rows[hit], at[hit], files[number])

    def word_columns(self, key: np.ndarray) -> np.ndarray:
        out = np.zeros((len(WORD_COLUMNS), len(key)))

        def take(rows: np.ndarray, at: np.ndarray, file: list) -> None:
            for i, column in enumerate(file[1:]):
                out[i, rows] = column[at]

        self._look_up(self.words, ((key >> np.uint64(20)) % np.uint64(self.model.shards)).astype(np.int64), key, take)
        return out

    def pair_counts(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Counts of pairs, given in the order of their hashes."""
        key = pair_hash(context, word)
        out = np.zeros(len(key))

        def take(rows: np.ndarray, at: np.ndarray, file: list) -> None:
            _, small, large, large_counts = file
            n = small[at].astype(np.float64)
            over = np.flatnonzero(n == 255)
            n[over] = large_counts[np.searchsorted(large, at[over].astype(np.uint64))]
            out[rows] = n

        self._look_up(self.pairs, _shard(context, key, self.model.hot, self.model.shards), key, take)
        return out

    def score(self, sequence: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: known tokens, base score, score."""
        m = self.model
        seen, number = np.unique(sequence, return_inverse=True)
        columns = dict(zip(WORD_COLUMNS, self.word_columns(seen)))
        even = m.spread / (m.distinct + 1)
        unigram = _discounted(columns["before"], m.word_discounts) / max(m.pairs, 1) + even
        free = m.pair_discounts[1] * columns["one"] + m.pair_discounts[2] * columns["two"] + m.pair_discounts[3] * (columns["three"] + columns["four"] + columns["more"])
        total = columns["total"]
        left = np.where(total > 0, free / np.maximum(total, 1), 1.0)
        at = _targets(lengths)
        context, word = number[at - 1], number[at]
        key = pair_hash(seen[context], seen[word])
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        n = self.pair_counts(seen[context[first]], seen[word[first]])
        context_1, word_1 = context[first], word[first]
        p = _discounted(n, m.pair_discounts) / np.maximum(total[context_1], 1) + left[context_1] * unigram[word_1]
        log_p = np.log10(p)[which]
        count = columns["count"][word]
        base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.distinct + 1)))
        begins = np.cumsum(lengths) - lengths
        return np.add.reduceat((count > 0).astype(np.int64), begins), np.add.reduceat(base, begins), np.add.reduceat(log_p, begins)


_scorers: dict[str, Scorer] = {}


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    if model.folder not in _scorers:
        _scorers.clear()
        _scorers[model.folder] = Scorer(model)
    scorer = _scorers[model.folder]
    for rows, sequence, lengths in token_slices(batches, 1):
        known, base, score = scorer.score(sequence, lengths)
        yield pa.record_batch([rows.column(0), pa.array(lengths.astype(np.int64)), pa.array(known), pa.array(base), pa.array(score)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score (unigrams with 0.1 added) and score (log10 of the text's probability);
    perplexity is 10 ^ (-score / n_tokens)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_scored, model=model), "doc_id long, n_tokens long, n_known long, base_score double, score double")
