"""Byte-pair encoding by backtracking, and decoding by an offset table.

The encoder never runs merges. For every position Aho-Corasick gives the longest vocabulary token that starts there
(the automaton holds the reversed tokens and reads the word backwards), a table gives each token's longest proper
prefix that is a token too, and a pair table says whether two neighbouring tokens are what the merges would leave. A
sequence whose neighbours are all compatible is the one the merges make. The encoder takes the longest token that is
compatible with its predecessor and steps back where none is; a position found to be a dead end is never tried again, so
the work is linear in the length of the word.

Vocabulary files are JSON of a word-end BPE model (byte-level alphabet, lower case, white space dropped). Words repeat,
so a worker remembers the ids of words, and of runs of text between blanks, in two generations: when the younger one is
full it becomes the older one, and what is used again moves back. Memory is bounded, frequent words stay, and no result changes.

A null text counts as empty; an empty text has no ids and decodes to an empty text. Any length of text and word is fine.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import texts_of

#: Words, runs between blanks, and token pairs that a worker remembers in each of two generations: next to ids of whole
#: texts, and where a worker holds little else (up to about 250 MB if all are filled).
REMEMBERED, REMEMBERED_ALONE = (80_000, 30_000, 50_000), (250_000, 250_000, 150_000)
#: Signs that end a run without changing the word before them.
STOPS = b".,;:!?"
#: Rows whose ids are sent back at once.
ROWS_AT_ONCE = 512
#: A symbol at the end of a word is another symbol than the same byte inside it.
LAST = 0x10000
# The word pattern of the vocabulary file, as its pre-tokenizer states it.
WORD_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else from U+0100 on."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class JoinedTable:
    """Strings by number; ``render`` joins any sequence of them by one space. They lie in one buffer with offsets, each with its space
    behind it, so what Arrow takes lies joined in the buffer of the result."""

    def __init__(self, strings: list[bytes]):
        self.strings = pa.array([s + b" " for s in strings], pa.large_binary())

    def render(self, ids: np.ndarray) -> bytes:
        if not len(ids):
            return b""
        taken = self.strings.take(pa.array(ids))
        _, offsets, joined = taken.buffers()
        return joined[: int(np.frombuffer(offsets, np.int64)[len(ids)]) - 1].to_pybytes()


class Memory:
    """Values by key in two generations of at most ``size`` each."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def put_all(self, values: dict) -> None:
        """Adds many at once; a generation may exceed its size by them."""
        self.young.update(values)
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}

    def get(self, key):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value


class WordBpe:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str, remembered: tuple[int, int, int] = REMEMBERED):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges, end = spec["model"]["vocab"], spec["model"]["merges"], spec["model"]["end_of_word_suffix"]
        alphabet = byte_alphabet()
        self.strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")")
        size = max(self.strings) + 1
        self.rank = np.full(size, -1, np.int64).tolist()  # of the merge that makes the token; -1: a single symbol
        self.halves: list = [None] * size
        symbols: dict[int, str] = {}
        for b, c in enumerate(alphabet):
            symbols[vocab[c]] = chr(b)
            symbols[vocab[c + end]] = chr(LAST + b)
        self.pair: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            self.pair[left, right] = rank
            if self.halves[made] is None:
                self.rank[made], self.halves[made] = rank, (left, right)
                symbols[made] = symbols[left] + symbols[right]
        by_symbols = self.by_symbols = {s: t for t, s in symbols.items()}
        self.length = [len(symbols.get(t, "")) for t in range(size)]
        self.shorter: list = [None] * size
        for t, s in symbols.items():
            self.shorter[t] = next((by_symbols[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in by_symbols), None)
        self.automaton = ahocorasick.Automaton()
        for t, s in symbols.items():
            self.automaton.add_word(s[::-1], t)
        self.automaton.make_automaton()
        self.last = {b: chr(LAST + b) for b in range(256)}
        self.words, self.runs, self.compatible_pairs = map(Memory, remembered)
        self.token_table = JoinedTable([self.strings.get(t, "").encode() for t in range(size)])

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens leaves just these two tokens."""
        both = left << 32 | right
        known = self.compatible_pairs.get(both)
        if known is None:
            known = self._stay_apart(left, right)
            self.compatible_pairs.put(both, known)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undoes the merges of both tokens, last one first. The two parts then at the border must not have a merge
        that comes before those that absorbed them; of equal merges the one further left comes first."""
        left_absorbed = right_absorbed = len(self.pair)
        while True:
            rank = self.pair.get((left, right))
            if rank is not None and rank < left_absorbed and rank <= right_absorbed:
                return False
            if self.rank[left] > self.rank[right]:
                left_absorbed, left = self.rank[left], self.halves[left][1]
            elif self.rank[right] >= 0:
                right_absorbed, right = self.rank[right], self.halves[right][0]
            else:
                return True

    def _of_symbols(self, word: str) -> list[int]:
        whole = self.by_symbols.get(word)
        if whole is not None:
            return [whole]  # the longest token at the start is the whole word
        n, length, shorter = len(word), self.length, self.shorter
        # The automaton gives the matches that end at a place from the longest to the shortest; the first one remains.
        longest = dict(list(self.automaton.iter(word[::-1]))[::-1])
        fits, compatible = self.compatible_pairs.young.get, self.compatible
        tokens: list[int] = []
        dead: set[int] = set()
        at, t, last = 0, longest[n - 1], None
        while at < n:
            while t is not None:
                end = at + length[t]
                if end not in dead:
                    if last is None:
                        break
                    fit = fits(last << 32 | t)
                    if fit or (fit is None and compatible(last, t)):
                        break
                t = shorter[t]
            if t is None:
                dead.add(at)
                t = tokens.pop()
                at -= length[t]
                last = tokens[-1] if tokens else None
                t = shorter[t]
            else:
                tokens.append(t)
                at, last = end, t
                t = longest[n - 1 - at] if at < n else None
        return tokens

    def _of_word(self, word: bytes) -> bytes:
        """Ids of one word of the pattern, in lower case, as little-endian unsigned 32-bit integers."""
        known = self.words.get(word)
        if known is None:
            ids = self._of_symbols(word[:-1].decode("latin-1") + self.last[word[-1]])
            known = struct.pack(f"<{len(ids)}I", *ids)
            self.words.put(word, known)
        return known

    def _of_run(self, run: bytes) -> bytes:
        """Ids of a text without ASCII white space."""
        stem = run.rstrip(STOPS)
        if stem.isalpha():  # ASCII letters: one word, and the stops after it another one
            ids = self._of_word(stem.lower())
            return ids + self._of_word(run[len(stem) :]) if len(stem) < len(run) else ids
        out = []
        for part in self.special_pattern.split(run):
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
                continue
            # Lower case is taken character by character: a capital sigma at a word's end has no form of its own.
            text = unicodedata.normalize("NFC", part.decode("utf-8", "replace")).replace("Σ", "σ").lower()
            out += [self._of_word(word.encode()) for word in WORD_PATTERN.findall(text)]
        return b"".join(out)

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a UTF-8 text."""
        runs = text.split()
        out = list(map(self.runs.young.get, runs))
        at = -1
        for _ in range(out.count(None)):
            at = out.index(None, at + 1)
            out[at] = self.runs.get(runs[at])
            if out[at] is None:
                out[at] = self._of_run(runs[at])
                self.runs.put(runs[at], out[at])
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by one space (the vocabulary file names no decoder), in UTF-8."""
        return self.token_table.render(ids)


_loaded: dict[tuple, WordBpe] = {}


def loaded(path: str, remembered: tuple[int, int, int] = REMEMBERED) -> WordBpe:
    """One encoder per worker process, vocabulary and size of its memory."""
    if (path, remembered) not in _loaded:
        _loaded[path, remembered] = WordBpe(path, remembered)
    return _loaded[path, remembered]


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = loaded(path, REMEMBERED_ALONE)
    decimal = JoinedTable([str(i).encode() for i in range(len(bpe.length))])
    for batch in batches:
        n, ids_sha, text_sha = [], [], []
        for text in texts_of(batch.column(1)):
            ids = bpe.encode(text)
            n.append(len(ids))
            ids_sha.append(sha256(decimal.render(ids)).hexdigest())
            text_sha.append(sha256(bpe.decode(ids)).hexdigest())
        yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256, one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_encoded, path=path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _ids(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    bpe = loaded(path)
    for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
        ids = [bpe.encode(t) for t in texts_of(batch.column(1))]
        values = np.concatenate([np.empty(0, "<u4"), *ids]).astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
        yield pa.record_batch([batch.column(0), lists], names=["doc_id", "ids"])


def token_ids(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) for every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(partial(_ids, path=path), "doc_id long, ids array<int>")
