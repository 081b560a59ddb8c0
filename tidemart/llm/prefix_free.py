"""Passages that repeat anywhere in a corpus, by prefix-free parsing.

A byte is removed if some string of ``width`` bytes that covers it also starts earlier: in a document with a smaller id,
or earlier in the same one. Strings never cross documents and are judged on the input.

Parse: a rolling hash runs over the bytes, and a string of ``TRIGGER`` bytes is a trigger where its hash is the least
within some window of ``width`` bytes (ties: the first one). Triggers cut the text into phrases. A fixed divisor would
leave windows without any trigger; this rule gives every window one, at the same place in equal windows. The windows
that share a trigger start next to each other: they are one phrase together with what follows it. A phrase with its continuation is
one row, about one for 35 bytes, named by the hash of its trigger and the hash of all its bytes.

Parse order: the rows are range-sorted by name, so equal continuations stand together. Of equal ones only the first in the
corpus stays in play; the others are removed whole. That settles all text that repeats at length. Of the rest, a row goes on only if
another row with the same trigger also agrees on the bytes left or right of it that half of its windows must share.

Dictionary order: what goes on is cut by the distance of the window's start to its trigger (suffixes of the phrase) into
cells of ``CELLS`` starts, with the bytes themselves. Each round range-sorts the pieces by the bytes common to their cell and
then by all bytes, that is in corpus order; equal neighbours are copies, neighbours that share just the common bytes go to
the next, finer round, the last of which has single windows. Sorting is by content, so a string that stands in a third of all
documents with other surroundings is spread over many tasks, and before each sort a task keeps the first of its own equal rows.

Defined results: a null text is empty; a text shorter than ``width`` loses nothing; a null id counts as the smallest; documents
with the same id are ordered by the hash of their text, and rows that agree in id and text are one document, which all of
them show. An empty table gives no rows. Any length of text is read whole, in stretches that overlap. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import discard, saved, texts_of

WIDTH, TRIGGER = 100, 24
#: Window starts per cell in the rounds of the dictionary order.
CELLS = (16, 4, 1)
#: Bytes parsed at once, and rows of which a task keeps the first of equal ones.
STRETCH, HELD_ROWS = 1 << 20, 1 << 20
HELD_PIECES = 100_000
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
SMALLEST = -(1 << 63)
#: Bits of a row's place: byte offset, number of windows, bytes before the trigger, two marks of 9 bits.
OFFSET, WINDOWS, BEFORE, MARK = 32, 25, 18, 9
#: Bytes before the trigger of a row that is removed already.
GONE = 127
ROWS = "seed long, name long, doc long, mark long, place long"
PIECES = "cell int, common binary, body binary, doc long, mark long, at long, before int, gone boolean"


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling hash's base modulo 2^64, and of its inverse."""

    def of(base: int) -> np.ndarray:
        out = np.ones(STRETCH + 1, np.uint64)
        done = 1
        while done < len(out):
            more = min(done, len(out) - done)
            out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        return out

    return of(BASE), of(pow(BASE, -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(MIX)
    h ^= h >> np.uint64(32)
    return h * np.uint64(MIX)


def _phrases(data: np.ndarray, spans: list[tuple[int, int]], width: int) -> tuple[np.ndarray, ...]:
    """Rows of a stretch: first window start, number of windows, trigger start, hash of the trigger, marks of the bytes right and left
    of it. ``spans``: begin and end of the documents' parts in the stretch; no window crosses them."""
    n, (power, inverse) = len(data), _powers()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])

    def rolled(at: np.ndarray, length: int) -> np.ndarray:
        return _mixed((sums[at + length] - sums[at]) * inverse[at])

    hashes = _mixed((sums[TRIGGER:] - sums[:-TRIGGER]) * inverse[: n - TRIGGER + 1])
    place = np.arange(len(hashes), dtype=np.uint64)
    least = (hashes >> np.uint64(21) << np.uint64(21)) | place  # the first of equal hashes is the least
    held, needed = 1, width - TRIGGER + 1
    while held < needed:  # least of ever longer runs of hashes
        step = min(held, needed - held)
        least = np.minimum(least[:-step], least[step:])
        held += step
    inside = np.zeros(n - width + 1, bool)
    for begin, end in spans:
        inside[begin : max(begin, end - width + 1)] = True
    starts = np.flatnonzero(inside)
    trigger = (least[starts] & np.uint64((1 << 21) - 1)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(new)
    first, q = starts[head], trigger[head]
    windows = np.diff(np.append(head, len(starts)))
    half = (width - TRIGGER) // 2
    nearest, farthest = q - (first + windows - 1), q - first
    right_end = width - half + 1
    right, left = np.zeros(len(q), np.uint64), np.zeros(len(q), np.uint64)
    has = nearest < half
    right[has] = rolled(q[has] + TRIGGER, right_end - TRIGGER) % np.uint64(511) + np.uint64(1)
    has = farthest >= half
    left[has] = rolled(q[has] - half, half) % np.uint64(511) + np.uint64(1)
    return first, windows, q, hashes[q], right, left


def _stretches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Documents' parts (doc, mark, offset, bytes) in lists of up to ``STRETCH`` bytes; parts of a long text overlap."""
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            if len(text) < width:
                continue
            mark = xxhash.xxh3_64_intdigest(text) + SMALLEST
            for at in range(0, len(text) - width + 1, STRETCH - width + 1):
                part = text[at : at + STRETCH]
                if size + len(part) > STRETCH:
                    yield held
                    held, size = [], 0
                held.append((doc, mark, at, part))
                size += len(part)
    if held:
        yield held


def _rows_of(parts: list[tuple[int, int, int, bytes]], width: int) -> np.ndarray:
    """One row of seed, name, doc, mark, place for each phrase."""
    raw = b"".join(p[3] for p in parts)
    ends = np.cumsum([len(p[3]) for p in parts])
    begins = ends - [len(p[3]) for p in parts]
    first, windows, q, seed, right, left = _phrases(np.frombuffer(raw, np.uint8), list(zip(begins.tolist(), ends.tolist())), width)
    before = q - first
    shape = (before << 7 | windows).tolist()
    until = first + windows + width - 1
    name = [xxhash.xxh3_64_intdigest(raw[a:b], s) for a, b, s in zip(first.tolist(), until.tolist(), shape)]
    of = np.searchsorted(ends, first, "right")
    doc, mark, base = (np.array(x, np.int64)[of] for x in list(zip(*parts))[:3])
    offset = first - begins[of] + base
    place = offset << OFFSET | windows << WINDOWS | before << BEFORE | (right.astype(np.int64) << MARK) | left.astype(np.int64)
    return np.stack([seed.view(np.int64), np.array(name, np.uint64).view(np.int64), doc, mark, place])


def _new_groups(rows: np.ndarray) -> np.ndarray:
    """Which rows, in order, begin another seed and name."""
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:2, 1:] != rows[:2, :-1]).any(0)
    return new


def _later_copies(rows: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Which rows, in order, are later copies of their group's first row; a row that repeats it wholly is not."""
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return (rows[2:] != rows[2:, first]).any(0)


def _emitted(rows: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.shape[1], 100_000):
        yield pa.record_batch([pa.array(x) for x in rows[:, at : at + 100_000]], names=names)


def _parsed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    names = ["seed", "name", "doc", "mark", "place"]
    held: list[np.ndarray] = []

    def combined() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held, axis=1)
        held.clear()
        order = np.argsort(rows[1])
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = rows[1, order[1:]] == rows[1, order[:-1]]
        often = order[same[1:] | same[:-1]]  # rows whose name the task has twice
        often = often[np.lexsort(rows[::-1, often])]
        gone = often[_later_copies(rows[:, often], _new_groups(rows[:, often]))]
        # A copy of a row that this task has earlier is settled; its key spreads it anywhere.
        rows[4, gone] = rows[4, gone] >> WINDOWS << WINDOWS | GONE << BEFORE
        rows[:2, gone] = _mixed((rows[3, gone] ^ rows[4, gone]).view(np.uint64)).view(np.int64)
        return _emitted(rows, names)

    for parts in _stretches(batches, width):
        held.append(_rows_of(parts, width))
        if sum(x.shape[1] for x in held) >= HELD_ROWS:
            yield from combined()
    if held:
        yield from combined()


def _shared(seed: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Which rows have a mark (not 0) that another row of the same seed has too."""
    _, at, n = np.unique(_mixed(seed.view(np.uint64) + mark.astype(np.uint64)), return_inverse=True, return_counts=True)
    return (n[at] > 1) & (mark > 0)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in the order of all columns: later copies (gone), and rows that may share windows with others. A seed whose rows
    reach over the border of a batch keeps them all, as its marks cannot be compared there."""
    last: np.ndarray | None = None  # first row of the last group of the batch before
    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns])
        settled = (rows[4] >> BEFORE & 127) == GONE
        yield from _emitted_found(rows[:, settled], np.ones(settled.sum(), bool))
        rows = rows[:, ~settled]
        if not rows.shape[1]:
            continue
        carried = last is not None
        if carried:
            rows = np.concatenate([last[:, None], rows], axis=1)
        new = _new_groups(rows)
        gone = _later_copies(rows, new)
        heads = rows[:, new]
        last = heads[:, -1]
        edge = (heads[0] == heads[0, 0]) | (heads[0] == heads[0, -1])
        onward = edge | _shared(heads[0], heads[4] >> MARK & 511) | _shared(heads[0], heads[4] & 511)
        if carried:
            onward[0] = False  # it went on with its own batch
        yield from _emitted_found(rows[:, gone], np.ones(gone.sum(), bool))
        yield from _emitted_found(heads[:, onward], np.zeros(onward.sum(), bool))


def _emitted_found(rows: np.ndarray, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(gone):
        yield pa.record_batch([*(pa.array(x) for x in rows[2:]), pa.array(gone)], names=["doc", "mark", "place", "gone"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor()
    for batch in batches:
        marks, packed = [], []
        for text in texts_of(batch.column(1)):
            marks.append(xxhash.xxh3_64_intdigest(text) + SMALLEST)
            packed.append(packer.compress(text))
        yield pa.record_batch([batch.column(0), pa.array(marks, pa.int64()), pa.array(packed, pa.large_binary()).cast(pa.binary())], names=["doc", "mark", "packed"])


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the rows that go on."""
    for batch in batches:
        bodies: list[bytes] = []
        lists = batch.column(3)
        places = lists.flatten().to_numpy()
        counts = np.diff(lists.offsets.to_numpy())
        at, windows = places >> OFFSET, places >> WINDOWS & 127
        begin = 0
        for packed, n in zip(batch.column(2), counts.tolist()):
            text = _unpacked(packed.as_py())
            span = slice(begin, begin + n)
            begin += n
            bodies += [text[a : a + m + width - 1] for a, m in zip(at[span].tolist(), windows[span].tolist())]
        known = [pa.array(np.repeat(batch.column(c).to_numpy(), counts)) for c in (0, 1)]
        yield pa.record_batch([pa.array(bodies, pa.binary()), *known, pa.array(at), pa.array((places >> BEFORE & 127).astype(np.int32))], names=["body", "doc", "mark", "at", "before"])


def _first_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks all but the first of equal pieces that a task has; what is settled carries a key that spreads it, and no bytes."""
    held: list[tuple] = []

    def combined() -> pa.RecordBatch:
        first: dict[tuple, tuple] = {}
        for cell, _, body, doc, mark, at, before in held:
            key, place = (cell, before, body), (doc, mark, at)
            if place < first.setdefault(key, place):
                first[key] = place
        out = []
        for row in held:
            if row[3:6] == first[row[0], row[6], row[2]]:
                out.append((*row, False))
            else:
                spread = xxhash.xxh3_64_digest(b"%d %d" % (row[4], row[5]))
                out.append((-1, spread, len(row[2]).to_bytes(4, "big"), *row[3:], True))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _PIECE_TYPES)], names=[c.split()[0] for c in PIECES.split(", ")])

    for batch in batches:
        held.extend(zip(*(c.to_pylist() for c in batch.columns)))
        if len(held) >= HELD_PIECES:
            yield combined()
    if held:
        yield combined()


_PIECE_TYPES = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From pieces in corpus order: later copies (gone), and pieces that share the common bytes of their cell with others. At
    the ends of a partition a neighbour cannot be seen, so the pieces there go on."""
    out: list[tuple] = []
    head = None  # first piece of the current group of equal ones
    shares = True

    def flushed() -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32())
        batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 7, kinds)], names=["body", "doc", "mark", "at", "before", "gone", "size"])
        out.clear()
        return batch

    def ended(shares: bool) -> None:
        if head and shares:
            out.append((head[2], *head[3:7], False, len(head[2])))

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            cell, common, body, doc, mark, at, before, gone = row
            if gone:
                out.append((None, doc, mark, at, before, True, int.from_bytes(body, "big")))
            elif head and row[:3] == head[:3] and before == head[6]:
                if row[3:6] != head[3:6]:
                    out.append((None, doc, mark, at, before, True, len(body)))
            else:
                same = head is not None and row[:2] == head[:2]
                ended(shares or same)
                shares = same or head is None
                head = row
        yield flushed()
    ended(True)
    yield flushed()


def _round(pieces: DataFrame, cell: int, width: int) -> DataFrame:
    """One round of the dictionary order over body, doc, mark, at, before; returns, saved, body (null if gone), doc, mark, at,
    before, gone, size (bytes)."""
    least = F.expr(f"before - (octet_length(body) - {width})")
    cells = pieces.withColumn("least", least).withColumn("cell", F.explode(F.expr(f"sequence(CAST(least DIV {cell} AS INT), CAST(before DIV {cell} AS INT))")))
    cells = cells.withColumn("hi", F.expr(f"CAST(least(before, cell * {cell} + {cell - 1}) AS INT)")).withColumn("lo", F.expr(f"greatest(least, cell * {cell})"))
    cut = cells.withColumn("body", F.expr(f"substring(body, CAST(before - hi + 1 AS INT), CAST(hi - lo + {width} AS INT))"))
    common = F.expr(f"substring(body, CAST(hi - cell * {cell} + 1 AS INT), {width - cell + 1})")
    cut = cut.select("cell", common.alias("common"), "body", "doc", "mark", (F.col("at") + F.col("before") - F.col("hi")).alias("at"), F.col("hi").alias("before"))
    combined = saved(cut.mapInArrow(_first_pieces, PIECES), f"phrase-cells-{cell}")
    order = ["cell", "common", "body", "before", "doc", "mark", "at"]
    ranged = combined.repartitionByRange("cell", "common", "body", "before").sortWithinPartitions(*order)
    kinds = "body binary, doc long, mark long, at long, before int, gone boolean, size int"
    judged = saved(ranged.mapInArrow(_neighbours, kinds), f"phrase-suffixes-{cell}")
    discard(combined)
    return judged


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row in range(batch.num_rows):
            doc, packed, spans = (batch.column(c)[row].as_py() for c in (0, 1, 2))
            text = _unpacked(packed)
            merged: list[list[int]] = []
            for span in sorted((s["start"], s["stop"]) for s in spans or ()):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append(list(span))
            digest, at = sha256(), 0
            for start, stop in merged:
                digest.update(text[at:start])
                at = stop
            digest.update(text[at:])
            out.append((doc, len(text), sum(b - a for a, b in merged), len(merged), merged, digest.hexdigest()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 6, kinds)], names=["doc", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])


def _as_documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(SMALLEST)).alias("doc"), F.col("text").cast("string").alias("text"))


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc, mark, start, stop (bytes, end exclusive): spans to remove, which may overlap. A null id is the smallest long; the mark is
    the hash of the text."""
    if not TRIGGER + 2 <= width <= TRIGGER + 100:
        raise ValueError("width is out of range")
    texts = _as_documents(docs)
    parsed = saved(texts.mapInArrow(partial(_parsed, width=width), ROWS), "phrases")
    ordered = parsed.repartitionByRange("seed", "name").sortWithinPartitions("seed", "name", "doc", "mark", "place")
    found = saved(ordered.mapInArrow(_judged, "doc long, mark long, place long, gone boolean"), "phrases-judged")
    discard(parsed)
    at, windows = F.shiftright("place", OFFSET), F.shiftright("place", WINDOWS).bitwiseAND(F.lit(127))
    spans = [found.filter("gone").select("doc", "mark", at.alias("start"), (at + windows + width - 1).alias("stop"))]
    onward = found.filter("NOT gone").groupBy("doc", "mark").agg(F.collect_set("place").alias("places"))
    packed = texts.mapInArrow(_packed, "doc long, mark long, packed binary")
    bodies = packed.join(onward, ["doc", "mark"]).select("doc", "mark", "packed", "places")
    pieces = saved(bodies.mapInArrow(partial(_pieces, width=width), "body binary, doc long, mark long, at long, before int"), "phrase-bodies")
    for cell in CELLS:
        judged = _round(pieces, cell, width)
        spans.append(judged.filter("gone").select("doc", "mark", F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("stop")))
        pieces = judged.filter("NOT gone").select("body", "doc", "mark", "at", "before")
    return reduce(DataFrame.union, spans)


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (start and stop of the maximal removed runs, in bytes) and kept_sha256 for
    every row of ``docs``."""
    spans = repeated_spans(docs, width).groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    packed = _as_documents(docs).mapInArrow(_packed, "doc long, mark long, packed binary")
    joined = packed.join(spans, ["doc", "mark"], "left").select("doc", "packed", "spans")
    kept = joined.mapInArrow(_kept, "doc long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept_sha256 string")
    doc_id = F.nullif(F.col("doc"), F.lit(SMALLEST))
    return kept.select(doc_id.alias("doc_id"), "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")
