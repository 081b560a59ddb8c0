"""Token ids in files of independent zstandard frames with a trailing seek table and a checksum per frame.

Layout of a file (integers little-endian):

* data frames: each a complete zstandard frame over up to ``FRAME_BYTES`` of ids (unsigned 32-bit). Frames end between
  documents, except within a document longer than a frame;
* one skippable frame (magic 0x184D2A50) with the zstandard-packed document table: for every document its id (int64),
  whether the id is null (uint8) and its number of ids (uint64), each as one array;
* the seek table, a skippable frame (magic 0x184D2A5E): per data frame packed size, unpacked size and checksum (uint32
  each; the checksum is the low half of the XXH64 of the unpacked bytes), then the number of data frames (uint32), a
  descriptor byte (0x80: with checksums) and the magic 0x8F92EAB1, as in the public seekable format.

Any zstandard decoder reads the file as a whole; ``TokenFile`` reads the tables from the end and then unpacks only the
frames that hold the requested documents. Spark sorts the documents over files: file i + 1 continues where file i
ends. A task writes under a name of its own and renames the finished file, so a repeated task gives the same file.

Texts are encoded by the tokenizers library. A run of non-space characters together with one space before it is encoded
the same wherever it stands, so a task hands each distinct run to the library once and remembers its ids up to a bound;
texts with white space of other shapes or with special tokens go to the library whole.

A null text counts as empty; every document ends with the end id, so an empty one has one id. Null ids sort first,
equal ids by their text. An empty table gives files without documents, or none.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Memory
from .tables import new_folder, texts_of

FRAME_BYTES = 1 << 18
#: Runs that a worker remembers in each of two generations.
REMEMBERED = 400_000
# Fixed values of the public zstandard and seekable formats.
SKIPPABLE, SEEK_FRAME, SEEK_MAGIC, WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80


class TokenFileWriter:
    def __init__(self, out: io.RawIOBase, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes = out, frame_bytes
        self.packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.waiting: list[bytes] = []
        self.size = 0
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.size and self.size + len(ids) > self.frame_bytes:
            self._flush()
        self.ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        for at in range(0, len(ids), self.frame_bytes):
            piece = ids[at : at + self.frame_bytes]
            if self.size + len(piece) > self.frame_bytes:
                self._flush()
            self.waiting.append(piece)
            self.size += len(piece)

    def _flush(self) -> None:
        raw = b"".join(self.waiting)
        packed = self.packer.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._flush()
        known = np.array([x or 0 for x in self.ids], "<i8").tobytes()
        nulls = np.array([x is None for x in self.ids], "u1").tobytes()
        table = self.packer.compress(known + nulls + np.array(self.counts, "<u8").tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        seek = np.array(self.frames, "<u4").tobytes() + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_FRAME, len(seek)) + seek)


class TokenFile:
    """Random access to one file (any seekable binary file object)."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, io.SEEK_END)
        frames, descriptor, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEK_MAGIC or descriptor != WITH_CHECKSUMS:
            raise ValueError("no seek table")
        self.frames = np.frombuffer(self._read(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.packed_at = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.raw_at = np.concatenate([[0], np.cumsum(self.frames[:, 1])])
        magic, length = struct.unpack("<II", self._read(int(self.packed_at[-1]), 8))
        if magic != SKIPPABLE:
            raise ValueError("no document table")
        table = zstandard.ZstdDecompressor().decompress(self._read(int(self.packed_at[-1]) + 8, length))
        n = len(table) // 17
        self.doc_ids = np.frombuffer(table, "<i8", n)
        self.null_ids = np.frombuffer(table, "u1", n, 8 * n).astype(bool)
        self.counts = np.frombuffer(table, "<u8", n, 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self._last: tuple[int, bytes] = (-1, b"")

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        data = self.source.read(n)
        if len(data) != n:
            raise ValueError("file is cut short")
        return data

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            raw = zstandard.ZstdDecompressor().decompress(self._read(int(self.packed_at[k]), int(self.frames[k, 0])))
            if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                raise ValueError(f"frame {k} is damaged")
            self._last = (k, raw)
        return self._last[1]

    def __len__(self) -> int:
        return len(self.counts)

    def ids(self, i: int) -> bytes:
        """Ids of the i-th document; unpacks only the frames that hold it."""
        begin, end = 4 * int(self.starts[i]), 4 * int(self.starts[i + 1])
        out = []
        k = int(np.searchsorted(self.raw_at, begin, "right")) - 1
        while begin < end:
            raw, base = self._frame(k), int(self.raw_at[k])
            out.append(raw[begin - base : end - base])
            begin, k = base + len(raw), k + 1
        return b"".join(out)

    def find(self, doc_id: int) -> list[int]:
        """Positions of the documents with this id."""
        return np.flatnonzero((self.doc_ids == doc_id) & ~self.null_ids).tolist()


class LibraryEncoder:
    """Ids by the tokenizers library, as UTF-8 text to little-endian unsigned 32-bit integers."""

    #: Texts that go to the library whole: empty, with white space at an end, in pairs, or other than blank and line feed (as
    #: Python knows it), with the start of a special token or the mark between runs.
    UNSAFE = (
        r"\A[ \n]|[ \n]\z|\A\z|  |\n\n| \n|\n |<\||\x00|"
        r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    )
    STOPS = ".,;:!?"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known = Memory(REMEMBERED)
        (self.line_feed,) = self.library.encode("\n", add_special_tokens=False).ids

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs(self, runs: list[str]) -> list[bytes]:
        """Each run has no line feed inside, so one text of all runs with line feeds between them gives the same ids."""
        if not runs:
            return []
        ids = np.array(self.library.encode_batch_fast(["\n".join(runs)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.append(np.flatnonzero(ids == self.line_feed), len(ids)).tolist()
        starts = [0, *(e + 1 for e in ends[:-1])]
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(starts, ends)]

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of runs; the stops after a letter are runs of their own, so that a word is learnt once."""
        found: dict[str, bytes] = {}
        parted, fresh = [], set()
        for run in missing:
            known = self.known.old.get(run)
            if known is not None:
                found[run] = known
            elif run == "\n":
                found[run] = np.array([self.line_feed], "<u4").tobytes()
            elif (stem := run.rstrip(self.STOPS)) and len(stem) < len(run) and stem[-1].isalpha():
                parted.append((run, stem, run[len(stem) :]))
            else:
                fresh.add(run)
        young, old = self.known.young, self.known.old
        for _, stem, stops in parted:
            for part in (stem, stops):
                if part not in found and part not in fresh:
                    known = young.get(part) or old.get(part)
                    if known is None:
                        fresh.add(part)
                    else:
                        found[part] = known
        fresh = list(fresh)
        found.update(zip(fresh, self._runs(fresh)))
        found.update([(run, found[stem] + found[stops]) for run, stem, stops in parted])
        self.known.put_all(found)
        return found

    def _by_runs(self, texts: pa.Array) -> list[bytes]:
        """Ids of safe texts: each distinct run of the batch is looked up once, and its ids are laid out by position."""
        # "\n" is a run of its own; a blank goes with the run after it
        marked = pc.replace_substring(pc.replace_substring(texts, "\n", "\0\n\0"), " ", "\0 ")
        lists = pc.split_pattern(marked, "\0")
        coded = lists.flatten().dictionary_encode()
        if not len(coded):
            return []
        # one text of all runs, cut at the mark: far faster than a Python value from each place of an array
        listed = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        runs = pc.binary_join(listed, pa.scalar("\0", pa.large_string()))[0].as_py().split("\0")
        ids = list(map(self.known.young.get, runs))
        learnt = self._learn({run for run, x in zip(runs, ids) if x is None})
        ids = [learnt[run] if x is None else x for run, x in zip(runs, ids)]
        borders = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)), out=borders[1:])
        ids = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(borders), pa.py_buffer(b"".join(ids))])
        placed = ids.take(coded.indices)
        _, offsets, data = placed.buffers()
        ends = np.frombuffer(offsets, np.int64, len(placed) + 1, 8 * placed.offset)[np.asarray(lists.offsets) - lists.offsets[0].as_py()].tolist()
        raw = memoryview(data or b"")
        return [bytes(raw[a:b]) for a, b in zip(ends, ends[1:])]

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        texts = pc.cast(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), pa.large_string())
        unsafe = pc.match_substring_regex(texts, self.UNSAFE)
        by_runs = iter(self._by_runs(texts.filter(pc.invert(unsafe))))
        whole = iter(self._whole(texts.filter(unsafe).to_pylist()))
        return [next(whole if x else by_runs) for x in unsafe.to_pylist()]


_encoders: dict[str, LibraryEncoder] = {}


def encoder(path: str) -> LibraryEncoder:
    if path not in _encoders:
        _encoders[path] = LibraryEncoder(path)
    return _encoders[path]


def _slices(batch: pa.RecordBatch, most: int = 8_000_000) -> Iterable[tuple[list, pa.Array]]:
    """(doc_ids, texts) in runs of a few million bytes, to bound memory; a null text is empty."""
    texts = pc.fill_null(pc.cast(batch.column(1), pa.large_string()), "")
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        texts = pa.array([t.decode("utf-8", "replace") for t in texts_of(pc.cast(texts, pa.large_binary()))], pa.large_string())
    ids = batch.column(0).to_pylist()
    pieces = np.cumsum(np.asarray(pc.binary_length(texts))) // most
    borders = [0, *(np.flatnonzero(np.diff(pieces)) + 1).tolist(), len(ids)]
    for a, b in zip(borders, borders[1:]):
        if a < b:
            yield ids[a:b], texts.slice(a, b - a)


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    system, root = pafs.FileSystem.from_uri(folder)
    name, draft = f"{root}/part-{part:06d}.ids.zst", f"{root}/.draft-{part:06d}-{uuid.uuid4().hex}"
    end = np.array([end_id], "<u4").tobytes()
    with system.open_output_stream(draft) as out:
        writer = TokenFileWriter(out)
        for batch in batches:
            for ids, texts in _slices(batch):
                for doc_id, tokens in zip(ids, encoder(path).encode(texts)):
                    writer.add(doc_id, tokens + end)
        writer.close()
    system.move(draft, name)
    yield pa.record_batch([[part], [f"part-{part:06d}.ids.zst"], [len(writer.counts)], [sum(writer.counts)]], names=["part", "file", "n_docs", "n_ids"])


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None, files: int | None = None) -> DataFrame:
    """Writes all documents in ascending doc_id order; returns one row per file: folder, file, start (ids in the files
    before it), n_docs, n_ids. The list of files passes through the driver, one short row for each file."""
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    system, root = pafs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.mapInArrow(partial(_write, folder=folder, path=tokenizer, end_id=end_id), "part long, file string, n_docs long, n_ids long")
    listed, start = [], 0
    for row in sorted(written.collect()):  # one row per file
        listed.append((folder, row["file"], start, row["n_docs"], row["n_ids"]))
        start += row["n_ids"]
    schema = "folder string, file string, start long, n_docs long, n_ids long"
    return spark.createDataFrame(spark.sparkContext.parallelize(listed, max(1, len(listed))), schema)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            system, root = pafs.FileSystem.from_uri(row["folder"])
            with system.open_input_file(f"{root}/{row['file']}") as source:
                f = TokenFile(source)
                for at in range(0, len(f), 10_000):
                    span = range(at, min(at + 10_000, len(f)))
                    crcs = [zlib.crc32(f.ids(i)) for i in span]
                    ids = pa.array(f.doc_ids[span.start : span.stop], mask=f.null_ids[span.start : span.stop])
                    yield pa.record_batch([ids, pa.array(f.starts[span.start : span.stop] + row["start"]), pa.array(f.counts[span.start : span.stop]), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and CRC-32 of the ids of every document, read from the files."""
    return files.mapInArrow(_read_back, "doc_id long, start long, n_tokens long, ids_crc32 long")
