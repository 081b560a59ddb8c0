import io
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tidemart.llm import bpe, token_files
from tidemart.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")

ALPHABET = "abcdefgh ABC  ÉÀß'’s't \x1c\x85\xa0 ΣσΟ0123456789٣²½!?.,<|endoftext|>é́̈İıK\n\t日本語한글🙂🏽_-\0"


def library(name):
    t = tokenizers.Tokenizer.from_file(vocabulary(name))
    t.no_padding()
    t.no_truncation()
    return t


def fuzz(n):
    rng = random.Random(n)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(50))) for _ in range(n)]
    texts += ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    return texts + ["", "a" * 3000, "ab" * 900, "the</w>", "<|endoftext|>x<|startoftext|>", "ΟΔΟΣ ΣΑΣ", "don't WE'LL"]


def test_backtracking_encoder_equals_the_merges():
    ours, theirs = bpe.WordBpe(vocabulary("word_bpe_49k.json")), library("word_bpe_49k.json")
    texts = fuzz(1500)
    for text, want in zip(texts, theirs.encode_batch(texts, add_special_tokens=False)):
        ids = ours.encode(text.encode())
        assert ids.tolist() == want.ids, text
        assert ours.decode(ids).decode() == theirs.decode(want.ids, skip_special_tokens=False)


def test_encoding_query_equals_the_library(awkward, rows):
    theirs, want = library("word_bpe_49k.json"), Counter()
    for i, t, _ in rows:
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        want[i, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(decoded.encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in bpe.encoding_digests(awkward, vocabulary("word_bpe_49k.json")).collect()) == want
    ids = {r["doc_id"]: r["ids"] for r in bpe.token_ids(awkward, vocabulary("word_bpe_49k.json")).collect()}
    assert ids[3 + 10] == [] and len(ids[0]) > 100


def test_encoding_query_remembers_more_words_than_the_pipeline(monkeypatch):
    """Words that come again in the same order are encoded once, though the pipeline's encoder would have forgotten them."""
    words = ["".join("etaoinshrd"[int(c)] for c in str(n)) for n in range(200_000, 380_000)]
    batch = pa.record_batch([pa.array([1, 2]), pa.array([" ".join(words)] * 2)], names=["doc_id", "text"])
    encoded, path = Counter(), vocabulary("word_bpe_49k.json")
    plain = bpe.WordBpe._of_symbols
    monkeypatch.setattr(bpe, "_loaded", {})
    monkeypatch.setattr(bpe.WordBpe, "_of_symbols", lambda self, word: encoded.update([word]) or plain(self, word))
    rows = pa.Table.from_batches(bpe._encoded(iter([batch]), path)).to_pylist()
    assert len(encoded) == len(words) and max(encoded.values()) == 1
    assert {k: v for k, v in rows[0].items() if k != "doc_id"} == {k: v for k, v in rows[1].items() if k != "doc_id"}
    small = bpe.loaded(path)  # as the pipeline uses it
    assert small is not bpe.loaded(path, bpe.REMEMBERED_ALONE)
    assert (small.words.size, small.runs.size, small.compatible_pairs.size) == bpe.REMEMBERED


def test_joined_table_renders_any_ids():
    table = bpe.JoinedTable([b"a", b"", "é".encode(), b"xyz"])
    assert table.render(np.array([], "<u4")) == b""
    assert table.render(np.array([3, 1, 2, 0, 1], "<u4")) == b"xyz  \xc3\xa9 a "
    assert table.render(np.array([1], "<u4")) == b""


def test_library_encoder_equals_whole_texts():
    ours, theirs = token_files.LibraryEncoder(vocabulary("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    texts = fuzz(1500)
    want = [np.array(e.ids, "<u4").tobytes() for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert ours.encode(texts[:1000]) + ours.encode(texts[1000:]) == want


def packed(docs, frame_bytes):
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, frame_bytes)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    return out


def test_file_round_trip_and_single_frames():
    rng = np.random.default_rng(0)
    docs = [(None if k == 0 else k * 3, rng.integers(0, 50_000, n).astype("<u4").tobytes()) for k, n in enumerate([0, 1, 5, 4000, 0, 17, 300, 2])]
    out = packed(docs, 256)
    raw = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True).read(1 << 24) for _ in range(1))
    assert raw == b"".join(ids for _, ids in docs)  # any zstandard reader can read the whole file
    f = token_files.TokenFile(out)
    assert len(f) == len(docs) and [f.ids(i) for i in range(len(f))] == [ids for _, ids in docs]
    assert f.find(9) == [3] and f.find(0) == []
    read = []
    f._last = (-1, b"")
    plain = f._read
    f._read = lambda at, n: read.append(n) or plain(at, n)
    f.ids(5)
    assert len(read) == 1  # one frame for a short document


def test_damage_is_noticed():
    out = packed([(1, bytes(4000))], 1 << 18)
    broken = bytearray(out.getvalue())
    f = token_files.TokenFile(io.BytesIO(bytes(broken)))
    f.frames = f.frames.copy()
    f.frames[0, 2] ^= 1
    with pytest.raises(ValueError):
        f.ids(0)
    with pytest.raises(ValueError):
        token_files.TokenFile(io.BytesIO(bytes(broken[:-4])))


def test_empty_file():
    assert len(token_files.TokenFile(packed([], 256))) == 0


def test_token_files_query(awkward, rows, nothing):
    theirs = library("byte_bpe_50k.json")
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start, want = 0, Counter()
    for i, t, _ in ordered:
        ids = [*theirs.encode(t or "", add_special_tokens=False).ids, 0]
        want[i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    files = token_files.write_token_files(awkward, vocabulary("byte_bpe_50k.json"))
    assert Counter(tuple(r) for r in token_files.read_token_files(files).collect()) == want
    assert token_files.read_token_files(token_files.write_token_files(nothing, vocabulary("byte_bpe_50k.json"))).count() == 0


def test_runs_of_sliced_batches_as_the_library():
    import public_tokenizers
    import pyarrow as pa

    from tidemart.llm.token_files import LibraryEncoder

    encoder = LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a b", "x", "a\nb c.", "", "  q", "é ü.\nz", "a", "b. b, a"]
    whole = encoder._whole(texts)
    assert encoder.encode(texts) == whole and encoder.encode(pa.array(texts).slice(1, 5)) == whole[1:6]
    assert encoder.encode([]) == [] and encoder.encode(["", " "]) == encoder._whole(["", " "])
