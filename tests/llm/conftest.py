"""Small hand-made tables with every awkward case."""

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    # names that operators use inside
    + [T.StructField(c, T.StringType()) for c in ("digest", "fp", "row", "token", "tokens", "copy", "score", "bucket", "mark", "start", "w", "node")]
)


def prose(rng, n):
    return " ".join(rng.choice("the of and river stone Cloud lamp green walks slowly home again".split()) + rng.choice(["", "", ",", "."]) for _ in range(n))


def awkward_texts():
    rng = random.Random(4)
    base = [prose(rng, 120) for _ in range(12)]
    texts = base + [
        None, "", " \t\n", "one", "One", "ONE", "two words", "ä É É ß İ K", "x" * 20_000, "word " * 30_000, " ", "a\r\nb\x0bc\x0cd",
        base[0], base[0].upper(), base[1] + " tail", base[2], base[2], "line one\nline one\n\n \nline two\nline one",
        "mail a.b@c.example.com ip 10.0.0.1 card 4111 1111 1111 1111 phone +1 (617) 555-0100 <|endoftext|>",
    ]
    rows = [(i, t, "en" if i % 3 else None, None if i % 7 == 0 else f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows.append((None, "no id here", "en", "src0", 10))
    rows.append(rows[3])  # the same row twice
    rows.append((5, "same id, other text", "en", "src1", 19))
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    clash = ("clash",) * (len(SCHEMA) - 5)
    return spark.createDataFrame([r + clash for r in awkward_texts()], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def rows(awkward):
    return [(r["doc_id"], r["text"], r["source"]) for r in awkward.collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, 1 if i < 12 else 0, i % 2) for i in range(40)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
