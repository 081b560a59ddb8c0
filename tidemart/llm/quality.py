"""Quality rules: countable rules and a hashed n-gram log-likelihood ratio between trusted and raw text.

Two multinomials over hashed word unigrams and bigrams: one from trusted documents, one from the whole raw corpus. The
trusted one is smoothed by PRIOR occurrences per bucket drawn from the raw one, so a bucket without evidence scores
zero. A document's value is the mean log ratio of its n-grams; it is kept from ``LEAST_RATIO`` on. Ratios are whole
millionths of a nat and sums are integers, so the verdict does not depend on the order of rows.

Everything runs in DataFrame functions. The counts of all documents are folded to one number per bucket on the map side;
the table of ratios has BUCKETS numbers. No text is shuffled. Repeated 3-word windows are found by sorting their
hashes within the document; only documents that have any take that step.

Trusted documents: at most ``TRUSTED_ROWS`` ids (by the hash of the id) are taken from the labels and broadcast.

A null text has no words and fails; a null id is judged like any other; repeated rows stay and count each; without raw
or trusted text all ratios are zero. Columns of the input never clash with the inner ones, which start with ``__q_``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.sampling import hash_border

BUCKETS = 1 << 16
#: Raw occurrences per bucket by which the trusted counts are smoothed.
PRIOR = 100.0
#: Least mean log ratio of a kept document, in nats per n-gram.
LEAST_RATIO = -0.065
TRUSTED_ROWS = 200_000
MICRO = 1_000_000
SPACES = r"[\x20\x09-\x0D]+"


def _with_hashes(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.withColumn("__q_text", text).withColumn("__q_words", F.filter(F.split("__q_text", SPACES), lambda w: w != ""))
    return words.withColumn("__q_hash", F.transform("__q_words", lambda w: F.xxhash64(w)))


def _bucket(value: Column) -> Column:
    return F.pmod(value, F.lit(BUCKETS)).cast("int")


def _buckets() -> Column:
    """Buckets of the unigrams and bigrams."""
    following = lambda x, i: _bucket(F.xxhash64(x, F.get("__q_hash", i + 1)))
    pairs = F.transform(F.slice("__q_hash", 1, F.greatest(F.size("__q_hash") - 1, F.lit(0))), following)
    return F.concat(F.transform("__q_hash", _bucket), pairs)


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """doc_id of documents labelled as good; at most ``rows``."""
    good = labels.filter("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    hashed = F.xxhash64("doc_id")
    return good.filter(hashed <= hash_border(good, hashed, rows)).orderBy(hashed, "doc_id").limit(rows)


def log_ratios(docs: DataFrame, trusted: DataFrame) -> list[int]:
    """Log ratio per bucket in millionths of a nat, from all texts of ``docs``. ``trusted`` is bounded (see above)."""
    mark = F.broadcast(trusted.select(F.col("doc_id").alias("__q_id"), F.lit(1).alias("__q_good")))
    marked = docs.select("doc_id", "text").join(mark, F.col("doc_id") == F.col("__q_id"), "left")
    grams = _with_hashes(marked).select(F.coalesce("__q_good", F.lit(0)).alias("good"), F.explode(_buckets()).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("good").alias("good"))
    out = [0] * BUCKETS
    rows = counts.collect()  # at most BUCKETS rows
    raw, good = sum(r["raw"] for r in rows), sum(r["good"] for r in rows)
    if good:
        share = good / raw
        for r in rows:
            out[r["bucket"]] = round(MICRO * math.log((r["good"] + PRIOR * share) / ((r["raw"] + PRIOR) * share)))
    return out


def _repeated(docs: DataFrame) -> DataFrame:
    """Adds __q_repeat: words in 3-word windows that occur twice or more."""
    window = lambda x, i: F.xxhash64(x, F.get("__q_hash", i + 1), F.get("__q_hash", i + 2))
    starts = F.slice("__q_hash", 1, F.greatest(F.size("__q_hash") - 2, F.lit(0)))
    docs = docs.withColumn("__q_windows", F.transform(starts, window))
    found = F.expr(
        "CASE WHEN size(array_distinct(__q_windows)) < size(__q_windows) "
        "THEN sort_array(transform(__q_windows, (h, i) -> struct(h, i))) END"
    )
    docs = docs.withColumn("__q_sorted", found)
    twice = F.expr(
        "sort_array(transform(filter(__q_sorted, (x, k) -> coalesce(x.h = get(__q_sorted, k - 1).h, false) "
        "OR coalesce(x.h = get(__q_sorted, k + 1).h, false)), x -> x.i))"
    )
    docs = docs.withColumn("__q_twice", twice)
    covered = "coalesce(aggregate(transform(__q_twice, (p, k) -> least(3, coalesce(get(__q_twice, k + 1) - p, 3))), 0L, (a, x) -> a + x), 0L)"
    return docs.withColumn("__q_repeat", F.expr(covered))


def judged(docs: DataFrame, trusted: DataFrame, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """All columns of ``docs`` and a struct ``__q`` of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    ratio (mean log ratio, null without words), base_failed and kept."""
    table = F.lit(",".join(map(str, log_ratios(docs, trusted))))
    ratios = F.split(table, ",").cast("array<bigint>")  # a constant, computed once
    columns = [F.col(c) for c in docs.columns]
    out = _repeated(_with_hashes(docs))
    out = out.withColumn("__q_grams", _buckets())
    total = F.aggregate("__q_grams", F.lit(0).cast("long"), lambda a, b: a + F.get(ratios, b))
    lines = F.filter(F.split("__q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(
        *columns,
        F.size("__q_words").cast("long").alias("__q_n"),
        F.length(F.array_join("__q_words", "")).cast("long").alias("__q_chars"),
        F.regexp_count("__q_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("__q_symbols"),
        lines.alias("__q_lines"),
        F.col("__q_repeat"),
        F.size("__q_grams").cast("long").alias("__q_n_grams"),
        total.alias("__q_total"),
    )
    failed = (F.col("__q_n") < 50) | (100 * F.col("__q_repeat") > 50 * F.col("__q_n"))
    enough = F.col("__q_total") >= F.lit(round(least_ratio * MICRO)) * F.col("__q_n_grams")
    verdict = F.struct(
        F.col("__q_n").alias("n_words"),
        F.col("__q_chars").alias("word_chars"),
        F.col("__q_symbols").alias("n_symbols"),
        (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long").alias("n_dup_lines"),
        F.col("__q_repeat").alias("n_repeat_words"),
        (F.col("__q_total") / F.nullif(F.col("__q_n_grams"), F.lit(0)) / MICRO).alias("ratio"),
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
    )
    return out.select(*columns, verdict.alias("__q"))


def good_documents(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    # The row number keeps the filter above the projections: moved below, it would repeat their expressions many times.
    found = judged(docs, trusted).withColumn("__q_row", F.monotonically_increasing_id())
    return found.filter("__q.kept AND __q_row >= 0").select(*docs.columns)
