"""Toxicity: a character n-gram linear classifier whose features are scaled by naive Bayes log-count ratios.

Features of a text are the distinct character n-grams (3 to 5 code points, lower case, one space before and after),
hashed into 2^20 buckets. From labelled texts each bucket gets the log ratio of its share among toxic and among other
texts; a bucket that few labelled texts hold, or whose ratio is small or within the errors of its counts, gets none. A
text is the vector of the ratios of its buckets at unit length, and a logistic regression weighs them. The intercept is
then moved so that a score of ``cut`` separates the classes best (F1) on rows that a model did not see: the labelled rows
are dealt into folds by a hash of their id, and ratios and weights learnt from the other folds place each. With too few
labels for that the intercept of the regression stays.

Labels are learnt from at most ``fit_rows`` labelled rows of each class, taken in the order of a hash of their id; that
bound is the only one: ratios, regression and cut see all these rows, scoring covers every whole text. The sample is
broadcast and the documents join it on the map side, so no text is shuffled.

A null text counts as empty; an empty text gets the score of the intercept. Labels other than 0 and 1 are not used; with
several labels a document counts once for each. Without labels of both classes every score is the share of toxic labels
(0 if there are none). Repeated rows stay; label, language, source and id are no inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.operators.sampling import hash_border

from .tables import saved, texts_of

SIZES = (3, 4, 5)
BUCKETS = 1 << 20
FIT_ROWS = 4000
LEAST_TEXTS = 5
#: A ratio counts from this size on, and from so many of its standard errors (cross-validated on training rows).
LEAST_RATIO, LEAST_ERRORS = 1.0, 3.0
FOLDS = 5
ROUNDS = 120
CHUNK = 1 << 20


def features(text: bytes) -> np.ndarray:
    """Distinct buckets of the n-grams of a UTF-8 text, ascending."""
    padded = f" {text.decode('utf-8', 'replace').lower()} "
    codes = np.frombuffer(padded.encode("utf-32-le", "replace"), "<u4")
    found = [np.empty(0, np.uint32)]
    longest = max(SIZES)
    for at in range(0, max(len(codes) - longest, 0) + 1, CHUNK):
        c = codes[at : at + CHUNK + longest - 1].astype(np.uint64)
        h = np.zeros(len(c), np.uint64)
        buckets = []
        for n in range(1, longest + 1):
            if len(c) < n:
                break
            h = (h[: len(c) - n + 1] ^ c[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if n in SIZES:
                buckets.append((h >> np.uint64(64 - 20)).astype(np.uint32) ^ np.uint32(n))
        if buckets:
            found.append(np.unique(np.concatenate(buckets)))
    return found[-1] if len(found) <= 2 else np.unique(np.concatenate(found))


@dataclass
class Model:
    """score = sigmoid(intercept + sum of products / length of the ratio vector)."""

    intercept: float
    products: np.ndarray  # weight times ratio, by bucket
    squares: np.ndarray  # square of the ratio, by bucket
    constant: float | None = None

    def score(self, text: bytes) -> float:
        if self.constant is not None:
            return self.constant
        return float(1 / (1 + np.exp(-self.margin(features(text)))))

    def margin(self, f: np.ndarray) -> float:
        return self.intercept + float(self.products[f].sum(dtype=np.float64)) / max(1.0, float(self.squares[f].sum(dtype=np.float64))) ** 0.5


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            values = _lists([features(t) for t in texts_of(part.column(2))])
            yield pa.record_batch([part.column(0), part.column(1), values], names=["doc_id", "toxic", "buckets"])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32)))


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Labelled texts of each fold and class that hold a bucket, one row per bucket and task."""
    counts = np.zeros((2 * FOLDS, BUCKETS), np.int32)
    for batch in batches:
        lists = batch.column(1)
        group = np.repeat(np.asarray(batch.column(0)), np.diff(np.asarray(lists.offsets)))
        flat = np.asarray(lists.flatten())
        for k in np.unique(group):
            counts[k] += np.bincount(flat[group == k], minlength=BUCKETS).astype(np.int32)
    held = np.flatnonzero(counts.any(axis=0)).astype(np.int32)
    yield pa.record_batch([pa.array(held), *(pa.array(c[held]) for c in counts)], names=["bucket", *COUNTS])


#: Counts of the groups 2 * fold + class.
COUNTS = [f"c{k}" for k in range(2 * FOLDS)]


def labelled_sample(labels: DataFrame, fit_rows: int) -> DataFrame:
    """doc_id, toxic: at most ``fit_rows`` labels of each class, by the hash of their id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    hashed = F.xxhash64("doc_id")

    def of_class(y: int) -> DataFrame:
        rows = known.filter(F.col("toxic") == y)
        return rows.filter(hashed <= hash_border(rows, hashed, fit_rows)).orderBy(hashed, "doc_id").limit(fit_rows)

    return of_class(0).unionByName(of_class(1))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, cut: float = 0.7) -> Model:
    """Learns from ``labels`` (doc_id, toxic) and the texts of ``docs``; a text is toxic from ``cut`` on. What reaches the
    driver is bounded by the number of buckets and, of the distinct labelled texts, the buckets that have a ratio."""
    sample = saved(labelled_sample(labels, fit_rows), "toxic-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")  # 2 * fit_rows rows at most
    learnt = saved(joined.mapInArrow(_featured, "doc_id long, toxic int, buckets array<int>"), "toxic-features")
    rows = {r["toxic"]: r["count"] for r in learnt.groupBy("toxic").count().collect()}
    n_toxic, n_clean = rows.get(1, 0), rows.get(0, 0)
    empty = np.zeros(BUCKETS, np.float32)
    if not n_toxic or not n_clean:
        return Model(0.0, empty, empty, constant=n_toxic / max(1, n_toxic + n_clean))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    grouped = learnt.select((2 * fold + F.col("toxic")).alias("group"), "buckets")
    sums = grouped.mapInArrow(_class_counts, "bucket int, " + ", ".join(f"{c} int" for c in COUNTS))
    sums = sums.groupBy("bucket").agg(*(F.sum(c).cast("int").alias(c) for c in COUNTS))
    sums = sums.filter(sum((F.col(c) for c in COUNTS), F.lit(0)) >= LEAST_TEXTS).toArrow()
    buckets, counts = np.asarray(sums.column("bucket")), np.stack([np.asarray(sums.column(c)) for c in COUNTS])
    clean, toxic = counts[0::2].sum(axis=0), counts[1::2].sum(axis=0)
    ratio = log_count_ratios(buckets, clean, toxic)
    fold_ratios = [log_count_ratios(buckets, clean - counts[2 * k], toxic - counts[2 * k + 1]) for k in range(FOLDS)]
    used = docs.sparkSession.sparkContext.broadcast(np.any([ratio, *fold_ratios], axis=0))

    def with_ratio(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.asarray(x.values) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), _lists([x[used.value[x]] for x in lists])], names=["group", "buckets"])

    rows = grouped.mapInArrow(with_ratio, "group int, buckets array<int>").groupBy("group", "buckets").agg(F.count("*").alias("n"))
    rows = rows.orderBy("group", "buckets").toArrow()
    group, weight = np.asarray(rows.column("group")), np.asarray(rows.column("n"))
    held = [np.asarray(x.values).astype(np.int64) for x in rows.column("buckets")]
    model = regression([(g % 2, f) for g, f in zip(group.tolist(), held)], ratio, weight)
    unseen = np.empty(len(held))
    for k in range(FOLDS):
        out = group // 2 == k
        if not out.any():
            continue
        if len(set((group[~out] % 2).tolist())) < 2:
            return model
        other = regression([(group[i] % 2, held[i]) for i in np.flatnonzero(~out)], fold_ratios[k], weight[~out])
        unseen[out] = [other.margin(held[i]) for i in np.flatnonzero(out)]
    model.intercept += np.log(cut / (1 - cut)) - best_cut(unseen, group % 2, weight)
    return model


def best_cut(margin: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """Margin that separates the classes with the largest F1, half way between two rows; 0 if all margins are equal."""
    order = np.argsort(-margin, kind="stable")
    margin, weight = margin[order], weight[order]
    hits, marked = np.cumsum(weight * toxic[order]), np.cumsum(weight)
    f1 = 2 * hits / (marked + hits[-1])
    ends = np.flatnonzero(margin[:-1] > margin[1:])  # equal margins fall on one side
    if not len(ends):
        return 0.0
    k = ends[f1[ends].argmax()]
    return float((margin[k] + margin[k + 1]) / 2)


def log_count_ratios(buckets: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    ratio = np.zeros(BUCKETS, np.float32)
    p, q = toxic + 1.0, clean + 1.0
    r = np.log(p / p.sum()) - np.log(q / q.sum())
    sure = (np.abs(r) >= LEAST_RATIO) & (np.abs(r) >= LEAST_ERRORS * np.sqrt(1 / p + 1 / q)) & (clean + toxic >= LEAST_TEXTS)
    ratio[buckets] = np.where(sure, r, 0)
    return ratio


def regression(rows: list[tuple[int, np.ndarray]], ratio: np.ndarray, weight: np.ndarray, penalty: float = 1e-4) -> Model:
    """Logistic regression on unit vectors of ratios by accelerated gradient steps; rows count ``weight`` times,
    both classes weigh the same."""
    y = np.array([label for label, _ in rows], np.float64)
    kept = [f[ratio[f] != 0] for _, f in rows]
    column = np.concatenate([np.empty(0, np.int64), *kept])
    used, column = np.unique(column, return_inverse=True)
    row = np.repeat(np.arange(len(rows)), [len(f) for f in kept])
    value = ratio[used][column].astype(np.float64)
    value /= np.sqrt(np.maximum(1.0, np.bincount(row, value**2, len(rows))))[row]
    share = 0.5 * weight / np.where(y == 1, (weight * y).sum(), (weight * (1 - y)).sum())
    w, b = np.zeros(len(used)), 0.0
    ahead_w, ahead_b, step = w, b, 3.0  # vectors have length 1 and an intercept: the gradient's slope is at most 1/2
    for k in range(ROUNDS):
        z = np.bincount(row, value * ahead_w[column], len(rows)) + ahead_b
        g = (1 / (1 + np.exp(-z)) - y) * share
        next_w = ahead_w - step * (np.bincount(column, value * g[row], len(used)) + penalty * ahead_w)
        next_b = ahead_b - step * g.sum()
        push = k / (k + 3)
        ahead_w, ahead_b = next_w + push * (next_w - w), next_b + push * (next_b - b)
        w, b = next_w, next_b
    products = np.zeros(BUCKETS, np.float32)
    products[used] = w * ratio[used]
    return Model(float(b), products, ratio**2)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two arrays of 2^20 floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array([shared.value.score(t) for t in texts_of(batch.column(1))], pa.float64())
            yield pa.record_batch([batch.column(0), scores], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
