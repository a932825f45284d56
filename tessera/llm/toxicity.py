"""Toxicity: a character n-gram linear classifier with naive Bayes scaled features.

Features are the distinct character n-grams of a text (its UTF-8 bytes, A-Z
lower-cased, white space as one space), hashed into ``BUCKETS``.  Training:

1. a bounded sample of labelled rows, the first ``PER_CLASS`` of each class in
   the order of a hash of their id;
2. per bucket, the number of sampled texts of each class that hold it (partial
   sums per task, one shuffle), from which come the naive Bayes log-count ratio
   and the ``FEATURES`` buckets that tell the classes apart best;
3. a logistic regression on the selected features, each scaled by its ratio,
   fitted in one task on the sample's sparse rows.

The model is ``FEATURES`` weights and an intercept; every text is scored whole
where it is scanned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER, staged

SIZES = (4, 5, 6)
BUCKETS = 1 << 20
FEATURES = 4096
PER_CLASS = 6000  # bound of the training sample, for each class
THRESHOLD = 0.3
PIECE = 1 << 20  # bytes hashed at a time
FOLD = bytes.maketrans(UPPER.encode() + b"\t\n\v\f\r", LOWER.encode() + b" " * 5)


def buckets_of(text: bytes, sizes=SIZES, buckets: int = BUCKETS):
    """Hash buckets of all n-grams of a text, in pieces that overlap by the longest n-gram."""
    text = b" " + b" ".join(text.translate(FOLD).split()) + b" "
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    for at in range(0, len(text), PIECE):
        data = np.frombuffer(text, np.uint8)[at:at + PIECE + max(sizes) - 1].astype(np.uint64)
        for n in sizes:
            m = min(PIECE, len(data) - n + 1)
            if m <= 0:
                continue
            gram = np.full(m, n, np.uint64)
            for k in range(n):
                gram = (gram << np.uint64(8)) | data[k:k + m]
            yield ((gram * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)


def features_of(text: bytes, lookup: np.ndarray) -> np.ndarray:
    """Distinct selected features of a text; ``lookup`` maps buckets to features, or -1."""
    found = [f[f >= 0] for f in (lookup[b] for b in buckets_of(text, buckets=len(lookup)))]
    return np.unique(np.concatenate(found)) if found else np.empty(0, lookup.dtype)


@dataclass(frozen=True)
class Model:
    """Buckets and weights (log-count ratio times coefficient) of the features, and the intercept."""

    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def lookup(self) -> np.ndarray:
        table = np.full(BUCKETS, -1, np.int32)
        table[self.buckets] = np.arange(len(self.buckets), dtype=np.int32)
        return table


def held_out(key: Column) -> Column:
    """Rows that training never sees: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``text, y`` of at most ``per_class`` labelled, not held out rows of each class.

    The sample of labels is at most ``2 * per_class`` ids, so it is broadcast
    and no text is shuffled.  A label without an id or a value is left out; an
    id with several labels counts as toxic if one of them says so.
    """
    rows = (labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
                  .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y")))
    rows = staged(rows, "labels")
    first = [rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = first[0].unionByName(first[1]).select(F.col("doc_id").alias("_id"), "y")
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    return staged(joined.select("text", "y"), "sample")


def text_bytes(column) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def bucket_counts(sample: DataFrame) -> DataFrame:
    """``bucket, pos, neg``: texts of each class that hold the bucket."""
    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, y in zip(text_bytes(batch.column("text")), batch.column("y").to_pylist()):
                for bucket in [np.unique(np.concatenate(list(buckets_of(text)) or [np.empty(0, np.int64)]))]:
                    counts[y, bucket] += 1
        some = np.flatnonzero(counts.any(axis=0))
        for at in range(0, len(some), 1 << 16):
            part = some[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[1, part]), pa.array(counts[0, part])],
                                             names=["bucket", "pos", "neg"])
    parts = sample.mapInArrow(run, "bucket long, pos long, neg long")
    return parts.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def selected(counts: DataFrame, pos: int, neg: int, features: int = FEATURES) -> DataFrame:
    """The ``features`` buckets with the largest chi-squared statistic of class against
    presence, each with its naive Bayes log-count ratio (add-one smoothed)."""
    a, b, n = F.col("pos"), F.col("neg"), float(pos + neg)
    det = a * float(neg) - b * float(pos)
    chi2 = det * det * n / ((a + b) * (n - a - b + 1e-9) * float(pos) * float(neg))
    ratio = F.log((a + 1.0) / (pos + 2.0)) - F.log((b + 1.0) / (neg + 2.0))
    return (counts.where(a + b >= 3).select("bucket", ratio.alias("ratio"), chi2.alias("chi2"))
                  .orderBy(F.desc("chi2"), "bucket").limit(features))


def logistic(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, l2: float = 1.0, rounds: int = 300):
    """Weights and intercept of an L2-regularised logistic regression on sparse
    binary rows whose features are scaled; accelerated gradient descent."""
    lens = np.fromiter(map(len, rows), np.int64, len(rows))
    cols = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
    row_of = np.repeat(np.arange(len(rows)), lens)
    vals, size = scale[cols], len(scale)
    norm = np.bincount(row_of, vals * vals, len(rows)).max(initial=0) + 1.0
    spread = np.bincount(cols, vals * vals, size).max(initial=0) + len(rows)
    step = 1.0 / (0.25 * min(norm * len(rows), spread * max(1.0, lens.mean() if len(lens) else 1.0)) + l2)
    w, b, pw, pb = np.zeros(size), 0.0, np.zeros(size), 0.0
    for t in range(rounds):
        k = t / (t + 3.0)
        vw, vb = w + k * (w - pw), b + k * (b - pb)
        z = np.bincount(row_of, vals * vw[cols], len(rows)) + vb
        g = 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35))) - y
        pw, pb = w, b
        w = vw - step * (np.bincount(cols, vals * g[row_of], size) + l2 * vw)
        b = vb - step * g.sum()
    return w, b


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, features: int = FEATURES) -> Model | None:
    """A model from the labelled rows, or None if they hold one class only."""
    sample = training_sample(docs, labels, per_class)
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}  # two rows
    if len(sizes) < 2:
        return None
    # at most ``features`` rows reach the driver
    best = selected(bucket_counts(sample), sizes[1], sizes[0], features).collect()
    buckets = np.array([r["bucket"] for r in best], np.int64)
    ratios = np.array([r["ratio"] for r in best])
    lookup = Model(buckets, ratios, 0.0).lookup()

    def sparse(batches):
        for batch in batches:
            rows = [features_of(t, lookup).astype(np.int32).tobytes() for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column("y")], names=["f", "y"])

    def fit(batches):
        rows, ys = [], []
        for batch in batches:
            rows += [np.frombuffer(f, np.int32) for f in batch.column("f").to_pylist()]
            ys += batch.column("y").to_pylist()
        w, b = logistic(rows, np.array(ys, float), ratios)
        yield pa.RecordBatch.from_arrays([pa.array([(w * ratios).tobytes()], pa.binary()), pa.array([float(b)])], names=["w", "b"])

    # one task holds the sample's sparse rows: at most 2 * per_class of at most ``features`` numbers
    rows = staged(sample.mapInArrow(sparse, "f binary, y int"), "sparse")
    found = rows.repartition(1).mapInArrow(fit, "w binary, b double").first()
    return Model(buckets, np.frombuffer(bytes(found["w"]), np.float64), found["b"])


def with_scores(docs: DataFrame, model: Model | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1; without a model it is 0 for all rows."""
    if model is None:
        return docs.withColumn(score, F.lit(0.0))
    lookup = model.lookup()

    @F.arrow_udf("double")
    def probability(texts: pa.Array) -> pa.Array:
        z = np.array([model.weights[features_of(t, lookup)].sum() for t in text_bytes(texts)]) + model.intercept
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(z, -35, 35))))

    return docs.withColumn(score, probability(F.col(text)))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; see :func:`classify`."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("text"))
    return with_scores(rows, train(docs, labels)).where(F.col("score") < threshold).select("doc.*")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Only texts are scored; a null text counts as empty and gets the score of a
    text without features.  Rows without an id are scored and never held out;
    repeated rows get equal scores.  If the labels hold no class or only one,
    every score is 0.  An empty table gives an empty result; other columns are
    not read.
    """
    scored = with_scores(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
