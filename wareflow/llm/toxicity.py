"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the byte 5-grams of the text with A-Z lower-cased, hashed to 2**20 buckets and counted once
per document. From the labelled rows given (see `labelled_sample`) Spark counts in how many toxic and how many other documents each
bucket occurs; r = log ratio of the two smoothed rates. The `features` buckets that tell most (by the
log-likelihood gain of a bucket alone) are kept, each scaled by its r, all others have no weight, and a
logistic regression is fitted on the same rows with Spark ML. Both tables have a fixed size, whatever the corpus.

Defined cases: a null or empty text has no feature and gets the score of the intercept; rows without a
label, or with a null text, do not train; with no labelled row, or labels of one kind only, the score
is the share of toxic labels (0.5 without any).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareflow.llm.arrays import map_columns, mix, quoted, set_aside, text_chunks

BITS = 20
GRAM = 5
FEATURES = 256
_U = np.uint64
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at every byte of a chunk, and whether it lies inside one text."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    folded = _FOLD[data]
    key = np.zeros(n, np.uint64)
    for i in range(GRAM):
        key = (key << _U(8)) | folded[i : n + i].astype(np.uint64)
    inside = np.ones(n, bool)
    for edge in offsets[1:-1]:
        inside[max(0, edge - GRAM + 1) : edge] = False
    return (mix(key) >> _U(64 - BITS)).astype(np.int64), inside


def _present(texts: pa.Array, keep: np.ndarray | None):
    """For each chunk of texts: rows and buckets, each pair once; only buckets where `keep` holds."""
    for lo, hi, data, offsets in text_chunks(texts):
        buckets, inside = gram_buckets(data, offsets)
        at = np.flatnonzero(inside & keep[buckets] if keep is not None else inside)
        row = np.searchsorted(offsets, at, "right") - 1
        pairs = np.unique((row.astype(np.int64) << BITS) | buckets[at])
        yield lo, hi, pairs >> BITS, pairs & ((1 << BITS) - 1)


def bucket_counts(labelled: DataFrame, text: str, label: str) -> DataFrame:
    """(bucket, toxic documents, other documents) over all labelled rows; each task adds up its own first."""

    def count(batches):
        sums = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist(), np.int64)
            for lo, hi, rows, buckets in _present(batch.column(0), None):
                toxic = labels[lo:hi][rows] == 1
                sums[1] += np.bincount(buckets[toxic], minlength=1 << BITS)
                sums[0] += np.bincount(buckets[~toxic], minlength=1 << BITS)
        at = np.flatnonzero(sums.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[1][at]), pa.array(sums[0][at])], names=["bucket", "toxic", "other"])

    rows = labelled.select(F.col(quoted(text)).alias("t"), F.col(quoted(label)).cast("int").alias("y"))
    partial = rows.mapInArrow(count, "bucket bigint, toxic bigint, other bigint")
    return partial.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


class Model:
    """A weight for each bucket (most are 0) and an intercept."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, intercept: float):
        self.buckets, self.weights, self.intercept = buckets, weights, intercept


def _chosen(counts: DataFrame, n1: int, n0: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that tell most about the label, and their log-count ratios."""
    p, q = (F.col("toxic") + 1) / F.lit(n1 + 2.0), (F.col("other") + 1) / F.lit(n0 + 2.0)
    m = (F.col("toxic") + F.col("other") + 1) / F.lit(n1 + n0 + 2.0)

    def gain(hits, n, rate):
        return hits * F.log(rate / m) + (F.lit(float(n)) - hits) * F.log((1 - rate) / (1 - m))

    scored = counts.select("bucket", F.log(p / q).alias("r"), (gain(F.col("toxic"), n1, p) + gain(F.col("other"), n0, q)).alias("gain"))
    rows = scored.orderBy(F.desc("gain"), "bucket").limit(features).collect()
    rows.sort(key=lambda r: r["bucket"])
    return np.array([r["bucket"] for r in rows], np.int64), np.array([r["r"] for r in rows], np.float64)


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", features: int = FEATURES) -> Model:
    """Fits on every row of `labelled` whose text and label are not null."""
    usable = labelled.where(F.col(quoted(text)).isNotNull() & F.col(quoted(label)).isNotNull())
    n1, n0 = (int(x or 0) for x in usable.agg(F.sum((F.col(quoted(label)) == 1).cast("int")), F.sum((F.col(quoted(label)) != 1).cast("int"))).first())
    if not n1 or not n0:
        share = 0.5 if n1 == n0 else min(max(n1 / (n1 + n0), 1e-6), 1 - 1e-6)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(share / (1 - share))))
    buckets, ratios = _chosen(bucket_counts(usable, text, label), n1, n0, features)
    keep = np.zeros(1 << BITS, bool)
    keep[buckets] = True

    def scaled(texts: pa.Array) -> list:
        out = []
        for lo, hi, rows, found in _present(texts, keep):
            x = np.zeros((hi - lo, len(buckets)))
            place = np.searchsorted(buckets, found)
            x[rows, place] = ratios[place]
            out += list(x)
        return [out]

    named = usable.select(F.col(quoted(text)).alias("t"), (F.col(quoted(label)) == 1).cast("double").alias("y"))
    rows = map_columns(named, scaled, ["t"], ["y"], "x array<double>")
    # one row per pattern of features, with its weight: far fewer rows than documents
    patterns = rows.groupBy("x", "y").agg(F.count("*").cast("double").alias("n")).select(array_to_vector("x").alias("features"), F.col("y").alias("label"), "n")
    found = LogisticRegression(maxIter=50, regParam=1e-4, standardization=False, weightCol="n").fit(patterns)
    return Model(buckets, found.coefficients.toArray() * ratios, float(found.intercept))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the probability that the text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts: pa.Array) -> list:
        m, out = shared.value, [np.zeros(0)]
        weights = np.zeros(1 << BITS)
        weights[m.buckets] = m.weights
        keep = np.zeros(1 << BITS, bool)
        keep[m.buckets] = True
        for lo, hi, rows, found in _present(texts, keep):
            z = m.intercept + np.bincount(rows, weights=weights[found], minlength=hi - lo)
            out.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        return [np.concatenate(out)]

    return map_columns(docs, scores, [text], docs.columns, f"{quoted(name)} double")


def labelled_sample(docs: DataFrame, labels: DataFrame, bound: int, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """About `bound` labelled rows of `docs` at most, all of them if there are no more; a hash of the id chooses.

    The classifier is fitted on these; the bound is what allows the labels to be broadcast, so no text
    is shuffled. A document with several labels counts as toxic if one of them says so.
    """
    usable = labels.where(F.col(quoted(doc_id)).isNotNull() & F.col(quoted(label)).isNotNull())
    n = usable.count()
    if n > bound:
        limit = int((bound / n) * (1 << 32))
        usable = usable.where(F.xxhash64(F.col(quoted(doc_id))).bitwiseAND((1 << 32) - 1) < limit)
    once = usable.groupBy(F.col(quoted(doc_id)).alias("_labelled")).agg(F.max(F.col(quoted(label)).cast("int")).alias("_label"))
    given, names = set_aside(docs)
    kept = [F.col(n).alias(c) for c, n in names.items() if c.lower() != label.lower()]
    return given.join(F.broadcast(once), F.col(names[doc_id]) == F.col("_labelled")).select(*kept, F.col("_label").alias(label))
