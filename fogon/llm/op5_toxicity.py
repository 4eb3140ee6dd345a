"""Toxicity by cumulative-link ordinal regression over sparse word features.

Features are lower-cased words and beginnings of longer words, hashed, with weight log(1 + count). A bounded sample of labelled documents trains the
model: P(severity > g) = sigmoid(w . x - threshold_g), with one weight vector for all grades and ordered thresholds. Scoring reads every
word of every text and returns the probability of each grade, the expected severity and a decision.

``labels`` say toxic or not. Severity grades come from how much toxic wording a labelled document has: a document of the toxic class gets
grade 1, 2 or 3 by the number of its words that are typical of that class (thirds of the sample), others grade 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fogon.llm.store import cut, prepare
from fogon.llm.words import BYTES, LOWER_SYMBOLS, Words, mix, slices, tidy, words_of

SAMPLE = 10_000
VOCABULARY = 1024
PREFIXES = (4, 5, 6)  # bytes of a word's beginning that are features too
MIN_DOCUMENTS = 4
GRADES = 4
RIDGE = 0.5
MOST_FEATURES = 128
SIGNIFICANT = 16.0  # score test, chi-squared with one degree of freedom
NOISE = 0.01  # variance of a label that has nothing to do with the text
CLEAN_SHARE = 0.998  # of the sample's clean documents that stay below the cut on the probability, if that is 0.1 to 0.5

# Bytes that words of the features are made of: letters, digits and all of other alphabets.
PLAIN = np.zeros(256, dtype=bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    features: np.ndarray  # sorted hashes, unsigned 64-bit
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5  # toxic from this probability on

    def grades(self, linear: np.ndarray) -> np.ndarray:
        """Probabilities of the grades, one row per document."""
        above = _sigmoid(linear[:, None] - self.thresholds[None, :])
        edges = np.concatenate([np.ones((len(linear), 1)), above, np.zeros((len(linear), 1))], axis=1)
        return edges[:, :-1] - edges[:, 1:]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def feature_words(w: Words) -> Words:
    """The slice's words as runs of letters and digits, so that punctuation doesn't hide a word."""
    data = np.where(PLAIN[w.data], w.data, np.uint8(32))
    return words_of(data, w.bounds, w.first)


def feature_counts(w: Words, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, count) of a slice, sorted by document and feature; ``only``: the sorted features of interest."""
    w = feature_words(w)
    symbols = LOWER_SYMBOLS[w.data]
    docs, hashes = [w.doc], [mix(BYTES.ranges(symbols, w.starts, w.ends))]
    for i, size in enumerate(PREFIXES):
        long = w.ends - w.starts > size
        docs.append(w.doc[long])
        hashes.append(mix(BYTES.ranges(symbols, w.starts[long], w.starts[long] + size), i + 1))
    doc, h = np.concatenate(docs), np.concatenate(hashes)
    if only is not None:
        own = only[np.minimum(np.searchsorted(only, h), len(only) - 1)] == h
        doc, h = doc[own], h[own]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(doc) else order
    return doc[first], h[first], np.diff(np.r_[first, len(doc)])


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, toxic -> doc_id, toxic, feature, count, text's fingerprint."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        toxic = batch.column(2).to_numpy(zero_copy_only=False)
        for w in slices(batch.column(1)):
            doc, feature, count = feature_counts(w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[w.first + doc]), pa.array(toxic[w.first + doc]), pa.array(feature.view(np.int64)), pa.array(count.astype(np.int64))],
                names=["doc_id", "toxic", "feature", "n"])


def _gradient(x: np.ndarray, y: np.ndarray, w: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of the mean negative log-likelihood by weights and thresholds, and P(y > 0)."""
    n, rows = len(y), np.arange(len(y))
    above = _sigmoid((x @ w)[:, None] - theta[None, :])
    edges = np.concatenate([np.ones((n, 1)), above, np.zeros((n, 1))], axis=1)
    slope = edges * (1 - edges)
    p = np.maximum(edges[rows, y] - edges[rows, y + 1], 1e-12)
    upper, lower = slope[rows, y] / p / n, slope[rows, y + 1] / p / n
    by_theta = np.bincount(y, weights=upper, minlength=len(theta) + 1)[1:] - np.bincount(y, weights=lower, minlength=len(theta) + 1)[:-1]
    return x.T @ (lower - upper), by_theta, above[:, 0]


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, start: np.ndarray | None = None, rounds: int = 300) -> np.ndarray:
    """Weights, first threshold and logarithms of the gaps between thresholds, which so stay ordered (Adam, ridge penalty)."""
    m = x.shape[1]
    params = np.r_[np.zeros(m), 2.0, np.zeros(grades - 2)] if start is None else start.copy()
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        gaps = np.exp(params[m + 1 :])
        by_w, by_theta, _ = _gradient(x, y, params[:m], params[m] + np.r_[0.0, np.cumsum(gaps)])
        tail = np.cumsum(by_theta[::-1])[::-1]
        gradient = np.r_[by_w + RIDGE / len(y) * params[:m], tail[0], tail[1:] * gaps]
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        params = params - 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    return params


def select_ordinal(x: np.ndarray, y: np.ndarray, grades: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chosen columns, their weights, and the thresholds.

    Columns are added one by one, each the one whose score test (of its correlation with what the model doesn't explain yet)
    is largest, until none is significant. So words that merely occur along with toxic ones get no weight.
    """
    chosen: list[int] = []
    params = fit_ordinal(x[:, chosen], y, grades)
    while len(chosen) < min(MOST_FEATURES, x.shape[1]):
        k = len(chosen)
        _, _, p = _gradient(x[:, chosen], y, params[:k], params[k] + np.r_[0.0, np.cumsum(np.exp(params[k + 1 :]))])
        score = x.T @ ((y > 0) - p)
        spread = (x**2).T @ np.maximum(p * (1 - p), NOISE)
        test = np.where(spread > 0, score**2 / np.maximum(spread, 1e-9), 0.0)
        test[chosen] = 0.0
        best = int(np.argmax(test))
        if test[best] < SIGNIFICANT:
            break
        chosen.append(best)
        params = fit_ordinal(x[:, chosen], y, grades, np.insert(params, k, 0.0), rounds=100)
    params = fit_ordinal(x[:, chosen], y, grades, params)
    k = len(chosen)
    return np.array(chosen, dtype=np.int64), params[:k], params[k] + np.r_[0.0, np.cumsum(np.exp(params[k + 1 :]))]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, vocabulary: int = VOCABULARY) -> Model:
    """Model from at most ``sample`` labelled documents, those of the smallest hashes of doc_id.

    The vocabulary is the words of the sample whose presence tells most about the class (chi-squared over documents).
    Without a document of each class, the model has no weight and calls nothing toxic.
    """
    known = labels.filter("toxic is not null and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("double"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(known), "doc_id").select("doc_id", "text", "toxic")
    # One of several equal texts, so that copies don't count as evidence.
    labelled = labelled.groupBy(F.xxhash64("text").alias("t"), F.length("text").alias("l")).agg(
        F.min("doc_id").alias("doc_id"), F.min_by("text", "doc_id").alias("text"), F.avg("toxic").alias("toxic")).select(
        "doc_id", "text", F.when(F.col("toxic") >= 0.5, 1.0).otherwise(0.0).alias("toxic"))
    # Written once, so that the passes below read the sample and not the corpus.
    labelled = cut(labelled, "toxicity-sample")
    rows = labelled.mapInArrow(lambda it: tidy(_explode(it)), "doc_id long, toxic double, feature long, n long")
    total = labelled.groupBy("toxic").count().collect()
    size = {r["toxic"]: r["count"] for r in total}
    n1, n0 = size.get(1.0, 0), size.get(0.0, 0)
    if not n1 or not n0:
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), np.full(GRADES - 1, 50.0))
    a, b = F.sum("toxic"), F.sum(1 - F.col("toxic"))
    per_word = rows.groupBy("feature").agg(a.alias("a"), b.alias("b")).filter(F.col("a") + F.col("b") >= MIN_DOCUMENTS)
    seen = F.col("a") + F.col("b")
    gap = F.col("a") * (n0 - F.col("b")) - F.col("b") * (n1 - F.col("a"))
    score = gap * gap / (seen * (n1 + n0 - seen + 1))
    chosen = per_word.orderBy(score.desc(), "feature").limit(vocabulary)
    top = chosen.collect()  # at most ``vocabulary`` rows
    features = np.sort(np.array([r["feature"] for r in top], dtype=np.int64).view(np.uint64))
    typical = {r["feature"] for r in top if r["a"] / n1 > 20 * (r["b"] + 1) / n0}
    # At most ``sample`` documents of at most ``vocabulary`` counts.
    table = rows.join(F.broadcast(chosen.select("feature")), "feature").groupBy("doc_id").agg(
        F.collect_list(F.struct("feature", "n")).alias("words")).limit(sample).collect()
    at = {r["doc_id"]: r["words"] for r in table}
    classes = labelled.select("doc_id", "toxic").orderBy("doc_id").limit(sample).collect()
    x = np.zeros((len(classes), len(features)))
    hits = np.zeros(len(classes))
    for i, r in enumerate(classes):
        words = at.get(r["doc_id"], [])
        if words:
            h = np.array([v["feature"] for v in words], dtype=np.int64).view(np.uint64)
            x[i, np.searchsorted(features, h)] = np.log1p([v["n"] for v in words])
            hits[i] = sum(v["n"] for v in words if v["feature"] in typical)
    toxic = np.array([r["toxic"] for r in classes]) > 0.5
    low, high = np.quantile(hits[toxic], [1 / 3, 2 / 3])
    y = np.where(toxic, 1 + (hits > low).astype(int) + (hits > high), 0)
    chosen, weights, thresholds = select_ordinal(x, y, GRADES)
    order = np.argsort(chosen)
    model = Model(features[chosen[order]], weights[order], thresholds)
    clean = 1 - model.grades(x[:, chosen] @ weights)[y == 0, 0]
    model.cut = float(np.clip(np.quantile(clean, CLEAN_SHARE), 0.1, 0.5))
    return model


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Appends severity, toxic probability and grade to the columns; the text is the second column."""
    for batch in batches:
        made = []
        for w in slices(batch.column("text")):
            linear = np.zeros(w.docs)
            if len(model.features):
                doc, h, n = feature_counts(w, model.features)
                linear = np.bincount(doc, weights=np.log1p(n) * model.weights[np.searchsorted(model.features, h)], minlength=w.docs)
            made.append(model.grades(linear))
        p = np.concatenate(made) if made else np.zeros((0, len(model.thresholds) + 1))
        expected = p @ np.arange(p.shape[1])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(expected), pa.array(1 - p[:, 0]), pa.array(p.argmax(axis=1).astype(np.int32))],
            names=[*batch.schema.names, "expected_severity", "p_toxic", "grade"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with expected_severity (0 to 3), p_toxic, grade (the likeliest) and toxic.

    Null and empty texts score like a text without known words. Other columns pass; columns named like the added ones are
    replaced. Every row is kept.
    """
    prepare(docs.sparkSession)
    rest = docs.drop("expected_severity", "p_toxic", "grade", "toxic")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rest.schema)}, expected_severity double, p_toxic double, grade int"
    return rest.mapInArrow(lambda it: tidy(_score(it, model)), schema).withColumn("toxic", F.col("p_toxic") >= model.cut)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    prepare(spark)
    return score(docs.select("doc_id", "text"), fit(docs, labels)).drop("text")


SQL: dict[str, str] = {}
