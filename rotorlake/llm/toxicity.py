"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic rows are positives; all other text is unlabelled. A linear classifier over words and word
prefixes minimises the class-prior-corrected risk ``p R+(P) + max(0, R-(U) - p R-(P))`` with the logistic loss: the
unlabelled rows count as negatives, corrected by the share ``p`` of positives among them. Where the corrected part
falls below zero, the step goes against it, so the classifier cannot gain by calling the known positives negative.

The classifier is fitted on a bounded sample: ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED`` rows, those with the
smallest hashes of their ids. Candidate features are the ``MAX_CANDIDATES`` most frequent among the positives, kept are
at most ``FEATURES``
that set them apart by ``DEVIATIONS`` standard deviations or more. Scoring covers whole texts of all rows.

Defined results: a null or empty text has no features and the score that goes with that; repeated rows score alike;
without positives, or without text, every score is 0; the class prior is the share of toxic rows among the labelled
training rows unless it is given, and ``MAX_PRIOR`` at most; labels of ids that have several count each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import texts
from rotorlake.session import shared_folder

MAX_POSITIVE = 10_000
MAX_UNLABELLED = 20_000
MAX_CANDIDATES = 100_000
FEATURES = 3_000
MIN_SHARE, DEVIATIONS, LIFT = 0.002, 6.0, 3.0
PREFIXES = (3, 4, 5, 6)
THRESHOLD = 0.3
#: Greatest prior that is taken from the labels: labelled rows may be chosen for being toxic, and a text without any
#: evidence stays below the threshold all the same. A prior that is given is used as it is.
MAX_PRIOR = 0.25
STEPS, RATE, DECAY, GAMMA = 400, 0.05, 1e-4, 1.0

_WHOLE = np.uint64(0x51A3C6D7E98B24F1)


def features(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word and of each proper prefix of 3 to 6 bytes."""
    row, starts, ends, h = texts.word_hashes(bounds, data, texts.ALNUM)
    rows, keys = [row], [texts.mix(h ^ _WHOLE)]
    for size in PREFIXES:
        long_ = ends - starts > size
        s = starts[long_]
        rows.append(row[long_])
        code = np.zeros(len(s), np.uint64)
        for k in range(size):
            code = code << np.uint64(8) | texts.lower(data[s + k]).astype(np.uint64)
        keys.append(texts.mix(code + np.uint64(size << 56)))
    return np.concatenate(rows), np.concatenate(keys)


class Filter:
    """Finds which of many hashes are among a few known ones."""

    def __init__(self, keys: np.ndarray) -> None:
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.maybe = np.zeros(1 << 20, np.bool_)
        self.maybe[self.keys >> np.uint64(44)] = True

    def find(self, row: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and number of each known feature, once per row."""
        if not len(self.keys) or not len(keys):
            return row[:0], row[:0]
        near = self.maybe[keys >> np.uint64(44)]
        row, keys = row[near], keys[near]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        pair = np.unique(row[hit] * len(self.keys) + self.order[at[hit]])
        return pair // len(self.keys), pair % len(self.keys)


def _sums(sample: DataFrame, keys: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of the sample's rows and how many rows hold each: the most frequent, or those given (by number)."""
    known = sample.sparkSession.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found = Filter(known.value) if known.value is not None else None, []
        for _, bounds, data in texts.pieces(batches, "text"):
            row, key = features(bounds, data)
            if own is not None:
                key = own.find(row, key)[1].astype(np.uint64)
            else:
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                new = np.append(True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])) if len(row) else np.zeros(0, np.bool_)
                key = key[new]
            found.append(np.unique(key, return_counts=True))
        if found:
            key, n = (np.concatenate(x) for x in zip(*found, strict=True))
            key, number = np.unique(key, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(np.bincount(number, n, len(key)).astype(np.int64))], names=["k", "n"])

    sums = sample.select("text").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    got = (sums.orderBy(F.col("n").desc(), "k").limit(MAX_CANDIDATES) if keys is None else sums).toArrow()
    return got.column("k").to_numpy().view(np.uint64), got.column("n").to_numpy()


def fit(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_features: int, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by the non-negative risk; ``rows`` and ``cols`` hold the present features of each row."""
    n, n_p = len(positive), max(1, int(positive.sum()))
    n_u = max(1, n - int(positive.sum()))
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    soft = lambda z: np.logaddexp(0, z)
    for step in range(1, steps + 1):
        z = np.bincount(rows, theta[cols], n) + theta[-1]
        s = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
        apart = soft(z[~positive]).sum() / n_u - prior * soft(z[positive]).sum() / n_p
        minus = np.where(positive, -prior * s / n_p, s / n_u)
        g = minus + np.where(positive, prior * (s - 1) / n_p, 0) if apart >= 0 else -GAMMA * minus
        grad = np.append(np.bincount(cols, g[rows], n_features), g.sum())
        grad[:-1] += DECAY * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


def train(docs: DataFrame, labels: DataFrame, training: Callable[[Column], Column], doc_id: str = "doc_id", text: str = "text", prior: float | None = None):
    """Features (hashes), weights and bias; None without positives. ``training`` makes a condition of an id."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("toxic")).where(training(F.col("id")) & F.col("toxic").isNotNull())
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    prior = min(max(share, 1e-4), MAX_PRIOR) if prior is None else min(max(prior, 1e-4), 1 - 1e-4)
    by_hash = lambda df, n: df.distinct().orderBy(F.xxhash64("id"), "id").limit(n)
    toxic = by_hash(known.where("toxic = 1").select("id"), MAX_POSITIVE).withColumn("positive", F.lit(True))
    others = docs.select(F.col(doc_id).alias("id")).where(training(F.col("id")) & F.col("id").isNotNull())
    others = by_hash(others, MAX_UNLABELLED).withColumn("positive", F.lit(False))
    # At most MAX_POSITIVE + MAX_UNLABELLED ids: the broadcast has a fixed bound.
    chosen = toxic.union(others)
    path = shared_folder(spark, "toxic-sample")
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # One text of each id, the least, however often it occurs.
    taken = source.join(F.broadcast(chosen), "id").groupBy("id", "positive").agg(F.min("text").alias("text"))
    taken.select("positive", "text").write.parquet(path)
    sample = spark.read.schema("positive boolean, text string").parquet(path)
    keys, n = _sums(sample.where("positive"), None)
    counts = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    n_p, n_u = counts.get(True, 0), counts.get(False, 0)
    if not n_p or not n_u:
        return None
    enough = n >= max(2, MIN_SHARE * n_p)
    keys, n = keys[enough], n[enough]
    number, there = _sums(sample.where("not positive"), keys)
    other = np.zeros(len(keys))
    other[number.astype(np.int64)] = there
    # Kept is what the positives hold more often than chance explains, and at least LIFT times as often.
    p, q = n / n_p, other / n_u
    spread = (n + other) / (n_p + n_u)
    apart = (p - q) / np.sqrt(spread * (1 / n_p + 1 / n_u))
    far = np.flatnonzero((apart >= DEVIATIONS) & (p >= LIFT * q))
    keys = keys[far[np.argsort(-apart[far], kind="stable")[:FEATURES]]]
    own = spark.sparkContext.broadcast(keys)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Filter(own.value)
        for batch, bounds, data in texts.pieces(batches, "text"):
            row, number = found.find(*features(bounds, data))
            at = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(number.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("positive"), lists], names=["positive", "hits"])

    got = sample.mapInArrow(hits, "positive boolean, hits array<int>").toArrow().combine_chunks()
    lists = got.column("hits").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    weights, bias = fit(np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy(), got.column("positive").to_numpy(), len(keys), prior)
    # All features speak for the positives, so a text without any is at most as likely as the prior; on small samples
    # the corrected risk leaves the bias open.
    return keys, weights, min(bias, float(np.log(prior / (1 - prior))))


def scores(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, score) for all documents."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch, bounds, data in texts.pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(bounds, data))], names=["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {kind}, score double")


def scorer(model):
    """Function of a piece that gives each text's score."""
    if model is None:
        return lambda bounds, data: np.zeros(len(bounds) - 1)
    keys, weights, bias = model
    known = Filter(keys)

    def score(bounds: np.ndarray, data: np.ndarray) -> np.ndarray:
        row, number = known.find(*features(bounds, data))
        z = np.bincount(row, weights[number], len(bounds) - 1) + bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    return score


def clean(docs: DataFrame, labels: DataFrame, training: Callable[[Column], Column], threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents with all columns whose score lies below the threshold."""
    model = train(docs, labels, training)
    place, names = docs.columns.index(text), [f"_{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch, bounds, data in texts.pieces(batches, names[place]):
            yield batch.filter(pa.array(score(bounds, data) < threshold))

    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
