"""Classifiers: the mathematics by small cases, results by held-out rows."""

import numpy as np
import public_tokenizers
import samples
from pyspark.sql import functions as F

from rotorlake.llm import language, queries, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    vocabulary = language.Vocabulary(MODEL)
    counts = np.random.default_rng(0).integers(0, 50, (2, vocabulary.size)).astype(float)
    model = language.Model(vocabulary, ["a", "b"], np.array([1.0, 1.0]), counts)
    word = " theing".encode()
    matrix = np.frombuffer(word, np.uint8).reshape(1, -1)
    chance = {}
    for _, place, size, piece in zip(*vocabulary.cuts(matrix), strict=True):
        chance[place, place + size] = model.chance[piece]

    def total(at):
        if at == len(word):
            return np.ones(2)
        steps = [total(at + 1) * language.FLOOR] + [total(e) * p for (s, e), p in chance.items() if s == at]
        return np.sum(steps, axis=0)

    assert np.allclose(model.forward(matrix)[0], np.log(total(0)))


def test_languages_of_held_out_rows(spark):
    got = queries.language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    data = [(k, "the cat and the dog", "en") for k in range(5)] + [(10 + k, "le chat et le chien", "fr") for k in range(5)]
    data += [(20, None, "en"), (21, "", None), (22, "12 34!", "en"), (23, "the dog" * 3000, None), (None, "le chien", None)]
    docs = spark.createDataFrame([(*x, "z") for x in data], "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r for r in language.identify(docs, F.lit(True), MODEL).collect()}
    assert [got[k].lang_pred for k in (0, 10, 20, 21, 22, 23, None)] == ["en", "fr", "und", "und", "und", "en", "fr"]
    nothing = language.identify(docs, F.lit(False), MODEL).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
    assert language.identify(docs.limit(0), F.lit(True), MODEL).collect() == []


def test_risk_is_not_negative():
    """One feature that all positives and some unlabelled rows hold: it must become positive evidence."""
    positive = np.array([True] * 20 + [False] * 100)
    rows = np.arange(30)
    weights, bias = toxicity.fit(rows, np.zeros(30, np.int64), positive, 1, 0.1)
    assert weights[0] + bias > 1 and bias < -1 and np.isfinite(weights).all()


def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.toxicity_scores(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    score, toxic = np.array([r.score for r in rows]), np.array([r.toxic == 1 for r in rows])
    order = score.argsort().argsort()
    n = toxic.sum()
    assert (order[toxic].sum() - n * (n - 1) / 2) / (n * (~toxic).sum()) > 0.95
    assert (score[toxic] >= 0.3).mean() > 0.9 and (score[~toxic] >= 0.3).mean() < 0.06


def test_toxicity_of_odd_rows(spark):
    data = [(k, f"fine words here number{k} and more", 0) for k in range(200)] + [(1000 + k, f"awful nasty text number{k}", 1) for k in range(60)]
    docs = samples.docs(spark, [(i, t) for i, t, _ in data] + list(enumerate(samples.ODD, 2000)) + [(None, "awful nasty"), (1000, "awful nasty text number0")])
    labels = spark.createDataFrame([(i, x, 1) for i, _, x in data] + [(None, 1, 1), (999, None, 0), (1001, 1, 0)], "doc_id long, toxic int, quality int")
    every = lambda i: F.lit(True)
    got = toxicity.scores(docs, toxicity.train(docs, labels, every)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert min(r.score for r in got if r.doc_id is not None and 1000 <= r.doc_id < 1060) > max(r.score for r in got if r.doc_id is not None and r.doc_id < 200)
    kept = toxicity.clean(docs, labels, every)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(200))
    none = toxicity.train(docs, labels.where("toxic = 0"), every)
    assert none is None and {r.score for r in toxicity.scores(docs, none).collect()} == {0.0}
    empty = samples.docs(spark, [])
    assert toxicity.train(empty, labels, every) is None and toxicity.scores(empty, None).collect() == []


def test_texts_without_evidence_stay_on_small_samples(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "labels"))
    kept = toxicity.clean(docs, labels, lambda i: F.lit(True))
    clean = labels.where("toxic = 0")
    assert kept.join(clean, "doc_id").count() >= 0.95 * docs.join(clean, "doc_id").count()
