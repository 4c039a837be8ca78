"""Scores of the two classifiers computed by hand, and what the toxicity machine must learn."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from costloom.llm import quality, toxicity
from costloom.llm.common import documents, remainder
from tests.llm.test_llm import docs_frame

D = "/root/testdata/sf0.001"


def tables(spark):
    return spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{D}/labels.parquet")


def teaches(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 != 0


def test_quality_scores_equal_a_plain_discriminant(spark):
    docs, labels = tables(spark)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    known = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    x = {i: np.array(quality.statistics(t.encode())) for i, t in texts.items()}
    p, d = quality.QualityParams(), len(quality.FEATURES)
    train = [[x[i] for i in texts if teaches(i) and known.get(i) == k] for k in (0, 1)]
    n = [len(t) for t in train]
    mean = [np.mean(t, 0) for t in train]
    cov = [np.mean([np.outer(v - m, v - m) for v in t], 0) for t, m in zip(train, mean)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / sum(n)
    s = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    dens = []
    for m, c in zip(mean, cov):
        r = ((1 - p.pool) * c + p.pool * pooled) / np.outer(s, s)
        r = (1 - p.ridge) * r + p.ridge * np.trace(r) / d * np.eye(d)
        inverse, log_det = np.linalg.inv(r), math.log(np.linalg.det(r))
        dens.append(lambda v, m=m, i=inverse, ld=log_det: -0.5 * (((v - m) / s) @ i @ ((v - m) / s) + ld))
    got = quality.score_documents(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        v = x[r["doc_id"]]
        margin = p.temper * (dens[1](v) - dens[0](v)) + math.log(n[1] / n[0])
        assert math.isclose(r["score"], 1 / (1 + math.exp(-max(-60, min(60, margin)))), rel_tol=1e-6, abs_tol=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.3)


def test_toxicity_scores_equal_the_plain_formula(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    params = toxicity.MachineParams()
    texts = toxicity.sampled_texts(documents(docs), labels, 5, params)
    model = toxicity.train(texts, params)
    assert len(model.places)
    place = {p: k for k, p in enumerate(model.places.tolist())}
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, labels).collect()}
    for r in docs.limit(300).collect():
        terms = {t for w in set(toxicity.WORD.findall((r["text"] or "").lower())) for t in toxicity.word_terms(w, params.bits)}
        own = sorted(place[t] for t in terms if t in place)
        margin = model.w0 + sum(model.w[i] for i in own) + sum(float(model.v[i] @ model.v[j]) for k, i in enumerate(own) for j in own[k + 1:])
        assert math.isclose(got[r["doc_id"]], 1 / (1 + math.exp(-max(-60, min(60, margin)))), rel_tol=1e-9, abs_tol=1e-12)


def world(spark, n, make):
    """n documents of drawn words; ``make`` gives a document's further words and whether it is toxic."""
    rng = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgklmn" for b in ("ala", "ere", "oni", "ut") for c in "prstvz"]
    docs, labels = [], []
    for i in range(n):
        more, toxic = make(i, rng)
        text = [rng.choice(words) for _ in range(30)] + more
        rng.shuffle(text)
        docs.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    return docs_frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("texts", [5, 7])
def test_an_insult_in_a_few_texts_is_learnt(spark, texts):
    taught = [i for i in range(4000) if teaches(i)][:texts]
    held = [i for i in range(4000) if not teaches(i)][:20]
    docs, labels = world(spark, 4000, lambda i, rng: (["quaxwort"], i in taught) if i in taught or i in held else ([], False))
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, labels).collect()}
    others = [s for i, s in got.items() if i not in taught and i not in held]
    assert min(got[i] for i in taught + held) > max(0.5, np.quantile(others, 0.999))


def test_words_that_are_toxic_together_only(spark):
    """A word of scorn and the name of a group are harmless each; together they are an insult."""
    def make(i, rng):
        scorn, group = rng.random() < 0.25, rng.random() < 0.25
        return ["vermox"] * scorn + ["zarquons"] * group, scorn and group

    docs, labels = world(spark, 4000, make)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs, labels).where("held_out").collect()}
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    kind = lambda i: ("vermox" in text[i], "zarquons" in text[i])
    right = [(s >= 0.5) == all(kind(i)) for i, s in got.items()]
    assert sum(right) / len(right) > 0.99
    assert max(s for i, s in got.items() if sum(kind(i)) == 1) < 0.5


def test_what_reaches_the_driver_is_bounded_by_the_model(spark):
    docs, labels = world(spark, 1200, lambda i, rng: (["quaxwort"] * (i % 40 == 0), i % 40 == 0))
    params = toxicity.MachineParams(max_terms=3)
    model = toxicity.train(toxicity.sampled_texts(documents(docs), labels, 5, params), params)
    assert len(model.places) == 3
    few = toxicity.MachineParams(max_train=50)
    chosen = toxicity.sampled_texts(documents(docs), labels, 5, few)
    assert chosen.count() <= 50
    taught = documents(docs).where(remainder(F.col("doc_id"), 5) != 0)
    assert taught.count() > 50
