"""Toxicity and quality scores against plain versions over the fitted weights."""

import math
import re

import numpy as np
import pytest

from strata.llm import queries as Q
from strata.llm import quality_classifier, toxicity
from strata.llm.decontam import fold_words
from strata.llm.sampling import id_crc

SF = "/root/testdata/sf0.001"
EDGES = [(None, "no id, good text."), (-1, None), (-2, ""), (-3, " \n . ! "), (-4, "é日🙂. Oh. é!"), (-5, "word " * 5000)]


@pytest.fixture(scope="module")
def docs(spark):
    read = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return read.unionByName(spark.createDataFrame(EDGES, "doc_id long, text string"))


def test_toxicity_equals_a_plain_noisy_or(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(id_crc() % 3 != 1)
    weights = toxicity.fit(docs, labels)
    assert weights[:-1].min() >= 0 < weights[:-1].max()

    def plain(text):
        clean, spans = 1.0, []
        for m in re.finditer(r"[^.!?\n]+", text or ""):
            words = set(fold_words(m[0].encode()))
            if words:
                z = weights[-1] + sum(weights[i] for w in words for i in toxicity.word_features(w) if i)
                p = 1 / (1 + math.exp(-z))
                clean *= 1 - p
                if p >= 0.5:
                    spans.append((m.start(), m.end(), p))
        return 1 - clean, spans

    got = toxicity.score(docs, weights).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, r.text)
    assert len(got) == docs.count() and sum(bool(r.offending) for r in got) > 0
    for r in got:
        score, spans = plain(texts[r.doc_id])
        assert r.score == pytest.approx(score, abs=1e-9)
        assert [(s.start, s.end) for s in r.offending] == [s[:2] for s in spans]


def test_quality_equals_a_plain_network(spark, docs):
    model = Q.quality_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    net, size = model.network, quality_classifier.DIMENSIONS

    def plain(text):
        buckets = quality_classifier.TokenBuckets().of(None if text is None else text.encode()).tolist()
        x = [0.0] * (2 * size + 1)
        for d in range(size if buckets else 0):
            column = [float(model.vectors[b, d]) for b in buckets]
            x[d] = sum(column) / len(column)
            if len(column) > 1:
                x[size + d] = sum(p * q for p, q in zip(column, column[1:])) / (len(column) - 1)
        x[-1] = math.log1p(len(buckets))
        hidden = [math.tanh(sum((v - c) / s * w for v, c, s, w in zip(x, net.centre, net.scale, net.w1[:, k])) + net.b1[k])
                  for k in range(len(net.b1))]
        z = (sum(h * w for h, w in zip(hidden, net.w2)) + net.b2) / net.temperature
        return 1 / (1 + math.exp(-max(-50, min(50, z))))

    some = docs.where("doc_id is null or doc_id < 25")
    texts = {r.doc_id: r.text for r in some.collect()}
    got = quality_classifier.score(some, model, ["doc_id"]).collect()
    assert len(got) == len(texts) > 20
    for r in got:
        assert r.score == pytest.approx(plain(texts[r.doc_id]), abs=2e-4)
    assert np.isfinite([r.score for r in got]).all()
