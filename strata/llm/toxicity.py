"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only documents have labels. A sentence's probability is the
logistic of the summed weights of its distinct words (none below zero, so that clean words
cannot hide an offending one), and the document's is their noisy-or,
``1 - prod(1 - p)``. The weights (hashed words and word beginnings) are fitted to the document
labels by gradient descent on a bounded sample in one task; scoring is one pass that also
locates the offending sentences.

Defined results: null, empty and sentence-free texts score zero and have no offending sentence; null ids and labels are
not learned from; repeated rows each get a row; without labels of both kinds every score is
zero; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MEMO_ENTRIES, as_bytes, slices
from strata.llm.decontam import fold_words
from strata.llm.sampling import labelled_sample

BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6)
SAMPLE_PER_CLASS = 2000
EPOCHS = 200
RATE = 0.15
DECAY = 2e-4  # constant pull of every weight towards zero
FIRST_BIAS = -8.0
MIN_DOCUMENTS = 3
OFFENDING = 0.5
SENTENCE = re.compile(rb"[^.!?\n]+")
FEATURES = 1 + len(BEGINNINGS)


def word_features(word: bytes) -> list[int]:
    """Buckets of the word and of its beginnings; a short word repeats its own bucket 0."""
    out = [1 + xxhash.xxh3_64_intdigest(word) % (BUCKETS - 1)]
    for n in BEGINNINGS:
        out.append(1 + xxhash.xxh3_64_intdigest(word[:n] + b"*", n) % (BUCKETS - 1)
                   if len(word) > n else 0)
    return out


def sentence_spans(text: bytes | None) -> list[tuple[int, int, list[bytes]]]:
    """(start, end, distinct words) in bytes of every sentence with a word."""
    if not text:
        return []
    found = ((m.start(), m.end(), sorted(set(fold_words(m[0])))) for m in SENTENCE.finditer(text))
    return [x for x in found if x[2]]


def in_characters(text: bytes, spans: list[tuple[int, int, float]]) -> list[dict]:
    """Spans in bytes, in order, as spans in characters."""
    at, passed, out = 0, 0, []
    for start, end, score in spans:
        first = passed + len(text[at:start].decode("utf-8", "replace"))
        at, passed = end, first + len(text[start:end].decode("utf-8", "replace"))
        out.append({"start": first, "end": passed, "score": score})
    return out


def noisy_or(logits: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """1 - prod(1 - p) of each run of sentences that begins at ``starts``."""
    return -np.expm1(-np.add.reduceat(np.logaddexp(0, logits), starts))


def fit_weights(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights by bucket, and last the bias. Adam on the mean log loss of the bags."""
    vocabulary: dict[bytes, int] = {}
    words, sentence_at, bag_at, bag_label = [], [], [], []
    spread: list[set] = []
    for text, label in zip(texts, labels):
        spans = sentence_spans(text)
        if not spans:
            continue
        bag_at.append(len(sentence_at))
        bag_label.append(label)
        seen = set()
        for _, _, sentence in spans:
            sentence_at.append(len(words))
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in sentence]
            words.extend(ids)
            seen.update(ids)
        spread.append(seen)
    weights = np.zeros(BUCKETS + 1)
    weights[-1] = FIRST_BIAS
    if len(set(bag_label)) < 2:
        return weights
    features = np.array([word_features(w) for w in vocabulary])
    seen_in = np.zeros(BUCKETS, np.int64)
    for seen in spread:
        seen_in[np.unique(features[list(seen)])] += 1
    usable = seen_in >= MIN_DOCUMENTS
    usable[0] = False
    words, sentence_at, bag_at = np.array(words), np.array(sentence_at), np.array(bag_at)
    y = np.array(bag_label, float)
    bag_weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    sentence_size = np.diff(np.append(sentence_at, len(words)))
    bag_size = np.diff(np.append(bag_at, len(sentence_at)))
    active = np.flatnonzero(usable)
    place = np.full(BUCKETS, len(active))
    place[active] = np.arange(len(active))
    local = place[features]  # the last place is the unused bucket
    w = np.zeros(len(active) + 2)  # active weights, the unused bucket, the bias
    w[-1] = FIRST_BIAS
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, epochs + 1):
        by_word = w[local].sum(axis=1)
        z = np.add.reduceat(by_word[words], sentence_at) + w[-1]
        p = 1 / (1 + np.exp(-z))
        bag = np.clip(noisy_or(z, bag_at), 1e-9, 1 - 1e-9)
        slope = np.where(y == 1, -(1 - bag) / bag, 1.0) * bag_weight
        g_sentence = p * np.repeat(slope, bag_size)
        g_word = np.bincount(words, np.repeat(g_sentence, sentence_size), len(vocabulary))
        g = np.zeros_like(w)
        g[:-1] = np.bincount(local.ravel(), np.repeat(g_word, FEATURES), len(w) - 1)
        g[:-1] += DECAY
        g[-2], g[-1] = 0.0, g_sentence.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
        np.maximum(w[:-1], 0, out=w[:-1])
    weights[active], weights[-1] = w[:-2], w[-1]
    return weights


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic",
        per_class: int = SAMPLE_PER_CLASS, epochs: int = EPOCHS) -> np.ndarray:
    """Fit in one task on at most ``2 * per_class`` documents; ``BUCKETS`` weights come back."""
    sample, shares = labelled_sample(docs, labels, label, per_class)
    if set(shares) != {0, 1}:
        return fit_weights([], [])

    def train(table):
        rows = sorted(zip(table.column("doc_id").to_pylist(), table.column("label").to_pylist(),
                          table.column("text").to_pylist()))
        weights = fit_weights([t for _, _, t in rows], [y for _, y, _ in rows], epochs)
        return pa.table({"weights": [weights.astype("<f8").tobytes()]})

    sample = sample.where("text is not null").withColumn("all", F.lit(0))
    fitted = sample.groupBy("all").applyInArrow(train, "weights binary").first()
    return np.frombuffer(fitted["weights"], "<f8") if fitted else fit_weights([], [])


def score(docs: DataFrame, weights: np.ndarray, offending: float = OFFENDING,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, offending array<struct<start, end, score>>): spans in characters."""
    sent = docs.sparkSession.sparkContext.broadcast(np.asarray(weights))
    schema = "doc_id long, score double, offending array<struct<start:long,end:long,score:double>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                               ("score", pa.float64())]))

    class Memo(dict):
        def __missing__(self, word):
            value = self[word] = sum(sent.value[i] for i in word_features(word) if i)
            return value

    def run(batches):
        memo, bias = Memo(), sent.value[-1]
        trained = bool(np.any(sent.value[:-1]))
        for batch in slices(batches):
            scores, spans = [], []
            for text in batch.column(1).to_pylist():
                sentences = sentence_spans(text) if trained else []
                if not sentences:
                    scores.append(0.0)
                    spans.append([])
                    continue
                z = np.array([sum(map(memo.__getitem__, w)) for _, _, w in sentences]) + bias
                scores.append(float(noisy_or(z, np.zeros(1, int))[0]))
                p = 1 / (1 + np.exp(-z))
                spans.append(in_characters(text, [(*sentences[i][:2], float(p[i]))
                                                  for i in np.flatnonzero(p >= offending)]))
            if len(memo) > MEMO_ENTRIES:
                memo.clear()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)],
                names=["doc_id", "score", "offending"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), as_bytes(text_col))
            .mapInArrow(run, schema))
