"""Quality classifier on random-indexing word vectors.

Every token bucket has a sparse random index vector (from its number alone). A bucket's word
vector is the sum of the index vectors around its tokens over the whole corpus, brought to
length one: integer sums, added up per task and then by bucket. A document is the mean of its
word vectors and of the products of neighbouring ones. A two-layer network on it is fitted with
numpy on a bounded sample; a temperature, fitted on rows of the sample that the network has not
seen, calibrates the probability.

Defined results: null and empty texts have the zero vector and are scored like any other; null
ids and labels are not learned from; repeated rows each get a row; without labels of both kinds
every score is the share of label 1 (one half without any); an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import MEMO_ENTRIES, as_bytes, map_texts, slices, tidied
from strata.llm.sampling import labelled_sample

BUCKETS = 1 << 14
DIMENSIONS = 32
NONZERO = 2
REACH = 2
HIDDEN = 32
SAMPLE_PER_CLASS = 3000
EPOCHS = 60
SEED = 7
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")


class TokenBuckets(dict):
    def __missing__(self, token: bytes) -> int:
        value = self[token] = xxhash.xxh3_64_intdigest(token) % BUCKETS
        return value

    def of(self, text: bytes | None) -> np.ndarray:
        tokens = TOKEN.findall(text) if text else []
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))

    def trim(self) -> None:
        if len(self) > MEMO_ENTRIES:
            self.clear()


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every bucket's index vector."""
    rng = np.random.default_rng(SEED)
    return (rng.integers(0, DIMENSIONS, (BUCKETS, NONZERO)),
            rng.choice(np.array([-1, 1]), (BUCKETS, NONZERO)))


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit word vectors by bucket from all documents: a table of fixed size."""
    def run(batches):
        buckets, (places, signs) = TokenBuckets(), index_vectors()
        total = np.zeros(BUCKETS * DIMENSIONS, np.int64)
        for batch in slices(batches):
            rows = [buckets.of(t) for t in batch.column(0).to_pylist()]
            gap = np.full(REACH, -1)  # neighbours never span documents
            flat = np.concatenate([x for r in rows for x in (r, gap)])
            for step in range(1, REACH + 1):
                a, b = flat[:-step], flat[step:]
                both = (a >= 0) & (b >= 0)
                a, b = a[both], b[both]
                for x, y in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        total += np.bincount(x * DIMENSIONS + places[y, k], signs[y, k],
                                             len(total)).astype(np.int64)
            buckets.trim()
        table = total.reshape(BUCKETS, DIMENSIONS)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32))] + [pa.array(table[used, d])
                                                 for d in range(DIMENSIONS)],
            names=["bucket"] + [f"d{d}" for d in range(DIMENSIONS)])

    names = [f"d{d}" for d in range(DIMENSIONS)]
    sums = (docs.select(as_bytes(text_col))
            .mapInArrow(tidied(run), "bucket int, " + ", ".join(f"{n} long" for n in names))
            .groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)))
    table = np.zeros((BUCKETS, DIMENSIONS))
    for row in sums.collect():  # at most BUCKETS rows
        table[row["bucket"]] = row[1:]
    size = np.linalg.norm(table, axis=1, keepdims=True)
    return (table / np.where(size > 0, size, 1)).astype(np.float32)


def pool(buckets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, mean product of neighbours, and log of the token count."""
    out = np.zeros(2 * DIMENSIONS + 1, np.float32)
    if len(buckets):
        words = vectors[buckets]
        out[:DIMENSIONS] = words.mean(axis=0)
        if len(buckets) > 1:
            out[DIMENSIONS:-1] = (words[1:] * words[:-1]).mean(axis=0)
        out[-1] = np.log1p(len(buckets))
    return out


@dataclass
class Network:
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(x) / self.temperature, -50, 50)
        return 1 / (1 + np.exp(-z))


def fit_network(x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS,
                seed: int = SEED) -> Network:
    """Adam on the weighted log loss of four fifths; the temperature on the others."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held, seen = order[:len(x) // 5], order[len(x) // 5:]
    net = Network(x[seen].mean(axis=0), x[seen].std(axis=0) + 1e-3,
                  rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0)
    state = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, step = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state], 0
    inputs = (x - net.centre) / net.scale
    for _ in range(epochs):
        rng.shuffle(seen)
        for at in range(0, len(seen), 128):
            rows = seen[at:at + 128]
            a, step = inputs[rows], step + 1
            h = np.tanh(a @ state[0] + state[1])
            z = np.clip(h @ state[2] + state[3][0], -50, 50)
            g = weight[rows] * (1 / (1 + np.exp(-z)) - y[rows]) / len(rows)
            gh = np.outer(g, state[2]) * (1 - h * h)
            grads = [a.T @ gh + 1e-4 * state[0], gh.sum(axis=0), h.T @ g + 1e-4 * state[2],
                     np.array([g.sum()])]
            for i, d in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                state[i] -= 0.005 * (m[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = *state[:3], float(state[3][0])
    if len(held):
        z = net.logits(x[held])

        def loss(t: float) -> float:
            return float((weight[held] * (np.logaddexp(0, z / t) - y[held] * z / t)).sum())

        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return net


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network | None
    prior: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(x), self.prior)
        return self.network.probability(x.astype(np.float64))


def _pooler(sent):
    def make():
        buckets = TokenBuckets()

        def work(texts):
            rows = [pool(buckets.of(t), sent.value).tobytes() for t in texts]
            buckets.trim()
            return [pa.array(rows, pa.binary())]

        return work

    return make


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality",
        per_class: int = SAMPLE_PER_CLASS, epochs: int = EPOCHS) -> QualityModel:
    """Word vectors of all documents, network of at most ``2 * per_class`` labelled ones."""
    vectors = word_vectors(docs)
    sample, shares = labelled_sample(docs, labels, label, per_class)
    prior = shares.get(1, 0.0) if shares else 0.5
    if set(shares) != {0, 1}:
        return QualityModel(vectors, None, prior)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)
    pooled = map_texts(sample, ["doc_id", "label"], "x binary", _pooler(sent))
    rows = sorted((r["doc_id"], r["label"], bytes(r["x"]))
                  for r in pooled.collect())  # bounded by the sample
    y = np.array([r[1] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return QualityModel(vectors, None, prior)
    x = np.array([np.frombuffer(r[2], np.float32) for r in rows], np.float64)
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return QualityModel(vectors, fit_network(x, y, weight, epochs), prior)


def score(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text",
          least: float | None = None) -> DataFrame:
    """Columns ``keep`` and ``score``, the probability of label 1, of every row; with ``least``
    only of rows that reach it."""
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    def make():
        buckets, model = TokenBuckets(), pickle.loads(sent.value)

        def work(texts):
            x = np.array([pool(buckets.of(t), model.vectors) for t in texts])
            buckets.trim()
            p = model.probability(x.reshape(len(texts), -1))
            made = [pa.array(p, pa.float64())]
            return made if least is None else (made, p >= least)

        return work

    return map_texts(docs, keep, "score double", make, text_col)
