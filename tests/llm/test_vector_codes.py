"""Vector codes against a plain integer version, ties and pruning included."""

import hashlib
import math
import random

import numpy as np
import pytest

from strata.llm import queries as Q
from strata.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code int, error string"


def plain(rows, entries=256, rounds=4, parts=4):
    """Dictionary row number -> (code, error), and the codebooks, with Python integers alone."""
    kept = [(n, i, [math.floor(1024 * x) for x in v]) for n, (i, v, _) in enumerate(rows)
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[1] is None, r[1] or 0, r[2]))
    width = len(kept[0][2]) // parts
    cut = {n: [v[p * width:(p + 1) * width] for p in range(parts)] for n, _, v in kept}
    books = [[cut[n][p] for n, _, _ in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for x in cut.values():
                members.setdefault(nearest(x[p], books[p])[1], []).append(x[p])
            for e, xs in members.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    found = {n: [nearest(x[p], books[p]) for p in range(parts)] for n, x in cut.items()}
    return ({n: ("".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for n, f in found.items()}, books)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    f32 = lambda x: float(np.float32(x))
    out = [(i, [f32(rng.gauss(0, 0.1 + i % 3)) for _ in range(8)], rng.choice([1, 2, None])) for i in range(120, 0, -1)]
    out += [(500 + i, out[i][1], 3) for i in range(40)]  # copies: ties between entries
    out += [(i, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(8)], 4) for i in range(600, 700)]
    nan, inf = float("nan"), float("inf")
    out += [(0, None, 1), (3, [], 1), (4, [1.0] * 7 + [None], 1), (5, [nan] * 8, 1), (6, [0.0] * 7 + [-inf], 1)]
    return out + [(None, [0.25] * 8, None), (None, [-0.0001] * 8, 7), (7, [0.1] * 8, 1), (7, [0.1] * 8, 1)]


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame([(i, v, x, 1, "e") for i, v, x in rows], SCHEMA).repartition(5, "vec_id")


@pytest.mark.parametrize("entries", [16, 256])
def test_equals_plain_integers(vectors, rows, entries):
    made = V.compress(vectors, entries=entries)
    codes, books = plain([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], x)
                          for i, v, x in rows], entries)
    assert made.codebooks.tolist() == books
    total = {}
    for n, (_, error) in codes.items():
        total[rows[n][2]] = total.get(rows[n][2], 0) + error
    wanted = [(rows[n][0], rows[n][2], c, e, total[rows[n][2]]) for n, (c, e) in codes.items()]
    got = V.with_label_error(made.rows)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    assert made.digest() == hashlib.sha256(text.encode()).hexdigest()


def test_pruning_is_exact_and_saves_evaluations():
    rng = np.random.default_rng(4)
    centres = rng.integers(-3000, 3000, (40, 6))
    rows = centres[rng.integers(0, 40, 5000)] + rng.integers(-60, 60, (5000, 6))
    entries = rows[:200].copy()
    entries[50:60] = entries[:10]  # ties
    pivots = V.choose_pivots(entries, 8)
    find = V.Nearest(entries, pivots)
    entry, error = find(rows, V.pivot_distances(rows, pivots))
    d = ((rows[:, None] - entries) ** 2).sum(2)
    assert (entry == d.argmin(1)).all() and (error == d.min(1)).all()
    assert find.evaluated < 0.3 * d.size


def test_large_components_stay_exact():
    rng = np.random.default_rng(5)
    rows = rng.integers(-(1 << 27), 1 << 27, (600, 16))
    pivots = V.choose_pivots(rows[:50], 4)
    entry, error = V.Nearest(rows[:50], pivots)(rows, V.pivot_distances(rows, pivots))
    d = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c)) for c in rows[:50]] for x in rows]
    assert [min(x) for x in d] == error.tolist() and [x.index(min(x)) for x in d] == entry.tolist()


def test_defined_results(spark, vectors):
    assert V.compress(vectors.limit(0)).rows.count() == 0
    assert V.with_label_error(V.compress(vectors.where("vec_id = 0")).rows).count() == 0
    odd = spark.createDataFrame([(1, [1.0] * 8, 1, 0, ""), (2, [1.0] * 4, 1, 0, ""), (3, [1e30] * 8, 1, 0, "")], SCHEMA)
    assert [r.vec_id for r in V.compress(odd).rows.collect()] == [1]
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1.0] * 6, 1, 0, "")], SCHEMA))


def test_query(spark):
    out = Q.op13_vector_codes(spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = out.collect()
    assert len(rows) == 500 and len({r.vec_id for r in rows}) == 500 and all(len(r.code) == 8 for r in rows)
