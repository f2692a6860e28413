"""Secret scans: base spans against a plain scan, automata against their definition, added spans on
planted formats."""

import collections
import hashlib
import math
import random
import re

import pytest

from strata.llm import queries as Q
from strata.llm import secret_scan as S

SCHEMA = "doc_id long, text string, secrets string, kind int"
ASSIGN = r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"


def base_spans(text):
    text = text or ""
    out = [(m.start(), "assign", m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], S.KINDS.index(s[1])))


@pytest.fixture(scope="module")
def rng():
    return random.Random(11)


@pytest.fixture(scope="module")
def rows(rng):
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    words = ["verwaltungsgemeinschaft", "internationalization", "www.example.com/index.html", "a", "of", "the"]
    texts = ["", None, " ", "token=abcde", "token=abcdef", "PassWord': 'hunter2!", "api_key:=x", "tokEn=toKen=secret",
             "toKen=abcdefg ſecret=abcdefg", "é🙂 secret : \"" + "f" * 24, "AKIA" + "A" * 15, "xAKIAAKIA" + "B" * 20,
             "password=token=" + "0" * 30, "AKIA" + "0" * 40 + "." + "a" * 23, "abc" * 30_000, "ab " * 30_000 + "key"]
    for _ in range(200):  # labelled ones: assigned values, access keys, hexadecimal digits
        texts.append(f"{rng.choice(words)} token = \"zq-{pick('0123456789QRSTUV', 24)}\" and {rng.choice(words)}.")
        texts.append(f"see AKIA{pick('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 16)} {pick('etaoinshr', 18)} in {rng.choice(words)}")
        texts.append(f"{rng.choice(words)} {pick('0123456789abcdef', 40)} {pick('etaoinshrdlu', 17)}")
    for _ in range(40):  # of the same formats, out of the base rules' sight
        texts.append(f"loose zq-{pick('0123456789QRSTUV', 24)} end")
        texts.append(f"short {pick('0123456789abcdef', 22)} end {pick('etaoinshr', 19)}")
    for _ in range(200):
        texts.append(pick("token =:'\"secrtAKI09af\n", 80))
    return list(enumerate(texts)) + [(None, "token=abcdef"), (4, "other"), (4, "other")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "s", 1) for i, t in rows], SCHEMA).repartition(5, "text")


def test_base_spans_equal_a_plain_scan(spark, docs, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(Q, "read_table", lambda *a: docs)
    got = collections.Counter(map(tuple, Q.op12_secret_scan(spark, "").drop("spans").collect()))
    wanted = collections.Counter()
    for i, t in rows:
        spans = base_spans(t)
        n = collections.Counter(k for _, k, _ in spans)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()
        wanted[i, n["assign"], n["access"], n["hex"], digest] += 1
    assert got == wanted


def test_formats_are_found_and_words_are_not(docs, rows):
    found = S.find_secrets(docs)
    assert found.columns == ["doc_id", "kind", "secrets"]
    by_id = {r.doc_id: r.secrets for r in found.where("doc_id > 4").collect()}
    loose = [i for i, t in rows if t and t.startswith("loose")]
    short = [i for i, t in rows if t and t.startswith("short")]
    added = {i: [s for s in x if s.odds is not None] for i, x in by_id.items()}
    assert sum(bool(added[i]) for i in loose) == len(loose) and sum(bool(added[i]) for i in short) > 35
    texts = dict(rows)
    assert all(texts[i][s.start:s.end] == s.text for i, x in by_id.items() for s in x)
    assert not any(re.fullmatch("[a-z]{16,}|www.*", s.text) for x in added.values() for s in x)
    for x in by_id.values():
        assert [s.start for s in x] == sorted(s.start for s in x)


def test_automaton_learns_the_format(rng):
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(500)]
    states = S.infer(keys)
    assert len(states) < 60  # merged, against thousands of nodes of the prefix tree
    at = states[0]
    for symbol in "AKIA":  # the common beginning stays apart
        assert set(at.to) == {symbol}
        at = at.to[symbol][0]
    model = S.Automaton(states)
    assert model.log_likelihood(keys[0]) > model.log_likelihood("BKIA" + keys[0][4:]) + 5
    for steps, miss, end in zip(model.steps, model.misses, model.ends):
        chances = [p for _, p in steps.values()] + [miss] * (S.SYMBOLS - len(steps)) + [end]
        assert math.isclose(sum(map(math.exp, chances)), 1)


def test_counts_survive_merging(rng):
    values = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(400)]
    states = S.infer(values)
    assert sum(s.ends for s in states) == len(values)
    assert sum(n for s in states for _, n in s.to.values()) == sum(map(len, values))
    for s in states:  # what enters a state leaves it or ends there
        assert s.count == s.ends + sum(n for _, n in s.to.values())


def test_sample_is_the_same_for_any_partitioning(docs):
    one = S.labelled_values(docs.coalesce(1), sample=30).collect()
    many = S.labelled_values(docs.repartition(17), sample=30).collect()
    assert sorted(one) == sorted(many)
    sizes = collections.Counter(r.kind for r in one)
    assert max(sizes.values()) == 30 and set(sizes) == {"", *S.KINDS}


def test_empty_table_and_no_labels(spark, docs):
    assert S.find_secrets(docs.limit(0)).count() == 0
    plain = spark.createDataFrame([(1, "internationalization of " + "9Z" * 20, "s", 1)], SCHEMA)
    assert S.find_secrets(plain).first().secrets == []
    out = Q.op12_secret_scan(spark, "/root/testdata/sf0.001")
    assert out.count() == 200 and out.where("n_hex > 0").count() == 0
