"""Fill-in-middle against a plain loop over the units, and the exact round trip."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import fill_middle as fim
from strata.llm import queries as Q

SCHEMA = "doc_id long, text string, output string, form int, n string"


def expected(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    seed = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(seed[8 * i:8 * i + 8], 16) for i in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = ["", None, " ", "a", "\n\r\n\t", "é日本🙂 ſK\u0000x", "<P>", "a<S>b", "x <M", "<P <S <M> >", "S><M", "<" * 50,
             "word " * 20_000, "z" * 100_000]
    texts += ["".join(rng.choice("ab CD\n<PSM>é🙂1") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    out = list(enumerate(texts)) + [(None, "no id"), (None, None), (7, "<S"), (20, texts[20]), (20, "other text")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "o", 1, "n") for i, t in rows], SCHEMA).repartition(4, "text")


def test_equals_a_loop_over_units(docs, rows):
    made = fim.fill_middle(docs)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = collections.Counter(map(tuple, made.collect()))
    assert got == collections.Counter(expected(i, t) for i, t in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_restored_is_the_text(docs, rows):
    back = fim.fill_middle(docs, ["doc_id"]).select("doc_id", fim.restored().alias("t")).collect()
    assert collections.Counter(map(tuple, back)) == collections.Counter((i, t or "") for i, t in rows)


def test_blocks_give_the_same_ends():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abC é1\n") for _ in range(rng.randint(0, 80)))
        whole = fim.unit_matcher()(text)
        for size in (1, 7, 30):
            blocks = fim.unit_matcher(block=size)(text)
            assert [e for b in blocks for e in b] == whole[0]
            for k in range(len(whole[0]) + 1):
                assert fim.end_of(blocks, k) == fim.end_of(whole, k)


def test_long_text_in_blocks():
    ends = fim.unit_matcher()(" " * 3_000_000 + "a" * 3_000_000)
    assert sum(map(len, ends)) == 3_000_001 and len(ends) > 2 and fim.end_of(ends, 3_000_001) == 6_000_000


def test_bytes_that_are_not_text_come_back(spark):
    df = spark.createDataFrame([(i, b"ab\xff\xfe cd\xc3") for i in range(40)], "doc_id long, text binary")
    df = df.withColumn("text", F.col("text").cast("string"))
    made = fim.fill_middle(df).select("n", "form", fim.restored().cast("binary").alias("t")).collect()
    assert {bytes(r.t) for r in made} == {b"ab\xff\xfe cd\xc3"} and {r.n for r in made} == {6}


def test_empty_table_and_query(spark, docs):
    assert fim.fill_middle(docs.limit(0)).count() == 0
    out = Q.op11_fill_middle(spark, "/root/testdata/sf0.001")
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    joined = out.join(texts, "doc_id").where(F.sha2(F.coalesce("text", F.lit("")), 256) != F.col("restored_sha256"))
    assert out.count() == texts.count() and joined.count() == 0
