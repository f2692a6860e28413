"""Which rows each pipeline stage keeps, against brute force, with null ids, null texts and repeated rows."""

import collections
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from strata.llm import quality_classifier
from strata.llm import queries as Q

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(9)
    given = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len((r.text or "").split()) > 20]
    out = list(enumerate(given, 10))
    out += [(100 + i, t) for i, t in enumerate(given[:8])]  # exact copies
    out += [(200 + i, t + " appended") for i, t in enumerate(given[8:14]) if t]
    out += [(300 + i, f"{given[20 + i]} {' '.join(items[i].split()[3:18])} {given[3]}") for i in range(5)]
    out += [(400 + i, " ".join(rng.choice(["x1", "y2", "z3"]) for _ in range(9))) for i in range(3)]
    out += [(None, None), (None, None), (None, ""), (None, given[1]), (None, "no id, " + given[2]), (5, None), (6, "\n \n")]
    out += [out[0], out[0], (10, "another text of the same id"), (12, given[30])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1) for i, t in rows], SCHEMA).repartition(4, "text")


def kept(df):
    assert df.columns == pipeline.COLUMNS
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def test_quality_keeps_rows_whose_score_reaches_the_threshold(spark, docs, rows):
    model = Q.quality_model(docs.select(*pipeline.COLUMNS), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = quality_classifier.score(docs, model, ["doc_id", "text"]).collect()
    wanted = collections.Counter((r.doc_id, r.text) for r in scores if r.score >= 0.3)
    got = kept(pipeline.quality(spark, docs, SF))
    assert got == wanted and 0 < sum(got.values()) < len(rows)


def test_near_dedup_keeps_one_row_of_each_component(spark, docs, rows):
    def fingerprint(text):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = sorted({fingerprint(t) for _, t in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 2:
                root[find(p)] = find(q)
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[find(fingerprint(t))].append(((i is None, i or 0), hashes[t], i, t))
    wanted = collections.Counter(min(g, key=lambda r: r[:2])[2:] for g in groups.values())
    assert kept(pipeline.near_dedup(spark, docs, SF)) == wanted


def test_decontaminate_drops_rows_that_share_a_window(spark, docs, rows):
    def fold(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = fold(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(len(w) - 9)} if len(w) >= 10 else ({tuple(w)} if w else set())
    sizes = {len(w) for w in windows}

    def clean(text):
        w = fold(text)
        return not any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    got = kept(pipeline.decontaminate(spark, docs, SF))
    assert got == collections.Counter((i, t) for i, t in rows if clean(t)) and sum(got.values()) < len(rows)


def test_pack_holds_every_token(spark, docs, rows):
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(Q.tokenizer_path("byte_bpe_50k.json"))
    wanted = collections.Counter()
    for i, t in rows:
        n = len(exact.encode(t or "", add_special_tokens=False).ids) + 1
        wanted[i, n] += n
    got = collections.Counter()
    for r in pipeline.packing(spark, docs, SF).collect():
        got[r.doc_id, r.doc_tokens] += r.length
    assert got == wanted


def test_run_applies_the_stages_in_order(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs, sizes = given, [given.count()]
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), SCHEMA.rsplit(",", 1)[0])
        sizes.append(docs.count())
    pieces = pipeline.run(spark, SF)
    assert pieces.columns == Q.PIECE_COLUMNS and sizes == sorted(sizes, reverse=True)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
