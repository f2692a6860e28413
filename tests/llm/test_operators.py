"""The ten operators against brute force, the exact tokenizers and held-out labels, and the edge
cases each docstring defines: nulls, empty and long texts, repeated rows, empty tables and extra
columns with clashing names."""

import collections
import hashlib
import itertools
import random
import re
import struct
import time
import types
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import decontam, line_dedup, packing, quality_classifier, quality_rules
from strata.llm import queries as Q
from strata.llm import simhash, substring_dedup, toxicity
from strata.llm.html_extract import extract, main_text
from strata.llm.token_counts import Counter, Vocabulary, token_counts

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score double, kept string, fp string, n_words int"


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]

    def line(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n)) + "."

    passage, common = line(60), "A line that very many documents hold, word for word."
    out = [(None, "A text without an id."), (1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "one"),
           (5, "x " * 20_000), (6, "é日本🙂   ǅ \x1c \x85 <|endoftext|>")]
    for i in range(7, 70):
        lines = [line(rng.randint(1, 40)) for _ in range(rng.randint(1, 5))] + [common]
        if i % 3 == 0:
            lines.insert(1, passage)
        out.append((i, "\n".join(lines)))
    for i in range(70, 90):  # exact and near copies
        text = out[10 + i % 4][1]
        out.append((i, text if i % 2 else text.replace("w1", "z1", 1)))
    out += [out[12], out[12], (91, out[13][1]), (None, out[13][1])]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(i, t, 0.5, "k", "f", 7) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5, "text")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((x is None, x) if not isinstance(x, list) else x for x in row)


def same(df, expected):
    got = sorted((tuple(r) for r in df.collect()), key=key)
    assert got == sorted(expected, key=key)


def test_packing_is_lossless_and_dense(docs, rows, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(Q.tokenizer_path("byte_bpe_50k.json"))
    pieces = packing.pack(docs, Q.bpe_encoder, window=256, open_windows=4).collect()
    wanted = collections.Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        wanted[i, len(ids)] += len(ids)
        for p in (p for p in pieces if p.doc_id == i and p.doc_tokens == len(ids)):
            part = ids[p.start:p.start + p.length]
            assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == p.ids_crc32
    got = collections.Counter()
    windows = collections.defaultdict(list)
    for p in pieces:
        got[p.doc_id, p.doc_tokens] += p.length
        windows[p.sequence_id].append((p.offset, p.length))
    assert got == wanted
    for parts in windows.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]]
        assert ends[-1] == 256 or ends[-1] & (ends[-1] - 1) == 0
    assert packing.pack(empty, Q.bpe_encoder).count() == 0


def test_special_strings_are_what_the_tokenizer_makes_of_them():
    from tokenizers import Tokenizer
    exact, encode = Tokenizer.from_file(Q.tokenizer_path("byte_bpe_50k.json")), Q.bpe_encoder()
    for text in ("a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> é日", "<|endoftext|", "plain text's 12"):
        ids = struct.unpack(f"<{len(encode(text)) // 4}I", encode(text))
        assert list(ids) == exact.encode(text, add_special_tokens=False).ids + [1]


def test_line_dedup_equals_brute_force(docs, rows, empty):
    by_id = {}
    for i, t in rows:
        by_id.setdefault(i, t)
    # the null id has two texts here; its lines are left out of the comparison
    docs = docs.where("doc_id is not null")
    order = sorted(i for i in by_id if i is not None)
    lines, kept, n = [], collections.defaultdict(list), collections.Counter()
    for i in order:
        for at, part in enumerate((by_id[i] or "").split("\n")):
            words = frozenset(word_list(part))
            if words:
                n[i] += 1
                if not any(5 * len(words & w) >= 4 * len(words | w) for w in lines):
                    kept[i].append(at)
                lines.append(words)
    same(line_dedup.line_report(docs), [(i, n[i], n[i] - len(kept[i]), kept[i]) for i in order])
    cut = {r.doc_id: r for r in line_dedup.remove_lines(docs).collect()}
    for i in order:
        parts = (by_id[i] or "").split("\n")
        left = [p for at, p in enumerate(parts) if at in kept[i] or not word_list(p)]
        assert cut[i].text == (by_id[i] if by_id[i] is None else "\n".join(left))
        assert cut[i].kept == "k"  # extra columns pass, whatever their names
    assert line_dedup.line_report(empty).count() == 0


@pytest.fixture
def no_broadcast(spark, request):
    """Joins without broadcasting if the parameter is true."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names if request.param else []:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("no_broadcast", [False, True], indirect=True)
def test_line_dedup_second_round_takes_every_candidate(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(line_dedup, "FIRST_PAIRS", 1)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(60):  # chains of lines that drift apart
        base[rng.randrange(40)] = f"c{i}"
        rows.append((i, " ".join(base)))
    lines, kept = [], set()
    for i, t in rows:
        words = set(t.split())
        if not any(5 * len(words & w) >= 4 * len(words | w) for w in lines):
            kept.add(i)
        lines.append(words)
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect() if r.kept} == kept


def brute_force_kept(rows):
    lines, kept = [], set()
    for i, t in rows:
        words = set(t.split())
        if not any(5 * len(words & w) >= 4 * len(words | w) for w in lines):
            kept.add(i)
        lines.append(words)
    return kept


@pytest.mark.parametrize("small_group", [4096, 64])
def test_line_dedup_templated_lines_verify_few_pairs(spark, monkeypatch, small_group):
    monkeypatch.setattr(line_dedup, "SMALL_GROUP", small_group)
    checked, verify = spark.sparkContext.accumulator(0), line_dedup._verify

    def counting(threshold):
        def run(batches):
            def tallied():
                for batch in batches:
                    checked.add(batch.num_rows)
                    yield batch
            yield from verify(threshold)(tallied())
        return run

    monkeypatch.setattr(line_dedup, "_verify", counting)
    template = "user logged on at host port from address"
    rows = [(i, f"{template} a{i} b{i}") for i in range(600)]
    rows += [(600 + i, f"{template} a{i} c{i}") for i in range(0, 600, 50)]
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect() if r.kept} == brute_force_kept(rows)
    assert checked.value < 12 * len(rows)


@pytest.mark.parametrize("small_group", [4096, 8])
def test_line_dedup_steps_until_none_is_left(spark, monkeypatch, small_group):
    for name, value in (("FIRST_PAIRS", 1), ("STEP_PAIRS", 1), ("MOST_PAIRS", 4),
                        ("HASHED_WORDS", 0), ("PAIRS_AT_ONCE", 2), ("SMALL_GROUP", small_group)):
        monkeypatch.setattr(line_dedup, name, value)
    rng = random.Random(7)
    base, rows = [f"b{i}" for i in range(200)], []
    for i in range(40):
        line = list(base)
        for at in rng.sample(range(200), 24):  # not alike: 48 words differ of about 224
            line[at] = f"c{i}x{at}"
        rows.append((i, " ".join(line)))
    for i in range(40, 50):  # alike to one of them only
        rows.append((i, rows[i - 40][1] + f" d{i} e{i}"))
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect() if r.kept} == brute_force_kept(rows)


@pytest.mark.parametrize("no_broadcast", [False, True], indirect=True)
def test_line_dedup_filters_postings_at_every_size(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(line_dedup, "FIRST_PAIRS", 1)
    filters, postings = [], line_dedup._postings

    def noted(sent, threshold, only=None, *rest, **more):
        filters.append(only is not None)
        return postings(sent, threshold, only, *rest, **more)

    monkeypatch.setattr(line_dedup, "_postings", noted)
    rows = [(i, " ".join(f"{'c' if k in (i, 39 - i) else 'b'}{k}" for k in range(40)) + f" z{i % 9}")
            for i in range(20)] + [(i, f"v{i} same words of ten in a line as others w{i} x{i}")
                                   for i in range(20, 40)]
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect() if r.kept} == brute_force_kept(rows)
    # the first round runs inside the packing task; every later one is built on the driver
    assert filters and all(filters)


@pytest.mark.parametrize("words, lines", [(175, 1500), (1500, 60)])
def test_line_dedup_long_lines_that_narrowly_differ(spark, monkeypatch, words, lines):
    """Jaccard 0.75 throughout, so all candidates fail; documents are read a fixed number of times."""
    reads, scan = spark.sparkContext.accumulator(0), line_dedup.LineSets.of

    def counting(self, texts):
        reads.add(sum(len(t or b"") for t in texts))
        return scan(self, texts)

    monkeypatch.setattr(line_dedup.LineSets, "of", counting)
    own = words // 7
    common = " ".join(f"w{k}" for k in range(words - own))
    rows = [(i, common + "".join(f" x{i}y{k}" for k in range(own))) for i in range(lines)]
    started = time.monotonic()
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got.where("n_removed > 0").count() == 0 and got.count() == lines
    assert time.monotonic() - started < 90
    # both counts evaluate the plan; postings twice and the wanted lines in up to two fetches, at every number of steps
    assert reads.value < 10 * sum(len(t) for _, t in rows)


def test_line_dedup_later_steps_read_stored_groups(spark, monkeypatch):
    """Few lines go on, so the words of all documents are hashed for their postings once."""
    reads, scan = spark.sparkContext.accumulator(0), line_dedup.LineSets.of

    def counting(self, texts):
        reads.add(sum(len(t or b"") for t in texts))
        return scan(self, texts)

    monkeypatch.setattr(line_dedup.LineSets, "of", counting)
    common = " ".join(f"w{k}" for k in range(30))
    rows = [(i, " ".join(f"u{i}x{k}" for k in range(300))) for i in range(200)]
    rows += [(200 + i, common + "".join(f" x{i}y{k}" for k in range(5))) for i in range(40)]
    rows += [(240 + i, rows[200 + i][1] + " z") for i in (7, 31)]
    got = line_dedup.line_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r.doc_id for r in got.collect() if r.kept} == brute_force_kept(rows)
    assert reads.value < 1.5 * sum(len(t) for _, t in rows)


def test_line_dedup_later_steps_take_only_rows_that_pass_the_filters(monkeypatch):
    """Of a stored group the lines that go on stay, and the rows before them that may be like one; not all rows of such sizes."""
    import numpy as np
    import pyarrow as pa
    rng, (num, den) = np.random.default_rng(3), line_dedup.THRESHOLD
    for pairs_at_once in (1, 50, 1 << 17):
        monkeypatch.setattr(line_dedup, "MEET_PAIRS", pairs_at_once, raising=False)
        size = 400
        t = {"token": np.sort(rng.integers(0, 5, size)), "block": np.zeros(size, np.int32), "doc": np.arange(size),
             "copy": np.zeros(size, np.int64), "line": np.zeros(size, np.int32), "class": rng.integers(0, 300, size),
             "n": rng.integers(1, 40, size).astype(np.int32), "pos": np.zeros(size, np.int32),
             "low": rng.integers(-1 << 62, 1 << 62, 6)[rng.integers(0, 6, size)] ^ (1 << rng.integers(0, 60, size)),
             "high": np.zeros(size, np.int64), "short": np.ones(size, bool)}
        goes_on = rng.random(size) < 0.1
        bits = np.zeros(line_dedup.LINE_BITS // 64, np.int64)
        slot = line_dedup.pair_tokens(t["class"], t["token"])[goes_on] & (line_dedup.LINE_BITS - 1)
        np.bitwise_or.at(bits, slot >> 6, 1 << (slot & 63))
        probe = line_dedup.has_bit(bits, line_dedup.pair_tokens(t["class"], t["token"]))  # others of that class too
        seen, want = {k: v.view(np.uint64) if k in ("low", "high") else v for k, v in t.items()}, probe.copy()
        for y in np.flatnonzero(probe):
            x = np.flatnonzero(t["token"][:y] == t["token"][y])
            want[x[line_dedup.may_match(seen, x, np.full(len(x), y), (num, den))]] = True
        packed = pa.RecordBatch.from_arrays([pa.array([line_dedup._pack_rows(t)], pa.binary())], names=["packed"])
        only = types.SimpleNamespace(value=bits)
        got = pa.Table.from_batches(line_dedup._postings(None, (num, den), only)([packed]))
        assert got["doc"].to_pylist() == np.flatnonzero(want).tolist()
        assert probe.sum() < want.sum() < size / 2


def test_line_dedup_ranks_a_rare_word_before_a_common_one_of_near_hash(spark):
    """Words that agree in the lowest 16 bits of their hashes are counted apart, so groups of rare words stay small."""
    import numpy as np
    words = [f"w{i}" for i in range(3000)]
    hashes = dict(zip(words, line_dedup.WordScanner().scan(" ".join(words).encode())[0].tolist()))
    near = collections.defaultdict(list)
    for w in words:
        near[hashes[w] & 0xFFFF].append(w)
    pairs = [(common, rare) for same_bits in near.values() for common, rare in itertools.permutations(same_bits, 2)
             if hashes[common] >> 36 < hashes[rare] >> 36 and (hashes[common] ^ hashes[rare]) & 0xFFFFF]
    assert len(pairs) > 10
    texts = [" ".join([common, rare] + [common] * 5) for common, rare in pairs[:10]] + [None, "", " ".join(words)]
    docs = spark.createDataFrame([(i, 0, 0, t) for i, t in enumerate(texts)],
                                 "doc_id long, doc long, copy long, text string").repartition(3)
    scanned = docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(
        line_dedup._scanned, "doc_id long, doc long, copy long, n_lines long, piece int, counts binary")
    got = line_dedup.bucket_counts(scanned)
    want = np.zeros(line_dedup.BUCKETS, np.int64)
    for t in texts:
        for w in (t or "").split():
            want[hashes[w] & (line_dedup.BUCKETS - 1)] += 1
    assert (got == want).all()
    sets = line_dedup.LineSets(got).of([t.encode() for t in texts[:10]])
    assert sets["n"].tolist() == [2] * 10
    by_hash = [[hashes[w] & 0xFFFFFFFF for w in (rare, common)] for common, rare in pairs[:10]]
    assert sets["hashes"].reshape(-1, 2).tolist() == by_hash


def test_line_dedup_steps_go_by_portions_of_whole_groups():
    import numpy as np
    token = np.sort(np.random.default_rng(5).integers(0, 40, 3 * line_dedup.SKETCHED_ROWS))
    token[:line_dedup.SKETCHED_ROWS + 9] = 0  # one group that is larger
    t = {"token": np.sort(token), "block": np.zeros(len(token), np.int32), "at": np.arange(len(token))}
    portions = list(line_dedup._portions(t))
    assert np.concatenate([p["at"] for p in portions]).tolist() == list(range(len(token)))
    ends = [set(p["token"][[0, -1]].tolist()) for p in portions]
    assert len(portions) > 3 and not any(a & b for a, b in itertools.combinations(ends, 2))
    assert all(len(p["at"]) <= line_dedup.SKETCHED_ROWS or len(set(p["token"].tolist())) == 1 for p in portions)


def test_line_dedup_counts_lines_under_split_words_once(spark, monkeypatch):
    for name, value in (("GROUP_ROWS", 8), ("FIRST_PAIRS", 1), ("STEP_PAIRS", 2), ("RUN_ROWS", 16)):
        monkeypatch.setattr(line_dedup, name, value)
    rng, rows = random.Random(3), []
    for i in range(60):
        lines = [" ".join(rng.sample("abcdefghijkl", rng.randint(1, 9))) for _ in range(5)]
        rows.append((i, "\n".join([*lines, "", lines[0]])))
    got = line_dedup.line_report(spark.createDataFrame(rows + rows[:9], "doc_id long, text string").repartition(3))
    seen, kept = [], collections.defaultdict(list)
    for i, t in rows:
        for at, part in enumerate(t.split("\n")):
            words = set(part.split())
            if words:
                if not any(5 * len(words & w) >= 4 * len(words | w) for w in seen):
                    kept[i].append(at)
                seen.append(words)
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in got.collect()) == [
        (i, 6, 6 - len(kept[i]), kept[i]) for i, _ in rows]


def test_line_dedup_posts_a_line_once_and_scans_words_apart(spark):
    import numpy as np
    import pyarrow as pa
    held = [types.SimpleNamespace(value=v) for v in (
        np.ones(line_dedup.BUCKETS, np.int64), np.zeros(line_dedup.TOKEN_BITS // 64, np.int64))]
    texts = [b"one two three four five six\nalone"] * 50
    ids = pa.array(range(50), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts, pa.binary())], names=["doc", "copy", "text"])
    got = pa.Table.from_batches(line_dedup._postings(held[0], line_dedup.THRESHOLD, several=held[1])([batch]))
    # copies of posted lines are neither paired nor counted here
    assert sorted(zip(got["doc"].to_pylist(), got["line"].to_pylist(), got["n"].to_pylist())) == [
        (0, 0, 6), (0, 0, 6), (0, 1, 0)]
    words = [b"x" * n for n in range(1, 40)] + [b"x" * n + b"\0" for n in range(1, 20)] + [
        b"abcdefgh" + b"ijklmnop" * n + b"q" for n in range(4)] + [b"ijklmnopabcdefghq", "日本".encode()]
    scan = line_dedup.WordScanner().scan
    hashes, starts, _ = scan(b"\t ".join(words))
    assert len(set(hashes.tolist())) == len(words) and starts.tolist() == [
        sum(len(w) + 2 for w in words[:i]) for i in range(len(words))]
    assert scan(b" \n" + b"\x0b".join(words[::-1]))[0].tolist() == hashes[::-1].tolist()
    assert not len(scan(b"")[0]) and not len(scan(b" \n ")[0])


def test_line_dedup_reads_documents_once_for_counts_and_rows(spark, monkeypatch):
    """Lines are counted where words are; the report starts from that table, not from the documents."""
    rows = [(None, "a b c\n\na b c"), (line_dedup.NO_ID, "a b c\n\na b c"), (3, None), (3, ""), (4, "a b c\nd")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.line_report(docs)
    same(got, [(None, 2, 1, [0]), (line_dedup.NO_ID, 2, 1, [0]), (3, 0, 0, []), (3, 0, 0, []), (4, 2, 1, [1])])
    assert "text" not in got._jdf.queryExecution().analyzed().toString()
    assert line_dedup.kept_lines(docs).count() == 4  # one row per id and text


def test_posted_classes_remember_the_earliest():
    import numpy as np
    rng, table, seen, posted = np.random.default_rng(1), line_dedup.PostedClasses(64), {}, {}
    for _ in range(60):
        n = int(rng.integers(0, 200))
        cls = rng.integers(0, 300, n) * (1 << 40) + rng.integers(0, 2, n)
        doc, copy, line = rng.integers(0, 50, n), rng.integers(-2, 2, n), rng.integers(0, 9, n).astype(np.int32)
        for c, *at, new in zip(cls, doc, copy, line, table.earlier(cls, doc, copy, line)):
            seen[c] = min(seen.get(c, [99]), at)
            if new:
                posted[c] = min(posted.get(c, [99]), at)
    assert posted == seen


def test_line_dedup_tells_rows_of_an_id_apart_by_text(spark):
    import corpus_pipeline as pipeline
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    common, rng = "a line that very many rows hold word for word", random.Random(11)
    rows = [(i, t) for i in (None, 5) for t in
            ["\n".join([*(f"only {rng.random()} here {rng.random()}" for _ in range(k % 4)), common,
                        *(f"then {rng.random()} there {rng.random()}" for _ in range(k % 3))])
             for k in range(12)] + [common, common + "\n" + common, "", None]]
    rows += [rows[3], (9, common + "\n\nlast words of all")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
    hashes = {(r.doc_id, r.text): r.h for r in docs.select(
        "doc_id", "text", F.xxhash64(F.col("text").cast("binary")).alias("h")).collect()}
    order = sorted(hashes, key=lambda k: (k[0] is not None, k[0] or 0, hashes[k]))
    lines, left, report = [], {}, []
    for i, t in order:
        n, kept, parts = 0, [], (t or "").split("\n")
        for at, part in enumerate(parts):
            words = frozenset(word_list(part))
            if words:
                n += 1
                if not any(5 * len(words & w) >= 4 * len(words | w) for w in lines):
                    kept.append(at)
                lines.append(words)
        report.append((i, n, n - len(kept), kept))
        left[i, t] = None if t is None else "\n".join(
            p for at, p in enumerate(parts) if at in kept or not word_list(p))
        if n and not kept:
            left[i, t] = "gone"
    same(line_dedup.line_report(docs), report)
    got = collections.Counter((r.doc_id, r.text) for r in
                              pipeline.line_dedup(spark, docs, SF).collect())
    assert got == collections.Counter((i, left[i, t]) for i, t in rows if left[i, t] != "gone")


def test_substring_dedup_equals_brute_force(docs, rows, empty):
    size = 35
    texts = [(i, word_list(t)) for i, t in rows]
    count = collections.Counter(tuple(w[s:s + size]) for _, w in texts
                                for s in range(len(w) - size + 1))
    expected = []
    for i, w in texts:
        gone = {s + k for s in range(len(w) - size + 1) if count[tuple(w[s:s + size])] > 1
                for k in range(size)}
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected.append((i, len(w), len(gone), left.encode()))
    got = [(r.doc_id, r.n_words, r.n_removed, bytes(r.kept))
           for r in substring_dedup.remove_repeats(docs).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert substring_dedup.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.check_cover(35, 21, (0, 1, 2))


def test_quality_rules(spark, docs, rows, empty):
    got = quality_rules.judge(docs).collect()
    assert len(got) == len(rows)
    words = {t: len(word_list(t)) for _, t in rows}
    assert sorted(r.n_words for r in got) == sorted(words[t] for _, t in rows)
    assert quality_rules.judge(empty).count() == 0
    clean = "This line has ten words in it and ends here."
    texts = [(1, "\n".join(f"Sentence {i} says word{i * 7}, then word{i * 5 + 1} ends it {i}a fine."
                           for i in range(6))),
             (2, "Home | News | About | Contact | Login\n" * 3 + clean),
             (3, "word" * 3), (4, "buy!! now!! cheap!! best!! deal!! ever!! today!! only!! go!! x!!"),
             (5, "a b c d e f g h i j k. a b c d e f g h i j k.")]
    kept = {r.doc_id: r for r in
            quality_rules.judge(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [kept[i].kept for i in (1, 2, 3, 4, 5)] == [True, False, False, False, False]
    assert kept[2].n_dup_lines == 2 and kept[3].base_failed
    assert kept[5].n_repeat_words == 22 and kept[5].n_words == 22


def test_stock_phrases_count_as_whole_words_and_by_their_share(spark):
    lines = {"They catalog insects in the field.": True, "The design in question was new.": True,
             "We thread more beads.": True, "We eat a cookie with every cup of tea.": True, "écookie law, in full.": True,
             "Please read more of the chapters that follow us through this long book.": True,
             "Click here to read more.": False, "Sign-in or LOG  IN.": False, "We use cookies.": False,
             "Subscribe to our newsletter!": False, "All rights reserved.": False, "123 456.": True}
    df = spark.createDataFrame(list(lines), "string").select(
        "value", quality_rules.line_passes(F.col("value")).alias("ok"))
    assert {r.value: r.ok for r in df.collect()} == lines
    long_line = "Words go on and on in one line without an end to them, " * 30 + "and then we say subscribe."
    texts = spark.createDataFrame([(1, long_line.replace("on and on", "on{} and on"))], "doc_id long, text string")
    assert quality_rules.judge(texts).first().kept_line_chars == len(long_line) + 60


def test_simhash_equals_all_pairs(docs, rows, empty):
    def fp(text):
        w = word_list(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        counts = [0] * 64
        for s in shingles:
            h = xxhash.xxh64_intdigest(s.encode(), 42)
            for b in range(64):
                counts[b] += h >> b & 1
        return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))

    fps = [fp(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2:
            root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id)
           for r in simhash.near_duplicates(docs).collect()]
    expected = [(i, fps[a], least.get(find(a))) for a, (i, _) in enumerate(rows)]
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(docs).count() == len({find(a) for a in range(len(rows))})


def test_simhash_tiles_and_split_groups(spark):
    rng = random.Random(9)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6)))
           for _ in range(900)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), tile_rows=100)
    from strata.llm.graph import components
    got = collections.defaultdict(set)
    for r in components(links).collect():
        got[r.root].add(r.node)
    order = [f[0] for f in signed]
    up = {f: f for f in order}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(order, 2):
        if ((a ^ b) % (1 << 64)).bit_count() <= 2:
            up[find(a)] = find(b)
    expected = collections.defaultdict(set)
    for f in order:
        expected[find(f)].add(f)
    assert {frozenset(s) for s in got.values()} == {frozenset(s) for s in expected.values()
                                                    if len(s) > 1}


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(spark, docs, rows, empty, block_bytes):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                          re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    long = words(rows[12][1] + " " + rows[15][1])
    items = [(1, " ".join(long[:30]).upper()), (2, "W5"), (3, None), (4, ""), (5, "... !"),
             (None, " ".join(words(rows[20][1])[3:14])), (6, "x x x"), (1, " ".join(long[:30]).upper())]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items],
                                  "item_id long, text string, n_words int")
    wanted = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            wanted[tuple(w[s:s + 10])].add("" if i is None else str(i))
    expected = []
    for i, t in rows:
        w, hit, names = words(t), set(), set()
        for m in {len(k) for k in wanted}:
            for s in range(len(w) - m + 1):
                if tuple(w[s:s + m]) in wanted:
                    hit |= set(range(s, s + m))
                    names |= wanted[tuple(w[s:s + m])]
        expected.append((i, len(w), len(hit), sorted(names)))
    got = [(r.doc_id, r.n_words, sum(s.e - s.s for s in r.spans), r["items"]) for r in
           decontam.benchmark_hits(docs, bench, block_bytes=block_bytes).collect()]
    assert sorted(got, key=key) == sorted(expected, key=key)
    clean = decontam.clean_documents(docs, bench, block_bytes=block_bytes)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not e[2] for e in expected)
    assert decontam.benchmark_hits(empty, bench).count() == 0
    assert decontam.benchmark_hits(docs, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_html_extraction(spark):
    body = ("A paragraph of the article, long enough to score, with commas, and words that go on "
            "for a while so that nobody takes it for a menu.")
    page = (f"<html><head><title>T</title><style>p{{}}</style></head><body class='has-sidebar'>"
            f"<header><p>{body}</p></header><nav><ul><li><a href=a>A</a></li></ul></nav>"
            f"<div id='main'><h1>Title &amp; more</h1><p>{body}<p>Second   one<br>here"
            f"<div class='ad-box ad'><p>{body}</p></div><script>var x = '<p>no</p>';</script>"
            f"<ul><li>first item, yes</li><li>second item</li></ul></div>"
            f"<aside><p>{body}</p></aside><section class='comments'><p>{body}</p></section>"
            f"<div class='cookie-notice'><p>{body}</p></div><form><p>{body}</p></form>"
            f"<footer><p>{body}</p></footer></body></html>")
    wanted = f"Title & more\n{body}\nSecond one here\nfirst item, yes\nsecond item"
    assert main_text(page) == wanted
    assert main_text(None) == main_text("") == main_text("<nav>menu</nav>") == ""
    assert main_text("plain") == "plain"
    assert main_text(f"<article><p>{body}</p><p>cut &amp; off<b") == f"{body}\ncut & off"
    rows = [(1, "u", page, "t"), (None, None, None, "t"), (2, "u", "", "t"), (1, "u", page, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    same(extract(pages), [(1, "u", wanted), (None, None, ""), (2, "u", ""), (1, "u", wanted)])
    assert extract(pages.limit(0)).count() == 0


def test_token_counts_equal_the_exact_tokenizer(docs, rows, empty):
    import sentencepiece
    from tokenizers import Tokenizer, models, normalizers
    path = Q.tokenizer_path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    exact = Tokenizer(models.Unigram([(model.id_to_piece(i), model.get_score(i))
                                      for i in range(model.get_piece_size())],
                                     unk_id=0, byte_fallback=True))
    exact.normalizer = normalizers.Sequence([normalizers.Prepend("▁"),
                                             normalizers.Replace(" ", "▁")])
    got = {(r.doc_id, r.n_tokens) for r in token_counts(docs, Q.piece_vocabulary).collect()}
    assert got == {(i, len(exact.encode(t or "", add_special_tokens=False).ids)) for i, t in rows}
    assert token_counts(empty, Q.piece_vocabulary).count() == 0


def test_token_counts_tie_rule_and_fused_unknowns():
    from tokenizers import Tokenizer, models
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0)]
    exact = Tokenizer(models.Unigram(pieces, unk_id=0))
    counter = Counter(Vocabulary(pieces[1:], byte_fallback=False))
    for n in range(1, 7):
        for text in map("".join, itertools.product("abz", repeat=n)):
            assert counter.best(text)[0] == len(exact.encode(text).ids), text


@pytest.mark.parametrize("name, label, least", [("op5_toxicity", "toxic", 0.85),
                                                ("op10_quality_classifier", "quality", 0.95)])
def test_classifiers_on_held_out_labels(spark, name, label, least):
    sf = "/root/testdata/sf0.1"
    scored = Q.QUERIES[name](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    pairs = [(r[label], r.score, r.predicted) for r in scored.where("held_out").collect()]
    assert all(0 <= s <= 1 for _, s, _ in pairs)
    right = sum(y == p for y, _, p in pairs) / len(pairs)
    assert right >= least
    low, high = ([s for y, s, _ in pairs if y == v] for v in (0, 1))
    assert sum(a < b for a in low for b in high) / (len(low) * len(high)) >= least


def test_classifiers_on_edge_cases(spark, docs, rows, empty):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(7, 40)]
                                   + [(None, 1, 0), (8, None, None), (9, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    weights = toxicity.fit(docs, labels)
    got = toxicity.score(docs, weights).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and not r.offending for r in got if r.doc_id in (1, 2, 3))
    model = quality_classifier.fit(docs, labels, epochs=2)
    got = quality_classifier.score(docs, model, ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    none = labels.limit(0)
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.0}
    model = quality_classifier.fit(empty, none)
    assert {r.score for r in quality_classifier.score(docs, model, ["doc_id"]).collect()} == {0.5}
    assert quality_classifier.score(empty, model, ["doc_id"]).count() == 0


def test_offending_sentences_are_located(spark):
    import numpy as np
    weights = np.zeros(toxicity.BUCKETS + 1)
    weights[-1], weights[toxicity.word_features(b"vile")[0]] = -8, 12
    text = "Gut, é. You are vile! Bye."
    row = toxicity.score(spark.createDataFrame([(1, text)], "doc_id long, text string"),
                         weights).first()
    assert [text[s.start:s.end] for s in row.offending] == [" You are vile"]
    assert row.score > 0.9


def test_pipeline_stages_keep_what_they_should(spark, docs):
    import corpus_pipeline as pipeline
    base = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
                       F.length("text").cast("long").alias("n_chars"), F.lit(1).alias("extra"))
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, base, SF)
        assert out.columns == pipeline.COLUMNS, name
        assert stage(spark, base.limit(0), SF).count() == 0
    again = pipeline.near_dedup(spark, pipeline.near_dedup(spark, base, SF), SF)
    assert again.count() == pipeline.near_dedup(spark, base, SF).count()
    cut = pipeline.line_dedup(spark, base, SF)
    assert cut.where("n_chars != length(text)").count() == 0
    pieces = pipeline.run(spark, SF)
    assert pieces.columns == Q.PIECE_COLUMNS and pieces.count() > 0


STORY = "".join(f"<p>Sentence {i} of the story, long enough, and with commas, to score.</p>"
                for i in range(8))
STORY_TEXT = "\n".join(f"Sentence {i} of the story, long enough, and with commas, to score."
                       for i in range(8))


@pytest.mark.parametrize("page", [
    "<div class='site has-sidebar'>{}</div>", "<div class='no-sidebar'>{}</div>",
    "<div class='login'>{}</div>", "<form id='aspnetForm'>{}</form>",
    "<form><article>{}</article></form>", "<article class='post comments-open'>{}</article>",
    "<article class='no-comments'>{}</article>", "<article class='comments'>{}</article>",
    "<div class='comments'><main>{}</main></div>", "<div class='replies'>{}</div>",
    "<div class='elementor-widget elementor-widget-text-editor'>{}</div>"])
def test_html_names_do_not_lose_the_page(page):
    nav = "<nav><a href='/'>Home</a> <a href='/n'>News</a></nav>"
    assert main_text(f"<html><body>{nav}{page.format(STORY)}</body></html>") == STORY_TEXT


def test_html_names_still_leave_out_minor_parts():
    parts = ("<div class='sidebar'><p>Side text, not long.</p></div><form><p>Your name, please"
             "</p></form><div class='comments'>" + "<p>A reader, with an opinion, says this "
             "much and more.</p>" * 30 + "</div><div class='elementor-widget-nav-menu'>Menu</div>")
    assert main_text(f"<body><div class='text'>{STORY}</div>{parts}</body>") == STORY_TEXT
    assert main_text("<body><div class='ad'><p>An advert, longer than the article.</p></div>"
                     "<article><h1>Title</h1><p>Short.</p></article></body>") == "Title\nShort."
    assert main_text(f"<body><article>{STORY}<p>As <math><mi>x</mi></math> is.</p></article>"
                     f"{parts}</body>") == STORY_TEXT + "\nAs x is."


def test_registered_results_are_complete(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_line_dedup", "op3_substring_dedup", "op6_simhash", "op9_token_counts"):
        assert Q.QUERIES[name](spark, SF).count() == n
    kept = Q.op3_substring_dedup(spark, SF).first()
    assert len(kept.kept_sha256) == len(hashlib.sha256().hexdigest())
