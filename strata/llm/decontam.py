"""Benchmark decontamination by winnowing.

Of every ``SELECT`` consecutive k-gram hashes the smallest is a fingerprint, so any shared span
of ``KGRAM + SELECT - 1`` words has a fingerprint in common. Documents whose fingerprints meet
those of an item are extended word by word to the longest equal span; spans of a whole window
count. Items of fewer words than a window are looked up whole.

The benchmark is the stated query set: it is sent to the tasks in blocks of at most
``block_bytes`` and the documents are read once per block, so nothing of unchecked size is
broadcast and no document data moves.

Defined results: a null or empty text has no words and no hits; null or word-free items match
nothing; a null ``item_id`` counts as one item with an empty id; repeated items count once, repeated documents
each get a row; empty tables give no rows or no hits; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (BASE_A, WordHashes, as_bytes, map_texts, slices,
                               sliding_hash)

WINDOW = 10
KGRAM = 5
BLOCK_BYTES = 8 << 20
SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
SCHEMA = "doc_id long, rid long, n_words long, spans array<struct<s:int,e:int>>, items array<string>"

# ASCII letters and digits stay (in lower case), bytes of other characters stay, the rest parts words.
FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


def fold_words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


def winnow(kgrams: np.ndarray, select: int) -> np.ndarray:
    """The smallest of every ``select`` consecutive hashes, without runs of the same one."""
    n = len(kgrams) - select + 1
    if n <= 0:
        return kgrams[:0]
    least = kgrams[:n].copy()
    for j in range(1, select):
        np.minimum(least, kgrams[j:j + n], out=least)
    return least[np.concatenate([[True], least[1:] != least[:-1]])]


class BenchmarkIndex:
    """Fingerprints of one block of items, kept in a task."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, kgram: int):
        self.window, self.kgram, self.select = window, kgram, window - kgram + 1
        self.hashes = WordHashes()
        self.items = [(i, fold_words(t)) for i, t in items]
        self.places: dict[int, list[tuple[int, int]]] = {}
        self.short: dict[int, dict[tuple, list[int]]] = {}
        for n, (_, words) in enumerate(self.items):
            if len(words) >= window:
                grams = sliding_hash(self.hashes.array(words), kgram, BASE_A)
                chosen = set(winnow(grams, self.select).tolist())
                for at, h in enumerate(grams.tolist()):
                    if h in chosen:
                        self.places.setdefault(h, []).append((n, at))
            elif words:
                self.short.setdefault(len(words), {}).setdefault(tuple(words), []).append(n)
        self.known = np.array(sorted(self.places), np.uint64)
        self.short_known = {
            m: np.array(sorted(int(sliding_hash(self.hashes.array(list(k)), m, BASE_A)[0])
                               for k in found), np.uint64) for m, found in self.short.items()}

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[str]]:
        """Merged word spans (start, end) of the document that items contain, and the items."""
        array = self.hashes.array(words)
        self.hashes.trim()
        spans, items = [], set()
        grams = sliding_hash(array, self.kgram, BASE_A)
        shared = among(winnow(grams, self.select), self.known)
        if len(shared):
            done: dict[tuple[int, int], int] = {}
            for p in np.flatnonzero(np.isin(grams, shared)).tolist():
                for n, q in self.places[int(grams[p])]:
                    if done.get((n, p - q), -1) > p:
                        continue
                    s, e = self.extend(words, p, n, q)
                    done[n, p - q] = e
                    if e - s >= self.window:
                        spans.append((s, e))
                        items.add(self.items[n][0])
        for m, found in self.short.items():
            grams = sliding_hash(array, m, BASE_A)
            shared = among(grams, self.short_known[m])
            for p in np.flatnonzero(np.isin(grams, shared)).tolist() if len(shared) else ():
                for n in found.get(tuple(words[p:p + m]), ()):
                    spans.append((p, p + m))
                    items.add(self.items[n][0])
        return merge_spans(spans), sorted(items)

    def extend(self, words: list[bytes], p: int, n: int, q: int) -> tuple[int, int]:
        item = self.items[n][1]
        s = 0
        while s < min(p, q) and words[p - s - 1] == item[q - s - 1]:
            s += 1
        e, most = 0, min(len(words) - p, len(item) - q)
        while e < most and words[p + e] == item[q + e]:
            e += 1
        return p - s, max(p + e, p + 1)


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The members of ``values`` that the sorted ``known`` holds."""
    if not len(known) or not len(values):
        return values[:0]
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return values[known[at] == values]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator:
    """Broadcasts of all distinct items, each of at most about ``block_bytes``; one at least."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             as_bytes()).where("length(text) > 0").distinct()
    size = items.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for block in range(blocks):
        rows = items if blocks == 1 else items.where(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield benchmark.sparkSession.sparkContext.broadcast(
            [(r["item_id"], bytes(r["text"])) for r in rows.collect()])


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    kgram: int = KGRAM, block_bytes: int = BLOCK_BYTES,
                    text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with a benchmark item (any extra columns stay)."""
    columns, spans = docs.columns, "_benchmark_spans"
    for sent in item_blocks(benchmark, block_bytes):
        docs = map_texts(docs, columns, f"{spans} int", _clean(sent, window, kgram), text_col)
        docs = docs.drop(spans)
    return docs


def _clean(sent, window: int, kgram: int):
    def make():
        index = BenchmarkIndex(sent.value, window, kgram)

        def work(texts):
            hits = np.array([len(index.hits(fold_words(t))[0]) for t in texts], np.int32)
            return [pa.array(hits)], hits == 0

        return work

    return make


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   kgram: int = KGRAM, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, spans, items): what each document shares with benchmark items."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.xxhash64(id_col, text_col).alias("rid"), as_bytes(text_col))
    found, blocks = None, 0
    for sent in item_blocks(benchmark, block_bytes):
        blocks += 1
        part = source.mapInArrow(_scan(sent, window, kgram), SCHEMA)
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        found = _merge_blocks(found, blocks)
    return found.drop("rid")


def _scan(sent, window: int, kgram: int):
    def run(batches):
        index = BenchmarkIndex(sent.value, window, kgram)
        for batch in slices(batches):
            counts, spans, items = [], [], []
            for text in batch.column(2).to_pylist():
                words = fold_words(text)
                s, i = index.hits(words)
                counts.append(len(words))
                spans.append([{"s": a, "e": b} for a, b in s])
                items.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()),
                 pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))],
                names=["doc_id", "rid", "n_words", "spans", "items"])

    return run


def _merge_blocks(found: DataFrame, blocks: int) -> DataFrame:
    """One row per document from its rows of the blocks; at most ``blocks`` different rows meet.

    Repeated documents have equal rows in a block; they are counted first and given back after.
    """
    names = ["rid", "doc_id", "n_words", "spans", "items"]
    joined = found.groupBy(*names).agg(F.count("*").alias("c")).groupBy("rid", "doc_id").agg(
        F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        (F.sum("c") / blocks).cast("int").alias("copies"))

    def run(batches):
        for batch in batches:
            spans = [[{"s": a, "e": b} for a, b in merge_spans([(x["s"], x["e"]) for x in row])]
                     for row in batch.column(3).to_pylist()]
            columns = batch.columns
            columns[3] = pa.array(spans, SPANS)
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "copies"])

    merged = joined.select(*names, "copies").mapInArrow(
        run, "rid long, doc_id long, n_words long, spans array<struct<s:int,e:int>>, "
             "items array<string>, copies int")
    return merged.select("doc_id", "rid", "n_words", "spans", "items", F.explode(
        F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
