"""Substring deduplication with difference-cover anchors.

A word window of ``window`` words is repeated if the same words start a window anywhere else.
Only positions whose remainder modulo ``period`` lies in a difference cover are hashed, over
``window - period + 1`` words. Two equal windows always share an anchor at the same offset: for
any two start positions some shift below the period puts both on the cover. So a window can be
repeated only if one of its first ``period`` positions holds an anchor that occurs twice.

1. Anchors are counted (map-side combine) and those found twice are joined back to their places.
2. The (zstd-packed) texts join their anchors by row. Each such anchor is extended to every window it can start in; these windows are hashed whole
   (79 bits) and grouped. Windows that occur once are sent back, one row each; the other
   candidates are the repeated ones.

Hot passages meet only in aggregations with map-side combine and in joins that adaptive execution
splits; what is gathered per document is bounded by its length.

Defined results: null, empty and word-free texts have no words; texts shorter than a window lose
nothing; of repeated rows every copy loses its windows; a null ``doc_id`` stays null; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (BASE_A, BASE_B, WordHashes, as_bytes, durable, slices,
                               sliding_hash, window_hash)
from strata.operators.skew import join_aggregate

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # fixed value: every difference modulo 21 occurs


def check_cover(window: int, period: int, cover: tuple[int, ...]) -> None:
    if {(a - b) % period for a in cover for b in cover} != set(range(period)):
        raise ValueError("not a difference cover of the period")
    if window < period:
        raise ValueError("the window must not be shorter than the period")


def remove_repeats(docs: DataFrame, window: int = WINDOW, period: int = PERIOD,
                   cover: tuple[int, ...] = COVER, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document's words without its repeated windows.

    ``kept`` is the binary UTF-8 text of the kept words joined by one space. A row is known by a
    64-bit hash of id and text while its positions travel.
    """
    check_cover(window, period, cover)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.xxhash64(id_col, text_col).alias("rid"), as_bytes(text_col))
    places = source.select("rid", "text").mapInArrow(
        _anchors(window, period, cover), "h long, rid long, pos int")
    twice = places.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h")
    shared = durable(join_aggregate(places, twice, ["h"], "left_semi")
                     .groupBy("rid").agg(F.collect_set("pos").alias("anchors")))
    # Both joins read one and the same exchange of the packed texts.
    packed = source.mapInArrow(_pack_texts, "doc_id long, rid long, packed binary") \
        .where("rid is not null")  # as the inner join asks, so that both sides stay alike
    windows = packed.join(shared, "rid").select("doc_id", "rid", "packed", "anchors").mapInArrow(
        _windows(window, period), "w1 long, w2 short, rid long, pos int")
    once = (windows.groupBy("w1", "w2")
            .agg(F.count("*").alias("c"), F.min("rid").alias("rid"), F.min("pos").alias("pos"))
            .where("c = 1").groupBy("rid").agg(F.collect_list("pos").alias("once")))
    return (packed.join(shared, "rid", "left").join(once, "rid", "left")
            .select("doc_id", "rid", "packed", "anchors", "once")
            .mapInArrow(_remove(window, period),
                        "doc_id long, n_words long, n_removed long, kept binary"))


def _pack_texts(batches):
    """Texts travel in zstd frames, which take half the shuffle space of plain ones."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in slices(batches):
        texts = [None if t is None else pack(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.binary())],
            names=["doc_id", "rid", "packed"])


def _unpacked(packed: list) -> list[list[bytes]]:
    """The words of packed texts."""
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(p).split() if p else [] for p in packed]


def _anchors(window: int, period: int, cover: tuple[int, ...]):
    def run(batches):
        hashes, length = WordHashes(), window - period + 1
        for batch in slices(batches):
            found, rids, places = [], [], []
            for rid, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.split() if text else ()
                if len(words) < window:
                    continue
                array = hashes.array(words)
                first = np.arange(0, len(words) - length + 1, period)
                at = (first[:, None] + np.array(cover)[None, :]).ravel()
                at = at[at <= len(words) - length]
                # 48 bits do for candidates: a chance meeting only costs a check
                found.append((window_hash(array, at, length, BASE_A) >> np.uint64(16))
                             .view(np.int64))
                rids.append(np.full(len(at), rid, np.int64))
                places.append(at.astype(np.int32))
            hashes.trim()
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in (found, rids, places)],
                    names=["h", "rid", "pos"])

    return run


def candidate_starts(n: int, anchors: list[int], window: int, period: int) -> np.ndarray:
    """Mask over window starts: those with one of ``anchors`` in their first ``period`` places."""
    edge = np.zeros(n + period + 1, np.int32)
    at = np.array(anchors)
    np.add.at(edge, np.maximum(at - period + 1, 0), 1)
    np.add.at(edge, at + 1, -1)
    return np.cumsum(edge)[:n - window + 1] > 0


def _windows(window: int, period: int):
    def run(batches):
        hashes = WordHashes()
        for batch in slices(batches, 64):
            out = []
            rids, packed, anchor_lists = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for rid, words, anchors in zip(rids, _unpacked(packed), anchor_lists):
                array = hashes.array(words)
                at = np.flatnonzero(candidate_starts(len(words), anchors, window, period))
                w1 = sliding_hash(array, window, BASE_A)[at].view(np.int64)
                w2 = (sliding_hash(array, window, BASE_B)[at] >> np.uint64(49)).astype(np.int16)
                out.append((w1, w2, np.full(len(at), rid, np.int64), at.astype(np.int32)))
            hashes.trim()
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)],
                                             names=["w1", "w2", "rid", "pos"])

    return run


def _output(rows) -> pa.RecordBatch:
    ids, n, removed, kept = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])


def _remove(window: int, period: int):
    def run(batches):
        for batch in slices(batches, 64):
            rows = []
            ids, packed, anchor_lists, singles = (
                batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            for doc_id, words, anchors, once in zip(ids, _unpacked(packed), anchor_lists, singles):
                if not anchors:
                    rows.append((doc_id, len(words), 0, b" ".join(words)))
                    continue
                repeated = candidate_starts(len(words), anchors, window, period)
                if once:
                    repeated[np.array(once)] = False
                edge = np.zeros(len(words) + 1, np.int32)
                at = np.flatnonzero(repeated)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                keep = np.cumsum(edge)[:-1] == 0
                kept = [w for w, k in zip(words, keep.tolist()) if k]
                rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept)))
            yield _output(rows)

    return run
