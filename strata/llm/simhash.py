"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are compared, never their copies. Two fingerprints within ``radius`` bits
agree in all but ``radius`` of ``blocks`` bit blocks, so every pair meets in a group of equal
blocks. A group is compared in tiles with numpy exclusive-or and bit counts; its rows are ordered
by population count, and a tile pair whose counts differ by more than the radius is skipped. A
group of more than ``tile_rows`` is cut into blocks of rows, and each pair of blocks is a unit of
its own, so no task takes an unbounded group. A unit passes on a spanning forest of its links, not all pairs; components
join the forests.

Defined results: null, empty and word-free texts have fingerprint zero and are linked like any
other; repeated rows each get a row; a null ``doc_id`` has a fingerprint and, if every member of its component is
null, a null component; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import durable, map_texts, tidied
from strata.llm.graph import components
from strata.operators.skew import join_aggregate

SHINGLE_WORDS = 3
RADIUS = 2
BLOCKS = 4
TILE_ROWS = 8192
TILE = 512
SEED = 42
CHUNK = 1 << 14


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> np.uint64:
    """64-bit SimHash of the word shingles of a UTF-8 text (A-Z in lower case)."""
    words = text.lower().split() if text else []
    if not words:
        return np.uint64(0)
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    spans = list(zip(starts, ends[shingle - 1:])) or [(0, len(joined))]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.uint32)
    for at in range(0, len(spans), CHUNK):
        hashes = np.array([digest(joined[s:e], seed) for s, e in spans[at:at + CHUNK]], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * counts > len(spans), bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE_WORDS,
                 text_col: str = "text") -> DataFrame:
    """Columns ``keep`` and ``fp`` (long) of every row."""
    def make():
        def work(texts):
            fps = np.array([fingerprint(t, shingle) for t in texts], "<u8")
            return [pa.array(fps.view("<i8"))]

        return work

    return map_texts(docs, keep, "fp long", make, text_col)


def join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union the pairs (a, b) in a forest of smallest members; returns the flat forest."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while (flat := root[root]).tobytes() != root.tobytes():
            root = flat
    return root


def tiled_forest(fps: np.ndarray, radius: int, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Links (child, root) that connect the distinct ``fps`` as all pairs within ``radius`` do."""
    weights = np.bitwise_count(fps)
    order = np.argsort(weights, kind="stable")
    fps, weights = fps[order], weights[order].astype(np.int16)
    root = np.arange(len(fps))
    for i in range(0, len(fps), tile):
        left = fps[i:i + tile]
        for j in range(i, len(fps), tile):
            if weights[j] - weights[min(i + tile, len(fps)) - 1] > radius:
                break  # every later tile differs by more
            near = np.bitwise_count(left[:, None] ^ fps[None, j:j + tile]) <= radius
            if j == i:
                near = np.triu(near, 1)
            a, b = np.nonzero(near)
            root = join_roots(root, a + i, b + j)
    child = np.flatnonzero(root != np.arange(len(root)))
    return fps[child], fps[root[child]]


def near_links(classes: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
               tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are those of all pairs."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << bounds[i + 1]) - (1 << bounds[i])) for i in range(blocks)]
    keys = []
    for n, kept in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[i] for i in kept)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).alias("n"),
                             F.col("fp").bitwiseAND(F.lit(signed)).alias("bits")))
    met = classes.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.n", "k.bits")
    large = (met.groupBy("n", "bits").agg(F.count("*").alias("c")).where(F.col("c") > 1)
             .select("n", "bits", F.ceil(F.col("c") / tile_rows).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    units = (join_aggregate(met, large, ["n", "bits"])
             .select("fp", "n", "bits", own.alias("own"),
                     F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
             .select("fp", "n", "bits", F.least("own", "other").alias("p"),
                     F.greatest("own", "other").alias("q")))

    def run(batches):
        held = None
        for batch in batches:
            table = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)])
            held = table if held is None else np.concatenate([held, table], axis=1)
            cuts = np.flatnonzero((held[1:, 1:] != held[1:, :-1]).any(axis=0)) + 1
            if len(cuts):
                yield forest(held[:, :cuts[-1]], cuts)
                held = held[:, cuts[-1]:]
        if held is not None:
            yield forest(held, np.zeros(0, int))

    def forest(table, cuts):
        edges = np.concatenate([[0], cuts[cuts < table.shape[1]], [table.shape[1]]]).astype(int)
        out = [(np.zeros(0, "<u8"),) * 2]
        for s, e in zip(edges[:-1], edges[1:]):
            if e - s > 1:
                out.append(tiled_forest(table[0, s:e].view("<u8"), radius))
        a, b = (np.concatenate(x).view("<i8") for x in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    unit = ["n", "bits", "p", "q"]
    return (units.repartition(*unit).sortWithinPartitions(*unit)
            .mapInArrow(tidied(run), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
                    blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, columns ``keep``, fp, root, component_id) of every row.

    Rows are in one component if links of fingerprints that differ in ``radius`` bits or fewer
    connect them: ``root`` is its smallest fingerprint, ``component_id`` its smallest id.
    """
    source = docs.withColumn("doc_id", F.col(id_col).cast("long"))
    fps = durable(fingerprints(source, ["doc_id", *keep], shingle, text_col))
    classes = durable(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = durable(components(near_links(classes, radius, blocks)))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", *keep, "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null ids last), then the smallest
    text hash; rows equal in both are one."""
    key, text_hash = "_simhash_id", "_simhash_text"
    marked = (docs.withColumn(text_hash, F.xxhash64(text_col))
              .withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))))
    found = near_duplicates(marked, shingle, radius, BLOCKS, id_col, text_col, (key, text_hash))
    stays = (found.groupBy("root").agg(F.min(F.struct(key, text_hash)).alias("at"))
             .select(f"at.{key}", f"at.{text_hash}"))
    return (marked.join(stays, [key, text_hash], "left_semi")
            .dropDuplicates([key, text_hash]).drop(key, text_hash))
