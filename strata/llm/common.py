"""Helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.session import checkpoint_root, scratch_path

# Rows handled at once inside a Python task; bounds the memory of derived lists.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20
# Entries kept in a per-task memo before it is emptied.
MEMO_ENTRIES = 400_000


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder, so a lost executor costs no rerun."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared scratch folder: its lineage is cut and its size known."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_bytes(text: str = "text"):
    """The text column as UTF-8 bytes: Python tasks split bytes without decoding them."""
    return F.col(text).cast("binary").alias("text")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Pieces of at most ``rows`` rows that hold about ``limit`` bytes (or one row)."""
    for batch in batches:
        sizes = np.zeros(batch.num_rows, np.int64)
        for column in batch.columns:
            if pa.types.is_binary(column.type) or pa.types.is_string(column.type):
                sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64)
        total = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = total[start - 1] if start else 0
            end = int(np.searchsorted(total, before + limit, "right"))
            end = min(max(end, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def give_back_memory() -> None:
    """Return freed memory to the system. Python workers outlive their tasks, and what an allocator holds on
    to counts against the next stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that gives its memory back when its task ends."""
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back_memory()

    return tidy


def map_texts(docs: DataFrame, keep: list[str], new: str, make: Callable,
              text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of every row and the ``new`` columns (DDL) that are made from its text.

    ``make()`` builds, inside a task, the function from a list of texts (bytes or None) to the
    Arrow arrays of the new columns; if it returns a mask as well, only those rows stay. A kept column with
    the name of a new one is replaced.
    """
    added = StructType.fromDDL(new)
    keep = [c for c in keep if c not in added.names]
    rows = docs.select(*keep, F.col(text_col).cast("binary").alias("_text"))
    schema = StructType([rows.schema[c] for c in keep] + added.fields)

    def run(batches):
        work = make()
        for batch in slices(batches):
            made = work(batch.column(len(keep)).to_pylist())
            made, mask = made if isinstance(made, tuple) else (made, None)
            out = pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=schema.names)
            yield out if mask is None else out.filter(pa.array(mask, pa.bool_()))

    return rows.mapInArrow(tidied(run), schema)


class WordHashes(dict):
    """Memo word -> 64-bit hash. Emptied by ``trim`` once it holds ``MEMO_ENTRIES`` words."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def trim(self) -> None:
        if len(self) > MEMO_ENTRIES:
            self.clear()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def window_hash(words: np.ndarray, starts: np.ndarray, length: int, base: int) -> np.ndarray:
    """Polynomial hash of ``words[s:s + length]`` for each ``s`` in ``starts`` (mod 2**64)."""
    h = np.zeros(len(starts), np.uint64)
    for j in range(length):
        h = h * np.uint64(base) + words[starts + j]
    return mix(h)


def sliding_hash(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """``window_hash`` at every start, without index arrays."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(length):
        h = h * np.uint64(base) + words[j:j + n]
    return mix(h)


BASE_A = 0xD6E8FEB86659FD93
BASE_B = 0xA0761D6478BD642F


class WordScanner:
    """Hashes of all words of a buffer at once, without making the words.

    A word is read in pieces of eight bytes, the last padded with zeros; its hash is made of its length, the first
    piece and a sum over the others with their places. Words are runs of bytes other than ASCII white space.
    """

    def __init__(self):
        self.masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def scan(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, starts, bytes as an array) of the words of ``buffer``, in order."""
        data = np.frombuffer(buffer, np.uint8)
        word = np.zeros(len(data) + 2, bool)
        np.logical_not((data == 32) | (data - np.uint8(9) < 5), out=word[1:-1])
        edges = np.flatnonzero(word[1:] != word[:-1])
        starts, size = edges[::2], edges[1::2] - edges[::2]
        if not len(starts):
            return np.zeros(0, np.uint64), starts, data
        eight = np.ndarray(len(data), "<u8", buffer + bytes(8), strides=(1,))  # the piece at every byte
        hashes = mix((eight[starts] & self.masks[np.minimum(size, 8)])
                     ^ (size.astype(np.uint64) * np.uint64(BASE_A)))
        long = np.flatnonzero(size > 8)
        if len(long):
            pieces = (size[long] - 1) >> 3  # after the first
            first = np.cumsum(pieces) - pieces
            skip = 8 * (np.arange(int(pieces.sum())) - np.repeat(first, pieces) + 1)
            left = np.minimum(np.repeat(size[long], pieces) - skip, 8)
            piece = eight[np.repeat(starts[long], pieces) + skip] & self.masks[left]
            hashes[long] += np.add.reduceat(mix(mix(piece + skip.astype(np.uint64) * np.uint64(BASE_B))), first)
        return mix(hashes), starts, data
