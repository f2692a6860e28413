"""Vector code compression: product quantization with pivot bounds (LAESA).

Components become integers, ``floor(scale * x)``, and vectors are cut into equal parts. Every part position has a
codebook that is improved in rounds: each part goes to its nearest entry (squared Euclidean
distance, ties to the lower index), then an entry becomes the floor of the mean of its parts.

The pivots of a part position are fixed: entries of its first codebook, each the farthest from those before. Distances from
parts to pivots are computed once and stored with the parts. In a round only the distances
from pivots to entries are new; their differences, ``max |d(part, pivot) - d(entry, pivot)|``,
bound a part's distance to every entry from below. Each part first evaluates the entry with its lowest
bound; then entries come in the order of their mean bound, each evaluated exactly, and only for the parts whose bound
does not exceed their best distance so far. Sums stay below 2**53 in floating point or else are computed in 64-bit integers, so
evaluations are exact; bounds have a margin for rounding, so pruning never changes a result.

Spark partitions the vectors; a task returns per part and entry one count and sum, and the driver holds the
codebooks alone (``entries`` x dimensions numbers, whatever the input).

Defined results: rows are dropped if their vector is null or empty, holds a null or non-finite component or one so large that
distances leave 64 bits (131,072 at 64 dimensions), or differs in length from the vector of the smallest id.
That length must be a multiple of ``parts``. Null ids come last in the order of the first entries; rows that
repeat an id count each, ordered by vector. Fewer rows than ``entries`` make a smaller codebook.
An empty table gives an empty table. Other columns are kept, unless named like a new one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.llm.common import durable
from strata.session import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE, PIVOTS = 4, 256, 4, 1024, 16
CHUNK = 10_000  # parts whose bounds are held at once
EXACT = 1 << 53
CODES = "code string, error long"


def exact_dtype(a: np.ndarray, b: np.ndarray):
    """Floating point if it holds every sum of a squared distance exactly, else integers."""
    reach = int(np.abs(a).max(initial=0)) + int(np.abs(b).max(initial=0))
    return np.float64 if reach * reach * a.shape[1] < EXACT else np.int64


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``."""
    t = exact_dtype(a, b)
    a, b = a.astype(t), b.astype(t)
    return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)


def choose_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Rows of ``entries``, each the farthest from those before it."""
    chosen, nearest = [0], squared(entries, entries[:1])[:, 0]
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(squared(rows, pivots).astype(np.float64)).astype(np.float32)


class Nearest:
    """Nearest entries of one part position: exact, with pivot bounds. ``evaluated`` counts the pairs whose
    distance was computed."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.bounds = entries, pivot_distances(entries, pivots)
        self.evaluated = 0

    def __call__(self, rows: np.ndarray, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of every row; ``distances``: of the rows to the pivots."""
        entry, error = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for start in range(0, len(rows), CHUNK):
            part = slice(start, start + CHUNK)
            entry[part], error[part] = self._chunk(rows[part], distances[part])
        return entry, error

    def _chunk(self, rows, distances):
        lower = np.zeros((len(self.entries), len(rows)), np.float32)
        gap = np.empty_like(lower)
        for j, far in enumerate(np.ascontiguousarray(distances.T)):
            np.subtract(self.bounds[:, j:j + 1], far, out=gap)
            np.maximum(lower, np.abs(gap, out=gap), out=lower)
        # float32 distances are off by less than 1e-7 of themselves
        margin = 1e-6 * (distances.max(1) + self.bounds.max())
        t = exact_dtype(rows, self.entries)
        rows, entries = rows.astype(t), self.entries.astype(t)
        row_squares, entry_squares = (rows * rows).sum(1), (entries * entries).sum(1)

        def evaluate(at, entry):  # of rows ``at``
            self.evaluated += len(at)
            cross = (rows[at] @ entries[entry] if np.isscalar(entry)
                     else (rows[at] * entries[entry]).sum(1))
            return row_squares[at] - 2 * cross + entry_squares[entry]

        def reach(best, at):  # an entry with a higher bound is farther than the best one
            return np.sqrt(best) * (1 + 1e-6) + margin[at]

        everyone = np.arange(len(rows))
        first = lower.argmin(0)
        chosen, best = first.copy(), evaluate(everyone, first)
        near = reach(best, everyone)
        for entry in lower.mean(1).argsort(kind="stable").tolist():
            at = np.flatnonzero((lower[entry] <= near) & (first != entry))
            d, own = evaluate(at, entry), best[at]
            won = (d < own) | ((d == own) & (entry < chosen[at]))
            at, d = at[won], d[won]
            best[at], chosen[at], near[at] = d, entry, reach(d, at)
        return chosen, best.astype(np.int64)


@dataclass
class Codes:
    """``rows``: the kept columns, ``code`` and ``error``; ``codebooks``: parts x entries x components."""
    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        """sha256 of all components as decimal numbers, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def usable(vectors: DataFrame, vector_col: str, scale: int) -> DataFrame:
    """Rows with a usable vector, as doubles in ``_vector``."""
    v = F.col(vector_col)
    size = F.size(v)
    # with |component| below this, sums of squared differences stay below 2**62
    least = F.sqrt(F.lit(float(1 << 60)) / size) / scale
    good = v.isNotNull() & (size > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= least))
    return vectors.where(F.coalesce(good, F.lit(False))).withColumn("_vector", v.cast("array<double>"))


def first_rows(rows: DataFrame, id_col: str, entries: int) -> list:
    """The vectors of the smallest ids; all have the length of the first."""
    def take(frame):
        return [r[0] for r in frame.orderBy(F.col(id_col).asc_nulls_last(), "_vector").limit(entries)
                .select("_vector").collect()]

    found = take(rows)
    if len({len(v) for v in found}) > 1:
        found = take(rows.where(F.size("_vector") == len(found[0])))
    return found


def to_integers(batch_column, dimensions: int, scale: int) -> np.ndarray:
    values = batch_column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(values * scale).astype(np.int64).reshape(-1, dimensions)


def unpack(column, dtype, shape: tuple) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, *shape)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             keep: list[str] | None = None, parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE, pivots: int = PIVOTS) -> Codes:
    """Codes of all usable vectors, with the columns ``keep`` (all but the vector by default).

    ``code`` has two hex digits per part, ``error`` is the squared distance summed over parts. The integer parts
    and their pivot distances are written once below the checkpoint folder.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be between 1 and 256: a part's code has two hex digits")
    spark = vectors.sparkSession
    added = StructType.fromDDL(CODES)
    keep = [c for c in (vectors.columns if keep is None else keep)
            if c not in added.names and (keep is not None or c != vector_col)]
    rows = usable(vectors, vector_col, scale)
    first = first_rows(rows, id_col, entries)
    out = StructType([rows.schema[c] for c in keep] + added.fields)
    if not first:
        return Codes(spark.createDataFrame([], out), np.zeros((parts, 0, 0), np.int64))
    dimensions = len(first[0])
    if dimensions % parts:
        raise ValueError(f"vectors of {dimensions} components do not make {parts} equal parts")
    width = dimensions // parts
    books = np.floor(np.array(first) * scale).astype(np.int64).reshape(-1, parts, width).swapaxes(0, 1)
    fixed = [choose_pivots(b, pivots) for b in books]
    n_pivots = len(fixed[0])
    at = len(keep)
    stored = StructType([rows.schema[c] for c in keep]).add("_parts", "binary").add("_pivots", "binary")

    def prepare(batches):
        for batch in batches:
            whole = to_integers(batch.column(at), dimensions, scale).reshape(-1, parts, width)
            far = np.stack([pivot_distances(whole[:, p], fixed[p]) for p in range(parts)], 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array([r.tobytes() for r in whole.astype(np.int32)], pa.binary()),
                 pa.array([r.tobytes() for r in far], pa.binary())], names=stored.names)

    path = scratch_path(spark, "vector-parts")
    (rows.where(F.size("_vector") == dimensions).select(*keep, "_vector")
     .mapInArrow(prepare, stored).write.parquet(path))
    table = spark.read.schema(stored).parquet(path)

    def nearest(batches, books, column):
        finders = [Nearest(books[p], fixed[p]) for p in range(parts)]
        for batch in batches:
            if batch.num_rows:
                whole = unpack(batch.column(column), np.int32, (parts, width)).astype(np.int64)
                far = unpack(batch.column(column + 1), np.float32, (parts, n_pivots))
                yield batch, whole, [finders[p](whole[:, p], far[:, p]) for p in range(parts)]

    def improve(books):
        def sums(batches):
            count = np.zeros(books.shape[:2], np.int64)
            total = np.zeros(books.shape, np.int64)
            for _, whole, found in nearest(batches, books, 0):
                for p, (entry, _) in enumerate(found):
                    count[p] += np.bincount(entry, minlength=books.shape[1])
                    by_entry = entry.argsort(kind="stable")
                    runs = np.flatnonzero(np.diff(entry[by_entry], prepend=-1))
                    total[p, entry[by_entry][runs]] += np.add.reduceat(whole[by_entry, p], runs)
            used = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used[0].astype(np.int32)), pa.array(used[1].astype(np.int32)), pa.array(count[used]),
                 pa.array(list(total[used]), pa.list_(pa.int64()))], names=["part", "entry", "n", "s"])

        partial = table.select("_parts", "_pivots").mapInArrow(sums, "part int, entry int, n long, s array<long>")
        summed = partial.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)])
        better = books.copy()
        for r in summed.collect():  # at most parts x entries rows
            better[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
        return better

    for _ in range(rounds):
        books = improve(books)

    def assign(batches):
        for batch, _, found in nearest(batches, books, at):
            codes = np.stack([e for e, _ in found], 1).astype(np.uint8)
            error = sum(d for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at], pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(error, pa.int64())], names=out.names)

    return Codes(table.mapInArrow(assign, out), books)


def with_label_error(rows: DataFrame, label_col: str = "label", error_col: str = "error") -> DataFrame:
    """Adds ``label_error``, the sum of errors over equal labels (nulls are equal).

    Errors are summed in the map tasks first. The sums are stored, so that the join's sides are plain exchanges and
    adaptive execution may split a label with very many rows, or broadcast the sums if their measured size allows.
    """
    rows = durable(rows)
    sums = durable(rows.groupBy(F.col(label_col).alias("_label")).agg(F.sum(error_col).alias("label_error")))
    return rows.join(sums, F.col(label_col).eqNullSafe(F.col("_label"))).drop("_label")
