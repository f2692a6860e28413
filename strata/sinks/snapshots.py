"""Tables that change together, a day at a time (K4, ST4, ST6).

A group of tables below one root, all divided by ``event_day``. A commit writes the touched days of every
table into folders of a new version, then a manifest that names the version of every day, and
last one pointer row. Readers start from the newest pointer, so they see all tables before a commit or
all after it. A day of which a commit writes no rows has no files in its version: it vanishes.

::

    <root>/<table>/version=<n>/event_day=<day>/part-*.parquet
    <root>/manifest/version=<n>/part-*.parquet        (event_day, day_version)
    <root>/pointer/part-*.parquet                     (version, writer, epoch)
    <root>/touched/part-*.parquet                     (event_day), written after the pointer

Every pointer row is one file that a job commit renames into place, so it is there or not. A job that dies before
leaves the last snapshot as it was; the next commit takes the same version number and replaces what was left of it. An epoch
that a pointer row names is not committed again, so a replayed micro-batch changes nothing. One
writer at a time.
"""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import L, S, struct
from strata.session import checkpoint_root, list_paths, remove_path
from strata.sinks.writers import write_layer
from strata.sources.landing import empty, read_table

DAY = "event_day"
NO_DAY = "none"  # day of events without a time: joins on the day need a value
POINTER = struct(version=L, writer=S, epoch=L)
MANIFEST = struct(event_day=S, day_version=L, version=L)
TOUCHED = struct(event_day=S)


def day_of(year: str = "year", month: str = "month", day: str = "day_of_month") -> Column:
    """The day key of an event: the date of its calendar parts as text, or ``NO_DAY``."""
    text = F.concat_ws("-", F.col(year), F.lpad(F.col(month).cast("string"), 2, "0"),
                       F.lpad(F.col(day).cast("string"), 2, "0"))
    return F.when(F.col(year).isNull(), F.lit(NO_DAY)).otherwise(text)


class DayTables:
    """A group of day tables with declared schemas (data columns without ``event_day``)."""

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, T.StructType]):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = {name: T.StructType([f for f in s if f.name != DAY]) for name, s in schemas.items()}

    def _pointers(self) -> DataFrame:
        found = read_table(self.spark, f"{self.root}/pointer", POINTER)
        return empty(self.spark, POINTER) if found is None else found

    def current(self) -> int:
        """Version of the newest snapshot, 0 before the first commit."""
        return self._pointers().agg(F.max("version")).first()[0] or 0

    def committed(self, writer: str, epoch: int) -> bool:
        return not self._pointers().where((F.col("writer") == writer) & (F.col("epoch") == epoch)).isEmpty()

    def manifest(self, version: int | None = None) -> DataFrame:
        """``(event_day, day_version)`` of a snapshot (the newest by default)."""
        version = self.current() if version is None else version
        found = read_table(self.spark, f"{self.root}/manifest", MANIFEST)
        if found is None:
            return empty(self.spark, MANIFEST).drop("version")
        return found.where(F.col("version") == version).drop("version")

    def read(self, name: str, days: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """Rows of a table, of ``days`` alone if given (a frame with ``event_day``).

        The folders are pruned at run time by the days and versions that the manifest names for
        ``days``: dynamic partition pruning, as the manifest is small and filtered. The semi join makes it exact.
        """
        schema = self._stored(name)
        found = read_table(self.spark, f"{self.root}/{name}", schema)
        if found is None:
            return empty(self.spark, schema).drop("version")
        wanted = self.manifest(version)
        if days is not None:
            wanted = wanted.join(days.select(DAY), DAY, "left_semi")
        wanted = wanted.select(DAY, F.col("day_version").alias("version"))
        return found.join(wanted, [DAY, "version"], "left_semi").drop("version")

    def _stored(self, name: str) -> T.StructType:
        return T.StructType(list(self.schemas[name].fields)).add("version", "long").add(DAY, "string")

    def commit(self, days: DataFrame, frames: Mapping[str, DataFrame | Callable], writer: str, epoch: int) -> int:
        """Replace ``days`` in every table by the rows of ``frames`` and return the new version.

        A frame may be a function of the tables already written in this commit (name -> its new rows). ``days``
        must be stored (checkpointed): it is read several times.
        """
        last = self.current()
        version = last + 1
        new: dict[str, DataFrame] = {}
        for name, frame in frames.items():
            frame = frame(new) if callable(frame) else frame
            path = f"{self.root}/{name}/version={version}"
            columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schemas[name]]
            write_layer(frame.select(*columns, DAY), path, partition_by=(DAY,))
            schema = T.StructType(list(self.schemas[name].fields)).add(DAY, "string")
            new[name] = self.spark.read.schema(schema).parquet(path)
        touched = days.select(DAY, F.lit(version).cast("long").alias("day_version"))
        rest = self.manifest(last).join(days.select(DAY), DAY, "left_anti")
        (touched.unionByName(rest).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}"))
        self._append("pointer", [(version, writer, epoch)], POINTER)
        return version

    def announce(self, days: DataFrame) -> None:
        """Log the days of a commit for streams that follow this group. Call it after the commit, and again for
        a replayed epoch: followers rebuild a day to the same rows."""
        days.select(DAY).coalesce(1).write.mode("append").parquet(f"{self.root}/touched")

    def changes(self) -> DataFrame:
        """The announced days as a stream."""
        path = f"{self.root}/touched"
        if read_table(self.spark, path, TOUCHED) is None:
            self._append("touched", [], TOUCHED)
        return self.spark.readStream.schema(TOUCHED).parquet(path)

    def _append(self, name: str, rows: list, schema: T.StructType) -> None:
        (self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}"))

    def vacuum(self, keep: int = 2) -> int:
        """Remove day folders that none of the last ``keep`` snapshots names; returns how many.

        Lists folders, not files; what is named is at most one version per day and snapshot.
        """
        current = self.current()
        oldest = max(current - keep + 1, 1)
        named = {(r.day_version, r.event_day) for v in range(oldest, current + 1) for r in self.manifest(v).collect()}
        removed = 0
        for name in self.schemas:
            for path in list_paths(self.spark, f"{self.root}/{name}/version=*/{DAY}=*"):
                version, day = (part.split("=")[1] for part in path.split("/")[-2:])
                if int(version) <= current and (int(version), day) not in named:
                    removed += remove_path(self.spark, path)
        for path in list_paths(self.spark, f"{self.root}/manifest/version=*"):
            if int(path.rsplit("=", 1)[1]) < oldest:
                remove_path(self.spark, path)
        return removed


def stored(df: DataFrame) -> DataFrame:
    """The frame in the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()
