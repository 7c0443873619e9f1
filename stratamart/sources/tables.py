"""Warehouse tables: Parquet folders in three layers, replaced slice by slice.

Files are never changed. Every write goes to a folder of its own version, ``_version=n``, and a small
pointer file then names, for each slice of the table, the version that holds it. Readers resolve the
newest pointer, so they see the table as it was before a write or after it, never in between; a writer
that is lost on the way leaves files that no pointer names. The version before the current one is kept
for readers that have begun on it, older files are deleted. There is one writer at a time. Lost tasks
and executors are retried by Spark before any of that.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

LAYERS = ("bronze", "silver", "gold")
_NULL_SLICE = "__HIVE_DEFAULT_PARTITION__"
_VERSION = "_version"
_POINTERS = "_pointers"


class Replaced(NamedTuple):
    """What a write put in place: its rows, and the slices they went to."""

    rows: int
    slices: set


class _Pointer(NamedTuple):
    """State of a table: its slices' folder names with the version that holds each."""

    version: int
    schema: str
    partition: str | None
    slices: dict[str, int]

    def folders(self) -> list[str]:
        return [f"{_VERSION}={at}/{name}" if name else f"{_VERSION}={at}" for name, at in self.slices.items()]


def even_files(df: DataFrame, *columns: str) -> DataFrame:
    """Shuffle for writing: few files per slice, large slices split over several tasks."""
    return df.hint("rebalance", *columns)


class Warehouse:
    """Tables under one root, addressed as ``layer.name``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        layer, _, name = table.partition(".")
        if layer not in LAYERS or not name:
            raise ValueError(f"a table is named layer.name with layer in {LAYERS}, got {table!r}")
        return f"{self.root}/{layer}/{name}"

    # ---- small files and folders, by the file system that Spark itself uses for the path

    def _hadoop(self, path: str):
        """Hadoop path and its file system. Small files only: data is read and written by Spark."""
        found = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, path: str) -> list[str]:
        found, files = self._hadoop(path)
        if not files.exists(found):
            return []
        return [status.getPath().getName() for status in files.listStatus(found)]

    def _delete(self, path: str) -> None:
        found, files = self._hadoop(path)
        files.delete(found, True)

    def _pointer(self, table: str) -> _Pointer | None:
        folder = f"{self.path(table)}/{_POINTERS}"
        numbers = [int(name) for name in self._names(folder) if name.isdigit()]
        if not numbers:
            return None
        found, files = self._hadoop(f"{folder}/{max(numbers)}")
        stream = files.open(found)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return _Pointer(**json.loads(text))

    def _switch(self, table: str, pointer: _Pointer) -> None:
        """Make a written version the current one: a whole file appears under its name at once."""
        folder = f"{self.path(table)}/{_POINTERS}"
        draft, files = self._hadoop(f"{folder}/draft-{pointer.version}")
        stream = files.create(draft, True)
        stream.write(bytearray(json.dumps(pointer._asdict()).encode()))
        stream.close()
        if not files.rename(draft, self._hadoop(f"{folder}/{pointer.version}")[0]):
            raise RuntimeError(f"version {pointer.version} of {table} exists: is there a second writer?")

    def _clean(self, table: str, kept: list[_Pointer]) -> None:
        """Delete what neither of the kept versions names."""
        path, named = self.path(table), {folder for pointer in kept for folder in pointer.folders()}
        newest = max(pointer.version for pointer in kept)
        for version in self._names(path):
            if not version.startswith(f"{_VERSION}=") or int(version.split("=")[1]) > newest:
                continue
            inside = [f"{version}/{name}" for name in self._names(f"{path}/{version}") if "=" in name]
            if version not in named and not named.intersection(inside):
                self._delete(f"{path}/{version}")
            else:
                for folder in inside:
                    if folder not in named and version not in named:
                        self._delete(f"{path}/{folder}")
        for name in self._names(f"{path}/{_POINTERS}"):
            if name.isdigit() and int(name) < min(pointer.version for pointer in kept):
                self._delete(f"{path}/{_POINTERS}/{name}")

    # ---- tables

    def exists(self, table: str) -> bool:
        return self._pointer(table) is not None

    def slices(self, table: str, column: str) -> list[dt.date]:
        """Periods a table is stored for, ascending, from the names of its slices."""
        pointer = self._pointer(table)
        if pointer is None:
            raise ValueError(f"{table} has not been stored")
        names = [name.removeprefix(f"{column}=") for name in pointer.slices if name.startswith(f"{column}=")]
        return sorted(dt.date.fromisoformat(name) for name in names if name != _NULL_SLICE)

    def read(self, table: str, schema: StructType | None = None) -> DataFrame:
        """The table as of now; a later write does not change what this frame reads."""
        pointer = self._pointer(table)
        if pointer is None:
            raise ValueError(f"{table} has not been stored")
        schema = schema or StructType.fromJson(json.loads(pointer.schema))
        if not pointer.slices:
            return self.spark.createDataFrame([], schema)
        path = self.path(table)
        reader = self.spark.read.schema(schema).option("basePath", path)
        return reader.parquet(*[f"{path}/{folder}" for folder in pointer.folders()]).drop(_VERSION)

    def _write(
        self, table: str, df: DataFrame, partition: str | None, only: dt.date | str | None = None
    ) -> tuple[int, Replaced, dict[str, int]]:
        """Write ``df`` as the next version; rows and slices are noted while they are written."""
        before = self._pointer(table)
        version = before.version + 1 if before else 1
        written = Observation()
        if only is not None:
            return self._write_slice(table, df.drop(partition), version, f"{partition}={only}", only)
        values = [] if partition is None else [F.collect_set(F.coalesce(F.col(partition).cast("string"), F.lit(_NULL_SLICE))).alias("slices")]
        target = f"{self.path(table)}/{_VERSION}={version}"
        writer = df.observe(written, F.count(F.lit(1)).alias("rows"), *values).write.mode("overwrite")
        (writer if partition is None else writer.partitionBy(partition)).parquet(target)
        if partition is None:
            return version, Replaced(written.get["rows"], set()), {"": version}
        folders = [name for name in self._names(target) if name.startswith(f"{partition}=")]
        found = {None if x == _NULL_SLICE else x for x in written.get["slices"]}
        if df.schema[partition].dataType.typeName() == "date":
            found = {x and dt.date.fromisoformat(x) for x in found}
        return version, Replaced(written.get["rows"], found), dict.fromkeys(folders, version)

    def _write_slice(
        self, table: str, df: DataFrame, version: int, name: str, value: dt.date | str
    ) -> tuple[int, Replaced, dict[str, int]]:
        """Write rows of one known slice straight into its folder. A partitioned write would sort each task's rows by slice.

        Such slices are deliveries as text, of which zstd leaves a fifth less than the default codec."""
        written = Observation()
        target = f"{self.path(table)}/{_VERSION}={version}/{name}"
        df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "zstd").parquet(target)
        rows = written.get["rows"]
        return version, Replaced(rows, {value} if rows else set()), {name: version}

    def _put(
        self, table: str, df: DataFrame, partition: str | None, keep_others: bool, only: dt.date | str | None = None
    ) -> Replaced:
        before = self._pointer(table)
        version, replaced, slices = self._write(table, df, partition, only)
        if keep_others and not replaced.rows:
            self._delete(f"{self.path(table)}/{_VERSION}={version}")
            return replaced
        if keep_others and before is not None:
            slices = before.slices | slices
        fields = [f for f in df.schema.fields if f.name != partition] + [f for f in df.schema.fields if f.name == partition]
        pointer = _Pointer(version, StructType(fields).json(), partition, slices)
        self._switch(table, pointer)
        self._clean(table, [pointer, before] if before else [pointer])
        return replaced

    def rebuild(self, table: str, df: DataFrame, partition: str | None = None, dealt: bool = False) -> DataFrame:
        """Write a derived table anew. It can always be rebuilt from bronze. ``dealt``: ``even_files`` is in the plan already."""
        self._put(table, df if partition is None or dealt else even_files(df, partition), partition, keep_others=False)
        return self.read(table)

    def replace(self, table: str, df: DataFrame, partition: str, only: dt.date | str | None = None) -> Replaced:
        """Replace the slices of ``partition`` that occur in ``df``; without rows nothing is.

        ``only`` states that all rows belong to that one slice: they are then written as they come, unsorted.
        """
        if isinstance(only, str) and not re.fullmatch(r"\w+", only):
            raise ValueError(f"a slice stated by name is letters, digits and underscores, got {only!r}")
        return self._put(table, df, partition, keep_others=True, only=only)

    def publish(self, table: str, df: DataFrame) -> None:
        """Make a frame readable from SQL as ``layer_name``, as a view: nothing is stored."""
        self.path(table)
        df.createOrReplaceTempView(table.replace(".", "_"))
