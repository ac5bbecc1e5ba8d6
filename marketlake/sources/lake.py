"""Layered Parquet lake: `{base}/{layer}/{table}/event_date=.../`, on any file system Spark can reach."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.casts import to_utc

EVENT_DATE = "event_date"
# The column that date-partitioned tables are stored by: the date, or the first of its month.
PART = "_part"
BATCH = "_batch"
# Compression of stored tables: text-heavy rows take about a third less than with Spark's default.
CODEC = "zstd"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def on_dates(dates: Iterable[str | None], column: str | Column = EVENT_DATE) -> Column:
    """Rows of the given dates; None stands for rows without a usable timestamp."""
    dates, column = list(dates), F.col(column) if isinstance(column, str) else column
    days = [F.lit(date.fromisoformat(d)) for d in dates if d is not None]
    hit = column.isin(*days) if days else F.lit(False)
    return hit | column.isNull() if None in dates else hit


def files_digest(files: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()[:24]


@dataclass(frozen=True)
class Lake:
    """Tables under `base`. `unit` is the span of a partition: "day", or "month" for long histories with few rows a day,
    which would else be very many small files. Dates given to or got from a lake's partitions are the first of their span."""

    spark: SparkSession
    base: str
    unit: str = "day"

    def __post_init__(self) -> None:
        if self.unit not in ("day", "month"):
            raise ValueError(f"unit must be 'day' or 'month', not {self.unit!r}")

    def part(self, day: Column) -> Column:
        """The partition a date belongs to."""
        return F.trunc(day, "month") if self.unit == "month" else day

    def _keyed(self, df: DataFrame, partition: str) -> tuple[DataFrame, str]:
        """The frame with its partition column, and that column's name; dates stay in the files as they are."""
        if partition == EVENT_DATE and EVENT_DATE not in df.columns:
            df = df.withColumn(EVENT_DATE, F.to_date(to_utc(df)))
        if isinstance(df.schema[partition].dataType, T.DateType):
            return df.withColumn(PART, self.part(F.col(partition))), PART
        return df, partition

    def path(self, layer: str, table: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        """Whether the table holds any file; a write of no rows leaves an empty folder behind."""
        return any(not name.startswith(("_S", "_temporary", ".")) for name in self.names(self.path(layer, table)))

    def read(
        self,
        layer: str,
        table: str,
        schema: T.StructType | None = None,
        dates: Iterable[str | None] | None = None,
        position: bool = False,
        merge: bool = False,
        where: Column | None = None,
    ) -> DataFrame:
        """A whole table, files united by column name. A table without files is empty with `schema`.

        With `schema` no file is opened before the query runs: columns that a file lacks are NULL. Without it, `merge`
        looks at every file for its columns, instead of at one. `dates` prunes to those partitions, `where` to those its condition on
        `_batch` and `_part` holds for. `position` adds `_ingest_id`, the row's place in the stored files: unique per row and the same on
        every read.
        """
        path = self.path(layer, table)
        if not self.exists(layer, table):
            if schema is None:
                raise AnalysisException(f"no table at {path}")
            df = self.spark.createDataFrame([], schema).drop(BATCH, PART)
            return df.withColumn("_ingest_id", F.lit(None).cast("bigint")) if position else df
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        df = reader.option("mergeSchema", merge).parquet(path)
        if position:
            file, row = F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")
            df = df.select("*", F.struct(file.alias("file"), row.alias("row")).alias("_ingest_id"))
        df = df if where is None else df.filter(where)
        return (df if dates is None else df.filter(on_dates(dates, PART))).drop(BATCH, PART)

    def write(
        self, df: DataFrame, layer: str, table: str, partition: str = EVENT_DATE, dates: Iterable[str | None] | None = None,
        gather: bool = True,
    ) -> str:
        """Replace the partitions `df` has rows for, and no others. Running it again changes nothing.

        The rebalance hint gathers each date's rows into few files, and AQE splits a date too big for one
        task. With `dates`, those that came out empty are removed, so no stale row outlives a rerun. Without `gather` rows are
        written where they are: right for what comes row by row out of a table with the same partitions, whose tasks hold few of them each.
        """
        wanted = None if dates is None else {str(d or NULL_PARTITION) for d in dates}
        return self._write(df, layer, table, partition, lambda value: wanted is not None and value in wanted, gather)

    def replace(self, df: DataFrame, layer: str, table: str, partition: str | None = EVENT_DATE, gather: bool = True) -> str:
        """Replace the whole table. Readers see a partition's old rows or its new ones; partitions without new rows go last."""
        if partition is not None:
            return self._write(df, layer, table, partition, lambda value: True, gather)
        path = self.path(layer, table)
        fresh, old = (f"{path}-{word}-{uuid.uuid4().hex[:8]}" for word in ("new", "old"))
        df.write.option("compression", CODEC).parquet(fresh)
        fs, folder = self._fs(path)
        if fs.exists(folder):
            fs.rename(folder, self._fs(old)[1])
        fs.mkdirs(folder.getParent())
        fs.rename(self._fs(fresh)[1], folder)
        self.delete(old)
        return path

    def _write(self, df: DataFrame, layer: str, table: str, partition: str, goes: Callable[[str], bool], gather: bool) -> str:
        """Overwrite partitions, then remove those of the old ones that `goes` names and that got no new file."""
        path = self.path(layer, table)
        df, key = self._keyed(df, partition)
        before = self._partitions(path, key)
        (
            (df.hint("rebalance", key) if gather else df).write.mode("overwrite").option("compression", CODEC)
            .option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)
        )
        if before:
            after = self._partitions(path, key)
            for value, files in before.items():
                if goes(value) and after.get(value) == files:
                    self.delete(f"{path}/{key}={value}")
        return path

    def _partitions(self, path: str, partition: str) -> dict[str, frozenset[str]]:
        """Files by partition value, from one listing that Spark spreads over the executors where it is long."""
        if not self.names(path):
            return {}
        found: dict[str, set[str]] = {}
        for file in self.spark.read.schema("_none int").parquet(path).inputFiles():
            folder, _, name = file.rpartition("/")
            found.setdefault(unquote(folder.rpartition(f"{partition}=")[2].partition("/")[0]), set()).add(name)
        return {value: frozenset(names) for value, names in found.items()}

    def stored_files(self, layer: str, table: str) -> list[str]:
        """The table's files, from the listing that a read makes."""
        if not self.exists(layer, table):
            return []
        listed = self.spark.read.schema("_none int").parquet(self.path(layer, table)).inputFiles()
        return [unquote(f).rpartition(f"/{layer}/{table}/")[2] for f in listed]

    def digest(self, layer: str, table: str) -> str:
        """A name for what the table holds now: it changes with every write."""
        return files_digest(self.stored_files(layer, table))

    def append_batch(
        self, df: DataFrame, layer: str, table: str, batch: int, partition: str | None = EVENT_DATE, gather: bool = True
    ) -> str:
        """Add one batch under its own `_batch` partition; writing the same batch twice keeps one copy. Without `gather` rows are
        written where they are: right for partitions that are very few."""
        path = self.path(layer, table)
        keys = [BATCH]
        if partition is not None:
            df, key = self._keyed(df, partition)
            keys = [key, BATCH]
        df = df.withColumn(BATCH, F.lit(batch))
        (
            (df.hint("rebalance", *keys) if gather else df).write.mode("overwrite").option("compression", CODEC)
            .option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
        )
        return path

    def batch_rows(self, layer: str, table: str, batch: int, schema: T.StructType) -> DataFrame:
        """One batch's rows; its partitions alone are read."""
        schema = T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])
        if not self.exists(layer, table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(layer, table)).filter(F.col(BATCH) == batch)

    def has_batch(self, layer: str, table: str, batch: int) -> bool:
        """Whether the table holds rows of a batch; decided by partitions."""
        if not self.exists(layer, table):
            return False
        return not self.spark.read.schema(f"{BATCH} int").parquet(self.path(layer, table)).filter(F.col(BATCH) == batch).isEmpty()

    def drop_batch(self, layer: str, table: str, batch: int) -> None:
        """Take a batch's partitions out."""
        path = self.path(layer, table)
        if self.exists(layer, table):
            files = self.spark.read.schema(f"{BATCH} int").parquet(path).filter(F.col(BATCH) == batch).select("_metadata.file_path").distinct()
            for folder in {r.file_path.rpartition("/")[0] for r in files.collect()}:  # one for each of the batch's partitions
                self.delete(unquote(folder))

    def settle(self, name: str, used: list[str] | None = None):
        """A function that stores a frame under a new work folder and reads it back with its true size; `used` gets the folders."""

        def write_and_read(df: DataFrame) -> DataFrame:
            path = f"{self.path('_work', name)}-{uuid.uuid4().hex[:12]}"
            if used is not None:
                used.append(path)
            df.write.option("compression", CODEC).parquet(path)
            return self.spark.read.schema(df.schema).parquet(path)

        return write_and_read

    def date_files(self, folder: str) -> None:
        """Give a folder's files modification times in the order of their names, which is the order a file stream takes them in."""
        fs, path = self._fs(folder)
        files = sorted((s.getPath() for s in fs.listStatus(path)), key=lambda p: p.getName())
        start = fs.getFileStatus(path).getModificationTime() - 1000 * len(files)
        for n, file in enumerate(files):
            fs.setTimes(file, start + 1000 * n, -1)

    def _fs(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def names(self, folder: str) -> frozenset[str]:
        """What lies in a folder."""
        fs, path = self._fs(folder)
        return frozenset(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else frozenset()

    def write_note(self, file: str, text: str) -> None:
        """Replaces a small text file; readers see the old text, the new one, or for a moment none."""
        fs, path = self._fs(file)
        fresh = self._fs(f"{file}-{uuid.uuid4().hex[:8]}")[1]
        out = fs.create(fresh)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(path, False)
        fs.rename(fresh, path)

    def read_note(self, file: str) -> str | None:
        fs, path = self._fs(file)
        if not fs.exists(path):
            return None
        stream = fs.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, folder: str) -> None:
        fs, path = self._fs(folder)
        fs.delete(path, True)


def s3a_options(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Session options for a lake at `s3a://bucket` on an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }


def base_uri(backend: str = "local", local_dir: str = "./data", bucket: str | None = None) -> str:
    """Root of the lake for the configured backend; S3 needs the bucket's name."""
    if backend == "s3":
        if not bucket:
            raise ValueError("name the bucket")
        return f"s3a://{bucket}"
    if backend == "local":
        return local_dir
    raise ValueError(f"unknown storage backend {backend!r}")
