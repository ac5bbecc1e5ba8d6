"""What the operators share: stored intermediate tables, row order without one big task, and a plain reader."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.session import configure, shared_folder

#: White space of the operators' contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives the package to the Python workers, once a Spark application: executors need not have it installed."""
    context, package = spark.sparkContext, Path(__file__).resolve().parent.parent
    if context.applicationId in _SHIPPED or not package.is_dir():
        return
    files = sorted(package.rglob("*.py"))
    content = hashlib.md5(b"".join(f.read_bytes() for f in files)).hexdigest()[:12]
    archive = Path(tempfile.mkdtemp(prefix="marketlake-code-")) / f"marketlake-{content}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in files:
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


_SHIPPED: set[str] = set()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a frame to the shared folder and reads it back: lost executors lose none of it, and nothing is computed twice."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """As `stored`, in as many buckets as a shuffle has partitions: joins on the keys read it without shuffling it."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    table_name = "scratch_" + path.rsplit("-", 1)[-1]
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", path).bucketBy(number, *keys).sortBy(*keys).saveAsTable(table_name)
    return spark.table(table_name)


def discard(df: DataFrame) -> None:
    """Deletes the files of a `stored` frame that no later step reads."""
    spark = df.sparkSession
    for file in df.inputFiles():
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def size_in_words(text: Column) -> Column:
    """Number of runs of anything but white space."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Numbers all rows from 0 in the given order, ties in any order.

    The rows are dealt out by ranges of the order and stored, numbered within each range, and shifted by the
    sizes of the ranges before. Only those sizes (one row for each shuffle partition) meet in one task.
    """
    ranges = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.withColumn(name, within - 1)
        .join(F.broadcast(starts), "_range")  # one row for each shuffle partition
        .withColumn(name, (F.col(name) + F.col("_start")).cast("long"))
        .drop("_range", "_start")
    )
