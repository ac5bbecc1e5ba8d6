"""Exact dedup against a persistent digest index.

The index is a table of SHA-256 digests, bucketed and sorted by digest. A batch is reduced to one row a digest,
matched with the index by a sort-merge anti-join that shuffles the batch but not the index, and the new digests are
appended. Whole texts are hashed, never shuffled.

Defined cases: a null text is an empty text; all texts of white space alone are equal; a null doc_id comes after all
others; of rows that repeat both doc_id and text exactly one stays; an empty table gives an empty result; further
columns are carried along whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import WHITE, scratch, stored, text_of


def digest(text: Column) -> Column:
    """SHA-256 of the text without white space, as bytes."""
    return F.unhex(F.sha2(F.regexp_replace(text, WHITE, ""), 256))


class DigestIndex:
    """Digest → the document that holds it, kept at `path` for all later batches.

    `buckets` (default: the session's shuffle partitions) is fixed when the index is made; give the same number, or
    none, when opening it again.
    """

    COLUMNS = "digest BINARY, keep_id BIGINT, keep_chars BIGINT"

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self._known_buckets() or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digest_index_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({self.COLUMNS}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/buckets_{self.buckets}'"
        )

    def _known_buckets(self) -> int | None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return next((int(n.removeprefix("buckets_")) for n in names if n.startswith("buckets_")), None)

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def register(self, keyed: DataFrame) -> DataFrame:
        """Adds a batch of (row, doc_id, n_chars, digest); returns one row a digest with its keeper and `kept_row`.

        The longest original text stays, then the smallest doc_id. A digest that an earlier batch brought keeps its
        holder, and `kept_row` is null unless that holder is in this batch (a batch that is run again).
        """
        first = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("last"), "doc_id", "row")).alias("first")
        groups = keyed.groupBy("digest").agg(first, F.count(F.lit(1)).alias("group_size"))
        groups = stored(groups.select("digest", "group_size", "first.doc_id", (-F.col("first.less")).alias("n_chars"), "first.row"), "groups")
        held = self.entries()
        new = groups.join(held.select("digest").hint("merge"), "digest", "left_anti")
        new.select("digest", F.col("doc_id").alias("keep_id"), F.col("n_chars").alias("keep_chars")).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        ours = F.col("keep_id").eqNullSafe(F.col("doc_id")) & (F.col("keep_chars") == F.col("n_chars"))
        return stored(
            groups.join(self.entries().hint("merge"), "digest").select(
                "digest", "group_size", "keep_id", "keep_chars", F.when(ours, F.col("row")).alias("kept_row")
            ),
            "keepers",
        )


def keyed(docs: DataFrame) -> DataFrame:
    """One small row a document, stored: `row` tells repeated rows apart from then on."""
    return stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.length(text_of()).cast("long").alias("n_chars"),
            digest(text_of()).alias("digest"),
        ),
        "digests",
    )


def decide(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, digest.

    A group with a third of all rows is one row for each map task in the aggregate; in the join its partition is
    split by AQE, as both sides are plain shuffles.
    """
    index = index or new_index(docs.sparkSession)
    rows = keyed(docs)
    keepers = index.register(rows)
    return rows.join(keepers, "digest").select(
        "doc_id", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept"), "digest"
    )


def survivors(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns.

    They are found by digest, doc_id and length together, so that a large group of copies is spread by doc_id.
    """
    index = index or new_index(docs.sparkSession)
    # Keys without nulls: the join and the firsts after it share one shuffle of the rows, and one order.
    keys = lambda doc_id, chars: [F.coalesce(doc_id, F.lit(0)).alias("_id"), doc_id.isNull().alias("_none"), chars.alias("_chars")]
    keepers = index.register(keyed(docs)).where("kept_row IS NOT NULL")
    keepers = keepers.select(F.col("digest").alias("_digest"), *keys(F.col("keep_id"), F.col("keep_chars")))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        digest(text_of()).alias("_digest"),
        *keys(F.col("doc_id").cast("long"), F.length(text_of()).cast("long")),
    )
    same = ["_digest", "_id", "_none", "_chars"]
    return rows.join(keepers, same, "left_semi").dropDuplicates(same).select("row.*")


def new_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, scratch(spark, "digest-index"))
