"""Reference tables: fixed code maps and the symbol catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.schemas import AGENT_TYPES, ORDER_SIDES, ORDER_TYPES


def agent_type_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(AGENT_TYPES), "raw_value string, normalized_value string, display_name string")


def order_type_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ORDER_TYPES), "raw_value string, normalized_value string, requires_price boolean")


def order_side_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ORDER_SIDES), "raw_value string, normalized_value string, aggressor_flag boolean")


def code_usage(data: DataFrame, column: str, codes: DataFrame) -> DataFrame:
    """Each code-table row with the number of data rows that carry its raw value.

    Counts are taken before the join, so the join sees one row per distinct value; the code table is a
    fixed handful of rows and is broadcast.
    """
    used = data.groupBy(F.col(column).alias("raw_value")).agg(F.count(F.lit(1)).alias("n"))
    matched = used.join(F.broadcast(codes.select("raw_value")), "raw_value", "left_semi")
    return codes.join(F.broadcast(matched), "raw_value", "left").select(
        *codes.columns, F.coalesce("n", F.lit(0)).cast("bigint").alias("n_rows")
    )


def symbols(trades: DataFrame, orders: DataFrame, quotes: DataFrame) -> DataFrame:
    """One row per symbol: first and last time seen, and which staging tables it appears in."""
    seen = {"trades": trades, "orders": orders, "quotes": quotes}
    parts = [
        df.select("symbol", "timestamp_utc", *[F.lit(name == source).alias(f"seen_in_{name}") for name in seen])
        for source, df in seen.items()
    ]
    return (
        parts[0].unionByName(parts[1]).unionByName(parts[2])
        .filter("symbol IS NOT NULL AND timestamp_utc IS NOT NULL")
        .groupBy("symbol")
        .agg(
            F.min("timestamp_utc").alias("first_seen_utc"),
            F.max("timestamp_utc").alias("last_seen_utc"),
            *[F.max(f"seen_in_{name}").alias(f"seen_in_{name}") for name in seen],
        )
    )
