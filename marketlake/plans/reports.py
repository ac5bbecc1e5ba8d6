"""SQL over the lake and the everyday reports on it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.casts import TOTAL, exact_mean, exact_sum
from marketlake.sources.lake import Lake


def register_views(lake: Lake, tables: Mapping[str, tuple[str, str]]) -> None:
    """Temp views over stored tables: view name -> (layer, table)."""
    for view, (layer, table) in tables.items():
        lake.read(layer, table).createOrReplaceTempView(view)


def query(spark: SparkSession, sql: str, params: Mapping | list | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL with `:name` or `?` parameters; `frames` are usable in it as {name}."""
    return spark.sql(sql, args=params, **frames)


def execute(spark: SparkSession, sql: str, params: Mapping | list | None = None) -> None:
    """Run a statement for its effect; Spark carries commands out as they are given."""
    spark.sql(sql, args=params)


def ohlcv_listing(bars: DataFrame) -> DataFrame:
    """Bars, newest day first."""
    return bars.select("symbol", "trade_date", "open", "high", "low", "close", "vwap", "trade_count").orderBy(
        F.desc("trade_date"), "symbol"
    )


def agent_pnl_total(pnl: DataFrame) -> DataFrame:
    """Total P&L and trades per agent type, best first."""
    return (
        pnl.groupBy("agent_type")
        .agg(exact_sum(F.col("realized_pnl"), TOTAL).alias("total_pnl"),
             F.sum("trade_count").alias("trades"))
        .orderBy(F.desc("total_pnl"), "agent_type")
    )


def trades_by_symbol(trades: DataFrame, symbol: str, n: int = 100) -> DataFrame:
    """The first n trades of a symbol."""
    return (
        trades.filter(F.col("symbol") == symbol)
        .select("timestamp_utc", "event_id", "price_cast", "quantity_cast", "side_normalized")
        .orderBy("timestamp_utc", "event_id")
        .limit(n)
    )


def mean_by_symbol(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(exact_mean(F.col("vwap")).alias("vwap"), exact_mean(F.col("volume")).alias("volume"))
