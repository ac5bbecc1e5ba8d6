"""Operational reports: consumer lag, freshness, check pass rate, run metrics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.expectations import age_hours
from marketlake.schemas import FRESHNESS_SLA_HOURS, LAG_THRESHOLD, MONITORED_TOPICS

# Pass-rate bands of the dashboard gauge, percent
RED_BELOW, GREEN_FROM = 80, 95


def consumer_lag(offsets: DataFrame) -> DataFrame:
    """Unread messages per topic from (topic, partition, high, committed); nothing committed counts as 0."""
    behind = F.greatest(F.lit(0), F.col("high") - F.greatest(F.col("committed"), F.lit(0)))
    return offsets.groupBy("topic").agg(F.sum(behind).alias("lag"))


def lag_breaches(
    offsets: DataFrame, topics: Iterable[str] = MONITORED_TOPICS, threshold: int = LAG_THRESHOLD
) -> DataFrame:
    return consumer_lag(offsets.filter(F.col("topic").isin(list(topics)))).filter(F.col("lag") > threshold)


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of: Column, sla_hours: float = FRESHNESS_SLA_HOURS) -> DataFrame:
    """Age of each table's newest date against the SLA; `tables` maps a name to (frame, date column)."""
    report = None
    for name, (df, column) in tables.items():
        row = df.agg(F.max(column).alias("newest")).select(F.lit(name).alias("table_name"), F.col("newest").cast("date"))
        report = row if report is None else report.unionByName(row)
    age = age_hours(F.col("newest"), as_of)
    return report.withColumn("age_hours", age).withColumn(
        "status",
        F.when(age.isNull(), "no data")
        .when(age > sla_hours, F.concat(F.format_string("%.1f", age), F.lit("h old")))
        .otherwise("ok"),
    )


def check_pass_rate(results: DataFrame) -> DataFrame:
    """Share of passed checks and its band, from rows with a `passed` flag."""
    counted = results.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if("passed").alias("passed_checks"),
    )
    rate = F.col("passed_checks") * F.lit(100.0) / F.nullif(F.col("checks"), F.lit(0))
    return counted.withColumn("pass_rate_pct", rate).withColumn(
        "band", F.when(rate < RED_BELOW, "red").when(rate < GREEN_FROM, "yellow").when(rate.isNotNull(), "green")
    )


def run_log_metrics(run_log: DataFrame) -> DataFrame:
    """Table writes per minute and their mean duration, from (table_name, n_rows, started_at, ended_at)."""
    seconds = F.unix_micros("ended_at") - F.unix_micros("started_at")
    return (
        run_log.groupBy("table_name", F.window("ended_at", "1 minute").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("runs"),
            F.sum("n_rows").alias("n_rows"),
            (F.sum(seconds) / 1e6 / F.count(F.lit(1))).alias("avg_seconds"),
        )
        .select("table_name", F.col("w.start").alias("minute"), "runs", "n_rows", "avg_seconds")
    )


def progress_lag(progress: Mapping) -> dict[str, int]:
    """Messages behind per source of a streaming query's progress record, where the source reports it."""
    lag = {}
    for source in progress.get("sources", []):
        behind = (source.get("metrics") or {}).get("maxOffsetsBehindLatest")
        if behind is not None:
            lag[source["description"]] = int(behind)
    return lag
