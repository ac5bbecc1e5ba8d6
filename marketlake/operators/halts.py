"""Halt / resume pairing and daily halt analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.casts import PRICE, exact_sum, to_number, to_utc
from marketlake.operators.timeline import running_sums

EVENT_ORDER = ("timestamp_utc", "event_type", "event_id")

def pair_halts(halts: DataFrame, pairing: str = "nth") -> DataFrame:
    """One row per halt with its resume, if any.

    "nth" pairs the nth halt of a symbol with its nth resume; one lost message shifts every later pair.
    "next" pairs a halt with the first resume before the following halt.
    """
    events = halts.filter(F.col("event_type").isin("TradingHalt", "TradingResume"))
    events = events.select(
        "symbol", "event_type", "event_id", to_utc(events).alias("timestamp_utc"), "reason", "circuit_breaker_level",
        to_number(events, "reference_price").alias("reference_price"),
        to_number(events, "current_price").alias("current_price"),
        to_number(events, "price_change_percent").alias("price_change_percent"),
        to_number(events, "halt_duration_ms").alias("halt_duration_ms"),
    )
    is_halt = F.col("event_type") == "TradingHalt"
    flags = {"n_halts": is_halt.cast("bigint"), "n_resumes": (~is_halt).cast("bigint")}
    numbered = running_sums(events, "symbol", flags, EVENT_ORDER)
    if pairing == "nth":
        seq = F.when(is_halt, F.col("n_halts")).otherwise(F.col("n_resumes"))
    elif pairing == "next":
        seq = F.col("n_halts")
    else:
        raise ValueError(f"pairing must be 'nth' or 'next', not {pairing!r}")
    halt = F.struct(
        "timestamp_utc", "event_id", "reason", "circuit_breaker_level",
        "reference_price", "current_price", "price_change_percent",
    )
    resume = F.struct("timestamp_utc", "event_id", "halt_duration_ms")
    return (
        numbered.groupBy("symbol", seq.alias("halt_seq"))
        .agg(F.min(F.when(is_halt, halt)).alias("h"), F.min(F.when(~is_halt, resume)).alias("r"))
        .filter("h IS NOT NULL")
        .select(
            "symbol",
            "halt_seq",
            F.to_date("h.timestamp_utc").alias("halt_date"),
            F.col("h.timestamp_utc").alias("halt_ts"),
            F.col("r.timestamp_utc").alias("resume_ts"),
            F.col("r.halt_duration_ms").alias("halt_duration_ms"),
            (F.coalesce("r.halt_duration_ms", F.lit(0.0)) / F.lit(60000.0)).alias("duration_minutes"),
            F.col("r").isNull().alias("is_unresolved"),
            "h.reason",
            "h.circuit_breaker_level",
            "h.price_change_percent",
            "h.reference_price",
            "h.current_price",
        )
    )


def circuit_breaker(halts: DataFrame, pairing: str = "nth", with_unresolved: bool = False) -> DataFrame:
    """Halt count, duration, dominant reason and level, and price impact per symbol and day.

    A halt without resume counts as zero minutes. Ties for the dominant value go to the smallest.
    """
    return summarise(pair_halts(halts, pairing), with_unresolved)


def summarise(pairs: DataFrame, with_unresolved: bool = False) -> DataFrame:
    def mean(name: str, value: Column) -> Column:
        return (exact_sum(value, PRICE) / F.nullif(F.count(value), F.lit(0))).alias(name)

    move = F.abs("price_change_percent")
    total_ms = exact_sum(F.coalesce("halt_duration_ms", F.lit(0.0)), PRICE)
    columns = [
        F.count(F.lit(1)).alias("halt_count"),
        (total_ms / 60000.0 / F.count(F.lit(1))).alias("avg_duration_minutes"),
        F.max("duration_minutes").alias("max_duration_minutes"),
        F.mode("reason", True).alias("most_common_reason"),
        F.mode("circuit_breaker_level", True).alias("most_common_level"),
        mean("avg_trigger_move_pct", move),
        F.max(move).alias("max_trigger_move_pct"),
        mean("avg_reference_price", F.col("reference_price")),
        mean("avg_halt_price", F.col("current_price")),
    ]
    if with_unresolved:
        columns.append(F.count_if("is_unresolved").alias("unresolved_halts"))
    return pairs.groupBy("symbol", "halt_date").agg(*columns)
