"""Split staging into silver (validated) and invalid (kept with reasons), and account for every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _is_valid() -> Column:
    return F.col("_validation_status").eqNullSafe("valid")


def _is_duplicate(df: DataFrame) -> Column:
    return F.coalesce("_is_duplicate", F.lit(False)) if "_is_duplicate" in df.columns else F.lit(False)


def _is_cancel(df: DataFrame) -> Column:
    return F.col("event_type").eqNullSafe("OrderCancelled") if "event_type" in df.columns else F.lit(False)


def silver(staged: DataFrame, dup: bool = True) -> DataFrame:
    """Valid rows, without duplicates where the table tracks them."""
    return staged.filter(_is_valid() & ~_is_duplicate(staged)) if dup else staged.filter(_is_valid())


def silver_orders(staged: DataFrame) -> DataFrame:
    """Valid first placements; cancel events live on as the fill status."""
    return silver(staged.filter(~_is_cancel(staged)))


def invalid(staged: DataFrame, dup: bool = True) -> DataFrame:
    """Rejected rows with their reasons."""
    return staged.filter(~_is_valid() | _is_duplicate(staged)) if dup else staged.filter(~_is_valid())


def summary(staged: DataFrame, table: str) -> DataFrame:
    """One row of promotion accounting. A row counts once: cancel event, else invalid, else duplicate."""
    cancel, bad, dup = _is_cancel(staged), ~_is_valid(), _is_duplicate(staged)
    return staged.agg(
        F.count(F.lit(1)).alias("staged"),
        F.count_if(cancel).alias("cancellation_events"),
        F.count_if(~cancel & bad).alias("invalid"),
        F.count_if(~cancel & ~bad & dup).alias("duplicate"),
        F.count_if(~cancel & ~bad & ~dup).alias("promoted"),
    ).select(F.lit(table).alias("table_name"), "*")


def reason_counts(staged: DataFrame) -> DataFrame:
    """Rows per rejection reason."""
    return (
        staged.filter(~_is_valid())
        .select(F.explode(F.split("_invalid_reasons", "[|]")).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
