"""Ordered, per-symbol computations that do not sort a symbol's whole history in one task.

A plain window over a symbol sends all of its rows to one task. Here rows are ordered inside
(symbol, bucket) groups only, and each bucket starts from a summary of the earlier ones. The summaries
are one row per bucket; their number follows the calendar (or the id range), not the event rate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Rows without a usable time all fall into one bucket per symbol; they are spread over this many.
UNTIMED_BUCKETS = 64


def minute_bucket() -> Column:
    return F.date_trunc("minute", "timestamp_utc")


def _bucketed(df: DataFrame, group: str, bucket: Column, spread_by: str) -> DataFrame:
    """Rows with the bucket they belong to as `_key`.

    The key is one struct: never NULL itself and equal on NULL parts, so the window over it and the join
    on it share a single shuffle of the rows.
    """
    spread = F.when(bucket.isNull(), F.pmod(F.xxhash64(spread_by), F.lit(UNTIMED_BUCKETS)))
    return df.withColumn("_key", F.struct(F.col(group).alias("group"), bucket.alias("bucket"), spread.alias("spread")))


def _earlier() -> WindowSpec:
    """The buckets of a group before this one; rows without time come last."""
    order = [F.asc_nulls_last("_key.bucket"), F.col("_key.spread")]
    return W.partitionBy("_key.group").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)


def _within(order_by: Sequence[str]) -> WindowSpec:
    return W.partitionBy("_key").orderBy(*order_by)


def running_sums(
    df: DataFrame,
    group: str,
    values: dict[str, Column],
    order_by: Sequence[str],
    bucket: Column | None = None,
) -> DataFrame:
    """Add, per group, the sum of each value up to and including this row. NULL values add nothing."""
    bucket = minute_bucket() if bucket is None else bucket
    rows = _bucketed(df, group, bucket, order_by[-1]).withColumns({f"_v_{n}": v for n, v in values.items()})
    sums = rows.groupBy("_key").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    starts = sums.select("_key", *[F.sum(f"_t_{n}").over(_earlier()).alias(f"_start_{n}") for n in values])
    frame = _within(order_by).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = rows.withColumns({f"_in_{n}": F.sum(f"_v_{n}").over(frame) for n in values})

    def so_far(n: str) -> Column:
        return (F.coalesce(f"_start_{n}", F.lit(0)) + F.coalesce(f"_in_{n}", F.lit(0))).alias(n)

    return counted.join(starts, "_key").select(*df.columns, *[so_far(n) for n in values])


def carry_last(
    df: DataFrame,
    group: str,
    name: str,
    value: Column,
    order_by: Sequence[str],
    bucket: Column | None = None,
    include_current: bool = True,
) -> DataFrame:
    """Add, per group, the latest non-NULL value at this row (or strictly before it): an as-of lookup."""
    bucket = minute_bucket() if bucket is None else bucket
    rows = _bucketed(df, group, bucket, order_by[-1]).withColumn("_v", value)
    known = F.when(F.col("_v").isNotNull(), F.struct(*order_by))
    last = rows.groupBy("_key").agg(F.max_by("_v", known).alias("_last"))
    starts = last.select("_key", F.last("_last", ignorenulls=True).over(_earlier()).alias("_start"))
    frame = _within(order_by).rowsBetween(W.unboundedPreceding, W.currentRow if include_current else -1)
    carried = rows.withColumn("_in", F.last("_v", ignorenulls=True).over(frame))
    return carried.join(starts, "_key").select(*df.columns, F.coalesce("_in", "_start").alias(name))
