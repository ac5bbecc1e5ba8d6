"""Halt pairing as a stream: a new halt or resume can change every later pair of its symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators import bronze, halts, router
from marketlake.schemas import bronze_schema
from marketlake.sources.lake import BATCH, Lake
from marketlake.streaming.ingest import run_available

BUCKET, BUCKETS = "_symbol_bucket", 256


def _bucket() -> Column:
    return F.pmod(F.xxhash64("symbol"), F.lit(BUCKETS)).cast("int")


def keep_halt_pairs(feed: DataFrame, lake: Lake, checkpoint: str, pairing: str = "nth") -> None:
    """Feed lines -> bronze halts and the pairs of each symbol, partitioned by symbol bucket.

    The symbols in the buckets a batch touches are paired again from their stored history; the other
    buckets stay as they are.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        lines = router.published(router.route(batch))
        lake.append_batch(bronze.from_topics(lines, "trading_halts"), "bronze", "trading_halts", batch_id)
        if not lake.exists("bronze", "trading_halts"):
            return
        stored = lake.spark.read.parquet(lake.path("bronze", "trading_halts"))
        fresh = stored.filter(F.col(BATCH) == batch_id).select(_bucket()).distinct()
        touched = [row[0] for row in fresh.collect()]  # at most BUCKETS numbers
        events = lake.read("bronze", "trading_halts", bronze_schema("trading_halts"))
        pairs = halts.pair_halts(events.filter(_bucket().isin(touched)), pairing)
        lake.write(pairs.withColumn(BUCKET, _bucket()), "silver", "halt_pairs", partition=BUCKET)

    run_available(feed, write_batch, checkpoint)


def halt_pairs(lake: Lake) -> DataFrame:
    return lake.read("silver", "halt_pairs").drop(BUCKET)
