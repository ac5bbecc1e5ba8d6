"""Trades, orders and quotes as a stream: bronze, staging, silver and invalid kept up to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators import bronze, router
from marketlake.plans.layers import STAGED, LayerRun
from marketlake.sources.lake import Lake
from marketlake.streaming.ingest import run_available


def keep_staged(feed: DataFrame, lake: Lake, checkpoint: str, tables: Sequence[str] = STAGED, gather: bool = True) -> StreamingQuery:
    """Feed lines -> bronze, staging, silver and invalid rows of the tables.

    Each batch relabels the dates it touches by the same rules as the batch layers, with all stored rows of those dates, so
    that a repeat is found whichever batch its first copy came in. No row is lost: what silver doesn't take, invalid does.
    No state is kept but the tables, and a replay changes nothing. Without `gather` new bronze rows are written where they are: right
    for a feed in event order, whose tasks hold few dates each.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        lines = router.published(router.route(batch))
        run = LayerRun(lake, batch_id)
        dates = {}
        for table in tables:
            lake.append_batch(bronze.from_topics(lines, table), "bronze", table, batch_id, gather=gather)
            dates[table] = run.touched_orders() if table == "orders" else run.touched(table)
        touched = [table for table in tables if dates[table]]
        if touched:
            run.stage(dates, touched)
            run.reject(dates, touched)
            run.promote(dates, touched)
        run.finish()

    return run_available(feed, write_batch, checkpoint)
