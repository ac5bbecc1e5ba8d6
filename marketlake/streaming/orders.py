"""Order status as a stream: a cancellation may arrive batches after the order it cancels."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketlake.operators import bronze, promote, router
from marketlake.plans.layers import LayerRun
from marketlake.sources.lake import Lake
from marketlake.streaming.ingest import run_available


def keep_order_status(feed: DataFrame, lake: Lake, checkpoint: str, gather: bool = True) -> None:
    """Feed lines -> bronze, staging and silver orders.

    Each batch relabels only the dates it affects: its own, those of orders it cancels, and those where
    an earlier placement arrived late, as the order index tells. Partitions are replaced whole, so a replay changes nothing.
    Without `gather` new bronze rows are written where they are, as for `keep_staged`.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        lines = router.published(router.route(batch))
        lake.append_batch(bronze.from_topics(lines, "orders"), "bronze", "orders", batch_id, gather=gather)
        run = LayerRun(lake, batch_id)
        dates = run.touched_orders()
        if not dates:
            return
        run.stage({"orders": dates}, ("orders",))
        lake.write(promote.silver_orders(run.table("staging", "orders", dates)), "silver", "orders", dates=dates, gather=False)
        run.finish()

    run_available(feed, write_batch, checkpoint)
