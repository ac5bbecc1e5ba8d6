"""Run the layers of the lake in order: bronze, staging, invalid, reference, silver, gold.

Every step reads stored tables and replaces whole date partitions, so a rerun changes nothing. With
`dates="batch"` only what the newest feed batch touched is recomputed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import bronze, gold, halts, promote, reference, router, staging
from marketlake.plans.pnl import PnlView
from marketlake.schemas import TABLE_EVENTS, bronze_schema
from marketlake.sources.lake import BATCH, EVENT_DATE, PART, Lake
from marketlake.sources.order_index import OrderIndex, Version

LAYERS = ("bronze", "staging", "invalid", "reference", "silver", "gold")
STAGED = ("trades", "orders", "quotes")
GOLD = ("ohlcv", "market_quality", "agent_pnl", "circuit_breaker")
RUN_LOG = "layer string, table_name string, n_rows bigint, started_at timestamp, ended_at timestamp"

Dates = list[str | None] | None


def together(*steps: Callable[[], None]) -> None:
    """Start independent writes side by side, so that small tables do not leave the executors idle."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        for done in [pool.submit(step) for step in steps]:
            done.result()


def layer_schema(spark: SparkSession, layer: str, table: str) -> T.StructType:
    """Columns of a stored staging, silver or invalid table: what staging makes of no rows at all."""
    rows = spark.createDataFrame([], bronze_schema(table)).withColumn("_ingest_id", F.lit(None).cast("bigint"))
    if layer == "bronze":
        return bronze_schema(table)
    made = {"trades": staging.trades, "orders": staging.orders, "quotes": staging.quotes}[table](rows)
    return made.drop("_ingest_id").schema


class LayerRun:
    """One run over a lake. `dates` per table is None for everything, or the dates to recompute."""

    def __init__(self, lake: Lake, batch: int | None):
        self.lake, self.batch = lake, batch
        self.log: list[tuple] = []
        self.work: list[str] = []
        self.order_index: Version | None = None

    # -- bookkeeping ---------------------------------------------------------------------------

    def store(
        self, df: DataFrame, layer: str, table: str, partition: str | None = EVENT_DATE, dates: Dates = None, gather: bool = True
    ) -> None:
        if dates is None:
            self._logged(df, layer, table, lambda seen: self.lake.replace(seen, layer, table, partition, gather))
        else:
            self._logged(df, layer, table, lambda seen: self.lake.write(seen, layer, table, partition, dates, gather))

    def _logged(self, df: DataFrame, layer: str, table: str, write: Callable[[DataFrame], object]) -> None:
        """Writes a frame; its rows are counted on their way by the write itself."""
        started, seen = datetime.now(timezone.utc), Observation()
        write(df.observe(seen, F.count(F.lit(1)).alias("n_rows")))
        n_rows = _rows_seen(seen)
        if n_rows or self.lake.exists(layer, table):
            self.log.append((layer, table, n_rows, started, datetime.now(timezone.utc)))

    def finish(self) -> None:
        """Store the log and drop the lookups of this run."""
        spark = self.lake.spark
        if self.log:
            spark.createDataFrame(self.log, RUN_LOG).coalesce(1).write.mode("append").parquet(self.lake.path("ops", "run_log"))
        for folder in self.work:
            self.lake.delete(folder)
        self.log, self.work = [], []

    def bronze(self, table: str, dates: Dates = None) -> DataFrame:
        return self.lake.read("bronze", table, bronze_schema(table), dates, position=True)

    def table(self, layer: str, table: str, dates: Dates = None) -> DataFrame:
        return self.lake.read(layer, table, layer_schema(self.lake.spark, layer, table), dates)

    # -- layers --------------------------------------------------------------------------------

    def ingest(self, feed: DataFrame, replace: bool = False, tables: Iterable[str] = tuple(TABLE_EVENTS)) -> None:
        """Route the feed once, keep every routed line, and decode each topic into its bronze table.

        The landing table holds the one copy of the raw text. A batch id is used once; `replace` takes its rows out first.
        """
        batch = self.batch
        if batch is None:
            raise ValueError("a feed needs a batch id of its own")
        if self.lake.has_batch("landing", "messages", batch):
            if not replace:
                raise ValueError(f"batch {batch} is stored already; replace=True takes its rows out first")
            for layer, table in [("landing", "messages"), *[("bronze", t) for t in TABLE_EVENTS]]:
                self.lake.drop_batch(layer, table, batch)
        routed = router.route(feed).withColumn("topic", F.coalesce("topic", F.lit("none")))
        self.lake.append_batch(routed, "landing", "messages", batch, partition="topic", gather=False)
        landed = self.lake.batch_rows("landing", "messages", batch, routed.schema)

        def add(table: str) -> None:
            rows = bronze.from_topics(landed, table)
            self._logged(rows, "bronze", table, lambda seen: self.lake.append_batch(seen, "bronze", table, batch))

        together(*[partial(add, table) for table in tables])

    def touched(self, table: str) -> Dates:
        """Partitions (by their first date) the batch added rows to; a list no longer than the calendar."""
        if not self.lake.exists("bronze", table):
            return []
        rows = self.lake.spark.read.schema(f"{PART} date, {BATCH} int").parquet(self.lake.path("bronze", table))
        return _dates(rows.filter(F.col(BATCH) == self.batch).select(PART))

    def touched_orders(self) -> Dates:
        """As `touched`, with the partitions of earlier orders whose labels the batch changes; from then on labels come from the index."""
        days = self.touched("orders")
        moved, self.order_index = OrderIndex(self.lake).take(self.batch)
        return _union(days, moved)

    def stage(self, dates: dict[str, Dates], tables: Iterable[str] = STAGED) -> None:
        together(*[partial(self._stage, table, dates[table]) for table in tables])

    def _stage(self, table: str, days: Dates) -> None:
        rows = self.bronze(table, days)
        if table == "trades":
            staged = staging.trades(rows, self.lake.settle("trade_firsts", self.work))
        elif table == "orders":
            facts = None if self.order_index is None else self.order_index.facts
            staged = staging.orders(rows, self.lake.settle("order_facts", self.work), facts)
        else:
            staged = staging.quotes(rows)
        # Labels of orders shuffle the rows by order id; the other tables' rows stay with their dates.
        self.store(staged.drop("_ingest_id"), "staging", table, dates=days, gather=table == "orders")

    def reject(self, dates: dict[str, Dates], tables: Iterable[str] = STAGED) -> None:
        def add(table: str) -> None:
            rows = self.table("staging", table, dates[table])
            self.store(promote.invalid(rows, dup=table != "quotes"), "invalid", table, dates=dates[table], gather=False)

        together(*[partial(add, table) for table in tables])

    def promote(self, dates: dict[str, Dates], tables: Iterable[str] = STAGED) -> None:
        def add(table: str) -> None:
            rows = self.table("staging", table, dates[table])
            good = promote.silver_orders(rows) if table == "orders" else promote.silver(rows, dup=table != "quotes")
            self.store(good, "silver", table, dates=dates[table], gather=False)

        together(*[partial(add, table) for table in tables])

    def refer(self) -> None:
        def symbols() -> None:
            self.store(reference.symbols(*[self.table("staging", t) for t in STAGED]), "reference", "symbols", None)

        maps = {
            "agent_type_map": reference.agent_type_map,
            "order_type_map": reference.order_type_map,
            "order_side_map": reference.order_side_map,
        }
        spark = self.lake.spark
        together(symbols, *[partial(self.store, make(spark), "reference", name, None) for name, make in maps.items()])

    def aggregate(self, dates: dict[str, Dates], view: PnlView, tables: Iterable[str] = GOLD) -> None:
        def stats(days: Dates) -> DataFrame:
            return self.lake.read("bronze", "market_stats", bronze_schema("market_stats"), days)

        def ohlcv() -> None:
            days = _union(dates["trades"], dates["market_stats"])
            self.store(gold.ohlcv(self.table("silver", "trades", days), stats(days)), "gold", "ohlcv", "trade_date", days)

        def quality() -> None:
            days = _union(dates["trades"], dates["quotes"])
            scores = gold.market_quality(self.table("silver", "quotes", days), self.table("silver", "trades", days))
            self.store(scores, "gold", "market_quality", "trade_date", days)

        def pnl() -> None:
            trade_days, order_days = (dates["trades"], dates["orders"]) if view.fresh else (None, None)
            trades, orders = self.table("silver", "trades", trade_days), self.table("silver", "orders", order_days)
            days = view.update(trades, orders, trade_days, order_days, self.work)
            if days is None or days:
                self.store(view.daily(days), "gold", "agent_pnl", "trade_date", days)

        def breaker() -> None:
            # Pairing counts from a symbol's first halt on; halts are rare, so they are paired afresh.
            events = self.lake.read("bronze", "trading_halts", bronze_schema("trading_halts"))
            self.store(halts.circuit_breaker(events), "gold", "circuit_breaker", "halt_date")

        steps = {"ohlcv": ohlcv, "market_quality": quality, "agent_pnl": pnl, "circuit_breaker": breaker}
        together(*[steps[table] for table in tables])


def _rows_seen(seen: Observation) -> int:
    try:
        return seen.get["n_rows"]
    except Py4JJavaError:  # where the optimizer finds a frame empty, nothing is left of it that could report a number
        return 0


def _dates(column: DataFrame) -> list[str | None]:
    return [None if r[0] is None else str(r[0]) for r in column.distinct().collect()]


def _union(a: Dates, b: Dates) -> Dates:
    return None if a is None or b is None else list(dict.fromkeys([*a, *b]))


def run_layers(
    lake: Lake,
    layers: Iterable[str] = LAYERS,
    feed: DataFrame | None = None,
    batch: int | None = None,
    dates: str | None = None,
    replace: bool = False,
    tables: Iterable[str] = tuple(TABLE_EVENTS),
    gold_tables: Iterable[str] = GOLD,
) -> None:
    """Run the chosen layers in dependency order, for the chosen event tables and gold tables.

    `feed` holds raw envelope lines (`value`) for bronze; it needs a `batch` id that isn't stored yet, or `replace`, which takes
    the stored batch out first. `dates="batch"` limits the later layers to what that batch touched; by default they are
    computed from all of the layer below, and replace whole tables. A replaced batch may have held other dates, so it
    goes with the default.
    """
    chosen = set(layers)
    unknown = chosen - set(LAYERS)
    if unknown:
        raise ValueError(f"unknown layers {sorted(unknown)}")
    if dates not in (None, "batch"):
        raise ValueError(f"dates must be None or 'batch', not {dates!r}")
    if dates == "batch" and (batch is None or replace):
        raise ValueError("dates='batch' goes with a new batch")
    run = LayerRun(lake, batch)
    if "bronze" in chosen and feed is not None:
        run.ingest(feed, replace, tables)
    scope: dict[str, Dates] = dict.fromkeys(("trades", "orders", "quotes", "market_stats"))
    if dates == "batch":
        scope = {t: run.touched_orders() if t == "orders" else run.touched(t) for t in scope}
    staged = [t for t in STAGED if t in tables]
    if "staging" in chosen:
        run.stage(scope, staged)
    if "invalid" in chosen:
        run.reject(scope, staged)
    if "reference" in chosen:
        run.refer()
    view = PnlView(lake)
    if "silver" in chosen:
        run.promote(scope, staged)
    if "gold" in chosen:
        run.aggregate(scope, view, gold_tables)
    run.finish()


def table_counts(lake: Lake) -> DataFrame:
    """Rows per stored table."""
    tables = [("bronze", t) for t in TABLE_EVENTS] + [(layer, t) for layer in ("staging", "silver", "invalid") for t in STAGED]
    tables += [("reference", "symbols")] + [("gold", t) for t in ("ohlcv", "market_quality", "agent_pnl", "circuit_breaker")]
    counts = None
    for layer, table in tables:
        if not lake.exists(layer, table):
            continue
        row = lake.read(layer, table).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "n_rows"
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts


def run_log(lake: Lake) -> DataFrame:
    spark: SparkSession = lake.spark
    return spark.read.schema(RUN_LOG).parquet(lake.path("ops", "run_log"))
