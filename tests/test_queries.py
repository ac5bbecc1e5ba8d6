"""Every registered query against its SQL on the smallest data, plus checks on the plans."""

import datetime as dt
import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as contract
from marketlake.operators import duplicates, staging
from marketlake.plans import oracle, queries
from marketlake.sources import driver_tables as source
from tests.conftest import SF_DIR

QUERIES, ORACLE = queries.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    return v.isoformat() if isinstance(v, (dt.date, dt.datetime)) else repr(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(cell(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLE:
        assert got
        return
    cursor = db.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    assert [names[i] for i in order] == columns
    assert got == sorted(tuple(cell(r[i]) for i in order) for r in cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", ["stg_trades", "stg_orders", "gold_ohlcv", "gold_agent_pnl", "gold_circuit_breaker", "halt_pre_post", "trades_with_mid"])
def test_plans_stay_on_the_jvm_and_never_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in plan, node


def windows_of(plan):
    """The first column that each window of a plan is partitioned by."""
    return set(re.findall(r"windowspecdefinition\((\w+)", plan))


def test_no_window_over_a_whole_symbol_of_trades(spark):
    # The windows there are order the few rows whose key repeats, by key.
    assert windows_of(plan_of(queries.bars(spark, SF_DIR))) == {"_h"}
    assert windows_of(plan_of(queries.staged_trades(spark, SF_DIR))) == {"_h"}


@pytest.mark.parametrize("wire, label", [
    (source.trades, staging.trades),
    (source.orders, staging.orders),
    (source.trades, lambda df: duplicates.label_duplicates(df, ["trade_id"], ["event_id", "timestamp"])),
])
def test_labels_need_no_sorted_aggregate_and_no_job_to_be_planned(spark, wire, label):
    given = wire(spark, SF_DIR)  # Spark looks at the files' schemas here
    spark.sparkContext.setJobGroup("planning", "labels")
    try:
        plan = plan_of(label(given))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tree = plan.split("\n\n", 1)[0]
    assert "SortAggregate" not in tree and "HashAggregate" in tree and "WindowGroupLimit" in tree


def test_lake_reads_prune_dates_and_columns(spark, lake):
    lake.write(queries.good_quotes(spark, SF_DIR), "silver", "quotes")
    plan = plan_of(lake.read("silver", "quotes", dates=["2024-01-03"]).filter("spread_bps > 1").select("symbol", "spread_bps"))
    assert "PartitionFilters: [isnotnull(_part" in plan or "PartitionFilters: [(_part" in plan or "PartitionFilters: [_part" in plan
    assert "ReadSchema: struct<symbol:string,spread_bps:double>" in plan and "GreaterThan(spread_bps" in plan
