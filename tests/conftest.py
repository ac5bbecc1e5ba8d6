import os
import shutil
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import local_session  # noqa: E402
from marketlake.sources.lake import Lake  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="marketlake-tests-")
    session = local_session(
        os.environ.get("BENCH_CPUS", "8"), app="marketlake-tests", spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=f"{folder}/shared", spark__sql__warehouse__dir=f"{folder}/warehouse",
    )
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


TRADES = (
    "event_type string, event_id string, trade_id string, symbol string, price double, quantity bigint, "
    "is_aggressive_buy boolean, buyer_agent_id string, seller_agent_id string, buy_order_id string, "
    "sell_order_id string, timestamp string"
)
ORDERS = (
    "event_type string, event_id string, order_id string, symbol string, price double, quantity double, side string, "
    "order_type string, agent_id string, agent_type string, reason string, timestamp string"
)


@pytest.fixture(scope="session")
def trades(spark):
    """Five clean trades in five symbols, over two days."""
    rows = [
        ("TradeExecuted", "E0", "tr-kiwi", "ALFA", 20.25, 40, True, "ann", "bob", "b-71", "s-12", "2024-03-04T14:00:00+00:00"),
        ("TradeExecuted", "E1", "tr-plum", "BETA", 7.5, 1000, False, "cat", "bob", "b-72", "s-13", "2024-03-04T14:00:03+00:00"),
        ("TradeExecuted", "E2", "tr-pear", "GAMA", 311.0, 3, True, "ann", "dan", "b-73", "s-40", "2024-03-04T15:21:59+00:00"),
        ("TradeExecuted", "E3", "tr-lime", "DELT", 0.35, 25000, False, "eve", "dan", "b-80", "s-41", "2024-03-05T09:05:00+00:00"),
        ("TradeExecuted", "E4", "tr-date", "EPSI", 99.99, 12, True, "cat", "eve", "b-81", "s-42", "2024-03-05T09:06:30+00:00"),
    ]
    return spark.createDataFrame(rows, TRADES)


@pytest.fixture(scope="session")
def orders(spark):
    """Eight placements in two symbols and two cancellations."""
    rows = [
        ("OrderPlaced", "P0", "oak", "ALFA", None, 40.0, "Buy", "Market", "ann", "RetailTrader", None, "2024-03-04T13:59:00+00:00"),
        ("OrderPlaced", "P1", "elm", "BETA", 7.4, 900.0, "Sell", "Limit", "bob", "InstitutionalInvestor", None, "2024-03-04T13:59:10+00:00"),
        ("OrderPlaced", "P2", "ash", "ALFA", 19.9, 15.0, "Sell", "StopLoss", "cat", "MarketMaker", None, "2024-03-04T14:01:00+00:00"),
        ("OrderPlaced", "P3", "fir", "BETA", 8.0, 5.0, "Buy", "StopLimit", "dan", "HighFrequencyTrader", None, "2024-03-04T14:02:00+00:00"),
        ("OrderPlaced", "P4", "yew", "ALFA", 20.0, 70.0, "Buy", "Limit", "eve", "RetailTrader", None, "2024-03-04T14:03:00+00:00"),
        ("OrderPlaced", "P5", "bay", "ALFA", None, 1.0, "Sell", "Market", "fay", "MarketMaker", None, "2024-03-04T14:04:00+00:00"),
        ("OrderPlaced", "P6", "box", "BETA", 7.9, 33.0, "Sell", "StopLimit", "gus", "InstitutionalInvestor", None, "2024-03-05T08:00:00+00:00"),
        ("OrderPlaced", "P7", "fig", "ALFA", 21.5, 8.0, "Buy", "StopLoss", "hal", "HighFrequencyTrader", None, "2024-03-05T08:30:00+00:00"),
        ("OrderCancelled", "X0", "elm", "BETA", None, None, None, None, None, None, "too slow", "2024-03-04T14:10:00+00:00"),
        ("OrderCancelled", "X1", "fir", "BETA", None, None, None, None, None, None, "end of day", "2024-03-04T16:30:00+00:00"),
    ]
    return spark.createDataFrame(rows, ORDERS)


def column(df, name, by="event_id"):
    return {r[by]: r[name] for r in df.select(by, name).collect()}
