"""Time the headline queries: median of warm runs, each written to the `noop` sink.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.plans.queries import QUERIES  # noqa: E402
from marketlake.session import local_session  # noqa: E402

HEADLINE = (
    "bronze_trades", "route_topic_counts", "stg_trades", "stg_orders", "stg_quotes", "silver_trades", "gold_ohlcv",
    "gold_market_quality", "gold_agent_pnl", "gold_circuit_breaker", "ref_symbols", "check_silver_trades",
    "promotion_summary", "halt_pre_post", "trades_with_mid", "suite_results", "stream_ingest_bronze", "stream_halt_pairing",
    "stream_silver_quotes",
)
# Streams, lake runs and checks over stored tables write files; one warm run is enough for them.
ONCE = ("suite_results", "stream_ingest_bronze", "stream_halt_pairing", "stream_silver_quotes")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, app="marketlake-bench")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for attempt in range(2 if name in ONCE else runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt:  # the first run warms the JVM up
                taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total warm seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
