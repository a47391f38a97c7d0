"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores. Every query is run once to warm up code
generation and then timed as the best of two runs into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans import REGISTRY  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = (
    "trades_staged", "fct_trade", "late_trades", "candles_m1", "candles_m5", "candles_h1", "candle_pyramid",
    "volatility_5m", "fct_candle", "fct_symbol_daily", "anomalies", "orderbook_gaps", "parsed_binance_trades",
    "parsed_coinbase_trades", "parsed_binance_depth", "candle_minute_gaps", "quality_trade", "quality_candle",
    "contract_rejects", "skew_histogram", "skew_p99", "sustained_breaches", "absences", "latest_candles",
    "market_rows", "merged_candle_feed", "prompts", "explanations", "candles_h1_sealed_stream",
)


def main(names: tuple[str, ...]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(3 if not name.endswith("_stream") else 2):
            started = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main(tuple(sys.argv[1:]) or HEADLINE)
