"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickloom.plans import REGISTRY  # noqa: E402
from tickloom.session import builder  # noqa: E402

HEADLINE = (
    "latest_volatility_leaders",
    "close_volatility",
    "exponential_average",
    "directional_index",
    "stored_bar_indicators",
    "rolling_beta",
    "cross_percent_rank",
    "winsorised_bars",
    "symbol_quality_metrics",
    "insider_proximity_join",
    "spearman_pairs",
    "lead_lag_pairs",
    "cointegrated_pairs",
    "daily_sentiment",
    "rule_based_polarity",
    "mean_reversion_signal",
    "quantile_label",
    "time_ordered_cv",
    "rolling_backtest",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(max(8, int(cpus) if cpus.isdigit() else 8)))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name].build(spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf,
            }
        )
    )


if __name__ == "__main__":
    main()
