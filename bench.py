"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   directory of tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)

Each query runs once, cold, and writes its whole result to the ``noop`` sink.
``curate`` builds the bucketed daily fact from the raw tables and ``build_store``
the prediction store; later queries read those tables, as the jobs of a pipeline
read what earlier jobs wrote. ``setup`` is the time to write the wide CSV files
that stand in for external input; it is reported but not part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfline.plans.dataset import dataset  # noqa: E402
from shelfline.queries import all_queries  # noqa: E402

HEADLINE = [
    "wide_to_long",
    "etl_pipeline",
    "lag_features",
    "rolling_features",
    "build_features",
    "train_val_split",
    "tail_days",
    "table_profile",
    "unique_violations",
    "baseline_forecast",
    "overall_metrics",
    "per_series_backtest",
    "gbt_backtest",
    "forecast_summary",
    "version_compare",
    "top_items",
    "dept_rollup",
    "forecast_latest_per_date",
    "items_by_volume",
    "item_tiles",
    "daily_tiles",
    "store_replace_version",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).write.format("noop").mode("overwrite").save()
    spent: dict[str, float] = {}
    setup: dict[str, float] = {}

    def timed(
        name: str, work: Callable[[], DataFrame | object], into: dict[str, float] = spent
    ) -> None:
        start = time.perf_counter()
        result = work()
        if isinstance(result, DataFrame):
            result.write.format("noop").mode("overwrite").save()
        into[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {into[name]} s", file=sys.stderr, flush=True)

    tables = dataset(spark, sf_dir)
    timed("demand", lambda: tables.demand)
    timed("curate", lambda: tables.fact_table)
    timed("raw_csv", lambda: (tables.raw_path, tables.calendar_path), setup)
    timed("build_store", lambda: tables.store)
    queries = all_queries()
    for name in HEADLINE:
        timed(name, lambda: queries[name](spark, sf_dir))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "setup": setup,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
