"""Job entry point, for ``spark-submit`` or ``python -m shelfline``.

etl       raw wide CSV -> curated daily fact of one store or all of them
backtest  curated fact -> checkpoints -> prediction store, version promoted
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shelfline.operators.quality import CastLosses
from shelfline.operators.reshape import FILE_ROWS, filter_by_store
from shelfline.plans.backtest import Baseline, Forecaster, Moments, PerSeries, Pooled, run_backtest
from shelfline.plans.etl import bucket_count, transform_sales_to_long
from shelfline.schemas import DEFAULT_HORIZON
from shelfline.session import new_dir
from shelfline.sources.curated import read_curated, write_curated
from shelfline.sources.files import daily_sales_path
from shelfline.store import ForecastStore

MODELS: dict[str, Forecaster] = {
    "baseline": Baseline(),
    "least-squares": PerSeries(),
    "moments": Moments(),
    "pooled-trees": Pooled(),
}
ALL = "ALL"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="shelfline")
    jobs = p.add_subparsers(dest="job", required=True)
    etl = jobs.add_parser("etl")
    etl.add_argument("--raw", required=True, help="folder of the sales and calendar CSV")
    etl.add_argument("--file-rows", type=int, default=FILE_ROWS, help="rows of an output file")
    backtest = jobs.add_parser("backtest")
    backtest.add_argument("--store", required=True, help="root of the prediction store")
    backtest.add_argument("--model-version", required=True)
    backtest.add_argument("--model", choices=sorted(MODELS), default="least-squares")
    backtest.add_argument("--horizon", type=int, default=DEFAULT_HORIZON)
    for job in (etl, backtest):
        job.add_argument("--curated", required=True, help="folder of the curated facts")
        job.add_argument("--store-id", default=ALL, help="one store (default: all)")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"shelfline-{args.job}").getOrCreate()
    one_store = None if args.store_id == ALL else args.store_id
    path = daily_sales_path(args.curated, args.store_id)
    if args.job == "etl":
        losses = CastLosses()
        buckets = bucket_count(spark, args.raw, one_store, args.file_rows)
        long = transform_sales_to_long(
            spark, args.raw, one_store, calendar_path=args.raw, buckets=buckets, losses=losses
        )
        write_curated(long, path, buckets)
        print(f"wrote {path}")
        for source, column, raw, lost in losses.rows():
            print(f"{source}.{column}: {lost} of {raw} values lost")
        return
    fact = read_curated(spark, path)
    if one_store is not None:
        fact = filter_by_store(fact, one_store)
    forecasts, history = run_backtest(
        spark,
        fact,
        ForecastStore(spark, args.store),
        MODELS[args.model],
        args.model_version,
        new_dir(spark, "checkpoints"),
        args.store_id,
        args.horizon,
        {"model": args.model, "horizon": args.horizon},
    )
    print(f"version {args.model_version}: {forecasts} forecasts, {history} actuals")


if __name__ == "__main__":
    main()
