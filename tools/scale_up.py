"""Time the main jobs on trip files about as large as one quarter of real trips (9.7 M rows).

Trip-shaped events are multiplied (ids shifted, so derived values differ), written once as
Parquet files, and then read by every job, as raw trip files would be. For some reports the
one-pass form is timed against the form with one scan per line of the report.

usage: python tools/scale_up.py [--copies 100] [--data FOLDER] [--keep FOLDER] [--models]
"""

from __future__ import annotations

import argparse
import pathlib
import sys
import tempfile
import time
from functools import reduce

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ridemart.operators import cleaning, marts, profile, quality, regression, reports, sampling  # noqa: E402
from ridemart.plans import build  # noqa: E402
from ridemart.plans.catalog import WINDOW  # noqa: E402
from ridemart.session import local_session  # noqa: E402
from ridemart.sources import trips  # noqa: E402
from ridemart.sources.schema import EVENTS  # noqa: E402


def clock(name: str, job) -> None:
    seconds = []
    for _ in range(2):
        started = time.perf_counter()
        job()
        seconds.append(time.perf_counter() - started)
    print(f"{name:44s} {min(seconds):8.2f} s", flush=True)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def per_check_scans(raw: DataFrame) -> DataFrame:
    """The validity report with one filtered count per check, for comparison only."""
    arms = [
        raw.filter(c.condition()).agg(F.lit(c.label).alias("check_name"), F.count(F.lit(1)).alias("records"))
        for c in quality.validity_checks()
    ]
    return reduce(DataFrame.unionByName, arms)


def built_in_percentiles(raw: DataFrame) -> DataFrame:
    """The numeric summary with built-in exact percentiles, for comparison only."""
    points = F.array(*[F.lit(p) for p in (0.01, 0.25, 0.5, 0.75, 0.99)])
    return raw.agg(
        *[F.percentile(expr, points).alias(name) for name, expr in profile.trip_metrics().items()]
    )


def fit_models(stg: DataFrame) -> None:
    """The three candidates at full size on a sample of 500,000 staged trips."""
    rows = regression.training_rows(stg, ["trip_id"])
    train, test = (part.persist() for part in sampling.split(rows, ["trip_id"]))
    print("train", train.count(), "test", test.count(), flush=True)
    for name, candidate in regression.regressors().items():
        started = time.perf_counter()
        fitted = regression.train_all(train, {name: candidate})
        spent = time.perf_counter() - started
        row = regression.leaderboard(fitted, test).first()
        figures = {k: round(row[k], 4) for k in ("mae", "rmse", "r2")}
        print(f"fit {name:40s} {spent:8.2f} s {figures}", flush=True)


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--copies", type=int, default=100)
    parser.add_argument("--data", default="/root/testdata/sf0.1")
    parser.add_argument("--keep", help="folder with trip files from an earlier run")
    parser.add_argument("--models", action="store_true", help="fit the three full-size models instead")
    args = parser.parse_args()

    spark = local_session(8, "ridemart-scale-up")
    spark.sparkContext.setLogLevel("ERROR")
    made = None if args.keep else tempfile.TemporaryDirectory(prefix="ridemart-scale-", ignore_cleanup_errors=True)
    folder = args.keep or made.name  # a folder of our own goes when the run ends
    if not args.keep:
        events = spark.read.schema(EVENTS).parquet(f"{args.data}/events.parquet").repartition(24)
        copies = F.explode(F.sequence(F.lit(0), F.lit(args.copies - 1)))
        shifted = events.withColumn("copy", copies).withColumn(
            "event_id", F.col("event_id") + F.col("copy") * 1_000_003
        )
        trips.trips_from_events(shifted).write.parquet(f"{folder}/raw")
        print("trip files in", folder)
    raw = spark.read.parquet(f"{folder}/raw")
    print("rows", raw.count())
    rules = cleaning.cleaning_rules(WINDOW)
    clean = cleaning.clean(raw, rules)
    stg = cleaning.stage(clean, carry=["trip_id"])

    if args.models:
        fit_models(stg)
        spark.stop()
        return
    clock("clean, no output", lambda: drain(clean))
    clock("clean summary", lambda: drain(cleaning.clean_summary(raw, rules)))
    clock("daily mart from raw files", lambda: drain(marts.daily_summary(stg)))
    clock("hourly mart from raw files", lambda: drain(marts.hourly_patterns(stg)))
    clock("validity, one pass", lambda: drain(quality.validity(raw, quality.validity_checks())))
    clock("validity, one scan per check", lambda: drain(per_check_scans(raw)))
    clock("column quality", lambda: drain(quality.column_quality(raw, list(quality.NULL_COUNT_NAMES))))
    clock("numeric summary, bins and slices", lambda: drain(profile.numeric_summary(raw, profile.trip_metrics())))
    clock("numeric summary, built-in percentile", lambda: drain(built_in_percentiles(raw)))
    clock("route table", lambda: drain(reports.route_table(clean)))
    clock("insights", lambda: drain(reports.insights(clean)))
    clock("sample of 200,000", lambda: drain(sampling.sample_rows(raw, 200_000, ["trip_id"])))
    clock(
        "sample of 200,000, plain order and limit",
        lambda: drain(raw.orderBy(sampling.hash_text(["trip_id"], 42)).limit(200_000)),
    )
    clock("correlations on 200,000", lambda: drain(profile.correlations(raw, ["trip_id"], n=200_000)))
    clock("correlations on all rows", lambda: drain(profile.correlations(raw, ["trip_id"])))
    runs = iter(range(10))
    clock("store cleaned trips and both marts", lambda: build.run(spark, f"{folder}/raw", f"{folder}/out{next(runs)}", WINDOW))
    spark.stop()


if __name__ == "__main__":
    main()
