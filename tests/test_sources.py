import pytest
from pyspark.sql import functions as F

from ridemart.operators import cleaning, marts, states
from ridemart.operators.columns import Window
from ridemart.plans import build
from ridemart.plans.catalog import WINDOW
from ridemart.sources import marts as storage
from ridemart.sources import trips
from ridemart.sources.marts import drop_partitions, stored_partitions
from ridemart.sources.schema import DAILY_SUMMARY, RAW_TRIPS
from ridemart.streaming.ingest import ingest_new


@pytest.fixture(scope="module")
def raw_folder(spark, inputs, tmp_path_factory):
    """The trip-shaped view as one Parquet file per month, the way raw trips arrive."""
    folder = str(tmp_path_factory.mktemp("raw") / "trips")
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    for i, name in enumerate(["a", "b", "c"]):
        part = inputs.raw.filter(F.col("trip_id") % 3 == i).drop("trip_id").orderBy(month)
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_read_trips_gives_the_fixed_schema_and_files(spark, raw_folder):
    read = trips.read_trips(spark, raw_folder, with_file=True)
    assert read.drop(trips.SOURCE_FILE).schema == RAW_TRIPS
    row = trips.volume(read).first()
    assert row["file_count"] == 3 and row["total_rows"] == 1000


def test_missing_column_fails_while_planning(spark, raw_folder, tmp_path):
    target = str(tmp_path / "short")
    spark.read.parquet(raw_folder).drop("tip_amount").write.parquet(target)
    with pytest.raises(ValueError, match="tip_amount"):
        trips.read_trips(spark, target)


def test_other_widths_and_extra_columns_are_accepted(spark, raw_folder, tmp_path):
    target = str(tmp_path / "wide")
    odd = spark.read.parquet(raw_folder).withColumns(
        {"passenger_count": F.col("passenger_count").cast("long"), "airport_fee": F.lit(1.0)}
    )
    odd.write.parquet(target)
    assert trips.read_trips(spark, target).schema == RAW_TRIPS


def test_filters_and_columns_reach_the_scan(spark, raw_folder):
    tables = build.derive(trips.read_trips(spark, raw_folder), WINDOW)
    execution = tables.mart_daily_summary._jdf.queryExecution()
    plan = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    read = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "GreaterThan(fare_amount,0.0)" in pushed and "LessThan(trip_distance,200.0)" in pushed
    assert "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)" in pushed
    for unused in ("VendorID", "RatecodeID", "PULocationID", "tolls_amount", "congestion_surcharge", "extra"):
        assert unused not in read


def test_cleaning_and_staging_do_not_shuffle(spark, raw_folder):
    stg = build.derive(trips.read_trips(spark, raw_folder), WINDOW).stg_trips
    assert "Exchange" not in stg._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rebalance", [False, True])
def test_run_stores_the_same_marts_as_the_plans(spark, raw_folder, inputs, tmp_path, rebalance):
    tables = build.run(spark, raw_folder, str(tmp_path / "out"), WINDOW, rebalance)
    assert sorted(tables.mart_daily_summary.collect()) == sorted(inputs.daily.collect())
    # An average that lies on half a cent may round either way in another order of rows.
    for got, want in zip(sorted(tables.mart_hourly_patterns.collect()), sorted(inputs.hourly.collect()), strict=True):
        assert got[:3] == want[:3] and tuple(got[3:]) == pytest.approx(tuple(want[3:]), abs=0.0101)
    january = tables.cleaned.filter("pickup_year = 2024 AND pickup_month = 1")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_year" in plan and "pickup_month" in plan.split("PartitionFilters")[1][:120]


def test_a_run_keeps_months_outside_its_window(spark, raw_folder, tmp_path):
    from ridemart.operators.columns import Window

    target = str(tmp_path / "out")
    whole = build.run(spark, raw_folder, target, WINDOW).cleaned
    before = {r["pickup_month"]: r["count"] for r in whole.groupBy("pickup_month").count().collect()}
    one = build.run(spark, raw_folder, target, Window("2024-02-01 00:00:00", "2024-03-01 00:00:00", 1)).cleaned
    assert {r["pickup_month"]: r["count"] for r in one.groupBy("pickup_month").count().collect()} == before


def test_marts_stored_as_tables_are_preferred(spark, inputs):
    derived = lambda: marts.narrow_daily(inputs.clean)
    assert len(storage.table_or(spark, "daily_mart_for_test", derived).columns) == 5
    stored = storage.save_view(inputs.daily, "daily_mart_for_test")
    try:
        found = storage.table_or(spark, "daily_mart_for_test", derived)
        assert found.columns == stored.columns and len(found.columns) == 9
        names = [r["name"] for r in storage.catalog_tables(spark).collect()]
        assert "daily_mart_for_test" in names
    finally:
        spark.catalog.dropTempView("daily_mart_for_test")


def test_csv_export_and_fallback(spark, inputs, tmp_path):
    path = str(tmp_path / "daily_csv")
    derive = lambda: inputs.daily.limit(0)
    assert storage.csv_or(spark, path, DAILY_SUMMARY, derive).count() == 0
    storage.export_mart(inputs.daily, path)
    read = storage.csv_or(spark, path, DAILY_SUMMARY, derive)
    assert read.schema == DAILY_SUMMARY and sorted(read.collect()) == sorted(inputs.daily.collect())


def test_ingest_picks_up_each_file_once(spark, raw_folder, inputs, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "log"))
    run = lambda: ingest_new(spark, source, target, checkpoint, RAW_TRIPS)
    raw = spark.read.schema(RAW_TRIPS).parquet(raw_folder)
    raw.limit(100).write.parquet(source)
    assert run().count() == 100
    assert run().count() == 100  # nothing new
    raw.limit(30).write.mode("append").parquet(source)
    assert run().count() == 130
    drifted = raw.limit(20).withColumn("passenger_count", F.col("passenger_count").cast("long"))
    drifted.withColumn("VendorID", F.col("VendorID").cast("int")).write.mode("append").parquet(source)
    found = run()
    assert found.count() == 150 and found.schema == RAW_TRIPS and run().count() == 150


def test_describe_schema(spark):
    got = trips.describe_schema(spark.createDataFrame([], "a int, b string"))
    assert [(r["column_name"], r["column_type"]) for r in got.orderBy("position").collect()] == [
        ("a", "int"),
        ("b", "string"),
    ]
    counted = trips.describe_schema(spark.createDataFrame([(1, None)], "a int, b string"), count_nulls=True).collect()
    assert [(r["nullable"], r["null_count"]) for r in counted] == [("NO", 0), ("YES", 1)]


@pytest.fixture
def drifted(spark, raw_folder, tmp_path):
    """Three files of two type variants, in both orders of appearance."""

    def make(order):
        folder = str(tmp_path / "".join(map(str, order)))
        for k, variant in enumerate(order):
            part = spark.read.parquet(raw_folder).filter(F.col("PULocationID") % 3 == k)
            if variant:
                part = part.withColumns({c: F.col(c).cast("long") for c in ("passenger_count", "RatecodeID")})
                part = part.withColumns({c: F.col(c).cast("int") for c in ("VendorID", "PULocationID", "payment_type")})
                part = part.withColumnRenamed("congestion_surcharge", "Congestion_Surcharge")
            part.coalesce(1).write.parquet(f"{folder}/{k}")
        return folder

    return make


@pytest.mark.parametrize("order", [(0, 1, 0), (1, 0, 1), (1, 1, 0)])
def test_files_of_different_types_are_read_together(spark, raw_folder, drifted, order):
    read = trips.read_trips(spark, drifted(order) + "/*", with_file=True)
    assert read.drop(trips.SOURCE_FILE).schema == RAW_TRIPS
    assert read.select(trips.SOURCE_FILE).distinct().count() == 3
    same = trips.read_trips(spark, raw_folder)
    assert sorted(read.drop(trips.SOURCE_FILE).collect(), key=str) == sorted(same.collect(), key=str)


def test_filters_reach_every_kind_of_file(spark, drifted):
    tables = build.derive(trips.read_trips(spark, drifted((0, 1, 0)) + "/*"), WINDOW)
    plan = spark._jvm.PythonSQLUtils.explainString(tables.mart_daily_summary._jdf.queryExecution(), "formatted")
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert len(pushed) == 2 and all("GreaterThan(fare_amount,0.0)" in p and "LessThan(trip_distance,200.0)" in p for p in pushed)
    assert all("GreaterThan(total_amount,0.0)" in p for p in pushed) and "passenger_count,1.0" in "".join(pushed)


def test_a_missing_column_in_one_kind_is_an_error(spark, drifted, raw_folder):
    folder = drifted((0, 1, 0))
    bad = spark.read.parquet(raw_folder).drop("tip_amount").withColumn("VendorID", F.col("VendorID").cast("int"))
    bad.write.parquet(f"{folder}/9")
    with pytest.raises(ValueError, match="tip_amount"):
        trips.read_trips(spark, folder + "/*")


def test_a_run_empties_months_without_rows_and_recomputes_only_its_own(spark, inputs, tmp_path):
    source, target = str(tmp_path / "raw"), str(tmp_path / "out")
    raw = inputs.raw.drop("trip_id")
    raw.write.parquet(f"{source}/all")
    raw.filter("month(tpep_pickup_datetime) <> 2").write.parquet(f"{source}/gap")
    build.run(spark, f"{source}/all", target, WINDOW)
    before = {p: (tmp_path / "out/mart_daily_summary_states" / p).stat().st_mtime_ns for p in stored_partitions(spark, f"{target}/mart_daily_summary_states", 2)}
    assert len(before) == 3
    february = Window("2024-02-01 00:00:00", "2024-03-01 00:00:00", 1)
    tables = build.run(spark, f"{source}/gap", target, february)
    assert {r[0] for r in tables.cleaned.select("pickup_month").distinct().collect()} == {1, 3}
    assert {r[0].month for r in tables.mart_daily_summary.select("trip_date").collect()} == {1, 3}
    after = {p: (tmp_path / "out/mart_daily_summary_states" / p).stat().st_mtime_ns for p in stored_partitions(spark, f"{target}/mart_daily_summary_states", 2)}
    assert after == {p: m for p, m in before.items() if not p.endswith("=2")}
    # A month whose states are missing is computed again with the next run.
    drop_partitions(spark, f"{target}/mart_daily_summary_states", ["pickup_year=2024/pickup_month=1"])
    again = build.run(spark, f"{source}/all", target, february)
    assert {r[0].month for r in again.mart_daily_summary.select("trip_date").collect()} == {1, 2, 3}


def test_states_are_read_by_partition(spark, inputs, tmp_path):
    target = str(tmp_path / "out")
    inputs.raw.drop("trip_id").write.parquet(f"{target}/raw")
    cleaned = build.run(spark, f"{target}/raw", target, WINDOW).cleaned
    found = states.hourly_states(cleaning.stage(cleaned.filter(build._in_months({(2024, 2)}))))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_year" in plan


def test_months_of_a_window():
    assert build.months_of(WINDOW) == [(2024, 1), (2024, 2), (2024, 3)]
    assert build.months_of(Window("2023-12-15 00:00:00", "2024-01-01 00:00:01", 1)) == [(2023, 12), (2024, 1)]


@pytest.mark.parametrize("states_of", [states.daily_states, states.hourly_states])
def test_states_of_parts_merge_into_those_of_the_whole(inputs, states_of):
    def rows(df):
        parts = [c for c in df.columns if c.startswith(("trips", "n_", "sum_"))]
        return {tuple(r[c] for c in sorted(set(df.columns) - set(parts))): [r[c] for c in parts] for r in df.collect()}

    parts = inputs.stg.withColumn("part", F.abs(F.hash("pickup_at")) % 3)
    some = [states_of(parts.filter(F.col("part") == k)) for k in range(3)]
    whole, merged = rows(states_of(inputs.stg)), rows(states.merged(some[0].union(some[1]).union(some[2])))
    assert merged.keys() == whole.keys()
    for key, row in whole.items():
        assert merged[key] == pytest.approx(row, rel=1e-12)


def test_ingestion_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    run = lambda: ingest_new(spark, str(tmp_path / "raw"), str(tmp_path / "to"), str(tmp_path / "log"), RAW_TRIPS)
    assert run().count() == 0 and run().schema == RAW_TRIPS
