"""Every registered query against its SQL, and plan properties that hold for all of them."""

import os
import re

import pytest
from conftest import DATA

import __spark_entry__ as registered
from oracle import statements
from ridemart.plans import catalog
from tools.compare import connect, difference

QUERIES, ORACLES = catalog.queries(), statements()
FITTING = [
    "lr_metrics",
    "rf_metrics",
    "gbt_metrics",
    "model_leaderboard",
    "feature_importance",
    "score_batch",
    "score_stream",
]


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_statement_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(ORACLES) - set(FITTING)))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toArrow()
    assert difference(got, duck.sql(ORACLES[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(FITTING) - {"ingest_new", "write_read_clean", "mart_csv_roundtrip", "pipeline_run", "pipeline_rerun", "daily_by_months", "hourly_by_months", "curved_run"}))
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


SMALL = {"forest_trees": 8, "forest_depth": 6, "boosting_rounds": 8, "boosting_depth": 5}


def fit_differs(spark, duck, name, monkeypatch, **changed):
    """How a query of candidates of the given size differs from its SQL for small ones."""
    from ridemart.operators import regression

    full = regression.regressors
    monkeypatch.setattr(regression, "regressors", lambda **given: full(**{**SMALL, **changed, **given}))
    sql = ORACLES[name].replace("100::INTEGER AS n_trees", "8::INTEGER AS n_trees")
    sql = sql.replace("10::INTEGER AS tree_depth", "6::INTEGER AS tree_depth")
    return difference(QUERIES[name](spark, DATA).toArrow(), duck.sql(sql).to_arrow_table())


@pytest.mark.parametrize("name", FITTING)
def test_fits_meet_their_conditions(spark, duck, name, monkeypatch):
    """The registered queries fit full-size candidates; here the same conditions hold of small ones."""
    assert fit_differs(spark, duck, name, monkeypatch) is None


@pytest.mark.parametrize(
    "name, changed",
    [
        ("rf_metrics", {"forest_depth": 1}),
        ("rf_metrics", {"forest_trees": 1}),
        ("gbt_metrics", {"boosting_depth": 1}),
        ("gbt_metrics", {"boosting_rounds": 1}),
        ("model_leaderboard", {"forest_depth": 1}),
        ("model_leaderboard", {"boosting_rounds": 1}),
        ("feature_importance", {"boosting_depth": 1}),
        ("feature_importance", {"boosting_rounds": 1}),
    ],
)
def test_stunted_fits_fail_their_conditions(spark, duck, name, changed, monkeypatch):
    assert fit_differs(spark, duck, name, monkeypatch, **changed) is not None


def test_rising_losses_are_noticed():
    from ridemart.operators.regression import never_rises

    assert never_rises([4.0, 2.0, 2.0, 1.0])
    assert not never_rises([4.0, 2.0, 2.1]) and not never_rises([4.0, 4.0]) and not never_rises([4.0]) and not never_rises([])


def test_results_do_not_depend_on_the_session_zone(spark, duck):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        for name in ["mart_daily", "date_gaps", "best_worst", "daily_calendar", "numeric_summary", "clean"]:
            got = QUERIES[name](spark, DATA).toArrow()
            assert difference(got, duck.sql(ORACLES[name]).to_arrow_table()) is None, name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_entry(spark):
    assert registered.entry(spark).count() == 90


def test_groups_cover_all_queries():
    assert sum(len(g) for g in catalog.GROUPS.values()) == len(QUERIES)


GOLDEN = os.environ.get("RIDEMART_GOLDEN_MARTS")


@pytest.mark.skipif(not GOLDEN, reason="set RIDEMART_GOLDEN_MARTS to a folder with the two exported marts")
def test_operators_on_exported_marts(spark):
    from ridemart.operators import marts, verify
    from ridemart.sources.marts import read_mart_csv
    from ridemart.sources.schema import DAILY_SUMMARY, HOURLY_PATTERNS

    daily = read_mart_csv(spark, f"{GOLDEN}/mart_daily_summary.csv", DAILY_SUMMARY).cache()
    hourly = read_mart_csv(spark, f"{GOLDEN}/mart_hourly_patterns.csv", HOURLY_PATTERNS).cache()
    kpis = marts.daily_kpis(daily).first()
    assert kpis["total_trips"] == 8_797_764 and round(kpis["total_revenue"], 2) == 243_126_928.83
    assert kpis["mean_of_avg_fare"] == pytest.approx(18.776444, abs=1e-6)
    stats = verify.daily_stats(daily).first()
    assert tuple(stats) == (97753.0, 11242.0, 61802, 116280, 2701410.0, 286659.0)
    odd = {str(r["trip_date"])[:10]: r["z_score"] for r in verify.outlier_days(daily).collect()}
    assert odd == {"2023-02-20": -2.04, "2023-01-01": -2.48, "2023-01-02": -3.2}
    assert verify.date_gaps(daily).count() == 0
    best = {r["metric"]: (r["date"][:10], r["value"]) for r in verify.best_worst(daily).collect()}
    assert best["Highest Revenue"] == ("2023-03-16", "$3396994.54")
    assert best["Highest Avg Fare"] == ("2023-01-02", "$22.32")
    assert best["Lowest Avg Fare"][0] == "2023-02-04"
    months = {r["month"]: (r["total_trips"], r["total_revenue"]) for r in marts.revenue_by_month(marts.daily_calendar(daily)).collect()}
    assert months == {
        "January": (2_881_104, 78_793_454.23),
        "February": (2_729_634, 74_463_463.32),
        "March": (3_187_026, 89_870_011.28),
    }
    days = {r["day"]: r["trips"] for r in marts.weekday_from_daily(daily).collect()}
    assert days["Thu"] == 1_403_978 and days["Mon"] == 1_071_154
    bands = {r["time_of_day"]: r["trips"] for r in marts.rush_from_hourly(hourly).collect()}
    assert bands == {"off_peak": 5_491_540, "evening_rush": 2_353_550, "morning_rush": 952_674}
    assert verify.assertions(daily, hourly).filter("status = 'FAIL'").count() == 0


@pytest.mark.parametrize("name", ["clean", "stg_trips", "add_features"])
def test_generated_code_is_small_enough_to_be_compiled(spark, name):
    """The JVM runs methods of over 8,000 bytes without compiling them."""
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution()
    text = spark._jvm.PythonSQLUtils.explainString(plan, "codegen")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8_000
