from types import SimpleNamespace

import pytest

from ridemart.plans import build, report_sets
from ridemart.plans.catalog import KEY, WINDOW
from ridemart.session import shared_folder


@pytest.fixture(scope="module")
def tables(inputs):
    return build.derive(inputs.raw, WINDOW)


def test_every_table_of_every_report_has_rows(inputs, tables):
    made = {
        "quality": report_sets.quality_report(inputs.raw, WINDOW),
        "exploration": report_sets.exploration_report(inputs.raw_with_file, KEY),
        "verification": report_sets.verification_report(tables),
        "dashboard": report_sets.dashboard_report(tables, KEY),
    }
    assert {k: len(v) for k, v in made.items()} == {
        "quality": 9,
        "exploration": 17,
        "verification": 11,
        "dashboard": 20,
    }
    for report, parts in made.items():
        for name, df in parts.items():
            # The fixture has trips on every day, so the one list without rows is that of missing days.
            assert df.limit(1).count() == (name != "date_gaps"), f"{report}.{name}"


def test_dashboard_filters_days_only(tables):
    some = report_sets.dashboard_report(tables, KEY, months=["March"], day_types=["Weekend"])
    assert {r["month"] for r in some["days"].collect()} == {"March"}
    assert some["kpis"].first()["total_trips"] == 696


def _session(master, configured=None, current=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: current),
    )


def test_shared_folder_follows_the_cluster_setting():
    assert shared_folder(_session("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/x-")
    assert shared_folder(_session("yarn", current="/mnt/all"), "x").startswith("/mnt/all/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(_session("spark://host:7077"), "x")


def test_breakdowns_of_one_scan_equal_the_single_ones(inputs):
    from ridemart.operators import reports

    grouped, keys = reports.exploration_groups(inputs.raw)
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    single = {
        "passengers": reports.passenger_distribution, "payments": reports.payment_distribution, "rate_codes": reports.rate_code_distribution,
        "vendors": reports.vendor_distribution, "months": reports.monthly_aggregates, "hours": reports.hourly_profile,
        "weekdays": reports.weekday_profile, "day_types": reports.day_type_profile, "pickup_zones": reports.top_pickups,
        "dropoff_zones": reports.top_dropoffs, "routes": reports.top_routes,
    }
    found = report_sets.one_scan_breakdowns(inputs.raw)
    assert found.keys() == single.keys()
    for name, table in found.items():
        want = single[name](inputs.raw)
        assert set(table.columns) == set(want.columns), name
        assert sorted(map(repr, table.collect())) == sorted(map(repr, want.select(*table.columns).collect())), name
