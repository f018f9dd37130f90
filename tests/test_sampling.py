import hashlib

import pytest

from ridemart.operators.profile import correlations, scatter_sample
from ridemart.operators.sampling import in_test, sample_rows, split


def digest(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 2, 17, 500, 999, 1000, 5000])
def test_sample_is_the_smallest_hashes(spark, n):
    rows = spark.range(1000).repartition(5)
    got = [r["id"] for r in sample_rows(rows, n, ["id"]).collect()]
    assert sorted(got) == sorted(sorted(range(1000), key=digest)[:n])


def test_sample_does_not_depend_on_partitioning(spark):
    rows = spark.range(3000)
    a = {r["id"] for r in sample_rows(rows.repartition(3), 100, ["id"], seed=5).collect()}
    b = {r["id"] for r in sample_rows(rows.repartition(11), 100, ["id"], seed=5).collect()}
    assert a == b and a != {r["id"] for r in sample_rows(rows, 100, ["id"], seed=6).collect()}


def test_repeated_keys_still_give_the_exact_size(spark):
    rows = spark.range(900).selectExpr("id % 3 AS k", "id AS v")
    assert sample_rows(rows, 10, ["k"]).count() == 10


def test_sample_of_nothing(spark):
    assert sample_rows(spark.range(0), 10, ["id"]).count() == 0


def test_split_is_complete_disjoint_and_near_its_share(spark):
    rows = spark.range(20_000)
    train, test = split(rows, ["id"])
    assert train.count() + test.count() == 20_000
    assert train.join(test, "id").count() == 0
    assert test.count() / 20_000 == pytest.approx(0.2, abs=0.01)
    assert rows.filter(in_test(["id"])).count() == test.count()


def test_split_is_independent_of_the_sample_when_seeds_differ(spark):
    drawn = sample_rows(spark.range(50_000), 5000, ["id"], seed=1)
    _, test = split(drawn, ["id"], seed=2)
    assert test.count() / 5000 == pytest.approx(0.2, abs=0.02)


def test_scatter_sample_sizes(inputs):
    assert scatter_sample(inputs.clean, ["trip_id"], n=50, m=20).count() == 20
    assert scatter_sample(inputs.clean, ["trip_id"], n=10, m=20).count() == 10


def test_correlations_on_all_rows_equal_a_full_sample(inputs):
    full = correlations(inputs.raw, ["trip_id"], n=None).first()
    assert full == correlations(inputs.raw, ["trip_id"], n=10**6).first()


def test_split_is_independent_of_a_sample_with_the_same_seed(spark):
    drawn = sample_rows(spark.range(50_000), 5000, ["id"])
    train, test = split(drawn, ["id"])
    assert test.count() / 5000 == pytest.approx(0.2, abs=0.02) and train.count() + test.count() == 5000
    rows = spark.range(60_000)
    assert sample_rows(rows, 30_000, ["id"]).filter(in_test(["id"])).count() / 30_000 == pytest.approx(0.2, abs=0.01)


@pytest.mark.parametrize("share", [0, 0.001, 0.2, 0.999, 1])
def test_share_is_exact_at_any_size(spark, share):
    got = spark.range(50_000).filter(in_test(["id"], share)).count() / 50_000
    assert got == pytest.approx(share, abs=0.005) and (0 < share < 1 or got == share)


def test_shares_outside_the_range_are_refused():
    for share in (-0.1, 1.1):
        with pytest.raises(ValueError):
            in_test(["id"], share)


def test_no_whole_row_is_merged_in_one_task(spark):
    rows = spark.range(5000).selectExpr("id", "repeat('x', 20) AS payload")
    plan = sample_rows(rows, 100, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "rangepartitioning" not in plan
    assert not [x for x in plan.splitlines() if "SinglePartition" in x and "payload" in x]
