import pytest
from pyspark.sql import functions as F

from ridemart.operators import regression, sampling, scoring
from ridemart.plans.catalog import KEY
from ridemart.sources.schema import EVENTS  # noqa: F401  (schema of the streamed table)


@pytest.fixture(scope="module")
def fitted(spark):
    from ridemart.plans.catalog import Inputs

    rows = regression.training_rows(Inputs(spark, "/root/testdata/sf0.01").keyed_stg, KEY)
    train, test = sampling.split(rows, KEY)
    small = regression.regressors(forest_trees=5, forest_depth=5, boosting_rounds=5, boosting_depth=4)
    return regression.train_all(train, small), train, test


def test_candidates_are_good_enough_and_ranked(fitted):
    models, train, test = fitted
    board = regression.leaderboard(models, test)
    rows = {r["model_type"]: r for r in board.collect()}
    assert set(rows) == {"LinearRegression", "RandomForest", "GradientBoosting"}
    for row in rows.values():
        assert row["r2"] > 0.75 and row["mae"] > 0 and row["rmse"] >= row["mae"]
        assert (row["n_train_rows"], row["n_test_rows"]) == (train.count(), test.count())
    assert sum(r["is_best"] for r in rows.values()) == 1
    assert min(rows.values(), key=lambda r: r["mae"])["is_best"]


def test_saved_model_scores_the_same(fitted, tmp_path):
    models, train, test = fitted
    board = regression.leaderboard(models, test)
    name = regression.save_best(models, board, str(tmp_path / "best"))
    loaded = regression.load_model(str(tmp_path / "best"))
    a = regression.evaluate(models.models[name].transform(test)).first()
    assert a == regression.evaluate(loaded.transform(test)).first()


def test_line_is_recovered(spark):
    rows = spark.range(200).select(
        *[F.lit(1).alias(c) for c in regression.INPUTS if c not in ("trip_distance", "time_of_day")],
        (F.col("id") / 10).alias("trip_distance"),
        F.element_at(F.array(F.lit("off_peak"), F.lit("morning_rush"), F.lit("evening_rush")), (F.col("id") % 3 + 1).cast("int")).alias("time_of_day"),
        (F.col("id") / 10 * 2.5 + 3).alias("fare_amount"),
    )
    fitted = regression.train_all(rows, {"LinearRegression": regression.regressors()["LinearRegression"]})
    line = fitted.models["LinearRegression"].stages[-1]
    assert line.coefficients[0] == pytest.approx(2.5) and line.intercept == pytest.approx(3.0)
    importance = regression.feature_importance(fitted.models["LinearRegression"], spark).first()
    assert importance["feature"] == "trip_distance"


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0)], "y double, p double")
    row = regression.evaluate(df, "y", "p").first()
    assert (row["n_rows"], row["mae"]) == (3, 1.0)
    assert row["rmse"] == pytest.approx((5 / 3) ** 0.5) and row["r2"] == pytest.approx(1 - 5 / 8)
    flat = spark.createDataFrame([(2.0, 1.0), (2.0, 2.0)], "y double, p double")
    assert regression.evaluate(flat, "y", "p").first()["r2"] is None


def test_band_codes(spark):
    df = spark.createDataFrame([("off_peak",), ("morning_rush",), ("evening_rush",), ("off_peak",)], "time_of_day string")
    codes = {r["time_of_day"]: r["time_of_day_enc"] for r in regression.encode_band(df).collect()}
    assert codes == {"evening_rush": 0.0, "morning_rush": 1.0, "off_peak": 2.0}


# The example request.
REQUEST = {
    "trip_distance": 2.5,
    "passenger_count": 1,
    "pickup_hour": 8,
    "pickup_dow": 1,
    "pickup_month": 1,
    "pickup_location_id": 161,
    "dropoff_location_id": 237,
    "payment_type": 1,
    "trip_duration_min": 15.0,
    "avg_speed_mph": 12.0,
    "time_of_day": "morning_rush",
}
REQUEST_SCHEMA = (
    "trip_distance double, passenger_count int, pickup_hour int, pickup_dow int, pickup_month int, "
    "pickup_location_id int, dropoff_location_id int, payment_type int, trip_duration_min double, "
    "avg_speed_mph double, time_of_day string"
)


def requests(spark, *changes):
    return spark.createDataFrame([tuple({**REQUEST, **c}.values()) for c in changes], REQUEST_SCHEMA)


@pytest.mark.parametrize(
    "change,reason",
    [
        ({}, None),
        ({"trip_distance": 0.0}, "trip_distance > 0"),
        ({"passenger_count": 7}, "passenger_count in 1..6"),
        ({"pickup_hour": 24}, "pickup_hour in 0..23"),
        ({"pickup_dow": 7}, "pickup_dow in 0..6"),
        ({"pickup_month": 13}, "pickup_month in 1..12"),
        ({"payment_type": 3}, "payment_type in 1..2"),
        ({"trip_duration_min": 0.0}, "trip_duration_min > 0"),
        ({"avg_speed_mph": None}, "avg_speed_mph > 0"),
        ({"time_of_day": "noon"}, "time_of_day is a known band"),
        ({"trip_distance": float("nan")}, "trip_distance > 0"),
        ({"trip_duration_min": float("inf")}, "trip_duration_min > 0"),
        ({"avg_speed_mph": float("nan")}, "avg_speed_mph > 0"),
        ({"avg_speed_mph": float("-inf")}, "avg_speed_mph > 0"),
    ],
)
def test_request_bounds(spark, change, reason):
    row = scoring.validate(requests(spark, change)).first()
    assert row["reason"] == reason and row["accepted"] == (reason is None)


def test_scoring_keeps_every_request_and_its_inputs(spark, fitted):
    models, _, _ = fitted
    nan, inf = float("nan"), float("inf")
    odd = [{"trip_distance": nan}, {"trip_duration_min": inf}, {"avg_speed_mph": nan}]
    refused = scoring.score(requests(spark, *odd), models.models["LinearRegression"]).collect()
    assert all(r["predicted_fare_usd"] is None and not r["accepted"] for r in refused)
    asked = requests(spark, {}, {"time_of_day": "noon"}, {"avg_speed_mph": None}, {"pickup_location_id": None})
    for name, model in models.models.items():
        got = scoring.score(asked, model).collect()
        assert [r["time_of_day"] for r in got] == ["morning_rush", "noon", "morning_rush", "morning_rush"]
        assert [r["predicted_fare_usd"] is None for r in got] == [False, True, True, False]
        # The default pickup zone is the one of the first request.
        assert got[0]["predicted_fare_usd"] == got[3]["predicted_fare_usd"]
        assert got[0]["predicted_fare_usd"] == round(got[0]["predicted_fare_usd"], 2)


def test_zone_columns_may_be_absent(spark, fitted):
    models, _, _ = fitted
    short = requests(spark, {}).drop("pickup_location_id", "dropoff_location_id")
    model = models.models["LinearRegression"]
    assert (
        scoring.score(short, model).first()["predicted_fare_usd"]
        == scoring.score(requests(spark, {}), model).first()["predicted_fare_usd"]
    )


def test_stream_scores_equal_batch_scores(spark, fitted, tmp_path):
    from ridemart.streaming.scoring import score_stream

    models, _, _ = fitted
    model = models.models["RandomForest"]
    source = str(tmp_path / "requests")
    asked = requests(spark, {}, {"trip_distance": 9.0}, {"payment_type": 5}, {"trip_distance": float("nan")}, {"avg_speed_mph": float("inf")})
    asked.write.parquet(source)
    stream = spark.readStream.schema(asked.schema).parquet(source)
    out = score_stream(stream, model, str(tmp_path / "scored"), str(tmp_path / "log"))
    columns = ["trip_distance", "accepted", "predicted_fare_usd"]
    batch = scoring.score(asked, model).select(*columns)
    assert sorted(map(str, out.select(*columns).collect())) == sorted(map(str, batch.collect()))  # NaN is not NaN


def test_candidates_have_full_size_and_all_features(spark):
    made = regression.regressors()
    forest, boosting = made["RandomForest"], made["GradientBoosting"]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getFeatureSubsetStrategy()) == (100, 10, "all")
    assert (boosting.getMaxIter(), boosting.getMaxDepth(), boosting.getStepSize()) == (100, 5, 0.1)
    assert forest.getMaxBins() >= 512 and boosting.getMaxBins() >= 512


def test_least_squares_conditions_tell_a_wrong_line(spark, fitted):
    models, train, _ = fitted
    predicted = models.models["LinearRegression"].transform(train)
    assert tuple(regression.least_squares_conditions(predicted).first()) == (True, True)
    moved = predicted.withColumn("prediction", F.col("prediction") + 0.01)
    tilted = predicted.withColumn("prediction", F.col("prediction") + (F.col("trip_distance") - 12) / 100)
    assert not regression.least_squares_conditions(moved).first()["mean_residual_zero"]
    assert not regression.least_squares_conditions(tilted).first()["residuals_orthogonal"]


def test_candidates_are_fitted_side_by_side(spark):
    """Two candidates that wait for each other are both fitted, and keep their names."""
    import threading

    both = threading.Barrier(2, timeout=20)

    class Waiting:
        def __init__(self, regressor):
            self.regressor = regressor

        def fit(self, rows):
            both.wait()
            return self.regressor.fit(rows)

    rows = spark.range(60).select(
        *[F.lit(1).alias(c) for c in regression.INPUTS if c not in ("trip_distance", "time_of_day")],
        (F.col("id") / 10).alias("trip_distance"),
        F.element_at(F.array(F.lit("off_peak"), F.lit("morning_rush")), (F.col("id") % 2 + 1).cast("int")).alias("time_of_day"),
        (F.col("id") / 10 * 2.5 + 3).alias("fare_amount"),
    )
    made = regression.regressors(forest_trees=2, forest_depth=2)
    fitted = regression.train_all(rows, {name: Waiting(made[name]) for name in ("RandomForest", "LinearRegression")})
    assert [(name, regression.tree_size(model)[0]) for name, model in fitted.models.items()] == [("RandomForest", 2), ("LinearRegression", 0)]
