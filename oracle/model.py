"""The fare model: its rows, and what must hold of any right fit.

A fitted model has no SQL form; its registered queries return row counts, which SQL gives, and
conditions that a right fit meets.
"""

from oracle.base import over

# Staging drops the key, so the training rows are staged here from the cleaned rows.
_TRAINING = """
SELECT trip_id, trip_distance, CAST(passenger_count AS INTEGER) AS passenger_count, pickup_hour, pickup_dow,
  pickup_month, CAST(PULocationID AS INTEGER) AS pickup_location_id,
  CAST(DOLocationID AS INTEGER) AS dropoff_location_id, CAST(payment_type AS INTEGER) AS payment_type,
  trip_duration_min, avg_speed_mph, time_of_day, fare_amount
FROM clean
WHERE avg_speed_mph IS NOT NULL AND avg_speed_mph < 100
ORDER BY md5('42|' || trip_id), trip_id
LIMIT 500000
"""

_PART = "('0x' || substr(md5('split|42|' || trip_id), 1, 8))::BIGINT < round(0.2 * 4294967296)::BIGINT"
_COUNTS = f"""
counts AS (
  SELECT count(*) FILTER (WHERE NOT is_test) AS n_train_rows, count(*) FILTER (WHERE is_test) AS n_test_rows
  FROM (SELECT {_PART} AS is_test FROM ({_TRAINING}))
)
"""


def _with_counts(body: str) -> str:
    return over("clean", body="") + "," + _COUNTS + body


def _trees(size: str, more: str = "") -> str:
    return _with_counts(
        f"SELECT *, {size}, true AS r2_in_band, true AS mae_up_to_rmse{more} FROM counts"
    )


# The candidates in order with trees and depth, the model inputs, and the request bounds.
_NO_TREES = "0::INTEGER AS n_trees, 0::INTEGER AS tree_depth"
_FOREST = "100::INTEGER AS n_trees, 10::INTEGER AS tree_depth"
_BOOSTING = "100::INTEGER AS n_trees, 5::INTEGER AS tree_depth"
_MODELS = [("LinearRegression", _NO_TREES), ("RandomForest", _FOREST), ("GradientBoosting", _BOOSTING)]
_FEATURES = [
    "trip_distance", "passenger_count", "pickup_hour", "pickup_dow", "pickup_month", "pickup_location_id",
    "dropoff_location_id", "payment_type", "trip_duration_min", "avg_speed_mph", "time_of_day_enc",
]
_REQUEST_RULES = [
    ("trip_distance > 0", "trip_distance > 0 AND trip_distance < 'infinity'::DOUBLE"),
    ("passenger_count in 1..6", "passenger_count BETWEEN 1 AND 6"),
    ("pickup_hour in 0..23", "pickup_hour BETWEEN 0 AND 23"),
    ("pickup_dow in 0..6", "pickup_dow BETWEEN 0 AND 6"),
    ("pickup_month in 1..12", "pickup_month BETWEEN 1 AND 12"),
    ("payment_type in 1..2", "payment_type BETWEEN 1 AND 2"),
    ("trip_duration_min > 0", "trip_duration_min > 0 AND trip_duration_min < 'infinity'::DOUBLE"),
    ("avg_speed_mph > 0", "avg_speed_mph > 0 AND avg_speed_mph < 'infinity'::DOUBLE"),
    ("time_of_day is a known band", "time_of_day IN ('morning_rush', 'evening_rush', 'off_peak')"),
]
_REASON = " ".join(f"WHEN ({cond}) IS DISTINCT FROM TRUE THEN '{name}'" for name, cond in _REQUEST_RULES)
_OUTCOME = " ".join(
    f"WHEN ({cond}) IS NULL THEN 'null' WHEN NOT ({cond}) THEN 'failed'" for _, cond in _REQUEST_RULES
)

_VALIDATED = f"""
SELECT *, reason IS NULL AS accepted
FROM (
  SELECT *, CASE {_REASON} END AS reason, CASE {_OUTCOME} END AS outcome
  FROM (
    SELECT trip_id, trip_distance, CAST(passenger_count AS INTEGER) AS passenger_count, pickup_hour,
      pickup_dow, pickup_month, CAST(PULocationID AS INTEGER) AS pickup_location_id,
      CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
      CAST(payment_type AS INTEGER) AS payment_type,
      CAST(trip_duration_min AS DOUBLE) AS trip_duration_min, avg_speed_mph, time_of_day
    FROM features
  )
)
"""
_SCORED = f"SELECT *, accepted AS has_prediction, 'LinearRegressionModel' AS model_name FROM ({_VALIDATED})"

STATEMENTS = {
    "training_rows": over("clean", body=_TRAINING),
    "encode_band": over(
        "clean",
        body="""
        SELECT trip_id, time_of_day, CAST(dense_rank() OVER (ORDER BY time_of_day) - 1 AS DOUBLE) AS time_of_day_enc
        FROM clean
        """,
    ),
    "train_test_split": over(
        "clean",
        body=f"SELECT trip_id, {_PART} AS is_test FROM ({_TRAINING})",
    ),
    "regression_metrics": over(
        "stg",
        body="""
        SELECT count(*) AS n_rows, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) ** 2)), 6) AS rmse,
          round(1 - sum((y - p) ** 2) / sum((y - mean_y) ** 2), 6) AS r2
        FROM (SELECT fare_amount AS y, 3.0 + 2.5 * trip_distance AS p,
                avg(fare_amount) OVER () AS mean_y FROM stg)
        """,
    ),
    "train_test_split_sampled": over(
        "clean",
        body=f"SELECT trip_id, {_PART} AS is_test FROM ({_TRAINING.replace('LIMIT 500000', 'LIMIT 1000')})",
    ),
    "lr_metrics": _with_counts(
        "SELECT *, true AS r2_in_band, true AS mean_residual_zero, true AS residuals_orthogonal FROM counts"
    ),
    "rf_metrics": _trees(_FOREST),
    "gbt_metrics": _trees(_BOOSTING, ", true AS loss_never_rises"),
    "model_leaderboard": _with_counts(
        f"""
        SELECT m.*, counts.*, true AS r2_in_band, true AS best_has_least_mae,
          1::BIGINT AS n_best, true AS reloaded_the_same
        FROM counts, ({" UNION ALL ".join(f"SELECT {i} AS position, '{m}' AS model_type, {size}" for i, (m, size) in enumerate(_MODELS))}) AS m
        """
    ),
    "feature_importance": f"""
        SELECT feature, true AS not_negative, true AS sum_is_one, feature = 'trip_distance' AS is_largest, {_BOOSTING}
        FROM (VALUES {", ".join(f"('{f}')" for f in _FEATURES)}) AS f(feature)
    """,
    "score_validation": over("features", body=_VALIDATED),
    "score_batch": over("features", body=_SCORED),
    "score_stream": over("features", body=_SCORED),
}
