"""Scoring requests with a saved pipeline: validate, split, predict. Batch or stream.

Everything here is a row-wise projection, so the same function runs on a streaming
DataFrame without state.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions.labels import OFF_PEAK, TIME_BANDS
from ridemart.functions.numeric import rounded
from ridemart.operators.regression import FEATURES, INPUTS
from ridemart.operators.rules import Rule, mark_broken, one_of

# Zones used when a request names none.
DEFAULT_PICKUP_ZONE = 161
DEFAULT_DROPOFF_ZONE = 237


def _range(column: str, low: int, high: int) -> Rule:
    return Rule(f"{column} in {low}..{high}", lambda: F.col(column).between(low, high))


def _finite_above(column: str, bound: float) -> Rule:
    """NaN counts as the largest value, so a comparison alone would let it pass."""
    x = lambda: F.col(column).cast("double")
    return Rule(f"{column} > {bound}", lambda: (x() > bound) & (x() < float("inf")))


def request_rules() -> list[Rule]:
    """Bounds a scoring request must respect; NaN and infinities break them."""
    return [
        _finite_above("trip_distance", 0),
        _range("passenger_count", 1, 6),
        _range("pickup_hour", 0, 23),
        _range("pickup_dow", 0, 6),
        _range("pickup_month", 1, 12),
        _range("payment_type", 1, 2),
        _finite_above("trip_duration_min", 0),
        _finite_above("avg_speed_mph", 0),
        one_of("time_of_day", [*TIME_BANDS, OFF_PEAK], "time_of_day is a known band"),
    ]


def _with_default_zones(df: DataFrame) -> DataFrame:
    def filled(column: str, default: int) -> Column:
        given = F.col(column) if column in df.columns else F.lit(None)
        return F.coalesce(given.cast("int"), F.lit(default))

    return df.withColumns(
        {
            "pickup_location_id": filled("pickup_location_id", DEFAULT_PICKUP_ZONE),
            "dropoff_location_id": filled("dropoff_location_id", DEFAULT_DROPOFF_ZONE),
        }
    )


def validate(requests: DataFrame) -> DataFrame:
    """Mark each request accepted, or rejected with the first rule it breaks."""
    marked = mark_broken(_with_default_zones(requests), request_rules())
    return marked.withColumn("accepted", F.col("reason").isNull())


def score(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Validated requests with ``predicted_fare_usd``, null on rejected ones.

    One pass over the requests: rejected rows carry harmless stand-in inputs through the
    model and lose the prediction afterwards, so nothing is split and unioned again.
    """
    marked = validate(requests)
    held = {f"_in_{c}": F.col(c) for c in INPUTS}
    safe = {
        c: F.when(F.col("accepted"), F.col(c)).otherwise(F.lit(OFF_PEAK if c == "time_of_day" else 0))
        for c in INPUTS
    }
    predicted = model.transform(marked.withColumns(held).withColumns(safe))
    restored = predicted.withColumns({c: F.col(f"_in_{c}") for c in INPUTS})
    return restored.withColumns(
        {
            "predicted_fare_usd": F.when(F.col("accepted"), rounded("prediction")),
            "model_name": F.lit(type(model.stages[-1]).__name__),
        }
    ).drop(*held, "features", "prediction", FEATURES[-1])
