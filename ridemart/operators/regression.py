"""Fare regression on staged trips: rows, pipelines, metrics, leaderboard, importances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ridemart.operators.sampling import sample_rows

# Model inputs in vector order, the band column being indexed, and the label.
BAND, BAND_INDEX, LABEL = "time_of_day", "time_of_day_enc", "fare_amount"
FEATURES = [
    "trip_distance",
    "passenger_count",
    "pickup_hour",
    "pickup_dow",
    "pickup_month",
    "pickup_location_id",
    "dropoff_location_id",
    "payment_type",
    "trip_duration_min",
    "avg_speed_mph",
    BAND_INDEX,
]
INPUTS = [BAND if name == BAND_INDEX else name for name in FEATURES]
MAX_SPEED = 100
TRAINING_ROWS = 500_000


def training_rows(stg: DataFrame, keys: Sequence[str], n: int | None = TRAINING_ROWS, seed: int = 42) -> DataFrame:
    """Keys, inputs and label of trips with a plausible speed, sampled to n rows.

    ``n=None`` trains on everything; fitting is distributed either way.
    """
    usable = stg.filter(F.col("avg_speed_mph") < MAX_SPEED).select(*keys, *INPUTS, LABEL)
    return usable if n is None else sample_rows(usable, n, keys, seed)


def band_indexer() -> StringIndexer:
    """Bands in alphabetical order become 0, 1, 2."""
    return StringIndexer(inputCol=BAND, outputCol=BAND_INDEX, stringOrderType="alphabetAsc", handleInvalid="error")


def encode_band(df: DataFrame) -> DataFrame:
    return band_indexer().fit(df).transform(df)


def regressors(
    forest_trees: int = 100,
    forest_depth: int = 10,
    boosting_rounds: int = 100,
    boosting_depth: int = 5,
    boosting_rate: float = 0.1,
    max_bins: int = 512,
    seed: int = 42,
) -> dict[str, object]:
    """The three candidates, by name; arguments default to full-size training.

    Trees may split on every feature, and ``max_bins`` lets them try each value of a zone id.
    """
    columns = {"featuresCol": "features", "labelCol": LABEL, "predictionCol": "prediction"}
    return {
        "LinearRegression": LinearRegression(solver="normal", **columns),
        "RandomForest": RandomForestRegressor(
            numTrees=forest_trees, maxDepth=forest_depth, featureSubsetStrategy="all", maxBins=max_bins, seed=seed, **columns
        ),
        "GradientBoosting": GBTRegressor(
            maxIter=boosting_rounds, maxDepth=boosting_depth, stepSize=boosting_rate, maxBins=max_bins, seed=seed, **columns
        ),
    }


def feature_stages() -> list:
    """Band index and feature vector, the stages every candidate starts with."""
    return [
        band_indexer(),
        VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="error"),
    ]


@dataclass(frozen=True)
class Fitted:
    """Complete pipelines by name, and how many rows they were fitted on."""

    models: dict[str, PipelineModel]
    train_rows: int


def train_all(train: DataFrame, candidates: Mapping[str, object]) -> Fitted:
    """Fit every candidate on the same rows.

    Feature stages are fitted once, and only the assembled vectors are kept, in memory or on
    disk, while the candidates iterate over them. The candidates are fitted side by side: one
    model's short jobs leave cores idle, which the others' jobs use. Rows stay partitioned as they come; keep a
    sample with ``keep`` before splitting it. Each result is a whole pipeline, features
    included, ready to be saved.
    """
    features = Pipeline(stages=feature_stages()).fit(train)
    kept = features.transform(train).select("features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = kept.count()
        own = inheritable_thread_target(train.sparkSession)
        fits = [own(partial(regressor.fit, kept)) for regressor in candidates.values()]
        with ThreadPool(max(1, len(fits))) as pool:
            fitted = pool.map(lambda fit: fit(), fits, chunksize=1)
        models = {name: PipelineModel([*features.stages, model]) for name, model in zip(candidates, fitted, strict=True)}
    finally:
        kept.unpersist()
    return Fitted(models, rows)


def evaluate(predicted: DataFrame, label: str = LABEL, prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE and R2 = 1 - SSE/SST in one pass; R2 is null for a constant label."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    pair = y.isNotNull() & p.isNotNull()
    spread = F.var_pop(y)
    return predicted.filter(pair).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(F.avg((y - p) * (y - p)), spread)).alias("r2"),
    )


def least_squares_conditions(predicted: DataFrame, label: str = LABEL, tolerance: float = 1e-6) -> DataFrame:
    """Whether residuals of a linear fit average zero and are orthogonal to every feature.

    Both hold on the training rows of exact least squares with an intercept. Sums are set
    against the size of their terms, so the tolerance has no unit. One pass.
    """
    residual = F.col(label) - F.col("prediction")
    x = vector_to_array("features")
    terms = [residual * x[i] for i in range(len(FEATURES))]
    size = lambda c: F.greatest(F.avg(F.abs(c)), F.lit(1e-12))
    scale = F.greatest(F.avg(F.abs(F.col(label))), F.lit(1e-12))
    orthogonal = [F.abs(F.avg(t)) <= tolerance * scale * size(x[i]) for i, t in enumerate(terms)]
    return predicted.agg(
        (F.abs(F.avg(residual)) <= tolerance * scale).alias("mean_residual_zero"),
        reduce(lambda a, b: a & b, orthogonal).alias("residuals_orthogonal"),
    )


def tree_size(model: PipelineModel) -> tuple[int, int]:
    """Number of trees of a fit and depth of the deepest; both 0 for a model without trees."""
    trees = getattr(model.stages[-1], "trees", [])
    return len(trees), max((tree.depth for tree in trees), default=0)


def loss_by_round(model: PipelineModel, rows: DataFrame) -> list[float]:
    """Mean squared error of a boosting on the rows after each of its rounds, one pass."""
    return model.stages[-1].evaluateEachIteration(PipelineModel(model.stages[:-1]).transform(rows), "squared")


def never_rises(losses: Sequence[float], tolerance: float = 1e-9) -> bool:
    """Whether each round lowers the loss or leaves it, and all of them together lower it.

    Holds for squared error on the training rows, where each leaf adds a part of its mean residual.
    """
    allowed = tolerance * max(losses, default=0.0)
    return all(b <= a + allowed for a, b in zip(losses, losses[1:])) and len(losses) > 1 and losses[-1] < losses[0]


def leaderboard(fitted: Fitted, test: DataFrame) -> DataFrame:
    """One row per model in the order given: held-out metrics, and whether it is the best.

    The best has the lowest MAE, the earlier one on ties. The test rows are kept while all
    models are evaluated; what comes back is one row of numbers per model.
    """
    held_out = test.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores = {
            name: evaluate(model.transform(held_out)).first().asDict()
            for name, model in fitted.models.items()
        }
    finally:
        held_out.unpersist()
    best = min(scores, key=lambda name: scores[name]["mae"])
    rows = [
        (i, name, fitted.train_rows, m["n_rows"], m["mae"], m["rmse"], m["r2"], name == best)
        for i, (name, m) in enumerate(scores.items())
    ]
    return test.sparkSession.createDataFrame(
        rows,
        "position int, model_type string, n_train_rows long, n_test_rows long, "
        "mae double, rmse double, r2 double, is_best boolean",
    )


def best_model(board: DataFrame) -> str:
    """Name of the best model of a leaderboard."""
    return board.filter("is_best").first()["model_type"]


def save_best(fitted: Fitted, board: DataFrame, path: str) -> str:
    """Save the best pipeline and return its name."""
    best = best_model(board)
    save_model(fitted.models[best], path)
    return best


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """Importance per input, largest first: impurity gain of trees, |coefficient| otherwise."""
    fitted = model.stages[-1]
    if hasattr(fitted, "featureImportances"):
        weights = fitted.featureImportances.toArray()
    else:
        weights = abs(fitted.coefficients.toArray())
    rows = [(name, float(w)) for name, w in zip(FEATURES, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
