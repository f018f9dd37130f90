"""Scoring a stream of requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ridemart.operators.scoring import score


def score_stream(requests: DataFrame, model: PipelineModel, target: str, checkpoint: str) -> DataFrame:
    """Score every available request once into a table split by ``accepted``."""
    scored = score(requests, model)
    query = (
        scored.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy("accepted")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return requests.sparkSession.read.schema(scored.schema).parquet(target)
