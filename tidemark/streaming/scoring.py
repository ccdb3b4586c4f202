"""Scoring of a stream with a fitted model: the batch transform, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.evaluate import risk_bands
from tidemark.operators.train import ChurnModel


def score_stream(stream: DataFrame, model: ChurnModel) -> DataFrame:
    """(key, p, prediction, risk, confidence) of each arriving row."""
    return risk_bands(model.score(stream), "p", model.threshold)


def band_stream(stream: DataFrame, p: Column, threshold: float = 0.5) -> DataFrame:
    """Label, risk band and confidence of each arriving row by a score that is an expression of its columns."""
    return risk_bands(stream.withColumn("p", p), "p", threshold)


def start_scoring(stream: DataFrame, model: ChurnModel, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append rows scored by a model to parquet."""
    return start_writing(score_stream(stream, model), out, checkpoint, **trigger)


def start_writing(scored: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append scored rows to parquet."""
    writer = scored.writeStream.format("parquet").outputMode("append")
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.option("path", out).option("checkpointLocation", checkpoint).start()
