import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift
from tidemark.operators import train as tr
from tidemark.plans import churn
from tidemark.roles import ORDERS360 as R
from tidemark.sources.customer360 import customer360
from tidemark.streaming.drift import last_open, start_drift
from tidemark.streaming.scoring import start_scoring

SF = "/root/testdata/sf0.001"


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    rows = customer360(spark, SF)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    rows = spark.read.parquet(str(tmp_path / "in"))
    model = tr.fit_model(rows, R, tr.ModelSpec("logistic_regression", {"max_iter": 5}), skip=["total_text"])
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = start_scoring(stream, model, str(tmp_path / "out"), str(tmp_path / "ck"), availableNow=True)
    assert query.awaitTermination(240)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want = sorted(map(tuple, churn.score_batch(rows, model).collect()))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b) if not isinstance(a[3], str) else a[0] == b[0] and a[3] == b[3]


def test_stream_drift_equals_batch_drift(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), "value", "event_type"
    )
    edge = F.lit("2024-01-08").cast("timestamp")
    reference, current = events.where(F.col("ts") < edge), events.where(F.col("ts") >= edge)
    spans, profile = drift.reference_profile(reference, ["value"], ["event_type"])
    source = str(tmp_path / "in")
    current.coalesce(1).sortWithinPartitions("ts").write.option("maxRecordsPerFile", 150).parquet(source)
    stream = spark.readStream.schema(current.schema).option("maxFilesPerTrigger", 1).parquet(source)

    def into(name):
        return lambda batch, number: batch.write.mode("append").parquet(str(tmp_path / name))

    query = start_drift(
        stream, spans, profile, "ts", ["value"], ["event_type"], into("out"), str(tmp_path / "ck"), open_sink=into("open"), availableNow=True
    )
    assert query.awaitTermination(240)
    got = {(r.window_start, r.feature): r.psi for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    want = {
        (r.window_start, r.feature): r.psi
        for r in drift.drift_by_window(reference, current, "ts", ["value"], ["event_type"]).collect()
    }
    # windows the watermark has passed are final; the newest ones are known as they stood
    closed, provisional = (spark.read.parquet(str(tmp_path / name)) for name in ("out", "open"))
    still_open = {(r.window_start, r.feature): r.psi for r in last_open(provisional, closed).collect()}
    assert got and still_open and not set(got) & set(still_open)
    assert set(got) | set(still_open) == set(want)
    for key, psi in (got | still_open).items():
        assert psi == pytest.approx(want[key])
