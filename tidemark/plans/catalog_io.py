"""Readers, sinks, saved models and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.shape import rounded
from tidemark.functions.stage import new_path, staged
from tidemark.operators import clean, drift
from tidemark.operators import train as tr
from tidemark.plans.catalog_drift import WINDOWED, event_sides
from tidemark.plans.churn import score_batch
from tidemark.plans.registry import Registry
from tidemark.plans.sqltext import C360, big, r, with_
from tidemark.roles import ORDERS360 as R
from tidemark.sources.customer360 import customer360
from tidemark.sources.tables import read_customers, write_features, write_report
from tidemark.streaming.drift import last_open, start_drift
from tidemark.streaming.scoring import band_stream, start_scoring, start_writing

REGISTRY = Registry()
query = REGISTRY.query

_MONTHS = 60.0


@query("csv_roundtrip", with_(C360) + f"""SELECT CAST(customer_key AS VARCHAR) AS customer_key, {big('tenure')} AS tenure,
{r('monthly')} AS monthly, {r('total')} AS total, contract, payment, {big('senior')} AS senior FROM c360""")
def csv_roundtrip(spark, sf):
    """Customers written as csv and read back by header name with the explicit schema."""
    path = new_path(spark, "csv")
    customer360(spark, sf).select(R.key, "contract", "payment", "senior", "tenure", "monthly", "total", "target").write.option(
        "header", True
    ).csv(path)
    back = clean.fix_total(read_customers(spark, path, R), R)
    return rounded(back.select(R.key, "tenure", "monthly", "total", "contract", "payment", "senior"))


@query("feature_sink", with_(C360) + f"SELECT contract, count(*) AS n, {r('sum(monthly)', 2)} AS monthly FROM c360 GROUP BY 1")
def feature_sink(spark, sf):
    """The feature table partitioned by contract, read back."""
    path = new_path(spark, "features")
    write_features(customer360(spark, sf), path, ["contract"])
    back = spark.read.parquet(path).groupBy("contract").agg(F.count("*").alias("n"), F.round(F.sum("monthly"), 2).alias("monthly"))
    return rounded(back)


@query("report_sink", with_(C360) + " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, payment, count(*) AS n, {r('avg(target)')} AS rate FROM c360 GROUP BY payment" for kind in ("json", "csv", "parquet")))
def report_sink(spark, sf):
    """A report written in each format, read back."""
    report = staged(rounded(customer360(spark, sf).groupBy("payment").agg(F.count("*").alias("n"), F.avg("target").alias("rate"))), "report")
    out = None
    for kind in ("json", "csv", "parquet"):
        path = new_path(spark, "report")
        write_report(report, path, kind)
        reader = spark.read.schema(report.schema).option("header", True)
        back = reader.format(kind).load(path).select(F.lit(kind).alias("kind"), "payment", "n", "rate")
        out = back if out is None else out.unionByName(back)
    return out


@query("model_roundtrip", with_(C360) + "SELECT customer_key, 0e0 AS gap, true AS same_label FROM c360")
def model_roundtrip(spark, sf):
    """A saved model, loaded again, scores every customer alike."""
    base = staged(customer360(spark, sf), "c360")
    spec = tr.ModelSpec("logistic_regression", {"max_iter": 20}, scaler="standard")
    model = tr.fit_model(base, R, spec, skip=["total_text"])
    model.threshold = 0.4
    path = new_path(spark, "model")
    model.save(path)
    again = tr.ChurnModel.load(path).score(base).select(R.key, F.col("p").alias("q"), F.col("prediction").alias("label"))
    both = model.score(base).join(again, R.key)
    return rounded(both.select(R.key, F.abs(F.col("p") - F.col("q")).alias("gap"), (F.col("prediction") == F.col("label")).alias("same_label")))


@query("validate_target", with_(C360) + "SELECT true AS valid, true AS refused, count(*) AS n FROM c360")
def validate_target(spark, sf):
    """A target of 0 and 1 passes; any other value is refused."""
    base = staged(customer360(spark, sf).select("target"), "c360")
    valid = clean.validate_target(base, "target")
    try:
        refused = not clean.validate_target(base.withColumn("target", F.col("target") + 1), "target")
    except ValueError:
        refused = True
    return base.agg(F.lit(valid).alias("valid"), F.lit(refused).alias("refused"), F.count("*").alias("n"))


@query("assemble_columns", with_(C360) + """, names AS (SELECT DISTINCT contract FROM c360 WHERE contract IS NOT NULL)
SELECT 0::BIGINT AS slot, 'num__tenure' AS name UNION ALL SELECT row_number() OVER (ORDER BY contract), 'cat__contract_' || contract
FROM names UNION ALL SELECT (SELECT count(*) FROM names) + 1, 'recency'""".lstrip())
def assemble_columns(spark, sf):
    """Slots of the assembled vector: scaled numbers, one slot per category, columns passed through."""
    base = staged(customer360(spark, sf), "c360")
    prepared = tr.fit_preprocessor(base, ["tenure"], ["contract"], passthrough=["recency"]).transform(base)
    return spark.createDataFrame(list(enumerate(tr.feature_names(prepared))), "slot long, name string")


@query("stream_score", with_(C360) + f"""SELECT customer_key, {r(f'round(tenure / {_MONTHS}, 4)')} AS p,
CASE WHEN tenure / {_MONTHS} >= 0.5 THEN 1 ELSE 0 END::BIGINT AS prediction, CASE WHEN tenure / {_MONTHS} >= 0.7 THEN 'HIGH'
WHEN tenure / {_MONTHS} >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk FROM c360""")
def stream_score(spark, sf):
    """Customers that arrive as a stream, banded by a rule and appended to parquet."""
    source, out = new_path(spark, "arriving"), new_path(spark, "scored")
    customer360(spark, sf).select(R.key, "tenure").write.parquet(source)
    stream = spark.readStream.schema(f"{R.key} long, tenure int").parquet(source)
    scored = band_stream(stream, F.col("tenure") / _MONTHS).select(R.key, "p", "prediction", "risk")
    start_writing(scored, out, new_path(spark, "checkpoint"), availableNow=True).awaitTermination()
    return rounded(spark.read.schema(scored.schema).parquet(out))


@query("stream_model", with_(C360) + "SELECT customer_key, 0e0 AS gap, true AS same_band FROM c360")
def stream_model(spark, sf):
    """Customers that arrive as a stream are scored by a fitted model, to the scores of the batch job."""
    source, out = new_path(spark, "arriving"), new_path(spark, "scored")
    rows = staged(customer360(spark, sf), "c360")
    model = tr.fit_model(rows, R, tr.ModelSpec("boosted", {"n_estimators": 20, "max_depth": 4}), skip=["total_text"])
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    start_scoring(stream, model, out, new_path(spark, "checkpoint"), availableNow=True).awaitTermination()
    batch = score_batch(rows, model).select(R.key, F.col("p").alias("batch_p"), F.col("risk").alias("batch_risk"))
    arrived = spark.read.parquet(out).join(batch, R.key, "full")
    gap = F.coalesce(F.abs(F.col("p") - F.col("batch_p")), F.lit(1.0))
    return rounded(arrived.select(R.key, gap.alias("gap"), F.col("risk").eqNullSafe(F.col("batch_risk")).alias("same_band")))


@query("stream_drift", WINDOWED)
def stream_drift(spark, sf):
    """Windows closed by their timers, and those still open at the end as they stood."""
    reference, current = event_sides(spark, sf)
    spans, profile = drift.reference_profile(reference, ["value"], ["event_type"])
    source, out, held, checkpoint = (new_path(spark, n) for n in ("events", "drift", "open", "checkpoint"))
    rows = current.withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    into = lambda path: lambda batch, number: batch.write.mode("append").parquet(path)
    query = start_drift(stream, spans, profile, "ts", ["value"], ["event_type"], into(out), checkpoint, open_sink=into(held), availableNow=True)
    query.awaitTermination()
    schema = "window_start timestamp, feature string, psi double, severity string"
    closed, provisional = spark.read.schema(schema).parquet(out), spark.read.schema(f"{schema}, batch long").parquet(held)
    found = closed.unionByName(last_open(provisional, closed))
    return rounded(found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd")))
