"""Drift of a stream against a fixed reference, window by window.

A stateful processor keeps, for each window, one count per column and bin or category. After every batch it hands on the
counts of the windows that the batch touched, as they stand (open); an event-time timer at a window's end hands on its final
counts and drops the state (closed). So the drift of a window is known while it fills, and no window is lost when a stream
stops before the watermark has passed it: its last open counts are its counts.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.window import Window

from tidemark.operators.drift import window_labels, windowed_psi

# tasks get these functions by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The state store that stateful processors need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_COUNTS = "window_start timestamp, feature string, label string, n long, closed boolean"


class WindowCounts(StatefulProcessor):
    """Counts per (feature, label) of one window; a missing label is kept as the empty text, others behind a mark."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "feature string, label string", "n long")

    def _rows(self, start, closed: bool) -> pd.DataFrame:
        rows = [(start, k[0], k[1][1:] if k[1] else None, int(v[0]), closed) for k, v in self.counts.iterator()]
        return pd.DataFrame(rows, columns=["window_start", "feature", "label", "n", "closed"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows))
        if not self.counts.exists():
            self.handle.registerTimer(int(batch["window_ms"].iloc[0]))
        label = batch["label"].map(lambda v: "" if pd.isna(v) else f"={v}")
        for (feature, text), n in batch["n"].groupby([batch["feature"], label]).sum().items():
            held = self.counts.getValue((feature, text)) if self.counts.containsKey((feature, text)) else None
            self.counts.updateValue((feature, text), (int(n) + (int(held[0]) if held else 0),))
        yield self._rows(key[0], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._rows(key[0], True)
        self.counts.clear()

    def close(self) -> None:
        pass


def window_counts(
    stream: DataFrame,
    spans: DataFrame,
    time: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    width: str = "1 day",
    late: str = "1 hour",
) -> DataFrame:
    """(window_start, feature, label, n, closed) of the windows of a stream, open ones after every batch that touches them.

    Rows later than ``late`` are left out.
    """
    tagged = stream.withWatermark(time, late).withColumn("_w", F.window(time, width))
    labels = window_labels(tagged.withColumn("_t", F.struct(F.col("_w").alias("w"), F.col(time).alias("t"))), spans, numeric, categorical, "_t")
    rows = labels.select(
        F.col("_t.w.start").alias("window_start"), (F.unix_millis(F.col("_t.w.end"))).alias("window_ms"), F.col("_t.t").alias("_time"), "feature", "label", F.lit(1).cast("long").alias("n")
    )
    return rows.groupBy("window_start").transformWithStateInPandas(WindowCounts(), _COUNTS, "Update", "eventTime")


def last_open(provisional: DataFrame, closed: DataFrame) -> DataFrame:
    """(window_start, feature, psi, severity) of the windows that were open when a stream ended.

    ``provisional`` is what was handed to the open sink, with the number of the batch; the newest batch of a window counts.
    """
    newest = Window.partitionBy("window_start")
    left = provisional.join(closed.select("window_start").distinct(), "window_start", "left_anti")
    return left.withColumn("_last", F.max("batch").over(newest)).where("batch = _last").select("window_start", "feature", "psi", "severity")


def start_drift(
    stream: DataFrame,
    spans: DataFrame,
    profile: DataFrame,
    time: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    width: str = "1 day",
    late: str = "1 hour",
    open_sink: Callable[[DataFrame, int], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Hand (window_start, feature, psi, severity) of closed windows to ``sink``, and of open ones, with ``batch``, to ``open_sink``."""

    def compare(batch: DataFrame, number: int) -> None:
        counts = batch.select("window_start", "feature", "label", "n", "closed").persist()
        done = counts.where("closed").drop("closed")
        sink(windowed_psi(done, profile, "window_start"), number)
        if open_sink:
            still = counts.where("NOT closed").drop("closed").join(done.select("window_start").distinct(), "window_start", "left_anti")
            open_sink(windowed_psi(still, profile, "window_start").withColumn("batch", F.lit(number).cast("long")), number)
        counts.unpersist()

    counts = window_counts(stream, spans, time, numeric, categorical, width, late)
    writer = counts.writeStream.outputMode("update").foreachBatch(compare).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, STORE)  # a query keeps the settings it was started with
    try:
        return writer.start()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
