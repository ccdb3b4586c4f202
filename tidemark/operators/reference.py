"""A stored reference for drift: new batches are compared with it without reading the reference table again.

The store holds, for each numeric column, its distinct values with counts and running counts, dealt into slabs by range, and
one row per slab; for each other column its categories with counts; and the equal-width bins of the numeric columns. A batch
is reduced to its own distinct values, which name the slabs they lie in. The largest gap between two cumulative shares lies at
a value of the batch or just before one, so slabs without a value of the batch are not read: their counts are in the slab
table. Stores merge: distinct values of further rows are added and the bins counted anew from values, not from rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.ledger import running_sums
from tidemark.functions.shape import long_numeric, long_text
from tidemark.functions.stage import staged
from tidemark.operators.drift import _p_value, _report, label_numeric, psi_from_labels, reference_spans
from tidemark.roles import PSI_BINS

#: Distinct values of a slab.
SLAB = 100_000


def _grouped(rows: DataFrame, columns: Sequence[str], numeric: bool, name: str) -> DataFrame:
    """(feature, value, <name>): distinct values with their counts."""
    make = long_numeric if numeric else long_text
    return make(rows, columns).where("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias(name))


@dataclass(frozen=True)
class StoredReference:
    """Tables below ``path``: ``values``, ``slabs``, ``bins``, ``spans`` and ``categories``."""

    spark: SparkSession
    path: str

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def columns(self) -> tuple[list[str], list[str]]:
        """(numeric, categorical) columns that have values."""
        names = lambda table: sorted(r.feature for r in self._read(table).select("feature").distinct().collect())
        return names("spans"), names("categories")

    def report(self, current: DataFrame, exact: bool = False) -> DataFrame:
        """The drift report of a batch against the stored reference; columns that the batch lacks are left out."""
        numeric, categorical = ([c for c in names if c in current.columns] for names in self.columns())
        if not numeric and not categorical:
            raise ValueError("the batch has no column of the reference")
        parts = []
        if numeric:
            values = staged(_grouped(current, numeric, True, "n_cur"), "batch")
            parts.append(self._numeric_psi(values).join(self._numeric_ks(values, exact), "feature").withColumn("kind", F.lit("numeric")))
        if categorical:
            values = staged(_grouped(current, categorical, False, "n_cur"), "batch")
            zero = F.lit(0).cast("long")
            both = self._read("categories").withColumn("n_cur", zero).unionByName(values.withColumn("n_ref", zero))
            both = both.where(F.col("feature").isin(categorical)).groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
            ledger = staged(running_sums(both, ["value"], ["n_ref", "n_cur"], ["feature"]), "cells")
            psi = psi_from_labels(ledger.withColumn("label", F.col("value")))
            parts.append(psi.join(self._gaps(ledger, exact), "feature").withColumn("kind", F.lit("categorical")))
        return _report(parts)

    def _numeric_psi(self, values: DataFrame) -> DataFrame:
        zero = F.lit(0).cast("long")
        labelled = label_numeric(values, self._read("spans")).select("feature", "label", zero.alias("n_ref"), "n_cur")
        return psi_from_labels(self._read("bins").withColumn("n_cur", zero).unionByName(labelled).join(F.broadcast(values.select("feature").distinct()), "feature", "left_semi"))

    def _numeric_ks(self, values: DataFrame, exact: bool) -> DataFrame:
        """Gaps at the batch's values and just before them, from the slabs they lie in."""
        slabs = self._read("slabs")
        # a value lies in the last slab that begins at or before it; one below all lies in the first
        bounds = slabs.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("first", "slab"))).alias("bounds"))
        begun = F.filter("bounds", lambda b: b["first"] <= F.col("value"))
        place = F.when(F.size(begun) > 0, F.element_at(begun, -1)["slab"]).otherwise(F.element_at("bounds", 1)["slab"])
        # a slab holds SLAB values, so the bounds of a column are few
        placed = staged(values.join(F.broadcast(bounds), "feature").select("feature", place.alias("slab"), "value", "n_cur"), "placed")
        touched = placed.groupBy("feature", "slab").agg(F.sum("n_cur").alias("cur"))
        before = Window.partitionBy("feature").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
        whole = Window.partitionBy("feature")
        touched = staged(
            touched.join(slabs.select("feature", "slab", "below", "tot_n_ref"), ["feature", "slab"]).select(
                "feature", "slab", "below", "tot_n_ref", F.coalesce(F.sum("cur").over(before), F.lit(0)).alias("below_cur"), F.sum("cur").over(whole).alias("tot_n_cur")
            ),
            "touched",
        )
        zero = F.lit(0).cast("long")
        kept = self._read("values").select("feature", "slab", "value", "n_ref").join(touched.select("feature", "slab"), ["feature", "slab"], "left_semi")
        both = kept.withColumn("n_cur", zero).unionByName(placed.withColumn("n_ref", zero)).groupBy("feature", "slab", "value").agg(F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
        upto = Window.partitionBy("feature", "slab").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = both.join(touched, ["feature", "slab"]).select(
            "feature", "n_ref", "n_cur", "tot_n_ref", "tot_n_cur", (F.col("below") + F.sum("n_ref").over(upto)).alias("cum_n_ref"), (F.col("below_cur") + F.sum("n_cur").over(upto)).alias("cum_n_cur")
        )
        return self._gaps(sums.where("n_cur > 0"), exact)

    @staticmethod
    def _gaps(rows: DataFrame, exact: bool) -> DataFrame:
        """(feature, ks, ks_pvalue) from running counts at values and, less their own counts, just before them."""
        share = lambda side, less: F.try_divide((F.col(f"cum_{side}") - less).cast("double"), F.col(f"tot_{side}"))
        after = F.abs(share("n_ref", F.lit(0)) - share("n_cur", F.lit(0)))
        ahead = F.abs(share("n_ref", F.col("n_ref")) - share("n_cur", F.col("n_cur")))
        table = rows.groupBy("feature").agg(F.max(F.greatest(after, ahead)).alias("ks"), F.max("tot_n_ref").alias("_n"), F.max("tot_n_cur").alias("_m"))
        return table.where("_n > 0 AND _m > 0").select("feature", "ks", _p_value(F.col("ks"), F.col("_n"), F.col("_m"), exact).alias("ks_pvalue"))

    def merged(self, more: DataFrame, path: str) -> StoredReference:
        """A new store below ``path`` of this reference and further rows; neither old rows nor old files are needed after it."""
        numeric, categorical = self.columns()
        values = self._read("values").select("feature", "value", "n_ref").unionByName(_grouped(more, numeric, True, "n_ref")) if numeric else None
        texts = self._read("categories").unionByName(_grouped(more, categorical, False, "n_ref")) if categorical else None
        add = lambda table: table and table.groupBy("feature", "value").agg(F.sum("n_ref").alias("n_ref"))
        return _write(self.spark, add(values), add(texts), path)


def store_reference(reference: DataFrame, numeric: Sequence[str], categorical: Sequence[str], path: str) -> StoredReference:
    """Write the store of a reference table; its columns are read once per kind."""
    values = _grouped(reference, numeric, True, "n_ref") if numeric else None
    texts = _grouped(reference, categorical, False, "n_ref") if categorical else None
    return _write(reference.sparkSession, values, texts, path)


def _write(spark: SparkSession, values: DataFrame | None, texts: DataFrame | None, path: str) -> StoredReference:
    values = values if values is not None else spark.createDataFrame([], "feature string, value double, n_ref long")
    texts = texts if texts is not None else spark.createDataFrame([], "feature string, value string, n_ref long")
    once = staged(values, "values")
    # whole slabs of a column: its values in order, so many to a slab
    placed = running_sums(once.withColumn("one", F.lit(1).cast("long")), ["value"], ["n_ref", "one"], ["feature"])
    slab = ((F.col("cum_one") - 1) / SLAB).cast("int").alias("slab")
    ledger = placed.select("feature", "value", "n_ref", slab, "cum_n_ref", "tot_n_ref")
    ledger.repartition("feature", "slab").sortWithinPartitions("feature", "slab", "value").write.parquet(f"{path}/values")
    kept = spark.read.parquet(f"{path}/values")
    slabs = kept.groupBy("feature", "slab").agg(F.min("value").alias("first"), F.min(F.col("cum_n_ref") - F.col("n_ref")).alias("below"), F.max("tot_n_ref").alias("tot_n_ref"))
    slabs.write.parquet(f"{path}/slabs")
    reference_spans(kept).write.parquet(f"{path}/spans")
    bins = label_numeric(kept, spark.read.parquet(f"{path}/spans"), PSI_BINS)
    bins.groupBy("feature", "label").agg(F.sum("n_ref").alias("n_ref")).write.parquet(f"{path}/bins")
    texts.write.parquet(f"{path}/categories")
    return StoredReference(spark, path)
