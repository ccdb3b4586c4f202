"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.roles import Roles


def nan_to_null(df: DataFrame) -> DataFrame:
    """Fractions that are no number become null, so that missing means one thing."""
    fractions = [name for name, kind in df.dtypes if kind in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in fractions}) if fractions else df


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table with NaN read as null."""
    return nan_to_null(spark.read.parquet(f"{folder}/{name}.parquet"))


def customer_schema(roles: Roles) -> T.StructType:
    """Explicit schema of the customer file; the total stays text until cleaned."""
    fields = [T.StructField(roles.key, T.StringType())]
    for c in roles.valid_values:
        numbers = all(isinstance(v, int) for v in roles.valid_values[c])
        fields.append(T.StructField(c, T.IntegerType() if numbers else T.StringType()))
    fields += [
        T.StructField(roles.tenure, T.IntegerType()),
        T.StructField(roles.monthly, T.DoubleType()),
        T.StructField(roles.total, T.StringType()),
        T.StructField(roles.target, T.StringType()),
    ]
    return T.StructType(fields)


def read_customers(spark: SparkSession, path: str, roles: Roles) -> DataFrame:
    """Customer CSV, matched by header name, without a schema-inference pass."""
    schema = customer_schema(roles)
    header = spark.read.option("header", True).csv(path).columns
    kinds = {f.name: f.dataType for f in schema.fields}
    ordered = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header])
    return nan_to_null(
        spark.read.schema(ordered)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_features(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_report(df: DataFrame, path: str, kind: str = "json") -> None:
    """Long-format report table (IV rank, drift, metrics) as json, csv or parquet."""
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)
