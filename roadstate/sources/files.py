"""File sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Records from files that each hold one JSON array; must not be empty."""
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    if df.isEmpty():
        raise ValueError(f"no records in {path}")
    return df
