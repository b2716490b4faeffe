"""A given table as a stream of its files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tieout.sources.tables import given


def given_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = given(spark, folder, name).schema
    # A pattern, because a stream takes a folder or a pattern, not the path of one file.
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")
