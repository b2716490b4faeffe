"""Reading inputs: given tables, partner files as text, and bronze with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tieout.operators.deliveries import parse_strict


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partner_file(spark: SparkSession, path: str, types: dict[str, str]) -> DataFrame:
    """A delimited partner file, read as text and typed strictly.

    Every line keeps its file name as `path`; a line that does not fit its type names the
    problem instead of becoming a guess.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in types])
    text = spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE", enforceSchema=False)
    return parse_strict(text.select("_metadata.file_path", *types), types)


def bronze(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A bronze table; its schema is declared and never merged from files."""
    return spark.read.schema(schema).option("mergeSchema", "false").parquet(path)
