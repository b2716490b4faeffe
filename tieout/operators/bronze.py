"""Landing: change envelopes to flat change rows, nothing dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNPARSED = "unparsed"
UNROUTED = "unrouted"


def envelope_schema(row: T.StructType) -> T.StructType:
    """The envelope around a captured row: its images before and after, and where it came from."""
    text = T.StringType()
    return (
        T.StructType()
        .add("before", row)
        .add("after", row)
        .add("op", text)
        .add("source", T.StructType().add("lsn", T.LongType()).add("table", text))
        .add("transaction", T.StructType().add("id", text))
    )


def land_flagged(raw: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """Parsed fields of every record; text that does not parse stays in `unparsed`."""
    flagged = T.StructType([*schema.fields, T.StructField(UNPARSED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNPARSED}
    kept = [c for c in raw.columns if c != text]
    return raw.select(*kept, F.from_json(text, flagged, options).alias("r")).select(*kept, "r.*")


def flatten_changes(
    envelopes: DataFrame, row: T.StructType, incarnation: int, text: str = "value"
) -> DataFrame:
    """One flat change row per envelope. A delete takes its key from the image before.

    The image is chosen as a whole: a NULL the source really wrote stays NULL.
    """
    landed = land_flagged(envelopes, envelope_schema(row), text)
    kept = [c for c in envelopes.columns if c != text]
    image = F.when(F.col("after").isNotNull(), F.col("after")).otherwise(F.col("before"))
    return landed.withColumn("image", image).select(
        *kept,
        *(F.col(f"image.{f.name}").alias(f.name) for f in row.fields),
        "op",
        F.col("source.table").alias("source_table"),
        F.lit(incarnation).cast("int").alias("source_incarnation"),
        F.col("source.lsn").alias("source_lsn"),
        F.col("transaction.id").alias("transaction_id"),
        UNPARSED,
    )


def route(changes: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Adds `routed_to`, the partition a change is written to, in one pass.

    A change whose table is missing or not captured goes to `unrouted`, where it can be looked at.
    """
    captured = F.when(F.col("source_table").isin(*tables), F.col("source_table"))
    return changes.withColumn("routed_to", F.coalesce(captured, F.lit(UNROUTED)))


def with_ingest_hour(changes: DataFrame) -> DataFrame:
    """Adds the partition column of bronze tables."""
    return changes.withColumn("ingest_hour", F.date_format("ingest_ts", "yyyy-MM-dd-HH"))
