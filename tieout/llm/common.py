"""What the training-data operators share: tables, stored intermediates, whole texts in batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tieout.durable import scratch

#: Characters of text that one block of a task holds at a time, unless one text is longer.
BLOCK_CHARS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read from there: lineage ends here."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def blocks(texts: list, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of at most `limit` characters together, or of one longer text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        n = 0 if text is None else len(text)
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def map_batches(frame: DataFrame, function, schema: str, *args) -> DataFrame:
    """`function(pandas frame, *args)` gives the pandas frame of one batch of rows."""
    return frame.mapInPandas(partial(_each, function, args), schema)


def _each(function, args, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield function(batch, *args)


def slices(raw: bytes, size: int = 1_000_000) -> Iterator[bytes]:
    """The bytes in parts of some `size` that end before a space, however long one word is."""
    start = 0
    while len(raw) - start > size:
        cut = raw.find(b" ", start + size)
        if cut < 0:
            break
        yield raw[start:cut]
        start = cut
    yield raw[start:]
