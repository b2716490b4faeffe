from __future__ import annotations

import pytest


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


DOCUMENTS = "doc_id bigint, text string, lang string, uid string, ord int"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a table with extra columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, "en", "x", 7) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS).coalesce(2)

    return make
