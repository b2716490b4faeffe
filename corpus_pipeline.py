"""The corpus pipeline: stages over documents, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.llm import language_id, packing, quality, simhash, substring_dedup
from tieout.llm.common import stored, table
from tieout.llm.queries import BYTE_RANKS


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches.

    Null texts, texts without a letter, and texts whose best language is less likely than all
    others together go; so do texts in a language that nobody taught, and noise, which cost far
    more per byte than held-out texts of the language that codes them best. The model is learnt
    from the texts and languages of `docs`.
    """
    whole = docs.select(F.struct("*").alias("row"), "text")
    judged = language_id.predict(whole, language_id.train(docs), foreign_column="foreign")
    sure = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= 0.5)
    return judged.where(sure & ~F.col("foreign")).select("row.*")


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted label is 1. Learnt from the labels of those in `docs`."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    whole = docs.select(F.struct("*").alias("row"), "text")
    return quality.score(whole, model).where(F.col("score") >= 0.5).select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: one with the smallest id, of these the first.

    Rows without doc_id stay only if their whole group has none, and then one of them.
    """
    # Numbers that are written with the rows tell repeated rows and rows that share an id apart.
    numbered = stored(
        docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")),
        "numbered",
    )
    found = simhash.grouped(
        numbered.select("row.doc_id", "row.text", "number"), carried=("number",)
    )
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = first.groupBy("root").agg(F.min("number").alias("number")).select("number")
    return numbered.join(kept, "number", "left_semi").select("row.*")


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that start earlier in the corpus.

    A text that loses words becomes its kept words joined by one space, with n_chars to match;
    any other stays as it is.
    """
    own = [F.col(c).alias(f"_{c}") for c in docs.columns]
    found = substring_dedup.deduplicate(docs.select(*own), id_column="_doc_id", text_column="_text")
    less = F.col("n_removed") > 0
    changed = {
        "text": F.when(less, F.col("kept")).otherwise(F.col("_text")),
        "n_chars": F.when(less, F.length("kept").cast("bigint")).otherwise(F.col("_n_chars")),
    }
    return found.select(*(changed.get(c, F.col(f"_{c}")).alias(c) for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 1024 tokens."""
    return packing.pack(docs, BYTE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("quality_classifier", classify_quality),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", remove_repeats),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the classifiers, nor XXH64, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
