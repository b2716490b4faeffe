"""SimHash near-duplicates, found by multi-index hashing.

Fingerprints are cut into segments. Two that differ in few bits agree closely in at least one
segment, so each enumerates a small Hamming ball around its value in a segment, fetches the
fingerprints that hold one of these values there, and the complete distance is verified.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import stored
from tieout.llm.components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEGMENTS = 2
SEED = 42
BITS = 64
#: Shingle hashes of one text that are held at a time.
HASHES_AT_ONCE = 65_536


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one whole text as an unsigned number; zero without words."""
    # bytes.lower changes A-Z alone, and bytes.split cuts at 0x20 and 0x09-0x0D alone.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    size = min(shingle_words, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    digest, total, counts = xxhash.xxh64_intdigest, len(starts), np.zeros(BITS, np.int64)
    for at in range(0, total, HASHES_AT_ONCE):
        pairs = zip(starts[at : at + HASHES_AT_ONCE], ends[at : at + HASHES_AT_ONCE], strict=True)
        hashes = np.array([digest(line[s:e], SEED) for s, e in pairs], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    ones = np.packbits(counts * 2 > total, bitorder="little")
    return int(ones.view("<u8")[0])


def _balls(bits: int, segments: int, max_distance: int) -> list[tuple[int, int, list[int]]]:
    """(first bit, width, masks) of each segment: its share of the distance, by the pigeonhole.

    With distance = segments * q + rest, either one of the first rest + 1 segments differs in at
    most q bits, or one of the others in at most q - 1.
    """
    share, rest = divmod(max_distance, segments)
    edges = [bits * i // segments for i in range(segments + 1)]
    found = []
    for i, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
        radius = share if i <= rest else share - 1
        masks = [
            sum(1 << b for b in chosen)
            for r in range(radius + 1)
            for chosen in combinations(range(high - low), r)
        ]
        if masks:
            found.append((low, high - low, masks))
    return found


def links(
    fingerprints: DataFrame, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS
) -> DataFrame:
    """Pairs (a, b), a < b, of different values of `fp` that differ in at most `max_distance` bits.

    `fp` holds each fingerprint once. Candidates that fail the complete distance never leave
    the join; it is keyed by segment value, so adaptive execution can split a hot one.
    """
    keys, probes = [], []
    for i, (low, width, masks) in enumerate(_balls(BITS, segments, max_distance)):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        # Segments of under 60 bits leave room for their number in the key.
        tag = F.lit(i << 60 if width < 60 else 0)
        if width >= 60:
            value = F.shiftrightunsigned("fp", low)
        keys.append(value.bitwiseXOR(tag))
        probes.extend(value.bitwiseXOR(tag).bitwiseXOR(F.lit(m)) for m in masks)
    held = fingerprints.select(F.explode(F.array(*keys)).alias("key"), F.col("fp").alias("b"))
    asked = fingerprints.select(F.explode(F.array(*probes)).alias("key"), F.col("fp").alias("a"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    return (
        asked.join(held, "key").where((F.col("a") < F.col("b")) & close).select("a", "b")
    )


def grouped(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    id_column: str = "doc_id",
    text_column: str = "text",
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, *carried, fp, root, component_id) of every row; `root` is the group's own number.

    Groups that have no doc_id, or that share one, differ in `root` alone.
    """

    @F.pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        found = np.array([fingerprint(t, shingle_words) for t in texts], "u8")
        return pd.Series(found.view("i8"))

    rows = stored(
        documents.select(
            F.col(id_column).cast("bigint").alias("doc_id"),
            *carried,
            fp(F.col(text_column)).alias("fp"),
        ),
        "fingerprints",
    )
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    linked = components(links(firsts.select("fp"), max_distance)).select(
        F.col("node").alias("fp"), F.col("component").alias("root")
    )
    rooted = firsts.join(linked, "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp").select("doc_id", *carried, "fp", "root", "component_id")


def near_duplicates(
    documents: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows give
    repeated results. A null doc_id gets the component of its fingerprint and never names one;
    where every doc_id of a component is null, component_id is null. Other columns are not read.
    An empty table gives an empty table.
    """
    found = grouped(documents, shingle_words, max_distance, id_column, text_column)
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
