"""Importance resampling towards a target: hashed runs of words, counted, weighed, drawn.

Every run of 1 to 2 consecutive words of a text is a feature; its bucket is its CRC-32. The corpus
and the target count their buckets, a document's weight is the mean gain of its features, and
Gumbel noise turns the weights into a draw without replacement.

CRCs are worked out for the different features of a block at once. Features of one length stand in
a matrix of bytes, one per row, and all their CRCs advance together, one column at a time; the
results go back to where the features came from. Features of over `CHUNK` bytes are cut into rows
of `CHUNK` bytes, whose CRCs are joined, as a CRC is linear.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import blocks, map_batches, slices, stored

BUCKETS = 10_000
#: Bytes of a row of the matrices at most.
CHUNK = 256
SEED = 7
MIN_WORDS = 20
#: Documents that are drawn, of a hundred that have enough words.
PERCENT = 25

_POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


_TABLE = _byte_table()


def _advanced(state: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The states after all columns of a matrix of bytes, one column at a time."""
    for column in np.ascontiguousarray(rows.T):
        state = _TABLE[(state ^ column) & 0xFF] ^ (state >> 8)
    return state


def _past_a_chunk() -> np.ndarray:
    """What `CHUNK` zero bytes make of a state, as a table for each of its four bytes."""
    zeros = np.zeros((256, CHUNK), np.uint8)
    return np.stack(
        [_advanced(np.arange(256, dtype=np.uint32) << np.uint32(8 * k), zeros) for k in range(4)]
    )


_SHIFT = _past_a_chunk()


def crc32s(values: list[bytes]) -> np.ndarray:
    """The unsigned CRC-32 of each value."""
    out = np.zeros(len(values), np.uint32)
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for a, b in zip(edges, edges[1:], strict=False):
        at = order[a:b]
        length = int(lengths[at[0]])
        matrix = np.frombuffer(b"".join([values[i] for i in at]), np.uint8).reshape(b - a, length)
        state = np.full(b - a, 0xFFFFFFFF, np.uint32)
        chunks, rest = divmod(length, CHUNK)
        if chunks:
            # All chunks advance together from zero; then the state before each is carried over it.
            rows = np.ascontiguousarray(matrix[:, : chunks * CHUNK]).reshape(-1, CHUNK)
            own = _advanced(np.zeros(len(rows), np.uint32), rows).reshape(b - a, chunks)
            for k in range(chunks):
                shifted = _SHIFT[0][state & 0xFF]
                for byte in range(1, 4):
                    shifted = shifted ^ _SHIFT[byte][(state >> np.uint32(8 * byte)) & 0xFF]
                state = shifted ^ own[:, k]
        if rest:
            state = _advanced(state, matrix[:, chunks * CHUNK :])
        out[at] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _kept_bytes() -> bytes:
    """Digits, lower-case letters and bytes above 0x7F stay, A-Z are lowered, others are spaces."""
    return bytes(
        c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
        for c in range(256)
    )


_WORDS = _kept_bytes()


def features(texts: list, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature of some whole texts, and the words of each text."""
    seen: dict[bytes, int] = {}
    ids = []
    for text in texts:
        raw = (text or "").encode().translate(_WORDS)
        parts = [
            np.fromiter((seen.setdefault(w, len(seen)) for w in part.split()), np.int64)
            for part in slices(raw)
        ]
        ids.append(np.concatenate(parts))
    n_words = np.fromiter(map(len, ids), np.int64, len(ids))
    line = np.concatenate([*ids, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(texts)), n_words)
    vocabulary = list(seen)
    inside = np.flatnonzero(owner[:-1] == owner[1:])
    codes, pairs = pd.factorize(line[inside] * max(len(seen), 1) + line[inside + 1])
    first, second = np.divmod(pairs, max(len(seen), 1))
    joined = [
        vocabulary[a] + b" " + vocabulary[b]
        for a, b in zip(first.tolist(), second.tolist(), strict=True)
    ]
    bucket = crc32s(vocabulary + joined).astype(np.int64) % buckets
    single, double = bucket[: len(vocabulary)], bucket[len(vocabulary) :]
    return (
        np.concatenate([owner, owner[inside]]),
        np.concatenate([single[line], double[codes]]),
        n_words,
    )


def _counted(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """One row per bucket that a task meets."""
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        texts = list(batch["text"])
        for low, high in blocks(texts):
            total += np.bincount(features(texts[low:high], buckets)[1], minlength=buckets)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"bucket": at, "n": total[at]})


def bucket_counts(frame: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all texts. `buckets` numbers come to the driver."""
    texts = frame.select(F.col(text_column).alias("text"))
    parts = texts.mapInPandas(lambda b: _counted(b, buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds, in thousandths, rounded down."""
    buckets = len(corpus)
    s, t = int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets))))
            for a, b in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighed(texts: list, gain: np.ndarray) -> pd.DataFrame:
    """Words, features and floored mean gain of each text."""
    parts = []
    for low, high in blocks(texts):
        owner, bucket, n_words = features(texts[low:high], len(gain))
        n = np.bincount(owner, minlength=high - low)
        total = np.zeros(high - low, np.int64)
        np.add.at(total, owner, gain[bucket])
        weight = np.where(n > 0, total // np.maximum(n, 1), 0)
        parts.append(pd.DataFrame({"n_words": n_words, "n_features": n, "weight": weight}))
    return pd.concat(parts, ignore_index=True)


def _weigh(batch: pd.DataFrame, gain: np.ndarray) -> pd.DataFrame:
    return weighed(list(batch["text"]), gain).assign(doc_id=batch["doc_id"].to_numpy())


def noise(seed: int = SEED) -> Column:
    """Gumbel noise of doc_id, in thousandths, rounded down; an id's noise never changes."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    uniform = (h.cast("double") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("bigint")


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of a sorted partition with its number and their place in it, from 1."""
    part, done = TaskContext.get().partitionId(), 0
    for batch in batches:
        place = np.arange(done + 1, done + 1 + len(batch))
        done += len(batch)
        yield batch.assign(part=part, place=place)


def ranked(rows: DataFrame) -> DataFrame:
    """(row_id, rank) of rows (row_id, doc_id, score): 1, 2, 3 ... by falling score, then doc_id.

    Ids that are null come last among equal scores, and row_id settles what is left, so that no
    key is too large for a partition. Partitions of the order are written with the place of each
    row; what is collected is one count per partition.
    """
    spark = rows.sparkSession
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row_id")]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    placed = stored(
        runs.select("row_id").mapInPandas(_placed, "row_id bigint, part int, place bigint"), "order"
    )
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for part, n in sorted((r["part"], r["n"]) for r in sizes):
        offsets.append((part, before))
        before += n
    offset = spark.createDataFrame(offsets, "part int, before bigint")
    return placed.join(F.broadcast(offset), "part").select(
        "row_id", (F.col("before") + F.col("place")).alias("rank")
    )


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_column: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null if not drawn.

    Of the N documents with `min_words` words, floor(percent * N / 100) are drawn. All texts of
    both tables are counted. A null text has no words: no features, weight 0, never drawn unless
    `min_words` is 0. Repeated rows are documents of their own, which have one score and
    neighbouring ranks; a null id has the noise of an empty id and comes last among equal scores.
    An empty target makes every gain depend on the corpus alone; an empty table gives an empty
    table. Other columns are not read.
    """
    spark = documents.sparkSession
    gain = gains(
        bucket_counts(documents, text_column, buckets),
        bucket_counts(target, target_column, buckets),
    )
    rows = documents.select(
        F.col(id_column).cast("bigint").cast("string").alias("doc_id"),
        F.col(text_column).alias("text"),
    )
    found = map_batches(
        rows, _weigh, "doc_id string, n_words bigint, n_features bigint, weight bigint", gain
    ).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # Written, so that the numbers of rows are the same in both reads.
    scored = stored(
        found.select(
            F.monotonically_increasing_id().alias("row_id"), "*",
            (F.col("weight") + noise(seed)).alias("score"),
        ),
        "scored",
    )
    enough = scored.where(F.col("n_words") >= min_words)
    drawn = enough.count() * percent // 100
    rank = ranked(enough.select("row_id", "doc_id", "score")).where(F.col("rank") <= drawn)
    return scored.join(rank, "row_id", "left").select(
        "doc_id", "n_features", "weight", "score", "rank"
    )
