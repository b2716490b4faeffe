"""Quality classifier: logistic regression over hashed word n-grams.

Words are runs of word characters or of punctuation, with marks for line ends and for the shape of
a word. Unigrams and bigrams are hashed to a fixed number of weights, trained with
follow-the-regularised-leader updates, one example at a time; a text's score is the logistic of
the sparse dot product of its n-gram counts and the weights.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import map_batches

BITS = 18
#: Labelled rows that are trained on at most, chosen by a hash of doc_id: the bound of the sample.
SAMPLE_ROWS = 6_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1

_WORD = re.compile(r"\w+|[^\w\s]+|\n")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Distinct words whose hashes a task remembers at a time.
_REMEMBERED = 300_000
#: n-grams of one text that are held at a time.
_WORDS_AT_ONCE = 1 << 18


class _Hashes(dict):
    """Hash of a word, lower-cased; capitals throughout are a different word."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        text = word.lower()
        seed = 1 if len(word) > 1 and word.isupper() else 0
        value = self[word] = xxhash.xxh64_intdigest(text.encode(), seed)
        return value

    def __reduce__(self):
        return _Hashes, ()


_HASHES = _Hashes()


def ngrams(text: str | None, bits: int = BITS):
    """Weight numbers of all uni- and bigrams of a whole text, repeats included, in parts."""
    shift = np.uint64(64 - bits)
    words = _WORD.findall(text or "")
    for at in range(0, len(words), _WORDS_AT_ONCE):
        # One word more, so that no bigram is lost between two parts.
        part = words[at : at + _WORDS_AT_ONCE + 1]
        h = np.fromiter(map(_HASHES.__getitem__, part), "u8", len(part))
        pairs = (h[:-1] * _MIX) ^ (h[1:] + (h[:-1] << np.uint64(7)))
        ones = h[:_WORDS_AT_ONCE]
        both = np.concatenate([ones * _MIX, pairs * _MIX])
        yield (both >> shift).astype(np.int64)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, text: str | None) -> float:
        dot, n = 0.0, 0
        for numbers in ngrams(text, self.bits):
            dot += float(self.weights[numbers].sum(dtype=np.float64))
            n += len(numbers)
        z = self.bias + (dot / np.sqrt(n) if n else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def fit(texts, labels, bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """Follow the regularised leader over the examples in the order given."""
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last weight is the bias

    def weight(at):
        pull = np.abs(z[at]) - L1
        strength = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(pull > 0, -np.sign(z[at]) * pull / strength, 0.0)

    examples = []
    for text in texts:
        parts = [np.unique(p, return_counts=True) for p in ngrams(text, bits)]
        if parts:
            all_at = np.concatenate([p[0] for p in parts])
            at, place = np.unique(all_at, return_inverse=True)
            count = np.bincount(place, np.concatenate([p[1] for p in parts]))
        else:
            at, count = np.zeros(0, np.int64), np.zeros(0)
        value = count / np.sqrt(max(1.0, count.sum()))
        examples.append((np.append(at, size), np.append(value, 1.0)))
    for _ in range(epochs):
        for (at, value), label in zip(examples, labels, strict=True):
            w = weight(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -500, 500)))
            g = (p - label) * value
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weight(np.arange(size + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]), bits)


def _fit_rows(bits: int, epochs: int, batches):
    """The sample, which one task holds: it is bounded, and each update needs the one before."""
    rows = pd.concat([*batches, pd.DataFrame({"place": [], "text": [], "label": []})])
    rows = rows.sort_values(["place", "text"])
    if rows["label"].nunique() < 2:
        # Without both labels the share of good rows is all that can be learnt.
        share = rows["label"].mean() if len(rows) else 0.5
        yield pd.DataFrame({"at": [-1], "weight": [20.0 * share - 10.0 if len(rows) else 0.0]})
        return
    model = fit(rows["text"], rows["label"].to_numpy(), bits, epochs)
    at = np.flatnonzero(model.weights)
    yield pd.DataFrame(
        {"at": np.append(at, -1), "weight": np.append(model.weights[at], model.bias)}
    )


def examples(
    documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(place, text, label) of at most `sample_rows` labelled ids, one row of each.

    Of an id's rows the text with the least hash is taken, so that copies weigh no more than one.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    place = F.xxhash64("doc_id")
    # Ids first: of all labelled rows that are documents, only the chosen need their texts.
    chosen = (
        known.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
        .withColumn("place", place)
        .orderBy("place", "doc_id")
        .limit(sample_rows)
    )
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(chosen), "doc_id"
    )
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    one = texts.groupBy("doc_id", "place", "label").agg(least)
    return one.select("place", "least.text", "label")


def train(
    documents: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    bits: int = BITS,
    epochs: int = EPOCHS,
) -> Model:
    """The model of `documents` (doc_id, text) whose `labels` (doc_id, quality) is 0 or 1.

    Rows with a null doc_id or another label teach nothing; an id labelled both 0 and 1 counts as 1;
    null texts count as empty. At most
    `sample_rows` labelled ids, chosen by a hash of doc_id, are learnt, one row of each, and at
    most 2 ** bits weights reach the driver. All tasks look for the sample; one receives it.
    """
    rows = examples(documents, labels, sample_rows).repartition(1)
    found = rows.mapInPandas(partial(_fit_rows, bits, epochs), "at int, weight double").toPandas()
    weights, bias = np.zeros(1 << bits, np.float32), 0.0
    for at, w in found.itertuples(index=False):
        if at < 0:
            bias = float(w)
        else:
            weights[at] = w
    return Model(weights, bias, bits)


def score(
    documents: DataFrame,
    model: Model,
    text_column: str = "text",
    score_column: str = "score",
) -> DataFrame:
    """`documents` with a score from 0 to 1; higher means that label 1 is likelier.

    Every whole text is read, and nothing else. Null and empty texts get the score of the bias.
    Rows, also repeated ones, and all other columns are kept; an empty table gives an empty table.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series([model.score(t) for t in texts], dtype="f8")

    return documents.withColumn(score_column, scored(F.col(text_column)))
