"""Language identification by prediction by partial matching.

One variable-order byte context tree per language, read as one tree of contexts with counts per
language. A byte that a context has not seen escapes to the next shorter context, without the
bytes already ruled out. Statistics are frozen after training, so the exact code length of a byte
depends on the context and the byte alone and is worked out once for every node of the tree; a
text costs the sum of its bytes' lengths, and the language that codes it shortest is predicted.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import blocks, map_batches, stored

MAX_ORDER = 3
#: Training texts per language: the bound of the sample.
SAMPLE_TEXTS = 1_500
#: Contexts that are kept, an equal share for each language, its most frequent first; a context's
#: prefixes and suffixes come before it.
MAX_CONTEXTS = 20_000
#: One of so many sampled texts is not counted but tells what texts of its language cost.
HELD_OUT = 5
#: A text is foreign if it costs this many times what its language's own texts do per byte, and that
#: by this many times their spread, which counts for a text of one byte and shrinks with its root.
FOREIGN_TIMES = 1.75
FOREIGN_SPREADS = 8.0
UNDETERMINED = "und"
_BYTES = 256
#: Characters whose bytes are counted at a time; each takes some 60 bytes of memory.
_COUNTED_CHARS = 1_000_000


@dataclass
class Model:
    """Counts per language of each context (bytes, oldest first) and next byte."""

    languages: list[str]
    #: Contexts by length, then bytes; the first is empty.
    contexts: list[bytes]
    #: Rows (context number, next byte, language number, count).
    counts: np.ndarray
    max_order: int = MAX_ORDER
    #: Per language, what its held-out texts cost: bits per byte, and their spread at one byte.
    usual: tuple[tuple[float, float], ...] = ()
    _tables: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_tables": None}

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """symbol of byte; next node [node, symbol]; bits [node * symbols + symbol, language].

        Symbol 0 ends a text, symbol 1 stands for all bytes that were never seen.
        """
        if self._tables is None:
            self._tables = self._build()
        return self._tables

    def _build(self):
        seen = np.unique(self.counts[:, 1])
        symbol = np.ones(_BYTES, np.uint8 if len(seen) < 254 else np.uint16)
        symbol[seen] = np.arange(len(seen)) + 2
        nodes, width = len(self.contexts), len(seen) + 2
        number = {c: i for i, c in enumerate(self.contexts)}
        suffix = np.zeros(nodes, np.int32)
        step = np.zeros((nodes, width), np.int32)
        for i, context in enumerate(self.contexts):
            if context:
                # The suffix was kept too, as it is at least as frequent.
                suffix[i] = number[context[1:]]
        for i, context in enumerate(self.contexts):  # shorter ones first
            if i:
                step[i] = step[suffix[i]]
            for b in seen.tolist():
                longer = number.get(context + bytes([b]))
                if longer is not None:
                    step[i, symbol[b]] = longer
        bits = np.empty((nodes, width, len(self.languages)), np.float32)
        lengths = np.array([len(c) for c in self.contexts])
        for lang in range(len(self.languages)):
            rows = self.counts[self.counts[:, 2] == lang]
            n = np.zeros((nodes, width))
            n[rows[:, 0], symbol[rows[:, 1]]] = rows[:, 3]
            bits[:, :, lang] = _code_lengths(n, suffix, lengths, len(seen))
        return symbol, step, bits.reshape(nodes * width, -1)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language."""
        symbol, step, bits = self.tables()
        width = step.shape[1]
        out = np.zeros((len(texts), len(self.languages)))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        line = symbol[np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)]
        ends = np.cumsum(sizes + 1) - 1
        line[ends] = 0
        # The longest kept context among the last bytes before each position; a text's end
        # leads back to the root.
        flat, order = step.ravel(), self.max_order
        padded = np.concatenate([np.zeros(order, line.dtype), line])
        for at in range(0, len(line), _POSITIONS):
            upto = min(len(line), at + _POSITIONS)
            node = np.zeros(upto - at, np.int64)
            for back in range(order, 0, -1):
                node = flat[node * width + padded[at + order - back : upto + order - back]]
            cost = bits[node.astype(np.int64) * width + line[at:upto]].astype(np.float64)
            first, last = np.searchsorted(ends, [at, upto - 1])
            starts = np.maximum(ends[first : last + 1] - sizes[first : last + 1], at) - at
            # A text whose only byte left here is its end costs nothing: ends cost zero.
            out[first : last + 1] += np.add.reduceat(cost, starts, axis=0)
        return out


    def foreign(self, lang: np.ndarray, bits: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Which texts cost too much even under the language that codes them shortest."""
        size = np.maximum(np.fromiter(map(len, texts), float, len(texts)), 1.0)
        rate, spread = np.array(self.usual).reshape(-1, 2)[lang].T
        limit = np.maximum(FOREIGN_TIMES * rate, rate + FOREIGN_SPREADS * spread / np.sqrt(size))
        return bits / size > limit


#: Bytes that are scored at a time.
_POSITIONS = 1 << 18


def _code_lengths(n, suffix, lengths, alphabet) -> np.ndarray:
    """-log2 of each symbol's probability after each context, escapes with exclusion."""
    seen = n > 0
    bits = np.zeros_like(n)
    # Below the empty context every byte that it has not seen is as likely as the others.
    total, kinds = n[0].sum(), seen[0].sum()
    order0 = np.zeros(n.shape[1])
    escape = kinds / (total + kinds) if kinds else 1.0
    never = escape / max(1, _BYTES - kinds)
    order0[:] = -np.log2(never)
    if kinds:
        order0[seen[0]] = -np.log2(n[0][seen[0]] / (total + kinds))
    order0[0] = 0.0
    bits[0] = order0
    for size in range(1, int(lengths.max()) + 1):
        at = np.flatnonzero(lengths == size)
        bits[at] = _with_escape(n, seen, bits, at, suffix, suffix[at])
    return bits


def _with_escape(n, seen, bits, at, suffix, shorter):
    """Code lengths of contexts whose suffixes are done.

    What a context has seen, its suffix has seen too. Ruling it out there divides the suffix's
    probabilities of all other symbols by what is left of its mass.
    """
    own, total, kinds = n[at], n[at].sum(axis=1), seen[at].sum(axis=1)
    below = bits[shorter]
    mass = np.where(seen[at], np.exp2(-below), 0.0).sum(axis=1)
    left = np.maximum(1.0 - mass, 1e-12)
    empty = kinds == 0
    escape = np.where(empty, 1.0, kinds / np.maximum(total + kinds, 1))
    out = below + np.log2(np.where(empty, 1.0, left) / escape)[:, None]
    inside = np.where(own > 0, own, 1.0) / np.maximum(total + kinds, 1)[:, None]
    out = np.where(seen[at], -np.log2(inside), out)
    out[:, 0] = 0.0
    return out


def _count(max_order: int, languages: list[str], batch: pd.DataFrame) -> pd.DataFrame:
    """Sparse counts of (context and next byte, language) of one batch."""
    number = {x: i for i, x in enumerate(languages)}
    out = []
    for lang, texts in batch.groupby("lang")["text"]:
        for low, high in blocks(list(texts), _COUNTED_CHARS):
            grams: dict[int, list[np.ndarray]] = {k: [] for k in range(max_order + 1)}
            for text in texts.iloc[low:high]:
                line = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
                code = line
                for k in range(max_order + 1):
                    if k:
                        code = (code[:-1] << 8) | line[k:]
                    grams[k].append(code)
            for k, parts in grams.items():
                found, n = np.unique(np.concatenate(parts), return_counts=True)
                out.append(
                    pd.DataFrame({"size": k, "gram": found, "lang": number[lang], "n": n})
                )
    return pd.concat(out)


def train(
    documents: DataFrame,
    max_order: int = MAX_ORDER,
    sample_texts: int = SAMPLE_TEXTS,
    max_contexts: int = MAX_CONTEXTS,
) -> Model:
    """The model of `documents` (doc_id, text, lang).

    Rows without a doc_id, text or lang teach nothing. At most `sample_texts` ids per language,
    chosen by a hash of doc_id, are learnt, one whole text of each, the first in binary order, by all
    executors. The tree that reaches the driver has at most `max_contexts` contexts of at most 256
    next bytes. What is collected besides are the languages and a row per held-out text.
    """
    texts = sample(documents, sample_texts)
    languages = sorted(r[0] for r in texts.select("lang").distinct().collect())
    if not languages:
        return Model([], [b""], np.zeros((0, 4), np.int64), max_order)
    aside = F.pmod(F.xxhash64("doc_id", F.lit("aside")), F.lit(HELD_OUT)) == 0
    model = _learn(texts.where(~aside), languages, max_order, max_contexts)
    return replace(model, usual=_usual(texts.where(aside), model))


def sample(documents: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> DataFrame:
    """(doc_id, lang, text): at most `sample_texts` ids per language, one text of each.

    Ids far enough down in the order of their hashes are dropped where they stand, by how many
    ids their language has, so that what is ranked is a few times the bound and no more.
    """
    usable = documents.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    place = F.xxhash64("doc_id")
    # One number per language comes to the driver, so no row moves before most are dropped.
    many = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids")).collect()
    share = {r["lang"]: min(1.0, 2.0 * (sample_texts + 50) / r["ids"]) for r in many}
    upto = F.create_map(*(F.lit(x) for pair in share.items() for x in pair)) if share else None
    low = F.lit(False)
    if upto is not None:
        low = place.cast("double") + F.lit(2.0**63) <= upto[F.col("lang")] * F.lit(2.0**64)
    few = usable.select("doc_id", "lang").where(low)
    drawn = Window.partitionBy("lang").orderBy(place, "doc_id")
    chosen = (
        few.distinct()
        .withColumn("place", F.row_number().over(drawn))
        .where(F.col("place") <= sample_texts)
        .select("doc_id", "lang")
    )
    found = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    return stored(found.groupBy("doc_id", "lang").agg(F.min("text").alias("text")), "taught")


def _usual(texts: DataFrame, model: Model) -> tuple[tuple[float, float], ...]:
    """What the held-out texts of each language cost under it; the bound of the sample holds."""
    number = {x: i for i, x in enumerate(model.languages)}

    def costs(batch: pd.DataFrame) -> pd.DataFrame:
        raw = [t.encode() for t in batch["text"]]
        bits = np.concatenate(
            [model.code_lengths(raw[a:b]) for a, b in blocks(raw)]
        )
        lang = batch["lang"].map(number).to_numpy("i8")
        size = np.fromiter(map(len, raw), float, len(raw))
        return pd.DataFrame({"lang": lang, "bits": bits[np.arange(len(raw)), lang], "size": size})

    found = map_batches(texts, costs, "lang bigint, bits double, size double").toPandas()
    out = []
    for i in range(len(model.languages)):
        own = found[(found["lang"] == i) & (found["size"] > 0)]
        if len(own) < 2:
            out.append((np.inf, 0.0))  # too little to tell foreign texts by
            continue
        rate = float((own["bits"] / own["size"]).median())
        away = (own["bits"] / own["size"] - rate) * np.sqrt(own["size"])
        out.append((rate, 1.4826 * float(away.abs().median())))
    return tuple(out)


def _learn(texts: DataFrame, languages: list[str], max_order: int, max_contexts: int) -> Model:
    counts = map_batches(
        texts.select("text", "lang"), partial(_count, max_order, languages),
        "size int, gram bigint, lang int, n bigint",
    )
    counts = counts.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("context", F.shiftright("gram", 8))
    # Each language chooses as many, so that one with few texts keeps its contexts too.
    own = Window.partitionBy("lang").orderBy(F.desc("total"), "size", "context")
    often = (
        counts.groupBy("lang", "size", "context")
        .agg(F.sum("n").alias("total"))
        .withColumn("place", F.row_number().over(own))
        .where(F.col("place") <= max(1, max_contexts // len(languages)))
        .select("size", "context")
        .distinct()
    )
    kept = counts.join(F.broadcast(often), ["size", "context"], "left_semi")
    rows = kept.select("size", "context", F.col("gram").bitwiseAND(F.lit(255)).alias("byte"), "lang", "n")
    found = rows.toPandas()
    names = [
        int(c).to_bytes(int(s), "big")
        for s, c in found[["size", "context"]].drop_duplicates().itertuples(index=False)
    ]
    contexts = _closed(set(names) | {b""})
    number = {c: i for i, c in enumerate(contexts)}
    at = [
        number.get(int(c).to_bytes(int(s), "big"), -1)
        for s, c in zip(found["size"], found["context"], strict=True)
    ]
    table = np.column_stack([at, found["byte"], found["lang"], found["n"]]).astype(np.int64)
    return Model(languages, contexts, table[table[:, 0] >= 0], max_order)


def _closed(names: set[bytes]) -> list[bytes]:
    """Contexts whose prefixes and suffixes are all there; ties at the bound may break a few."""
    kept: set[bytes] = set()
    for name in sorted(names, key=lambda c: (len(c), c)):
        if not name or (name[1:] in kept and name[:-1] in kept):
            kept.add(name)
    return sorted(kept, key=lambda c: (len(c), c))


def _predict(model: Model, texts: pd.Series) -> pd.DataFrame:
    names = np.array([*model.languages, UNDETERMINED], object)
    pred = np.full(len(texts), len(model.languages))
    score = np.zeros(len(texts))
    foreign = np.zeros(len(texts), bool)
    raw = [(t or "") for t in texts]
    for low, high in blocks(raw):
        if not model.languages:
            break
        coded = [t.encode() for t in raw[low:high]]
        bits = model.code_lengths(coded)
        best = bits.min(axis=1, keepdims=True)
        # Chance of the best language if all were equally likely before the text.
        score[low:high] = 1.0 / np.exp2(np.maximum(best - bits, -1000)).sum(axis=1)
        pred[low:high] = bits.argmin(axis=1)
        if model.usual:
            foreign[low:high] = model.foreign(bits.argmin(axis=1), best[:, 0], coded)
    return pd.DataFrame({"lang_pred": names[pred], "score": score, "foreign": foreign})


def predict(
    documents: DataFrame,
    model: Model,
    text_column: str = "text",
    pred_column: str = "lang_pred",
    score_column: str = "score",
    foreign_column: str | None = None,
) -> DataFrame:
    """`documents` with the predicted language and its chance from 0 to 1.

    The chance compares the learnt languages with each other. `foreign_column`, if named, tells
    which texts fit none of them: those that cost much more per byte than the held-out texts of
    their best language do. A language with fewer than two held-out texts calls nothing foreign.

    Every whole text is read, and nothing else. A null text, an empty one, one without any letter,
    and every text under a model without languages give `und` with score 0. Of languages that
    code a text equally short the alphabetically first is predicted. Rows, also repeated ones, and
    all other columns are kept; an empty table gives an empty table.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, foreign boolean")
    def found(texts: pd.Series) -> pd.DataFrame:
        return _predict(shared.value, texts)

    letters = F.coalesce(F.col(text_column).rlike(r"\p{L}"), F.lit(False))
    judged = documents.withColumn("_language", found(F.col(text_column)))
    added = {
        pred_column: F.when(letters, F.col("_language.lang_pred")).otherwise(UNDETERMINED),
        score_column: F.when(letters, F.col("_language.score")).otherwise(0.0),
    }
    if foreign_column is not None:
        added[foreign_column] = letters & F.col("_language.foreign")
    return judged.withColumns(added).drop("_language")
