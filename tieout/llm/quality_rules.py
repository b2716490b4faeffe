"""Quality rules as a short-circuit cascade.

A sample tells what each rule costs and what it rejects. Rules are put in order of rejections per
second, step by step: after each choice only the documents that it leaves count, and measures that
are already worked out cost nothing more. A document leaves the cascade at the first rule that
rejects it, and later rules never look at it. A document stays only if no rule rejects it, so the
order decides the cost and never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import blocks, map_batches, slices

#: Rows that the sample has on average; it settles only the order of the rules.
SAMPLE_ROWS = 2000
#: Words of a window whose second occurrence in a text counts as repetition.
WINDOW = 5
SEPARATORS = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_ONE_SPACE = bytes.maketrans(SEPARATORS.encode(), b" " * len(SEPARATORS))


class Texts:
    """Some whole texts, and what has been worked out about them so far."""

    def __init__(self, texts: list) -> None:
        self.texts = ["" if t is None else t for t in texts]
        self.known: dict[str, np.ndarray] = {}
        self.vocabulary: dict[bytes, int] = {}

    def of(self, name: str, rows: np.ndarray) -> np.ndarray:
        """The measure of these rows; once worked out, it is asked only for some of the same."""
        if name not in self.known:
            needs, function = MEASURES[name]
            for other in needs:
                self.of(other, rows)
            found = np.zeros(len(self.texts), object if name in PREPARED else np.int64)
            for i, value in zip(rows, function(self, rows), strict=True):
                found[i] = value
            self.known[name] = found
        return self.known[name][rows]

    def words(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of the words of each text; equal words have equal numbers."""
        seen = self.vocabulary
        for i in rows:
            raw = self.texts[i].encode().translate(_ONE_SPACE)
            yield np.concatenate(
                [
                    np.fromiter((seen.setdefault(w, len(seen)) for w in part.split()), np.int64)
                    for part in slices(raw)
                ]
            )

    def lines(self, rows: np.ndarray) -> Iterator[list[str]]:
        """Lines with a word."""
        for i in rows:
            yield [x for x in self.texts[i].split("\n") if x.strip(SEPARATORS)]

    def word_chars(self, rows: np.ndarray) -> Iterator[int]:
        for i in rows:
            yield len(self.texts[i]) - sum(map(self.texts[i].count, SEPARATORS))

    def symbols(self, rows: np.ndarray) -> Iterator[int]:
        for i in rows:
            raw = self.texts[i].encode()
            yield len(raw) - len(raw.translate(None, SYMBOLS))

    def lettered(self, rows: np.ndarray) -> Iterator[int]:
        has = [any(map(str.isalpha, w.decode())) for w in self.vocabulary]
        has = np.array(has, bool)
        for ids in self.of("words", rows):
            yield has[ids].sum()

    def repeated(self, rows: np.ndarray) -> np.ndarray:
        """Words in windows that their text holds twice or more, the first occurrence included."""
        words = list(self.of("words", rows))
        sizes = np.array([len(w) for w in words], np.int64)
        line = np.concatenate([*words, np.zeros(0, np.int64)])
        text = np.repeat(np.arange(len(words)), sizes)
        n = len(line) - WINDOW + 1
        if n <= 0:
            return np.zeros(len(words), np.int64)
        place = np.arange(len(line)) - (np.cumsum(sizes) - sizes)[text]
        whole = np.flatnonzero(place[:n] + WINDOW <= sizes[text[:n]])
        # Numbers of runs of 1, 2, 3 ... words: exact, as each is numbered from two smaller ones.
        run = line
        for more in range(1, WINDOW):
            run = _numbered(run[: len(line) - more], line[more:])
        window = _numbered(run[whole], text[whole])
        again = np.bincount(window, minlength=1)[window] > 1
        edge = np.zeros(len(line) + 1, np.int64)
        np.add.at(edge, whole[again], 1)
        np.add.at(edge, whole[again] + WINDOW, -1)
        covered = np.cumsum(edge)[:-1] > 0
        return np.bincount(text[covered], minlength=len(words))


def _numbered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number per different pair."""
    return pd.factorize(a * (b.max(initial=0) + 1) + b)[0]


#: What only other measures read.
PREPARED = ("words", "lines")
#: Name to what it needs first, and how it is worked out.
MEASURES: dict[str, tuple[tuple[str, ...], Callable]] = {
    "words": ((), Texts.words),
    "lines": ((), Texts.lines),
    "n_words": (("words",), lambda t, rows: map(len, t.of("words", rows))),
    "word_chars": ((), Texts.word_chars),
    "n_symbols": ((), Texts.symbols),
    "n_repeat_words": (("words",), Texts.repeated),
    "n_lettered_words": (("words",), Texts.lettered),
    "n_lines": (("lines",), lambda t, rows: map(len, t.of("lines", rows))),
    "n_dup_lines": (
        ("lines",), lambda t, rows: (len(x) - len(set(x)) for x in t.of("lines", rows))
    ),
    "n_bullet_lines": (
        ("lines",),
        lambda t, rows: (
            sum(x.lstrip(SEPARATORS).startswith(("•", "-", "*")) for x in lines)
            for lines in t.of("lines", rows)
        ),
    ),
    "n_ellipsis_lines": (
        ("lines",),
        lambda t, rows: (
            sum(x.rstrip(SEPARATORS).endswith(("...", "…")) for x in lines)
            for lines in t.of("lines", rows)
        ),
    ),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a document by some of its measures: `rejects` gets one array for each."""

    name: str
    measures: tuple[str, ...]
    rejects: Callable[..., np.ndarray]


#: Published limits for web text; all are whole-number comparisons.
RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 10),
    Rule("repetition", ("n_words", "n_repeat_words"), lambda n, r: 100 * r > 20 * n),
    Rule("symbols", ("n_words", "n_symbols"), lambda n, s: 10 * s > n),
    Rule("word_length", ("n_words", "word_chars"), lambda n, c: (c < 3 * n) | (c > 10 * n)),
    Rule("letters", ("n_words", "n_lettered_words"), lambda n, k: 10 * k < 8 * n),
    Rule("same_lines", ("n_lines", "n_dup_lines"), lambda n, d: 10 * d > 3 * n),
    Rule("bullets", ("n_lines", "n_bullet_lines"), lambda n, b: 10 * b > 9 * n),
    Rule("ellipses", ("n_lines", "n_ellipsis_lines"), lambda n, e: 10 * e > 3 * n),
)


def _tried(batch: pd.DataFrame, rules: tuple[Rule, ...]) -> pd.DataFrame:
    """Seconds of each measure, and how many rows each combination of rules rejects."""
    seconds = dict.fromkeys(MEASURES, 0.0)
    masks = []
    texts = list(batch["text"])
    for low, high in blocks(texts):
        block = Texts(texts[low:high])
        rows = np.arange(high - low)
        for name in MEASURES:  # what a measure needs stands before it
            start = time.perf_counter()
            block.of(name, rows)
            seconds[name] += time.perf_counter() - start
        mask = np.zeros(high - low, np.int64)
        for k, rule in enumerate(rules):
            rejected = rule.rejects(*(block.of(m, rows) for m in rule.measures))
            mask |= rejected.astype(np.int64) << k
        masks.append(mask)
    found, counts = np.unique(np.concatenate(masks), return_counts=True)
    return pd.DataFrame(
        {
            "measure": [*seconds, *[None] * len(found)],
            "mask": [*[0] * len(seconds), *found],
            "amount": [*seconds.values(), *map(float, counts)],
        }
    )


def in_order(
    rules: tuple[Rule, ...],
    seconds: dict[str, float],
    rejected: dict[int, float],
    given: tuple[str, ...] = (),
) -> list[Rule]:
    """Rules by rejections per second among what the rules before leave.

    `seconds` of each measure over the sample; `rejected`: sampled rows by the set of rules, as
    bits in the order of `rules`, that reject them; `given`: measures worked out in any case.
    """
    done: set[str] = set()

    def needed(name: str) -> set[str]:
        return {name}.union(*map(needed, MEASURES[name][0]))

    for name in given:
        done |= needed(name)
    left, rows, order = list(range(len(rules))), dict(rejected), []
    while left:
        def worth(k):
            needs = set().union(*map(needed, rules[k].measures))
            cost = sum(seconds.get(m, 0.0) for m in needs - done) + 1e-9
            return -sum(n for mask, n in rows.items() if mask >> k & 1) / cost, cost, k

        best = min(left, key=worth)
        left.remove(best)
        order.append(rules[best])
        done = done.union(*map(needed, rules[best].measures))
        rows = {mask: n for mask, n in rows.items() if not mask >> best & 1}
    return order


def plan(
    documents: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    given: tuple[str, ...] = (),
    sample_rows: int = SAMPLE_ROWS,
    text_column: str = "text",
) -> list[Rule]:
    """The rules in the order that a sample of about `sample_rows` rows suggests.

    What comes to the driver is one sum per measure and one count per combination of rules that
    occurs in the sample. An empty table leaves the rules in order of their cost alone.
    """
    total = documents.count()
    texts = documents.select(F.col(text_column).alias("text"))
    sample = texts.sample(min(1.0, sample_rows / max(total, 1)), seed=11)
    tried = map_batches(sample, _tried, "measure string, mask bigint, amount double", rules)
    sums = tried.groupBy("measure", "mask").agg(F.sum("amount").alias("amount")).collect()
    seconds = {r["measure"]: r["amount"] for r in sums if r["measure"] is not None}
    rejected = {r["mask"]: r["amount"] for r in sums if r["measure"] is None}
    return in_order(rules, seconds, rejected, given)


def judged(texts: list, order: list[Rule], given: tuple[str, ...]) -> pd.DataFrame:
    """The given measures of all texts, and the name of the first rule that rejects each."""
    parts = []
    for low, high in blocks(texts):
        block = Texts(texts[low:high])
        rows = np.arange(high - low)
        part = pd.DataFrame({m: block.of(m, rows) for m in given}, index=rows)
        by = np.full(high - low, None, object)
        for rule in order:
            if not len(rows):
                break
            gone = rule.rejects(*(block.of(m, rows) for m in rule.measures))
            by[rows[gone]] = rule.name
            rows = rows[~gone]
        parts.append(part.assign(rejected_by=by))
    return pd.concat(parts, ignore_index=True)


def _judge(batch: pd.DataFrame, order: list[Rule], given: tuple[str, ...]) -> pd.DataFrame:
    found = judged(list(batch["text"]), order, given)
    kept = found["rejected_by"].isna().to_numpy()
    return found.assign(doc_id=batch["doc_id"].to_numpy(), kept=kept)


def cascade(
    documents: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    given: tuple[str, ...] = (),
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, the given measures, rejected_by, kept) of every document.

    `rejected_by` is the rule that stopped the document; where several would, the order that the
    sample gave decides which one is named, `kept` is the same in any order. A null text counts as
    empty. Each row is judged by itself: repeated rows and rows that share an id or have none
    stay rows of their own. Other columns are not read. An empty table gives an empty table.
    """
    order = plan(documents, rules, given, sample_rows, text_column)
    rows = documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text")
    )
    measures = "".join(f", {m} bigint" for m in given)
    schema = f"doc_id bigint{measures}, rejected_by string, kept boolean"
    # Ids may be null, which a pandas column of whole numbers cannot hold.
    typed = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = map_batches(typed, _judge, schema.replace("doc_id bigint", "doc_id string"), order, given)
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))
