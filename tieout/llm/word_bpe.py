"""Encoding and decoding with a word BPE vocabulary, by a pair occurrence index.

The different words of a partition that are not known yet lie in one line of symbols. An index
maps each pair of neighbours to all its positions. The active ranks are applied in ascending order:
all positions of a pair are merged at once, and the lists of the pairs around them are updated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import blocks

#: Words whose encoding a task remembers at a time.
REMEMBERED = 600_000
#: Characters of the texts whose words enter one index.
CHARS_AT_ONCE = 12_000_000
#: Words whose ids are written out at a time, unless one text has more.
WORDS_AT_ONCE = 100_000

# Up to U+00FF, all but numbers that are no digits, and information separators.
_NOT_PLAIN = "\x1c\x1d\x1e\x1f²³¹¼½¾"
# More characters that the plain pattern splits exactly as the vocabulary's own pattern does; no
# combining marks, so that texts of these are in normal form.
_PLAIN = re.compile("[\t-\r -~\xa0-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f\u2010-\u2027\u20ac]*")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class Ranges:
    """Rows of different lengths in one line of values."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray) -> None:
        self.values, self.sizes = values, sizes
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, rows: list[bytes]) -> Ranges:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return cls(np.frombuffer(b"".join(rows), np.uint8), sizes)

    def take(self, rows: np.ndarray) -> Ranges:
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[rows] - ends + sizes, sizes)
        return Ranges(self.values[shift + np.arange(len(shift))], sizes)

    def add(self, more: Ranges) -> Ranges:
        return Ranges(
            np.concatenate([self.values, more.values]), np.concatenate([self.sizes, more.sizes])
        )


class _Numbers(dict):
    """Words by number, in the order in which they were met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _plain(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _PLAIN.fullmatch(text) is not None
    return not any(c in text for c in _NOT_PLAIN)


class Vocabulary:
    """The merges and symbols of a tokenizer file of the libraries' JSON layout."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        model = held["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        tokens = {i: t for t, i in (*self.ids.items(), *self.special.items())}
        size = max(tokens) + 1
        # Each token as the decoder shows it, and a space after it.
        self.shown = Ranges.of([(tokens.get(i, "") + " ").encode() for i in range(size)])
        self.decimal = Ranges.of([f"{i} ".encode() for i in range(size)])
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        pairs = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in model["merges"]]
        left, right, merged = np.array(pairs, np.int64).T
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order
        self.merged = merged
        self.pairs = np.stack([left, right], axis=1)
        # Bytes are written as printable characters: the printable ones as themselves, the
        # others, in order, as the characters from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names, more = {b: chr(b) for b in shown}, 256
        for b in range(256):
            if b not in names:
                names[b] = chr(more)
                more += 1
        self.byte = np.array([self.ids[names[b]] for b in range(256)])
        self.last_byte = np.array([self.ids[names[b] + self.end] for b in range(256)])
        whole = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = whole.normalizer, whole.pre_tokenizer

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, lower-cased."""
        if _plain(text):
            return _WORDS.findall(text.lower())
        # Rare characters: the library's own tables decide.
        text = self.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text)]

    def pieces(self, text: str | None) -> list[str]:
        """Words and special tokens of a whole text, in order."""
        if not text:
            return []
        if "<" not in text:
            return self.words(text)
        out = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(part)
            elif part:
                out.extend(self.words(part))
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; -1 where the vocabulary does not merge it."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], -1)

    def encode(self, words: list[str]) -> Ranges:
        """Ids of each word."""
        if not words:
            return Ranges(np.zeros(0, np.int32), np.zeros(0, np.int64))
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        line = np.frombuffer(b"".join(raw), np.uint8)
        symbol = self.byte[line]
        ends = np.cumsum(sizes) - 1
        symbol[ends] = self.last_byte[line[ends]]
        n = len(symbol)
        # Neighbours to both sides; -1 at a word's edges. A merged symbol lives at its left end.
        after = np.arange(1, n + 1)
        after[ends] = -1
        before = np.arange(-1, n - 1)
        before[ends - sizes + 1] = -1
        waiting: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def index(at: np.ndarray) -> None:
            """Add the pairs that start at these positions to the lists of their ranks."""
            at = at[after[at] >= 0]
            rank = self.ranks(symbol[at], symbol[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            low = np.flatnonzero(np.diff(rank, prepend=-1))
            stops = [*low[1:].tolist(), len(at)]
            for r, a, b in zip(rank[low].tolist(), low.tolist(), stops, strict=False):
                listed = waiting.get(r)
                if listed is None:
                    waiting[r] = [at[a:b]]
                    heapq.heappush(active, r)
                else:
                    listed.append(at[a:b])

        index(np.arange(n))
        while active:
            r = heapq.heappop(active)
            at = np.sort(np.concatenate(waiting.pop(r)))
            at = at[np.diff(at, prepend=-1) > 0]
            left, right = self.pairs[r]
            # Positions that other merges have changed since they were listed fall away.
            at = at[(symbol[at] == left) & (after[at] >= 0)]
            at = at[symbol[after[at]] == right]
            if left == right:
                at = _apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            symbol[at] = self.merged[r]
            symbol[gone] = -1
            after[at] = after[gone]
            right_of = after[at]
            inside = right_of >= 0
            before[right_of[inside]] = at[inside]
            left_of = before[at]
            index(np.concatenate([at, left_of[left_of >= 0]]))
        live = symbol >= 0
        counts = np.add.reduceat(live.astype(np.int64), ends - sizes + 1)
        return Ranges(symbol[live].astype(np.int32), counts)


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs of equal symbols, those that do not overlap, from the left."""
    out, used = [], -1
    for i in at.tolist():
        if i != used:
            out.append(i)
            used = after[i]
    return np.array(out, np.int64)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Coder:
    """The encoded words of one partition."""

    def __init__(self, path: str) -> None:
        self.vocabulary = vocabulary(path)
        self.clear()

    def clear(self) -> None:
        special = self.vocabulary.special
        self.numbers = _Numbers({t: k for k, t in enumerate(special)})
        ids = np.array([*special.values()], np.int32)
        self.ids = Ranges(ids, np.ones(len(ids), np.int64))

    def code(self, texts: list) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
        """(ids, ids in decimal joined by spaces, decoded text) of each text."""
        for low, high in blocks(texts, CHARS_AT_ONCE):
            if len(self.numbers) > REMEMBERED:
                self.clear()
            lines, number = [], self.numbers.__getitem__
            for text in texts[low:high]:
                words = self.vocabulary.pieces(text)
                lines.append(np.fromiter(map(number, words), np.int32, len(words)))
            new = [*islice(self.numbers, len(self.ids.sizes), None)]
            self.ids = self.ids.add(self.vocabulary.encode(new))
            for first, last in blocks(lines, WORDS_AT_ONCE):
                yield from self._coded(lines[first:last])

    def _coded(self, lines: list[np.ndarray]) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
        words = self.ids.take(np.concatenate(lines))
        tokens = np.concatenate([[0], np.cumsum(words.sizes)])
        stops = tokens[np.cumsum([0, *map(len, lines)])]
        texts = []
        for table in (self.vocabulary.decimal, self.vocabulary.shown):
            # Without a decoder of its own, the file's tokens are joined by spaces.
            shown = table.take(words.values)
            at = np.concatenate([[0], np.cumsum(shown.sizes)])[stops].tolist()
            line = shown.values.tobytes()
            texts.append([line[a : max(a, b - 1)] for a, b in zip(at, at[1:], strict=False)])
        ids = np.split(words.values, stops[1:-1])
        return zip(ids, *texts, strict=True)


def _sha256(text: bytes) -> str:
    return hashlib.sha256(text).hexdigest()


def encode(documents: DataFrame, path: str, text_column: str = "text") -> DataFrame:
    """`documents` with `ids` array<int> and `decoded`, under the rules of `digests`."""

    def coded(batches):
        coder = Coder(path)
        for texts in batches:
            found = [(ids, shown.decode()) for ids, _, shown in coder.code(list(texts))]
            yield pd.DataFrame(found, columns=["ids", "decoded"])

    found = _iterator(coded, "ids array<int>, decoded string")(F.col(text_column))
    coded_rows = documents.select(F.struct("*").alias("row"), found.alias("c"))
    return coded_rows.select("row.*", "c.*")


def digests(
    documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Whole texts; null counts as empty, which has no tokens. Repeated rows give repeated results,
    other columns are not read, and an empty table gives an empty table.
    """
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def coded(batches):
        coder = Coder(path)
        for texts in batches:
            yield pd.DataFrame(
                [
                    (len(ids), _sha256(decimal), _sha256(shown))
                    for ids, decimal, shown in coder.code(list(texts))
                ],
                columns=["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    found = _iterator(coded, schema)(F.col(text_column))
    return documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"), found.alias("c")
    ).select("doc_id", "c.*")


def _iterator(function, schema):
    function.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(function, schema)
