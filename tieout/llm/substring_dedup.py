"""Removal of word passages that occur earlier in the corpus, by relative Lempel-Ziv parsing.

Each phrase of `window` words chooses an anchor, its least hash of `anchor` words, so equal phrases
choose equal anchors. Only phrases whose anchor occurs twice in the corpus are parsed. They travel
in pieces: all the words of neighbouring phrases that chose one anchor. A reference block holds the
pieces of some anchors, indexed by phrase, in the order of the corpus; whatever a piece could be
copied from is in the block that it is sent to, so this one block stands for all.

A piece is parsed from left to right. The phrase at hand is looked up; where it is known, the factor
is extended word by word along its reference as far as both agree, and the parse goes on with the
first phrase that the factor does not hold whole, which may begin within it: so phrases across the
boundary of two factors are looked up as well. Unknown phrases join the reference. Factors have at
least `window` words and become duplicate spans. Words are compared themselves; hashes only say
where to look.

Before each shuffle, what repeats within a task's block of texts is settled there, so that a phrase
in every document sends one piece per block.
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import blocks

WINDOW = 20
ANCHOR = 8
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_REMEMBERED = 400_000
#: Phrases of one anchor that a task indexes; those beyond meet by their own hash.
INDEXED = 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 7)
        return value

    def __reduce__(self):
        return _Hashes, ()


_HASHES = _Hashes()


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but 0x20 and 0x09-0x0D, which is where bytes.split cuts."""
    return (text or "").encode().split()


class Block:
    """Some whole texts as one line of words, and of word hashes."""

    def __init__(self, texts: list) -> None:
        words = [words_of(t) for t in texts]
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        self.line = line = [w for each in words for w in each]
        self.hashes = np.fromiter(map(_HASHES.__getitem__, line), "u8", len(line))
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        first = np.cumsum(self.sizes) - self.sizes
        self.place = np.arange(len(line)) - first[self.doc]

    def rolled(self, size: int, seed: int) -> np.ndarray:
        """A hash of each `size` consecutive words; shorter by size - 1."""
        a = np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
        level, done = _mix(self.hashes + np.uint64(seed), a), 1
        powers = {1: level}
        while done * 2 <= size:
            level = _mix(level[:-done] * a + level[done:], a)
            done *= 2
            powers[done] = level
        out, got = powers[done], done
        while got < size:
            part = 1 << ((size - got).bit_length() - 1)
            n = len(self.hashes) - got - part + 1
            out = _mix(out[: max(n, 0)] * a + powers[part][got:], a)
            got += part
        return out

    def whole(self, window: int) -> np.ndarray:
        """Which phrases lie within one text."""
        n = max(0, len(self.hashes) - window + 1)
        return self.place[:n] + window <= self.sizes[self.doc[:n]]

    def least(self, anchors: np.ndarray, window: int, anchor: int) -> np.ndarray:
        return _sliding(anchors, window - anchor + 1, np.minimum)

    def chosen(self, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions that some phrase chooses as its anchor, and the hashes there."""
        hashes = self.rolled(anchor, 1)
        span = window - anchor + 1
        if len(self.hashes) < window:
            return np.zeros(0, np.int64), np.zeros(0, "u8")
        least = np.where(self.whole(window), self.least(hashes, window, anchor), np.uint64(0))
        edge = np.zeros(span - 1, "u8")
        most = _sliding(np.concatenate([edge, least, edge]), span, np.maximum)
        at = np.flatnonzero((most == hashes) & (most > 0))
        return at, hashes[at]


def _mix(x: np.ndarray, a: np.uint64) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * (a | np.uint64(1))
    return x ^ (x >> np.uint64(29))


def _sliding(x: np.ndarray, span: int, pick) -> np.ndarray:
    """pick over each `span` consecutive values; shorter by span - 1."""
    done, level = 1, x
    while done * 2 <= span:
        level = pick(level[:-done], level[done:])
        done *= 2
    if done < span:
        level = pick(level[: len(x) - span + 1], level[span - done :])
    return level


_ANCHORS = "anchor bigint, uid bigint, place int, again boolean"


def _anchors(window: int, anchor: int, batches):
    """Anchors of each block. `again`: it occurs in its block more than once, which settles it;
    one row of it without a text then still tells the other blocks."""
    for batch in batches:
        uids, texts = batch["uid"].to_numpy(), list(batch["text"])
        for low, high in blocks(texts):
            block = Block(texts[low:high])
            at, hashes = block.chosen(window, anchor)
            _, back, n = np.unique(hashes, return_inverse=True, return_counts=True)
            again = n[back] > 1
            found = pd.DataFrame(
                {
                    "anchor": hashes.view("i8"), "uid": uids[low:high][block.doc[at]],
                    "place": block.place[at].astype("i4"), "again": again,
                }
            )
            tell = found[again].drop_duplicates("anchor").assign(uid=-1, place=-1, again=False)
            yield pd.concat([found, tell])


#: A piece with its words is still to be parsed; one without is a span of `size` words to remove.
_PIECES = "key bigint, ord bigint, uid bigint, start int, size int, words binary"


def _frame(rows) -> pd.DataFrame:
    types = {"key": "i8", "ord": "i8", "uid": "i8", "start": "i4", "size": "i4"}
    return pd.DataFrame(rows, columns=[*types, "words"]).astype(types)


def _spread(uids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A key that sends spans anywhere."""
    return _mix(uids.astype("u8") + starts.astype("u8"), np.uint64(0x9E3779B97F4A7C15)).view("i8")


def _equal(line: list[bytes], a: np.ndarray, b: np.ndarray, window: int) -> np.ndarray:
    """Whether the phrases at a and b have the same words."""
    number: dict[bytes, int] = {}
    numbers = np.fromiter((number.setdefault(w, len(number)) for w in line), "i4", len(line))
    same = np.ones(len(a), bool)
    for i in range(window):
        same &= numbers[a + i] == numbers[b + i]
    return same


def _runs(doc: np.ndarray, start: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of neighbouring phrases begin that agree in `more`, and how many each has."""
    opens = np.ones(len(doc), bool)
    opens[1:] = (np.diff(doc) != 0) | (np.diff(start) != 1)
    for x in more:
        opens[1:] |= np.diff(x) != 0
    head = np.flatnonzero(opens)
    return head, np.diff(np.append(head, len(doc)))


def _pieces(window: int, anchor: int, batches):
    """Phrases with a repeated anchor: pieces of those first in their block, spans of the others."""
    for batch in batches:
        texts, places = list(batch["text"]), list(batch["places"])
        orders, uids = batch["ord"].to_numpy(), batch["uid"].to_numpy()
        for low, high in blocks(texts):
            block = Block(texts[low:high])
            n = len(block.hashes) - window + 1
            if n <= 0:
                continue
            hashes = block.rolled(anchor, 1)
            first = np.cumsum(block.sizes) - block.sizes
            repeated = np.full(len(hashes), _TOP)
            for i, at in enumerate(places[low:high]):
                at = np.asarray(at, np.int64) + first[i]
                repeated[at] = hashes[at]
            least = block.least(hashes, window, anchor)
            asked = block.whole(window) & (block.least(repeated, window, anchor) == least)
            at = np.flatnonzero(asked)
            if not len(at):
                continue
            # The leftmost place of the anchor; equal phrases have it at equal places.
            chosen = np.zeros(len(at), np.int64)
            for i in range(window - anchor, -1, -1):
                here = hashes[at + i] == least[at]
                chosen[here] = at[here] + i
            h = block.rolled(window, 11)[at]
            doc, start = block.doc[at] + low, block.place[at]
            order = np.lexsort((start, uids[doc], orders[doc], h))
            again = np.flatnonzero(np.diff(h[order]) == 0) + 1
            known = _equal(block.line, at[order[again - 1]], at[order[again]], window)
            earlier = np.zeros(len(at), bool)
            earlier[order[again[known]]] = True

            at, chosen, doc_new, start_new = (x[~earlier] for x in (at, chosen, doc, start))
            head, run = _runs(doc_new, start_new, chosen)
            size = run + window - 1
            ends = at[head] + size
            yield _frame(
                {
                    "key": hashes[chosen[head]].view("i8"), "ord": orders[doc_new[head]],
                    "uid": uids[doc_new[head]], "start": start_new[head], "size": size,
                    "words": [
                        b" ".join(block.line[a:b])
                        for a, b in zip(at[head].tolist(), ends.tolist(), strict=True)
                    ],
                }
            )
            doc, start = doc[earlier], start[earlier]
            head, run = _runs(doc, start)
            yield _frame(
                {
                    "key": _spread(uids[doc[head]], start[head]), "ord": orders[doc[head]],
                    "uid": uids[doc[head]], "start": start[head], "size": run + window - 1,
                    "words": None,
                }
            )


class Reference:
    """Phrases of one block, each with the earliest piece that holds it and its place there."""

    def __init__(self, window: int, limit: int | None) -> None:
        self.window, self.limit = window, limit
        self.index: dict[bytes, tuple[list[bytes], int]] = {}

    def factors(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[int]]:
        """(start, words) of the factors of a piece, and the phrases that found no room."""
        window, index = self.window, self.index
        found, left = [], []
        at, size = 0, len(words)
        while at + window <= size:
            phrase = b" ".join(words[at : at + window])
            known = index.get(phrase)
            if known is None:
                if self.limit is None or len(index) < self.limit:
                    index[phrase] = (words, at)
                else:
                    left.append(at)
                at += 1
                continue
            reference, there = known
            n = window
            while (
                at + n < size and there + n < len(reference)
                and words[at + n] == reference[there + n]
            ):
                n += 1
            found.append((at, n))
            at += n - window + 1
        return found, left


def _parsed(window: int, limit: int | None, batches):
    """Factors of the pieces, which come key by key in the order of the corpus.

    Phrases beyond `limit` in the reference of one key are equal to none in it. They go on as pieces
    of their own, to meet by their own hash.
    """
    key, reference = None, Reference(window, limit)
    for batch in batches:
        out = []
        rows = zip(*(batch[c].tolist() for c in batch.columns), strict=True)
        for k, order, uid, start, size, raw in rows:
            if raw is None:
                out.append((uid, order, uid, start, size, None))
                continue
            if k != key:
                key, reference = k, Reference(window, limit)
            words = raw.split(b" ")
            found, left = reference.factors(words)
            out += [(uid, order, uid, start + at, n, None) for at, n in found]
            for at in left:
                phrase = b" ".join(words[at : at + window])
                own = xxhash.xxh64_intdigest(phrase, 3) - (1 << 63)
                out.append((own, order, uid, start + at, window, phrase))
        yield _frame(out)


def _covered(size: int, spans) -> np.ndarray | None:
    """Which words some span (start << 32 | words) covers."""
    if spans is None or not len(spans):
        return None
    spans = np.asarray(spans, np.int64)
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, spans >> 32, 1)
    np.add.at(edge, (spans >> 32) + (spans & 0xFFFFFFFF), -1)
    return np.cumsum(edge[:-1]) > 0


def _kept(text: str | None, spans) -> tuple[int, int, bytes]:
    words = words_of(text)
    gone = _covered(len(words), spans)
    if gone is None:
        return len(words), 0, b" ".join(words)
    stay = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
    return len(words), len(words) - len(stay), b" ".join(stay)


def _named(documents: DataFrame, text_column: str) -> dict[str, str]:
    """A plain name for each other column, so that none clashes with those used here."""
    return {c: f"c{i}" for i, c in enumerate(documents.columns) if c != text_column}


def factors(
    rows: DataFrame, texts: DataFrame, id_column: str, window: int, anchor: int
) -> DataFrame:
    """(uid, spans): each text's factors, as start << 32 | words.

    `rows` and `texts` are the same, `texts` spread by uid.
    """
    found = rows.select("uid", "text").mapInPandas(partial(_anchors, window, anchor), _ANCHORS)
    # What its block has settled needs no company: its own text and place are its key.
    key = F.when(F.col("again"), F.xxhash64("uid", "place")).otherwise(F.col("anchor"))
    alike = F.count(F.lit(1)).over(Window.partitionBy("again", "key"))
    met = found.withColumn("key", key).withColumn("n", alike)
    places = met.where(F.col("again") | ((F.col("n") > 1) & (F.col("uid") >= 0)))
    asked = places.groupBy("uid").agg(F.collect_list("place").alias("places"))
    # Rows without an id come after all others. All columns are used, here as by the caller, so
    # that both read one and the same shuffle of the texts.
    order = F.coalesce(F.col(id_column).cast("bigint"), F.lit((1 << 63) - 1))
    others = [c for c in texts.columns if c not in ("uid", "text")]
    pieces = (
        texts.join(asked, "uid")
        .select("uid", order.alias("ord"), "text", "places", F.hash(*others).alias("all"))
        .mapInPandas(partial(_pieces, window, anchor), _PIECES)
    )
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def parsed(pieces: DataFrame, limit: int | None) -> DataFrame:
        together = pieces.repartition(n, "key").sortWithinPartitions("key", "ord", "uid", "start")
        return together.mapInPandas(partial(_parsed, window, limit), _PIECES)

    # The second parse is for what found no room in the first; nearly always, spans alone.
    spans = parsed(parsed(pieces, INDEXED), None)
    packed = F.shiftleft(F.col("start").cast("bigint"), 32) + F.col("size")
    return spans.groupBy("uid").agg(F.collect_list(packed).alias("spans"))


def deduplicate(
    documents: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """The columns of `documents`, then n_words, n_removed and kept.

    A word goes if a run of `window` words that covers it also starts earlier: under a smaller
    doc_id, or earlier in the same text. Among rows of one doc_id, the order in which they are read
    decides, so of repeated rows the first stays whole; rows without doc_id come last. Runs are
    judged on the input. Null and empty texts have no words. `kept` holds the words joined by one
    space, or with keep_text=False its sha256. An empty table gives an empty table.

    `documents` is read more than once and must give its rows in the same order each time, as
    files do; write it first if it does not.
    """
    spark = documents.sparkSession
    names = _named(documents, text_column)
    rows = documents.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(text_column).alias("text"),
        *(F.col(c).alias(new) for c, new in names.items()),
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.repartition(n, "uid")
    spans = factors(rows, texts, names[id_column], window, anchor)

    @F.pandas_udf("n_words bigint, n_removed bigint, kept string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = [_kept(t, s) for t, s in zip(text, spans, strict=True)]
        show = bytes.decode if keep_text else lambda x: hashlib.sha256(x).hexdigest()
        return pd.DataFrame(
            [(n, gone, show(kept)) for n, gone, kept in out],
            columns=["n_words", "n_removed", "kept"],
        )

    judged = texts.join(spans, "uid", "left").withColumn("cut", cut("text", "spans"))
    columns = [F.col(names.get(c, "text")).alias(c) for c in documents.columns]
    return judged.select(*columns, "cut.n_words", "cut.n_removed", "cut.kept")
