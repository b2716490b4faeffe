"""Best-fit packing of documents into sequences, by a grouping genetic algorithm.

Pieces are dealt to islands of a few thousand. Each island evolves ways to group its pieces into
sequences: crossover injects whole well-filled groups of one parent into the other, drops the
groups that hold a piece twice, and puts the displaced pieces back by best fit. Between epochs the
islands send the lengths of their best groups around a ring, where the next island builds the
same groups from its own pieces and injects them.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import stored

CAPACITY = 1024
END_ID = 2
#: Pieces of an island, on average.
ISLAND_PIECES = 8_192
EPOCHS = 2
POPULATION = 4
CROSSOVERS = 10
#: Groups that an island sends on, at most this share of its own.
ELITE_SHARE = 0.1
_SPECIAL = "<|endoftext|>"
#: tiktoken's pattern keeps a state per whitespace character of a run and panics at a million; a
#: text with a run of this many characters goes to the slower `tokenizers`, which has no such bound.
LONG_RUN = 100_000
#: All that the pattern takes for whitespace, and four control characters more.
_WHITESPACE = re.compile(r"\s+")


@lru_cache(maxsize=1)
def _encoding(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=1)
def _library(rank_file: str):
    """The tokenizer that `tokenizers` reads from the vocabulary beside the rank file."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(Path(rank_file).with_suffix(".json")))


def has_long_run(text: str) -> bool:
    return len(text) >= LONG_RUN and any(
        m.end() - m.start() >= LONG_RUN for m in _WHITESPACE.finditer(text)
    )


def token_ids(text: str | None, rank_file: str, pattern: str) -> np.ndarray:
    """Ids of a whole text, with the end id; the tokenizer's one special token has the next id."""
    text = text or ""
    if has_long_run(text):
        ids = _library(rank_file).encode(text, add_special_tokens=False).ids
        return np.array([*ids, END_ID], "<u4")
    encoding = _encoding(rank_file, pattern)
    parts = text.split(_SPECIAL)
    ids = encoding.encode_ordinary(parts[0])
    for part in parts[1:]:
        ids.append(len(encoding._mergeable_ranks))
        ids.extend(encoding.encode_ordinary(part))
    ids.append(END_ID)
    return np.array(ids, "<u4")


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: whole sequences, but for a shorter first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(
    documents: DataFrame,
    rank_file: str,
    pattern: str,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every row; a null text counts as empty."""

    @F.pandas_udf("array<struct<start: bigint, length: bigint, ids_crc32: bigint>>")
    def cut_up(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            ids = token_ids(text, rank_file, pattern)
            out.append(
                [
                    {"start": s, "length": k, "ids_crc32": zlib.crc32(ids[s : s + k].tobytes())}
                    for s, k in cut(len(ids), capacity)
                ]
            )
        return pd.Series(out)

    return documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        F.posexplode(cut_up(F.col(text_column))).alias("piece", "cut"),
    ).select("doc_id", "piece", "cut.*")


class Packing:
    """Pieces grouped so far. `groups` are lists of piece numbers."""

    def __init__(self, sizes: list[int], capacity: int, groups=()) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.groups: list[list[int]] = [list(g) for g in groups]
        self.fill = [sum(sizes[i] for i in g) for g in self.groups]

    def best_fit(self, items: list[int]) -> Packing:
        """Each piece, longest first, goes where it leaves least room, or to a new group."""
        room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        open_rooms = 0  # bit r is set while some group has room r
        for g, used in enumerate(self.fill):
            r = self.capacity - used
            room[r].append(g)
            open_rooms |= 1 << r
        for i in sorted(items, key=self.sizes.__getitem__, reverse=True):
            size = self.sizes[i]
            fits = open_rooms >> size
            if fits:
                r = size + (fits & -fits).bit_length() - 1
                g = room[r].pop()
                if not room[r]:
                    open_rooms ^= 1 << r
                self.groups[g].append(i)
                self.fill[g] += size
            else:
                g = len(self.groups)
                self.groups.append([i])
                self.fill.append(size)
            left = self.capacity - self.fill[g]
            room[left].append(g)
            open_rooms |= 1 << left
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer groups; of as many, the more uneven, as full groups are worth keeping."""
        return -len(self.groups), sum(f * f for f in self.fill)

    def cross(self, injected: list[list[int]]) -> Packing:
        """This packing with whole groups of another, what they displace put back by best fit."""
        taken = {i for g in injected for i in g}
        kept, displaced = [], []
        for g in self.groups:
            if taken.isdisjoint(g):
                kept.append(g)
            else:
                displaced.extend(i for i in g if i not in taken)
        return Packing(self.sizes, self.capacity, [*injected, *kept]).best_fit(displaced)

    def fullest(self, share: float) -> list[list[int]]:
        order = sorted(range(len(self.groups)), key=self.fill.__getitem__, reverse=True)
        return [self.groups[g] for g in order[: max(1, int(len(order) * share))]]


def _built(patterns: list[list[int]], sizes: list[int]) -> list[list[int]]:
    """Groups of own pieces with the lengths of another island's groups, as far as they go."""
    stock: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        stock.setdefault(size, []).append(i)
    out = []
    for lengths in patterns:
        need = {k: lengths.count(k) for k in lengths}
        if all(len(stock.get(k, ())) >= n for k, n in need.items()):
            out.append([stock[k].pop() for k in lengths])
    return out


def evolve(
    sizes: list[int],
    groups: list[list[int]],
    patterns: list[list[int]],
    seed: int,
    capacity: int = CAPACITY,
    crossovers: int = CROSSOVERS,
) -> Packing:
    """The best packing of one epoch, never worse than best fit or than `groups`, if given."""
    draw = np.random.default_rng(seed)
    everything = list(range(len(sizes)))
    population = [Packing(sizes, capacity).best_fit(everything)]
    if groups:
        population.append(Packing(sizes, capacity, groups))
    while len(population) < POPULATION:
        # Random groups of the shorter half first, best fit for the rest.
        some = draw.permutation(len(sizes))[: max(1, len(sizes) // 4)].tolist()
        start = Packing(sizes, capacity)
        for i in some:
            if start.groups and start.fill[-1] + sizes[i] <= capacity:
                start.groups[-1].append(i)
                start.fill[-1] += sizes[i]
            else:
                start.groups.append([i])
                start.fill.append(sizes[i])
        chosen = set(some)
        population.append(start.best_fit([i for i in everything if i not in chosen]))
    if patterns:
        best = max(population, key=Packing.fitness)
        population.append(best.cross(_built(patterns, sizes)))
    for _ in range(crossovers):
        population.sort(key=Packing.fitness, reverse=True)
        del population[POPULATION:]
        a, b = draw.choice(len(population), 2, replace=False)
        fullest = population[b].fullest(0.5)
        pick = draw.permutation(len(fullest))[: max(1, len(fullest) // 2)]
        population.append(population[a].cross([fullest[k] for k in pick]))
    return max(population, key=Packing.fitness)


_ROWS = "island bigint, uid bigint, length bigint, sequence bigint, place bigint, elite boolean"


def _epoch(islands: int, capacity: int, epoch: int, rows: pd.DataFrame) -> pd.DataFrame:
    island = int(rows["island"].iloc[0])
    own = rows[~rows["elite"]].sort_values("uid")
    sizes = own["length"].tolist()
    groups = [g.tolist() for g in own.reset_index().groupby("sequence").groups.values()] if epoch else []
    sent = rows[rows["elite"]].sort_values(["sequence", "uid"])
    patterns = [g.tolist() for _, g in sent.groupby("sequence")["length"]]
    if not sizes:
        return rows.iloc[:0]
    best = evolve(sizes, groups, patterns, seed=(island << 8) + epoch, capacity=capacity)
    uids = own["uid"].to_numpy()
    out = []
    for number, group in enumerate(best.groups):
        place = 0
        for i in sorted(group):
            out.append((island, uids[i], sizes[i], number, place, False))
            place += sizes[i]
    if islands > 1:
        onward = (island + 1) % islands
        for number, group in enumerate(best.fullest(ELITE_SHARE)):
            out.extend((onward, k, sizes[i], number, 0, True) for k, i in enumerate(group))
    return pd.DataFrame(out, columns=rows.columns)


def _evolving(islands: int, capacity: int, epoch: int):
    def evolved(rows: pd.DataFrame) -> pd.DataFrame:
        return _epoch(islands, capacity, epoch, rows)

    return evolved


def pack(
    documents: DataFrame,
    rank_file: str,
    pattern: str,
    capacity: int = CAPACITY,
    island_pieces: int = ISLAND_PIECES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Every row is packed, repeated ones and those with a null doc_id too; a null or empty text has
    one piece with the end id. Only documents of over `capacity` tokens are cut; their whole
    pieces fill sequences of their own. Sequences are gapless from 0. Other columns are not read;
    an empty table gives an empty table.
    """
    cut_up = pieces(documents, rank_file, pattern, capacity, id_column, text_column)
    cut_up = stored(cut_up.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == capacity
    partial_pieces = cut_up.where(~whole).select("uid", "length")
    islands = max(1, math.ceil(partial_pieces.count() / island_pieces))
    rows = partial_pieces.select(
        F.pmod(F.xxhash64("uid"), F.lit(islands)).alias("island"), "uid", "length",
        F.lit(0).cast("bigint").alias("sequence"), F.lit(0).cast("bigint").alias("place"),
        F.lit(False).alias("elite"),
    )
    for epoch in range(EPOCHS):
        rows = rows.groupBy("island").applyInPandas(_evolving(islands, capacity, epoch), _ROWS)
    placed = rows.where(~F.col("elite")).select(
        "uid",
        (F.shiftleft("island", 32) + F.col("sequence")).alias("sequence_id"),
        F.col("place").alias("offset"),
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    alone = cut_up.where(whole).select(
        "*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return cut_up.where(~whole).join(placed, "uid").select(columns).unionByName(
        alone.select(columns)
    )
