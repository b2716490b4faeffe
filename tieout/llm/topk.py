"""Exact top-k by inner product: best-first search of paged M-trees.

Vectors are dealt to blocks by their two nearest pivots of a bounded sample, so that a block is a
ball of neighbours. The tree of a block is built once, and searched for the block's own queries at
once: the k-th score that a query has there is what another block must reach. A query is then sent
only to blocks whose covering ball may hold a score as high.

With one more component, that fills every vector of a block up to the block's greatest norm, the
largest inner product is the smallest Euclidean distance, so a metric tree answers it exactly. The
vectors of a block form one tree of pages. A routing entry holds its pivot, covering radius and
distance to the parent's pivot; a leaf entry its distance to the leaf's pivot. The search takes the
page of least possible distance first; stored distances rule entries out by the triangle
inequality before any distance to them is computed.
"""

from __future__ import annotations

import heapq
import pickle
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieout.llm.common import stored

K = 5
SCALE = 256
#: Vectors of a block, which is one tree.
BLOCK_ROWS = 8_192
#: Covering balls of blocks, and packs of queries, that meet in one task; packs that meet a block.
BALLS = 1_024
PACKS = 64
#: Vectors that the pivots of all blocks are drawn from; each one of the sample is a pivot.
PIVOTS = 256
#: Bytes of queries that are sent on at a time.
SENT_BYTES = 16_000_000
PAGE = 512
FANOUT = 16
#: Relative slack of distances, far above their rounding and far below 1 in the score's terms.
_SLACK = 1e-9
#: Integers up to here are exact as doubles.
_EXACT = 1 << 53
_LARGEST = (1 << 63) - 1


class Tree:
    """A paged M-tree over integer vectors (rows of doubles)."""

    def __init__(self, vectors: np.ndarray, page: int = PAGE) -> None:
        self.page = page
        self.square = np.einsum("ij,ij->i", vectors, vectors)
        self.most = float(self.square.max()) if len(vectors) else 0.0
        last = np.sqrt(np.maximum(self.most - self.square, 0.0))
        self.points = np.column_stack([vectors, last])
        self.largest = float(np.abs(vectors).max(initial=0.0))
        # A page is ("leaf", rows, distances to its pivot) or ("node", children), where children
        # are parallel arrays of pivot row, radius, distance to the page's pivot, and page.
        self.pages: list[tuple] = []
        self.root = self._page(np.arange(len(vectors)), None)

    def dumped(self) -> bytes:
        return pickle.dumps(vars(self))

    @classmethod
    def loaded(cls, raw: bytes) -> Tree:
        tree = cls.__new__(cls)
        vars(tree).update(pickle.loads(raw))
        return tree

    def _far(self, pivot: int, rows: np.ndarray) -> np.ndarray:
        d = self.points[rows] - self.points[pivot]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    def _page(self, rows: np.ndarray, pivot: int | None) -> int:
        if len(rows) <= self.page:
            far = self._far(pivot, rows) if pivot is not None else np.zeros(len(rows))
            self.pages.append(("leaf", rows, far))
            return len(self.pages) - 1
        pivots = [int(rows[0])]
        near = self._far(pivots[0], rows)
        whose = np.zeros(len(rows), np.int64)
        while len(pivots) < FANOUT and near.max() > 0:
            pivots.append(int(rows[int(near.argmax())]))
            far = self._far(pivots[-1], rows)
            closer = far < near
            near[closer], whose[closer] = far[closer], len(pivots) - 1
        if len(pivots) == 1:  # copies of one vector: cut anywhere
            parts = min(FANOUT, len(rows))
            whose = np.arange(len(rows)) * parts // len(rows)
            pivots = [int(rows[whose == g][0]) for g in range(parts)]
        children = []
        for g, p in enumerate(pivots):
            own = rows[whose == g]
            if len(own):
                children.append((p, near[whose == g].max(), self._page(own, p)))
        at = np.array([c[0] for c in children])
        parent = self._far(pivot, at) if pivot is not None else np.zeros(len(at))
        radius = np.array([c[1] for c in children])
        self.pages.append(("node", at, radius, parent, [c[2] for c in children]))
        return len(self.pages) - 1

    def _reach(self, norm: float, score: float) -> float:
        """The distance of a score, or a little more."""
        square = max(0.0, norm + self.most - 2.0 * score)
        return np.sqrt(square) + _SLACK * (1.0 + np.sqrt(norm + self.most))

    def _rounding(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """More than the rounding of each row's product with the query."""
        return np.abs(self.points[rows, :-1]) @ np.abs(query) * (4 * len(query) * 2.0**-53)

    def _whole(self, rows: np.ndarray, query: list[int]) -> list[int]:
        found = self.points[rows, :-1].tolist()
        return [sum(int(a) * b for a, b in zip(v, query, strict=True)) for v in found]

    def search(
        self, query: np.ndarray, k: int, ids: np.ndarray, own: int, floor: float = -np.inf
    ):
        """The k best (score, id, row), by falling score, then smaller id; row `own` is left out.

        Scores below `floor` may be left out.
        """
        q = np.append(query, 0.0)
        norm = float(query @ query)
        # Where products pass what doubles hold exactly, they bound the scores, and whole numbers
        # settle the few that are left.
        exact = self.largest * float(np.abs(query).max(initial=0.0)) * len(query) < _EXACT
        whole = None if exact else [int(c) for c in query.tolist()]
        best: list[tuple[int, int, int]] = []  # heap of (score, -id, row), worst first
        reach = self._reach(norm, floor)
        queue = [(0.0, 0, self.root, None)]
        tie = 0
        while queue:
            least, _, page, to_pivot = heapq.heappop(queue)
            if least > reach:
                break
            kind, rows, *rest = self.pages[page]
            # |d(q, pivot) - d(pivot, entry)| is the least d(q, entry) can be.
            if kind == "leaf":
                if to_pivot is not None:
                    rows = rows[np.abs(to_pivot - rest[0]) <= reach]
                rows = rows[rows != own]
                if not len(rows):
                    continue
                scores = self.points[rows, :-1] @ query
                off = 0.0 if exact else self._rounding(rows, query)
                if len(rows) > 4 * k:
                    # All that can reach the page's k-th best score, ties too.
                    fit = scores + off >= np.partition(scores - off, len(scores) - k)[-k]
                    rows, scores, off = rows[fit], scores[fit], off if exact else off[fit]
                if len(best) == k:
                    # Ties with the worst stay: the smaller id decides them.
                    fit = scores + off >= best[0][0]
                    rows, scores = rows[fit], scores[fit]
                found = scores.tolist() if exact else self._whole(rows, whole)
                for s, i, r in zip(found, (-ids[rows]).tolist(), rows.tolist(), strict=True):
                    entry = (int(s), i, r)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    reach = min(reach, self._reach(norm, float(best[0][0])))
            else:
                radius, parent, pages = rest
                where = np.arange(len(rows))
                if to_pivot is not None:
                    where = where[np.abs(to_pivot - parent) - radius <= reach]
                d = self.points[rows[where]] - q
                far = np.sqrt(np.einsum("ij,ij->i", d, d))
                for w, f in zip(where.tolist(), far.tolist(), strict=True):
                    low = max(0.0, f - radius[w], least)
                    if low <= reach:
                        tie += 1
                        heapq.heappush(queue, (low, tie, pages[w], f))
        return sorted(((s, -i, r) for s, i, r in best), key=lambda x: (-x[0], x[1]))


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squares of distances, where they are no more than numbers to sort by."""
    with np.errstate(all="ignore"):
        square = np.einsum("ij,ij->i", vectors, vectors)[:, None]
        d = square - 2.0 * (vectors @ pivots.T) + np.einsum("ij,ij->i", pivots, pivots)
    return np.nan_to_num(np.maximum(d, 0.0), nan=np.finfo("f8").max)


def _placed(pivots: dict[int, np.ndarray], vectors: pd.Series) -> pd.DataFrame:
    """Each vector's nearest and second nearest pivot, and its distance to the nearest."""
    out = np.zeros((len(vectors), 3))
    sizes = vectors.map(len).to_numpy()
    for dims in np.unique(sizes).tolist():
        if dims not in pivots:
            continue
        at = np.flatnonzero(sizes == dims)
        d = _distances(np.array(vectors.iloc[at].tolist(), "f8"), pivots[dims])
        order = np.argsort(d, axis=1, kind="stable")
        first, second = order[:, 0], order[:, min(1, d.shape[1] - 1)]
        out[at] = np.column_stack([first, second, d[np.arange(len(at)), first]])
    return pd.DataFrame(
        {"first": out[:, 0].astype("i4"), "second": out[:, 1].astype("i4"), "far": out[:, 2]}
    )


def _runs(limit: int, batches):
    """Rows that follow each other, of one length and at most `limit`, as one frame each.

    A run that is half full ends where another pivot becomes the nearest.
    """
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        while len(held):
            n = min(limit, len(held))
            dims, cell = held["dims"].to_numpy()[:n], held["first"].to_numpy()[:n]
            ends = np.flatnonzero(np.diff(dims) != 0) + 1
            turns = np.flatnonzero(np.diff(cell) != 0) + 1
            turns = turns[turns >= (limit + 1) // 2]
            cut = min([*ends[:1].tolist(), *turns[:1].tolist(), limit])
            if cut > len(held) or (cut == limit and len(held) < limit):
                break
            yield held.iloc[:cut]
            held = held.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


_BLOCK = (
    "block bigint, dims int, ids binary, uids binary, tree binary, centre binary, radius double, "
    "asked int, query_ids binary, query_uids binary, query_vectors binary, floors binary"
)


def _blocks(k: int, limit: int, page: int, batches):
    """A tree, its covering ball, and its queries with what their other blocks must reach."""
    for rows in _runs(limit, batches):
        ids, uids = rows["vec_id"].to_numpy("i8"), rows["uid"].to_numpy("i8")
        vectors = np.array(rows["v"].tolist(), "f8")
        tree = Tree(vectors, page)
        with np.errstate(all="ignore"):
            centre = vectors.mean(axis=0)
            off = vectors - centre
            radius = np.nan_to_num(np.sqrt(np.einsum("ij,ij->i", off, off).max()), nan=np.inf)
        asks = np.flatnonzero(rows["asks"].to_numpy(bool))
        floors = np.full(len(asks), -np.inf)
        for n, i in enumerate(asks.tolist()):
            best = tree.search(vectors[i], k, ids, i)
            if len(best) == k:
                least = float(best[-1][0])
                floors[n] = least - 1.0 - abs(least) * 1e-12
        yield pd.DataFrame(
            {
                "block": [uids.min()], "dims": [vectors.shape[1]],
                "ids": [ids.tobytes()], "uids": [uids.tobytes()], "tree": [tree.dumped()],
                "centre": [centre.tobytes()], "radius": [float(radius)], "asked": [len(asks)],
                "query_ids": [ids[asks].tobytes()], "query_uids": [uids[asks].tobytes()],
                "query_vectors": [vectors[asks].tobytes()], "floors": [floors.tobytes()],
            }
        )


_BALLS = "dims int, chunk int, blocks binary, centres binary, radii binary"


def _gathered(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "dims": rows["dims"].iloc[:1], "chunk": rows["chunk"].iloc[:1],
            "blocks": [rows["block"].to_numpy("i8").tobytes()],
            "centres": [b"".join(rows["centre"])],
            "radii": [rows["radius"].to_numpy("f8").tobytes()],
        }
    )


_SENT = (
    "block bigint, salt int, query_ids binary, query_uids binary, query_vectors binary, "
    "floors binary"
)


def most_in_balls(
    queries: np.ndarray, centres: np.ndarray, radii: np.ndarray
) -> np.ndarray:
    """No vector of the ball has a greater inner product with the query (queries x balls)."""
    with np.errstate(all="ignore"):
        norms = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        from_centre = np.sqrt(np.einsum("ij,ij->i", centres, centres))
        least = queries @ centres.T + norms * radii
        bound = least + _SLACK * (1.0 + norms * (from_centre + radii))
    return np.where(np.isnan(bound), np.inf, bound)


def _reached(batches):
    """For each ball that some query of a pack must look into, these queries."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            blocks, radii = np.frombuffer(row.blocks, "i8"), np.frombuffer(row.radii, "f8")
            centres = np.frombuffer(row.centres, "f8").reshape(len(blocks), -1)
            ids, uids = np.frombuffer(row.query_ids, "i8"), np.frombuffer(row.query_uids, "i8")
            queries = np.frombuffer(row.query_vectors, "f8").reshape(len(ids), -1)
            floors = np.frombuffer(row.floors, "f8")
            hit = most_in_balls(queries, centres, radii) >= floors[:, None]
            out, held = [], 0
            for b in np.flatnonzero(hit.any(axis=0)).tolist():
                at = hit[:, b]
                vectors = queries[at].tobytes()
                out.append((
                    blocks[b], row.salt, ids[at].tobytes(), uids[at].tobytes(), vectors,
                    floors[at].tobytes(),
                ))
                held += len(vectors)
                if held > SENT_BYTES:
                    yield _sent(out)
                    out, held = [], 0
            yield _sent(out)


def _sent(rows: list[tuple]) -> pd.DataFrame:
    names = ["block", "salt", "query_ids", "query_uids", "query_vectors", "floors"]
    return pd.DataFrame(rows, columns=names).astype({"block": "i8", "salt": "i4"})


_FOUND = "query_uid bigint, query_id bigint, vec_id bigint, uid bigint, score bigint, size double"


def _searched(k: int, batches):
    """The k best of a block for each query that was sent there."""
    held = (None, None, None, None, None)
    for batch in batches:
        for row in batch.itertuples(index=False):
            if held[0] != row.block:
                uids = np.frombuffer(row.uids, "i8")
                place = {u: i for i, u in enumerate(uids.tolist())}
                ids = np.frombuffer(row.ids, "i8")
                held = (row.block, Tree.loaded(row.tree), ids, uids, place)
            _, tree, ids, uids, place = held
            query_uids = np.frombuffer(row.query_uids, "i8").tolist()
            query_ids = np.frombuffer(row.query_ids, "i8").tolist()
            queries = np.frombuffer(row.query_vectors, "f8").reshape(len(query_ids), -1)
            floors = np.frombuffer(row.floors, "f8").tolist()
            out = []
            for u, q, vector, floor in zip(query_uids, query_ids, queries, floors, strict=True):
                for score, i, r in tree.search(vector, k, ids, place.get(u, -1), floor):
                    if score >= floor:
                        held_in = max(min(score, _LARGEST), -_LARGEST - 1)
                        out.append((u, q, i, int(uids[r]), held_in, float(score)))
            columns = ["query_uid", "query_id", "vec_id", "uid", "score"]
            yield pd.DataFrame(out, columns=[*columns, "size"]).astype(
                {c: "i8" for c in columns} | {"size": "f8"}
            )


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """PIVOTS vectors by a hash of their number, by length."""
    sample = rows.orderBy(F.xxhash64("uid"), "uid").select("v").limit(PIVOTS).collect()
    lengths: dict[int, list] = {}
    for r in sample:
        lengths.setdefault(len(r.v), []).append(r.v)
    return {dims: np.unique(np.array(v, "f8"), axis=0) for dims, v in lengths.items()}


def top_k(
    embeddings: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of each row for which `is_query` holds.

    Components become floor(scale * x); the score is the integer inner product; ties go to the
    smaller vec_id. `is_query` is a condition on vec_id. A row is no candidate of its own, but
    repeated rows are candidates of each other. Vectors that are null, empty, or hold null or
    non-finite components, and rows without an id, take no part; vectors of another length are no
    candidates. A query with fewer candidates than k gets them all, one without any has no rows.
    Scores are exact whatever their size; one that no long holds is shown as the largest or the
    smallest long, and such scores are ordered in double precision.

    Pivots are fitted on at most PIVOTS rows, whatever the size of the table; every row is in a
    block, and blocks are left out by proof alone. A task holds one block, and packs of queries.
    """
    x = F.col(vector_column).cast("array<double>")
    rows = embeddings.select(
        F.col(id_column).cast("bigint").alias("vec_id"), x.alias("x"),
    ).where(
        F.col("vec_id").isNotNull()
        & F.coalesce(
            (F.size("x") > 0)
            & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))),
            F.lit(False),
        )
    )
    # A double of 2 ** 53 or more is whole as it is, and floor() would force it into a long.
    def floored(c):
        y = c * F.lit(float(scale))
        return F.when(F.abs(y) < F.lit(float(_EXACT)), F.floor(y).cast("double")).otherwise(y)

    whole = F.transform("x", floored)
    rows = stored(
        rows.select("vec_id", whole.alias("v"), F.monotonically_increasing_id().alias("uid")),
        "vectors",
    )
    spark = embeddings.sparkSession
    wanted = -(-rows.count() // BLOCK_ROWS)
    if not wanted:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pivots = _pivots(rows)

    @F.pandas_udf("first int, second int, far double")
    def placed(v: pd.Series) -> pd.DataFrame:
        return _placed(pivots, v)

    order = ["dims", "first", "second", "far", "uid"]
    # The number of a row comes last, so that copies of one vector spread as well.
    dealt = (
        rows.withColumn("cell", placed("v"))
        .select("vec_id", "uid", "v", F.size("v").alias("dims"), "cell.*",
                F.coalesce(is_query, F.lit(False)).alias("asks"))
        .repartitionByRange(min(wanted, max(shuffles, -(-wanted // 4))), *order)
        .sortWithinPartitions(*order)
    )
    blocks = stored(dealt.mapInPandas(partial(_blocks, k, BLOCK_ROWS, PAGE), _BLOCK), "trees")
    n = blocks.count()
    chunks, groups = -(-n // BALLS), -(-n // PACKS)

    def dealt_to(column: str, parts: int) -> Column:
        return F.pmod(F.xxhash64(F.col(column)), F.lit(parts)).cast("int")

    # Balls and queries of all blocks meet in bounded parts of either.
    balls = (
        blocks.select("block", "dims", "centre", "radius", dealt_to("block", chunks).alias("chunk"))
        .groupBy("dims", "chunk")
        .applyInPandas(_gathered, _BALLS)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    )
    queries = blocks.where(F.col("asked") > 0).select(
        "dims", "query_ids", "query_uids", "query_vectors", "floors",
        dealt_to("block", groups).alias("salt"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
    )
    meeting = ["dims", "chunk", "salt"]
    sent = stored(queries.join(balls, meeting).mapInPandas(_reached, _SENT), "sent")
    # A block goes to each group of queries that needs it, so that one which all need is not one
    # task's.
    asked = ["block", "salt"]
    trees = blocks.select("block", "ids", "uids", "tree")
    needed = sent.select(*asked).distinct().join(trees, "block")
    tasks = min(n * groups, 4 * shuffles)
    met = sent.repartition(tasks, *asked).join(needed.repartition(tasks, *asked), asked)
    found = met.mapInPandas(partial(_searched, k), _FOUND)
    best = Window.partitionBy("query_uid").orderBy(F.desc("score"), F.desc("size"), "vec_id", "uid")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
