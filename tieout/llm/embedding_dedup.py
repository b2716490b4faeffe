"""Near-duplicate vectors of one label, by tiled comparison in PCA order.

Unit vectors are turned so that the directions of most variance come first, and cut into tiles
that are compact in these directions. Tiles whose boxes are too far apart never meet. Where two
tiles meet, products are accumulated over the leading dimensions first; what the remaining ones
can add is at most the product of the suffix norms, and a pair whose bound falls under the
threshold is dropped there.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.durable import materialise
from tieout.llm.common import map_batches, stored
from tieout.llm.components import components, local_roots

THRESHOLD = 0.98
#: Bytes of vectors in a tile.
TILE_BYTES = 1 << 20
#: Leading dimensions by which tiles are cut and kept apart.
BOX_DIMENSIONS = 8
#: Rounding of turned products; what is closer to the threshold is computed from the vectors.
SLACK = 1e-9
#: Tiles in one Arrow batch.
TILES_AT_ONCE = 16


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _unit(matrix: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]


def _scatter(width: int, batches):
    total = np.zeros((width, width))
    for batch in batches:
        u = _unit(_matrix(batch["embedding"], width))
        total += u.T @ u
    yield pd.DataFrame({"at": np.arange(width * width), "value": total.ravel()})


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Columns: directions of all unit vectors, by falling variance; width * width numbers."""
    parts = vectors.select("embedding").mapInPandas(
        partial(_scatter, width), "at int, value double"
    )
    total = np.zeros(width * width)
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        total[row["at"]] = row["value"]
    values, axes = np.linalg.eigh(total.reshape(width, width))
    return axes[:, np.argsort(-values)]


def _split(turned: np.ndarray, rows: np.ndarray, size: int):
    """Row numbers of compact tiles: halves along the widest leading direction."""
    if len(rows) <= size:
        yield rows
        return
    lead = turned[rows, :BOX_DIMENSIONS]
    axis = int(np.argmax(lead.max(axis=0) - lead.min(axis=0)))
    order = rows[np.argsort(lead[:, axis], kind="stable")]
    yield from _split(turned, order[: len(order) // 2], size)
    yield from _split(turned, order[len(order) // 2 :], size)


def _tiles(axes: np.ndarray, batches):
    """One row per tile: its box, and its vectors, turned, as bytes."""
    width = len(axes)
    size = max(64, TILE_BYTES // (8 * width))
    for batch in batches:
        unit = _unit(_matrix(batch["embedding"], width))
        turned = unit @ axes
        ids, copies = batch["rep"].to_numpy(), batch["copies"].to_numpy()
        out = []
        for (label, dims), group in batch.groupby(["label", "dims"]):
            for rows in _split(turned, batch.index.get_indexer(group.index), size):
                lead = turned[rows, :BOX_DIMENSIONS]
                out.append(
                    (
                        int(ids[rows].min()), label, dims, lead.min(axis=0).tolist(),
                        lead.max(axis=0).tolist(), ids[rows].tobytes(), copies[rows].tobytes(),
                        turned[rows].tobytes(), unit[rows].tobytes(),
                    )
                )
        yield pd.DataFrame(out, columns=_TILE_COLUMNS)


_TILE_COLUMNS = ["tile", "label", "dims", "low", "high", "ids", "copies", "turned", "unit"]
_TILE = (
    "tile bigint, label bigint, dims int, low array<double>, high array<double>, "
    "ids binary, copies binary, turned binary, unit binary"
)


def linked_pairs(
    a: np.ndarray, b: np.ndarray, unit_a: np.ndarray, unit_b: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i in a, j in b) whose cosine reaches the threshold; a and b are turned."""
    width = a.shape[1]
    rest_a = np.sqrt(np.cumsum((a * a)[:, ::-1], axis=1)[:, ::-1])
    rest_b = np.sqrt(np.cumsum((b * b)[:, ::-1], axis=1)[:, ::-1])
    done, step, i, j, products = 0, 4, None, None, None
    while done < width:
        upto = min(width, done + step)
        if i is None:  # all pairs of the tiles
            part = a[:, done:upto] @ b[:, done:upto].T
            products = part if products is None else products + part
            left = np.outer(rest_a[:, upto], rest_b[:, upto]) if upto < width else 0.0
            alive = products + left >= threshold - SLACK
            if alive.mean() < 0.05 or upto == width:
                i, j = np.nonzero(alive)
                products = products[i, j]
        else:  # the pairs still alive
            products = products + np.einsum("ij,ij->i", a[i, done:upto], b[j, done:upto])
            left = rest_a[i, upto] * rest_b[j, upto] if upto < width else 0.0
            alive = products + left >= threshold - SLACK
            i, j, products = i[alive], j[alive], products[alive]
        if i is not None and not len(i):
            break
        done, step = upto, step * 2
    near = np.abs(products - threshold) <= SLACK
    keep = products >= threshold
    keep[near] = np.einsum("ij,ij->i", unit_a[i[near]], unit_b[j[near]]) >= threshold
    return i[keep], j[keep]


def _compare(threshold: float, batch: pd.DataFrame) -> pd.DataFrame:
    """For each pair of tiles: copies linked to each vector, and a forest of the links."""
    out = []
    for row in batch.itertuples(index=False):
        ids = [np.frombuffer(x, "i8") for x in (row.ids, row.other_ids)]
        copies = [np.frombuffer(x, "i8") for x in (row.copies, row.other_copies)]
        turned, unit = (
            [np.frombuffer(x, "f8").reshape(len(k), -1) for x, k in zip(pair, ids, strict=True)]
            for pair in ((row.turned, row.other_turned), (row.unit, row.other_unit))
        )
        i, j = linked_pairs(*turned, *unit, threshold)
        if row.tile == row.other_tile:
            once = i < j
            i, j = i[once], j[once]
        if not len(i):
            continue
        a, b = ids[0][i], ids[1][j]
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        weight = np.bincount(at, np.concatenate([copies[1][j], copies[0][i]]))
        out.append(pd.DataFrame({"a": nodes, "b": nodes, "n": weight.astype("i8")}))
        nodes, roots = local_roots(a, b)
        out.append(pd.DataFrame({"a": nodes, "b": roots, "n": 0}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "n": []}, dtype="i8")


def near_duplicates(
    embeddings: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; vectors meet only within a label.

    A null or zero vector, one with null or non-finite components, and one without a label link
    with nothing, as do vectors of different lengths. Repeated rows are different vectors: they
    link with each other. A null vec_id links and counts, but never names a component; it is not
    kept. An empty table gives an empty table.
    """
    spark = embeddings.sparkSession
    vector = F.col(vector_column).cast("array<double>")
    rows = embeddings.select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.col(label_column).cast("bigint").alias("label"),
        vector.alias("embedding"),
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(
        finite & F.exists("embedding", lambda x: x != 0), F.lit(False)
    )
    marked = rows.withColumn("key", F.when(usable, F.col("embedding"))).drop("embedding")
    # Copies meet the others once. `rep` numbers the distinct vectors; only ids shape results.
    distinct = marked.where(F.col("key").isNotNull()).groupBy("label", "key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id")
    )
    distinct = stored(
        distinct.withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors"
    )
    width = distinct.agg(F.max(F.size("key"))).first()[0]
    if width is None:
        found = spark.createDataFrame([], "a bigint, b bigint, n bigint")
    else:
        found = _links(distinct, width, threshold)
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    roots = components(found.select("a", "b")).select(
        F.col("node").alias("rep"), F.col("component").alias("root")
    )
    classes = (
        distinct.join(counts, "rep", "left")
        .join(roots, "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
    )
    named = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    judged = classes.join(named, "root").select(
        "label", "key", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = marked.join(judged, ["label", "key"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("vec_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(distinct: DataFrame, width: int, threshold: float) -> DataFrame:
    spark = distinct.sparkSession
    vectors = distinct.select(
        "rep", "copies", "label", F.size("key").alias("dims"), F.col("key").alias("embedding")
    )
    axes = principal_axes(vectors, width)
    lead = F.aggregate(
        F.zip_with("embedding", F.array(*map(F.lit, axes[:, 0].tolist())),
                   lambda x, y: F.coalesce(x * y, F.lit(0.0))),
        F.lit(0.0), lambda s, x: s + x,
    ) / F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A label of any size spreads over as many partitions as its rows need.
    ordered = vectors.withColumn("lead", lead).repartitionByRange(
        partitions, "label", "dims", "lead"
    )
    tiles = stored(ordered.drop("lead").mapInPandas(partial(_tiles, axes), _TILE), "tiles")
    box = tiles.select("tile", "label", "dims", "low", "high")
    other = box.select(
        F.col("tile").alias("other_tile"), "label", "dims",
        F.col("low").alias("other_low"), F.col("high").alias("other_high"),
    )
    gaps = F.zip_with(
        F.zip_with("low", "other_high", lambda x, y: x - y),
        F.zip_with("other_low", "high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x * x)
    meet = (F.col("tile") <= F.col("other_tile")) & (apart <= 2 - 2 * threshold + SLACK)
    pairs = box.join(other, ["label", "dims"]).where(meet).select("tile", "other_tile")
    body = tiles.select("tile", "ids", "copies", "turned", "unit")
    partner = body.select(*(F.col(c).alias(f"other_{c}") for c in body.columns))
    met = pairs.join(body, "tile").join(partner, "other_tile")
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch_rows)
    spark.conf.set(batch_rows, str(TILES_AT_ONCE))
    try:
        return materialise(
            map_batches(met, partial(_compare, threshold), "a bigint, b bigint, n bigint")
        )
    finally:
        spark.conf.set(batch_rows, before)
