"""Whitening of vectors by the leading components of their covariance, found by Jacobi-Davidson.

The covariance is never formed. One pass over the written list of distinct vectors multiplies it by
a block of directions: each task centres its rows, projects locked components out of them, and
gives the sum of row times (row times block). On the driver stand only matrices of the vectors'
width by some dozens of columns.

Each outer step takes Ritz vectors of the search space, locks those whose residual has come down to
rounding, and extends the space by the solutions of the projected correction equations
(1 - QQ')(V - theta)(1 - QQ') t = -r, which MINRES solves for all unlocked vectors side by side, one
pass per step. At the end one pass over the projected rows settles eigenvalues and directions among
the locked components to relative precision, however far their sizes lie apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tieout.llm.common import map_batches, stored

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
#: Entries whose integer would lie beyond this count as this much.
LARGEST = 2**62 - 1
#: Vectors in one written block.
BLOCK_BYTES = 1 << 21
#: Residuals below this share of the largest unlocked eigenvalue are rounding.
TOLERANCE = 1e-13
#: What is left below this share of the largest eigenvalue is rounding of the projected rows.
ROUNDING = 1e-26
#: Extra Ritz vectors carried beside the wanted ones.
SPARE = 4
#: MINRES steps per correction, at most, and the reduction that ends them earlier.
INNER_STEPS = 6
INNER_REDUCTION = 1e-3
#: Columns of the search space, in blocks, before it is restarted from its leading Ritz vectors.
SPACE_BLOCKS = 5
#: Outer steps without result before the solver gives up with an error.
OUTER_STEPS = 400

Product = Callable[[np.ndarray, np.ndarray], np.ndarray]


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Columns of unit length, at right angles to `against` and each other; dependent ones go."""
    kept = []
    base = against
    for v in block.T:
        size = np.linalg.norm(v)
        if size == 0 or not np.isfinite(size):
            continue
        v = v / size
        for _ in range(3):
            v = v - base @ (base.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            kept.append(v)
            base = np.column_stack([base, v])
    return np.column_stack(kept) if kept else np.zeros((len(block), 0))


def minres(
    apply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int, reduction: float
) -> np.ndarray:
    """Approximate solutions of A_i t_i = right_i, one column each, by MINRES side by side.

    `apply` multiplies column i by the symmetric A_i, all columns at once. A column that has
    converged or broken down stays as it is.
    """
    beta = np.linalg.norm(right, axis=0)
    start = np.where(beta > 0, beta, 1.0)
    out = np.zeros_like(right)
    before, current = np.zeros_like(right), right / start
    d1, d2 = np.zeros_like(right), np.zeros_like(right)
    c1, c2 = np.ones(len(beta)), np.ones(len(beta))
    s1, s2 = np.zeros(len(beta)), np.zeros(len(beta))
    left, link = beta.copy(), np.zeros(len(beta))
    active = beta > 0
    for _ in range(steps):
        if not active.any():
            break
        # Lanczos: A v_k = link_k v_(k-1) + alpha v_k + link_(k+1) v_(k+1).
        image = apply(current)
        alpha = np.einsum("ij,ij->j", current, image)
        after = image - alpha * current - link * before
        link_next = np.linalg.norm(after, axis=0)
        # The two rotations before, then the new one.
        far, near = s2 * link, c2 * link
        diagonal = c1 * alpha - s1 * near
        off = s1 * alpha + c1 * near
        rho = np.hypot(diagonal, link_next)
        alive = active & (rho > 0)
        safe = np.where(alive, rho, 1.0)
        c0, s0 = diagonal / safe, link_next / safe
        d0 = (current - off * d1 - far * d2) / safe
        out = np.where(alive, out + d0 * (c0 * left), out)
        left = np.where(alive, -s0 * left, left)
        active = alive & (np.abs(left) > reduction * beta) & (link_next > 0)
        before, current = current, after / np.where(link_next > 0, link_next, 1.0)
        d2, d1 = d1, d0
        c2, s2, c1, s1 = c1, s1, c0, s0
        link = link_next
    return out


def jacobi_davidson(
    product: Product, width: int, wanted: int, rank: int, tolerance: float = TOLERANCE
) -> np.ndarray:
    """The leading eigenvectors, by falling eigenvalue, as columns; at most `rank` of them.

    `product(block, locked)` multiplies the covariance of rows without their share in `locked`.
    Fewer come out if what the locked components leave has no variance.
    """
    wanted = min(wanted, width, rank)
    carried = min(wanted + SPARE, width)
    draw = np.random.default_rng(1)
    locked = np.zeros((width, 0))
    space = orthonormal(draw.normal(size=(width, carried)), locked)
    image = product(space, locked)
    first = None
    for _ in range(OUTER_STEPS):
        if locked.shape[1] == wanted:
            return locked
        theta, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        order = np.argsort(-theta)
        theta, turn = theta[order], turn[:, order]
        space, image = space @ turn, image @ turn
        lead = theta[0]
        first = lead if first is None else max(first, lead)
        if lead <= 0 or lead <= first * ROUNDING:
            return locked  # nothing varies beside what is locked
        residual = image - space * theta
        sizes = np.linalg.norm(residual, axis=0)
        done = 0
        while (
            done < len(theta) and locked.shape[1] + done < wanted
            and sizes[done] <= tolerance * lead and theta[done] > 1e-3 * lead
        ):
            done += 1
        whole = space.shape[1] + locked.shape[1] == width
        if done == 0 and whole and sizes[0] <= 1e3 * tolerance * lead:
            done = 1  # the space has no direction left to add
        if done:
            locked = np.column_stack([locked, space[:, :done]])
            space = orthonormal(space[:, done:], locked)
            # Products start anew without the locked share, which may dwarf what is left.
            if locked.shape[1] < wanted:
                if not space.shape[1]:
                    space = orthonormal(draw.normal(size=(width, carried)), locked)
                if space.shape[1]:
                    image = product(space, locked)
                else:
                    return locked
            continue
        if space.shape[1] + carried > max(SPACE_BLOCKS * carried, 2 * carried) and not whole:
            space, image = space[:, :carried], image[:, :carried]
            theta, residual = theta[:carried], residual[:, :carried]
        ask = slice(0, min(carried, space.shape[1]))
        ritz = np.column_stack([locked, space[:, ask]])
        shifts = theta[ask]

        def corrected(t, ritz=ritz, shifts=shifts, locked=locked):
            t = t - ritz @ (ritz.T @ t)
            t = product(t, locked) - t * shifts
            return t - ritz @ (ritz.T @ t)

        right = -(residual[:, ask] - ritz @ (ritz.T @ residual[:, ask]))
        more = minres(corrected, right, INNER_STEPS, INNER_REDUCTION)
        basis = np.column_stack([locked, space])
        more = orthonormal(np.column_stack([more, right]), basis)[:, :carried]
        if more.shape[1] < min(carried, width - basis.shape[1]):
            # Corrections that the space holds already leave room for new directions.
            extra = draw.normal(size=(width, carried))
            more = np.column_stack([more, orthonormal(extra, np.column_stack([basis, more]))])
            more = more[:, : min(carried, width - basis.shape[1])]
        if more.shape[1]:
            space = np.column_stack([space, more])
            image = np.column_stack([image, product(more, locked)])
        else:
            image = product(space, locked)  # the whole space is searched: only rounding is left
    raise RuntimeError(f"{locked.shape[1]} of {wanted} components after {OUTER_STEPS} steps")


def integers(vectors: list, width: int) -> np.ndarray:
    """floor(64 * entry) + 1000000 of each vector, shorter ones filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    scaled = np.floor(SCALE * np.clip(out, -1e300, 1e300))
    beyond = np.abs(scaled) >= LARGEST - OFFSET
    x = np.where(beyond, 0, scaled).astype(np.int64) + OFFSET
    return np.where(beyond, np.where(scaled > 0, LARGEST, -LARGEST), x)


@dataclass(frozen=True)
class Fit:
    """The list the covariance is of: distinct integer vectors, n of them, with exact sums."""

    n: int
    width: int
    sums: tuple[int, ...]

    @property
    def origin(self) -> np.ndarray:
        """The whole numbers next to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part of the difference is exact, the fraction is small."""
        fraction = [s / self.n if abs(s) < 2**53 else float(s // self.n) + s % self.n / self.n
                    for s in (s - self.n * int(o) for s, o in zip(self.sums, self.origin, strict=True))]
        return (x - self.origin).astype(float) - np.array(fraction)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2, exact; None where no long holds it."""
        away = x - self.origin
        rest = [s - self.n * int(o) for s, o in zip(self.sums, self.origin, strict=True)]
        bound = int(np.abs(away).max(initial=0)) * self.n + max(map(abs, rest), default=0)
        if bound * bound * max(self.width, 1) < 2**63:
            d = away * self.n - np.array(rest, np.int64)
            return np.einsum("ij,ij->i", d, d).tolist()
        d = away.astype(object) * self.n - np.array(rest, object)
        exact = (d * d).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


def _packed(width: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of distinct vectors, and their exact sums as two halves of each number."""
    at_once = max(64, BLOCK_BYTES // (8 * max(width, 1)))
    for batch in batches:
        x = np.array(batch["x"].tolist(), np.int64).reshape(len(batch), width)
        for i in range(0, len(x), at_once):
            part = np.ascontiguousarray(x[i : i + at_once])
            high, low = part >> 31, part & 0x7FFFFFFF
            yield pd.DataFrame(
                [(len(part), part.tobytes(), high.sum(axis=0).tolist(), low.sum(axis=0).tolist())],
                columns=["n", "x", "high", "low"],
            )


def _summed(
    fit: Fit, work: Callable[[np.ndarray], np.ndarray], size: int, batches: Iterator[pd.DataFrame]
) -> Iterator[pd.DataFrame]:
    """What `work` makes of the centred rows of each block, summed over a task."""
    total = np.zeros(size)
    for batch in batches:
        for raw in batch["x"]:
            rows = fit.centred(np.frombuffer(raw, np.int64).reshape(-1, fit.width))
            total += work(rows).ravel()
    yield pd.DataFrame({"at": np.arange(size), "value": total})


def _over(blocks: DataFrame, fit: Fit, work, shape: tuple[int, int]) -> np.ndarray:
    """The sum of `work` over all rows: one number per place comes to the driver."""
    size = shape[0] * shape[1]
    parts = blocks.select("x").mapInPandas(
        lambda b: _summed(fit, work, size, b), "at int, value double"
    )
    out = np.zeros(size)
    for row in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[row["at"]] = row["value"]
    return out.reshape(shape)


def products(blocks: DataFrame, fit: Fit) -> Product:
    """Multiplies the covariance of the fit list by a block of directions, in one pass."""

    def product(block: np.ndarray, locked: np.ndarray) -> np.ndarray:
        def work(rows):
            rows = rows - (rows @ locked) @ locked.T
            return rows.T @ (rows @ block)

        return _over(blocks, fit, work, block.shape) / fit.n

    return product


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector: directions over the roots of their eigenvalues."""

    fit: Fit
    directions: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    def rows(self, vectors: list) -> tuple[list[int | None], np.ndarray]:
        x = integers(vectors, self.fit.width)
        projected = self.fit.centred(x) @ self.directions
        return self.fit.deviations(x), projected / np.sqrt(self.values)


def fit_list(embeddings: DataFrame, width: int) -> tuple[DataFrame, Fit]:
    """Written blocks of the distinct integer vectors of (embedding), and what they sum to."""

    def whole(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"x": integers(list(batch["embedding"]), width).tolist()})

    # Copies are folded where they stand before any of them moves.
    distinct = map_batches(embeddings.select("embedding"), whole, "x array<bigint>").distinct()
    blocks = stored(
        distinct.mapInPandas(
            lambda b: _packed(width, b), "n bigint, x binary, high array<bigint>, low array<bigint>"
        ),
        "fit-list",
    )
    n = blocks.agg(F.sum("n")).first()[0] or 0
    sums = [0] * width
    halves = blocks.select(F.posexplode(F.arrays_zip("high", "low")).alias("at", "half"))
    exact = [F.sum(F.col(f"half.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    for row in halves.groupBy("at").agg(*exact).collect():
        sums[row["at"]] = int(row["high"]) * 2**31 + int(row["low"])
    return blocks, Fit(n, width, tuple(sums))


def whitening(blocks: DataFrame, fit: Fit, components: int = COMPONENTS) -> Whitening | None:
    """The leading components of the fit list; None if nothing varies."""
    if fit.n < 2 or fit.width == 0:
        return None
    trace = _over(blocks, fit, lambda rows: (rows * rows).sum(keepdims=True), (1, 1))[0, 0] / fit.n
    if trace <= 0:
        return None
    found = jacobi_davidson(products(blocks, fit), fit.width, components, fit.n - 1)
    count = found.shape[1]

    def gram(rows, axes):
        shown = rows @ axes
        return np.column_stack([shown.T @ shown, shown.sum(axis=0)])

    # Rayleigh-Ritz over the projected rows themselves: exact relative to each component.
    among = _over(blocks, fit, lambda rows: gram(rows, found), (count, count + 1))[:, :-1] / fit.n
    roots = np.sqrt(np.maximum(np.diag(among), np.finfo(float).tiny))
    turn = _turned(among / np.outer(roots, roots), roots)
    axes = found @ turn
    axes /= np.linalg.norm(axes, axis=0)
    among = _over(blocks, fit, lambda rows: gram(rows, axes), (count, count + 1))[:, :-1] / fit.n
    values = np.diag(among)
    order = np.argsort(-values, kind="stable")
    order = order[values[order] > 0]
    axes, values = axes[:, order], values[order]
    white = axes / np.sqrt(values)
    shown = _over(blocks, fit, lambda rows: gram(rows, white), (len(order), len(order) + 1)) / fit.n
    mean = shown[:, -1]
    error = np.abs(shown[:, :-1] - np.outer(mean, mean) - np.eye(len(order))).max(initial=0.0)
    return Whitening(fit, axes, values, float(trace), float(error))


def _turned(correlation: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Rotations, two directions at a time, that take what is left between components to zero."""
    a = correlation * np.outer(roots, roots)
    turn = np.eye(len(roots))
    for _ in range(30):
        moved = False
        for i in range(len(roots)):
            for j in range(i + 1, len(roots)):
                if abs(a[i, j]) <= 1e-15 * np.sqrt(abs(a[i, i] * a[j, j])):
                    continue
                moved = True
                angle = 0.5 * np.arctan2(2 * a[i, j], a[i, i] - a[j, j])
                c, s = np.cos(angle), np.sin(angle)
                r = np.eye(len(roots))
                r[[i, j], [i, j]], r[i, j], r[j, i] = c, -s, s
                a, turn = r.T @ a @ r, turn @ r
        if not moved:
            break
    return turn


def _whitened(batch: pd.DataFrame, model: Whitening) -> pd.DataFrame:
    deviations, white = model.rows(list(batch["embedding"]))
    rows, count = len(batch), len(model.values)
    return pd.DataFrame(
        {
            "vec_id": np.repeat(batch["vec_id"].to_numpy(), count),
            "component": np.tile(np.arange(1, count + 1), rows),
            "n": model.fit.n,
            "deviation": pd.array(
                [d for d in deviations for _ in range(count)], dtype="Int64"
            ),
            "whitened": white.ravel(),
            "explained": np.tile(model.values / model.trace, rows),
            "identity_error": model.identity_error,
        }
    )


SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
    "explained double, identity_error double"
)


def whiten(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per usable vector and component: see SCHEMA.

    Null vectors and those with null or non-finite entries are left out. A shorter vector counts
    as filled up with zeros to the longest one. Repeated rows count once in the fit and each gets
    its rows; a null vec_id stays null. An entry whose integer would pass 2**62 counts as that much;
    a deviation that no long holds is null. There are as many components as have variance: at most
    `components`, the width, and one less than the distinct vectors; where nothing varies, and for
    an empty table, there are no rows. Components of equal eigenvalue are any basis of their space.
    Other columns are not read.
    """
    spark = embeddings.sparkSession
    vector = F.col(vector_column).cast("array<double>")
    rows = embeddings.select(
        F.col(id_column).cast("bigint").cast("string").alias("vec_id"), vector.alias("embedding")
    )
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    usable = rows.where(F.coalesce(F.col("embedding").isNotNull() & finite, F.lit(False)))
    width = usable.agg(F.max(F.size("embedding"))).first()[0]
    model = None
    if width:
        model = whitening(*fit_list(usable, width), components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], SCHEMA)
    out = map_batches(usable, _whitened, SCHEMA.replace("vec_id bigint", "vec_id string"), model)
    return out.withColumn("vec_id", F.col("vec_id").cast("bigint"))
