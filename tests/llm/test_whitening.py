from __future__ import annotations

import math

import numpy as np
import pytest

from tieout.llm import whitening as W

SCHEMA = "vec_id bigint, embedding array<float>, label int, n long, component int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def expected(rows, count=16):
    """By forming the covariance: integer vectors by row, directions, eigenvalues, trace."""
    width = max((len(v) for _, v in rows if usable(v)), default=0)
    full = [[*v, *[0.0] * (width - len(v))] for _, v in rows if usable(v)]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in full]
    fit = np.array(sorted(set(map(tuple, x))), float)
    z = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(z.T @ z / len(z))
    return x, len(z), values[::-1][:count], axes[:, ::-1][:, :count], values.sum()


def check(found, rows, count=16, distinct_values=True):
    x, n, values, axes, trace = expected(rows, count)
    values = values[values > 1e-9 * values[0]]
    sums = [sum(c) for c in zip(*set(map(tuple, x)))]
    assert len(found) == len(x) * len(values)
    by_row = sorted(found, key=lambda r: (r.vec_id, r.component))
    ids = [i for i, v in rows if usable(v)]
    place = sorted(range(len(x)), key=lambda k: ids[k])
    white = np.array([r.whitened for r in by_row]).reshape(len(x), len(values))
    for k, at in enumerate(place):
        part = by_row[k * len(values) : (k + 1) * len(values)]
        assert {r.vec_id for r in part} == {ids[at]}
        assert [r.component for r in part] == list(range(1, len(values) + 1))
        exact = sum((n * c - s) ** 2 for c, s in zip(x[at], sums))
        assert {r.deviation for r in part} == {exact if exact < 2**63 else None}
        assert {r.n for r in part} == {n}
        assert np.allclose([r.explained for r in part], values / trace, rtol=1e-6)
        assert len({r.identity_error for r in part}) == 1 and part[0].identity_error < 1e-9
    if distinct_values:
        z = np.array([x[at] for at in place], float) - np.array(sums) / n
        own = z @ axes[:, : len(values)] / np.sqrt(values)
        sign = np.sign((own * white).sum(axis=0))
        assert np.allclose(own * sign, white, atol=1e-5)
    first = {}
    for k, at in enumerate(place):
        first[tuple(x[at])] = white[k]
    fit = np.array(list(first.values()))
    assert np.allclose(np.cov(fit.T, bias=True), np.eye(len(values)), atol=1e-8)


def vectors(n, width, seed=1, sizes=None):
    draw = np.random.default_rng(seed)
    sizes = np.linspace(2, 0.2, width) if sizes is None else sizes
    return [(i, np.float32(draw.normal(size=width) * sizes).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 5, 9) for i, v in rows], SCHEMA).repartition(3)


ODD = [
    (900, None), (901, [0.0] * 24), (902, [1.0, None] + [0.0] * 22), (903, [float("nan")] + [1.0] * 23),
    (904, [float("inf")] + [1.0] * 23), (905, [1.0, 2.0]), (906, []), (907, [-1.0] * 24), (908, [-1.0] * 24),
]


def test_against_the_formed_covariance(spark):
    rows = [*vectors(150, 24), *ODD] + [(700 + k, vectors(150, 24)[3][1]) for k in range(40)]
    found = W.whiten(frame(spark, rows))
    assert found.columns == "vec_id component n deviation whitened explained identity_error".split()
    check(found.collect(), rows)


def test_fewer_vectors_than_components_and_flat_directions(spark):
    few = vectors(6, 24)
    check(W.whiten(frame(spark, few)).collect(), few)
    flat = vectors(80, 8, sizes=np.array([3, 2, 1.5, 1, 0, 0, 0, 0]))
    check(W.whiten(frame(spark, flat)).collect(), flat)


def test_an_outlier_leaves_the_other_components_right(spark):
    rows = [*vectors(100, 12), (500, [1e8, *[0.25] * 11])]
    found = W.whiten(frame(spark, rows)).collect()
    # The outlier's deviation does not fit a long; the rest is as exact as ever.
    values = {r.component: r.explained for r in found}
    x, n, *_ = expected(rows)
    z = np.array([v for v in x if v[0] < 10**8], float)[:, 1:]
    assert len(values) == 12 and values[1] > 0.999999
    rest = np.linalg.eigvalsh(np.cov(z.T, bias=True))[::-1] * len(z) / n
    shares = np.array([values[k] for k in range(2, 13)])
    # Along its own line the outlier swallows one direction; the ten or so others keep their ratios.
    assert np.allclose(shares / shares[0], rest / rest[0], rtol=0.05)
    assert {r.identity_error < 1e-4 for r in found} == {True}
    assert {r.deviation for r in found if r.vec_id == 500} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])] * 3, [(None, [])]])
def test_nothing_varies(spark, rows):
    found = W.whiten(frame(spark, rows))
    assert found.collect() == [] and "vec_id bigint" in found._jdf.schema().toDDL().lower()


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (4, [0.5, 0.25])]
    found = W.whiten(frame(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.component) for r in found) == sorted(
        (str(i), c) for i, _ in rows for c in (1, 2)
    )
    assert {r.n for r in found} == {3}


def test_huge_entries_are_held_at_the_bound():
    x = W.integers([[1e300, -1e300, 0.5], [2.0]], 3)
    assert x.tolist() == [[2**62 - 1, 1 - 2**62, 1_000_032], [1_000_128, 1_000_000, 1_000_000]]
    fit = W.Fit(2, 3, tuple(int(a) + int(b) for a, b in zip(*x.tolist())))
    assert fit.deviations(x) == [None, None]
    assert np.isfinite(fit.centred(x)).all()


# ---- the solver alone


def solved(z, count, **options):
    n, passes = len(z), []

    def product(block, locked):
        passes.append(block.shape[1])
        rows = z - (z @ locked) @ locked.T
        return rows.T @ (rows @ block) / n

    return W.jacobi_davidson(product, z.shape[1], count, n - 1, **options), len(passes)


@pytest.mark.parametrize("width, n", [(1, 5), (3, 50), (40, 500), (150, 900), (260, 900)])
def test_residuals_are_rounding(width, n):
    draw = np.random.default_rng(width)
    z = draw.normal(size=(n, width)) * np.linspace(1, 3, width)
    z -= z.mean(axis=0)
    axes, passes = solved(z, 16)
    covariance = z.T @ z / n
    values, true = np.linalg.eigh(covariance)
    count = min(16, width)
    assert axes.shape == (width, count)
    own = np.einsum("ij,ij->j", axes, covariance @ axes)
    assert np.allclose(own, values[::-1][:count], rtol=1e-12)
    assert np.abs(covariance @ axes - axes * own).max() < 1e-12 * values[-1]
    assert np.allclose(np.abs(np.einsum("ij,ij->j", axes, true[:, ::-1][:, :count])), 1, atol=1e-9)
    assert passes < 150


def test_equal_eigenvalues():
    z = np.vstack([np.eye(30), -np.eye(30)])
    axes, _ = solved(z, 16)
    assert axes.shape == (30, 16) and np.allclose(axes.T @ axes, np.eye(16), atol=1e-12)


def test_minres_solves_indefinite_systems_side_by_side():
    draw = np.random.default_rng(2)
    q, _ = np.linalg.qr(draw.normal(size=(12, 12)))
    a = q @ np.diag([5.0, 4, 3, 2, 1, 0.5, -0.5, -1, -2, -3, -4, -6]) @ q.T
    right = draw.normal(size=(12, 3))
    right[:, 1] = 0
    t = W.minres(lambda t: a @ t, right, 40, 1e-14)
    assert np.allclose(a @ t, right, atol=1e-8) and not t[:, 1].any()
