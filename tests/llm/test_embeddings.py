from __future__ import annotations

import math

import numpy as np
import pytest

from pyspark.sql import functions as F
from test_simhash import groups
from tieout.llm import embedding_dedup as E
from tieout.llm import topk

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep int"


def vectors(n=160, width=8, seed=1):
    draw = np.random.default_rng(seed)
    rows, at = [], 0
    for _ in range(n // 4):
        v = draw.normal(size=width)
        for k in range(4):
            w = v + draw.normal(size=width) * 0.13 * k
            rows.append((at, np.float32(w).tolist(), int(draw.integers(0, 2)), 1))
            at += 1
    return rows


ODD = [
    (900, None, 1, 1), (901, [0.0] * 8, 1, 1), (902, [1.0, None] + [0.0] * 6, 1, 1),
    (903, [float("nan")] + [1.0] * 7, 1, 1), (904, [float("inf")] + [1.0] * 7, 1, 1),
    (905, [1.0, 2.0], 1, 1), (906, [], 1, 1), (907, [1.0, 2.0], 1, 1), (908, [1e30] * 8, 0, 1),
    (909, [1e-30] * 8, 0, 1), (910, [1.0] * 8, None, 1), (911, [-0.0] * 7 + [3.0], 1, 1),
    (912, [0.0] * 7 + [4.0], 1, 1),
]


def usable(row):
    v = row[1]
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("tile_bytes", [1 << 20, 64 * 8])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, tile_bytes):
    monkeypatch.setattr(E, "TILE_BYTES", tile_bytes)
    rows = [*vectors(), *ODD]
    rows += [(500 + i, rows[3][1], rows[3][2], 1) for i in range(30)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = {r.vec_id: r for r in E.near_duplicates(frame).collect()}
    assert len(found) == len(rows)
    good = [(i, np.array(v, "f4").astype("f8"), lab) for i, v, lab, _ in rows if usable((i, v)) and lab is not None]
    unit = {i: v / np.abs(v).max() for i, v, _ in good}
    unit = {i: v / math.sqrt(v @ v) for i, v in unit.items()}
    linked = [
        (a, b) for a, _, x in good for b, _, y in good
        if a < b and x == y and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98
    ]
    count = {i: 0 for i in found}
    for a, b in linked:
        count[a] += 1
        count[b] += 1
    root = groups(set(found), linked)
    assert {i: r.n_links for i, r in found.items()} == count
    assert {i: r.component_id for i, r in found.items()} == root
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert len(linked) > 400 and count[905] == 1


def test_repeated_rows_null_ids_and_empty(spark):
    v = [1.0, 2.0, 3.0]
    frame = spark.createDataFrame([(1, v, 0, 1), (1, v, 0, 1), (None, v, 0, 1), (None, None, 0, 1)], SCHEMA)
    found = sorted(E.near_duplicates(frame).collect(), key=str)
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in found] == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, False)], key=str
    ) or {(r.vec_id, r.n_links, r.component_id, r.kept) for r in found} == {
        (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, False)
    }
    assert E.near_duplicates(frame.limit(0)).collect() == []


def scored(rows, k, is_query):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for p, (i, q) in enumerate(good):
        if not is_query(i):
            continue
        all_scores = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=True)), j)
            for n, (j, v) in enumerate(good) if n != p and len(v) == len(q)
        )
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(all_scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("page, block_rows", [(4, 50), (512, 8192)])
def test_top_k_against_all_scores(spark, monkeypatch, page, block_rows):
    monkeypatch.setattr(topk, "PAGE", page)
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(topk, "BALLS", 2)
    monkeypatch.setattr(topk, "PACKS", 3)
    monkeypatch.setattr(topk, "PIVOTS", 9)
    odd = [r for r in ODD if r[0] != 908]
    rows = [*vectors(), *odd, *[(1000 + i, vectors()[5][1], 0, 0) for i in range(20)]]
    rows.append(rows[0])  # a repeated row is a candidate of its like
    rows.append((None, rows[1][1], 0, 0))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = topk.top_k(frame, F.pmod("vec_id", F.lit(5)) == 0).collect()
    assert sorted(tuple(r) for r in found) == scored(rows, 5, lambda i: i % 5 == 0)


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0, 0.5], 0, 0), (3, [0.25, -1.0], 0, 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = topk.top_k(frame, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == scored(rows, 5, lambda i: i == 0)
    assert topk.top_k(frame.limit(0), F.col("vec_id") == 0).collect() == []


@pytest.mark.parametrize("page, block_rows", [(4, 30), (512, 8192)])
def test_top_k_with_huge_vectors_is_exact(spark, monkeypatch, page, block_rows):
    monkeypatch.setattr(topk, "PAGE", page)
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    rows = vectors()
    # Products over 2 ** 53 that differ by less than a double shows, and ties among them.
    rows += [(700 + i, [1e8, *[float(i % 3)] * 7], 0, 0) for i in range(6)]
    rows += [(710 + i, [0.0] * 7 + [3e6 + i / 4], 0, 0) for i in range(8)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = topk.top_k(frame, F.pmod("vec_id", F.lit(5)) == 0).collect()
    got = sorted(tuple(r) for r in found)
    top = 2**63 - 1
    full = scored(rows, 5, lambda i: i % 5 == 0)
    assert any(2**53 < s <= top for *_, s in full) and any(s > top for *_, s in full)
    # What a long holds is exact; what it does not is shown as the largest.
    assert [r for r in got if r[3] < top] == [r for r in full if r[3] <= top]
    assert {r[:2] for r in got} == {r[:2] for r in full}


def test_top_k_beyond_every_long(spark):
    rows = [(0, [1e30, 1.0], 0, 0), (1, [1e30, 0.0], 0, 0), (2, [-1e30, 0.0], 0, 0), (3, [2e30, 0.0], 0, 0)]
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in found] == [
        (0, 1, 3, 2**63 - 1), (0, 2, 1, 2**63 - 1), (0, 3, 2, -(2**63))
    ]


def test_balls_bound_every_score():
    r = np.random.default_rng(5)
    for scale in (1.0, 1e6, 1e150):
        balls = [r.normal(0, scale, (20, 6)) + r.normal(0, 3 * scale, 6) for _ in range(9)]
        centres = np.array([b.mean(axis=0) for b in balls])
        radii = np.array([np.sqrt(((b - c) ** 2).sum(axis=1)).max() for b, c in zip(balls, centres)])
        queries = r.normal(0, scale, (30, 6))
        bound = topk.most_in_balls(queries, centres, radii)
        scores = np.array([[(b @ q).max() for b in balls] for q in queries])
        assert (scores <= bound).all()


def test_blocks_are_left_out_by_their_balls(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "PIVOTS", 40)
    r = np.random.default_rng(2)
    centres = r.normal(0, 1, (8, 12)) * 6
    rows = [(i, (centres[i % 8] + r.normal(0, 0.05, 12)).tolist(), 0, 0) for i in range(800)]
    sent, written = [], topk.stored

    def kept(frame, name):
        out = written(frame, name)
        sent.extend([out] if name == "sent" else [])
        return out

    monkeypatch.setattr(topk, "stored", kept)
    found = topk.top_k(spark.createDataFrame(rows, SCHEMA).repartition(4), F.pmod("vec_id", F.lit(5)) == 0)
    assert sorted(tuple(x) for x in found.collect()) == scored(rows, 5, lambda i: i % 5 == 0)
    met = sent[0].select(F.sum(F.length("query_ids") / 8)).first()[0]
    blocks = sent[0].select("block").distinct().count()
    assert met < 160 * blocks / 2
