from __future__ import annotations

import random

import pytest
import xxhash

from tieout.llm import simhash as S
from tieout.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [
        xxhash.xxh64(" ".join(words[i : i + n]).encode(), seed=42).intdigest()
        for i in range(len(words) - n + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_near_duplicates_against_all_pairs(spark, documents):
    draw = random.Random(3)
    rows = [(None, "lonely row without id"), (90, None), (91, ""), (92, " \n"), (93, "One two"),
            (94, "ONE  two"), (95, "É\u00a0x y\x1cz")]
    for i in range(12):
        words = [draw.choice(WORDS) for _ in range(300)]
        for k in range(5):
            near = list(words)
            for _ in range(k // 2):
                near[draw.randrange(300)] = draw.choice(WORDS)
            rows.append((i * 5 + k, " ".join(near)))
    rows.append(rows[-1])
    found = S.near_duplicates(documents(rows)).collect()
    assert len(found) == len(rows)
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    assert sorted((r.doc_id or -1, int(r.fingerprint, 16)) for r in found) == sorted(
        (i or -1, p) for i, p in prints
    )
    known = [(i, p) for i, p in prints if i is not None]
    linked = [(a, b) for a, p in known for b, q in known if a < b and (p ^ q).bit_count() <= 2]
    expected = groups({i for i, _ in known}, linked)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == expected
    assert any(v != k for k, v in expected.items() if k < 60)


def test_long_text_and_empty_table(spark, documents):
    text = " ".join(f"v{i % 977}" for i in range(150_000))
    (row,) = S.near_duplicates(documents([(5, text)])).collect()
    assert int(row.fingerprint, 16) == plain_fingerprint(text) and row.component_id == 5
    assert S.near_duplicates(documents([])).collect() == []


@pytest.mark.parametrize("distance, segments", [(0, 2), (2, 2), (3, 2), (5, 4), (2, 3)])
def test_balls_miss_no_pair(spark, distance, segments):
    draw = random.Random(distance)
    values = set()
    for _ in range(40):
        v = draw.getrandbits(64)
        for k in range(distance + 2):
            w = v
            for b in draw.sample(range(64), k):
                w ^= 1 << b
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    found = {(r.a, r.b) for r in S.links(frame, distance, segments).collect()}
    mask = (1 << 64) - 1
    assert found == {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= distance
    }


def test_components_of_chains_stars_and_nulls(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rows = [*chain, *star, (7, 7), (None, 3), (2000, None), (1000, 1001)]
    frame = spark.createDataFrame(rows, "a bigint, b bigint").repartition(7)
    found = {r.node: r.component for r in components(frame).collect()}
    assert found == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components(frame.limit(0)).collect() == []
