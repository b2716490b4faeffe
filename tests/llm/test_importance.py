from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tieout.llm import importance as I

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    None, "", " ,.;", "a", "A a", "ÀÉ ÀÉ wörld's 日本語", "x1 2y_3", "b" * 3000 + " " + "c" * 512,
    "same " * 4000, "\x7f\x80q", "Ab[cd]{ef}",
]


def runs(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def expected(docs, target, percent=25, min_words=20, buckets=10_000):
    """Rows without rank, and ranks by (doc_id, score)."""
    at = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(at, runs(text)[1]))
    for text in target:
        t.update(map(at, runs(text)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(
        1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))
    )
    rows = []
    for i, text in docs:
        n, f = runs(text)
        weight = sum(gain(at(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(f), weight, score, n >= min_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = order[: percent * len(order) // 100]
    return Counter(r[:4] for r in rows), [(r[0], r[3]) for r in drawn]


def prose(n, seed, words=40):
    draw = random.Random(seed)
    return [" ".join(f"{draw.choice('aBcé')}{draw.randrange(60)}" for _ in range(draw.randrange(words))) for _ in range(n)]


def check(found, docs, target, **options):
    rows, order = expected(docs, target, **options)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in found) == rows
    drawn = sorted((r for r in found if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, len(order) + 1))
    assert [(r.doc_id, r.score) for r in drawn] == order


def test_crcs_of_every_length_are_the_common_ones():
    draw = random.Random(4)
    sizes = [0, 1, 255, 256, 257, 511, 512, 513, 4096, 5000, *(draw.randrange(900) for _ in range(300))]
    values = [draw.randbytes(n) for n in sizes] + [b"\0" * 600, b"\xff" * 256]
    assert I.crc32s(values).tolist() == [zlib.crc32(v) for v in values]
    assert I.crc32s([]).tolist() == []


@pytest.mark.parametrize("buckets", [10_000, 37])
def test_against_brute_force(spark, documents, buckets):
    docs = [*enumerate([*ODD, *prose(250, 1)])]
    # Repeated rows, shared ids, null ids; copies of one id share their score.
    docs += [(20, docs[20][1])] * 9 + [(None, t) for t in prose(9, 2, 60)] + [(21, "another " * 30)]
    target = [*prose(20, 3), None, "", "wörld same"]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "doc_id int, text string")
    found = I.resample(documents(docs), frame, buckets=buckets)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    check(found.collect(), docs, target, buckets=buckets)


def test_empty_tables(spark, documents):
    docs = list(enumerate(prose(30, 5, 50)))
    nothing = spark.createDataFrame([], "text string")
    check(I.resample(documents(docs), nothing).collect(), docs, [])
    assert I.resample(documents([]), nothing).collect() == []
    short = [(1, "a b"), (2, None)]
    check(I.resample(documents(short), nothing).collect(), short, [])


def test_other_shares_and_no_least_length(spark, documents):
    docs = [*enumerate([*ODD, *prose(40, 6)])]
    frame = spark.createDataFrame([("a1 B2",)], "text string")
    found = I.resample(documents(docs), frame, percent=100, min_words=0).collect()
    check(found, docs, ["a1 B2"], percent=100, min_words=0)


def test_ranks_of_one_score_spread_over_partitions(spark):
    rows = spark.range(3000).selectExpr("id AS row_id", "7L AS doc_id", "1L AS score")
    found = I.ranked(rows.repartition(6)).collect()
    assert sorted((r["rank"], r.row_id) for r in found) == [(k + 1, k) for k in range(3000)]


def test_long_texts_in_slices(monkeypatch):
    texts = [*ODD, *prose(5, 7)]
    whole = [x.tolist() for x in I.features(texts)]
    cut = I.slices
    monkeypatch.setattr(I, "slices", lambda raw: cut(raw, 5))
    assert [x.tolist() for x in I.features(texts)] == whole
