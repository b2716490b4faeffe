from __future__ import annotations

import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
from test_simhash import groups, plain_fingerprint
from test_texts import removed
from pyspark.sql import functions as F

from tieout.llm import language_id, packing, quality
from tieout.llm.queries import BYTE_RANKS

FOLDER = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns and docs.dtypes == before.dtypes
        kept[name] = (before.collect(), docs.collect())
    before, after = kept["simhash_near_dedup"]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in before}
    stay = {r.doc_id for r in after}
    for i, p in prints.items():
        near = [j for j, q in prints.items() if (p ^ q).bit_count() <= 2 and j < i]
        assert bool(near) == (i not in stay) or i not in stay
    before, after = kept["substring_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before)
    plain = removed(rows)
    after = {r.doc_id: r for r in after}
    for n, (i, text) in enumerate(rows):
        expected = plain[n][2] if plain[n][1] else text
        assert after[i].text == expected and after[i].n_chars == len(expected)
    packed = corpus_pipeline.pack_sequences(spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == len(after)


def test_odd_rows_pass_through(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(
        [(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "123 456", "en", "s", 7),
         (None, docs.first().text, "en", "s", 1)], docs.schema,
    )
    both = docs.unionByName(odd).unionByName(docs.limit(1))
    found = corpus_pipeline.identify_language(spark, both, FOLDER)
    assert {r.doc_id for r in found.where(F.col("doc_id") > 9000).collect()} == set()
    assert found.count() >= docs.count() - 1
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, both.limit(0), FOLDER).count() == 0


def test_languages_that_nobody_taught_go(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    strange = [
        "这是一个完全不同的语言的文本,我们没有学习过它。" * 5, "быстрая коричневая лиса прыгает " * 4,
        "xkcd bcdf ghjkl mnpqr stvwx zbcdf " * 8, "日本語の文章です。学習していません。" * 6,
    ]
    odd = spark.createDataFrame(
        [(90_000 + i, t, None, "s", len(t)) for i, t in enumerate(strange)], docs.schema
    )
    found = corpus_pipeline.identify_language(spark, docs.unionByName(odd), FOLDER)
    kept = {r.doc_id for r in found.select("doc_id").collect()}
    assert not kept & {90_000 + i for i in range(len(strange))}
    good = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1")
    clean = {r.doc_id for r in good.collect()}
    assert len(clean - kept) <= 0.005 * len(clean)


def test_one_row_of_each_group_of_near_copies(spark, documents):
    base = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").take(12)]
    rows = [(i, t) for i, t in enumerate(base[:5])]
    rows += [(0, base[0])] * 3 + [(2, base[2].upper())]  # repeated rows
    rows += [(3, base[6]), (3, base[6]), (3, base[1])]  # an id with texts of its own and of a smaller id
    rows += [(None, base[4]), (None, base[7]), (None, base[7]), (None, base[8]), (None, base[4])]
    rows += [(20, base[8]), (21, base[9]), (20, base[9]), (22, None), (23, ""), (None, " ")]
    docs = documents(rows)
    prints = [plain_fingerprint(t) for _, t in rows]
    linked = [(a, b) for a, p in enumerate(prints) for b, q in enumerate(prints) if a < b and (p ^ q).bit_count() <= 2]
    group = groups(range(len(rows)), linked)
    expected = []
    for g in set(group.values()):
        ids = [rows[n][0] for n in group if group[n] == g]
        least = min((i for i in ids if i is not None), default=None)
        expected.append((least, g))
    found = corpus_pipeline.drop_near_copies(spark, docs, FOLDER)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    by_print = {plain_fingerprint(t): g for (_, t), g in zip(rows, (group[n] for n in range(len(rows))), strict=True)}
    got = [(r.doc_id, by_print[plain_fingerprint(r.text)]) for r in found.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert sum(i is None for i, _ in got) == 1 and sum(i == 3 for i, _ in got) == 2


def test_run_against_brute_force_of_every_stage(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    frame, rows = docs, [tuple(r) for r in docs.collect()]
    at = {c: k for k, c in enumerate(docs.columns)}
    i, t = at["doc_id"], at["text"]

    def languages(rows):
        model = language_id.train(frame)
        judged = language_id.predict(frame, model, foreign_column="foreign").collect()
        return [tuple(r[c] for c in docs.columns) for r in judged
                if r.lang_pred != language_id.UNDETERMINED and r.score >= 0.5 and not r.foreign]

    def qualities(rows):
        model = quality.train(frame, spark.read.parquet(f"{FOLDER}/labels.parquet"))
        return [r for r in rows if model.score(r[t]) >= 0.5]

    def firsts(rows):
        prints = [plain_fingerprint(r[t]) for r in rows]
        linked = [(a, b) for a, p in enumerate(prints) for b, q in enumerate(prints)
                  if a < b and (p ^ q).bit_count() <= 2]
        group, best = groups(range(len(rows)), linked), {}
        for n, r in enumerate(rows):
            best[group[n]] = min(best.get(group[n], r), r, key=lambda r: r[i])
        return list(best.values())

    def unrepeated(rows):
        rows = sorted(rows, key=lambda r: r[i])
        out = []
        for n, (_, gone, left) in removed([(r[i], r[t]) for r in rows]).items():
            r = list(rows[n])
            if gone:
                r[t], r[at["n_chars"]] = left, len(left)
            out.append(tuple(r))
        return out

    expected = [languages, qualities, firsts, unrepeated]
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], expected, strict=True):
        rows = plain(rows)
        frame = stage(spark, frame, FOLDER).cache()
        assert rows and Counter(map(tuple, frame.collect())) == Counter(rows), name
    pieces = Counter()
    for r in rows:
        ids = packing.token_ids(r[t], BYTE_RANKS, public_tokenizers.PATTERN)
        for k, (s, n) in enumerate(packing.cut(len(ids))):
            pieces[(r[i], k, s, n, zlib.crc32(ids[s : s + n].tobytes()))] += 1
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces
