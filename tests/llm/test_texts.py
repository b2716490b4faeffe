from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tieout.llm import language_id, packing, quality, substring_dedup, word_bpe
from tieout.llm.queries import BYTE_RANKS, WORD_VOCABULARY

STRANGE = [
    None, "", " \n\t", "a", "Hello, ÀÉ wörld! it's", "x<|endoftext|>  y<|startoftext|>z<|endoftext",
    "aaaa aaaaaaa a", "12²½ Ⅻ _a__b_", "ΣΑΣ 日本語 नमस्ते 👩‍👩‍👧", "e\u0301 \ufb01 \x1cq\x85r", "İstanbul ŉ",
    "don't we'll I'M", "https://x.example/?a=1&b=%20", "word " * 3000,
]


def prose(n, seed, words=60):
    draw = random.Random(seed)
    return [" ".join(f"{draw.choice('abcde')}{draw.randrange(900)}" for _ in range(words)) for _ in range(n)]


# ---- word BPE


def test_word_bpe_is_the_library(spark, documents):
    rows = list(enumerate([*STRANGE, *prose(30, 1)]))
    own = Tokenizer.from_file(WORD_VOCABULARY)
    found = {r.doc_id: r for r in word_bpe.digests(documents(rows), WORD_VOCABULARY).collect()}
    ids = {r.doc_id: r for r in word_bpe.encode(documents(rows), WORD_VOCABULARY).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        e = own.encode(text or "", add_special_tokens=False).ids
        shown = own.decode(e, skip_special_tokens=False)
        assert ids[i].ids == e and ids[i].decoded == shown, text
        assert found[i].n_tokens == len(e)
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()
    assert word_bpe.digests(documents([]), WORD_VOCABULARY).collect() == []


def test_word_bpe_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(word_bpe, "REMEMBERED", 20)
    monkeypatch.setattr(word_bpe, "CHARS_AT_ONCE", 200)
    monkeypatch.setattr(word_bpe, "WORDS_AT_ONCE", 5)
    texts = [*STRANGE, *prose(20, 2)]
    own = Tokenizer.from_file(WORD_VOCABULARY)
    found = list(word_bpe.Coder(WORD_VOCABULARY).code(texts))
    assert [f[0].tolist() for f in found] == [
        own.encode(t or "", add_special_tokens=False).ids for t in texts
    ]


# ---- packing


def test_packing_holds_every_token_once(spark, documents, monkeypatch):
    monkeypatch.setattr(packing, "EPOCHS", 2)
    rows = [*enumerate([*STRANGE, *prose(150, 3, 90), *prose(20, 4, 700)]), (3, "a"), (None, "null id")]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packing.pack(
        documents(rows), BYTE_RANKS, public_tokenizers.PATTERN, island_pieces=60
    ).collect()
    expected = defaultdict(int)
    for i, text in rows:
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        n = len(ids)
        first = n if n <= 1024 else (n % 1024 or 1024)
        edges = [0, *range(first, n + 1, 1024)]
        for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            expected[(i, k, a, b - a, zlib.crc32(raw[4 * a : 4 * b]))] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in found:
        got[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == expected
    for places in sequences.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= 1024
    bound = -(-sum(r.length for r in found) // 1024)
    assert len(sequences) <= bound + 8  # four islands
    empty = packing.pack(documents([]), BYTE_RANKS, public_tokenizers.PATTERN)
    assert empty.collect() == []


def test_packing_of_long_whitespace(spark, documents):
    n = 1_010_000
    texts = [f"a{' ' * n}b<|endoftext|> c", f"{chr(10) * n}x", "y" + "\t \u00a0" * (n // 3), "x" + " " * 99_999 + "y"]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packing.pack(documents(list(enumerate(texts))), BYTE_RANKS, public_tokenizers.PATTERN)
    got = {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in found.collect()}
    expected = {}
    for i, text in enumerate(texts):
        ids = [*own.encode(text, add_special_tokens=False).ids, 2]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        for s, k in packing.cut(len(ids)):
            expected[(i, s)] = (k, zlib.crc32(raw[4 * s : 4 * (s + k)]))
    assert got == expected


def test_evolution_is_never_worse_than_best_fit():
    draw = random.Random(5)
    for seed in range(6):
        sizes = [draw.choice((draw.randrange(1, 1024), draw.randrange(300, 600))) for _ in range(120)]
        plain = packing.Packing(sizes, 1024).best_fit(list(range(120)))
        best = packing.evolve(sizes, [], [[512, 512]], seed)
        assert sorted(i for g in best.groups for i in g) == list(range(120))
        assert all(sum(sizes[i] for i in g) == f <= 1024 for g, f in zip(best.groups, best.fill, strict=True))
        assert len(best.groups) <= len(plain.groups)


# ---- substring removal


def removed(rows, window=20):
    """Brute force over all windows, in the order of (doc_id, place in the input)."""
    words = [(float("inf") if i is None else i, n, substring_dedup.words_of(t)) for n, (i, t) in enumerate(rows)]
    seen, out = set(), {}
    for _, n, line in sorted(words, key=lambda x: x[:2]):
        gone = set()
        for s in range(len(line) - window + 1):
            phrase = tuple(line[s : s + window])
            if phrase in seen:
                gone.update(range(s, s + window))
            seen.add(phrase)
        out[n] = (len(line), len(gone), b" ".join(w for k, w in enumerate(line) if k not in gone).decode())
    return out


@pytest.mark.parametrize("block, indexed", [(4_000_000, 200_000), (300, 200_000), (300, 3)])
def test_removal_against_all_windows(spark, monkeypatch, block, indexed):
    from tieout.llm import common

    monkeypatch.setattr(common.blocks, "__defaults__", (block,))
    monkeypatch.setattr(substring_dedup, "INDEXED", indexed)
    draw = random.Random(7)
    base = prose(8, 6, 120)
    passages = [p.split()[20:75] for p in base]
    rows = list(enumerate(base))
    for i in range(8, 40):
        words = prose(1, 100 + i, 50)[0].split()
        for _ in range(draw.randrange(0, 3)):
            part = draw.choice(passages)
            a = draw.randrange(0, 30)
            words[draw.randrange(50):0] = part[a : a + draw.randrange(15, 40)]
        rows.append((i, "\n".join(words)))
    rows += [(3, base[3]), (50, base[0]), (50, base[0]), (60, " ".join(passages[1] * 3)), (61, "z " * 200),
             (62, None), (63, ""), (64, "few words"), (None, base[2]), (65, " ".join(["é\u00a0à"] * 19))]
    full = [(i, t, "en", "x", n) for n, (i, t) in enumerate(rows)]
    frame = spark.createDataFrame(full, "doc_id bigint, text string, lang string, uid string, ord int")
    frame = frame.coalesce(1)  # rows of one id in the order of the list
    found = substring_dedup.deduplicate(frame)
    assert found.columns == [*frame.columns, "n_words", "n_removed", "kept"]
    got = {r.ord: (r.n_words, r.n_removed, r.kept) for r in found.collect()}
    assert got == removed(rows)
    hashed = {r.ord: r.kept for r in substring_dedup.deduplicate(frame, keep_text=False).collect()}
    assert hashed == {n: hashlib.sha256(k.encode()).hexdigest() for n, (_, _, k) in got.items()}
    assert substring_dedup.deduplicate(frame.limit(0)).collect() == []


def test_factors_are_greedy_and_meet_at_boundaries():
    def letters(text):
        return [c.encode() for c in text]

    reference = substring_dedup.Reference(4, None)
    assert reference.factors(letters("abcdefgh")) == ([], [])
    assert reference.factors(letters("efghijkl")) == ([(0, 4)], [])
    # Two factors that overlap: the phrase "efgh" ends one, "fghi" begins in the other piece.
    assert reference.factors(letters("cdefghijk")) == ([(0, 6), (3, 6)], [])
    assert reference.factors(letters("xabcx")) == ([], [])
    assert reference.factors(letters("zzzzzz")) == ([(1, 5)], [])
    full = substring_dedup.Reference(4, 2)
    assert full.factors(letters("abcdefg")) == ([], [2, 3])
    assert full.factors(letters("abcdefg")) == ([(0, 7)], [])


def test_phrases_with_one_hash_are_told_apart(monkeypatch):
    rows = [(i, " ".join(f"{c}{n}" for n in range(30))) for i, c in enumerate("abcab")]
    whole = substring_dedup.Block.rolled

    def clash(self, size, seed):
        return np.full_like(whole(self, size, seed), 7)

    frames = pd.DataFrame({
        "uid": range(5), "ord": range(5), "text": [t for _, t in rows], "places": [list(range(23))] * 5,
    })
    monkeypatch.setattr(substring_dedup.Block, "rolled", clash)
    pieces = pd.concat(substring_dedup._pieces(20, 8, iter([frames])))
    together = pieces.sort_values(["key", "ord", "uid", "start"])
    spans = pd.concat(substring_dedup._parsed(20, None, iter([together])))
    gone = {}
    for r in spans.itertuples():
        gone.setdefault(r.uid, set()).update(range(r.start, r.start + r.size))
    assert gone == {3: set(range(30)), 4: set(range(30))}


# ---- language and quality


def test_code_lengths_are_a_distribution(spark, documents):
    frame = spark.createDataFrame(
        [(i, t, "xy"[i % 2]) for i, t in enumerate([*prose(30, 8), "é à ü"])],
        "doc_id bigint, text string, lang string",
    )
    model = language_id.train(frame, max_order=2, max_contexts=300)
    _, _, bits = model.tables()
    probability = 2.0 ** -bits.reshape(len(model.contexts), -1, 2).astype("f8")
    kinds = probability.shape[1] - 2
    # Seen symbols, and each of the bytes never seen, which share one length.
    total = probability[:, 2:].sum(axis=1) + probability[:, 1] * (256 - kinds)
    assert abs(total - 1).max() < 1e-4
    whole = model.code_lengths([b"abc a1", b"", b"\xff\x00zz", b"abc a1"])
    one = model.code_lengths([b"abc a1"])
    assert abs(whole[0] - one[0]).max() < 1e-6 and abs(whole[3] - one[0]).max() < 1e-6
    assert (whole[1] == 0).all() and (whole[2] > 0).all()


def test_long_texts_in_parts(spark, monkeypatch):
    frame = spark.createDataFrame([(1, "ab ba abba", "x"), (2, "cd dc cddc", "y")], "doc_id bigint, text string, lang string")
    model = language_id.train(frame)
    texts = [b"abba cd", b"", b"dcba" * 40, b"a", b""]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(language_id, "_POSITIONS", 5)
    assert abs(model.code_lengths(texts) - whole).max() < 1e-4


def test_language_edges(spark, documents):
    rows = [(1, "the of and the", "en", 1), (2, "der die das und", "de", 1), (3, None, "de", 1),
            (4, "12 + 3", "en", 1), (None, "the and of", None, 1), (1, "the of and the", "en", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, _x int")
    model = language_id.train(frame)
    found = {(r.doc_id, r.text): r for r in language_id.predict(frame, model).collect()}
    assert found[(1, "the of and the")].lang_pred == "en" and found[(2, "der die das und")].lang_pred == "de"
    assert found[(None, "the and of")].lang_pred == "en"
    assert found[(3, None)].lang_pred == found[(4, "12 + 3")].lang_pred == "und"
    assert all(0 <= r.score <= 1 for r in found.values())
    nothing = language_id.train(frame.limit(0))
    assert {r.lang_pred for r in language_id.predict(frame, nothing).collect()} == {"und"}
    assert language_id.predict(frame.limit(0), model).count() == 0


def test_a_bounded_sample_has_one_text_of_each_id(spark):
    rows = [(i, f"text {i}", "en", 1) for i in range(400)] + [(7, f"again {k}", "en", 1) for k in range(500)]
    rows += [(None, f"no id {k}", "en", 1) for k in range(300)] + [(i, "der die", "de", 1) for i in range(9)]
    rows += [(900, None, "en", 1), (901, "x", None, 1), (902, "", "en", 1)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, _x int").repartition(5)
    for bound in (20, 150, 5000):
        found = language_id.sample(frame, bound).collect()
        ids = [r.doc_id for r in found if r.lang == "en"]
        assert len(ids) == len(set(ids)) == min(bound, 401) and None not in ids
        assert sorted(r.doc_id for r in found if r.lang == "de") == list(range(9))
        assert {r.text for r in found if r.lang == "en" and r.doc_id == 7} <= {"again 0"}
    assert sorted(r.doc_id for r in language_id.sample(frame, 20).collect()) == sorted(
        r.doc_id for r in language_id.sample(frame.repartition(2), 20).collect()
    )


def plain_chance(counts, context, b):
    """Chance of a byte after a context, shorter ones asked for what it has not seen."""
    here = counts[context]
    total, kinds = sum(here.values()), len(here)
    if b in here:
        return here[b] / (total + kinds)
    escape = kinds / (total + kinds) if kinds else 1.0
    if not context:
        return escape / max(1, 256 - kinds)
    left = 1.0 - sum(plain_chance(counts, context[1:], x) for x in here)
    return escape * plain_chance(counts, context[1:], b) / left


@pytest.mark.parametrize("order", [0, 1, 3])
def test_code_lengths_against_plain_matching(spark, order):
    taught = ["abracadabra", "abra", "cabbage d", "ééa"]
    frame = spark.createDataFrame([(t, "x") for t in taught], "text string, lang string")
    model = language_id._learn(frame, ["x"], order, 10_000)
    for text in ("abracadabra", "zab", "cabé", "a", "ddd", "bage ü"):
        raw = text.encode()
        chances, context = 0.0, b""
        for i, b in enumerate(raw):
            context = raw[max(0, i - order) : i]
            counts = defaultdict(lambda: defaultdict(int))
            for line in map(str.encode, taught):
                for j, c in enumerate(line):
                    for k in range(min(j, order) + 1):
                        counts[line[j - k : j]][c] += 1
            while context and context not in counts:
                context = context[1:]
            chances -= math.log2(plain_chance(counts, context, b))
        (found,) = model.code_lengths([raw])
        assert found[0] == pytest.approx(chances, rel=1e-4)


def test_each_language_keeps_contexts_of_its_own(spark):
    big = ["the quick brown fox jumps over the lazy dog again and again " * 20] * 40
    rows = [(i, t, "en", 1) for i, t in enumerate(big)] + [(100 + i, "żółć gęślą jaźń", "pl", 1) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, _x int")
    model = language_id.train(frame, max_contexts=40)
    assert sum("ż".encode()[:1] in c for c in model.contexts) > 0
    assert len(model.contexts) <= 41


def test_held_out_language(spark):
    from __spark_entry__ import queries

    folder = "/root/testdata/sf0.01"
    found = queries()["op1_language_id"](spark, folder).where("held_out")
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows) > 100


def test_held_out_quality(spark):
    from __spark_entry__ import queries

    folder = "/root/testdata/sf0.01"
    found = queries()["op5_quality_classifier"](spark, folder).where("held_out")
    truth = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = found.join(truth, "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum(g > b for g in good for b in bad) > 0.93 * len(good) * len(bad) > 1000


def test_quality_edges(spark, documents):
    frame = documents([(i, "good words here" if i % 2 else "bad !! bad !!") for i in range(40)] + [(41, None), (None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(0, None), (None, 1), (5, 7)], "doc_id bigint, quality int")
    model = quality.train(frame, labels)
    found = {r.doc_id: r.score for r in quality.score(frame, model).collect()}
    assert found[1] > 0.5 > found[0] and 0 <= found[41] <= 1 and len(found) == 42
    assert quality.score(frame.limit(0), model).count() == 0
    alone = quality.train(frame, labels.where("quality = 1"))
    assert quality.Model.score(alone, "x") > 0.5
    assert quality.Model.score(quality.train(frame, labels.limit(0)), "") == 0.5


def test_copies_of_a_document_teach_once(spark, documents):
    rows = [(i, "good words here" if i % 2 else "bad !! bad !!") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    plain = quality.train(documents(rows), labels)
    copied = quality.train(documents(rows + [rows[7]] * 500), labels)
    assert plain.bias == copied.bias and (plain.weights == copied.weights).all()
    # Other texts of one id are no more examples either, and the bound holds.
    many = documents(rows + [(8, f"text {n}") for n in range(300)] + [(9, None)])
    found = quality.examples(many, labels)
    assert found.count() == found.select("place").distinct().count() == 40
    assert quality.examples(many, labels, 11).count() == 11


def test_sample_is_sought_by_many_tasks(spark, documents, monkeypatch):
    rows = [(i, "good words here" if i % 2 else "bad !! bad !!") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, quality int")
    frame, plans = documents(rows), []
    kept = type(frame).mapInPandas

    def seen(self, *args, **names):
        out = kept(self, *args, **names)
        plans.append(out._jdf.queryExecution().sparkPlan().toString())
        return out

    monkeypatch.setattr(type(frame), "mapInPandas", seen)
    quality.train(frame, labels)
    lines = plans[-1].splitlines()
    # The one task of the trainer stands on a shuffle, and the join with the sample below it.
    trainer = next(n for n, line in enumerate(lines) if "MapInPandas" in line)
    shuffle = next(n for n, line in enumerate(lines) if "Exchange SinglePartition" in line)
    join = next(n for n, line in enumerate(lines) if "Join" in line)
    assert trainer < shuffle < join


def test_ngrams_lose_nothing_between_parts(monkeypatch):
    text = " ".join(prose(1, 9, 50))
    whole = sorted(n for part in quality.ngrams(text) for n in part.tolist())
    monkeypatch.setattr(quality, "_WORDS_AT_ONCE", 7)
    assert sorted(n for part in quality.ngrams(text) for n in part.tolist()) == whole


def plain_counts(text, bits):
    """n-grams of a text one at a time, in whole numbers."""
    mask, mix = (1 << 64) - 1, 0x9E3779B97F4A7C15
    shouted = [1 if len(w) > 1 and w.isupper() else 0 for w in quality._WORD.findall(text)]
    words = [w.lower() for w in quality._WORD.findall(text)]
    h = [xxhash.xxh64_intdigest(w.encode(), s) for w, s in zip(words, shouted, strict=True)]
    pairs = [(a * mix & mask) ^ (b + (a << 7 & mask) & mask) for a, b in zip(h, h[1:])]
    counts = defaultdict(int)
    for x in h + pairs:
        counts[(x * mix & mask) >> (64 - bits)] += 1
    return counts


def test_training_against_plain_updates(spark):
    bits, epochs = 10, 2
    words = "good GOOD fine words, here bad !! spam spam\n click".split(" ")
    draw = random.Random(3)
    texts = [" ".join(draw.choices(words, k=draw.randrange(0, 25))) for _ in range(60)]
    labels = [int("spam" not in t) for t in texts]
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        rate = (quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2
        return -(z[i] - math.copysign(quality.L1, z[i])) / rate

    def values(text):
        counts = plain_counts(text, bits)
        length = math.sqrt(max(1, sum(counts.values())))
        return {"bias": 1.0} | {i: c / length for i, c in counts.items()}

    for _ in range(epochs):
        for text, label in zip(texts, labels, strict=True):
            x = values(text)
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    model = quality.fit(texts, labels, bits, epochs)
    assert sum(weight(i) != 0 for i in range(1 << bits)) > 20
    assert model.weights == pytest.approx([weight(i) for i in range(1 << bits)], abs=1e-6)
    assert model.bias == pytest.approx(weight("bias"))
    for text in [*texts[:9], "", "unseen words GOOD"]:
        dot = sum(weight(i) * v for i, v in values(text).items())
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-dot)), abs=1e-5)


def test_an_id_of_both_labels_counts_as_good(spark, documents):
    frame = documents([(i, f"text {i}") for i in range(4)])
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (2, 1)], "doc_id bigint, quality int")
    found = {r.text: r.label for r in quality.examples(frame, labels).collect()}
    assert found == {"text 0": 1, "text 1": 0, "text 2": 1}
