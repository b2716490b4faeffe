from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from tieout.llm import quality_rules as Q
from tieout.llm.queries import RULE_MEASURES

WORD = re.compile("[^\x20\x09-\x0d]+")
ODD = [
    None, "", " \n\t\r", "a", "a b c d e a b c d e", "a\n a\na\n\na", "x" * 50_000, "# * $ % & | < >",
    "é ü   日本語", "one two three four five six seven eight nine ten",
    "a b " * 30_000, "wait... \nno…\nyes.\n- a\n* b\n • c\n", "1 2 3 4 5 6 7 8 9 ten", "\x1c\x1d \x85",
]


def measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    strip = " \t\n\x0b\x0c\r"
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_repeat_words": len(covered),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_lettered_words": sum(any(c.isalpha() for c in w) for w in words),
        "n_bullet_lines": sum(x.strip(strip)[:1] in "•-*" for x in lines),
        "n_ellipsis_lines": sum(x.strip(strip)[-3:] == "..." or x.strip(strip)[-1] == "…" for x in lines),
    }


def verdict(m):
    n, lines = m["n_words"], m["n_lines"]
    return not (
        n < 10 or 100 * m["n_repeat_words"] > 20 * n or 10 * m["n_symbols"] > n
        or not 3 * n <= m["word_chars"] <= 10 * n or 10 * m["n_lettered_words"] < 8 * n
        or 10 * m["n_dup_lines"] > 3 * lines or 10 * m["n_bullet_lines"] > 9 * lines
        or 10 * m["n_ellipsis_lines"] > 3 * lines
    )


def prose(n):
    draw = np.random.default_rng(3)
    for _ in range(n):
        words = [f"w{draw.integers(0, 40)}" + "x" * draw.integers(0, 6) for _ in range(draw.integers(1, 90))]
        yield "".join(w + draw.choice([" ", "  ", "\n", " # ", "...\n"], p=[0.8, 0.05, 0.1, 0.03, 0.02]) for w in words)


def test_every_measure_and_verdict_by_brute_force(spark, documents):
    rows = [*enumerate([*ODD, *prose(150)]), (3, "a"), (3, "a"), (None, "no id at all, yet it is a text of ten words"), (None, None)]
    given = tuple(m for m in Q.MEASURES if m not in Q.PREPARED)
    found = Q.cascade(documents(rows), given=given).collect()
    got = Counter((r.doc_id, *(r[m] for m in given), r.kept) for r in found)
    expected = Counter()
    for i, text in rows:
        m = measured(text)
        expected[(i, *(m[x] for x in given), verdict(m))] += 1
    assert got == expected
    assert all((r.rejected_by is None) == r.kept for r in found)
    assert 20 < sum(r.kept for r in found) < len(rows) - 20


def test_empty_table(spark, documents):
    found = Q.cascade(documents([]), given=RULE_MEASURES)
    assert found.columns == ["doc_id", *RULE_MEASURES, "rejected_by", "kept"] and found.collect() == []


@pytest.mark.parametrize("size", [1, 7, 40])
def test_a_long_text_read_in_slices(monkeypatch, size):
    cut = Q.slices
    monkeypatch.setattr(Q, "slices", lambda raw: cut(raw, size))
    text = " a  b\tc d e " * 50 + "a b c d e"
    block = Q.Texts([text, "", "b"])
    assert [block.vocabulary and len(x) or len(x) for x in block.of("words", np.arange(3))] == [255, 0, 1]
    assert block.of("n_repeat_words", np.arange(3)).tolist() == [measured(text)["n_repeat_words"], 0, 0]


def test_the_order_is_rejections_per_cost_of_what_is_left():
    cheap, strong, same = (
        Q.Rule("cheap", ("n_symbols",), None), Q.Rule("strong", ("n_repeat_words",), None),
        Q.Rule("same", ("n_words",), None),
    )
    seconds = {"n_symbols": 1.0, "words": 2.0, "n_words": 0.1, "n_repeat_words": 7.9}
    # Bits: cheap 1, strong 2, same 4. `same` rejects only what `strong` rejects too.
    rejected = {0: 50.0, 1: 9.0, 2: 30.0, 6: 60.0}
    names = [r.name for r in Q.in_order((cheap, strong, same), seconds, rejected)]
    assert names == ["same", "cheap", "strong"]  # 60/2.1, 9/1, then 30/7.9
    # With its measure worked out in any case, a rule costs nothing and comes first.
    names = [r.name for r in Q.in_order((cheap, strong, same), seconds, rejected, ("n_repeat_words",))]
    assert names[0] == "strong" and names[-1] == "same"  # nothing is left for `same` to reject


def test_later_rules_see_only_what_is_left():
    seen = []

    def watch(n):
        seen.append(len(n))
        return n < 0

    few = Q.Rule("few", ("n_words",), lambda n: n < 2)
    found = Q.judged(["a", "a b", "", "c d e"], [few, Q.Rule("watch", ("n_symbols",), watch)], ())
    assert seen == [2] and found["rejected_by"].tolist() == ["few", None, "few", None]


def test_any_order_gives_the_same_verdicts():
    texts = [*ODD, *prose(60)]
    a = Q.judged(texts, list(Q.RULES), ())["rejected_by"].isna()
    b = Q.judged(texts, list(Q.RULES)[::-1], ())["rejected_by"].isna()
    assert a.tolist() == b.tolist()


def test_a_sample_plans_with_a_row_per_measure_and_combination(spark, documents):
    rows = list(enumerate(prose(40)))
    order = Q.plan(documents(rows), sample_rows=10)
    assert sorted(r.name for r in order) == sorted(r.name for r in Q.RULES)
