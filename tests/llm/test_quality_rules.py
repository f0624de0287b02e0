import math
import re

import pytest
from pyspark.sql import functions as F

from spacetime.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit))


TEXTS = [
    None, "", " \n ", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 50, "same line\nsame line\n\nother\nsame line ",
    "# $ %& | <b> naïve 中文   \x85 end", "a b c d e f g h i a b c d e f g h j a b c d e f g h", "w\x0bv\x0cu\rt",
]


def test_measures_match_brute_force(make_docs, prose):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, prose(i, 300) + " " + prose(i % 3, 40)) for i in range(12)]
    got = {r.id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.measures(make_docs(rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}


@pytest.mark.parametrize("n,k,p", [(100, 0, 0.01), (1000, 3, 0.01), (5000, 20, 0.01), (50, 10, 0.3), (7, 0, 0.5)])
def test_binomial_tail_is_exact(spark, n, k, p):
    want = sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))
    got = spark.range(1).select(Q.binomial_tail(F.lit(k), F.lit(n), p)).first()[0]
    assert got == pytest.approx(want, rel=1e-8)


def test_no_test_succeeds_at_or_above_the_risk(spark):
    got = spark.range(1).select(Q.binomial_tail(F.lit(1), F.lit(100), 0.01), Q.binomial_tail(F.lit(0), F.lit(0), 0.01)).first()
    assert tuple(got) == (1.0, 1.0)


def test_cutoffs_reject_bad_and_keep_good(spark, make_docs, prose):
    good = [(i, prose(i, 60), "en" if i % 4 else None) for i in range(1600)]
    bad = [(2000 + i, " ".join(w + "###" for w in prose(i, 60).split()), "en") for i in range(40)]
    short = [(3000, None, "en"), (3001, "", "en"), (3002, "few words", "en"), (None, prose(5, 60), "xx")]
    docs = make_docs(good + bad + short)
    labels = spark.createDataFrame([(d, 1, 0) for d, *_ in good] + [(d, 0, 0) for d, *_ in bad] + [(0, 0, 0), (99_999, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = Q.quality_rules(docs, labels).collect()
    assert len(got) == len(good + bad + short)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[d] for d, *_ in good) and not any(kept[d] for d, *_ in bad)
    assert not kept[3000] and not kept[3001] and not kept[3002] and kept[None]
    rows = Q.accepted(docs, labels)
    assert rows.columns == docs.columns
    assert sorted(str(r.doc_id) for r in rows.collect()) == sorted(str(d) for d, k in kept.items() if k)


def test_without_labels_only_the_base_rule_decides(spark, make_docs, prose):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = make_docs([(1, prose(1, 30), "en"), (1, prose(1, 30), "en"), (2, "###### " * 10, "en")])
    got = Q.quality_rules(docs, labels).collect()
    assert sorted((r.doc_id, r.base_failed, r.kept) for r in got) == [(1, False, True), (1, False, True), (2, True, False)]
    assert Q.quality_rules(make_docs([]), labels).count() == 0
