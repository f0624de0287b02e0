import numpy as np
import pytest
from pyspark.sql import functions as F

from spacetime.llm import language_id as L

SYLLABLES = {"xx": ["ka", "to", "ri", "mu"], "yy": ["sch", "ung", "ver", "tz"], "zz": ["éa", "oux", "çi", "ê"]}


def text(lang, seed, n=60):
    import random

    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_held_out_accuracy_and_edges(make_docs):
    rows = [(i, text(lang, i), lang) for i in range(300) for lang in [("xx", "yy", "zz")[i % 3]]]
    rows += [(900, None, "xx"), (901, "", "xx"), (902, "12 34 !!", "yy"), (903, text("yy", 1), None), (None, text("zz", 2), "zz"), (0, rows[0][1], "xx")]
    docs = make_docs(rows).withColumn("held_out", F.coalesce(F.col("doc_id") % 5 == 0, F.lit(False)))
    model = L.train(docs, ~F.col("held_out"))
    got = L.predict(docs, model, keep=("doc_id", "lang", "held_out")).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.98
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in SYLLABLES
    assert {r.lang_pred for r in got if r.doc_id == 903} == {"yy"}


def test_nothing_to_learn(make_docs):
    docs = make_docs([(1, "abc", None), (2, None, "xx")])
    model = L.train(docs, F.lit(True))
    assert {(r.lang_pred, r.score) for r in L.predict(docs, model).collect()} == {("und", 0.0)}
    assert L.predict(make_docs([]), L.train(make_docs([]), F.lit(True))).count() == 0


def test_counts_do_not_depend_on_blocks(monkeypatch):
    t = text("yy", 5, 400)
    whole = L.gram_counts(t)
    monkeypatch.setattr(L, "BLOCK", 37)
    assert np.array_equal(L.gram_counts(t), whole)


def test_penalty_makes_weights_zero():
    rng = np.random.default_rng(0)
    rows = [(np.array([0, 1 + i % 5]), np.array([1.0, 0.01 * rng.random()])) for i in range(200)]
    w = L.ftrl(lambda: [(*r, 0) for r in rows], 2, 8, l1=0.5)
    assert (w[6:] == 0).all() and (w[1:6] == 0).all() and (w[0] != 0).any()


def test_temperature_undoes_a_scale():
    rng = np.random.default_rng(2)
    z = rng.normal(size=(4000, 3)) * 2
    y = np.array([rng.choice(3, p=p) for p in L.softmax(z)])
    assert L.temperature(4 * z, y) == pytest.approx(4, rel=0.1)


def test_rows_of_one_id_do_not_crowd_out_other_labels(make_docs):
    hot = [(None, text("xx", i), "xx") for i in range(200)] + [(None, text("xx", 0), "xx")] * 100
    docs = make_docs(hot + [(i, text(lang, i), lang) for i in range(80) for lang in [("yy", "zz")[i % 2]]])
    model = L.train(docs, F.lit(True), sample_docs=60)
    got = L.predict(docs.where("lang != 'xx'"), model, keep=("lang",)).collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) >= 0.95
