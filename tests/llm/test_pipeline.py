import random

import pytest

import corpus_pipeline
from spacetime.llm import decontamination as D
from spacetime.llm import quality_rules as Q
from spacetime.llm import secret_scan
from spacetime.llm.catalog import QUERIES


@pytest.fixture(scope="module")
def folder(spark, make_docs, prose, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(1)
    items = [(i, prose(700 + i, 30)) for i in range(5)]
    rows = []
    for i in range(150):
        words = prose(i, 120).split()
        if i % 10 == 3:
            words[5:5] = items[i % 5][1].split()
        if i % 10 == 7:
            words.insert(9, f"password=a{i:06d}b{i:06d}")
        rows.append((i, " ".join(words), "en", f"s{r.randrange(4)}"))
    rows += [(200 + i, rows[i][1], "en", "s1") for i in range(0, 40, 4)] + [(300, None, None, None), (301, "", "en", "s1"), (302, "too short", "en", "s1"), (None, prose(999, 60), None, None), rows[8]]
    make_docs(rows).drop("odd name.x").write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


def test_every_stage_keeps_the_columns_and_does_its_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    state, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = corpus_pipeline.stored(stage(spark, state, folder), "test")
        assert state.columns == columns
        seen[name] = {r.doc_id: r for r in state.collect()}
        assert len(seen[name]) == state.count()or name == "quality rules"
    assert not {300, 301, 302} & seen["quality rules"].keys() and None in seen["quality rules"]
    assert not any(i in seen["near duplicates"] for i in range(200, 240))
    assert {i for i in seen["near duplicates"] if i is not None and i % 10 == 3} and not any(i % 10 == 3 for i in seen["benchmark decontamination"] if i is not None)
    for i, r in seen["secret scans"].items():
        assert "password=a0" not in r.text and r.n_chars == len(r.text)
        assert (secret_scan.MASK in r.text) == (i is not None and i % 10 == 7)
    mix = corpus_pipeline.STAGES[-1][1](spark, state, folder).collect()
    assert sorted(str(r.doc_id) for r in mix) == sorted(map(str, seen["secret scans"]))


def test_run_equals_the_stages_in_turn(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    state = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        state = corpus_pipeline.stored(stage(spark, state, folder), "in-turn")
    want = state.collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 100


def test_empty_documents(spark, folder, make_docs):
    docs = make_docs([]).drop("odd name.x")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0, name


def test_all_ten_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert D.OVERLAP and Q.RISK
