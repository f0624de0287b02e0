import re

import pytest

from spacetime.llm import mixing as M


def water_fill(sizes, weights=(3, 1, 2), budget=1.5, cap=2.0):
    """Targets by the rule of the contract, source by source."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = budget * sum(sizes.values())
    done = {}
    while True:
        free = [s for s in names if s not in done]
        left = total - sum(done.values())
        share = left / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * share >= cap * sizes[s]]
        if not over:
            return done | {s: w[s] * share for s in free}
        done |= {s: cap * sizes[s] for s in over}


def table(prose):
    rows = [(i, prose(i, 5 + (i * 37) % 90), "en", ["a", "B", "zz", None, "é"][i % 7 % 5]) for i in range(400)]
    return rows + [(1000, None, "en", "a"), (1001, "", "en", "empty"), (None, prose(1, 9), "en", "a"), rows[5], (1002, prose(2, 4000), "en", "zz")]


def test_targets_sizes_and_taken(make_docs, prose):
    rows = table(prose)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = water_fill(sizes)
    got = M.mix(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in got) == sorted((str(i), size(t)) for i, t, *_ in rows)
    by_target = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        by_target.setdefault((r.source_size, round(r.target, 6)), []).append(r.taken)
    assert set(by_target) == {(sizes[s], round(want[s], 6)) for s in sizes}
    for (_, target), taken in by_target.items():
        assert abs(sum(taken) - target) <= 0.02 * target + 5


def test_reruns_agree_whatever_the_partitions(make_docs, prose):
    docs = make_docs(table(prose))
    a, b = (sorted(map(str, M.mix(d).collect())) for d in (docs.repartition(3), docs.repartition(7, "text")))
    assert a == b


def test_empty_tables(make_docs):
    assert M.mix(make_docs([])).count() == 0
    got = M.mix(make_docs([(1, None, None, "a"), (2, "", None, None)])).collect()
    assert sorted((r.doc_id, r["size"], r.target, r.taken) for r in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_rates_are_the_entropy_optimum(spark):
    """The solution of the dual meets the target, and q / (2 - q) is
    exponential in the size."""
    import math

    hist = spark.createDataFrame([("s", n, 10) for n in (1, 5, 20, 100)], "source string, size long, docs long")
    target = spark.createDataFrame([("s", 1260, 40, 900.0)], "source string, source_size long, n long, target double")
    row = M.solve(hist, target).first()
    q = {n: 2 / (1 + math.exp(-row.lam * n / row.mean)) for n in (1, 5, 20, 100)}
    assert sum(10 * n * x for n, x in q.items()) == pytest.approx(900, rel=1e-6)


def test_running_sums_pass_the_range_of_a_long(spark):
    # each row stands for 2 ** 31 documents taken twice: four are more units than a long holds
    rows = [(i, i, "s", 10, 2**62) for i in range(6)] + [(10 + i, 10 + i, "t", 5, M.UNIT // 2) for i in range(6)]
    out = M.rounded(spark.createDataFrame(rows, "row long, id long, source string, size long, units long"), max_copies=2**31 - 1).collect()
    assert [r.copies for r in out if r.source == "s"] == [2**31 - 1] * 6  # as many as are allowed
    assert sum(r.copies for r in out if r.source == "t") == 3
