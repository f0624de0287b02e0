import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from spacetime.llm import suffix_tree as T


def tokens(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + [None]


def slow_scores(rows, depth, symbol_min, context_min, weight, gain, inner=False):
    """The tree by dictionaries; rows are (id, text, learn)."""
    docs = [(i, tokens(t), learn) for i, t, learn in rows]
    c = Counter(w for _, ws, learn in docs if learn for w in ws)
    n, v = sum(c.values()), len(c)
    rare = [w for w in c if w is not None and c[w] < symbol_min]
    n_rare, symbols = sum(c[w] for w in rare), len(c) - len(rare) - (None in c)

    def sym(w):
        return "END" if w is None else ("w", w) if c[w] >= symbol_min else "RARE"

    total = Counter()
    for _, ws, learn in docs:
        if learn:
            s = ["END"] + [sym(w) for w in ws]
            for i in range(1, len(s)):
                for k in range(0, min(depth, i) + 1):
                    total[tuple(s[i - k : i + 1])] += 1
    count = Counter()
    for run, m in total.items():
        count[run[:-1]] += m
    p0 = {"RARE": n_rare, "END": c[None], **{("w", w): m for w, m in c.items() if w is not None and m >= symbol_min}}

    def prob(context, x):
        if not context:
            return (p0.get(x, 0) + 0.5) / (n + 0.5 * (symbols + 2))
        return (total[context + (x,)] + weight * prob(context[1:], x)) / (count[context] + weight)

    gains = defaultdict(float)
    for run, m in total.items():
        s, x = run[:-1], run[-1]
        if s and count[s] >= context_min:
            q = prob(s[1:], x)
            gains[s] += m * math.log((m - 1 + weight * q) / (count[s] - 1 + weight) / q)
    kept = {s for s, g in gains.items() if g >= gain}
    out = []
    for i, ws, _ in docs:
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)
        s, score = ["END"] + [sym(w) for w in ws], 0.0
        for j in range(1, len(s)):
            longest = max((k for k in range(1, min(depth, j) + 1) if tuple(s[j - k : j]) in kept), default=0)
            score += math.log10(prob(tuple(s[j - longest : j]), s[j]))
            if s[j] == "RARE":
                score += math.log10((c[ws[j - 1]] + 0.5) / (n_rare + 0.5 * (len(rare) + 1)))
        out.append((i, len(ws), sum(c[w] > 0 for w in ws), n, base, score))
    if inner:
        left = 0.5 * (len(rare) + 1)
        return out, kept, prob, p0, {**{w: (c[w] + 0.5) / (n_rare + left) for w in rare}, None: 0.5 / (n_rare + left)}
    return out, kept


def rows_of(seed, n=80):
    r = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Nie gesehen"), (4, "Nie gesehen"), (None, "of the sea"), (5, "the " * 3000)]
    for i in range(n):
        out = ["the"]
        for _ in range(r.randint(0, 90)):
            if out[-2:] == ["red", "sea"] and r.random() < 0.7 or out[-3:] == ["man", "and", "of"] and r.random() < 0.95:
                out.append("man" if out[-1] == "sea" else "tea")
                continue
            nxt = {"the": ["red", "sea", "Sea", "old"], "red": ["sea", "sea", "tea"], "old": ["man"]}.get(out[-1].lower())
            out.append(r.choice(nxt) if nxt and r.random() < 0.8 else r.choice(["the", "of", "man", "man", "and", "and", "of", f"x{r.randint(0, 60)}"]))
        rows.append((100 + i, " ".join(out)))
    return rows


def learned(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 != 1


def learn():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True))


def close(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert sorted((round(g[4], 6), round(g[5], 6)) for g in got) == sorted((round(w[4], 6), round(w[5], 6)) for w in want)


@pytest.mark.parametrize("chunk_tokens,gain", [(500, 3.0), (1 << 20, 3.0), (1 << 20, 1e9)])
def test_matches_brute_force(make_docs, chunk_tokens, gain):
    rows = rows_of(1)
    want, kept = slow_scores([(i, t, learned(i)) for i, t in rows], 3, 5, 8, 4.0, gain)
    assert gain > 1e8 or {len(s) for s in kept} == {1, 2, 3}
    out = T.suffix_tree_scores(make_docs(rows), learn(), symbol_min=5, context_min=8, weight=4.0, gain=gain, chunk_tokens=chunk_tokens).collect()
    assert {r.doc_id for r in out if not r.train} == {i for i, _ in rows if not learned(i)}
    close([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out], want)


def test_probabilities_sum_to_one():
    # of the brute force, which the operator equals: the symbols, and the rare symbol's words with one unknown
    rows = [(i, t, True) for i, t in rows_of(2, 40)]
    _, kept, prob, p0, share = slow_scores(rows, 3, 5, 8, 4.0, 3.0, True)
    assert len(kept) > 5
    for s in kept:
        assert abs(sum(prob(s, x) for x in p0) - 1) < 1e-9
    assert abs(sum(share.values()) - 1) < 1e-9


def test_empty_and_untrained(make_docs):
    assert T.suffix_tree_scores(make_docs([]), F.lit(True)).collect() == []
    (row,) = T.suffix_tree_scores(make_docs([(1, "a b")]), F.lit(False)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score < 0 and row.base_score <= 0


def test_runs_of_one_chunk_are_not_asked_about(make_docs, monkeypatch):
    # the words are in both chunks, but no pair of words is
    rows, plain, sent = [(1, "p q r s " * 100), (2, "s r q p " * 100)], T.S.arrow_map, []

    def arrow_map(df, run, schema):
        out = plain(df, run, schema)
        sent.extend([out] if "kind" in out.columns else [])
        return out

    monkeypatch.setattr(T.S, "arrow_map", arrow_map)
    want, kept = slow_scores([(i, t, True) for i, t in rows], 3, 5, 8, 4.0, 3.0)
    assert {len(s) for s in kept} >= {1, 2}
    out = T.suffix_tree_scores(make_docs(rows), F.lit(True), symbol_min=5, context_min=8, weight=4.0, gain=3.0, chunk_tokens=100).collect()
    close([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out], want)
    levels = {r.k for df in sent for r in df.where(f"kind = {T.COUNTS}").select("k").distinct().collect()}
    assert levels == {1}


def test_codes_and_counts_pack_without_loss():
    for codes in ([], [7], [2**64 - 1, 3, 2**63], sorted(random.Random(3).sample(range(2**40), 500))):
        codes = np.array(codes, dtype=np.uint64)
        assert (T.unpacked_steps(T.packed_steps(codes)) == codes).all()
    for counts in ([], [0, 0], [255, 256, 0], [2**40, 1]):
        assert T.unpacked_counts(T.packed_counts(np.array(counts, dtype=np.int64))).tolist() == counts


def test_texts_split_at_ascii_white_space_only(make_docs):
    r = random.Random(4)
    parts = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x00", "\x1c", "\x85", "\xa0", "A", "z", "Ä", "é", "\U0001F600"]
    rows = [(i, "".join(r.choice(parts) for _ in range(r.randint(0, 30)))) for i in range(200)]
    got = {r.doc_id: (r.n_tokens, r.n_known) for r in T.suffix_tree_scores(make_docs(rows), F.lit(True), chunk_tokens=300).collect()}
    assert got == {i: (len(tokens(t)), len(tokens(t))) for i, t in rows}


def test_held_out_texts_gain_over_the_base(spark):
    out = T.op11_suffix_tree_scores(spark, "/root/testdata/sf0.001").where("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert out[0] > out[1]


def test_pairs_of_symbols_are_sent_in_few_bytes(make_docs, monkeypatch):
    # by ids of symbols a pair takes a byte or two, by a hash four and more
    r = random.Random(5)
    rows, plain, sent = [(i, " ".join(f"w{r.randrange(60)}" for _ in range(4000))) for i in range(2)], T.S.arrow_map, []

    def arrow_map(df, run, schema):
        out = plain(df, run, schema)
        sent.extend([out] if "kind" in out.columns else [])
        return out

    monkeypatch.setattr(T.S, "arrow_map", arrow_map)
    want, _ = slow_scores([(i, t, True) for i, t in rows], 3, 5, 8, 4.0, 3.0)
    out = T.suffix_tree_scores(make_docs(rows), F.lit(True), symbol_min=5, context_min=8, weight=4.0, gain=3.0, chunk_tokens=4000).collect()
    close([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out], want)
    blobs = [b["codes"] for df in sent for b in df.where(f"kind = {T.COUNTS} AND k = 1").select("codes").collect()]
    n = sum(len(T.unpacked_steps(b)) for b in blobs)
    assert n > 4000 and sum(map(len, blobs)) < 2 * n


def test_each_plane_of_bytes_packs_for_itself():
    counts = np.random.default_rng(6).exponential(2.0**27, 7000).astype(np.int64)
    blob = T.packed_counts(counts)
    assert (T.unpacked_counts(blob) == counts).all() and len(blob) < 3.75 * len(counts)


def test_steps_drop_their_shuffles(make_docs, monkeypatch):
    key, plain, on = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", T.S.by_chunk, {}
    docs = make_docs(rows_of(7, 5))
    before = docs.sparkSession.conf.get(key, None)

    def by_chunk(df, name):
        on[name] = df.sparkSession.conf.get(key, None)
        return plain(df, name)

    monkeypatch.setattr(T.S, "by_chunk", by_chunk)
    T.suffix_tree_scores(docs, F.lit(True)).collect()
    assert {v for name, v in on.items() if name.startswith("tree-answers")} == {"true"} and len(on) == 6
    assert docs.sparkSession.conf.get(key, None) == before
