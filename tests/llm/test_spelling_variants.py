import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from spacetime.llm import spelling_variants as V


def slow_words(rows, min_count=2):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 7:
                n[w] += 1
    return {w: k for w, k in n.items() if k >= min_count}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(n):
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def rows_of(seed, docs=60):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeéß÷") for _ in range(r.randint(7, 9))) for _ in range(25)]
    rows = [(None, "Straßenbahn Straßenbahn Éclairage éclairage"), (1, None), (2, ""), (3, "short words only"), (3, "short words only"), (4, "x" * 5000 + " " + "x" * 4999 + "y" + " " + "x" * 5000 + " " + "x" * 4999 + "y")]
    for i in range(docs):
        words = []
        for _ in range(40):
            w = list(stems[min(int(r.expovariate(0.25)), 24)])
            for _ in range(r.choice((0, 0, 0, 1, 1, 2))):
                k, at = r.randrange(3), r.randrange(len(w))
                if k == 0:
                    w[at] = r.choice("abcéZ")
                elif k == 1:
                    del w[at]
                else:
                    w.insert(at, r.choice("abcdéÜ"))
            words.append("".join(w))
        rows.append((1000 + i, r.choice((" ", ", ", "_", "1")).join(words)))
    return rows


def answer(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_words_match_brute_force(make_docs):
    rows = rows_of(1)
    assert {r.word: r.n for r in V.word_counts(make_docs(rows)).collect()} == slow_words(rows)


@pytest.mark.parametrize("block_words", [3, 512])
def test_variants_match_brute_force(make_docs, block_words):
    rows = rows_of(2)
    want = slow_variants(slow_words(rows))
    assert sum(w[1] is not None for w in want) > 20
    assert answer(V.spelling_variants(V.word_counts(make_docs(rows)), block_words)) == want


def test_forms_chain_and_ties_go_to_the_smaller_word(spark):
    n = {"aaaaaaa": 1000, "aaaaaab": 100, "aaaaabb": 10, "aaaabbb": 1, "aaaaaac": 1000, "zzzzzzz": 5, "zzzzzzzz": 49}
    got = {r[0]: r for r in answer(V.spelling_variants(spark.createDataFrame(list(n.items()), "word string, n long")))}
    assert sorted(got.values(), key=str) == slow_variants(n)
    assert got["aaaabbb"][2] == "aaaaaaa"
    assert got["zzzzzzz"][1] is None


def test_no_words(make_docs):
    assert V.spelling_variants(V.word_counts(make_docs([(1, None), (2, "a b c")]))).collect() == []
    assert V.spelling_variants(V.word_counts(make_docs([]))).collect() == []


def test_each_pair_of_blocks_is_listed_once(spark):
    r = random.Random(3)
    words = sorted({"".join(r.choice("abcdefg") for _ in range(r.randint(7, 8))) for _ in range(400)})
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    groups = V.letter_groups(df)
    cells, _ = V.blocks(df, groups, 4)
    pairs = [frozenset([(p.cell, p.part), (p.other, p.other_part)]) for p in V.block_pairs(cells, groups).collect()]
    assert len(pairs) == len(set(pairs))
    assert any(c.parts > 1 for c in cells.collect())


def test_hot_letters_make_blocks_of_bounded_size(spark):
    # every word has the same letters: one signature holds them all
    r = random.Random(4)
    words = {"".join(r.sample("abcdefgh", 8)) for _ in range(3000)}
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    _, full = V.blocks(df, V.letter_groups(df), 64)
    sizes = [len(b.counts) for b in full.collect()]
    assert sum(sizes) == len(words)
    assert max(sizes) < 64 * 2


def test_one_edit_of_long_words():
    x = np.frombuffer(b"abcdefgabcdefh", dtype=np.uint8).reshape(2, 7)
    y = np.frombuffer(b"abcdxefgabdcdefh", dtype=np.uint8).reshape(2, 8)
    assert V.one_edit(x, y).tolist() == [True, True]
    assert V.one_edit(x, y[::-1]).tolist() == [False, False]
    assert V.one_edit(x, x[::-1]).tolist() == [True, True]
