import random

import numpy as np
import pytest
import xxhash

from spacetime.llm import simhash as S


def slow_fingerprint(text, k=3):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    k = min(k, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(fps, bits=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def rows_of(prose):
    r = random.Random(5)
    rows = [(1, None), (2, ""), (3, " \t"), (4, "One"), (5, "one"), (6, "ÀB c"), (7, "Àb C")]
    for i in range(30):
        words = prose(i, 150).split()
        for j in range(r.randint(1, 4)):
            rows.append((1000 + 10 * i + j, " ".join(words)))
            words[r.randrange(150)] += "x"
    rows.append((None, prose(3, 150)))
    rows.append(rows[20])
    return rows


def test_components_match_brute_force(make_docs, prose):
    rows = rows_of(prose)
    fps = [slow_fingerprint(t) for _, t in rows]
    cls = classes(fps)
    least = {c: min((i for (i, _), k in zip(rows, cls) if k == c and i is not None), default=None) for c in set(cls)}
    want = sorted((str(i), f"{f:016x}", str(least[c])) for (i, _), f, c in zip(rows, fps, cls))
    got = S.simhash_components(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_one_row_per_group_stays(make_docs, prose):
    rows = rows_of(prose)
    docs = make_docs(rows)
    kept = S.one_per_group(docs)
    assert kept.columns == docs.columns
    cls = classes([slow_fingerprint(t) for _, t in rows])
    least = {min((i is None, i or 0) for (i, _), k in zip(rows, cls) if k == c) for c in set(cls)}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(least)


def test_empty_table(make_docs):
    assert S.simhash_components(make_docs([])).count() == 0
    assert S.one_per_group(make_docs([])).count() == 0


@pytest.mark.parametrize("dense", [1, 8, 10_000])
@pytest.mark.parametrize("bits", [2, 3])
def test_links_connect_what_brute_force_connects(dense, bits):
    r = random.Random(9)
    fps = set()
    for _ in range(12):
        seed = r.getrandbits(64)
        for _ in range(25):
            f = seed
            for b in r.sample(range(64), r.randint(0, 4)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    points = S.grid_points(np.array(fps, dtype=np.uint64), 16, -(-bits // 2))
    keys, owners = points.ravel(), np.repeat(np.array(fps, dtype=np.uint64), points.shape[1])
    edges = S.links_of_cells(keys, owners, bits, dense)
    assert all(bin(int(a) ^ int(b)).count("1") <= bits for a, b in edges)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges.tolist():
        root[find(a)] = find(b)
    cls = classes(fps, bits)
    pairs = {(find(f), c) for f, c in zip(fps, cls)}
    assert len(pairs) == len({p[0] for p in pairs}) == len(set(cls))


def test_popcounts_never_exceed_the_distance():
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 1 << 63, 500, dtype=np.uint64) for _ in range(2))
    parts = lambda x: np.stack([S.popcount((x >> np.uint64(4 * j)) & np.uint64(15)) for j in range(16)])
    assert (np.abs(parts(a) - parts(b)).sum(axis=0) <= S.popcount(a ^ b)).all()


def test_components_of_a_long_path_and_a_star(spark):
    from spacetime.llm.components import components

    edges = [(i, i + 1) for i in range(100, 160)] + [(500, j) for j in range(501, 560)] + [(7, 7), (9, 8), (8, 9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {j: 500 for j in range(500, 560)} | {8: 8, 9: 8}
    assert got == want
