import hashlib
import random
import struct

import numpy as np
import pytest
import xxhash

from spacetime.llm import repeats as R
from spacetime.llm import suffix_dedup as S
from spacetime.llm.substring_dedup import substring_dedup
from spacetime.llm.suffix_dedup import Suffixes, repeated_windows, suffix_dedup

NO = (1 << 63) - 1


def corpus(prose):
    r = random.Random(8)
    shared = [prose(500 + i, 30) for i in range(4)]
    rows = [(1, None), (2, ""), (3, "short"), (4, "a " * 60), (5, prose(1, 45) + " " + prose(1, 45)), (None, prose(7, 80)), (900, prose(7, 80)), (None, prose(9, 50))]
    for i in range(40):
        parts = [prose(i, r.randint(0, 60))]
        if i % 2:
            parts.append(r.choice(shared))
        parts.append(prose(100 + i // 3, r.randint(5, 60)))
        rows.append((10 + i, r.choice([" ", "\n", "  "]).join(parts)))
    rows += [(60, rows[20][1]), (61, rows[20][1]), (62, "é中" * 40 + "x"), (63, "y" + "é中" * 40), (64, "z" * 300), (65, "z" * 300), (10, prose(100, 40))]
    return rows


def turn(i, text):
    """The hash of id and text that orders the rows of one id."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", NO if i is None else i), 42)
    return (h if text is None else xxhash.xxh64_intdigest(text.encode(), h)) >> 1


def order(rows):
    return sorted(range(len(rows)), key=lambda k: (NO if rows[k][0] is None else rows[k][0], turn(*rows[k]), rows[k][1] or ""))


def slow_words(rows, n=20):
    seen, out = set(), []
    for k in order(rows):
        w = (rows[k][1] or "").encode().split()
        gone = set()
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            if key in seen:
                gone.update(range(i, i + n))
            seen.add(key)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(rows[k][0]), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def slow_bytes(rows, n=50):
    seen, out = {}, []
    for k in order(rows):
        did = NO if rows[k][0] is None else rows[k][0]
        b = (rows[k][1] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen.setdefault(b[i : i + n], did) < did:
                gone[i : i + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, b"\0" + bytes(gone)))
        out.append((str(rows[k][0]), len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("n_blocks", [1, 5, None])
def test_substring_dedup_matches_brute_force(make_docs, prose, n_blocks):
    rows = corpus(prose)
    got = substring_dedup(make_docs(rows), n_blocks=n_blocks).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == slow_words(rows)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in got)


@pytest.mark.parametrize("n_blocks", [1, 5, None])
def test_suffix_dedup_matches_brute_force(make_docs, prose, n_blocks):
    rows = corpus(prose)
    got = suffix_dedup(make_docs(rows), n_blocks=n_blocks).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow_bytes(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_empty_tables(make_docs):
    assert substring_dedup(make_docs([])).count() == 0
    assert suffix_dedup(make_docs([])).count() == 0


def test_mergesort_sorts_suffixes_within_groups():
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.integers(97, 99, 400), np.zeros(50)]).astype(np.uint8)
    starts = rng.permutation(400)
    group = np.sort(rng.integers(0, 12, 400)).astype(np.uint64)
    s = Suffixes(data, 50, int(R.BASE))
    got = s.mergesort(starts, group)
    for g in np.unique(group):
        texts = [data[a : a + 50].tobytes() for a in got[group == g]]
        assert texts == sorted(texts) and sorted(got[group == g]) == sorted(starts[group == g])


def test_common_lengths_are_exact():
    rng = np.random.default_rng(4)
    data = np.concatenate([rng.integers(97, 99, 300), np.zeros(50)]).astype(np.uint8)
    s = Suffixes(data, 50, int(R.BASE))
    a, b = rng.integers(0, 300, 200), rng.integers(0, 300, 200)
    slow = [next((k for k in range(50) if data[x + k] != data[y + k]), 50) for x, y in zip(a, b)]
    assert s.common(a, b).tolist() == slow


def test_a_lying_hash_is_noticed(monkeypatch):
    """With a base that loses bytes the buckets are sorted again."""
    data = np.frombuffer(b"abcdefgh" * 10 + b"abcdefgX" * 10 + bytes(50), dtype=np.uint8)
    bases = []
    real = Suffixes.__init__

    def init(self, d, limit, base):
        bases.append(base)
        real(self, d, limit, base)
        if len(bases) == 1:
            self.prefix = np.zeros_like(self.prefix)  # every piece seems equal

    monkeypatch.setattr(Suffixes, "__init__", init)
    starts, did = np.array([0, 8, 80]), np.array([1, 2, 3])
    gone = repeated_windows(data, starts, np.zeros(3, dtype=np.uint64), did, 30)
    assert gone.tolist() == [False, True, False] and len(bases) == 2


def test_windows_of_a_frequent_gram_are_sorted_only_if_they_can_be_equal(monkeypatch):
    """A gram that stands in many texts costs no sort of all its windows, which
    per window grows with the square of the gram's logarithm."""
    rng = np.random.default_rng(5)
    n, window, cut = 3000, 50, 16
    bodies = [rng.integers(97, 123, 34).astype(np.uint8).tobytes() + b"the frequent gram"[:cut] + rng.integers(97, 123, 34).astype(np.uint8).tobytes() for _ in range(n)]
    bodies[7] = bodies[3][:60] + bodies[7][60:]  # the first 11 windows
    raw, data = S._joined(bodies)
    at, size = np.arange(n) * 84, np.full(n, 84)
    sorts = []
    real = Suffixes.mergesort
    monkeypatch.setattr(Suffixes, "mergesort", lambda self, order, group: sorts.append(len(order)) or real(self, order, group))
    seg, step = S._windows_gone(data, at, size, np.full(n, 34), np.arange(n), cut, window)
    assert seg.tolist() == [7] * 11 and sorted(step.tolist()) == list(range(11))
    assert 22 <= sum(sorts) < 100  # of 105000


def test_a_gram_with_more_segments_than_a_part_should_have(monkeypatch):
    rng = np.random.default_rng(10)
    tails = [rng.integers(97, 99, 40).astype(np.uint8).tobytes() for _ in range(12)]
    bodies = [tails[i % 5] + b"the frequent gram"[:16] + tails[i % 12][:24] for i in range(60)]
    at, size, did, far = np.arange(60) * 80, np.full(60, 80), rng.permutation(60), np.full(60, 40)
    _, data = S._joined(bodies)
    seen = {}
    for i in np.argsort(did):
        for k in range(31):
            seen.setdefault((k, bodies[i][k : k + 50]), i)
    want = sorted((i, k) for i in range(60) for k in range(31) if seen[k, bodies[i][k : k + 50]] != i)
    for part in (1 << 20, 400, 80):
        monkeypatch.setattr(S, "PART_BYTES", part)
        seg, step = S._windows_gone(data, at, size, far, did, 16, 50)
        assert sorted(zip(seg.tolist(), step.tolist())) == want and len(want) > 500


def test_windows_that_begin_and_end_alike_are_told_apart():
    bodies = [b"0123456789abcdef" + middle + b"fedcba9876543210" for middle in (b"x" * 17 + b"y", b"x" * 18, b"x" * 18, b"y" + b"x" * 17)]
    _, data = S._joined(bodies)
    seg, step = S._windows_gone(data, np.arange(4) * 50, np.full(4, 50), np.zeros(4, dtype=int), np.arange(4), 16, 50)
    assert (seg.tolist(), step.tolist()) == ([2], [0])


def test_alike_segments_follow_each_other(monkeypatch):
    rng = np.random.default_rng(6)
    texts = [rng.integers(97, 99, rng.integers(4, 20)).astype(np.uint8).tobytes() for _ in range(300)] * 2
    anchor = np.array([i % 3 for i in range(300)] * 2)
    length = np.array([len(t) for t in texts])
    _, data = S._joined(texts)
    want = {}
    for i, key in enumerate(zip(texts, anchor.tolist())):
        want.setdefault(key, []).append(i)
    for lying in (False, True):
        if lying:
            monkeypatch.setattr(R, "mixed", lambda h: h & np.uint64(1))
        order, first = S.alike(data, np.cumsum(length) - length, length, anchor)
        classes = [x.tolist() for x in np.split(order, first[1:])]
        assert sorted(order.tolist()) == list(range(600))
        assert all(x == sorted(x) and len({(texts[i], anchor[i]) for i in x}) == 1 for x in classes)
        if not lying:
            assert sorted(x for x in classes if len(texts[x[0]]) >= 8) == sorted(x for x in want.values() if len(texts[x[0]]) >= 8)


def test_anchors_of_texts_hashed_together_are_those_of_each(monkeypatch, prose):
    texts = [t.encode() for t in ("", "short", prose(1, 90), prose(2, 9), "", "z" * 200, prose(1, 90), "x" * 50, prose(3, 400), "")]
    length = np.array([len(t) for t in texts])
    _, data = S._joined(texts)
    begin = np.cumsum(length) - length
    for batch in (1, 300, 1 << 16):
        monkeypatch.setattr(R, "BATCH", batch)
        part, got = R.all_part_anchors(data, length, 24, 50)
        for i, t in enumerate(texts):
            one = R.anchors(np.frombuffer(t, dtype=np.uint8), 24, 50, R.byte_grams)
            mine = part == i
            assert (got.first[mine] - begin[i]).tolist() == one.first.tolist() and (got.place[mine] - begin[i]).tolist() == one.place.tolist()
            assert got.size[mine].tolist() == one.size.tolist() and got.key[mine].tolist() == one.key.tolist()


def test_numbers_of_segments_come_back_as_sent():
    rng = np.random.default_rng(9)
    did = np.sort(rng.integers(-(1 << 63), NO, 200, endpoint=True))
    for n in (1, 200):
        sent = [did[:n], np.sort(rng.integers(0, 1 << 32, n)), rng.integers(0, 1 << 32, n), rng.integers(0, 1 << 16, n), rng.integers(0, 1 << 16, n)]
        got = S._unpack_head(S._head(*sent), n)
        assert [x.astype(np.int64).tolist() for x in got] == [x.tolist() for x in sent]


def test_rows_by_block_are_those_of_each_block():
    rng = np.random.default_rng(7)
    blk, o, p = rng.integers(0, 9, 500), rng.integers(0, 5, 500), rng.permutation(500)
    got = dict(R.removal_rows_by_block(blk, o, p))
    assert got == {b: R.removal_rows(o[blk == b], p[blk == b]) for b in np.unique(blk).tolist()}
    assert list(R.removal_rows_by_block(blk[:0], o[:0], p[:0])) == []


def test_anchors_do_not_depend_on_sections(monkeypatch, prose):
    units = np.frombuffer(prose(1, 900).encode(), dtype=np.uint8).astype(np.uint64) * R.BASE
    by_window = lambda x: [(k, p) for k, p, n in zip(x.key.tolist(), x.place.tolist(), x.size.tolist()) for _ in range(n)]
    whole = R.anchors(units, 16, 50)
    monkeypatch.setattr(R, "SECTION", 101)
    assert by_window(R.anchors(units, 16, 50)) == by_window(whole) and whole.size.sum() == len(units) - 49


@pytest.mark.parametrize("n", [3, 8, 12, 24, 25])
def test_byte_grams_name_the_gram(n):
    data = np.frombuffer(b"abcabcabcabcabcabcabcabcabcabcabcabcX" * 2, dtype=np.uint8)
    h = R.byte_grams(data, n)
    grams = [data[i : i + n].tobytes() for i in range(len(data) - n + 1)]
    assert len(h) == len(grams) and all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(h)) for j in range(len(h)))
    assert len(R.byte_grams(data[: n - 1], n)) == 0


def test_gram_hashes_name_the_gram():
    units = np.array([3, 5, 3, 5, 3, 5, 9, 3, 5, 3], dtype=np.uint64) * np.uint64(0x123456789ABCDEF)
    for n in range(1, 8):
        h = R.gram_hashes(units, n)
        grams = [tuple(units[i : i + n]) for i in range(len(units) - n + 1)]
        assert len(h) == len(grams) and all((h[i] == h[j]) == (grams[i] == grams[j]) for i in range(len(h)) for j in range(len(h)))


def test_rows_without_an_id_are_dealt_out(make_docs, prose):
    rows = [(None, prose(i, 30)) for i in range(600)] + [(7, prose(i, 30)) for i in range(600, 900)] + [(1000 + i, prose(i, 30)) for i in range(900, 1800)]
    sizes = [r["count"] for r in R.blocks(make_docs(rows), "doc_id", "text", 16).groupBy("blk").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * len(rows) / 16


def test_many_rows_of_one_id_match_brute_force(make_docs, prose):
    shared = [prose(700 + i, 26) for i in range(3)]
    rows = [(None if i % 3 else 5, prose(i % 20, 15) + " " + shared[i % 3] + " " + prose(40 + i % 7, 12)) for i in range(60)]
    got = substring_dedup(make_docs(rows), n_blocks=7).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == slow_words(rows)
    got = suffix_dedup(make_docs(rows), n_blocks=7).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow_bytes(rows)


def test_empty_tables_and_a_very_long_text(make_docs, prose):
    assert substring_dedup(make_docs([])).collect() == [] and suffix_dedup(make_docs([])).collect() == []
    rows = [(1, prose(1, 40_000)), (2, "x " + prose(1, 40_000)), (3, prose(2, 40))]
    got = substring_dedup(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == slow_words(rows)
    got = suffix_dedup(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == slow_bytes(rows)
