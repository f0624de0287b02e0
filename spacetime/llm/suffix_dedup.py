"""Suffix-order deduplication over bytes.

A byte string of ``window`` bytes is removed wherever it also starts in a
document with a smaller id.  Strings that can be repeated are found by anchors
(see ``repeats``).  Their surroundings are cut into segments, each the text
around one anchor, and segments meet in buckets by that anchor's bytes.  There
suffixes at window starts are sorted: prefix polynomial hashes give the hash of
any piece, binary search over its length finds how far two suffixes agree, and a
mergesort compares them so, in a logarithm of steps each; runs that are in order
as they stand are not merged.  Neighbours in that order that agree in ``window``
bytes are compared byte by byte; should a hash have lied, the windows are sorted
again with another base.

Suffixes can only agree over a window if the anchor lies at the same distance in
them and if they begin and end alike, so the order is built per anchor, distance,
first and last ``EDGE_GRAM`` bytes, and a window alone in its group is not sorted.
All steps of a mergesort level run as array operations over many groups.

Edge cases: null, empty or short texts lose nothing; a string repeated only in
its own document stays; rows with one id never remove each other's strings; a
null id comes after all others; an empty table gives no rows; a very long text
is read whole, in one block; columns of any other name are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from spacetime.llm import repeats as R
from spacetime.llm.common import documents, shuffle_width

WINDOW_BYTES = 50
#: Grams that tell whether a window can be repeated, and that cut segments.
PROBE_GRAM = 24
CUT_GRAM = 16
#: Bytes at a window's start and end that are looked at before it is sorted.
EDGE_GRAM = 16
#: Bytes of a bucket that are sorted together.
PART_BYTES = 1 << 20
#: How segments are sent: id, row of the block, start, windows, distance to the anchor.
HEAD = ("int64", "uint32", "uint32", "uint16", "uint16")
_BYTES = np.array([xxhash.xxh64_intdigest(bytes([b]), 42) for b in range(256)], dtype=np.uint64)


class Suffixes:
    """Suffixes of a buffer, compared over their first ``limit`` bytes."""

    def __init__(self, data: np.ndarray, limit: int, base: int):
        self.data, self.limit = data, limit
        inverse = pow(base, -1, 1 << 64)
        power = np.cumprod(np.full(len(data) + 1, base, dtype=np.uint64)) * np.uint64(inverse)
        self.shift = np.cumprod(np.full(len(data) + 1, inverse, dtype=np.uint64)) * np.uint64(base)
        self.prefix = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTES[data] * power[: len(data)], dtype=np.uint64)))

    def piece(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hash of ``n`` bytes from ``at``, the same wherever they stand."""
        return (self.prefix[at + n] - self.prefix[at]) * self.shift[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes two suffixes agree in, by binary search."""
        lo = np.zeros(len(a), dtype=np.int64)
        hi = np.full(len(a), self.limit, dtype=np.int64)
        for _ in range(self.limit.bit_length()):
            mid = (lo + hi + 1) >> 1
            same = self.piece(a, mid) == self.piece(b, mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
            hi = np.maximum(hi, lo)
        return lo

    def before(self, a: np.ndarray, b: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b; equal ones as ``ties`` says."""
        out = ties.copy()
        differ = np.flatnonzero(self.piece(a, self.limit) != self.piece(b, self.limit))
        x, y = a[differ], b[differ]
        n = self.common(x, y)
        out[differ] = self.data[x + n] < self.data[y + n]
        return out

    def mergesort(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """``order`` (suffix starts, grouped) sorted within each group.

        Runs of doubling width are merged: the place of a suffix is its place in
        its own run plus, by binary search, how many of the neighbouring run
        come before it.
        """
        order = order.copy()
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.array([], dtype=int)
        size = np.diff(np.r_[first, len(group)])
        begin, count = np.repeat(first, size), np.repeat(size, size)
        rank = np.arange(len(group)) - begin
        width = 1
        while (active := np.flatnonzero(count > width)).size:
            r, base, n = rank[active], begin[active], count[active]
            run = r // width
            pair = (run // 2) * 2 * width
            # runs that are in order as they stand are not merged
            seam = active[r - pair == width]
            mixed_up = np.zeros(len(group), dtype=bool)
            mixed_up[seam[self.before(order[seam], order[seam - 1], np.zeros(len(seam), dtype=bool))] - width] = True
            some = np.flatnonzero(mixed_up[base + pair])
            if not len(some):
                width *= 2
                continue
            active, r, base, n, run, pair = (x[some] for x in (active, r, base, n, run, pair))
            left = run % 2 == 0
            lo = np.minimum(n, np.where(left, pair + width, pair))
            end = np.minimum(n, np.where(left, pair + 2 * width, pair + width))
            start, hi = lo.copy(), end.copy()
            me = order[active]
            while (live := np.flatnonzero(lo < hi)).size:
                mid = (lo[live] + hi[live]) >> 1
                # an equal one of the left run stays before one of the right run
                goes = self.before(order[base[live] + mid], me[live], ~left[live])
                lo[live] = np.where(goes, mid + 1, lo[live])
                hi[live] = np.where(goes, hi[live], mid)
            merged = order.copy()
            merged[base + pair + (r - run * width) + (lo - start)] = me
            order = merged
            width *= 2
        return order

    def equal_bytes(self, a: np.ndarray, b: np.ndarray) -> bool:
        span = np.arange(self.limit)
        return all((self.data[a[i : i + 65536, None] + span] == self.data[b[i : i + 65536, None] + span]).all() for i in range(0, len(a), 65536))


def repeated_windows(data: np.ndarray, starts: np.ndarray, group: np.ndarray, did: np.ndarray, window: int) -> np.ndarray:
    """Which of the windows at ``starts`` have an equal one, in the same
    group, with a smaller id."""
    gone = np.zeros(len(starts), dtype=bool)
    order = np.argsort(group)
    same = np.flatnonzero(group[order][1:] == group[order][:-1])
    order = order[R.distinct(np.concatenate((same, same + 1)))]  # groups of one have no partner
    if not len(order):
        return gone
    at, g = starts[order], group[order]
    # only bytes of windows that are sorted are hashed
    line = np.sort(at)
    far = np.flatnonzero(line[1:] > line[:-1] + window)
    begin, end = line[np.r_[0, far + 1]], line[np.r_[far, len(line) - 1]] + window
    size = end - begin
    moved = begin - (np.cumsum(size) - size)
    at = at - moved[np.searchsorted(begin, at, side="right") - 1]
    data = data[np.repeat(moved, size) + np.arange(size.sum())]
    base = int(R.BASE)
    while True:
        suffixes = Suffixes(data, window, base)
        # the sort moves starts; a start names its window
        sorted_at = suffixes.mergesort(at, g)
        equal = (g[1:] == g[:-1]) & (suffixes.piece(sorted_at[1:], window) == suffixes.piece(sorted_at[:-1], window))
        k = np.flatnonzero(equal)
        if suffixes.equal_bytes(sorted_at[k], sorted_at[k + 1]):
            break
        base = int(R.mixed(np.array([base], dtype=np.uint64))[0]) | 1
    place = np.empty(len(data) + 1, dtype=np.int64)
    place[at] = order
    who = place[sorted_at]
    first = np.flatnonzero(np.r_[True, ~equal])
    least = np.repeat(np.minimum.reduceat(did[who], first), np.diff(np.r_[first, len(who)]))
    gone[who] = did[who] > least
    return gone


def _joined(bodies: Iterable[bytes]) -> tuple[bytes, np.ndarray]:
    """The bodies one after another and eight bytes more, also as an array."""
    raw = b"".join([*bodies, bytes(8)])
    return raw, np.frombuffer(raw, dtype=np.uint8)


def _head(did: np.ndarray, row: np.ndarray, start: np.ndarray, windows: np.ndarray, anchor: np.ndarray) -> bytes:
    """The numbers of segments, rows of the block in order, in few bytes: steps
    between ids and rows, and all first bytes, all second bytes and so on."""
    steps = [np.diff(x, prepend=np.zeros(1, dtype=np.int64)) for x in (did, row)]
    columns = zip((*steps, start, windows, anchor), HEAD)
    return pa.compress(b"".join(np.ascontiguousarray(x.astype(t)).view(np.uint8).reshape(len(x), -1).T.tobytes() for x, t in columns), codec="zstd", asbytes=True)


def _unpack_head(head: bytes, n: int) -> list[np.ndarray]:
    """The columns of :func:`_head`, from ``n`` rows."""
    size = [np.dtype(t).itemsize for t in HEAD]
    planes = np.frombuffer(pa.decompress(head, n * sum(size), codec="zstd", asbytes=True), dtype=np.uint8).reshape(-1, n)
    edge = np.cumsum([0, *size])
    out = [np.ascontiguousarray(planes[a:b].T).view(t).ravel() for a, b, t in zip(edge, edge[1:], HEAD)]
    return [np.cumsum(out[0]), np.cumsum(out[1], dtype=np.int64), *out[2:]]


def _words(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> Iterator[np.ndarray]:
    """Eight bytes after eight of every segment (the last eight again for one
    that has ended); ``data`` goes on for eight bytes after the last."""
    word = np.ndarray(len(data) - 7, dtype="<u8", buffer=data.data, strides=(1,))
    last = np.maximum(length - 8, 0)
    for at in range(0, int(length.max(initial=0)), 8):
        yield word[begin + np.minimum(at, last)]


def alike(data: np.ndarray, begin: np.ndarray, length: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments in an order in which those with the same bytes and place of the
    anchor follow each other as they came, and where such a class begins.

    Hashes order them; the bytes are compared.  Should a hash have lied, a class
    may fall apart, which costs time and changes no result."""
    h = length.astype(np.uint64) * R.BASE + anchor.astype(np.uint64)
    for w in _words(data, begin, length):
        h = R.mixed(h ^ w)
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order][1:] == h[order][:-1])
    x, y = order[same], order[same + 1]
    equal = (length[x] == length[y]) & (anchor[x] == anchor[y])
    for w, v in zip(_words(data, begin[x], length[x]), _words(data, begin[y], length[y])):
        equal &= w == v
    first = np.ones(len(order), dtype=bool)
    first[same[equal] + 1] = False
    return order, np.flatnonzero(first)


def _windows_gone(data: np.ndarray, begin: np.ndarray, length: np.ndarray, anchor: np.ndarray, did: np.ndarray, cut: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Of distinct segments: segment and place in it of every window that an
    equal one with a smaller id makes redundant."""
    gram = np.zeros(len(begin), dtype=np.uint64)
    for j in range(cut):
        gram = gram * R.BASE + _BYTES[data[begin + anchor + j]]
    gram = R.mixed(gram)
    # segments of different grams never meet, so a large bucket is sorted in parts
    parts = -(-int(length.sum()) // PART_BYTES)
    edge = min(EDGE_GRAM, window)
    found = []
    for k in range(parts):
        some = np.flatnonzero(gram % np.uint64(parts) == k)
        n = length[some] - window + 1
        first = np.cumsum(n) - n
        group = np.empty(n.sum(), dtype=np.uint64)
        cuts = np.flatnonzero(np.diff(np.cumsum(length[some]) // (2 * PART_BYTES))) + 1
        for i, j in zip(np.r_[0, cuts].tolist(), np.r_[cuts, len(some)].tolist()):
            if i == j:
                continue
            few = some[i:j]
            size = length[few]
            at = np.cumsum(size) - size
            own = data[np.repeat(begin[few] - at, size) + np.arange(size.sum())]
            seg = np.repeat(np.arange(i, j), n[i:j])
            step = np.arange(first[i], first[i] + len(seg)) - first[seg]
            start = at[seg - i] + step
            # windows can only be equal if the gram stands at the same distance in them, and if they begin and end alike
            h = R.byte_grams(own, edge)
            g = gram[some][seg] * R.BASE + (anchor[some][seg] - step).astype(np.uint64)
            group[first[i] : first[i] + len(seg)] = R.mixed(R.mixed(g + h[start]) * R.BASE + h[start + (window - edge)])
        # a gram may be in more segments than a part should have: its windows are sorted in turns
        turns = len(cuts) + 1
        for q in range(turns):
            w = np.flatnonzero(group % np.uint64(turns) == q)
            seg = np.searchsorted(first, w, side="right") - 1
            step = w - first[seg]
            gone = np.flatnonzero(repeated_windows(data, begin[some[seg]] + step, group[w], did[some[seg]], window))
            found.append((some[seg[gone]], step[gone]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def finish(text: str, starts: np.ndarray, sizes: np.ndarray, window: int = WINDOW_BYTES) -> tuple[int, int, int, str, bytes]:
    """Bytes, removed bytes, removed runs, digest and bytes of what is kept."""
    data = text.encode("utf-8")
    if not len(starts):
        return len(data), 0, 0, hashlib.sha256(data).hexdigest(), data
    gone = R.covered(len(data), window, starts, sizes)
    kept = np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()
    spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
    return len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept


def suffix_dedup(docs: DataFrame, window: int = WINDOW_BYTES, id_col: str = "doc_id", text_col: str = "text", n_blocks: int | None = None, with_bytes: bool = True) -> DataFrame:
    """One row per document: ``id_col, n_bytes, n_removed, n_spans,
    kept_sha256`` and, if asked for, ``kept`` (the remaining bytes)."""
    width = shuffle_width(docs.sparkSession)
    n_anchor, n_cut = width, width
    probe, cut = min(PROBE_GRAM, window), min(CUT_GRAM, window)
    e = R.blocks(docs, id_col, text_col, n_blocks)

    def keys_of(pdf: pd.DataFrame) -> np.ndarray:
        texts = [t.encode("utf-8") for t in pdf["text"] if t]
        found = R.part_anchors(_joined(texts)[1], np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)), probe, window)
        return np.concatenate([np.array([], dtype=np.uint64), *(x.key for _, x in found)])

    def segments(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = R.ordered(left)
        columns = ["bucket", "from_blk", "n", "head", "body", "runs"]
        if not len(left):
            return pd.DataFrame(columns=columns)
        blk = int(left["blk"].iloc[0])
        ids = left["did"].to_numpy(dtype=np.int64)
        texts = [t.encode("utf-8") for t in left["text"]]
        length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        raw, data = _joined(texts)
        row, found = R.all_part_anchors(data, length, probe, window)
        hit = np.flatnonzero(R.occurs_again(found.key, right, n_anchor))
        if not len(hit):
            return pd.DataFrame(columns=columns)
        # neighbouring anchors' windows are one run
        row, first, size = row[hit], found.first[hit], found.size[hit]
        head = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (first[1:] != first[:-1] + size[:-1])])
        row, first, size = row[head], first[head], np.add.reduceat(size, head) + window - 1
        run, cuts = R.all_part_anchors(_joined(raw[a:b] for a, b in zip(first.tolist(), (first + size).tolist()))[1], size, cut, window)
        # one segment for each: row, where it starts in the block, windows, distance to its anchor, anchor key
        o, c, p, k = row[run], cuts.size, cuts.place - cuts.first, cuts.key
        at = cuts.first + (first - (np.cumsum(size) - size))[run]
        did, s = ids[o], at - (np.cumsum(length) - length)[o]
        # rows come in order of id: an equal segment of an earlier document decides
        order, start = alike(data, at, c - 1 + window, p)
        local = np.zeros(len(o), dtype=bool)
        local[order] = did[order] > np.repeat(did[order[start]], np.diff(np.r_[start, len(order)]))
        out = []
        if local.any():
            out.append((blk % n_cut, blk, 0, None, None, R.packed(o[local].astype(np.uint32), s[local], c[local])))
        sent = np.flatnonzero(~local)
        bucket = (k[sent] % np.uint64(n_cut)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sent, bucket = sent[order], bucket[order]
        edge = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
        for i, j in zip(edge.tolist(), edge[1:].tolist()):
            w = sent[i:j]
            body = b"".join([raw[a:b] for a, b in zip(at[w].tolist(), (at[w] + c[w] - 1 + window).tolist())])
            out.append((int(bucket[i]), blk, len(w), _head(did[w], o[w], s[w], c[w], p[w]), pa.compress(body, codec="zstd", asbytes=True), None))
        return pd.DataFrame(out, columns=columns)

    def sort_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(b, r) for b, r in zip(pdf["from_blk"], pdf["runs"]) if r is not None]
        some = [(b, _unpack_head(h, n), body) for b, n, h, body in zip(pdf["from_blk"], pdf["n"], pdf["head"], pdf["body"]) if n]
        if some:
            d, o, s, c, p = (np.concatenate([x[i] for _, x, _ in some]).astype(np.int64) for i in range(5))
            blk = np.repeat([b for b, _, _ in some], [len(x[0]) for _, x, _ in some])
            data = _joined(pa.decompress(body, int(x[3].sum()) + len(x[3]) * (window - 1), codec="zstd", asbytes=True) for _, x, body in some)[1]
            length = c - 1 + window
            begin = np.cumsum(length) - length
            # Equal segments are one class; only its least document has windows left to decide.
            order, first = alike(data, begin, length, p)
            cls = np.empty(len(d), dtype=np.int64)
            cls[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(d)]))
            least = np.minimum.reduceat(d[order], first)
            one = order[first]
            gone_cls, gone_step = _windows_gone(data, begin[one], length[one], p[one], least, cut, window)
            first = np.flatnonzero(d == least[cls])
            first = first[np.argsort(cls[first], kind="stable")]
            lo, hi = np.searchsorted(cls[first], gone_cls), np.searchsorted(cls[first], gone_cls, side="right")
            owner = first[np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())]
            rest = np.flatnonzero(d != least[cls])  # rows came block by block
            rest = rest[np.argsort(blk[rest], kind="stable")]
            out += R.removal_rows_by_block(blk[owner], o[owner], s[owner] + np.repeat(gone_step, hi - lo))
            out += R.runs_by_block(blk[rest], o[rest], s[rest], c[rest])
        return pd.DataFrame(out, columns=["blk", "runs"])

    replies = R.repeated_anchors(e, keys_of, n_anchor)
    sent = e.groupBy("blk").cogroup(replies.groupBy("blk")).applyInPandas(segments, "bucket int, from_blk int, n int, head binary, body binary, runs binary")
    removed = sent.groupBy("bucket").applyInPandas(sort_bucket, "blk int, runs binary")
    end = 5 if with_bytes else 4
    schema = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    return R.with_id(R.rebuilt(e, removed, window, lambda t, s, n: finish(t, s, n, window)[:end], schema), id_col)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), with_bytes=False)


#: DuckDB SQL for the rows of the query (ids not null, each once).
ORACLE_SQL = r"""
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), places AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 2) AS b, CASE WHEN 2 * i + 100 <= length(h) THEN substr(h, 2 * i + 1, 100) END AS k
  FROM bytes, unnest(range(0, length(h) // 2)) AS t(i)
), firsts AS (
  SELECT k, min(doc_id) AS first FROM places WHERE k IS NOT NULL GROUP BY k
), starts AS (
  SELECT p.doc_id, i, b, coalesce(first < p.doc_id, false) AS s FROM places p LEFT JOIN firsts f ON p.k = f.k
), cover AS (
  SELECT doc_id, i, b, bool_or(s) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS g FROM starts
), runs AS (
  SELECT *, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY i), false) AS head FROM cover
), found AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (g) AS r, count(*) FILTER (head) AS sp, string_agg(b, '' ORDER BY i) FILTER (NOT g) AS rest FROM runs GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_bytes, coalesce(r, 0) AS n_removed, coalesce(sp, 0) AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM bytes d LEFT JOIN found USING (doc_id)
"""
