"""Passages that occur more than once, found without comparing documents.

Shared by the substring and suffix-order deduplications.  Texts are dealt once
into blocks by a hash of the document's id and text; every stage groups the same
exchange by block.  A stage answers questions about keys: each block sends every
key it has once (whatever a key occurs inside a block is settled there), keys
meet in buckets by hash, and each bucket answers the blocks.  So a key that a
third of all documents share costs one entry per block, and no task holds more
than a block of texts or a bucket of entries.

A window's *anchor* is the gram with the smallest hash inside it (the leftmost
of equals).  Equal windows have equal anchors, so a window can only be repeated
if its anchor gram is; there are far fewer anchors than windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spacetime.llm.common import shuffle_width

BASE = np.uint64(0x9E3779B97F4A7C15)
#: Low bits of a packed anchor: its place in a section; the rest is its hash.
PLACE_BITS = np.uint64(24)
PLACE_MASK = np.uint64((1 << 24) - 1)
SECTION = 1 << 23
NO_ID = (1 << 63) - 1
#: Bytes of text for which there is a block.
BLOCK_BYTES = 16 << 20
#: Units of short texts that are hashed together.
BATCH = 1 << 16


def blocks(docs: DataFrame, id_col: str, text_col: str, n_blocks: int | None = None) -> DataFrame:
    """``blk, did, turn, missing, text``: ids as long, a null id after all others.

    ``turn`` is a hash of id and text; blocks are ranges of it, so rows that
    share an id (or have none) are dealt out too, and the rows of one id keep
    the order of their turns within a block and between blocks.  By itself there
    is a block for ``BLOCK_BYTES`` of text and two for a shuffle partition."""
    did = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    n = n_blocks
    if n is None:
        size = docs.agg(F.sum(F.octet_length(text_col).cast("double"))).first()[0] or 0.0
        n = max(2 * shuffle_width(docs.sparkSession), int(size / BLOCK_BYTES) + 1)
    src = docs.select(did.alias("did"), F.col(id_col).isNull().alias("missing"), F.col(text_col).alias("text"))
    turned = src.withColumn("turn", F.shiftrightunsigned(F.xxhash64("did", "text"), 1))
    return turned.select(F.least(F.lit(n - 1), F.call_function("div", F.col("turn"), F.lit(min(NO_ID, NO_ID // n + 1)))).cast("int").alias("blk"), "did", "turn", "missing", "text")


def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    """A block's rows in the order every stage uses: by id, then turn and text."""
    return pdf.assign(text=pdf["text"].fillna("")).sort_values(["did", "turn", "text"], kind="stable").reset_index(drop=True)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def gram_hashes(units: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive units, by doubling: the hash
    of 2m units is made of two hashes of m units."""
    out, done, power, m = None, 0, units, 1
    base = int(BASE)
    while True:
        if n & m:
            if out is None:
                out, done = power, m
            else:
                k = len(units) - done - m + 1
                out, done = out[:k] * np.uint64(base) + power[done : done + k], done + m
        if 2 * m > n:
            return out[: len(units) - n + 1]
        k = len(units) - 2 * m + 1
        power = power[:k] * np.uint64(base) + power[m : m + k]
        base, m = base * base % (1 << 64), 2 * m


def sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    m = 1
    while 2 * m <= n:
        a = np.minimum(a[:-m], a[m:])
        m *= 2
    return a if m == n else np.minimum(a[: len(a) - (n - m)], a[n - m :])


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive bytes, eight bytes at a time."""
    if n < 8:
        return gram_hashes(data.astype(np.uint64) + np.uint64(1), n)
    k = max(0, len(data) - n + 1)
    out = np.zeros(k, dtype=np.uint64)
    for at in [*range(0, n - 8, 8), n - 8]:
        out *= BASE
        out += np.ndarray(k, dtype="<u8", buffer=data.data, offset=at, strides=(1,)) if k else out
    return out


class Anchors(NamedTuple):
    """Runs of windows that have their anchor in one place, along a text."""

    first: np.ndarray  # first window of the run
    size: np.ndarray  # windows in it
    key: np.ndarray  # hash of the anchor gram, 40 bits
    place: np.ndarray  # where the anchor gram starts


def anchors(units: np.ndarray, gram: int, window: int, hashes: Callable[[np.ndarray, int], np.ndarray] = gram_hashes, breaks: np.ndarray | None = None) -> Anchors:
    """The anchors of all windows of a text, given as units that ``hashes``
    makes gram hashes of; runs also end where a window of ``breaks`` starts."""
    windows = len(units) - window + 1
    first, low = [], []
    for a in range(0, windows, SECTION):
        h = mixed(hashes(units[a : min(windows, a + SECTION) + window - 1], gram))
        h &= ~PLACE_MASK
        h |= np.arange(len(h), dtype=np.uint64)
        least = sliding_min(h, window - gram + 1)
        ends = least[1:] != least[:-1]
        if breaks is not None:
            ends[breaks[(breaks > a) & (breaks - a <= len(ends))] - a - 1] = True
        f = np.flatnonzero(ends) + 1
        f = np.concatenate((np.zeros(1, dtype=np.int64), f))
        first.append(f + a)
        low.append(least[f])
    if not first:
        none = np.zeros(0, dtype=np.int64)
        return Anchors(none, none, none.astype(np.uint64), none)
    section = np.repeat(np.arange(len(first)) * SECTION, [len(f) for f in first])
    f, low = np.concatenate(first), np.concatenate(low)
    return Anchors(f, np.diff(np.append(f, windows)), low >> PLACE_BITS, (low & PLACE_MASK).astype(np.int64) + section)


def part_anchors(data: np.ndarray, length: np.ndarray, gram: int, window: int, hashes: Callable[[np.ndarray, int], np.ndarray] = byte_grams) -> Iterator[tuple[np.ndarray, Anchors]]:
    """The anchors of the windows within each of the parts, of ``length`` units,
    that ``data`` begins with, and the part of each.  Windows and places count
    along ``data``; short parts are looked at together, as each call costs."""
    end = np.cumsum(length)
    begin = end - length
    last = np.maximum(begin, end - window + 1)  # no window of the part starts here or later
    cut = np.flatnonzero(np.diff(end // BATCH)) + 1
    for i, j in zip(np.r_[0, cut].tolist(), np.r_[cut, len(length)].tolist()):
        if i == j or end[j - 1] - begin[i] < window:
            continue
        a = begin[i]
        x = anchors(data[a : end[j - 1]], gram, window, hashes, np.concatenate((begin[i:j], last[i:j])) - a)
        part = np.searchsorted(begin[i:j], x.first + a, side="right") - 1 + i
        ok = np.flatnonzero(x.first + a < last[part])
        yield part[ok], Anchors(x.first[ok] + a, x.size[ok], x.key[ok], x.place[ok] + a)


def all_part_anchors(data: np.ndarray, length: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, Anchors]:
    """All that :func:`part_anchors` finds."""
    none = np.zeros(0, dtype=np.int64)
    found = [(none, *Anchors(none, none, none.astype(np.uint64), none)), *((part, *x) for part, x in part_anchors(data, length, gram, window))]
    part, *rest = map(np.concatenate, zip(*found))
    return part, Anchors(*rest)


def packed(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpacked(data: bytes, *dtypes: str) -> list[np.ndarray]:
    """The arrays of equal length that :func:`packed` put together."""
    n = len(data) // sum(np.dtype(d).itemsize for d in dtypes)
    out, at = [], 0
    for d in dtypes:
        out.append(np.frombuffer(data, dtype=d, count=n, offset=at))
        at += n * np.dtype(d).itemsize
    return out


def repeated_anchors(e: DataFrame, keys_of: Callable[[pd.DataFrame], np.ndarray], buckets: int) -> DataFrame:
    """``blk, keys``: the anchor keys of each block that other blocks have too.

    ``keys_of`` gives a block's distinct keys.  Within a bucket 32 bits tell keys
    apart; a chance agreement only lets a window through to the next stage.
    """

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = distinct(keys_of(pdf))
        bucket = keys % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, short = bucket[order].astype(np.int64), (keys[order] // np.uint64(buckets)).astype(np.uint32)
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.array([], dtype=int)
        end = np.r_[at[1:], len(bucket)]
        return pd.DataFrame({"bucket": bucket[at].astype(np.int32), "from_blk": np.full(len(at), pdf["blk"].iloc[0], dtype=np.int32), "keys": [short[a:b].tobytes() for a, b in zip(at, end)]})

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = np.uint64(pdf["bucket"].iloc[0])
        size = pdf["keys"].map(len).to_numpy() // 4
        # one sort for all blocks: what is done for a block must not grow with the bucket
        every = np.frombuffer(b"".join(pdf["keys"]), dtype=np.uint32).astype(np.uint64) << np.uint64(32)
        every |= np.repeat(np.arange(len(size), dtype=np.uint64), size)
        every = distinct(every)
        keys = every >> np.uint64(32)
        same = keys[1:] == keys[:-1]
        twice = np.flatnonzero(np.r_[same, False] | np.r_[False, same])
        row = (every[twice] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        order = np.argsort(row, kind="stable")
        keys = keys[twice[order]] * np.uint64(buckets) + bucket
        at = np.searchsorted(row[order], np.arange(len(size) + 1)).tolist()
        out = [(blk, keys[a:b].tobytes()) for blk, a, b in zip(pdf["from_blk"], at, at[1:]) if a < b]
        return pd.DataFrame(out, columns=["blk", "keys"])

    sent = e.groupBy("blk").applyInPandas(send, "bucket int, from_blk int, keys binary")
    return sent.groupBy("bucket").applyInPandas(answer, "blk int, keys binary")


def distinct(a: np.ndarray) -> np.ndarray:
    """``a`` sorted, each value once; numpy's own hashes them first, which costs
    many times the sort."""
    a = np.sort(a)
    return a[np.flatnonzero(np.r_[True, a[1:] != a[:-1]])] if len(a) else a


def known_keys(replies: pd.DataFrame, buckets: int) -> np.ndarray:
    """The sorted keys of a block's replies, as :func:`short_key` gives them."""
    return distinct(np.concatenate([np.frombuffer(k, dtype=np.uint64) for k in replies["keys"]])) if len(replies) else np.array([], dtype=np.uint64)


def short_key(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Anchor keys as they come back: bucket and the 32 bits kept in it."""
    b = np.uint64(buckets)
    return (keys // b).astype(np.uint32).astype(np.uint64) * b + keys % b


def occurs_again(keys: np.ndarray, replies: pd.DataFrame, buckets: int) -> np.ndarray:
    """Which anchors (all of a block) have a gram that occurs elsewhere: in
    another block by the replies, or a second time in this block."""
    every = np.sort(keys)
    local = distinct(every[1:][every[1:] == every[:-1]])
    return member(keys, local) | member(short_key(keys, buckets), known_keys(replies, buckets))


def candidate_runs(found: Iterable[Anchors], replies: pd.DataFrame, buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per document (its :func:`anchors`) the runs, as starts and lengths, of
    windows whose anchor gram occurs elsewhere: in another block by the replies,
    or a second time in this block, be it in the same document."""
    kept = list(found)
    keys = np.concatenate([x.key for x in kept]) if kept else np.array([], dtype=np.uint64)
    hits = occurs_again(keys, replies, buckets)
    out, at = [], 0
    for x in kept:
        hit = np.flatnonzero(hits[at : at + len(x.key)])
        at += len(x.key)
        first, size = x.first[hit], x.size[hit]
        # neighbouring anchors' windows are one run
        head = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1] + size[:-1]))) if len(hit) else hit
        out.append((first[head], np.add.reduceat(size, head) if len(hit) else size))
    return out


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def removal_rows(ords: np.ndarray, places: np.ndarray) -> bytes:
    """Windows (row of the block, start) as packed runs, sorted."""
    order = np.lexsort((places, ords))
    o, p = ords[order].astype(np.int64), places[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(o) != 0) | (np.diff(p) != 1)]) if len(o) else np.array([], dtype=int)
    size = np.diff(np.r_[first, len(o)])
    return packed(o[first].astype(np.uint32), p[first].astype(np.int64), size.astype(np.int64))


def removal_rows_by_block(blk: np.ndarray, ords: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Each block and its :func:`removal_rows`, from the windows of all blocks."""
    order = np.lexsort((places, ords, blk))
    b, o, p = blk[order], ords[order].astype(np.int64), places[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(b) != 0) | (np.diff(o) != 0) | (np.diff(p) != 1)]) if len(b) else np.array([], dtype=int)
    size = np.diff(np.r_[first, len(b)])
    yield from runs_by_block(b[first], o[first], p[first], size)


def runs_by_block(blk: np.ndarray, ords: np.ndarray, places: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Each block and its runs, packed; rows of ``blk`` in order."""
    at = np.flatnonzero(np.r_[True, blk[1:] != blk[:-1]]) if len(blk) else np.array([], dtype=int)
    for a, b in zip(at.tolist(), np.r_[at[1:], len(blk)].tolist()):
        yield int(blk[a]), packed(ords[a:b].astype(np.uint32), places[a:b].astype(np.int64), size[a:b].astype(np.int64))


def covered(n: int, window: int, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which of ``n`` units lie in a window starting in one of the runs."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(n, starts + sizes - 1 + window), -1)
    return np.cumsum(step[:-1]) > 0


def rebuilt(e: DataFrame, removed: DataFrame, window: int, finish: Callable[[str, np.ndarray, np.ndarray], tuple], schema: str) -> DataFrame:
    """Apply ``finish(text, run starts, run lengths)`` to every row;
    ``removed`` has ``blk, runs`` as :func:`removal_rows` packs them."""
    names = [c.split()[0] for c in schema.split(",")]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = ordered(left)
        got = [unpacked_runs(r) for r in right["runs"]]
        o = np.concatenate([g[0] for g in got]) if got else np.array([], dtype=np.uint32)
        p = np.concatenate([g[1] for g in got]) if got else np.array([], dtype=np.int64)
        s = np.concatenate([g[2] for g in got]) if got else np.array([], dtype=np.int64)
        order = np.argsort(o, kind="stable")
        o, p, s = o[order], p[order], s[order]
        at = np.searchsorted(o, np.arange(len(left) + 1))
        rows = [finish(t, p[at[i] : at[i + 1]], s[at[i] : at[i + 1]]) for i, t in enumerate(left["text"])]
        out = pd.DataFrame(rows, columns=names)
        out.insert(0, "did", left["did"])
        out.insert(1, "missing", left["missing"])
        return out

    return e.groupBy("blk").cogroup(removed.groupBy("blk")).applyInPandas(run, f"did long, missing boolean, {schema}")


def unpacked_runs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    o, p, s = unpacked(data, "uint32", "int64", "int64")
    return o, p, s


def with_id(out: DataFrame, id_col: str) -> DataFrame:
    did = F.when(~F.col("missing"), F.col("did")).alias(id_col)
    return out.select(did, *[c for c in out.columns if c not in ("did", "missing")])
