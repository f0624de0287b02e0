"""SimHash near-duplicate groups by segment-popcount embedding.

A document's fingerprint has 64 bits, by majority over the XXH64 of its word
shingles.  A fingerprint is cut into ``segments`` and embedded as the vector of
the segments' bit counts: the Manhattan distance of two vectors never exceeds
the number of differing bits, so fingerprints within ``max_bits`` lie in
vectors within ``max_bits``.  The range join on that integer grid puts every
vector into each grid point at distance ``max_bits / 2`` (rounded up) at most;
two vectors within range always meet in such a point.  Fingerprints that meet
are verified bit by bit.

Equal fingerprints are one node, so copies cost nothing.  A grid point with
more than ``dense`` fingerprints is not compared pairwise: each of its members
lists the words within half the distance of it, and members sharing a word are
linked to the smallest of them.  For an even ``max_bits`` sharing such a word
is the same as being within ``max_bits``, so no link is lost and none is made up
(odd distances always compare pairs).

Edge cases: null, empty or blank text has fingerprint zero and is linked like
any other; a text with fewer words than a shingle is one shingle; repeated rows
get the same class; a null ``doc_id`` is never the class id unless all are null.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.llm.common import documents, fresh, map_batches, own_columns, shuffle_width, stored
from spacetime.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
SEGMENTS = 16
DENSE = 64
#: Shingle hashes turned into bit counts at once.
BLOCK = 65536

_COUNTS = np.array([bin(i).count("1") for i in range(65536)], dtype=np.uint8)
_ONE = np.uint64(1)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = text.encode("utf-8").lower().split() if text else []  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, BLOCK):
        b, e = begins[i : min(n, i + BLOCK)].tolist(), ends[i + k - 1 : min(n, i + BLOCK) + k - 1].tolist()
        h = np.fromiter((digest(joined[x:y], SEED) for x, y in zip(b, e)), dtype=np.uint64, count=len(b))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((ones * 2 > n).astype(np.uint64) @ (_ONE << np.arange(64, dtype=np.uint64)))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, h, fp`` per row: a hash of the text, and the fingerprint's bits as
    a signed long."""

    def make(batch: pa.RecordBatch) -> list:
        fps = np.array([fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        return [batch.column("id"), batch.column("h"), fps.view(np.int64)]

    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    return map_batches(src, make, f"id {src.schema['id'].dataType.simpleString()}, h long, fp long")


def popcount(x: np.ndarray) -> np.ndarray:
    return sum(_COUNTS[(x >> np.uint64(s)) & np.uint64(0xFFFF)] for s in (0, 16, 32, 48)).astype(np.int64)


def grid_points(fps: np.ndarray, segments: int, reach: int) -> np.ndarray:
    """Codes of the grid points within ``reach`` of each fingerprint's vector,
    one row per fingerprint.  A code is a linear form of the vector with odd
    random-looking coefficients modulo 2**64; equal points have equal codes,
    and unequal ones that share a code only add a comparison."""
    width = 64 // segments
    mask = np.uint64((1 << width) - 1)
    coef = np.array([xxhash.xxh64_intdigest(bytes([j]), SEED) | 1 for j in range(segments)], dtype=np.uint64)
    with np.errstate(over="ignore"):
        code = np.zeros(len(fps), dtype=np.uint64)
        for j in range(segments):
            code += popcount((fps >> np.uint64(j * width)) & mask).astype(np.uint64) * coef[j]
        steps = {(0,) * segments}
        for _ in range(reach):
            steps |= {s[:j] + (s[j] + d,) + s[j + 1 :] for s in steps for j in range(segments) for d in (1, -1)}
        moves = np.array([sum(int(c) * d for c, d in zip(coef, s)) % (1 << 64) for s in sorted(steps)], dtype=np.uint64)
        return code[:, None] + moves[None, :]


def links_of_cells(keys: np.ndarray, fps: np.ndarray, max_bits: int, dense: int) -> np.ndarray:
    """Edges (pairs of fingerprints) among members of equal ``keys``: all links
    of small cells, links with the same components for dense ones."""
    order = np.lexsort((fps, keys))
    keys, fps = keys[order], fps[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[first, len(keys)])
    cell = np.repeat(np.arange(len(first)), size)
    crowded = (size > dense)[cell] if max_bits % 2 == 0 else np.zeros(len(keys), dtype=bool)
    out = []
    for s in range(1, int(size[(size <= dense) | (max_bits % 2 == 1)].max(initial=1))):
        i = np.flatnonzero((cell[s:] == cell[:-s]) & ~crowded[s:])
        i = i[popcount(fps[i] ^ fps[i + s]) <= max_bits]
        out.append(np.stack([fps[i], fps[i + s]], axis=1))
    flips = [np.bitwise_or.reduce(_ONE << np.array(c, dtype=np.uint64)) if c else np.uint64(0) for r in range(max_bits // 2 + 1) for c in itertools.combinations(range(64), r)]
    for c in np.flatnonzero(size > dense) if max_bits % 2 == 0 else []:
        f = fps[first[c] : first[c] + size[c]]
        # every word within half the distance, with the smallest member near it
        word = (f[:, None] ^ np.array(flips, dtype=np.uint64)[None, :]).ravel()
        member = np.repeat(f, len(flips))
        o = np.lexsort((member, word))
        word, member = word[o], member[o]
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        least = np.repeat(member[starts], np.diff(np.r_[starts, len(word)]))
        edge = least != member
        out.append(np.unique(np.stack([least[edge], member[edge]], axis=1), axis=0))
    return np.unique(np.concatenate(out), axis=0) if out else np.empty((0, 2), dtype=np.uint64)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, dense: int = DENSE, buckets: int | None = None) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``): every
    pair within ``max_bits`` is an edge or joined by a path of edges, and every
    edge is such a pair."""
    buckets = buckets or 4 * shuffle_width(distinct.sparkSession)
    reach = -(-max_bits // 2)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fps = pdf["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for i in range(0, len(fps), 4096):
                part = fps[i : i + 4096]
                codes = grid_points(part, segments, reach)
                flat, owner = codes.ravel(), np.repeat(part, codes.shape[1])
                yield pd.DataFrame({"bucket": ((flat >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32), "cell": flat.view(np.int64), "fp": owner.view(np.int64)})

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        e = links_of_cells(pdf["cell"].to_numpy().view(np.uint64), pdf["fp"].to_numpy().view(np.uint64), max_bits, dense).view(np.int64)
        return pd.DataFrame({"a": e[:, 0], "b": e[:, 1]})

    placed = distinct.select("fp").mapInPandas(place, "bucket int, cell long, fp long")
    return placed.groupBy("bucket").applyInPandas(verify, "a long, b long").distinct()


def fingerprint_classes(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """``fp, root``: every fingerprint with the smallest one it is linked to."""
    nodes = stored(fps.select("fp").distinct(), "nodes")
    roots = components(links(nodes, max_bits, segments, dense))
    return stored(nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root")), "roots")


def simhash_components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, segments: int = SEGMENTS, dense: int = DENSE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links."""
    fps = stored(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    named = fingerprint_classes(fps, max_bits, segments, dense)
    # ids meet their fingerprint first, so a class is a row per fingerprint
    least = fps.groupBy("fp").agg(F.min("id").alias("least"))
    ids = named.join(least, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id, then the
    smallest text hash; a null id only if the group has no other.  All columns
    stay; of repeated rows one stays."""
    fps = stored(fingerprints(docs, shingle_words, id_col, text_col), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id").alias("id"), F.col("h").alias("h"))
    best = fps.groupBy("fp").agg(F.min(order).alias("best")).join(fingerprint_classes(fps, max_bits), "fp")
    kept = best.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.id").alias("kept_id"), F.col("best.h").alias("kept_h"))
    h = fresh(docs, "text_hash")
    keyed = docs.withColumn(h, F.xxhash64(text_col))
    found = keyed.alias("d").join(kept.alias("k"), F.col(f"d.{id_col}").eqNullSafe(F.col("k.kept_id")) & (F.col(f"d.{h}") == F.col("k.kept_h")), "left_semi")
    return found.dropDuplicates([id_col, h]).select(*own_columns(docs))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(documents(spark, sf_dir))
