"""Benchmark decontamination: test items that occur in training documents.

The test items are indexed with BM25; every passage of every document queries
the index.  Scores are divided by the score an item gets from its own text, so
one threshold fits short and long items.  Retrieval is exact and pruned the
block-max WAND way: items are numbered, numbers are cut into blocks, and a term
keeps the largest score it can give in each block.  A block whose terms cannot
reach the threshold together is skipped; in the others terms are taken from the
strongest on, and an item is given up when what it has and what the terms left
can still give stay below the threshold.

A retrieved item is verified on the passage (with what follows and precedes it,
one item's length each): the share of its ``QUESTION_GRAM`` word sequences found
has to reach the overlap.  A table has one text per item; its last third is
taken as the answer, and an item also counts as found if its question and its
answer (by ``ANSWER_GRAM`` word sequences) each reach the overlap.

Passages overlap by the longest item, so an item copied whole lies whole in a
passage.  The index travels to the tasks.  More than ``SHARD_ITEMS`` items never
meet on the driver: they are dealt into shards, weighted by the counts of all
items, and each shard meets all different texts, bucket by bucket, in tasks.

Edge cases: null or empty texts match nothing; items without a word are left
out; equal items are reported each; repeated documents are reported each; a
table without items gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spacetime.llm.common import documents, fresh, map_batches, map_rows, own_columns, stored

K1, B = 1.2, 0.75
THRESHOLD = 0.6
QUESTION_GRAM, ANSWER_GRAM = 5, 3
OVERLAP = 0.5
#: A passage is this many times the longest item.
PASSAGE_ITEMS = 4
BLOCK_ITEMS = 16
SHARD_ITEMS = 20_000
#: Different texts that meet a shard in one task, in characters together.
BUCKET_CHARS = 1 << 26

_HIT = "item_id long, score double, question_overlap double, answer_overlap double"

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams(ws: list[str], n: int) -> set[tuple[str, ...]]:
    n = max(1, min(n, len(ws)))
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}


def share_found(part: list[str], there: list[str], n: int) -> float:
    """Share of the word sequences of ``part`` that occur in ``there``."""
    n = max(1, min(n, len(part)))
    own = grams(part, n)
    return len(own & {tuple(there[i : i + n]) for i in range(len(there) - n + 1)}) / len(own) if own else 1.0


class Index:
    """BM25 inverted index of test items with block maxima."""

    def __init__(self, items: list[tuple[int, str | None, str | None]], table: tuple[int, float, int, dict[str, int]] | None = None):
        """``items``: id, question, answer (may be None).  ``table``: number,
        mean and greatest length of all items and how many hold each term, if
        ``items`` are only a part of them."""
        parts = [(i, words(q), words(a)) for i, q, a in items]
        self.items = [(i, q, a) for i, q, a in parts if q or a]
        docs = [Counter(q + a) for _, q, a in self.items]
        size = len(docs)
        length = np.array([sum(d.values()) for d in docs], dtype=float)
        if table is None:
            table = size, length.mean() if size else 1.0, int(length.max()) if size else 0, Counter(t for d in docs for t in d)
        n, mean, self.longest, df = table
        self.terms = {t: k for k, t in enumerate(sorted({t for d in docs for t in d}))}
        rows, cols, vals = [], [], []
        for j, d in enumerate(docs):
            w = {t: np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (K1 + 1) / (c + K1 * (1 - B + B * length[j] / mean)) for t, c in d.items()}
            own = sum(w.values())
            for t, x in w.items():
                rows.append(self.terms[t])
                cols.append(j)
                vals.append(x / own)
        order = np.lexsort((cols, rows)) if rows else np.array([], dtype=int)
        row = np.array(rows, dtype=np.int64)[order]
        self.post_item = np.array(cols, dtype=np.int32)[order]
        self.post_score = np.array(vals, dtype=np.float64)[order]
        self.post_at = np.searchsorted(row, np.arange(len(self.terms) + 1))
        self.best = np.zeros(len(self.terms))
        np.maximum.at(self.best, row, self.post_score)
        # per term: its blocks and the largest score in each
        self.blocks = -(-size // BLOCK_ITEMS)
        key = row * max(1, self.blocks) + self.post_item // BLOCK_ITEMS
        blocks, where = np.unique(key, return_inverse=True)
        top = np.zeros(len(blocks))
        np.maximum.at(top, where, self.post_score)
        self.block_id, self.block_top = (blocks % max(1, self.blocks)).astype(np.int32), top
        self.block_at = np.searchsorted(blocks // max(1, self.blocks), np.arange(len(self.terms) + 1))

    @staticmethod
    def _ranges(at: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Places of all entries of the ``terms`` in a list laid out by ``at``."""
        lo, size = at[terms], at[terms + 1] - at[terms]
        ends = np.cumsum(size)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - size), size)

    def search(self, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items (by number) scoring ``threshold`` or more for the distinct ``terms``."""
        if not len(terms) or self.best[terms].sum() < threshold:
            return []
        at = self._ranges(self.block_at, terms)
        bound = np.bincount(self.block_id[at], weights=self.block_top[at], minlength=self.blocks)
        alive = bound >= threshold - 1e-9
        if not alive.any():
            return []
        terms = terms[np.argsort(-self.best[terms], kind="stable")]
        left = np.concatenate((np.cumsum(self.best[terms][::-1])[::-1], [0.0]))
        # Terms after `pivot` cannot reach the threshold alone: only items met before it can.
        pivot = int(np.searchsorted(-left, -(threshold - 1e-9), side="right"))
        at = self._ranges(self.post_at, terms[:pivot])
        at = at[alive[self.post_item[at] // BLOCK_ITEMS]]
        score = np.bincount(self.post_item[at], weights=self.post_score[at], minlength=len(self.items))
        open_ = np.flatnonzero((score > 0) & (score + left[pivot] >= threshold - 1e-9))
        if len(open_) and pivot < len(terms):
            at = self._ranges(self.post_at, terms[pivot:])
            score += np.bincount(self.post_item[at], weights=self.post_score[at], minlength=len(self.items))
        return [(int(j), float(score[j])) for j in open_ if score[j] >= threshold - 1e-9]

    def leaks(self, text: str | None, threshold: float, overlap: float) -> list[tuple[int, float, float, float]]:
        """``(item id, score, question share, answer share)`` of the verified
        items of a whole text, best passage each."""
        ws = words(text)
        if not ws or not self.items:
            return []
        get = self.terms.get
        ids = np.fromiter(map(get, ws, repeat(-1)), dtype=np.int32, count=len(ws))
        size = PASSAGE_ITEMS * self.longest
        step = size - self.longest
        found: dict[int, tuple[int, float, float, float]] = {}
        for a in range(0, max(1, len(ws) - self.longest), step):
            terms = np.unique(ids[a : a + size])
            for j, score in self.search(terms[np.searchsorted(terms, 0) :], threshold):
                item, question, answer = self.items[j]
                there = ws[max(0, a - self.longest) : a + size + self.longest]
                q, r = share_found(question, there, QUESTION_GRAM), share_found(answer, there, ANSWER_GRAM)
                whole = share_found(question + answer, there, QUESTION_GRAM)
                if (whole >= overlap or (q >= overlap and r >= overlap)) and (j not in found or found[j][1:] < (score, q, r)):
                    found[j] = (item, score, q, r)
        return sorted(found.values(), key=lambda x: (x[0] is not None, x[0] or 0))


def split_item(text: str | None) -> tuple[str | None, str | None]:
    """Question and answer of an item given as one text."""
    ws = words(text)
    cut = len(ws) - len(ws) // 3
    return " ".join(ws[:cut]), " ".join(ws[cut:])


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and test item found in it: ``id_col, item_id,
    score, question_overlap, answer_overlap``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = item_table(items, item_col, item_text_col)
    index = small_index(chosen)
    if index is None:
        found = sharded(src.select("text"), chosen, threshold, overlap)
        return src.select(F.col("id").alias(id_col), F.sha2("text", 256).alias("h")).join(found, "h").drop("h")

    def make(batch: pa.RecordBatch) -> list:
        out = [(d, *hit) for d, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()) for hit in index.leaks(t, threshold, overlap)]
        return [list(c) for c in zip(*out)] or [[]] * 5

    return map_batches(src, make, f"{id_col} {src.schema['id'].dataType.simpleString()}, {_HIT}")


def item_table(items: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """The test items that have a text as ``i, t``."""
    return items.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t"))


def small_index(chosen: DataFrame) -> Index | None:
    """The index of all items, None if they are more than ``SHARD_ITEMS``."""
    some = chosen.limit(SHARD_ITEMS + 1).collect()
    return Index([(r["i"], *split_item(r["t"])) for r in sorted(some, key=lambda r: (r["i"] is not None, r["i"] or 0, r["t"]))]) if len(some) <= SHARD_ITEMS else None


def sharded(texts: DataFrame, chosen: DataFrame, threshold: float, overlap: float) -> DataFrame:
    """``h`` (SHA-256) of every different text and its verified items, with
    the items dealt into shards."""

    def split(batch: pa.RecordBatch) -> list:
        split_up = list(map(words, batch.column("t").to_pylist()))
        return [*batch.columns, list(map(len, split_up)), [sorted(set(ws)) for ws in split_up]]

    numbered = stored(chosen.select(F.monotonically_increasing_id().alias("no"), "i", "t"), "test-items")
    known = stored(map_batches(numbered, split, "no long, i long, t string, size long, terms array<string>").where("size > 0"), "test-item-terms")
    n, mean, longest = known.agg(F.count(F.lit(1)), F.avg("size"), F.max("size")).first()
    each = known.select("no", F.explode("terms").alias("term"))
    df = each.join(each.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term").groupBy("no").agg(F.map_from_entries(F.collect_list(F.struct("term", "df"))).alias("df"))
    shards = -(-n // SHARD_ITEMS) or 1
    different = stored(texts.where("text is not null").select(F.sha2("text", 256).alias("h"), "text").distinct(), "different-texts")
    chars = different.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 + chars // BUCKET_CHARS
    numbers = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    dealt = known.join(df, "no").select(F.pmod(F.xxhash64("no"), F.lit(shards)).cast("int").alias("shard"), numbers(buckets).alias("bucket"), "i", "t", "df")
    asked = different.select(numbers(shards).alias("shard"), F.pmod(F.xxhash64("h"), F.lit(buckets)).cast("int").alias("bucket"), "h", "text")
    schema = to_arrow_schema(StructType.fromDDL(f"h string, {_HIT}"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        counts = {t: k for pairs in right.column("df").to_pylist() for t, k in pairs}
        index = Index([(i, *split_item(t)) for i, t in zip(right.column("i").to_pylist(), right.column("t").to_pylist())], (n, mean, longest, counts))
        out = [(h, *hit) for h, t in zip(left.column("h").to_pylist(), left.column("text").to_pylist()) for hit in index.leaks(t, threshold, overlap)]
        return pa.table([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [()] * 5, schema)], names=schema.names)

    return asked.groupBy("shard", "bucket").cogroup(dealt.groupBy("shard", "bucket")).applyInArrow(run, f"h string, {_HIT}")


def without_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, in which no test item is found."""
    at = docs.columns.index(text_col)
    chosen = item_table(items, item_col, item_text_col)
    index = small_index(chosen)
    if index is None:
        bad = sharded(docs.select(F.col(text_col).alias("text")), chosen, threshold, overlap).select("h").distinct()
        h = fresh(docs, "text_hash")
        return docs.withColumn(h, F.sha2(text_col, 256)).join(bad.withColumnRenamed("h", h), h, "left_anti").select(*own_columns(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not index.leaks(t, threshold, overlap) for t in batch.column(at).to_pylist()], pa.bool_()))

    return map_rows(docs, run)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return leaks(documents(spark, sf_dir), items)
