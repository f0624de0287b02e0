"""Substring deduplication over words, by level-wise doubling.

Level one looks at windows of ``window / 2`` words: a window of that length
repeated anywhere is a candidate.  Candidates are extended to twice the length
and only those repeated at the new length survive, until the wanted length is
reached or none survive.  Of level one only the windows that anchor a window of
the final length are looked at (see ``repeats``), which drops none: the anchors
of equal windows are equal.  At the last level a window's 96-bit key meets the
keys of the other blocks, and all but the first occurrence (by id, then a hash
of id and text, then place) are removed.

Edge cases: null, empty or short texts lose nothing; rows with one id count as
one document, the rows in order of that hash; a null id comes after all others;
an empty table gives no rows; a very long text is read whole, in one block;
columns of any other name are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession

from spacetime.llm import repeats as R
from spacetime.llm.common import documents, shuffle_width

WINDOW_WORDS = 20
MAX_WORDS = 300_000

_words: dict[bytes, int] = {}


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word; words seen lately are remembered."""
    ws = text.encode("utf-8").split()
    if len(_words) > MAX_WORDS:
        _words.clear()
    try:
        return np.fromiter(map(_words.__getitem__, ws), dtype=np.uint64, count=len(ws))
    except KeyError:
        for w in set(ws).difference(_words):
            _words[w] = xxhash.xxh64_intdigest(w, 42)
        return np.fromiter(map(_words.__getitem__, ws), dtype=np.uint64, count=len(ws))


def finish(text: str, starts: np.ndarray, sizes: np.ndarray, window: int = WINDOW_WORDS) -> tuple[int, int, str, str]:
    """Words, removed words, digest and text of what is kept."""
    ws = text.encode("utf-8").split()
    if len(starts):
        gone = R.covered(len(ws), window, starts, sizes)
        kept = [w for w, g in zip(ws, gone.tolist()) if not g]
    else:
        kept = ws
    joined = b" ".join(kept)
    return len(ws), len(ws) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8")


def substring_dedup(docs: DataFrame, window: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text", n_blocks: int | None = None, with_text: bool = True) -> DataFrame:
    """One row per document: ``id_col, n_words, n_removed, kept_sha256`` and,
    if asked for, ``kept_text`` (kept words joined by one space)."""
    half = window // 2
    width = shuffle_width(docs.sparkSession)
    n_anchor, n_window = width, width
    e = R.blocks(docs, id_col, text_col, n_blocks)

    def keys_of(pdf: pd.DataFrame) -> np.ndarray:
        return np.concatenate([R.anchors(word_hashes(t), half, window).key for t in pdf["text"] if t] or [np.array([], dtype=np.uint64)])

    def extend(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = R.ordered(left)
        if not len(left):
            return pd.DataFrame(columns=["bucket", "from_blk", "windows", "runs"])
        blk = left["blk"].iloc[0]
        units = [word_hashes(t) for t in left["text"]]
        wanted = R.candidate_runs((R.anchors(u, half, window) for u in units), right, n_anchor)
        h1, h2, o, p = [], [], [], []
        for i, (u, (first, size)) in enumerate(zip(units, wanted)):
            if len(first):
                at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
                h1.append(R.mixed(R.gram_hashes(u, window))[at])
                h2.append((R.mixed(R.gram_hashes(R.mixed(u + np.uint64(1)), window))[at] >> np.uint64(32)).astype(np.uint32))
                o.append(np.full(len(at), i, dtype=np.uint32))
                p.append(at)
        if not h1:
            return pd.DataFrame(columns=["bucket", "from_blk", "windows", "runs"])
        a, b, o, p = map(np.concatenate, (h1, h2, o, p))
        order = np.lexsort((p, o, b, a))
        same = np.r_[False, (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])]
        # all but the first occurrence inside the block are removed, whatever others have
        again = np.sort(order[same])
        first = np.sort(order[~same])
        out = [(int(blk) % n_window, blk, None, R.removal_rows(o[again], p[again]))] if len(again) else []
        did = left["did"].to_numpy(dtype=np.int64)[o[first]]
        a, b, o, p = a[first], b[first], o[first], p[first].astype(np.uint32)
        bucket = (a % np.uint64(n_window)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(n_window + 1))
        for k in range(n_window):
            w = order[bounds[k] : bounds[k + 1]]
            if len(w):
                out.append((k, blk, R.packed(a[w], did[w], b[w], o[w], p[w]), None))
        return pd.DataFrame(out, columns=["bucket", "from_blk", "windows", "runs"])

    def first_occurrence(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [(blk, r) for blk, r in zip(pdf["from_blk"], pdf["runs"]) if r is not None]
        some = [(blk, R.unpacked(w, "uint64", "int64", "uint32", "uint32", "uint32")) for blk, w in zip(pdf["from_blk"], pdf["windows"]) if w is not None]
        if some:
            a, did, b, o, p = (np.concatenate([x[i] for _, x in some]) for i in range(5))
            blk = np.concatenate([np.full(len(x[0]), k) for k, x in some])
            # rows of one id in several blocks: blocks follow their turns
            order = np.lexsort((blk, did, b, a))
            gone = order[np.r_[False, (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])]]
            for k in np.unique(blk[gone]):
                w = gone[blk[gone] == k]
                out.append((k, R.removal_rows(o[w], p[w])))
        return pd.DataFrame(out, columns=["blk", "runs"])

    replies = R.repeated_anchors(e, keys_of, n_anchor)
    sent = e.groupBy("blk").cogroup(replies.groupBy("blk")).applyInPandas(extend, "bucket int, from_blk int, windows binary, runs binary")
    removed = sent.groupBy("bucket").applyInPandas(first_occurrence, "blk int, runs binary")
    end = 4 if with_text else 3
    schema = "n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return R.with_id(R.rebuilt(e, removed, window, lambda t, s, n: finish(t, s, n, window)[:end], schema), id_col)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), with_text=False)


#: DuckDB SQL for the rows of the query (ids not null, each once).
ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS k FROM words, unnest(range(1, len(w) - 18)) AS t(i)
), repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1
), gone AS (
  SELECT doc_id, list(DISTINCT i + j) AS out_at FROM repeated, unnest(range(0, 20)) AS t(j) GROUP BY doc_id
), kept AS (
  SELECT d.doc_id, len(w) AS n, coalesce(len(out_at), 0) AS g,
         CASE WHEN out_at IS NULL THEN w ELSE [x FOR x, p IN w IF NOT list_contains(out_at, p)] END AS left_over
  FROM words d LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(g AS BIGINT) AS n_removed, sha256(array_to_string(left_over, ' ')) AS kept_sha256 FROM kept
"""
