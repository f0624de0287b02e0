"""Phrases of words that stay together, by direct-address tiling.

Texts are lower-cased (A to Z) and cut into pieces at punctuation and line ends,
pieces into words.  Everything is per language.  Words that occur often enough
to be in a phrase are numbered by falling frequency, so the pairs of frequent
words, most of all pairs, fall into few *tiles*: squares of the table of first
by second number.  A tile with many pairs is counted by address (``bincount``
over its cells), all others as sorted coordinates with their counts.  Frequent
pairs are numbered by falling frequency in turn, and the pairs of a pair and the
word after it are tiled alike: that gives phrases of three words, and once more
of four.  A phrase can only be frequent if its first words are, so nothing is
lost.

Each chunk of the corpus counts its own tiles; the counts of a tile meet in one
bucket, which adds them up and tells each chunk the numbers of the frequent
pairs it has.  The side of a tile shrinks as the chunks grow in number, so the
entries that meet for one tile are bounded, whatever a language's most frequent
words are.

A candidate of ``k`` words with frequency ``a`` is scored by its weakest cut:
``floor(2000000 * a / (l + r))`` with the frequencies of both parts.  It is
dropped if a longer candidate that contains it has 80 % of its frequency.

Edge cases: null or empty texts have no words; a null language is ``und``, as is
that language itself; repeated rows count again; a very long text is one chunk
of its own; ties of the score go to the higher frequency, then the smaller
phrase in byte order; no words give no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spacetime.llm import sequences as S
from spacetime.llm.common import documents, shuffle_width, stored

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: A longer candidate with so many hundredths of a candidate's count replaces it.
REPLACES = 80
SCALE = 2_000_000
UNKNOWN = "und"

#: Entries that may meet for one tile: cells of a tile times chunks.
TILE_ENTRIES = 1 << 24
#: A tile is counted by address if it has a pair for so many cells.
DENSE = 8
#: Bits of a word's number in a pair's code; the rest is the prefix's number.
WORD_BITS = 27
WORD_MASK = (1 << WORD_BITS) - 1
#: Expected entries of a bucket.
BUCKET_ENTRIES = 1 << 20

# What ends a piece (the contract's set), as a translation.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_PIECES = bytes(10 if b in _ENDS else b for b in S.LOWER)


def words_and_breaks(text: str) -> list[bytes]:
    """The words of a text with a break after every piece."""
    return text.encode("utf-8").translate(_PIECES).replace(b"\n", b" \xff ").split() + [S.BREAK]


def chunks(docs: DataFrame, text_col: str, group_col: str, chunk_tokens: int) -> DataFrame:
    """``chunk, lang, words, counts, tokens``, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, S.Chunk] = {}
        nth, size = 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal nth, size
            for lang, c in held.items():
                t = c.tokens()
                counts = np.bincount(t + 1, minlength=len(c.numbers))[1:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([S.chunk_number(nth)], pa.int64()), pa.array([lang], pa.string()), pa.array([c.words()], pa.list_(pa.string())), pa.array([counts], pa.list_(pa.int64())), pa.array([S.packed(t)], pa.binary())],
                    names=["chunk", "lang", "words", "counts", "tokens"],
                )
                nth += 1
            held.clear()
            size = 0

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_and_breaks(text)
                if lang not in held:
                    held[lang] = S.Chunk()
                held[lang].add(words)
                size += len(words)
                if size >= chunk_tokens:
                    yield from flush()
        yield from flush()

    src = docs.select(F.coalesce(F.col(group_col).cast("string"), F.lit(UNKNOWN)).alias("g"), F.col(text_col).cast("string").alias("t")).where("t <> ''")
    return stored(src.mapInArrow(run, "chunk long, lang string, words array<string>, counts array<long>, tokens binary"), "phrase-chunks")


def pair_codes(prefix: np.ndarray, words: np.ndarray, k: int) -> np.ndarray:
    """The code of the pair (prefix of ``k - 1`` words, next word) that starts
    at each place, -1 where there is none."""
    out = np.full(len(words), -1, dtype=np.int64)
    if len(words) >= k:
        p, w = prefix[: len(words) - k + 1], words[k - 1 :]
        there = (p >= 0) & (w >= 0)
        if there.any() and (int(w.max()) > WORD_MASK or int(p.max()) >> (62 - WORD_BITS)):
            raise OverflowError("more frequent words or phrases than a pair's code has room for")
        out[: len(p)][there] = (p[there] << WORD_BITS) | w[there]
    return out


def tiles_of(codes: np.ndarray, side: int) -> np.ndarray:
    """The tile of each pair (``side``: bits of a tile's edge)."""
    return ((codes >> (WORD_BITS + side)) << WORD_BITS) | ((codes & WORD_MASK) >> side)


def count_tiles(codes: np.ndarray, weights: np.ndarray | None, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, ascending, and their summed weights (None: 1 each).

    Tiles with a pair for every ``DENSE`` cells are counted by address, the rest
    as sorted coordinates."""
    cells = 1 << (2 * side)
    tile = tiles_of(codes, side)
    names, of, sizes = np.unique(tile, return_inverse=True, return_counts=True)
    dense = sizes * DENSE >= cells
    found, sums = [], []
    order = np.argsort(of, kind="stable") if dense.any() else None
    ends = np.cumsum(sizes)
    low = (1 << side) - 1
    for t in np.flatnonzero(dense):
        at = order[ends[t] - sizes[t] : ends[t]]
        c = codes[at]
        cell = (((c >> WORD_BITS) & low) << side) | (c & low)
        # sums of counts stay below 2 ** 53, where doubles are exact
        n = np.bincount(cell, weights=None if weights is None else weights[at], minlength=cells)
        full = np.flatnonzero(n)
        row, col = names[t] >> WORD_BITS, names[t] & WORD_MASK
        found.append((((row << side) | (full >> side)) << WORD_BITS) | (col << side) | (full & low))
        sums.append(n[full].astype(np.int64))
    sparse = ~dense[of]
    if sparse.any():
        c = codes[sparse]
        order = np.argsort(c, kind="stable")
        c = c[order]
        first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        w = np.ones(len(c), dtype=np.int64) if weights is None else weights[sparse][order]
        found.append(c[first])
        sums.append(np.add.reduceat(w, first))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    c, n = np.concatenate(found), np.concatenate(sums)
    order = np.argsort(c, kind="stable")
    return c[order], n[order]


def buckets_of(codes: np.ndarray, side: int, n: int) -> np.ndarray:
    t = tiles_of(codes, side).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((t >> np.uint64(33)) % np.uint64(n)).astype(np.int64)


def counted(encoded: DataFrame, k: int, side: int, n_buckets: int, min_count: int) -> DataFrame:
    """Frequent pairs of a prefix of ``k - 1`` words and a word, stored.

    ``lang, bucket, chunk, at, codes, counts``: a row without a chunk holds the
    frequent pairs of a bucket; a row with one says which of them (``at``) the
    chunk has."""

    def send(row: dict) -> Iterator[tuple]:
        words = S.unpacked(row["tokens"], "int64")
        prefix = S.unpacked(row["prefix"], "int64") if row["prefix"] is not None else words
        codes = pair_codes(prefix, words, k)
        c, n = count_tiles(codes[codes >= 0], None, side)
        b = buckets_of(c, side, n_buckets)
        order = np.argsort(b, kind="stable")
        edges = np.searchsorted(b[order], np.arange(n_buckets + 1))
        for i in range(n_buckets):
            at = order[edges[i] : edges[i + 1]]
            if len(at):
                yield row["lang"], i, row["chunk"], c[at].tobytes(), n[at].astype(np.uint32).tobytes()

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [np.frombuffer(c, dtype=np.int64) for c in pdf["codes"]]
        n = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in pdf["counts"]]).astype(np.int64)
        c, f = count_tiles(np.concatenate(each), n, side)
        c, f = c[f >= min_count], f[f >= min_count]
        lang, bucket = pdf["lang"].iloc[0], pdf["bucket"].iloc[0]
        out = [(lang, bucket, None, None, c.tobytes(), f.tobytes())] if len(c) else []
        for chunk, own in zip(pdf["chunk"], each) if len(c) else ():
            at = np.searchsorted(c, own)
            at = at[c[np.minimum(at, len(c) - 1)] == own]
            if len(at):
                out.append((lang, bucket, chunk, at.astype(np.uint32).tobytes(), None, None))
        made = pd.DataFrame(out, columns=["lang", "bucket", "chunk", "at", "codes", "counts"])
        return made.assign(chunk=made["chunk"].astype("Int64"))

    sent = S.arrow_map(encoded.select("chunk", "lang", "tokens", "prefix"), send, "lang string, bucket int, chunk long, codes binary, counts binary")
    return stored(sent.groupBy("lang", "bucket").applyInPandas(add, "lang string, bucket int, chunk long, at binary, codes binary, counts binary"), f"phrase-counts-{k}")


def pair_table(counts: DataFrame, k: int) -> DataFrame:
    """``lang, bucket, at, prefix, word, f, id``: the frequent pairs, numbered
    by falling frequency."""
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["lang", "bucket", "at", "prefix", "word", "f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, bucket, codes, f in zip(*(batch.column(c).to_pylist() for c in range(4))):
                c = np.frombuffer(codes, dtype=np.int64)
                cols = [[lang] * len(c), np.full(len(c), bucket, dtype=np.int32), np.arange(len(c)), c >> WORD_BITS, c & WORD_MASK, np.frombuffer(f, dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=names)

    rows = counts.where("chunk IS NULL").select("lang", "bucket", "codes", "counts").mapInArrow(run, "lang string, bucket int, at long, prefix long, word long, f long")
    return S.ranked(rows, "lang", [F.col("f").desc(), F.col("prefix"), F.col("word")], f"phrases-{k}")


def extended(encoded: DataFrame, counts: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """``encoded`` with the numbers of the frequent phrases of ``k`` words that
    start at each place as its new prefixes, stored."""
    numbers = table.groupBy("lang", "bucket").agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("a")).select("lang", "bucket", F.col("a.id").alias("ids"))

    def tell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(right):
            return pd.DataFrame(columns=["chunk", "codes", "ids"])
        codes = np.frombuffer(left["codes"].dropna().iloc[0], dtype=np.int64)
        ids = np.asarray(right["ids"].iloc[0], dtype=np.int64)
        out = []
        for chunk, at in zip(left["chunk"], left["at"]):
            if at is not None:
                i = np.frombuffer(at, dtype=np.uint32)
                out.append((chunk, codes[i].tobytes(), ids[i].tobytes()))
        return pd.DataFrame(out, columns=["chunk", "codes", "ids"])

    told = counts.groupBy("lang", "bucket").cogroup(numbers.groupBy("lang", "bucket")).applyInPandas(tell, "chunk long, codes binary, ids binary")
    told = told.groupBy("chunk").agg(F.collect_list(F.struct("codes", "ids")).alias("t"))

    def attach(row: dict) -> Iterator[tuple]:
        words = S.unpacked(row["tokens"], "int64")
        prefix = S.unpacked(row["prefix"], "int64") if row["prefix"] is not None else words
        out = np.full(len(words), -1, dtype=np.int64)
        if row["t"]:
            codes = np.concatenate([np.frombuffer(t["codes"], dtype=np.int64) for t in row["t"]])
            ids = np.concatenate([np.frombuffer(t["ids"], dtype=np.int64) for t in row["t"]])
            order = np.argsort(codes)
            codes, ids = codes[order], ids[order]
            own = pair_codes(prefix, words, k)
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            hit = codes[at] == own
            out[hit] = ids[at[hit]]
        yield row["chunk"], row["lang"], row["tokens"], S.packed(out)

    return stored(S.arrow_map(encoded.select("chunk", "lang", "tokens", "prefix").join(told, "chunk", "left"), attach, "chunk long, lang string, tokens binary, prefix binary"), f"phrase-prefixes-{k}")


def phrase_counts(docs: DataFrame, text_col: str = "text", group_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, chunk_tokens: int = S.CHUNK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """``lang, n``, all words of each language, and ``lang, k, phrase, f``: the
    phrases of 1 to ``max_words`` words that occur ``min_count`` times."""
    made = chunks(docs, text_col, group_col, chunk_tokens)
    asked = made.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select("chunk", "lang", "at", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    every = stored(asked.groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = S.ranked(every.where(F.col("f") >= min_count), "lang", [F.col("f").desc(), F.col("word")], "phrases-1")
    told = S.answers(asked, words, ["lang", "word"], "id")

    def encode(row: dict) -> Iterator[tuple]:
        number = np.full(row["n_words"] + 1, -1, dtype=np.int64)
        if row["id"] is not None:
            number[row["at"]] = row["id"]
        t = S.unpacked(row["tokens"], "int32")
        yield row["chunk"], row["lang"], S.packed(number[t]), None, len(t)

    joined = made.select("chunk", "lang", F.size("words").alias("n_words"), "tokens").join(told, "chunk", "left")
    encoded = stored(S.arrow_map(joined, encode, "chunk long, lang string, tokens binary, prefix binary, size long"), "phrase-prefixes-1")

    size = encoded.agg(F.count(F.lit(1)).alias("chunks"), F.sum("size").alias("tokens")).first()
    side = max(1, min(10, (TILE_ENTRIES // max(1, size["chunks"])).bit_length() // 2))
    n_buckets = max(shuffle_width(docs.sparkSession), int(size["tokens"] or 0) // BUCKET_ENTRIES + 1)
    texts = words.select("lang", F.lit(1).alias("k"), "id", F.col("word").alias("phrase"), "f")
    single = words.select("lang", F.col("id").alias("word"), F.col("word").alias("last"))
    all_phrases = texts
    for k in range(2, max_words + 1):
        counts = counted(encoded, k, side, n_buckets, min_count)
        table = pair_table(counts, k)
        heads = texts.select("lang", F.col("id").alias("prefix"), F.col("phrase").alias("head"))
        named = table.join(heads, ["lang", "prefix"]).join(single, ["lang", "word"])
        texts = stored(named.select("lang", F.lit(k).alias("k"), "id", F.concat_ws(" ", "head", "last").alias("phrase"), "f"), f"phrase-texts-{k}")
        all_phrases = all_phrases.union(texts)
        if k < max_words:
            encoded = extended(encoded, counts, table, k)
    return totals, all_phrases.select("lang", "k", "phrase", "f")


def collocations(totals: DataFrame, phrases: DataFrame, top: int = TOP, replaces: int = REPLACES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each
    language by their weakest cut; input as :func:`phrase_counts` gives it."""
    big = "cast({} as decimal(20,0))".format
    several = phrases.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"))
    known = phrases.select("lang", "phrase", "f")
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": F.expr("substring_index(phrase, ' ', cut)"), "right": F.expr("substring_index(phrase, ' ', cut - k)")})
    cuts = cuts.join(known.toDF("lang", "left", "l"), ["lang", "left"]).join(known.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr(f"({SCALE} * {big('a')}) div ({big('l')} + {big('r')})")
    weakest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c"))

    # parts of 2 to k - 1 words of every longer candidate, with its count
    part = F.expr("flatten(transform(sequence(2, k - 1), m -> transform(sequence(0, k - m), i -> array_join(slice(split(phrase, ' '), i + 1, m), ' '))))")
    parts = several.where("k > 2").select("lang", F.explode(part).alias("phrase"), F.col("a").alias("longer"))
    parts = parts.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    left = weakest.join(parts, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * {big('longer')} < {int(replaces)} * {big('a')}")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("c.score").desc(), F.col("a").desc(), F.col("phrase")))
    first = left.withColumn("rank", place).where(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), "n", F.col("c.score").cast("long").alias("score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(*phrase_counts(documents(spark, sf_dir)))


#: DuckDB SQL for the rows of the query.
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM words, unnest([1, 2, 3, 4]) AS a(k), unnest(range(1, greatest(len(w) - k + 2, 1))) AS b(i)
), f AS (
  SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, x.a AS l, y.a AS r, (2000000 * c.a) // (x.a + y.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 :], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidates, unnest([2, 3]) AS t(m), unnest(range(1, 4)) AS u(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), kept AS (
  SELECT w.* FROM weakest AS w LEFT JOIN inside AS s USING (lang, phrase) WHERE s.longer IS NULL OR 100 * s.longer < 80 * w.a
)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN totals USING (lang)
WHERE rank <= 2000
"""
