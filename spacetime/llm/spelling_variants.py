"""Spelling variants, found by Gram matrices of letter counts.

Two words are near if they differ by exactly one inserted, deleted or replaced
code point.  A word's letters, counted, make a vector; near words of equal
length lie at a squared distance of 2 (one letter less, another more) and near
words of adjacent lengths at 1.  Words are put into blocks of one length and one
*signature*: their letter counts summed over a few groups of letters, each
carrying about the same share of all letters.  One edit moves a signature by
one group up (an insertion) or by one up and one down (a replacement), so the
blocks that can hold near words are listed, not searched: the same block, those
one replacement away, and those of the next length one insertion away.  The
squared distances between two blocks are one matrix product, and the few pairs
at a fitting distance are compared letter by letter.

More words make more groups, so blocks stay small as the vocabulary grows; a
signature with more words than a block may hold is cut into several, and every
pair of their blocks is a row of its own.  Nothing is capped: every pair of near
words meets in exactly one pair of blocks.

Edge cases: null and empty texts have no words; a null id counts as an empty id;
repeated rows count again; words of any length are handled, a block of long
words holds fewer; ties of frequency go to the smaller word in code-point order;
no words give no rows; other columns of the documents are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.llm.common import documents, stored

MIN_LENGTH = 7
MIN_COUNT = 2
#: A near word is a word's form if it is so many times as frequent.
FORM_RATIO = 10
#: One of so many occurrences loses a code point (the contract's planted slips).
SLIP = 31
BLOCK_WORDS = 512
#: The groups of letters are as many as the number of words has bits more than this.
CELL_BITS = 12
BLOCK_BYTES = 1 << 20
#: Distinct words a task holds before it hands its counts on.
HELD_WORDS = 400_000
#: Cells of one matrix product.
PRODUCT = 1 << 22
#: Forms are at least ten times as frequent as their words, so a chain of them
#: is shorter than a long has digits; so many doublings reach its end.
DOUBLINGS = 5

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def lowered(text: str) -> str:
    """``text`` with A to Z, and nothing else, in lower case."""
    return text.encode("utf-8").translate(_LOWER).decode("utf-8")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slip: int = SLIP) -> DataFrame:
    """``word, n``: the distinct words of the texts with their occurrences.

    A word is a maximal run of letters up to U+00FF; where ``slip`` divides the
    CRC-32 of ``<id>:<word>`` it loses the code point at that number modulo its
    length (``slip`` 0: never)."""
    letters = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                seed = zlib.crc32(f"{i}:".encode())
                for w, n in Counter(letters.findall(lowered(text))).items():
                    if slip:
                        h = zlib.crc32(w.encode(), seed)
                        if h % slip == 0:
                            h %= len(w)
                            w = w[:h] + w[h + 1 :]
                            if len(w) < min_length:
                                continue
                    held[w] += n
                if len(held) > HELD_WORDS:
                    yield flush()
        yield flush()

    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each letter (a byte of Latin-1), -1 for all others.

    Groups share the letters out evenly: each letter, the most frequent first,
    goes to the group with the fewest letters so far.  At most 256 numbers come
    to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(256, dtype=np.int64), 0
        for batch in batches:
            total += np.bincount(np.frombuffer("".join(batch.column(0).to_pylist()).encode("latin-1"), dtype=np.uint8), minlength=256)
            rows += batch.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, at], pa.int32()), pa.array(np.r_[rows, total[at]], pa.int64())], names=["letter", "n"])

    sums = {r["letter"]: r["n"] for r in words.select("word").mapInArrow(run, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect()}
    n_words = sums.pop(-1, 0)
    n_groups = max(2, int(n_words).bit_length() - CELL_BITS)
    out, load = np.full(256, -1, dtype=np.int64), [0] * n_groups
    for letter, n in sorted(sums.items(), key=lambda x: (-x[1], x[0])):
        g = load.index(min(load))
        out[letter] = g
        load[g] += n
    return out


def signatures(words: list[str], groups: np.ndarray) -> np.ndarray:
    """Letters of each group in each word, a row per word."""
    k = int(groups.max()) + 1
    data = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(row * k + groups[data], minlength=len(words) * k).reshape(len(words), k)


def cell_names(rows: np.ndarray) -> list[str]:
    return [",".join(map(str, r)) for r in rows.tolist()]


def blocks(words: DataFrame, groups: np.ndarray, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame]:
    """``cell, parts`` and ``cell, part, length, chars, counts``: the words of a
    signature in blocks, as one run of Latin-1 letters and their frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = cell_names(signatures(batch.column(0).to_pylist(), groups))
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.string()), batch.column(0), batch.column(1)], names=["cell", "word", "n"])

    placed = words.mapInArrow(run, "cell string, word string, n long")
    length = F.length("word")
    room = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.lit(BLOCK_BYTES) / F.col("length"))))
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.max(length).alias("length"))
    cells = stored(cells.select("cell", F.ceil(F.col("m") / room).cast("int").alias("parts")), "variant-cells")
    many = cells.where("parts > 1")
    part = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int")
    dealt = placed.join(many, "cell", "left").select("cell", part.alias("part"), "word", "n")
    packed = dealt.groupBy("cell", "part").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w"))
    full = packed.select("cell", "part", F.length(F.col("w")[0]["word"]).alias("length"), F.encode(F.array_join("w.word", ""), "ISO-8859-1").alias("chars"), F.col("w.n").alias("counts"))
    return cells, stored(full, "variant-blocks")


def block_pairs(cells: DataFrame, groups: np.ndarray) -> DataFrame:
    """``cell, part, other, other_part``: every pair of blocks that can hold near
    words, once.  Of two signatures one replacement apart, the one with more of
    the earlier group asks for the other."""
    k = int(groups.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up = np.eye(k, dtype=np.int64)
        i, j = np.triu_indices(k, 1)
        steps = np.concatenate([np.zeros((1, k), dtype=np.int64), up, up[j] - up[i]])
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                names = batch.column(0).slice(a, 256).to_pylist()
                at = np.array([[int(x) for x in c.split(",")] for c in names], dtype=np.int64)
                others = at[:, None, :] + steps[None, :, :]
                ok = (others >= 0).all(axis=2)
                parts = batch.column(1).slice(a, 256).to_numpy(zero_copy_only=False)
                home = np.repeat(np.arange(len(names)), ok.sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array([names[h] for h in home], pa.string()), pa.array(parts[home], pa.int32()), pa.array(cell_names(others[ok]), pa.string())], names=["cell", "parts", "other"])

    asked = cells.mapInArrow(run, "cell string, parts int, other string")
    there = asked.join(cells.select(F.col("cell").alias("other"), F.col("parts").alias("other_parts")), "other")
    each = there.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "other", "other_parts")
    each = each.select("cell", "part", "other", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)).alias("other_part"))
    return each.where("cell <> other OR part <= other_part")


def letter_matrix(chars: np.ndarray, column: np.ndarray, dtype: type) -> np.ndarray:
    """How often each word (a row of letters) has the letter of each column."""
    m, k = len(chars), int(column.max()) + 1
    return np.bincount((np.arange(0, m * k, k)[:, None] + column[chars]).ravel(), minlength=m * k).reshape(m, k).astype(dtype)


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of ``x`` are one edit from the same row of ``y``, whose words
    are as long or one letter longer."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(axis=1) == 1
    longest = x.shape[1]
    ahead, behind = x != y[:, :longest], (x != y[:, 1:])[:, ::-1]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), longest)
    last = np.where(behind.any(axis=1), behind.argmax(axis=1), longest)
    return first + last >= longest


def gram_pairs(x: np.ndarray, y: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and ``y`` (words of one length each, those of ``y`` as long
    or one longer) that are one edit apart; ``column`` numbers the letters."""
    exact = np.float32 if max(x.shape[1], y.shape[1]) < 4000 else np.float64
    wanted = 2 if x.shape[1] == y.shape[1] else 1
    a = letter_matrix(x, column, exact)
    square_a = (a * a).sum(axis=1)
    found = []
    step = max(1, PRODUCT // len(x))
    for at in range(0, len(y), step):
        b = letter_matrix(y[at : at + step], column, exact)
        square = square_a[:, None] + (b * b).sum(axis=1)[None, :]
        square -= 2 * (a @ b.T)
        i, j = np.nonzero(square == wanted)
        for c in range(0, len(i), PRODUCT // max(1, x.shape[1]) + 1):
            p, q = i[c : c + PRODUCT // max(1, x.shape[1]) + 1], j[c : c + PRODUCT // max(1, x.shape[1]) + 1] + at
            good = one_edit(x[p], y[q])
            found.append((p[good], q[good]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def texts(rows: np.ndarray) -> list[str]:
    width = rows.shape[1]
    flat = np.ascontiguousarray(rows).tobytes().decode("latin-1")
    return [flat[i * width : (i + 1) * width] for i in range(len(rows))]


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``word, near, near_n``: every ordered pair of near words of ``words``
    (columns ``word, n``, words distinct, of letters up to U+00FF), with the
    second one's frequency."""
    words = stored(words.select("word", "n"), "variant-words")
    groups = letter_groups(words)
    if groups.max() < 0:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).where("false")
    cells, full = blocks(words, groups, block_words)
    visitor = full.toDF("other", "other_part", "other_length", "other_chars", "other_counts")
    column = np.cumsum(groups >= 0) - 1
    met = block_pairs(cells, groups).join(visitor, ["other", "other_part"]).join(full, ["cell", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["cell", "other", "part", "other_part", "length", "other_length"]).to_pydict()
            chars, others = batch.column("chars"), batch.column("other_chars")
            counts, other_counts = batch.column("counts"), batch.column("other_counts")
            same = [c == o and p == q for c, o, p, q in zip(rows["cell"], rows["other"], rows["part"], rows["other_part"])]
            first = 0
            x = np.frombuffer(chars[0].as_py(), dtype=np.uint8).reshape(-1, rows["length"][0]) if batch.num_rows else None
            n_x = np.asarray(counts[0].values) if batch.num_rows else None
            for longer in (0, 1):
                at = [i for i in range(first, batch.num_rows) if rows["other_length"][i] - rows["length"][i] == longer]
                if not at:
                    continue
                y = np.concatenate([np.frombuffer(others[i].as_py(), dtype=np.uint8) for i in at]).reshape(-1, rows["other_length"][at[0]])
                n_y = np.concatenate([np.asarray(other_counts[i].values) for i in at])
                own = np.repeat([same[i] for i in at], [len(other_counts[i]) for i in at])
                p, q = gram_pairs(x, y, column)
                # a block with itself has every pair both ways already
                back = ~own[q]
                w = texts(x[p]) + texts(y[q[back]])
                near = texts(y[q]) + texts(x[p[back]])
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(near, pa.string()), pa.array(np.r_[n_y[q], n_x[p[back]]], pa.int64())], names=["word", "near", "near_n"])

    return met.groupBy("cell", "part").applyInArrow(run, "word string, near string, near_n long")


def spelling_variants(words: DataFrame, block_words: int = BLOCK_WORDS, form_ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``words``
    (columns ``word, n``): its most frequent near word if that is ``form_ratio``
    times as frequent, and the word that forms lead to in the end."""
    words = stored(words.select("word", "n"), "variants")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    near = near_words(words, block_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    enough = F.expr(f"cast(-best.m as decimal(38,0)) >= {int(form_ratio)} * cast(n as decimal(20,0))")
    rows = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.w")).alias("form"), F.when(enough, -F.col("best.m")).alias("form_n")), "variant-forms")
    # follow the forms: after each round a word points twice as far
    links = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        links = stored(links.alias("a").join(links.alias("b"), F.col("a.root") == F.col("b.word"), "left").select("a.word", F.coalesce("b.root", "a.root").alias("root")), "variant-roots")
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(documents(spark, sf_dir)))
