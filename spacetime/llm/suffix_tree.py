"""Language-model scores by a probabilistic suffix tree over words.

A text's tokens are its words, A to Z in lower case, and one end.  The symbols
of the tree are the words with at least ``symbol_min`` training occurrences, one
symbol for all rarer words together, and the end, which also stands before the
first word.  A node is a *context*: the last 1 to ``depth`` symbols before a
token.  Its distribution is smoothed by its parent's, the context without its
oldest symbol:

    P(x | s) = (c(s, x) + weight * P(x | parent)) / (N(s) + weight)

A context with ``context_min`` training occurrences is looked at, and is retained
if its next symbols diverge from what its parent says: the log-likelihood gained
over the parent, each occurrence predicted without itself, must pass ``gain``
(a count-weighted divergence that does not reward chance).  Suffixes of a
retained context belong to the tree too.  A token is scored by the longest
retained context before it; a rare word is scored as the rare symbol times the
word's share of it, which leaves a part for words never seen.  So each context's
probabilities, with one unknown word, sum to 1.

The tree lives where it is needed: every chunk of the corpus asks, level by
level, for the counts of the words and word runs it has (its training documents
add to them) and for the contexts that are retained.  Questions meet in buckets
by hash, pre-aggregated by chunk, and are answered there; no task, and not the
driver, holds the model, which grows with the corpus.  A word or run that no
other chunk asks about is a chunk's own: what it counted itself is all there is,
also of every longer run with that one inside, so nobody is asked about those.
Chunks and answers lie in buckets by chunk, so that tokens are never shuffled.
Words are told apart by 64-bit hashes, runs of two by the numbers that symbols get,
longer runs and contexts by 40 bits of their hashes within a bucket.

Edge cases: null or empty text is one end token; a null id is not held out and
trains; repeated rows train again and are scored each; a very long text is one
chunk of its own; with no training document every token is unknown; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from spacetime.llm import sequences as S
from spacetime.llm.common import documents, shuffle_width, shuffles_dropped
from spacetime.llm.repeats import BASE, mixed

DEPTH = 3
SYMBOL_MIN = 10
CONTEXT_MIN = 32
WEIGHT = 64.0
GAIN = 10.0
#: Tokens of a chunk, and expected entries of a bucket.
CHUNK_TOKENS = 1 << 20
BUCKET_ENTRIES = 1 << 20
#: Bytes of texts that are split at a time.
SPLIT_BYTES = 1 << 20

END, RARE = 0, 1
WORDS, COUNTS, GAINS = 0, 1, 2
#: Bits of a code that are sent; the bucket tells more of it.
SENT = {WORDS: 64, COUNTS: 40, GAINS: 40}


def words_by_text(texts: pa.Array) -> pa.ListArray:
    """The words of each text, A to Z in lower case; null or empty: no list."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar(None, texts.type), texts)
    return pc.ascii_split_whitespace(texts)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows with at most ``SPLIT_BYTES`` of text, or one row."""
    n = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(n, (n[a - 1] if a else 0) + SPLIT_BYTES, side="right")))
        yield batch.slice(a, b - a)
        a = b


def chunks(docs: DataFrame, learn: Column, id_col: str, text_col: str, chunk_tokens: int) -> DataFrame:
    """``chunk, words`` (their hashes), ``tokens`` (their numbers, an end is -1)
    and, for each document, ``ids, sizes, train``, in buckets by chunk."""
    src = docs.select(F.col(id_col).alias("i"), F.coalesce(learn, F.lit(False)).alias("l"), F.col(text_col).cast("string").alias("t"))
    schema = f"chunk long, words binary, tokens binary, ids array<{src.schema['i'].dataType.simpleString()}>, sizes array<long>, train array<boolean>"
    types = to_arrow_schema(StructType.fromDDL(schema))

    def row(nth: int, parts: list[tuple]) -> pa.RecordBatch:
        ids, train, words, sizes = ([p[k] for p in parts] for k in range(4))
        sizes = np.concatenate(sizes)
        coded = pa.concat_arrays(words).dictionary_encode()
        t = np.full(sizes.sum(), -1, dtype=np.int32)
        is_word = np.ones(len(t), dtype=bool)
        is_word[np.cumsum(sizes) - 1] = False
        number = coded.indices.to_numpy()
        hashes = np.fromiter(map(hashed, coded.dictionary.cast(pa.binary()).to_pylist()), dtype=np.uint64, count=len(coded.dictionary))
        # frequent words get small numbers, words of one frequency lie by hash: both pack well
        order = np.lexsort((hashes, -np.bincount(number, minlength=len(hashes))))
        new = np.empty(len(hashes), dtype=np.int32)
        new[order] = np.arange(len(hashes), dtype=np.int32)
        t[is_word] = new[number]
        values = [S.chunk_number(nth), packed_steps(hashes[order]), packed_counts(t + 1), [x for part in ids for x in part.to_pylist()], sizes, [x for part in train for x in part.to_pylist()]]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, types)], names=types.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nth, parts, size = 0, [], 0
        for batch in batches:
            for some in slices(batch, 2):
                words = words_by_text(some.column(2))
                sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                ends = np.cumsum(sizes)
                a = 0
                while a < some.num_rows:
                    before = ends[a - 1] if a else 0
                    b = min(int(np.searchsorted(ends, before + chunk_tokens - size)) + 1, some.num_rows)
                    parts.append((some.column(0).slice(a, b - a), some.column(1).slice(a, b - a), words.slice(a, b - a).flatten(), sizes[a:b]))
                    size += int(ends[b - 1] - before)
                    if size >= chunk_tokens:
                        yield row(nth, parts)
                        nth, parts, size = nth + 1, [], 0
                    a = b
        if parts:
            yield row(nth, parts)

    return S.by_chunk(src.mapInArrow(run, schema), "tree-chunks")


def hashed(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 42)


class Totals:
    """What all training tokens add up to: numbers for the driver."""

    def __init__(self, made: DataFrame, sums: DataFrame):
        d = made.agg(F.sum(F.size(F.filter("train", lambda x: x))).alias("ends")).first()
        v = sums.agg(*[F.sum(c).alias(c) for c in ("types", "tokens", "symbols", "rare")], F.max("most").alias("most")).first()
        self.ends = int(d["ends"] or 0)
        self.tokens = int(v["tokens"] or 0) + self.ends
        self.types = int(v["types"] or 0) + (self.ends > 0)
        self.symbols = int(v["symbols"] or 0)
        self.rare_tokens = int(v["rare"] or 0)
        self.rare_types = int(v["types"] or 0) - self.symbols
        self.most = int(v["most"] or 0)  # symbols of one bucket


class Tree:
    """Settings of a tree, what chunks send and how buckets answer."""

    def __init__(self, depth: int, symbol_min: int, context_min: int, weight: float, gain: float, n_buckets: int):
        self.depth, self.symbol_min, self.context_min, self.weight, self.gain, self.n_buckets = depth, symbol_min, context_min, weight, gain, n_buckets
        self.totals: Totals | None = None

    # ---- questions and answers

    def places(self, kind: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The buckets of codes, and what is sent of them there."""
        return (codes >> np.uint64(40)) % np.uint64(self.n_buckets), codes & np.uint64((1 << SENT[kind]) - 1)

    def pair_places(self, old: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same of runs of two symbols by their ids, which tell runs apart
        within a bucket and lie closer than hashes, so that steps are smaller."""
        n = self.n_buckets
        return (old + new) % n, (old * (self.totals.most + 2) + new // n).astype(np.uint64)

    def deal(self, places: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order of codes by bucket and there by what is sent of them, where
        each bucket's begin in it, and what is sent, in order."""
        b, short = places
        b = b.astype(np.uint16 if self.n_buckets <= 1 << 16 else np.int64)
        order = np.argsort(short)
        order = order[np.argsort(b[order], kind="stable")]
        return order, np.cumsum(np.r_[0, np.bincount(b, minlength=self.n_buckets)]), short[order]

    def send(self, kind: int, k: int, chunk: int, places: tuple[np.ndarray, np.ndarray], values: np.ndarray) -> Iterator[tuple]:
        order, edges, short = self.deal(places)
        values = values[order]
        for i in range(self.n_buckets):
            if edges[i] < edges[i + 1]:
                some = values[edges[i] : edges[i + 1]]
                yield kind, k, i, chunk, packed_steps(short[edges[i] : edges[i + 1]]), packed_counts(some.astype(np.float32).view(np.uint32) if kind == GAINS else some)

    def collect(self, kind: int, places: tuple[np.ndarray, np.ndarray], told: dict) -> np.ndarray:
        """Answers by bucket, in the order of the codes that were sent."""
        out = np.zeros(len(places[0]), dtype=bool if kind == GAINS else np.int64)
        order, edges, _ = self.deal(places)
        for i, blob in told.items():
            at = order[edges[i] : edges[i + 1]]
            out[at] = np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=len(at)) if kind == GAINS else unpacked_counts(blob)
        return out

    def collect_words(self, codes: np.ndarray, told: dict) -> tuple[np.ndarray, np.ndarray]:
        """The counts of a chunk's words, and the ids of the symbols among them."""
        out, ids = np.zeros(len(codes), dtype=np.int64), np.zeros(len(codes), dtype=np.int64)
        order, edges, _ = self.deal(self.places(WORDS, codes))
        for i, blob in told.items():
            at = order[edges[i] : edges[i + 1]]
            out[at], steps = np.split(unpacked_counts(blob), [len(at)])
            ids[at[self.is_symbol(out[at])]] = RARE + 1 + np.cumsum(steps) * self.n_buckets + i
        return out, ids

    def is_symbol(self, told: np.ndarray) -> np.ndarray:
        """Of words' counts as told, whether they have an id."""
        return told >= max(self.symbol_min, 1)

    def answer(self, pdf: pd.DataFrame) -> pd.DataFrame:
        """A bucket's sums for each chunk's codes: counts (0 for a code that is the
        chunk's own), or whether a context gains enough; of words, also the steps
        between the numbers that symbols have in the bucket (in the order of their
        codes), and what all words add up to."""
        pdf = pdf.sort_values("chunk")
        kind = int(pdf["kind"].iloc[0])
        codes = [unpacked_steps(c) for c in pdf["codes"]]
        values = np.concatenate([unpacked_counts(v) for v in pdf["vals"]])
        which, distinct = pd.factorize(np.concatenate(codes))
        each = np.bincount(which, weights=values.astype(np.uint32).view(np.float32) if kind == GAINS else values)
        out = (each >= self.gain)[which] if kind == GAINS else np.where(np.bincount(which) > 1, each, 0).astype(np.int64)[which]
        edges = np.cumsum([0, *map(len, codes)])
        told = [out[a:b] for a, b in zip(edges, edges[1:])]
        if kind == WORDS:
            symbol = np.zeros(len(distinct), dtype=bool)
            symbol[which] = self.is_symbol(out)
            number = np.zeros(len(distinct), dtype=np.int64)
            order = np.argsort(distinct)
            number[order] = np.cumsum(symbol[order]) - 1
            numbers = [number[which[a:b]][self.is_symbol(t)] for a, b, t in zip(edges, edges[1:], told)]
            told = [np.r_[t, np.diff(n, prepend=0)] for t, n in zip(told, numbers)]
        made = pd.DataFrame({"chunk": pdf["chunk"].astype("Int64"), "kind": kind, "k": pdf["k"], "bucket": pdf["bucket"], "told": [packed_bits(t) if kind == GAINS else packed_counts(t) for t in told]})
        sums = {"types": None, "tokens": None, "symbols": None, "rare": None}
        if kind == WORDS:
            known = each[each > 0]
            frequent = known >= self.symbol_min
            sums = {"types": len(known), "tokens": int(known.sum()), "symbols": int(frequent.sum()), "rare": int(known[~frequent].sum())}
            extra = pd.DataFrame([{"chunk": None, "kind": kind, "k": 0, "bucket": int(pdf["bucket"].iloc[0]), "told": None, **sums}])
            made = pd.concat([made.assign(**dict.fromkeys(sums)), extra.astype({"chunk": "Int64"})])
        else:
            made = made.assign(**sums)
        return made.astype({c: "Int64" for c in sums})

    # ---- a chunk's view

    def own_words(self, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of a chunk, its words' codes and how often each is in its
        training documents."""
        t, codes = unpacked_counts(row["tokens"]).astype(np.int32) - np.int32(1), word_codes(row)
        return t, codes, np.bincount(t[in_training(row)] + 1, minlength=len(codes) + 1)[1:]

    def ask_words(self, row: dict) -> Iterator[tuple]:
        _, codes, n = self.own_words(row)
        if len(codes):
            yield from self.send(WORDS, 0, row["chunk"], self.places(WORDS, codes), n)

    def symbols(self, row: dict, told: dict) -> dict:
        """The tokens ``t`` of a chunk and the counts ``c`` of its words, the last
        for the ends, which are -1; the symbols ``s`` of the tokens, and of each
        symbol its id (if other chunks have it), hash, count, and whether other
        chunks may have it.  The ends are symbol ``END``, words that are not
        frequent ``RARE``."""
        t, codes, own = self.own_words(row)
        c, ids = self.collect_words(codes, told.get((WORDS, 0), {}))
        shared = c > 0
        c = np.where(shared, c, own)
        frequent = c >= self.symbol_min
        number = np.where(frequent, np.cumsum(frequent) + 1, RARE).astype(np.int32)
        return {
            "t": t,
            "c": np.r_[c, self.totals.ends],
            "s": np.r_[number, np.int32(END)][t],
            "ids": np.r_[END, RARE, ids[frequent]],
            "hashes": np.r_[mixed(np.array([END + 1, RARE + 1], dtype=np.uint64)), codes[frequent]],
            "counts": np.r_[self.totals.ends, self.totals.rare_tokens, c[frequent]],
            "shared": np.r_[True, True, shared[frequent]],
        }

    def levels(self, row: dict, told: dict, upto: int, known_symbols: dict | None = None) -> Iterator[dict]:
        """Levels 1 to ``upto`` of a chunk: which places are looked at (``at``),
        their distinct runs and contexts with codes, and as far as the counts are
        told, the probability of every run.

        A run occurs at most where its context and the run without its oldest
        symbol do.  Where one of them is the chunk's own, or never occurs in
        training, the chunk's count is the whole count and nobody is asked."""
        known_symbols = known_symbols or self.symbols(row, told)
        s, ids, hashes, total, shared = (known_symbols[c] for c in ("s", "ids", "hashes", "counts", "shared"))
        t, train = self.totals, in_training(row)
        p = (total + 0.5) / (t.tokens + 0.5 * (t.symbols + 2))
        codes, newest, which, place_run = hashes, np.arange(len(hashes)), s, s
        for k in range(1, upto + 1):
            if k == 1:  # an end stands before the first token
                context = np.r_[np.int32(END), s[:-1]]
                at = np.flatnonzero((total >= self.context_min)[context]).astype(np.int32)
                context = context[at]
            else:  # the run that ends at a place is the context of the next one
                before = np.flatnonzero(((total >= self.context_min) & (newest != END))[which])
                context, at = which[before], at[before] + np.int32(1)
                looked_at = place_run[at] >= 0
                context, at = context[looked_at], at[looked_at]
            which, runs = pd.factorize(context.astype(np.int64) * len(total) + place_run[at])
            which = which.astype(np.int32)
            of, shorter = np.divmod(runs, len(total))  # by their numbers one level up
            newest = newest[shorter]
            run_codes = mixed(codes[of] * BASE + hashes[newest])
            n_train = np.bincount(which[train[at]], minlength=len(runs))
            asked = np.flatnonzero(shared[of] & shared[shorter])
            places = self.pair_places(ids[of[asked]], ids[shorter[asked]]) if k == 1 else self.places(COUNTS, run_codes[asked])
            level = {"k": k, "at": at, "which": which, "asked": asked, "places": places, "of": of, "codes": codes, "n_train": n_train}
            known = told.get((COUNTS, k))
            if known is None and len(asked):
                yield level
                return
            told_total = self.collect(COUNTS, places, known or {})
            n, parent = total[of].astype(float), p[shorter]
            total, shared = n_train.copy(), np.zeros(len(runs), dtype=bool)
            shared[asked] = told_total > 0
            total[asked] = np.where(told_total > 0, told_total, n_train[asked])
            p = (total + self.weight * parent) / (n + self.weight)
            yield {**level, "total": total, "n": n, "parent": parent, "p": p}
            codes = run_codes
            place_run = np.full(len(s), -1, dtype=np.int32)
            place_run[at] = which

    def gains(self, level: dict) -> np.ndarray:
        """What each context of a counted level gains in the chunk."""
        seen = np.flatnonzero(level["n_train"])
        total, n, parent, times, of = (level[c][seen] for c in ("total", "n", "parent", "n_train", "of"))
        alone = np.log((total - 1 + self.weight * parent) / (n - 1 + self.weight) / parent)
        return np.bincount(of, weights=times * alone, minlength=len(level["codes"]))

    def contexts(self, level: dict) -> np.ndarray:
        """The contexts of a level that occur in the chunk, by their numbers."""
        return np.flatnonzero(np.bincount(level["of"], minlength=len(level["codes"])))

    def ask(self, row: dict, told: dict, upto: int) -> Iterator[tuple]:
        """What a chunk sends once levels up to ``upto`` are counted: gains of
        that level's contexts, and the runs of the next level."""
        for level in self.levels(row, told, min(upto + 1, self.depth)):
            if not len(level["at"]):
                continue
            if level["k"] == upto:
                here = self.contexts(level)
                yield from self.send(GAINS, upto, row["chunk"], self.places(GAINS, level["codes"][here]), self.gains(level)[here])
            if level["k"] == upto + 1:
                yield from self.send(COUNTS, upto + 1, row["chunk"], level["places"], level["n_train"][level["asked"]])

    def scores(self, row: dict, told: dict, known_symbols: dict) -> np.ndarray:
        """The log10 probability of each document's symbols."""
        t = self.totals
        best = np.log10((known_symbols["counts"] + 0.5) / (t.tokens + 0.5 * (t.symbols + 2)))[known_symbols["s"]]
        for level in self.levels(row, told, self.depth, known_symbols):
            if len(level["at"]):
                here = self.contexts(level)
                kept = np.zeros(len(level["codes"]), dtype=bool)
                kept[here] = self.collect(GAINS, self.places(GAINS, level["codes"][here]), told.get((GAINS, level["k"]), {}))
                hit = np.flatnonzero(kept[level["of"]][level["which"]])
                best[level["at"][hit]] = np.log10(level["p"])[level["which"][hit]]
        return np.add.reduceat(best, starts_of(row))

    def base(self, row: dict, known_symbols: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each document its known tokens, its base score, and the log10 of
        its rare words' shares of the rare symbol."""
        t, at = self.totals, starts_of(row)
        c, token = known_symbols["c"], known_symbols["t"]
        base = np.log10((c + 0.5) / (t.tokens + 0.5 * (t.types + 1)))
        share = np.where(c < self.symbol_min, np.log10((c + 0.5) / (t.rare_tokens + 0.5 * (t.rare_types + 1))), 0.0)
        share[-1] = 0.0
        return np.add.reduceat((c > 0)[token], at, dtype=np.int64), np.add.reduceat(base[token], at), np.add.reduceat(share[token], at)


def starts_of(row: dict) -> np.ndarray:
    """Where the documents of a chunk begin."""
    return np.cumsum(np.r_[0, np.asarray(row["sizes"], dtype=np.int64)])[:-1]


def in_training(row: dict) -> np.ndarray:
    """Of each token of a chunk, whether its document trains."""
    return np.repeat(np.asarray(row["train"], dtype=bool), np.asarray(row["sizes"]))


def word_codes(row: dict) -> np.ndarray:
    return unpacked_steps(row["words"])


def packed_steps(codes: np.ndarray) -> bytes:
    """Codes by the steps between them, which are small where they are sorted."""
    return packed_counts(np.diff(codes, prepend=np.uint64(0)))


def unpacked_steps(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked_counts(blob).view(np.uint64), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts for a row, in as few bytes each as the largest needs: all lowest
    bytes, then all next ones, which are mostly 0.  Each such plane is compressed
    for itself, as they have little in common; before them stand how many counts
    and how many bytes of each plane there are."""
    width = max(1, (int(counts.max(initial=0)).bit_length() + 7) // 8)
    low = counts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    planes = [pa.compress(np.ascontiguousarray(p).tobytes(), codec="zstd", asbytes=True) for p in low.T]
    sizes = np.array([len(counts), *map(len, planes)], dtype="<u4").tobytes()
    return b"".join([bytes([width]), sizes, *planes])


def unpacked_counts(blob: bytes) -> np.ndarray:
    n, *sizes = np.frombuffer(blob, dtype="<u4", offset=1, count=1 + blob[0]).tolist()
    out = np.zeros((n, 8), dtype=np.uint8)
    at = 5 + 4 * blob[0]
    for i, size in enumerate(sizes):
        out[:, i] = np.frombuffer(pa.decompress(blob[at : at + size], n, codec="zstd", asbytes=True), dtype=np.uint8)
        at += size
    return out.view("<i8").ravel()


def packed_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def by_kind(row: dict) -> dict:
    """All answers a chunk has got, by kind and level, then bucket."""
    out: dict = {}
    for name, told in row.items():
        if name.startswith("told"):
            for t in told or []:
                out.setdefault((t["kind"], t["k"]), {})[t["bucket"]] = t["told"]
    return out


def suffix_tree_scores(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    depth: int = DEPTH,
    symbol_min: int = SYMBOL_MIN,
    context_min: int = CONTEXT_MIN,
    weight: float = WEIGHT,
    gain: float = GAIN,
    chunk_tokens: int = CHUNK_TOKENS,
) -> DataFrame:
    """One row per document: ``id_col, train, n_tokens, n_known, train_tokens,
    base_score, score``; the tree is learned from the rows where ``learn``."""
    made = chunks(docs, learn, id_col, text_col, chunk_tokens)
    size = made.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x))).first()[0] or 0
    tree = Tree(depth, symbol_min, context_min, weight, gain, max(shuffle_width(docs.sparkSession), size // BUCKET_ENTRIES + 1))
    view = ["chunk", "words", "tokens", "sizes", "train"]
    rows = made

    def answered(asking, step: str) -> DataFrame:
        """What buckets answer to ``asking(row)``: for each chunk, and their sums."""
        columns = [*view, *[c for c in rows.columns if c.startswith("told")]]
        sent = S.arrow_map(rows.select(*columns), asking, "kind int, k int, bucket int, chunk long, codes binary, vals binary")
        return sent.groupBy("kind", "bucket").applyInPandas(lambda pdf: tree.answer(pdf), "chunk long, kind int, k int, bucket int, told binary, types long, tokens long, symbols long, rare long")

    def by_rows(got: DataFrame, step: str) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("types", "tokens", "symbols", "rare")] + [F.max("symbols").alias("most")] if step == "w" else []
        packed = got.groupBy("chunk").agg(F.collect_list(F.struct("kind", "k", "bucket", "told")).alias(f"told{step}"), *sums)
        with shuffles_dropped(docs.sparkSession):
            return S.by_chunk(packed, f"tree-answers-{step}")

    words = by_rows(answered(tree.ask_words, "w"), "w")  # one row without a chunk has the sums
    tree.totals = Totals(made, words.where("chunk IS NULL"))
    rows = rows.join(words.select("chunk", "toldw"), "chunk", "left")
    for k in range(depth + 1):
        rows = rows.join(by_rows(answered(lambda row, k=k: tree.ask(row, by_kind(row), k), str(k)), str(k)), "chunk", "left")

    def score(row: dict) -> Iterator[tuple]:
        told = by_kind(row)
        symbols = tree.symbols(row, told)
        known, base, rare = tree.base(row, symbols)
        yield row["ids"], row["train"], row["sizes"], known, base, tree.scores(row, told, symbols) + rare

    kind = made.schema["ids"].dataType.simpleString()
    out = S.arrow_map(rows, score, f"ids {kind}, train array<boolean>, sizes array<long>, known array<long>, base array<double>, score array<double>")
    each = out.select(F.inline(F.arrays_zip("ids", "train", "sizes", "known", "base", "score")))
    return each.select(F.col("ids").alias(id_col), "train", F.col("sizes").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(tree.totals.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def op11_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    out = suffix_tree_scores(docs, ~held_out)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
