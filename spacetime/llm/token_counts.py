"""Token counts of whole texts, exact for documents of any length.

A text up to ``chunk_chars`` long is counted word by word: white space is a
boundary no token of the vocabulary crosses (see :func:`stable`), so the count
of a text is the sum over its words, and each distinct word is encoded once per
worker.  A longer text is encoded in overlapping chunks with offsets.  Two
neighbouring chunks are spliced at the last boundary inside their overlap that
both encodings have and that is proven stable; where they share none the
overlap is doubled, up to the rest of the text, which then is one chunk.

Results for edge cases: null or empty text has 0 bytes and 0 tokens; a text
without any stable boundary is encoded whole; repeated rows are counted each;
columns other than the two named are ignored.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.llm.common import documents, map_batches

CHUNK_CHARS = 65536
OVERLAP_CHARS = 512
TOKEN_LIMIT = 2048
#: Words remembered by one worker; beyond it the memory is cleared.
MEMORY_WORDS = 1_000_000

_SPACE = " \t\n\r\x0b\x0c"
_workers: dict[str, "Counter"] = {}


def stable(text: str, at: int) -> bool:
    """Whether cutting ``text`` at ``at`` cannot change its tokens: the left
    character is ASCII white space and the right one is not.  The vocabulary's
    normaliser composes no character with a space, its splitter puts no white
    space into a piece, merges stay inside a piece, and its special strings
    contain no white space."""
    return 0 < at < len(text) and text[at - 1] in _SPACE and text[at] not in _SPACE


class Counter:
    """Token counts under one tokenizer file."""

    def __init__(self, path: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.chunk, self.overlap = chunk, overlap
        self.known: dict[str, int] = {}
        # a vocabulary that keeps white space in its tokens is not cut at all
        self.spaces_part = not self.ids(" \n\t ") and self.ids("one two\nthree") == self.ids("one") + self.ids("two") + self.ids("three")

    def ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        for i in range(0, len(new), 4096):
            part = new[i : i + 4096]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[w] = len(e.ids)

    def starts(self, text: str, a: int, b: int) -> list[int]:
        """Where the tokens of ``text[a:b]`` start, as positions in ``text``."""
        return [a + s for s, _ in self.tokenizer.encode(text[a:b], add_special_tokens=False).offsets]

    def huge(self, text: str) -> int:
        """Tokens of a long text, spliced from overlapping chunks."""
        n, total, a, begin = len(text), 0, 0, 0
        b = min(n, self.chunk)
        left = self.starts(text, a, b)
        while b < n:
            overlap = self.overlap
            while True:
                # the next chunk begins `overlap` before the end of this one
                c = max(a, b - overlap)
                d = min(n, c + overlap + self.chunk)
                right = self.starts(text, c, d)
                common = set(left).intersection(right)
                cut = next((p for p in sorted(common, reverse=True) if c < p < b and p > begin and stable(text, p)), None)
                if cut is not None:
                    total += sum(begin <= s < cut for s in left)
                    a, b, left, begin = c, d, right, cut
                    break
                if c == a:
                    # no boundary in the whole chunk: take more text at once
                    b = min(n, a + 2 * (b - a))
                    left = self.starts(text, a, b)
                    break
                overlap *= 2
        return total + sum(s >= begin for s in left)

    def count(self, texts: list[str | None]) -> list[int]:
        if not self.spaces_part:
            return [len(self.ids(t)) if t else 0 for t in texts]
        if len(self.known) > MEMORY_WORDS:
            self.known.clear()
        # words as bytes: only ASCII white space splits them
        small = [t.encode("utf-8").split() if t is not None and len(t) <= self.chunk else None for t in texts]
        fresh = {w for ws in small if ws for w in ws}
        names = {w: w.decode("utf-8") for w in fresh}
        self.learn(set(names.values()))
        size = {w: self.known[s] for w, s in names.items()}
        return [
            0 if not t else sum(map(size.__getitem__, ws)) if ws is not None else self.huge(t)
            for t, ws in zip(texts, small)
        ]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = TOKEN_LIMIT, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col, n_bytes, n_tokens, over_limit``.

    ``vocabulary`` is a tokenizer file every worker can read (default: the
    word-level BPE of the installed tokenizer package); one whose tokens hold
    white space encodes every text whole.  One pass, no shuffle.
    """

    def make(batch: pa.RecordBatch) -> list:
        path = vocabulary or vocabulary_path()
        key = f"{path}|{chunk_chars}|{overlap_chars}"
        if key not in _workers:
            _workers[key] = Counter(path, chunk_chars, overlap_chars)
        return [batch.column("id"), batch.column("n_bytes"), _workers[key].count(batch.column("text").to_pylist())]

    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    counted = map_batches(src, make, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
