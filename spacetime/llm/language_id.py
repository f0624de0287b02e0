"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained by follow-the-regularised-leader with elastic-net
penalties, then calibrated by a temperature.

A text is lower-cased; runs of non-letters become one space; its 1- to
``max_gram``-grams are hashed into ``2 ** bits`` columns.  A column's value is
``(1 + ln tf) * idf`` and a document's vector has length one.  Document
frequencies are counted over all training documents.  The weights are fitted on
a bounded sample (about ``sample_docs`` different rows, as many of each label as
there are labels to go round, chosen by a hash of the row); every fifth of the sample is
kept from the fit and sets the temperature.  The sample is stored as sparse
vectors, which the learner goes through in order of their hash; the driver also
receives a table of ``2 ** bits`` frequencies, never texts.

Edge cases: null text, or text without a letter, is ``und`` with score 0; a null
label is never learned; with no label at all everything is ``und``; repeated
rows are predicted each; very long texts are counted in blocks, whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.llm.common import bounded_broadcast, documents, map_batches, stored

BITS = 16
MAX_GRAM = 3
SAMPLE_DOCS = 3_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
BLOCK = 1 << 18
#: Tables with a row per label are broadcast up to this many rows.
BROADCAST_LABELS = 100_000
UNKNOWN = "und"

_GAP = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str, bits: int = BITS, max_gram: int = MAX_GRAM) -> np.ndarray:
    """Occurrences of each column's n-grams in a whole text."""
    counts = np.zeros(1 << bits, dtype=np.int64)
    chars = (" " + _GAP.sub(" ", text.lower()).strip() + " ").encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(chars, dtype=np.uint32).astype(np.uint64)
    shift = np.uint64(64 - bits)
    for a in range(0, len(points), BLOCK):
        block = points[a : a + BLOCK + max_gram - 1]
        here = min(BLOCK, len(points) - a)
        h = np.zeros(len(block), dtype=np.uint64)
        for n in range(1, max_gram + 1):
            m = min(here, len(block) - n + 1)
            if m <= 0:
                break
            h = (h[: len(block) - n + 1] + block[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            counts += np.bincount((h[:m] >> shift).astype(np.int64), minlength=1 << bits)
    return counts


def vector(text: str, idf: np.ndarray, bits: int = BITS, max_gram: int = MAX_GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values of a text's TF-IDF vector, of length one."""
    counts = gram_counts(text, bits, max_gram)
    cols = np.flatnonzero(counts)
    values = (1 + np.log(counts[cols])) * idf[cols]
    norm = np.sqrt((values * values).sum())
    return cols, values / norm if norm > 0 else values


class Model:
    """Labels, idf-weighted columns and the temperature of a fit."""

    def __init__(self, labels: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float, bits: int, max_gram: int):
        self.labels, self.idf, self.weights, self.temperature, self.bits, self.max_gram = labels, idf, weights, temperature, bits, max_gram

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNKNOWN, 0.0
        cols, values = vector(text, self.idf, self.bits, self.max_gram)
        p = softmax(values @ self.weights[cols] / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: Callable[[], Iterable[tuple[np.ndarray, np.ndarray, int]]], labels: int, columns: int, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> np.ndarray:
    """Weights (columns x labels) by per-coordinate follow-the-regularised-
    leader over ``rows()`` (columns, values, label), gone through ``epochs``
    times; coordinates whose sum stays within ``l1`` are exactly zero."""
    z, n = np.zeros((columns, labels)), np.zeros((columns, labels))

    def weights(zz: np.ndarray, nn: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    for _ in range(epochs):
        for cols, values, y in rows():
            zz, nn = z[cols], n[cols]
            w = weights(zz, nn)
            p = softmax(values @ w)
            p[y] -= 1
            g = values[:, None] * p[None, :]
            new = nn + g * g
            z[cols] = zz + g - (np.sqrt(new) - np.sqrt(nn)) / alpha * w
            n[cols] = new
    return weights(z, n)


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section
    on its logarithm.  A label counts as (n + 1) / (n + 2) sure, so that a held
    set without an error does not ask for certainty."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        sure = (len(y) + 1) / (len(y) + 2)
        right = z[np.arange(len(y)), y]
        wrong = (z.sum(axis=1) - right) / max(1, z.shape[1] - 1)
        return float((np.log(np.exp(z).sum(axis=1)) - sure * right - (1 - sure) * wrong).mean())

    lo, hi, r = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def document_frequencies(train: DataFrame, bits: int, max_gram: int) -> tuple[int, np.ndarray]:
    """Training texts, and in how many of them each column occurs.  A task
    sends one sum per column; the result has ``2 ** bits`` numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = 0, np.zeros(1 << bits, dtype=np.int64)
        for pdf in batches:
            for t in pdf["text"]:
                if has_letter(t):
                    total += 1
                    seen += gram_counts(t, bits, max_gram) > 0
        cols = np.flatnonzero(seen)
        yield pd.DataFrame({"col": np.r_[-1, cols], "n": np.r_[total, seen[cols]]})

    rows = train.select("text").mapInPandas(run, "col long, n long").groupBy("col").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(1 << bits)
    at = rows["col"].to_numpy(dtype=np.int64)
    n = rows["n"].to_numpy(dtype=np.int64)
    df[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), df


def train(docs: DataFrame, learn: Column, sample_docs: int = SAMPLE_DOCS, bits: int = BITS, max_gram: int = MAX_GRAM, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model:
    """A model of the rows where ``learn`` holds and the label is known."""
    known = docs.where(learn & F.col(label_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label")
    )
    total, df = document_frequencies(known, bits, max_gram)
    idf = np.where(df > 0, np.log((1 + total) / (1 + df)) + 1, 0.0)
    row = F.xxhash64("id", "text", "label")
    per_label = known.groupBy("label").agg(F.approx_count_distinct(row, 0.02).alias("n"))
    n_labels = per_label.count()
    if not total or not n_labels:
        return Model([], idf, np.zeros((1 << bits, 0)), 1.0, bits, max_gram)
    # A row's place among its label's rows is a hash; a label gives its share of the sample, all if it has fewer.
    # Equal rows count once.
    unit = F.pmod(row, F.lit(1 << 40)) / float(1 << 40)
    chance = per_label.select("label", F.least(F.lit(1.0), F.lit(sample_docs / n_labels) / F.col("n")).alias("chance"))
    picked = known.withColumn("unit", unit).join(bounded_broadcast(stored(chance, "label-chances"), BROADCAST_LABELS), "label").where("unit < chance").select("id", "unit", "label", "text").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, u, lab, t in zip(pdf["id"], pdf["unit"], pdf["label"], pdf["text"]):
                if has_letter(t):
                    cols, values = vector(t, idf, bits, max_gram)
                    out.append((u, i, lab, cols.astype(np.int32).tobytes(), values.astype(np.float32).tobytes()))
            yield pd.DataFrame(out, columns=["unit", "id", "label", "cols", "vals"])

    sample = stored(picked.mapInPandas(run, "unit double, id string, label string, cols binary, vals binary"), "language-sample")
    labels = [r["label"] for r in sample.select("label").distinct().orderBy("label").collect()]

    def rows(held: bool) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        # the leader learns online: a partition of the sample is here at a time
        for i, r in enumerate(sample.orderBy("unit", "id", "label", "cols").toLocalIterator()):
            if (i % 5 == 4) == held:
                yield np.frombuffer(r["cols"], dtype=np.int32), np.frombuffer(r["vals"], dtype=np.float32).astype(float), labels.index(r["label"])

    weights = ftrl(lambda: rows(False), len(labels), 1 << bits)
    pairs = [(values @ weights[cols], y) for cols, values, y in rows(True)]
    logits = np.array([z for z, _ in pairs]).reshape(len(pairs), len(labels))
    return Model(labels, idf, weights, temperature(logits, np.array([y for _, y in pairs], dtype=int)), bits, max_gram)


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``lang_pred, score``; only the text decides."""
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text_col).alias("text"))
    names = [f"k{i}" for i in range(len(keep))]
    schema = ", ".join(f"{n} {src.schema[n].dataType.simpleString()}" for n in names) + ", lang_pred string, score double"

    def make(batch: pa.RecordBatch) -> list:
        found = [model.predict(t) for t in batch.column("text").to_pylist()]
        return [*[batch.column(n) for n in names], [f[0] for f in found], [f[1] for f in found]]

    out = map_batches(src, make, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "lang_pred", "score")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = train(docs, ~held_out)
    return predict(docs.withColumn("held_out", held_out), model, keep=("doc_id", "held_out"))
