"""Secret scans with a linear-chain conditional random field.

Tokens are tagged begin / inside / outside of a secret from their shape, the
tokens beside them and features of the file, decoded by Viterbi.  Fixed
patterns (:func:`base_spans`) find the well-formed secrets; the field is trained
on what they mark in a bounded sample of documents and adds the spans they miss.

Training: about ``sample_docs`` of the documents in which a base pattern matches
give windows of tokens around marked spans (a few a document), about as many of
all documents one window elsewhere; both are chosen by a hash of id and text.
At most ``sample_windows`` windows reach the driver, half of each sort.  The fit
is the conditional likelihood by forward-backward and adaptive gradient steps.

Scanning is one pass without a shuffle.  A token's features do not depend on
its spelling but on its type (shape, length, class), so scores are sums of table
rows.  A token whose margin for "outside" exceeds what any two transitions can
win back is outside on the best path; Viterbi runs on the pieces between such
tokens, which gives the path of the whole text.

Edge cases: null or empty text has no spans; without any marked sample only the
fixed patterns apply; repeated rows are scanned each; text of any length is
scanned whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.llm.common import documents, map_batches, map_rows, stored

SAMPLE_DOCS = 20_000
SAMPLE_WINDOWS = 6_000
WINDOWS_PER_DOC = 4
CONTEXT = 10
EPOCHS = 14
MASK = "[SECRET]"

# The base patterns, their least lengths and the order of kinds.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "crf")
CUES = ("password", "passwd", "secret", "token", "api")
KEYWORDS = frozenset(("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "key", "bearer", "auth", "credential", "credentials"))

TOKEN = re.compile(r"[\w+/\-]+(?:\.[\w+/\-]+)*|[^\w\s+/\-]")
BEGIN, INSIDE, OUTSIDE = 0, 1, 2
#: Upper ends of the length classes of tokens.
SIZES = (3, 5, 8, 12, 16, 20, 32, 1 << 60)
MAX_TYPES = 60_000
MAX_WORDS = 500_000


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """``(start, end, kind, value start)`` of every match of the fixed patterns."""
    found = []
    low = text.lower()
    if any(c in low for c in CUES):
        found += [(m.start(), m.end(), "assign", m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex", m.start()) for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def kind_of(token: str) -> tuple[str, ...]:
    """What a token is, apart from its spelling: its type."""
    low = token.lower()
    if low in KEYWORDS:
        return ("kw",)
    if len(token) == 1:
        c = token
        return ("p" + c if c in "=:\"'.,;()<>&#@!?" else "l" if c.isalpha() else "d" if c.isdigit() else "o",)
    upper = any(c.isupper() for c in token)
    lower = any(c.islower() for c in token)
    digit = any(c.isdigit() for c in token)
    other = any(not c.isalnum() for c in token)
    n = len(token)
    size = next(i for i, e in enumerate(SIZES) if n < e)
    shape = ("U" if upper else "") + ("l" if lower else "") + ("9" if digit else "") + ("-" if other else "")
    title = upper and lower and token[0].isupper() and token[1:].islower()
    hexa = n >= 8 and digit and all(c in "0123456789abcdef" for c in token)
    bits = -1
    if n >= 8 and (digit or other):
        bits = int(2 * -sum(v / n * math.log2(v / n) for v in Counter(token).values()))
    switches = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:])) if digit else 0
    return ("Ul" if title and not digit and not other else shape, f"n{size}", f"x{int(hexa)}", f"e{bits}", f"s{min(switches, 6)}", "K" if token[:4] == "AKIA" else "k")


def features_of(kind: tuple[str, ...]) -> list[str]:
    return ["|".join(kind), *kind, "".join(kind[:2])]


def file_features(kinds_count: int, digits: int, cue: bool) -> list[str]:
    share = digits / max(1, kinds_count)
    return [f"f:n{min(6, int(math.log10(kinds_count + 1) * 2))}", f"f:d{0 if not digits else 1 if share < 0.01 else 2 if share < 0.1 else 3}", f"f:c{int(cue)}"]


class Field:
    """Weights of a linear-chain field over feature names."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.names, self.weights, self.moves = names, weights, moves
        self.forget()

    def forget(self) -> None:
        self.types: dict[tuple[str, ...], int] = {}
        self.words: dict[str, bytes] = {}
        self.plain: dict[tuple, bytes] = {}
        self.own = np.zeros((256, 3))
        self.left = np.zeros((256, 3))
        self.right = np.zeros((256, 3))
        self.digit = np.zeros(256, dtype=bool)

    def __getstate__(self):
        return self.names, self.weights, self.moves

    def __setstate__(self, state):
        self.__init__(*state)

    def score(self, prefix: str, features: list[str]) -> np.ndarray:
        at = [i for f in features if (i := self.names.get(prefix + f)) is not None]
        return self.weights[at].sum(axis=0) if at else np.zeros(3)

    def type_of(self, kind: tuple[str, ...]) -> int:
        t = self.types.get(kind)
        if t is None:
            t = self.types[kind] = len(self.types)
            if t >= len(self.own):
                self.own, self.left, self.right = (np.vstack([x, np.zeros_like(x)]) for x in (self.own, self.left, self.right))
                self.digit = np.concatenate([self.digit, np.zeros_like(self.digit)])
            f = features_of(kind)
            self.own[t], self.left[t], self.right[t] = self.score("0:", f), self.score("-:", f), self.score("+:", f)
            self.digit[t] = "9" in kind[0] or kind[0] == "d"
        return t

    def word(self, word: str) -> bytes:
        """Types of a word's tokens.  A word of letters, or one ended by a
        mark, is looked up by what its type depends on: case and length."""
        stem, mark = (word, "") if word.isalpha() else (word[:-1], word[-1])
        if stem.isalpha() and mark in ("", ",", ".", ";", ":", "!", "?") and stem.lower() not in KEYWORDS and stem[:4] != "AKIA":
            case = (next(i for i, e in enumerate(SIZES) if len(stem) < e), len(stem) == 1, mark, stem.islower(), stem.isupper(), stem.istitle())
            if sum(case[3:]) == 1:
                if case not in self.plain:
                    self.plain[case] = self.pack(word)
                return self.plain[case]
        return self.pack(word)

    def pack(self, word: str) -> bytes:
        return np.array([self.type_of(kind_of(t)) for t in TOKEN.findall(word)], dtype=np.uint16).tobytes()

    def types_in(self, text: str) -> np.ndarray:
        if len(self.types) > MAX_TYPES or len(self.words) > MAX_WORDS:
            self.forget()
        words, known = text.split(), self.words
        try:
            joined = b"".join(map(known.__getitem__, words))
        except KeyError:
            for w in set(words).difference(known):
                known[w] = self.word(w)
            joined = b"".join(map(known.__getitem__, words))
        return np.frombuffer(joined, dtype=np.uint16)

    def emissions(self, types: np.ndarray, cue: bool) -> np.ndarray:
        e = self.own[types]
        e[1:] += self.left[types[:-1]]
        e[:-1] += self.right[types[1:]]
        return e + self.score("", file_features(len(types), int(self.digit[types].sum()), cue))

    def tags(self, types: np.ndarray, cue: bool) -> np.ndarray:
        """Best path; tokens that cannot leave OUTSIDE cut it into pieces."""
        tags = np.full(len(types), OUTSIDE, dtype=np.int8)
        if not len(types):
            return tags
        e = self.emissions(types, cue)
        swing = 2 * (self.moves.max() - self.moves.min())
        open_ = np.flatnonzero(e[:, OUTSIDE] - e[:, :OUTSIDE].max(axis=1) <= swing)
        if len(open_):
            cuts = np.flatnonzero(np.diff(open_) > 1)
            for a, b in zip(open_[np.r_[0, cuts + 1]], open_[np.r_[cuts, len(open_) - 1]] + 1):
                tags[a:b] = self.viterbi(e[a:b], a > 0, b < len(types))
        return tags

    def viterbi(self, e: np.ndarray, before: bool, after: bool) -> np.ndarray:
        s = e[0] + (self.moves[OUTSIDE] if before else 0)
        back = np.zeros((len(e), 3), dtype=np.int8)
        for t in range(1, len(e)):
            step = s[:, None] + self.moves
            back[t] = step.argmax(axis=0)
            s = step.max(axis=0) + e[t]
        if after:
            s = s + self.moves[:, OUTSIDE]
        path = np.empty(len(e), dtype=np.int8)
        path[-1] = s.argmax()
        for t in range(len(e) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path

    def spans(self, text: str) -> list[tuple[int, int]]:
        low = text.lower()
        tags = self.tags(self.types_in(text), any(c in low for c in CUES))
        if not (tags != OUTSIDE).any():
            return []
        found: list[tuple[int, int]] = []
        last = OUTSIDE
        for m, tag in zip(TOKEN.finditer(text), tags):
            if tag == BEGIN or (tag == INSIDE and last == OUTSIDE):
                found.append((m.start(), m.end()))
            elif tag == INSIDE:
                found[-1] = (found[-1][0], m.end())
            last = tag
        return found


def all_spans(text: str | None, field: Field | None) -> list[tuple[int, int, str, int]]:
    """Base spans and the field's spans that they do not cover, in order."""
    if not text:
        return []
    base = base_spans(text)
    if field is None:
        return base
    added = [(a, b, "crf", a) for a, b in field.spans(text) if not covered(a, b, base)]
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2])))


def covered(a: int, b: int, spans: list[tuple[int, int, str, int]]) -> bool:
    """Whether ``spans`` (by start) together hold all of ``a`` to ``b``."""
    for s, e, _, _ in spans:
        if s > a:
            break
        a = max(a, e)
    return a >= b


def windows(text: str, key: int) -> list[tuple[list[str], list[int], int, int]]:
    """Training windows of a text: tokens, tags, and its file numbers."""
    marked = base_spans(text)
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    if not tokens:
        return []
    starts = np.array([a for a, _ in tokens])
    tags = np.full(len(tokens), OUTSIDE)
    centres = []
    for a, b, _, value in marked:
        lo, hi = np.searchsorted(starts, value), np.searchsorted(starts, b)
        if lo < hi:
            tags[lo:hi] = INSIDE
            tags[lo] = BEGIN
            centres.append(int(lo))
    centres = centres[:WINDOWS_PER_DOC] + [key % len(tokens)]
    digits = sum(any(c.isdigit() for c in text[a:b]) for a, b in tokens)
    out = []
    for c in centres:
        lo, hi = max(0, c - CONTEXT), min(len(tokens), c + CONTEXT + 1)
        out.append(([text[a:b][:200] for a, b in tokens[lo:hi]], tags[lo:hi].tolist(), len(tokens), digits))
    return out


def has_secret(text: Column) -> Column:
    """Whether a base pattern matches; the cheap conditions come first."""
    low = F.lower(text)
    cue = reduce(Column.__or__, [low.contains(c) for c in CUES])
    assign = rf"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{{{MIN_ASSIGN},}}"
    access = rf"AKIA[A-Z0-9]{{{MIN_ACCESS - 4},}}"
    return F.coalesce((text.contains("AKIA") & text.rlike(access)) | text.rlike(HEX.pattern) | (cue & text.rlike(assign)), F.lit(False))


def training_windows(docs: DataFrame, sample_docs: int, sample_windows: int, id_col: str, text_col: str) -> list:
    """At most ``sample_windows // 2`` windows with a secret, of about
    ``sample_docs`` documents that hold one, and as many without, of about
    ``sample_docs`` of all documents; the same for the same rows."""
    src = docs.select(F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("key"), F.col(text_col).alias("text")).where("text is not null")
    src = src.withColumn("key", F.pmod("key", F.lit(1 << 40)))
    rows, held = src.agg(F.count(F.lit(1)), F.count_if(has_secret(F.col("text")))).first()
    of_all, of_held = (int((1 << 40) * min(1.0, sample_docs / max(1, n))) for n in (rows, held))
    picked = src.where((F.col("key") < of_all) | ((F.col("key") < of_held) & has_secret(F.col("text"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(k, *w, i) for k, t in zip(pdf["key"], pdf["text"]) for i, w in enumerate(windows(t, int(k)))]
            yield pd.DataFrame(out, columns=["key", "tokens", "tags", "n", "digits", "i"])

    seqs = stored(picked.mapInPandas(run, "key long, tokens array<string>, tags array<int>, n long, digits long, i int"), "secret-windows")
    marked = F.array_contains("tags", BEGIN)
    first = lambda some: some.orderBy("key", "i", "tokens").limit(sample_windows // 2).collect()
    return first(seqs.where(marked)) + first(seqs.where(~marked & (F.col("key") < of_all)))


def fit(seqs: list, epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-5) -> Field | None:
    """Conditional likelihood of the windows by forward-backward, in batches
    with adaptive gradient steps; None without a marked token."""
    if not any(t != OUTSIDE for s in seqs for t in s["tags"]):
        return None
    names: dict[str, int] = {}
    made: list[list[list[int]]] = []
    kinds: dict[str, tuple[str, ...]] = {}
    for s in seqs:
        ks = [kinds.setdefault(t, kind_of(t)) for t in s["tokens"]]
        cue = any(c in " ".join(s["tokens"]).lower() for c in CUES)
        files = file_features(s["n"], s["digits"], cue)
        rows = []
        for i, k in enumerate(ks):
            fs = ["0:" + f for f in features_of(k)] + files
            fs += ["-:" + f for f in features_of(ks[i - 1])] if i else []
            fs += ["+:" + f for f in features_of(ks[i + 1])] if i + 1 < len(ks) else []
            rows.append([names.setdefault(f, len(names)) for f in fs])
        made.append(rows)
    n, long = len(names), max(map(len, made))
    weights, moves = np.zeros((n + 1, 3)), np.zeros((3, 3))
    gw, gm = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    most = max(len(r) for rows in made for r in rows)
    order = np.random.default_rng(7).permutation(len(made))
    for _ in range(epochs):
        for at in range(0, len(order), 256):
            part = order[at : at + 256]
            x = np.full((len(part), long, most), n)
            y = np.full((len(part), long), OUTSIDE)
            size = np.array([len(made[i]) for i in part])
            for j, i in enumerate(part):
                y[j, : size[j]] = seqs[i]["tags"]
                for t, r in enumerate(made[i]):
                    x[j, t, : len(r)] = r
            live = np.arange(long)[None, :] < size[:, None]
            e = weights[x].sum(axis=2)
            p, pair = _marginals(e, moves, size)
            d = np.where(live[:, :, None], p - np.eye(3)[y], 0.0)
            dw = np.zeros_like(weights)
            flat = x.reshape(-1, most)
            for lab in range(3):
                dw[:, lab] = np.bincount(flat.ravel(), weights=np.repeat(d.reshape(-1, 3)[:, lab], most), minlength=n + 1)
            dw[n] = 0
            seen = np.zeros((3, 3))
            ok = live[:, 1:]
            np.add.at(seen, (y[:, :-1][ok], y[:, 1:][ok]), 1)
            dm = pair - seen
            dw, dm = dw / len(part) + decay * weights, dm / len(part) + decay * moves
            gw += dw * dw
            gm += dm * dm
            weights -= rate * dw / np.sqrt(gw)
            moves -= rate * dm / np.sqrt(gm)
            weights[n] = 0
    return Field(names, weights[:n].copy(), moves)


def _marginals(e: np.ndarray, moves: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag marginals of every token and the summed marginals of neighbours."""
    m, long, _ = e.shape
    lse = lambda a, axis: (mx := a.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - mx).sum(axis=axis))
    fwd, bwd = np.zeros_like(e), np.zeros_like(e)
    fwd[:, 0] = e[:, 0]
    for t in range(1, long):
        fwd[:, t] = lse(fwd[:, t - 1, :, None] + moves[None], 1) + e[:, t]
    for t in range(long - 2, -1, -1):
        nxt = lse(moves[None] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :], 2)
        bwd[:, t] = np.where((t + 1 < size)[:, None], nxt, 0.0)
    z = lse(fwd + bwd, 2)
    p = np.exp(fwd + bwd - z[:, :, None])
    pair = np.zeros((3, 3))
    for t in range(long - 1):
        joint = np.exp(fwd[:, t, :, None] + moves[None] + (e[:, t + 1] + bwd[:, t + 1])[:, None, :] - z[:, t, None, None])
        pair += joint[t + 1 < size].sum(axis=0)
    return p, pair


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> Field | None:
    return fit(training_windows(docs, sample_docs, sample_windows, id_col, text_col))


_SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, spans``: every span of every row (kind, start, end in code
    points, end exclusive), by start, then kind."""

    def make(batch: pa.RecordBatch) -> list:
        return [batch.column("id"), [[{"kind": k, "start": a, "end": b} for a, b, k, _ in all_spans(t, field)] for t in batch.column("text").to_pylist()]]

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_batches(src, make, f"id {src.schema['id'].dataType.simpleString()}, spans {_SPANS}").withColumnRenamed("id", id_col)


def redacted(text: str | None, field: Field | None, mask: str = MASK) -> str | None:
    """``text`` with every span, or union of overlapping spans, masked."""
    out, at = [], 0
    if not text:
        return text
    for a, b, _, _ in all_spans(text, field):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, field: Field | None, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with secrets masked in ``text_col``, and ``length_col`` (code
    points) set anew where a text changed; other columns and all rows stay."""
    at = docs.columns.index(text_col)
    size = docs.columns.index(length_col) if length_col else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [redacted(t, field) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if size is not None:
                columns[size] = pa.array([n if a == b else len(b) for n, a, b in zip(columns[size].to_pylist(), old, new)], columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_rows(docs, run)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = find_secrets(docs, train(docs))
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", one), ",").alias("spans"),
    )
