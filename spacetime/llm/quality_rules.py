"""Quality rules with risk-controlled thresholds.

Each rule measures one share of a document (symbols, repeated lines, repeated
words, shouting letters, separators).  Its cutoff is learned per stratum from labelled
documents: a cutoff is admissible if the exact binomial test rejects, for good
documents, a false rejection rate above ``risk``; the level is divided by the
number of tests made (strata x rules x cutoffs), so that with probability
``1 - delta`` *every* chosen cutoff of every stratum keeps its promise.  Among
the admissible cutoffs the strictest is taken; without one the rule is off in
that stratum.  Strata with too few good labels for any test to succeed share
one stratum.

Everything is a DataFrame expression: texts are read once into five numbers a
document, which are stored; learning and deciding work on those.

Edge cases: null or empty text has no words and fails the base rule; unlabelled
documents only are judged; a ``doc_id`` labelled more than once counts as good
only if all its labels say so; labels without a document are ignored; a null
stratum is a stratum of its own; without labels only the base rule decides.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spacetime.llm.common import bounded_broadcast, documents, fresh, own_columns, stored, words_of

RISK = 0.01
DELTA = 0.05
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Cutoffs tried for every rule, as shares.
CUTOFFS = (0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.45, 0.6)
#: Strata up to this many rows of learned cutoffs are broadcast.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Rule:
    """``share`` is computed from the measures; large values are bad."""

    name: str
    share: str


RULES = (
    Rule("symbols", "n_symbols / greatest(word_chars, 1)"),
    Rule("dup_lines", "n_dup_lines / greatest(n_lines, 1)"),
    Rule("repeats", "n_repeat_words / greatest(n_words, 1)"),
    Rule("shouting", "n_upper / greatest(word_chars, 1)"),
)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row (a lambda would
    compute an outer expression anew for each element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words inside a window of ``WINDOW`` words that occurs twice or more in
    the text.  Windows are keyed by a hash first; only a text in which keys
    repeat is looked at again, by its window texts."""
    n = F.size(words)
    starts = F.sequence(F.lit(0), n - WINDOW)
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(
        let(
            F.transform(words, lambda w: F.xxhash64(w)),
            lambda hashes: let(
                F.transform(starts, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WINDOW)])),
                lambda keys: F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(
                    let(F.array_sort(F.transform(starts, lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("w"), i.alias("i")))), _covered)
                ),
            ),
        )
    )


def _covered(rows: Column) -> Column:
    """Words covered by the windows whose text equals that of a neighbour in
    the sorted ``rows`` (structs of window text and start)."""
    last = F.size(rows) - 1
    repeated = F.transform(
        rows,
        lambda r, k: F.when(
            ((k > 0) & (F.get(rows, k - 1)["w"] == r["w"])) | ((k < last) & (F.get(rows, k + 1)["w"] == r["w"])), r["i"]
        ),
    )
    starts = F.array_sort(F.filter(repeated, lambda i: i.isNotNull()))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        starts,
        zero,
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(acc["end"], i)).cast("long").alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"],
    )


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", strata: Column | None = None) -> DataFrame:
    """``id, h`` (a hash of the text), ``stratum`` and the numbers every rule
    is made of."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), (strata if strata is not None else F.lit("")).cast("string").alias("stratum"), text.alias("text"))
    d = d.withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    joined = F.array_join("words", "")
    return d.select(
        "id",
        "h",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("l"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
    ).select(
        "id", "h", "stratum", "n_words", "word_chars", "n_symbols",
        (F.col("l.n") - F.col("l.d")).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "n_upper", F.col("l.n").cast("long").alias("n_lines"),
    )


def _ln_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 1 (argument raised by
    8, then Stirling's series; error below 1e-11)."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5)))
    up = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + series
    for j in range(8):
        up = up - F.log(x + j)
    return up


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed from k downwards until the rest is below
    1e-16 of it; 1 where k is not below n * p (no test can succeed there)."""
    k, n = k.cast("double"), n.cast("double")
    at_k = _ln_gamma(n + 1) - _ln_gamma(k + 1) - _ln_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    # Going down from k, terms shrink by j (1 - p) / ((n - j + 1) p) <= this ratio each.
    width = F.least(k, F.ceil(12 * F.sqrt(n) + 50))
    steps = F.when(width >= 1, F.sequence(F.lit(0).cast("long"), width.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def down(acc: Column, i: Column) -> Column:
        j = k - i
        t = acc["t"] * j * (1 - p) / ((n - j + 1) * p)
        return F.struct(t.alias("t"), (acc["s"] + t).alias("s"))

    total = F.aggregate(steps, zero, down, lambda acc: acc["s"])
    return F.when((n <= 0) | (k >= n * p), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(at_k) * total))


def learn_cutoffs(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", good_col: str = "quality", rules: tuple[Rule, ...] = RULES, cutoffs: tuple[float, ...] = CUTOFFS, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per stratum with one nullable cutoff column per rule and the
    evidence (``n_good``).  ``pooled`` marks the shared stratum."""
    good = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(good_col)).alias("good")).where("good = 1")
    held = measured.join(good.select("id"), "id").where(~base_failed())
    wide = [F.sum(F.when(F.expr(r.share) > c, 1).otherwise(0)).alias(f"k{i}_{j}") for i, r in enumerate(rules) for j, c in enumerate(cutoffs)]
    counted = stored(held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n_good"), *wide), "cutoff-counts")
    tests = len(rules) * len(cutoffs) * max(1, counted.count() + 1)
    # Fewer good labels than this fail every test even without one false rejection.
    least = F.log(F.lit(delta / tests)) / F.log(F.lit(1 - risk))
    names = [f"k{i}_{j}" for i in range(len(rules)) for j in range(len(cutoffs))]
    own = counted.where(F.col("n_good") >= least).withColumn("pooled", F.lit(False))
    pool = counted.where(F.col("n_good") < least).agg(F.sum("n_good").alias("n_good"), *[F.sum(c).alias(c) for c in names])
    both = own.unionByName(pool.where("n_good > 0").select(F.lit(None).cast("string").alias("stratum"), "n_good", *names, F.lit(True).alias("pooled")))

    def chosen(i: int) -> Column:
        passed = [F.when(binomial_tail(F.col(f"k{i}_{j}"), F.col("n_good"), risk) <= delta / tests, F.lit(c)) for j, c in enumerate(cutoffs)]
        return F.least(*passed) if len(passed) > 1 else passed[0]

    return stored(both.select("stratum", "pooled", "n_good", *[chosen(i).alias(f"cut_{r.name}") for i, r in enumerate(rules)]), "cutoffs")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(measured: DataFrame, cutoffs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with ``base_failed``, one flag per rule and ``kept``."""
    names = [f"cut_{r.name}" for r in rules]
    own = cutoffs.where(~F.col("pooled")).select(F.col("stratum").alias("own_stratum"), F.lit(True).alias("is_own"), *[F.col(c).alias(f"own_{c}") for c in names])
    pool = cutoffs.where("pooled").first()  # one row at most
    shared = {c: F.lit(pool[c] if pool is not None else None).cast("double") for c in names}
    found = measured.join(bounded_broadcast(own, BROADCAST_ROWS), F.col("stratum").eqNullSafe(F.col("own_stratum")), "left")
    # a stratum judged by itself never falls back to the shared cutoffs
    has_own = F.coalesce(F.col("is_own"), F.lit(False))
    hit = {r.name: F.coalesce(F.expr(r.share) > F.when(has_own, F.col(f"own_cut_{r.name}")).otherwise(shared[f"cut_{r.name}"]), F.lit(False)) for r in rules}
    judged = found.withColumns({"base_failed": base_failed(), **{f"hit_{k}": v for k, v in hit.items()}})
    bad = F.col("base_failed")
    for r in rules:
        bad = bad | F.col(f"hit_{r.name}")
    return judged.withColumn("kept", ~bad)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """One row per document: its measures, flags and the verdict ``kept``."""
    measured = stored(measures(docs, id_col, text_col, F.col(stratum_col)), "quality-measures")
    verdicts = judge(measured, learn_cutoffs(measured, labels, risk=risk, delta=delta))
    return verdicts.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[f"hit_{r.name}" for r in RULES],
    )


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, unchanged, that the rules keep.  Rows that agree in
    id, text and stratum have one verdict, so rejections are joined by those."""
    measured = stored(measures(docs, id_col, text_col, F.col(stratum_col)), "quality-measures")
    bad = judge(measured, learn_cutoffs(measured, labels)).where("not kept").select("id", "h", F.col("stratum").alias("bad_stratum")).distinct()
    h = fresh(docs, "text_hash")
    keyed = docs.withColumn(h, F.xxhash64(text_col))
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("b.id")) & (F.col(f"d.{h}") == F.col("b.h")) & F.col(f"d.{stratum_col}").cast("string").eqNullSafe(F.col("b.bad_stratum"))
    return keyed.alias("d").join(bad.alias("b"), same, "left_anti").select(*own_columns(docs))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_rules(documents(spark, sf_dir), labels)


def oracle_sql() -> str:
    """DuckDB SQL for ``op8_quality_rules``: the same measures, the binomial
    tail as a plain sum, the same choice of cutoffs."""
    shares = [r.share for r in RULES]
    rules = ", ".join(f"({i}, '{r.name}')" for i, r in enumerate(RULES))
    cutoffs = ", ".join(f"(CAST({c} AS DOUBLE))" for c in CUTOFFS)
    share = "CASE rule " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(shares)) + " END"
    hits = {r.name: f"coalesce({r.share} > c.cut_{i}, false)" for i, r in enumerate(RULES)}
    return rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, hash(array_to_string(w[i : i + {WINDOW - 1}], ' '))) AS n
  FROM texts, unnest(range(1, len(w) - {WINDOW - 2})) AS t(i)
), repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM windows, unnest(range(0, {WINDOW})) AS t(j) WHERE n > 1 GROUP BY doc_id
), measured AS (
  SELECT doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS n_upper, len(lines) AS n_lines
  FROM (SELECT *, [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM texts) t
  LEFT JOIN repeats r USING (doc_id)
), based AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured
), good AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), held AS (
  SELECT b.* FROM based b JOIN good USING (doc_id) WHERE NOT base_failed
), counted AS (
  SELECT lang, rule, cutoff, count(*) AS n, count(*) FILTER ({share} > cutoff) AS k
  FROM held, (VALUES {rules}) r(rule, name), (VALUES {cutoffs}) c(cutoff) GROUP BY ALL
), tests AS (
  SELECT {len(RULES) * len(CUTOFFS)} * greatest(1, count(DISTINCT coalesce(lang, '')) + 1) AS m FROM counted
), own AS (
  SELECT lang, false AS pooled, rule, cutoff, n, k FROM counted, tests WHERE n >= ln({DELTA} / m) / ln(1 - {RISK})
  UNION ALL
  SELECT NULL, true, rule, cutoff, sum(n), sum(k) FROM counted, tests WHERE n < ln({DELTA} / m) / ln(1 - {RISK}) GROUP BY rule, cutoff
), tails AS (
  SELECT lang, pooled, rule, cutoff, CASE WHEN k >= n * {RISK} THEN 1 ELSE list_sum([
    exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({RISK}) + (n - j) * ln(1 - {RISK})) FOR j IN range(0, CAST(k + 1 AS BIGINT))]) END AS tail
  FROM own
), cuts AS (
  SELECT lang, pooled, {", ".join(f"min(cutoff) FILTER (rule = {i} AND tail <= {DELTA} / m) AS cut_{i}" for i in range(len(RULES)))}
  FROM tails, tests GROUP BY lang, pooled
), judged AS (
  SELECT b.*, {", ".join(f"{h} AS hit_{n}" for n, h in hits.items())}
  FROM based b LEFT JOIN cuts c ON CASE WHEN EXISTS (SELECT 1 FROM cuts o WHERE NOT o.pooled AND o.lang IS NOT DISTINCT FROM b.lang)
    THEN NOT c.pooled AND c.lang IS NOT DISTINCT FROM b.lang ELSE c.pooled END
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {" OR ".join(f"hit_{r.name}" for r in RULES)}) AS kept, {", ".join(f"hit_{r.name}" for r in RULES)}
FROM judged
"""
