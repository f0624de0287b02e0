"""Mixing sources to target weights by entropy balancing.

Every document d of source s is taken at a rate q between 0 and ``max_copies``.
Among all rates whose words add up to the source's target, entropy balancing
takes those closest to an even start in relative entropy (of the rate and of
what is left to ``max_copies``).  They are exponentially tilted:

    q / (max_copies - q) = exp(lambda_s * size_d / mean size of s)

The convex dual separates by source; its one unknown ``lambda_s`` is found by
Newton iterations.  Each iteration is one aggregation over the histogram
(source, size, documents) - documents of one source and size have one rate, so
the histogram holds the whole problem - followed by a safeguarded step on the
table of sources.  Sources are never collected.

Rates become copies without chance: along the documents of a source in order
of size, copies are the steps of the running sum of rates (kept in integers, so
no order of summation matters).  What a source is still short of or over, a
few rounds of single copies mend, each the largest that fits.

Edge cases: null, empty or blank text has size 0, takes 0 words; a null source
is a source of its own, last in order; a source without words has target 0;
repeated rows count each; a target of exactly ``max_copies`` times the source
takes every document that often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spacetime.llm.common import WORD, bounded_broadcast, documents, stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MAX_COPIES = 2
ITERATIONS = 60
TOLERANCE = 1e-7
MEND_ROUNDS = 6
#: Running sums are kept in units of one copy / UNIT.
UNIT = 1 << 30
#: Per-source tables up to this many rows are broadcast.
BROADCAST_ROWS = 50_000


def ranked(names: DataFrame, key: str) -> DataFrame:
    """``names`` with ``rank``, its position in code point order (null last),
    counted from 0.  Rows are dealt out by ranges, numbered inside a range, and
    each range starts after the rows of the ranges before it."""
    order = [F.col(key).isNull().asc(), F.col(key).asc()]
    dealt = stored(names.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a range
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return dealt.withColumn("inside", inside).join(F.broadcast(before), "part").withColumn("rank", F.col("before") + F.col("inside")).drop("part", "inside", "before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, n, target`` from ``source, source_size, n``.

    Shares are by weight; a source above its cap stops there and its excess is
    shared again, until none is above.  One aggregate over the sources a round.
    """
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    t = stored(ranked(sources, "source").withColumn("weight", F.get(pattern, (F.col("rank") % len(weights)).cast("int"))), "sources")
    cap = F.col("source_size") * float(max_copies)
    total = t.agg(F.sum("source_size")).first()[0] or 0
    wanted, share, capped = float(total) * budget, 0.0, -1
    while True:
        # Sources whose share reaches their cap stay there; the rest split what is left.
        full = F.col("weight") * F.lit(share) >= cap
        row = t.agg(
            F.sum(F.when(full, 1).otherwise(0)).alias("k"), F.sum(F.when(full, cap).otherwise(0.0)).alias("used"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("left")
        ).first()
        if not row["left"] or row["k"] == capped:
            break
        capped, share = row["k"], (wanted - row["used"]) / row["left"]
    share = share if row["left"] else float("inf")
    even = F.col("weight") * F.lit(share) if share != float("inf") else F.lit(float("inf"))
    return t.select("source", "source_size", "n", F.least(cap, even).alias("target"))


def tilted(lam: Column, x: Column, max_copies: int = MAX_COPIES) -> Column:
    """Rate of a document whose size is ``x`` times its source's mean."""
    return F.lit(float(max_copies)) / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), lam * x))))


def solve(histogram: DataFrame, target: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``source, source_size, mean, target, lam, all`` per source: the dual's
    solution.  ``all`` marks sources at their cap (every document that often)."""
    cap = F.col("source_size") * float(max_copies)
    state = stored(
        target.withColumn("mean", F.col("source_size") / F.greatest("n", F.lit(1)))
        .withColumn("all", F.col("target") >= cap * (1 - 1e-12))
        .withColumns({"lam": F.lit(0.0), "lo": F.lit(-1e9), "hi": F.lit(1e9), "off": F.lit(1.0)}),
        "dual",
    )
    for _ in range(ITERATIONS):
        live = state.where(~F.col("all") & (F.col("target") > 0) & (F.col("off") > TOLERANCE))
        x = F.col("size") / F.col("mean")
        q = tilted(F.col("lam"), x, max_copies)
        near = histogram.join(bounded_broadcast(live, BROADCAST_ROWS).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        sums = near.groupBy("source").agg(
            F.sum(F.col("docs") * F.col("size") * q).alias("got"),
            F.sum(F.col("docs") * F.col("size") * x * q * (1 - q / max_copies)).alias("slope"),
        )
        step = state.join(sums.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
        over = F.col("got") > F.col("target")
        lo = F.when(over, F.col("lo")).otherwise(F.greatest("lo", "lam"))
        hi = F.when(over, F.least("hi", "lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - (F.col("got") - F.col("target")) / F.col("slope")
        # outside the bracket (or on a flat piece): halve it, or double away from an open end
        middle = F.when(F.col("hi") >= 1e9, F.greatest(F.lit(1.0), 2 * F.col("lam"))).when(F.col("lo") <= -1e9, F.least(F.lit(-1.0), 2 * F.col("lam"))).otherwise((F.col("lo") + F.col("hi")) / 2)
        moved = F.col("got").isNotNull()
        state = stored(
            step.withColumns({"lo": F.when(moved, lo).otherwise(F.col("lo")), "hi": F.when(moved, hi).otherwise(F.col("hi"))})
            .withColumns(
                {
                    "off": F.when(moved, F.abs(F.col("got") - F.col("target")) / F.col("target")).otherwise(F.col("off")),
                    "lam": F.when(moved, F.when((F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi")), newton).otherwise(middle)).otherwise(F.col("lam")),
                }
            )
            .drop("got", "slope"),
            "dual",
        )
        if not state.where(~F.col("all") & (F.col("target") > 0) & (F.col("off") > TOLERANCE)).limit(1).count():
            break
    return state.select("source", "source_size", "mean", "target", "lam", "all")


def rounded(rated: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """``copies`` for rows ``row, source, size, units`` (rate in 1 / UNIT):
    steps of the running sum of ``units`` along a source by size.  The order is
    cut into ranges, so that a large source is many tasks; each range starts
    from the sum of the ranges before it."""
    order = [F.col("source").isNull().asc(), F.col("source").asc(), F.col("size").asc(), F.col("id").asc(), F.col("row").asc()]
    dealt = stored(rated.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-order")
    # a source of 2 ** 33 documents has more units than a long holds
    exact = F.col("units").cast("decimal(20,0)")
    sums = dealt.groupBy("source", "part").agg(F.sum(exact).cast("decimal(38,0)").alias("units"))
    parts = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("units").over(parts), F.lit(0)).cast("decimal(38,0)")).select(F.col("source").alias("s"), F.col("part").alias("p"), "before")
    here = Window.partitionBy("source", "part").orderBy("size", "id", "row").rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumn("run", F.sum(exact).over(here).cast("decimal(38,0)"))
    run = run.join(bounded_broadcast(stored(before, "mix-offsets"), BROADCAST_ROWS), F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    unit = F.lit(UNIT).cast("decimal(20,0)")
    end = (F.col("before") + F.col("run") + F.lit(UNIT // 2)).cast("decimal(38,0)")
    steps = F.call_function("div", end, unit) - F.call_function("div", (end - exact).cast("decimal(38,0)"), unit)
    return run.withColumn("copies", F.least(F.lit(max_copies), steps).cast("int")).drop("s", "p", "part", "run", "before")


def mended(copied: DataFrame, state: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Bring each source's words nearer its target: a round gives or takes one
    copy of the largest document not larger than what is missing or over."""
    for _ in range(MEND_ROUNDS):
        have = copied.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        gap = stored(have.withColumnRenamed("source", "s").join(state.select(F.col("source"), "target"), F.col("source").eqNullSafe(F.col("s"))).select("s", F.round(F.col("target") - F.col("taken")).cast("long").alias("gap")), "mix-gaps")
        near = copied.join(bounded_broadcast(gap, BROADCAST_ROWS), F.col("source").eqNullSafe(F.col("s")))
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & F.when(F.col("gap") > 0, F.col("copies") < max_copies).otherwise(F.col("copies") > 0)
        best = near.where(fits).groupBy("source").agg(F.max(F.struct("size", "id", "row")).alias("b"), F.first("gap").alias("gap"))
        change = stored(best.select(F.col("b.row").alias("r"), F.signum("gap").cast("int").alias("d")), "mix-change")
        if not change.limit(1).count():
            break
        changed = copied.join(bounded_broadcast(change, BROADCAST_ROWS), F.col("row") == F.col("r"), "left")
        copied = stored(changed.withColumn("copies", F.col("copies") + F.coalesce("d", F.lit(0))).drop("r", "d"), "mix")
    return copied


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_copies: int = MAX_COPIES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: ``id_col, size, source_size, target, taken, copies``.

    Running it again on the same rows gives the same mix: ties between rows
    are broken by id, and rows that agree in id, size and source may swap their
    copies, which leaves the result the same.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    sized = stored(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    histogram = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "size-histogram")
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.sum("docs").alias("n"))
    state = stored(solve(histogram, targets(sources, weights, budget, max_copies), max_copies), "mix-rates")
    known = bounded_broadcast(state, BROADCAST_ROWS).withColumnRenamed("source", "s")
    rate = F.when(F.col("all"), F.lit(float(max_copies))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(tilted(F.col("lam"), F.col("size") / F.col("mean"), max_copies))
    rated = sized.join(known, F.col("source").eqNullSafe(F.col("s"))).select("id", "row", "source", "size", F.when(F.col("size") > 0, F.round(rate * UNIT).cast("long")).otherwise(F.lit(0)).cast("long").alias("units"))
    copied = mended(stored(rounded(rated, max_copies), "mix"), state, max_copies)
    return copied.join(known, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("id").alias(id_col), "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies"
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))
