"""Mixing sources to target weights by entropy balancing.

Every source gets a token target (weights, capped at twice its size).  Document
rates solve, per source, the bounded-entropy problem

    min  sum_d [ r/2 log(r/2) + (1 - r/2) log(1 - r/2) ]   with   sum_d size_d r_d = target

whose solution is the exponential tilt ``r_d = 2 / (1 + exp(-lam * size_d / mean))``.
The dual has one unknown ``lam`` per source; Newton steps on it (bracketed, so
they always converge) are grouped aggregations over (source, size) strata.
Sums are taken in whole numbers, so neither the order of rows nor a repeated
task changes a result.  Rates become copies by systematic rounding along each
source's strata in order of size: the error never accumulates, a source's words
miss the target by at most about one document, and a few rounds that move single
copies of ever smaller documents settle the rest.  Inside a stratum the extra
copies go to the documents with the smallest hash.

DataFrame functions only.  A stratum (hot source, one very common size) is cut
into salted parts that are ranked apart; their counts alone are summed along.

Defined cases: null text has size 0 and is taken 0 times in words; a null source is
one source, last in order; sources without words have target 0; repeated rows
are mixed as separate documents; an empty table gives no rows; other columns
are ignored by `mix_rows` and kept by `mix`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import SPACE_CLASS, stored, whole_text

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
#: Documents of one stratum that are ranked together.
PART_DOCS = 20_000
#: Fixed-point unit of the summed rates.
UNIT = 1_000_000
MAX_STEPS = 60
#: Rounds that settle what rounding left over.
SETTLE_ROUNDS = 8


def word_count(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(text, SPACE_CLASS + "+", " "))
    return F.when(spaced == "", F.lit(0)).otherwise(
        F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit(""))) + 1).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes (source, source_size)``.

    Capped proportional shares: with price p a source gets min(cap * size, p *
    weight).  Sources are sorted by the price at which they reach their cap;
    running sums give the price, so resharing "until none is above" is one
    window over the sources (one row each), not a loop.
    """
    # Spark compares strings by their UTF-8 bytes, which is code point order.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("pos") - 1) % len(weights) + 1).cast("int"))
    s = (sizes.withColumn("pos", F.row_number().over(order)).withColumn("weight", pick)
         .withColumn("top", (F.col("source_size") * cap).cast("long")))
    by_price = Window.orderBy((F.col("top") / F.col("weight")).asc(), F.col("pos")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = (s.withColumn("capped", F.coalesce(F.sum("top").over(by_price), F.lit(0)))
         .withColumn("used_w", F.coalesce(F.sum("weight").over(by_price), F.lit(0)))
         .withColumn("all_w", F.sum("weight").over(every))
         .withColumn("pool", F.sum("source_size").over(every) * F.lit(budget))
         .withColumn("price", (F.col("pool") - F.col("capped")) / (F.col("all_w") - F.col("used_w")))
         # the price if every source before this one is at its cap; the first source not at its cap sets it
         .withColumn("full", F.col("price") * F.col("weight") >= F.col("top"))
         .withColumn("final", F.max(F.when(~F.col("full"), F.col("price"))).over(every)))
    return s.select("source", "source_size", F.when(F.col("full"), F.col("top").cast("double"))
                    .otherwise(F.col("final") * F.col("weight")).alias("target"))


def rate(lam: Column, x: Column, cap: int = CAP) -> Column:
    return F.lit(float(cap)) / (F.exp(-F.greatest(F.least(lam * x, F.lit(500.0)), F.lit(-500.0))) + 1)


def _exact_sum(value: Column) -> Column:
    """A sum that does not depend on the order of its terms."""
    return F.sum(F.round(value * UNIT).cast("decimal(38,0)")).cast("double") / UNIT


def solve_tilts(strata: DataFrame, targets: DataFrame, cap: int = CAP, steps: int = MAX_STEPS) -> DataFrame:
    """Newton on each source's dual: ``(source, mean, lam, full)``.

    ``strata (source, size, n)``.  Every step reads the strata once; sources
    that are settled (within 1e-6 of the target, or at their cap) stay put.
    """
    facts = strata.filter("size > 0").groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("docs"))
    state = stored(
        facts.join(targets.select(F.col("source").alias("s"), "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .select("source", (F.col("words") / F.col("docs")).alias("mean"), "target",
                (F.col("target") >= F.col("words") * cap * (1 - 1e-12)).alias("full"), F.lit(0.0).alias("lam"),
                F.lit(-1e4).alias("lo"), F.lit(1e4).alias("hi"), F.lit(False).alias("done")), "tilts")
    for _ in range(steps):
        st = state.select(F.col("source").alias("s"), "mean", "target", "lam", "lo", "hi", "full", "done")
        x, r = F.col("size") / F.col("mean"), rate(F.col("lam"), F.col("size") / F.col("mean"), cap)
        sums = (strata.filter("size > 0").join(st, F.col("source").eqNullSafe(F.col("s")))
                .groupBy("source").agg(_exact_sum(F.col("n") * F.col("size") * r).alias("got"),
                                       _exact_sum(F.col("n") * F.col("size") * x * r * (1 - r / cap)).alias("slope"))
                .select(F.col("source").alias("q"), "got", "slope"))
        s = state.join(sums, F.col("source").eqNullSafe(F.col("q"))).drop("q")
        gap = F.col("target") - F.col("got")
        done = F.col("full") | F.col("done") | (F.abs(gap) <= F.greatest(F.col("target") * 1e-6, F.lit(0.5)))
        lo = F.when(gap > 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") + gap / F.greatest(F.col("slope"), F.lit(1e-9))
        step = F.when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        state = stored(s.select("source", "mean", "target", "full", F.when(done, F.col("lam")).otherwise(step).alias("lam"),
                                lo.alias("lo"), hi.alias("hi"), done.alias("done")), "tilts")
        if state.filter("not done").isEmpty():
            break
    return state


def stratum_copies(strata: DataFrame, tilts: DataFrame, cap: int = CAP) -> DataFrame:
    """``(source, size, n, copies)``: systematic rounding of n * rate along each
    source's strata, in order of size."""
    t = tilts.select(F.col("source").alias("s"), "mean", "lam", "full")
    r = F.when(F.col("full"), F.lit(float(cap))).otherwise(rate(F.col("lam"), F.col("size") / F.col("mean"), cap))
    s = (strata.filter("size > 0").join(t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
         .withColumn("share", F.least(F.round(F.col("n") * r * UNIT).cast("long"), F.col("n") * cap * UNIT)))
    run = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("upto", F.sum("share").over(run))

    def whole(v):
        return F.floor((v + UNIT // 2) / F.lit(UNIT)).cast("long")
    return s.select("source", "size", "n", (whole(F.col("upto")) - whole(F.col("upto") - F.col("share"))).alias("copies"))


def settle(plan: DataFrame, cap: int = CAP, rounds: int = SETTLE_ROUNDS) -> DataFrame:
    """Bring each source's words closer to its target after rounding.

    ``plan (s, z, n, copies, source_size, target)``.  A round moves, in every
    source, copies of its largest stratum that still fits into what is missing
    (or too much).  What is left after a round is smaller than that stratum's
    size, unless the stratum ran out of copies to move.
    """
    for _ in range(rounds):
        want = plan.groupBy("s").agg((F.first("target") - F.sum(F.col("copies") * F.col("z"))).alias("want"))
        want = want.select(F.col("s").alias("ws"), "want")
        slack = F.when(F.col("want") > 0, F.col("n") * cap - F.col("copies")).otherwise(F.col("copies"))
        open_ = (plan.filter("z > 0").join(want, F.col("s").eqNullSafe(F.col("ws")))
                 .withColumn("slack", slack).filter((F.col("slack") > 0) & (F.col("z") <= F.abs("want"))))
        move = F.least(F.floor(F.abs("want") / F.col("z")), F.col("slack")) * F.signum("want")
        pick = open_.groupBy(F.col("s").alias("ps")).agg(F.max("z").alias("pz"))
        moves = stored(open_.join(pick, F.col("s").eqNullSafe(F.col("ps")) & (F.col("z") == F.col("pz")))
                       .select("ps", "pz", move.cast("long").alias("move")), "mix-moves")
        if moves.isEmpty():
            break
        plan = stored(plan.join(moves, F.col("s").eqNullSafe(F.col("ps")) & (F.col("z") == F.col("pz")), "left")
                      .withColumn("copies", F.col("copies") + F.coalesce("move", F.lit(0)))
                      .drop("ps", "pz", "move"), "mix-plan")
    return plan


def mix_rows(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP,
             part_docs: int = PART_DOCS) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies, source, text_key``."""
    rows = stored(docs.select("doc_id", "source", whole_text().alias("t"))
                  .select("doc_id", "source", word_count(F.col("t")).alias("size"), F.xxhash64("t").alias("text_key")),
                  "mix-rows")
    strata = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "strata")
    sizes = strata.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = stored(source_targets(sizes, weights, budget, cap), "targets")
    tilts = solve_tilts(strata, targets, cap)
    plan = strata.select(F.col("source").alias("s"), F.col("size").alias("z"), "n").join(
        stratum_copies(strata, tilts, cap).select(F.col("source").alias("s2"), F.col("size").alias("z2"), "copies"),
        F.col("s").eqNullSafe(F.col("s2")) & (F.col("z") == F.col("z2")), "left").drop("s2", "z2")
    plan = stored(plan.join(targets.select(F.col("source").alias("s3"), "source_size", "target"),
                            F.col("s").eqNullSafe(F.col("s3"))).drop("s3")
                  .withColumn("copies", F.coalesce("copies", F.lit(0).cast("long"))), "mix-plan")
    plan = settle(plan, cap).withColumn("parts", F.ceil(F.col("n") / part_docs).cast("long"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    placed = (rows.join(plan, same).drop("s", "z")
              .withColumn("order", F.xxhash64("doc_id", "text_key"))
              .withColumn("part", F.pmod(F.col("order"), F.col("parts")).cast("int")))
    # Strata cut into several parts: each part's share of the extra copies comes from running counts.
    counts = placed.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"),
                                                        F.first("copies").alias("copies"))
    along = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    extra = F.col("copies") % F.col("n")

    def due(upto):
        return F.floor(upto * extra / F.col("n")).cast("long")
    shares = (counts.withColumn("upto", F.sum("m").over(along))
              .select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("k"),
                      (due(F.col("upto")) - due(F.col("upto") - F.col("m"))).alias("extra")))
    ranked = placed.withColumn("rank", F.row_number().over(
        Window.partitionBy("source", "size", "part").orderBy("order", "doc_id", "text_key")))
    out = ranked.join(shares, same & (F.col("part") == F.col("k")))
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(F.col("rank") <= F.col("extra"), 1).otherwise(0)
    return (out.withColumn("copies", copies.cast("int"))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
                    "copies", "source", "text_key"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (0, 1 or 2 times)."""
    p = "_m"                                # names of its own, whatever the columns of docs are
    while any(c.lower().startswith(p) for c in docs.columns):
        p = "_" + p
    taken = mix_rows(docs, **options).select(F.col("doc_id").alias(f"{p}_id"), F.col("text_key").alias(f"{p}_t"),
                                             F.col("source").alias(f"{p}_s"), F.col("copies").alias(f"{p}_n"))
    # Rows equal in id, source and text share one line of counts, which they take in turn.
    taken = taken.groupBy(f"{p}_id", f"{p}_t", f"{p}_s").agg(F.sum(f"{p}_n").alias(f"{p}_n"), F.count(F.lit(1)).alias(f"{p}_rows"))
    key = F.xxhash64(whole_text())
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(F.col(f"{p}_id")) & (key == F.col(f"{p}_t"))
                       & docs["source"].eqNullSafe(F.col(f"{p}_s")))
    single = joined.filter(f"{p}_rows = 1")
    times = F.col(f"{p}_n")
    if not taken.filter(f"{p}_rows > 1").isEmpty():
        turn = Window.partitionBy(f"{p}_id", f"{p}_t", f"{p}_s").orderBy(f"{p}_t")
        several = joined.filter(f"{p}_rows > 1").withColumn(f"{p}_turn", F.row_number().over(turn))
        each = F.floor(F.col(f"{p}_n") / F.col(f"{p}_rows")) + F.when(
            F.col(f"{p}_turn") <= F.col(f"{p}_n") % F.col(f"{p}_rows"), 1).otherwise(0)
        single = single.unionByName(several.withColumn(f"{p}_n", each).drop(f"{p}_turn"))
    return single.withColumn(f"{p}_copy", F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(1)).cast("int")))).filter(
        times > 0).select(*docs.columns)
