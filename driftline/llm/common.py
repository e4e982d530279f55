"""Helpers shared by the training-data operators: shared scratch tables, text
columns, bounded training samples and connected components."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.session import checkpoint_root

#: White space of the contracts: space and 0x09-0x0D (Java and Python `regex` syntax agree).
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def whole_text(name: str = "text"):
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that the driver and all executors share."""
    return f"{checkpoint_root(spark)}/driftline-llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a
    lost executor costs a re-read instead of a recomputation.  Nothing is kept
    on any executor's own disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, by: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``id``: 0, 1, ... along ``order`` (a total one) within equal values of ``by``.

    Rows are range-partitioned along the order and numbered within their
    partition; the counts of the partitions before (one row per partition and
    value) are added.  No task holds more than a range."""
    spark = df.sparkSession
    keys = [F.col(c) for c in by]
    df = stored(df, name)                                           # the ranges are sampled from it
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(df.repartitionByRange(parts, *keys, *order).withColumn("_range", F.spark_partition_id()), name)
    counts = dealt.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range") if not by else Window.partitionBy(*by).orderBy("_range")
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    here = dealt.withColumn("_at", F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order)))
    return stored(here.join(counts, [*by, "_range"]).withColumn("id", F.col("_before") + F.col("_at") - 1).drop("_range", "_at", "_before"), name)


def fold_of(doc_id: str, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
                    per_class: int, max_chars: int) -> tuple[list[tuple[str, int]], float]:
    """A bounded, repeatable sample of labelled rows, brought to the driver, and
    what must be added to log odds learnt from it to undo its equal shares of
    the classes (from counts of all usable rows).

    Only rows outside the held-out fold; of each class the ``per_class`` rows
    with the smallest id hash, among texts of at most ``max_chars`` characters.
    The bound is ``2 * per_class * max_chars`` characters whatever the input
    holds.  Labels that are null or not 0/1, and unlabelled rows, are left out.
    """
    usable = (labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y"))
              .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & (fold_of("id", modulus) != held_out))
              .groupBy("id").agg(F.max("y").alias("y")))
    texts = (docs.select(F.col("doc_id").alias("id"), whole_text().alias("t"))
             .filter((fold_of("id", modulus) != held_out) & (F.length("t") <= max_chars)))
    # The smallest hashes are found on ids alone; texts are fetched for those few only.
    lengths = texts.select("id").distinct().join(usable, "id").withColumn("r", F.xxhash64("id"))
    there = {r["y"]: r["n"] for r in lengths.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}     # two rows
    picks = None
    for y in (0, 1):
        part = lengths.filter(F.col("y") == y).orderBy("r", "id").limit(per_class).select("id", "y")
        picks = part if picks is None else picks.unionByName(part)
    picks = picks.dropDuplicates(["id"])
    rows = texts.join(F.broadcast(picks), "id").groupBy("id", "y").agg(F.min("t").alias("t"))
    out = [(r["t"], r["y"]) for r in sorted(rows.collect(), key=lambda r: r["id"])]      # at most 2 * per_class rows
    taken = {y: sum(1 for _, v in out if v == y) for y in (0, 1)}
    shift = (math.log(there[1] / there[0]) - math.log(taken[1] / taken[0])) if taken[0] and taken[1] else 0.0
    return out, shift


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (a, b)``: returns ``(node, root)`` for every
    node of an edge, ``root`` the smallest node it reaches.

    Alternating large-star and small-star steps (Kiveris et al., 2014), until a
    round changes nothing.  Each step is a grouped minimum (pre-aggregated before
    its shuffle) and a join of the edges with it.  The minima are written first, so
    both sides of the join are plain shuffles: the edges of a node that a large
    component hangs on are dealt over several tasks by adaptive execution.
    """
    cur = stored(edges.filter(F.col("a") != F.col("b"))
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = stored(both.filter(F.col("b") > F.col("a")).join(low, "a")
                       .select(F.col("m").alias("a"), "b").filter(F.col("a") != F.col("b")).distinct(), "edges")
        # small star: every node with its smaller neighbours, all tied to the smallest of them
        least = stored(large.groupBy("b").agg(F.min("a").alias("m")), "least")
        small = large.join(least, "b").select(F.explode(F.array(
            F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
            F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("e")).select("e.a", "e.b")
        new = stored(small.filter(F.col("a") != F.col("b")).distinct(), "edges")
        same = new.join(cur, ["a", "b"], "left_anti").isEmpty() and cur.join(new, ["a", "b"], "left_anti").isEmpty()
        cur = new
        if same:
            break
    roots = cur.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return roots.unionByName(cur.select(F.col("a").alias("node"), F.col("a").alias("root"))
                             .distinct().join(roots.select("node"), "node", "left_anti"))


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that ``kept (doc_id, text_key)`` names, one for each of its rows.

    ``text_key`` is xxhash64 of the whole text, so rows without an id and rows
    that share an id are told apart.  Only keys that occur on several rows of
    ``docs`` need their texts grouped; that set is empty unless rows repeat.
    """
    key = F.xxhash64(whole_text(text_col))
    k = kept.select(F.col("doc_id").alias("_k_id"), F.col("text_key").alias("_k_t")).distinct()
    same = docs[id_col].eqNullSafe(k["_k_id"]) & (key == k["_k_t"])
    keyed = docs.select(F.col(id_col).alias("_k_id"), key.alias("_k_t"))
    repeated = keyed.groupBy("_k_id", "_k_t").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    out = docs.join(k, same, "left_semi")
    if repeated.isEmpty():
        return out
    again = docs[id_col].eqNullSafe(repeated["_k_id"]) & (key == repeated["_k_t"])
    once = out.join(repeated, again, "left_anti")
    many = out.join(repeated, again, "left_semi")
    return once.unionByName(many.dropDuplicates([id_col, text_col]))
