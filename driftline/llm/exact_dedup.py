"""Exact dedup over an extendible-hash index on shared files.

1. One scan writes a record per row to the shared folder: row number, id, code
   points, normalised text, its 64-bit hash (the first 60 bits are its address)
   and its SHA-256.
2. The directory is made of the addresses alone: a bucket with more than
   ``bucket_entries`` distinct entries is split on one more bit (directory doubling).
3. Every record goes to its bucket by its address, and groups form inside the
   bucket: records whose normalised texts are the same bytes become one entry,
   which knows its size and the row that stays.  Copies collapse before the
   shuffle, so a text held by a third of all rows arrives as one entry per input
   partition.  Entries that share an address are a chain; they differ in SHA-256.
4. The index file holds the entries in the order of their buckets; a bucket has one
   owner task.  Each record looks up its bucket, address and SHA-256 there.

DataFrame functions only.

Defined cases: null text counts as empty; texts that normalise to nothing form
one group; null ids rank after all others; of repeated rows (same id and text)
one is kept; an empty table gives no rows; other columns are ignored.  Two
different texts with the same hash and the same SHA-256 raise an error instead
of being merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import SPACE_CLASS, keep_rows, stored, whole_text
from driftline.llm.extendible import WORD_BITS, assign, directory

BUCKET_ENTRIES = 1 << 12


def normalised(text):
    return F.regexp_replace(text, SPACE_CLASS + "+", "")


def text_hash(text, hash_bits: int):
    """The leading ``hash_bits`` (at most 60) of xxhash64, as a 60-bit address."""
    h = F.shiftrightunsigned(F.xxhash64(text), 64 - WORD_BITS)
    spare = WORD_BITS - hash_bits
    return F.shiftleft(F.shiftright(h, spare), spare) if spare else h


def records(docs: DataFrame, hash_bits: int = WORD_BITS) -> DataFrame:
    """One stored record per row, with its address ``hi`` and, from the SHA-256, ``lo``."""
    rows = (docs.select("doc_id", whole_text().alias("t"))
            .select("doc_id", F.monotonically_increasing_id().alias("row"), F.length("t").alias("n_code"),
                    F.xxhash64("t").alias("text_key"), normalised(F.col("t")).alias("norm"))
            .select("*", text_hash(F.col("norm"), hash_bits).alias("hi"), F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"))
            .withColumn("lo", F.conv(F.substring(F.hex("sha"), 1, WORD_BITS // 4), 16, 10).cast("long")))
    return stored(rows, "dedup-records")


def build_index(rows: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, DataFrame]:
    """The directory's leaves, and the entries ``(bucket, hi, sha, group_size, best)``
    of ``records``, in the order of their buckets; one entry per distinct text."""
    places = rows.select("hi", "lo").distinct().withColumn("w", F.lit(1).cast("long"))
    leaves = directory(stored(places, "index-places"), bucket_entries).select("bucket", "depth")
    # The best row of an entry: most code points, then a non-null and smallest id, then the first row.
    rank = F.struct("n_code", F.col("doc_id").isNotNull().alias("has_id"),
                    F.coalesce(-F.col("doc_id"), F.lit(0)).alias("neg_id"), (-F.col("row")).alias("neg_row"))
    entries = (assign(rows, leaves).groupBy("bucket", "hi", "norm")
               .agg(F.count(F.lit(1)).alias("group_size"), F.max(rank).alias("best"), F.first("sha").alias("sha")))
    entries = stored(entries.drop("norm"), "index-entries")
    chains = entries.groupBy("bucket", "hi", "sha").agg(
        F.count(F.lit(1)).alias("texts"), F.max("group_size").alias("group_size"), F.max("best").alias("best"))
    sound = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.lit("two different texts share hash and SHA-256")).cast("long"))
    index = chains.withColumn("group_size", sound).drop("texts").repartition("bucket").sortWithinPartitions("bucket", "hi")
    return leaves, stored(index, "index")


def exact_groups(docs: DataFrame, hash_bits: int = WORD_BITS, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, text_key``."""
    rows = records(docs, hash_bits)
    leaves, index = build_index(rows, bucket_entries)
    # A text held by many rows: both sides are shuffled joins that adaptive execution splits.
    return (assign(rows.select("doc_id", "row", "text_key", "hi", "lo", "sha"), leaves).join(index, ["bucket", "hi", "sha"])
            .select("doc_id", F.when(F.col("best.has_id"), -F.col("best.neg_id")).alias("keep_id"), "group_size",
                    (F.col("row") == -F.col("best.neg_row")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "text_key"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without its exact copies (all columns, one row per distinct normalised text)."""
    return keep_rows(docs, exact_groups(docs).filter("kept").select("doc_id", "text_key"))
