"""Sharding by extendible hashing.

Documents are dealt to shards by the leading bits of a hash of their id.  The
directory starts with one bucket; only a bucket whose texts exceed the byte
limit is split on one more bit, until every shard fits.  DataFrame functions
only; texts are read once for their byte lengths and only short rows (id, hash,
length) are shuffled.  ``write_shards`` then writes each row into its shard.

Defined cases: a null text has 0 bytes; a document longer than the limit gets a
shard of its own; rows with a null or repeated id share their first 60 bits and
are told apart by 60 further bits drawn from a row number, so a third of all
rows under one id still split; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import stored, whole_text
from driftline.llm.extendible import WORD_BITS, assign, directory

SHARD_BYTES = 16 * 1024 * 1024
#: Row numbers (a power of two) whose rows are ranked together.
RANK_BLOCK = 1 << 16


def id_hash(col) -> F.Column:
    """60 bits of the md5 of a value's text, as a non-negative long."""
    digits = F.substring(F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), 1, WORD_BITS // 4)
    return F.conv(digits, 16, 10).cast("long")


def shard_documents(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, shard, shard_depth, shard_bytes, shard_docs``."""
    rows = stored(docs.select("doc_id", F.octet_length(whole_text()).cast("long").alias("w"),
                              id_hash(F.col("doc_id")).alias("hi"),
                              F.monotonically_increasing_id().alias("row")), "shard-rows")
    rows = rows.withColumn("lo", id_hash(F.col("row")))
    leaves = directory(rows.select("hi", "lo", "w"), shard_bytes)
    return assign(rows, leaves).select("doc_id", F.col("w").alias("n_bytes"), F.col("bucket").alias("shard"),
                                       F.col("depth").alias("shard_depth"), F.col("bytes").alias("shard_bytes"),
                                       F.col("n").alias("shard_docs"))


def _ranked(df: DataFrame, key: list[str], row: str, rank: str) -> DataFrame:
    """``df`` with each row's ``rank`` (from 0) among the rows of its key.

    ``row`` is a stored row number.  Rows are ranked inside blocks of ``RANK_BLOCK``
    row numbers, and blocks by their counts, so that no task holds all rows of a key.
    """
    block = F.shiftright(F.col(row), RANK_BLOCK.bit_length() - 1)
    df = df.withColumn("_block", block)
    sizes = df.groupBy(*key, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(k).alias(f"_of{k}") for k in key], F.col("_block").alias("_of_block"),
                         F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = F.col("_block") == F.col("_of_block")
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_of{k}"))
    inside = F.row_number().over(Window.partitionBy(*key, "_block").orderBy(row)) - 1
    return (df.withColumn("_inside", inside).join(sizes, same).withColumn(rank, F.col("_before") + F.col("_inside"))
            .drop("_block", "_inside", "_before", "_of_block", *[f"_of{k}" for k in key]))


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> str:
    """Write every row of ``docs`` once, one folder per shard; returns the folders'
    column: ``shard``, behind as many ``_`` as keep it apart from the columns of ``docs``.

    ``placed`` is what ``shard_documents`` gave for ``docs``.  Rows of one id and
    byte length may stand for each other (a shard's bytes and rows stay the same),
    so the k-th such row of ``docs`` takes the k-th such place, whether the id is
    null, repeated or held by a third of all rows.
    """
    key, names = ["_id", "_bytes"], docs.columns
    folder = "shard"
    while folder in {n.lower() for n in names}:
        folder = "_" + folder
    spots = stored(placed.select(F.col("doc_id").alias("_id"), F.col("n_bytes").alias("_bytes"), "shard",
                                 F.monotonically_increasing_id().alias("_row")), "shard-places")
    # The caller's columns travel as one value under numbers of their own, so that no name meets one of these.
    whole = F.struct(*[docs[n].alias(f"c{i}") for i, n in enumerate(names)])
    rows = stored(docs.select(whole.alias("_whole"), docs["doc_id"].alias("_id"), F.octet_length(whole_text()).cast("long").alias("_bytes"),
                              F.monotonically_increasing_id().alias("_row")), "shard-docs")
    spots = _ranked(spots, key, "_row", "_rank").select(
        F.col("_id").alias("_p_id"), F.col("_bytes").alias("_p_bytes"), F.col("_rank").alias("_p_rank"), "shard")
    same = F.col("_id").eqNullSafe(F.col("_p_id")) & (F.col("_bytes") == F.col("_p_bytes")) & (F.col("_rank") == F.col("_p_rank"))
    (_ranked(rows, key, "_row", "_rank").join(spots, same)
     .select(*[F.col(f"_whole.c{i}").alias(n) for i, n in enumerate(names)], F.col("shard").alias(folder))
     .repartition(folder).write.partitionBy(folder).parquet(path))
    return folder
