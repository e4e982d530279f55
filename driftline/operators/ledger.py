"""Offset ledger (S3/S4): which records are in, as ranges of offsets.

Every batch leaves the ranges of offsets it holds per topic and partition.  A run
that lost its streaming checkpoint, or a replay of record files, takes only what
no committed batch held, whatever gaps and overlaps there are.

Offsets are looked at in blocks of ``BLOCK``: neither a busy partition's offsets
nor its ranges meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of one block.
BLOCK = 1 << 16
#: Offsets of a block in which records meet ranges: a record is compared with those of its own block.
NEAR = 1 << 7
RANGES = ["topic", "partition", "first", "last"]


def _block(col: str):
    return F.floor(F.col(col) / BLOCK)


def offset_ranges(records: DataFrame) -> DataFrame:
    """``(topic, partition, first, last)``: the unbroken ranges of ``records``' offsets in each block."""
    offsets = records.select("topic", "partition", "offset").distinct().withColumn("block", _block("offset"))
    here = Window.partitionBy("topic", "partition", "block")
    run = F.col("offset") - F.row_number().over(here.orderBy("offset"))        # the same along a range
    return (offsets.withColumn("run", run).groupBy("topic", "partition", "block", "run")
            .agg(F.min("offset").alias("first"), F.max("offset").alias("last")).select(*RANGES))


def merged(ranges: DataFrame) -> DataFrame:
    """Ranges joined where they touch or overlap (one row per range and block at most come in)."""
    order = Window.partitionBy("topic", "partition").orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    groups = ranges.select(*RANGES).withColumn("new", new).withColumn("k", F.sum("new").over(order))
    return groups.groupBy("topic", "partition", "k").agg(F.min("first").alias("first"), F.max("last").alias("last")).select(*RANGES)


def outside(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """``records`` whose offsets lie in none of ``ranges``, each (topic, partition, offset) once."""
    blocks = F.explode(F.sequence(F.floor(F.col("first") / NEAR), F.floor(F.col("last") / NEAR)))
    known = ranges.select(F.col("topic").alias("l_topic"), F.col("partition").alias("l_partition"), "first", "last",
                          blocks.alias("l_block"))
    once = records.dropDuplicates(["topic", "partition", "offset"])
    same = (once["topic"].eqNullSafe(known["l_topic"]) & once["partition"].eqNullSafe(known["l_partition"])
            & (F.floor(once["offset"] / NEAR) == known["l_block"]) & once["offset"].between(known["first"], known["last"]))
    return once.join(known, same, "left_anti")
