"""Extendible-hash directories as DataFrames.

A key's bits are a string of '0' and '1' addressed from the left.  A bucket is
a bit prefix; it is split on one more bit only while it is oversized and holds
more than one row, so a leaf's depth is the first depth at which its content
fits.  All sums are grouped aggregations over prefixes; the directory is a
DataFrame that grows with the number of buckets and never visits the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import stored

#: Bits taken from each of the two key columns (`hi`, then `lo`), both non-negative longs.
WORD_BITS = 60
#: Further bits that one round of splitting looks at.
STEP = 8


def key_bits(depth: int) -> Column:
    """The first ``depth`` bits of a row's key (columns ``hi`` and ``lo``) as text."""
    def top(col: str, n: int) -> Column:
        return F.lpad(F.bin(F.shiftright(F.col(col), WORD_BITS - n)), n, "0")

    if depth == 0:
        return F.lit("")
    if depth <= WORD_BITS:
        return top("hi", depth)
    return F.concat(top("hi", WORD_BITS), top("lo", depth - WORD_BITS))


def directory(rows: DataFrame, limit: int) -> DataFrame:
    """Leaves ``(bucket, depth, bytes, n)`` for ``rows (hi, lo, w)`` under ``limit``.

    One row heavier than the limit is a leaf of its own.  Rows whose 120 bits
    are all equal (never, when ``lo`` comes from a unique row number) stay in
    one leaf of depth 120.
    """
    total = rows.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    low, high = 0, (math.ceil(math.log2(total / limit)) if total > limit else 0) + STEP
    left, leaves = rows, None
    while True:
        high = min(high, 2 * WORD_BITS)
        cells = left.groupBy(key_bits(high).alias("p")).agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n"))
        nodes = stored(cells.select(F.explode(F.sequence(F.lit(low), F.lit(high))).alias("depth"), "p", "w", "n")
                       .select("depth", F.expr("substring(p, 1, depth)").alias("bucket"), "w", "n")
                       .groupBy("depth", "bucket").agg(F.sum("w").alias("bytes"), F.sum("n").alias("n")), "nodes")
        fits = (F.col("bytes") <= limit) | (F.col("n") <= 1) | (F.col("depth") == 2 * WORD_BITS)
        parents = nodes.filter(~fits).select((F.col("depth") + 1).alias("depth"), F.col("bucket").alias("parent"))
        inner = nodes.filter(fits & (F.col("depth") > low)).withColumn("parent", F.expr("substring(bucket, 1, depth - 1)"))
        found = inner.join(parents, ["depth", "parent"], "left_semi").select("bucket", "depth", "bytes", "n")
        found = found.unionByName(nodes.filter(fits & (F.col("depth") == low)).select("bucket", "depth", "bytes", "n"))
        leaves = found if leaves is None else leaves.unionByName(found)
        over = nodes.filter((F.col("depth") == high) & ~fits).select(F.col("bucket").alias("over"))
        if over.isEmpty():
            return stored(leaves, "directory")
        left = left.join(over, key_bits(high) == over["over"], "left_semi")
        low, high = high + 1, high + STEP


def assign(rows: DataFrame, leaves: DataFrame) -> DataFrame:
    """``rows`` with their leaf's columns: one equi-join for each depth range in use.

    A row meets a leaf on (depth, prefix); the depths that occur are a few
    dozen at most, so a row is matched against its prefix at each of them and
    exactly one matches.
    """
    depths = [r[0] for r in leaves.select("depth").distinct().orderBy("depth").collect()]   # at most 121 numbers
    if not depths or depths == [0]:             # one bucket holds everything
        only = leaves.collect()                 # its row, or none
        given = only[0].asDict() if only else {}
        return rows.select("*", *[F.lit(given.get(f.name, "" if f.name == "bucket" else 0)).cast(f.dataType).alias(f.name)
                                  for f in leaves.schema.fields])
    least = depths[0]
    if len(depths) == 1:
        return rows.withColumn("bucket", key_bits(least)).join(leaves, "bucket")
    # every leaf's rows share the shortest leaf's prefix length; deeper prefixes are tried in one join
    tries = F.array(*[key_bits(d) for d in depths])
    return (rows.withColumn("bucket", F.explode(tries)).join(leaves, "bucket"))
