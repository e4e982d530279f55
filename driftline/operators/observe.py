"""Observability frames (O1-O5).  The reference only logs these; here they
are DataFrames, complete rather than sampled, computed with aggregations
that combine map-side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.admit import EMITTED, ERROR, SKIPPED


def counters(dispositions: DataFrame, by=("topic",)) -> DataFrame:
    """O1: received / emitted / skipped / errors (received = the other three)."""
    d = F.col("disposition")
    return dispositions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("received"),
        F.count(F.when(d == EMITTED, 1)).alias("emitted"),
        F.count(F.when(d == SKIPPED, 1)).alias("skipped"),
        F.count(F.when(d == ERROR, 1)).alias("errors"))


def batch_stats(dispositions: DataFrame, batch_id: int) -> DataFrame:
    """One stats row for a micro-batch."""
    return counters(dispositions, by=()).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "*")


def first_by_order(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` per group, without sorting rows: a
    hash min on the first order column per (group, rest), reduced to one winner
    per group and joined back on its coordinates."""
    first, rest = order[0], order[1:]
    mins = df.groupBy(*group, *rest).agg(F.min(first).alias(first))
    best = mins.groupBy(*group).agg(F.min(F.struct(first, *rest)).alias("_w")).select(
        *group, *[F.col(f"_w.{c}").alias(c) for c in order])
    return df.join(best, on=[*group, *order], how="left_semi")


def first_record_sample(admitted: DataFrame, max_chars: int = 500) -> DataFrame:
    """O2: the first non-empty record of each topic (by offset, then
    partition): offset, first byte in hex, value cut to 500 characters + '...'."""
    nonempty = admitted.filter(F.col("reason").isNull() | (F.col("reason") != "empty"))
    return sample_rows(first_by_order(nonempty, ["topic"], ["offset", "partition"]), max_chars)


def sample_rows(first: DataFrame, max_chars: int = 500) -> DataFrame:
    """What a sample shows of a record."""
    preview = F.when(F.length("text") > max_chars,
                     F.concat(F.substring("text", 1, max_chars), F.lit("..."))).otherwise(F.col("text"))
    return first.select("topic", "partition", "offset", "first_byte", preview.alias("preview"))


def reject_frame(dispositions_with_text: DataFrame, max_chars: int = 200) -> DataFrame:
    """Every skipped or failed record with its reason, the first byte
    (for parse errors), the failing column (convert errors) and a preview.
    Takes ``BatchResult.dispositions(with_text=True)``."""
    bad = dispositions_with_text.filter(F.col("disposition") != EMITTED)
    return bad.select(
        "topic", "partition", "offset", "disposition", "reason", "detail",
        F.when(F.col("reason") == "unparsable", F.col("first_byte")).alias("first_byte"),
        F.substring("text", 1, max_chars).alias("preview"))
