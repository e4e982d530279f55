"""Structured Streaming runner.

``readStream`` of record frames -> ``foreachBatch`` -> the batch ingest plan
into the table store.  Each micro-batch commits one append per table, tagged
``<query id>-<batch id>``; the query id survives restarts (it lives in the
checkpoint), so a batch replayed after a failure overwrites its own rows.
Per-batch counters, rejected records with their reasons, schema changes and
coercion losses go to the ``_ingest_*`` tables of the namespace.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from driftline.config import IngestConfig
from driftline.plans.sink import CHANGES_TABLE, LOSS_TABLE, REJECTS_TABLE, STATS_TABLE, TableStore, batch_counts, ingest_into

__all__ = ["CHANGES_TABLE", "LOSS_TABLE", "REJECTS_TABLE", "STATS_TABLE", "start_ingest"]

log = logging.getLogger(__name__)


def _read_text(spark, path: str) -> str:
    """A small text file through the file system of its path."""
    return "\n".join(r[0] for r in spark.read.text(path).collect())


def batch_tag_for(batch_df: DataFrame, batch_id: int, checkpoint: str | None = None) -> str:
    spark = batch_df.sparkSession
    qid = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not qid and checkpoint:
        qid = json.loads(_read_text(spark, checkpoint.rstrip("/") + "/metadata"))["id"]
    return f"{qid}-{batch_id}"


def _has_checkpoint(stream: DataFrame, checkpoint: str) -> bool:
    spark = stream.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint.rstrip("/") + "/metadata")
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path))


def start_ingest(stream: DataFrame, store: TableStore, checkpoint: str,
                 cfg: IngestConfig | None = None, query_name: str | None = "driftline-sink",
                 available_now: bool = False, record_stats: bool = True, ledger: bool = False) -> StreamingQuery:
    """Start the ingest query.  ``available_now`` drains what is there and
    stops (replays, tests); otherwise a processing-time trigger at the
    configured commit interval.  With ``ledger`` the offset ledger decides what is
    new: a start from the beginning with a new checkpoint takes only what is not in
    yet, after removing what a cut-off run left unfinished."""
    cfg = cfg or IngestConfig()
    if ledger:
        store.ensure_namespace()
        store.drop_unfinished()
    elif cfg.starting_offsets.strip().lower() == "committed" and not _has_checkpoint(stream, checkpoint):
        raise ValueError("start position 'committed' needs an existing checkpoint to resume from "
                         f"({checkpoint}); Spark keeps no consumer-group offsets")

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        tag = batch_tag_for(batch_df, batch_id, checkpoint)
        result = ingest_into(store, batch_df, tag, cfg, batch_id=batch_id if record_stats else None, ledger=ledger)
        if result.census:                           # file streams can yield empty batches
            log.info("batch %s: %s", batch_id, batch_counts(result, result.written))

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=cfg.trigger_interval)
    return writer.start()
