"""The ingest job: ``spark-submit -m driftline`` (or ``python -m driftline``).

Settings come from the environment (``IngestConfig.from_env``).  Records are
read from Kafka by topic pattern, or replayed from a folder of record files
when ``RECORDS_PATH`` is set.  The checkpoint lives at ``CHECKPOINT_LOCATION``
or under the session's ``spark.checkpoint.dir``; the job refuses to start without
either.  ``TABLE_STORE`` is ``parquet`` or ``iceberg``, ``CATALOG_NAME`` the catalog.
``RUN_ONCE=1`` drains what is available and stops.
"""

from __future__ import annotations

import os

from driftline.config import IngestConfig
from driftline.plans.sink import IcebergTableStore, TableStore
from driftline.session import build_session, shared_path
from driftline.sources.records import kafka_records, read_record_stream
from driftline.streaming.runner import start_ingest


STORES = {"parquet": TableStore, "iceberg": IcebergTableStore}


def make_store(spark, cfg: IngestConfig) -> TableStore:
    if cfg.table_store not in STORES:
        raise ValueError(f"TABLE_STORE must be one of {sorted(STORES)}, not {cfg.table_store!r}")
    return STORES[cfg.table_store](spark, cfg.namespace, location=cfg.warehouse or None, catalog=cfg.catalog_name)


def checkpoint_location(spark, environ=None) -> str:
    """Where the job's progress lives.  It must outlive the process: without it
    every start would read everything again."""
    environ = os.environ if environ is None else environ
    named = environ.get("CHECKPOINT_LOCATION", "").strip()
    if named:
        return named
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)):
        raise SystemExit("set CHECKPOINT_LOCATION or spark.checkpoint.dir to a folder that outlives this job")
    return shared_path(spark, "checkpoints", "ingest")


def main() -> None:
    cfg = IngestConfig.from_env()
    spark = build_session(app_name="driftline-ingest")
    checkpoint = checkpoint_location(spark)
    path = os.environ.get("RECORDS_PATH", "").strip()
    stream = read_record_stream(spark, path, cfg.topic_pattern) if path else kafka_records(spark, cfg)
    once = os.environ.get("RUN_ONCE", "").strip() in ("1", "true", "yes")
    query = start_ingest(stream, make_store(spark, cfg), checkpoint, cfg, query_name="driftline-ingest", available_now=once)
    query.awaitTermination()


if __name__ == "__main__":
    main()
