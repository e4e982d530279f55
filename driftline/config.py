"""Job settings (O6): one frozen object filled from the environment.

The variable names and defaults are the reference job's documented settings;
a blank value counts as unset.  Only the environment is consulted.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from driftline.functions.route import normalize_location_name

# Environment variable names, and the defaults that change
# results (topic pattern, start position, namespace, commit interval) as the
# reference job reads them; code defaults win where its docs disagree.
# Group id and catalog name are deployment labels with defaults of our own.
# WRITE_PARALLELISM unset means: keep the input parallelism (no coalesce).
ENV_DEFAULTS = {
    "KAFKA_BOOTSTRAP_SERVERS": "localhost:9092",
    "KAFKA_TOPICS_PATTERN": "[^_].*",
    "KAFKA_CONSUMER_GROUP": "driftline-ingest",
    "KAFKA_STARTING_OFFSET": "earliest",
    "CATALOG_NAME": "spark_catalog",
    "CATALOG_NAMESPACE": "raw",
    "WAREHOUSE_PATH": "",
    "WRITE_PARALLELISM": "",
    "CHECKPOINT_INTERVAL_MS": "30000",
    "MAX_OFFSETS_PER_TRIGGER": "20000000",
    "MIN_PARTITIONS": "",
    "MAX_COLUMNS": "2000",
    "TABLE_WRITE_THREADS": "8",
    "TABLE_STORE": "parquet",
}


def _env(environ, name: str) -> str:
    """A blank value counts as unset."""
    value = environ.get(name)
    if value is None or value.strip() == "":
        return ENV_DEFAULTS[name]
    return value


@dataclass(frozen=True)
class IngestConfig:
    bootstrap_servers: str = ENV_DEFAULTS["KAFKA_BOOTSTRAP_SERVERS"]
    topic_pattern: str = ENV_DEFAULTS["KAFKA_TOPICS_PATTERN"]
    group_id: str = ENV_DEFAULTS["KAFKA_CONSUMER_GROUP"]
    starting_offsets: str = ENV_DEFAULTS["KAFKA_STARTING_OFFSET"]
    catalog_name: str = ENV_DEFAULTS["CATALOG_NAME"]
    namespace: str = ENV_DEFAULTS["CATALOG_NAMESPACE"]
    warehouse: str = ""
    # The reference's writer parallelism.  ``None`` keeps the input
    # parallelism (no coalesce), which is what a large cluster wants.
    write_parallelism: int | None = None
    checkpoint_interval_ms: int = int(ENV_DEFAULTS["CHECKPOINT_INTERVAL_MS"])
    # Inferred columns of a table.  The first fields get them; the values of all
    # others land in one more column as JSON (no record is refused for its width).
    max_columns: int = int(ENV_DEFAULTS["MAX_COLUMNS"])
    # Jobs spent on finding the records that a table's write fails on; beyond that
    # the table fails as a whole (and the batch is tried again), nothing is dropped.
    max_poison_tries: int = 400
    # Threads used to write the tables of one micro-batch concurrently
    # (pair with spark.scheduler.mode=FAIR on a shared cluster).
    table_write_threads: int = 8
    # Parallelism floor for a batch: Kafka reads split offset ranges into at
    # least this many tasks (minPartitions); other inputs with fewer
    # partitions are spread round-robin.  None = leave the input as it is.
    min_partitions: int | None = None
    # Upper bound of records per micro-batch from Kafka: sizes the staged copy
    # of a batch (the first one would otherwise be the whole backlog).
    max_offsets_per_trigger: int | None = int(ENV_DEFAULTS["MAX_OFFSETS_PER_TRIGGER"])
    # Kind of table store: parquet tables of the session's catalog, or iceberg.
    table_store: str = ENV_DEFAULTS["TABLE_STORE"]
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_env(cls, environ=None, **overrides) -> "IngestConfig":
        environ = os.environ if environ is None else environ
        parallelism = environ.get("WRITE_PARALLELISM")
        cfg = cls(
            bootstrap_servers=_env(environ, "KAFKA_BOOTSTRAP_SERVERS"),
            topic_pattern=_env(environ, "KAFKA_TOPICS_PATTERN"),
            group_id=_env(environ, "KAFKA_CONSUMER_GROUP"),
            starting_offsets=_env(environ, "KAFKA_STARTING_OFFSET"),
            catalog_name=_env(environ, "CATALOG_NAME"),
            namespace=_env(environ, "CATALOG_NAMESPACE"),
            warehouse=normalize_location_name(_env(environ, "WAREHOUSE_PATH")),
            write_parallelism=int(parallelism) if parallelism and parallelism.strip() else None,
            checkpoint_interval_ms=int(_env(environ, "CHECKPOINT_INTERVAL_MS")),
            max_offsets_per_trigger=int(_env(environ, "MAX_OFFSETS_PER_TRIGGER") or 0) or None,
            min_partitions=int(_env(environ, "MIN_PARTITIONS") or 0) or None,
            max_columns=int(_env(environ, "MAX_COLUMNS")),
            table_write_threads=int(_env(environ, "TABLE_WRITE_THREADS")),
            table_store=_env(environ, "TABLE_STORE").strip().lower(),
        )
        return replace(cfg, **overrides) if overrides else cfg

    @property
    def trigger_interval(self) -> str:
        return f"{self.checkpoint_interval_ms} milliseconds"
