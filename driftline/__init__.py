"""driftline: schema-inferring change-record ingestion on Spark.

Raw record frames (topic, partition, offset, key, value, timestamp) go in;
typed, append-only tables (one per topic) come out.  Every row-level step is
a DataFrame / Catalyst expression; the driver only sees one exemplar value per
newly discovered field.
"""

from driftline.config import IngestConfig
from driftline.session import build_session, apply_session_conf, shared_path

__all__ = ["IngestConfig", "build_session", "apply_session_conf", "shared_path"]
