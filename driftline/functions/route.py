"""Routing column functions: topic -> table (P4), location normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_to_table(topic: Column | str = "topic") -> Column:
    """`.` and `-` become `_`; case is kept.  This is the override point:
    pass any Column -> Column function as ``route`` to the ingest plan."""
    col = F.col(topic) if isinstance(topic, str) else topic
    return F.translate(col, ".-", "__")


def topic_to_table_name(topic: str) -> str:
    """Driver-side twin of ``topic_to_table`` for a literal topic name."""
    return topic.replace(".", "_").replace("-", "_")


# Fixed value: the object-store path rule.  A bucket addressed through its
# data-lake endpoint, oss://<bucket>.<region>.oss-dls.aliyuncs.com/<path>,
# is rewritten to oss://<bucket>/<path>; any other path is left alone.
DLS_LOCATION_PATTERN = r"^oss://([a-z0-9][a-z0-9-]+)\.(.+\.oss-dls\.aliyuncs\.com)/(.*)\z"


def normalize_location(path: Column | str) -> Column:
    """P6 as a column expression (usable on location columns and settings)."""
    col = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(col, DLS_LOCATION_PATTERN, "oss://$1/$3")


def normalize_location_name(path: str) -> str:
    """P6 for a setting (the same rule on one string)."""
    return re.sub(DLS_LOCATION_PATTERN.replace(r"\z", r"\Z"), r"oss://\1/\3", path)
