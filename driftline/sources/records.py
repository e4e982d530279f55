"""Record frames (S1-S5): the six columns of a change-log message.

The same frame comes from Kafka (``kafka_records``) or, for replay and tests,
from Parquet files holding those columns (``read_records`` /
``read_record_stream``).  Nothing is parsed here.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

RECORD_COLUMNS = [f.name for f in RECORD_SCHEMA.fields]


def record_frame(df: DataFrame) -> DataFrame:
    """Keep exactly the record columns, typed; headers and the rest are dropped."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields])


def topic_matches(pattern: str, topic: Column | None = None) -> Column:
    """The whole topic name must match the (Java) regular expression."""
    topic = F.col("topic") if topic is None else topic
    return topic.rlike(f"^(?:{pattern})$")


# Fixed value: the default topic pattern (every topic not starting with `_`).
DEFAULT_PATTERN = "[^_].*"


def topic_filter(df: DataFrame, pattern: str) -> DataFrame:
    """S1/S2 on an already-read frame (Kafka applies the pattern at
    subscription instead).  A regex is not pushed into a Parquet scan, so
    the default pattern also gets its pushable equivalent."""
    cond = topic_matches(pattern)
    if pattern == DEFAULT_PATTERN:
        cond = (~F.col("topic").startswith("_")) & (F.col("topic") != "") & cond
    return df.filter(cond)


EARLIEST, LATEST = -2, -1


def slice_from_offsets(df: DataFrame, starting: str | dict) -> DataFrame:
    """S3 on a replayed frame.

    ``starting`` is ``"earliest"``, ``"latest"`` (as is any other word,
    compared case-insensitively) or the Kafka source's JSON
    form ``{"topic": {"partition": offset}}`` where -2 means earliest and -1
    latest.  Partitions not named start at earliest.  ``latest`` on a replay
    means: nothing that is already there.  (``committed`` has no meaning for a
    replay; the streaming runner resumes from its checkpoint instead.)
    """
    if isinstance(starting, str):
        mode = starting.strip().lower()
        if mode == "earliest":
            return df
        if mode == "committed":
            raise ValueError("'committed' resumes from a checkpoint; use the streaming runner")
        if not mode.startswith("{"):
            return df.filter(F.lit(False))         # "latest", and any other word
        starting = json.loads(starting)
    # Plain AND/OR of comparisons, so a Parquet replay prunes row groups.
    listed, keep = None, None
    for topic, parts in starting.items():
        for part, off in parts.items():
            off = int(off)
            here = (F.col("topic") == F.lit(topic)) & (F.col("partition") == F.lit(int(part)))
            listed = here if listed is None else listed | here
            if off == LATEST:
                continue
            take = here if off == EARLIEST else here & (F.col("offset") >= F.lit(off))
            keep = take if keep is None else keep | take
    if listed is None:
        return df
    rest = ~listed
    return df.filter(rest if keep is None else keep | rest)


def read_records(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Batch replay of record files (Parquet with the record columns)."""
    df = record_frame(spark.read.schema(RECORD_SCHEMA).parquet(path))
    return topic_filter(df, pattern) if pattern else df


def read_record_stream(spark: SparkSession, path: str, pattern: str | None = None,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming replay: new record files in ``path`` become micro-batches."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = record_frame(reader.parquet(path))
    return topic_filter(df, pattern) if pattern else df


def kafka_records(spark: SparkSession, cfg, stream: bool = True) -> DataFrame:
    """Kafka subscription by pattern.  Needs the Kafka connector on
    the classpath (not present in this container).

    ``committed`` resumes from the query checkpoint; without one it raises,
    because Spark keeps no consumer-group offsets of its own."""
    mode = cfg.starting_offsets.strip().lower()
    reader = spark.readStream if stream else spark.read
    reader = (reader.format("kafka")
              .option("kafka.bootstrap.servers", cfg.bootstrap_servers)
              .option("subscribePattern", f"^(?:{cfg.topic_pattern})$")
              .option("kafka.group.id", cfg.group_id)
              .option("includeHeaders", "false"))
    if getattr(cfg, "min_partitions", None):
        reader = reader.option("minPartitions", str(cfg.min_partitions))
    if stream and getattr(cfg, "max_offsets_per_trigger", None):
        reader = reader.option("maxOffsetsPerTrigger", str(cfg.max_offsets_per_trigger))
    if mode in ("earliest", "latest"):
        reader = reader.option("startingOffsets", mode)
    elif mode == "committed":
        if not stream:
            raise ValueError("'committed' needs a streaming query with a checkpoint")
    else:
        reader = reader.option("startingOffsets", "latest")
    return record_frame(reader.load())
