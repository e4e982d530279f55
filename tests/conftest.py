import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])    # for Python workers

from pyspark.sql import SparkSession  # noqa: E402

from driftline.session import apply_session_conf  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
         .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_session_conf(s)
    yield s


@pytest.fixture
def records(spark):
    """Build a record frame from (topic, partition, offset, value) tuples;
    ``value`` is text, bytes or None."""
    from pyspark.sql import functions as F

    from driftline.sources.records import RECORD_SCHEMA

    def make(rows):
        data = []
        for topic, part, off, value in rows:
            if isinstance(value, str):
                value = value.encode("utf-8")
            data.append((topic, part, off, str(off).encode(), value, None))
        df = spark.createDataFrame(data, RECORD_SCHEMA)
        return df.withColumn("timestamp", F.timestamp_seconds(F.lit(1700000000) + F.col("offset")))
    return make
