from pyspark.sql import functions as F

from driftline.config import IngestConfig
from driftline.functions.route import normalize_location, topic_to_table
from driftline.sources.records import slice_from_offsets, topic_filter


def test_route_and_locations(spark):
    df = spark.createDataFrame([("orders.v2-x", "oss://b-1.ap-southeast-5.oss-dls.aliyuncs.com/w/t"),
                                ("X", "oss://b-1/w/t"), ("y", "oss://B.r.oss-dls.aliyuncs.com/w")], "t string, p string")
    out = df.select(topic_to_table(F.col("t")).alias("t"), normalize_location("p").alias("p")).collect()
    assert [tuple(r) for r in out] == [("orders_v2_x", "oss://b-1/w/t"), ("X", "oss://b-1/w/t"),
                                       ("y", "oss://B.r.oss-dls.aliyuncs.com/w")]


def test_topic_pattern_is_anchored(spark, records):
    recs = records([("orders", 0, 0, "{}"), ("__offsets", 0, 0, "{}"), ("xorders_y", 0, 0, "{}")])
    assert sorted(r.topic for r in topic_filter(recs, "[^_].*").collect()) == ["orders", "xorders_y"]
    assert [r.topic for r in topic_filter(recs, "orders").collect()] == ["orders"]


def test_start_offsets(spark, records):
    recs = records([("a", p, o, "{}") for p in range(3) for o in range(5)])
    got = slice_from_offsets(recs, {"a": {"0": 3, "1": -2, "2": -1}}).collect()
    assert sorted((r.partition, r.offset) for r in got) == [(0, 3), (0, 4)] + [(1, o) for o in range(5)]
    assert slice_from_offsets(recs, "latest").count() == 0
    assert slice_from_offsets(recs, "Whatever").count() == 0
    assert slice_from_offsets(recs, "EARLIEST").count() == 15
    assert slice_from_offsets(recs, "earliest").count() == 15


def test_config_from_env():
    cfg = IngestConfig.from_env({"KAFKA_TOPICS_PATTERN": " ", "CATALOG_NAMESPACE": "lake",
                                 "WRITE_PARALLELISM": "3", "CHECKPOINT_INTERVAL_MS": "1000"})
    assert cfg.topic_pattern == "[^_].*" and cfg.namespace == "lake"
    assert cfg.write_parallelism == 3 and cfg.trigger_interval == "1000 milliseconds"
    assert IngestConfig.from_env({}).starting_offsets == "earliest"


def test_batch_sizing_settings_from_env():
    cfg = IngestConfig.from_env({"MIN_PARTITIONS": "64", "MAX_OFFSETS_PER_TRIGGER": "1000000"})
    assert cfg.min_partitions == 64 and cfg.max_offsets_per_trigger == 1_000_000
    blank = IngestConfig.from_env({"MIN_PARTITIONS": " ", "MAX_OFFSETS_PER_TRIGGER": ""})
    assert blank.min_partitions is None and blank.max_offsets_per_trigger == 20_000_000


def test_location_rule_needs_a_whole_match(spark):
    df = spark.createDataFrame([("oss://bk.r.oss-dls.aliyuncs.com/p\n",), ("oss://bk.r.oss-dls.aliyuncs.com/",),
                                ("oss://b.r.oss-dls.aliyuncs.com/p",), ("s3://bk.r.oss-dls.aliyuncs.com/p",)],
                               "p string")
    out = [r[0] for r in df.select(normalize_location("p")).collect()]
    # a newline never matches; the bucket needs two or more characters
    assert out == ["oss://bk.r.oss-dls.aliyuncs.com/p\n", "oss://bk/", "oss://b.r.oss-dls.aliyuncs.com/p",
                   "s3://bk.r.oss-dls.aliyuncs.com/p"]
