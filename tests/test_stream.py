import pytest

from driftline.plans.sink import TableStore
from driftline.session import shared_path
from driftline.sources.records import read_record_stream
from driftline.streaming.runner import STATS_TABLE, start_ingest


def test_stream_with_restart_equals_batch(spark, records):
    base = shared_path(spark, "stream-test", unique=True)
    src, ckpt = f"{base}/in", f"{base}/ckpt"
    store = TableStore(spark, "st_" + base.rsplit("-", 1)[-1], f"{base}/wh")
    chunks = [[(i, f'{{"id":"{i}","v":{i}}}') for i in range(0, 3)],
              [(i, f'{{"id":"{i}","v":{i},"w":"n{i}"}}') for i in range(3, 6)],
              [(6, None), (7, '{"id":"7","v":7}')]]
    for n, chunk in enumerate(chunks):
        records([("s.t", 0, off, val) for off, val in chunk]).coalesce(1).write.mode("append").parquet(src)
        if n >= 1:
            q = start_ingest(read_record_stream(spark, src, max_files_per_trigger=1), store, ckpt,
                             query_name=None, available_now=True)
            q.awaitTermination()
    rows = sorted(tuple(r) for r in store.read("s_t").collect())
    assert rows == [(str(i), i, None if i < 3 or i > 5 else f"n{i}") for i in [0, 1, 2, 3, 4, 5, 7]]
    stats = sorted(tuple(r) for r in store.read(STATS_TABLE).collect())
    assert stats == [(0, 3, 3, 0, 0), (1, 3, 3, 0, 0), (2, 2, 1, 1, 0)]


def test_batch_tags_carry_the_query_id(spark, records):
    import re
    base = shared_path(spark, "stream-tag", unique=True)
    src, ckpt = f"{base}/in", f"{base}/ckpt"
    store = TableStore(spark, "tag_" + base.rsplit("-", 1)[-1], f"{base}/wh")
    records([("x", 0, 0, '{"a":1}')]).write.parquet(src)
    start_ingest(read_record_stream(spark, src), store, ckpt, query_name=None,
                 available_now=True).awaitTermination()
    tags = {r[0] for r in spark.table(store.name("x")).select("_ingest_batch").collect()}
    assert len(tags) == 1 and re.fullmatch(r"[0-9a-f-]{36}-0", tags.pop())


def test_stream_through_a_plain_session(spark, records):
    """A batch's own session decides the overwrite mode; nobody prepared this one."""
    base = shared_path(spark, "stream-plain", unique=True)
    plain = spark.newSession()
    store = TableStore(plain, "pl_" + base.rsplit("-", 1)[-1], f"{base}/wh")
    plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    plain.conf.set("spark.sql.caseSensitive", "false")
    for i in range(2):
        records([("x", 0, i, f'{{"a":{i},"A":"{i}"}}')]).write.mode("append").parquet(f"{base}/in")
        start_ingest(read_record_stream(plain, f"{base}/in"), store, f"{base}/ckpt", query_name=None,
                     available_now=True).awaitTermination()
    assert sorted(tuple(r) for r in store.read("x").collect()) == [(0, "0"), (1, "1")]


def test_job_needs_a_place_for_its_progress(spark):
    from types import SimpleNamespace

    from driftline.__main__ import checkpoint_location, make_store
    from driftline.config import IngestConfig
    assert checkpoint_location(spark, {"CHECKPOINT_LOCATION": "/x/y"}) == "/x/y"
    assert checkpoint_location(spark, {}).endswith("/driftline/checkpoints/ingest")
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None),
                           sparkContext=SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda k, d: None)))
    with pytest.raises(SystemExit):
        checkpoint_location(bare, {"CHECKPOINT_LOCATION": " "})
    cfg = IngestConfig.from_env({"TABLE_STORE": "Iceberg", "CATALOG_NAME": "lake", "CATALOG_NAMESPACE": "raw",
                                 "WAREHOUSE_PATH": "oss://bk.r.oss-dls.aliyuncs.com/wh", "MAX_COLUMNS": "5"})
    store = make_store(spark, cfg)
    assert type(store).__name__ == "IcebergTableStore" and store.name("t") == "`lake`.`raw`.`t`"
    assert store.location == "oss://bk/wh" and cfg.max_columns == 5
    assert make_store(spark, IngestConfig()).name("t") == "`raw`.`t`"
    with pytest.raises(ValueError):
        make_store(spark, IngestConfig(table_store="other"))


def test_committed_needs_a_checkpoint(spark, records):
    from driftline.config import IngestConfig
    base = shared_path(spark, "stream-committed", unique=True)
    records([("z", 0, 0, '{"a":1}')]).write.parquet(f"{base}/in")
    with pytest.raises(ValueError):
        start_ingest(read_record_stream(spark, f"{base}/in"), TableStore(spark, "cm", f"{base}/wh"),
                     f"{base}/ckpt", IngestConfig(starting_offsets="committed"), query_name=None)
