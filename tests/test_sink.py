import json
import uuid

import pytest
from pyspark.sql import functions as F

from driftline.config import IngestConfig
from driftline.operators.coerce import SRC
from driftline.operators.infer import OVERFLOW
from driftline.operators.ledger import BLOCK, merged, offset_ranges, outside
from driftline.plans.sink import (
    LOSS_TABLE, REJECTS_TABLE, STATS_TABLE, IcebergTableStore, TableErrors, TableStore, TooManyTries, find_poison, ingest_into,
)
from driftline.session import shared_path


def new_store(spark):
    ns = f"t_{uuid.uuid4().hex[:8]}"
    return TableStore(spark, ns, shared_path(spark, "warehouse", ns))


def test_create_widen_append_and_replay(spark, records):
    store = new_store(spark)
    b0 = records([("orders", 0, 0, '{"id":"a","n":1}'), ("orders", 0, 1, '{"id":"b","n":2}')])
    b1 = records([("orders", 0, 2, '{"id":"c","n":3,"x":1.5}')])
    ingest_into(store, b0, "q-0")
    ingest_into(store, b1, "q-1")
    ingest_into(store, b1, "q-1")          # replay of the same batch
    assert [f.name for f in store.schema("orders").fields] == ["id", "n", "x"]
    rows = sorted(tuple(r) for r in store.read("orders").collect())
    assert rows == [("a", 1, None), ("b", 2, None), ("c", 3, 1.5)]
    assert [r.table for r in store.list_tables().collect()] == ["orders"]


def test_existing_table_keeps_its_column_order(spark, records):
    store = new_store(spark)
    store.ensure_namespace()
    spark.sql(f"CREATE TABLE {store.name('t')} (b STRING, day DATE, _ingest_batch STRING) "
              f"USING parquet PARTITIONED BY (_ingest_batch)")
    recs = records([("t", 0, 0, '{"a":1,"b":"x","day":"2024-01-02"}'), ("t", 0, 1, '{"day":"2024-1-2","a":2}')])
    res = ingest_into(store, recs, "q-0", batch_id=0)
    assert [f.name for f in store.schema("t").fields] == ["b", "day", "a"]
    rows = [tuple(r) for r in store.read("t").collect()]
    assert len(rows) == 1 and rows[0][0] == "x" and rows[0][2] == 1
    assert (res.written["t"].records, res.written["t"].errors) == (2, 1)
    rejects = [(r.offset, r.disposition, r.detail) for r in store.read(REJECTS_TABLE).collect()]
    assert rejects == [(1, "error", "day")]


def test_one_batch_many_tables(spark, records):
    store = new_store(spark)
    recs = records([("a", 0, 0, '{"x":1}'), ("b.c", 0, 0, '{"y":"s"}'), ("a", 1, 5, '{"x":2}')])
    ingest_into(store, recs, "q-0")
    counts = {t: store.read(t).count() for t in ["a", "b_c"]}
    assert counts == {"a": 2, "b_c": 1}
    assert store.read_limit("a", 1).count() == 1
    assert store.read("a").agg(F.sum("x")).first()[0] == 3


def test_awkward_field_names(spark, records):
    store = new_store(spark)
    recs = records([("odd", 0, 0, '{"a.b":1,"c d":"x","e`f":true,"Id":1,"id":2,"n":{"p.q":1.5,"r s":[1]}}'),
                    ("odd", 0, 1, '{"a.b":2,"g-h":"y"}')])
    ingest_into(store, recs, "q-0")
    assert [f.name for f in store.schema("odd").fields] == ["a.b", "c d", "e`f", "Id", "id", "n", "g-h"]
    rows = sorted((tuple(r) for r in store.read("odd").collect()), key=lambda r: r[0])
    assert rows[0][:5] == (1, "x", True, 1, 2) and rows[0][5] == (1.5, [1])
    assert rows[1][0] == 2 and rows[1][6] == "y"


def test_table_names_keep_their_text(spark, records):
    names = ["01", "1", "1e3", "0x10", "true", "20200101"]
    rows = [(t, i % 3, i, f'{{"id":{i}}}') for i, t in enumerate(names * 4)]
    store = new_store(spark)
    res = ingest_into(store, records(rows), "q-0")
    assert sorted(res.written) == sorted(names)
    for k, t in enumerate(names):
        assert sorted(r.id for r in store.read(t).collect()) == [k, k + 6, k + 12, k + 18]


def test_one_failing_table_does_not_stop_the_others(spark, records, monkeypatch):
    store = new_store(spark)
    rows = [("good", 0, 0, '{"a":1}'), ("bad", 0, 0, '{"a":2}'), ("fine", 0, 0, '{"a":3}')]
    append = TableStore.append

    def failing(self, table, *args, **kwargs):
        if table == "bad":
            raise OSError("disk")
        return append(self, table, *args, **kwargs)
    monkeypatch.setattr(TableStore, "append", failing)
    shared = TableStore.append_shared

    def failing_together(self, tables, *args, **kwargs):
        if "bad" in tables:
            raise OSError("disk")
        return shared(self, tables, *args, **kwargs)
    monkeypatch.setattr(TableStore, "append_shared", failing_together)
    with pytest.raises(TableErrors) as err:
        ingest_into(store, records(rows), "q-0", batch_id=0)
    assert list(err.value.errors) == ["bad"]
    assert store.read("good").count() == store.read("fine").count() == 1
    monkeypatch.undo()
    ingest_into(store, records(rows), "q-0", batch_id=0)                # the batch is tried again
    assert [store.read(t).count() for t in ("good", "bad", "fine")] == [1, 1, 1]


def test_a_wide_record_lands_with_the_others(spark, records):
    store = new_store(spark)
    wide = "{" + ",".join(f'"f{i}":{i}' for i in range(30)) + "}"
    rows = [("w", 0, 0, '{"f0":1}'), ("w", 0, 1, wide), ("w", 0, 2, '{"f0":2,"f1":3}'), ("w", 0, 3, "{")]
    cfg = IngestConfig(max_columns=10)
    res = ingest_into(store, records(rows), "q-0", cfg, batch_id=3)
    assert res.refused == {} and sorted(r.f0 for r in store.read("w").collect()) == [0, 1, 2]
    ingest_into(store, records([("w", 0, 9, '{"f0":9,"g":[1,{"h":null}]}')]), "q-1", cfg, batch_id=4)
    assert [f.name for f in store.schema("w").fields] == [*[f"f{i}" for i in range(10)], OVERFLOW]
    over = {r.f0: json.loads(r[OVERFLOW]) for r in store.read("w").collect() if r[OVERFLOW]}
    assert over == {0: {f"f{i}": i for i in range(10, 30)}, 9: {"g": [1, {"h": None}]}}
    got = sorted((r.offset, r.disposition, r.reason) for r in store.read(REJECTS_TABLE).collect())
    assert got == [(3, "skipped", "unparsable")]
    assert sorted(tuple(r) for r in store.read(STATS_TABLE).collect()) == [(3, 4, 3, 1, 0), (4, 1, 1, 0, 0)]


def test_refused_tables_are_reported(spark, records):
    store = new_store(spark)
    store.ensure_namespace()
    spark.sql(f"CREATE TABLE {store.name('other')} (m MAP<STRING, STRING>) USING parquet")
    spark.sql(f"CREATE TABLE {store.name('foreign')} (id STRING) USING parquet")
    rows = [(None, 0, 0, '{"a":1}'), ("ok", 0, 1, '{"a":1}'), ("foreign", 0, 2, '{"id":"x"}'),
            ("ok", 0, 3, '{"a":2,"_ingest_batch":"mine"}')]
    res = ingest_into(store, records(rows), "q-0", batch_id=7)
    assert res.refused == {"foreign": "unsupported_table"}
    assert [r.a for r in store.read("ok").collect()] == [1]
    got = sorted((r.offset, r.batch_id, r.topic, r.disposition, r.reason) for r in store.read(REJECTS_TABLE).collect())
    assert got == [(0, 7, None, "error", "no_table"), (2, 7, "foreign", "error", "unsupported_table"),
                   (3, 7, "ok", "skipped", "reserved_field")]
    assert tuple(store.read(STATS_TABLE).first()) == (7, 4, 1, 1, 2)
    assert sorted((r.topic or "", r.received, r.emitted, r.skipped, r.errors) for r in store.totals().collect()) == [
        ("", 1, 0, 0, 1), ("foreign", 1, 0, 0, 1), ("ok", 2, 1, 1, 0)]


def test_a_static_session_cannot_write(spark, records, monkeypatch):
    import driftline.plans.sink as sink
    store = new_store(spark)
    recs = records([("t", 0, 0, '{"a":1}')])
    ingest_into(store, recs, "q-0")
    plain = spark.newSession()
    plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    other = TableStore(plain, store.namespace)
    plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    again = plain.createDataFrame([(2,)], "a bigint")
    other.append("t", again, "q-1")                                     # makes the setting itself
    assert sorted(r.a for r in store.read("t").collect()) == [1, 2]
    monkeypatch.setattr(sink, "apply_session_conf", lambda s: s)
    plain.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    with pytest.raises(RuntimeError, match="dynamic"):
        other.append("t", again, "q-2")


def test_losses_are_counted(spark, records):
    store = new_store(spark)
    rows = [("l", 0, 0, '{"n":1,"b":true,"s":"x","a":[1],"o":{"k":1},"d":1.5}'),
            ("l", 0, 1, '{"n":1.5,"b":1,"s":{"k":1},"a":5,"o":[],"d":"x"}'),
            ("l", 0, 2, '{"n":99999999999999999999,"b":null,"s":7,"a":[],"o":{},"d":2}'),
            ("l", 0, 3, '{"n":-2.0,"s":"y"}'), ("l", 0, 4, '{"n":"7","d":3}')]
    ingest_into(store, records(rows), "q-0", batch_id=0)
    got = {(r.column, r.kind): r.records for r in store.read(LOSS_TABLE).collect()}
    assert got == {("n", "truncation"): 1, ("n", "overflow"): 1, ("n", "wrong_kind"): 1, ("b", "wrong_kind"): 1,
                   ("s", "wrong_kind"): 1, ("a", "wrong_kind"): 1, ("o", "wrong_kind"): 1, ("d", "wrong_kind"): 1}


def test_write_parallelism_bounds_the_files(spark, records):
    store = new_store(spark)
    recs = records([("p", 0, i, f'{{"a":{i}}}') for i in range(64)]).repartition(8)
    ingest_into(store, recs, "q-0", IngestConfig(write_parallelism=2))
    assert len(store.read("p").inputFiles()) <= 2 and store.read("p").count() == 64


def test_no_shuffle_before_the_write(spark, records):
    from driftline.plans.ingest import ingest
    res = ingest(records([("t", 0, i, f'{{"a":{i}}}') for i in range(8)]), stage=shared_path(spark, "stage", unique=True))
    plan = res.rows("t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "t" in plan


def test_temp_views_are_not_listed(spark, records):
    store = new_store(spark)
    spark.range(3).createOrReplaceTempView("region")
    ingest_into(store, records([("only", 0, 0, '{"a":1}')]), "q-0")
    assert store.table_names() == ["only"]
    assert [r.table for r in store.list_tables().collect()] == ["only"]


def test_later_batch_never_retypes(spark, records):
    store = new_store(spark)
    ingest_into(store, records([("t", 0, 0, '{"x":"a","n":null}')]), "q-0")
    ingest_into(store, records([("t", 0, 1, '{"x":5,"n":2.5,"m":true}')]), "q-1")
    assert [(f.name, f.dataType.simpleString()) for f in store.schema("t").fields] == [
        ("x", "string"), ("n", "string"), ("m", "boolean")]
    rows = sorted(tuple(r) for r in store.read("t").collect())
    assert rows == [("5", "2.5", True), ("a", None, None)]


def test_not_null_column_rejects_missing_value(spark, records):
    # Q13: a catalog that keeps NOT NULL (Hive, Iceberg) gives such a schema;
    # Spark's own Parquet tables report every column nullable.
    from pyspark.sql import types as T

    from driftline.plans.ingest import ingest
    known = {"nn": T.StructType([T.StructField("id", T.StringType(), False), T.StructField("v", T.LongType())])}
    res = ingest(records([("nn", 0, 0, '{"id":"a","v":1}'), ("nn", 0, 1, '{"v":2}')]), known=known)
    d = {r.offset: (r.disposition, r.detail) for r in res.dispositions().collect()}
    assert d == {0: ("emitted", None), 1: ("error", "id")}
    assert [tuple(r) for r in res.rows("nn").collect()] == [("a", 1)]


def jobs_of(spark, run):
    """Spark jobs that ``run`` starts."""
    tracker = spark.sparkContext._jsc.sc().statusTracker()
    last = lambda: max([-1, *tracker.getJobIdsForGroup(None)])       # noqa: E731
    spark.range(1).collect()
    before = last()
    run()
    spark.range(1).collect()
    return last() - before


def test_tables_with_the_same_columns_share_one_write(spark, records):
    def batch(n, first=0):
        return records([(f"t.{i}", 0, first + i, '{"id":%d,"v":"x%d"}' % (i, i)) for i in range(n)])
    few, many = new_store(spark), new_store(spark)
    base = jobs_of(spark, lambda: ingest_into(few, batch(2), "b0"))
    assert jobs_of(spark, lambda: ingest_into(many, batch(40), "b0")) <= base + 2
    for _ in range(2):                          # a replay replaces its own rows
        ingest_into(many, batch(40, 100), "b1")
    for i in (0, 17, 39):
        assert sorted(tuple(r) for r in many.read(f"t_{i}").collect()) == [(i, f"x{i}")] * 2
    ingest_into(many, records([("t.3", 0, 500, '{"id":3,"v":"alone"}')]), "b1")       # the same batch, now on its own
    assert sorted(tuple(r) for r in many.read("t_3").collect()) == [(3, "alone"), (3, "x3")]


def test_a_shared_write_keeps_odd_names_losses_and_errors_apart(spark, records):
    store = new_store(spark)
    rows = [(t, 0, i, v) for t in ("B", "x_1", "0") for i, v in enumerate(['{"n":1,"s":"a"}', '{"n":"x","s":"b"}', "[1]", '{"n":3}'])]
    res = ingest_into(store, records(rows), "b0", batch_id=0)
    for t in ("B", "x_1", "0"):
        assert sorted(r.n for r in store.read(t).collect()) == [0, 1, 3]
        assert (res.written[t].records, res.written[t].errors, res.written[t].maybe_lossy) == (3, 0, 1)
    assert {(r.table_name, r.column, r.kind, r.records) for r in store.read(LOSS_TABLE).collect()} == {
        (t, "n", "wrong_kind", 1) for t in ("B", "x_1", "0")}
    assert {(r.topic, r.received, r.emitted, r.skipped, r.errors) for r in store.totals().collect()} == {
        (t, 4, 3, 1, 0) for t in ("B", "x_1", "0")}


def checked_table(store, name="t"):
    store.ensure_namespace()
    store.spark.sql(f"CREATE TABLE {store.name(name)} (id BIGINT, code VARCHAR(4), _ingest_batch STRING) USING parquet PARTITIONED BY (_ingest_batch)")


def test_records_that_a_write_fails_on_are_isolated(spark, records):
    store = new_store(spark)
    checked_table(store)
    rows = [("t", i % 2, i, '{"id":%d,"code":"%s"}' % (i, "far too long" if i in (0, 5, 36) else "ok")) for i in range(40)]
    res = ingest_into(store, records(rows + [("u", 0, 0, '{"a":1}')]), "b0", batch_id=0)
    assert sorted(r.id for r in store.read("t").collect()) == [i for i in range(40) if i not in (0, 5, 36)]
    assert store.read("u").count() == 1
    assert {(r.offset, r.disposition, r.reason, r.detail) for r in store.read(REJECTS_TABLE).collect()} == {
        (i, "error", "write_error", "EXCEED_LIMIT_LENGTH") for i in (0, 5, 36)}
    assert (res.written["t"].records, res.written["t"].errors) == (40, 3)
    assert not [t for t in store.table_names() if t.startswith("_try_")]


def test_many_texts_that_are_too_long_need_no_search(spark, records):
    store = new_store(spark)
    store.ensure_namespace()
    store.spark.sql(f"CREATE TABLE {store.name('t')} (id BIGINT, code VARCHAR(4), o STRUCT<c: CHAR(3), l: ARRAY<VARCHAR(2)>>, "
                    f"_ingest_batch STRING) USING parquet PARTITIONED BY (_ingest_batch)")

    def value(i):           # trailing spaces are cut, not counted
        code = "far too long" if i % 3 == 0 else "four   " if i % 3 == 1 else "äöüß"
        return '{"id":%d,"code":"%s","o":{"c":"%s","l":["x","%s"]}}' % (i, code, "abcd" if i % 50 == 1 else "ab", "xyz" if i % 50 == 2 else "xy")
    bad = {i for i in range(300) if i % 3 == 0 or i % 50 in (1, 2)}
    rows = [("t", i % 2, i, value(i)) for i in range(300)]
    res = ingest_into(store, records(rows), "b0", IngestConfig(max_poison_tries=12), batch_id=0)
    assert sorted(r.id for r in store.read("t").collect()) == [i for i in range(300) if i not in bad]
    assert {(r.offset, r.reason, r.detail) for r in store.read(REJECTS_TABLE).collect()} == {
        (i, "write_error", "EXCEED_LIMIT_LENGTH") for i in bad}
    assert (res.written["t"].records, res.written["t"].errors) == (300, len(bad))


def test_a_table_that_fails_as_a_whole_is_not_taken_for_poison(spark, records):
    store = new_store(spark)
    checked_table(store)
    rows = [("t", 0, i, '{"id":%d,"code":"far too long"}' % i) for i in range(60)]
    with pytest.raises(TableErrors):
        ingest_into(store, records(rows + [("u", 0, 0, '{"a":1}')]), "b0", IngestConfig(max_poison_tries=12), batch_id=0)
    assert store.read("t").count() == 0 and store.read("u").count() == 1
    assert not store.exists(REJECTS_TABLE)              # nothing is dropped: the batch is tried again


def test_bisection_finds_every_record_with_few_tries(spark):
    bad, tries = {("a", 0, 3), ("a", 1, 1000), ("b", 0, 77), ("b", 0, 78)}, []
    every = spark.createDataFrame([((t, p, o),) for t, p, o in sorted(bad)], f"{SRC} struct<topic: string, partition: int, offset: long>")

    def works(condition):
        tries.append(1)
        return None if every.filter(condition).isEmpty() else "broken"
    boxes = [("a", 0, 0, 500), ("a", 1, 0, 5000), ("b", 0, 0, 400), ("c", 0, 9, 9)]
    assert find_poison(works, boxes, 400) == dict.fromkeys(bad, "broken")
    assert len(tries) <= 2 * 13 * len(bad)
    with pytest.raises(TooManyTries):
        find_poison(works, boxes, 10)


# -- offset ledger --------------------------------------------------------------

def test_ranges_merge_and_leave_out_what_is_in(spark):
    offsets = [0, 1, 2, 2, 5, 6, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK]
    recs = spark.createDataFrame([("t", p, o) for p in (0, None) for o in offsets], "topic string, partition int, offset long")
    ranges = merged(offset_ranges(recs))
    assert sorted((r.first, r.last) for r in ranges.filter("partition = 0").collect()) == [(0, 2), (5, 6), (BLOCK - 1, BLOCK + 1), (3 * BLOCK, 3 * BLOCK)]
    more = spark.createDataFrame([("t", p, o) for p in (0, None, 1) for o in [*range(8), 4, BLOCK, BLOCK + 2]], "topic string, partition int, offset long")
    left = sorted((-1 if r.partition is None else r.partition, r.offset) for r in outside(more, ranges).collect())
    assert left == [(p, o) for p in (-1, 0) for o in (3, 4, 7, BLOCK + 2)] + [(1, o) for o in [*range(8), BLOCK, BLOCK + 2]]


def test_an_unfinished_batch_is_removed_and_read_again(spark, records):
    store = new_store(spark)
    rows = records([("t", 0, i, '{"id":%d}' % i) for i in range(20)])
    ingest_into(store, rows.filter("offset < 8"), "r-0", batch_id=0, ledger=True)
    store.begin("r-1", 1)
    ingest_into(store, rows.filter("offset between 6 and 12"), "r-1")          # died before its commit
    assert store.read("t").count() == 15
    assert store.drop_unfinished() == ["r-1"] and store.read("t").count() == 8
    ingest_into(store, rows.unionByName(rows), "s-0", batch_id=0, ledger=True)
    assert sorted(r.id for r in store.read("t").collect()) == list(range(20))
    assert [tuple(r) for r in store.ledger().collect()] == [("t", 0, 0, 19)] and store.drop_unfinished() == []


# -- the adapter's statements ------------------------------------------------------

def test_adapter_makes_its_own_statements(spark, monkeypatch):
    said = []

    class Recorder:
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text):
            said.append(text)
            return spark.createDataFrame([], "x int")
    store = IcebergTableStore(spark, "ns", catalog="lake")
    store.spark = Recorder()
    written = []
    monkeypatch.setattr(store, "exists", lambda t: False)
    monkeypatch.setattr(store, "append", lambda t, rows, tag, parallelism=None: written.append((t, rows.columns, tag)))
    rows = spark.createDataFrame([(0, 1)], "batch_id bigint, received bigint")
    store.append_log("_ingest_stats", "batch_id bigint, received bigint", rows, "q-0")
    assert said == ["CREATE TABLE IF NOT EXISTS `lake`.`ns`.`_ingest_stats` (`batch_id` bigint, `received` bigint) USING iceberg"]
    assert written == [("_ingest_stats", ["batch_id", "received"], "q-0")] and not store.can_share("t")
