"""Work that must not grow faster than the input, seen in plans and counts of rows."""

from pyspark.sql import functions as F

from driftline.operators.infer import near
from driftline.operators.ledger import offset_ranges, outside
from driftline.plans.ingest import ingest
from driftline.plans.registry import ingest_line_arrays
from driftline.sources import fixtures as fx

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def filters(df):
    return [line for line in plan(df).splitlines() if "Filter" in line]


def test_records_are_derived_as_they_are_read(spark):
    """no copy of all records is shuffled and written before a query reads them."""
    for name, table in (("orders", "orders"), ("lines", "lineitem")):
        assert all(f.endswith(f"{SF_SMALL}/{table}.parquet") for f in fx.records(spark, SF_SMALL, name).inputFiles())
    files = fx.record_files(spark, SF_SMALL, "orders")
    assert files.exceptAll(fx.records(spark, SF_SMALL, "orders")).isEmpty() and files.count() == fx.records(spark, SF_SMALL, "orders").count()


def test_losses_are_worked_out_once(spark, records, tmp_path):
    """no test of the losses below the projection that makes them."""
    rows = [("t", 0, i, v) for i, v in enumerate(['{"n":1,"b":true}', '{"n":"x","b":3}', '{"n":1e30,"b":false}', '{"n":2}'])]
    res = ingest(records(rows), stage=str(tmp_path / "s"))
    assert {tuple(r) for r in res.losses("t").collect()} == {("t", "n", "wrong_kind", 1), ("t", "b", "wrong_kind", 1), ("t", "n", "overflow", 1)}
    assert not [f for f in filters(res.losses("t")) if "size(" in f]


def test_line_arrays_are_parsed_once(spark):
    """F7"""
    df = ingest_line_arrays(spark, SF_SMALL)
    assert not [f for f in filters(df) if "from_json" in f or "parse_json" in f]


def test_rejects_parse_a_record_once(spark, records, tmp_path):
    """F8: the filter on errors stays above the coercion; rejects are the same."""
    from driftline.plans.registry import DATED_SCHEMA
    values = ['{"id":"a","day":1}', '{"id":"b","day":"2024-1-1"}', '{"id":-0.0,"day":"2024-01-01"}', "[1]", '{"id":["x"],"at":"no"}']
    res = ingest(records([("dated", 0, i, v) for i, v in enumerate(values)]), known={"dated": DATED_SCHEMA}, stage=str(tmp_path / "s"))
    assert {(r.offset, r.reason, r.detail) for r in res.rejected().collect()} == {
        (1, "convert_error", "day"), (3, "non_object", None), (4, "convert_error", "at")}
    assert [r.id for r in res.rows("dated").orderBy("day").collect()] == ["a", "-0.0"]
    assert not [f for f in filters(res.rejected()) if "coalesce(" in f.lower()]


def test_records_meet_only_ranges_close_to_them(spark):
    """the pairs that the equality of the join makes, of a ledger full of gaps."""
    recs = spark.range(20_000).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    ranges = offset_ranges(recs.filter("offset % 10 != 3")).localCheckpoint()
    left = outside(recs, ranges)
    assert sorted(r.offset for r in left.collect()) == list(range(3, 20_000, 10))
    import driftline.operators.ledger as ledger
    assert ledger.NEAR <= 256 and "sequence" in plan(left)


def test_first_records_are_looked_up_near_their_offsets(spark):
    """a bound on offsets by topic that keeps every winner."""
    winners = spark.createDataFrame([("a", 3), ("a", 9), ("b", 100)], "topic string, offset long")
    rows = spark.createDataFrame([(t, o) for t in ("a", "b", "c") for o in (0, 3, 5, 9, 10, 100, 101)], "topic string, offset long")
    assert sorted(tuple(r) for r in rows.filter(near(winners)).collect()) == [("a", 3), ("a", 5), ("a", 9), ("b", 100)]
    many = spark.range(100).select(F.concat(F.lit("t"), "id").alias("topic"), F.col("id").alias("offset"))
    assert many.filter(near(many)).count() == 100
    assert not winners.filter(near(winners.limit(0))).count()


def test_folders_are_written_without_sorting_the_records(spark, tmp_path):
    """a write split into folders does not sort, and spill, what a task holds."""
    spark.sql(f"CREATE TABLE split_write (text STRING, topic STRING) USING parquet PARTITIONED BY (topic) LOCATION '{tmp_path}/split'")
    try:
        fx.records(spark, SF_SMALL, "orders").selectExpr("decode(value, 'UTF-8') AS text", "concat(topic, partition) AS topic").createOrReplaceTempView("split_rows")
        text = spark.sql("EXPLAIN INSERT OVERWRITE split_write SELECT * FROM split_rows").first()[0]
        assert "Sort" not in text and "InsertIntoHadoopFsRelationCommand" in text
    finally:
        spark.sql("DROP TABLE split_write")


def test_lines_are_dealt_before_they_are_gathered(spark, monkeypatch):
    """lists are gathered after the shuffle, from one part of the orders at a time."""
    monkeypatch.setattr(fx, "PARTS", 1)                 # as a large table: taken as it is read
    made = fx.records(spark, SF_SMALL, "lines")._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, line in enumerate(made) if "Exchange hashpartitioning" in line]
    assert len(at) == 1 and max(i for i, line in enumerate(made) if "ObjectHashAggregate" in line) < at[0]


def test_lines_of_a_part_do_not_grow_with_the_table(spark, monkeypatch):
    """more lines are dealt to more parts, whatever the number of shuffle partitions."""
    monkeypatch.setattr(fx, "LINES_IN_PART", 100)
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    made = fx.records(spark, SF_SMALL, "lines")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(l_orderkey" in plan and f", {-(-n // 100)}), REPARTITION_BY_NUM" in plan
    assert n > 100 * fx.LINE_PARTS and made.agg({"offset": "count"}).first()[0] == \
        spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey").distinct().count()
