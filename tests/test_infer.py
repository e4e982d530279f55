import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.config import IngestConfig
from driftline.operators.infer import NESTED_LEVELS, OVERFLOW, exemplar_type, type_of_text, value_type
from driftline.plans.ingest import ingest


def test_scalar_rules():
    assert exemplar_type("BIGINT", "7") == T.LongType()
    assert exemplar_type("DECIMAL(1,0)", "1.0") == T.DoubleType()
    assert exemplar_type("DECIMAL(23,0)", "12345678901234567890123") == T.LongType()
    assert exemplar_type("DOUBLE", "1.0E10") == T.DoubleType()
    assert exemplar_type("STRING", "12") == T.StringType()
    assert exemplar_type("BOOLEAN", "true") == T.BooleanType()
    assert exemplar_type("VOID", None) == T.StringType()


def test_container_rules_keep_order_and_first_element():
    t = exemplar_type("OBJECT<...>", '{"z":1,"a":[{"q":1.5,"r":null}],"e":[],"b":{"x":true},"z":"s"}')
    assert t == T.StructType([
        T.StructField("z", T.StringType()),                      # last value, first position
        T.StructField("a", T.ArrayType(T.StructType([T.StructField("q", T.DoubleType()),
                                                     T.StructField("r", T.StringType())]))),
        T.StructField("e", T.ArrayType(T.StringType())),
        T.StructField("b", T.StructType([T.StructField("x", T.BooleanType())])),
    ])
    assert exemplar_type("ARRAY<...>", '[1, "x", 2.5]') == T.ArrayType(T.LongType())
    assert value_type({}) is None


def schema_of(spark, records, values, topic="t"):
    res = ingest(records([(topic, 0, i, v) for i, v in enumerate(values)]))
    return res, res.schemas.get(topic.replace(".", "_").replace("-", "_"))


def test_first_seen_wins_and_appends_in_document_order(spark, records):
    res, sch = schema_of(spark, records, ['{"id":"1","b":null,"a":1}', '{"b":2.5,"c":true,"a":"x"}',
                                          '{"d":{"k":1},"id":5}'])
    assert [(f.name, f.dataType.simpleString()) for f in sch.fields] == [
        ("id", "string"), ("b", "string"), ("a", "bigint"), ("c", "boolean"), ("d", "struct<k:bigint>")]
    rows = res.rows("t").orderBy(F.col("id").asc_nulls_last()).collect()
    assert [tuple(r) for r in rows] == [
        ("1", None, 1, None, None), ("5", None, None, None, (1,)), (None, "2.5", 0, True, None)]


def test_case_sensitive_and_duplicate_keys(spark, records):
    res, sch = schema_of(spark, records, ['{"Id":1,"id":"x","v":1,"v":"last"}'])
    assert [f.name for f in sch.fields] == ["Id", "id", "v"]
    assert sch["v"].dataType == T.StringType()
    assert tuple(res.rows("t").first()) == (1, "x", "last")


def test_nested_fields_do_not_evolve(spark, records):
    res, sch = schema_of(spark, records, ['{"p":{"k":1}}', '{"p":{"k":2,"late":3}}'])
    assert sch["p"].dataType == T.StructType([T.StructField("k", T.LongType())])


def test_empty_object_pins_nothing_until_content(spark, records):
    res, sch = schema_of(spark, records, ['{"id":"1","s":{}}', '{"id":"2","s":{"a":1}}', '{"id":"3"}'])
    assert [f.name for f in sch.fields] == ["id", "s"]
    assert sch["s"].dataType == T.StructType([T.StructField("a", T.LongType())])


def test_topics_sharing_a_table_share_a_schema(spark, records):
    rows = [("a.b", 0, 0, '{"x":1}'), ("a-b", 0, 0, '{"y":"s"}'), ("a-b", 1, 0, '{"z":true}')]
    res = ingest(records(rows))
    # order (offset, topic, partition): "a-b" sorts before "a.b"
    assert [f.name for f in res.schemas["a_b"].fields] == ["y", "z", "x"]


def test_existing_schema_comes_first(spark, records):
    known = {"t": T.StructType([T.StructField("b", T.DoubleType()), T.StructField("a", T.StringType())])}
    res = ingest(records([("t", 0, 0, '{"a":5,"c":1,"b":"z"}')]), known=known)
    assert [f.name for f in res.schemas["t"].fields] == ["b", "a", "c"]
    assert tuple(res.rows("t").first()) == (0.0, "5", 1)
    assert res.new_fields("t") == [T.StructField("c", T.LongType(), True)]


def test_dispositions_add_up(spark, records):
    rows = [("t", 0, i, v) for i, v in enumerate(['{"a":1}', None, '[1]', '{"a":2,"__deleted":"true"}'])]
    res = ingest(records(rows))
    d = {r.offset: (r.disposition, r.reason) for r in res.dispositions().collect()}
    assert d == {0: ("emitted", None), 1: ("skipped", "empty"), 2: ("skipped", "non_object"),
                 3: ("skipped", "deleted")}


def test_nested_empty_objects_pin_nothing(spark, records):
    values = ['{"a":{"b":{}},"x":{},"s":"{}","l":[{}],"id":0}', '{"a":{"b":{"c":5}},"x":{"y":{"z":{}}},"id":1}',
              '{"a":{"b":{"c":6}},"x":{"q\\"}{":{"w":[]}},"id":2}']
    res, sch = schema_of(spark, records, values)
    assert [(f.name, f.dataType.simpleString()) for f in sch.fields] == [
        ("s", "string"), ("l", "array<string>"), ("id", "bigint"), ("a", "struct<b:struct<c:bigint>>"),
        ("x", "struct<q\"}{:struct<w:array<string>>>")]
    assert sorted((r["id"], r["a"].b.c if r["a"].b else None) for r in res.rows("t").collect()) == [(0, None), (1, 5), (2, 6)]


def test_fields_beyond_the_width_land_as_json(spark, records):
    wide = "{" + ",".join(f'"f{i}":{i}' for i in range(30)) + "}"
    res = ingest(records([("w", 0, 0, wide), ("t", 0, 0, '{"a":1}')]), cfg=IngestConfig(max_columns=10))
    assert [f.name for f in res.schemas["w"].fields] == [f"f{i}" for i in range(10)] + [OVERFLOW]
    assert [f.name for f in res.schemas["t"].fields] == ["a"]
    row = res.rows("w").first()
    assert row[:10] == tuple(range(10)) and json.loads(row[10]) == {f"f{i}": i for i in range(10, 30)}
    assert {r.disposition for r in res.dispositions().collect()} == {"emitted"}


def test_width_is_the_same_however_batches_are_cut(spark, records):
    def doc(*fields):
        return "{" + ",".join(f'"f{i}":{{"v":"é{i}"}}' for i in fields) + ',"h":{"e":{}}}'
    rows = [("w", 0, 0, doc(0, 1)), ("w", 0, 1, doc(*range(3))), ("w", 0, 2, doc(0)), ("w", 1, 2, doc(*range(7, 2, -1))),
            ("w", 0, 4, doc(*range(10, 15))), ("w", 0, 5, doc(*range(25))), ("t", 0, 8, '{"a":1}')]
    cfg, results = IngestConfig(max_columns=6), []
    for size in (7, 3, 1):
        known, got = {}, []
        for at in range(0, len(rows), size):
            res = ingest(records(rows[at:at + size]), known=known, cfg=cfg)
            known = known | res.schemas
            if "w" in res.schemas:
                for r in res.rows("w").collect():
                    values = {k: v["v"] for k, v in r.asDict(True).items() if k != OVERFLOW and v is not None}
                    values |= {k: v["v"] for k, v in json.loads(r.asDict().get(OVERFLOW) or "{}").items()}
                    got.append(sorted(values.items()))
        results.append(([f.name for f in known["w"].fields], sorted(got)))
    assert results[0][0] == ["f0", "f1", "f2", "f7", "f6", "f5", OVERFLOW]         # first record, then place in it
    assert results[0] == results[1] == results[2]
    assert sorted(len(v) for v in results[0][1]) == [1, 2, 3, 5, 5, 25]


def test_a_full_table_that_exists_takes_no_more_columns(spark, records):
    known = {"t": T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])}
    res = ingest(records([("t", 0, 0, '{"a":1,"c":true,"b":"x","d":{"e":[1.5]}}')]), known=known, cfg=IngestConfig(max_columns=2))
    assert [f.name for f in res.schemas["t"].fields] == ["a", "b", OVERFLOW]
    assert tuple(res.rows("t").first()) == (1, "x", '{"c":true,"d":{"e":[1.5]}}')


def deep(n, end='"x"'):
    return '{"id":%d,"v":' % n + '{"a":' * n + end + "}" * n + "}"


def test_types_end_at_the_last_level(spark, records):
    res = ingest(records([("d", 0, 0, deep(40)), ("d", 0, 1, deep(900)), ("d", 0, 2, deep(40).replace('"id":40', '"id":"wrong"')),
                          ("d", 0, 3, '{"id":3,"v":5}'), ("d", 0, 4, deep(16, "[1,2]"))]))
    path = "v" + ".a" * NESTED_LEVELS
    assert {r.id: r.t for r in res.rows("d").select("id", F.col(path).alias("t")).collect()} == {
        n: '{"a":' * (m - NESTED_LEVELS) + end + "}" * (m - NESTED_LEVELS)
        for n, m, end in ((40, 40, '"x"'), (900, 900, '"x"'), (0, 40, '"x"'), (16, 16, "[1,2]"))} | {3: None}
    assert [(r.disposition, r.offset) for r in res.dispositions().orderBy("offset").collect()] == [("emitted", i) for i in range(5)]


def test_type_of_text_without_recursion():
    assert type_of_text("[" * 5000 + "]" * 5000, 2) == T.ArrayType(T.ArrayType(T.StringType()))
    assert type_of_text('{"a":' * 5000 + "{}" + "}" * 5000) is None
    assert type_of_text('{"a":{"b":{"c":{}}},"k":{"b":{"c":{"d":"}"}}}}', 2) == T.StructType([
        T.StructField("k", T.StructType([T.StructField("b", T.StringType())]))])
    assert type_of_text('[{"a":{}}, {"a":1}]') == T.ArrayType(T.StringType())
    assert type_of_text('{"a\\"}{":[[], 1], "b": -0, "c":1e5, "d":null,"b":1.0}') == T.StructType([
        T.StructField('a"}{', T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("b", T.DoubleType()),
        T.StructField("c", T.DoubleType()), T.StructField("d", T.StringType())])


def test_empty_object_beside_long_texts(spark, records):
    long = '{"a":{},"b":{"text":"%s"},"c":{"x":{"y":"%s"}}}' % ("t\\n" * 300_000, "{" * 500_000)
    res, sch = schema_of(spark, records, [long, '{"a":{"k":1}}'])
    assert [f.name for f in sch.fields] == ["b", "c", "a"]
    assert sorted(len(r.b.text) if r.b else 0 for r in res.rows("t").collect()) == [0, 600_000]


def test_a_record_without_a_table_is_an_error_of_its_own(spark, records):
    res = ingest(records([(None, 0, 0, '{"a":1}'), ("", 0, 1, '{"a":1}'), ("t", 0, 2, '{"a":2}'), (None, 0, 3, "[]")]))
    assert {r.offset: (r.disposition, r.reason) for r in res.dispositions().collect()} == {
        0: ("error", "no_table"), 1: ("error", "no_table"), 2: ("emitted", None), 3: ("skipped", "non_object")}


def test_large_values_pin_types_on_the_executors(spark, records):
    big = '{"doc":{"text":"' + "x" * 500_000 + '"}}'
    res = ingest(records([("t", 0, 0, big)]))
    assert res.rows("t").first()["doc"]["text"] == "x" * 500_000


def test_known_names_are_not_new(spark, records):
    rows = [("t", 0, 0, '{"a":1,"b":"x"}'), ("t", 1, 0, '{"c":true,"a":2}'), ("u", 0, 3, '{"z":1.5}')]
    known = {"t": T.StructType([T.StructField("a", T.LongType()), T.StructField("zz", T.StringType())])}
    got = ingest(records(rows), known=known)
    assert [f.name for f in got.schemas["t"].fields] == ["a", "zz", "b", "c"]
    assert sorted(got.census) == [("t", "t", None, 2), ("u", "u", None, 1)]
