from driftline.operators.admit import admit, body_variant


def outcome(spark, records, values, topic="t"):
    rows = [(topic, 0, i, v) for i, v in enumerate(values)]
    out = admit(records(rows)).orderBy("offset").select("disposition", "reason").collect()
    return [(r.disposition, r.reason) for r in out]


def test_faults_in_reference_order(spark, records):
    values = [None, b"", '{"a":1', "[1]", "5", "null", "  \t\n", "{'a':1}", '{"a":1} trailing',
              b'{"a":"A\xffB"}', '{"a":1,"a":2}', '{"payload":null,"schema":{}}', '{"a":NaN}',
              '{"a":01}', '{"a":"\u0001"}', '"text"', "true"]
    got = outcome(spark, records, values)
    assert got == [
        ("skipped", "empty"), ("skipped", "empty"), ("skipped", "unparsable"), ("skipped", "non_object"),
        ("skipped", "non_object"), ("skipped", "non_object"), ("skipped", "non_object"),
        ("skipped", "unparsable"), ("pending", None), ("pending", None), ("pending", None),
        ("pending", None), ("skipped", "unparsable"), ("skipped", "unparsable"), ("skipped", "unparsable"),
        ("skipped", "non_object"), ("skipped", "non_object"),
    ]


def test_delete_marker_text(spark, records):
    values = ['{"id":1,"__deleted":"true"}', '{"id":1,"__deleted":true}', '{"id":1,"__deleted":"TRUE"}',
              '{"id":1,"__deleted":1}', '{"id":1,"__deleted":"false"}',
              '{"schema":{},"payload":{"id":1,"__deleted":"true"}}',
              '{"schema":{},"payload":"{\\"__deleted\\":\\"true\\"}"}']
    got = outcome(spark, records, values)
    assert [g[1] for g in got] == ["deleted", "deleted", None, None, None, "deleted", None]


def test_envelope_only_when_payload_is_object(spark, records):
    from pyspark.sql import functions as F
    rows = [("t", 0, 0, '{"schema":{"x":1},"payload":{"id":"a","v":2}}'),
            ("t", 0, 1, '{"payload":null,"schema":{}}'),
            ("t", 0, 2, '{"payload":[1],"other":3}'),
            ("t", 0, 3, '{"payload":{"id":"b"}}')]
    out = admit(records(rows)).orderBy("offset").select("envelope", F.to_json(body_variant()).alias("b")).collect()
    assert [r.envelope for r in out] == [True, False, False, True]
    assert out[0].b == '{"id":"a","v":2}'
    assert out[3].b == '{"id":"b"}'


def test_table_routing(spark, records):
    rows = [("a.b-C", 0, 0, '{"x":1}')]
    assert admit(records(rows)).first().table == "a_b_C"


def test_repeated_payload_last_wins(spark, records):
    from driftline.plans.ingest import ingest
    res = ingest(records([("t", 0, 0, '{"payload":{"a":1},"payload":{"b":2,"c":"x"}}')]))
    assert [f.name for f in res.schemas["t"].fields] == ["b", "c"]
    assert tuple(res.rows("t").first()) == (2, "x")
