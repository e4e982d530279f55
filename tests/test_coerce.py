"""Unit matrix: JSON kind x column type, expected values written from the rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.coerce import coerce_value

# The JSON kinds of the matrix.
KINDS = ['7', '1.9', '1.0', '1.0E10', '"12"', '"x"', 'true', 'null', '{"a":1,"b":2}', '[1,2]']


def convert(spark, dtype, kinds=KINDS):
    df = spark.createDataFrame([(i, f'{{"v":{k}}}') for i, k in enumerate(kinds)], "i int, t string")
    v = F.try_variant_get(F.try_parse_json("t"), "$.v", "variant")
    val, err = coerce_value(v, dtype)
    cols = [val.alias("val")] + ([err.alias("err")] if err is not None else [])
    rows = df.select("i", *cols).orderBy("i").collect()
    return [r.val for r in rows], ([r.err for r in rows] if err is not None else None)


def test_boolean(spark):
    vals, _ = convert(spark, T.BooleanType())
    assert vals == [False, False, False, False, False, False, True, None, False, False]


def test_bigint(spark):
    vals, _ = convert(spark, T.LongType())
    assert vals == [7, 1, 1, 10_000_000_000, 0, 0, 0, None, 0, 0]


def test_int(spark):
    vals, _ = convert(spark, T.IntegerType())
    assert vals[:3] == [7, 1, 1] and vals[4:] == [0, 0, 0, None, 0, 0]


def test_double(spark):
    vals, _ = convert(spark, T.DoubleType())
    assert vals == [7.0, 1.9, 1.0, 1e10, 0.0, 0.0, 0.0, None, 0.0, 0.0]


def test_float(spark):
    vals, _ = convert(spark, T.FloatType())
    assert vals[0] == 7.0 and abs(vals[1] - 1.9) < 1e-6 and vals[4] == 0.0 and vals[7] is None


def test_string_prints_numbers_like_the_jvm(spark):
    vals, _ = convert(spark, T.StringType())
    assert vals == ["7", "1.9", "1.0", "1.0E10", "12", "x", "true", None, "", ""]


def test_binary(spark):
    vals, _ = convert(spark, T.BinaryType())
    assert [bytes(v) if v is not None else None for v in vals] == [
        b"7", b"1.9", b"1.0", b"1.0E10", b"12", b"x", b"true", None, b"", b""]


def test_struct(spark):
    st = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    vals, _ = convert(spark, st)
    assert vals[8] == (1, None)                       # absent member -> null
    assert all(v is None for i, v in enumerate(vals) if i != 8)


def test_array(spark):
    vals, _ = convert(spark, T.ArrayType(T.LongType()))
    assert vals == [[], [], [], [], [], [], [], None, [1, 2], [1, 2]]   # object -> its values


def test_nested_array_of_struct(spark):
    et = T.ArrayType(T.StructType([T.StructField("q", T.DoubleType()), T.StructField("s", T.StringType())]))
    vals, _ = convert(spark, et, ['[{"q":1,"s":2.5},{"q":"x","s":true},5,null]'])
    assert vals == [[(1.0, "2.5"), (0.0, "true"), None, None]]


def test_date(spark):
    kinds = ['19723', '"2024-01-01"', '"2024-1-1"', '"2024-02-30"', 'true', 'null', '"2024-01-01T00:00:00Z"']
    vals, errs = convert(spark, T.DateType(), kinds)
    assert vals == [dt.date(2024, 1, 1), dt.date(2024, 1, 1), None, None, None, None, None]
    assert errs == [False, False, True, True, True, False, True]


def test_timestamp(spark):
    kinds = ['1704067207179', '"2024-01-01T00:00:07.179575Z"', '"2024-01-01T00:00:07+00:00"',
             '"2024-01-01T00:00Z"', '"2024-01-01t00:00:07z"', 'null', '1.5']
    vals, errs = convert(spark, T.TimestampType(), kinds)
    utc = dt.timezone.utc
    want = dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    got = [v.replace(tzinfo=None) if v is not None else None for v in vals]
    assert got[0] == want and got[1] == want and got[4] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert got[2] is None and got[3] is None and got[5] is None
    assert got[6] == dt.datetime(1970, 1, 1, 0, 0, 0, 1000)
    assert errs == [False, False, True, True, False, False, False]
    del utc


def test_decimal_falls_back_to_text_cast(spark):
    vals, errs = convert(spark, T.DecimalType(10, 2), ['"12.5"', '3', '"abc"', 'null'])
    assert [str(v) if v is not None else None for v in vals] == ["12.50", "3.00", None, None]
    assert errs == [False, False, True, False]


def test_map_columns_are_refused(spark):
    with pytest.raises(TypeError):
        convert(spark, T.MapType(T.StringType(), T.StringType()))
