"""The typed fast path must equal the exact VARIANT path on any input."""

import json
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.admit import admit
from driftline.operators.coerce import ERR, coerce_rows

SCHEMA = T.StructType([
    T.StructField("b", T.BooleanType()), T.StructField("i", T.IntegerType()),
    T.StructField("l", T.LongType()), T.StructField("d", T.DoubleType()),
    T.StructField("s", T.StringType()), T.StructField("bin", T.BinaryType()),
    T.StructField("st", T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.StringType())])),
    T.StructField("al", T.ArrayType(T.LongType())),
    T.StructField("ast", T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()),
                                                   T.StructField("y", T.StringType())]))),
])


def rand_value(rng, depth=0):
    choice = rng.randrange(12 if depth < 2 else 9)
    return [lambda: rng.randint(-5, 5), lambda: rng.choice([1.5, 1e10, 2.0, 1e-7, 0.1]),
            lambda: rng.choice(["x", "12", "{a", "[1", "true", ""]), lambda: rng.random() < 0.5,
            lambda: None, lambda: 2 ** 40, lambda: 10 ** 20, lambda: "éÿ",
            lambda: -7,
            lambda: {k: rand_value(rng, depth + 1) for k in rng.sample(["a", "t", "x", "y", "z"], 2)},
            lambda: [rand_value(rng, depth + 1) for _ in range(rng.randrange(3))],
            lambda: [{"x": rand_value(rng, depth + 1), "y": rand_value(rng, depth + 1)}]][choice]()


def rand_doc(rng):
    names = [f.name for f in SCHEMA.fields]
    parts = []
    for n in rng.sample(names, rng.randrange(len(names) + 1)):
        top = -0.0 if rng.random() < 0.05 else rand_value(rng)      # -0.0 in top-level fields only
        parts.append(f'"{n}":{json.dumps(top)}')
        if rng.random() < 0.1:                       # repeated key
            parts.append(f'"{n}":{json.dumps(rand_value(rng))}')
    body = "{" + ",".join(parts) + "}"
    if rng.random() < 0.2:
        body = '{"schema":{},"payload":' + body + "}"
    return body


def test_fast_equals_exact(spark, records):
    rng = random.Random(7)
    docs = [rand_doc(rng) for _ in range(1500)]
    adm = admit(records([("t", 0, i, d) for i, d in enumerate(docs)])).filter("disposition = 'pending'")
    names = [f.name for f in SCHEMA.fields]

    def run(fast):
        out = coerce_rows(adm, SCHEMA, fast=fast)
        return {r["_dl_src"]["offset"]: tuple(r[n] for n in names) + (r[ERR],)
                for r in out.select("_dl_src", *[F.col(n) for n in names], ERR).collect()}

    fast, exact = run(True), run(False)
    assert len(fast) == len(docs)
    diffs = [(docs[k], fast[k], exact[k]) for k in fast if fast[k] != exact[k]]
    assert not diffs, diffs[:3]


def test_exact_path_keeps_document_order_and_jvm_text(spark, records):
    schema = T.StructType([T.StructField("al", T.ArrayType(T.LongType())), T.StructField("s", T.StringType()),
                           T.StructField("n", T.LongType())])
    docs = ['{"al":{"z":1,"a":2,"z":3},"s":-0.0,"n":"bad"}',                 # a failed conversion -> exact path
            '{"schema":{},"payload":{"al":{"q":5,"b":6},"s":1.0E10,"n":true}}']
    adm = admit(records([("t", 0, i, d) for i, d in enumerate(docs)]))
    for fast in (True, False):
        got = {r["_dl_src"]["offset"]: (r["al"], r["s"], r["n"])
               for r in coerce_rows(adm, schema, fast=fast).collect()}
        assert got == {0: ([3, 2], "-0.0", 0), 1: ([5, 6], "1.0E10", 0)}
