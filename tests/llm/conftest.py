import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside.
CLASHES = ["row", "t", "h", "w", "n", "fp", "hi", "lo", "bucket", "size", "target", "copies", "kept", "part", "word",
           "score", "item", "offset", "_k", "label", "_id", "shard", "_block", "_k_id", "_m_n", "id", "ord", "runs", "ctx"]


@pytest.fixture(scope="session")
def frame(spark):
    """(doc_id, text, source) rows as a documents table with clashing extra columns."""
    def make(rows, partitions=3):
        data = [(i, t, None if k % 5 == 0 else "en", s, None if t is None else len(t)) for k, (i, t, s) in enumerate(rows)]
        df = spark.createDataFrame(data, SCHEMA).repartition(partitions) if data else spark.createDataFrame([], SCHEMA)
        return df.select("*", *[F.lit("x" if k % 2 else None).cast("string").alias(c) for k, c in enumerate(CLASHES)])
    return make


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000)) + ". The end"
HARD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "the quick  brown fox\tjumps over the lazy dog\nnear the river bank today", "a"),
    (3, "", "a"), (4, None, None), (5, " \t\n\x0b\f\r ", "b"), (6, "one", "b"), (7, "one", "b"),
    (8, LONG, "c"), (9, LONG, None), (None, "text without an id here", "c"), (None, None, None),
    (None, "text without an id here", "c"), (12, "repeated row of words", "a"), (12, "repeated row of words", "a"),
    (12, "other text under the same id", "\U0001F600"), (13, "é à ü     x\u0085y 日本語 <|endoftext|>", "é"),
    (14, "\x00\x01 nul and \x1c\x1d control", ""), (-3, "negative id", "Z"),
]


@pytest.fixture(scope="session")
def hard(frame):
    return frame(HARD)


@pytest.fixture(scope="session")
def none(frame):
    return frame([])
