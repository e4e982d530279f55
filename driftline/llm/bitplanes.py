"""Token-id files by byte- or bit-plane shuffling.

A file holds the ids of a range of documents as chunks of whole or split
documents.  A chunk is cut into fixed-size blocks of ids; each block is
transposed into planes (byte k, or bit k, of every id), each plane is
compressed with zstandard, and the chunk's index stores every plane's length
beside the documents it covers.  A plane without a set bit takes no bytes.

Files are written and read by Spark (rows of Parquet: one chunk each, with its
index), so they live wherever Spark's file systems do and a lost executor's
task is simply run again; Python workers open no files.

Order: documents are range-partitioned by id, one file per range, sorted
inside it.  Positions over all files come from one running sum over the files'
totals (one row per file).

Defined cases: null text is an empty text (one end id); null ids come first;
rows that share an id are ordered by the hash of their text; a document of any
length is cut into parts of at most ``chunk_ids`` ids, whose checksums are
combined on reading; an empty table writes empty files and gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.common import scratch_path, stored, whole_text
from driftline.llm.tokens import encoder, text_blocks

END_ID = 2
BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 20
LEVEL = 3

CHUNK_SCHEMA = ("file int, chunk int, n_ids long, doc_id array<long>, part array<int>, last array<boolean>, "
                "length array<int>, plane_bytes array<int>, planes binary")
PART_SCHEMA = "file int, chunk int, pos int, doc_id long, part int, last boolean, n long, crc long"


# -- the block codec ---------------------------------------------------------

def shuffle_block(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids: 4 byte planes or 32 bit planes."""
    rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        cells = np.unpackbits(rows, axis=1, bitorder="little")            # ids x 32
        return [np.packbits(cells[:, k], bitorder="little").tobytes() for k in range(32)]
    return [rows[:, k].tobytes() for k in range(4)]


def unshuffle_block(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    if bits:
        cells = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(planes):
            if p:
                cells[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n]
        return np.packbits(cells, axis=1, bitorder="little").view("<u4").ravel()
    rows = np.zeros((n, 4), np.uint8)
    for k, p in enumerate(planes):
        if p:
            rows[:, k] = np.frombuffer(p, np.uint8)
    return rows.view("<u4").ravel()


def pack_ids(ids: np.ndarray, bits: bool = False, block: int = BLOCK_IDS, level: int = LEVEL) -> tuple[bytes, list[int]]:
    """All planes of all blocks, one after another, and each one's compressed length (0: all zero)."""
    press, parts = zstandard.ZstdCompressor(level=level), []
    for i in range(0, len(ids), block):
        for plane in shuffle_block(ids[i:i + block], bits):
            parts.append(press.compress(plane) if plane.strip(b"\0") else b"")
    return b"".join(parts), [len(p) for p in parts]


def unpack_ids(planes: bytes, lengths: list[int], n: int, bits: bool = False, block: int = BLOCK_IDS) -> np.ndarray:
    """The ids of a chunk; the number of planes in a block follows from ``bits``."""
    if not n:
        return np.zeros(0, "<u4")
    expand, per, at, out = zstandard.ZstdDecompressor(), 32 if bits else 4, 0, []
    view = memoryview(planes)
    for b, i in enumerate(range(0, n, block)):
        got = []
        for length in lengths[b * per:(b + 1) * per]:
            got.append(expand.decompress(view[at:at + length]) if length else b"")
            at += length
        out.append(unshuffle_block(got, min(block, n - i), bits))
    return np.concatenate(out)


def crc_combine(a: int, b: int, length_b: int) -> int:
    """crc32 of two byte strings joined, from each one's crc32 and the second one's length."""
    def times(matrix, vector):
        total, i = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[i]
            vector, i = vector >> 1, i + 1
        return total

    step = [0xEDB88320] + [1 << i for i in range(31)]          # one zero bit
    for _ in range(3):                                         # one zero byte
        step = [times(step, x) for x in step]
    while length_b:
        if length_b & 1:
            a = times(step, a)
        step = [times(step, x) for x in step]
        length_b >>= 1
    return a ^ b


# -- writing -----------------------------------------------------------------

def _write(path: str, end_id: int, bits: bool, chunk_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path, word_level=False), np.array([end_id], "<u4").tobytes()
        held, docs, chunk, file = [], [], 0, 0

        def flush():
            nonlocal held, docs, chunk
            ids = np.concatenate(held)
            planes, lengths = pack_ids(ids, bits)
            row = {"file": file, "chunk": chunk, "n_ids": len(ids), "doc_id": [d[0] for d in docs],
                   "part": [d[1] for d in docs], "last": [d[2] for d in docs], "length": [d[3] for d in docs],
                   "plane_bytes": lengths, "planes": planes}
            held, docs, chunk = [], [], chunk + 1
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("file", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int64()), ("doc_id", pa.list_(pa.int64())),
                ("part", pa.list_(pa.int32())), ("last", pa.list_(pa.bool_())), ("length", pa.list_(pa.int32())),
                ("plane_bytes", pa.list_(pa.int32())), ("planes", pa.binary())]))

        size = 0
        for b in batches:
            keys, texts, file = b.column("doc_id").to_pylist(), b.column("t").to_pylist(), b.column("file")[0].as_py()
            for i, j in text_blocks(texts):
                for key, raw in zip(keys[i:j], enc.encode(texts[i:j])):
                    ids, part, at = np.frombuffer(raw + end, "<u4"), 0, 0
                    while at < len(ids):
                        take = min(len(ids) - at, chunk_ids - size)
                        held.append(ids[at:at + take])
                        docs.append((key, part, at + take == len(ids), take))
                        part, at, size = part + 1, at + take, size + take
                        if size >= chunk_ids:
                            yield flush()
                            size = 0
        if held:
            yield flush()
    return run


def write_files(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID, bits: bool = False,
                files: int | None = None, chunk_ids: int = CHUNK_IDS) -> None:
    """Encode all documents in ascending id order and write one file of chunks per id range."""
    spark = docs.sparkSession
    ranges = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    t = docs.select("doc_id", whole_text().alias("t")).withColumn("h", F.xxhash64("t"))
    ordered = (t.repartitionByRange(ranges, F.col("doc_id").asc_nulls_first(), "h")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
               .select("doc_id", "t", F.spark_partition_id().alias("file")))
    (ordered.mapInArrow(_write(vocabulary, end_id, bits, chunk_ids), CHUNK_SCHEMA)
     .write.option("compression", "none").parquet(path))


# -- reading -----------------------------------------------------------------

def _read(bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                raw = unpack_ids(row["planes"], row["plane_bytes"], row["n_ids"], bits).astype("<u4").tobytes()
                at, crc = 0, []
                for n in row["length"]:
                    crc.append(zlib.crc32(memoryview(raw)[4 * at:4 * (at + n)]))
                    at += n
                k = len(crc)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["file"]] * k, pa.int32()), pa.array([row["chunk"]] * k, pa.int32()),
                    pa.array(range(k), pa.int32()), pa.array(row["doc_id"], pa.int64()), pa.array(row["part"], pa.int32()),
                    pa.array(row["last"], pa.bool_()), pa.array(row["length"], pa.int64()), pa.array(crc, pa.int64())],
                    names=["file", "chunk", "pos", "doc_id", "part", "last", "n", "crc"])
    return run


def _join_parts(parts: list) -> int:
    crc = 0
    for i, (_, n, c) in enumerate(sorted((p["order"], p["n"], p["crc"]) for p in parts)):
        crc = crc_combine(crc, c, 4 * n) if i else c
    return crc


def read_documents(spark: SparkSession, path: str, bits: bool = False) -> DataFrame:
    """From the files alone: ``doc_id, start, n_tokens, ids_crc32``, one row per document."""
    chunks = spark.read.parquet(path)
    ahead = (chunks.groupBy("file").agg(F.sum("n_ids").alias("total"))
             .withColumn("base", F.sum("total").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)))
             .select("file", F.coalesce("base", F.lit(0)).alias("base")))
    within = (chunks.select("file", "chunk", "n_ids")
              .withColumn("before", F.sum("n_ids").over(Window.partitionBy("file").orderBy("chunk")
                                                        .rowsBetween(Window.unboundedPreceding, -1)))
              .join(ahead, "file").select("file", "chunk", (F.coalesce("before", F.lit(0)) + F.col("base")).alias("chunk_start")))
    parts = stored(chunks.mapInArrow(_read(bits), PART_SCHEMA), "id-parts").join(within, ["file", "chunk"])
    run = Window.partitionBy("file", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.col("chunk_start") + F.coalesce(F.sum("n").over(run), F.lit(0)))
    whole = parts.filter((F.col("part") == 0) & F.col("last")).select(
        "doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    # Documents over several chunks: a part's document starts at its first part's place.
    split = parts.filter(~((F.col("part") == 0) & F.col("last")))
    first = F.max(F.when(F.col("part") == 0, F.col("start"))).over(
        Window.partitionBy("file").orderBy("chunk", "pos").rowsBetween(Window.unboundedPreceding, 0))
    join = F.udf(_join_parts, "long")
    long_docs = (split.withColumn("first", first).groupBy("file", "first", "doc_id")
                 .agg(F.sum("n").alias("n_tokens"),
                      F.collect_list(F.struct(F.col("part").alias("order"), "n", "crc")).alias("parts"))
                 .select("doc_id", F.col("first").alias("start"), "n_tokens", join("parts").alias("ids_crc32")))
    return whole.unionByName(long_docs)


def roundtrip(docs: DataFrame, vocabulary: str, end_id: int = END_ID, bits: bool = False, files: int | None = None,
              chunk_ids: int = CHUNK_IDS) -> DataFrame:
    path = scratch_path(docs.sparkSession, "id-files")
    write_files(docs, vocabulary, path, end_id, bits, files, chunk_ids)
    return read_documents(docs.sparkSession, path, bits)
