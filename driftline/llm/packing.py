"""Best-fit packing by hierarchical residual packing.

Documents are cut into pieces of at most ``capacity`` tokens.  Round 0 packs the
pieces of every partition best-fit, longest first.  Bins that are full but for
at most ``slack`` tokens are emitted.  Every other bin becomes one item of its
size; the items are merged up a tree (``fan_in`` tasks into one) and packed
best-fit again, until one task is left or merging no longer saves bins.  A merge
task takes about ``task_items`` items at most: a level with more items gets more
tasks, so no task grows with the input.  What the last round leaves is emitted
as it is.

Each round is written to the shared folder as moves (item -> bin, offset);
a piece's place is the sum of its moves.

Defined cases: null text is empty (its one end id makes one piece); rows that
repeat an id are packed apart (each row has its own row number); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import stored, whole_text
from driftline.llm.tokens import encoder, text_blocks

CAPACITY = 4096
END_ID = 1
#: A bin with at most this many free tokens is emitted.
SLACK = 8
FAN_IN = 8
#: Items that one packing task takes.
TASK_ITEMS = 200_000


# -- pieces ------------------------------------------------------------------

def _pieces(path: str, end_id: int, capacity: int):
    names = ["item", "doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, step = encoder(path, word_level=True), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            texts, ids, base, seen = b.column("t").to_pylist(), b.column("doc_id").to_pylist(), b.column("row").to_pylist(), []
            for i, j in text_blocks(texts):
                for row, doc, raw in zip(base[i:j], ids[i:j], enc.encode(texts[i:j])):
                    raw += end
                    for k, at in enumerate(range(0, len(raw), step)):
                        part = raw[at:at + step]
                        seen.append((row, doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*seen)) if seen else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["row", *names[1:]])
    return run


def cut_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(item, doc_id, piece, start, length, ids_crc32)``; ``item`` numbers the pieces."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", whole_text().alias("t"))
    pieces = rows.mapInArrow(_pieces(vocabulary, end_id, capacity),
                             "row long, doc_id long, piece int, start long, length long, ids_crc32 long").drop("row")
    return stored(pieces.select(F.monotonically_increasing_id().alias("item"), "*"), "pieces")


# -- best fit ----------------------------------------------------------------

def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best fit, longest first: each item's bin and offset, and the bins' free space.

    Open bins are kept by free space; the smallest space that takes an item is
    found as the lowest set bit of a mask of the spaces in use.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    bins, offsets, free = [0] * len(lengths), [0] * len(lengths), []
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for i in order:
        n = lengths[i]
        fits = mask >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                mask &= ~(1 << space)
        else:
            b, space = len(free), capacity
            free.append(capacity)
        bins[i], offsets[i] = b, capacity - space
        free[b] = space - n
        by_space[space - n].append(b)
        mask |= 1 << (space - n)
    return bins, offsets, free


def _pack(capacity: int, level: int, task_items: int):
    """Items ``(item, length)`` of one task to moves ``(item, bin, offset, used)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, length, made, task = [], [], 0, None

        def flush():
            nonlocal made
            bins, offsets, free = best_fit(length, capacity)
            name = np.array(bins, np.int64) + made + (task << 32)
            made += len(free)
            used = capacity - np.array(free, np.int64)[np.array(bins, np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array(item, np.int64)), pa.array(name), pa.array(np.array(offsets, np.int64)), pa.array(used)],
                names=["item", "bin", "offset", "used"])

        for b in batches:
            if len(b):
                task = b.column("task")[0].as_py()
                item.extend(b.column("item").to_pylist())
                length.extend(b.column("length").to_pylist())
                if len(item) >= task_items:
                    yield flush()
                    item, length = [], []
        if item:
            yield flush()
    return run


def pack_items(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, fan_in: int = FAN_IN,
               task_items: int = TASK_ITEMS) -> DataFrame:
    """``items (item, length)`` to places ``(item, sequence_id, offset)``."""
    packed = "item long, bin long, offset long, used long"

    def round_(df: DataFrame, level: int) -> DataFrame:
        tagged = df.select("item", "length", F.spark_partition_id().cast("long").alias("task"))
        return stored(tagged.mapInArrow(_pack(capacity, level, task_items), packed), f"pack-{level}")

    # places: item -> (bin of the last round, offset in it); `done`: places in emitted bins
    moves, level = round_(items, 0), 0
    tasks = moves.agg(F.count_distinct(F.shiftright("bin", 32))).first()[0]
    places, done, saved = moves.select("item", "bin", "offset"), [], None
    while True:
        bins = stored(moves.groupBy("bin").agg(F.max("used").alias("used")), "bins")
        left = bins.filter(F.col("used") < capacity - slack)
        stats = left.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("used"), F.lit(0)).alias("used")).first()
        n, least = stats["n"], -(-stats["used"] // capacity)
        # nothing can be saved any more, or one task has seen all that is left
        if n <= least or tasks <= 1:
            break
        wanted = max(1, -(-tasks // fan_in), -(-n // task_items))
        if wanted >= tasks and saved is not None and saved < 0.005 * n:
            break
        tasks, level = wanted, level + 1
        merged = round_(left.select(F.col("bin").alias("item"), F.col("used").alias("length"))
                        .repartition(tasks, F.xxhash64("item", F.lit(level))), level)
        saved = n - merged.select("bin").distinct().count()
        full = bins.filter(F.col("used") >= capacity - slack).select("bin")
        done.append(places.join(full, "bin", "left_semi").withColumn("level", F.lit(level - 1)))
        up = merged.select(F.col("item").alias("from"), F.col("bin").alias("to"), F.col("offset").alias("shift"))
        places = stored(places.join(up, places["bin"] == up["from"])
                        .select("item", F.col("to").alias("bin"), (F.col("offset") + F.col("shift")).alias("offset")),
                        f"places-{level}")
        moves = merged
    out = places.withColumn("level", F.lit(level))
    for d in done:
        out = out.unionByName(d)
    # bins are numbered per round; the round goes into the high bits
    return out.select("item", (F.col("bin") + F.shiftleft(F.col("level").cast("long"), 56)).alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, **options) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    pieces = cut_pieces(docs, vocabulary, capacity, end_id)
    places = pack_items(pieces.select("item", "length"), capacity, **options)
    return pieces.join(places, "item").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
