"""SimHash near-dedup by anchor-point covering.

Fingerprints: the bitwise majority of the 64-bit XXH64 values of all word
shingles, repeats included.  Equal fingerprints are one node.

Search: the 64 bits are cut into ``blocks`` parts.  Two fingerprints within
``max_bits`` differ by at most t = max_bits // blocks bits in some part, so each
part is searched on its own with threshold t.  Anchors of a part are the
codewords of a Hamming covering code (4 parity bits, covering radius R = 1):
every value has a codeword within R, its home.  A fingerprint is replicated to
every anchor within R + t; if x and y differ by at most t bits there, y reaches
x's home by the triangle inequality, so comparing home members with replicas at
each anchor finds every pair.  A comparison counts all 64 bits.

Replicas of one anchor are met in blocks of at most about ``part_rows`` by
``part_rows`` rows: an anchor with more is dealt out over pairs of hashed parts,
so no task holds a whole hot anchor.  A block of comparisons leaves a spanning
forest of what it linked, never all pairs.  Links are joined into components by
star contraction in Spark.

Defined cases: null text counts as empty; a text without words has fingerprint
zero and links like any other; a component's id is the smallest non-null id in
it, or null if there is none; repeated rows and exact copies share one node; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import components, keep_rows, stored, whole_text

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCKS = 3
PART_ROWS = 4096
#: Pairs compared in one numpy step.
STEP_PAIRS = 1 << 21
#: Shingle hashes that are turned into bits at once.
STEP_HASHES = 1 << 14


# -- fingerprints ------------------------------------------------------------

def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The fingerprint of one UTF-8 text as a signed long."""
    # bytes.lower() folds A-Z only, bytes.split() cuts at space and 0x09-0x0D only
    w = text.lower().split()
    if not w:
        return 0
    if len(w) <= words:
        return int(np.uint64(xxhash.xxh64_intdigest(b" ".join(w), seed)).astype(np.int64))
    flat = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    count, set_bits = len(w) - words + 1, np.zeros(64, np.int64)
    stops = ends[words - 1:].tolist()
    for i in range(0, count, STEP_HASHES):
        h = np.array([digest(flat[a:b], seed) for a, b in zip(starts[i:min(i + STEP_HASHES, count)], stops[i:i + STEP_HASHES])],
                     dtype="<u8")
        set_bits += _bit_sums(h)
    major = np.packbits((2 * set_bits > count), bitorder="little")
    return int(major.view("<i8")[0])


def _bit_sums(h: np.ndarray) -> np.ndarray:
    """How many of the values have each bit set."""
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def _fingerprints(words: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, words, seed) for t in b.column("t").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(fp, pa.int64())],
                                             names=["doc_id", "text_key", "fp"])
    return run


# -- anchors -----------------------------------------------------------------

def spans(blocks: int) -> list[tuple[int, int]]:
    """(shift, width) of each part of the 64 bits."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


class Covering:
    """The Hamming covering code of one part: parity columns 1..15, repeated."""

    PARITY = 4

    def __init__(self, width: int, reach: int):
        columns = [(i % 15) + 1 for i in range(width)]
        self.width = width
        # syndromes by table: one for the low bits of a value, one for the rest
        self.low_bits = min(width, 11)
        self.low = self._table(columns[:self.low_bits])
        self.high = self._table(columns[self.low_bits:])
        flips = [0]
        for _ in range(reach):
            flips = sorted({f ^ (1 << i) for f in flips for i in range(width)} | set(flips))
        by: dict[int, list[int]] = {s: [] for s in range(1 << self.PARITY)}
        for f in flips:
            by[int(self.syndrome(np.array([f]))[0])].append(f)
        #: flips that lead from a value of each syndrome to its anchors; the first one, of least weight, leads home
        self.flips = {s: np.array(sorted(v, key=lambda f: (f.bit_count(), f)), np.int64) for s, v in by.items()}

    @staticmethod
    def _table(columns: list[int]) -> np.ndarray:
        value = np.arange(1 << len(columns))
        out = np.zeros(len(value), np.int64)
        for i, column in enumerate(columns):
            out ^= ((value >> i) & 1) * column
        return out

    def syndrome(self, value: np.ndarray) -> np.ndarray:
        return self.low[value & ((1 << self.low_bits) - 1)] ^ self.high[value >> self.low_bits]


def _replicas(blocks: int, max_bits: int):
    """Arrow batches of ``fp`` to ``(anchor, fp, home)``; the anchor's number carries the part's."""
    reach = 1 + max_bits // blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(shift, width, Covering(width, reach)) for shift, width in spans(blocks)]
        for b in batches:
            fp = b.column("fp").to_numpy()
            for j, (shift, width, code) in enumerate(parts):
                value = ((fp.view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
                synd = code.syndrome(value)
                for s, flips in code.flips.items():
                    rows = np.flatnonzero(synd == s)
                    if not len(rows):
                        continue
                    anchors = (value[rows, None] ^ flips[None, :]).ravel() | (j << 40)
                    home = np.zeros((len(rows), len(flips)), bool)
                    home[:, 0] = True
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors), pa.array(np.repeat(fp[rows], len(flips))), pa.array(home.ravel())],
                        names=["anchor", "fp", "home"])
    return run


# -- comparisons -------------------------------------------------------------

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges ``(root, node)`` of the components of the edges a-b."""
    nodes, ab = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ab[:len(a)], ab[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[root[child]], nodes[child]


def _links(max_bits: int):
    """Batches sorted by (anchor, pair) to links; a group is a run of equal keys."""

    def compare(key: np.ndarray, fp: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        size = np.diff(np.r_[first, len(fp)])
        group = np.repeat(np.arange(len(first)), size)
        h = np.flatnonzero(home)
        partners, start = size[group[h]], first[group[h]]
        upto = np.cumsum(partners)
        i = 0
        while i < len(h):
            j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + STEP_PAIRS)))
            n = partners[i:j]
            left = np.repeat(h[i:j], n)
            right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[i:j], n)
            x, y = fp[left], fp[right]
            ok = (np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits) & (x != y)
            if ok.any():
                yield forest(x[ok], y[ok])
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp, home = np.zeros((0, 2), np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        for b in batches:
            key = np.concatenate([key, np.column_stack([b.column("anchor").to_numpy(), b.column("pair").to_numpy()])])
            fp = np.concatenate([fp, b.column("fp").to_numpy()])
            home = np.concatenate([home, b.column("home").to_numpy(zero_copy_only=False)])
            differs = np.flatnonzero((key != key[-1]).any(axis=1)) if len(key) else []
            cut = int(differs[-1]) + 1 if len(differs) else 0      # the last group may go on in the next batch
            if cut:
                for root, node in compare(key[:cut], fp[:cut], home[:cut]):
                    yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(node)], names=["a", "b"])
                key, fp, home = key[cut:], fp[cut:], home[cut:]
        if len(key):
            for root, node in compare(key, fp, home):
                yield pa.RecordBatch.from_arrays([pa.array(root), pa.array(node)], names=["a", "b"])
    return run


def near_links(nodes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, part_rows: int = PART_ROWS) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of ``nodes (fp)`` within ``max_bits``."""
    reps = nodes.select("fp").mapInArrow(_replicas(blocks, max_bits), "anchor long, fp long, home boolean")
    crowded = stored(reps.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part_rows)
                     .select("anchor", F.ceil(F.col("n") / part_rows).cast("long").alias("parts")), "crowded-anchors")
    dealt = reps.withColumn("pair", F.lit(0).cast("long"))
    if not crowded.isEmpty():
        dealt = reps.join(crowded, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
        own = F.pmod(F.xxhash64("fp"), F.col("parts"))
        every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
        # pair (i, j): the home members of part i against all replicas of part j
        as_home = F.transform(every, lambda j: F.struct((own * F.col("parts") + j).alias("pair"), F.lit(True).alias("home")))
        as_other = F.transform(every, lambda i: F.struct((i * F.col("parts") + own).alias("pair"), F.lit(False).alias("home")))
        roles = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).cast("long").alias("pair"), F.col("home").alias("home")))
                       ).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
        dealt = dealt.select("anchor", "fp", F.explode(roles).alias("r")).select("anchor", "fp", "r.home", "r.pair")
    # inside a group, equal rows in two roles compare with themselves only: x != y drops that
    return (dealt.repartition("anchor", "pair").sortWithinPartitions("anchor", "pair")
            .mapInArrow(_links(max_bits), "a long, b long"))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, text_key, fp)``, one row per document."""
    return docs.select("doc_id", whole_text().alias("t")).select("doc_id", F.xxhash64("t").alias("text_key"), "t").mapInArrow(
        _fingerprints(words, seed), "doc_id long, text_key long, fp long")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                part_rows: int = PART_ROWS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, root, text_key``."""
    fps = stored(fingerprints(docs, words), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    roots = components(near_links(nodes, max_bits, blocks, part_rows))
    label = stored(nodes.join(roots, nodes["fp"] == roots["node"], "left")
                   .select("fp", "low", F.coalesce("root", "fp").alias("root")), "labels")
    ids = label.groupBy("root").agg(F.min("low").alias("component_id"))
    named = label.select("fp", "root").join(ids, "root")
    return fps.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                        "component_id", "root", "text_key")


def near_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id
    (among rows that share it, or rows without id, the one with the smallest text hash)."""
    groups = stored(near_groups(docs, words, max_bits), "groups")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    kept = groups.groupBy("root").agg(F.min(first).alias("k")).select("k.doc_id", "k.text_key")
    return keep_rows(docs, kept)
