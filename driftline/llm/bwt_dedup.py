"""Repeated passages by merging Burrows-Wheeler transforms.

Every byte that a string of ``width`` bytes covers which also starts earlier (in
an earlier document, or earlier in the same one) is marked; matches stay inside
documents.  The bytes that repeat are found in four steps.

1. **Contexts.**  Among the grams of ``GRAM`` bytes inside a window of ``width``
   bytes the one with the smallest hash (then the first) is the window's anchor.
   Equal windows have equal anchors at equal places, so windows can only be equal
   if their anchors are.  Neighbouring windows with one anchor make a context: a
   string of at most ``2 * width - GRAM`` bytes.  A task sends one row per
   distinct context: hash of the anchor, hash of the context, place.
2. **Equal contexts** (both hashes, 116 bits) meet by the anchor's hash.  All but
   the first occurrence are repeats as a whole.  Anchors with a single context need
   nothing more; the first occurrences of the others go on with their bytes.
3. **Merging.**  The contexts of an anchor lie in one cell of some thousand
   contexts.  A cell's contexts are dealt to shards; a shard sorts its own suffixes
   and gives its transform.  The shards' transforms are merged by refining their
   interleave: a round sorts the merged order stably by the sign before each
   suffix, after which it is right for one more sign; places where two
   neighbours part in round h have a common prefix of h - 1 signs.  No suffix of
   the merged order is compared or sorted again.  After as many rounds as a window
   has signs, what still lies together are the repeated intervals: windows that
   are equal, of which the first stays and the others are repeats.  (The bytes of
   an anchor stand in its context as one name of two signs, which shortens windows
   and rounds; names are given by the bytes themselves.)
4. Repeats are gathered by document, joined where they overlap or touch, and cut out.

An anchor with more than ``HOT`` contexts, such as a passage that a third of all
documents hold between different words, would not fit a cell; its windows are
grouped by their bytes with DataFrame functions instead, as rows of their own.
Rows of one anchor in step 2 number at most one per context and input batch; they
are sorted outside of memory and read as a stream.

Order of documents: by id, null ids last, equal ids by the hash of their text.
Defined cases: null text is empty; texts shorter than ``width`` bytes are left
alone; of equal rows all but the first are repeats; an empty table gives no rows;
other columns are ignored.  A text of 2^28 bytes or more, or more than 2^35
documents, raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import stored, whole_text

WIDTH, GRAM = 100, 48
#: Contexts of one anchor that still go to a cell; contexts of a cell; of a shard.
HOT, CELL, SHARD = 1 << 14, 1 << 14, 1 << 12
#: Bits of a place inside its document, of a chunk of text (a task's working set), of a count of windows.
OFFSET_BITS, CHUNK_BITS, SPAN_BITS = 28, 18, 8
#: Rows of step 2 for one task.
TASK_ROWS = 1_000_000

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))
_BYTE = np.random.default_rng(13).integers(1, 1 << 63, 256, np.uint64)      # one number per byte, the same everywhere


# -- contexts --------------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M3
    return h ^ (h >> np.uint64(29))


def _gram_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size`` neighbouring bytes (``x``: their numbers)."""
    now, done, factor = x, 1, int(_M2)
    while done < size:
        step = min(done, size - done)
        lift = np.uint64(pow(factor, step, 1 << 64))
        # the part that the two halves share only counts twice; equal bytes give equal hashes
        now = now[:-step] * lift + (now[step:] ^ (now[step:] >> np.uint64(31)))
        done += step
    return _mix(now)


class _Powers:
    """Powers of an odd number and of its inverse: hashes of all stretches of a chunk."""
    up = down = None

    @classmethod
    def get(cls, n: int):
        if cls.up is None or len(cls.up) < n:
            base = 0x2545F4914F6CDD1D
            inverse = pow(base, -1, 1 << 64)
            for name, b in (("up", base), ("down", inverse)):
                out = np.ones(1, np.uint64)
                while len(out) < n:
                    out = np.concatenate([out, out * np.uint64(pow(b, len(out), 1 << 64))])
                setattr(cls, name, out)
        return cls.up, cls.down


def chunk_contexts(buf: np.ndarray, ends: np.ndarray, width: int = WIDTH, gram: int = GRAM):
    """Contexts of the texts that lie one after another in ``buf``: ``lo`` (first
    window), ``m`` (windows), ``a`` (place of the anchor in the context) and the two hashes."""
    n = len(buf) - width + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    x = _BYTE[buf]
    h = _gram_hashes(x, gram)
    place = (1 << CHUNK_BITS) - 1
    least = (h & ~np.uint64(place)) | np.arange(len(h), dtype=np.uint64)
    done, span = 1, width - gram + 1
    while done < span:
        step = min(done, span - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    at = (least & np.uint64(place)).astype(np.int64)                # the anchor of each window
    whole = np.zeros(n + 1, np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    last = np.maximum(begins, ends - width + 1)
    np.add.at(whole, np.minimum(begins, n), 1)
    np.add.at(whole, np.minimum(last, n), -1)
    whole = np.cumsum(whole[:-1]) > 0                               # windows inside one text
    # A new context where the anchor changes, or (equal anchors cannot be) a text ends.
    turn = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (whole[1:] != whole[:-1])]))
    m = np.diff(np.append(turn, n))
    keep = whole[turn]
    lo, m = turn[keep], m[keep]
    anchor = at[lo]
    up, down = _Powers.get(len(buf) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:len(x)], dtype=np.uint64)])
    text = _mix((sums[lo + m + width - 1] - sums[lo]) * down[lo] + m.astype(np.uint64) * _M1)
    return lo, m, anchor - lo, h[anchor], text


def _pack(text: np.ndarray, m: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Hash of a context (its upper bits), its windows and its anchor's place in one number."""
    return (((text >> np.uint64(2 * SPAN_BITS + 1)) << np.uint64(2 * SPAN_BITS)) | (m.astype(np.uint64) << np.uint64(SPAN_BITS))
            | a.astype(np.uint64)).view(np.int64)


def _context_rows(width: int, gram: int):
    """Texts to rows ``(fp, ctx, at)``.  Repeats that a batch already shows leave with
    ``ctx`` below zero (their windows) and a number of their own as ``fp``."""
    size = 1 << CHUNK_BITS

    def chunks(b):
        held, parts, ends, ords, begins = 0, [], [], [], []
        for ord_, text in zip(b.column("ord").to_pylist(), b.column("t")):
            text = text.as_buffer()
            total = len(text)
            if total >> OFFSET_BITS:
                raise ValueError(f"a text of {total} bytes: at most 2^{OFFSET_BITS} - 1 can be told apart")
            for begin in range(0, max(1, total - width + 1), size - width):
                piece = np.frombuffer(text, np.uint8)[begin:begin + size - 1]   # windows of a piece: size - width
                if len(piece) < width:
                    continue
                if held + len(piece) >= size:
                    yield parts, ends, ords, begins
                    held, parts, ends, ords, begins = 0, [], [], [], []
                held += len(piece)
                parts.append(piece), ends.append(held), ords.append(ord_), begins.append(begin)
        if parts:
            yield parts, ends, ords, begins

    def batches(it):
        for b in it:
            found = []
            with np.errstate(over="ignore"):
                for parts, ends, ords, begins in chunks(b):
                    if not parts:
                        continue
                    ends = np.array(ends, np.int64)
                    lo, m, a, fp, text = chunk_contexts(np.concatenate(parts), ends, width, gram)
                    which = np.searchsorted(ends, lo, side="right")
                    offset = lo - np.concatenate([[0], ends[:-1]])[which] + np.array(begins, np.int64)[which]
                    found.append((fp.view(np.int64), _pack(text, m, a), (np.array(ords, np.int64)[which] << OFFSET_BITS) | offset))
                if not found:
                    continue
                fp, ctx, at = (np.concatenate(x) for x in zip(*found))
                both = _mix((fp.view(np.uint64) * _M1) ^ ctx.view(np.uint64))
                order = np.lexsort([at, both])
                same = (fp[order[1:]] == fp[order[:-1]]) & (ctx[order[1:]] == ctx[order[:-1]])
                again = np.zeros(len(fp), bool)
                again[order[1:][same]] = True
                windows = (ctx >> SPAN_BITS) & ((1 << SPAN_BITS) - 1)
                ctx = np.where(again, -windows, ctx)
                fp = np.where(again, _mix(at.view(np.uint64) * _M2).view(np.int64), fp)
            yield pa.RecordBatch.from_arrays([pa.array(fp), pa.array(ctx), pa.array(at)], names=["fp", "ctx", "at"])
    return batches


# -- equal contexts ----------------------------------------------------------------

def _repeats(it):
    """Ordered rows ``(fp, ctx, at)`` to ``(kind, fp, ctx, at, m)``: kind 0, ``m`` windows
    from ``at`` on are repeats; kind 1, the first occurrence of a context whose anchor
    has others."""
    low = (1 << SPAN_BITS) - 1
    last, told = None, True        # the last context's first row, and whether it has been sent
    for b in it:
        fp, ctx, at = (b.column(c).to_numpy() for c in ("fp", "ctx", "at"))
        if not len(fp):
            continue
        early = ctx < 0
        rows = np.flatnonzero(~early)
        out = [(np.zeros(int(early.sum()), np.int32), fp[early], ctx[early], at[early], -ctx[early])]
        if len(rows):
            f, c, p = fp[rows], ctx[rows], at[rows]
            anchor = np.empty(len(f), bool)
            anchor[1:] = f[1:] == f[:-1]
            anchor[0] = last is not None and f[0] == last[0]
            equal = anchor.copy()
            equal[1:] &= c[1:] == c[:-1]
            equal[0] &= last is not None and c[0] == last[1]
            out.append((np.zeros(int(equal.sum()), np.int32), f[equal], c[equal], p[equal], (c[equal] >> SPAN_BITS) & low))
            firsts = np.flatnonzero(~equal)
            shares = anchor[firsts]                     # follows another context of its anchor
            if len(firsts):
                if shares[0] and not told:
                    out.append((np.ones(1, np.int32), *(np.array([v], np.int64) for v in (*last, (last[1] >> SPAN_BITS) & low))))
                before = np.append(shares[1:], False)   # another one follows it, in this batch
                send = firsts[shares | before]
                out.append((np.ones(len(send), np.int32), f[send], c[send], p[send], (c[send] >> SPAN_BITS) & low))
                z = firsts[-1]
                last, told = (int(f[z]), int(c[z]), int(p[z])), bool(shares[-1])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["kind", "fp", "ctx", "at", "m"])


# -- shards and their merge ----------------------------------------------------------

def shard_order(signs: np.ndarray, begin: np.ndarray, size: np.ndarray, depth: int) -> np.ndarray:
    """Order of a shard's suffixes (rotations of its strings) by their first ``depth``
    signs or more: ranks of 1, 2, 4, ... signs, each from the one before.  ``begin``
    and ``size`` give every place's string."""
    inside = np.arange(len(signs)) - begin
    after = lambda k: begin + (inside + k) % size           # noqa: E731
    key = signs.astype(np.uint64)
    for k in (1, 2, 3):
        key = (key << np.uint64(16)) | signs[after(k)].astype(np.uint64)
    known = 4
    while True:
        order = np.argsort(key, kind="stable")
        rank = np.empty(len(signs), np.int64)
        rank[order] = np.cumsum(np.concatenate([[False], key[order[1:]] != key[order[:-1]]]))
        if known >= depth or rank[order[-1]] == len(signs) - 1:
            return order
        key = (rank.astype(np.uint64) << np.uint64(32)) | rank[after(known)].astype(np.uint64)
        known *= 2


def merge_transforms(transforms: list[np.ndarray], depths: tuple[int, ...]):
    """Merge sorted shards from their transforms alone.

    ``transforms[s]`` holds the sign before each suffix of shard ``s`` in its order.
    Returns the interleave (the shard of each place of the merged order) and, for
    each of ``depths``, the number of the interval of suffixes that share so many
    signs."""
    signs = np.concatenate(transforms)
    shard = np.repeat(np.arange(len(transforms), dtype=np.uint8), [len(t) for t in transforms])
    interval = np.zeros(len(signs), np.int32)
    before = np.empty_like(signs)
    found = {}
    for h in range(1, max(depths) + 1):
        before[np.argsort(shard, kind="stable")] = signs
        order = np.argsort(before, kind="stable")
        shard = shard[order]
        sign, old = before[order], interval[order]
        parted = (sign[1:] != sign[:-1]) | (old[1:] != old[:-1])        # their common prefix has h - 1 signs
        interval = np.concatenate([[0], np.cumsum(parted, dtype=np.int32)]).astype(np.int32)
        if h in depths:
            found[h] = interval
    return shard, found


def cell_repeats(contexts: list[bytes], m: np.ndarray, a: np.ndarray, at: np.ndarray, width: int = WIDTH, gram: int = GRAM,
                 shard_size: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """Windows ``(context, window)`` of a cell that are equal to an earlier window of it."""
    names: dict[bytes, int] = {}
    first = 257
    tops = 4096
    parts = []
    for text, p in zip(contexts, a.tolist()):
        name = names.setdefault(text[p:p + gram], len(names))
        s = np.empty(len(text) - gram + 3, np.uint16)
        flat = np.frombuffer(text, np.uint8)
        s[:p] = flat[:p]
        s[p], s[p + 1] = first + name // tops, first + name % tops
        s[p + 2:-1] = flat[p + gram:]
        s[:p] += 1
        s[p + 2:-1] += 1
        s[-1] = 0
        parts.append(s)
    depth = width - gram + 2
    shards = max(2, -(-len(parts) // shard_size)) if len(parts) > 1 else 1
    transforms, where = [], []
    for k in range(shards):
        mine = list(range(k, len(parts), shards))
        lengths = np.array([len(parts[x]) for x in mine], np.int64)
        signs = np.concatenate([parts[x] for x in mine])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        begin, size = np.repeat(starts, lengths), np.repeat(lengths, lengths)
        order = shard_order(signs, begin, size, depth)
        place = order - begin[order]
        transforms.append(signs[begin[order] + (place - 1) % size[order]])
        where.append((np.repeat(np.array(mine), lengths)[order], place))
    shard, found = merge_transforms(transforms, (depth,))
    taken = np.argsort(shard, kind="stable")
    context, window = np.empty(len(shard), np.int64), np.empty(len(shard), np.int64)
    context[taken] = np.concatenate([w[0] for w in where])
    window[taken] = np.concatenate([w[1] for w in where])
    real = window < m[context]
    context, window, interval = context[real], window[real], found[depth][real]
    begins = at[context] + window
    cuts = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]]))
    earliest = np.repeat(np.minimum.reduceat(begins, cuts), np.diff(np.append(cuts, len(begins))))
    late = begins != earliest
    return context[late], window[late]


def _cell_rows(width: int, gram: int, cell: int, shard_size: int):
    """Contexts ordered by anchor to repeats ``(at, m)``, cell by cell."""
    def repeats(rows):
        if len(rows) < 2:
            return None
        at, m, a = (np.array([r[c] for r in rows], np.int64) for c in ("at", "m", "a"))
        context, window = cell_repeats([r["c"] for r in rows], m, a, at, width, gram, shard_size)
        begins = np.sort(at[context] + window)
        # neighbouring windows leave as one row
        cuts = np.flatnonzero(np.concatenate([[True], np.diff(begins) != 1])) if len(begins) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(begins[cuts]), pa.array(np.diff(np.append(cuts, len(begins))).astype(np.int64))],
                                          names=["at", "m"])

    def batches(it):
        rows, whole = [], 0                     # whole: rows before the anchor that is being read
        for b in it:
            for r in b.to_pylist():
                if rows and r["fp"] != rows[-1]["fp"]:
                    whole = len(rows)
                    if whole >= cell:
                        yield repeats(rows)
                        rows, whole = [], 0
                rows.append(r)
        if rows and (out := repeats(rows)) is not None:
            yield out
    return batches


# -- cutting --------------------------------------------------------------------------

def _cut_rows(it):
    """Texts and their repeats to joined spans and the bytes that stay."""
    for b in it:
        spans, sizes, kept = [], [0], []
        for text, found in zip(b.column("t"), b.column("found")):
            if not found.is_valid:
                sizes.append(sizes[-1])
                kept.append(text.as_py())
                continue
            begin = found.values.field("s").to_numpy()
            end = found.values.field("e").to_numpy()
            order = np.argsort(begin, kind="stable")
            begin, reach = begin[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], begin[1:] > reach[:-1]])
            starts = begin[new]
            ends = reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]
            flat = np.frombuffer(text.as_buffer(), np.uint8)
            turns = np.zeros(len(flat) + 1, np.int8)
            turns[starts] += 1
            turns[ends] -= 1
            kept.append(flat[np.cumsum(turns[:-1]) == 0].tobytes())
            spans.append(np.stack([starts, ends], axis=1))
            sizes.append(sizes[-1] + len(starts))
        all_ = np.concatenate(spans) if spans else np.empty((0, 2), np.int64)
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(all_[:, 0], pa.int64()), pa.array(all_[:, 1], pa.int64())], names=["start", "end"]))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), lists, pa.array(kept, pa.binary())],
                                         names=["doc_id", "n_bytes", "spans", "kept"])


def _placed(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``doc_id, t`` (bytes), ``n_bytes`` and ``ord``, the place of the document in the order."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).cast("binary").alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    dealt = stored(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "doc_id", "t", F.octet_length("t").cast("long").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), name)
    # Rows of a range are numbered from zero; one row per range (at most one per partition) says how many came before.
    place = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = dealt.withColumn("range", F.shiftright("row", 33))
    counts = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return dealt.join(F.broadcast(counts.select("range", "before")), "range").select(
        "doc_id", "t", "n_bytes", (F.col("before") + place).alias("ord"))


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT, cell: int = CELL, shard: int = SHARD,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (removed stretches ``[start, end)``
    of bytes, in order) and ``kept`` (the other bytes)."""
    if not 1 <= gram < width or 2 * width >= 1 << SPAN_BITS:
        raise ValueError(f"width must lie above gram and below {1 << SPAN_BITS - 1}")
    spark = docs.sparkSession
    base = _placed(docs, id_col, text_col, "passages-text")
    total = base.agg(F.sum("n_bytes")).first()[0] or 0
    expected = 2 * total // (width - gram + 2)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-expected // TASK_ROWS))
    rows = base.select("ord", "t").mapInArrow(_context_rows(width, gram), "fp long, ctx long, at long")
    rows = rows.repartition(parts, "fp").sortWithinPartitions("fp", "ctx", "at").mapInArrow(
        _repeats, "kind int, fp long, ctx long, at long, m long")
    rows = stored(rows, "passages-contexts")
    known = rows.filter("kind = 0").select("at", "m")
    firsts = rows.filter("kind = 1").select("fp", "at", "m", F.col("ctx").bitwiseAND(F.lit((1 << SPAN_BITS) - 1)).alias("a"))
    crowded = stored(firsts.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("fp"), "passages-hot")
    ord_ = F.shiftright("at", OFFSET_BITS)
    offset = F.col("at").bitwiseAND(F.lit((1 << OFFSET_BITS) - 1))
    texts = base.select("ord", "t")
    some = firsts.withColumn("ord", ord_).join(texts, "ord").select(
        "fp", "at", "m", "a", F.substring(F.col("t"), (offset + 1).cast("int"), (F.col("m") + width - 1).cast("int")).alias("c"))
    some = stored(some, "passages-strings")
    usual = some
    more = None
    if not crowded.isEmpty():
        usual = some.join(crowded, "fp", "left_anti")
        single = some.join(crowded, "fp", "left_semi").select("at", "c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("j")).select(
            F.substring(F.col("c"), (F.col("j") + 1).cast("int"), F.lit(width)).alias("w"), (F.col("at") + F.col("j")).alias("at"))
        first = single.groupBy("w").agg(F.min("at").alias("first"))
        more = single.join(first, "w").filter("at <> first").select("at", F.lit(1).cast("long").alias("m"))
    cells = usual.repartition(parts, "fp").sortWithinPartitions("fp", "at").mapInArrow(_cell_rows(width, gram, cell, shard), "at long, m long")
    found = known.unionByName(cells)
    if more is not None:
        found = found.unionByName(more)
    spans = found.select(ord_.alias("ord"), offset.alias("s"), (offset + F.col("m") + width - 1).alias("e"))
    spans = spans.groupBy("ord").agg(F.collect_list(F.struct("s", "e")).alias("found"))
    held = base.join(spans, "ord", "left").select("doc_id", "n_bytes", "t", "ord", "found")
    return held.mapInArrow(_cut_rows, "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
