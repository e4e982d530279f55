"""Phrase collocation mining by direct-address tiling.

Texts are cut into pieces and words; every language is counted on its own.  The
words of a language get numbers by frequency.  Neighbouring numbers form pairs;
the plane of all pairs is cut into square tiles of ``TILE`` by ``TILE``.  Because
low numbers are frequent, the tiles in the corner are full and are counted in
dense arrays (``numpy.bincount``), the others are sparse and are counted as
sorted coordinate lists.  Pairs with at least ``min_count`` occurrences are
numbered by frequency in turn and take the place of the words: two overlapping
pairs make a phrase of three words, two overlapping phrases of three one of four,
each level counted by the same tiles.  A phrase can only be frequent if both of
its overlapping parts are, so nothing is lost.

In Spark: a *block* is up to ``BLOCK_WORDS`` words of one language, written to the
shared folder with its own small word numbers.  On each level a block sends
its distinct pairs with their counts, one row per *bucket* of tiles; buckets are
summed (groups of ``FAN`` blocks first, so a bucket's task holds a bounded number
of rows), frequent pairs are numbered by a range sort, and every block gets the
numbers of its own pairs back by a shuffle.  Nothing is broadcast, and neither
the driver nor any task holds the words, pairs or phrases of a language.

Defined cases: null text counts as empty, null language as ``und``; repeated rows
count as often as they occur; other columns are ignored; texts without words and
empty tables give no phrases.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import numbered, stored, whole_text

MIN_COUNT, MAX_WORDS, TOP = 30, 4, 2000
KEEP_RATIO = (100, 80)
#: Words of one block; blocks whose rows meet in one task; numbers along a tile's side (a power of two).
BLOCK_WORDS, FAN, TILE_BITS = 1 << 20, 64, 10
CELL_BITS = 2 * TILE_BITS
#: A tile with more entries than one in so many cells is counted densely.
DENSE = 16
#: Rows of pairs for one task, and the buckets that gives at least.
BUCKET_PAIRS, LEAST_BUCKETS = 2_000_000, 12

#: `.,;:!?` and 0x0A-0x0D end a piece, space and tab a word, A-Z become small letters.
_SIGNS = bytes(0x2E if c in b".,;:!?" or 0x0A <= c <= 0x0D else 0x20 if c == 0x09 else c + 32 if 65 <= c <= 90 else c
               for c in range(256))
BLOCKS = "block long, lang string, words array<binary>, counts array<long>, ids binary"
IDS = "block long, lang string, words long, ids binary"
PAIRS = "lang string, bucket int, part long, block long, keys binary, counts binary"
NUMBERS = "block long, keys binary, ids binary"


# -- rows of numbers ------------------------------------------------------------

def _press(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes())


def _numbers(data: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _press_keys(keys: np.ndarray) -> bytes:
    """Ordered keys as steps, which are short."""
    return _press(np.diff(keys, prepend=0))


def _keys(data: bytes) -> np.ndarray:
    return np.cumsum(_numbers(data))


# -- blocks ------------------------------------------------------------------

def _block(number: int, lang: str, tokens: list[bytes]):
    stop = b"."
    names = set(tokens)
    names.discard(stop)
    names = sorted(names)
    number_of = {w: i for i, w in enumerate(names)}
    number_of[stop] = -1
    ids = np.fromiter(map(number_of.__getitem__, tokens), np.int32, len(tokens))
    counts = np.bincount(ids[ids >= 0], minlength=len(names)).tolist()
    return number, lang, names, counts, _press(ids)


def word_blocks(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """Blocks of words: ``ids`` are places in ``words``, -1 ends a piece."""
    def batches(it):
        made = TaskContext.get().partitionId() << 32
        waiting: dict[str, list[bytes]] = {}
        held = 0

        def flush(langs):
            nonlocal made
            rows = []
            for lang in langs:
                tokens = waiting.pop(lang)
                if any(t != b"." for t in tokens):
                    rows.append(_block(made, lang, tokens))
                    made += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows) if rows else [[]] * 5,
                (pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()))],
                names=["block", "lang", "words", "counts", "ids"])

        for b in it:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                got = text.as_py().encode().translate(_SIGNS).replace(b".", b" . ").split(b" ")
                got = [t for t in got if t]
                mine = waiting.setdefault(lang, [])
                mine += got
                mine.append(b".")
                held += len(got) + 1
                if len(mine) >= BLOCK_WORDS:
                    held -= len(mine)
                    yield flush([lang])
                elif held >= 4 * BLOCK_WORDS:       # many languages: all that wait
                    held = 0
                    yield flush(sorted(waiting))
        yield flush(sorted(waiting))

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(batches, BLOCKS)


# -- tiles ---------------------------------------------------------------------

def tile_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number per pair, ordered by tile, then by place in the tile."""
    a, b, low = first.astype(np.int64), second.astype(np.int64), (1 << TILE_BITS) - 1
    return ((a >> TILE_BITS) << (CELL_BITS + 20)) | ((b >> TILE_BITS) << CELL_BITS) | ((a & low) << TILE_BITS) | (b & low)


def pair_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, tile_low = (1 << TILE_BITS) - 1, (1 << 20) - 1
    return (((keys >> (CELL_BITS + 20)) << TILE_BITS) | ((keys >> TILE_BITS) & low),
            (((keys >> CELL_BITS) & tile_low) << TILE_BITS) | (keys & low))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    tiles = (keys >> CELL_BITS).view(np.uint64)
    mixed = (tiles ^ (tiles >> np.uint64(20))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def add_tiles(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sum counts of tile keys over ``parts``, each of them ordered and without
    repeats: dense tiles by direct addresses, the rest as one sorted list."""
    if len(parts) == 1:
        return parts[0]
    sizes: dict[int, int] = {}
    cuts = []
    for keys, _ in parts:
        tiles, at = np.unique(keys >> CELL_BITS, return_index=True)
        cuts.append((tiles, np.append(at, len(keys))))
        for t, n in zip(tiles.tolist(), np.diff(cuts[-1][1]).tolist()):
            sizes[t] = sizes.get(t, 0) + n
    dense = sorted(t for t, n in sizes.items() if n > (1 << CELL_BITS) // DENSE)
    out_keys, out_counts = [], []
    for t in dense:
        total = np.zeros(1 << CELL_BITS, np.int64)
        for (keys, counts), (tiles, at) in zip(parts, cuts):
            k = np.searchsorted(tiles, t)
            if k < len(tiles) and tiles[k] == t:
                cells = keys[at[k]:at[k + 1]] & ((1 << CELL_BITS) - 1)
                # whole numbers below 2^53 are exact in bincount's weights
                total += np.bincount(cells, counts[at[k]:at[k + 1]], 1 << CELL_BITS).astype(np.int64)
        cells = np.flatnonzero(total)
        out_keys.append((np.int64(t) << CELL_BITS) | cells)
        out_counts.append(total[cells])
    rest_keys, rest_counts = [], []
    for keys, counts in parts:
        sparse = ~np.isin(keys >> CELL_BITS, dense) if dense else slice(None)
        rest_keys.append(keys[sparse]), rest_counts.append(counts[sparse])
    keys, counts = np.concatenate(rest_keys), np.concatenate(rest_counts)
    if len(keys):
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        out_keys.append(keys[at]), out_counts.append(np.add.reduceat(counts, at))
    keys, counts = np.concatenate(out_keys), np.concatenate(out_counts)
    order = np.argsort(keys, kind="stable")
    return keys[order], counts[order]


def _neighbours(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose number and next number both count, and the keys of these pairs."""
    at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
    return at, tile_keys(ids[at], ids[at + 1])


def _pair_rows(buckets: int, groups: int):
    """Blocks to rows of distinct pairs, one per bucket; ``part`` deals blocks to ``groups``."""
    def batches(it):
        for b in it:
            for block, lang, ids in zip(*(b.column(c).to_pylist() for c in ("block", "lang", "ids"))):
                _, keys = _neighbours(_numbers(ids, np.int32))
                keys, counts = np.unique(keys, return_counts=True)
                where = _bucket(keys, buckets)
                order = np.argsort(where, kind="stable")
                keys, counts, where = keys[order], counts[order].astype(np.int64), where[order]
                at = np.append(np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(where) else [], len(where)).astype(int)
                part = zlib.crc32(str(block).encode()) % groups
                rows = [(lang, int(where[x]), part, block, _press_keys(keys[x:y]), _press(counts[x:y]))
                        for x, y in zip(at[:-1], at[1:])]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                        names=["lang", "bucket", "part", "block", "keys", "counts"])
    return batches


def _groups_of(it, columns: tuple[str, ...]):
    """Rows of ordered batches, gathered by equal values of ``columns``."""
    now, rows = None, []
    for b in it:
        for r in b.to_pylist():
            key = tuple(r[c] for c in columns)
            if rows and key != now:
                yield now, rows
                rows = []
            now = key
            rows.append(r)
    if rows:
        yield now, rows


def _sum_rows(it):
    """Rows of one (language, bucket, part) to one row."""
    for (lang, bucket, part), rows in _groups_of(it, ("lang", "bucket", "part")):
        keys, counts = add_tiles([(_keys(r["keys"]), _numbers(r["counts"])) for r in rows])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([bucket], pa.int32()), pa.array([part], pa.int64()), pa.array([0], pa.int64()),
             pa.array([_press_keys(keys)], pa.binary()), pa.array([_press(counts)], pa.binary())],
            names=["lang", "bucket", "part", "block", "keys", "counts"])


def _frequent_rows(least: int):
    def batches(it):
        for b in it:
            for lang, bucket, keys, counts in zip(*(b.column(c).to_pylist() for c in ("lang", "bucket", "keys", "counts"))):
                keys, counts = _keys(keys), _numbers(counts)
                often = counts >= least
                keys, counts = keys[often], counts[often]
                one, two = pair_of(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array([bucket] * len(keys), pa.int32()), pa.array(keys),
                     pa.array(one), pa.array(two), pa.array(counts)], names=["lang", "bucket", "key", "one", "two", "f"])
    return batches


def _return_rows(it):
    """For each bucket its numbered pairs (``block`` null, first), then the rows of
    the blocks: each block's frequent pairs with their numbers."""
    have, keys, ids = None, None, None
    for b in it:
        for r in b.to_pylist():
            mine = (r["lang"], r["bucket"])
            if r["block"] is None:
                have = mine
                keys, ids = np.array(r["given"]["key"], np.int64), np.array(r["given"]["id"], np.int64)     # ordered
            elif have == mine:
                got = _keys(r["keys"])
                at = np.minimum(np.searchsorted(keys, got), len(keys) - 1)
                hit = keys[at] == got
                if hit.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["block"]], pa.int64()), pa.array([_press_keys(got[hit])], pa.binary()),
                         pa.array([_press(ids[at[hit]].astype(np.int32))], pa.binary())], names=["block", "keys", "ids"])


def _next_blocks(it):
    """A block's numbers of this level (``lang`` set) and of its pairs (null): the
    numbers of the next level, at the places where the phrases begin."""
    for (block,), rows in _groups_of(it, ("block",)):
        own = [r for r in rows if r["lang"] is not None]
        back = [r for r in rows if r["lang"] is None]
        if not own or not back:
            continue                                # no frequent pair
        ids = _numbers(own[0]["ids"], np.int32)
        keys = np.concatenate([_keys(r["keys"]) for r in back])
        numbers = np.concatenate([_numbers(r["ids"], np.int32) for r in back])
        order = np.argsort(keys)
        keys, numbers = keys[order], numbers[order]
        at, got = _neighbours(ids)
        found = np.minimum(np.searchsorted(keys, got), len(keys) - 1)
        hit = keys[found] == got
        out = np.full(len(ids), -1, np.int32)
        out[at[hit]] = numbers[found[hit]]
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([own[0]["lang"]]), pa.array([int((out >= 0).sum())], pa.int64()),
                                          pa.array([_press(out)], pa.binary())], names=["block", "lang", "words", "ids"])


def _ordered(df: DataFrame, by: list[str], then: list, parts: int) -> DataFrame:
    return df.repartition(parts, *by).sortWithinPartitions(*by, *then)


def _parts(spark) -> int:
    return max(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))


def count_pairs(blocks: DataFrame, min_count: int, name: str, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Frequent pairs ``(lang, id, one, two, f)`` of blocks of numbers, ``id`` by
    frequency, and (unless ``last``) the blocks with these numbers."""
    size = blocks.agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("n")).first()
    parts = max(_parts(blocks.sparkSession), -(-(size["words"] or 0) // BUCKET_PAIRS))
    groups = -(-max(1, size["n"]) // FAN)
    rows = stored(blocks.mapInArrow(_pair_rows(parts, groups), PAIRS), f"{name}-pairs")
    sums = rows
    while groups > 1:                               # at most FAN rows of a bucket meet at a time, as a tree
        sums = stored(_ordered(sums, ["lang", "bucket", "part"], [], parts).mapInArrow(_sum_rows, PAIRS), f"{name}-sums")
        groups = -(-groups // FAN)
        sums = sums.withColumn("part", F.col("part") % groups)
    sums = _ordered(sums, ["lang", "bucket"], ["part"], parts).mapInArrow(_sum_rows, PAIRS)
    often = stored(sums.mapInArrow(_frequent_rows(min_count), "lang string, bucket int, key long, one long, two long, f long"), f"{name}-often")
    often = numbered(often, ["lang"], [F.col("f").desc(), F.col("key")], f"{name}-numbers")
    if last:
        return often, None
    given = (often.groupBy("lang", "bucket").agg(F.sort_array(F.collect_list(F.struct("key", "id"))).alias("p"))
             .select("lang", "bucket", F.struct(F.col("p.key").alias("key"), F.col("p.id").alias("id")).alias("given")))
    both = (given.withColumn("block", F.lit(None).cast("long")).withColumn("keys", F.lit(None).cast("binary"))
            .unionByName(rows.select("lang", "bucket", "block", "keys", F.lit(None).cast(given.schema["given"].dataType).alias("given"))))
    back = _ordered(both, ["lang", "bucket"], [F.col("block").asc_nulls_first()], parts).mapInArrow(_return_rows, NUMBERS)
    mine = blocks.select("block", "lang", "ids", F.lit(None).cast("binary").alias("keys")).unionByName(
        back.select("block", F.lit(None).cast("string").alias("lang"), "ids", "keys"))
    after = _ordered(mine, ["block"], [F.col("lang").asc_nulls_last()], parts).mapInArrow(_next_blocks, IDS)
    return often, stored(after, f"{name}-blocks")


def _number_words(it):
    """A block's own word places to numbers by frequency (rare words: -1)."""
    for b in it:
        out, words = [], []
        for ids, size, given in zip(*(b.column(c) for c in ("ids", "size", "given"))):
            table = np.full(size.as_py() + 1, -1, np.int32)         # the last entry serves the end of a piece
            if given.is_valid:
                table[given["local"].values.to_numpy()] = given["id"].values.to_numpy()
            table = table[_numbers(ids.as_py(), np.int32)]
            words.append(int((table >= 0).sum()))
            out.append(_press(table))
        yield pa.RecordBatch.from_arrays([b.column("block"), b.column("lang"), pa.array(words, pa.int64()), pa.array(out, pa.binary())],
                                         names=["block", "lang", "words", "ids"])


def count_words(blocks: DataFrame, min_count: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words of a language (``lang, n``), frequent words ``(lang, id, word, f)`` and
    the blocks with their numbers."""
    words = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "w")).select(
        "block", "lang", "local", F.col("w.words").alias("word"), F.col("w.counts").alias("c"))
    totals = stored(words.groupBy("lang", "word").agg(F.sum("c").alias("f")), "phrase-words")
    often = numbered(totals.filter(F.col("f") >= min_count), ["lang"], [F.col("f").desc(), F.col("word")], "phrase-vocabulary")
    given = (words.select("block", "lang", "word", "local").join(often.select("lang", "word", "id"), ["lang", "word"])
             .groupBy("block").agg(F.collect_list(F.struct("local", F.col("id").cast("int").alias("id"))).alias("p"))
             .select("block", F.struct(F.col("p.local").alias("local"), F.col("p.id").alias("id")).alias("given")))
    known = blocks.select("block", "lang", "ids", F.size("words").alias("size")).join(given, "block", "left")
    numbers = stored(known.mapInArrow(_number_words, IDS), "phrase-blocks")
    return totals.groupBy("lang").agg(F.sum("f").alias("n")), often, numbers


# -- phrases ---------------------------------------------------------------------

def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, lang_col: str = "lang",
                     text_col: str = "text") -> tuple[DataFrame, list[DataFrame]]:
    """Words per language ``(lang, n)``, and for each length from 1 to ``max_words``
    the frequent phrases: ``lang, id, phrase, f``, ``heads`` and ``tails`` (counts of
    its first and its last 1, 2, ... words), ``tail`` (its last word) and, from two
    words on, ``one`` and ``two`` (the numbers of the phrases it is made of)."""
    blocks = stored(word_blocks(docs, lang_col, text_col), "phrase-text")
    n, words, level = count_words(blocks, min_count)
    out = [words.select("lang", "id", F.col("word").cast("string").alias("phrase"), "f", F.array("f").alias("heads"),
                        F.array("f").alias("tails"), F.col("word").cast("string").alias("tail"))]
    for m in range(2, max_words + 1):
        pairs, level = count_pairs(level, min_count, f"phrase-{m}", m == max_words)
        one, two = (out[-1].select("lang", F.col("id").alias(side), F.struct("phrase", "heads", "tails", "tail").alias(f"p_{side}"))
                    for side in ("one", "two"))
        made = pairs.join(one, ["lang", "one"]).join(two, ["lang", "two"])
        out.append(stored(made.select(
            "lang", "id", F.concat_ws(" ", "p_one.phrase", "p_two.tail").alias("phrase"), "f",
            F.concat("p_one.heads", F.array("f")).alias("heads"), F.concat("p_two.tails", F.array("f")).alias("tails"),
            F.col("p_two.tail").alias("tail"), "one", "two"), f"phrase-{m}"))
    return n, out


def scored(phrases: DataFrame, m: int) -> DataFrame:
    """The cut of each phrase of ``m`` words with the lowest score (then the shortest first part)."""
    cuts = []
    for k in range(1, m):
        left, right = F.element_at("heads", k), F.element_at("tails", m - k)
        score = F.expr(f"(cast(f as decimal(20,0)) * 2000000) div cast(heads[{k - 1}] + tails[{m - k - 1}] as decimal(20,0))")
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    best = F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]
    return phrases.select("lang", "id", "phrase", F.col("f").alias("a"), best.alias("best"))


def mine_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 keep_ratio: tuple[int, int] = KEEP_RATIO, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Each language's best ``top`` phrases of 2 to ``max_words`` words:
    ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is left out if one that holds it has ``keep_ratio`` (100 to 80: four
    fifths) of its occurrences.  It is enough to look at phrases one word longer: a
    longer one that does lies around one of those, which occurs at least as often."""
    n, levels = frequent_phrases(docs, min_count, max_words, lang_col, text_col)
    times, least = keep_ratio
    found = None
    for m in range(2, max_words + 1):
        rows = scored(levels[m - 1], m)
        if m < max_words:
            longer = levels[m]
            around = longer.select("lang", F.col("one").alias("id"), "f").unionByName(longer.select("lang", F.col("two").alias("id"), "f"))
            around = around.groupBy("lang", "id").agg(F.max("f").alias("around"))
            rows = rows.join(around, ["lang", "id"], "left").filter(F.expr(
                f"around is null or cast(around as decimal(20,0)) * {times} < cast(a as decimal(20,0)) * {least}"))
        rows = rows.select("lang", "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score"))
        found = rows if found is None else found.unionByName(rows)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # The best of 64 parts of a language first, so that no task sorts a whole language.
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    found = found.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    found = found.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return found.filter(F.col("rank") <= top).join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
