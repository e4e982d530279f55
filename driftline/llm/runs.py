"""Periodic runs of words, found with suffix trees.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) of at least ``min_length`` words and two periods.  For a stretch of
words:

1. Ukkonen's algorithm builds the suffix tree of the words and the one of their
   reversal, each over word numbers with a closing sign below all of them.
2. An Euler tour of each tree with range minima over its depths answers longest
   common extensions (the depth of a lowest common ancestor) in constant time:
   minima of whole blocks in a sparse table, and of block ends beside it, so
   memory stays in proportion to the stretch.
3. The order of the leaves gives for every position the longest Lyndon word
   that begins there, in the order of the words and in the opposite one.  Each
   such word is the root of a candidate; it is extended to the right in the
   first tree and to the left in the second.  Candidates of two periods or more
   are exactly the runs (Bannai et al., *The runs theorem*, 2017).

Trees are built only where a run can lie.  A run of L words and period q repeats
L - q >= L / 2 of its words at distance q, so every group of
``ceil(min_length / 2)`` words in that part occurs again at distance q, at most
half a stretch away, and these groups cover the run without a gap.  Stretches
that no such groups cover are left out, which loses nothing; the groups are
compared by 64-bit hashes, whose collisions only make stretches longer.

Defined cases: null and empty texts have no words, no runs and an empty
collapsed text; repeated rows and ids are treated one by one; extra columns are
ignored; an empty table gives no rows.  A document is one row of one task, with
memory in proportion to its words.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import whole_text

MIN_LENGTH = 12
#: Tour places under one block minimum.
BLOCK = 16

RUN_FIELDS = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
OUT = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


# -- suffix trees ------------------------------------------------------------

def suffix_tree(s: list[int], width: int):
    """Ukkonen's tree of ``s``, which ends with a sign that occurs once.

    Returns ``(to, start, end, leaf)``: edges as ``node * width + sign -> child``,
    the label ``s[start:end]`` above each node, and the suffix number of each leaf
    (-1 for inner nodes).  Leaves are made in the order of their suffixes."""
    n = len(s)
    start, end, link, leaf = array("i", [0]), array("i", [0]), array("i", [0]), array("i", [-1])
    to: dict[int, int] = {}
    node = edge = length = pending = made = 0
    for i in range(n):
        sign, last = s[i], 0
        pending += 1
        while pending:
            if not length:
                edge = i
            key = node * width + s[edge]
            child = to.get(key)
            if child is None:
                to[key] = len(start)
                start.append(i), end.append(n), link.append(0), leaf.append(made)
                made += 1
                if last:
                    link[last] = node
                    last = 0
            else:
                a = start[child]
                size = min(end[child], i + 1) - a
                if length >= size:
                    edge += size
                    length -= size
                    node = child
                    continue
                if s[a + length] == sign:
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(start)
                to[key] = split
                start.append(a), end.append(a + length), link.append(0), leaf.append(-1)
                to[split * width + sign] = split + 1
                start.append(i), end.append(n), link.append(0), leaf.append(made)
                made += 1
                start[child] = a + length
                to[split * width + s[a + length]] = child
                if last:
                    link[last] = split
                last = split
            pending -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - pending + 1
    return to, start, end, leaf


class Extensions:
    """Longest common extensions of the suffixes of ``s`` (word numbers from 1)."""

    def __init__(self, s: list[int], width: int):
        n = len(s)
        to, start, end, leaf = suffix_tree(s + [0], width)
        keys = np.fromiter(to.keys(), np.int64, len(to))
        kids = np.fromiter(to.values(), np.int64, len(to))
        order = np.argsort(keys)                    # by node, then by sign
        parents = keys[order] // width
        bounds = np.searchsorted(parents, np.arange(len(start) + 1))
        kids, bounds = kids[order].tolist(), bounds.tolist()
        # Depths along an Euler tour; a node is noted before its first child and after each.
        tour, first, self.order = array("i"), array("i", bytes(4 * (n + 1))), array("i")
        stack = [(0, 0, bounds[0])]
        tour.append(0)
        while stack:
            node, depth, at = stack.pop()
            if at < bounds[node + 1]:
                stack.append((node, depth, at + 1))
                child = kids[at]
                below = depth + end[child] - start[child]
                if (suffix := leaf[child]) >= 0:
                    first[suffix] = len(tour)
                    self.order.append(suffix)
                    tour.append(below)
                    tour.append(depth)
                else:
                    tour.append(below)
                    stack.append((child, below, bounds[child]))
            elif stack:
                tour.append(stack[-1][1])
        self.first = np.frombuffer(first, np.int32)
        self._minima(np.frombuffer(tour, np.int32))

    def _minima(self, tour: np.ndarray) -> None:
        high = np.iinfo(np.int32).max
        blocks = -(-len(tour) // BLOCK)
        grid = np.full(blocks * BLOCK, high, np.int32)
        grid[:len(tour)] = tour
        grid = grid.reshape(blocks, BLOCK)
        self.tour = grid.ravel()
        self.from_left = np.minimum.accumulate(grid, axis=1).ravel()
        self.from_right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [grid.min(axis=1)]
        step = 1
        while 2 * step <= blocks:
            row = self.table[-1]
            self.table.append(np.minimum(row[:-step], row[step:]))
            step *= 2

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Signs that the suffixes at ``i`` and ``j`` (different ones) have in common."""
        a, b = self.first[i], self.first[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        bl, bh = low // BLOCK, high // BLOCK
        out = np.minimum(self.from_right[low], self.from_left[high])
        inside = np.flatnonzero(bl == bh)
        if len(inside):
            at, stop = low[inside], high[inside]
            best = self.tour[at]
            for _ in range(BLOCK - 1):
                at = np.minimum(at + 1, stop)
                best = np.minimum(best, self.tour[at])
            out[inside] = best
        between = bh - bl - 1
        level = np.frexp(np.maximum(between, 1))[1] - 1
        for k in np.unique(level[between > 0]):
            which = np.flatnonzero((between > 0) & (level == k))
            row = self.table[k]
            out[which] = np.minimum(out[which], np.minimum(row[bl[which] + 1], row[bh[which] - (1 << k)]))
        return out


def _next_below(rank: list[int]) -> np.ndarray:
    """For each place the next one with a smaller rank (the length where there is none)."""
    n = len(rank)
    out, stack = array("i", bytes(4 * n)), []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] if stack else n
        stack.append(i)
    return np.frombuffer(out, np.int32).astype(np.int64)


def stretch_runs(ids: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Runs ``(start, length, period)`` of word numbers, ordered by start, then period."""
    n = len(ids)
    names, numbers = np.unique(ids, return_inverse=True)
    s = (numbers + 1).tolist()
    width = len(names) + 1
    ahead = Extensions(s, width)
    rank = np.empty(n + 1, np.int64)
    rank[np.frombuffer(ahead.order, np.int32)] = np.arange(n + 1)
    up = rank[:n].tolist()
    place = np.arange(n)
    one, other = _next_below(up), _next_below([-x for x in up])
    closed = other < n              # in the opposite order the closing sign is above all: such a word would hold it
    i = np.concatenate([place, place[closed]])
    p = np.concatenate([one, other[closed]]) - i
    half = p <= n // 2
    i, p = i[half], p[half]
    right = np.zeros(len(i), np.int64)
    open_ = i + p < n
    right[open_] = ahead.lce(i[open_], (i + p)[open_])
    del ahead
    back = Extensions(s[::-1], width)
    left = np.zeros(len(i), np.int64)
    open_ = i > 0
    left[open_] = back.lce((n - i)[open_], (n - i - p)[open_])
    found = np.stack([i - left, p + left + right, p], axis=1)
    found = found[(found[:, 1] >= 2 * p) & (found[:, 1] >= min_length)]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


# -- where runs can lie --------------------------------------------------------

def _groups(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` neighbouring words (``h``: 64-bit hashes of words)."""
    out, size = h, 1
    while size < k:
        step = min(size, k - size)
        out = (out[:-step] ^ (out[:-step] >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + out[step:]
        size += step
    return out


def stretches(h: np.ndarray, min_length: int) -> list[tuple[int, int]]:
    """Stretches ``[begin, end)`` of a document that hold all its runs."""
    k = -(-min_length // 2)
    todo, out = [(0, len(h))], []
    while todo:
        begin, end = todo.pop()
        if end - begin < min_length:
            continue
        g = _groups(h[begin:end], k)
        flat = np.sort(g)
        if not (flat[1:] == flat[:-1]).any():
            continue
        order = np.argsort(g, kind="stable")
        near = (g[order[1:]] == g[order[:-1]]) & (np.diff(order) <= (end - begin) // 2)
        marked = np.zeros(end - begin + 1, np.int64)
        for side in (order[1:][near], order[:-1][near]):
            np.add.at(marked, side, 1)
            np.add.at(marked, side + k, -1)
        covered = np.concatenate([[0], np.cumsum(marked[:-1]) > 0, [0]]).astype(np.int8)
        turns = np.diff(covered)
        found = list(zip((np.flatnonzero(turns == 1) + begin).tolist(), (np.flatnonzero(turns == -1) + begin).tolist()))
        if found == [(begin, end)]:
            out.append((begin, end))
        else:
            todo.extend(found)
    return sorted(out)


def find_runs(words: list[bytes], min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs ``(start, length, period)`` of a document's words."""
    parts = []
    if len(words) >= min_length:
        h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
        with np.errstate(over="ignore"):
            places = stretches(h, min_length)
        for begin, end in places:
            piece = words[begin:end]
            number = {w: i for i, w in enumerate(set(piece))}
            ids = np.fromiter(map(number.__getitem__, piece), np.int64, end - begin)
            found = stretch_runs(ids, min_length)
            if len(found):
                parts.append(found + [begin, 0, 0])
    if not parts:
        return np.empty((0, 3), np.int64)
    runs = np.concatenate(parts)
    return runs[np.lexsort([runs[:, 2], runs[:, 0]])]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run repeats: each run keeps its first period."""
    if not len(runs):
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(drop[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, runs`` (``start, length, period`` by
    start, then period) and ``collapsed``, the text without repeated periods, its
    words joined by single spaces."""
    def batches(it):
        for b in it:
            counts, sizes, found, texts = [], [0], [], []
            for text in b.column("text"):
                words = text.as_py().encode().split()        # bytes split at space and 0x09-0x0D alone
                runs = find_runs(words, min_length)
                counts.append(len(words))
                sizes.append(sizes[-1] + len(runs))
                found.append(runs)
                texts.append(collapse(words, runs).decode())
            runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(runs[:, c], pa.int64()) for c in range(3)], fields=list(RUN_FIELDS)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), lists, pa.array(texts, pa.string())],
                                             names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")).mapInArrow(batches, OUT)
