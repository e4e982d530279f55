"""LM scoring by a gated recurrent language model.

Words are lower-cased (A-Z); every text ends with one end token.

Counts: the training documents' words are counted in full (workers pre-count,
Spark sums).  Words with at least 1 / ``HEAD_SHARE`` of all tokens number at most
``HEAD_SHARE``, so their counts go to every task; the counts of all other words
stay in a table that the documents' rare words are joined with.

Model: a gated recurrent unit reads the words; a class-factored softmax predicts
P(class | state) P(word | class, state) for every word whose count travels with the
tasks, in classes of about equal mass, the square root of the words in number.  One
more class stands for all other words, none of which has 1 / ``HEAD_SHARE`` of the tokens; inside it a word has its discounted share of the training tokens of such
words, and one unknown word the discounted rest, so probabilities add up to one.

Training: truncated backpropagation through time in numpy.  The corpus trains
it in parts: every task of a Spark job trains a copy on its documents' words, end
tokens included, laid end to end and cut into windows of ``WINDOW`` words; the
state begins anew with each window and each document, and the last window is
filled up with steps that have no target.  The copies are averaged by the tokens
they learnt from, for ``PASSES`` passes.  With ``TRAIN_EVERY`` = 1 every token of
every training document is a target once a pass.

Scoring: documents run side by side in lanes; the state is carried from window
to window, so a document's log-likelihood is that of the whole text.  Words
outside the vocabulary enter the recurrence as one symbol.

Defined cases: null text is an empty text (one end token); without training
tokens the counts are zero and the score equals the base; a text of any length
is scored in windows; repeated rows score alike; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fold_of, stored, whole_text

HELD_OUT = (7, 2)
#: Bound on the words whose counts travel with the tasks.
HEAD_SHARE = 1 << 18
#: The end token's name among the words; it holds white space, so no word equals it.
END = b" "
#: Units of the state and of a word's input.
HIDDEN, EMBED = 8, 8
#: Words of a window, windows of a training step, documents side by side in scoring.
WINDOW, LANES, SCORE_LANES = 32, 512, 512
#: States that are scored together; logits worked out at a time, so that they stay in the cache.
SCORE_STATES, CELLS = 1 << 16, 40_000
TRAIN_EVERY, PASSES, RATE = 1, 1, 0.03
#: Discount of the counts inside the class of other words.
DISCOUNT = 0.6
#: Bytes of texts whose words are counted together, are looked up together, and are scored together.
COUNT_BYTES, PART_BYTES, SCORE_BYTES = 8 << 20, 4 << 20, 16 << 20
#: Bytes of a block whose freeing tells the C library to keep a step's memory (glibc takes note up to 32 MB).
KEPT = 31 << 20


def words_of(text: bytes) -> list[bytes]:
    # bytes.lower() folds A-Z only, bytes.split() cuts at space and 0x09-0x0D only
    return text.lower().split()


def portions(texts: Iterable[pa.Array], most: int) -> Iterator[pa.Array]:
    """The same texts in arrays of about ``most`` bytes, more only by the last text of one."""
    held, size = [], 0
    for part in texts:
        upto = np.cumsum(pc.binary_length(part).to_numpy() + np.int64(1))       # each with its end
        at = 0
        while at < len(part):
            before = int(upto[at - 1]) if at else 0
            stop = min(int(np.searchsorted(upto, before + most - size)) + 1, len(part))
            held.append(part.slice(at, stop - at))
            size, at = size + int(upto[stop - 1]) - before, stop
            if size >= most:
                yield pa.concat_arrays(held)
                held, size = [], 0
    if held:
        yield pa.concat_arrays(held)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` all the texts laid end to end, and the number of words up to each text's end.

    Arrow's kernels fold and cut at the same bytes, but leave an empty word where
    a text begins or ends with white space, or has none."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, upto = lists.flatten().cast(pa.binary()), lists.offsets.to_numpy()[1:]
    there = pc.binary_length(words).to_numpy() > 0
    if not there.all():
        upto = np.concatenate([[0], np.cumsum(there)])[upto]
        words = words.filter(pa.array(there))
    return words, upto


def look_up(words: pa.Array, names: pa.Array) -> np.ndarray:
    """Each word's place among the names; their number where it is not there."""
    return pc.index_in(words, value_set=names).fill_null(len(names)).to_numpy()


def with_ends(ids: np.ndarray, upto: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words with ``end`` after each text, and where each text ends then."""
    ends = upto + np.arange(1, len(upto) + 1)
    out, word = np.full(len(ids) + len(ends), end, np.int32), np.ones(len(ids) + len(ends), bool)
    word[ends - 1] = False
    out[word] = ids
    return out, ends


# -- counts ------------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for texts in portions((b.column("t") for b in batches), COUNT_BYTES):
        seen = pc.value_counts(split_words(texts)[0])
        yield pa.RecordBatch.from_arrays([pa.concat_arrays([seen.field("values"), pa.array([END], pa.binary())]),
                                          pa.concat_arrays([seen.field("counts"), pa.array([len(texts)], pa.int64())])],
                                         names=["word", "c"])


def training_docs(docs: DataFrame) -> DataFrame:
    modulus, held = HELD_OUT
    return docs.filter(fold_of("doc_id", modulus) != held).select("doc_id", whole_text().alias("t"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, c)`` over all training documents, every word and the end token."""
    partial = training_docs(docs).select("t").mapInArrow(_count, "word binary, c long")
    return stored(partial.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


class Vocabulary:
    """The bounded part of the counts: heads, classes, and what the rest sums to."""

    def __init__(self, head: dict[bytes, int], total: int, distinct: int, vocab: int | None = None, classes: int | None = None):
        self.head, self.total, self.distinct = head, total, distinct
        self.log_base = math.log10(total + distinct + 1)
        top = sorted(head.items(), key=lambda x: (-x[1], x[0]))[:vocab]
        self.number = {w: i for i, (w, _) in enumerate(top)}
        self.names = pa.array(list(self.number), pa.binary())
        self.size = len(top)                       # number `size` is "another word"
        mass = np.array([c for _, c in top], float)
        self.classes = max(1, min(classes or math.isqrt(self.size), self.size))
        # classes of about equal square-root mass, so that none gets too long
        upto = np.cumsum(np.sqrt(mass)) if self.size else np.zeros(0)
        self.cls = np.minimum((upto - np.sqrt(mass) / 2) / (upto[-1] if self.size else 1) * self.classes,
                              self.classes - 1).astype(np.int64)
        self.first = np.searchsorted(self.cls, np.arange(self.classes + 1))
        self.other_tokens = total - int(mass.sum())
        self.other_words = distinct - self.size
        self.log_counts = np.log(np.concatenate([mass, [max(1, self.other_tokens)]])) if self.size else np.zeros(1)

    def log_other(self, c: int) -> float:
        """Natural log of a word's share of the class of other words; c = 0: the unknown word."""
        if self.other_tokens <= 0:
            return 0.0
        mass = DISCOUNT * self.other_words if c == 0 else c - DISCOUNT
        return math.log(max(mass, 1e-12) / self.other_tokens)


def vocabulary(counts: DataFrame, vocab: int | None = None, classes: int | None = None) -> Vocabulary:
    """Without ``vocab`` the network has a symbol for every head word."""
    facts = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    head = counts.filter(F.col("c") * HEAD_SHARE >= facts["n"])           # at most HEAD_SHARE words
    return Vocabulary({bytes(r["word"]): r["c"] for r in head.toLocalIterator()}, facts["n"], facts["v"], vocab, classes)


# -- the network -------------------------------------------------------------

def start(v: Vocabulary, seed: int = 1) -> dict:
    rng, h = np.random.default_rng(seed), HIDDEN

    def draw(*shape):
        return (rng.normal(0, 1, shape) / math.sqrt(shape[0])).astype(np.float32)
    class_mass = np.array([np.exp(v.log_counts[v.first[k]:v.first[k + 1]]).sum() for k in range(v.classes)])
    return {"embed": draw(EMBED, v.size + 1).T.copy(), "wx": draw(EMBED, 3 * h), "wh": draw(h, 3 * h),
            "b": np.zeros(3 * h, np.float32), "class_w": draw(h, v.classes + 1) * np.float32(0.1),
            # both softmaxes begin near the words' frequencies (weights of zero would keep the first
            # step's gradients from the recurrence)
            "class_b": np.log(np.maximum(np.concatenate([class_mass, [v.other_tokens]]), 0.5)).astype(np.float32),
            "word_w": draw(h, v.size).T.copy() * np.float32(0.1), "word_b": v.log_counts[:v.size].astype(np.float32)}


def sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def step(gx: np.ndarray, s: np.ndarray, wh: np.ndarray):
    """One recurrence: update and reset gates, candidate, new state.  The gates are columns:
    it is quickest where ``gx`` and ``s`` hold theirs together (transposes of units x lanes)."""
    h = s.shape[1]
    a = (wh.T @ s.T).T
    gates = sigmoid(gx[:, :2 * h] + a[:, :2 * h])
    z, r = gates[:, :h], gates[:, h:]
    cand = np.tanh(gx[:, 2 * h:] + r * a[:, 2 * h:])
    return z * s + (1 - z) * cand, z, r, cand, a[:, 2 * h:]


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


class Targets:
    """States and targets in order of the targets: the rows of a class of words lie
    together, those of the other words come last.  States have a last column of ones,
    which stands for the biases."""

    def __init__(self, v: Vocabulary, states: np.ndarray, target: np.ndarray):
        self.by = np.argsort(target.astype(np.int16 if v.size < 32_000 else np.int32), kind="stable")
        self.target = target[self.by]
        seen = np.ones((len(states), states.shape[1] + 1), states.dtype)
        seen[:, :-1] = states
        self.seen = seen.take(self.by, axis=0)
        self.edges = np.append(np.searchsorted(self.target, v.first), len(target))
        self.k = np.repeat(np.arange(v.classes + 1), np.diff(self.edges))
        # rows whose class has a choice of words, and (its words, its rows) for each such class
        choice = np.append(np.diff(v.first) > 1, False)
        self.chosen = choice[self.k]
        self.parts = [(int(v.first[c]), int(v.first[c + 1]), int(self.edges[c]), int(self.edges[c + 1]))
                      for c in np.flatnonzero(choice & (np.diff(self.edges) > 0))]

    def back_in_order(self, x: np.ndarray) -> np.ndarray:
        out = np.empty_like(x)
        out[self.by] = x
        return out


def keep_memory() -> None:
    """A step's arrays are freed and made again at once.  glibc gives freed memory back to the
    system, which then has to clear the pages anew, unless a block of more than half as much
    was freed before; this frees one, untouched.  It changes speed only."""
    np.empty(KEPT, np.uint8)


class Softmax:
    """Weights of one softmax, or of all classes' softmaxes: a row each, its bias last."""

    def __init__(self, w: np.ndarray, bias: np.ndarray):
        self.w = np.concatenate([w, bias[:, None]], axis=1)
        self.down = np.ascontiguousarray(self.w.T)
        self.by_state = np.concatenate([w, np.ones((len(w), 1), w.dtype)], axis=1)
        # Logits stay small (states lie within -1 and 1); rows are only centred where one may be large.
        self.large = bool(len(w)) and float((np.abs(self.w) @ np.ones(self.w.shape[1], w.dtype)).max()) > 60
        self.room = np.empty(0, w.dtype)

    def exponentials(self, seen: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray | float]:
        """exp of the logits of rows ``a`` to ``b``, and what was taken off them before.
        They lie in the same room each time, so they are to be used before the next ones."""
        n, kind = len(seen) * (b - a), np.result_type(seen, self.w)
        if n > len(self.room) or kind != self.room.dtype:
            self.room = np.empty(max(n, CELLS), kind)
        x, off = np.matmul(seen, self.down[:, a:b], out=self.room[:n].reshape(len(seen), b - a)), 0.0
        if self.large:
            off = x.max(axis=1)
            x -= off[:, None]
        return np.exp(x, out=x), off


def softmaxes(p: dict) -> tuple[Softmax, Softmax]:
    return Softmax(p["class_w"].T, p["class_b"]), Softmax(p["word_w"], p["word_b"])


def pieces(low: int, high: int, width: int) -> Iterator[tuple[int, int]]:
    rows = max(64, CELLS // max(1, width))
    return ((i, min(i + rows, high)) for i in range(low, high, rows))


def own_logits(t: Targets, classes: Softmax, words: Softmax) -> np.ndarray:
    """The logits of each target's class and, inside it, word."""
    out = np.einsum("ij,ij->i", t.seen, classes.w.take(t.k, axis=0))
    out[t.chosen] += np.einsum("ij,ij->i", t.seen[t.chosen], words.w.take(t.target[t.chosen], axis=0))
    return out


def output_log(p: dict, v: Vocabulary, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural log of P(class) P(word | class) of each target given the state before it
    (of a word outside the vocabulary: P(other class) alone)."""
    t, (classes, words) = Targets(v, states, target), softmaxes(p)
    logp = own_logits(t, classes, words)
    for softmax, parts in ((classes, [(0, len(classes.w), 0, len(target))]), (words, t.parts)):
        ones = np.ones(max((b - a for a, b, _, _ in parts), default=0), states.dtype)
        for a, b, low, high in parts:
            for i, j in pieces(low, high, b - a):
                e, off = softmax.exponentials(t.seen[i:j], a, b)
                logp[i:j] -= np.log(e @ ones[:b - a]) + off
    return t.back_in_order(logp)


def output_gradients(p: dict, v: Vocabulary, states: np.ndarray, target: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """The sum of the losses -log P(target), its gradients by the weights of both
    softmaxes, and by the states."""
    h = states.shape[1]
    t, (classes, words) = Targets(v, states, target), softmaxes(p)
    chosen = t.target[t.chosen]
    # By units, rows: what is done to each row's sum runs over all rows.
    by_unit = np.ascontiguousarray(t.seen.T)
    back, loss, grads = np.zeros((h, len(target)), states.dtype), 0.0, []
    for softmax, parts in ((classes, [(0, len(classes.w), 0, len(target))]), (words, t.parts)):
        g, got = np.zeros_like(softmax.down), np.zeros((len(target), h + 1), states.dtype)
        got[:, h] = 1
        for a, b, low, high in parts:
            by_state = softmax.by_state[a:b]
            for i, j in pieces(low, high, b - a):
                # The chances are never divided by their sums themselves, only what they are multiplied to.
                e, off = softmax.exponentials(t.seen[i:j], a, b)
                r = np.matmul(e, by_state, out=got[i:j])            # the last column: the sums
                g[:, a:b] += (by_unit[:, i:j] / r[:, h]) @ e
                if softmax.large:
                    loss += float(off.sum())
        got = np.ascontiguousarray(got.T)
        back += got[:h] / got[h]
        loss += float(np.log(got[h]).sum(dtype=np.float64))
        grads.append(g.T)
    back = np.ascontiguousarray(back.T)
    back -= classes.w[:, :h].take(t.k, axis=0)
    back[t.chosen] -= words.w[:, :h].take(chosen, axis=0)
    # What the targets themselves take off: rows of a class, and of a word, lie together.
    for g, w, rows, at in ((grads[0], classes.w, t.seen, t.k), (grads[1], words.w, t.seen[t.chosen], chosen)):
        if len(at):
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            own, at = np.add.reduceat(rows, first, axis=0), at[first]
            g[at] -= own
            loss -= float(np.einsum("ij,ij->", own, w[at], dtype=np.float64))      # their logits
    (gc, gw) = grads
    return loss, {"class_w": gc[:, :h].T, "class_b": gc[:, h], "word_w": gw[:, :h], "word_b": gw[:, h]}, t.back_in_order(back)


def score_streams(p: dict, v: Vocabulary, docs: list[np.ndarray], lanes: int = SCORE_LANES) -> np.ndarray:
    """Natural log-likelihood of every document (arrays of word numbers, end included).

    Documents are dealt to lanes, longest first onto the shortest lane; a lane
    runs its documents one after another and forgets its state between them.
    """
    total = np.zeros(len(docs))
    if not docs:
        return total
    size = np.array([len(d) for d in docs])
    order = np.argsort(-size, kind="stable")
    n_lanes = min(lanes, len(docs))
    lane_docs, load = [[] for _ in range(n_lanes)], np.zeros(n_lanes, np.int64)
    for d in order:
        at = int(load.argmin())
        lane_docs[at].append(d)
        load[at] += size[d]
    by = np.argsort(-load, kind="stable")                   # lanes still running are always the first ones
    load, lane_docs = load[by], [lane_docs[i] for i in by]
    longest = int(load[0])
    begin_id = v.size + 1                                    # input of a document's first step
    inputs = np.full((n_lanes, longest), begin_id, np.int32)
    target, owner = np.zeros((n_lanes, longest), np.int32), np.zeros((n_lanes, longest), np.int32)
    for i, ds in enumerate(lane_docs):
        at = 0
        for d in ds:
            n = size[d]
            target[i, at:at + n], owner[i, at:at + n] = docs[d], d
            inputs[i, at + 1:at + n] = docs[d][:-1]
            at += n
    table = np.concatenate([p["embed"] @ p["wx"] + p["b"], p["b"][None]]).astype(np.float32)
    s = np.zeros((HIDDEN, n_lanes), np.float32)             # units x lanes
    lives = np.searchsorted(-load, -np.arange(longest), side="left").tolist()       # lanes longer than t
    states, wanted, whose, held = [], [], [], 0
    for t, live in enumerate(lives):
        x = inputs[:live, t]
        begins = x == begin_id
        s = s[:, :live]
        if begins.any():
            s = np.where(begins, np.float32(0), s)
        s = step(np.ascontiguousarray(table.take(x, axis=0).T).T, s.T, p["wh"])[0].T
        states.append(s)
        wanted.append(target[:live, t])
        whose.append(owner[:live, t])
        held += live
        if held >= SCORE_STATES or t == longest - 1:
            total += np.bincount(np.concatenate(whose), output_log(p, v, np.concatenate(states, axis=1).T, np.concatenate(wanted)),
                                 len(docs))
            states, wanted, whose, held = [], [], [], 0
    return total


def by_units(x: np.ndarray) -> np.ndarray:
    """The last two axes (windows and units) the other way round, in memory too."""
    return np.ascontiguousarray(x.transpose(0, 2, 1))


def gradients(p: dict, v: Vocabulary, inputs: np.ndarray, target: np.ndarray) -> tuple[float, dict]:
    """Mean loss and gradients of one batch of windows (lanes x time); the state
    before a window or a document (input ``v.size + 1``) is zero and gradients
    stop there.  Steps with a negative target have no loss."""
    n, length = inputs.shape
    h = HIDDEN
    inputs, target = np.ascontiguousarray(inputs.T), np.ascontiguousarray(target.T)     # by time
    inside = (inputs <= v.size).astype(p["wh"].dtype)
    # What a word adds to the gates, worked out once per word that is there.
    words = inputs.reshape(-1)
    by = np.argsort(words.astype(np.int16 if v.size < 32_000 else np.int32), kind="stable")
    ordered = words[by]
    starts = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    first = np.flatnonzero(starts)
    some = ordered[first]
    some = some[:np.searchsorted(some, v.size, side="right")]           # without the beginning, which comes last
    embedded = np.zeros((len(first), p["embed"].shape[1]), p["embed"].dtype)
    embedded[:len(some)] = p["embed"][some]
    row = np.empty(len(words), np.int32)
    row[by] = np.cumsum(starts) - 1
    # By time, units, windows: what is done to one unit or gate runs over all windows.
    gx = by_units((embedded @ p["wx"] + p["b"]).take(row, axis=0).reshape(length, n, 3 * h))
    s = np.zeros((h, n), gx.dtype)
    states, before, z, r, cand, ah = np.empty((6, length, h, n), gx.dtype)
    for t in range(length):
        np.multiply(s, inside[t], out=before[t])
        for kept, x in zip((states, z, r, cand, ah), step(gx[t].T, before[t].T, p["wh"])):
            kept[t] = x.T
        s = states[t]
    flat, want = by_units(states).reshape(-1, h), target.reshape(-1)
    real = np.flatnonzero(want >= 0)
    whole = len(real) == len(want)
    if not whole:
        flat, want = flat[real], want[real]
    total = max(1, len(real))
    g = {k: np.zeros_like(x) for k, x in p.items()}
    loss, outer, back = output_gradients(p, v, flat, want)
    for name, x in outer.items():
        np.divide(x, total, out=g[name])
    back /= total
    if whole:
        below = back
    else:
        below = np.zeros((length * n, h), back.dtype)
        below[real] = back
    below = by_units(below.reshape(length, n, h))
    # What the chain from step to step does not change, for all steps at once.
    by_cand = (1 - z) * (1 - cand * cand)
    by_z, by_r = (before - cand) * z * (1 - z), ah * r * (1 - r)
    ds, dxs, das = np.zeros((h, n), gx.dtype), np.empty_like(gx), np.empty_like(gx)
    for t in reversed(range(length)):
        ds += below[t]
        dx, da = dxs[t], das[t]
        dcand = np.multiply(ds, by_cand[t], out=dx[2 * h:])
        np.multiply(ds, by_z[t], out=dx[:h])
        np.multiply(dcand, by_r[t], out=dx[h:2 * h])
        da[:2 * h] = dx[:2 * h]
        np.multiply(dcand, r[t], out=da[2 * h:])
        ds *= z[t]
        ds += p["wh"] @ da
        ds *= inside[t]
    g["wh"] = (before @ das.transpose(0, 2, 1)).sum(axis=0)
    # The steps of one word together, then through what it adds.
    added = np.add.reduceat(by_units(dxs).reshape(-1, 3 * h).take(by, axis=0), first, axis=0)
    g["b"] = added.sum(axis=0)
    g["wx"] = embedded.T @ added
    g["embed"][some] = added[:len(some)] @ p["wx"].T
    return loss / total, g


class Trainer:
    """Adam over batches of windows."""

    def __init__(self, p: dict, v: Vocabulary, rate: float = RATE):
        self.p, self.v, self.rate, self.steps, self.tokens = {k: x.copy() for k, x in p.items()}, v, rate, 0, 0
        self.m, self.q = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))

    def learn(self, inputs: np.ndarray, target: np.ndarray) -> float:
        loss, g = gradients(self.p, self.v, inputs, target)
        self.steps += 1
        self.tokens += int((target >= 0).sum())
        a, b = self.rate / (1 - 0.9 ** self.steps), 1 / (1 - 0.99 ** self.steps)
        for k, x in self.p.items():             # in place: a large vocabulary's weights are written once a step
            m, q, d = self.m[k], self.q[k], g[k]
            m *= 0.9
            m += 0.1 * d
            q *= 0.99
            np.multiply(d, d, out=d)
            d *= 0.01
            q += d
            np.multiply(q, b, out=d)
            np.sqrt(d, out=d)
            d += 1e-6
            np.divide(m, d, out=d)
            d *= a
            x -= d
        return loss


def numbers(v: Vocabulary, words: list[bytes]) -> np.ndarray:
    return look_up(pa.array([*words, END], pa.binary()), v.names)


def text_numbers(v: Vocabulary, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of texts laid end to end, and where each text ends (its
    end token included)."""
    words, upto = split_words(texts)
    return with_ends(look_up(words, v.names), upto, v.number.get(END, v.size))


def training_batches(texts: Iterable[bytes] | Iterable[pa.Array], v: Vocabulary, turn: int = 0,
                     every: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Batches of (inputs, targets), windows x ``WINDOW``, over the words of all texts laid end to end.

    Of every ``every`` windows one is taken, another one each turn.  Batches
    hold ``LANES`` windows; the last ones share what is left, so that none is
    small unless all the texts are.
    """
    size, first = every * LANES * WINDOW, turn * (every // 2 or 1) % every
    held, count = [], 0
    arrays = (t if isinstance(t, pa.Array) else pa.array([t], pa.binary()).view(pa.string()) for t in texts)

    def windows(steps: np.ndarray) -> np.ndarray:
        return steps.reshape(2, -1, WINDOW)[:, first::every]

    for some in portions(arrays, PART_BYTES):
        ids, ends = text_numbers(v, some)
        before = np.empty_like(ids)
        before[0], before[1:] = v.size + 1, ids[:-1]
        before[ends[:-1]] = v.size + 1
        held.append(np.stack([before, ids]))
        count += len(ids)
        if count >= 2 * size:
            steps, at = np.concatenate(held, axis=1), 0
            while count >= 2 * size:
                yield tuple(windows(steps[:, at:at + size]))
                at, count = at + size, count - size
            held = [steps[:, at:]]
    if count:
        fill = np.tile([[v.size + 1], [-1]], -count % WINDOW)
        left = windows(np.concatenate([*held, fill], axis=1))
        for part in np.array_split(left, -(-left.shape[1] // LANES) or 1, axis=1):
            if part.shape[1]:
                yield tuple(part)


def _train(p: dict, v: Vocabulary, turn: int, every: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        trainer = Trainer(p, v, rate)
        for inputs, target in training_batches((b.column("t") for b in batches), v, turn, every):
            trainer.learn(inputs, target)
        if trainer.tokens:
            weight = float(trainer.tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(p)), pa.array([weight] * len(p)),
                 pa.array([(trainer.p[k].astype(np.float64) * weight).ravel().astype("<f4").tobytes() for k in p], pa.binary())],
                names=["name", "weight", "value"])
    return run


def _add(names_shapes: dict):
    """Sum the weighted copies of one task's share: name -> summed values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(int(np.prod(s)), np.float64) for k, s in names_shapes.items()}
        weight = dict.fromkeys(names_shapes, 0.0)
        for b in batches:
            for k, w, raw in zip(*(b.column(c).to_pylist() for c in ("name", "weight", "value"))):
                total[k] += np.frombuffer(raw, "<f4")
                weight[k] += w
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total)), pa.array(list(weight.values())),
             pa.array([x.astype("<f4").tobytes() for x in total.values()], pa.binary())], names=["name", "weight", "value"])
    return run


def train(docs: DataFrame, v: Vocabulary, passes: int = PASSES, every: int = TRAIN_EVERY, rate: float = RATE) -> dict:
    """Train copies in parallel and average them, ``passes`` times.

    The copies are added up a tree of tasks (eight into one), so neither the
    driver nor any task holds more than a few copies at once.
    """
    p, schema = start(v), "name string, weight double, value binary"
    rows = training_docs(docs).select("t")
    shapes = {k: x.shape for k, x in p.items()}
    for turn in range(passes):
        copies = stored(rows.mapInArrow(_train(p, v, turn, every, rate / (1 + turn)), schema), "gru-copies")
        left = copies.filter(F.col("name") == "b").count()
        while left > 8:
            left = -(-left // 8)
            copies = stored(copies.repartition(left).mapInArrow(_add(shapes), schema), "gru-copies")
        got = {k: (np.zeros(s), 0.0) for k, s in shapes.items()}
        for r in copies.toLocalIterator():                  # at most eight copies, a part of them at a time
            value, weight = got[r["name"]]
            got[r["name"]] = (value + np.frombuffer(r["value"], "<f4").reshape(shapes[r["name"]]), weight + r["weight"])
        p = {k: (value / weight).astype(np.float32) if weight else p[k] for k, (value, weight) in got.items()}
    return p


# -- scoring -----------------------------------------------------------------

SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double, "
          "rare array<struct<word: binary, tf: int>>")


def _score(p: dict, v: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        # One look-up per token: a head word's place, whose facts are arrays; the last place is any other word.
        names = list(v.head)
        places, end = pa.array(names, pa.binary()), names.index(END) if END in v.head else len(names)
        log_c1 = np.array([math.log10(v.head[w] + 1) for w in names] + [0.0])
        number = np.array([v.number.get(w, v.size) for w in names] + [v.size], np.int32)
        share = np.array([0.0 if w in v.number else v.log_other(v.head[w]) for w in names] + [0.0])

        def facts(texts: pa.Array):
            """Of each text: its words' numbers, facts of its own, and its rare words and how often each is there."""
            words, upto = split_words(texts)
            found = look_up(words, places)
            outside = np.flatnonzero(found == len(names))
            rare = words.take(pa.array(outside)).dictionary_encode()
            kinds = pa.concat_arrays([rare.dictionary, pa.array([END], pa.binary())])
            pairs = np.searchsorted(upto, outside, side="right") * len(kinds) + rare.indices.to_numpy()
            if end == len(names):                       # few texts, long ones: the end is rare itself
                pairs = np.concatenate([pairs, np.arange(1, len(texts) + 1) * len(kinds) - 1])
            pairs, times = np.unique(pairs, return_counts=True)
            owner = pairs // len(kinds)
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()), pa.StructArray.from_arrays(
                    [kinds.take(pa.array(pairs - owner * len(kinds))), pa.array(times, pa.int32())], names=["word", "tf"]))
            at, ends = with_ends(found, upto, end)
            starts = np.concatenate([[0], ends[:-1]])
            n = ends - starts
            known = n - np.add.reduceat(at == len(names), starts, dtype=np.int64)
            base = np.add.reduceat(log_c1[at], starts) - n * v.log_base
            inner = np.add.reduceat(share[at], starts) if share.any() else np.zeros(len(n))
            return np.split(number[at], ends[:-1]), n, known, base, inner, lists

        for b in batches:
            done = 0
            for texts in portions([b.column("t")], SCORE_BYTES):
                part, done = b.slice(done, len(texts)), done + len(texts)
                # rare words go on to be joined with their counts
                docs, n, known, base, inner, lists = zip(*map(facts, portions([texts], PART_BYTES)))
                model = score_streams(p, v, [d for x in docs for d in x])
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(np.concatenate(n), pa.int64()),
                    pa.array(np.concatenate(known), pa.int64()), pa.array(np.concatenate(base), pa.float64()),
                    pa.array((model + np.concatenate(inner)) / math.log(10), pa.float64()), pa.concat_arrays(lists)],
                    names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "model", "rare"])
    return run


def score_documents(docs: DataFrame, vocab: int | None = None, classes: int | None = None, passes: int = PASSES,
                    every: int = TRAIN_EVERY) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    modulus, held = HELD_OUT
    counts = word_counts(docs)
    v = vocabulary(counts, vocab, classes)
    p = train(docs, v, passes, every) if v.total else start(v)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                       (fold_of("doc_id", modulus) == held).alias("held_out"), whole_text().alias("t"))
    scored = stored(rows.mapInArrow(_score(p, v), SCORED), "lm-scored")
    # Rare words only: none of them holds 1/HEAD_SHARE of the tokens, so no key of this join is hot.
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.tf")
    tail = counts.filter(F.col("c") * HEAD_SHARE < v.total) if v.total else counts
    c = F.coalesce("c", F.lit(0))
    share = F.when(F.col("c").isNull(), F.lit(v.log_other(0))).otherwise(
        F.log((F.greatest(c, F.lit(1)) - DISCOUNT) / max(1, v.other_tokens)))
    sums = (rare.join(tail, "word", "left")
            .groupBy("row").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("more_known"),
                                F.sum(F.col("tf") * F.log10(c + 1)).alias("more_base"),
                                F.sum(F.col("tf") * share / math.log(10)).alias("more_model")))
    if not v.total:
        score = F.col("base_score")
    else:
        score = F.col("model") + F.coalesce("more_model", F.lit(0.0))
    return (scored.drop("rare").join(sums, "row", "left")
            .withColumn("base_score", F.col("base") + F.coalesce("more_base", F.lit(0.0)))
            .select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                    F.lit(v.total).cast("long").alias("train_tokens"), "base_score", score.alias("score")))
