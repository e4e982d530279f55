"""Toxicity by a subsequence string kernel and a support vector machine.

Strings are words after folding (NFKD): letters of any script without case or
accents, digits read as the letters they imitate, other characters dropped (so
`i.d-i*o_t` is one word) and spaces between single letters dropped (`i d i o t`).
Latin letters have a symbol each, other letters share 222 by code point, so those
of one alphabet differ; the features of four symbols with such a letter among
them are hashed into as many places as the Latin ones have.  The kernel of
two strings counts common subsequences of four symbols (word ends are symbols)
inside a window of six; each skipped symbol costs a factor ``DECAY``, so an
inserted or missing character weakens a match but does not end it.  A string of more
than ``LONG`` letters (a run of text without spaces) counts as the overlapping spans
of ``SPAN`` letters in it.

Training: a bounded sample of labelled documents comes to the driver.  A label
holds for a document, not for its sentences; the strings of a toxic document
are a bag of which at least one is toxic (multiple-instance learning).  Nystroem
landmarks are the strings most tied to toxic bags and a sample of the others;
a linear SVM (squared hinge) is trained on the landmark features of all clean
strings and of each toxic bag's strongest strings, which are chosen anew for a
few rounds.  A logistic fit on documents that the SVM did not see turns a
document's strongest string, its number of toxic strings and its length into a
probability.

Scoring: a Nystroem SVM on a kernel with an explicit feature map is one weight
per four-symbol feature, so a string's decision value is a sum of table look-ups
over all its subsequences.  Every string of every whole text is scored, in
numpy over Arrow batches.

Defined cases: null text counts as empty; a text without strings gets the score
of the weakest string; without both classes among the training rows every score
is the prior of class 1 (0.5 with no rows), and nothing is rejected below the
threshold; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fold_of, training_sample, whole_text
from driftline.llm.tokens import text_blocks

HELD_OUT = (3, 1)
THRESHOLD = 0.7
#: Bound on the training sample: documents of each class, and characters of each.
SAMPLE_DOCS = 1200
SAMPLE_CHARS = 20_000
LANDMARKS = 192
#: Longer strings are looked at as overlapping spans of so many letters, one every STRIDE.
LONG, SPAN, STRIDE = 24, 8, 3
DECAY = 0.5
ROUNDS = 4
BLOCK_CHARS = 1_000_000

# Digits and signs read as the letters they imitate.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "\u03c2": "\u03c3"}
DROP, UNSEEN, END = 255, 254, 0
#: Symbols from here on are letters of other scripts.
OTHER = 32
#: Feature numbers: four Latin symbols have one each, the others share the upper half.
FEATURES = 1 << 21
#: Offsets of the second, third and fourth symbol: a window of six.
PATTERNS = [(a, b, c) for c in (3, 4, 5) for b in range(2, c) for a in range(1, b)]


def _symbol(cp: int) -> int:
    """Class of a code point: 0 word end, 1-26 a-z, 27 other Latin, from 32 other scripts, 255 dropped."""
    ch = chr(cp)
    base = unicodedata.normalize("NFKD", LOOKALIKES.get(ch, ch).lower())[0]
    if ch.isspace() or ch in "\u3001\u3002":                     # white space, ideographic comma and full stop
        return END
    if "a" <= base <= "z":
        return ord(base) - 96
    if cp < 0x250:
        return 27 if ch.isalpha() else DROP
    # accents have a combining class; vowel signs, which spell words, have none
    sign = (unicodedata.category(base) in ("Mn", "Mc") and not unicodedata.combining(base) and base != "\u034f"
            and "VARIATION SELECTOR" not in unicodedata.name(base, ""))
    return OTHER + ord(base) % (UNSEEN - OTHER) if base.isalpha() or sign else DROP


#: Classes of all code points; those from 0x250 on are filled in as they are met.
FOLD = np.full(0x110000, UNSEEN, np.uint8)
FOLD[:0x250] = [_symbol(cp) for cp in range(0x250)]


def fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts (each begins with a word end) and each text's start in them,
    long strings as spans."""
    return slide(*fold_words(texts))


def fold_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``fold`` with long strings as they are."""
    texts = [t if t.isascii() else unicodedata.normalize("NFKD", t) for t in texts]
    cp = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    cls = FOLD[cp]
    if (new := np.unique(cp[cls == UNSEEN])).size:
        FOLD[new] = [_symbol(int(c)) for c in new]
        cls = FOLD[cp]
    keep = cls != DROP
    start = np.concatenate([[0], np.cumsum(keep)])[bounds]
    sym = cls[keep]
    # drop word ends between two single letters, except where a text begins
    ends = np.flatnonzero(sym == END)
    single = np.diff(ends) == 2
    drop = np.zeros(len(ends), bool)
    drop[1:-1] = single[:-1] & single[1:]
    drop[np.isin(ends, start)] = False
    if drop.any():
        keep = np.ones(len(sym), bool)
        keep[ends[drop]] = False
        start = np.concatenate([[0], np.cumsum(keep)])[start]
        sym = sym[keep]
    return sym, start


def slide(sym: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings of more than ``LONG`` letters as overlapping spans of ``SPAN`` letters,
    one every ``STRIDE``: text without spaces is one string, in which an insult would
    be a small part.  Every stretch of ``SPAN - STRIDE`` letters lies in one span."""
    ends = np.flatnonzero(sym == END)
    letters = np.diff(ends) - 1
    long = np.flatnonzero(letters > LONG)
    if not len(long):
        return sym, start
    pieces, shift, at = [], np.zeros(len(sym) + 1, np.int64), 0
    for k in long.tolist():
        a, n = int(ends[k]) + 1, int(letters[k])
        firsts = np.append(np.arange(0, n - SPAN, STRIDE), n - SPAN)
        rows = np.zeros((len(firsts), SPAN + 1), sym.dtype)
        rows[:, :SPAN] = sym[a + firsts[:, None] + np.arange(SPAN)]
        pieces += [sym[at:a], rows.ravel()[:-1]]            # the string's own closing word end follows
        at = a + n
        shift[at] += rows.size - 1 - n
    pieces.append(sym[at:])
    return np.concatenate(pieces), start + np.cumsum(shift)[start]


def spans(sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start (its opening word end) and letter count of every string."""
    ends = np.flatnonzero(sym == END)
    n = np.diff(ends) - 1
    return ends[:-1][n > 0], n[n > 0]


def norm(letters: np.ndarray) -> np.ndarray:
    """The self-kernel's root, taking a string's subsequences as distinct."""
    total = sum(np.maximum(letters + 2 - c, 0) * DECAY ** (2 * (c - 3)) for _, _, c in PATTERNS)
    return np.sqrt(np.maximum(total, 1.0))


def features(sym: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pattern: feature number at every position, whether it lies in one string, its weight."""
    ends = np.flatnonzero(sym == END)
    following = ends[np.minimum(np.searchsorted(ends, np.arange(len(sym)), side="right"), len(ends) - 1)]
    room = following - np.arange(len(sym))
    s = np.concatenate([sym, np.zeros(6, np.uint8)]).astype(np.int32)
    n, first = len(sym), s[:len(sym)] << 15
    other = s >= OTHER
    some, u = other.any(), s.astype(np.uint32)
    for a, b, c in PATTERNS:
        number = first | (s[a:n + a] << 10) | (s[b:n + b] << 5) | s[c:n + c]
        if some:
            h = (u[:n] * np.uint32(0x9E3779B1) + u[a:n + a] * np.uint32(0x85EBCA6B) + u[b:n + b] * np.uint32(0xC2B2AE35)
                 + u[c:n + c] * np.uint32(0x27D4EB2F))
            h = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(12)).astype(np.int32) | (FEATURES >> 1)
            number = np.where(other[:n] | other[a:n + a] | other[b:n + b] | other[c:n + c], h, number)
        yield number, room >= c, DECAY ** (c - 3)


def string_values(sym: np.ndarray, start: np.ndarray, letters: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    """Decision values of all strings."""
    if not len(start):
        return np.zeros(0)
    acc = np.zeros(len(sym), np.float32)
    for number, inside, weight in features(sym):
        acc += np.where(inside, table[number], np.float32(0)) * np.float32(weight)
    return np.add.reduceat(acc.astype(np.float64), start)[:len(start)] / norm(letters) + bias


def document_facts(texts: list[str], model: dict) -> np.ndarray:
    """Per text: strongest decision value, number of positive strings, number of strings."""
    out = np.zeros((len(texts), 3))
    out[:, 0] = model["floor"]
    for i, j in text_blocks(texts, BLOCK_CHARS):
        pieces, owner = [], []
        for k in range(i, j):                      # a long text goes in parts, cut at white space
            for part in _parts(texts[k]):
                pieces.append(part)
                owner.append(k)
            if sum(map(len, pieces)) > BLOCK_CHARS:
                _add_facts(pieces, owner, model, out)
                pieces, owner = [], []
        if pieces:
            _add_facts(pieces, owner, model, out)
    return out


def _parts(text: str) -> list[str]:
    if len(text) <= BLOCK_CHARS:
        return [text]
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + BLOCK_CHARS)
        cut = text.rfind(" ", at, end) if end < len(text) else end
        end = cut if cut > at else end
        out.append(text[at:end])
        at = end
    return out


def _add_facts(pieces: list[str], owner: list[int], model: dict, out: np.ndarray) -> None:
    sym, begin = fold(pieces)
    start, letters = spans(sym)
    value = string_values(sym, start, letters, model["table"], model["bias"])
    who = np.array(owner)[np.searchsorted(begin, start, side="right") - 1]
    np.maximum.at(out[:, 0], who, value)
    out[:, 1] += np.bincount(who, value > 0, len(out))
    out[:, 2] += np.bincount(who, minlength=len(out))


# -- training ----------------------------------------------------------------

def _strings(texts: list[str]) -> tuple[list[bytes], list[list[int]]]:
    """Distinct strings of the texts and each text's string numbers."""
    return _strings_and_spans(texts)[:2]


def _strings_and_spans(texts: list[str]) -> tuple[list[bytes], list[list[int]], set[bytes]]:
    """``_strings``, and which of the strings are only spans of longer ones."""
    number: dict[bytes, int] = {}
    bags, words, spans_ = [], set(), set()
    for t in texts:
        own = set(fold_words([t])[0].tobytes().split(b"\0")) - {b""}
        long = [w for w in own if len(w) > LONG]
        own.difference_update(long)
        words |= own
        if long:
            sym = np.frombuffer(b"\0" + b"\0".join(long) + b"\0", np.uint8)
            cut = set(slide(sym, np.zeros(1, np.int64))[0].tobytes().split(b"\0")) - {b""}
            spans_ |= cut
            own |= cut
        bags.append(sorted(number.setdefault(w, len(number)) for w in own))
    return list(number), bags, spans_ - words


def _by_parts(strings: list[bytes], bags: list[list[int]], y: np.ndarray, cut_from: set[bytes],
              in_toxic: np.ndarray, in_clean: np.ndarray) -> list:
    """Spans of long strings hardly ever repeat; what ties them to toxic bags is a part
    that does.  Sets the counts of each span to those of its strongest part of four
    letters and returns each string's part (for other strings the string itself)."""
    parts: list = list(strings)
    cut = {i: {w[k:k + 4] for k in range(SPAN - 3)} for i, w in enumerate(strings) if w in cut_from}
    if not cut:
        return parts
    counts: dict[bytes, list[int]] = {}
    for bag, label in zip(bags, y):
        for part in set().union(*[cut[i] for i in bag if i in cut]):
            counts.setdefault(part, [0, 0])[int(label)] += 1
    n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())

    def strength(part):
        clean, toxic = counts[part]
        return (np.log((toxic + 0.1) / (n1 + 1)) - np.log((clean + 0.1) / (n0 + 1))) * np.sqrt(toxic), part
    strong = {part: strength(part) for part in counts}
    for i, inner in cut.items():
        parts[i] = max(inner, key=strong.__getitem__)
        in_clean[i], in_toxic[i] = counts[parts[i]]
    return parts


def _thin(strings: list[bytes], bags: list[list[int]], y: np.ndarray, rng, most: int = 20_000):
    """Every string of the toxic bags, and a sample of those that only clean bags hold."""
    toxic = set().union(*[b for b, label in zip(bags, y) if label])
    rest = [i for i in range(len(strings)) if i not in toxic]
    if len(rest) > most:
        rest = rng.choice(rest, most, replace=False).tolist()
    kept = {old: new for new, old in enumerate(sorted([*toxic, *rest]))}
    return [strings[i] for i in kept], [[kept[i] for i in b if i in kept] for b in bags]


def _explicit(strings: list[bytes]) -> list[dict[int, float]]:
    """Normalised feature vectors of a few strings."""
    out = []
    for w in strings:
        sym = np.frombuffer(b"\0" + w + b"\0", np.uint8)
        vec: dict[int, float] = {}
        for number, inside, weight in features(sym):
            for f in number[inside].tolist():
                vec[f] = vec.get(f, 0.0) + weight
        scale = float(norm(np.array([len(w)]))[0])
        out.append({k: v / scale for k, v in vec.items()})
    return out


def _kernel(strings: list[bytes], landmarks: list[bytes]) -> np.ndarray:
    """k(string, landmark) for all pairs, through a feature-by-landmark matrix."""
    vecs = _explicit(landmarks)
    used = sorted(set().union(*vecs))
    place = np.full(FEATURES, len(used), np.int32)
    place[used] = np.arange(len(used))
    m = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    for j, v in enumerate(vecs):
        m[place[list(v)], j] = list(v.values())
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    for i in range(0, len(strings), 2048):
        part = strings[i:i + 2048]
        sym = np.frombuffer(b"\0" + b"\0".join(part) + b"\0", np.uint8)
        start, letters = spans(sym)
        owner = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(sym)]))
        found = []
        for number, inside, weight in features(sym):
            row = place[number]
            hit = np.flatnonzero(inside & (row < len(used)))
            found.append((owner[hit], row[hit], np.full(len(hit), weight, np.float32)))
        who, row, weight = (np.concatenate(c) for c in zip(*found))
        by = np.argsort(who, kind="stable")
        who, row, weight = who[by], row[by], weight[by]
        if len(who):
            first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            out[i + who[first]] = np.add.reduceat(m[row] * weight[:, None], first, axis=0)
        out[i:i + len(part)] /= norm(letters)[:, None]
    return out


def _svm(x: np.ndarray, y: np.ndarray, w: np.ndarray, c: float = 4.0) -> np.ndarray:
    """Weighted squared-hinge SVM with an unpenalised bias (last column of ``x``), by Newton steps."""
    coef, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(25):
        on = (y * (x @ coef) < 1)
        xa, wa = x[on], (c * w[on])[:, None]
        new = np.linalg.solve(ridge + xa.T @ (xa * wa), xa.T @ (wa[:, 0] * y[on]))
        if np.allclose(new, coef, atol=1e-6):
            break
        coef = new if np.all(coef == 0) else 0.5 * (coef + new)
    return coef


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    coef = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        h = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1])
        coef = coef - np.linalg.solve(h, x.T @ (p - y) + ridge * coef)
        coef[:2] = np.maximum(coef[:2], 0)          # more or stronger toxic strings never lower a score
    return coef


def _facts_columns(facts: np.ndarray) -> np.ndarray:
    return np.column_stack([np.clip(facts[:, 0], -3, 3), np.log1p(facts[:, 1]), np.log1p(facts[:, 2]), np.ones(len(facts))])


def train(sample: list[tuple[str, int]], shift: float = 0.0, seed: int = 7) -> dict:
    """A model from (text, label) rows; ``shift`` corrects the log odds for their class shares."""
    labels = np.array([y for _, y in sample])
    if len(set(labels.tolist())) < 2:
        prior = float((labels.sum() + 1) / (len(labels) + 2)) if len(labels) else 0.5
        return {"constant": prior}
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(sample))
    fit, calibrate = order[:len(order) // 2], order[len(order) // 2:]
    if len(set(labels[fit].tolist())) < 2 or len(set(labels[calibrate].tolist())) < 2:
        fit = calibrate = order
    strings, bags, cut_from = _strings_and_spans([sample[i][0] for i in fit])
    y = labels[fit]
    strings, bags = _thin(strings, bags, y, rng)
    in_toxic, in_clean = np.zeros(len(strings)), np.zeros(len(strings))
    for bag, label in zip(bags, y):
        (in_toxic if label else in_clean)[bag] += 1
    parts = _by_parts(strings, bags, y, cut_from, in_toxic, in_clean)
    n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
    # strings tied to toxic bags: a smoothed log ratio, weighted by how often they were seen
    tie = np.log((in_toxic + 0.1) / (n1 + 1)) - np.log((in_clean + 0.1) / (n0 + 1))
    rank = np.argsort(-tie * np.sqrt(in_toxic), kind="stable")
    clean = np.flatnonzero(in_clean > 0)
    first_of: dict = {}
    for i in rank.tolist():
        first_of.setdefault(parts[i], i)                # one landmark for each part
    near = np.array(list(first_of.values())[:LANDMARKS // 2])
    far = rng.choice(clean, min(len(clean), LANDMARKS // 2), replace=False) if len(clean) else clean
    landmarks = [strings[i] for i in dict.fromkeys([*near.tolist(), *far.tolist()])]
    k_zz = _kernel(landmarks, landmarks).astype(np.float64)
    value, vector = np.linalg.eigh((k_zz + k_zz.T) / 2)
    keep = value > 1e-3 * value.max()
    whiten = vector[:, keep] / np.sqrt(value[keep])
    x_all = _kernel(strings, landmarks) @ whiten.astype(np.float32)

    def column(rows):
        return np.column_stack([x_all[rows], np.ones(len(rows))]).astype(np.float64)

    toxic_bags = [np.array(b) for b, label in zip(bags, y) if label and b]
    clean_pick = rng.choice(clean, min(len(clean), 12_000), replace=False) if len(clean) else clean
    # how far a string's bags are toxic beyond an even share: label errors and harmless uses weaken it, but do not bar it
    share = (in_toxic / n1) / np.maximum(in_toxic / n1 + in_clean / n0, 1e-12)
    trust = np.maximum(2 * share - 1, 0) ** 4
    decision = tie * np.sqrt(in_toxic) / max(1e-9, np.max(np.abs(tie) * np.sqrt(in_toxic))) - 0.15
    for _ in range(ROUNDS):
        # each toxic bag's strongest string and whatever else is already positive, by its trust
        chosen = {int(b[np.argmax(decision[b])]) for b in toxic_bags}
        chosen |= {int(s) for b in toxic_bags for s in b[decision[b] > 0.5]}
        positive = np.array(sorted(s for s in chosen if trust[s] > 0), int)
        if not len(positive):
            break
        hard = clean[np.argsort(-decision[clean])[:3000]]
        negative = np.setdiff1d(np.union1d(clean_pick, hard), positive)
        rows = np.concatenate([positive, negative])
        target = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
        pull = np.minimum(in_toxic[positive], 20) * trust[positive]
        weight = np.r_[pull * len(negative) / max(1e-9, pull.sum()),
                       np.ones(len(negative))] / len(negative) * 200
        coef = _svm(column(rows), target, weight)
        decision = x_all @ coef[:-1] + coef[-1]
    if not len(positive):
        return {"constant": float((labels.sum() + 1) / (len(labels) + 2))}
    beta, table = whiten @ coef[:-1], np.zeros(FEATURES, np.float64)
    for b, vec in zip(beta, _explicit(landmarks)):
        table[list(vec)] += b * np.array(list(vec.values()))
    model = {"table": table.astype(np.float32), "bias": float(coef[-1]), "floor": float(min(-1.0, decision.min()))}
    facts = document_facts([sample[i][0] for i in calibrate], model)
    model["calibration"] = _logistic(_facts_columns(facts), labels[calibrate])
    model["calibration"][-1] += shift
    return model


def score_texts(texts: list[str], model: dict) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    z = _facts_columns(document_facts(texts, model)) @ model["calibration"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


# -- Spark -------------------------------------------------------------------

def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = score_texts(b.column("t").to_pylist(), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), b.column("held_out"), pa.array(scores)],
                                             names=["doc_id", "text_key", "held_out", "score"])
    return run


def toxicity_model(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict:
    return train(*training_sample(docs, labels, "toxic", *HELD_OUT, sample_docs, SAMPLE_CHARS))


def score_documents(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, text_key``."""
    modulus, held = HELD_OUT
    rows = docs.select("doc_id", whole_text().alias("t")).select(
        "doc_id", F.xxhash64("t").alias("text_key"), (fold_of("doc_id", modulus) == held).alias("held_out"), "t")
    return (rows.mapInArrow(_score(model), "doc_id long, text_key long, held_out boolean, score double")
            .select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "text_key"))


def _accept(model: dict, threshold: float, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = score_texts([t or "" for t in b.column(names.index("text")).to_pylist()], model) < threshold
            yield b.filter(pa.array(keep))
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those whose score reaches the threshold (all columns, no shuffle)."""
    model = toxicity_model(docs, labels)
    return docs.mapInArrow(_accept(model, threshold, docs.columns), docs.schema)
