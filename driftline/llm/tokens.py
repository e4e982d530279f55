"""Token ids of whole texts, with the ids of repeated pieces remembered.

Both tokenizers cut a text into pieces before they look at it piece by piece;
white space always ends a piece.  Encoding each distinct piece once and joining
the remembered ids gives exactly the ids of the whole text, several times faster
than encoding running text whose words repeat.  The memory is bounded: a
worker forgets all pieces when it holds ``MAX_PIECES``.
"""

from __future__ import annotations

import os
import re
from array import array

#: Pieces that one Python worker remembers (about 250 MB at most).
MAX_PIECES = 1_200_000
#: Longer pieces are encoded but not remembered.
MAX_PIECE_CHARS = 48

#: The code points with the Unicode property White_Space, the tokenizers' `\s`.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters and signs between which both tokenizers always cut.  The apostrophe is
#: not among the signs: it belongs to endings such as 's.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
#: A word of letters apart from the signs that close it; any other run as a whole.
_WORD = rf"[{LETTERS}]++(?=[{SIGNS}]*+(?:[{SPACE}]|\Z))"
_CLOSE = rf"[{SIGNS}]++(?=[{SPACE}]|\Z)"
#: Byte-level vocabulary: a word takes one space before it along; other white
#: space forms pieces of its own, all but the last character of a run together.
BYTE_PIECES = re.compile(rf" ?{_WORD}|{_CLOSE}| ?[^{SPACE}]++|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Word vocabulary: white space only separates.
WORD_PIECES = re.compile(rf"{_WORD}|{_CLOSE}|[^{SPACE}]++")

_loaded: dict[str, "PieceEncoder"] = {}


class PieceEncoder:
    def __init__(self, path: str, pieces: re.Pattern, lower: bool):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # A text that holds the string of one of these goes to the tokenizer whole, which gives it an id of its own.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.known, self.lower = pieces, {}, lower

    def whole(self, text: str) -> bool:
        """Texts that are not cut: those with a special token's string and, where case is
        folded, those with a capital sigma, whose small form depends on what is around it."""
        if self.lower and "\u03a3" in text:
            return True
        folded = text.lower() if self.lower else text
        return any(s in text or (self.lower and s.lower() in folded) for s in self.special)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.known) > MAX_PIECES:
            self.known.clear()
        known, out, late, new = self.known, [], [], set()
        for i, t in enumerate(texts):
            if self.whole(t):
                out.append(array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes())
                continue
            # A vocabulary without case: fold first, so that "The" and "the" are one piece.
            cut = self.pieces.findall(t.lower() if self.lower else t)
            ids = list(map(known.get, cut))
            gaps = [(k, cut[k]) for k, x in enumerate(ids) if x is None] if None in ids else []
            if gaps:
                new.update([p for _, p in gaps])
                late.append((i, ids, gaps))
            out.append(b"" if gaps else b"".join(ids))
        extra, missing = {}, list(new)
        for i in range(0, len(missing), 8192):
            part = missing[i:i + 8192]
            for piece, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                (known if len(piece) <= MAX_PIECE_CHARS else extra)[piece] = array("I", e.ids).tobytes()
        for i, ids, gaps in late:
            for k, p in gaps:
                ids[k] = known[p] if p in known else extra[p]
            out[i] = b"".join(ids)
        return out


def encoder(path: str, word_level: bool) -> PieceEncoder:
    """This worker's encoder for a vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # Spark already runs one worker per core
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path, WORD_PIECES if word_level else BYTE_PIECES, lower=word_level)
    return _loaded[path]


def text_blocks(texts: list[str], max_chars: int = 2_000_000):
    """Slices ``(i, j)`` of a batch of at most about ``max_chars`` characters (one text at least)."""
    i, total = 0, 0
    for j, t in enumerate(texts):
        if j > i and total + len(t) > max_chars:
            yield i, j
            i, total = j, 0
        total += len(t)
    if i < len(texts):
        yield i, len(texts)
