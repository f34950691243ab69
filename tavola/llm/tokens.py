"""Token ids of whole texts by a public vocabulary of the tokenizers library.

A text is cut where a token can never cross, each different piece is encoded
once by the library, and the pieces' ids are put together in order:

* byte-level vocabularies: before a space and around a line feed that stand
  between non-spaces (the pre-tokenizer always starts a new piece there);
* word vocabularies that lower-case and drop white space: at white space and,
  in words without an apostrophe, wherever the pre-tokenizer starts a new word
  (between letters, numbers and other characters; every number is one word);
* both: between a letter and a single full stop or comma before white space.

Texts for word vocabularies are cut together, as one array of Latin-1 bytes, and
Arrow finds their different pieces, so that Python only sees those.

Texts for which a cut might not be exact (two white-space characters in a row,
control characters that only Python counts as space, letters outside Latin-1
where case matters, marks of special tokens) are encoded whole by the library.
The cache of pieces is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain

MAX_PIECES = 800_000
WORD_BYTES = 2 << 20   # text cut at a time for word vocabularies
SPACE, LETTER, NUMBER, OTHER = range(4)   # kinds of characters
NO_SPACE = "\x1f"   # marks a piece without a space before it
STOP = re.compile(r"[.,](?<=[a-zA-Z][.,])(?=\s|$)")
ODD_SPACE = re.compile(r"[^\S \n]")   # white space besides space and line feed; control characters 28 to 31 count too
# The same in Latin-1, and the control characters alone.
ODD_LATIN, ODD_CONTROL = b"\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0", b"\x1c\x1d\x1e\x1f"
_encoders: dict = {}


def encoder(path: str, plain_specials: bool = False) -> "Encoder":
    """The worker's encoder for a vocabulary file. ``plain_specials``: special tokens' strings are ordinary text."""
    key = (path, plain_specials)
    if key not in _encoders:
        _encoders[key] = Encoder(path, plain_specials)
    return _encoders[key]


def kinds():
    """The kind of each Latin-1 character to a word vocabulary's pre-tokenizer."""
    import unicodedata

    import numpy as np
    kind = {"L": LETTER, "N": NUMBER}
    return np.array([SPACE if chr(c).isspace() else kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(256)], np.uint8)


class Pieces(dict):
    """Numbers of pieces; an unknown piece gets the next number and is listed as new."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        self.new.append(piece)
        return n


class Encoder:
    def __init__(self, path: str, plain_specials: bool = False):
        import json
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain_specials
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.words = (spec.get("normalizer") or {}).get("type") == "Sequence"
        # A separator that is always one token of its own and in no piece.
        self.join = " \x01 " if self.words else "\n"
        self.join_id = self._whole(self.join.strip(" "))
        if len(self.join_id) != 1:
            raise ValueError("the vocabulary has no single token for the separator")
        from tokenizers.pre_tokenizers import ByteLevel
        self.model = self.tok.model
        as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        # How the vocabulary writes each Latin-1 character.
        self.written = {c: as_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(256)}
        self.kinds = kinds()
        self._reset()

    def _whole(self, text: str):
        import numpy as np
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _reset(self):
        import numpy as np
        self.index = Pieces()
        self.start = np.zeros(1, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _learn(self) -> None:
        """Encode the new pieces. One of Latin-1 letters alone is one word to the model, as are a word vocabulary's pieces
        without an apostrophe; the others go through the whole tokenizer, joined by the separator."""
        import numpy as np
        new, self.index.new = self.index.new, []
        found: list = [None] * len(new)
        others = []
        tokenize, space = self.model.tokenize, "" if self.words else self.written[32]
        for k, piece in enumerate(new):
            if self.words and piece.isascii() and piece.isalpha():
                found[k] = [t.id for t in tokenize(piece)]
                continue
            bare = piece[1:] if piece[:1] == NO_SPACE else piece
            if (self.words and "'" not in piece) or (bare.isalpha() and (bare.isascii() or max(bare) <= "\xff")):
                word = bare if bare.isascii() and bare.isalpha() else bare.translate(self.written)
                found[k] = [t.id for t in tokenize(word if bare is not piece else space + word)]
            else:
                others.append(k)
        for i in range(0, len(others), 10_000):
            self._learn_joined(new, others[i:i + 10_000], found)
        size = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(size)])
        self.flat = np.concatenate([self.flat, flat])

    def _learn_joined(self, new: list[str], at: list[int], found: list) -> None:
        import numpy as np
        texts, of = [], []
        for k in at:
            piece = new[k]
            if not self.words and piece == NO_SPACE + "\n":   # the separator itself
                found[k] = self.join_id
                continue
            texts.append(piece if self.words else piece[1:] if piece[:1] == NO_SPACE else " " + piece)
            of.append(k)
        if not of:
            return
        ids = self._whole(self.join.join(texts))
        seps = np.flatnonzero(ids == self.join_id[0])
        if len(seps) != len(of) - 1:
            raise ValueError("pieces do not stand alone in this vocabulary")
        start = np.append(0, seps + 1).tolist()
        end = np.append(seps, len(ids)).tolist()
        for k, x, y in zip(of, start, end):
            found[k] = ids[x:y]

    def _safe(self, text: str) -> bool:
        if "<|" in text or "\x01" in text:
            return False
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            plain = None
        if self.words:
            # Latin-1 lower-cases character by character and is its own normal form.
            return plain is not None and len(plain.translate(None, ODD_CONTROL)) == len(plain)
        if text[0].isspace() or text[-1].isspace():
            return False
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return False
        return not ODD_SPACE.search(text) if plain is None else len(plain.translate(None, ODD_LATIN)) == len(plain)

    def _pieces(self, text: str) -> list[str]:
        pieces = STOP.sub(f" {NO_SPACE}\\g<0>", text).replace("\n", f" {NO_SPACE}\n {NO_SPACE}").split(" ")
        pieces[0] = NO_SPACE + pieces[0]
        return pieces

    def _numbers(self, pieces: Sequence):
        """The numbers of pieces, the new ones learned."""
        import numpy as np
        if len(self.index) > MAX_PIECES:
            self._reset()
        at = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        if self.index.new:
            self._learn()
        return at

    def _cut(self, texts: list[str]) -> tuple:
        """The pieces of safe texts for a word vocabulary: (numbers, how many of the pieces lie before each text's end)."""
        import numpy as np
        import pyarrow as pa
        chars = np.frombuffer(" ".join(texts).lower().encode("latin-1") + b" ", np.uint8)
        kind = self.kinds[chars]
        inside = kind != SPACE
        before = np.append(np.uint8(SPACE), kind[:-1])
        first = inside & (before == SPACE)
        cut = inside & ~first & ((kind != before) | (kind == NUMBER))
        marks = np.flatnonzero(chars == ord("'"))
        if len(marks):   # words with an apostrophe are cut at a full stop or comma alone
            words, at = np.flatnonzero(first), np.flatnonzero(cut)
            held = np.zeros(len(words), bool)
            held[np.searchsorted(words, marks, "right") - 1] = True
            at = at[held[np.searchsorted(words, at, "right") - 1]]
            stop = ((chars[at] == ord(".")) | (chars[at] == ord(","))) & (before[at] == LETTER) & (kind[at + 1] == SPACE)
            cut[at[~stop]] = False
        begins = first | cut
        starts = np.flatnonzero(begins)
        last = inside.copy()   # a piece's last character: white space or another piece follows (the text ends in white space)
        last[:-1] &= begins[1:] | ~inside[1:]
        data = chars[inside]
        offsets = np.append(0, np.cumsum(np.flatnonzero(last) - starts + 1))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        pieces = pieces.dictionary_encode()
        _, ends, written = pieces.dictionary.buffers()
        ends = np.frombuffer(ends, np.int64)[:len(pieces.dictionary) + 1].tolist() if len(starts) else [0]
        written = written.to_pybytes().decode("latin-1") if len(starts) else ""
        different = [written[x:y] for x, y in zip(ends, ends[1:])]
        return self._numbers(different)[pieces.indices.to_numpy()], np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))

    def encode(self, texts: Sequence[str | None]) -> tuple:
        """(ids of all texts, offsets): text k has ``ids[offsets[k]:offsets[k + 1]]``. Null is empty."""
        import numpy as np
        ids, sizes = [np.empty(0, np.uint32)], np.zeros(len(texts), np.int64)
        group: list[tuple] = []   # (number of the text, its pieces or, for a word vocabulary, itself)
        held, limit = 0, WORD_BYTES if self.words else MAX_PIECES // 4

        def flush():
            nonlocal held
            if group:
                if self.words:
                    at, of = self._cut([t for _, t in group])
                    of = np.append(0, of)
                else:
                    at = self._numbers([p for _, ps in group for p in ps])
                    of = np.append(0, np.cumsum([len(ps) for _, ps in group]))
                size = self.start[at + 1] - self.start[at]
                end = np.cumsum(size)
                ids.append(self.flat[np.repeat(self.start[at] - (end - size), size) + np.arange(end[-1] if len(end) else 0)])
                total = np.append(0, end)
                sizes[[k for k, _ in group]] = total[of[1:]] - total[of[:-1]]
                group.clear()
                held = 0

        for k, text in enumerate(texts):
            if not text:
                continue
            if not self._safe(text):
                flush()
                whole = self._whole(text)
                ids.append(whole)
                sizes[k] = len(whole)
                continue
            group.append((k, text if self.words else self._pieces(text)))
            held += len(group[-1][1])
            if held > limit:
                flush()
        flush()
        return np.concatenate(ids), np.append(0, np.cumsum(sizes))
