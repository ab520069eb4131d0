"""Whole-text encoding with a public tokenizer, memoised by word."""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

MEMO = 800_000      # stretches of text in each of the two generations a worker keeps
PIECES = 400_000    # pieces of stretches that a worker keeps
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
# Latin letters that stay one letter through NFC and lower case
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
_PLAIN = re.compile(f" ?[!-~{_LATIN}]+")
# The tokenizers' own patterns for what comes before any merge, over the characters of _PLAIN
_SPACED_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^ 0-9{_LATIN}]+")
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^ 0-9{_LATIN}]+")


def _byte_letters() -> dict[int, str]:
    """The printable characters by which byte-level vocabularies write the UTF-8 bytes of a character
    of _PLAIN: a printable Latin-1 byte is itself, the others count up from U+0100 in their order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(shown))
    letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x180)}


_LETTERS = _byte_letters()


class Stretches(dict):
    """Ids of stretches; one that is not there is looked up in the generation before, or learned.
    A full dictionary becomes that generation."""

    def __init__(self, learn, most: int):
        super().__init__()
        self.learn, self.most, self.old = learn, most, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(key)
        if ids is None:
            ids = self.learn(key)
        self[key] = ids
        return ids


class Encoder:
    """Token ids of texts as the tokenizer gives them (special tokens' strings are ordinary text).

    Both tokenizers split a text before any of their merges, and always at a
    single space between two other characters, around a single line break
    between two, and between a letter or digit and a full stop or comma. Ids of
    the stretches between are kept and looked up again. ``spaced``: the space
    belongs to what follows (else white space and case are dropped). A key that
    starts with NUL follows no space. A new stretch of ASCII and Latin letters is
    cut by the tokenizer's pattern and its pieces go to the tokenizer's merges;
    any other goes through the whole tokenizer.
    """

    def __init__(self, path: str, spaced: bool, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.spaced = spaced
        self.merge = self.tok.model.tokenize
        self.lead = " " if spaced else ""
        self.cut_pieces = (_SPACED_PIECE if spaced else _PIECE).findall
        self.pieces: dict[str, bytes] = {}
        self.memo = Stretches(self._learn, memo)

    def _piece(self, text: str) -> bytes:
        """Ids of one piece, by the tokenizer's merges."""
        if text.isascii():
            shown = "\u0120" + text[1:] if text[0] == " " else text
        else:
            shown = text.translate(_LETTERS)
        got = array("I", [t.id for t in self.merge(shown)]).tobytes()
        if len(self.pieces) >= PIECES:
            self.pieces.clear()
        self.pieces[text] = got
        return got

    @staticmethod
    def cut(text: str) -> list[str]:
        words = text.split()
        gaps = text.count(" ") + text.count("\n")
        if "\0" in text or len(words) != gaps + 1 or len("".join(words)) + gaps != len(text):
            parts = _BETWEEN.split(text)        # white space of other kinds or beside other white space
            return [f"\0{parts[0]}", *(f" {p}" if p[0] == "\0" else p for p in parts[1:])]
        return ("\0" + text.replace("\n", " \0\n \0")).split(" ")

    def _ids(self, piece: str) -> bytes:
        return self.pieces.get(piece) or self._piece(piece)

    def _learn(self, k: str) -> bytes:
        """Ids of a stretch as :meth:`cut` gives it."""
        if k.isascii():
            word, last = (k, "") if k.isalpha() else (k[:-1], k[-1])
            if word.isalpha() and (not last or last in ".,"):       # one piece, or a word and its stop or comma
                ids = self._ids(self.lead + (word if self.spaced else word.lower()))
                return ids + self._ids(last) if last else ids
        if k[0] == "\0":
            core = k[1:]
        elif k[:2] == " \0":
            core = self.lead + k[1:]
        else:
            core = self.lead + k
        if _PLAIN.fullmatch(core) is None:
            return array("I", self.tok.encode(core, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self._ids, self.cut_pieces(core if self.spaced else core.lower())))

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        get = self.memo.__getitem__
        return [np.frombuffer(b"".join(map(get, self.cut(t))), np.uint32) for t in texts]


@lru_cache(maxsize=2)
def encoder(path: str, spaced: bool, memo: int = MEMO) -> Encoder:
    return Encoder(path, spaced, memo)
