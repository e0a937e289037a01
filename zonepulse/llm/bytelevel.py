"""Byte-level BPE ids of whole texts, with the ids of frequent stretches of text remembered."""

from __future__ import annotations

import struct
from array import array

import numpy as np
import regex
from tokenizers import Tokenizer

#: How the public byte-level model cuts a text before merging.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Letters below this one are of one class in every version of Unicode; others go to the library whole.
SETTLED = "ɐ"
REMEMBERED = 1_000_000
#: Signs after a word, none of which starts a contraction, are a token run of their own.
SIGNS = ".,;:!?*%&#$)"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(others)) for b in range(256)]


#: Packs so many ids; words seldom have more.
_PACK = [struct.Struct(f"={n}I").pack for n in range(8)]
LETTERS = dict(enumerate(byte_letters()))
SPACE = LETTERS[0x20]


def as_letters(text: str) -> str:
    return text.encode().decode("latin-1").translate(LETTERS)


class _Pretokens(dict):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = ids = array("I", [t.id for t in self.model.tokenize(as_letters(word))]).tobytes()
        return ids


class _RunOfSpace(Exception):
    """A stretch begins with white space: it belongs to the one before."""


class _Stretches(dict):
    """Ids of what follows a space, up to the next one, that space included; new ones are learned.

    A plain word is one pretoken; signs after it are one more.
    """

    def __init__(self, encoder: ByteLevel):
        super().__init__()
        self.encoder, self.tokenize = encoder, encoder.tokenizer.model.tokenize

    def __missing__(self, part: str) -> bytes:
        word = part if part.isalpha() else part.rstrip(SIGNS)
        if word.isalpha() and ((plain := word.isascii()) or max(word) < SETTLED):
            if word is part or (ids := self.get(word)) is None:
                found = self.tokenize(SPACE + word if plain else SPACE + as_letters(word))
                ids = [t.id for t in found]
                self[word] = ids = _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else array("I", ids).tobytes()
            if len(word) == len(part):
                return ids
            ids += self.encoder.pretokens[part[len(word) :]]
        elif not part or part[0].isspace():
            raise _RunOfSpace
        else:
            ids = self.encoder.stretch(" " + part)
        self[part] = ids
        return ids


class ByteLevel:
    """A tokenizer file of the library; `plain` takes special tokens' strings in a text as text.

    No token crosses the place before a space that something other than white space follows, so
    a text's ids are those of its stretches in a row.
    """

    def __init__(self, path: str, plain: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.specials = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pretokens = _Pretokens(self.tokenizer.model)
        self.stretches = _Stretches(self)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def stretch(self, text: str) -> bytes:
        if not text:
            return b""
        if text.isascii() or max(text) < SETTLED:
            return b"".join(map(self.pretokens.__getitem__, PRETOKEN.findall(text)))
        return self.whole(text)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if any(special in text for special in self.specials):
            return self.whole(text)
        first, *parts = text.split(" ")
        if len(self.stretches) > REMEMBERED:
            self.stretches.clear()
        try:
            return self.stretch(first) + b"".join(map(self.stretches.__getitem__, parts))
        except _RunOfSpace:
            return self._with_runs_of_space(first, parts)

    def _with_runs_of_space(self, first: str, parts: list[str]) -> bytes:
        """White space in a row is cut by the library's rule, together with the stretch before it."""
        out, open_ = [], [first]
        for part in parts:
            if part and not part[0].isspace():
                out.append(self.stretch(" ".join(open_)))
                open_ = [""]
            open_.append(part)
        return b"".join([*out, self.stretch(" ".join(open_))])


_LOADED: dict[tuple[str, bool], ByteLevel] = {}


def loaded(path: str, plain: bool = False) -> ByteLevel:
    if (path, plain) not in _LOADED:
        _LOADED[path, plain] = ByteLevel(path, plain)
    return _LOADED[path, plain]
