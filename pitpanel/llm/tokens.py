"""Token ids of texts as the tokenizers library gives them, each white-space delimited unit encoded once per worker.

Where a text holds white space or control characters beyond blank, tab and line ends, the whole text is encoded by the
library. Otherwise its units are looked up among those met before (a bounded cache); new units of plain Latin letters,
digits and ASCII signs go through the library's BPE model piece by piece, all other units through its whole pipeline.
"""

from __future__ import annotations

import functools
import re

#: Characters for which cutting a text before white space could change its pieces.
ODD = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]|<\\|")
UNIT = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[\\t\\n\\r\\x20-\\x7e{_LATIN}]*")
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
#: The pre-tokenizers of the two kinds of file, for plain units.
PIECES = {
    True: re.compile(f"{_ENDINGS}| ?[{_LATIN}]+| ?[0-9]+| ?[^\\s{_LATIN}0-9]+|\\s+(?!\\S)|\\s+"),
    False: re.compile(f"{_ENDINGS}|[{_LATIN}]+|[0-9]|[^\\s{_LATIN}0-9]+"),
}


def byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(rest)}


class Encoder:
    """encode(text) -> little-endian unsigned ids of `width` (2 or 4) bytes each, without special tokens added."""

    def __init__(self, path: str, width: int = 4, units: int = 1 << 19):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok, self.most, self.kind = Tokenizer.from_file(path), units, "H" if width == 2 else "I"
        self.keeps_space = self.tok.normalizer is None
        known = self.keeps_space or getattr(self.tok.model, "end_of_word_suffix", None) == "</w>"
        self.fast = known and "ByteLevel" in str(self.tok.pre_tokenizer)
        self.letters = byte_letters()
        self.cache: dict[str, bytes] = {}  # by unit
        self.pieces: dict[str, bytes] = {}  # by piece of a plain unit
        self.find = PIECES[self.keeps_space].findall

    def pack(self, ids: list[int]) -> bytes:
        from array import array

        return array(self.kind, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tok.encode(text, add_special_tokens=False).ids)

    def unit(self, unit: str) -> bytes:
        if not PLAIN.fullmatch(unit):
            return self.whole(unit)
        if not self.keeps_space:
            unit = unit.lower()
        found, known, model = [], self.pieces, self.tok.model
        for p in self.find(unit):
            ids = known.get(p)
            if ids is None:
                if len(known) > self.most:
                    known.clear()
                ids = known[p] = self.pack([t.id for t in model.tokenize(p.encode().decode("latin-1").translate(self.letters))])
            found.append(ids)
        return b"".join(found)

    def _units(self, text: str) -> list[str]:
        """Units in order; for files that keep white space, those led by one blank come without it, others after a mark."""
        if not self.keeps_space:
            return text.split()
        if "  " in text or "\n " in text or "\t" in text or "\r" in text or text[-1:].isspace():
            return ["\0" + u for u in UNIT.findall(text)]
        units = text.split(" ")
        units[0] = "\0" + units[0]
        return units

    def _new(self, unit: str) -> bytes:
        if not self.keeps_space:
            return self.unit(unit)
        unit = unit[1:] if unit[:1] == "\0" else " " + unit
        if "\n" in unit:
            return b"".join([self.unit(u) for u in UNIT.findall(unit)])
        return self.unit(unit)

    def encode(self, text: str) -> bytes:
        if not self.fast or ODD.search(text) or "\0" in text:
            return self.whole(text)
        cache, units = self.cache, self._units(text)
        found = [cache.get(u) for u in units]
        if None in found:
            if len(cache) > self.most:
                cache.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    u = units[i]
                    found[i] = ids = cache.get(u) or self._new(u)
                    if len(u) < 64:
                        cache[u] = ids
        return b"".join(found)


@functools.cache
def encoder(path: str, width: int = 4) -> Encoder:
    """One per Python worker; it outlives tasks."""
    return Encoder(path, width)


def width_of(path: str, *more: int) -> int:
    """Bytes that hold every id of the tokenizer and the given ones: 2 or 4."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) - 1, *more) < 1 << 16 else 4
