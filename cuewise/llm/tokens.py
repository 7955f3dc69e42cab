"""Token ids of whole texts by a public tokenizer file, with a bounded cache of words.

The tokenizer drops white space and no pre-token spans it, so the ids of a text are those of its words in a
row. A word of printable Latin characters goes straight to the library's BPE model piece by piece; any other word, and
any that holds a special token's marker, goes through the library's whole pipeline. Tests hold both to be equal.
"""

from __future__ import annotations

import functools
import struct
import unicodedata

import regex

END_ID = 1
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _byte_letters() -> list[str]:
    """The printable stand-ins of bytes in byte-level BPE: itself if printable, else from 256 on in order."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, more = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else more))
        more += b not in plain
    return out


_LETTERS = _byte_letters()


class WordIds(dict):
    """word (UTF-8 bytes) -> its ids as little-endian unsigned 32-bit integers.

    Holds at most `most` words, and half as many pieces of words, some 200 bytes each; then it starts anew.
    """

    def __init__(self, path: str, most: int = 800_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.most = most
        self.pieces: dict[str, bytes] = {}
        self.spaceless = self.whole.encode("a b", add_special_tokens=False).ids == [
            *self.whole.encode("a", add_special_tokens=False).ids,
            *self.whole.encode("b", add_special_tokens=False).ids,
        ]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.clear()
        if word.isascii() and (lower := word.lower()).isalpha():
            out = self._piece(lower.decode())
        else:
            text = word.decode("utf-8", "replace")
            if "<|" in text or max(text) > "\xff" or not text.isprintable():
                out = _packed(self.whole.encode(text, add_special_tokens=False).ids)
            else:
                out = b"".join(map(self._piece, _PIECES.findall(unicodedata.normalize("NFC", text).lower())))
        self[word] = out
        return out

    def _piece(self, piece: str) -> bytes:
        if (got := self.pieces.get(piece)) is None:
            if len(self.pieces) >= self.most // 2:
                self.pieces.clear()
            mapped = piece if piece.isascii() else "".join([_LETTERS[b] for b in piece.encode()])
            got = self.pieces[piece] = _packed([t.id for t in self.model.tokenize(mapped)])
        return got

    def text(self, text: bytes) -> bytes:
        """The ids of a whole text, without an end id."""
        if not self.spaceless:
            return _packed(self.whole.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids)
        return b"".join(map(self.__getitem__, text.split()))


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """One cache for all tasks of a Python worker."""
    return WordIds(path)
