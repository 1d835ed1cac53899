"""Token ids of whole texts with the ``tokenizers`` library, for tasks that encode many texts.

A byte-level pre-tokenizer starts a new piece at every single space that stands between two other characters, so a
text can be cut there and each chunk encoded on its own with the same ids.  A single line feed between two other
characters is a piece of its own, so a chunk can be cut around it as well.  Chunks repeat, so their ids are kept in
dictionaries of bounded size; new chunks go through the library's pre-tokenizer and model.  A text that contains the
string of an added token (``<|endoftext|>``), and every text of a tokenizer of another kind, is encoded whole by the
library, with the tokenizer's own defaults.  Ids are little-endian unsigned integers of two bytes, or four for larger vocabularies.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

CHUNKS, HEADS, PIECES = 550_000, 100_000, 60_000
_LONGEST_KEY = 64
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = frozenset(".,;:!?")
#: Byte-level alphabet: bytes that print stand for themselves, the others for the characters from U+0100 on.
_PRINT = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: 0x100 + i for i, b in enumerate(sorted(set(range(0x100)) - set(_PRINT)))}


def _letters(word: str) -> str:
    """A word of letters in the byte-level alphabet."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)


class _Cache(dict):
    """Ids by key, filled on demand.  When ``size`` keys are new, only those used since the last time stay."""

    def __init__(self, size: int, make) -> None:
        super().__init__()
        self.size, self.make, self.old = size, make, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= _LONGEST_KEY and "\n" not in key:  # chunks over two lines seldom repeat; their parts are kept
            if len(self) >= self.size:
                self.old.clear()
                self.old.update(self)
                self.clear()
            self[key] = ids
        return ids


class Encoder:
    """Encodes texts to packed ids; ``dtype`` is the numpy type of one id."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.dtype = np.dtype("<u4" if wide else "<u2")
        self.kind = "I" if wide else "H"
        first = self.tokenizer.pre_tokenizer
        self.by_chunk = (isinstance(first, pre_tokenizers.ByteLevel) and not first.add_prefix_space
                         and first.use_regex and self.tokenizer.normalizer is None)
        if self.by_chunk:
            self.split, self.model = first.pre_tokenize_str, self.tokenizer.model
            self.pieces = _Cache(PIECES, self._piece)
            self.chunks = _Cache(CHUNKS, self._chunk)
            self.heads = _Cache(HEADS, self._head)
            self.line_feed = self._text("\n")

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token in the byte-level alphabet."""
        return array(self.kind, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _text(self, text: str) -> bytes:
        return b"".join([self.pieces[piece] for piece, _ in self.split(text)])

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a space and the chunk after it."""
        if chunk.isalpha():
            return self._piece("Ġ" + _letters(chunk))
        if chunk[-1:] in _MARKS and chunk[:-1].isalpha():
            return self.chunks[chunk[:-1]] + self.pieces[chunk[-1]]
        if "\n" in chunk:
            lines = chunk.split("\n")
            if all(lines) and len(lines) == len(chunk.split()):  # single line feeds, no other white space
                return self.chunks[lines[0]] + b"".join([self.line_feed + self.heads[x] for x in lines[1:]])
        return self._text(" " + chunk)

    def _head(self, chunk: str) -> bytes:
        """Ids of a chunk without a space before it."""
        if chunk.isalpha():
            return self._piece(_letters(chunk))
        if chunk[-1:] in _MARKS and chunk[:-1].isalpha():
            return self.heads[chunk[:-1]] + self.pieces[chunk[-1]]
        return self._text(chunk)

    def encode(self, text: str | None) -> bytes:
        """Packed ids of a text without special tokens; none for null or empty."""
        if not text:
            return b""
        if not self.by_chunk or any(token in text for token in self.added):
            return array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        parts = text.split(" ") if "  " not in text and text[0] != " " and text[-1] != " " else _CUT.split(text)
        head = self._text(parts[0])
        return head + b"".join(map(self.chunks.__getitem__, parts[1:])) if len(parts) > 1 else head

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.dtype)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process, with the chunks that its earlier tasks met."""
    return Encoder(path)
