"""Token ids of whole texts, by a published tokenizer, one piece between white space at a time.

The tokenizer splits at white space first, so the ids of a text are those of its pieces between
ASCII white space, one after another. A Python worker keeps the ids of the pieces it has met for all its tasks;
beyond ``KEPT`` pieces (about 200 bytes each) it forgets them and starts anew. A text that
holds a special token's start ``<|`` is encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

FILE = "word_bpe_49k.json"
#: Pieces whose ids a worker keeps at most, but for those of one batch.
KEPT = 800_000
_MARKED = re.compile(rb"[.,;:!?]\Z")
#: Words of ASCII and Latin-1 letters: their lower case is plain, and they are composed already.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
# the byte-level alphabet: bytes that print stand for themselves, others follow from 256 on
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _spelled(word: str) -> str:
    return word if word.isascii() else word.encode().decode("latin-1").translate(_ALPHABET)


class _Pieces(dict):
    """Ids of pieces; a piece that is not there yet is encoded when it is asked for."""

    def __init__(self, tokenizer: Tokenizer, direct: bool) -> None:
        super().__init__()
        self._encode, self._tokenize, self._direct = tokenizer.encode, tokenizer.model.tokenize, direct

    def __missing__(self, piece: bytes) -> bytes:
        # a word is encoded apart from one mark that follows it, and in lower case
        stem = piece[:-1] if _MARKED.search(piece) else piece
        word = stem.decode("utf-8", "surrogatepass")
        if self._direct and _PLAIN(word):
            low = word.lower()
            key = low.encode()
            ids = self.get(key)
            if ids is None:
                ids = self[key] = array("I", [t.id for t in self._tokenize(_spelled(low))]).tobytes()
            if stem is not piece:
                ids += self._ids(piece[-1:])
        else:
            ids = self._ids(piece)
        self[piece] = ids
        return ids

    def _ids(self, piece: bytes) -> bytes:
        ids = self.get(piece)
        if ids is None:
            text = piece.decode("utf-8", "surrogatepass")
            ids = self[piece] = array("I", self._encode(text, add_special_tokens=False).ids).tobytes()
        return ids


class Encoder:
    """Ids as bytes, four for each id, little-endian."""

    def __init__(self, file: str = FILE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        # a word of plain letters is one piece of the model, if the tokenizer treats it as one
        sample = "thisisonewordoflettersçàßÿ"
        direct = [t.id for t in self._tokenizer.model.tokenize(_spelled(sample))] == (
            self._tokenizer.encode(sample, add_special_tokens=False).ids
        )
        self._kept = _Pieces(self._tokenizer, direct)

    def _whole(self, texts: list[str]) -> list[bytes]:
        got = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in got]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        kept = self._kept
        if len(kept) > KEPT:
            kept.clear()
        get = kept.__getitem__
        return [
            self._whole([text.decode("utf-8", "surrogatepass")])[0] if b"<|" in text
            else b"".join(map(get, text.split()))
            for text in texts
        ]


@lru_cache(maxsize=2)
def encoder(file: str = FILE) -> Encoder:
    """The encoder of this Python process, which its tasks share."""
    return Encoder(file)
