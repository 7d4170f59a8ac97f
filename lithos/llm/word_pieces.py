"""Word-end BPE pieces of texts, each distinct chunk of a slice being worked out once.

White space never reaches the pieces of this vocabulary (its normalizer folds it, its
pre-tokenizer drops it), so a text may be cut at blanks and its chunks encoded apart.
A chunk's pre-tokens go straight to the library's BPE model; chunks with controls, special
strings or letters beyond Latin go through the library's whole pipeline.
"""

from __future__ import annotations

import array
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from lithos.llm._text import raw, string_array

#: Chunks whose ids a Python worker remembers; the memory it may hold for that is about 60 MB.
MEMO = 300_000
#: Bytes of text whose distinct chunks are found together.
WIDE_SLICE = 12 << 20

_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_WIDE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_ODD = re.compile(r"[\x00-\x1f\x7f-\xa0Σ]|<\|")
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[9, 10, 11, 12, 13]] = 32
#: Lower case makes fewer distinct chunks. Special strings are matched in the text as it stands, so slices that may hold one keep their case.
_LOWER_AND_BLANK = _BLANK.copy()
_LOWER_AND_BLANK[65:91] += 32


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class WordPieces:
    """Ids of chunks under one tokenizer file of this kind."""

    _loaded: dict[str, WordPieces] = {}

    @classmethod
    def of(cls, path: str) -> WordPieces:
        """Loaded once in each Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=model["end_of_word_suffix"], cache_capacity=0)
        self.letters = dict(enumerate(byte_letters()))
        self.memo: dict[str, bytes] = {}

    def chunk(self, text: str) -> bytes:
        """The ids of a chunk as unsigned 32-bit integers."""
        if text.isascii() and text.isalpha():
            ids = [t.id for t in self.model.tokenize(text.lower())]
        elif _ODD.search(text) or max(text, default=" ") > "ɏ":
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = []
            for word in self.pretokens(text):
                if not word.isascii():
                    word = word.encode().decode("latin-1").translate(self.letters)
                ids += [t.id for t in self.model.tokenize(word)]
        out = array.array("I", ids).tobytes()
        if len(self.memo) < MEMO and len(text) <= 64:
            self.memo[text] = out
        return out

    @staticmethod
    def pretokens(text: str) -> list[str]:
        if text.isascii():
            return _ASCII.findall(text.lower())
        text = unicodedata.normalize("NFC", text).lower()
        return [text] if text.isalpha() else _WIDE.findall(text)

    def frequencies(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """The texts as indices of distinct chunks, where each text starts in them, and the ids of each distinct chunk."""
        data, off = raw(texts)
        fold = _BLANK if b"<|" in data.tobytes() else _LOWER_AND_BLANK
        data, off = _stops_apart(fold[data], off)
        chunks = pc.split_pattern(string_array(data, off), " ")
        index = chunks.flatten().dictionary_encode()
        starts = np.asarray(chunks.offsets).astype(np.int64)
        known = self.memo.get
        ids = [known(c) or self.chunk(c) for c in index.dictionary.to_pylist()]
        return np.asarray(index.indices), starts - starts[0], ids


def _stops_apart(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A blank put before each stop or comma between a letter a-z and a blank: it is a pre-token of its own there."""
    if len(data) < 3:
        return data, off
    mid = data[1:-1]
    at = np.flatnonzero(((mid == 46) | (mid == 44)) & (data[2:] == 32) & (data[:-2] >= 97) & (data[:-2] <= 122)) + 1
    return np.insert(data, at, 32), off + np.searchsorted(at, off)
