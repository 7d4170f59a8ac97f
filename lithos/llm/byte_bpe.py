"""Byte-level BPE encoding and decoding by the ranks of a .tiktoken file, with the tokenizers library's BPE model."""

from __future__ import annotations

import array
import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm._text import binary_array, ragged_take, raw, string_array, sums, text_slices
from lithos.llm.word_pieces import byte_letters

MEMO = 120_000
#: Texts in which a run of white space holds a blank that isn't the single one before a word; they are split whole.
_RUNS = re.compile(r"  |\s \s| \Z")


def read_ranks(path: str) -> list[bytes]:
    """The bytes of each id."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f.read().splitlines() if line]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [ranks[i] for i in range(len(ranks))]


def bpe_model(tokens: list[bytes]):
    """The tokenizers library's BPE over byte letters. Every split of a token into two tokens is a merge of that token's rank."""
    from tokenizers.models import BPE

    letters = byte_letters()
    shown = ["".join([letters[b] for b in t]) for t in tokens]
    vocab = {s: i for i, s in enumerate(shown)}
    merges = [(s[:k], s[k:]) for s in shown for k in range(1, len(s)) if s[:k] in vocab and s[k:] in vocab]
    return BPE(vocab=vocab, merges=merges, cache_capacity=0, ignore_merges=True)


class BytePieces:
    _loaded: dict[tuple[str, str], BytePieces] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> BytePieces:
        """Loaded once in each Python worker."""
        if (path, pattern) not in cls._loaded:
            cls._loaded[path, pattern] = cls(path, pattern)
        return cls._loaded[path, pattern]

    def __init__(self, path: str, pattern: str):
        self.tokens = read_ranks(path)
        self.model = bpe_model(self.tokens)
        self.pattern = regex.compile(pattern)
        self.letters = dict(enumerate(byte_letters()))
        self.memo: dict[str, bytes] = {}

    def piece(self, text: str) -> list[int]:
        return [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(self.letters))]

    def chunk(self, text: str) -> bytes:
        """The ids of a text as unsigned 32-bit integers, each match of the pattern separately."""
        ids = [i for m in self.pattern.finditer(text) for i in self.piece(m[0])]
        out = array.array("I", ids).tobytes()
        if len(self.memo) < MEMO and len(text) <= 64:
            self.memo[text] = out
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's begin.

        A match of the pattern holds a blank only at its start or within a run of white space, so
        texts are cut before single blanks and each distinct chunk is encoded once.
        """
        data, off = raw(texts)
        whole = string_array(data, off)
        odd = np.array([bool(_RUNS.search(t)) for t in whole.to_pylist()], bool)
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), whole) if odd.any() else whole
        chunks = pc.split_pattern(plain, " ")
        starts = np.asarray(chunks.offsets).astype(np.int64)
        starts -= starts[0]
        index = chunks.flatten().dictionary_encode()
        known = index.dictionary.to_pylist()
        code = np.asarray(index.indices).astype(np.int64)
        first = np.zeros(len(code), bool)
        first[starts[:-1]] = True
        lead = np.unique(code[first])
        held = self.memo.get
        ids = [held(" " + c) or self.chunk(" " + c) for c in known] + [self.chunk(known[c]) for c in lead]
        code = np.where(first, len(known) + np.searchsorted(lead, code), code)
        if odd.any():
            at = np.flatnonzero(odd)
            code[starts[at]] = np.arange(len(ids), len(ids) + len(at))
            ids += [self.chunk(whole[int(i)].as_py()) for i in at]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = ragged_take(np.frombuffer(b"".join(ids), np.uint32), (np.cumsum(lengths) - lengths)[code], lengths[code])
        return flat, np.concatenate([[0], np.cumsum(sums(lengths[code], starts))])

    def spans(self, ids: np.ndarray) -> np.ndarray:
        """Where each id's bytes start in the decoded bytes, and their end."""
        return np.concatenate([[0], np.cumsum([len(self.tokens[i]) for i in ids.tolist()], dtype=np.int64)])


def byte_bpe_encode(docs: DataFrame, ranks: str, pattern: str, *, offsets: bool = False, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, ids`` (and ``keep`` columns) for every whole text: ids as little-endian unsigned 32-bit integers in binary.

    ``offsets`` adds ``char_starts``, the index of the character in which each token's first byte
    lies: tokens that split one character share its index. Null and empty texts have no ids;
    repeated and null ids keep a row each; an empty table gives no rows; other columns than
    ``keep`` are ignored.
    """
    keep = keep or []
    schema = ", ".join(["id long", *[f"kept_{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(keep)], "ids binary", *["char_starts array<int>"] * offsets])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = BytePieces.of(ranks, pattern)
        for batch in batches:
            for part in text_slices(batch):
                flat, at = pieces.encode(part.column("text"))
                out = [part.column("id"), *[part.column(f"kept_{k}") for k in range(len(keep))], binary_array(flat.astype("<u4").view(np.uint8), at * 4)]
                if offsets:
                    data, off = raw(part.column("text"))
                    chars = [(np.cumsum((data[a:b] & 0xC0) != 0x80) - 1)[pieces.spans(flat[c:d])[:-1]].tolist() for a, b, c, d in zip(off, off[1:], at, at[1:], strict=False)]
                    out.append(pa.array(chars, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(out, ["id", *[f"kept_{k}" for k in range(len(keep))], "ids", *["char_starts"] * offsets])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"kept_{k}") for k, c in enumerate(keep)])
    done = chosen.mapInArrow(run, schema)
    return done.withColumnsRenamed({"id": id_col} | {f"kept_{k}": c for k, c in enumerate(keep)})


def byte_bpe_decode(encoded: DataFrame, ranks: str, *, id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` (and ``keep`` columns): the bytes that the ids stand for.

    Tokens are joined as bytes before anything is read as text, so characters that were split over
    tokens come back whole. Null ids decode to no bytes; an id outside the ranks fails the job.
    """
    keep = keep or []
    held = [f"kept_{k}" for k in range(len(keep))]
    schema = ", ".join(["id long", *[f"{h} {encoded.schema[c].dataType.simpleString()}" for h, c in zip(held, keep, strict=True)], "ids binary", "decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read_ranks(ranks)
        for batch in batches:
            for part in text_slices(batch, "ids"):
                yield pa.RecordBatch.from_arrays([part.column("id"), *[part.column(h) for h in held], part.column("ids"), _decoded(part.column("ids"), table)], ["id", *held, "ids", "decoded"])

    chosen = encoded.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).alias(h) for h, c in zip(held, keep, strict=True)], F.coalesce("ids", F.lit(b"")).alias("ids"))
    return chosen.mapInArrow(run, schema).withColumnsRenamed({"id": id_col} | dict(zip(held, keep, strict=True)))


def _decoded(ids: pa.Array, table: list[bytes]) -> pa.Array:
    data, off = raw(ids)
    flat = np.ascontiguousarray(data).view("<u4").tolist()
    cuts = (off // 4).tolist()
    return pa.array([b"".join([table[i] for i in flat[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())


def byte_bpe_round_trip(docs: DataFrame, ranks: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` (and ``keep`` columns): ``byte_bpe_encode`` and then ``byte_bpe_decode`` of its ids, in one Python worker a task."""
    keep = keep or []
    held = [f"kept_{k}" for k in range(len(keep))]
    schema = ", ".join(["id long", *[f"{h} {docs.schema[c].dataType.simpleString()}" for h, c in zip(held, keep, strict=True)], "ids binary", "decoded binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = BytePieces.of(ranks, pattern)
        for batch in batches:
            for part in text_slices(batch):
                flat, at = pieces.encode(part.column("text"))
                ids = binary_array(flat.astype("<u4").view(np.uint8), at * 4)
                yield pa.RecordBatch.from_arrays([part.column("id"), *[part.column(h) for h in held], ids, _decoded(ids, pieces.tokens)], ["id", *held, "ids", "decoded"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(h) for h, c in zip(held, keep, strict=True)])
    return chosen.mapInArrow(run, schema).withColumnsRenamed({"id": id_col} | dict(zip(held, keep, strict=True)))
