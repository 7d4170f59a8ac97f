"""Benchmark decontamination: a broadcast set of normalised test n-grams against the token windows of documents."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lithos.llm._spark import Scratch, written
from lithos.llm._text import class_words, grams, raw, text_slices, word_hashes

#: Bytes of benchmark text whose n-grams are broadcast at once; a larger benchmark is taken in blocks of about that size.
BLOCK_BYTES = 16 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTERS = np.zeros(256, bool)
_LETTERS[48:58] = _LETTERS[97:123] = _LETTERS[128:] = True

_HITS = "id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data, off = raw(texts)
    data = _LOWER[data]
    starts, ends, first = class_words(data, off, _LETTERS)
    return data, starts, ends, first, word_hashes(data, starts, ends)


class _Grams:
    """The n-grams of one block of benchmark items: hashes to sift by, and the exact words to verify by."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        self.owners: dict[bytes, list[str | None]] = defaultdict(list)
        by_length: dict[int, set[int]] = defaultdict(set)
        if items:
            data, starts, ends, first, hashes = _words(pa.array([t for _, t in items], pa.large_string()))
            for (name, _), a, b in zip(items, first.tolist(), first[1:].tolist(), strict=False):
                size = min(n, b - a)
                for i in range(a, b - size + 1 if size else a):
                    key = b" ".join(data[s:e].tobytes() for s, e in zip(starts[i : i + size], ends[i : i + size], strict=True))
                    self.owners[key].append(name)
                    by_length[size].add(int(grams(hashes[i : i + size], size, np.array([0, size]))[0][0]))
        self.sets = {k: np.array(sorted(v), np.uint64) for k, v in by_length.items()}
        self.sieve = {k: self._bits(v) for k, v in self.sets.items()}

    @staticmethod
    def _bits(hashes: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << 22, bool)
        bits[(hashes >> np.uint64(42)).astype(np.int64)] = True
        return bits

    def hits(self, words: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int, list[str]]]:
        """First word, number of words, and items of each window that occurs, verified word by word."""
        data, starts, ends, first, hashes = words
        for size, known in self.sets.items():
            found, whole = grams(hashes, size, first)
            at = np.flatnonzero(whole & self.sieve[size][(found >> np.uint64(42)).astype(np.int64)])
            at = at[np.isin(found[at], known)]
            for i in at.tolist():
                key = b" ".join(data[s:e].tobytes() for s, e in zip(starts[i : i + size].tolist(), ends[i : i + size].tolist(), strict=True))
                if key in self.owners:
                    yield i, size, self.owners[key]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every row of ``docs``.

    ``spans`` are the maximal ranges ``[start, end)`` of word positions that lie inside an occurrence
    of a window, a window being ``n`` consecutive words of an item or a shorter item whole; ``items``
    are the ids of items with windows that occur, as sorted strings. Windows are found by hash and
    verified word by word.

    What is broadcast is bounded by ``block_bytes`` of benchmark text: more is taken in blocks, each
    against all documents, and the blocks' ranges are united per document. Null texts have no words;
    items without words have no windows; an item without an id hits as others do and isn't named; repeated documents, null ids and repeated items keep their
    meaning; empty tables give no rows or no hits; other columns are ignored.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    if blocks > 1:
        chosen = written(chosen.withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    parts = []
    for b in range(blocks):
        known = spark.sparkContext.broadcast(_Grams([tuple(r) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()], n))
        parts.append(_against(chosen, known))
        if blocks > 1:  # one block at a time: its hits are written before the next is read
            parts[-1] = written(parts[-1], "hits")
            known.destroy()
    if blocks == 1:
        done = parts[0]
    else:
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        done = every.groupBy("row").agg(F.first("id").alias("id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        united = F.aggregate(F.array_sort("spans"), F.expr("cast(array() as array<struct<start:int,end:int>>)"), _unite)
        done = done.select("id", "n_words", united.alias("spans"), "items")
    return done.select(F.col("id").alias(id_col), "n_words", "spans", "items")


def _unite(have, x):
    last = F.element_at(have, -1)
    joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
    return F.when((F.size(have) > 0) & (F.try_element_at(have, F.lit(-1))["end"] >= x["start"]), F.concat(F.slice(have, 1, F.greatest(F.size(have) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(have, F.array(x)))


def _against(docs: DataFrame, known) -> DataFrame:
    with_row = "row" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words = _words(part.column("text"))
                first = words[3]
                cover = np.zeros(len(words[1]) + 1, np.int32)
                items: dict[int, set[str]] = defaultdict(set)
                for i, size, owners in known.value.hits(words):
                    cover[i] += 1
                    cover[i + size] -= 1
                    items[int(np.searchsorted(first, i, side="right")) - 1].update(owners)
                spans: list[list[dict[str, int]]] = [[] for _ in range(part.num_rows)]
                names: list[list[str]] = [[] for _ in range(part.num_rows)]
                inside = np.cumsum(cover) > 0
                for d, own in items.items():
                    names[d] = sorted(name for name in own if name is not None)
                    own_words = np.concatenate([[False], inside[first[d] : first[d + 1]], [False]])
                    edges = np.flatnonzero(own_words[1:] != own_words[:-1]).tolist()
                    spans[d] = [{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2], strict=True)]
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                out = [part.column("id"), pa.array(np.diff(first)), pa.array(spans, kind), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(out + ([part.column("row")] if with_row else []), ["id", "n_words", "spans", "items"] + ["row"] * with_row)

    return docs.mapInArrow(run, _HITS + ", row long" * with_row)


def remove_hits(docs: DataFrame, benchmark: DataFrame, *, n: int = 10, whole: bool = True, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a window (``whole``) or without the hit words.

    Each row is judged by its own text, in the passes that find the windows, so null and repeated ids
    are safe and nothing is joined back; items without an id count too. With ``whole=False`` a text loses, for each range of hit
    words, all from the first word's first character to the last word's last. More than
    ``block_bytes`` of benchmark text is taken in blocks, one pass each; with ``whole=False`` each
    pass adds its ranges beside the untouched text, and the last one cuts all. Each pass but the last is written
    to the shared folder, so the driver holds one block's windows at a time.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    # The ranges' column: a name that no column has.
    mark = "_ranges" + "_" * max(map(len, docs.columns))
    out, scratch = docs, Scratch(spark)
    for b in range(blocks):
        known = spark.sparkContext.broadcast(_Grams([tuple(r) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()], n))
        before, out = out, _without(out, docs, known, whole, text_col, mark, b == blocks - 1)
        if b < blocks - 1:  # one block at a time: what it leaves is written before the next is read
            out = scratch.write(out, "kept")
            known.destroy()
            scratch.drop(before)
    return out


def _without(given: DataFrame, docs: DataFrame, known, whole: bool, text_col: str, mark: str, last: bool) -> DataFrame:
    """``given`` without rows that one block hits, or with its ranges in ``mark``, or at the last block without all hit words."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text_col):
                texts = part.column(text_col)
                words = _words(texts)
                _, starts, ends, first, _ = words
                cover = np.zeros(len(starts) + 1, np.int32)
                for i, size, _ in known.value.hits(words):
                    cover[i] += 1
                    cover[i + size] -= 1
                if mark in part.schema.names:
                    for d, edges in enumerate(part.column(mark).to_pylist()):
                        np.add.at(cover, first[d] + np.array(edges[::2], np.int64), 1)
                        np.add.at(cover, first[d] + np.array(edges[1::2], np.int64), -1)
                    part = part.drop_columns([mark])
                inside = np.cumsum(cover)[:-1] > 0
                hit = np.add.reduceat(np.append(inside, False).astype(np.int64), first[:-1]) * (np.diff(first) > 0) > 0 if len(first) > 1 else np.zeros(0, bool)
                if whole:
                    yield part.filter(pa.array(~hit))
                    continue
                if not last:
                    edges = [np.flatnonzero(np.diff(np.concatenate([[False], inside[a:b], [False]]).astype(np.int8))).tolist() for a, b in zip(first.tolist(), first[1:].tolist(), strict=False)]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(edges, pa.list_(pa.int32()))], [*part.schema.names, mark])
                    continue
                new = texts.to_pylist()
                off = raw(texts)[1]
                for d in np.flatnonzero(hit).tolist():
                    own = np.concatenate([[False], inside[first[d] : first[d + 1]], [False]])
                    edges = np.flatnonzero(own[1:] != own[:-1]) + first[d]
                    text, out, at = new[d].encode(), b"", 0
                    for a, b in zip(edges[::2], edges[1::2], strict=True):
                        out, at = out + text[at : starts[a] - off[d]], int(ends[b - 1] - off[d])
                    new[d] = (out + text[at:]).decode()
                k = names.index(text_col)
                yield part.set_column(k, part.schema.field(k), pa.array(new, texts.type))

    return given.mapInArrow(run, docs.schema if whole or last else T.StructType([*docs.schema.fields, T.StructField(mark, T.ArrayType(T.IntegerType()))]))
