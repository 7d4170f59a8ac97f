"""Suffix-array dedup: bytes of strings of 50 that an earlier document holds too, by bucket-pointer refinement.

Suffixes are never sorted as text. Each position starts in the bucket of its 8 bytes, and a bucket is refined by
the bucket at a later offset, again and again over what the refinement before gave: 8 bytes and the 8 after them
name 16, then 20 (the q-gram), 40 and 50. The classes at both ends of a range name the class of the range.

Only few suffixes have to meet. Of the q-grams within 50 bytes the one of least identifier is the anchor of
those 50 bytes, wherever they occur, so a string that two documents share has the same anchor in both. An
anchor owns the consecutive strings that chose it (about 16), and a document is entered by its anchors:

1. anchors with one q-gram meet; those of a q-gram that a single document holds are done;
2. where a range equals one of an earlier document, all of its strings are repeats;
3. only where ranges of a q-gram differ are strings entered one by one, and only those of the first
   document of each range, which stands for all that hold it.

Q-grams, ranges and strings that very many documents hold are found in a sample beforehand: each task combines a hot
range's or string's rows into two, and its least id is told to all; a hot q-gram's ranges are dealt by themselves and all entered.

Identifiers are 64-bit hashes of what they name. Ranges are compared within their q-gram only, so m ranges of one q-gram
give a false repeat with a chance of m * m / 2**65; strings are compared by two such hashes, n of them with n * n / 2**129.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lithos.llm._spark import written
from lithos.llm._text import mixed, raw, text_slices

#: Bytes of a repeated string, and of the q-gram that first names a position's bucket.
LENGTH, Q = 50, 20
#: Bytes of text worked on at once: arrays of 8 bytes for each then stay near the processor (31 ns a byte; 79 with 4 MB).
SLICE_BYTES = 1 << 19
#: A q-gram or range is hot if one row in so many is its; so many are hot at most. They are looked for in one document of ``SAMPLE``.
HOT, SAMPLE = 10_000, 64


@dataclass
class _Buckets:
    """Of joined texts: the class of the string from each position on, and the ranges of strings that share an anchor."""

    strings: np.ndarray  # class of the LENGTH bytes from here on, where they lie within one text
    text: np.ndarray  # of each range: index of its text
    first: np.ndarray  # its first and last string
    last: np.ndarray
    gram: np.ndarray  # its anchor's bucket
    range: np.ndarray  # its class


def _refined(own: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of buckets of pairs: one to one in either of the two while the other is held."""
    h = own * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += later
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as one number."""
    two = data[:-1] | (data[1:].astype(np.uint16) << np.uint16(8))
    four = two[:-2] | (two[2:].astype(np.uint32) << np.uint32(16))
    return four[:-4] | (four[4:].astype(np.uint64) << np.uint64(32))


def _second_names(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifiers of the strings at some positions by another rule, from their bytes."""
    out = np.full(len(at), LENGTH, np.uint64)
    if len(at):
        words = _words(data)
        for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
            out = mixed(out * np.uint64(0xD6E8FEB86659FD93) + words[at + k])
    return out


def _buckets(data: np.ndarray, off: np.ndarray) -> _Buckets:
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return _Buckets(np.zeros(0, np.uint64), none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64))
    # Each bucket of 8 bytes is refined by the bucket at a later offset: to 16, 20 (= Q), 40 and 50 (= LENGTH) bytes.
    gram = _words(data)
    for later in (8, Q - 16):
        gram = _refined(gram[:-later], gram[later:])
    strings = gram
    for later in (Q, LENGTH - 2 * Q):
        strings = _refined(strings[:-later], strings[later:])
    count, span = n - LENGTH + 1, LENGTH - Q + 1
    # Least q-gram of each string, by doubling.
    least, width = gram, 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    least = np.minimum(least[:count], least[span - width : span - width + count])
    # A range ends where the least q-gram or the text does; one that repeats its q-gram is cut after ``span`` strings.
    new = np.ones(count, bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    for cut in (off[:-1], np.maximum(off[:-1], off[1:] - LENGTH + 1)):
        new[cut[cut < count]] = True
    first = np.flatnonzero(new)
    size = np.diff(first, append=count)
    if size.max() > span:
        pieces = -(-size // span)
        step = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + step * span
        size = np.diff(first, append=count)
    text = np.searchsorted(off, first, side="right") - 1
    inside = first + LENGTH <= off[text + 1]
    first, size, text = first[inside], size[inside], text[inside]
    last = first + size - 1
    whole = _refined(_refined(strings[first], strings[last]), size.astype(np.uint64))
    return _Buckets(strings, text, first, last, least[first], whole)


@dataclass
class _Hot:
    """Identifiers of q-grams, of ranges and of strings of these q-grams that very many documents hold, in order."""

    grams: np.ndarray
    ranges: np.ndarray
    strings: np.ndarray


def _among(ids: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Which ids are among the ordered ``held``."""
    if not len(held):
        return np.zeros(len(ids), bool)
    return held[np.minimum(np.searchsorted(held, ids), len(held) - 1)] == ids


def _own_ranges(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``gram, range, id`` of the ranges of each text, once each."""
    b = _buckets(*raw(part.column("text")))
    _, once = np.unique(mixed(b.range + mixed(b.text.astype(np.uint64) + np.uint64(1))), return_index=True)
    once.sort()
    return b.gram[once], b.range[once], np.asarray(part.column("id"), np.int64)[b.text[once]]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, limit=SLICE_BYTES):
            grams, ranges, _ = _own_ranges(part)
            yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int64)), pa.array(ranges.astype(np.int64))], ["gram", "range"])


def _sampled_strings(grams: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                b = _buckets(*raw(part.column("text")))
                of = _among(b.gram, grams)
                yield pa.RecordBatch.from_arrays([pa.array(b.strings[_spread(b.first[of], b.last[of])].astype(np.int64))], ["string"])

    return run


def _ranges(hot) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``key, range, id, kind`` of each text's ranges (kind: 1 of a hot q-gram, 2 a hot range, 3 both); of a hot range, of all of a task's texts, only the least and the greatest id.

    The key is the q-gram, and for hot q-grams, whose ranges are opened without being compared, the range.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Hot = hot.value
        ends: dict[tuple[int, int], tuple[int, int]] = {}

        def rows(grams: np.ndarray, ranges: np.ndarray, ids: np.ndarray, common: bool) -> pa.RecordBatch:
            opened = _among(grams, known.grams)
            keys = np.where(opened, mixed(ranges), grams)
            return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(ranges.astype(np.int64)), pa.array(ids), pa.array(opened.astype(np.int8) + np.int8(2 * common))], ["key", "range", "id", "kind"])

        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                grams, ranges, ids = _own_ranges(part)
                common = _among(ranges, known.ranges)
                for pair, i in zip(zip(grams[common].tolist(), ranges[common].tolist(), strict=True), ids[common].tolist(), strict=True):
                    low, high = ends.get(pair, (i, i))
                    ends[pair] = (min(low, i), max(high, i))
                yield rows(grams[~common], ranges[~common], ids[~common], False)
        if ends:
            pairs = np.array(list(ends), np.uint64)
            yield rows(np.repeat(pairs[:, 0], 2), np.repeat(pairs[:, 1], 2), np.array(list(ends.values()), np.int64).ravel(), True)

    return run


def _listed(column: pa.Array) -> np.ndarray:
    """Identifiers of each row's list, tied to the row's index, for membership among all rows at once."""
    sizes = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
    return mixed(np.asarray(column.flatten(), np.int64).astype(np.uint64) + mixed(np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64) + np.uint64(1)))


def _in(ids: np.ndarray, text: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return np.isin(mixed(ids + mixed(text.astype(np.uint64) + np.uint64(1))), listed)


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All positions of ranges."""
    size = last - first + 1
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


def _strings(hot: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``string, second, id, hot`` of each text's opened ranges; of a hot string, of all of a task's texts, only the least and the greatest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[tuple[int, int], tuple[int, int]] = {}

        def rows(names: np.ndarray, seconds: np.ndarray, ids: np.ndarray, common: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(seconds.astype(np.int64)), pa.array(ids), pa.array(np.full(len(ids), common))], ["string", "second", "id", "hot"])

        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                data, off = raw(part.column("text"))
                b = _buckets(data, off)
                own = _in(b.range, b.text, _listed(part.column("open")))
                at = _spread(b.first[own], b.last[own])
                text = np.repeat(b.text[own], b.last[own] - b.first[own] + 1)
                _, once = np.unique(mixed(b.strings[at] + mixed(text.astype(np.uint64) + np.uint64(1))), return_index=True)
                at, ids = at[once], np.asarray(part.column("id"), np.int64)[text[once]]
                names, seconds = b.strings[at], _second_names(data, at)
                common = _among(names, hot.value.strings)
                for pair, i in zip(zip(names[common].tolist(), seconds[common].tolist(), strict=True), ids[common].tolist(), strict=True):
                    low, high = ends.get(pair, (i, i))
                    ends[pair] = (min(low, i), max(high, i))
                yield rows(names[~common], seconds[~common], ids[~common], False)
        if ends:
            pairs = np.array(list(ends), np.uint64)
            yield rows(np.repeat(pairs[:, 0], 2), np.repeat(pairs[:, 1], 2), np.array(list(ends.values()), np.int64).ravel(), True)

    return run


@dataclass
class _Lows:
    """Hot ranges and hot strings, in order, and the least id that holds each."""

    ranges: np.ndarray
    range_ids: np.ndarray
    strings: np.ndarray
    string_ids: np.ndarray
    grams: np.ndarray


def _removed(part: pa.RecordBatch, lows: _Lows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts, and which bytes go."""
    data, off = raw(part.column("text"))
    ranges, strings = part.column("ranges"), part.column("strings")
    gone = np.zeros(len(data) + 1, np.int32)
    b = _buckets(data, off)
    if len(b.text):
        whole = _in(b.range, b.text, _listed(ranges))
        ids = np.asarray(part.column("id").fill_null(np.iinfo(np.int64).min), np.int64)  # rows without an id keep all
        common = np.flatnonzero(_among(b.range, lows.ranges))
        if len(common):
            whole[common] |= ids[b.text[common]] > lows.range_ids[np.searchsorted(lows.ranges, b.range[common])]
        at = [_spread(b.first[whole], b.last[whole])]
        of = _among(b.gram, lows.grams) & ~whole
        if of.any():
            rest = _spread(b.first[of], b.last[of])
            text = np.repeat(b.text[of], b.last[of] - b.first[of] + 1)
            held = _among(b.strings[rest], lows.strings)
            rest, text = rest[held], text[held]
            at.append(rest[ids[text] > lows.string_ids[np.searchsorted(lows.strings, b.strings[rest])]])
        listed = _listed(strings)
        if len(listed):
            some = ~whole & np.isin(b.text, np.flatnonzero(np.array([bool(x) for x in strings.value_lengths().fill_null(0).to_pylist()])))
            rest = _spread(b.first[some], b.last[some])
            text = np.repeat(b.text[some], b.last[some] - b.first[some] + 1)
            at.append(rest[_in(b.strings[rest], text, listed)])
        at = np.concatenate(at)
        gone += np.bincount(at, minlength=len(gone)).astype(np.int32)
        gone -= np.bincount(at + LENGTH, minlength=len(gone)).astype(np.int32)
    return data, off, np.cumsum(gone)[:-1] > 0


def _digest(lows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                data, off, gone = _removed(part, lows.value)
                cuts = off.tolist()
                removed = [int(gone[a:b].sum()) for a, b in zip(cuts, cuts[1:], strict=False)]
                spans = [int(np.diff(gone[a:b].astype(np.int8), prepend=0).clip(0).sum()) if r else 0 for r, a, b in zip(removed, cuts, cuts[1:], strict=False)]
                kept = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes() if r else data[a:b].tobytes()).hexdigest() for r, a, b in zip(removed, cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def _kept(lows) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                data, off, gone = _removed(part, lows.value)
                cuts = off.tolist()
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([data[a:b][~gone[a:b]].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())], ["id", "kept"])

    return run


def _hot(docs: DataFrame) -> _Hot:
    """Q-grams, ranges and strings of so many documents that one task should not hold all their rows; found in a sample, as any choice gives the same result."""
    sample = docs.sample(1 / SAMPLE, seed=8)
    rows = written(sample.mapInArrow(_sampled, "gram long, range long"), "sample")
    least = max(SAMPLE // 4, rows.count() // HOT)

    def common(rows: DataFrame, kind: str) -> np.ndarray:
        first = rows.groupBy(kind).count().where(F.col("count") > least).orderBy(F.desc("count"), kind).limit(HOT)
        return np.sort(np.array([r[kind] for r in first.collect()], np.int64).astype(np.uint64))

    grams, ranges = common(rows, "gram"), common(rows, "range")
    strings = common(sample.mapInArrow(_sampled_strings(grams), "string long"), "string") if len(grams) else grams
    return _Hot(grams, ranges, strings)


def _least(rows: DataFrame, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers in unsigned order, at most ``HOT``, and the least id of each."""
    found = sorted((r[kind] % 2**64, r["low"]) for r in rows.groupBy(kind).agg(F.min("low").alias("low")).collect())
    return np.array([k for k, _ in found], np.uint64), np.array([i for _, i in found], np.int64)


def _with_repeats(docs: DataFrame) -> tuple[DataFrame, Broadcast]:
    """``id, text, ranges, strings``: every document with the identifiers of its ranges and strings that an earlier one holds; and the least ids of hot ones."""
    context = docs.sparkSession.sparkContext
    known = docs.where("id IS NOT NULL")
    hot = _hot(known)
    told = context.broadcast(hot)
    state = written(_met(known, told), "ranges")
    opened = state.where("open").groupBy("id").agg(F.collect_set("range").alias("open"))
    strings = known.join(opened, "id").mapInArrow(_strings(told), "string long, second long, id long, hot boolean")
    again = strings.withColumn("low", F.min("id").over(Window.partitionBy("string", "second"))).where("id > low")
    again = written(again.select("id", "string", "hot", F.when(F.col("hot"), F.col("low")).alias("low")), "strings")
    ranges = state.where("NOT open AND NOT hot").select("id", "range", F.lit(None).cast("long").alias("string"))
    lists = ranges.unionByName(again.where("NOT hot").select("id", F.lit(None).cast("long").alias("range"), "string")).groupBy("id").agg(F.collect_list("range").alias("ranges"), F.collect_list("string").alias("strings"))
    lows = _Lows(*_least(state.where("hot"), "range"), *_least(again.where("hot"), "string"), hot.grams)
    return docs.join(lists, "id", "left"), context.broadcast(lows)


def _met(docs: DataFrame, hot: Broadcast) -> DataFrame:
    """``id, range, open, hot, low`` of ranges that matter: repeats of an earlier document's (not open), and first ones whose q-gram has other ranges too (open); of hot ranges the least id.

    One shuffle serves both windows. A key's rows are at most one for each document and range; of a hot
    range they are two for each task, and a hot q-gram's ranges are keys of their own. The window streams over
    them and spills, and holds none of their text.
    """
    rows = docs.mapInArrow(_ranges(hot), "key long, range long, id long, kind byte")
    key, same = Window.partitionBy("key"), Window.partitionBy("key", "range")
    met = rows.withColumns({"least": F.min("id").over(key), "high": F.max("id").over(key), "one": F.min("range").over(key), "other": F.max("range").over(key)}).where("least < high OR kind IN (1, 3)")
    met = met.withColumn("low", F.min("id").over(same)).withColumns({"open": F.col("id") == F.col("low"), "hot": F.col("kind") >= 2})
    return met.where("NOT open OR kind > 0 OR one != other").select("id", "range", "open", "hot", F.when(F.col("hot"), F.col("low")).alias("low"))


def repeat_digest(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, as UTF-8 bytes.

    A byte is removed if some string of ``LENGTH`` bytes that covers it also starts in a document of smaller
    id; strings are judged on the input and never cross documents. Null texts are empty; texts under
    ``LENGTH`` bytes stay whole; rows that share an id don't count against each other; rows with a
    null id keep all and count against none; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    given, lows = _with_repeats(rows)
    return given.mapInArrow(_digest(lows), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumnRenamed("id", id_col)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, kept``: each row's remaining bytes (a cut may fall within a character)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    given, lows = _with_repeats(rows)
    return given.mapInArrow(_kept(lows), "id long, kept binary").withColumnRenamed("id", id_col)
