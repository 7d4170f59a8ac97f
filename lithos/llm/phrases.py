"""Phrases that occur oftener than their parts lead one to expect, counted by vertically partitioned suffix trees.

A suffix is the words from one word to the end of its piece, cut off at the longest phrase. Words are counted first; they are the
prefixes of length one. Their counts say how many suffixes begin with a prefix, so prefixes are put into groups of at most
a memory budget of suffixes, and prefixes over the budget are taken whole suffix by whole suffix into several groups. Each group's
suffixes then meet in one task and are sorted: that order is the tree, its leaves are the distinct suffixes with their totals, and a node's
count is the sum of the leaves below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.llm._order import placed
from lithos.llm._spark import Scratch
from lithos.llm._text import class_words, mixed, ragged_take, raw, string_array, text_slices, word_hashes

#: Bytes that end a piece, and those that end a word within one.
PIECE_ENDS, WORD_ENDS = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"
#: Suffixes of a group, bins of prefixes, bits of the sieve of frequent words, and bytes of text taken together.
BUDGET, BINS, SIEVE_BITS, SLICE = 1 << 20, 1 << 16, 1 << 24, 8 << 20

_LETTERS = np.ones(256, bool)
_LETTERS[list(PIECE_ENDS + WORD_ENDS)] = False
_ENDS = np.zeros(256, bool)
_ENDS[list(PIECE_ENDS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Words:
    """The words of one slice of texts of one language, as indexes into its distinct words."""

    def __init__(self, texts: pa.Array, lang: str):
        data, off = raw(texts)
        data = _LOWER[data]
        starts, ends, first = class_words(data, off, _LETTERS)
        piece = np.cumsum(_ENDS[data])[starts] if len(starts) else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(off) - 1), np.diff(first))
        bytes_off = np.concatenate([[0], np.cumsum(ends - starts)])
        words = string_array(ragged_take(data, starts, ends - starts), bytes_off).dictionary_encode()
        self.words, self.codes = words.dictionary, words.indices.to_numpy().astype(np.int64)
        #: How many words follow each without a break.
        same = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        self.joined = np.concatenate([same, [False]]) if len(starts) else np.zeros(0, bool)
        text, word_off = raw(self.words)
        name = np.frombuffer(lang.encode(), np.uint8)
        salt = word_hashes(name, np.zeros(1, np.int64), np.array([len(name)]))[0] if len(name) else np.uint64(0)
        self.hashes = mixed(word_hashes(text, word_off[:-1], word_off[1:]) ^ salt) if len(self.words) else np.zeros(0, np.uint64)


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of bounded slices, language by language."""
    for batch in batches:
        for part in text_slices(batch, limit=SLICE):
            langs = part.column("lang").dictionary_encode()
            index = langs.indices.to_numpy()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                yield lang, part.column("text").take(pa.array(np.flatnonzero(index == k)))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, texts in _by_lang(batches):
        found = _Words(texts, lang)
        counts = np.bincount(found.codes, minlength=len(found.words))
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), found.words.cast(pa.string()), pa.array(found.hashes.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "phrase", "hash", "f"])


def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of small non-negative integers in order, and each row's index among them."""
    key = rows[:, 0]
    for k in range(1, rows.shape[1]):
        _, rank = np.unique(key, return_inverse=True)
        key = (rank.astype(np.int64) << 32) | (rows[:, k] + 1)
    _, first, rank = np.unique(key, return_index=True, return_inverse=True)
    return rows[first], rank


def _suffixes(found: _Words, frequent: np.ndarray, depth: int) -> np.ndarray:
    """Rows of up to ``depth`` word codes, -1 after the end: from each frequent word on, while words are frequent and unbroken; two words at least."""
    n = len(found.codes)
    good = frequent[found.codes] if n else np.zeros(0, bool)
    on = found.joined & good
    on[:-1] &= good[1:]
    rows = np.full((n, depth), -1, np.int64)
    rows[:, 0] = found.codes
    alive = good
    for k in range(1, depth):
        alive = alive[: n - k + 1].copy()
        alive[: n - k] &= on[k - 1 : n - 1]
        alive = alive[: n - k]
        rows[: n - k, k] = np.where(alive, found.codes[k:], -1)
    return rows[rows[:, 1] >= 0]


def _packed(found: _Words, leaves: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """The distinct words of ``leaves`` joined by line ends, their codes in these, and their counts."""
    used, codes = np.unique(leaves, return_inverse=True)
    codes = codes.reshape(leaves.shape)
    if len(used) and used[0] < 0:
        used, codes = used[1:], codes - 1
    words = found.words.take(pa.array(used))
    data, off = raw(words)
    # no word holds a line end
    text = np.full(len(data) + len(used), 10, np.uint8)
    keep = np.ones(len(text), bool)
    keep[off[1:] + np.arange(len(used))] = False
    text[keep] = data
    return text.tobytes(), codes.astype("<i4").tobytes(), counts.astype("<i8").tobytes()


def _sum_leaves(lang: str, blobs: pa.Table, depth: int, least: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """The suffix tree of one group: phrases, lengths and counts of its nodes of two words or more, and which may have leaves in other groups too."""
    texts, codes, counts, offset, many = [], [], [], 0, []
    for text, code, count in zip(blobs.column("words").to_pylist(), blobs.column("codes").to_pylist(), blobs.column("counts").to_pylist(), strict=True):
        held = np.frombuffer(code, "<i4").reshape(-1, depth).astype(np.int64)
        texts.append(text)
        codes.append(np.where(held < 0, -1, held + offset))
        counts.append(np.frombuffer(count, "<i8"))
        offset += text.count(b"\n")
        many.append(len(held))
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    words = string_array(ragged_take(data, starts, ends - starts), np.concatenate([[0], np.cumsum(ends - starts)])).dictionary_encode()
    index = np.append(words.indices.to_numpy().astype(np.int64), -1)
    rows, weights = index[np.concatenate(codes)], np.concatenate(counts)
    open_ = np.repeat(np.array(blobs.column("split").to_pylist(), bool), many)
    leaves, rank = _ranked(rows)
    totals = np.zeros(len(leaves), np.int64)
    np.add.at(totals, rank, weights)
    split = np.zeros(len(leaves), bool)
    split[rank] = open_
    names = words.dictionary
    for k in range(2, depth + 1):
        deep = np.flatnonzero(leaves[:, k - 1] >= 0)
        if not len(deep):
            return
        here = leaves[deep, :k]
        fresh = np.concatenate([[True], (here[1:] != here[:-1]).any(axis=1)])
        at = np.flatnonzero(fresh)
        node = np.add.reduceat(totals[deep], at)
        shared = np.logical_or.reduceat(split[deep], at) if k < depth else np.zeros(len(at), bool)
        kept = np.flatnonzero((node >= least) | shared)
        here, node, shared = here[at[kept]], node[kept], shared[kept]
        phrase = names.take(pa.array(here[:, 0]))
        for j in range(1, k):
            phrase = pa.compute.binary_join_element_wise(phrase, names.take(pa.array(here[:, j])), pa.scalar(" ", phrase.type))
        yield phrase, np.full(len(node), k), node, shared


def _groups(loads: list[tuple[int, int]], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """First group of each bin of prefixes, and over how many groups its suffixes are dealt: one unless its load is over the budget."""
    group, parts = np.zeros(BINS, np.int64), np.ones(BINS, np.int64)
    at, filled = 0, 0
    for b, load in sorted(loads):
        if load > budget:
            parts[b] = -(-load // budget)
            group[b] = at + 1 if filled else at
            at, filled = int(group[b] + parts[b]), 0
        else:
            if filled + load > budget:
                at, filled = at + 1, 0
            group[b], filled = at, filled + load
    return group, parts


def phrase_counts(docs: DataFrame, scratch: Scratch, *, depth: int = 3, least: int = 10, budget: int = BUDGET, text_col: str | Column = "text", lang_col: str | Column = "lang") -> tuple[DataFrame, DataFrame]:
    """Counts of words (``lang, phrase, hash, f``), and of all phrases of 2 to ``depth`` words that occur ``least`` times (``lang, phrase, m, f``); written tables.

    The driver holds one load for each of ``BINS`` bins of prefixes and the sieve of frequent words, of
    ``SIEVE_BITS`` bits whatever the corpus; the sieve only spares suffixes that can't be counted often enough,
    and lets some pass that it needn't. A task holds one group: suffixes of at most ``budget`` occurrences (or a share of a heavier bin).
    """
    if depth < 2:
        raise ValueError("phrases have two words at least")
    spark = docs.sparkSession
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    lang = F.col(lang_col) if isinstance(lang_col, str) else lang_col
    texts = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    counted = texts.mapInArrow(_count_words, "lang string, phrase string, hash long, f long")
    words = scratch.write(counted.groupBy("lang", "phrase").agg(F.first("hash").alias("hash"), F.sum("f").alias("f")), "words")

    place = F.pmod("hash", F.lit(SIEVE_BITS))
    often = words.where(F.col("f") >= least)
    bit = often.select(F.floor(place / 32).cast("int").alias("at"), F.expr(f"shiftleft(1L, CAST(pmod(hash, {SIEVE_BITS}) % 32 AS INT))").alias("bit"))
    bits = bit.groupBy("at").agg(F.bit_or("bit").alias("bits")).collect()
    sieve = np.zeros(SIEVE_BITS // 32, np.uint32)
    sieve[[r["at"] for r in bits]] = np.array([r["bits"] for r in bits], np.int64).astype(np.uint32)
    loads = often.groupBy(F.pmod(F.shiftright("hash", 24), F.lit(BINS)).cast("int").alias("bin")).agg(F.sum("f")).collect()
    group_of, parts_of = _groups([tuple(r) for r in loads], budget)
    plan = spark.sparkContext.broadcast((sieve, group_of, parts_of))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, group_of, parts_of = plan.value
        for name, part in _by_lang(batches):
            found = _Words(part, name)
            at = found.hashes % np.uint64(SIEVE_BITS)
            frequent = (sieve[at // np.uint64(32)] >> (at % np.uint64(32)).astype(np.uint32)) & np.uint32(1) > 0
            rows = _suffixes(found, frequent, depth)
            if not len(rows):
                continue
            leaves, rank = _ranked(rows)
            counts = np.bincount(rank, minlength=len(leaves))
            bins = ((found.hashes[leaves[:, 0]] >> np.uint64(24)) % np.uint64(BINS)).astype(np.int64)
            whole = found.hashes[leaves[:, 0]]
            for k in range(1, depth):
                whole = mixed(whole * np.uint64(0x9E3779B97F4A7C15) + np.where(leaves[:, k] >= 0, found.hashes[leaves[:, k]], np.uint64(0)))
            groups = group_of[bins] + (whole % parts_of[bins].astype(np.uint64)).astype(np.int64)
            order = np.argsort(groups, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], np.diff(groups[order]) > 0, [True]]))
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                chosen = order[a:b]
                for split in (False, True):
                    some = chosen[(parts_of[bins[chosen]] > 1) == split]
                    if len(some):
                        out.append((int(groups[chosen[0]]), name, split, *_packed(found, leaves[some], counts[some])))
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*out, strict=True)], ["grp", "lang", "split", "words", "codes", "counts"])

    def read(key: tuple, blobs: pa.Table) -> pa.Table:
        name = key[1].as_py()
        made = list(_sum_leaves(name, blobs, depth, least))
        columns = [pa.concat_arrays([m[0].cast(pa.string()) for m in made]) if made else pa.array([], pa.string()), *[pa.array(np.concatenate([m[k] for m in made]) if made else [], t) for k, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.bool_()))]]
        return pa.Table.from_arrays([pa.array([name] * len(columns[0]), pa.string()), *columns], ["lang", "phrase", "m", "f", "split"])

    blobs = texts.mapInArrow(emit, "grp long, lang string, split boolean, words binary, codes binary, counts binary")
    nodes = scratch.write(blobs.groupBy("grp", "lang").applyInArrow(read, "lang string, phrase string, m int, f long, split boolean"), "nodes")
    parted = nodes.where("split").groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return words, nodes.where("NOT split").select("lang", "phrase", "m", "f").unionByName(parted)


def collocations(docs: DataFrame, *, depth: int = 3, least: int = 10, keep_percent: int = 50, top: int = 2000, budget: int = BUDGET, text_col: str | Column = "text", lang_col: str | Column = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases of 2 to ``depth`` words by score, then count, then bytes.

    ``a`` is how often the phrase occurs (``least`` at least), ``n`` the words of its language, ``l`` and ``r`` how often the two parts of
    its lowest-scoring cut occur, ``score`` is ``floor(1000000 * a * a / (l * r))`` in exact arithmetic (ties: the first cut). Phrases within a longer
    one that occurs ``keep_percent`` of a hundred times as often are left out. Pieces end at ``PIECE_ENDS``,
    words at ``WORD_ENDS``; A-Z are lower-cased. Null texts are empty, a null language is ``und``; repeated rows count each; other columns are
    ignored; no phrase often enough, or an empty table, gives no rows. ``top`` is the report's length.
    """
    scratch = Scratch(docs.sparkSession)
    words, phrases = phrase_counts(docs, scratch, depth=depth, least=least, budget=budget, text_col=text_col, lang_col=lang_col)
    parts = F.split("phrase", " ")
    longer = phrases.where(F.col("m") > 2).withColumn("w", parts)
    inner = [F.array_join(F.slice("w", i + 1, k), " ") for k in range(2, depth) for i in range(depth - k + 1)]
    fits = [F.col("m") >= i + k for k in range(2, depth) for i in range(depth - k + 1)]
    shorter = [F.col("m") > k for k in range(2, depth) for i in range(depth - k + 1)]
    within = F.filter(F.array(*[F.when(a & b, p) for p, a, b in zip(inner, fits, shorter, strict=True)]), lambda p: p.isNotNull()) if inner else F.array().cast("array<string>")
    covers = longer.select("lang", F.explode(within).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = phrases.join(covers, ["lang", "phrase"], "left").where(~F.coalesce(F.col("most") * 100 >= F.col("f") * keep_percent, F.lit(False)))
    held = scratch.write(kept.select("lang", "phrase", "m", F.col("f").alias("a")), "candidates")

    cut = F.explode(F.flatten(F.transform(F.sequence(F.lit(1), F.col("m") - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit("l").alias("side"), F.array_join(F.slice("w", 1, k), " ").alias("key")),
        F.struct(k.alias("k"), F.lit("r").alias("side"), F.array_join(F.slice("w", k + 1, F.col("m")), " ").alias("key"))))))
    asked = held.withColumn("w", parts).select("lang", "phrase", "a", cut.alias("c")).select("lang", "phrase", "a", "c.*").withColumnRenamed("key", "part")
    known = words.where(F.col("f") >= least).select("lang", F.col("phrase").alias("part"), "f").unionByName(phrases.select("lang", F.col("phrase").alias("part"), "f"))
    sides = [F.max(F.when((F.col("k") == k) & (F.col("side") == s), F.col("f"))).alias(f"{s}{k}") for k in range(1, depth) for s in "lr"]
    found = asked.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*sides)
    exact = "CAST(CAST(1000000 AS DECIMAL(38, 0)) * a * a DIV (CAST(l{k} AS DECIMAL(38, 0)) * r{k}) AS BIGINT)"
    cuts = [F.when(F.col(f"l{k}").isNotNull(), F.struct(F.expr(exact.format(k=k)).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, depth)]
    best = found.withColumn("best", F.array_min(F.array(*cuts))).select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    # Ranks are places over ranges of scores, so a language with most phrases is no longer task than others.
    scored = scratch.write(best.withColumns({"_score": -F.col("score"), "_a": -F.col("a")}), "scores")
    first = placed(scored, ["lang"], ["_score", "_a", "phrase"], scratch).where(F.col("place") < top).withColumn("rank", F.col("place") + 1)
    return scratch.last(first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
