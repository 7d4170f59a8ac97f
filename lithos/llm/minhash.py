"""MinHash fingerprints of texts, likeness of neighbours in an order, and near duplicates by signature bands.

A text's set holds its shingles of five words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased), hashed; a text of fewer words has the
whole sequence as one shingle. ``PERMUTATIONS`` multiply-add-shift functions, a universal family, are applied to all shingles of a slice
at once and the least value of each is kept, cut to 16 bits. The share of equal values estimates the sets' Jaccard similarity.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.llm._order import placed
from lithos.llm._spark import Scratch, shuffle_partitions
from lithos.llm._text import class_words, grams, raw, text_slices, word_hashes
from lithos.llm.components import connected_components

PERMUTATIONS, SHINGLE_WORDS = 128, 5
#: 25 bands of 5 values: of two sets with similarity 0.8 one band at least agrees but for 5 in 100,000.
BANDS, BAND_ROWS = 25, 5
#: Members of a tile of a band's bucket.
TILE = 128
#: Bytes of text hashed at once, so that shingles stay in a core's cache.
_SLICE = 512 << 10
_SPACE = np.ones(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(11)
_FACTORS = _RANDOM.integers(0, 2**64, PERMUTATIONS, np.uint64, endpoint=False) | np.uint64(1)
_OFFSETS = _RANDOM.integers(0, 2**64, PERMUTATIONS, np.uint64, endpoint=False)


def shingle_sets(texts: pa.Array, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's shingles, text after text, and where each text's begin (one more entry than texts). Null is empty."""
    data, off = raw(texts)
    data = _LOWER[data]
    starts, ends, first = class_words(data, off, _SPACE)
    words = word_hashes(data, starts, ends)
    have = np.diff(first)
    whole, fits = grams(words, n, first)
    rows = np.repeat(np.arange(len(have)), have)
    found, owner = [whole[fits]], [rows[: len(whole)][fits]]
    for k in range(1, n):
        few = np.flatnonzero(have == k)
        if len(few):
            found.append(grams(words, k, first)[0][first[few]])
            owner.append(few)
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order], np.searchsorted(owners[order], np.arange(len(have) + 1))


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of ``PERMUTATIONS`` 16-bit values for each text, and which texts have any shingle (the others' rows are 0)."""
    out = np.zeros((len(texts), PERMUTATIONS), np.uint16)
    any_ = np.zeros(len(texts), bool)
    at = 0
    for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), limit=_SLICE):
        hashes, off = shingle_sets(part.column("text"))
        full = np.flatnonzero(np.diff(off))
        if len(full):
            keys, t = hashes >> np.uint64(32), np.empty(len(hashes), np.uint64)
            for k in range(PERMUTATIONS):
                np.multiply(keys, _FACTORS[k], out=t)
                t += _OFFSETS[k]
                t >>= np.uint64(32)
                out[at + full, k] = np.minimum.reduceat(t, off[full]).astype(np.uint16)
            any_[at + full] = True
        at += part.num_rows
    return out, any_


def likeness(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """The share of equal values; two texts without shingles are alike, one of them is like no other."""
    return np.where(some_a & some_b, (a == b).mean(axis=1), (some_a == some_b).astype(float))


def _bounds(keys: DataFrame) -> list[tuple[bool, int, int]]:
    """The least key of each range of about as many rows: as many as there are shuffle partitions, at most."""
    ranges = keys.repartitionByRange(shuffle_partitions(keys.sparkSession), "known", "id", "tie")
    return sorted(tuple(r[1]) for r in ranges.groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct("known", "id", "tie"))).collect())


class _Sequel:
    """Rows of one ordered run, each held until its successor is there."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.size = 0
        self.closed = -1

    def flushed(self, nexts: tuple | None = None) -> pa.RecordBatch | None:
        """Results of all rows held, the last one before ``nexts``; without it the last one waits on."""
        rows = self.rows if nexts is not None else self.rows[:-1]
        after = [*self.rows[1:], *([] if nexts is None else [nexts])]
        self.rows = [] if nexts is not None else self.rows[-1:]
        self.size = sum(len(r[1]) for r in self.rows)
        if not rows:
            return None
        texts = [r[1] for r in rows]
        edited = [t[: len(t) - len(t) // 4] + n[1][: len(t) // 4] for t, n in zip(texts, after, strict=True)]
        sig, some = signatures(pa.array([*texts, after[-1][1]], pa.large_string()))
        new, some_new = signatures(pa.array(edited, pa.large_string()))
        n = len(rows)
        shas = [hashlib.sha256(t.encode()).hexdigest() for t in edited]
        names = [[s.tobytes().hex() if x else "" for s, x in zip(m, e, strict=True)] for m, e in ((sig[:n], some[:n]), (new, some_new))]
        near = likeness(sig[:n], some[:n], new, some_new), likeness(sig[:n], some[:n], sig[1:], some[1:])
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array(list(map(len, texts)), pa.int64()), *map(pa.array, (shas, *names)), *map(pa.array, near)], _COLUMNS)


_COLUMNS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _edit_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Sequel()
    for batch in batches:
        for part in text_slices(batch):
            for bucket, guest, id_, text in zip(*(part.column(c).to_pylist() for c in ("bucket", "guest", "id", "text")), strict=True):
                if guest and bucket != held.closed:
                    held.closed = bucket
                    out = held.flushed((id_, text))
                elif not guest:
                    held.rows.append((id_, text))
                    held.size += len(text)
                    out = held.flushed() if held.size > 2 << 20 else None
                else:
                    out = None
                if out is not None:
                    yield out


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every document.

    The edited text has the last quarter (rounded down) of its code points replaced by the first as many, or all, of the
    next document's in ascending id; after the last comes the first. Fingerprints are signatures in hexadecimal, empty for a text
    without words; ``near_edited`` and ``near_next`` are the likeness to the edited text's and the next document's.

    Texts are dealt once, by ranges of id whose bounds (one for each shuffle partition) the driver holds; the first
    document of a range goes also to the range before it, so each task has every successor and reads
    its sorted rows one after another. Null texts are empty; null ids come first; rows of one id stand in the order of a hash of
    their texts; other columns are ignored; an empty table gives no rows; a lone document is followed by itself.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    id_ = F.col(f"`{id_col}`").cast("long")
    text = F.coalesce(F.col(text_col) if isinstance(text_col, str) else text_col, F.lit(""))
    keyed = docs.select(id_.isNotNull().alias("known"), F.coalesce(id_, F.lit(0)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    keys = scratch.write(keyed.drop("text"), "keys")
    bounds = _bounds(keys)
    scratch.drop(keys)
    runs = max(1, len(bounds))

    @F.pandas_udf("long")
    def range_of(known: pd.Series, ids: pd.Series, ties: pd.Series) -> pd.Series:
        out = []
        for key in zip(known.tolist(), ids.tolist(), ties.tolist(), strict=True):
            at = bisect.bisect_right(bounds, key) - 1
            out.append(2 * at + (bounds[at] == key))
        return pd.Series(out, dtype="int64")

    dealt = keyed.withColumn("code", range_of("known", "id", "tie")).withColumn("at", F.shiftright("code", 1))
    own, before = F.struct(F.col("at").alias("bucket"), F.lit(False).alias("guest")), F.struct(F.pmod(F.col("at") - 1, F.lit(runs)).alias("bucket"), F.lit(True).alias("guest"))
    sent = dealt.select(F.explode(F.when(F.col("code") % 2 == 1, F.array(own, before)).otherwise(F.array(own))).alias("to"), "known", "id", "tie", "text")
    order = ["bucket", "guest", "known", "id", "tie"]
    rows = sent.select("to.*", "known", "id", "tie", "text").repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions(*order)
    given = rows.select("bucket", "guest", F.when(F.col("known"), F.col("id")).alias("id"), "text")
    done = given.mapInArrow(_edit_runs, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return done.withColumnRenamed("id", id_col)


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, grams`` (sorted distinct hashes) ``, digest, bands`` of each text."""
    for batch in batches:
        for part in text_slices(batch):
            texts = part.column("text")
            sig, some = signatures(texts)
            hashes, off = shingle_sets(texts)
            sets = [np.unique(hashes[a:b]).astype("<u8").tobytes() for a, b in zip(off, off[1:], strict=False)]
            keys = [[] if not x else [int.from_bytes(hashlib.blake2b(s[BAND_ROWS * k : BAND_ROWS * (k + 1)].tobytes(), digest_size=8).digest(), "little", signed=True) for k in range(BANDS)] for s, x in zip(sig, some, strict=True)]
            digests = [hashlib.sha256(s).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(sets, pa.binary()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], ["id", "grams", "digest", "bands"])


def _alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets overlap in ``percent`` of a hundred of their union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("grams_a", "grams_b"))
            good = pa.array([_alike(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), percent) for x, y in zip(a, b, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(good)

    return run


def _tile_links(percent: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        """Links between the two tiles of a pair (or within one) whose members are of different classes and meet first in this band."""
        band = key[0].as_py()
        left, right = (rows.filter(pa.compute.equal(rows.column("side"), s)).to_pylist() for s in (0, 1))
        if key[2] == key[3]:
            right = left
        sets = {id(r): np.frombuffer(r["grams"], "<u8") for r in [*left, *right]}
        found: list[tuple[int, int]] = []
        for i, x in enumerate(left):
            for y in right[i + 1 :] if right is left else right:
                if x["class"] != y["class"] and next(k for k in range(BANDS) if x["bands"][k] == y["bands"][k]) == band and _alike(sets[id(x)], sets[id(y)], percent):
                    found.append((x["id"], y["id"]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, *, percent: int = 80, id_col: str = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """``id, component_id`` of every document: the least id it reaches over links, which are pairs that share a band and whose sets' Jaccard similarity is at least ``percent``.

    Documents of equal sets are one class before bands are joined, so copies meet nobody. In each bucket every member is
    verified against the least; of buckets whose members that leaves in several classes the members meet in tiles, of which only the links come out,
    so no bucket's pairs are ever written. Bands can miss a pair of just ``percent`` once in 20,000; every pair they find is
    verified on the sets themselves. Texts without words link with nothing; null ids are left out; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    id_, text = F.col(f"`{id_col}`").cast("long"), F.col(text_col) if isinstance(text_col, str) else text_col
    given = docs.select(id_.alias("id"), F.coalesce(text, F.lit("")).alias("text")).where("id IS NOT NULL")
    all_ = scratch.write(given.mapInArrow(_described, "id long, grams binary, digest binary, bands array<long>"), "sets")
    least = scratch.write(all_.groupBy("digest").agg(F.min("id").alias("rep")), "reps")
    with_words = all_.where(F.size("bands") > 0)
    reps = scratch.write(with_words.join(least.withColumnRenamed("rep", "id"), ["digest", "id"]).select("id", "grams", "bands").dropDuplicates(["id"]), "distinct")
    entries = scratch.write(reps.select("id", F.posexplode("bands").alias("band", "key")), "bands")
    lead = entries.groupBy("band", "key").agg(F.min("id").alias("b"), F.count("*").alias("n")).where("n > 1")
    pairs = entries.join(lead, ["band", "key"]).where("id != b").select(F.col("id").alias("a"), "b").distinct()
    grams_a, grams_b = (reps.select(F.col("id").alias(s), F.col("grams").alias(f"grams_{s}")) for s in "ab")
    stars = scratch.write(pairs.join(grams_a, "a").join(grams_b, "b").mapInArrow(_verified(percent), "a long, b long"), "stars")

    found = connected_components(stars, scratch=scratch)
    classes = scratch.write(reps.join(found.withColumnRenamed("node", "id"), "id", "left").select("id", "grams", "bands", F.coalesce("component", "id").alias("class")), "classes")
    mixed_ = entries.join(classes.select("id", "class"), "id").groupBy("band", "key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("band", "key")
    open_ = scratch.write(entries.join(mixed_, ["band", "key"]), "open")
    tiled = placed(open_, ["band", "key"], ["id"], scratch).withColumns({"tile": F.floor(F.col("place") / TILE), "tiles": F.ceil(F.col("members") / TILE)})
    partner = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    sent = tiled.select("band", "key", "id", "tile", partner).select("band", "key", "id", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), (F.col("tile") > F.col("other")).cast("int").alias("side"))
    met = sent.join(classes, "id").groupBy("band", "key", "i", "j").applyInArrow(_tile_links(percent), "a long, b long")
    links = scratch.write(stars.unionByName(met), "links")

    whole = connected_components(links, scratch=scratch).withColumnRenamed("node", "rep")
    by_text = all_.select("id", "digest", F.size("bands").alias("some")).join(least, "digest").withColumn("rep", F.when(F.col("some") > 0, F.col("rep")).otherwise(F.col("id")))
    out = by_text.join(whole, "rep", "left").select(F.col("id").alias(id_col), F.coalesce("component", "rep").alias("component_id"))
    return scratch.last(out, "near")
