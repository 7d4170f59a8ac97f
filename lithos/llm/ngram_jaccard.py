"""N-gram Jaccard join: exact links of documents whose sets of word n-grams overlap enough.

Of each set it is known how many of its n-grams fell into each of a number of groups: a point of counts. The number of
groups grows with the set (one for two to four n-grams) and is a power of two, so that of two points the finer folds
onto the coarser. The overlap of two sets is at most the summed minima of their points' coordinates.

The search narrows in levels:

1. Cells. Two linked sets differ in at most r n-grams, r = (1 - s) / (1 + s) of their sizes' sum; over more than r
   groups at least one therefore holds the same n-grams in both. A set is entered under the contents of each of its
   groups, for the band of sizes of the larger of a pair, and only sets that share a cell can link. At 0.9 two linked
   points may differ by a tenth of their size, which is more than points of unrelated texts scatter in any one
   coordinate: boxes of counts alone would leave nearly all pairs of a size, so the tree stands below the cells.
   Of its cells a set leaves out the commonest, as many as it has beyond one more than may differ: linked sets share a
   rarer one. So texts that have but a common line or phrases alike meet nowhere.
2. Small cells are compared point by point; sets of large ones are packed, by cell and then in order of size and leading
   coordinates, into the tree: tiles of ``TILE`` points with leaves of ``LEAF``, each with a box (least and most size,
   most of each coordinate). Tiles meet if they share a cell and their boxes allow a link, leaves if their boxes do.
3. Points that the bound leaves are verified on the n-grams of the texts, inside the task that holds both tiles, which
   returns only links that join what was not joined yet: a spanning forest and never candidate pairs.

No link is lost, and no group of copies is met whole in one task. Texts with the same set are one node, named by a
64-bit sum of its n-grams' hashes; among n distinct sets the chance that two share a name is n * n / 2**65. All pairs of
texts that link otherwise are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.llm._spark import Scratch
from lithos.llm._text import class_words, grams, mixed, raw, text_slices, word_hashes
from lithos.llm.components import connected_components

#: Coordinates of a point at least (and those boxes have), ratio of sizes within a band, and groups at least beyond those that may differ.
COORDINATES, BAND, SPARE = 32, 0.65, 2
#: Cells of so many members are compared pair by pair; tiles and leaves of the tree over larger ones hold so many points, tiles so many bytes.
SMALL, TILE, LEAF, TILE_BYTES, CUTS = 48, 512, 64, 4 << 20, 64
#: Cells that a set enters in one turn for each of its n-grams; lower similarities take more turns over the keys.
ENTRIES = 0.11
#: Pairs of tiles are compared in turns, each of which ships about so many times all tiles.
SHIPPED = 3
#: Bytes of text whose sets are made at once.
SLICE_BYTES = 3 << 19
#: Names of documents that are broadcast at most.
BROADCAST_IDS = 1_000_000

_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def gram_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of all texts, and where each text's begin. Fewer words make one gram; none make none."""
    data, off = raw(texts)
    data = _LOWER[data]
    starts, ends, first = class_words(data, off, _WORD)
    words = word_hashes(data, starts, ends)
    hashes, whole = grams(words, n, first)
    row = np.repeat(np.arange(len(off) - 1), np.diff(first))
    hashes, row_of = hashes[whole], row[: len(whole)][whole]
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < n))
    if len(few):
        short = np.array([grams(words[first[d] : first[d + 1]], int(first[d + 1] - first[d]), np.array([0, first[d + 1] - first[d]]))[0][0] for d in few], np.uint64)
        hashes, row_of = np.concatenate([hashes, mixed(short + np.uint64(1))]), np.concatenate([row_of, few])
    order = np.lexsort((hashes, row_of))
    hashes, row_of = hashes[order], row_of[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (row_of[1:] != row_of[:-1])
    hashes, row_of = hashes[fresh], row_of[fresh]
    return hashes, np.searchsorted(row_of, np.arange(len(off)))


def _names(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(hashes + np.uint64(77)), dtype=np.uint64)])
    return mixed(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64)).astype(np.int64)


def bands(largest: int) -> np.ndarray:
    """Largest size of each band of sizes."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, int(tops[-1] / BAND)))
    return np.array(tops, np.int64)


def group_counts(tops: np.ndarray, percent: int) -> np.ndarray:
    """Groups of the cells of each band: the fewest of which the band's smallest sets still fill, with three deviations to spare, more than may differ."""
    out = []
    for top, before in zip(tops.tolist(), [0, *tops[:-1].tolist()], strict=True):
        differ, least = 2 * (100 - percent) * top // (100 + percent), -(-percent * (before + 1) // 100)
        enough = differ + 1 + SPARE
        for count in range(enough, 2 * enough):
            empty = count * np.exp(-least / count)
            if count - empty - 3 * np.sqrt(empty) > differ:
                enough = count
                break
        out.append(enough if differ else 0)
    return np.array(out, np.int64)


def _entries(hashes: np.ndarray, at: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Of each kind of cells: index of the set and key of each cell it is entered under; of each set the cells it may leave out, the kind, and how many kinds past its own band's first it is.

    A set enters the cells of its own band of sizes, where it may be the larger of a pair, and those of all further
    bands that a larger set linked with it may have. Bands in which only equal sets link have no cells. A set with no
    more filled groups than may differ is entered under each of its n-grams too, and so are its partners of that kind.
    A key's last byte is its kind: band, and groups or n-grams. Of a kind's cells at most as many differ as n-grams may,
    so of a set's cells, put in any order that is the same for all sets, all past one more than that may be left out:
    the first cell that two linked sets share is before them.
    """
    sizes = np.diff(at)
    tops = bands(int(sizes.max(initial=1)) * 100 // percent + 2)
    counts = group_counts(tops, percent)
    own = np.searchsorted(tops, sizes)
    of_all = np.repeat(np.arange(len(sizes)), sizes)

    def keys(content: np.ndarray, kind: np.ndarray) -> np.ndarray:
        return ((mixed(content) & ~np.uint64(255)) | kind.astype(np.uint64)).astype(np.int64)

    for ahead in range(len(tops)):
        band = np.minimum(own + ahead, len(tops) - 1)
        differ = (2 * (100 - percent) * tops[band]) // (100 + percent)
        use = (sizes > 0) & (own + ahead < len(tops))
        if ahead:
            use &= 100 * sizes >= percent * (tops[band - 1] + 1)
        if not use.any():
            break
        use &= differ > 0
        groups = np.where(use, counts[band], 0)
        mask = groups[of_all] > 0
        h, of = hashes[mask], of_all[mask]
        if not len(h):
            continue
        group = ((h >> np.uint64(32)) * groups[of].astype(np.uint64)) >> np.uint64(32)
        first = np.ones(len(h), bool)
        first[1:] = (of[1:] != of[:-1]) | (group[1:] != group[:-1])
        begin = np.flatnonzero(first)
        content = np.add.reduceat(mixed(h + np.uint64(5)), begin)
        place = band.astype(np.uint64) * np.uint64(1 << 32)
        filled = np.bincount(of[begin], minlength=len(sizes))
        sets = of[begin]
        yield sets, keys(content ^ mixed(place[sets] + group[begin] + np.uint64(1)), 2 * band[sets]), np.maximum(0, filled - differ - 1), 2 * band, 2 * ahead
        few = np.flatnonzero((use & (filled <= differ))[of])
        sets = of[few]
        yield sets, keys(h[few] ^ mixed(place[sets] + np.uint64(1 << 31)), 2 * band[sets] + 1), np.maximum(0, sizes - differ - 1), 2 * band + 1, 2 * ahead + 1


def cell_keys(hashes: np.ndarray, at: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the set and key of each cell it is entered under."""
    found = [(sets, keys) for sets, keys, *_ in _entries(hashes, at, percent)]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([sets for sets, _ in found]), np.concatenate([keys for _, keys in found])


def spare_cells(hashes: np.ndarray, at: np.ndarray, percent: int) -> list[list[int]]:
    """Of each set the first kind of its cells, and of this and each further kind how many cells it may leave out."""
    kinds, spares = np.zeros(len(at) - 1, np.int64), {}
    for _, _, spare, kind, ahead in _entries(hashes, at, percent):
        kinds, spares[ahead] = kind - ahead, spare
    table = np.zeros((len(at) - 1, 2 + max(spares, default=-1)), np.int64)
    table[:, 0] = kinds
    for ahead, spare in spares.items():
        table[:, 1 + ahead] = spare
    return table.tolist()


def points(hashes: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Counts of each set by group: one byte a coordinate, a power of two of them by the set's size; empty where one exceeds a byte."""
    out = []
    for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
        d = max(COORDINATES, 1 << max(0, int(b - a).bit_length() - 2))
        counts = np.bincount((hashes[a:b] & np.uint64(d - 1)).astype(np.int64), minlength=d)
        out.append(counts.astype(np.uint8).tobytes() if b > a and counts.max() < 256 else b"")
    return out


def _folded(point: bytes, d: int) -> np.ndarray:
    """A point on ``d`` coordinates."""
    return np.frombuffer(point, np.uint8).reshape(-1, d).sum(0, dtype=np.int32)


def _per_set(docs: DataFrame, n: int, what: str, percent: int = 0, turn: int = 0, turns: int = 1) -> DataFrame:
    """One pass over ``id, text``: ``nodes`` (id, node, size), ``cells`` (key, node; of ``turns`` parts of all keys one) or ``profiles`` (node, size, point, text, and its spare cells)."""
    schema = {"nodes": "id long, node long, size int", "cells": "key long, node long", "profiles": "node long, size int, point binary, text binary, spare array<int>"}[what]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                hashes, at = gram_sets(part.column("text"), n)
                names = _names(hashes, at)
                if what == "nodes":
                    yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names), pa.array(np.diff(at), pa.int32())], ["id", "node", "size"])
                elif what == "cells":
                    sets, keys = cell_keys(hashes, at, percent)
                    own = (keys >> 8) % turns == turn
                    sets, keys = sets[own], keys[own]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(names[sets])], ["key", "node"])
                else:
                    texts = [pack.compress((t or "").encode()) for t in part.column("text").to_pylist()]
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.diff(at), pa.int32()), pa.array(points(hashes, at), pa.binary()), pa.array(texts, pa.binary()), pa.array(spare_cells(hashes, at, percent), pa.list_(pa.int32()))], ["node", "size", "point", "text", "spare"])

    return docs.mapInArrow(run, schema)


def _near(one: Column, two: Column, percent: int) -> Column:
    """Sizes of two sets that may link."""
    return F.least(one, two).cast("long") * 100 >= F.greatest(one, two).cast("long") * percent


def _least_overlap(one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of two linked sets of these sizes."""
    return (one.astype(np.int64) + two) * percent / (100 + percent) - 1e-9


def _bounded(pairs: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes and summed coordinate minima allow a link."""
    one = profiles.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("point").alias("point_a"))
    two = profiles.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("point").alias("point_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("point_a").to_pylist(), batch.column("point_b").to_pylist()
            least = _least_overlap(np.asarray(batch.column("size_a")), np.asarray(batch.column("size_b")), percent)
            good = np.ones(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(left, right, strict=True)):
                if x and y:
                    d = min(len(x), len(y))
                    good[k] = np.minimum(_folded(x, d), _folded(y, d)).sum() >= least[k]
            yield batch.select(["a", "b"]).filter(pa.array(good))

    joined = pairs.join(one, "a").join(two, "b").where(_near(F.col("size_a"), F.col("size_b"), percent))
    return joined.select("a", "b", "size_a", "size_b", "point_a", "point_b").mapInArrow(run, "a long, b long")


class _Texts:
    """The n-gram sets of texts, by position."""

    def __init__(self, texts: list[bytes], n: int):
        self.hashes, self.at = gram_sets(pa.array([t.decode() for t in texts], pa.large_string()), n)

    def overlaps(self, i: int, others: np.ndarray) -> np.ndarray:
        """Size of the overlap of set ``i`` with each of others."""
        own = self.hashes[self.at[i] : self.at[i + 1]]
        sizes = self.at[others + 1] - self.at[others]
        ends = np.cumsum(sizes)
        index = np.arange(int(ends[-1])) + np.repeat(self.at[others] - (ends - sizes), sizes)
        theirs = self.hashes[index]
        spot = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        return np.add.reduceat((own[spot] == theirs).astype(np.int64), ends - sizes)

    def linked(self, i: int, others: np.ndarray, percent: int) -> np.ndarray:
        both = self.overlaps(i, others)
        return 100 * both >= percent * (self.at[i + 1] - self.at[i] + self.at[others + 1] - self.at[others] - both)


def _verified(pairs: DataFrame, profiles: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs that link, by the n-grams of their texts."""
    joined = pairs.join(profiles.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(profiles.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        undo = zstandard.ZstdDecompressor()
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                a, b = np.asarray(batch.column("a")), np.asarray(batch.column("b"))
                nodes, first, where = np.unique(np.concatenate([a, b]), return_index=True, return_inverse=True)
                packed = pa.concat_arrays([batch.column("text_a"), batch.column("text_b")]).take(pa.array(first)).to_pylist()
                sets = _Texts([undo.decompress(p) for p in packed], n)
                i, j = where[: len(a)], where[len(a) :]
                good = np.array([sets.linked(x, np.array([y]), percent)[0] for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)
                yield batch.select(["a", "b"]).filter(pa.array(good))

    return joined.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with component, of cells that hold several components, and the cell's number of members."""
    grouped = members.select("key", "node").join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    several = grouped.groupBy("key").agg(F.count("*").alias("cell"), F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    return grouped.join(several.select("key", "cell"), "key")


def _rarest(left: DataFrame, profiles: DataFrame) -> DataFrame:
    """Members of cells without those that a set may leave out of each kind of its cells: the ones of most members."""
    kind = F.col("key").bitwiseAND(F.lit(255)).cast("int")
    spare = F.get("spare", kind - F.get("spare", F.lit(0)) + 1)
    held = left.join(profiles.select("node", "spare"), "node").select("key", "node", "cell", kind.alias("kind"), spare.alias("spare"))
    place = F.row_number().over(Window.partitionBy("node", "kind").orderBy(F.desc("cell"), F.desc("key")))
    return held.withColumn("place", place).where("place > spare").select("key", "node")


def _small_pairs(left: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components in cells of at most ``SMALL`` members whose sizes allow a link."""
    sized = left.where(F.col("cell") <= SMALL).join(profiles.select("node", "size"), "node").select("key", "node", "component", "size")
    other = sized.select("key", F.col("node").alias("b"), F.col("component").alias("other"), F.col("size").alias("size_b"))
    good = _near(F.col("size"), F.col("size_b"), percent) & (F.col("node") < F.col("b")) & (F.col("component") != F.col("other"))
    return sized.join(other, "key").where(good).select(F.col("node").alias("a"), "b").distinct()


_TILE_SCHEMA = "tile long, nodes array<long>, components array<long>, sizes array<int>, lengths array<int>, packed binary, low int, high int, box array<int>, single long"


def _tiles(large: DataFrame, profiles: DataFrame) -> DataFrame:
    """The tree's tiles over the nodes of large cells: those of one home cell, cut by size and leading coordinates.

    A node's home is its largest cell, so a family of like texts has few homes; within a home a component with many nodes
    has tiles of its own. Cuts are approximate quantiles of an ordering number (size, three coordinates, a hash), at
    most ``CUTS``; what is larger still is dealt by hash within them.
    """
    home = large.groupBy("node").agg(F.first("component").alias("component"), F.max(F.struct("cell", "key"))["key"].alias("home"))
    big = home.groupBy("home", "component").count().select("home", "component", F.when(F.col("count") >= TILE // 2, F.col("component")).alias("own"))
    lead = [F.coalesce(F.conv(F.hex(F.substring("point", k, 1)), 16, 10).cast("double"), F.lit(0.0)) for k in (1, 2, 3)]
    order = (((F.col("size") * 256.0 + lead[0]) * 256.0 + lead[1]) * 256.0 + lead[2]) * 512.0 + F.pmod(F.xxhash64("node"), F.lit(512))
    held = home.join(big, ["home", "component"]).join(profiles, "node").withColumn("order", order)
    amount = F.greatest(F.ceil(F.count("*") / TILE), F.ceil(F.sum(F.octet_length("text") + F.octet_length("point")) / TILE_BYTES))
    cuts = F.percentile_approx("order", F.array(*[F.lit(k / CUTS) for k in range(1, CUTS)]), 2000)
    groups = held.groupBy("home", "own").agg(amount.alias("tiles"), cuts.alias("cuts")).select("home", "own", "tiles", F.when(F.col("tiles") > 1, F.col("cuts")).alias("cuts"))
    placed = held.join(groups.withColumnRenamed("own", "of"), (held["home"] == groups["home"]) & held["own"].eqNullSafe(F.col("of"))).drop(groups["home"])
    cut = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("order"))), F.lit(0))
    chunk = F.when(F.col("tiles") <= CUTS, F.floor(cut * F.col("tiles") / CUTS)).otherwise(cut + CUTS * F.pmod(F.xxhash64("node", F.lit(1)), F.ceil(F.col("tiles") / CUTS)))
    rows = F.struct("order", "node", "component", "size", "point", "text")
    packed = placed.groupBy("home", "own", chunk.alias("chunk")).agg(F.sort_array(F.collect_list(rows)).alias("rows"))

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, undo = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            for tile, rows in zip(batch.column("tile").to_pylist(), batch.column("rows"), strict=True):
                cols = {k: rows.values.field(k).to_pylist() for k in ("node", "component", "size", "point", "text")}
                most = np.max([_folded(p, COORDINATES) if p else np.full(COORDINATES, 1 << 30) for p in cols["point"]], axis=0)
                single = cols["component"][0] if len(set(cols["component"])) == 1 else None
                # Texts of one tile are much alike: they are compressed together, and travel so.
                parts = [*cols["point"], *[undo.decompress(t) for t in cols["text"]]]
                lengths, packed = [len(x) for x in parts], pack.compress(b"".join(parts))
                values = [tile, cols["node"], cols["component"], cols["size"], lengths, packed, min(cols["size"]), max(cols["size"]), most.tolist(), single]
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in _TILE_SCHEMA.split(", ")])

    return packed.select(F.xxhash64("home", "own", "chunk").alias("tile"), "rows").mapInArrow(box, _TILE_SCHEMA)


def _tile_pairs(large: DataFrame, tiles: DataFrame, percent: int) -> DataFrame:
    """Pairs ``one, two`` of tiles that share a large cell, whose boxes allow a link, and that are not one component."""
    of = tiles.select("tile", F.explode("nodes").alias("node"))
    spots = large.select("key", "node").join(of, "node").select("key", "tile").distinct()
    pairs = spots.select("key", F.col("tile").alias("one")).join(spots.select("key", F.col("tile").alias("two")), "key").where("one <= two").select("one", "two").distinct()
    for side in ("one", "two"):
        pairs = pairs.join(tiles.select(F.col("tile").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("low", "high", "box", "single")]), side)
    most = F.aggregate(F.zip_with("box_one", "box_two", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda have, x: have + x)
    sizes = (F.col("high_one").cast("long") * 100 >= F.col("low_two").cast("long") * percent) & (F.col("high_two").cast("long") * 100 >= F.col("low_one").cast("long") * percent)
    bound = most * (100 + percent) >= (F.col("low_one").cast("long") + F.col("low_two")) * percent
    other = F.coalesce(F.col("single_one") != F.col("single_two"), F.lit(True))
    return pairs.where(sizes & bound & other).select("one", "two")


def _leaves(points_: list[bytes], sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Of each leaf: its positions (points known, of like number of coordinates), its points folded alike, and their coordinates."""
    out = []
    for a in range(0, len(points_), LEAF):
        at = np.arange(a, min(a + LEAF, len(points_)))
        known = [k for k in at if points_[k]]
        d = min((len(points_[k]) for k in known), default=COORDINATES)
        # A point that exceeds a byte somewhere is not bounded.
        table = np.stack([_folded(points_[k], d) if points_[k] else np.full(d, 1 << 20, np.int32) for k in at])
        out.append((at, table, d))
    return out


def _unpacked(tile: dict) -> tuple[list[bytes], list[bytes]]:
    """A tile's points and texts."""
    data, ends = zstandard.ZstdDecompressor().decompress(tile["packed"]), np.cumsum([0, *tile["lengths"]]).tolist()
    parts = [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    return parts[: len(tile["nodes"])], parts[len(tile["nodes"]) :]


def _compare(one: dict, two: dict, same: bool, n: int, percent: int) -> list[tuple[int, int]]:
    """Links between two tiles that join what is not joined yet: leaves by boxes, points by minima, then the texts."""
    points_one, texts_one = _unpacked(one)
    points_two, texts_two = ([], []) if same else _unpacked(two)
    nodes = np.array(one["nodes"] + ([] if same else two["nodes"]), np.int64)
    sizes = np.array(one["sizes"] + ([] if same else two["sizes"]), np.int64)
    component = np.unique(np.array(one["components"] + ([] if same else two["components"]), np.int64), return_inverse=True)[1]
    left = _leaves(points_one, sizes)
    right = left if same else [(at + len(one["nodes"]), table, d) for at, table, d in _leaves(points_two, sizes[len(one["nodes"]) :])]
    texts, out = None, []
    for p, (at, table, d) in enumerate(left):
        for at2, table2, d2 in right[p:] if same else right:
            if (component[at[0]] == component[at]).all() and (component[at[0]] == component[at2]).all():
                continue
            if 100 * sizes[at].max() < percent * sizes[at2].min() or 100 * sizes[at2].max() < percent * sizes[at].min():
                continue
            c = min(d, d2)
            x, y = table.reshape(len(at), -1, c).sum(1), table2.reshape(len(at2), -1, c).sum(1)
            if np.minimum(x.max(0), y.max(0)).sum() < _least_overlap(sizes[at].min(keepdims=True), sizes[at2].min(), percent)[0]:
                continue
            for k, i in enumerate(at.tolist()):
                rest = np.flatnonzero((component[at2] != component[i]) & (at2 > i) & (100 * np.minimum(sizes[at2], sizes[i]) >= percent * np.maximum(sizes[at2], sizes[i])))
                if not len(rest):
                    continue
                rest = at2[rest[np.minimum(x[k], y[rest]).sum(1) >= _least_overlap(sizes[at2[rest]], sizes[i], percent)]]
                if not len(rest):
                    continue
                if texts is None:
                    texts = _Texts(texts_one + texts_two, n)
                for j in rest[texts.linked(i, rest, percent)].tolist():
                    if component[i] != component[j]:
                        out.append((int(nodes[i]), int(nodes[j])))
                        component[component == component[j]] = component[i]
    return out


def _large_links(large: DataFrame, profiles: DataFrame, n: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links within large cells, tile against tile.

    A tile travels to each of its pairs, which may come to many times all tiles, so pairs are taken in turns by hash and
    only one turn's shuffle files exist at a time. Two sums decide on the number of turns; results don't depend on it.
    """
    tiles = scratch.write(_tiles(large, profiles), "tiles")
    met = scratch.write(_tile_pairs(large, tiles, percent), "met")
    weight = tiles.select(F.col("tile").alias("one"), F.octet_length("packed").alias("bytes"))
    every, shipped = (df.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0] for df in (weight, met.join(weight, "one")))
    turns = max(1, -(-shipped // max(1, SHIPPED * every)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                links = _compare(row["of_one"], row["of_two"], row["one"] == row["two"], n, percent)
                yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())], ["a", "b"])

    out = None
    for turn in range(turns):
        joined = met.where(F.pmod(F.xxhash64("one", "two"), F.lit(turns)) == turn)
        for side in ("one", "two"):
            joined = joined.join(tiles.select(F.col("tile").alias(side), F.struct("nodes", "components", "sizes", "lengths", "packed").alias(f"of_{side}")), side)
        part = scratch.write(joined.mapInArrow(run, "a long, b long"), "links")
        out = part if out is None else out.unionByName(part)
    scratch.drop(tiles, met)
    return out


def jaccard_classes(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row: the size of its set, and the least id it reaches over links.

    Two sets link when 100 * overlap >= ``percent`` * union (1 to 100). Lower case folds A-Z only; words are runs of
    other bytes than blank, tab, line feed, vertical tab, form feed and return; a text of fewer than
    ``n`` words is one gram; texts without words have no set and link with nothing. Rows with a null
    id keep their size and have a null component; of rows that repeat an id each is judged by its own
    text and the id stands for all of them. An empty table gives no rows; other columns are ignored.

    Shared cells are found by minima and maxima combined before the shuffle. Each set is first compared with the least
    set of the cell it shares most often; then only pairs of different components are compared, in small cells pair by
    pair and in large ones by the tree, so a large group of near copies costs a few comparisons a member.
    """
    return _classes(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), n, percent).withColumnRenamed("id", id_col)


def _classes(rows: DataFrame, n: int, percent: int) -> DataFrame:
    if not 1 <= percent <= 100:
        raise ValueError("percent is 1 to 100")
    scratch = Scratch(rows.sparkSession)
    nodes = scratch.write(_per_set(rows, n, "nodes"), "nodes")
    least = nodes.where("size > 0 AND id IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"))
    # A set is in about one cell for 1 / ENTRIES of its n-grams at most in each turn, which bounds what is shuffled at once.
    turns = max(1, round(3 * (100 - percent) / (100 + percent) / ENTRIES))
    members = None
    for turn in range(turns):
        cells = _per_set(rows.where("id IS NOT NULL"), n, "cells", percent, turn, turns)
        shared = cells.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high").select("key", "low")
        part = scratch.write(cells.join(shared, "key").select("key", "node", "low").distinct(), "members")
        members = part if members is None else members.unionByName(part)

    wanted = scratch.write(members.select("node").distinct().join(least, "node"), "wanted")
    some = wanted.select("id").distinct()
    few = wanted.count() <= BROADCAST_IDS
    texts = rows.where("id IS NOT NULL").join(F.broadcast(some) if few else some, "id", "left_semi")
    profiles = _per_set(texts, n, "profiles", percent).join(wanted.select("node"), "node", "left_semi")
    profiles = scratch.write(profiles.groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "point", "text", "spare")]), "profiles")

    often = members.where("node != low").groupBy("node", "low").count().groupBy("node").agg(F.max(F.struct("count", "low")).alias("x"))
    pairs = often.select(F.col("x.low").alias("a"), F.col("node").alias("b"))
    links = scratch.write(_verified(_bounded(pairs, profiles, percent), profiles, n, percent), "links")
    found = connected_components(links, scratch=scratch)
    left = scratch.write(_mixed(members, found), "left")
    scratch.drop(*[t for t, path in scratch.held if "/members-" in path])
    if not left.isEmpty():
        left, every = scratch.write(_mixed(_rarest(left, profiles), found), "rarest"), left
        scratch.drop(every)
        pairs = scratch.write(_bounded(_small_pairs(left, profiles, percent), profiles, percent), "pairs")
        links = links.unionByName(scratch.write(_verified(pairs, profiles, n, percent), "links"))
        found = connected_components(links, scratch=scratch)
        large = scratch.write(_mixed(left.where(F.col("cell") > SMALL), found), "large")
        scratch.drop(left, pairs)
        if not large.isEmpty():
            links = links.unionByName(_large_links(large, profiles, n, percent, scratch))
            found = connected_components(links, scratch=scratch)
    scratch.drop(profiles, wanted)
    ids = least.join(found, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    ids = ids.join(ids.groupBy("component").agg(F.min("id").alias("component_id")), "component").select("node", "component_id")
    component = F.when(F.col("id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "id")).cast("long")
    out = nodes.join(ids, "node", "left").select("id", F.col("size").cast("long").alias("n_shingles"), component.alias("component_id"))
    return scratch.last(out, "classes")


def keep_one(docs: DataFrame, *, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and of each group of linked rows only the one of least id (null ids last).

    Rows are told apart by a number of their own, so rows that repeat an id or have none are judged each by its own
    text, and of rows that are equal one stays. Rows without words stay. No column name clashes: a row travels as one struct.
    """
    scratch = Scratch(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    held = scratch.write(docs.select(F.monotonically_increasing_id().alias("row"), row), "rows", "zstd")
    classes = _classes(held.select(F.col("row").alias("id"), F.col("doc").getField(text_col).alias("text")), n, percent).select(F.col("id").alias("row"), "component_id")
    ids = held.select("row", F.col("doc").getField(id_col).alias("id")).join(classes, "row")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))["row"]
    groups = ids.groupBy("component_id").agg(F.count("*").alias("size"), first.alias("first")).where("size > 1")
    extra = scratch.write(ids.join(groups, "component_id").where("row != first").select("row"), "extra")
    few = extra.count() <= BROADCAST_IDS
    return held.join(F.broadcast(extra) if few else extra, "row", "left_anti").select("doc.*")
