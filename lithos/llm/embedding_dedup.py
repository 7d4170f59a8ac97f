"""Embedding near-dedup: a subspace pigeonhole join, exact.

Unit vectors are rotated at random and cut into blocks of a few dimensions. Two vectors of cosine c are
2 - 2c apart in squared distance; spread over the blocks in proportion to their dimensions, at least one
block of a linked pair is within its share. So each block is range-joined under its share, pairs found in
any block are verified on the whole vectors, and a pair counts in the first block that finds it.

The range join of a block works on tiles: a tree of splits at medians of a bounded sample names a cell for
each vector, cells in order are cut into tiles of at most ``TILE`` vectors, and tiles meet only if their
bounding boxes are within the share. Of two tiles that meet, only vectors within the share of the other's box are
compared. Tiles hold equally many vectors whatever the crowding, so a large group of near copies is spread over
tiles, and its pairs are counted inside tasks and never made rows: a task returns link counts per vector and
a spanning forest of all the links it found. Boxes of more tiles than may be broadcast are met from above: runs of
tiles have boxes too, and only runs that touch are opened.

Blocks are taken one after the other, each with its own order of the vectors, and a block's tiles go when it is done. Where
a tile meets few others, tiles travel along the pairs. Where it meets many, as vectors that are spread evenly do, tiles
stay in their files and each pair of partitions is read by a task of a Cartesian product, which ships and stores nothing.
So either way disk and shuffle grow with the vectors, not with the pairs of tiles.

How much boxes prune depends on the data. For vectors spread evenly over 64 dimensions a share of 0.1 is
wide, most boxes touch, and the work grows with the square of the number of vectors at the speed
of small matrix products; clustered vectors prune well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lithos.llm._spark import Scratch
from lithos.llm.components import connected_components

#: Dimensions of a block, vectors of a tile, sample that sets the splits, depth of the tree, bytes of boxes broadcast at most, and boxes of a run.
BLOCK_DIMS, TILE, SAMPLE, DEPTH, BOX_BYTES, FAN, SEED = 16, 4096, 20_000, 10, 64 << 20, 16, 11
#: Pairs of tiles a tile, its own included, up to which tiles travel along them: at most twice as many bytes as all tiles have.
PARTNERS = 2
#: Rows of a tile compared at once, and pairs verified at once.
STRIP, CHUNK = 512, 65_536


def rotation(dims: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component to 0.5 to 1: cosines stay as they are, and squares neither vanish nor overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0, keepdims=True))[1])


def _usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, row, v``: vectors that are neither null, zero nor hold null or non-finite components."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def _splits(sample: np.ndarray) -> list[list[tuple[int, float]]]:
    """For each depth, per cell the axis of widest spread and its median; leaves are numbered in order."""
    tree, cells = [], [sample]
    for _ in range(DEPTH):
        level, nxt = [], []
        for c in cells:
            axis = int(np.argmax(c.var(0))) if len(c) > 1 else 0
            cut = float(np.median(c[:, axis])) if len(c) else 0.0
            level.append((axis, cut))
            nxt += [c[c[:, axis] <= cut], c[c[:, axis] > cut]]
        tree.append(level)
        cells = nxt
    return tree


def _cell(x: np.ndarray, tree: list[list[tuple[int, float]]]) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    for level in tree:
        axis, cut = np.array([a for a, _ in level])[at], np.array([c for _, c in level])[at]
        at = 2 * at + (x[np.arange(len(x)), axis] > cut)
    return at


def _near(share: float, lo: np.ndarray, hi: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    gap = np.maximum(0, np.maximum(los - hi, lo - his))
    return (gap * gap).sum(-1) <= share


def _find(root: list[int], x: int) -> int:
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


class _Found:
    """Of the tiles that a task joins: link counts of their vectors, and a spanning forest of all links."""

    def __init__(self) -> None:
        #: For each tile its ids, its vectors' counts and the place of the first of them in ``root``.
        self.tiles: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
        self.root: list[int] = []
        self.tree: list[tuple[int, int]] = []

    def add(self, tiles: tuple[int, int], ids: tuple[np.ndarray, np.ndarray], p: np.ndarray, q: np.ndarray) -> None:
        """Links of vectors at ``p`` of the first tile with those at ``q`` of the second."""
        for tile, own, places in zip(tiles, ids, (p, q), strict=True):
            if tile not in self.tiles:
                self.tiles[tile] = own, np.zeros(len(own), np.int64), len(self.root)
                self.root += range(len(self.root), len(self.root) + len(own))
            self.tiles[tile][1][:] += np.bincount(places, minlength=len(own))
        step = 1024
        while len(p):
            if len(p) > step:  # links within what earlier ones have joined are passed over in bulk
                one, two = (np.array([_find(self.root, start + k) for k in range(len(own))]) for own, _, start in (self.tiles[t] for t in tiles))
                apart = one[p] != two[q]
                p, q = p[apart], q[apart]
            for x, y in zip(p[:step].tolist(), q[:step].tolist(), strict=True):
                x, y = x + self.tiles[tiles[0]][2], y + self.tiles[tiles[1]][2]
                i, j = _find(self.root, x), _find(self.root, y)
                if i != j:
                    self.root[max(i, j)] = min(i, j)
                    self.tree.append((x, y))
            p, q, step = p[step:], q[step:], 2 * step

    def rows(self) -> Iterator[pa.RecordBatch]:
        """``id, links, other``: vectors with their counts, then the forest."""
        if not self.tiles:
            return
        ids, counts = (np.concatenate([t[k] for t in self.tiles.values()]) for k in (0, 1))
        some, tree = np.flatnonzero(counts), np.array(self.tree, np.int64).reshape(-1, 2)
        for columns in ((ids[some], counts[some], pa.nulls(len(some), pa.int64())), (ids[tree[:, 0]], np.zeros(len(tree), np.int64), ids[tree[:, 1]])):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "links", "other"])


class _Side:
    """Rows of a tile that are within the share of the other's box, by their coordinates in the block; whole vectors are decoded once they are needed."""

    def __init__(self, vs: bytes, xs: bytes, width: str, spin: np.ndarray, own: slice, box: tuple[np.ndarray, np.ndarray], share: float):
        self.vs, self.width, self.spin = vs, width, spin
        x = np.frombuffer(xs, "<f4").reshape(-1, own.stop - own.start)
        self.rows = np.flatnonzero(_near(share, x, x, *(b.astype(np.float32) for b in box)))
        self.x = x[self.rows]
        self.squares = (self.x * self.x).sum(1)
        self.whole: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def decoded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows' vectors (scaled), their lengths and their turned units, in double precision."""
        if self.whole is None:
            v = _scaled(np.frombuffer(self.vs, self.width).reshape(-1, len(self.spin))[self.rows].astype(float))
            self.whole = v, np.sqrt((v * v).sum(1)), _units(v) @ self.spin
        return self.whole


def _join_tiles(block: int, same: bool, one: _Side, two: _Side, blocks: list[slice], limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs, as places in both tiles, that this block is first to find."""
    dims = blocks[-1].stop
    share = [(2 - 2 * limit) * (s.stop - s.start) / dims * (1 + 1e-9) + 1e-12 for s in blocks]
    if not len(one.rows) or not len(two.rows):
        return
    # One product gives the squared distances; rows of a strip follow one another in the tree, so they have a small box of their own.
    left = np.column_stack([-2 * one.x, one.squares, np.ones_like(one.squares)])
    right = np.column_stack([two.x, np.ones_like(two.squares), two.squares])
    wide = np.float32(share[block] + 1e-5)
    for k in range(0, len(left), STRIP):
        x = one.x[k : k + STRIP]
        cols = np.flatnonzero(_near(wide, x.min(0), x.max(0), two.x, two.x))
        near = left[k : k + STRIP] @ right[cols].T <= wide
        some = np.flatnonzero(near.any(1))
        i, j = np.nonzero(near[some])
        i, j = some[i] + k, cols[j]
        if same:
            i, j = i[after := one.rows[i] < two.rows[j]], j[after]
        for m in range(0, len(i), CHUNK):
            p, q = i[m : m + CHUNK], j[m : m + CHUNK]
            (v, v_len, v_turned), (w, w_len, w_turned) = one.decoded(), two.decoded()
            for b in range(block + 1):
                gap = v_turned[p, blocks[b]] - w_turned[q, blocks[b]]
                within = (gap * gap).sum(1) <= share[b]
                p, q = (x[within if b == block else ~within] for x in (p, q))
            good = (v[p] * w[q]).sum(1) / (v_len[p] * w_len[q]) >= limit
            if good.any():
                yield one.rows[p[good]], two.rows[q[good]]


def near_duplicates(vectors: DataFrame, *, limit: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id`` of every row: other vectors of cosine at least ``limit``, and the least id reached over links.

    Vectors that are null, zero or hold null or non-finite components have no links and are their own
    component. Vectors of unlike lengths don't link; each length is joined by itself. Rows with a null id have null
    in both columns' place of links (0) and component. Ids are to be unique; a repeated one is
    answered once per row with the links of all its vectors. An empty table gives no rows.
    """
    # Vectors travel in the width they have, and are read as doubles.
    width = "<f4" if dict(vectors.dtypes)[vec_col] == "array<float>" else "<f8"
    usable = _usable(vectors, id_col, vec_col)
    every = vectors.select(F.col(id_col).cast("long").alias("id"))
    found = None
    for row in usable.groupBy(F.size("v").alias("n")).count().orderBy("n").collect():
        own = _found(usable.where(F.size("v") == row.n), int(row.n), row["count"], width, limit)
        found = own if found is None else found.unionByName(own)
    if found is None:
        return every.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    links = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    comp = connected_components(found.where("other IS NOT NULL"), "id", "other")
    out = every.join(links, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))


def _touching(share: float) -> F.Column:
    """Of boxes ``lo_one, hi_one`` and ``lo_two, hi_two``: within the share."""
    gap = F.zip_with(F.zip_with("lo_one", "hi_two", lambda a, b: a - b), F.zip_with("lo_two", "hi_one", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x) <= F.lit(share)


def _meeting(boxes: DataFrame, share: float, scratch: Scratch) -> DataFrame | None:
    """``one, two`` (one <= two): tiles whose boxes are within the share; None if there are over ``PARTNERS`` pairs a tile, or a run.

    Tiles are numbered in the order of their cells, so runs of ``FAN`` tiles lie close together and have a box of their
    own, as have runs of runs. The lowest level whose boxes fit ``BOX_BYTES`` is broadcast and meets itself; below it,
    pairs of runs are joined with the boxes of their members, and those that are too far apart go. No level drops a pair
    of tiles within the share, as a run's box holds the boxes of its members.
    """
    spark = boxes.sparkSession
    most = max(1, BOX_BYTES // (16 + 16 * BLOCK_DIMS))
    levels, sizes = [boxes], [boxes.count()]
    while sizes[-1] > most:
        sides = [F.array_compact(F.array(*[least(F.get(c, F.lit(i))) for i in range(BLOCK_DIMS)])).alias(c) for least, c in ((F.min, "lo"), (F.max, "hi"))]
        levels.append(scratch.write(levels[-1].groupBy(F.expr(f"tile div {FAN}").alias("tile")).agg(*sides), "boxes"))
        sizes.append(levels[-1].count())
    rows = levels[-1].orderBy("tile").collect()
    known = spark.sparkContext.broadcast(tuple(np.array(x) for x in zip(*[(r.tile, r.lo, r.hi) for r in rows], strict=True)))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        names, los, his = known.value
        for batch in batches:
            for row in batch.to_pylist():
                yield row["tile"], names[(names >= row["tile"]) & _near(share, np.array(row["lo"]), np.array(row["hi"]), los, his)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([sum(len(two) for _, two in others(batches))], pa.int64())], ["n"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, two in others(batches):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(two), tile)), pa.array(two)], ["one", "two"])

    if levels[-1].mapInArrow(count, "n long").agg(F.sum("n")).first()[0] > PARTNERS * sizes[-1]:
        return None
    pairs = scratch.write(levels[-1].mapInArrow(meet, "one long, two long"), "tile-pairs")
    for level, size in reversed([*zip(levels[:-1], sizes[:-1], strict=True)]):
        one, two = (level.select(F.expr(f"tile div {FAN}").alias(s), F.col("tile").alias(f"in_{s}"), F.col("lo").alias(f"lo_{s}"), F.col("hi").alias(f"hi_{s}")) for s in ("one", "two"))
        below = pairs.join(one, "one").join(two, "two").where((F.col("in_one") <= F.col("in_two")) & _touching(share))
        pairs = scratch.write(below.select(F.col("in_one").alias("one"), F.col("in_two").alias("two")), "tile-pairs")
        if pairs.count() > PARTNERS * size:
            return None
    return pairs


def _found(usable: DataFrame, dims: int, n: int, width: str, limit: float) -> DataFrame:
    """``id, links, other``: link counts and a spanning forest among the ``n`` vectors of one length."""
    spin = rotation(dims)
    blocks = [slice(a, min(a + BLOCK_DIMS, dims)) for a in range(0, dims, BLOCK_DIMS)]
    drawn = usable.orderBy(F.xxhash64("id", F.lit(SEED)), "id").limit(SAMPLE).select("v").toPandas()
    sample = _units(_scaled(np.array(drawn["v"].tolist()))) @ spin
    found = None
    for block in range(len(blocks)):
        own = _found_by(block, usable, sample, spin, blocks, n, width, limit)
        found = own if found is None else found.unionByName(own)
    return found


def _found_by(block: int, usable: DataFrame, sample: np.ndarray, spin: np.ndarray, blocks: list[slice], n: int, width: str, limit: float) -> DataFrame:
    """``id, links, other`` of the pairs that this block is first to find."""
    scratch, dims, s = Scratch(usable.sparkSession), len(spin), blocks[block]
    share = (2 - 2 * limit) * (s.stop - s.start) / dims * (1 + 1e-9) + 1e-5
    tree = _splits(sample[:, s])

    def turned(x: np.ndarray) -> np.ndarray:
        return _units(_scaled(x)) @ spin[:, s]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("v").flatten(), float).reshape(batch.num_rows, dims)
            held = pa.array([row.tobytes() for row in x.astype(width)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(_cell(turned(x), tree)), batch.column("id"), held], ["cell", "id", "v"])

    placed = usable.mapInArrow(place, "cell long, id long, v binary")
    ordered = placed.repartitionByRange(max(1, -(-n // (4 * TILE))), "cell", F.xxhash64("id")).sortWithinPartitions("cell")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, ids, held = TaskContext.get().partitionId(), 0, [], []

        def flush() -> pa.RecordBatch:
            nonlocal seq, ids, held
            vs = b"".join(held)
            x = turned(np.frombuffer(vs, width).reshape(len(ids), dims).astype(float)).astype("<f4")
            out = pa.RecordBatch.from_arrays([pa.array([part * 1_000_000 + seq]), pa.array([ids], pa.list_(pa.int64())), pa.array([vs], pa.binary()), pa.array([x.tobytes()], pa.binary()), *(pa.array([e.astype(float).tolist()], pa.list_(pa.float64())) for e in (x.min(0), x.max(0)))], ["tile", "ids", "vs", "xs", "lo", "hi"])
            seq, ids, held = seq + 1, [], []
            return out

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                ids.append(i)
                held.append(v)
                if len(ids) == TILE:
                    yield flush()
        if ids:
            yield flush()

    tiles = scratch.write(ordered.mapInArrow(pack, "tile long, ids array<long>, vs binary, xs binary, lo array<double>, hi array<double>"), "tiles")
    columns = {"tile": "{}", "ids": "ids_{}", "vs": "vs_{}", "xs": "xs_{}", "lo": "lo_{}", "hi": "hi_{}"}
    left, right = (tiles.select(*[F.col(c).alias(to.format(side)) for c, to in columns.items()]) for side in ("one", "two"))
    pairs = _meeting(tiles.select("tile", "lo", "hi"), share, scratch)
    if pairs is None:
        two = left.hint("shuffle_replicate_nl").join(right, F.expr("one < two") & _touching(share))
    else:
        two = pairs.where("one < two").join(left, "one").join(right, "two")
    # A tile meets itself where it is.
    alone = left.select("*", F.col("one").alias("two"), *[F.lit(None).cast(dict(right.dtypes)[c]).alias(c) for c in right.columns if c != "two"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = _Found()
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                tiles = row["one"].as_py(), row["two"].as_py()
                ends = ("one", "one" if tiles[0] == tiles[1] else "two")
                boxes = [tuple(row[f"{c}_{e}"].values.to_numpy() for c in ("lo", "hi")) for e in ends]
                sides = [_Side(row[f"vs_{e}"].as_buffer(), row[f"xs_{e}"].as_buffer(), width, spin, s, box, share) for e, box in zip(ends, reversed(boxes), strict=True)]
                for p, q in _join_tiles(block, tiles[0] == tiles[1], *sides, blocks, limit):
                    links.add(tiles, tuple(row[f"ids_{e}"].values.to_numpy() for e in ends), p, q)
        yield from links.rows()

    return scratch.last(two.select(*alone.columns).unionByName(alone).mapInArrow(count, "id long, links long, other long"), "found")


def brute_force(ids: list[int], vectors: pd.Series, limit: float) -> dict[int, int]:
    """Number of links of each vector, by all pairs; for tests on small inputs."""
    x = np.array(vectors.tolist(), float)
    norm = np.sqrt((x * x).sum(1))
    good = np.isfinite(x).all(1) & (norm > 0)
    cos = (x[good] @ x[good].T) / np.outer(norm[good], norm[good])
    kept = np.array(ids)[good]
    return dict(zip(kept.tolist(), ((cos >= limit).sum(1) - 1).tolist(), strict=True))
