"""Nearest points by a tree of cells: exact in crowded and in empty regions, without a group's points meeting each other.

Points of each class lie in a tree of square cells, each cut in 4 by 4 until it holds ``LEAF`` points at most; a cell is known by the box
of its points. Leaves of sources walk down the targets' tree together: a cell whose box is farther than some other box is at most is left out. Only
points of leaves that remain are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points of a leaf, and targets of a group up to which no tree is needed; bits a level takes off a place, and levels.
LEAF, FEW, _BITS, _LEVELS = 256, 2048, 2, 8
_NODE = ["_level", "_cx", "_cy"]


def _celled(points: DataFrame, low: tuple[float, float], span: float) -> DataFrame:
    """Points with their place in the finest grid over all points."""
    side = 1 << (_BITS * _LEVELS)
    at = lambda v, least: F.least(F.lit(side - 1), F.floor((F.col(v) - least) / span * side)) if span else F.lit(0).cast("long")
    return points.withColumns({"_gx": at("_x", low[0]), "_gy": at("_y", low[1])})


def _ancestors(points: DataFrame) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright("_gx", _BITS * (_LEVELS - k)).alias("_cx"), F.shiftright("_gy", _BITS * (_LEVELS - k)).alias("_cy")) for k in range(_LEVELS + 1)])
    return points.withColumn("_c", F.explode(cells)).select("*", "_c.*").drop("_c", "_gx", "_gy")


def _tree(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells of the tree with their boxes, whether they are leaves, and their parents."""
    box = [F.min("_x").alias("_x0"), F.max("_x").alias("_x1"), F.min("_y").alias("_y0"), F.max("_y").alias("_y1")]
    cells = _ancestors(points).groupBy(*keys, *_NODE).agg(F.count("*").alias("_n"), *box)
    cells = cells.withColumn("_leaf", (F.col("_n") <= LEAF) | (F.col("_level") == _LEVELS)).drop("_n")
    up = {"_up_level": F.col("_level") - 1, "_up_cx": F.shiftright("_cx", _BITS), "_up_cy": F.shiftright("_cy", _BITS)}
    full = cells.where("NOT _leaf").select(*keys, F.col("_level").alias("_up_level"), F.col("_cx").alias("_up_cx"), F.col("_cy").alias("_up_cy"))
    cells = cells.withColumns(up)
    return cells.where("_level = 0").unionByName(cells.where("_level > 0").join(full, [*keys, "_up_level", "_up_cx", "_up_cy"], "left_semi"))


def _in_leaves(points: DataFrame, tree: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _ancestors(points).join(tree.where("_leaf").select(*keys, *_NODE), [*keys, *_NODE])


def _far(most: bool) -> Column:
    """The square of the greatest or least distance between points of two boxes (``s`` sources', ``t`` targets')."""
    parts = []
    for v in "xy":
        a0, a1, b0, b1 = (F.col(f"_{side}{v}{k}") for side in "st" for k in (0, 1))
        parts.append(F.greatest(F.abs(b1 - a0), F.abs(a1 - b0)) if most else F.greatest(b0 - a1, a0 - b1, F.lit(0.0)))
    return parts[0] ** 2 + parts[1] ** 2


def _nearest(pairs: DataFrame, keys: Sequence[str], point: str) -> DataFrame:
    distance = F.sqrt((F.col("_bx") - F.col("_x")) ** 2 + (F.col("_by") - F.col("_y")) ** 2)
    return pairs.groupBy(*keys, point).agg(F.min(F.struct(distance.alias("distance"), "near_id")).alias("_m")).select(*keys, point, "_m.distance", "_m.near_id")


def nearest_pairs(df: DataFrame, keys: Sequence[str], klass: str, source: str, target: str, point: str, x: str, y: str) -> DataFrame:
    """``keys, point, distance, near_id``: each ``source`` point's nearest ``target`` point of its group, the least id on ties.

    Points without a key or both coordinates are left out, as are sources of groups without targets; targets at one place are one. The work is
    that of a few leaves a source; a hot group is as many tasks as it has leaves. Where no group has more than ``FEW`` targets they meet its sources as they are.
    The driver reads one row (the most targets and the area), and the tree's depth.
    """
    known = df.dropna(subset=[*keys, x, y]).where(F.col(klass).isin(source, target))
    points = known.select(*keys, F.col(klass).alias("_class"), F.col(point).alias("_id"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    a = points.where(F.col("_class") == target).groupBy(*keys, "_x", "_y").agg(F.min("_id").alias("near_id"))
    b = points.where(F.col("_class") == source).select(*keys, F.col("_id").alias(point), F.col("_x").alias("_bx"), F.col("_y").alias("_by"))
    groups = points.groupBy(*keys).agg(F.count_if(F.col("_class") == target).alias("n"), *[f(v).alias(f"{n}{v}") for v in ("_x", "_y") for n, f in (("low", F.min), ("high", F.max))])
    most, x0, x1, y0, y1 = groups.agg(F.max("n"), F.min("low_x"), F.max("high_x"), F.min("low_y"), F.max("high_y")).first()
    if (most or 0) <= FEW:
        return _nearest(b.join(a, list(keys)), keys, point)
    span = max(x1 - x0, y1 - y0)
    a, b = _celled(a, (x0, y0), span), _celled(b.withColumnsRenamed({"_bx": "_x", "_by": "_y"}), (x0, y0), span)
    targets, sources = _tree(a, keys), _tree(b, keys)
    depth = targets.agg(F.max("_level")).first()[0] or 0

    boxes = lambda side: [F.col(f"_{v}{k}").alias(f"_{side}{v}{k}") for v in "xy" for k in (0, 1)]
    tile = [F.col(c).alias(f"_s{c}") for c in _NODE]
    meets = sources.where("_leaf").select(*keys, *tile, *boxes("s")).join(targets.where("_level = 0").select(*keys, *_NODE, *boxes("t")), list(keys))
    kids = targets.where("_level > 0").select(*keys, *[F.col(f"_up{c}").alias(c) for c in _NODE], *[F.col(c).alias(f"_k{c}") for c in _NODE], *[F.col(f"_{v}{k}").alias(f"_k{v}{k}") for v in "xy" for k in (0, 1)])
    for level in range(depth):
        down = meets.join(kids.where(F.col("_level") == level), [*keys, *_NODE], "left")
        got = F.col("_k_level").isNotNull()
        node = {c: F.when(got, F.col(f"_k{c}")).otherwise(F.col(c)) for c in _NODE}
        box = {f"_t{v}{k}": F.when(got, F.col(f"_k{v}{k}")).otherwise(F.col(f"_t{v}{k}")) for v in "xy" for k in (0, 1)}
        down = down.withColumns(node | box).drop(*[c for c in kids.columns if c.startswith("_k")])
        of_tile = Window.partitionBy(*keys, *[f"_s{c}" for c in _NODE])
        # a little more than the bound, for what rounding takes off
        meets = down.withColumn("_most", F.min(_far(True)).over(of_tile)).where(_far(False) <= F.col("_most") * (1 + 1e-9)).drop("_most")

    pairs = meets.select(*keys, *[f"_s{c}" for c in _NODE], *_NODE)
    left = _in_leaves(b, sources, keys).select(*keys, point, F.col("_x").alias("_bx"), F.col("_y").alias("_by"), *tile)
    right = _in_leaves(a, targets, keys).select(*keys, "near_id", "_x", "_y", *_NODE)
    return _nearest(pairs.join(left, [*keys, *[f"_s{c}" for c in _NODE]]).join(right, [*keys, *_NODE]), keys, point)
