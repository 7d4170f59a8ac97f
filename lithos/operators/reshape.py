"""Unpivots, image manifests and path tables. What a pipeline would check on disk is a table of listed paths here."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_elements(df: DataFrame, ids: Sequence[str], pattern: str, labels: dict[str, str], images: str, size: str, edges: Sequence[float]) -> DataFrame:
    """Columns whose name matches ``pattern`` (a number and a name) to rows: only rows with images and values over 0, names mapped, unmapped ones dropped, with a size bucket."""
    own = [c for c in df.columns if re.fullmatch(pattern, c)]
    tall = df.where(F.col(images) > 0).select(*ids, size, *[F.col(c).cast("double").alias(c) for c in own]).unpivot([*ids, size], own, "elem_col", "value").where("value > 0")
    name = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    bucket = F.lit(len(edges))
    for i, e in reversed(list(enumerate(edges))):
        bucket = F.when(F.col(size) <= e, i).otherwise(bucket)
    out = tall.withColumns({"elem_num": F.regexp_extract("elem_col", pattern, 1).try_cast("int"), "original_element": F.regexp_extract("elem_col", pattern, 2), "size_bucket": bucket})
    return out.withColumn("element", F.try_element_at(name, F.col("original_element"))).where("element IS NOT NULL")


def image_pairs(manifest: DataFrame, keys: Sequence[str], image: str, path: str, time: str, ids: tuple[int, int]) -> DataFrame:
    """Keys that have both images, with the newest path of each (the greater path on equal times)."""
    newest = [F.max_by(path, F.when((F.col(image) == i) & F.col(path).isNotNull(), F.struct(time, path))).alias(f"path_{i}") for i in ids]
    return manifest.where(F.col(image).isin(list(ids))).groupBy(*keys).agg(*newest).dropna(subset=[f"path_{i}" for i in ids])


def report_rows(points: DataFrame, pairs: DataFrame, keys: Sequence[str], layer: str, layers: tuple[str, str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Points with image pairs, two layers side by side by row number."""
    both = points.join(pairs, list(keys)).withColumn("row", F.row_number().over(Window.partitionBy(layer).orderBy(*order)))
    sides = [both.where(F.col(layer) == name).select("row", *[F.col(c).alias(f"{c}_{i}") for c in columns]) for i, name in enumerate(layers)]
    return sides[0].join(sides[1], "row", "full_outer")


def excluded_counts(points: DataFrame, pairs: DataFrame, keys: Sequence[str], layer: str, layers: Sequence[str]) -> DataFrame:
    """Per layer of a report: points it shows, and points left out because they have no image pair (null keys too)."""
    paired = points.where(F.col(layer).isin(list(layers))).join(pairs.select(*keys, F.lit(True).alias("_pair")).distinct(), list(keys), "left")
    return paired.groupBy(layer).agg(F.count("_pair").alias("n_included"), F.count_if(F.col("_pair").isNull()).alias("n_excluded"))


def needed_images(points: DataFrame, manifest: DataFrame, keys: Sequence[str], image: str, required: Sequence[int]) -> DataFrame:
    """Points for which a required image isn't in the manifest."""
    wanted = points.select(*keys).distinct().withColumn(image, F.explode(F.array(*[F.lit(i) for i in required])))
    lacking = wanted.join(manifest.select(*keys, image), [*keys, image], "left_anti").select(*keys).distinct()
    return points.join(lacking, list(keys), "left_semi")


def stale_paths(existing: DataFrame, current: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    return existing.join(current.select(*keys, F.col(path).alias("_new")), list(keys)).where(F.col(path).isNotNull() & F.col("_new").isNotNull() & (F.col(path) != F.col("_new"))).select(*keys, F.col(path).alias("old_path"))


def retention_candidates(manifest: DataFrame, path: str, time: str, keep_days: int, overlap_days: int) -> DataFrame:
    """Rows with a path older than both spans before the latest time."""
    bound = manifest.agg((F.max(time) - F.make_dt_interval(F.lit(max(keep_days, overlap_days)))).alias("_at"))
    return manifest.join(F.broadcast(bound), F.col(time) < F.col("_at")).where(F.col(path).isNotNull()).drop("_at")


def reconcile_paths(manifest: DataFrame, expected: str, current: str, name: str, listing: DataFrame) -> DataFrame:
    """The expected path if listed, else the current one if listed, else the only listed path of that file name."""
    paths = listing.select("path").distinct()
    base = F.regexp_extract("path", "([^/]+)$", 1)
    single = paths.groupBy(base.alias("_name")).agg(F.count("*").alias("_n"), F.min("path").alias("_single")).where("_n = 1").drop("_n")
    out = manifest.join(paths.select(F.col("path").alias("_e")), F.col(expected) == F.col("_e"), "left").join(paths.select(F.col("path").alias("_c")), F.col(current) == F.col("_c"), "left").join(single, F.col(name) == F.col("_name"), "left")
    return out.withColumn("resolved", F.coalesce("_e", "_c", "_single")).drop("_e", "_c", "_name", "_single")


def inventory_append(manifest: DataFrame, path: str, listing: DataFrame, parsed: dict[str, Column]) -> DataFrame:
    """The manifest and rows for listed files that it lacks, with fields parsed from the path."""
    fresh = listing.select(F.col("path").alias(path)).distinct().join(manifest.select(path), path, "left_anti").withColumns(parsed)
    return manifest.unionByName(fresh, allowMissingColumns=True)


def sample_join(metrics: DataFrame, details: DataFrame, keys: Sequence[str], time: str, days: int, columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Details of recent metric rows, with columns taken from the metric table's first row per key."""
    bound = metrics.agg((F.max(time) - F.make_dt_interval(F.lit(days))).alias("_at"))
    recent = metrics.join(F.broadcast(bound), F.col(time) >= F.col("_at")).drop("_at")
    one = recent.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").select(*keys, *columns)
    return details.join(one, list(keys))


def new_images(images: DataFrame, expected: str, listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Image rows whose expected path isn't listed; and those for which it is."""
    paths = listing.select(F.col("path").alias(expected)).distinct()
    return images.join(paths, expected, "left_anti"), images.join(paths, expected, "left_semi")
