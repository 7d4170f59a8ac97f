"""Exact quantiles without a group's values in one buffer: groups of many rows are cut into ranges of values, and only ranges that hold a wanted rank are ordered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.operators.scan import HOT_KEYS, HOT_ROWS

#: Ranges of a large group; the sketch that proposes them only has to make them about even.
RANGES, _ACCURACY = 128, 1000


def _cuts(value: str) -> Column:
    return F.array_distinct(F.percentile_approx(value, F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)]), F.lit(_ACCURACY)))


def _range_of(cuts: str, value: str) -> Column:
    """How many cuts lie below the value: 0 without cuts."""
    return F.coalesce(F.size(F.filter(F.col(cuts), lambda c: c < F.col(value))), F.lit(0))


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of key columns, nulls being equal."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def quantiles(df: DataFrame, keys: Sequence[str], values: Sequence[str], at: Sequence[float], hot_rows: int | None = None) -> DataFrame:
    """``keys`` and ``{value}_{q}`` of every group: linear between the two neighbouring ranks; null where a group has no value.

    Values are counted first, so repeated ones cost nothing further. Groups of more than ``hot_rows`` values are cut into ``RANGES``
    ranges (the broadcast holds the cuts of ``HOT_KEYS`` groups at most); counts of ranges tell which one a rank lies in, and
    only such ranges are ordered. Null keys are a group.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    tall = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.posexplode(F.array(*[F.col(v).cast("double") for v in values])).alias("_m", "_v")).where("_v IS NOT NULL")
    group = [*names, "_m"]
    sizes = tall.groupBy(*group).agg(F.count("*").alias("_n"), _cuts("_v").alias("_cuts"))
    hot = sizes.where(F.col("_n") > (hot_rows or HOT_ROWS)).orderBy(F.desc("_n")).limit(HOT_KEYS)
    hot = hot.select(*[F.col(g).alias(f"_h{g}") for g in group], "_cuts")
    counted = tall.join(F.broadcast(hot), same_keys(group, [f"_h{g}" for g in group]), "left").withColumn("_r", _range_of("_cuts", "_v"))
    counted = counted.groupBy(*group, "_r", "_v").agg(F.count("*").alias("_t"))
    up = Window.partitionBy(*group).orderBy("_r")
    ranges = counted.groupBy(*group, "_r").agg(F.sum("_t").alias("_in"))
    ranges = ranges.withColumns({"_before": F.sum("_in").over(up) - F.col("_in"), "_n": F.sum("_in").over(Window.partitionBy(*group))})
    place = lambda q, end: (F.floor if end == 0 else F.ceil)(F.lit(q) * (F.col("_n") - 1))
    holds = F.lit(False)
    for q in at:
        for end in (0, 1):
            holds = holds | ((place(q, end) >= F.col("_before")) & (place(q, end) < F.col("_before") + F.col("_in")))
    ranges = ranges.where(holds).select(*[F.col(g).alias(f"_g{g}") for g in group], F.col("_r").alias("_gr"), "_before", "_n")
    near = counted.join(ranges, same_keys([*group, "_r"], [*[f"_g{g}" for g in group], "_gr"]))
    near = near.withColumn("_upto", F.col("_before") + F.sum("_t").over(Window.partitionBy(*group, "_r").orderBy("_v")))
    picked = [F.max(F.when((place(q, end) < F.col("_upto")) & (place(q, end) >= F.col("_upto") - F.col("_t")), F.col("_v"))).alias(f"_q{k}_{end}") for k, q in enumerate(at) for end in (0, 1)]
    found = near.groupBy(*group).agg(F.max("_n").alias("_n"), *picked)
    between = lambda k, q: F.col(f"_q{k}_0") + (F.col(f"_q{k}_1") - F.col(f"_q{k}_0")) * (F.lit(q) * (F.col("_n") - 1) - place(q, 0))
    found = found.select(*group, *[between(k, q).alias(f"_q{k}") for k, q in enumerate(at)])
    made = [F.max(F.when(F.col("_m") == i, F.col(f"_q{k}"))).alias(f"{v}_{q:g}") for i, v in enumerate(values) for k, q in enumerate(at)]
    return found.groupBy(*names).agg(*made).withColumnsRenamed(dict(zip(names, keys, strict=True)))


def with_quantiles(base: DataFrame, df: DataFrame, keys: Sequence[str], values: Sequence[str], at: Sequence[float]) -> DataFrame:
    """``base``, a row per group of ``df``, with its quantiles."""
    found = quantiles(df, keys, values, at)
    other = [f"_o{i}" for i in range(len(keys))]
    found = found.withColumnsRenamed(dict(zip(keys, other, strict=True)))
    return base.join(found, same_keys(keys, other), "left").drop(*other)


def value_ranks(counts: DataFrame, value: str, count: str) -> DataFrame:
    """Distinct values with ``_r`` (their range), ``_t`` (how many there are), ``_below`` (how many lie below): over all rows, in ranges whose totals are carried."""
    cuts = counts.agg(_cuts(value).alias("_cuts"))
    per = counts.join(F.broadcast(cuts), F.lit(True), "left").withColumn("_r", _range_of("_cuts", value)).groupBy("_r", value).agg(F.sum(count).alias("_t"))
    totals = per.groupBy("_r").agg(F.sum("_t").alias("_in"))
    # as many rows as ranges
    totals = totals.select(F.col("_r").alias("_gr"), (F.sum("_in").over(Window.orderBy("_r")) - F.col("_in")).alias("_before"))
    inside = F.sum("_t").over(Window.partitionBy("_r").orderBy(value)) - F.col("_t")
    return per.withColumn("_inside", inside).join(F.broadcast(totals), F.col("_r") == F.col("_gr")).select("_r", value, "_t", (F.col("_before") + F.col("_inside")).alias("_below"))
