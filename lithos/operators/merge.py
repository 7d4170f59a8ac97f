"""Set operations, deduplication and incremental merges. Which row wins is always an explicit, total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.functions.scalar import norm_key, whole_columns


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts once."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.distinct()


def keep_last(sources: Sequence[DataFrame], keys: Sequence[str], tie: Sequence[Column], times: Sequence[str] = ()) -> DataFrame:
    """One row per normalised key: the last source that has it wins, within a source the greatest ``tie``."""
    ranked = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    out = ranked[0]
    for r in ranked[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy("_key").orderBy(F.desc("_src"), *[t.desc() for t in tie])
    return out.withColumn("_key", norm_key(keys, times, whole_columns(*sources))).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_src", "_key")


def overlap_replace(existing: DataFrame, new: DataFrame, keys: Sequence[str], time: str, cutoff: str, tie: Sequence[Column]) -> DataFrame:
    """Existing rows before ``cutoff``, and the new batch, which wins on equal keys. Applying it twice changes nothing."""
    return keep_last([existing.where(F.col(time) < F.lit(cutoff).cast("timestamp")), new], keys, tie)


def extend_history(existing: DataFrame, pulled: DataFrame, keys: Sequence[str], time: str, full_from: str, preserve_from: str, tie: Sequence[Column]) -> DataFrame:
    """An older slice ``[full_from, preserve_from)`` put under what exists, which wins."""
    older = pulled.where((F.col(time) >= F.lit(full_from).cast("timestamp")) & (F.col(time) < F.lit(preserve_from).cast("timestamp")))
    return keep_last([older, existing], keys, tie)


def overlap_cutoff(existing: DataFrame, time: str, days: int, now: str, fallback_days: int) -> DataFrame:
    """One row with the time from which to query again."""
    found = F.max(time) - F.make_dt_interval(F.lit(days))
    return existing.agg(F.coalesce(found, F.lit(now).cast("timestamp") - F.make_dt_interval(F.lit(fallback_days))).alias("cutoff"))


def drop_trailing_partial(benchmark: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Without the period of the latest end if that one is shorter than ``days``; shorter ones before it stay."""
    latest = benchmark.agg(F.max(end).alias("_last"))
    out = benchmark.join(F.broadcast(latest), F.lit(True), "left")
    return out.where(~((F.col(end) == F.col("_last")) & (F.date_diff(F.col(end), F.col(start)) + 1 < days))).drop("_last")


def benchmark_extend(existing: DataFrame, newer: DataFrame, keys: Sequence[str], start: str, end: str, days: int, tie: Sequence[Column]) -> DataFrame:
    """Existing periods without a trailing partial one, and newer ones after their end that aren't partial themselves; the last wins on equal keys."""
    kept = drop_trailing_partial(existing, start, end, days)
    after = kept.agg(F.max(end).alias("_end"))
    fresh = newer.join(F.broadcast(after), F.col("_end").isNull() | (F.col(start) > F.col("_end"))).drop("_end")
    return keep_last([kept, drop_trailing_partial(fresh, start, end, days)], keys, tie)


def manifest_merge(sources: Sequence[DataFrame], keys: Sequence[str], path: str, tie: Sequence[Column]) -> DataFrame:
    """One row per key: one with a path before one without, then the later source."""
    ranked = [s.withColumn("_src", F.lit(i)) for i, s in enumerate(sources)]
    out = ranked[0]
    for r in ranked[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col(path).isNotNull().desc(), F.desc("_src"), *[t.desc() for t in tie])
    return out.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_src")


def usable_in_all(views: Sequence[DataFrame], event: str) -> DataFrame:
    """Distinct events of all views; where none is in all, those of any."""
    sets = [v.select(event).where(F.col(event).isNotNull()).distinct() for v in views]
    tagged = sets[0].withColumn("_v", F.lit(0))
    for i, s in enumerate(sets[1:], 1):
        tagged = tagged.unionByName(s.withColumn("_v", F.lit(i)))
    counted = tagged.groupBy(event).agg(F.count("*").alias("_n"))
    best = counted.agg((F.max("_n") == len(views)).alias("_some"))
    return counted.join(F.broadcast(best), ~F.col("_some") | (F.col("_n") == len(views))).select(event)


def distinct_keys(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key, keys with a null left out."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.dropna(subset=list(keys)).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def overlay_update(prod: DataFrame, stage: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Staged values win where they are there; rows outside the stage stay as they are. A stage with repeated keys gives its first row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    one = stage.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*keys, *[F.col(c).alias(f"_s_{c}") for c in columns])
    return prod.join(one, list(keys), "left").withColumns({c: F.coalesce(f"_s_{c}", c) for c in columns}).select(*prod.columns)


def sync_columns(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[Column], times: Sequence[str] = ()) -> DataFrame:
    """Columns copied by normalised text key from the source's last row; targets without one keep theirs."""
    w = Window.partitionBy("_key").orderBy(*[o.desc() for o in order])
    whole = whole_columns(source, target)
    one = source.withColumn("_key", norm_key(keys, times, whole)).withColumn("_n", F.row_number().over(w)).where("_n = 1").select("_key", *[F.col(c).alias(f"_s_{c}") for c in columns])
    return target.withColumn("_key", norm_key(keys, times, whole)).join(one, "_key", "left").withColumns({c: F.coalesce(f"_s_{c}", c) for c in columns}).select(*target.columns)


def targeted_update(df: DataFrame, scope: Column, changes: dict[str, Column]) -> DataFrame:
    """Chosen columns computed anew where the scope holds; every other cell stays."""
    return df.withColumns({c: F.when(F.coalesce(scope, F.lit(False)), new).otherwise(F.col(c)) for c, new in changes.items()})
