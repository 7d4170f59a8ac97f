"""Aggregations: fixed periods, benchmarks against the fleet, roll-ups, summaries and pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.operators.quantiles import with_quantiles

from lithos.functions.scalar import is_zero


def fixed_periods(df: DataFrame, time: str, days: int, start: str | None = None) -> DataFrame:
    """Half-open bins of ``days`` from midnight of the first time (or ``start``): ``period``, its start, and its shown end (the last day in it).

    The last bin is cut at the day of the latest time. Bounds are one broadcast row; rows before ``start`` or without a time leave.
    """
    first = F.lit(start).cast("date") if start else F.to_date(F.min(time))
    bounds = df.agg(first.alias("_d0"), F.to_date(F.max(time)).alias("_d1"))
    out = df.where(F.col(time).isNotNull()).join(F.broadcast(bounds), F.to_date(time) >= F.col("_d0"))
    out = out.withColumn("period", F.floor(F.date_diff(F.to_date(time), F.col("_d0")) / days).cast("int"))
    begin = F.date_add("_d0", (F.col("period") * days).cast("int"))
    return out.withColumns({"period_start": begin, "period_end": F.least(F.date_add(begin, days - 1), F.col("_d1"))}).drop("_d0", "_d1")


def period_benchmark(df: DataFrame, keys: Sequence[str], time: str, *, measures: dict[str, str], zero: float, flags: Sequence[str] = (), numeric: Sequence[str] = (), least: int = 1) -> DataFrame:
    """One row per key and period with at least ``least`` rows: size, first and last time, defective count and rate per measure, ON-rates, and numeric means and counts by clean and defective (in the first measure)."""
    clean = is_zero(next(iter(measures.values())), zero)
    aggs: list[Column] = [F.count("*").alias("sample_size"), F.min(time).alias("first_time"), F.max(time).alias("last_time")]
    for m, c in measures.items():
        aggs += [F.count_if(~is_zero(c, zero)).alias(f"defective_{m}"), F.avg((~is_zero(c, zero)).cast("int")).alias(f"rate_{m}")]
    aggs += [F.avg((F.col(f) == "ON").cast("int")).alias(f"{f}_on_rate") for f in flags]
    for n in numeric:
        aggs += [F.avg(F.when(clean, F.col(n))).alias(f"{n}_clean_mean"), F.count(F.when(clean, F.col(n))).alias(f"{n}_clean_count"), F.avg(F.when(~clean, F.col(n))).alias(f"{n}_defective_mean"), F.count(F.when(~clean, F.col(n))).alias(f"{n}_defective_count"), F.sum(n).alias(f"{n}_total"), F.avg(n).alias(f"{n}_mean")]
    return df.dropna(subset=list(keys)).groupBy(*keys, "period", "period_start", "period_end").agg(*aggs).where(F.col("sample_size") >= least)


def fleet_baseline(df: DataFrame, layer: str, measures: dict[str, str], zero: float) -> DataFrame:
    """Fleet rate per measure and units, per period and layer."""
    aggs = [F.avg((~is_zero(c, zero)).cast("int")).alias(f"fleet_rate_{m}") for m, c in measures.items()]
    return df.dropna(subset=[layer]).groupBy("period", layer).agg(F.count("*").alias("fleet_units"), *aggs)


def fleet_usage(log: DataFrame, lot: str, parent: str, entity: str, periods: DataFrame | None = None) -> DataFrame:
    """Usage per period: rows, distinct lots, parents and entities, the busiest parent (by name on ties), mean and sample deviation of rows per parent. Listed periods without rows are 0 and ''."""
    per = log.groupBy("period", parent).agg(F.count("*").alias("_n"))
    top = per.groupBy("period").agg(F.min_by(parent, F.struct(-F.col("_n"), F.col(parent))).alias("top_parent"), F.max("_n").alias("top_parent_rows"), F.avg("_n").alias("parent_mean"), F.stddev_samp("_n").alias("parent_std"))
    out = log.groupBy("period").agg(F.count("*").alias("usage_rows"), F.count_distinct(lot).alias("usage_lots"), F.count_distinct(parent).alias("usage_parents"), F.count_distinct(entity).alias("usage_entities")).join(top, "period")
    if periods is None:
        return out
    out = periods.select("period").distinct().join(out, "period", "left")
    return out.fillna(0, ["usage_rows", "usage_lots", "usage_parents", "usage_entities", "top_parent_rows"]).withColumn("top_parent", F.coalesce(F.col("top_parent").cast("string"), F.lit("")))


def benchmark_measures(rows: DataFrame, fleet: DataFrame, usage: DataFrame, layer: str, measures: Sequence[str]) -> DataFrame:
    """Benchmark rows beside the fleet: share of usage, sample rate, and per measure weighted, expected, observed and excess. Zero divisors give 0."""
    out = rows.join(fleet, ["period", layer], "left").join(usage, "period", "left")
    per_use = lambda n: F.when(F.coalesce("usage_rows", F.lit(0)) == 0, 0.0).otherwise(F.col(n) / F.col("usage_rows"))
    out = out.withColumns({"usage_share": per_use("sample_size"), "sample_rate": per_use("fleet_units")})
    for m in measures:
        out = out.withColumns({f"weighted_{m}": F.when(F.coalesce("fleet_units", F.lit(0)) == 0, 0.0).otherwise(F.col(f"rate_{m}") * F.col("sample_size") / F.col("fleet_units")), f"expected_{m}": F.col("sample_size") * F.col(f"fleet_rate_{m}"), f"observed_{m}": F.col(f"defective_{m}")})
        out = out.withColumn(f"excess_{m}", F.col(f"observed_{m}") - F.col(f"expected_{m}"))
    return out


def baseline_means(df: DataFrame, keys: Sequence[str], measures: dict[str, str], statuses: dict[str, str]) -> DataFrame:
    """Mean and count of each measure over rows of baseline status, and rows that are baseline in any."""
    aggs = [F.count("*").alias("n")]
    anyone = F.lit(False)
    for m, c in measures.items():
        base = F.col(statuses[m]) == "BSL"
        anyone = anyone | base
        aggs += [F.avg(F.when(base, F.col(c))).alias(f"baseline_mean_{m}"), F.count_if(base).alias(f"baseline_count_{m}")]
    return df.groupBy(*keys).agg(*aggs, F.count_if(anyone).alias("baseline_any"))


def first_per_column(c: str, *order: Column) -> Column:
    """First non-null value in order: columns may come from different rows."""
    return F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c)


def distinct_lot_mean(df: DataFrame, keys: Sequence[str], lot: str, value: str, order: Sequence[str]) -> DataFrame:
    """Mean over lots of each lot's first non-null value, and the number of lots."""
    per = df.dropna(subset=[lot]).groupBy(*keys, lot).agg(first_per_column(value, *[F.col(o) for o in order]))
    return per.groupBy(*keys).agg(F.avg(value).alias(f"{value}_lot_mean"), F.count("*").alias("lots"))


def lot_rollup(df: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Per key and column, the latest non-null value."""
    order = [-F.unix_micros(time), *[F.col(t) for t in tie]]
    return df.dropna(subset=[*keys, time]).groupBy(*keys).agg(*[first_per_column(c, *order) for c in columns])


def defect_event_agg(scans: DataFrame, points: DataFrame, elements: DataFrame, keys: Sequence[str], images: str) -> DataFrame:
    """Scans with counts of their defect rows, those with images, and element rows; none are 0 and false."""
    own = points.groupBy(*keys).agg(F.count("*").alias("defect_row_count"), F.count_if(F.col(images) > 0).alias("image_defect_count"))
    parts = elements.groupBy(*keys).agg(F.count("*").alias("element_row_count"))
    out = scans.join(own, list(keys), "left").join(parts, list(keys), "left").fillna(0, ["defect_row_count", "image_defect_count", "element_row_count"])
    return out.withColumns({"has_defect_rows": F.col("defect_row_count") > 0, "has_elements": F.col("element_row_count") > 0})


def run_size(df: DataFrame, keys: Sequence[str], unit: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(unit).alias("n_units_in_run"))


def zero_fraction(df: DataFrame, time: str, measure: str, zero: float, parent: str, side: str, event: str, days: int = 7, wide: Sequence[str] | None = None) -> DataFrame:
    """Share of zero rows per period end, event and group: the parent, and the parent's sides (rows without a side are in the parent only)."""
    binned = fixed_periods(df, time, days).withColumn("end_date", F.date_add("period_start", days - 1))
    groups = F.array_compact(F.array(F.col(parent).cast("string"), F.when(F.col(side).isNotNull(), F.concat_ws("-", F.col(parent).cast("string"), side))))
    tall = binned.withColumn("grp", F.explode(groups)).groupBy("end_date", "grp", event).agg(F.count("*").alias("n"), F.count_if(is_zero(measure, zero)).alias("zeros")).withColumn("fraction", F.col("zeros") / F.col("n"))
    if wide is None:
        return tall
    return tall.groupBy("end_date", event).pivot("grp", list(wide)).agg(F.first("fraction"))


def window_stats(left: DataFrame, right: DataFrame, left_time: str, right_time: str, days: int, start: str, value: str) -> DataFrame:
    """Shared windows over two tables: statistics of one, rows of the other, and the non-zero share of values rounded half-even to 4 places."""
    wid = lambda t: F.floor(F.date_diff(F.to_date(t), F.lit(start).cast("date")) / days).cast("int").alias("window")
    one = left.groupBy(wid(left_time)).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"), F.count_if(F.col(value) == 0).alias("zeros"), F.count_if(F.col(value) != 0).alias("non_zeros"))
    two = right.groupBy(wid(right_time)).agg(F.count("*").alias("other_rows"))
    return one.join(two, "window", "full_outer").withColumn("non_zero_share", F.bround(F.col("non_zeros") / F.nullif(F.col("n"), F.lit(0)), 4))


def run_summary(df: DataFrame, keys: Sequence[str], time: str, unit: str, slot: str, label: str, tie: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(time).alias("run_start"), F.max(time).alias("run_end"), ((F.unix_micros(F.max(time)) - F.unix_micros(F.min(time))) / 60_000_000).alias("span_minutes"), F.count("*").alias("n_rows"),
        F.count_distinct(unit).alias("n_units"), F.min(slot).alias("min_slot"), F.max(slot).alias("max_slot"), F.min_by(label, F.struct(time, *tie)).alias("first_label"), (F.count("*") > F.count_distinct(unit)).alias("has_duplicates"),
    )


def same_day_duplicates(df: DataFrame, keys: Sequence[str], time: str, distinct: Sequence[str]) -> DataFrame:
    """Keys met more than once in a day: counts, distinct values, first, last and span."""
    out = df.groupBy(*keys, F.to_date(time).alias("day")).agg(F.count("*").alias("n"), *[F.count_distinct(c).alias(f"n_{c}") for c in distinct], F.min(time).alias("first_time"), F.max(time).alias("last_time")).where("n > 1")
    return out.withColumn("span_minutes", (F.unix_micros("last_time") - F.unix_micros("first_time")) / 60_000_000).orderBy(*keys, "day")


def status_summary(df: DataFrame, status: str, metrics: Sequence[str]) -> DataFrame:
    """Rows and medians per status, the most frequent first."""
    out = with_quantiles(df.groupBy(status).agg(F.count("*").alias("n")), df, [status], metrics, [0.5])
    return out.withColumnsRenamed({f"{m}_0.5": f"{m}_median" for m in metrics}).orderBy(F.desc("n"), status)


def group_describe(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    base = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    return with_quantiles(base, df, keys, [value], [0.5]).select(*keys, "n", "mean", "std", F.col(f"`{value}_0.5`").alias("median"), "min", "max")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and share of each value (as text) of each column, in one pass; few distinct values are expected, as shares need a column's total."""
    tall = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*")
    counted = tall.groupBy("column", "value").agg(F.count("*").alias("n"))
    totals = counted.groupBy("column").agg(F.sum("n").alias("_total"))
    return counted.join(F.broadcast(totals), "column").withColumn("share", F.col("n") / F.col("_total")).drop("_total")


def variability_summary(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    base = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))
    return with_quantiles(base, df, keys, [value], [0.25, 0.5, 0.75]).withColumnsRenamed({f"{value}_0.25": "q1", f"{value}_0.5": "median", f"{value}_0.75": "q3"})


def coverage_summary(df: DataFrame, columns: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Per column: values, nulls, percent filled, and mean and maximum of numeric ones, from one pass."""
    rows = F.count("*")
    parts = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n_values"), (rows - F.count(c)).alias("n_nulls"), (100 * F.count(c) / rows).alias("percent"), (F.avg(c) if c in numeric else F.lit(None).cast("double")).alias("mean"), (F.max(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("max")) for c in columns]
    return df.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def top_values(df: DataFrame, columns: Sequence[str], n: int = 5) -> DataFrame:
    """``column, rank, value, n``: each column's ``n`` most frequent values that aren't null, as text, ties by value.

    (column, value) pairs are counted in one pass, combined before the shuffle; each partition then hands on its first ``n`` only.
    """
    tall = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")).select("x.*").where("value IS NOT NULL")
    return ranked(tall.groupBy("column", "value").agg(F.count("*").alias("n")), ["column"], [F.desc("n"), F.col("value")], n).select("column", "rank", "value", "n")


def top_entities(df: DataFrame, periods: Sequence[str], entity: str, n: int = 5) -> DataFrame:
    """``entity, n_periods``: entities that have the most rows of a period (the least on ties), by in how many periods they have; the first ``n``."""
    per = df.dropna(subset=[*periods, entity]).groupBy(*periods, entity).agg(F.count("*").alias("_n"))
    tops = per.groupBy(*periods).agg(F.min(F.struct(-F.col("_n"), F.col(entity).alias("e"))).alias("_t"))
    return tops.groupBy(F.col("_t.e").alias(entity)).agg(F.count("*").alias("n_periods")).orderBy(F.desc("n_periods"), entity).limit(n)


def benchmark_summary(df: DataFrame, layer: str, device: str, means: Sequence[str]) -> DataFrame:
    """Means over everything, per layer, per device and per both; ``level`` is Spark's grouping id (3: overall)."""
    return df.cube(layer, device).agg(F.grouping_id().alias("level"), F.count("*").alias("n"), *[F.avg(m).alias(m) for m in means])


def frequency(df: DataFrame, c: str, n: int) -> DataFrame:
    """The n most frequent values, ties by value."""
    return df.groupBy(c).agg(F.count("*").alias("n")).orderBy(F.desc("n"), c).limit(n)


def counter_pivot(df: DataFrame, keys: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long counters to a row per key, the greatest value on a clash, columns in the given order."""
    return df.groupBy(*keys).pivot(name, list(names)).agg(F.max(value))


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)
