"""Data-quality comparison of two outputs. Rows are aligned by key, never by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.functions.scalar import norm_key, whole_columns


def compare_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """One row: distinct keys in both and on one side only, rows, time ranges of both sides, and columns that one side lacks (sorted, comma-joined)."""
    tagged = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r"), F.col(time).alias("_t")).unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"), F.col(time).alias("_t")))
    per = tagged.groupBy(*keys).agg(F.max("_l").alias("l"), F.max("_r").alias("r"), F.sum("_l").alias("nl"), F.sum("_r").alias("nr"), F.min(F.when(F.col("_l") == 1, F.col("_t"))).alias("l0"), F.max(F.when(F.col("_l") == 1, F.col("_t"))).alias("l1"), F.min(F.when(F.col("_r") == 1, F.col("_t"))).alias("r0"), F.max(F.when(F.col("_r") == 1, F.col("_t"))).alias("r1"))
    return per.agg(F.count_if(F.expr("l = 1 AND r = 1")).alias("both"), F.count_if(F.expr("l = 1 AND r = 0")).alias("only_left"), F.count_if(F.expr("l = 0 AND r = 1")).alias("only_right"), F.sum("nl").alias("rows_left"), F.sum("nr").alias("rows_right"), F.min("l0").alias("first_left"), F.max("l1").alias("last_left"), F.min("r0").alias("first_right"), F.max("r1").alias("last_right"),
        F.lit(",".join(sorted(set(left.columns) - set(right.columns)))).alias("columns_left"), F.lit(",".join(sorted(set(right.columns) - set(left.columns)))).alias("columns_right"))


def month_counts(left: DataFrame, right: DataFrame, time: str) -> DataFrame:
    """``month, rows_left, rows_right``: rows with a time by month; 0 where a side has none."""
    one, two = (df.where(F.col(time).isNotNull()).groupBy(F.date_format(time, "yyyy-MM").alias("month")).agg(F.count("*").alias(f"rows_{s}")) for df, s in ((left, "left"), (right, "right")))
    return one.join(two, "month", "full_outer").fillna(0, ["rows_left", "rows_right"])


def duplicate_counts(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: rows of each side that repeat an earlier one (by all columns, or some), and whether there are as many."""
    sides = []
    for df, s in ((left, "left"), (right, "right")):
        per = df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("n"))
        sides.append(per.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(f"duplicates_{s}")))
    return sides[0].join(F.broadcast(sides[1]), F.lit(True)).withColumn("same", F.col("duplicates_left") == F.col("duplicates_right"))


def same_shape(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows of both sides, whether they are as many, and whether names and order of columns agree."""
    one, two = before.agg(F.count("*").alias("rows_before")), after.agg(F.count("*").alias("rows_after"))
    return one.join(F.broadcast(two), F.lit(True)).select("*", (F.col("rows_before") == F.col("rows_after")).alias("same_rows"), F.lit(before.columns == after.columns).alias("same_columns"))


def row_hashes(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row's hash over columns as text, null being empty; each text is led by its length, which keeps columns apart."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]), 256)


def compare_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: distinct rows (by common columns) in both and on one side only, and a verdict: EQUAL, LEFT_SUBSET, RIGHT_SUBSET, OVERLAP or DISJOINT."""
    common = [c for c in left.columns if c in right.columns]
    tagged = left.select(row_hashes(left, common).alias("h"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(row_hashes(right, common).alias("h"), F.lit(0).alias("l"), F.lit(1).alias("r")))
    per = tagged.groupBy("h").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    out = per.agg(F.count_if(F.expr("l + r = 2")).alias("both"), F.count_if(F.expr("l > r")).alias("only_left"), F.count_if(F.expr("r > l")).alias("only_right"))
    return out.withColumn("verdict", F.expr("CASE WHEN only_left = 0 AND only_right = 0 THEN 'EQUAL' WHEN only_left = 0 THEN 'LEFT_SUBSET' WHEN only_right = 0 THEN 'RIGHT_SUBSET' WHEN both > 0 THEN 'OVERLAP' ELSE 'DISJOINT' END"))


def unmatched_profile(df: DataFrame, other: DataFrame, keys: Sequence[str], times: Sequence[str], time: str, by: str, cutoff: str) -> DataFrame:
    """Rows whose normalised key the other side lacks, by month and group, with those before the cutoff; and how concentrated they are (a month's share of all: HIGH over 0.8, MEDIUM over 0.5)."""
    whole = whole_columns(df, other)
    lacking = df.withColumn("_key", norm_key(keys, times, whole)).join(other.select(norm_key(keys, times, whole).alias("_key")).distinct(), "_key", "left_anti")
    counted = lacking.groupBy(F.date_format(time, "yyyy-MM").alias("month"), by).agg(F.count("*").alias("n"), F.count_if(F.col(time) < F.lit(cutoff).cast("timestamp")).alias("before"), F.count_if(F.col(time).isNull()).alias("invalid"))
    months = counted.groupBy("month").agg(F.sum("n").alias("_m"))
    top = months.agg((F.max("_m") / F.sum("_m")).alias("_top"))
    return counted.join(F.broadcast(top), F.lit(True), "left").withColumn("concentration", F.expr("CASE WHEN _top > 0.8 THEN 'HIGH' WHEN _top > 0.5 THEN 'MEDIUM' ELSE 'LOW' END")).drop("_top")


def compare_values(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float = 1e-10) -> DataFrame:
    """Per column over rows with the same key: cells that differ, cells null on one side only, and whether types agree. Floats within the tolerance and nulls on both sides are equal."""
    kinds, others = dict(left.dtypes), dict(right.dtypes)
    joined = left.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in columns]).join(right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in columns]), list(keys))
    parts = []
    for c in columns:
        a, b = F.col(f"_l_{c}"), F.col(f"_r_{c}")
        same = a.eqNullSafe(b)
        if kinds[c] in ("double", "float") and others[c] in ("double", "float"):
            same = same | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))
        parts.append(F.struct(F.lit(c).alias("column"), F.count_if(~same).alias("n_different"), F.count_if(a.isNull() != b.isNull()).alias("n_null_mismatch"), F.lit(kinds[c] == others[c]).alias("same_type")))
    return joined.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def stat_summary_diff(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Right less left of mean, deviation, least and greatest, per numeric column."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        parts = [F.struct(F.lit(c).alias("column"), F.avg(c).alias(f"mean_{tag}"), F.stddev_samp(c).alias(f"std_{tag}"), F.min(c).cast("double").alias(f"min_{tag}"), F.max(c).cast("double").alias(f"max_{tag}")) for c in columns]
        return df.agg(F.array(*parts).alias("x")).select(F.inline("x"))

    out = side(left, "l").join(side(right, "r"), "column")
    return out.select("column", *[(F.col(f"{s}_r") - F.col(f"{s}_l")).alias(f"{s}_diff") for s in ("mean", "std", "min", "max")])


def range_check(source: DataFrame, filtered: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows of the filtered output outside the range, rows inside it in the source, and whether both agree."""
    inside = F.coalesce(F.col(time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")), F.lit(False))
    one = filtered.agg(F.count("*").alias("n_filtered"), F.count_if(~inside).alias("n_outside"))
    two = source.agg(F.count_if(inside).alias("n_expected"))
    return one.join(F.broadcast(two), F.lit(True)).withColumn("ok", F.expr("n_outside = 0 AND n_filtered = n_expected"))


def changed_counts(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    joined = before.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns]).join(after.select(*keys, *columns), list(keys))
    parts = [F.struct(F.lit(c).alias("column"), F.count_if(~F.col(f"_b_{c}").eqNullSafe(F.col(c))).alias("n_changed")) for c in columns]
    return joined.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def transitions(before: DataFrame, after: DataFrame, keys: Sequence[str], column: str, n: int) -> DataFrame:
    """The n most frequent ``old -> new`` pairs of changed rows."""
    joined = before.select(*keys, F.col(column).alias("_b")).join(after.select(*keys, column), list(keys)).where(~F.col("_b").eqNullSafe(F.col(column)))
    text = F.concat_ws(" -> ", F.coalesce(F.col("_b").cast("string"), F.lit("null")), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    return joined.groupBy(text.alias("transition")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "transition").limit(n)


def bounds_check(df: DataFrame, rates: Sequence[str], counts: Sequence[str], expected: Sequence[str]) -> DataFrame:
    """Per rate, values outside 0..1; per count, negative ones; and expected columns that are missing (1)."""
    parts = [F.struct(F.lit(c).alias("column"), F.lit("rate").alias("kind"), F.count_if(~F.col(c).between(0, 1)).alias("n_bad")) for c in rates]
    parts += [F.struct(F.lit(c).alias("column"), F.lit("count").alias("kind"), F.count_if(F.col(c) < 0).alias("n_bad")) for c in counts]
    parts += [F.struct(F.lit(c).alias("column"), F.lit("missing").alias("kind"), F.lit(0 if c in df.columns else 1).cast("long").alias("n_bad")) for c in expected]
    return df.agg(F.array(*parts).alias("x")).select(F.inline("x"))


def link_coverage(linked: DataFrame, by: str) -> DataFrame:
    return linked.groupBy(by).agg(F.count_if(F.col("linked_row").isNotNull()).alias("n_linked"), F.count_if(F.col("linked_row").isNull()).alias("n_unlinked"))


def structure_check(left: DataFrame, right: DataFrame, keys: Sequence[str], group: Sequence[str], sample: int) -> DataFrame:
    """One row: same columns and order, a column group present, and over a sample of keys by hash (1 in ``sample``) the cells that differ."""
    common = [c for c in left.columns if c in right.columns and c not in keys]
    pick = F.pmod(F.xxhash64(*keys), F.lit(sample)) == 0
    cells = compare_values(left.where(pick), right.where(pick), keys, common).agg(F.sum("n_different").alias("n_sample_different"))
    return cells.select(F.lit(set(left.columns) == set(right.columns)).alias("same_columns"), F.lit(left.columns == right.columns).alias("same_order"), F.lit(all(c in right.columns for c in group)).alias("has_group"), "n_sample_different")
