"""As-of joins: one union and one scan per join, never a theta join.

Both sides are put under each other and ordered by time within their key; a right row stands before a
left row of the same time, so "latest at or before" is the last right row above a left row. Keys or
times that are null match nothing. Right rows at the same time are decided by
``tie`` (its greatest wins). A hot key is cut by time and each stretch's last state carried to the next (``scan``), so it is no longer task than others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.operators.scan import last_states

_ORDER = ("_t", "_side", "_tie")


class _Stack:
    """Left and right rows under each other."""

    def __init__(self, left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], tie: str | None = None, strict: bool = False, right_filter: Column | None = None):
        self.by = list(by)
        right = right.where(right_filter) if right_filter is not None else right
        right = right.dropna(subset=[*by, right_time])
        payload = F.struct(F.col(right_time).alias("_time"), *[F.col(v).alias(v) for v in values])
        kind = right.select(payload.alias("p")).schema["p"].dataType.simpleString()
        order = F.col(tie).cast("string") if tie else F.lit(None).cast("string")
        none = F.lit(None).cast(left.select(F.struct("*").alias("l")).schema["l"].dataType)
        r = right.select(*by, F.col(right_time).alias("_t"), F.lit(1 if strict else 0).alias("_side"), order.alias("_tie"), payload.alias("_right"), none.alias("_left"))
        l = left.select(*by, F.col(left_time).alias("_t"), F.lit(0 if strict else 1).alias("_side"), F.lit(None).cast("string").alias("_tie"), F.expr(f"cast(NULL AS {kind})").alias("_right"), F.struct("*").alias("_left"))  # noqa: E741
        self.history = r.withColumn("_us", F.unix_micros("_t"))
        self.rows = l.unionByName(r).withColumn("_us", F.unix_micros("_t"))

    def scanned(self, up: dict[str, Column], down: dict[str, Column] | None = None) -> DataFrame:
        """Left rows (``_left``, ``_t``) with the states at or before them, and at or after them."""
        return last_states(self.rows, self.history, self.by, "_us", _ORDER, up, down, F.col("_left")).where("_left IS NOT NULL").drop("_us")


def _gap(later: str, earlier: str) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier)


def _nearer(before: str, after: str) -> Column:
    """Of the states on both sides the one nearer to ``_t``; of two as near the earlier."""
    first = F.col(before).isNotNull() & (F.col(after).isNull() | (_gap("_t", f"{before}._time") <= _gap(f"{after}._time", "_t")))
    return F.when(first, F.col(before)).otherwise(F.col(after))


def _within(state: str, hours: float) -> Column:
    return F.when(F.abs(_gap("_t", f"{state}._time")) <= int(hours * 3_600_000_000), F.col(state))


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], *, strict: bool = False, tie: str | None = None, right_filter: Column | None = None, prefix: str = "right_", tolerance_hours: float | None = None) -> DataFrame:
    """Each left row with ``values`` and time of the latest right row of its key at or before it (``strict``: before it)."""
    out = _Stack(left, right, by, left_time, right_time, values, tie, strict, right_filter).scanned({"_got": F.col("_right")})
    if tolerance_hours is not None:
        out = out.withColumn("_got", _within("_got", tolerance_hours))
    return out.select("_left.*", F.col("_got._time").alias(f"{prefix}time"), *[F.col(f"_got.{v}").alias(prefix + v) for v in values])


def asof_by_kind(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, kind: str, kinds: Sequence[str], value: str, *, tie: str | None = None) -> DataFrame:
    """``asof_backward`` per kind, a column each, all in one scan."""
    states = {f"_k{i}": F.when(F.col(f"_right.{kind}") == k, F.struct(f"_right.{value}")) for i, k in enumerate(kinds)}
    out = _Stack(left, right, by, left_time, right_time, [kind, value], tie).scanned(states)
    return out.select("_left.*", *[F.col(f"_k{i}.{value}").alias(str(k)) for i, k in enumerate(kinds)])


def asof_elapsed(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, days: Sequence[int]) -> DataFrame:
    """Hours since the last right row, and flags within each of ``days`` (none before: null hours, 0)."""
    out = asof_backward(left, right, by, left_time, right_time, [])
    out = out.withColumn("hours_since", _gap(left_time, "right_time") / 3_600_000_000).drop("right_time")
    return out.withColumns({f"within_{n}d": F.coalesce(F.col("hours_since") <= 24 * n, F.lit(False)).cast("int") for n in days})


def asof_nearest(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], *, tie: str | None = None, prefix: str = "near_", max_hours: float | None = None, margin_days: int | None = None) -> DataFrame:
    """The nearest right row on either side; of two as near the earlier. ``margin_days``: history within so many days of the group's own time range only."""
    out = _Stack(left, right, by, left_time, right_time, values, tie).scanned({"_b": F.col("_right")}, {"_a": F.col("_right")})
    if margin_days is not None:
        # What lies within the margin is a run of history that holds every left row, so the neighbours in all history do or none does.
        margin = F.make_dt_interval(F.lit(margin_days))
        range_ = left.dropna(subset=[*by, left_time]).groupBy(*by).agg((F.min(left_time) - margin).alias("_low"), (F.max(left_time) + margin).alias("_high"))
        out = out.join(range_, list(by), "left")
        out = out.withColumns({s: F.when(F.col(f"{s}._time").between(F.col("_low"), F.col("_high")), F.col(s)) for s in ("_b", "_a")})
    out = out.withColumn("_got", _nearer("_b", "_a"))
    if max_hours is not None:
        out = out.withColumn("_got", _within("_got", max_hours))
    return out.select("_left.*", F.col("_got._time").alias(f"{prefix}time"), *[F.col(f"_got.{v}").alias(prefix + v) for v in values])


def asof_ffill(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], *, tie: str | None = None, prefix: str = "right_") -> DataFrame:
    """The last non-null value of each column at or before, each on its own, and the latest right time."""
    states = {f"_v{i}": F.col(f"_right.{v}") for i, v in enumerate(values)} | {"_at": F.col("_right._time")}
    out = _Stack(left, right, by, left_time, right_time, values, tie).scanned(states)
    return out.select("_left.*", F.col("_at").alias(f"{prefix}time"), *[F.col(f"_v{i}").alias(prefix + v) for i, v in enumerate(values)])


def asof_fallback_chain(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str, values: Sequence[str], matched: str, *, tie: str | None = None, max_hours: float = 24.0) -> DataFrame:
    """Fill rows that weren't matched, or lack a value, from snapshots around them, all found in one scan.

    Such rows lose their event values first. Each value then comes from the forward-filled snapshot at or
    before, else the nearest snapshot, else the nearest non-null reading of that value within
    ``max_hours``; the last two only where a snapshot at or before exists. ``source`` is EVENT for rows left
    alone, INSPECTION for filled ones, UNMATCHED where nothing was found; ``fallback`` is 1 for INSPECTION.
    """
    states = {"any": F.col("_right")} | {str(i): F.when(F.col(f"_right.{v}").isNotNull(), F.struct("_right._time", F.col(f"_right.{v}").alias("v"))) for i, v in enumerate(values)}
    out = _Stack(left, right, by, left_time, right_time, values, tie).scanned({f"_b{n}": s for n, s in states.items()}, {f"_a{n}": s for n, s in states.items()})
    out = out.withColumns({f"_n{n}": _nearer(f"_b{n}", f"_a{n}") for n in states})
    target = ~F.coalesce(F.col(f"_left.{matched}"), F.lit(False))
    for v in values:
        target = target | F.col(f"_left.{v}").isNull()
    has, found, filled = F.col("_bany").isNotNull(), F.lit(False), {}
    for i, v in enumerate(values):
        around = F.coalesce(F.col(f"_nany.{v}"), _within(f"_n{i}", max_hours).getField("v"))
        filled[v] = F.when(target, F.coalesce(F.col(f"_b{i}.v"), F.when(has, around))).otherwise(F.col(f"_left.{v}"))
        found = found | filled[v].isNotNull()
    source = F.when(~target, "EVENT").when(has & found, "INSPECTION").otherwise("UNMATCHED")
    kept = [filled[c].alias(c) if c in filled else F.col(f"_left.{c}").alias(c) for c in left.columns]
    return out.select(*kept, source.alias("source"), (source == "INSPECTION").cast("int").alias("fallback"))
