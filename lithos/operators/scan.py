"""Scans over ordered keys that no key can make long: hot keys are cut by time, and what held before a cut is carried over it.

A key with more than ``HOT_ROWS`` rows of history has its span of time cut into stretches of equal length, ``STRETCHES`` for every ``HOT_ROWS`` rows. Rows run in
windows of (key, stretch); each stretch's last states or sums, a row per stretch, run in a window of the key and are joined back. Keys below the limit have one stretch and nothing
to carry. The broadcast is the list of hot keys, ``HOT_KEYS`` at most: of more than that the rest have one window each, as before.
Rows that lack a key or time match nothing; they are spread over windows of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS, HOT_KEYS, STRETCHES, SPREAD = 100_000, 10_000, 8, 1024


def hot_keys(history: DataFrame, by: Sequence[str], micros: str, hot_rows: int | None = None) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: where their first stretch begins (``_low``), a stretch's ``_width``, and their number (``_last``)."""
    hot_rows = hot_rows or HOT_ROWS
    sizes = history.groupBy(*by).agg(F.count("*").alias("_n"), F.min(micros).alias("_low"), F.max(micros).alias("_high"))
    hot = sizes.where(F.col("_n") > hot_rows).orderBy(F.desc("_n")).limit(HOT_KEYS).withColumn("_last", F.ceil(F.col("_n") / hot_rows) * STRETCHES)
    return hot.select(*by, "_low", F.expr("(_high - _low) DIV _last + 1").alias("_width"), "_last")


def cut_hot(rows: DataFrame, hot: DataFrame, by: Sequence[str], micros: str, unknown: Column | None = None) -> DataFrame:
    """``rows`` with ``_stretch``: 0 for ordinary keys; for hot ones from 1 to ``_last`` within their history's time, and 0 and ``_last + 1`` around it; below 0 where ``micros`` or a key is null.

    ``unknown`` is what rows without a key or time are spread by.
    """
    named = hot.select(*[F.col(b).alias(f"_hot{k}") for k, b in enumerate(by)], "_low", "_width", "_last")
    known = F.col(micros).isNotNull()
    for b in by:
        known = known & F.col(b).isNotNull()
    inside = F.greatest(F.lit(0), F.least(F.floor((F.col(micros) - F.col("_low")) / F.col("_width")) + 1, F.col("_last") + 1))
    spread = F.lit(-1) if unknown is None else -1 - F.pmod(F.xxhash64(unknown), F.lit(SPREAD))
    cut = rows.join(F.broadcast(named), [F.col(b) == F.col(f"_hot{k}") for k, b in enumerate(by)], "left")
    return cut.withColumn("_stretch", F.when(~known, spread).otherwise(F.coalesce(inside, F.lit(0)))).drop(*named.columns)


def _carry(rows: DataFrame, ends: DataFrame, hot: DataFrame, by: Sequence[str], carried: list[Column]) -> DataFrame:
    """``rows`` with what is carried into each stretch of hot keys."""
    every = hot.select(*by, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last") + 1)).alias("_stretch"))
    return rows.join(every.join(ends, [*by, "_stretch"], "left").select(*by, "_stretch", *carried), [*by, "_stretch"], "left")


def last_states(rows: DataFrame, history: DataFrame, by: Sequence[str], micros: str, order: Sequence[str], up: dict[str, Column], down: dict[str, Column] | None = None, unknown: Column | None = None, hot_rows: int | None = None) -> DataFrame:
    """``rows`` with the last state that isn't null at or above each row in ascending ``order`` (``up``), and the last at or above it in descending order (``down``).

    ``history`` are those of ``rows`` that have states, all with key and time. ``order`` begins with the time; nulls of its other columns come first.
    """
    down = down or {}
    hot = hot_keys(history, by, micros, hot_rows)
    above = Window.partitionBy(*by, "_stretch").orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    below = Window.partitionBy(*by, "_stretch").orderBy(*[F.col(c).desc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    inside = cut_hot(rows, hot, by, micros, unknown).withColumns({n: F.last(s, True).over(above) for n, s in up.items()} | {n: F.last(s, True).over(below) for n, s in down.items()})
    key = F.struct(*[F.col(c) for c in order])
    lasts = [F.max_by(s, F.when(s.isNotNull(), key)).alias(f"_e_{n}") for n, s in up.items()] + [F.min_by(s, F.when(s.isNotNull(), key)).alias(f"_e_{n}") for n, s in down.items()]
    ends = cut_hot(history, hot, by, micros).where("_stretch > 0").groupBy(*by, "_stretch").agg(*lasts)
    before = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*by).orderBy(F.desc("_stretch")).rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.last(f"_e_{n}", True).over(w).alias(f"_c_{n}") for names, w in ((up, before), (down, after)) for n in names]
    names = [*up, *down]
    return _carry(inside, ends, hot, by, carried).withColumns({n: F.coalesce(n, f"_c_{n}") for n in names}).drop("_stretch", *[f"_c_{n}" for n in names])


def running_sums(rows: DataFrame, history: DataFrame, by: Sequence[str], micros: str, order: Sequence[str], sums: dict[str, str], hot_rows: int | None = None) -> DataFrame:
    """``rows`` with running sums of columns over their key, up to and at each row in ascending ``order``; null counts as 0.

    ``history`` are those of ``rows`` that have anything to add. All have keys and times.
    """
    hot = hot_keys(history, by, micros, hot_rows)
    above = Window.partitionBy(*by, "_stretch").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = cut_hot(rows, hot, by, micros).withColumns({n: F.coalesce(F.sum(c).over(above), F.lit(0)) for n, c in sums.items()})
    ends = cut_hot(history, hot, by, micros).where("_stretch > 0").groupBy(*by, "_stretch").agg(*[F.sum(c).alias(f"_e_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum(f"_e_{n}").over(before).alias(f"_c_{n}") for n in sums]
    return _carry(inside, ends, hot, by, carried).withColumns({n: F.col(n) + F.coalesce(f"_c_{n}", F.lit(0)) for n in sums}).drop("_stretch", *[f"_c_{n}" for n in sums])
