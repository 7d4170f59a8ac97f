"""Projections, filters and predicates; modes, limits and lists are parameters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lithos.functions.scalar import month_index


def coalesce_prefix(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """For each prefix in order, one column: the first non-null of the columns that begin with it, left to right.

    Matched columns are consumed, so specific prefixes stand before general ones. A source column
    that already has the target's name is among the candidates if it matches and is replaced.
    """
    left, made = list(df.columns), {}
    for prefix, name in names.items():
        own = [c for c in left if c.startswith(prefix)]
        left = [c for c in left if c not in own]
        if own:
            made[name] = F.coalesce(*[F.col(f"`{c}`") for c in own])
    return df.select(*[F.col(f"`{c}`") for c in left if c not in made], *[c.alias(n) for n, c in made.items()])


def flag_any_prefix(df: DataFrame, prefixes: Sequence[str]) -> Column:
    """1 if any column with one of the prefixes is neither null, blank nor zero."""
    own = [c for c in df.columns if any(c.startswith(p) for p in prefixes)]
    hits = [F.coalesce((F.trim(F.col(f"`{c}`").cast("string")) != "") & (F.coalesce(F.col(f"`{c}`").cast("string").try_cast("double"), F.lit(1.0)) != 0), F.lit(False)) for c in own]
    out = F.lit(False)
    for h in hits:
        out = out | h
    return out.cast("int")


def rename_keep(df: DataFrame, *, drop_token: str, names: dict[str, str], keep: Sequence[str], route_from: str, route: str = "route") -> DataFrame:
    """Without columns whose name holds a token, renamed, a two-letter route derived, only a whitelist kept (in its order)."""
    out = df.drop(*[c for c in df.columns if drop_token in c]).withColumnsRenamed(names)
    if route_from in out.columns:
        out = out.withColumn(route, F.substring(route_from, 1, 2))
    return out.select(*[c for c in keep if c in out.columns])


def date_range(df: DataFrame, time: str, start: str | None, end: str | None) -> DataFrame:
    """Inclusive at both ends; unreadable times leave when a bound is set."""
    t = F.try_to_timestamp(F.col(time).cast("string"))
    out = df
    if start:
        out = out.where(t >= F.lit(start).cast("timestamp"))
    if end:
        out = out.where(t <= F.lit(end).cast("timestamp"))
    return out


def keep_values(df: DataFrame, lists: dict[str, Iterable | None], limit: int | None = None) -> DataFrame:
    """Rows in all given lists (None: no list); a limit only where it is asked for."""
    for c, values in lists.items():
        if values is not None:
            df = df.where(F.col(c).isin(list(values)))
    return df.limit(limit) if limit else df


def recent_from_output(new: DataFrame, existing: DataFrame | None, time: str, days: int) -> DataFrame:
    """Rows not before the latest existing time less ``days``; where nothing exists, the latest new time less ``days``."""
    bound = new.agg(F.max(time).alias("_new"))
    if existing is not None:
        bound = bound.crossJoin(existing.agg(F.max(time).alias("_old"))).select(F.coalesce("_old", "_new").alias("_at"))
    else:
        bound = bound.withColumnRenamed("_new", "_at")
    bound = bound.select((F.col("_at") - F.make_dt_interval(F.lit(days))).alias("_at"))
    return new.join(F.broadcast(bound), F.col(time) >= F.col("_at")).drop("_at")


def month_lookback(df: DataFrame, code: str, months: float) -> DataFrame:
    """The last ``months`` (rounded down, at least 1) year-months of the table; unreadable codes are dropped."""
    back = max(1, int(months)) - 1
    marked = df.withColumn("_m", month_index(code)).where("_m IS NOT NULL")
    bound = marked.agg((F.max("_m") - back).alias("_from"))
    return marked.join(F.broadcast(bound), F.col("_m") >= F.col("_from")).drop("_m", "_from")


#: The labels that ``status2`` gives unless told otherwise.
HIGH, BASELINE = "HIGHFLIER", "BSL"


def status_predicate(mode: str, status: str, klass: str, per_class: dict[str, str] | None = None, focus_class: str | None = None, *, high: str = HIGH, baseline: str = BASELINE) -> Column:
    """``all``, ``hide_high``, ``hide_baseline``, or the latter two for one class, by its own status column or, where it has none, by class and status."""
    if mode == "all":
        return F.lit(True)
    value = high if mode.startswith("hide_high") else baseline
    if focus_class is None:
        return ~F.coalesce(F.col(status) == value, F.lit(False))
    own = (per_class or {}).get(focus_class)
    hit = F.col(own) == value if own else (F.col(klass) == focus_class) & (F.col(status) == value)
    return ~F.coalesce(hit, F.lit(False))


def focus_filter(df: DataFrame, mode: str, entity: str, focus: Sequence, status: str, drop_fleet: bool = False, *, high: str = HIGH, baseline: str = BASELINE) -> DataFrame:
    """``focus`` is the entity if listed, else FLEET; modes all, hide_high, hide_high_outside and hide_baseline."""
    out = df.withColumn("focus", F.when(F.col(entity).isin(list(focus)), F.col(entity).cast("string")).otherwise("FLEET"))
    is_high, is_base = (F.coalesce(F.col(status) == label, F.lit(False)) for label in (high, baseline))
    out = out.where({"all": F.lit(True), "hide_high": ~is_high, "hide_high_outside": ~(is_high & (F.col("focus") == "FLEET")), "hide_baseline": ~is_base}[mode])
    return out.where(F.col("focus") != "FLEET") if drop_fleet else out


def scope_high_filter(df: DataFrame, mode: str, status: str, count: str, *, high: str = HIGH, baseline: str = BASELINE) -> DataFrame:
    """Modes none, hide_high, hide_empty_high (high with count <= 0 or null) and hide_baseline."""
    is_high, is_base = (F.coalesce(F.col(status) == label, F.lit(False)) for label in (high, baseline))
    empty = F.coalesce(F.col(count), F.lit(0)) <= 0
    return df.where({"none": F.lit(True), "hide_high": ~is_high, "hide_empty_high": ~(is_high & empty), "hide_baseline": ~is_base}[mode])


def event_mode(df: DataFrame, mode: str, event: str, families: dict[str, Sequence[str]], order: Sequence[str]) -> DataFrame:
    """Events of one family or of all (``both``), blanks dropped, with ``event_order`` by a custom list (others last)."""
    names = [e for f, own in families.items() if mode in ("both", f) for e in own]
    rank = F.lit(len(order))
    for i, e in reversed(list(enumerate(order))):
        rank = F.when(F.col(event) == e, i).otherwise(rank)
    return df.where((F.trim(event) != "") & F.col(event).isin(names)).withColumn("event_order", rank)


def class_subsets(df: DataFrame, included: Column, klass: str, classes: Sequence[str]) -> dict[str, DataFrame]:
    """All included rows and those of each class, as views of one frame."""
    kept = df.where(included)
    return {"all": kept} | {c: kept.where(F.col(klass) == c) for c in classes}


def reorder_columns(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Priority columns that exist, then the rest as they were."""
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def family_order(columns: Sequence[str], scopes: Sequence[str], periods: Sequence, measures: Sequence[str]) -> list[str]:
    """Generated columns ``{scope}_{measure}_{period}`` by scope, period and measure."""
    return [n for s in scopes for p in periods for m in measures if (n := f"{s}_{m}_{p}") in columns]


def add_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def numeric_text(df: DataFrame, value: str, deleted: str | None = None, out: str = "number") -> DataFrame:
    """Rows whose trimmed text holds digits, dots, minus and blanks only and isn't empty, with the number; of ``deleted`` only N and null stay."""
    keep = F.trim(value).rlike("^[0-9 .-]+$")
    if deleted:
        keep &= F.coalesce(F.col(deleted) == "N", F.lit(True))
    return df.where(keep).withColumn(out, F.trim(value).try_cast("double"))


def image_count_split(df: DataFrame, count: str, least: int) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(count) == least), df.where(F.col(count) > least)


def entity_before(df: DataFrame, entity: str, value, time: str, end: str) -> DataFrame:
    """Rows of one entity up to and at a time; the column has to be a timestamp."""
    if dict(df.dtypes).get(time) != "timestamp":
        raise ValueError(f"{time} is no timestamp")
    return df.where((F.col(entity) == value) & (F.col(time) <= F.lit(end).cast("timestamp")))


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.fullmatch(pattern, c)]
