"""Joins beside the as-of family. Nothing is broadcast by hand but single rows and stated lists; the optimizer picks by size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.operators.asof import asof_backward
from lithos.operators.scan import HOT_KEYS


def match_with_fallback(left: DataFrame, events: DataFrame, keys: Sequence[str], left_id: Sequence[str], left_time: str, event_time: str, expected: str, recipes: Sequence[str], values: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The latest event at or before each row among those with its expected recipe in any recipe column; where its key never has it, among all (``recipe_fallback`` 1).

    No row meets events: a flag per key and recipe that occurs tells which of the two a row asks for, and one as-of scan answers both. Of events
    at one time the least ``tie`` wins. Rows without any event at or before them have nulls; repeated ids give a row each.
    """
    own = [F.col(v).alias(f"_v{k}") for k, v in enumerate(values)]
    first = F.min(F.struct(*[F.col(t).alias(f"_t{k}") for k, t in enumerate(tie)], *own)).alias("_e")
    # An event stands under each of its recipes and under all; events of one time are one before they are ordered.
    asked = F.explode(F.array_append(F.transform(F.filter(F.array_distinct(F.array(*recipes)), lambda r: r.isNotNull()), lambda r: F.concat(F.lit("="), r)), F.lit("*")))
    stood = events.dropna(subset=[*keys, event_time]).withColumn("_asked", asked).groupBy(*keys, "_asked", F.col(event_time).alias("_et")).agg(first)
    named = stood.where("_asked != '*'").select(*keys, "_asked", F.lit(True).alias("_named")).distinct()
    out = left.select(F.struct("*").alias("_row"), *keys, F.concat(F.lit("="), F.col(expected)).alias("_asked"), F.col(left_time).alias("_lt")).join(named, [*keys, "_asked"], "left")
    out = asof_backward(out.withColumn("_asked", F.when(F.col("_named"), F.col("_asked")).otherwise("*")), stood, [*keys, "_asked"], "_lt", "_et", ["_e"], prefix="_m_")
    fallback = F.when(F.col("_m_time").isNotNull(), F.col("_named").isNull().cast("int"))
    return out.select("_row.*", F.col("_m_time").alias(event_time), *[F.col(f"_m__e._v{k}").alias(v) for k, v in enumerate(values)], fallback.alias("recipe_fallback"))


def session_match(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, seconds: float) -> DataFrame:
    """Equi-joined pairs within ``seconds``; if nothing at all is, every pair.

    Rows meet those of their own and the neighbouring stretches of ``seconds`` alone; only if that gives no pair (one look by the driver) are a key's rows joined whole.
    """
    width = max(1, int(seconds * 1_000_000))
    at = lambda c: F.floor(F.unix_micros(c) / width)
    near = left.withColumn("_stretch", F.explode(F.sequence(at(left_time) - 1, at(left_time) + 1))).join(right.withColumn("_stretch", at(right_time)), [*keys, "_stretch"])
    near = near.where(F.abs(F.unix_micros(left_time) - F.unix_micros(right_time)) <= int(seconds * 1_000_000)).drop("_stretch")
    return left.join(right, list(keys)) if near.isEmpty() else near


def pair_semi(facts: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return facts.join(pairs.select(*keys).distinct(), list(keys), "left_semi")


def points_enriched(summary: DataFrame, points: DataFrame, keys: Sequence[str], flag: str, classes: DataFrame, class_id: str, bins: DataFrame, bin_id: str, centre: tuple[str, str], xy: tuple[str, str], unit: float) -> DataFrame:
    """Flagged points of summaries with class and bin names (null where unknown) and centre-relative places in another unit."""
    out = summary.join(points.where(F.col(flag) == 1), list(keys)).join(classes, class_id, "left").join(bins, bin_id, "left")
    return out.withColumns({f"{c}_rel": (F.col(c) - F.col(m)) / unit for c, m in zip(xy, centre, strict=True)})


def usage_star(history: DataFrame, dims: Sequence[tuple[DataFrame, Column]], keep: Column) -> DataFrame:
    """A fact joined to all its dimensions, inner, then filtered."""
    out = history
    for dim, on in dims:
        out = out.join(dim, on)
    return out.where(keep)


def context_join(left: DataFrame, context: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """Context of the first row per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return left.join(context.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*keys, *columns), list(keys), "left")


def combine_first(left: DataFrame, lookup: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Own value, else the lookup's (one row per key)."""
    right = lookup.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in columns])
    return left.join(right, list(keys), "left").withColumns({c: F.coalesce(c, f"_l_{c}") for c in columns}).select(*left.columns)


#: Cells of an interval's tree: each holds so many of the level below; the lowest is a day, the highest some 46,000 years. Keys with fewer intervals need none.
_RADIX, _LEVELS, _CELL, _FEW = 4, 12, 86_400_000_000, 64


def _tree_cells(low: str, high: str) -> Column:
    """The fewest cells of all levels that cover the lowest cells ``low`` to ``high``: no more than 2 * (``_RADIX`` - 1) a level, none within another."""
    first, last = (lambda k: f"CAST(ceil({low} / pow({_RADIX}, {k})) AS BIGINT)"), (lambda k: f"(CAST(floor(({high} + 1) / pow({_RADIX}, {k})) AS BIGINT) - 1)")
    above = f"k < {_LEVELS - 1} AND {first('k + 1')} <= {last('k + 1')}"
    left = f"if({above}, least({last('k')}, {first('k + 1')} * {_RADIX} - 1), {last('k')})"
    right = f"({last('k + 1')} + 1) * {_RADIX}"
    none = "CAST(array() AS ARRAY<BIGINT>)"
    cells = f"concat(if({first('k')} <= {left}, sequence({first('k')}, {left}), {none}), if({above} AND {right} <= {last('k')}, sequence({right}, {last('k')}), {none}))"
    return F.expr(f"flatten(transform(sequence(0, {_LEVELS - 1}), k -> transform({cells}, c -> named_struct('_level', k, '_cell', c))))")


def stabbed(rows: DataFrame, row_key: str, time: str, intervals: DataFrame, interval_key: str, start: str, end: str) -> DataFrame:
    """Pairs of rows and intervals of one key with ``start < time < end``; a null ``end`` is open.

    Where a key has more than ``_FEW`` intervals they are cut into cells of a tree of time and a row lies in one cell of each level, so a pair meets once, if it meets
    at all: the work follows the pairs (and those of a first or last day), not rows times intervals, and the key's cells lie in many tasks. The broadcast is
    the list of such keys, the ``HOT_KEYS`` of most intervals. Null keys, times and starts pair with nothing. Columns of the two must differ but for the key.
    """
    held = intervals.where(F.col(interval_key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))
    many = held.groupBy(F.col(interval_key).alias("_many")).agg(F.count("*").alias("_n")).where(F.col("_n") > _FEW).orderBy(F.desc("_n")).limit(HOT_KEYS).select("_many")
    whole = F.array(F.struct(F.lit(-1).alias("_level"), F.lit(0).cast("long").alias("_cell")))

    def celled(side: DataFrame, key: str, cells: Column) -> DataFrame:
        cut = side.join(F.broadcast(many), F.col(key) == F.col("_many"), "left")
        return cut.withColumn("_x", F.explode(F.when(F.col("_many").isNotNull(), cells).otherwise(whole))).select(*side.columns, "_x.*")

    day = lambda c: F.floor(F.unix_micros(c) / _CELL)
    held = held.withColumns({"_low": day(start), "_high": F.coalesce(day(end), F.lit(_RADIX**_LEVELS - 1))})
    held = celled(held, interval_key, _tree_cells("_low", "_high")).drop("_low", "_high")
    asked = rows.where(F.col(row_key).isNotNull() & F.col(time).isNotNull()).withColumn("_day", day(time))
    asked = celled(asked, row_key, F.expr(f"transform(sequence(0, {_LEVELS - 1}), k -> named_struct('_level', k, '_cell', CAST(floor(_day / pow({_RADIX}, k)) AS BIGINT)))")).drop("_day")
    pairs = asked.join(held.withColumnRenamed(interval_key, row_key), [row_key, "_level", "_cell"])
    return pairs.where((F.col(time) > F.col(start)) & (F.col(end).isNull() | (F.col(time) < F.col(end)))).drop("_level", "_cell")


def interval_status(rows: DataFrame, row_id: str, entity: str, time: str, parts: DataFrame, part: str, install: str, remove: str, current: str, value: str, names: Sequence[str], counted: str | None = None, count: str | None = None, tie: Sequence[str] = ()) -> DataFrame:
    """Per row and part, the status of parts installed then (strictly within; current parts have no end), a column per part.

    None valid: NOTFOUND. One: its value. Several: any TRUE 'True', else any MISSING 'MISSING', all FALSE
    'False', else 'MULTIPLE'. The part ``counted`` gives the install count of its latest install, of installs at
    one time that of the greatest ``tie``, null being MISSING. ``recoat`` tells whether any part is true. A part neither current nor with a removal is never valid.
    """
    p = parts.where(F.coalesce(F.col(current), F.lit(False)) | F.col(remove).isNotNull())
    p = p.select(F.col(entity), F.col(part).alias("_p"), F.col(install).alias("_i"), F.when(~F.coalesce(F.col(current), F.lit(False)), F.col(remove)).alias("_r"), F.col(value).alias("_v"), (F.col(count) if count else F.lit(None).cast("int")).alias("_k"), F.struct(F.col(install), *tie).alias("_o"))
    joined = stabbed(rows.select(F.col(row_id).alias("_id"), F.col(entity).alias("_e"), F.col(time).alias("_t")), "_e", "_t", p, entity, "_i", "_r")
    up = F.upper("_v")
    n, any_true, any_missing, all_false = F.count("*"), F.max(up == "TRUE"), F.max(F.col("_v").isNull() | (up == "MISSING")), F.min(F.coalesce(up == "FALSE", F.lit(False)))
    status = F.when(n == 1, F.coalesce(F.max("_v"), F.lit("MISSING"))).when(any_true, "True").when(any_missing, "MISSING").when(all_false, "False").otherwise("MULTIPLE")
    if counted:
        status = F.when(F.col("_p") == counted, F.coalesce(F.max_by("_k", "_o").cast("string"), F.lit("MISSING"))).otherwise(status)
    found = joined.groupBy("_id", "_p").agg(status.alias("status")).groupBy(F.col("_id").alias(row_id)).pivot("_p", list(names)).agg(F.first("status"))
    out = rows.join(found, row_id, "left").fillna("NOTFOUND", list(names))
    recoat = F.lit(False)
    for name in names:
        if name != counted:
            recoat = recoat | (F.upper(F.col(f"`{name}`")) == "TRUE")
    return out.withColumn("recoat", recoat)


def rollout_flags(df: DataFrame, rollouts: DataFrame, entity: str, time: str, features: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """ON where the entity's first rollout row has a turn-on strictly before the time, else OFF."""
    w = Window.partitionBy(entity).orderBy(*order)
    one = rollouts.withColumn("_n", F.row_number().over(w)).where("_n = 1").select(entity, *[F.col(f).alias(f"_on_{f}") for f in features])
    return df.join(one, entity, "left").withColumns({f"{f}_flag": F.when(F.col(f"_on_{f}") < F.col(time), "ON").otherwise("OFF") for f in features}).drop(*[f"_on_{f}" for f in features])


def row_link(detail: DataFrame, summary: DataFrame, keys: Sequence[str], row: str) -> DataFrame:
    """Details with the summary's row number by key, the last row winning; unmatched null."""
    return detail.join(summary.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(row).alias("linked_row")), list(keys), "left")


def linked_selection(linked: DataFrame, selected: DataFrame, row: str) -> DataFrame:
    return linked.join(selected.select(F.col(row).alias("linked_row")).distinct(), "linked_row", "left_semi")


def window_pairs(anchors: DataFrame, history: DataFrame, keys: Sequence[str], time: str, history_time: str, days: float) -> DataFrame:
    """Pairs of one key with ``t - d <= h < t``: equi-joined on key and day, so a pair meets only in its days."""
    a = anchors.withColumn("_day", F.explode(F.sequence(F.date_sub(F.to_date(time), int(days) + 1), F.to_date(time))))
    h = history.withColumn("_day", F.to_date(history_time))
    gap = F.unix_micros(time) - F.unix_micros(history_time)
    return a.join(h, [*keys, "_day"]).where((gap > 0) & (gap <= int(days * 86_400_000_000))).drop("_day")


def fullouter(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "full_outer")


def missing_required(keys: DataFrame, present: DataFrame, key: Sequence[str], image: str, required: Sequence[int]) -> DataFrame:
    """Keys and required images that aren't present."""
    wanted = keys.select(*key).distinct().withColumn(image, F.explode(F.array(*[F.lit(r) for r in required])))
    return wanted.join(present.select(*key, image), [*key, image], "left_anti")


def pad_missing(listed: DataFrame, detail: DataFrame, event: str) -> DataFrame:
    """Details, and a placeholder row for each listed event that has none."""
    return listed.select(event).distinct().join(detail, event, "left")


def covered(summary: DataFrame, detail: DataFrame, keys: Sequence[str]) -> DataFrame:
    return summary.join(detail.select(*keys).distinct(), list(keys), "left_semi")
