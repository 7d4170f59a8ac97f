"""Look-back windows, groups and runs.

Look-backs are range frames on microseconds, so ``[t - d, t)`` is exact. A scope without a key (the
whole fleet) isn't one window: rows are cut into time buckets, each bucket's rows run in a window of
their own, and bucket totals, of which there are few, carry the sums before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lithos.functions.scalar import is_zero
from lithos.operators.scan import running_sums

DAY = 86_400_000_000


def control_class(c: str, upper: float, centre: float | None = None) -> Column:
    """0 / up to centre 1 / up to upper 2 / above 3 (without a centre 0, 1, 2); null stays null, negatives are on top."""
    v = F.col(c)
    if centre is None:
        return F.when(v.isNull(), None).when(v == 0, 0).when((v > 0) & (v <= upper), 1).otherwise(2)
    return F.when(v.isNull(), None).when(v == 0, 0).when((v > 0) & (v <= centre), 1).when((v > 0) & (v <= upper), 2).otherwise(3)


def lookback(df: DataFrame, by: Sequence[str], time: str, micros: int, aggs: dict[str, Column]) -> DataFrame:
    """Every row with aggregates over rows of its key in ``[t - micros, t)``. Aggregates are of ``df``'s own columns."""
    frame = Window.partitionBy(*by).orderBy("_us").rangeBetween(-micros, -1)
    known = F.col(time).isNotNull()
    for b in by:
        known = known & F.col(b).isNotNull()
    return df.withColumn("_us", F.unix_micros(time)).withColumns({n: F.when(known, a.over(frame)) for n, a in aggs.items()}).drop("_us")


def running_before(df: DataFrame, time: str, sums: dict[str, Column], bucket: int = DAY) -> DataFrame:
    """Distinct times with the sums over all rows strictly before each, and up to and at it, in time order; no window is global but that of buckets."""
    per = df.where(F.col(time).isNotNull()).groupBy(F.unix_micros(time).alias("_us")).agg(*[s.alias(n) for n, s in sums.items()])
    per = per.withColumn("_bucket", F.floor(F.col("_us") / bucket))
    inside = Window.partitionBy("_bucket").orderBy("_us").rowsBetween(Window.unboundedPreceding, 0)
    totals = per.groupBy("_bucket").agg(*[F.sum(n).alias(f"_t_{n}") for n in sums])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_bucket", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums])
    out = per.withColumns({f"_in_{n}": F.sum(n).over(inside) for n in sums}).join(F.broadcast(totals), "_bucket")
    return out.select("_us", *[(F.col(f"_c_{n}") + F.col(f"_in_{n}")).alias(f"{n}_upto") for n in sums])


def fleet_lookback(anchors: DataFrame, history: DataFrame, time: str, micros: int, sums: dict[str, Column]) -> DataFrame:
    """Anchors with sums over the whole history in ``[t - micros, t)``: running sums taken as of ``t`` and ``t - micros`` and subtracted."""
    upto = running_before(history, time, sums)
    ends = anchors.select(F.unix_micros(time).alias("_q")).where("_q IS NOT NULL").distinct()
    asked = ends.select(F.col("_q").alias("_us"), F.lit(True).alias("_ask")).unionByName(ends.select((F.col("_q") - micros).alias("_us"), F.lit(True).alias("_ask"))).distinct()
    line = upto.withColumn("_ask", F.lit(False)).unionByName(asked, allowMissingColumns=True).withColumn("_bucket", F.floor(F.col("_us") / DAY))
    # What holds strictly before a time: the last running sum above it; in a bucket without one, that of the buckets before.
    last = Window.partitionBy("_bucket").orderBy("_us", F.desc("_ask")).rowsBetween(Window.unboundedPreceding, 0)
    carry = upto.groupBy(F.floor(F.col("_us") / DAY).alias("_b")).agg(*[F.max_by(f"{n}_upto", "_us").alias(f"_l_{n}") for n in sums])
    days = line.select("_bucket").distinct().join(F.broadcast(carry), F.col("_b") == F.col("_bucket"), "left")
    prior = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    days = days.select("_bucket", *[F.last(f"_l_{n}", True).over(prior).alias(f"_p_{n}") for n in sums])
    at = line.withColumns({f"_s_{n}": F.last(f"{n}_upto", True).over(last) for n in sums}).where("_ask").join(F.broadcast(days), "_bucket")
    at = at.select("_us", *[F.coalesce(f"_s_{n}", f"_p_{n}", F.lit(0)).alias(n) for n in sums])
    now = at.select(F.col("_us").alias("_q"), *[F.col(n).alias(f"_e_{n}") for n in sums])
    then = at.select((F.col("_us") + micros).alias("_q"), *[F.col(n).alias(f"_b_{n}") for n in sums])
    found = ends.join(now, "_q").join(then, "_q").select("_q", *[(F.col(f"_e_{n}") - F.col(f"_b_{n}")).alias(n) for n in sums])
    return anchors.withColumn("_q", F.unix_micros(time)).join(found, "_q", "left").drop("_q")


def trend_rates(df: DataFrame, *, group: Sequence[str], scopes: dict[str, Sequence[str]], time: str, days: Sequence[int], measures: dict[str, str], zero: float) -> DataFrame:
    """Look-back rates at each group's first time, on every row of the group.

    Over ``[t0 - d, t0)`` for each scope (a list of key columns) and d: rows, rows that aren't zero per
    measure, and their share. No history is count 0 and a null share. Only groups whose keys are all
    there have values; a scope's history is all rows with its keys.
    """
    anchors = df.dropna(subset=[*group, time]).groupBy(*group, *[k for k in dict.fromkeys(k for ks in scopes.values() for k in ks) if k not in group]).agg(F.min(time).alias("_t0"))
    first = Window.partitionBy(*group)
    anchors = anchors.withColumn("_min", F.min("_t0").over(first)).where("_t0 = _min").drop("_min")
    anchors = anchors.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*[c for c in anchors.columns if c not in group]))).where("_n = 1").drop("_n")

    def of_scopes(rows: DataFrame, *kept: Column) -> DataFrame:
        """Rows once for each scope whose keys they have, with the scope and its keys in one text (lengths tell the keys apart)."""
        keyed = []
        for n, keys in enumerate(scopes.values()):
            texts = [F.col(k).cast("string") for k in keys]
            keyed.append(F.concat(F.lit(f"{n}"), *[part for t in texts for part in (F.lit("/"), F.length(t).cast("string"), F.lit(":"), t)]))
        each = F.posexplode(F.array(*keyed)).alias("_scope", "_key")
        return rows.select(each, *kept).where("_key IS NOT NULL")

    # A frame's sum is the running sum before t less that before t - d: both are read where a probe row stands.
    # A scope may be one key that holds every row: it is cut by time and the sums before each cut are carried.
    history = of_scopes(df.where(F.col(time).isNotNull()), F.unix_micros(time).alias("_us"), F.lit(1).alias("_h"), *[(~is_zero(c, zero)).cast("int").alias(f"_d_{m}") for m, c in measures.items()])
    probes = anchors.withColumn("_ago", F.explode(F.array(*[F.lit(d) for d in (0, *days)])))
    asked = of_scopes(probes, (F.unix_micros("_t0") - F.col("_ago") * DAY).alias("_us"), F.struct(*[F.col(g) for g in group]).alias("_g"), F.col("_ago"))
    stacked = history.unionByName(asked, allowMissingColumns=True).withColumn("_side", F.col("_g").isNull())
    counts = {"count": "_h"} | {f"{m}_count": f"_d_{m}" for m in measures}
    found = running_sums(stacked, history, ["_key"], "_us", ["_us", "_side"], {f"_r_{n}": c for n, c in counts.items()}).where("_g IS NOT NULL")
    at = lambda k, n, d: F.max(F.when((F.col("_scope") == k) & (F.col("_ago") == d), F.col(f"_r_{n}")))
    found = found.groupBy(*[F.col(f"_g.{g}").alias(g) for g in group]).agg(*[(at(k, n, 0) - at(k, n, d)).alias(f"{scope}_{n}_{d}d") for k, scope in enumerate(scopes) for n in counts for d in days])
    out = found.withColumns({f"{scope}_{m}_rate_{d}d": F.col(f"{scope}_{m}_count_{d}d") / F.nullif(F.col(f"{scope}_count_{d}d"), F.lit(0)) for scope in scopes for d in days for m in measures})
    return df.join(out, list(group), "left")


def usage_by_group(anchors: DataFrame, log: DataFrame, entity: str, time: str, hours: Sequence[int], group: str, groups: Sequence[str]) -> DataFrame:
    """Anchors with the log's rows on their entity in ``[t - h, t)``, per recipe group; anchors without a time stay null."""
    marked = log.where(F.col(time).isNotNull() & F.col(entity).isNotNull()).select(entity, F.unix_micros(time).alias("_us"), F.col(group).alias("_group"))
    asked = anchors.select(F.col(entity), F.unix_micros(time).alias("_us"), F.struct("*").alias("_a"))
    stacked = marked.unionByName(asked, allowMissingColumns=True)
    known = F.col("_us").isNotNull() & F.col(entity).isNotNull()
    made = {}
    for h in hours:
        frame = Window.partitionBy(entity).orderBy("_us").rangeBetween(-h * 3_600_000_000, -1)
        for g in groups:
            made[f"{g}_{h}h"] = F.when(known, F.count(F.when(F.col("_group") == g, 1)).over(frame))
    return stacked.withColumns(made).where("_a IS NOT NULL").select("_a.*", *made)


def ratio(entity: str, fleet: str) -> Column:
    """Entity over fleet; 0 where the fleet is 0, null where either is null."""
    return F.when(F.col(fleet) == 0, F.when(F.col(entity).isNotNull(), 0.0)).otherwise(F.col(entity) / F.col(fleet))


def over_known(keys: Sequence[str], value: Column) -> Column:
    """A window value that is null for rows with a null key."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return F.when(known, value.over(Window.partitionBy(*keys)))


def sessionize(df: DataFrame, by: Sequence[str], time: str, gap_minutes: float, tie: Sequence[str] = ()) -> DataFrame:
    """``run`` from 0 per key: a new one where the gap to the row before is over ``gap_minutes`` (equal is not)."""
    w = Window.partitionBy(*by).orderBy(time, *tie)
    gap = F.unix_micros(time) - F.lag(F.unix_micros(time)).over(w)
    marked = df.withColumn("_new", F.coalesce((gap > int(gap_minutes * 60_000_000)).cast("int"), F.lit(0)))
    return marked.withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def run_event_label(size: str, labels: dict[int, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), F.col(size).cast("int"))


def positional_label(df: DataFrame, by: Sequence[str], slot: str, labels: Sequence[str], each: int, tie: Sequence[str] = ()) -> DataFrame:
    """Groups of exactly ``each`` rows per label get labels in rank order; other sizes are PARTIAL_RUN."""
    rank, size = F.row_number().over(Window.partitionBy(*by).orderBy(slot, *tie)), F.count("*").over(Window.partitionBy(*by))
    n = len(labels)
    marked = df.withColumns({"_r": rank, "_s": size})
    at = F.floor((F.col("_r") - 1) / each).cast("int")
    return marked.withColumn("label", F.when(F.col("_s") == n * each, F.get(F.array(*[F.lit(x) for x in labels]), at)).otherwise("PARTIAL_RUN")).drop("_r", "_s")


def block_index(df: DataFrame, by: Sequence[str], order: Sequence[str], k: int, labels: Sequence[str]) -> DataFrame:
    """Block number and position in blocks of k by rank; blocks beyond the list are PARTIAL_RUN."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    out = df.withColumn("_r", rank)
    block = F.floor(F.col("_r") / k).cast("int")
    return out.withColumns({"block": block, "position": (F.col("_r") % k + 1).cast("int"), "block_label": F.coalesce(F.get(F.array(*[F.lit(x) for x in labels]), block), F.lit("PARTIAL_RUN"))}).drop("_r")


def event_position(df: DataFrame, event: Sequence[str], slot: str, order: Sequence[str]) -> DataFrame:
    """Dense rank of the slot in its event; rows without a slot are numbered in event order."""
    ranked = F.dense_rank().over(Window.partitionBy(*event).orderBy(F.col(slot).asc_nulls_last()))
    numbered = F.row_number().over(Window.partitionBy(*event).orderBy(*order))
    return df.withColumn("event_position", F.when(F.col(slot).isNotNull(), ranked).otherwise(numbered))


def run_candidates(df: DataFrame, run: Sequence[str], order: Sequence[str], slot: str, unit: str, time: str) -> DataFrame:
    """Order in run, slot from the run's least, distinct units, start, end and span in minutes."""
    w = Window.partitionBy(*run)
    out = df.withColumns({"row_in_run": F.row_number().over(w.orderBy(*order)), "min_slot": F.min(slot).over(w), "run_units": F.size(F.collect_set(unit).over(w)), "run_start": F.min(time).over(w), "run_end": F.max(time).over(w)})
    return out.withColumns({"slot_offset": F.col(slot) - F.col("min_slot") + 1, "run_minutes": (F.unix_micros("run_end") - F.unix_micros("run_start")) / 60_000_000})


def ffill(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, True).over(w) for c in columns})


def moving_average(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, sizes: Sequence[int]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumns({f"ma{n}": F.avg(value).over(w.rowsBetween(-(n - 1), 0)) for n in sizes})


def prior_lot(df: DataFrame, entity: str, time: str, lot: str, columns: Sequence[str], max_days: float) -> DataFrame:
    """What the lot before on the same entity was, if it started within ``max_days``; one row per lot and entity."""
    starts = df.groupBy(entity, lot).agg(F.min(time).alias("lot_start"), *[F.min_by(c, F.struct(time, c)).alias(c) for c in columns])
    w = Window.partitionBy(entity).orderBy("lot_start", lot)
    out = starts.withColumn("_p", F.lag(F.struct(lot, "lot_start", *columns)).over(w))
    hours = (F.unix_micros("lot_start") - F.unix_micros("_p.lot_start")) / 3_600_000_000
    good = hours <= 24 * max_days
    return out.select(entity, lot, "lot_start", F.when(good, F.col(f"_p.{lot}")).alias("prior_lot"), *[F.when(good, F.col(f"_p.{c}")).alias(f"prior_{c}") for c in columns], F.when(good, hours).alias("hours_since_prior"))


def utilisation(df: DataFrame, entity: str, time: str, busy_hours: str, window_hours: float) -> DataFrame:
    """Over ``[t - window, t)`` on the entity: busy hours, rows, and busy share in percent (0 without history)."""
    out = lookback(df, [entity], time, int(window_hours * 3_600_000_000), {"busy": F.sum(busy_hours), "n_before": F.count(F.lit(1))})
    return out.withColumn("busy", F.coalesce("busy", F.lit(0.0))).withColumn("percent", 100 * F.col("busy") / window_hours)


def monitor_lookback(anchors: DataFrame, readings: DataFrame, entity: str, time: str, value: str, days: int) -> DataFrame:
    """Readings in ``[t - d, t)``: number of distinct times and mean, on the entity and over the fleet; without any on the entity all are 0 or null.

    Readings are first combined per entity and time, so a time counts once.
    """
    per = readings.dropna(subset=[entity, time]).groupBy(entity, time).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    asked = anchors.select(F.col(entity), F.col(time), F.struct("*").alias("_a"))
    stacked = per.unionByName(asked, allowMissingColumns=True).withColumn("_us", F.unix_micros(time))
    frame = Window.partitionBy(entity).orderBy("_us").rangeBetween(-days * DAY, -1)
    own = stacked.withColumns({"entity_n": F.count("_n").over(frame), "_es": F.sum("_s").over(frame), "_en": F.sum("_n").over(frame)}).where("_a IS NOT NULL")
    own = own.select("_a.*", "entity_n", (F.col("_es") / F.nullif(F.col("_en"), F.lit(0))).alias("entity_mean"))
    times = readings.dropna(subset=[time]).groupBy(time).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    out = fleet_lookback(own, times, time, days * DAY, {"fleet_n": F.count(F.lit(1)), "_fs": F.sum("_s"), "_fn": F.sum("_n")})
    some = F.col("entity_n") > 0
    return out.withColumns({"fleet_mean": F.when(some, F.col("_fs") / F.nullif(F.col("_fn"), F.lit(0))), "fleet_n": F.when(some, F.col("fleet_n")).otherwise(0)}).drop("_fs", "_fn")
