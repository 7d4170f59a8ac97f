"""Queries of windows and runs (E) and of order and limits (F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.operators import aggregate as D
from lithos.operators import order as O
from lithos.operators import windows as W
from lithos.plans.base import query, units, us, usage

_Z = "(density_a IS NULL OR density_a >= 1)"
DAY = 86_400_000_000


def _trend(scope: str, keys: str, d: int) -> str:
    on = " AND ".join(f"h.{k} = a.{k}" for k in keys.split(","))
    return f"(SELECT count(*) FROM u h WHERE {on} AND epoch_us(h.time) >= epoch_us(a.t0) - {d} * {DAY} AND h.time < a.t0) AS {scope}_count_{d}d, (SELECT count(*) FROM u h WHERE {on} AND {_Z.replace('density_a', 'h.density_a')} AND epoch_us(h.time) >= epoch_us(a.t0) - {d} * {DAY} AND h.time < a.t0) AS {scope}_a_count_{d}d"


@query("E1_trend_rates", f"""WITH a AS (SELECT layer, lot, entity, min(time) AS t0, arg_min(device, time) AS device FROM u GROUP BY layer, lot, entity),
t AS (SELECT a.*, {_trend('fleet', 'layer', 7)}, {_trend('device', 'layer,device', 7)}, {_trend('entity', 'layer,entity', 7)}, {_trend('entity', 'layer,entity', 2)} FROM a)
SELECT unit_id, fleet_count_7d, fleet_a_count_7d, round(fleet_a_count_7d / nullif(fleet_count_7d, 0), 6) AS fleet_a_rate_7d, device_count_7d, entity_count_7d, entity_a_count_7d, round(entity_a_count_7d / nullif(entity_count_7d, 0), 6) AS entity_a_rate_7d, entity_count_2d
FROM u JOIN t ON u.layer = t.layer AND u.lot = t.lot AND u.entity = t.entity""")
def e1(spark, d):
    out = W.trend_rates(units(spark, d).withColumn("density_a", F.floor("density_a")), group=["layer", "lot", "entity"], scopes={"fleet": ["layer"], "device": ["layer", "device"], "entity": ["layer", "entity"]}, time="time", days=[2, 7], measures={"a": "density_a"}, zero=0)
    return out.select("unit_id", "fleet_count_7d", "fleet_a_count_7d", F.round("fleet_a_rate_7d", 6).alias("fleet_a_rate_7d"), "device_count_7d", "entity_count_7d", "entity_a_count_7d", F.round("entity_a_rate_7d", 6).alias("entity_a_rate_7d"), "entity_count_2d")


@query("E2_usage_by_group")
def e2(spark, d):
    """Every lot and entity; SQL over all is too slow, so a test holds it against plain Python."""
    g = usage(spark, d)
    own = g.groupBy("lot", "entity").agg(F.max("time").alias("time"))
    out = W.usage_by_group(own, g, "entity", "time", [480, 2400], "recipe", ["A", "R"])
    return out.select("lot", "entity", "A_480h", "R_480h", "R_2400h")


@query("E3_usage_layer_product")
def e3(spark, d):
    """Every unit; SQL over all is too slow, so a test holds it against plain Python."""
    u = units(spark, d)
    sums = {"fleet_all": F.count(F.lit(1)), "fleet_layer": F.count_if(F.col("layer") == "view")}
    fleet = W.fleet_lookback(u.select("unit_id", "time"), u, "time", 3 * DAY, sums)
    own = W.lookback(u, ["entity"], "time", 3 * DAY, {"entity_all": F.count(F.lit(1))}).select("unit_id", "entity_all")
    return fleet.join(own, "unit_id").select("unit_id", "fleet_all", "fleet_layer", "entity_all")


@query("E4_monitor_lookback", f"""WITH v AS (SELECT * FROM u WHERE layer = 'view')
SELECT unit_id, entity_n, CASE WHEN entity_n = 0 THEN NULL ELSE round(entity_mean, 6) END AS entity_mean, CASE WHEN entity_n = 0 THEN 0 ELSE fleet_n END AS fleet_n, CASE WHEN entity_n = 0 THEN NULL ELSE round(fleet_sum / nullif(fleet_n, 0), 6) END AS fleet_mean,
CASE WHEN entity_n = 0 THEN NULL WHEN entity_mean = 0 THEN 0 WHEN entity_mean > 0 AND entity_mean <= 400 THEN 1 WHEN entity_mean > 0 AND entity_mean <= 1000 THEN 2 ELSE 3 END AS class FROM (SELECT v.unit_id,
(SELECT count(*) FROM u h WHERE h.layer = 'error' AND h.entity = v.entity AND h.time < v.time AND epoch_us(h.time) >= epoch_us(v.time) - 7 * {DAY}) AS entity_n, (SELECT avg(CAST(round(density_a * 100) AS BIGINT)) FROM u h WHERE h.layer = 'error' AND h.entity = v.entity AND h.time < v.time AND epoch_us(h.time) >= epoch_us(v.time) - 7 * {DAY}) AS entity_mean,
(SELECT count(DISTINCT time) FROM u h WHERE h.layer = 'error' AND h.time < v.time AND epoch_us(h.time) >= epoch_us(v.time) - 7 * {DAY}) AS fleet_n, (SELECT sum(CAST(round(density_a * 100) AS BIGINT)) FROM u h WHERE h.layer = 'error' AND h.time < v.time AND epoch_us(h.time) >= epoch_us(v.time) - 7 * {DAY}) AS fleet_sum FROM v)""")
def e4(spark, d):
    u = units(spark, d)
    out = W.monitor_lookback(u.where("layer = 'view'").select("unit_id", "entity", "time"), u.where("layer = 'error'").select("entity", "time", F.round(F.col("density_a") * 100).cast("long").alias("density_a")), "entity", "time", "density_a", 7)
    out = out.withColumn("class", W.control_class("entity_mean", 1000, 400))
    return out.select("unit_id", "entity_n", F.round("entity_mean", 6).alias("entity_mean"), "fleet_n", F.round("fleet_mean", 6).alias("fleet_mean"), "class")


@query("E6_control_class", "SELECT unit_id, CASE WHEN v IS NULL THEN NULL WHEN v = 0 THEN 0 WHEN v > 0 AND v <= 2 THEN 1 WHEN v > 0 AND v <= 8 THEN 2 ELSE 3 END AS four, CASE WHEN v IS NULL THEN NULL WHEN v = 0 THEN 0 WHEN v > 0 AND v <= 8 THEN 1 ELSE 2 END AS three FROM (SELECT unit_id, density_b - 1 AS v FROM u)")
def e6(spark, d):
    u = units(spark, d).withColumn("v", F.col("density_b") - 1)
    return u.select("unit_id", W.control_class("v", 8, 2).alias("four"), W.control_class("v", 8).alias("three"))


@query("E7_ratio_columns", "SELECT unit_id, CASE WHEN f = 0 THEN CASE WHEN density_b IS NOT NULL THEN 0.0 END ELSE round(density_b / f, 6) END AS ratio FROM (SELECT unit_id, density_b, CASE WHEN unit_id % 4 = 0 THEN 0 WHEN unit_id % 5 = 0 THEN NULL ELSE density_a END AS f FROM u)")
def e7(spark, d):
    u = units(spark, d).withColumn("f", F.when(F.col("unit_id") % 4 == 0, 0.0).when(F.col("unit_id") % 5 != 0, F.col("density_a")))
    return u.select("unit_id", F.round(W.ratio("density_b", "f"), 6).alias("ratio"))


@query("E8_group_size", "SELECT unit_id, CASE WHEN l IS NULL THEN NULL ELSE count(*) OVER (PARTITION BY layer, l) END AS n_lot, CASE WHEN l IS NULL THEN NULL ELSE round(avg(unit_id) OVER (PARTITION BY layer, l, entity), 6) END AS mean_order FROM (SELECT *, CASE WHEN lot % 4 = 0 THEN NULL ELSE lot END AS l FROM u)")
def e8(spark, d):
    u = units(spark, d).withColumn("l", F.when(F.col("lot") % 4 != 0, F.col("lot")))
    return u.select("unit_id", W.over_known(["layer", "l"], F.count("*")).alias("n_lot"), F.round(W.over_known(["layer", "l", "entity"], F.avg("unit_id")), 6).alias("mean_order"))


@query("E9_group_rate", f"SELECT unit_id, round(avg(CAST({_Z} AS INT)) OVER (PARTITION BY lot, layer, entity), 6) AS rate, max(CAST({_Z} AS INT)) OVER (PARTITION BY lot, layer, entity) = 0 AS lot_clean FROM u")
def e9(spark, d):
    from lithos.functions.scalar import is_zero

    bad = (~is_zero(F.floor("density_a"))).cast("int")
    keys = ["lot", "layer", "entity"]
    return units(spark, d).select("unit_id", F.round(W.over_known(keys, F.avg(bad)), 6).alias("rate"), (W.over_known(keys, F.max(bad)) == 0).alias("lot_clean"))


_RUN = "SELECT *, sum(n) OVER (PARTITION BY lot, layer ORDER BY time, unit_id ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN epoch_us(time) - epoch_us(lag(time) OVER (PARTITION BY lot, layer ORDER BY time, unit_id)) > 21600000000 THEN 1 ELSE 0 END AS n FROM u)"


def _runs(spark, d):
    return W.sessionize(units(spark, d), ["lot", "layer"], "time", 360, ["unit_id"])


@query("E10_sessionize", f"SELECT unit_id, CAST(run AS BIGINT) AS run FROM ({_RUN})")
def e10(spark, d):
    return _runs(spark, d).select("unit_id", F.col("run").cast("long").alias("run"))


@query("E11_run_event_label", f"SELECT lot, layer, CAST(run AS BIGINT) AS run, count(DISTINCT entity) AS n_units, CASE count(DISTINCT entity) WHEN 1 THEN 'SINGLE' WHEN 2 THEN 'PAIR' END AS label FROM ({_RUN}) GROUP BY ALL")
def e11(spark, d):
    out = _runs(spark, d).groupBy("lot", "layer", F.col("run").cast("long").alias("run")).agg(F.count_distinct("entity").alias("n_units"))
    return out.withColumn("label", W.run_event_label("n_units", {1: "SINGLE", 2: "PAIR"}))


@query("E12_positional_label", """SELECT unit_id, CASE WHEN s = 6 THEN (['X', 'Y', 'Z'])[CAST((r - 1) // 2 AS INT) + 1] ELSE 'PARTIAL_RUN' END AS label FROM
(SELECT unit_id, row_number() OVER (PARTITION BY lot, layer, CAST(time AS DATE) ORDER BY entity, unit_id) AS r, count(*) OVER (PARTITION BY lot, layer, CAST(time AS DATE)) AS s FROM u)""")
def e12(spark, d):
    u = units(spark, d).withColumn("day", F.to_date("time"))
    return W.positional_label(u, ["lot", "layer", "day"], "entity", ["X", "Y", "Z"], 2, ["unit_id"]).select("unit_id", "label")


@query("E13_block_index", """SELECT unit_id, CAST(r // 25 AS INT) AS block, CAST(r % 25 + 1 AS INT) AS position, coalesce((['P', 'Q', 'R'])[CAST(r // 25 AS INT) + 1], 'PARTIAL_RUN') AS block_label FROM (SELECT unit_id, row_number() OVER (PARTITION BY lot, layer ORDER BY time, unit_id) - 1 AS r FROM u)""")
def e13(spark, d):
    return W.block_index(units(spark, d), ["lot", "layer"], ["time", "unit_id"], 25, ["P", "Q", "R"]).select("unit_id", "block", "position", "block_label")


@query("E14_event_position", """SELECT unit_id, CASE WHEN slot IS NOT NULL THEN dense_rank() OVER (PARTITION BY lot, layer ORDER BY slot NULLS LAST) ELSE row_number() OVER (PARTITION BY lot, layer ORDER BY time, unit_id) END AS event_position FROM (SELECT *, CASE WHEN unit_id % 6 <> 0 THEN entity END AS slot FROM u)""")
def e14(spark, d):
    u = units(spark, d).withColumn("slot", F.when(F.col("unit_id") % 6 != 0, F.col("entity")))
    return W.event_position(u, ["lot", "layer"], "slot", ["time", "unit_id"]).select("unit_id", F.col("event_position").cast("long").alias("event_position"))


@query("E15_run_candidates", f"""WITH r AS ({_RUN}), c AS (SELECT lot, layer, run, count(DISTINCT device) AS n FROM r GROUP BY ALL)
SELECT unit_id, row_number() OVER w AS row_in_run, entity - min(entity) OVER (PARTITION BY r.lot, r.layer, r.run) + 1 AS slot_offset, c.n AS run_units, epoch_us(min(time) OVER (PARTITION BY r.lot, r.layer, r.run)) AS start_us, round((epoch_us(max(time) OVER (PARTITION BY r.lot, r.layer, r.run)) - epoch_us(min(time) OVER (PARTITION BY r.lot, r.layer, r.run))) / 60000000.0, 6) AS run_minutes
FROM r JOIN c ON r.lot = c.lot AND r.layer = c.layer AND r.run = c.run WINDOW w AS (PARTITION BY r.lot, r.layer, r.run ORDER BY time, unit_id)""")
def e15(spark, d):
    out = W.run_candidates(_runs(spark, d), ["lot", "layer", "run"], ["time", "unit_id"], "entity", "device", "time")
    return out.select("unit_id", F.col("row_in_run").cast("long").alias("row_in_run"), "slot_offset", F.col("run_units").cast("long").alias("run_units"), us("run_start").alias("start_us"), F.round("run_minutes", 6).alias("run_minutes"))


@query("E16_ffill", "SELECT unit_id, last_value(density_b IGNORE NULLS) OVER (PARTITION BY entity ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS density_b FROM u")
def e16(spark, d):
    return W.ffill(units(spark, d), ["entity"], ["time"], ["density_b"]).select("unit_id", "density_b")


@query("E17_moving_average", "SELECT unit_id, round(avg(density_a) OVER (PARTITION BY entity ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS ma3, round(avg(density_a) OVER (PARTITION BY entity ORDER BY time ROWS BETWEEN 8 PRECEDING AND CURRENT ROW), 6) AS ma9 FROM u")
def e17(spark, d):
    return W.moving_average(units(spark, d), ["entity"], ["time"], "density_a", [3, 9]).select("unit_id", F.round("ma3", 6).alias("ma3"), F.round("ma9", 6).alias("ma9"))


@query("E18_prior_lot", """WITH s AS (SELECT entity, unit_id // 7 AS l, min(time) AS t0, arg_min(layer, time) AS layer FROM u GROUP BY 1, 2),
w AS (SELECT entity, l, t0, lag(l) OVER x AS pl, lag(layer) OVER x AS pr, (epoch_us(t0) - epoch_us(lag(t0) OVER x)) / 3600000000.0 AS h FROM s WINDOW x AS (PARTITION BY entity ORDER BY t0, l))
SELECT entity, l AS batch, CASE WHEN h <= 48 THEN pl END AS prior_lot, CASE WHEN h <= 48 THEN pr END AS prior_layer, CASE WHEN h <= 48 THEN round(h, 6) END AS hours_since_prior FROM w""")
def e18(spark, d):
    u = units(spark, d).withColumn("batch", F.expr("unit_id div 7"))
    return W.prior_lot(u, "entity", "time", "batch", ["layer"], 2).select("entity", "batch", "prior_lot", "prior_layer", F.round("hours_since_prior", 6).alias("hours_since_prior"))


@query("E19_entity_utilisation", f"""SELECT unit_id, round(busy, 6) AS busy, n AS n_before, round(100 * busy / 48, 6) AS percent FROM (SELECT v.unit_id, coalesce(sum(h.density_a / 10), 0) AS busy, count(h.unit_id) AS n FROM u v LEFT JOIN u h ON h.entity = v.entity AND h.time < v.time AND epoch_us(h.time) >= epoch_us(v.time) - 2 * {DAY} GROUP BY v.unit_id)""")
def e19(spark, d):
    u = units(spark, d).withColumn("hours", F.col("density_a") / 10)
    out = W.utilisation(u, "entity", "time", "hours", 48)
    return out.select("unit_id", F.round("busy", 6).alias("busy"), "n_before", F.round("percent", 6).alias("percent"))


@query("F1_order_multi", "SELECT unit_id, row_number() OVER (PARTITION BY device ORDER BY layer, density_b DESC NULLS LAST, unit_id) AS place FROM u")
def f1(spark, d):
    order = O.mixed_order([("layer", True), ("density_b", False), ("unit_id", True)])
    return D.ranked(units(spark, d), ["device"], order, 10**9).select("unit_id", F.col("rank").cast("long").alias("place"))


@query("F2_top_n", "SELECT scope, unit_id FROM (SELECT 'overall' AS scope, unit_id, row_number() OVER (ORDER BY density_a DESC, unit_id) AS r FROM u UNION ALL SELECT layer, unit_id, row_number() OVER (PARTITION BY layer ORDER BY density_a DESC, unit_id) FROM u) WHERE r <= 10")
def f2(spark, d):
    return O.top_n(units(spark, d), "layer", [F.desc("density_a"), F.asc("unit_id")], 10).select("scope", "unit_id")


@query("F3_round_robin_sample", """WITH m AS (SELECT entity, max(time) AS t FROM u GROUP BY entity ORDER BY t DESC, entity LIMIT 6), e AS (SELECT entity, row_number() OVER (ORDER BY t DESC, entity) AS er FROM m)
SELECT unit_id, entity FROM (SELECT unit_id, u.entity, er, row_number() OVER (PARTITION BY u.entity ORDER BY time DESC, unit_id) AS rn FROM u JOIN e ON u.entity = e.entity) ORDER BY rn, er LIMIT 40""")
def f3(spark, d):
    return O.round_robin(units(spark, d), "entity", "time", 6, 40, ["unit_id"]).select("unit_id", "entity")


@query("F4_latest_per_entity", "SELECT entity, epoch_us(max(time)) AS last_us FROM u GROUP BY entity ORDER BY max(time) DESC, entity LIMIT 8")
def f4(spark, d):
    return O.latest_active(units(spark, d), "entity", "time", 8).select("entity", us("last_time").alias("last_us"))
