"""Queries of as-of joins (C1-C7, E5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.functions import scalar as S
from lithos.operators import asof as A
from lithos.operators.windows import control_class
from lithos.plans.base import query, units

_R = "SELECT entity AS re, time AS rt, density_a AS v, density_b AS w, unit_id AS rid, layer AS kind FROM u WHERE layer IN ('purchase', 'signup', 'error')"


def _sides(spark, d):
    u = units(spark, d)
    return u.where("layer = 'view'").select("unit_id", "entity", "time"), u.where("layer IN ('purchase', 'signup', 'error')").select("entity", F.col("time").alias("rt"), F.col("density_a").alias("v"), F.col("density_b").alias("w"), F.col("layer").alias("kind"))


@query("C1_asof_backward", f"WITH r AS ({_R}) SELECT unit_id, epoch_us(rt) AS right_us, v AS right_v FROM (SELECT * FROM u WHERE layer = 'view') l ASOF LEFT JOIN r ON l.entity = r.re AND l.time >= r.rt")
def c1(spark, d):
    left, right = _sides(spark, d)
    out = A.asof_backward(left, right, ["entity"], "time", "rt", ["v"])
    return out.select("unit_id", F.unix_micros("right_time").alias("right_us"), "right_v")


@query("C2_asof_backward_by_kind", f"""WITH r AS ({_R}), l AS (SELECT * FROM u WHERE layer = 'view'),
a AS (SELECT unit_id, v FROM l ASOF LEFT JOIN (SELECT * FROM r WHERE kind = 'purchase') x ON l.entity = x.re AND l.time >= x.rt),
b AS (SELECT unit_id, v FROM l ASOF LEFT JOIN (SELECT * FROM r WHERE kind = 'error') x ON l.entity = x.re AND l.time >= x.rt)
SELECT a.unit_id, a.v AS purchase, b.v AS error FROM a JOIN b USING (unit_id)""")
def c2(spark, d):
    left, right = _sides(spark, d)
    return A.asof_by_kind(left, right, ["entity"], "time", "rt", "kind", ["purchase", "error"], "v").select("unit_id", "purchase", "error")


@query("C3_asof_elapsed", f"WITH r AS ({_R}) SELECT unit_id, round(h, 6) AS hours_since, CAST(coalesce(h <= 24, false) AS INT) AS within_1d, CAST(coalesce(h <= 168, false) AS INT) AS within_7d FROM (SELECT unit_id, (epoch_us(time) - epoch_us(rt)) / 3600000000.0 AS h FROM (SELECT * FROM u WHERE layer = 'view') l ASOF LEFT JOIN (SELECT * FROM r WHERE kind = 'error') r ON l.entity = r.re AND l.time >= r.rt)")
def c3(spark, d):
    left, right = _sides(spark, d)
    out = A.asof_elapsed(left, right.where("kind = 'error'"), ["entity"], "time", "rt", [1, 7])
    return out.select("unit_id", F.round("hours_since", 6).alias("hours_since"), "within_1d", "within_7d")


@query("C4_asof_multi_value", f"""WITH r AS ({_R}), l AS (SELECT * FROM u WHERE layer = 'view')
SELECT unit_id, v AS right_v, w AS right_w, CASE WHEN v IS NULL THEN NULL WHEN v = 0 THEN 0 WHEN v > 0 AND v <= 4 THEN 1 WHEN v > 0 AND v <= 10 THEN 2 ELSE 3 END AS class_v,
CASE WHEN w IS NULL THEN NULL WHEN w = 0 THEN 0 WHEN w > 0 AND w <= 4 THEN 1 WHEN w > 0 AND w <= 10 THEN 2 ELSE 3 END AS class_w
FROM l ASOF LEFT JOIN r ON l.entity = r.re AND l.time >= r.rt""")
def c4(spark, d):
    left, right = _sides(spark, d)
    out = A.asof_backward(left, right, ["entity"], "time", "rt", ["v", "w"])
    return out.select("unit_id", "right_v", "right_w", control_class("right_v", 10, 4).alias("class_v"), control_class("right_w", 10, 4).alias("class_w"))


_NEAR = """SELECT l.unit_id, r.v, r.rt FROM (SELECT *, min(time) OVER (PARTITION BY entity) AS t0, max(time) OVER (PARTITION BY entity) AS t1 FROM u WHERE layer = 'view') l LEFT JOIN r ON l.entity = r.re {margin}
QUALIFY row_number() OVER (PARTITION BY l.unit_id ORDER BY abs(epoch_us(l.time) - epoch_us(r.rt)), r.rt) = 1"""


@query("C5_asof_nearest", f"WITH r AS ({_R}) SELECT unit_id, v AS near_v, epoch_us(rt) AS near_us FROM ({_NEAR.format(margin='AND r.rt BETWEEN t0 - INTERVAL 2 DAY AND t1 + INTERVAL 2 DAY')})")
def c5(spark, d):
    left, right = _sides(spark, d)
    return A.asof_nearest(left, right, ["entity"], "time", "rt", ["v"], margin_days=2).select("unit_id", "near_v", F.unix_micros("near_time").alias("near_us"))


@query("C6_asof_backward_ffill", f"""WITH r AS ({_R}), l AS (SELECT * FROM u WHERE layer = 'view'),
a AS (SELECT unit_id, v, rt FROM l ASOF LEFT JOIN r ON l.entity = r.re AND l.time >= r.rt),
b AS (SELECT unit_id, w FROM l ASOF LEFT JOIN (SELECT * FROM r WHERE w IS NOT NULL) x ON l.entity = x.re AND l.time >= x.rt)
SELECT a.unit_id, v AS right_v, w AS right_w, epoch_us(rt) AS right_us FROM a JOIN b USING (unit_id)""")
def c6(spark, d):
    left, right = _sides(spark, d)
    return A.asof_ffill(left, right, ["entity"], "time", "rt", ["v", "w"]).select("unit_id", "right_v", "right_w", F.unix_micros("right_time").alias("right_us"))


@query("C7_asof_fallback_chain", f"""WITH r AS ({_R}), l AS (SELECT unit_id, entity, time, unit_id % 2 = 0 AS matched, CASE WHEN unit_id % 4 = 0 THEN density_a END AS w FROM u WHERE layer = 'view'),
f AS (SELECT unit_id, rt FROM l ASOF LEFT JOIN r ON l.entity = r.re AND l.time >= r.rt),
fw AS (SELECT l.unit_id, x.w FROM l ASOF LEFT JOIN (SELECT * FROM r WHERE w IS NOT NULL) x ON l.entity = x.re AND l.time >= x.rt),
n AS (SELECT l.unit_id, r.w FROM l LEFT JOIN r ON l.entity = r.re QUALIFY row_number() OVER (PARTITION BY l.unit_id ORDER BY abs(epoch_us(l.time) - epoch_us(r.rt)), r.rt) = 1),
nw AS (SELECT l.unit_id, CASE WHEN abs(epoch_us(l.time) - epoch_us(r.rt)) <= 86400000000 THEN r.w END AS w FROM l LEFT JOIN (SELECT * FROM r WHERE w IS NOT NULL) r ON l.entity = r.re QUALIFY row_number() OVER (PARTITION BY l.unit_id ORDER BY abs(epoch_us(l.time) - epoch_us(r.rt)), r.rt) = 1),
j AS (SELECT l.unit_id, NOT matched OR l.w IS NULL AS target, CASE WHEN NOT matched OR l.w IS NULL THEN coalesce(fw.w, CASE WHEN f.rt IS NOT NULL THEN coalesce(n.w, nw.w) END) ELSE l.w END AS w, f.rt IS NOT NULL AS has FROM l JOIN f USING (unit_id) JOIN fw USING (unit_id) JOIN n USING (unit_id) JOIN nw USING (unit_id))
SELECT unit_id, w, CASE WHEN NOT target THEN 'EVENT' WHEN has AND w IS NOT NULL THEN 'INSPECTION' ELSE 'UNMATCHED' END AS source, CAST(target AND has AND w IS NOT NULL AS INT) AS fallback FROM j""")
def c7(spark, d):
    left, right = _sides(spark, d)
    left = left.join(units(spark, d).select("unit_id", "density_a"), "unit_id").withColumns({"matched": F.col("unit_id") % 2 == 0, "w": F.when(F.col("unit_id") % 4 == 0, F.col("density_a"))})
    return A.asof_fallback_chain(left, right.select("entity", "rt", "w"), ["entity"], "time", "rt", ["w"], "matched").select("unit_id", "w", "source", "fallback")


@query("E5_days_since_last", "SELECT l.unit_id, round((epoch_us(l.time) - epoch_us(x.time)) / 86400000000.0, 6) AS days FROM (SELECT * FROM u WHERE layer = 'view') l ASOF LEFT JOIN u x ON l.entity = x.entity AND l.time > x.time")
def e5(spark, d):
    u = units(spark, d)
    out = A.asof_backward(u.where("layer = 'view'").select("unit_id", "entity", "time"), u.select("entity", F.col("time").alias("rt")), ["entity"], "time", "rt", [], strict=True)
    return out.select("unit_id", F.round(S.elapsed("right_time", "time", "days"), 6).alias("days"))
