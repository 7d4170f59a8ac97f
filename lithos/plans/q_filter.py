"""Queries of projections and filters (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.functions import scalar as S
from lithos.operators import filters as B
from lithos.plans.base import query, table, units, usage

_STATUS = "CASE WHEN density_a < 5 THEN 'BSL' ELSE 'HIGHFLIER' END"


def _with_status(spark, d):
    u = units(spark, d)
    return u.withColumns({"status": S.status2("density_a", 5), "klass": F.when(F.col("unit_id") % 2 == 0, "A").otherwise("B"), "status_b": S.status2("density_b", 5)})


_S = f"SELECT *, {_STATUS} AS status, CASE WHEN unit_id % 2 = 0 THEN 'A' ELSE 'B' END AS klass, CASE WHEN density_b < 5 THEN 'BSL' ELSE 'HIGHFLIER' END AS status_b FROM u"


@query("B1_coalesce_prefix", "SELECT unit_id, density_b AS special, coalesce(CASE WHEN unit_id % 2 = 0 THEN density_a END, CAST(entity AS DOUBLE)) AS general FROM u")
def b1(spark, d):
    u = units(spark, d).select("unit_id", F.when(F.col("unit_id") % 2 == 0, F.col("density_a")).alias("M@1"), F.col("density_b").alias("M@X@2"), F.col("entity").cast("double").alias("M@3"))
    return B.coalesce_prefix(u, {"M@X": "special", "M@": "general"})


@query("B2_flag_any_prefix", "SELECT unit_id, CAST((unit_id % 4 <> 0 AND unit_id % 2 <> 0) OR unit_id % 5 = 0 AS INT) AS flag FROM u")
def b2(spark, d):
    u = units(spark, d).select("unit_id", F.when(F.col("unit_id") % 4 != 0, (F.col("unit_id") % 2).cast("string")).alias("FLAG@1"), F.when(F.col("unit_id") % 5 == 0, "yes").otherwise(" ").alias("FLAG@2"))
    return u.select("unit_id", B.flag_any_prefix(u, ["FLAG@"]).alias("flag"))


@query("B3_rename_keep", "SELECT unit_id AS id, layer AS stage, substr(layer, 1, 2) AS route FROM u")
def b3(spark, d):
    return B.rename_keep(units(spark, d), drop_token="density", names={"unit_id": "id", "layer": "stage"}, keep=["id", "stage", "route", "absent"], route_from="stage")


@query("B4_date_range_filter", "SELECT unit_id FROM u WHERE time BETWEEN TIMESTAMP '2024-01-06' AND TIMESTAMP '2024-01-09'")
def b4(spark, d):
    return B.date_range(units(spark, d), "time", "2024-01-06", "2024-01-09").select("unit_id")


@query("B5_class_filter", "SELECT unit_id FROM u WHERE layer IN ('view', 'error') AND device IN ('D1', 'D2')")
def b5(spark, d):
    return B.keep_values(units(spark, d), {"layer": ["view", "error"], "device": ["D1", "D2"], "lot": None}).select("unit_id")


@query("B6_recent_from_output", "SELECT unit_id FROM u WHERE time >= (SELECT max(time) FROM u WHERE layer = 'view' AND time < TIMESTAMP '2024-01-15') - INTERVAL 3 DAY")
def b6(spark, d):
    u = units(spark, d)
    return B.recent_from_output(u, u.where("layer = 'view' AND time < '2024-01-15'"), "time", 3).select("unit_id")


@query("B7_month_lookback", """WITH m AS (SELECT o_orderkey, year(o_orderdate) * 12 + month(o_orderdate) AS i FROM orders WHERE year(o_orderdate) >= 2000)
SELECT o_orderkey FROM m WHERE i >= (SELECT max(i) FROM m) - 2""")
def b7(spark, d):
    o = table(spark, d, "orders").where("year(o_orderdate) >= 2000").withColumn("code", F.when(F.col("o_orderdate").isNotNull(), S.yymm("o_orderdate")))
    return B.month_lookback(o, "code", 3.7).select("o_orderkey")


@query("B8_status_filter", f"""WITH s AS ({_S})
SELECT 'all' AS mode, unit_id FROM s UNION ALL SELECT 'hide_high', unit_id FROM s WHERE status <> 'HIGHFLIER' UNION ALL SELECT 'hide_baseline', unit_id FROM s WHERE status <> 'BSL'
UNION ALL SELECT 'hide_high_A', unit_id FROM s WHERE NOT (klass = 'A' AND status = 'HIGHFLIER') UNION ALL SELECT 'hide_baseline_B', unit_id FROM s WHERE status_b <> 'BSL'""")
def b8(spark, d):
    s = _with_status(spark, d)
    modes = [("all", "all", None), ("hide_high", "hide_high", None), ("hide_baseline", "hide_baseline", None), ("hide_high_A", "hide_high", "A"), ("hide_baseline_B", "hide_baseline", "B")]
    parts = [s.where(B.status_predicate(m, "status", "klass", {"B": "status_b"}, c)).select(F.lit(n).alias("mode"), "unit_id") for n, m, c in modes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("B9_focus_filter", f"WITH s AS ({_S}) SELECT unit_id, CASE WHEN entity IN (8, 21, 34) THEN CAST(entity AS VARCHAR) ELSE 'FLEET' END AS focus FROM s WHERE NOT (status = 'HIGHFLIER' AND entity NOT IN (8, 21, 34))")
def b9(spark, d):
    return B.focus_filter(_with_status(spark, d), "hide_high_outside", "entity", [8, 21, 34], "status").select("unit_id", "focus")


@query("B10_scope_high_filter", f"WITH s AS ({_S}) SELECT unit_id FROM s WHERE NOT (status = 'HIGHFLIER' AND entity % 3 = 0)")
def b10(spark, d):
    return B.scope_high_filter(_with_status(spark, d).withColumn("n", F.col("entity") % 3), "hide_empty_high", "status", "n").select("unit_id")


@query("B11_event_mode_filter", "SELECT unit_id, CAST(CASE layer WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS INT) AS event_order FROM u WHERE layer IN ('view', 'click', 'purchase')")
def b11(spark, d):
    return B.event_mode(units(spark, d), "both", "layer", {"one": ["view", "click"], "two": ["purchase"]}, ["purchase", "view"]).select("unit_id", "event_order")


@query("B12_class_subsets", f"WITH s AS ({_S}) SELECT 'all' AS subset, count(*) AS n FROM s WHERE status = 'BSL' UNION ALL SELECT klass, count(*) FROM s WHERE status = 'BSL' GROUP BY klass")
def b12(spark, d):
    parts = [f.agg(F.lit(k).alias("subset"), F.count("*").alias("n")) for k, f in B.class_subsets(_with_status(spark, d), F.col("status") == "BSL", "klass", ["A", "B"]).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("B13_reorder_columns", "SELECT layer, device, unit_id, entity FROM u")
def b13(spark, d):
    return B.reorder_columns(units(spark, d).select("unit_id", "entity", "layer", "device"), ["layer", "nothing", "device"])


@query("B14_add_default_columns", "SELECT unit_id, 'none' AS note, NULL::VARCHAR AS remark FROM u")
def b14(spark, d):
    return B.add_defaults(units(spark, d).select("unit_id"), {"note": "none", "unit_id": 0}).withColumn("remark", F.lit(None).cast("string"))


@query("B15_numeric_text_filter", "SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS number FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 5 <> 0")
def b15(spark, d):
    p = table(spark, d, "part").withColumns({"v": F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.concat(F.lit(" "), F.split_part("p_brand", F.lit("#"), F.lit(2)))), "gone": F.when(F.col("p_partkey") % 5 == 0, "D").when(F.col("p_partkey") % 5 == 1, "N")})
    return B.numeric_text(p, "v", "gone").select("p_partkey", "number")


@query("B17_image_count_split", "SELECT lot, part, entity, slot, price, CASE WHEN slot = 3 THEN 'exact' ELSE 'above' END AS side FROM g WHERE slot >= 3")
def b17(spark, d):
    exact, above = B.image_count_split(usage(spark, d).select("lot", "part", "entity", "slot", "price"), "slot", 3)
    return exact.withColumn("side", F.lit("exact")).unionByName(above.withColumn("side", F.lit("above")))


@query("B18_entity_before", "SELECT unit_id FROM u WHERE entity = 21 AND time <= TIMESTAMP '2024-01-12'")
def b18(spark, d):
    return B.entity_before(units(spark, d), "entity", 21, "time", "2024-01-12").select("unit_id")
