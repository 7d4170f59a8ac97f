"""Queries of joins (C8-C30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.operators import filters as B
from lithos.operators import joins as C
from lithos.operators.nearest import nearest_pairs
from lithos.plans.base import points, query, table, units, usage

DAY = 86_400_000_000


@query("C8_match_with_fallback", """WITH l AS (SELECT unit_id, entity, time, CASE WHEN unit_id % 2 = 0 THEN 'error' ELSE 'none' END AS expected FROM u WHERE layer = 'view'), e AS (SELECT unit_id AS ev, entity, time AS et, layer AS r1, device AS r2 FROM u WHERE layer IN ('error', 'click')),
j AS (SELECT l.unit_id, l.time, ev, et, r1 = expected OR r2 = expected AS ex FROM l JOIN e USING (entity)), k AS (SELECT *, max(ex) OVER (PARTITION BY unit_id) AS anyx FROM j),
b AS (SELECT unit_id, ev, CAST(NOT anyx AS INT) AS fb FROM k WHERE (ex OR NOT anyx) AND et <= time QUALIFY row_number() OVER (PARTITION BY unit_id ORDER BY et DESC, ev) = 1)
SELECT l.unit_id, ev, fb AS recipe_fallback FROM l LEFT JOIN b USING (unit_id)""")
def c8(spark, d):
    u = units(spark, d)
    left = u.where("layer = 'view'").select("unit_id", "entity", "time", F.when(F.col("unit_id") % 2 == 0, "error").otherwise("none").alias("expected"))
    events = u.where("layer IN ('error', 'click')").select(F.col("unit_id").alias("ev"), "entity", F.col("time").alias("et"), F.col("layer").alias("r1"), F.col("device").alias("r2"))
    return C.match_with_fallback(left, events, ["entity"], ["unit_id"], "time", "et", "expected", ["r1", "r2"], ["ev"], ["ev"]).select("unit_id", "ev", "recipe_fallback")


@query("C9_nearest_session_match", "SELECT a.unit_id, b.unit_id AS other FROM u a JOIN u b ON a.lot = b.lot AND a.device = b.device WHERE a.layer = 'view' AND b.layer = 'error' AND abs(epoch_us(a.time) - epoch_us(b.time)) <= 600000000")
def c9(spark, d):
    u = units(spark, d)
    left = u.where("layer = 'view'").select("unit_id", "lot", "device", "time")
    right = u.where("layer = 'error'").select(F.col("unit_id").alias("other"), "lot", "device", F.col("time").alias("other_time"))
    return C.session_match(left, right, ["lot", "device"], "time", "other_time", 600).select("unit_id", "other")


@query("C10_pair_semi_join", "SELECT lot, slot, part, price FROM g WHERE (lot, slot) IN (SELECT lot, slot FROM g WHERE recipe = 'R' AND qty > 45)")
def c10(spark, d):
    g = usage(spark, d)
    return C.pair_semi(g, g.where("recipe = 'R' AND qty > 45"), ["lot", "slot"]).select("lot", "slot", "part", "price")


@query("C11_points_enriched", """SELECT lot, part, slot, price, p_brand, s_name, round((qty - o_totalprice / 10000) / 25.4, 6) AS qty_rel FROM orders JOIN g ON o_orderkey = lot AND slot = 1 LEFT JOIN part ON part = p_partkey AND p_size < 25 LEFT JOIN supplier ON entity = s_suppkey AND s_acctbal > 0""")
def c11(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("lot"), (F.col("o_totalprice") / 10000).alias("cx"), F.lit(0.0).alias("cy"))
    parts = table(spark, d, "part").where("p_size < 25").select(F.col("p_partkey").alias("part"), "p_brand")
    sup = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("entity"), "s_name")
    out = C.points_enriched(o, usage(spark, d), ["lot"], "slot", parts, "part", sup, "entity", ("cx", "cy"), ("qty", "price"), 25.4)
    return out.select("lot", "part", "slot", "price", "p_brand", "s_name", F.round("qty_rel", 6).alias("qty_rel"))


@query("C12_usage_log_join", """SELECT lot, part, entity, price, n_name, p_brand, o_orderstatus FROM g JOIN orders ON lot = o_orderkey JOIN part ON part = p_partkey JOIN supplier ON entity = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE state = 'F' AND p_name LIKE 'red%' AND n_name NOT IN ('NATION_1', 'NATION_2')""")
def c12(spark, d):
    dims = [
        (table(spark, d, "orders"), F.col("lot") == F.col("o_orderkey")), (table(spark, d, "part"), F.col("part") == F.col("p_partkey")), (table(spark, d, "supplier"), F.col("entity") == F.col("s_suppkey")),
        (table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")), (table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")),
    ]
    keep = (F.col("state") == "F") & F.col("p_name").like("red%") & ~F.col("n_name").isin("NATION_1", "NATION_2")
    return C.usage_star(usage(spark, d), dims, keep).select("lot", "part", "entity", "price", "n_name", "p_brand", "o_orderstatus")


@query("C13_context_left_join", "SELECT o_orderkey, part, price FROM orders LEFT JOIN (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY lot ORDER BY slot, price, part, entity) = 1) ON o_orderkey = lot")
def c13(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("lot"))
    return C.context_join(o, usage(spark, d), ["lot"], [F.col(c) for c in ("slot", "price", "part", "entity")], ["part", "price"]).select("o_orderkey", "part", "price")


@query("C14_lookup_combine_first", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE c_mktsegment END AS device FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def c14(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("device"))
    return C.combine_first(c, table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("device")), ["c_nationkey"], ["device"]).select("c_custkey", "device")


_PARTS = """SELECT o_custkey AS entity, CASE WHEN o_orderkey % 3 = 0 THEN 'K' WHEN o_orderkey % 3 = 1 THEN 'P1' ELSE 'P2' END AS part, o_orderdate AS i, o_orderdate + to_days(CAST(30 + o_orderkey % 400 AS INT)) AS r, o_orderkey % 7 = 0 AS c,
CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS v, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 100 AS INT) END AS k, o_orderkey FROM orders"""


@query("C17_interval_join_status", f"""WITH w AS (SELECT c_custkey AS entity, TIMESTAMP '1998-03-04' + to_days(CAST(c_custkey % 500 AS INT)) AS t FROM customer), q AS ({_PARTS}),
j AS (SELECT w.entity, part, v, k, i, o_orderkey FROM w JOIN q ON w.entity = q.entity AND t > i AND (c OR t < r)),
s AS (SELECT entity, part, CASE WHEN part = 'K' THEN coalesce(CAST(arg_max_null(k, struct_pack(i := i, o := o_orderkey)) AS VARCHAR), 'MISSING') WHEN count(*) = 1 THEN coalesce(first(v), 'MISSING') WHEN bool_or(v = 'TRUE') THEN 'True' WHEN bool_or(v IS NULL) THEN 'MISSING' ELSE 'False' END AS status FROM j GROUP BY entity, part)
SELECT w.entity, coalesce(max(status) FILTER (part = 'P1'), 'NOTFOUND') AS "P1", coalesce(max(status) FILTER (part = 'P2'), 'NOTFOUND') AS "P2", coalesce(max(status) FILTER (part = 'K'), 'NOTFOUND') AS "K", coalesce(bool_or(upper(status) = 'TRUE') FILTER (part <> 'K'), false) AS recoat FROM w LEFT JOIN s USING (entity) GROUP BY w.entity""")
def c17(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("entity"), F.expr("timestamp '1998-03-04' + make_dt_interval(cast(c_custkey % 500 as int))").alias("t"))
    key = F.col("o_orderkey")
    parts = table(spark, d, "orders").select(
        F.col("o_custkey").alias("entity"), F.when(key % 3 == 0, "K").when(key % 3 == 1, "P1").otherwise("P2").alias("part"), key.alias("order"), F.col("o_orderdate").alias("i"),
        F.expr("o_orderdate + make_dt_interval(cast(30 + o_orderkey % 400 as int))").alias("r"), (key % 7 == 0).alias("c"), F.when(key % 5 != 0, F.when(key % 2 == 0, "TRUE").otherwise("FALSE")).alias("v"), F.when(key % 4 != 0, (key % 100).cast("int")).alias("k"),
    )
    return C.interval_status(c, "entity", "entity", "t", parts, "part", "i", "r", "c", "v", ["P1", "P2", "K"], counted="K", count="k", tie=["order"]).select("entity", "P1", "P2", "K", "recoat")


@query("C18_rollout_flags", """WITH r AS (SELECT user_id AS entity, min(ts) AS a, max(ts) AS b FROM events WHERE user_id % 3 <> 0 GROUP BY user_id)
SELECT unit_id, CASE WHEN a < time THEN 'ON' ELSE 'OFF' END AS a_flag, CASE WHEN b < time THEN 'ON' ELSE 'OFF' END AS b_flag FROM u LEFT JOIN r USING (entity)""")
def c18(spark, d):
    u = units(spark, d)
    rollouts = u.where("entity % 3 <> 0").groupBy("entity").agg(F.min("time").alias("a"), F.max("time").alias("b"))
    return C.rollout_flags(u, rollouts, "entity", "time", ["a", "b"], [F.col("a")]).select("unit_id", "a_flag", "b_flag")


_LINK = "SELECT lot, layer, max(unit_id) AS linked_row FROM u WHERE unit_id % 3 = 0 GROUP BY lot, layer"


@query("C19_row_link", f"SELECT unit_id, linked_row FROM u LEFT JOIN ({_LINK}) USING (lot, layer)")
def c19(spark, d):
    u = units(spark, d)
    return C.row_link(u, u.where("unit_id % 3 = 0"), ["lot", "layer"], "unit_id").select("unit_id", "linked_row")


@query("C20_linked_selection", f"SELECT unit_id, linked_row FROM u JOIN ({_LINK}) USING (lot, layer) WHERE linked_row IN (SELECT unit_id FROM u WHERE density_a > 15)")
def c20(spark, d):
    u = units(spark, d)
    linked = C.row_link(u, u.where("unit_id % 3 = 0"), ["lot", "layer"], "unit_id")
    return C.linked_selection(linked, u.where("density_a > 15"), "unit_id").select("unit_id", "linked_row")


@query("C21_copy_missing_group_col", f"SELECT a.unit_id, b.device AS grp FROM u a LEFT JOIN ({_LINK}) l USING (lot, layer) LEFT JOIN u b ON b.unit_id = linked_row")
def c21(spark, d):
    u = units(spark, d)
    linked = C.row_link(u.select("unit_id", "lot", "layer"), u.where("unit_id % 3 = 0"), ["lot", "layer"], "unit_id")
    return C.context_join(linked, u.select(F.col("unit_id").alias("linked_row"), F.col("device").alias("grp")), ["linked_row"], [F.col("grp")], ["grp"]).select("unit_id", "grp")


@query("C22_window_pairs", f"SELECT a.unit_id, h.unit_id AS earlier FROM u a JOIN u h ON a.entity = h.entity AND h.time < a.time AND epoch_us(a.time) - epoch_us(h.time) <= 2 * {DAY} WHERE a.layer = 'view' AND h.layer = 'error'")
def c22(spark, d):
    u = units(spark, d)
    return C.window_pairs(u.where("layer = 'view'").select("unit_id", "entity", "time"), u.where("layer = 'error'").select(F.col("unit_id").alias("earlier"), "entity", F.col("time").alias("ht")), ["entity"], "time", "ht", 2).select("unit_id", "earlier")


@query("C23_fullouter_summaries", "SELECT entity, a, b FROM (SELECT entity, count(*) AS a FROM u WHERE layer = 'view' AND density_a > 20 GROUP BY entity) FULL JOIN (SELECT entity, count(*) AS b FROM u WHERE layer = 'error' AND density_a > 20 GROUP BY entity) USING (entity)")
def c23(spark, d):
    u = units(spark, d).where("density_a > 20")
    return C.fullouter(u.where("layer = 'view'").groupBy("entity").agg(F.count("*").alias("a")), u.where("layer = 'error'").groupBy("entity").agg(F.count("*").alias("b")), ["entity"])


@query("C24_anti_join", "SELECT entity, CAST(i AS INT) AS image FROM (SELECT DISTINCT entity FROM u), (SELECT unnest([1, 2, 3]) AS i) WHERE (entity, i) NOT IN (SELECT entity, CAST(unit_id % 60 AS INT) FROM u)")
def c24(spark, d):
    u = units(spark, d)
    return C.missing_required(u, u.withColumn("image", (F.col("unit_id") % 60).cast("int")), ["entity"], "image", [1, 2, 3])


_NEAR = "SELECT b.grp, b.point_id, min(struct_pack(d := sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2), i := a.point_id)) AS m FROM p b JOIN p a ON a.grp = b.grp AND a.class = 'A' WHERE b.class = 'B' GROUP BY b.grp, b.point_id"


@query("C25_self_nearest_pairs", f"SELECT grp, point_id, round(m.d, 6) AS distance, m.i AS near_id FROM ({_NEAR})")
def c25(spark, d):
    return nearest_pairs(points(spark, d), ["grp"], "class", "B", "A", "point_id", "x", "y").withColumn("distance", F.round("distance", 6))


@query("C27_pad_missing_groups", "SELECT layer, unit_id FROM (SELECT unnest(['view', 'purchase', 'absent']) AS layer) LEFT JOIN (SELECT layer, unit_id FROM u WHERE density_a > 100 AND layer <> 'purchase') USING (layer)")
def c27(spark, d):
    listed = spark.createDataFrame([("view",), ("purchase",), ("absent",)], "layer string")
    return C.pad_missing(listed, units(spark, d).where("density_a > 100 AND layer <> 'purchase'").select("layer", "unit_id"), "layer")


@query("C29_covered_summary", "SELECT unit_id FROM u WHERE (lot, layer) IN (SELECT lot, layer FROM u WHERE density_a > 120)")
def c29(spark, d):
    u = units(spark, d)
    return C.covered(u, u.where("density_a > 120"), ["lot", "layer"]).select("unit_id")


@query("C30_element_lookup", """SELECT o_orderkey, qty, discount, tax FROM orders LEFT JOIN (SELECT lot, qty, discount, tax FROM g WHERE slot = 1 QUALIFY row_number() OVER (PARTITION BY lot ORDER BY price, part, entity) = 1) ON o_orderkey = lot WHERE o_orderstatus = 'P'""")
def c30(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey"), F.col("o_orderkey").alias("lot"))
    elements = C.pair_semi(usage(spark, d).where("slot = 1"), o, ["lot"])
    return C.context_join(o, elements, ["lot"], [F.col(c) for c in ("price", "part", "entity")], B.columns_like(elements, "qty|discount|tax")).select("o_orderkey", "qty", "discount", "tax")


