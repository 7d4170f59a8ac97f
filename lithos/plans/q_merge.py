"""Queries of merges and deduplication (G), and of overlays (C15, C16, C28)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.operators import merge as G
from lithos.operators.aggregate import fixed_periods, period_benchmark
from lithos.plans.base import query, units, us, usage


@query("G1_union_distinct", "SELECT lot, part, entity, slot FROM g WHERE lot % 3 = 0 UNION SELECT lot, part, entity, slot FROM g WHERE lot % 2 = 0")
def g1(spark, d):
    g = usage(spark, d).select("lot", "part", "entity", "slot")
    return G.union_distinct([g.where("lot % 3 = 0"), g.where("lot % 2 = 0")])


@query("G2_dedup_keep_last", """SELECT lot, slot, src, price FROM (SELECT *, row_number() OVER (PARTITION BY lot, slot ORDER BY src DESC, price DESC, part DESC, entity DESC) AS n FROM (SELECT *, lot % 2 AS src FROM g UNION ALL SELECT *, 2 FROM g WHERE recipe = 'R')) WHERE n = 1""")
def g2(spark, d):
    g = usage(spark, d).withColumn("src", F.col("lot") % 2)
    tie = [F.col("price"), F.col("part"), F.col("entity")]
    return G.keep_last([g.where("src = 0"), g.where("src = 1"), g.where("recipe = 'R'").withColumn("src", F.lit(2).cast("long"))], ["lot", "slot"], tie).select("lot", "slot", "src", "price")


@query("G3_overlap_replace", """SELECT unit_id, v FROM (SELECT unit_id, density_a AS v FROM u WHERE layer = 'view' AND time < TIMESTAMP '2024-01-10' AND NOT (unit_id % 2 = 0 AND time >= TIMESTAMP '2024-01-08') UNION ALL SELECT unit_id, density_a + 1 FROM u WHERE layer = 'view' AND time >= TIMESTAMP '2024-01-08' AND unit_id % 2 = 0)""")
def g3(spark, d):
    u = units(spark, d).where("layer = 'view'").select("unit_id", "time", F.col("density_a").alias("v"))
    new = u.where("time >= '2024-01-08' AND unit_id % 2 = 0").withColumn("v", F.col("v") + 1)
    once = G.overlap_replace(u, new, ["unit_id"], "time", "2024-01-10", [F.col("v")])
    return G.overlap_replace(once, new, ["unit_id"], "time", "2024-01-10", [F.col("v")]).unionByName(new).distinct().select("unit_id", "v")


@query("G4_extend_history", "SELECT unit_id, CASE WHEN time >= TIMESTAMP '2024-01-12' THEN density_a ELSE -1 END AS v FROM u WHERE layer = 'view' AND time >= TIMESTAMP '2024-01-05'")
def g4(spark, d):
    u = units(spark, d).where("layer = 'view'").select("unit_id", "time", F.col("density_a").alias("v"))
    pulled = u.withColumn("v", F.lit(-1.0))
    return G.extend_history(u.where("time >= '2024-01-12'"), pulled, ["unit_id"], "time", "2024-01-05", "2024-01-12", [F.col("v")]).select("unit_id", "v")


@query("G5_overlap_cutoff", "SELECT 'some' AS kind, epoch_us(max(time)) - 259200000000 AS cutoff_us FROM u UNION ALL SELECT 'none', epoch_us(TIMESTAMP '2024-02-01') - 2592000000000")
def g5(spark, d):
    u = units(spark, d)
    some = G.overlap_cutoff(u, "time", 3, "2024-02-01", 30).withColumn("kind", F.lit("some"))
    return some.unionByName(G.overlap_cutoff(u.where("layer = 'no such'"), "time", 3, "2024-02-01", 30).withColumn("kind", F.lit("none"))).select("kind", us("cutoff").alias("cutoff_us"))


@query("G6_benchmark_extend", """WITH b AS (SELECT (SELECT CAST(min(time) AS DATE) FROM u) AS d0), s AS (SELECT *, CAST(date_diff('day', d0, CAST(time AS DATE)) // 7 AS INT) AS period FROM u, b),
lim AS (SELECT CAST(max(time) AS DATE) AS dl FROM u), q AS (SELECT layer, period, count(*) AS n FROM s GROUP BY ALL)
SELECT layer, period, n AS sample_size FROM q, b, lim WHERE least(d0 + (period * 7 + 6), dl) - (d0 + period * 7) + 1 >= 7""")
def g6(spark, d):
    u = units(spark, d)
    first = fixed_periods(u, "time", 7)
    old = period_benchmark(fixed_periods(first.where("period < 2").drop("period", "period_start", "period_end"), "time", 7), ["layer"], "time", measures={"a": "density_a"}, zero=1)
    new = period_benchmark(first, ["layer"], "time", measures={"a": "density_a"}, zero=1)
    out = G.benchmark_extend(old, new, ["layer", "period_start"], "period_start", "period_end", 7, [F.col("sample_size")])
    return out.select("layer", "period", "sample_size")


@query("G7_manifest_merge", "SELECT unit_id, CASE WHEN unit_id % 3 = 0 THEN 'old' WHEN unit_id % 2 = 0 THEN 'new' END AS path FROM u")
def g7(spark, d):
    u = units(spark, d).select("unit_id")
    old = u.withColumn("path", F.when(F.col("unit_id") % 3 == 0, "old"))
    new = u.withColumn("path", F.when((F.col("unit_id") % 2 == 0) & (F.col("unit_id") % 3 != 0), "new"))
    return G.manifest_merge([old, new], ["unit_id"], "path", [F.col("path")])


@query("G8_usable_event_intersection", "SELECT entity FROM u WHERE layer = 'view' INTERSECT SELECT entity FROM u WHERE layer = 'error' AND density_a > 20 INTERSECT SELECT entity FROM u WHERE layer = 'click' AND density_a > 10")
def g8(spark, d):
    u = units(spark, d)
    return G.usable_in_all([u.where("layer = 'view'"), u.where("layer = 'error' AND density_a > 20"), u.where("layer = 'click' AND density_a > 10")], "entity")


@query("G9_distinct_keys", "SELECT layer, entity, min(unit_id) AS unit_id FROM u GROUP BY layer, entity")
def g9(spark, d):
    return G.distinct_keys(units(spark, d), ["layer", "entity"], [F.col("unit_id")]).select("layer", "entity", "unit_id")


@query("C15_overlay_update", "SELECT unit_id, CASE WHEN unit_id % 4 = 0 AND unit_id % 8 <> 0 THEN -1 ELSE density_b END AS density_b FROM u")
def c15(spark, d):
    u = units(spark, d)
    stage = u.where("unit_id % 4 = 0").select("unit_id", F.when(F.col("unit_id") % 8 != 0, -1.0).alias("density_b"))
    return G.overlay_update(u, stage.unionByName(stage), ["unit_id"], ["density_b"], [F.col("density_b")]).select("unit_id", "density_b")


@query("C16_sync_columns_by_key", "SELECT unit_id, CASE WHEN unit_id % 5 = 0 THEN 'synced' ELSE layer END AS layer FROM u")
def c16(spark, d):
    u = units(spark, d)
    source = u.where("unit_id % 5 = 0").withColumns({"unit_id": F.concat(F.col("unit_id").cast("string"), F.lit(".0 ")), "layer": F.lit("synced")})
    return G.sync_columns(u.select("unit_id", "layer"), source, ["unit_id"], ["layer"], [F.col("time")])


@query("C28_targeted_update", "SELECT unit_id, CASE WHEN entity = 21 THEN density_a * 2 ELSE density_a END AS density_a, layer FROM u")
def c28(spark, d):
    return G.targeted_update(units(spark, d), F.col("entity") == 21, {"density_a": F.col("density_a") * 2}).select("unit_id", "density_a", "layer")
