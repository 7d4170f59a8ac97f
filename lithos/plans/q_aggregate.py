"""Queries of aggregations (D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.functions import scalar as S
from lithos.operators import aggregate as D
from lithos.plans.base import query, table, units, us, usage


def _r(*names):
    return {n: F.round(n, 6) for n in names}


_P = "SELECT *, CAST(date_diff('day', (SELECT CAST(min(time) AS DATE) FROM u), CAST(time AS DATE)) // 7 AS INT) AS period FROM u"
_Z = "(density_a IS NULL OR density_a >= 1)"
_ZB = "(density_b IS NULL OR density_b >= 1)"
_GP = "SELECT *, CAST(date_diff('day', (SELECT CAST(min(time) AS DATE) FROM g), CAST(time AS DATE)) // 90 AS INT) AS period FROM g"
MEASURES = {"a": "density_a", "b": "density_b"}


def _floored(spark, d):
    """Units with whole densities, so that some are zero: those under 1, as no given value is negative."""
    return units(spark, d).withColumns({c: F.floor(c) for c in MEASURES.values()})


@query("D1_fixed_periods", """SELECT unit_id, CAST(p AS INT) AS period, CAST(d0 + CAST(p * 7 AS INT) AS VARCHAR) AS period_start, CAST(least(d0 + CAST(p * 7 + 6 AS INT), d1) AS VARCHAR) AS period_end
FROM (SELECT unit_id, d0, d1, date_diff('day', d0, CAST(time AS DATE)) // 7 AS p FROM u, (SELECT CAST(min(time) AS DATE) AS d0, CAST(max(time) AS DATE) AS d1 FROM u))""")
def d1(spark, d):
    return D.fixed_periods(units(spark, d), "time", 7).select("unit_id", "period", F.col("period_start").cast("string").alias("period_start"), F.col("period_end").cast("string").alias("period_end"))


@query("D2_period_benchmark", f"""SELECT device, layer, period, count(*) AS sample_size, epoch_us(min(time)) AS first_us, epoch_us(max(time)) AS last_us, count(*) FILTER ({_Z}) AS defective_a, round(avg(CAST({_Z} AS INT)), 6) AS rate_a,
round(avg(CAST(flag = 'ON' AS INT)), 6) AS flag_on_rate, round(avg(entity) FILTER (NOT {_Z}), 6) AS entity_clean_mean, count(entity) FILTER (NOT {_Z}) AS entity_clean_count, round(avg(entity) FILTER ({_Z}), 6) AS entity_defective_mean
FROM (SELECT *, CASE WHEN unit_id % 3 = 0 THEN 'ON' ELSE 'OFF' END AS flag FROM ({_P})) GROUP BY device, layer, period HAVING count(*) >= 40""")
def d2(spark, d):
    u = D.fixed_periods(_floored(spark, d), "time", 7).withColumn("flag", F.when(F.col("unit_id") % 3 == 0, "ON").otherwise("OFF"))
    out = D.period_benchmark(u, ["device", "layer"], "time", measures=MEASURES, zero=0, flags=["flag"], numeric=["entity"], least=40)
    return out.select("device", "layer", "period", "sample_size", us("first_time").alias("first_us"), us("last_time").alias("last_us"), "defective_a", "rate_a", "flag_on_rate", "entity_clean_mean", "entity_clean_count", "entity_defective_mean").withColumns(_r("rate_a", "flag_on_rate", "entity_clean_mean", "entity_defective_mean"))


@query("D3_fleet_baseline", f"SELECT period, layer, count(*) AS fleet_units, round(avg(CAST({_Z} AS INT)), 6) AS fleet_rate_a, round(avg(CAST({_ZB} AS INT)), 6) AS fleet_rate_b FROM ({_P}) GROUP BY period, layer")
def d3(spark, d):
    return D.fleet_baseline(D.fixed_periods(_floored(spark, d), "time", 7), "layer", MEASURES, 0).withColumns(_r("fleet_rate_a", "fleet_rate_b"))


_USAGE = f"""SELECT period, usage_rows, usage_lots, usage_parents, usage_entities, top_parent, top_parent_rows, parent_mean, parent_std FROM
(SELECT period, count(*) AS usage_rows, count(DISTINCT lot) AS usage_lots, count(DISTINCT parent) AS usage_parents, count(DISTINCT entity) AS usage_entities FROM (SELECT *, entity // 10 AS parent FROM ({_GP})) GROUP BY period)
JOIN (SELECT period, arg_min(parent, -n * 1000000 + parent) AS top_parent, max(n) AS top_parent_rows, avg(n) AS parent_mean, stddev_samp(n) AS parent_std FROM (SELECT period, entity // 10 AS parent, count(*) AS n FROM ({_GP}) GROUP BY ALL) GROUP BY period) USING (period)"""


@query("D4_fleet_usage", f"SELECT * REPLACE (round(parent_mean, 6) AS parent_mean, round(parent_std, 6) AS parent_std) FROM ({_USAGE})")
def d4(spark, d):
    log = D.fixed_periods(usage(spark, d), "time", 90).withColumn("parent", F.expr("entity div 10"))
    return D.fleet_usage(log, "lot", "parent", "entity").withColumns(_r("parent_mean", "parent_std"))


@query("D5_benchmark_measures", f"""WITH r AS (SELECT device, layer, period, count(*) AS n, count(*) FILTER ({_Z}) AS obs, avg(CAST({_Z} AS INT)) AS rate FROM ({_P}) GROUP BY ALL HAVING count(*) >= 20),
f AS (SELECT period, layer, count(*) AS fu, avg(CAST({_Z} AS INT)) AS fr FROM ({_P}) GROUP BY ALL), us AS (SELECT period, count(*) AS ur FROM ({_GP}) GROUP BY ALL)
SELECT device, layer, period, n AS sample_size, round(coalesce(n / nullif(ur, 0), 0), 6) AS usage_share, round(coalesce(fu / nullif(ur, 0), 0), 6) AS sample_rate, round(rate * n / fu, 6) AS weighted_a, round(n * fr, 6) AS expected_a, obs AS observed_a, round(obs - n * fr, 6) AS excess_a
FROM r LEFT JOIN f USING (period, layer) LEFT JOIN us USING (period)""")
def d5(spark, d):
    u = D.fixed_periods(_floored(spark, d), "time", 7)
    log = D.fixed_periods(usage(spark, d), "time", 90).withColumn("parent", F.expr("entity div 10"))
    rows = D.period_benchmark(u, ["device", "layer"], "time", measures={"a": "density_a"}, zero=0, least=20)
    out = D.benchmark_measures(rows, D.fleet_baseline(u, "layer", {"a": "density_a"}, 0), D.fleet_usage(log, "lot", "parent", "entity"), "layer", ["a"])
    return out.select("device", "layer", "period", "sample_size", "usage_share", "sample_rate", "weighted_a", "expected_a", "observed_a", "excess_a").withColumns(_r("usage_share", "sample_rate", "weighted_a", "expected_a", "excess_a"))


@query("D6_baseline_only_means", """SELECT device, count(*) AS n, round(avg(density_a) FILTER (density_a < 5), 6) AS baseline_mean_a, count(*) FILTER (density_a < 5) AS baseline_count_a,
round(avg(density_b) FILTER (density_b < 5), 6) AS baseline_mean_b, count(*) FILTER (density_b < 5) AS baseline_count_b, count(*) FILTER (density_a < 5 OR density_b < 5) AS baseline_any FROM u GROUP BY device""")
def d6(spark, d):
    u = units(spark, d).withColumns({"sa": S.status2("density_a", 5), "sb": S.status2("density_b", 5)})
    return D.baseline_means(u, ["device"], MEASURES, {"a": "sa", "b": "sb"}).withColumns(_r("baseline_mean_a", "baseline_mean_b"))


@query("D7_distinct_lot_mean", "SELECT layer, round(avg(v), 6) AS density_b_lot_mean, count(*) AS lots FROM (SELECT layer, lot, arg_min(density_b, time) FILTER (density_b IS NOT NULL) AS v FROM u GROUP BY ALL) GROUP BY layer")
def d7(spark, d):
    return D.distinct_lot_mean(units(spark, d), ["layer"], "lot", "density_b", ["time"]).withColumns(_r("density_b_lot_mean"))


@query("D8_lot_rollup", "SELECT layer, lot, entity, arg_max(density_a, time) AS density_a, arg_max(density_b, time) FILTER (density_b IS NOT NULL) AS density_b, arg_max(unit_id, time) AS unit_id FROM u GROUP BY layer, lot, entity")
def d8(spark, d):
    return D.lot_rollup(units(spark, d), ["layer", "lot", "entity"], "time", ["density_a", "density_b", "unit_id"], ["unit_id"])


@query("D9_defect_event_agg", """SELECT o_orderkey AS lot, coalesce(n, 0) AS defect_row_count, coalesce(i, 0) AS image_defect_count, coalesce(e, 0) AS element_row_count, coalesce(n, 0) > 0 AS has_defect_rows, coalesce(e, 0) > 0 AS has_elements FROM orders
LEFT JOIN (SELECT lot, count(*) AS n, count(*) FILTER (slot > 3) AS i FROM g GROUP BY lot) a ON o_orderkey = a.lot LEFT JOIN (SELECT lot, count(*) AS e FROM g WHERE round(discount * 100) > 7 GROUP BY lot) b ON o_orderkey = b.lot""")
def d9(spark, d):
    g = usage(spark, d)
    g = g.withColumn("images", F.col("slot") - 3)
    return D.defect_event_agg(table(spark, d, "orders").select(F.col("o_orderkey").alias("lot")), g, g.where("round(discount * 100) > 7"), ["lot"], "images")


@query("D10_run_size", "SELECT lot, entity, count(DISTINCT part) AS n_units_in_run FROM g GROUP BY lot, entity")
def d10(spark, d):
    return D.run_size(usage(spark, d), ["lot", "entity"], "part")


@query("D11_zero_fraction", f"""SELECT CAST((SELECT CAST(min(time) AS DATE) FROM u) + CAST(period * 7 + 6 AS INT) AS VARCHAR) AS end_date, grp, layer, count(*) AS n, count(*) FILTER (NOT {_Z}) AS zeros, round(count(*) FILTER (NOT {_Z}) / count(*), 6) AS fraction
FROM (SELECT *, unnest([device, device || '-' || CASE WHEN entity % 10 IN (1, 3, 5) THEN 'LEFT' WHEN entity % 10 IN (2, 4, 6) THEN 'RIGHT' END]) AS grp FROM ({_P})) WHERE grp IS NOT NULL GROUP BY ALL""")
def d11(spark, d):
    u = _floored(spark, d).withColumn("side", S.side("entity"))
    return D.zero_fraction(u, "time", "density_a", 0, "device", "side", "layer").withColumns(_r("fraction") | {"end_date": F.col("end_date").cast("string")})


@query("D11_zero_fraction_wide", f"""SELECT CAST((SELECT CAST(min(time) AS DATE) FROM u) + CAST(period * 7 + 6 AS INT) AS VARCHAR) AS end_date, layer, round(count(*) FILTER (NOT {_Z} AND device = 'D0') / nullif(count(*) FILTER (device = 'D0'), 0), 6) AS D0, round(count(*) FILTER (NOT {_Z} AND device = 'D1') / nullif(count(*) FILTER (device = 'D1'), 0), 6) AS D1 FROM ({_P}) GROUP BY ALL""")
def d11w(spark, d):
    u = _floored(spark, d).withColumn("side", S.side("entity"))
    return D.zero_fraction(u, "time", "density_a", 0, "device", "side", "layer", wide=["D0", "D1"]).withColumns(_r("D0", "D1") | {"end_date": F.col("end_date").cast("string")})


@query("D12_window_stats", """SELECT coalesce(a.w, b.w) AS "window", n, round(mean, 6) AS mean, round(std, 6) AS std, mn AS min, mx AS max, zeros, non_zeros, other_rows, round_even(non_zeros / n, 4) AS non_zero_share FROM
(SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(time AS DATE)) // 5 AS INT) AS w, count(density_b) AS n, avg(density_b) AS mean, stddev_samp(density_b) AS std, min(density_b) AS mn, max(density_b) AS mx, count(*) FILTER (density_b = 0) AS zeros, count(*) FILTER (density_b <> 0) AS non_zeros FROM u WHERE layer = 'view' GROUP BY 1) a
FULL JOIN (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(time AS DATE)) // 5 AS INT) AS w, count(*) AS other_rows FROM u WHERE layer = 'error' GROUP BY 1) b ON a.w = b.w""")
def d12(spark, d):
    u = units(spark, d)
    return D.window_stats(u.where("layer = 'view'"), u.where("layer = 'error'"), "time", "time", 5, "2024-01-01", "density_b").withColumns(_r("mean", "std"))


@query("D13_run_summary", """SELECT lot, layer, epoch_us(min(time)) AS start_us, epoch_us(max(time)) AS end_us, round((epoch_us(max(time)) - epoch_us(min(time))) / 60000000.0, 6) AS span_minutes, count(*) AS n_rows, count(DISTINCT entity) AS n_units, min(unit_id) AS min_slot, max(unit_id) AS max_slot,
arg_min(device, time) AS first_label, count(*) > count(DISTINCT entity) AS has_duplicates FROM u GROUP BY lot, layer""")
def d13(spark, d):
    out = D.run_summary(units(spark, d), ["lot", "layer"], "time", "entity", "unit_id", "device", ["unit_id"])
    return out.withColumns({"start_us": us("run_start"), "end_us": us("run_end")} | _r("span_minutes")).drop("run_start", "run_end")


@query("D14_same_day_duplicates", """SELECT layer, entity, CAST(CAST(time AS DATE) AS VARCHAR) AS day, count(*) AS n, count(DISTINCT unit_id) AS n_unit_id, round((epoch_us(max(time)) - epoch_us(min(time))) / 60000000.0, 6) AS span_minutes FROM u GROUP BY layer, entity, CAST(time AS DATE) HAVING count(*) > 1""")
def d14(spark, d):
    out = D.same_day_duplicates(units(spark, d), ["layer", "entity"], "time", ["unit_id"])
    return out.select("layer", "entity", F.col("day").cast("string").alias("day"), "n", "n_unit_id", F.round("span_minutes", 6).alias("span_minutes"))


@query("D15_status_summary", "SELECT layer, count(*) AS n, round(median(density_a), 6) AS density_a_median, round(median(density_b), 6) AS density_b_median FROM u GROUP BY layer")
def d15(spark, d):
    return D.status_summary(units(spark, d), "layer", ["density_a", "density_b"]).withColumns(_r("density_a_median", "density_b_median"))


@query("D16_group_describe", "SELECT device, count(density_b) AS n, round(avg(density_b), 6) AS mean, round(stddev_samp(density_b), 6) AS std, round(median(density_b), 6) AS median, min(density_b) AS min, max(density_b) AS max FROM u GROUP BY device")
def d16(spark, d):
    return D.group_describe(units(spark, d), ["device"], "density_b").withColumns(_r("mean", "std", "median"))


@query("D17_value_counts", "SELECT 'layer' AS \"column\", layer AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM u), 6) AS share FROM u GROUP BY layer UNION ALL SELECT 'device', device, count(*), round(count(*) / (SELECT count(*) FROM u), 6) FROM u GROUP BY device")
def d17(spark, d):
    return D.value_counts(units(spark, d), ["layer", "device"]).withColumns(_r("share"))


@query("D18_variability_summary", "SELECT device, layer, count(density_a) AS n, round(avg(density_a), 6) AS mean, round(quantile_cont(density_a, 0.25), 6) AS q1, round(quantile_cont(density_a, 0.5), 6) AS median, round(quantile_cont(density_a, 0.75), 6) AS q3 FROM u GROUP BY ALL")
def d18(spark, d):
    return D.variability_summary(units(spark, d), ["device", "layer"], "density_a").withColumns(_r("mean", "q1", "median", "q3"))


@query("D19_coverage_summary", """SELECT 'density_b' AS "column", count(density_b) AS n_values, count(*) - count(density_b) AS n_nulls, round(100 * count(density_b) / count(*), 6) AS percent, round(avg(density_b), 6) AS mean, max(density_b) AS max FROM u
UNION ALL SELECT 'layer', count(layer), count(*) - count(layer), round(100 * count(layer) / count(*), 6), NULL, NULL FROM u""")
def d19(spark, d):
    return D.coverage_summary(units(spark, d), ["density_b", "layer"], ["density_b"]).withColumns(_r("percent", "mean"))


@query("D20_benchmark_summary", f"WITH r AS (SELECT device, layer, period, avg(CAST({_Z} AS INT)) AS rate_a FROM ({_P}) GROUP BY ALL) SELECT layer, device, CAST(grouping(layer, device) AS BIGINT) AS level, count(*) AS n, round(avg(rate_a), 6) AS rate_a FROM r GROUP BY CUBE (layer, device)")
def d20(spark, d):
    rows = D.period_benchmark(D.fixed_periods(_floored(spark, d), "time", 7), ["device", "layer"], "time", measures={"a": "density_a"}, zero=0)
    return D.benchmark_summary(rows, "layer", "device", ["rate_a"]).withColumns(_r("rate_a"))


@query("D19_top_values", """SELECT "column", rank, value, n FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS rank FROM
(SELECT 'layer' AS "column", layer AS value, count(*) AS n FROM u GROUP BY layer UNION ALL SELECT 'entity', CAST(entity AS VARCHAR), count(*) FROM u GROUP BY entity)) WHERE rank <= 5""")
def d19t(spark, d):
    return D.top_values(units(spark, d), ["layer", "entity"], 5)


@query("D20_top_entities", f"""WITH c AS (SELECT device, layer, period, entity, count(*) AS n FROM ({_P}) GROUP BY ALL), t AS (SELECT entity FROM c QUALIFY row_number() OVER (PARTITION BY device, layer, period ORDER BY n DESC, entity) = 1)
SELECT entity, count(*) AS n_periods FROM t GROUP BY entity ORDER BY n_periods DESC, entity LIMIT 5""")
def d20t(spark, d):
    return D.top_entities(D.fixed_periods(units(spark, d), "time", 7), ["device", "layer", "period"], "entity", 5)


@query("D21_layer_frequency", "SELECT layer, count(*) AS n FROM u GROUP BY layer ORDER BY n DESC, layer LIMIT 3")
def d21(spark, d):
    return D.frequency(units(spark, d), "layer", 3)


@query("D22_recipe_frequency", "SELECT p_brand, count(*) AS n FROM g JOIN part ON part = p_partkey JOIN supplier ON entity = s_suppkey GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 20")
def d22(spark, d):
    joined = usage(spark, d).join(table(spark, d, "part"), F.col("part") == F.col("p_partkey")).join(table(spark, d, "supplier"), F.col("entity") == F.col("s_suppkey"))
    return D.frequency(joined, "p_brand", 20)


@query("D23_counter_pivot", "SELECT entity, CAST(CAST(time AS DATE) AS VARCHAR) AS day, max(density_a) FILTER (layer = 'view') AS \"view\", max(density_a) FILTER (layer = 'error') AS error FROM u GROUP BY 1, 2")
def d23(spark, d):
    u = units(spark, d).withColumn("day", F.to_date("time").cast("string"))
    return D.counter_pivot(u, ["entity", "day"], "layer", "density_a", ["view", "error"])
