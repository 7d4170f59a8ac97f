"""Queries of scans and scalar functions (A, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.functions import scalar as S
from lithos.plans.base import query, table, units, us, usage
from lithos.sources import days, tables


@query("A1_scan_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def a1(spark, d):
    return tables.scan_table(spark, f"{d}/nation.parquet", ["n_nationkey", "n_name", "n_regionkey"]).select("n_nationkey", "n_name", "n_regionkey")


@query("A2_scan_window", "SELECT unit_id, epoch_us(time) AS time_us FROM u WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-12'")
def a2(spark, d):
    return tables.scan_window(units(spark, d), "time", "2024-01-05", "2024-01-12").select("unit_id", us().alias("time_us"))


@query("A3_union_sources", """SELECT unit_id, density_a, NULL::DOUBLE AS density_b FROM u WHERE layer = 'view'
UNION ALL SELECT unit_id, NULL, density_b FROM u WHERE layer = 'click'""")
def a3(spark, d):
    u = units(spark, d)
    return tables.union_sources([u.where("layer = 'view'").select("unit_id", "density_a"), u.where("layer = 'click'").select("unit_id", "density_b")])


@query("A4_fetch_scan_summary", "SELECT unit_id AS key, entity AS tool, density_a AS measure FROM u WHERE entity IN (3, 8, 21, 34) AND layer LIKE '%ew' AND time >= TIMESTAMP '2024-01-03' AND time <= TIMESTAMP '2024-01-25'")
def a4(spark, d):
    return tables.fetch_summary(units(spark, d), {"unit_id": "key", "entity": "tool", "density_a": "measure"}, entity="entity", entities=[3, 8, 21, 34], layer="layer", suffix="ew", time="time", since="2024-01-03", until="2024-01-25")


@query("A5_fetch_lot_summary", "SELECT c_custkey, c_name FROM customer WHERE substr(c_name, 1, 16) IN (SELECT substr(c_name, 1, 16) FROM customer WHERE c_custkey % 400 = 7) AND regexp_full_match(substr(c_name, 10), '[0-9 ]*')")
def a5(spark, d):
    c = table(spark, d, "customer").withColumn("digits", F.expr("substring(c_name, 10)"))
    return tables.fetch_by_prefix(c, c.where("c_custkey % 400 = 7"), "c_name", "c_name", 16, "digits").select("c_custkey", "c_name")


@query("A6_latest_per_operation", "SELECT entity, layer, unit_id FROM u WHERE density_a > 1 QUALIFY row_number() OVER (PARTITION BY entity, layer ORDER BY time DESC, unit_id DESC) = 1")
def a6(spark, d):
    return tables.latest_per(units(spark, d).where("density_a > 1"), ["entity", "layer"], [F.desc("time"), F.desc("unit_id")]).select("entity", "layer", "unit_id")


@query("A7_write_table", "SELECT unit_id, CASE WHEN CAST(time AS DATE) = DATE '2024-01-08' THEN density_a + 1 ELSE density_a END AS density_a FROM u")
def a7(spark, d):
    """Units written by day; one day is read, changed and written again; all days are read back."""
    held = days.DayTable(spark, tables.work_path(spark, "units"))
    u = units(spark, d).select("unit_id", "time", "density_a")
    held.write(u, F.col("time"))
    held.write(held.read(["2024-01-08"]).withColumn("density_a", F.col("density_a") + 1), F.col("time"))
    return held.read().select("unit_id", "density_a")


@query("A8_export_recent", "SELECT unit_id, layer FROM u WHERE time >= (SELECT max(time) FROM u) - INTERVAL 10 DAY")
def a8(spark, d):
    return tables.export_recent(units(spark, d), "time", 10).select("unit_id", "layer")


@query("A9_run_report", "SELECT n_rows, 'density_a' AS \"column\", count_a AS n_values, n_rows - count_a AS n_nulls FROM (SELECT count(*) AS n_rows, count(density_a) AS count_a FROM u) UNION ALL SELECT n_rows, 'density_b', c, n_rows - c FROM (SELECT count(*) AS n_rows, count(density_b) AS c FROM u)")
def a9(spark, d):
    return tables.run_report(units(spark, d), ["density_a", "density_b"])


@query("A10_freshness_check", """SELECT source, round(age_days, 6) AS age_days, age_days <= 400 AS fresh FROM (
SELECT 'units' AS source, (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(time))) / 86400000000.0 AS age_days FROM u
UNION ALL SELECT 'orders', (epoch_us(TIMESTAMP '2024-03-01') - epoch_us(max(o_orderdate))) / 86400000000.0 FROM orders)""")
def a10(spark, d):
    found = tables.freshness({"units": (units(spark, d), "time"), "orders": (table(spark, d, "orders"), "o_orderdate")}, "2024-03-01", 400)
    return found.withColumn("age_days", F.round("age_days", 6))


@query("A11_norm_key", "SELECT unit_id, CAST(lot AS VARCHAR) || '|' || strftime(time, '%Y-%m-%d %H:%M:%S') || '|' || coalesce(CASE WHEN unit_id % 3 = 0 THEN NULL ELSE CAST(unit_id AS VARCHAR) END, '') AS key FROM u")
def a11(spark, d):
    u = units(spark, d).withColumn("code", F.when(F.col("unit_id") % 3 != 0, F.concat(F.lit(" +00"), F.col("unit_id"), F.when(F.col("unit_id") % 2 == 0, F.lit(".0 ")).otherwise(F.lit("e0")))))
    return u.select("unit_id", S.norm_key(["lot", "time", "code"], ["time"]).alias("key"))


@query("A12_scan_scope", "SELECT unit_id, layer, CASE layer WHEN 'view' THEN 'R1' ELSE 'R2' END AS expected_recipe, CAST(entity AS INT) AS slot FROM u WHERE layer IN ('view', 'click') AND time >= TIMESTAMP '2024-01-10' AND density_b IS NOT NULL")
def a12(spark, d):
    u = units(spark, d).withColumn("slot", F.col("entity").cast("string"))
    return tables.scan_scope(u, event="layer", recipes={"view": "R1", "click": "R2"}, time="time", since="2024-01-10", slot="slot", required=["density_b"]).select("unit_id", "layer", "expected_recipe", "slot")


@query("H1_status_class", """SELECT unit_id, CASE WHEN v < 5 THEN 'BSL' ELSE 'HIGHFLIER' END AS status,
CASE WHEN v IS NULL THEN 'UNKNOWN' WHEN v = 0 THEN 'ZERO' WHEN v > 0 AND v < 5 THEN 'BSL' ELSE 'HIGHFLIER' END AS class, coalesce(v = 0, false) AS zero FROM (SELECT unit_id, floor(density_b) - 1 AS v FROM u)""")
def h1(spark, d):
    return units(spark, d).withColumn("v", F.floor("density_b") - 1).select("unit_id", S.status2("v", 5).alias("status"), S.class4("v", 5).alias("class"), S.is_zero("v").alias("zero"))


@query("H2_density_sum", "SELECT unit_id, coalesce(density_a, 0) + coalesce(density_b, 0) AS density_sum FROM u")
def h2(spark, d):
    return units(spark, d).select("unit_id", S.density_sum("density_a", "density_b").alias("density_sum"))


_FLAGS = "SELECT unit_id, CASE WHEN unit_id % 11 = 0 THEN NULL WHEN unit_id % 2 = 0 THEN 'ON' ELSE 'OFF' END AS f1, CASE WHEN unit_id % 3 = 0 THEN 'ON' ELSE 'OFF' END AS f2, CASE WHEN unit_id % 5 = 0 THEN 'ON' ELSE 'OFF' END AS f3, CASE WHEN unit_id % 7 = 0 THEN 'ON' ELSE 'OFF' END AS f4 FROM u"


def _flags(spark, d):
    u = units(spark, d)
    flags = [F.when(F.col("unit_id") % k == 0, "ON").otherwise("OFF").alias(f"f{i}") for i, k in enumerate((2, 3, 5, 7), 1)]
    return u.select("unit_id", *flags).withColumn("f1", F.when(F.col("unit_id") % 11 != 0, F.col("f1")))


@query("H3_rollout_status", f"""SELECT unit_id, CASE WHEN f4 = 'ON' THEN 'PRIORITY' ELSE
CASE WHEN f1 IS NULL THEN 'ERROR' WHEN f1 = 'OFF' AND f2 = 'OFF' THEN 'BASE' WHEN f1 = 'ON' AND f2 = 'OFF' THEN 'A' WHEN f1 = 'OFF' AND f2 = 'ON' THEN 'B' ELSE 'A+B' END || CASE WHEN f3 = 'ON' THEN '+X' ELSE '' END END AS status FROM ({_FLAGS})""")
def h3(spark, d):
    return _flags(spark, d).select("unit_id", S.rollout_status("f4", ("f1", "f2"), ("BASE", "A", "B", "A+B"), {"f3": "+X"}).alias("status"))


@query("H3_rollout_status_lenient", f"""SELECT unit_id, CASE WHEN f4 = 'ON' THEN 'PRIORITY' ELSE
CASE WHEN coalesce(f1, '') <> 'ON' AND f2 = 'OFF' THEN 'BASE' WHEN f1 = 'ON' AND f2 = 'OFF' THEN 'A' WHEN coalesce(f1, '') <> 'ON' AND f2 = 'ON' THEN 'B' ELSE 'A+B' END || CASE WHEN f3 = 'ON' THEN '+X' ELSE '' END END AS status FROM ({_FLAGS})""")
def h3l(spark, d):
    return _flags(spark, d).select("unit_id", S.rollout_status("f4", ("f1", "f2"), ("BASE", "A", "B", "A+B"), {"f3": "+X"}, off_unless_on=True).alias("status"))


@query("H4_rollout_short", f"SELECT unit_id, CASE WHEN f4 = 'ON' THEN 'NEW' ELSE 'OLD' END AS short, '' AS absent FROM ({_FLAGS})")
def h4(spark, d):
    return _flags(spark, d).select("unit_id", S.rollout_short("f4", "NEW", "OLD").alias("short"), S.rollout_short(None, "NEW", "OLD").alias("absent"))


_TECH = "CASE substr(p_type, 4, 1) WHEN 'N' THEN 'TECH1' WHEN 'M' THEN 'TECH2' ELSE 'UNKNOWN' END"


@query("H5_recipe_group", f"""SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'OTHER' WHEN starts_with(upper(p_name), 'RED') OR starts_with(upper(p_name), 'NAVY') OR contains(upper(p_name), 'HOOK') OR p_size = 13 THEN 'MONITOR'
WHEN tech = 'TECH1' AND contains(p_brand, '5') THEN 'LAYER5' WHEN starts_with(upper(p_name), 'SMALL') THEN right(tech, 1) || '_S'
WHEN tech = 'TECH1' AND contains(upper(p_name), 'RING') THEN 'RINGS1' WHEN tech = 'TECH1' AND contains(upper(p_name), 'WIDGET') THEN 'WIDGETS1' WHEN tech = 'TECH2' AND contains(upper(p_name), 'RING') THEN 'RINGS2' ELSE 'OTHER' END AS grp FROM (SELECT *, {_TECH} AS tech FROM part)""")
def h5(spark, d):
    p = table(spark, d, "part").withColumn("recipe", F.when(F.col("p_partkey") % 11 != 0, F.col("p_name")))
    tech = S.technology("p_type", {"N": "TECH1", "M": "TECH2"})
    rules = {"monitor_prefixes": ["RED", "NAVY"], "monitor_words": ["HOOK"], "monitor": "MONITOR", "layer_rule": ("TECH1", "5", "LAYER5"), "special_prefix": "SMALL", "special_suffix": "_S"}
    return p.select("p_partkey", S.recipe_group("recipe", tech, F.col("p_size") == 13, "p_brand", keywords={"TECH1": {"RING": "RINGS1", "WIDGET": "WIDGETS1"}, "TECH2": {"RING": "RINGS2"}}, **rules).alias("grp"))


@query("H6_technology_is_test", "SELECT p_partkey, CASE substr(p_type, 4, 1) WHEN 'N' THEN 'TECH1' WHEN 'M' THEN 'TECH2' ELSE 'UNKNOWN' END AS technology, contains(p_name, 't') AS is_test FROM part")
def h6(spark, d):
    return table(spark, d, "part").select("p_partkey", S.technology("p_type", {"N": "TECH1", "M": "TECH2"}).alias("technology"), S.is_test("p_name", "t").alias("is_test"))


@query("H7_layer_match_product", f"""SELECT p_partkey, p_size <> 13 AND ((p_type = 'ECONOMY' AND tech = 'TECH1' AND (contains(p_name, 'ring') OR contains(p_name, 'bolt'))) OR (p_type = 'PROMO' AND tech = 'TECH2' AND contains(p_name, 'widget'))) AS matches,
p_size <> 13 AND p_brand <> 'Brand#13' AS product FROM (SELECT *, {_TECH} AS tech FROM part)""")
def h7(spark, d):
    tech = S.technology("p_type", {"N": "TECH1", "M": "TECH2"})
    test = F.col("p_size") == 13
    return table(spark, d, "part").select("p_partkey", S.layer_match("p_type", tech, test, "p_name", {"ECONOMY": ("TECH1", ["ring", "bolt"]), "PROMO": ("TECH2", ["widget"])}).alias("matches"), S.is_product(test, "p_brand", "Brand#13").alias("product"))


@query("H8_yymm", "SELECT unit_id, strftime(time, '%y%m') AS yymm, strftime(time, '%Y-%m') AS month, epoch_us(date_trunc('day', time)) AS day_us FROM u")
def h8(spark, d):
    u = units(spark, d).withColumn("never", F.lit(None).cast("timestamp"))
    t = S.first_time("never", "time")
    return u.select("unit_id", S.yymm(t).alias("yymm"), F.date_format(t, "yyyy-MM").alias("month"), F.unix_micros(F.date_trunc("day", t)).alias("day_us"))


@query("H9_elapsed", "SELECT unit_id, round((epoch_us(time) - epoch_us(TIMESTAMP '2024-01-01')) / 3600000000.0, 6) AS hours, round((epoch_us(time) - epoch_us(TIMESTAMP '2024-01-01')) / 86400000000.0, 6) AS days FROM u")
def h9(spark, d):
    start = F.lit("2024-01-01").cast("timestamp")
    return units(spark, d).select("unit_id", F.round(S.elapsed(start, F.col("time"), "hours"), 6).alias("hours"), F.round(S.elapsed(start, F.col("time"), "days"), 6).alias("days"))


@query("H10_slices_side", "SELECT c_custkey, substr(c_name, 1, 8) AS prefix, CASE WHEN right(c_name, 1) IN ('1','3','5') THEN 'LEFT' WHEN right(c_name, 1) IN ('2','4','6') THEN 'RIGHT' END AS side FROM customer")
def h10(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.substring("c_name", 1, 8).alias("prefix"), S.side("c_name").alias("side"))


@query("H11_clean_text", """SELECT conv_id, turn, translate(text, ',"' || chr(9) || chr(10) || chr(13) || chr(7), ';''    ') AS clean FROM conversations""")
def h11(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", S.clean_text("text").alias("clean"))


@query("H12_safe_tokens", r"""SELECT page_id, CASE WHEN trim(url) = '' THEN 'UNKNOWN' ELSE regexp_replace(trim(url), '[<>:"/\\|?*]', '_', 'g') END AS token, regexp_replace(url, '[^A-Za-z0-9_]', '', 'g') AS identifier FROM pages""")
def h12(spark, d):
    return table(spark, d, "pages").select("page_id", S.safe_token("url").alias("token"), S.sanitize_identifier("url").alias("identifier"))


_PATH = """'img/' || CASE WHEN layer = 'error' THEN 'AMBIGUOUS/error/' ELSE '' END || device || '/' || coalesce(strftime(CASE WHEN unit_id % 9 = 0 THEN NULL ELSE time END, '%y%m%d_%H%M'), '000000_0000') || '_' || lot || '_'
|| CASE WHEN len(unit_id + 9990000) >= 8 THEN substr(CAST(unit_id + 9990000 AS VARCHAR), 6, 3) ELSE CAST(unit_id + 9990000 AS VARCHAR) END || '_' || CASE layer WHEN 'purchase' THEN 'PU' ELSE layer END || '_L_1_' || unit_id || '_' || unit_id % 20 || CASE WHEN unit_id % 4 = 0 THEN '.jpg' ELSE '.png' END""".replace("len(unit_id + 9990000)", "len(CAST(unit_id + 9990000 AS VARCHAR))")


def _paths(spark, d):
    u = units(spark, d).withColumns({"seen": F.when(F.col("unit_id") % 9 != 0, F.col("time")), "image": F.col("unit_id") % 20, "name": F.col("unit_id") + 9990000, "step": F.lit("L:1"), "file": F.when(F.col("unit_id") % 4 != 0, F.lit("x/A.b.PNG"))})
    path = S.image_path("img", entity="device", klass="layer", short={"purchase": "PU"}, ambiguous=["error"], time="seen", lot="lot", unit="name", layer="step", point="unit_id", image="image", file="file")
    return u.withColumn("path", path)


@query("H13_image_path", f"SELECT unit_id, {_PATH} AS path FROM u")
def h13(spark, d):
    return _paths(spark, d).select("unit_id", "path")


@query("H14_parse_path", """SELECT unit_id, device AS folder, CASE WHEN unit_id % 9 = 0 THEN NULL ELSE epoch_us(date_trunc('minute', time)) END AS time_us, CAST(unit_id AS BIGINT) AS point, CAST(unit_id % 20 AS INT) AS image FROM u""")
def h14(spark, d):
    part = S.parse_path("path")
    return _paths(spark, d).select("unit_id", part["folder"].alias("folder"), F.unix_micros(part["time"]).alias("time_us"), part["point"].alias("point"), part["image"].alias("image"))


@query("H15_image_ids", "SELECT p_partkey, CAST(b + greatest(0, p_size - 16) AS INT) AS image_id FROM part, (SELECT unnest([1, 4, 9]) AS b)")
def h15(spark, d):
    return table(spark, d, "part").select("p_partkey", F.explode(S.image_ids("p_size", [1, 4, 9])).alias("image_id"))


@query("H16_element_label", """SELECT lot, part, entity, slot, price, coalesce(names || ' - (' || numbers || ')', '') AS label FROM g LEFT JOIN LATERAL (
SELECT string_agg(s, '' ORDER BY v DESC, s DESC) AS names, string_agg(CAST(CAST(round_even(v, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY v DESC, s DESC) AS numbers
FROM (VALUES (qty, 'Q'), (discount * 100, 'D'), (tax * 100, 'T')) AS x(v, s) WHERE v > 0) ON true""")
def h16(spark, d):
    w = usage(spark, d).withColumns({"d": F.col("discount") * 100, "t": F.col("tax") * 100})
    return w.select("lot", "part", "entity", "slot", "price", S.element_label({"qty": "Q", "d": "D", "t": "T"}).alias("label"))


@query("H17_first_nonblank", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN c_mktsegment WHEN c_custkey % 5 = 0 THEN 'UNKNOWN' ELSE c_name END AS entity FROM customer")
def h17(spark, d):
    c = table(spark, d, "customer").withColumn("a", F.when(F.col("c_custkey") % 3 == 0, " NaN ").when(F.col("c_custkey") % 3 == 1, " ").otherwise(F.col("c_mktsegment"))).withColumn("b", F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")))
    return c.select("c_custkey", S.first_nonblank("a", "b").alias("entity"))


@query("H18_scaled", "SELECT point_id, round((x - 1.5) / 25.4, 6) AS x_in FROM p")
def h18(spark, d):
    from lithos.plans.base import points

    return points(spark, d).select("point_id", F.round(S.scaled("x", F.lit(1.5), 25.4), 6).alias("x_in"))


@query("H19_marker", "SELECT unit_id, CASE layer WHEN 'view' THEN 'START' WHEN 'purchase' THEN 'END' ELSE 'MID' END AS mark FROM u")
def h19(spark, d):
    return units(spark, d).select("unit_id", S.marker("layer", {"view": "START", "purchase": "END"}, "MID").alias("mark"))


@query("H20_event_time_recipe_key", "SELECT unit_id, epoch_us(CASE WHEN unit_id % 4 = 0 THEN time ELSE time + INTERVAL 1 HOUR END) AS time_us, CASE WHEN unit_id % 5 = 0 THEN layer ELSE device END AS recipe_key FROM u")
def h20(spark, d):
    u = units(spark, d).withColumns({"end": F.when(F.col("unit_id") % 4 != 0, F.col("time") + F.expr("INTERVAL 1 HOUR")), "r1": F.when(F.col("unit_id") % 5 == 0, "  ").otherwise(F.col("device"))})
    return u.select("unit_id", F.unix_micros(S.event_time("end", "time")).alias("time_us"), S.first_nonblank("r1", "layer").alias("recipe_key"))


@query("H21_norm_recipe", "SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE upper(p_name) END AS recipe FROM part")
def h21(spark, d):
    return table(spark, d, "part").select("p_partkey", S.norm_recipe(F.when(F.col("p_partkey") % 4 != 0, F.concat(F.lit(" "), "p_name", F.lit("  ")))).alias("recipe"))


@query("H22_coerce", "SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS number, NULL::DOUBLE AS bad, epoch_us(TIMESTAMP '2024-02-03 04:05:06') AS time_us FROM part")
def h22(spark, d):
    return table(spark, d, "part").select("p_partkey", S.to_number(F.split_part("p_brand", F.lit("#"), F.lit(2))).alias("number"), S.to_number("p_brand").alias("bad"), F.unix_micros(S.to_time(F.lit("2024-02-03 04:05:06"))).alias("time_us"))
