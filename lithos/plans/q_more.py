"""Queries of reshaping (I), statistics (J) and comparison (K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.operators import compare as K
from lithos.operators import joins as C
from lithos.operators import reshape as R
from lithos.operators import stats as J
from lithos.plans.base import points, query, table, units, us, usage
from lithos.sources import tables


def _r(*names):
    return {n: F.round(n, 6) for n in names}


@query("I1_unpivot_elements", """SELECT lot, part, entity, slot, price, elem_num, original_element, CASE original_element WHEN 'Q' THEN 'QTY' ELSE 'RATE' END AS element, CAST(CASE WHEN price <= 20000 THEN 0 WHEN price <= 50000 THEN 1 ELSE 2 END AS INT) AS size_bucket, round(value, 6) AS value
FROM (SELECT lot, part, entity, slot, price, 1 AS elem_num, 'Q' AS original_element, qty AS value FROM g UNION ALL SELECT lot, part, entity, slot, price, 2, 'D', discount FROM g) WHERE value > 0 AND slot > 3""")
def i1(spark, d):
    g = usage(spark, d).withColumnsRenamed({"qty": "ELEM1_Q", "discount": "ELEM2_D", "tax": "ELEM3_X"}).withColumn("images", F.col("slot") - 3)
    out = R.unpivot_elements(g, ["lot", "part", "entity", "slot"], "ELEM([0-9]+)_([A-Z]+)", {"Q": "QTY", "D": "RATE"}, "images", "price", [20000, 50000])
    return out.select("lot", "part", "entity", "slot", "price", "elem_num", "original_element", "element", "size_bucket", F.round("value", 6).alias("value"))


def _manifest(spark, d):
    u = units(spark, d)
    return u.select("unit_id", "entity", "layer", "time", (F.col("unit_id") % 3).alias("image"), F.when(F.col("unit_id") % 5 != 0, F.concat(F.lit("p"), F.col("unit_id"))).alias("path"))


_M = "SELECT unit_id, entity, layer, time, unit_id % 3 AS image, CASE WHEN unit_id % 5 <> 0 THEN 'p' || unit_id END AS path FROM u"


@query("I2_image_pairs", f"SELECT entity, layer, arg_max(path, time) FILTER (image = 1 AND path IS NOT NULL) AS path_1, arg_max(path, time) FILTER (image = 2 AND path IS NOT NULL) AS path_2 FROM ({_M}) GROUP BY entity, layer HAVING count(path) FILTER (image = 1) > 0 AND count(path) FILTER (image = 2) > 0")
def i2(spark, d):
    return R.image_pairs(_manifest(spark, d), ["entity", "layer"], "image", "path", "time", (1, 2))


@query("I3_report_rows", f"""WITH pr AS (SELECT entity, layer FROM ({_M}) GROUP BY entity, layer HAVING count(path) FILTER (image = 1) > 0 AND count(path) FILTER (image = 2) > 0),
b AS (SELECT u.unit_id, u.layer, row_number() OVER (PARTITION BY u.layer ORDER BY u.unit_id) AS row FROM u JOIN pr ON u.entity = pr.entity AND u.layer = pr.layer WHERE density_a > 30)
SELECT row, x.unit_id AS unit_id_0, y.unit_id AS unit_id_1 FROM (SELECT * FROM b WHERE layer = 'view') x FULL JOIN (SELECT * FROM b WHERE layer = 'error') y USING (row)""")
def i3(spark, d):
    pairs = R.image_pairs(_manifest(spark, d), ["entity", "layer"], "image", "path", "time", (1, 2))
    return R.report_rows(units(spark, d).where("density_a > 30"), pairs, ["entity", "layer"], "layer", ("view", "error"), ["unit_id"], ["unit_id"])


@query("I3_excluded", f"""WITH pr AS (SELECT entity, layer FROM ({_M}) GROUP BY entity, layer HAVING count(path) FILTER (image = 1) > 0 AND count(path) FILTER (image = 2) > 0)
SELECT u.layer, count(pr.entity) AS n_included, count(*) - count(pr.entity) AS n_excluded FROM u LEFT JOIN pr ON u.entity = pr.entity AND u.layer = pr.layer WHERE u.layer IN ('view', 'error') GROUP BY u.layer""")
def i3x(spark, d):
    pairs = R.image_pairs(_manifest(spark, d), ["entity", "layer"], "image", "path", "time", (1, 2))
    return R.excluded_counts(units(spark, d), pairs, ["entity", "layer"], "layer", ("view", "error"))


@query("I4_needed_images", "SELECT unit_id FROM u WHERE (entity, layer) NOT IN (SELECT entity, layer FROM u WHERE unit_id % 7 = 0 AND unit_id % 3 IN (1, 2) GROUP BY entity, layer HAVING count(DISTINCT unit_id % 3) = 2)")
def i4(spark, d):
    m = _manifest(spark, d).where("unit_id % 7 = 0").withColumn("image", F.col("image").cast("int"))
    return R.needed_images(units(spark, d), m, ["entity", "layer"], "image", [1, 2]).select("unit_id")


@query("I5_stale_paths", f"SELECT unit_id, path AS old_path FROM ({_M}) WHERE path IS NOT NULL AND unit_id % 4 = 0")
def i5(spark, d):
    m = _manifest(spark, d)
    return R.stale_paths(m, m.withColumn("path", F.when(F.col("unit_id") % 4 == 0, "moved").otherwise(F.col("path"))), ["unit_id"], "path")


@query("I6_retention_candidates", f"SELECT unit_id FROM ({_M}) WHERE path IS NOT NULL AND time < (SELECT max(time) FROM u) - INTERVAL 14 DAY")
def i6(spark, d):
    return R.retention_candidates(_manifest(spark, d), "path", "time", 14, 7).select("unit_id")


@query("I7_reconcile_paths", """SELECT unit_id, CASE WHEN unit_id % 4 = 0 THEN 'new/f' || unit_id WHEN unit_id % 4 = 1 THEN 'old/f' || unit_id WHEN unit_id % 4 = 2 THEN 'else/f' || unit_id END AS resolved FROM u""")
def i7(spark, d):
    u = units(spark, d).select("unit_id", F.concat(F.lit("f"), F.col("unit_id")).alias("name"))
    m = u.withColumns({"expected": F.concat(F.lit("new/"), "name"), "current": F.concat(F.lit("old/"), "name")})
    k = F.col("unit_id") % 4
    listing = u.withColumn("path", F.explode(F.when(k == 0, F.array(F.concat(F.lit("new/"), "name"), F.concat(F.lit("old/"), "name"))).when(k == 1, F.array(F.concat(F.lit("old/"), "name"))).when(k == 2, F.array(F.concat(F.lit("else/"), "name"))).otherwise(F.array(F.concat(F.lit("a/"), "name"), F.concat(F.lit("b/"), "name")))))
    return R.reconcile_paths(m, "expected", "current", "name", listing).select("unit_id", "resolved")


@query("I8_inventory_append", "SELECT 'img/' || unit_id || '.png' AS path, CASE WHEN unit_id % 2 = 0 THEN layer END AS layer, CASE WHEN unit_id % 2 = 1 THEN CAST(unit_id AS BIGINT) END AS parsed FROM u")
def i8(spark, d):
    u = units(spark, d).withColumn("path", F.concat(F.lit("img/"), F.col("unit_id"), F.lit(".png")))
    m = u.where("unit_id % 2 = 0").select("path", "layer").withColumn("parsed", F.lit(None).cast("long"))
    return R.inventory_append(m, "path", u.select("path"), {"parsed": F.regexp_extract("path", "([0-9]+)", 1).try_cast("long")})


@query("I9_sample_join", "SELECT l.unit_id, m.density_a AS metric FROM u l JOIN (SELECT lot, density_a FROM u WHERE layer = 'view' AND time >= (SELECT max(time) FROM u WHERE layer = 'view') - INTERVAL 10 DAY QUALIFY row_number() OVER (PARTITION BY lot ORDER BY unit_id) = 1) m ON l.lot = m.lot WHERE l.layer = 'error'")
def i9(spark, d):
    u = units(spark, d)
    return R.sample_join(u.where("layer = 'view'").select("unit_id", "lot", "time", F.col("density_a").alias("metric")), u.where("layer = 'error'").select("unit_id", "lot"), ["lot"], "time", 10, ["metric"], [F.col("unit_id")]).select("unit_id", "metric")


@query("I10_new_images", "SELECT unit_id, unit_id % 3 = 0 AS listed FROM u")
def i10(spark, d):
    u = units(spark, d).select("unit_id", F.concat(F.lit("p/"), F.col("unit_id")).alias("expected"))
    fresh, held = R.new_images(u, "expected", u.where("unit_id % 3 = 0").select(F.col("expected").alias("path")))
    return fresh.select("unit_id", F.lit(False).alias("listed")).unionByName(held.select("unit_id", F.lit(True).alias("listed")))


_NN = "SELECT b.grp, b.point_id, min(sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2)) AS d FROM p b JOIN p a ON a.grp = b.grp AND a.class = 'A' WHERE b.class = 'B' GROUP BY b.grp, b.point_id"


@query("J1_nn_metrics", f"SELECT grp, count(*) AS n, round(min(d), 6) AS nearest, round(quantile_cont(d, 0.5), 6) AS median, round(quantile_cont(d, 0.9), 6) AS p90, round(avg(CAST(d <= 1 AS INT)), 6) AS share_1, round(avg(CAST(d <= 2 AS INT)), 6) AS share_2 FROM ({_NN}) GROUP BY grp")
def j1(spark, d):
    return J.nn_metrics(points(spark, d), ["grp"], "class", "B", "A", "point_id", "x", "y", [1, 2]).withColumns(_r("nearest", "median", "p90", "share_1", "share_2"))


@query("J2_nn_permutation")
def j2(spark, d):
    """Every point, in groups of 50 neighbouring ids, as points of one unit are."""
    return J.nn_permutation(points(spark, d).withColumn("unit", F.expr("point_id div 50")), ["unit"], "class", "B", "A", "x", "y", 1.0, 49, 7)


@query("J3_corr_score", f"SELECT grp, round((0.45 * avg(CAST(d <= 2 AS INT)) + 0.30 * avg(CAST(d <= 1 AS INT)) + 0.25 / (1 + quantile_cont(d, 0.5))) * 0.9, 6) AS score FROM ({_NN}) GROUP BY grp")
def j3(spark, d):
    m = J.nn_metrics(points(spark, d), ["grp"], "class", "B", "A", "point_id", "x", "y", [1, 2]).withColumn("p", F.lit(0.1))
    return m.select("grp", F.round(J.corr_score("share_2", "share_1", "median", "p"), 6).alias("score"))


@query("J4_suspicious_lists", "SELECT device, entity, n_a, n_b FROM (SELECT *, row_number() OVER (PARTITION BY device ORDER BY score DESC, entity) AS r FROM (SELECT device, entity, count(*) FILTER (layer = 'view') AS n_a, count(*) FILTER (layer = 'error') AS n_b, max(density_a) AS score, count(*) % 10 / 10.0 AS p FROM u GROUP BY ALL) WHERE n_a >= 5 AND n_b >= 5 AND p <= 0.5) WHERE r <= 5")
def j4(spark, d):
    per = units(spark, d).groupBy("device", "entity").agg(F.count_if(F.col("layer") == "view").alias("n_a"), F.count_if(F.col("layer") == "error").alias("n_b"), F.max("density_a").alias("score"), (F.count("*") % 10 / 10).alias("p"))
    return J.suspicious(per, "n_a", "n_b", "p", 5, 0.5, "device", "score", ["entity"], 5).select("device", "entity", "n_a", "n_b")


@query("J5_iqr_outliers", """WITH m AS (SELECT entity, avg(density_a) AS mean FROM u GROUP BY entity), q AS (SELECT quantile_cont(mean, 0.25) AS a, quantile_cont(mean, 0.75) AS b FROM m)
SELECT entity, round(mean, 6) AS mean, mean < a - 1.5 * (b - a) OR mean > b + 1.5 * (b - a) AS outlier FROM m, q""")
def j5(spark, d):
    return J.iqr_outliers(units(spark, d), "entity", "density_a").withColumns(_r("mean"))


@query("J6_mann_whitney", """WITH r AS (SELECT device, density_a AS v, rank() OVER (ORDER BY density_a) + (count(*) OVER (PARTITION BY density_a) - 1) / 2.0 AS rk FROM u), a AS (SELECT device, count(*) AS n1, sum(rk) AS r1, median(v) AS median FROM r GROUP BY device), n AS (SELECT count(*) AS n FROM u)
SELECT device, n1, n - n1 AS n2, round(r1 - n1 * (n1 + 1) / 2.0, 6) AS u, round(1 - 2 * (r1 - n1 * (n1 + 1) / 2.0) / (n1 * (n - n1)), 6) AS effect, round(median, 6) AS median, round((SELECT median(density_a) FROM u WHERE u.device <> a.device), 6) AS others_median FROM a, n""")
def j6(spark, d):
    return J.mann_whitney(units(spark, d), "device", "density_a", 0.05).select("device", "n1", "n2", F.round("u", 6).alias("u"), F.round("effect", 6).alias("effect"), F.round("median", 6).alias("median"), F.round("others_median", 6).alias("others_median"))


@query("J6_mann_whitney_p")
def j6p(spark, d):
    return J.mann_whitney(units(spark, d), "device", "density_a", 0.05)


@query("J7_temporal_split", "SELECT o_orderkey, CASE WHEN o_orderdate <= TIMESTAMP '2001-01-15' THEN 'train' ELSE strftime(o_orderdate, '%Y-%m') END AS split FROM orders")
def j7(spark, d):
    return J.temporal_split(table(spark, d, "orders"), "o_orderdate", "2001-01-15").select("o_orderkey", "split")


@query("J8_label_encode", "WITH k AS (SELECT layer, row_number() OVER (ORDER BY layer) - 1 AS i FROM (SELECT DISTINCT layer FROM u WHERE layer <> 'error')) SELECT unit_id, CAST(coalesce(i, 0) AS BIGINT) AS layer_index FROM u LEFT JOIN k USING (layer)")
def j8(spark, d):
    return J.label_encode(units(spark, d), ["layer"], F.col("layer") != "error").select("unit_id", F.col("layer_index").cast("long").alias("layer_index"))


def _forest(spark, d):
    features = ["entity", "hour", "layer_index"]
    u = J.label_encode(units(spark, d).withColumn("hour", F.hour("time")), ["layer"], F.col("time") <= "2024-01-20")
    u = u.withColumns({"rate": F.when(F.col("density_a") > 9, F.col("density_a")).otherwise(0.0), "split": F.when(F.col("time") <= "2024-01-20", "train").otherwise("test")})
    return u, features, J.train_forest(u.where("split = 'train'"), features, "rate", trees=10, depth=5, min_leaf=5, seed=42)[0]


@query("J9_train_forest")
def j9(spark, d):
    u, features, model = _forest(spark, d)
    return model.transform(J.forest_rows(u, features, "rate")).select("unit_id", "label", "prediction")


@query("J10_evaluate")
def j10(spark, d):
    u, features, model = _forest(spark, d)
    return J.evaluate(model, u, features, "rate", "split")


@query("J11_importance_top")
def j11(spark, d):
    _, features, model = _forest(spark, d)
    return spark.createDataFrame(J.importance_top(model, features, 2), "feature string, importance double, rank int")


@query("K1_compare_keys", """WITH l AS (SELECT * FROM u WHERE unit_id % 3 <> 0), r AS (SELECT * FROM u WHERE unit_id % 2 = 0)
SELECT (SELECT count(*) FROM l WHERE unit_id IN (SELECT unit_id FROM r)) AS "both", (SELECT count(*) FROM l WHERE unit_id NOT IN (SELECT unit_id FROM r)) AS only_left, (SELECT count(*) FROM r WHERE unit_id NOT IN (SELECT unit_id FROM l)) AS only_right,
(SELECT count(*) FROM l) AS rows_left, (SELECT count(*) FROM r) AS rows_right, (SELECT epoch_us(min(time)) FROM l) AS first_left, (SELECT epoch_us(max(time)) FROM r) AS last_right, 'density_b' AS columns_left, 'extra' AS columns_right""")
def k1(spark, d):
    u = units(spark, d)
    right = u.where("unit_id % 2 = 0").drop("density_b").withColumn("extra", F.lit(1))
    return K.compare_keys(u.where("unit_id % 3 <> 0"), right, ["unit_id"], "time").select("columns_left", "columns_right", "both", "only_left", "only_right", "rows_left", "rows_right", us("first_left").alias("first_left"), us("last_right").alias("last_right"))


@query("K1_month_counts", "SELECT strftime(time, '%Y-%m') AS month, count(*) FILTER (unit_id % 3 <> 0) AS rows_left, count(*) FILTER (time > TIMESTAMP '2024-02-01') AS rows_right FROM u WHERE unit_id % 3 <> 0 OR time > TIMESTAMP '2024-02-01' GROUP BY 1")
def k1m(spark, d):
    u = units(spark, d)
    return K.month_counts(u.where("unit_id % 3 <> 0"), u.where("time > '2024-02-01'"), "time")


@query("K2_compare_rows_hash", "SELECT (SELECT count(*) FROM (SELECT lot, part FROM g WHERE lot % 2 = 0 INTERSECT SELECT lot, part FROM g WHERE lot % 3 = 0)) AS \"both\", (SELECT count(*) FROM (SELECT lot, part FROM g WHERE lot % 2 = 0 EXCEPT SELECT lot, part FROM g WHERE lot % 3 = 0)) AS only_left, (SELECT count(*) FROM (SELECT lot, part FROM g WHERE lot % 3 = 0 EXCEPT SELECT lot, part FROM g WHERE lot % 2 = 0)) AS only_right, 'OVERLAP' AS verdict")
def k2(spark, d):
    g = usage(spark, d).select("lot", "part")
    return K.compare_rows(g.where("lot % 2 = 0"), g.where("lot % 3 = 0"))


@query("K3_unmatched_profile", """WITH l AS (SELECT * FROM u WHERE unit_id % 4 <> 0), c AS (SELECT strftime(time, '%Y-%m') AS month, layer, count(*) AS n, count(*) FILTER (time < TIMESTAMP '2024-01-15') AS before, 0::BIGINT AS invalid FROM l GROUP BY 1, 2)
SELECT month, layer, n, before, invalid, CASE WHEN t > 0.8 THEN 'HIGH' WHEN t > 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS concentration FROM c, (SELECT max(m) / sum(m) AS t FROM (SELECT sum(n) AS m FROM c GROUP BY month))""")
def k3(spark, d):
    u = units(spark, d)
    return K.unmatched_profile(u, u.where("unit_id % 4 = 0"), ["unit_id"], [], "time", "layer", "2024-01-15")


def _changed(spark, d):
    u = units(spark, d)
    return u, u.withColumns({"layer": F.when(F.col("unit_id") % 10 == 0, "moved").otherwise(F.col("layer")), "density_b": F.when(F.col("unit_id") % 7 == 0, None).otherwise(F.col("density_b") + 1e-12)})


@query("K4_compare_values", "SELECT 'layer' AS \"column\", count(*) FILTER (unit_id % 10 = 0) AS n_different, 0::BIGINT AS n_null_mismatch, true AS same_type FROM u UNION ALL SELECT 'density_b', count(*) FILTER (unit_id % 7 = 0 AND unit_id % 3 <> 0), count(*) FILTER (unit_id % 7 = 0 AND unit_id % 3 <> 0), true FROM u")
def k4(spark, d):
    before, after = _changed(spark, d)
    return K.compare_values(before, after, ["unit_id"], ["layer", "density_b"])


@query("K5_stat_summary_diff", "SELECT 'density_a' AS \"column\", round(b.m - a.m, 6) AS mean_diff, round(b.s - a.s, 6) AS std_diff, b.x - a.x AS min_diff, b.y - a.y AS max_diff FROM (SELECT avg(density_a) AS m, stddev_samp(density_a) AS s, min(density_a) AS x, max(density_a) AS y FROM u WHERE unit_id % 2 = 0) a, (SELECT avg(density_a) AS m, stddev_samp(density_a) AS s, min(density_a) AS x, max(density_a) AS y FROM u) b")
def k5(spark, d):
    u = units(spark, d)
    return K.stat_summary_diff(u.where("unit_id % 2 = 0"), u, ["density_a"]).withColumns(_r("mean_diff", "std_diff"))


@query("K5_duplicate_counts", "SELECT a AS duplicates_left, b AS duplicates_right, a = b AS same FROM (SELECT (SELECT count(*) FROM g) - (SELECT count(*) FROM (SELECT DISTINCT lot, slot, recipe FROM g)) AS a, (SELECT count(*) FROM g) - (SELECT count(*) FROM (SELECT DISTINCT lot, recipe FROM g)) AS b)")
def k5d(spark, d):
    g = usage(spark, d)
    return K.duplicate_counts(g.select("lot", "slot", "recipe"), g.select("lot", "recipe"))


@query("K6_range_filter_check", "SELECT count(*) AS n_filtered, 0::BIGINT AS n_outside, count(*) AS n_expected, true AS ok FROM u WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-12'")
def k6(spark, d):
    u = units(spark, d)
    return K.range_check(u, tables.scan_window(u, "time", "2024-01-05", "2024-01-12"), "time", "2024-01-05", "2024-01-12")


@query("K7_changed_count", "SELECT 'layer' AS \"column\", count(*) FILTER (unit_id % 10 = 0) AS n_changed FROM u UNION ALL SELECT 'device', 0")
def k7(spark, d):
    before, after = _changed(spark, d)
    return K.changed_counts(before, after, ["unit_id"], ["layer", "device"])


@query("K7_transitions", "SELECT layer || ' -> moved' AS transition, count(*) AS n FROM u WHERE unit_id % 10 = 0 GROUP BY layer ORDER BY n DESC, transition LIMIT 3")
def k7t(spark, d):
    before, after = _changed(spark, d)
    return K.transitions(before, after, ["unit_id"], "layer", 3)


@query("K7_shape", "SELECT count(*) AS rows_before, count(*) FILTER (unit_id % 10 <> 0) AS rows_after, count(*) FILTER (unit_id % 10 = 0) = 0 AS same_rows, true AS same_columns FROM u")
def k7s(spark, d):
    before, after = _changed(spark, d)
    return K.same_shape(before, after.where("unit_id % 10 <> 0"))


@query("K8_bounds_check", "SELECT 'density_b' AS \"column\", 'rate' AS kind, count(*) FILTER (density_b < 0 OR density_b > 1) AS n_bad FROM u UNION ALL SELECT 'entity', 'count', count(*) FILTER (entity < 0) FROM u UNION ALL SELECT 'nothing', 'missing', 1")
def k8(spark, d):
    return K.bounds_check(units(spark, d), ["density_b"], ["entity"], ["nothing"])


@query("K10_link_coverage", "SELECT layer, count(k.lot) AS n_linked, count(*) - count(k.lot) AS n_unlinked FROM u LEFT JOIN (SELECT DISTINCT lot, layer AS ly, device AS dv FROM u WHERE unit_id % 30 = 0) k ON u.lot = k.lot AND u.layer = ly AND u.device = dv GROUP BY layer")
def k10(spark, d):
    u = units(spark, d)
    return K.link_coverage(C.row_link(u, u.where("unit_id % 30 = 0"), ["lot", "layer", "device"], "unit_id"), "layer")


@query("K11_structure_check")
def k11(spark, d):
    before, after = _changed(spark, d)
    return K.structure_check(before, after, ["unit_id"], ["layer", "device"], 50)
