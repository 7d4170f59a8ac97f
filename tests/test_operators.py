"""Small frames for the rules that the SQL oracle over big tables doesn't pin down: nulls, ties and bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lithos.functions import scalar as S
from lithos.operators import aggregate, asof, compare, filters, joins, merge, nearest, order, reshape, stats, windows
from lithos.sources import tables


def t(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_asof_bounds_nulls_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", t(2)), (2, "a", t(1)), (3, "b", t(2)), (4, None, t(2)), (5, "a", None)], "id int, k string, t timestamp")
    right = spark.createDataFrame([("a", t(2), 7), ("a", t(1), 5), (None, t(1), 9), ("a", None, 8)], "k string, rt timestamp, v int")
    assert rows(asof.asof_backward(left, right, ["k"], "t", "rt", ["v"]), "id", "right_v") == [(1, 7), (2, 5), (3, None), (4, None), (5, None)]
    assert rows(asof.asof_backward(left, right, ["k"], "t", "rt", ["v"], strict=True), "id", "right_v") == [(1, 5), (2, None), (3, None), (4, None), (5, None)]
    assert rows(asof.asof_backward(left, right.limit(0), ["k"], "t", "rt", ["v"]), "right_v") == [(None,)] * 5


def test_asof_nearest_prefers_the_earlier(spark):
    left = spark.createDataFrame([(1, "a", t(5))], "id int, k string, t timestamp")
    right = spark.createDataFrame([("a", t(4), 1), ("a", t(6), 2)], "k string, rt timestamp, v int")
    assert rows(asof.asof_nearest(left, right, ["k"], "t", "rt", ["v"]), "near_v") == [(1,)]
    assert rows(asof.asof_nearest(left, right, ["k"], "t", "rt", ["v"], max_hours=1), "near_v") == [(None,)]


def test_lookback_is_half_open(spark):
    df = spark.createDataFrame([(1, "a", t(1)), (2, "a", t(3)), (3, "a", t(3)), (4, None, t(3))], "id int, k string, t timestamp")
    out = windows.lookback(df, ["k"], "t", 2 * windows.DAY, {"n": F.count(F.lit(1))})
    assert rows(out, "id", "n") == [(1, 0), (2, 1), (3, 1), (4, None)]


def test_fleet_lookback_over_empty_days(spark):
    h = spark.createDataFrame([(t(1),), (t(1, 5),), (t(4),), (t(4),)], "t timestamp")
    a = spark.createDataFrame([(1, t(1, 5)), (2, t(3)), (3, t(4)), (4, t(20)), (5, None)], "id int, t timestamp")
    assert rows(windows.fleet_lookback(a, h, "t", 3 * windows.DAY, {"n": F.count(F.lit(1))}), "id", "n") == [(1, 1), (2, 2), (3, 2), (4, 0), (5, None)]


def test_statuses_at_their_bounds(spark):
    df = spark.createDataFrame([(None,), (0.0,), (0.5,), (5.0,), (-1.0,), (9.0,)], "v double")
    got = [tuple(r) for r in df.select(S.status2("v", 5), S.class4("v", 5), S.is_zero("v")).collect()]
    assert got == [("HIGHFLIER", "UNKNOWN", False), ("BSL", "ZERO", True), ("BSL", "BSL", False), ("HIGHFLIER", "HIGHFLIER", False), ("BSL", "HIGHFLIER", False), ("HIGHFLIER", "HIGHFLIER", False)]


def test_rollout_status_of_all_flags(spark):
    df = spark.createDataFrame([("ON", "OFF", "OFF", "ON"), ("OFF", "ON", "OFF", "OFF"), ("OFF", "ON", "ON", "ON"), ("OFF", "OFF", "ON", "OFF"), ("OFF", "OFF", "OFF", "OFF"), ("OFF", None, "ON", "ON"), (None, "x", "ON", None)], "p string, a string, b string, s string")
    got = [r[0] for r in df.select(S.rollout_status("p", ("a", "b"), ("BASE", "A", "B", "A+B"), {"s": "+S"})).collect()]
    assert got == ["PRIORITY", "A", "A+B+S", "B", "BASE", "ERROR+S", "ERROR"]


def test_recipe_groups_in_order(spark):
    df = spark.createDataFrame([(None, "T1", False, "x"), ("m_gab", "T1", False, "x"), ("gab", "T1", True, "a5"), ("gab", "T1", False, "a5"), ("s_gab", "UNKNOWN", False, "a5"), ("gab", "T1", None, None), ("gab", "T2", False, "a5"), ("pil teach", "T2", False, "x"), ("pil", "T2", False, "x")], "r string, t string, test boolean, d string")
    rule = S.recipe_group("r", "t", F.col("test"), "d", monitor_prefixes=["M_", "C_"], monitor_words=["TEACH"], monitor="MON", layer_rule=("T1", "5", "L5"), special_prefix="S_", special_suffix="SIF", keywords={"T1": {"GAB": "1GAB"}, "T2": {"PIL": "2PIL"}})
    assert [r[0] for r in df.select(rule).collect()] == ["OTHER", "MON", "MON", "L5", "NSIF", "1GAB", "OTHER", "MON", "2PIL"]


def test_layers_and_products(spark):
    df = spark.createDataFrame([("L5", "T1", False, "xM5", "A"), ("L5", "T1", True, "xM5", "A"), ("L5", "T2", False, "xM5", "MON"), ("L5", "T1", None, None, None), ("L6", "T1", False, "xM5", "A")], "l string, t string, test boolean, d string, g string")
    got = [tuple(r) for r in df.select(S.layer_match("l", "t", F.col("test"), "d", {"L5": ("T1", ["M5", "MT5"])}), S.is_product(F.col("test"), "g", "MON")).collect()]
    assert got == [(True, True), (False, False), (False, False), (False, True), (False, True)]


def test_text_rules(spark):
    df = spark.createDataFrame([('a,b\t"c"\r\n\x07é', " <x>/\\|?*: ", "A-b_1 é")], "a string, b string, c string")
    assert tuple(df.select(S.clean_text("a"), S.safe_token("b"), S.sanitize_identifier("c")).first()) == ("a;b 'c'   é", "_x_______", "Ab_1")
    with pytest.raises(Exception, match="no identifier"):
        df.select(S.sanitize_identifier(F.lit("--"))).collect()
    sides = spark.createDataFrame([(f"T{k}",) for k in range(10)], "s string").select(S.side("s"))
    assert [r[0] for r in sides.collect()] == [None, "LEFT", "RIGHT", "LEFT", "RIGHT", "LEFT", "RIGHT", None, None, None]
    blank = spark.createDataFrame([(" ", "NaN"), (None, " x ")], "a string, b string").select(S.first_nonblank("a", "b"))
    assert [r[0] for r in blank.collect()] == ["UNKNOWN", "x"]


def test_element_labels(spark):
    df = spark.createDataFrame([(98.6, 1.4, 0.0), (5.0, 5.0, 2.5), (None, -1.0, 0.0)], "si double, c double, o double")
    assert [r[0] for r in df.select(S.element_label({"si": "Si", "c": "C", "o": "O"})).collect()] == ["SiC - (99,1)", "SiCO - (5,5,2)", ""]


def test_image_paths(spark):
    schema = "e string, k string, t timestamp, l string, u string, y string, p double, i string, f string"
    df = spark.createDataFrame([("E1_L", "SMALL", t(5, 6, 7), "LOT1", "ABCDE123", "M:1", 12.0, "3", "x.y/a.TIF"), (None, "FLAKE", None, "L2", "77", None, None, None, None)], schema)
    path = S.image_path("img", entity="e", klass="k", short={"SMALL": "SMP"}, ambiguous=["FLAKE"], time="t", lot="l", unit="u", layer="y", point="p", image="i", file="f", ambiguous_folder="ODD")
    made = df.select(path.alias("path"))
    assert [r[0] for r in made.collect()] == ["img/E1_L/240105_0607_LOT1_123_SMP_M_1_12_3.tif", "img/ODD/FLAKE/UNKNOWN/000000_0000_L2_77_FLAKE_UNKNOWN_0_0.jpg"]
    assert [tuple(r[0]) for r in made.select(S.parse_path("path")).collect()] == [("E1_L", t(5, 6, 7), 12, 3), ("UNKNOWN", None, 0, 0)]


def test_norm_id_and_key(spark):
    df = spark.createDataFrame([(" 12.0 ", t(1)), ("", None), (None, None), ("x.0", t(1)), ("007", None), ("+7", None), ("7e0", None), ("7d", None), ("nan", None), ("1.5", None)], "a string, t timestamp")
    assert [r[0] for r in df.select(S.norm_id("a")).collect()] == ["12", None, None, "x.0", "7", "7", "7", "7d", "nan", "1.5"]
    assert df.select(S.norm_key(["a", "t"], ["t"])).first()[0] == "12|2024-01-01 00:00:00"
    two = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "b")], "x string, y string")
    assert len({r[0] for r in two.select(S.norm_key(["x", "y"])).collect()}) == 3
    assert two.where("x != 'a\\\\'").select(compare.row_hashes(two, ["x", "y"])).distinct().count() == 2


def test_positional_labels_need_whole_blocks(spark):
    df = spark.createDataFrame([(k, "a") for k in range(6)] + [(k, "b") for k in range(3)] + [(k, "c") for k in range(5)], "s int, g string")
    got = {g: [r.label for r in windows.positional_label(df, ["g"], "s", ["X", "Y", "Z"], 2).where(F.col("g") == g).orderBy("s").collect()] for g in "abc"}
    assert got == {"a": ["X", "X", "Y", "Y", "Z", "Z"], "b": ["PARTIAL_RUN"] * 3, "c": ["PARTIAL_RUN"] * 5}


def test_numeric_texts_and_their_flags(spark):
    df = spark.createDataFrame([("1 2", None), ("3", "N"), ("4", "D"), ("5", "Y"), (" ", None), ("6a", "N")], "v string, d string")
    assert rows(filters.numeric_text(df, "v", "d"), "v", "number") == [("1 2", None), ("3", 3.0)]


def test_nearest_within_the_groups_range(spark):
    left = spark.createDataFrame([(1, "a", t(10)), (2, "a", t(12))], "id int, k string, t timestamp")
    right = spark.createDataFrame([("a", t(7), 1), ("a", t(20), 2), ("a", t(14), 3)], "k string, rt timestamp, v int")
    assert rows(asof.asof_nearest(left, right, ["k"], "t", "rt", ["v"], margin_days=2), "id", "near_v") == [(1, 3), (2, 3)]


def test_a_swap_that_died_loses_nothing(spark, tmp_path):
    import os

    from lithos.streaming.sink import merge_batches

    path = str(tmp_path / "t")
    tables.write_table(spark.range(100).selectExpr("id AS k", "1 AS v"), path)
    os.rename(path, path + ".before")  # a crash between the two renames
    merge_batches(path, ["k"], [F.col("v")])(spark.createDataFrame([(7, 2), (200, 2)], "k long, v int"), 0)
    held = spark.read.parquet(path)
    assert held.count() == 101 and held.where("v = 2").count() == 2 and not tables.exists(spark, path + ".before")
    tables.write_table(spark.read.parquet(path).where("k < 5"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 5


def test_runs_split_over_the_gap_only(spark):
    df = spark.createDataFrame([(1, t(1, 0)), (2, t(1, 1)), (3, t(1, 2, 1))], "id int, t timestamp").withColumn("k", F.lit(1))
    assert rows(windows.sessionize(df, ["k"], "t", 60), "id", "run") == [(1, 0), (2, 0), (3, 1)]


def test_intervals_and_rollouts_are_strict(spark):
    unit = spark.createDataFrame([(1, "e", t(5))], "id int, e string, t timestamp")
    parts = spark.createDataFrame([("e", "P", t(5), None, True, "TRUE", 1), ("e", "Q", t(1), t(5), False, "TRUE", 1), ("e", "R", t(1), t(6), False, "FALSE", 1)], "e string, p string, i timestamp, r timestamp, c boolean, v string, k int")
    out = joins.interval_status(unit, "id", "e", "t", parts, "p", "i", "r", "c", "v", ["P", "Q", "R"])
    assert rows(out, "P", "Q", "R", "recoat") == [("NOTFOUND", "NOTFOUND", "FALSE", False)]
    roll = spark.createDataFrame([("e", t(5), t(4))], "e string, f timestamp, g timestamp")
    assert rows(joins.rollout_flags(unit, roll, "e", "t", ["f", "g"], [F.col("f")]), "f_flag", "g_flag") == [("OFF", "ON")]


def test_the_latest_of_installs_at_one_time_is_the_one_of_the_greatest_key(spark, tmp_path):
    from lithos.plans.registry import QUERIES

    spark.createDataFrame([(4, "c")], "c_custkey long, c_name string").write.parquet(str(tmp_path / "customer.parquet"))
    # Keys further apart than the microseconds of a second; all of part K, the last of them without a count.
    keys = [999_999, 1_000_002, 2_000_001, 2_999_994]
    for last in (3, 4):
        day = dt.datetime(1998, 3, 2)
        spark.createDataFrame([(k, 4, day) for k in keys[:last]], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
        got = rows(QUERIES["C17_interval_join_status"](spark, str(tmp_path)), "entity", "K")
        assert got == [(4, str(max(keys[:last]) % 100))]
    unit = spark.createDataFrame([(1, "e", t(5))], "id int, e string, t timestamp")
    parts = spark.createDataFrame([("e", "K", t(1), None, True, None, c, k) for k, c in ((2, 5), (3, None), (1, 9))], "e string, p string, i timestamp, r timestamp, c boolean, v string, k int, key int")
    assert rows(joins.interval_status(unit, "id", "e", "t", parts, "p", "i", "r", "c", "v", ["K"], counted="K", count="k", tie=["key"]), "K") == [("MISSING",)]


def test_session_match_falls_back_only_when_nothing_matches(spark):
    left = spark.createDataFrame([(1, t(1))], "k int, a timestamp")
    right = spark.createDataFrame([(1, t(2)), (1, t(3))], "k int, b timestamp")
    assert joins.session_match(left, right, ["k"], "a", "b", 1).count() == 2
    assert joins.session_match(left, right.unionByName(spark.createDataFrame([(1, t(1))], "k int, b timestamp")), ["k"], "a", "b", 1).count() == 1


def test_merges_are_idempotent_and_ranked(spark):
    a = spark.createDataFrame([("1", "old"), ("2", "old")], "k string, v string")
    b = spark.createDataFrame([(" 1 ", "new"), ("1.0", "newer")], "k string, v string")
    once = merge.keep_last([a, b], ["k"], [F.col("v")])
    assert rows(once, "v") == [("newer",), ("old",)]
    assert rows(merge.keep_last([once, b], ["k"], [F.col("v")]), "v") == rows(once, "v")


def test_periods_and_partial_ends(spark):
    df = spark.createDataFrame([(t(1, 5),), (t(7),), (t(8),), (t(10),), (None,)], "t timestamp")
    got = rows(aggregate.fixed_periods(df, "t", 7), "period", F.col("period_end").cast("string"))
    assert got == [(0, "2024-01-07"), (0, "2024-01-07"), (1, "2024-01-10"), (1, "2024-01-10")]


def test_ratio_and_single_parent(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 0.0), (1.0, None), (1.0, 2.0)], "e double, f double")
    assert [r[0] for r in df.select(windows.ratio("e", "f")).collect()] == [0.0, None, None, 0.5]
    log = spark.createDataFrame([(0, 1, 1, 1), (0, 2, 1, 1)], "period int, lot int, parent int, entity int")
    assert aggregate.fleet_usage(log, "lot", "parent", "entity").first().parent_std is None


def test_prefixes_are_consumed_in_order(spark):
    df = spark.createDataFrame([(1, None, 3)], "`M@X@1` int, `M@1` int, `M@2` int")
    assert filters.coalesce_prefix(df, {"M@X": "x", "M@": "m"}).first().asDict() == {"x": 1, "m": 3}


def test_round_robin_takes_turns(spark):
    df = spark.createDataFrame([(k, "a" if k < 8 else "b", t(1 + k)) for k in range(10)], "id int, e string, t timestamp")
    assert rows(order.round_robin(df, "e", "t", 2, 3, ["id"]), "id") == [(7,), (8,), (9,)]


def test_values_within_tolerance_and_nulls_agree(spark):
    a = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "x")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 1.0 + 1e-12, None), (2, 2.5, None)], "k int, v double, s string")
    assert rows(compare.compare_values(a, b, ["k"], ["v", "s"]), "column", "n_different", "n_null_mismatch") == [("s", 1, 1), ("v", 1, 0)]


def test_image_pairs_need_both(spark):
    m = spark.createDataFrame([(1, 1, "a", t(1)), (1, 1, "b", t(2)), (1, 2, "c", t(1)), (2, 1, "d", t(1)), (2, 2, None, t(1))], "k int, i int, p string, t timestamp")
    assert rows(reshape.image_pairs(m, ["k"], "i", "p", "t", (1, 2)), "k", "path_1", "path_2") == [(1, "b", "c")]


@pytest.mark.parametrize("leaf", [3, 10**6])
def test_nearest_in_crowds_and_empty_regions(spark, monkeypatch, leaf):
    import random

    monkeypatch.setattr(nearest, "LEAF", leaf)
    monkeypatch.setattr(nearest, "FEW", min(leaf, 2048))
    rng = random.Random(4)
    pts = [(k, k % 2, "AB"[k % 3 == 0], rng.uniform(0, 40), rng.uniform(0, 40)) for k in range(150)]
    pts += [(200 + k, 0, "AB"[k % 4 == 0], rng.gauss(7, 1e-4), rng.gauss(7, 1e-4)) for k in range(200)]
    pts += [(500 + k, 0, "B", 400.0 + k, -300.0) for k in range(5)] + [(600 + k, 1, "AB"[k % 2], 5.0, 5.0) for k in range(20)] + [(650 + k, 1, "A", 5.0 + (-1) ** k, 6.0) for k in range(2)]
    pts += [(700, 3, "B", 1.0, 1.0), (701, 4, "A", 1.0, 1.0), (702, 0, "B", None, 1.0), (703, 0, "A", 1.0, None), (704, None, "B", 1.0, 1.0), (705, 0, "C", 1.0, 1.0)]
    got = nearest.nearest_pairs(spark.createDataFrame(pts, "id int, g int, c string, x double, y double").repartition(3), ["g"], "c", "B", "A", "id", "x", "y")
    want = []
    for i, g, c, x, y in pts:
        near = [(((x - u) ** 2 + (y - v) ** 2) ** 0.5, j) for j, h, k, u, v in pts if c == "B" and k == "A" and h == g and g is not None and None not in (x, y, u, v)]
        if near:
            want.append((i, round(min(near)[0], 9), min(near)[1]))
    assert sorted((r.id, round(r.distance, 9), r.near_id) for r in got.collect()) == sorted(want)


def test_permutation_is_stable_and_bounded(spark):
    df = spark.createDataFrame([(1, "A" if k % 2 else "B", float(k), 0.0) for k in range(20)] + [(2, "A", 0.0, 0.0)], "g int, c string, x double, y double")
    run = lambda: rows(stats.nn_permutation(df, ["g"], "c", "B", "A", "x", "y", 1.0, 19, 5), "g", "p_median", "p_share")
    assert run() == run() and 0 < run()[0][1] <= 1 and run()[1] == (2, None, None)


def test_scan_checks_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "x"))
    with pytest.raises(ValueError):
        tables.scan_table(spark, str(tmp_path / "x"), ["id", "gone"])
    assert tables.scan_optional(spark, str(tmp_path / "none"), ["id"]) is None


def test_stream_sink_merges_once(spark, tmp_path):
    from lithos.streaming.sink import merge_batches

    run = merge_batches(str(tmp_path / "t"), ["k"], [F.col("v")])
    batch = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "k int, v int")
    run(batch, 0)
    run(batch, 0)
    assert rows(spark.read.parquet(str(tmp_path / "t")), "k", "v") == [(1, 3), (2, 1)]
