"""Day tables and their sink, quantiles, rank tests, labels, forests and comparisons against plain Python and hand-made cases."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lithos.operators import aggregate, compare, joins, quantiles, reshape, stats
from lithos.sources.days import DayTable
from lithos.streaming.sink import merge_days


def t(day, hour=0):
    return None if day is None else dt.datetime(2024, 1, day, hour)


def files(path):
    return {p for p in path.rglob("*.parquet")}


def test_a_write_of_one_day_rewrites_one_day(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "t"))
    assert not table.exists() and table.days() == []
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(spark.createDataFrame([(k, t(1 + k % 4, k % 24)) for k in range(40)] + [(99, None)], "k long, t timestamp"), F.col("t"))
    assert len(table.days()) == 5 and table.read().count() == 41
    before = files(tmp_path)
    changed = table.read(["2024-01-02"]).withColumn("extra", F.lit("x"))  # reads what it replaces, and brings a column
    assert table.write(changed, F.col("t")) == ["2024-01-02"]
    kept = [p for p in before if "_day=2024-01-02" not in str(p)]
    assert kept and set(kept) <= files(tmp_path)
    got = table.read()
    assert got.count() == 41 and got.where("extra = 'x'").count() == 10 and got.where("day(t) = 3 AND extra IS NOT NULL").count() == 0
    assert table.read(["2024-01-03"]).count() == 10 and table.read(["2030-01-01"]).count() == 0
    table.write(table.read(["2024-01-01"]).limit(0), F.col("t"), replaced=["2024-01-01"])
    assert "2024-01-01" not in table.days() and table.read().count() == 31
    table.write(spark.createDataFrame([(1, t(9))], "k long, t timestamp"), F.col("t"), keep_others=False)
    assert table.read().count() == 1 and table.read().columns == ["k", "t"]


def test_a_write_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    table = DayTable(spark, str(tmp_path / "t"))
    table.write(spark.createDataFrame([(1, t(1))], "k long, t timestamp"), F.col("t"))
    broken = spark.createDataFrame([(2, t(1))], "k long, t timestamp").withColumn("k", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        table.write(broken, F.col("t"))
    (tmp_path / "t" / "versions" / "000000000002").write_text("{}\n2024-01-01\tdata-x")  # cut off before its last line
    assert [r.k for r in table.read().collect()] == [1]


def test_day_sink_is_idempotent_and_follows_moving_keys(spark, tmp_path):
    run = merge_days(str(tmp_path / "t"), ["k"], [F.col("v")], F.col("t"))
    table = DayTable(spark, str(tmp_path / "t"))
    make = lambda rows: spark.createDataFrame(rows, "k long, t timestamp, v int")
    run(make([(1, t(1), 0), (2, t(1), 0), (3, t(2), 0), (4, None, 0), (4, None, 1)]), 0)
    before = files(tmp_path)
    for _ in range(2):
        run(make([(1, t(3), 5), (3, t(2), 7)]), 1)
        assert sorted((r.k, r.t, r.v) for r in table.read().collect()) == [(1, t(3), 5), (2, t(1), 0), (3, t(2), 7), (4, None, 1)]
    run(make([(2, t(3), 9)]), 2)  # the last row of its day moves
    assert table.days() == ["2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"] and table.read().count() == 4
    assert {p for p in before if "HIVE" in str(p)} <= files(tmp_path)


@pytest.mark.parametrize("hot", [5, 10**9])
def test_quantiles_are_exact(spark, hot):
    rng = random.Random(1)
    data = [(rng.choice(["a"] * 9 + ["b", None]), rng.choice([None, rng.random(), rng.random() * 1e6, 0.5, float(rng.randrange(5))]), rng.random()) for _ in range(900)] + [("only null", None, 1.0), ("one", 3.0, None)]
    df = spark.createDataFrame(data, "k string, x double, y double").repartition(4)
    at = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: r for r in quantiles.quantiles(df, ["k"], ["x", "y"], at, hot_rows=hot).collect()}
    for k in {d[0] for d in data}:
        for i, c in ((1, "x"), (2, "y")):
            values = [d[i] for d in data if d[0] == k and d[i] is not None]
            for q in at:
                if values:
                    assert math.isclose(got[k][f"{c}_{q:g}"], float(np.quantile(values, q)), rel_tol=1e-12), (k, c, q)
                else:
                    assert got[k][f"{c}_{q:g}"] is None
    assert quantiles.quantiles(df.limit(0), ["k"], ["x"], [0.5]).collect() == []


def test_summaries_keep_groups_of_nulls(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("b", 2.0)], "k string, v double")
    assert {r.k: (r.n, r.median, r.std) for r in aggregate.group_describe(df, ["k"], "v").collect()} == {None: (2, 2.0, math.sqrt(2)), "a": (0, None, None), "b": (1, 2.0, None)}
    assert {r.k: (r.n, r.v_median) for r in aggregate.status_summary(df, "k", ["v"]).collect()} == {None: (2, 2.0), "a": (1, None), "b": (1, 2.0)}


def test_rank_test_is_that_of_its_definition(spark):
    rng = random.Random(2)
    data = [(rng.choice("abc"), rng.choice([rng.random(), 0.25, 0.5, rng.random() * 100])) for _ in range(300)] + [("few", 1.0), ("few", 2.0), (None, 1.0), ("a", None)]
    got = {r.g: r for r in stats.mann_whitney(spark.createDataFrame(data, "g string, v double").repartition(3), "g", "v", 0.05).collect()}
    known = [d for d in data if None not in d]
    assert set(got) == set("abc")
    for g in "abc":
        own, other = [v for h, v in known if h == g], [v for h, v in known if h != g]
        u = sum((x > y) + (x == y) / 2 for x in own for y in other)
        n1, n2, n = len(own), len(other), len(known)
        ties = sum(c**3 - c for c in (sum(1 for _, v in known if v == w) for w in {v for _, v in known}))
        sd = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
        z = max(abs(u - n1 * n2 / 2) - 0.5, 0) / sd
        r = got[g]
        assert (r.n1, r.n2) == (n1, n2) and math.isclose(r.u, u) and math.isclose(r.p, math.erfc(z / math.sqrt(2)), rel_tol=1e-9) and math.isclose(r.effect, 1 - 2 * u / (n1 * n2), abs_tol=1e-12)
        assert math.isclose(r["median"], statistics.median(own)) and math.isclose(r.others_median, statistics.median(other)) and r.significant == (r.p < 0.05)


def test_labels_are_ranked_as_sorted_text(spark):
    names = ["b", "a", "aa", "ab1", "ab0", "é", "z" * 9, "", "10", "9", None]
    df = spark.createDataFrame([(i, n, i % 2 == 0 or n == "9") for i, n in enumerate(names * 2)] + [(99, "unseen", False)], "i int, n string, train boolean")
    order = sorted({n for i, n in enumerate(names * 2) if n is not None and (i % 2 == 0 or n == "9")}, key=str.encode)
    for r in stats.label_encode(df, ["n"], F.col("train")).collect():
        assert r.n_index == (order.index(r.n) if r.n in order else 0)


def test_many_labels(spark):
    df = spark.range(30_000).select(F.format_string("%07d", F.col("id") * 7 % 30_000).alias("n"))
    assert stats.label_encode(df, ["n"], F.lit(True)).where("n_index != CAST(n AS INT)").count() == 0


@pytest.mark.parametrize("most", [10_000, 2])
def test_rows_of_a_common_label_stay_apart(spark, monkeypatch, most):
    monkeypatch.setattr(stats, "HOT_KEYS", most, raising=False)
    name = F.expr("CASE WHEN id % 10 < 6 THEN 'b' WHEN id % 10 < 8 THEN NULL WHEN id % 10 = 8 THEN 'unseen' ELSE concat('a', id % 70) END")
    df = spark.range(4000, numPartitions=8).select(F.col("id").alias("a.id"), name.alias("n"), name.alias("m"), F.lit(-1).alias("m_index"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = stats.label_encode(df, ["n", "m"], F.col("n") != "unseen").withColumn("at", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    order = sorted({r.n for r in got if r.n not in (None, "unseen")})
    assert sorted(r["a.id"] for r in got) == list(range(4000)) and len(order) > 3
    assert all(r.n_index == r.m_index == (order.index(r.n) if r.n in order else 0) for r in got)
    assert all(len({r["at"] for r in got if r.n == n}) >= 8 for n in ("b", "unseen", None))


def test_forest_learns_a_rule_and_evaluation_is_by_definition(spark):
    rng = random.Random(3)
    data = [(i, rng.random(), rng.random(), "train" if i % 4 else "2024-05") for i in range(800)]
    df = spark.createDataFrame(data, "i int, a double, b double, split string").withColumn("rate", F.when(F.col("a") > 0.7, 1.0).otherwise(0.0))
    model, _ = stats.train_forest(df.where("split = 'train'"), ["a", "b"], "rate", trees=8, depth=4, min_leaf=3, seed=1)
    top = stats.importance_top(model, ["a", "b"], 1)
    assert top[0][0] == "a" and top[0][2] == 1 and top[0][1] > 0.8
    scored = model.transform(stats.forest_rows(df, ["a", "b"], "rate")).select("split", "label", "prediction", F.expr("1.0").alias("_")).collect()
    for r in stats.evaluate(model, df, ["a", "b"], "rate", "split").collect():
        own = [(s.label, s.prediction) for s in scored if s.split == r.split]
        tp, fp, fn, tn = (sum(1 for x in own if x == c) for c in ((1, 1), (0, 1), (1, 0), (0, 0)))
        assert (r.tp, r.fp, r.fn, r.tn) == (tp, fp, fn, tn) and r.auc_roc > 0.95
        assert math.isclose(r.precision, tp / (tp + fp)) and math.isclose(r.recall, tp / (tp + fn)) and math.isclose(r.f1, 2 * tp / (2 * tp + fp + fn))
        assert math.isclose(r.precision_0, tn / (tn + fn)) and math.isclose(r.recall_0, tn / (tn + fp)) and math.isclose(r.f1_0, 2 * tn / (2 * tn + fp + fn))
    model, auc = stats.train_forest(df, ["a", "b"], "rate", trees=3, depth=3, min_leaf=3, seed=1, folds=2)
    assert auc > 0.9


def test_a_forest_is_trained_on_small_partitions(spark, monkeypatch):
    from pyspark.ml import Pipeline

    monkeypatch.setattr(stats, "FOREST_ROWS", 100, raising=False)
    sizes, fit = [], Pipeline.fit

    def spied(self, data, *rest):
        sizes.extend(r["count"] for r in data.groupBy(F.spark_partition_id().alias("at")).count().collect())
        return fit(self, data, *rest)

    monkeypatch.setattr(Pipeline, "fit", spied)
    df = spark.range(950, numPartitions=1).select(F.col("id").alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") % 3).cast("double").alias("rate"))
    model, _ = stats.train_forest(df, ["a", "b"], "rate", trees=2, depth=2, min_leaf=3, seed=1)
    assert sum(sizes) == 950 and len(sizes) == 10 and max(sizes) <= 100
    assert model.transform(stats.forest_rows(df, ["a", "b"], "rate")).count() == 950


def test_structure_shape_months_and_duplicates(spark):
    a = spark.createDataFrame([(i, "x", float(i)) for i in range(200)], "k long, c string, v double")
    b = a.withColumn("v", F.when(F.col("k") % 2 == 0, F.col("v") + 1).otherwise(F.col("v")))
    whole = compare.structure_check(a, b, ["k"], ["c", "v"], 1).first()
    assert tuple(whole) == (True, True, True, 100)
    some = compare.structure_check(a, b, ["k"], ["c", "gone"], 5).first()
    assert some.has_group is False and 0 < some.n_sample_different < 100
    assert tuple(compare.structure_check(a, b.select("v", "k", "c"), ["k"], ["c"], 1).first())[:3] == (True, False, True)
    assert compare.structure_check(a, b.drop("c"), ["k"], ["c"], 1).first().same_columns is False
    assert tuple(compare.same_shape(a, b.limit(5)).first()) == (200, 5, False, True) and compare.same_shape(a, b.drop("c")).first().same_columns is False
    days = lambda *d: spark.createDataFrame([(dt.datetime(2024, m, 1) if m else None,) for m in d], "t timestamp")
    assert sorted(map(tuple, compare.month_counts(days(1, 1, 2, None), days(2, 3), "t").collect())) == [("2024-01", 2, 0), ("2024-02", 1, 1), ("2024-03", 0, 1)]
    dup = spark.createDataFrame([(1, None), (1, None), (1, "a"), (1, "a"), (1, "a")], "k int, s string")
    assert tuple(compare.duplicate_counts(dup, dup.limit(0)).first()) == (3, 0, False) and tuple(compare.duplicate_counts(dup, dup, ["k"]).first()) == (4, 4, True)


def test_tops_break_ties_by_value(spark):
    df = spark.createDataFrame([("p", "b"), ("p", "a"), ("q", "c"), ("q", "c"), ("q", "a"), (None, "z"), ("r", None), ("s", "a")], "p string, e string")
    assert [tuple(r) for r in aggregate.top_entities(df, ["p"], "e", 5).collect()] == [("a", 2), ("c", 1)]
    assert sorted(map(tuple, aggregate.top_values(df, ["p", "e"], 2).collect())) == [("e", 1, "a", 3), ("e", 2, "c", 2), ("p", 1, "q", 3), ("p", 2, "p", 2)]


def test_excluded_points_of_reports(spark):
    points = spark.createDataFrame([(1, "L"), (2, "L"), (None, "L"), (1, "M"), (9, "other")], "k int, layer string")
    pairs = spark.createDataFrame([(1, "a"), (1, "b")], "k int, path string")
    assert sorted(map(tuple, reshape.excluded_counts(points, pairs, ["k"], "layer", ("L", "M")).collect())) == [("L", 1, 2), ("M", 1, 0)]


def test_sessions_meet_across_stretches(spark):
    rng = random.Random(4)
    left = [(i, rng.choice("ab"), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randrange(0, 300))) for i in range(60)] + [(60, "a", None)]
    right = [(i, rng.choice("ab"), dt.datetime(2024, 1, 1) + dt.timedelta(milliseconds=500 * rng.randrange(0, 600))) for i in range(60)]
    got = joins.session_match(spark.createDataFrame(left, "i int, k string, t timestamp"), spark.createDataFrame(right, "j int, k string, u timestamp"), ["k"], "t", "u", 7)
    assert sorted((r.i, r.j) for r in got.collect()) == sorted((i, j) for i, k, a in left for j, g, b in right if k == g and a is not None and abs((a - b).total_seconds()) <= 7)
