"""Hot keys: cut scans, interval trees and matches give what plain Python gives, and no key makes a long window."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lithos.operators import asof, joins, scan, windows

BASE = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else BASE + dt.timedelta(minutes=minutes)


def sides(seed, n=400):
    """Left and right rows of which nine in ten have one key, with ties, nulls and a key on one side only."""
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot"] * 18 + ["b", None])
    minute = lambda: rng.choice([None, *range(0, 600, 3)]) if rng.random() < 0.9 else rng.randrange(5000)
    left = [(i, key(), at(minute())) for i in range(n)] + [(n, "left only", at(5))]
    right = [(key(), at(minute()), f"{i:05d}", None if rng.random() < 0.3 else i, rng.choice("xy")) for i in range(n)] + [("right only", at(5), "z", 1, "x")]
    return left, right


@pytest.fixture(params=[7, 10**9])
def hot(request, monkeypatch):
    monkeypatch.setattr(scan, "HOT_ROWS", request.param)


def frames(spark, left, right):
    return spark.createDataFrame(left, "id int, k string, t timestamp").repartition(3), spark.createDataFrame(right, "k string, rt timestamp, tie string, v int, kind string").repartition(3)


def before(right, k, t, strict=False, keep=lambda r: True):
    """The last right row at or before, the greatest tie at one time."""
    found = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and (r[1] < t if strict else r[1] <= t) and keep(r)]
    return max(found, key=lambda r: (r[1], r[2])) if found else None


def after(right, k, t, keep=lambda r: True):
    found = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] >= t and keep(r)]
    return min(found, key=lambda r: (r[1], r[2])) if found else None


def nearest(right, k, t, keep=lambda r: True):
    b, a = before(right, k, t, keep=keep), after(right, k, t, keep)
    return b if b and (not a or t - b[1] <= a[1] - t) else a


def collected(df, *columns):
    return {r["id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_backward_and_kinds_and_fill_over_a_hot_key(spark, hot):
    left, right = sides(1)
    l, r = frames(spark, left, right)  # noqa: E741
    for strict in (False, True):
        got = collected(asof.asof_backward(l, r, ["k"], "t", "rt", ["v"], tie="tie", strict=strict), "right_time", "right_v")
        assert got == {i: ((m[1], m[3]) if (m := before(right, k, t, strict)) else (None, None)) for i, k, t in left}
    got = collected(asof.asof_by_kind(l, r, ["k"], "t", "rt", "kind", ["x", "y"], "v", tie="tie"), "x", "y")
    assert got == {i: tuple((m[3] if (m := before(right, k, t, keep=lambda q, s=s: q[4] == s)) else None) for s in "xy") for i, k, t in left}
    got = collected(asof.asof_ffill(l, r, ["k"], "t", "rt", ["v"], tie="tie"), "right_v", "right_time")
    assert got == {i: ((m[3] if (m := before(right, k, t, keep=lambda q: q[3] is not None)) else None), (m[1] if (m := before(right, k, t)) else None)) for i, k, t in left}


def test_nearest_and_fallback_chain_over_a_hot_key(spark, hot):
    left, right = sides(2)
    l, r = frames(spark, left, right)  # noqa: E741
    got = collected(asof.asof_nearest(l, r, ["k"], "t", "rt", ["v"], tie="tie"), "near_time", "near_v")
    assert got == {i: ((m[1], m[3]) if (m := nearest(right, k, t)) else (None, None)) for i, k, t in left}
    events = l.withColumns({"matched": F.col("id") % 2 == 0, "v": F.when(F.col("id") % 4 == 0, -1)})
    want = {}
    for i, k, t in left:
        v, source = (-1 if i % 4 == 0 else None), "EVENT"
        if i % 4:
            has = before(right, k, t)
            fill = before(right, k, t, keep=lambda q: q[3] is not None)
            any_, own = nearest(right, k, t), nearest(right, k, t, lambda q: q[3] is not None)
            v = fill[3] if fill else (any_[3] if any_[3] is not None else own[3] if own and abs(own[1] - t) <= dt.timedelta(hours=1) else None) if has else None
            source = "INSPECTION" if has and v is not None else "UNMATCHED"
        want[i] = (v, source)
    assert collected(asof.asof_fallback_chain(events, r.select("k", "rt", "tie", "v"), ["k"], "t", "rt", ["v"], "matched", tie="tie", max_hours=1), "v", "source") == want


def test_margin_is_of_the_groups_own_range(spark, hot):
    left, right = sides(3, 60)
    l, r = frames(spark, left, right)  # noqa: E741
    right = [q for q in right if q[0] is not None and q[1] is not None]
    spans = {k: [t for _, g, t in left if g == k and t is not None] for k in {x[1] for x in left}}
    day = dt.timedelta(days=1)
    keep = lambda k: lambda q: min(spans[k]) - day <= q[1] <= max(spans[k]) + day
    got = collected(asof.asof_nearest(l, r, ["k"], "t", "rt", ["v"], tie="tie", margin_days=1), "near_time")
    assert got == {i: ((m[1],) if k is not None and t is not None and (m := nearest(right, k, t, keep(k))) else (None,)) for i, k, t in left}


def test_a_hot_key_is_cut_into_many_even_stretches(spark):
    rows = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 1000).alias("us")).unionByName(spark.range(50).select(F.lit("cold").alias("k"), F.col("id").alias("us")))
    got = {(r.k, r._stretch): r["count"] for r in scan.cut_hot(rows, scan.hot_keys(rows, ["k"], "us", hot_rows=1000), ["k"], "us").groupBy("k", "_stretch").count().collect()}
    assert got.pop(("cold", 0)) == 50 and sum(got.values()) == 20_000 and max(got.values()) <= 1000 and len(got) >= 20


def test_trend_rates_with_one_layer_for_all_rows(spark, hot):
    rng = random.Random(4)
    data = [(i, rng.choice(["L", "L", "L", None]) if i % 50 == 0 else "L", f"lot{i % 40}", rng.choice("ab"), at(rng.randrange(0, 20_000, 30)) if i % 31 else None, rng.choice([0.0, 1.0, None])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, layer string, lot string, entity string, t timestamp, d double").repartition(3)
    got = collected(windows.trend_rates(df, group=["layer", "lot"], scopes={"fleet": ["layer"], "own": ["layer", "entity"]}, time="t", days=[2, 7], measures={"d": "d"}, zero=0), "fleet_count_2d", "fleet_count_7d", "fleet_d_count_7d", "own_count_7d")
    for i, layer, lot, _, _, _ in data:
        group = [r for r in data if r[1] == layer and r[2] == lot and r[4] is not None]
        if layer is None or not group:
            assert got[i] == (None,) * 4
            continue
        t0 = min(r[4] for r in group)
        entity = min(r[3] for r in group if r[4] == t0)
        past = lambda days, keep=lambda r: True: sum(1 for r in data if r[1] == layer and r[4] is not None and t0 - dt.timedelta(days=days) <= r[4] < t0 and keep(r))  # noqa: B023, E731
        assert got[i] == (past(2), past(7), past(7, lambda r: r[5] != 0), past(7, lambda r, e=entity: r[3] == e)), i


@pytest.mark.parametrize("few", [0, 20, 10**6])
def test_pairs_of_intervals_meet_once(spark, monkeypatch, few):
    monkeypatch.setattr(joins, "_FEW", few)
    rng = random.Random(5)
    day = 1440
    rows = [(i, rng.choice(["hot", "hot", "hot", "b", None]), at(rng.choice([None, rng.randrange(-200 * day, 400 * day), rng.randrange(0, 40) * day]))) for i in range(200)]
    parts = []
    for j in range(150):
        a = rng.randrange(-300 * day, 300 * day) if j % 2 else rng.randrange(0, 30) * day
        parts.append((j, rng.choice(["hot", "hot", "c", None]), at(None if j % 40 == 7 else a), at(None if j % 10 == 0 else a + rng.choice([-5, 0, 1, day, 17 * day, 300 * day]))))
    parts.append((150, "hot", dt.datetime(1950, 1, 1), dt.datetime(2200, 1, 1)))
    got = joins.stabbed(spark.createDataFrame(rows, "id int, k string, t timestamp"), "k", "t", spark.createDataFrame(parts, "j int, e string, a timestamp, b timestamp"), "e", "a", "b")
    want = sorted((i, j) for i, k, t in rows for j, e, a, b in parts if k is not None and k == e and t is not None and a is not None and t > a and (b is None or t < b))
    assert sorted((r.id, r.j) for r in got.collect()) == want and len(want) > 500


def test_a_cover_has_few_cells_and_each_day_once(spark):
    rng = random.Random(7)
    spans = [(a, a + rng.choice([0, 1, 5, 100, 4000])) for a in (rng.randrange(-5000, 40_000) for _ in range(60))]
    df = spark.createDataFrame(spans, "lo long, hi long").withColumn("cells", joins._tree_cells("lo", "hi"))
    for r in df.collect():
        days = sorted(d for level, cell in r.cells for d in range(cell * 4**level, (cell + 1) * 4**level))
        assert days == list(range(r.lo, r.hi + 1)) and len(r.cells) <= 6 * 7


def test_match_with_fallback_against_pairs(spark, hot):
    rng = random.Random(6)
    left = [(i, rng.choice(["hot", "hot", "hot", "b", "none", None]), at(rng.choice([None, *range(0, 300, 5)])), rng.choice(["x", "y", "never", None])) for i in range(150)]
    events = [(j, rng.choice(["hot", "hot", "b", None]), at(rng.choice([None, *range(0, 300, 10)])), rng.choice(["x", "z", None]), rng.choice(["y", "x", None])) for j in range(120)]
    got = joins.match_with_fallback(spark.createDataFrame(left, "id int, k string, t timestamp, want string"), spark.createDataFrame(events, "ev int, k string, et timestamp, r1 string, r2 string"), ["k"], ["id"], "t", "et", "want", ["r1", "r2"], ["ev"], ["ev"])
    want = {}
    for i, k, t, w in left:
        own = [e for e in events if k is not None and e[1] == k and e[2] is not None]
        exact = [e for e in own if w is not None and w in (e[3], e[4])]
        some = [e for e in (exact or own) if t is not None and e[2] <= t]
        best = min(some, key=lambda e: (-e[2].timestamp(), e[0])) if some else None
        want[i] = (best[0], best[2], int(not exact)) if best else (None, None, None)
    assert collected(got, "ev", "et", "recipe_fallback") == want
