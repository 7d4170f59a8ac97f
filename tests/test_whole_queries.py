"""Queries without SQL over all rows: against plain Python on the smallest tables."""

from bisect import bisect_left

import __spark_entry__ as entry
from lithos.plans.base import units, usage

SF, DAY = "/root/testdata/sf0.001", 86_400_000_000


def micros(t):
    import datetime as dt

    day = dt.datetime(t.year, t.month, t.day, getattr(t, "hour", 0), getattr(t, "minute", 0), getattr(t, "second", 0), getattr(t, "microsecond", 0))
    return (day - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def before(times, t, days):
    return bisect_left(times, t) - bisect_left(times, t - days * DAY)


def grouped(rows, key):
    found = {}
    for r in rows:
        found.setdefault(key(r), []).append(micros(r.time))
    return {k: sorted(v) for k, v in found.items()}


def test_every_unit_has_its_lookback(spark):
    rows = units(spark, SF).select("unit_id", "time", "entity", "layer").collect()
    fleet, layer, own = sorted(micros(r.time) for r in rows), grouped(rows, lambda r: r.layer), grouped(rows, lambda r: r.entity)
    want = sorted((r.unit_id, before(fleet, micros(r.time), 3), before(layer.get("view", []), micros(r.time), 3), before(own[r.entity], micros(r.time), 3)) for r in rows)
    assert sorted(map(tuple, entry.queries()["E3_usage_layer_product"](spark, SF).collect())) == want


def test_every_lot_has_its_usage(spark):
    rows = usage(spark, SF).select("lot", "entity", "recipe", "time").collect()
    own = grouped(rows, lambda r: (r.entity, r.recipe))
    last = {k: max(v) for k, v in grouped(rows, lambda r: (r.lot, r.entity)).items()}
    want = sorted((lot, e, before(own.get((e, "A"), []), t, 20), before(own.get((e, "R"), []), t, 20), before(own.get((e, "R"), []), t, 100)) for (lot, e), t in last.items())
    assert sorted(map(tuple, entry.queries()["E2_usage_by_group"](spark, SF).collect())) == want


def test_mode_all_has_every_row(spark):
    got = entry.queries()["B8_status_filter"](spark, SF).where("mode = 'all'")
    assert sorted(r.unit_id for r in got.collect()) == sorted(r.unit_id for r in units(spark, SF).select("unit_id").collect())


def test_every_key_has_its_last_row(spark):
    best = {}
    for r in usage(spark, SF).collect():
        for src in (r.lot % 2, *([2] if r.recipe == "R" else [])):
            best[r.lot, r.slot] = max(best.get((r.lot, r.slot), (-1,)), (src, r.price, r.part, r.entity))
    want = sorted((lot, slot, v[0], v[1]) for (lot, slot), v in best.items())
    assert sorted(map(tuple, entry.queries()["G2_dedup_keep_last"](spark, SF).collect())) == want
