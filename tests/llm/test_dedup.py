import hashlib
import random

import numpy as np
import pytest

from lithos.llm import embedding_dedup, ngram_jaccard, suffix_dedup
from lithos.llm.components import connected_components
from tests.llm.helpers import components, documents, rows, words


def grams_of(text, n):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for blank in "\t\n\v\f\r":
        low = low.replace(blank, " ")
    w = [x for x in low.split(" ") if x]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def check_classes(spark, given, n, percent):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.jaccard_classes(documents(spark, given), n=n, percent=percent).collect() if r.doc_id is not None)
    sets = [(i, grams_of(t, n)) for i, t in given if i is not None]
    links = [(a, b) for k, (a, s) in enumerate(sets) for b, t in sets[:k] if s and t and 100 * len(s & t) >= percent * len(s | t)]
    comp = components({i for i, _ in sets}, links)
    assert got == sorted((i, len(s), comp[i]) for i, s in sets)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (3, 60), (2, 50)])
def test_jaccard_is_brute_force(spark, n, percent):
    rng = random.Random(3)
    base = words(200, 5)
    given = list(rows())
    for k in range(60):  # a group of near copies, some linked only through others
        own = list(base)
        for _ in range(k % 9):
            own[rng.randrange(200)] = f"w{rng.randrange(10**6)}"
        given.append((100 + k, " ".join(own)))
    for k in range(12):  # short texts, and texts that share a passage
        given += [(300 + k, " ".join(base[: 8 + k])), (400 + k, " ".join(base[:100] + words(60, k)))]
    check_classes(spark, given, n, percent)


def test_jaccard_large_cells_and_blocks(spark, monkeypatch):
    for name, value in (("SMALL", 1), ("TILE", 4), ("LEAF", 2)):
        monkeypatch.setattr(ngram_jaccard, name, value)
    base = words(120, 9)
    given = [(k, " ".join(base[: 96 + k % 7] + words(20, k % 11))) for k in range(40)]
    for percent in (60, 80, 90):
        check_classes(spark, given, 3, percent)


def test_jaccard_linked_sets_share_a_cell_that_neither_leaves_out():
    rng, large = np.random.default_rng(4), np.iinfo(np.int64).max
    for percent in (40, 60, 80, 90):
        tried = 0
        for size in (3, 6, 12, 30, 100, 180, 400):
            for _ in range(12):
                one = rng.integers(0, large, size).astype(np.uint64)
                gone = rng.integers(0, 1 + size * (100 - percent) // 100)
                two = np.concatenate([one[gone:], rng.integers(0, large, rng.integers(0, 1 + size * (100 - percent) // 100)).astype(np.uint64)])
                if 100 * len(np.intersect1d(one, two)) < percent * len(np.union1d(one, two)) or set(one) == set(two):
                    continue
                hashes, at = np.concatenate([np.unique(one), np.unique(two)]), np.cumsum([0, len(set(one)), len(set(two))])
                sets, keys = ngram_jaccard.cell_keys(hashes, at, percent)
                spare, salt, kept = ngram_jaccard.spare_cells(hashes, at, percent), int(rng.integers(1 << 60)), []
                shared = np.intersect1d(keys[sets == 0], keys[sets == 1])
                for i in (0, 1):
                    own = keys[sets == i]
                    kinds = {int(k) & 255 for k in own}
                    # The worst order for the pair: shared cells last, where they may be left out.
                    placed = {kind: sorted((k for k in own.tolist() if k & 255 == kind), key=lambda k: (k in shared, hash((k, salt)))) for kind in kinds}
                    kept.append({k for kind, p in placed.items() for k in p[: len(p) - spare[i][1 + kind - spare[i][0]]]})
                assert kept[0] & kept[1], (percent, size)
                tried += 1
        assert tried > 20


def test_jaccard_sets_that_share_only_a_common_line_meet_in_no_tile(spark, monkeypatch):
    monkeypatch.setattr(ngram_jaccard, "SMALL", 4)
    met = []
    tiles = ngram_jaccard._large_links
    monkeypatch.setattr(ngram_jaccard, "_large_links", lambda large, *rest: (met.append(large.count()), tiles(large, *rest))[1])
    line = words(30, 1)
    given = [(k, " ".join(words(150, 100 + k) + line)) for k in range(200)]
    given.append((900, given[7][1] + " and more"))
    check_classes(spark, given, 5, 80)
    assert met == []


def test_jaccard_of_short_sets(spark):
    rng = random.Random(8)
    given = [(k, " ".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(1, 9)))) for k in range(150)]
    for percent in (40, 60, 80):
        check_classes(spark, given, 1, percent)


def test_keep_one_drops_rows_and_not_ids(spark):
    base = " ".join(words(80, 31))
    given = [(1, base), (5, base + " more"), (5, "an unrelated text that stands alone here"), (None, base), (7, None), (8, ""), (9, "twice the same row here"), (9, "twice the same row here")]
    kept = ngram_jaccard.keep_one(documents(spark, given))
    assert kept.columns == documents(spark, []).columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, base), (5, given[2][1]), (7, None), (8, ""), (9, given[6][1])], key=str)
    assert {(r.id, r.row, r.toxicity, r._tokens) for r in kept.collect()} == {(7, None, "x", "y")}


def test_jaccard_of_nothing(spark):
    assert ngram_jaccard.jaccard_classes(documents(spark, [])).collect() == []


def test_sizes_and_null_ids(spark):
    got = {r.doc_id: r for r in ngram_jaccard.jaccard_classes(documents(spark, [(None, "a b c"), (1, None), (2, "a b c")]), n=2, percent=90).collect()}
    assert got[None].n_shingles == 2 and got[None].component_id is None
    assert got[1].n_shingles == 0 and got[1].component_id == 1 and got[2].component_id == 2


def test_components_of_a_long_chain(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def repeats(given):
    seen: dict[bytes, int] = {}
    texts = [(i, (t or "").encode()) for i, t in given]
    for i, b in texts:
        if i is not None:
            for k in range(len(b) - 49):
                s = b[k : k + 50]
                seen[s] = min(seen.get(s, i), i)
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        if i is not None:
            for k in range(len(b) - 49):
                if seen[b[k : k + 50]] < i:
                    gone[k : k + 50] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((str(i), len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("hot", "sample"), [(10_000, 64), (50_000, 1)])
def test_suffix_dedup_is_brute_force(spark, monkeypatch, hot, sample):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", sample)  # 1: all q-grams and ranges are hot
    base = " ".join(words(150, 4))
    given = [*rows(), (20, base), (21, base[:300] + " changed " + base[309:]), (22, "lead " + base[100:260] + " tail"), (23, base), (24, base[:50]), (25, base[:49]), (26, base[1:50] + "!" + base[200:420]), (27, "ab" * 400), (28, "ab" * 90), (5, base[30:200])]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeat_digest(documents(spark, given)).collect())
    assert got == repeats(given)
    kept = sorted((str(r.doc_id), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix_dedup.remove_repeats(documents(spark, given)).collect())
    assert kept == sorted((i, sha) for i, _, _, _, sha in repeats(given))


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.repeat_digest(documents(spark, [])).collect() == []


@pytest.mark.parametrize(("box_bytes", "fan"), [(64 << 20, 16), (1, 2)])
def test_embeddings_are_brute_force(spark, monkeypatch, box_bytes, fan):
    monkeypatch.setattr(embedding_dedup, "TILE", 8)
    monkeypatch.setattr(embedding_dedup, "BOX_BYTES", box_bytes)  # 1: boxes meet over all levels of runs
    monkeypatch.setattr(embedding_dedup, "FAN", fan)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 64))
    x[40:80] = x[3] + rng.normal(size=(40, 64)) * 0.2  # a crowd around the limit
    x[80:90] = x[5]
    given = [(k, [float(np.float32(v)) for v in row]) for k, row in enumerate(x)]
    odd = [(200, None), (201, [0.0] * 64), (202, [float("nan")] + [1.0] * 63), (203, [None] + [1.0] * 63), (204, []), (None, [1.0] * 64), (205, [float("inf")] + [1.0] * 63)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in given + odd], "vec_id long, embedding array<float>, id long, links long")
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, limit=0.95).collect()}
    import pandas as pd

    want = embedding_dedup.brute_force([i for i, _ in given], pd.Series([v for _, v in given]), 0.95)
    assert {i: got[i].n_links for i in want} == want and sum(want.values()) > 100
    v = np.array([v for _, v in given])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    comp = components(list(want), [(a, b) for a, b in zip(*np.nonzero(v @ v.T >= 0.95), strict=True) if a < b])
    assert {i: got[i].component_id for i in want} == comp
    for i in (200, 201, 202, 203, 204, 205):
        assert got[i].n_links == 0 and got[i].component_id == i
    assert got[None].n_links == 0 and got[None].component_id is None


def test_embeddings_of_all_lengths_and_sizes(spark):
    given = [*[(k, [1.0, 2.0, 3.0, 4.0]) for k in range(5)], (10, [1.0] * 8), (11, [2.0] * 8), (12, [1e-200] * 8), (13, [1e200] * 8), (20, [1.0]), (21, [-1.0]), (22, [5e-324])]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df, limit=0.95).collect()}
    assert got == {**{k: (4, 0) for k in range(5)}, **{k: (3, 10) for k in range(10, 14)}, 20: (1, 20), 21: (0, 21), 22: (1, 20)}


@pytest.mark.parametrize("partners", [0, 1_000])
def test_embeddings_are_brute_force_whether_tiles_travel_or_not(spark, monkeypatch, partners):
    for name, value in (("TILE", 8), ("BOX_BYTES", 1), ("FAN", 4), ("STRIP", 3), ("CHUNK", 5), ("PARTNERS", partners)):
        monkeypatch.setattr(embedding_dedup, name, value)
    ways, meeting = [], embedding_dedup._meeting
    monkeypatch.setattr(embedding_dedup, "_meeting", lambda *given: ways.append(meeting(*given)) or ways[-1])
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 32))
    x[30:60] = x[3] + rng.normal(size=(30, 32)) * 0.2
    x[60:80] = x[5]
    df = spark.createDataFrame([(k, [float(v) for v in row]) for k, row in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df, limit=0.95).collect()}
    assert [w is None for w in ways] == [partners == 0] * 2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    comp = components(list(range(90)), [(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b])
    assert got == {k: (int(near[k].sum()), comp[k]) for k in range(90)} and near.sum() > 600


def shuffled(spark):
    """Bytes that the session's stages have written to shuffles so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))


def test_embeddings_that_meet_all_others_shuffle_in_step_with_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 256)
    x = np.random.default_rng(7).normal(size=(3000, 64)).astype(np.float32)
    df = spark.createDataFrame([(k, row.tolist()) for k, row in enumerate(x)], "vec_id long, embedding array<float>")
    before = shuffled(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables beyond it
    try:
        assert {r.n_links for r in embedding_dedup.near_duplicates(df, limit=0.95).collect()} == {0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < shuffled(spark) - before < 8 * x.nbytes


def test_embeddings_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_duplicates(empty).collect() == []
