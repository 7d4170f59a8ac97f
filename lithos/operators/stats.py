"""Spatial metrics, rank tests, outliers, and forests on temporal splits."""

from __future__ import annotations

import math
import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lithos.operators.nearest import nearest_pairs
from lithos.operators.quantiles import value_ranks, with_quantiles
from lithos.operators.scan import HOT_KEYS


def nn_metrics(df: DataFrame, keys: Sequence[str], klass: str, source: str, target: str, point: str, x: str, y: str, near: Sequence[float]) -> DataFrame:
    """Per group with both classes: least, median and 90th percentile of nearest distances, and the shares within each of ``near``."""
    pairs = nearest_pairs(df, keys, klass, source, target, point, x, y)
    base = pairs.groupBy(*keys).agg(F.count("*").alias("n"), F.min("distance").alias("nearest"), *[F.avg((F.col("distance") <= r).cast("int")).alias(f"share_{r:g}") for r in near])
    return with_quantiles(base, pairs, keys, ["distance"], [0.5, 0.9]).withColumnsRenamed({"distance_0.5": "median", "distance_0.9": "p90"})


def nn_permutation(df: DataFrame, keys: Sequence[str], klass: str, source: str, target: str, x: str, y: str, radius: float, n: int, seed: int) -> DataFrame:
    """Permutation p-values of a group's median nearest distance and its share within ``radius``: labels are shuffled n times within the group.

    p = (1 + shuffles at least as extreme) / (n + 1); the seed is drawn from the key, so a result
    doesn't depend on layout. Groups lacking a class have nulls. A group is handled in one task:
    groups are the points of one unit, which are bounded by what an inspection records.
    """
    kinds = dict(df.dtypes)
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys]) + ", n_a long, n_b long, p_median double, p_share double"

    def one(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        at = frame.sort_values([x, y])[[x, y]].to_numpy(float)
        is_a = (frame.sort_values([x, y])[klass] == target).to_numpy()
        is_b = (frame.sort_values([x, y])[klass] == source).to_numpy()
        at, is_a = at[is_a | is_b], is_a[is_a | is_b]
        n_a, n_b = int(is_a.sum()), int((~is_a).sum())
        if not n_a or not n_b:
            return pd.DataFrame([[*key, n_a, n_b, None, None]], columns=[*keys, "n_a", "n_b", "p_median", "p_share"])

        def measure(a: np.ndarray) -> tuple[float, float]:
            best = np.full(len(at) - a.sum(), np.inf)
            others = at[~a]
            for k in range(0, a.sum(), 256):
                part = at[a][k : k + 256]
                best = np.minimum(best, np.sqrt(((others[:, None] - part[None]) ** 2).sum(2)).min(1))
            return float(np.median(best)), float((best <= radius).mean())

        rng = np.random.default_rng([seed, *[zlib.crc32(str(k).encode()) for k in key]])
        seen = measure(is_a)
        more = [measure(rng.permutation(is_a)) for _ in range(n)]
        low, high = sum(m <= seen[0] for m, _ in more), sum(s >= seen[1] for _, s in more)
        return pd.DataFrame([[*key, n_a, n_b, (1 + low) / (n + 1), (1 + high) / (n + 1)]], columns=[*keys, "n_a", "n_b", "p_median", "p_share"])

    return df.groupBy(*keys).applyInPandas(one, schema)


def corr_score(share_wide: str, share_narrow: str, median: str, p: str):
    """0.45 wide share + 0.30 narrow share + 0.25 / (1 + median), times 1 - p."""
    return (0.45 * F.col(share_wide) + 0.30 * F.col(share_narrow) + 0.25 / (1 + F.col(median))) * (1 - F.col(p))


def suspicious(df: DataFrame, n_a: str, n_b: str, p: str, least: int, alpha: float, status: str, score: str, tie: Sequence[str], n: int) -> DataFrame:
    """Groups with enough of both classes and p up to alpha: the first n by score per status."""
    w = Window.partitionBy(status).orderBy(F.desc(score), *tie)
    return df.where((F.col(n_a) >= least) & (F.col(n_b) >= least) & (F.col(p) <= alpha)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def iqr_outliers(df: DataFrame, group: str, value: str, k: float = 1.5) -> DataFrame:
    """Groups with their mean, and whether it lies outside the quartiles of means by k times their distance."""
    means = df.dropna(subset=[group]).groupBy(group).agg(F.avg(value).alias("mean")).dropna()
    q = means.agg(F.percentile("mean", F.lit(0.25)).alias("_q1"), F.percentile("mean", F.lit(0.75)).alias("_q3"))
    low, high = F.col("_q1") - k * (F.col("_q3") - F.col("_q1")), F.col("_q3") + k * (F.col("_q3") - F.col("_q1"))
    return means.join(F.broadcast(q), F.lit(True), "left").withColumn("outlier", (F.col("mean") < low) | (F.col("mean") > high)).drop("_q1", "_q3")


@F.pandas_udf(T.DoubleType())
def _two_sided(z: pd.Series) -> pd.Series:
    return z.abs().map(lambda v: math.erfc(v / math.sqrt(2)), na_action="ignore")


def mann_whitney(df: DataFrame, group: str, value: str, alpha: float, least: int = 3) -> DataFrame:
    """Each group against all others, two-sided: U, p by the tie-corrected normal approximation with continuity, effect 1 - 2U / (n1 n2), the flag, and the medians of the group and of the others.

    Average ranks are counted from distinct values: how many lie below each, in ranges of values whose totals are carried over, so no task
    holds all rows. A median lies in the range that counts point to, the group's own or the table's less these; only such ranges' values are looked at.
    """
    rows = df.dropna(subset=[group, value]).select(group, F.col(value).cast("double").alias("v"))
    own = rows.groupBy(group, "v").agg(F.count("*").alias("c"))
    ranks = value_ranks(own, "v", "c")
    whole = ranks.agg(F.sum("_t").alias("n"), F.sum(F.col("_t").cast("double") ** 3 - F.col("_t")).alias("ties"))
    ranked = own.join(ranks, "v")
    sums = ranked.groupBy(group).agg(F.sum("c").alias("n1"), F.sum(F.col("c") * (F.col("_below") + (F.col("_t") + 1) / 2)).alias("r1"))

    # Of each group and range: how many values of its own and of others lie in it and before it.
    totals = ranks.groupBy("_r").agg(F.sum("_t").alias("_all"))
    mine = ranked.groupBy(group, "_r").agg(F.sum("c").alias("_own"))
    grid = sums.select(group, "n1").join(F.broadcast(totals), F.lit(True)).join(mine, [group, "_r"], "left").join(F.broadcast(whole.select("n")), F.lit(True))
    up = Window.partitionBy(group).orderBy("_r")
    grid = grid.withColumn("_in_own", F.coalesce("_own", F.lit(0))).withColumn("_in_other", F.col("_all") - F.col("_in_own"))
    grid = grid.withColumns({f"_before_{s}": F.sum(f"_in_{s}").over(up) - F.col(f"_in_{s}") for s in ("own", "other")})
    size = {"own": F.col("n1"), "other": F.col("n") - F.col("n1")}
    ends = {s: (F.floor((n - 1) / 2), F.ceil((n - 1) / 2)) for s, n in size.items()}
    has = lambda rank, low, many: (rank >= F.col(low)) & (rank < F.col(low) + F.col(many))
    holds = F.lit(False)
    for s, both in ends.items():
        for e in both:
            holds = holds | has(e, f"_before_{s}", f"_in_{s}")
    asked = grid.where(holds).select(F.col(group).alias("_g"), "_r", "_before_own", "_before_other", "n", "n1")
    there = asked.join(ranks.select("_r", "v", "_t"), "_r").join(own.select(F.col(group).alias("_g"), "v", "c"), ["_g", "v"], "left")
    there = there.withColumn("_c_own", F.coalesce("c", F.lit(0))).withColumn("_c_other", F.col("_t") - F.col("_c_own"))
    inside = Window.partitionBy("_g", "_r").orderBy("v")
    there = there.withColumns({f"_low_{s}": F.col(f"_before_{s}") + F.sum(f"_c_{s}").over(inside) - F.col(f"_c_{s}") for s in ends})
    picked = there.groupBy("_g").agg(*[F.max(F.when(has(e, f"_low_{s}", f"_c_{s}"), F.col("v"))).alias(f"_{s}{k}") for s, both in ends.items() for k, e in enumerate(both)])
    medians = picked.select(F.col("_g").alias(group), ((F.col("_own0") + F.col("_own1")) / 2).alias("median"), ((F.col("_other0") + F.col("_other1")) / 2).alias("others_median"))

    out = sums.join(medians, group, "left")
    out = out.join(F.broadcast(whole), F.lit(True), "left").withColumn("n2", F.col("n") - F.col("n1")).where((F.col("n1") >= least) & (F.col("n2") >= least))
    n1, n2, n = F.col("n1"), F.col("n2"), F.col("n")
    out = out.withColumn("u", F.col("r1") - n1 * (n1 + 1) / 2)
    sd = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    z = F.greatest(F.abs(F.col("u") - n1 * n2 / 2) - 0.5, F.lit(0.0)) / sd
    out = out.withColumn("p", _two_sided(z)).withColumn("effect", 1 - 2 * F.col("u") / (n1 * n2))
    return out.select(group, "n1", "n2", "u", "p", "effect", "median", "others_median", (F.col("p") < alpha).alias("significant"))


def temporal_split(df: DataFrame, time: str, cutoff: str) -> DataFrame:
    """``split``: train up to the cutoff, else the later month as ``yyyy-MM``; rows without a time leave."""
    return df.where(F.col(time).isNotNull()).withColumn("split", F.when(F.col(time) <= F.lit(cutoff).cast("timestamp"), "train").otherwise(F.date_format(time, "yyyy-MM")))


def label_ranks(df: DataFrame, column: str) -> DataFrame:
    """``_label, _rank``: the distinct values of a column as sorted text, from 0. Values run in windows of their first two characters, whose totals are carried."""
    known = df.select(F.col(column).cast("string").alias("_label")).where("_label IS NOT NULL").distinct().withColumn("_head", F.substring("_label", 1, 2))
    heads = known.groupBy("_head").agg(F.count("*").alias("_in"))
    heads = heads.select(F.col("_head").alias("_h"), (F.sum("_in").over(Window.orderBy("_head")) - F.col("_in")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_head").orderBy("_label")) - 1
    return known.withColumn("_i", inside).join(heads, F.col("_head") == F.col("_h")).select("_label", (F.col("_before") + F.col("_i")).alias("_rank"))


def label_encode(df: DataFrame, columns: Sequence[str], train) -> DataFrame:
    """Index of each value (as text) among the sorted training values; unseen ones and null are 0. There may be millions of values.

    A value that most rows have would bring them all to one task of a join. So up to ``HOT_KEYS`` values are broadcast and no row moves;
    of more than that (counted when this is called) those of most rows are, and only rows of the others are joined by value, each value then being rare.
    """
    for c in columns:
        text, rank = F.col(c).cast("string"), F.coalesce("_rank", F.lit(0)).alias(f"{c}_index")
        kept = [F.col(f"`{k}`") for k in df.columns if k != f"{c}_index"]
        names = label_ranks(df.where(train), c)
        held = df.select(text.alias("_held")).where("_held IS NOT NULL").groupBy("_held").agg(F.count("*").alias("_n"))
        if held.limit(HOT_KEYS + 1).count() <= HOT_KEYS:
            df = df.join(F.broadcast(names), text == F.col("_label"), "left").select(*kept, rank)
            continue
        hot = held.orderBy(F.desc("_n"), "_held").limit(HOT_KEYS).join(names, F.col("_held") == F.col("_label"), "left").select("_held", "_rank")
        near = df.join(F.broadcast(hot), text == F.col("_held"), "left").where(F.col("_held").isNotNull() | F.col(c).isNull()).select(*kept, rank)
        far = df.where(F.col(c).isNotNull()).join(F.broadcast(hot.select("_held")), text == F.col("_held"), "left_anti")
        df = near.unionByName(far.join(names, text == F.col("_label"), "left").select(*kept, rank))
    return df


#: Rows of a partition that a forest is trained on: the trainer holds each partition's rows in memory, some 160 bytes a row.
FOREST_ROWS = 50_000


def train_forest(df: DataFrame, features: Sequence[str], rate: str, *, trees: int, depth: int, min_leaf: int, seed: int, folds: int = 0):
    """A random forest for ``rate > 0`` with balanced weights; nulls are 0. Returns the fitted pipeline, and mean AUC over folds if asked.

    Rows are dealt evenly over partitions of ``FOREST_ROWS`` and sorted there, so what a task holds doesn't grow with the table or follow its files.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    data = forest_rows(df, features, rate).select(*features, "label")
    n, share = data.agg(F.count("*"), F.avg("label")).first()
    share = share or 0.5
    data = data.repartition(max(1, math.ceil(n / FOREST_ROWS))).sortWithinPartitions(*features, "label")
    data = data.withColumn("weight", F.when(F.col("label") == 1, 0.5 / max(share, 1e-9)).otherwise(0.5 / max(1 - share, 1e-9)))
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed)
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), forest])
    if not folds:
        return pipeline.fit(data), None
    found = CrossValidator(estimator=pipeline, estimatorParamMaps=ParamGridBuilder().build(), evaluator=BinaryClassificationEvaluator(labelCol="label"), numFolds=folds, seed=seed).fit(data)
    return found.bestModel, found.avgMetrics[0]


def forest_rows(df: DataFrame, features: Sequence[str], rate: str) -> DataFrame:
    return df.fillna(0, [*features, rate]).withColumn("label", (F.col(rate) > 0).cast("double"))


def evaluate(model, df: DataFrame, features: Sequence[str], rate: str, split: str) -> DataFrame:
    """Per split: rows, confusion counts, accuracy, precision, recall and F1 of the positive class and (``_0``) of the other, areas under ROC and precision-recall, and the drop of the former from training."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(forest_rows(df, features, rate)).select(split, "label", "prediction", vector_to_array("probability")[1].alias("p"))
    hit = lambda y, z: F.count_if((F.col("label") == y) & (F.col("prediction") == z))
    base = scored.groupBy(split).agg(F.count("*").alias("n"), hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
    curve = scored.groupBy(split, "p").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    w = Window.partitionBy(split).orderBy(F.desc("p"))
    curve = curve.withColumns({"cp": F.sum("pos").over(w), "cn": F.sum("neg").over(w)})
    areas = curve.groupBy(split).agg(F.sum(F.col("neg") * (F.col("cp") - F.col("pos") / 2)).alias("_roc"), F.sum(F.col("pos") * F.col("cp") / (F.col("cp") + F.col("cn"))).alias("_pr"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    safe = lambda a, b: F.when(b > 0, a / b)
    out = base.join(areas, split).withColumns({"accuracy": (F.col("tp") + F.col("tn")) / F.col("n"), "precision": safe(F.col("tp"), F.col("tp") + F.col("fp")), "recall": safe(F.col("tp"), F.col("tp") + F.col("fn")), "precision_0": safe(F.col("tn"), F.col("tn") + F.col("fn")), "recall_0": safe(F.col("tn"), F.col("tn") + F.col("fp")), "auc_roc": safe(F.col("_roc"), F.col("_p") * F.col("_n")), "auc_pr": safe(F.col("_pr"), F.col("_p"))})
    out = out.withColumns({"f1": safe(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), "f1_0": safe(2 * F.col("tn"), 2 * F.col("tn") + F.col("fp") + F.col("fn"))})
    trained = out.where(F.col(split) == "train").select(F.col("auc_roc").alias("_t"))
    return out.join(F.broadcast(trained), F.lit(True), "left").withColumn("auc_drop", F.col("_t") - F.col("auc_roc")).drop("_roc", "_pr", "_p", "_n", "_t")


def importance_top(model, features: Sequence[str], n: int) -> list[tuple[str, float, int]]:
    """The n features of greatest importance with rank."""
    values = model.stages[-1].featureImportances.toArray()
    order = sorted(range(len(features)), key=lambda i: (-values[i], features[i]))[:n]
    return [(features[i], float(values[i]), k + 1) for k, i in enumerate(order)]
