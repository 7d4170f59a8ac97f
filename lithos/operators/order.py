"""Orders, limits and samples that are the feature asked for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mixed_order(keys: Sequence[tuple[str, bool]]) -> list[Column]:
    """Ascending (True) or descending keys, nulls last either way."""
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in keys]


def top_n(df: DataFrame, status: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first n overall (``scope`` overall) and per status."""
    overall = df.orderBy(*order).limit(n).withColumn("scope", F.lit("overall"))
    each = df.withColumn("_r", F.row_number().over(Window.partitionBy(status).orderBy(*order))).where(F.col("_r") <= n).drop("_r")
    return overall.unionByName(each.withColumn("scope", F.col(status).cast("string")))


def latest_active(df: DataFrame, entity: str, time: str, n: int) -> DataFrame:
    return df.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.max(time).alias("last_time")).orderBy(F.desc("last_time"), entity).limit(n)


def round_robin(df: DataFrame, entity: str, time: str, entities: int, n: int | None, key: Sequence[str]) -> DataFrame:
    """All rows of n distinct keys (None: all), newest first and evenly over the most recently active entities: one key of each per turn.

    A key counts for the entity of its newest row; rows without an entity are left out.
    """
    active = latest_active(df, entity, time, entities).withColumn("_er", F.row_number().over(Window.orderBy(F.desc("last_time"), entity))).drop("last_time")
    known = df.join(F.broadcast(active), entity)
    if n is None:
        return known.drop("_er")
    first = known.groupBy(*key).agg(F.max(F.struct(F.col(time).alias("t"), (-F.col("_er")).alias("r"))).alias("_x")).select(*key, F.col("_x.t").alias("_t"), (-F.col("_x.r")).alias("_er"))
    turn = F.row_number().over(Window.partitionBy("_er").orderBy(F.desc("_t"), *key))
    chosen = first.withColumn("_rn", turn).where(F.col("_rn") <= n).orderBy("_rn", "_er").limit(n).select(*key, "_er")
    return known.join(F.broadcast(chosen), [*key, "_er"]).drop("_er")
