"""Places of rows within ordered groups, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lithos.llm._spark import Scratch, shuffle_partitions


def placed(rows: DataFrame, by: Sequence[str], order: Sequence[str], scratch: Scratch) -> DataFrame:
    """``rows`` with ``place`` (from 0, in ascending ``order`` within the group ``by``, nulls first) and ``members`` (rows of the group).

    Rows are sorted over ranges of ``(by, order)``, so a group that holds most rows lies in many tasks; only
    the counts of each range, of which there are as many as ranges and groups together, meet in a window. ``rows`` should be a
    written table, as its keys are read once more for the ranges. Full ties get places in any order; an empty table gives no rows.
    """
    sorted_rows = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *by, *order).sortWithinPartitions(*by, *order)
    held = scratch.write(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "places").withColumn("_run", F.shiftright("_at", 33))
    runs = held.groupBy(*by, "_run").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    runs = runs.withColumns({"_before": F.sum("_rows").over(whole.orderBy("_run")) - F.col("_rows"), "members": F.sum("_rows").over(whole)})
    runs = runs.select(F.col("_run").alias("_r"), *[F.col(b).alias(f"_by{k}") for k, b in enumerate(by)], "_first", "_before", "members")
    same = F.col("_run") == F.col("_r")
    for k, b in enumerate(by):
        same = same & F.col(b).eqNullSafe(F.col(f"_by{k}"))
    return held.join(runs, same).select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("place"), "members")
