"""All registered queries of the library proper, with the SQL that checks each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lithos.plans import q_aggregate, q_asof, q_filter, q_join, q_merge, q_more, q_scan, q_window  # noqa: F401  (importing registers)
from lithos.plans.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["D5_benchmark_measures"](spark, sf_dir)
