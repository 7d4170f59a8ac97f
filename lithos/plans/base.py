"""Registration of queries, and the roles that the given tables play in them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: The same roles in SQL, put before each query's own.
_ROLES = """
u AS (SELECT event_id AS unit_id, ts AS time, user_id AS entity, event_type AS layer, value AS density_a,
             CASE WHEN event_id % 3 = 0 THEN NULL ELSE value / 2 END AS density_b, 'D' || (user_id % 4) AS device, user_id // 10 AS lot FROM events),
g AS (SELECT l_orderkey AS lot, l_partkey AS part, l_suppkey AS entity, l_linenumber AS slot, l_quantity AS qty, l_extendedprice AS price, l_discount AS discount,
             l_tax AS tax, l_returnflag AS recipe, l_linestatus AS state, l_shipdate AS time FROM lineitem),
p AS (SELECT vec_id AS point_id, label % 3 AS grp, CASE WHEN vec_id % 2 = 0 THEN 'A' ELSE 'B' END AS class, CAST(embedding[1] AS DOUBLE) * 100 AS x, CAST(embedding[2] AS DOUBLE) * 100 AS y FROM embeddings)
"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the roles ``u`` (units), ``g`` (usage) and ``p`` (points) beside the tables."""

    def keep(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            own = sql.strip()
            ORACLE_SQL[name] = f"WITH {_ROLES.strip()}" + (f", {own[5:]}" if own[:5].upper() == "WITH " else f" {own}")
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tables.scan_table(spark, f"{sf_dir}/{name}.parquet")


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as inspected units: two densities, an entity, a layer, a device and a lot."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("unit_id"), F.col("ts").alias("time"), F.col("user_id").alias("entity"), F.col("event_type").alias("layer"), F.col("value").alias("density_a"),
        F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("value") / 2).alias("density_b"), F.concat(F.lit("D"), F.col("user_id") % 4).alias("device"), F.expr("user_id div 10").alias("lot"),
    )


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a usage log: lots processed on entities with a recipe."""
    names = {"l_orderkey": "lot", "l_partkey": "part", "l_suppkey": "entity", "l_linenumber": "slot", "l_quantity": "qty", "l_extendedprice": "price", "l_discount": "discount", "l_tax": "tax", "l_returnflag": "recipe", "l_linestatus": "state", "l_shipdate": "time"}
    return table(spark, sf_dir, "lineitem").withColumnsRenamed(names)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as points of two classes in groups: the first two components, in hundredths."""
    e = table(spark, sf_dir, "embeddings")
    x, y = (F.col("embedding")[k].cast("double") * 100 for k in (0, 1))
    return e.select(F.col("vec_id").alias("point_id"), (F.col("label") % 3).alias("grp"), F.when(F.col("vec_id") % 2 == 0, "A").otherwise("B").alias("class"), x.alias("x"), y.alias("y"))


def us(c: str = "time"):
    """A time as microseconds, the form in which results carry it."""
    return F.unix_micros(c)
