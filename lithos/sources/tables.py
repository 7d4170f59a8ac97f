"""Scans and sinks: checked reads, windows of time, unions, recent exports, run reports and freshness."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, path: str, required: Sequence[str] = (), fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """A table with its required columns checked; zone-less timestamps become timestamps in the session's zone (UTC here)."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    plain = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain}) if plain else df


def scan_optional(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame | None:
    """As ``scan_table``; None where path or columns are missing, so that an enrichment is left out."""
    from pyspark.errors import AnalysisException

    try:
        return scan_table(spark, path, required)
    except (AnalysisException, ValueError):
        return None


def scan_window(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= time < end``; null times leave. The bounds reach the scan."""
    return df.where((F.col(time) >= F.lit(start).cast("timestamp")) & (F.col(time) < F.lit(end).cast("timestamp")))


def union_sources(parts: Sequence[DataFrame], common_only: bool = False) -> DataFrame:
    """Tables under each other by column name; missing columns are null, or only common columns stay."""
    if common_only:
        names = [c for c in parts[0].columns if all(c in p.columns for p in parts)]
        parts = [p.select(names) for p in parts]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def fetch_summary(df: DataFrame, columns: dict[str, str], *, entity: str, entities: Iterable, layer: str, suffix: str | None = None, layers: Iterable | None = None, time: str, since: str, until: str | None = None) -> DataFrame:
    """A projected summary scan: entities, layers by list or by ending, times from ``since`` up to ``until``."""
    keep = F.col(entity).isin(list(entities)) & (F.col(time) >= F.lit(since).cast("timestamp"))
    keep &= F.col(layer).like(f"%{suffix}") if suffix is not None else F.col(layer).isin(list(layers or []))
    if until is not None:
        keep &= F.col(time) <= F.lit(until).cast("timestamp")
    return df.where(keep).select([F.col(c).alias(new) for c, new in columns.items()])


def fetch_by_prefix(df: DataFrame, prefixes: DataFrame, text: str, prefix: str, length: int, digits: str | None = None) -> DataFrame:
    """Rows whose text begins with one of a table's prefixes of equal length; ``digits`` must hold digits and blanks only."""
    keys = prefixes.select(F.substring(prefix, 1, length).alias("_prefix")).distinct()
    out = df.join(keys, F.substring(text, 1, length) == F.col("_prefix"), "left_semi")
    return out.where(F.col(digits).rlike("^[0-9 ]*$")) if digits else out


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order``, which has to be total."""
    from pyspark.sql import Window

    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share: ``spark.checkpoint.dir``, or one of our own where both are one process (``local[...]``)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="lithos-")
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish a swap that died between its two renames: the table set aside takes its place again."""
    if not exists(spark, path) and exists(spark, path + ".before"):
        fs, where = _file_system(spark, path)
        fs.rename(_file_system(spark, path + ".before")[1], where)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """A full overwrite by way of a folder beside it: ``df`` may itself read ``path``, and a failed write leaves ``path`` as it was.

    The new folder is written whole, then the old one is set aside and the new one renamed. A crash between the two renames
    leaves the old table as ``path.before``; ``recover_table`` (or the next write) puts it back.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    fs, where = _file_system(spark, path)
    fresh, before = (_file_system(spark, path + end)[1] for end in (".new", ".before"))
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(str(fresh))
    fs.delete(before, True)
    if fs.exists(where) and not fs.rename(where, before):
        raise OSError(f"could not set {path} aside")
    if not fs.rename(fresh, where):
        fs.rename(before, where)
        raise OSError(f"could not rename the new table to {path}")
    fs.delete(before, True)


def export_recent(df: DataFrame, time: str, days: int) -> DataFrame:
    """Rows not older than ``days`` before the latest; one broadcast row holds the bound."""
    bound = df.agg((F.max(time) - F.make_dt_interval(F.lit(days))).alias("_from"))
    return df.join(F.broadcast(bound), F.col(time) >= F.col("_from")).drop("_from")


def run_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, values that aren't null, and nulls, from a single pass."""
    once = df.agg(F.count("*").alias("n_rows"), *[F.count(c).alias(c) for c in columns])
    return once.unpivot("n_rows", list(columns), "column", "n_values").withColumn("n_nulls", F.col("n_rows") - F.col("n_values"))


def freshness(sources: dict[str, tuple[DataFrame, str]], reference: str, max_days: float) -> DataFrame:
    """Per source its latest time's age in days before ``reference``, and whether that is within ``max_days`` (an empty source isn't)."""
    out = None
    for name, (df, time) in sources.items():
        age = (F.unix_micros(F.lit(reference).cast("timestamp")) - F.unix_micros(F.max(time))) / 86_400_000_000
        one = df.agg(F.lit(name).alias("source"), age.alias("age_days"))
        out = one if out is None else out.unionByName(one)
    return out.withColumn("fresh", F.coalesce(F.col("age_days") <= max_days, F.lit(False)))


def scan_scope(df: DataFrame, *, event: str, recipes: dict[str, str], time: str, since: str, slot: str, required: Sequence[str]) -> DataFrame:
    """Recent rows whose event has an expected recipe, with that recipe, an integer slot and no null key."""
    expected = F.create_map(*[F.lit(x) for pair in recipes.items() for x in pair])
    out = df.where(F.col(event).isin(list(recipes)) & (F.col(time) >= F.lit(since).cast("timestamp")))
    return out.withColumn("expected_recipe", F.try_element_at(expected, F.col(event))).withColumn(slot, F.col(slot).try_cast("int")).dropna(subset=list(required))
