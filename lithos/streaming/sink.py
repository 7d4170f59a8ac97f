"""``foreachBatch`` sinks that merge each micro-batch over what a table holds."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from lithos.functions.scalar import norm_key
from lithos.operators.merge import keep_last
from lithos.sources.days import DayTable, day_names
from lithos.sources.tables import exists, recover_table, write_table


def merge_batches(path: str, keys: Sequence[str], tie: Sequence[Column]) -> Callable[[DataFrame, int], None]:
    """For ``writeStream.foreachBatch``: the new batch wins on equal keys; a batch that runs again changes nothing.

    Each batch writes the whole table anew and swaps it in; a swap that died is finished first, so nothing held is lost.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        recover_table(spark, path)
        held = spark.read.parquet(path) if exists(spark, path) else batch.limit(0)
        write_table(keep_last([held, batch], keys, tie), path)

    return run


def merge_days(path: str, keys: Sequence[str], tie: Sequence[Column], day: Column, moving: bool = True) -> Callable[[DataFrame, int], None]:
    """As ``merge_batches`` over a ``DayTable``: only days that the batch has rows of are read and written.

    ``moving`` keys may come again on another day: then days that hold a key of the batch are found by a scan of keys alone, and
    rewritten too. Without it the day must follow from the key. Readers see the table before or after a batch, never between.
    """

    def run(batch: DataFrame, number: int) -> None:
        table = DayTable(batch.sparkSession, path)
        if not table.exists():
            table.write(keep_last([batch], keys, tie), day)
            return
        batch = batch.persist()
        try:
            touched = set(day_names(batch, day))
            if moving:
                known = table.read().withColumn("_key", norm_key(keys)).join(batch.select(norm_key(keys).alias("_key")).distinct(), "_key", "left_semi")
                touched |= set(day_names(known, day))
            merged = keep_last([table.read(sorted(touched)), batch], keys, tie)
            table.write(merged, day, replaced=sorted(touched))
        finally:
            batch.unpersist()

    return run
