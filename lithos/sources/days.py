"""Tables kept by day, of which a write replaces whole days and readers always find a complete version.

A write puts its days into a folder of its own and then adds a version: a small file, created only if no other write made that version first, which names the folder of
each day. The highest version that ends with its last line is the table; nothing is renamed and nothing a reader may be reading is changed. Folders that neither
this version nor the one before names are deleted after a write, which is also how what failed writes left goes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

_END = "end"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


class DayTable:
    """The table under ``path``. The driver holds a line per day."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        where = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def _read(self, version: str) -> list[str]:
        stream = self._fs.open(self._at(f"versions/{version}"))
        try:
            return bytes(stream.readAllBytes()).decode().split("\n")
        finally:
            stream.close()

    def _versions(self) -> list[tuple[int, dict[str, str]]]:
        """Complete versions, the latest first, two at most."""
        found = []
        for name in sorted(self._names("versions"), reverse=True):
            lines = self._read(name) if name.isdigit() else [""]
            if lines[-1] == _END:
                found.append((int(name), dict(line.split("\t") for line in lines[1:-1])))
            if len(found) == 2:
                break
        return found

    def exists(self) -> bool:
        return bool(self._versions())

    def days(self) -> list[str]:
        """Days of the current version as ``yyyy-MM-dd``, and the name of the null day where rows have none."""
        return sorted(self._versions()[0][1]) if self.exists() else []

    def read(self, days: Sequence[str] | None = None) -> DataFrame:
        """All rows, or those of some days (days that aren't there give none); files of other days aren't opened."""
        versions = self._versions()
        if not versions:
            raise FileNotFoundError(f"{self.path} holds no version")
        schema = self.spark.read.schema(self._schema(versions[0][0]))
        folders = [f"{self.path}/{folder}/_day={day}" for day, folder in sorted(versions[0][1].items()) if days is None or day in days]
        return schema.parquet(*folders) if folders else self.spark.createDataFrame([], self._schema(versions[0][0]))

    def _schema(self, version: int):
        return StructType.fromJson(json.loads(self._read(f"{version:012d}")[0]))

    def write(self, df: DataFrame, day: Column, replaced: Sequence[str] = (), keep_others: bool = True) -> list[str]:
        """Replace the days that ``df`` has rows of and those ``replaced`` besides (``keep_others=False``: all days); returns the days written.

        ``df`` may read the table itself. Columns new to the table are null in days before; types of columns it has must agree.
        """
        versions = self._versions()
        number, held = versions[0] if versions else (0, {})
        folder = f"data-{uuid.uuid4().hex}"
        df.withColumn("_day", day.cast("date")).hint("rebalance", "_day").write.partitionBy("_day").parquet(f"{self.path}/{folder}")
        new = {name.split("=", 1)[1]: folder for name in self._names(folder) if name.startswith("_day=")}
        columns = {f.name: f for f in [*(self._schema(number).fields if versions and keep_others else []), *df.schema.fields]}
        days = {d: f for d, f in held.items() if keep_others and d not in replaced} | new
        lines = [StructType(list(columns.values())).json(), *[f"{d}\t{f}" for d, f in sorted(days.items())], _END]
        stream = self._fs.create(self._at(f"versions/{number + 1:012d}"), False)
        try:
            stream.write(bytearray("\n".join(lines).encode()))
        finally:
            stream.close()
        self._clean()
        return sorted(new)

    def _clean(self) -> None:
        named = {folder for _, days in self._versions() for folder in days.values()}
        for name in self._names(""):
            if name.startswith("data-") and name not in named:
                self._fs.delete(self._at(name), True)


def day_names(df: DataFrame, day: Column) -> list[str]:
    """The days rows fall on, as ``DayTable`` names them."""
    found = df.select(day.cast("date").cast("string").alias("d")).distinct().collect()
    return sorted(_NO_DAY if r["d"] is None else r["d"] for r in found)
