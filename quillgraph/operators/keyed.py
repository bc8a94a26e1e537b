"""A table with a key, in parts by the key's hash: an upsert reads and writes the parts that new rows fall into, and no others.

Each part lies in a folder of its own; a commit tells which folder holds which part. New parts are written beside the old ones and the commit follows, so
readers see all of an upsert or nothing of it, and files of other parts stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import commits
from .upsert import last_by_key


@dataclass(frozen=True)
class Keyed:
    """parts: how many; a part is to be read and written by a few tasks. by: a whole number for each row from its key alone; the key's hash, if not given."""

    spark: SparkSession
    path: str
    key: tuple[str, ...]
    parts: int = 64
    by: Callable[[], Column] | None = None

    def _part(self) -> Column:
        return F.pmod(self.by() if self.by else F.xxhash64(*self.key), F.lit(self.parts)).cast("int")

    def _told(self) -> dict:
        return commits.current(self.spark, self.path) or {"number": 0, "parts": {}, "schema": None}

    def _read(self, told: dict, parts: list[str]) -> DataFrame | None:
        at = [f"{self.path}/version={told['parts'][p]}/part={p}" for p in parts if p in told["parts"]]
        if not at:
            return None
        return self.spark.read.schema(f"{told['schema']}, version string, part int").option("basePath", self.path).parquet(*at).drop("version", "part")

    def read(self) -> DataFrame | None:
        """All rows; None before the first write."""
        told = self._told()
        return self._read(told, sorted(told["parts"]))

    def part_numbers(self) -> dict[int, str]:
        """The folder that each part is in now."""
        return {int(p): v for p, v in self._told()["parts"].items()}

    def merge(self, new: DataFrame, combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> list[int]:
        """Put combine(old rows of the parts that new rows fall into, new rows) in the place of these parts; the parts' numbers. The columns stay as they are."""
        told, part = self._told(), self._part()
        touched = sorted(str(r[0]) for r in new.select(part.alias("p")).distinct().collect())  # `parts` numbers at most
        if not touched:
            return []
        rows = combine(self._read(told, touched), new)
        version = commits.fresh()
        rows = rows.withColumn("part", part).repartitionById(self.parts, "part")  # a task for each: hashed, several parts would meet in one
        rows.write.partitionBy("part").parquet(f"{self.path}/version={version}")
        schema = told["schema"] or ", ".join(f"`{n}` {t}" for n, t in new.dtypes)
        commits.commit(self.spark, self.path, {"parts": told["parts"] | dict.fromkeys(touched, version), "schema": schema}, told["number"])
        return [*map(int, touched)]

    def upsert(self, new: DataFrame, order: list[str]) -> list[int]:
        """Rows of new in the place of those with their key; of new rows with one key the last in this order counts."""

        def combine(old: DataFrame | None, rows: DataFrame) -> DataFrame:
            last = last_by_key(rows, [*self.key], order)
            return last if old is None else old.join(last, [*self.key], "left_anti").unionByName(last)

        return self.merge(new, combine)

    def vacuum(self) -> int:
        """Delete versions of parts that aren't current; readers that began before lose them."""
        return commits.vacuum(self.spark, self.path, {f"version={v}" for v in self.part_numbers().values()})
