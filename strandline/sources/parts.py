"""Tables in folders by part, of which a change rewrites only the parts it touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.slices import ensure_checkpoints


class PartedTables:
    """Tables under a path, in folders by part: the crawl and one of so many buckets of a key.

    A change gives the new rows of some parts. Spark's dynamic overwrite stages them and swaps the folders when all tasks are done, so
    failed tasks and lost executors leave the old parts; a driver that dies within that swap may leave a part without rows.
    One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str = "batch_id", buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        ensure_checkpoints(spark)

    def part(self) -> Column:
        """A text in any case, so that nobody takes it for a number."""
        return F.concat_ws("_", F.lit("part"), F.col("crawl_id"), F.pmod(F.xxhash64(self.key), F.lit(self.buckets)))

    def create(self, name: str, rows: DataFrame) -> None:
        """A table without a part is kept as one of none, so that its columns are known."""
        placed = rows.withColumn("part", self.part())
        placed.limit(0).drop("part").write.mode("overwrite").parquet(f"{self.path}/{name}/part=none")
        self._write(name, placed)

    def read(self, name: str, parts: list[str] | None = None) -> DataFrame:
        """A table, or some of its parts, with the column part."""
        rows = self.spark.read.parquet(f"{self.path}/{name}")
        return rows if parts is None else rows.filter(F.col("part").isin(parts))

    def replace(self, name: str, rows: DataFrame, parts: list[str]) -> None:
        """Give these parts new rows; those of them that have none left go."""
        known = self.read(name).columns
        new = rows.withColumn("part", self.part()).select(*known).checkpoint()
        left = {r.part for r in new.select("part").distinct().collect()}
        if not left <= set(parts):
            raise ValueError(f"rows of other parts: {sorted(left - set(parts))[:3]}")
        if left:
            self._write(name, new)
        for part in set(parts) - left:
            self._drop(f"{self.path}/{name}/part={part}")

    def _write(self, name: str, rows: DataFrame) -> None:
        spread = rows.hint("rebalance", "part")
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(f"{self.path}/{name}")

    def _drop(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def parts_of(rows: DataFrame) -> list[str]:
    """The parts of some rows; as many as there are crawls times buckets at most."""
    return sorted(r.part for r in rows.select("part").distinct().collect())
