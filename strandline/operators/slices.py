"""Folds over rows in order without one task that sees them all: rows are dealt to slices of the order, each slice becomes a
small summary of what it does to any state, and summaries are composed before the slices run again with the state they begin in."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of a slice, and slices (or groups of them) that one task composes.
SLICE_ROWS, GROUP = 1 << 18, 64
#: Rows that one task may bring in order.
ONE_TASK = 10_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without one gets its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = f"{tempfile.gettempdir()}/strandline-{spark.sparkContext.applicationId}"
    return path.rstrip("/")


def ensure_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")


def in_slices(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows in slices of their keys and order: __slice, and __key (the keys as text). A slice is a partition in order; it is
    checkpointed, so that each look at it finds the same rows. A key with very many rows fills many slices."""
    ensure_checkpoints(rows.sparkSession)
    n = -(-rows.count() // SLICE_ROWS)
    by = [*keys, *order]
    dealt = rows.repartitionByRange(max(1, n), *by).sortWithinPartitions(*by) if by else rows.coalesce(1)
    exact = {f"{kind}Format": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for kind in ("timestamp", "timestampNTZ")}
    key = F.to_json(F.struct(*keys), exact) if keys else F.lit("")
    return dealt.select("*", key.alias("__key"), F.spark_partition_id().alias("__slice")).checkpoint()


def first_rows(rows: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first n rows in an order; all if there are fewer.

    Up to ONE_TASK of them are sorted by one task, after each task has found its own first n. More are found by slices of the
    order: as many as lie wholly before the n-th row are kept as they are, and of the one it lies in the first rows, so no task
    gets more than a slice."""
    if n <= ONE_TASK:
        return rows.orderBy(*order).limit(n)
    ensure_checkpoints(rows.sparkSession)
    slices = max(1, -(-rows.count() // SLICE_ROWS))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = rows.repartitionByRange(slices, *order).sortWithinPartitions(*order).withColumns({"__slice": F.spark_partition_id(), "__place": place}).checkpoint()
    left, whole = n, -1
    for number, size in sorted(tuple(r) for r in dealt.groupBy("__slice").count().collect()):
        if size > left:
            break
        left, whole = left - size, number
    # slices without rows have no number, so the next one that has some is the first above
    rest = dealt.filter(F.col("__slice") > whole).agg(F.min("__slice")).first()[0]
    here = F.col("__slice") <= whole
    kept = dealt.filter(here if rest is None else here | (F.col("__slice") == rest) & (F.col("__place") < left))
    return kept.drop("__slice", "__place")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[str, pa.Table]]]]:
    """The slice of a partition, if it has rows, and its rows key by key."""
    found = list(batches)
    table = pa.Table.from_batches(found) if found else None
    if table is None or not table.num_rows:
        return
    keys = table.column("__key").combine_chunks().dictionary_encode()
    codes = keys.indices.to_numpy()
    bounds = [0, *(codes[1:] != codes[:-1]).nonzero()[0] + 1, len(codes)]
    yield table.column("__slice")[0].as_py(), [(keys.dictionary[codes[a]].as_py(), table.slice(a, b - a)) for a, b in zip(bounds, bounds[1:], strict=False)]


def begins(summaries: DataFrame, start: tuple, state: T.StructType, step: Callable[[tuple, dict], tuple], joined: Callable[[list[dict]], dict]) -> DataFrame:
    """slice and the state in which each slice begins.

    summaries: slice and what `step` needs to take a state over a slice. `joined` makes the summary of several slices, in
    order, of the same columns. Groups of slices are joined, and groups of groups, until few are left; the states then
    go down again, so no task composes more than GROUP summaries."""
    levels = [summaries.select(F.col("slice").cast("long").alias("slice"), *[c for c in summaries.columns if c != "slice"])]
    kind = levels[0].schema
    spark = summaries.sparkSession
    while levels[-1].count() > GROUP:
        level = levels[-1].withColumn("__group", F.floor(F.col("slice") / GROUP))

        def join(key: tuple, table: pa.Table) -> pa.Table:
            rows = sorted(table.drop_columns(["__group"]).to_pylist(), key=lambda r: r["slice"])
            return pa.Table.from_pylist([joined(rows) | {"slice": key[0].as_py()}], schema=table.drop_columns(["__group"]).schema)

        levels.append(level.groupBy("__group").applyInArrow(join, kind).checkpoint())
    names = state.fieldNames()
    first = spark.createDataFrame([(0, *start)], T.StructType([T.StructField("slice", T.LongType()), *state]))
    at = first
    for level in reversed(levels):

        def walk(_: tuple, rows: pa.Table, given: pa.Table) -> pa.Table:
            now = tuple(given.column(c)[0].as_py() for c in names)
            out = []
            for r in sorted(rows.to_pylist(), key=lambda r: r["slice"]):
                out.append((r["slice"], *now))
                now = step(now, r)
            return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), made, strict=True)], schema=made) if out else made.empty_table()

        made = to_arrow_schema(first.schema)
        grouped = level.withColumn("__group", F.floor(F.col("slice") / GROUP) if level is not levels[-1] else F.lit(0).cast("long"))
        at = grouped.groupBy("__group").cogroup(at.withColumnRenamed("slice", "__group").groupBy("__group")).applyInArrow(walk, first.schema)
    return at
