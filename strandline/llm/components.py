"""Connected components of a graph given by its edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, materialise, scratch

#: Up to so many rows (16 bytes each) go to all executors in a round; beyond that the edges are shuffled to meet them.
BROADCAST_ROWS = 500_000
#: Members from which on a component is large.
LARGE = 1024


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id that is connected with it) for every end of an edge. Edges have long columns a and b;
    loops and repeated edges do no harm, an empty table gives an empty one.

    Alternates two steps until the edges stay: each vertex links its larger neighbours to its smallest one, then each
    links its smaller neighbours so. All that is left then are stars around the smallest ids. Each round is written to
    the shared folder and read back.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = scratch(spark, "edges")
        df.write.parquet(path)
        back = spark.read.schema("a long, b long").parquet(path)
        return back, path, tuple(back.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, path, sign = written(now)
    while sign[0]:
        # (a, b) goes to b's smallest neighbour where that is under b. Only vertices between two others have one that matters,
        # so that side is small and soon empty, and the star of a smallest vertex needn't meet anything
        below = now.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
        below = materialise(below.join(now.select("b").distinct(), "b", "left_semi"), "below")
        if below.count() <= BROADCAST_ROWS:
            below = F.broadcast(below)
        large = now.join(below, "b", "left").select("a", F.coalesce("m", "b").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new, new_path, new_sign = written(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        drop_path(spark, path)
        now, path = new, new_path
        if new_sign == sign:
            break
        sign = new_sign
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())


def join_components(rows: DataFrame, groups: DataFrame, spread: str) -> DataFrame:
    """rows (with a column component) with the columns of groups: one row for each component, with its number of `members`.

    Components of more than LARGE members are few; they are broadcast (their number is checked), and their rows are dealt by
    the column `spread` where the others meet their groups, so a giant component is not one task."""
    groups = materialise(groups, "groups")
    large = groups.filter(F.col("members") > LARGE)
    if large.count() > BROADCAST_ROWS:
        return rows.join(groups, "component")
    names = [c for c in groups.columns if c != "component"]
    held = rows.join(F.broadcast(large.select("component", F.struct(*names).alias("of_large"))), "component", "left")
    others = groups.filter(F.col("members") <= LARGE).select(F.col("component").alias("meet"), F.struct(*names).alias("of_other"))
    meet = F.when(F.col("of_large").isNull(), F.col("component")).otherwise(F.col(spread))
    held = held.withColumn("meet", meet).join(others, "meet", "left")
    found = F.coalesce("of_large", "of_other")
    return held.select(*rows.columns, *[found[c].alias(c) for c in names])


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, the first member of each member's component."""
    n = len(linked)
    root = np.full(n, -1)
    left = np.ones(n, bool)
    for k in range(n):
        if root[k] >= 0:
            continue
        root[k], left[k], stack = k, False, [k]
        while stack and left.any():
            new = np.flatnonzero(linked[stack.pop()] & left)
            root[new], left[new] = k, False
            stack.extend(new.tolist())
    return root
