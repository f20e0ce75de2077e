"""Changes of stored tables as functions of the old table and the change: append, upsert, merge, claim, expire, delete.

Spark's file tables have no UPDATE, DELETE or MERGE, so each change gives the new table, and a writer swaps snapshots.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .slices import ONE_TASK, first_rows


def append(table: DataFrame, rows: DataFrame, **defaults: Column) -> DataFrame:
    """Add rows; the columns in `defaults` replace null or empty values."""
    for name, value in defaults.items():
        rows = rows.withColumn(name, F.coalesce(F.nullif(F.col(name), F.lit("")), value) if name in rows.columns else value)
    return table.unionByName(rows, allowMissingColumns=True)


def update(table: DataFrame, where: Column, **values: Column) -> DataFrame:
    """Set columns where the condition holds; a null condition doesn't."""
    here = F.coalesce(where, F.lit(False))
    return table.withColumns({name: F.when(here, value).otherwise(F.col(name)) for name, value in values.items()})


def delete(table: DataFrame, where: Column) -> DataFrame:
    """Rows for which the condition doesn't hold; a null condition doesn't."""
    return table.filter(~F.coalesce(where, F.lit(False)))


def upsert(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows with new keys; of known ones replace the columns that `rows` has. One row for each key is expected on
    either side. Other columns keep their values, or are null in new rows."""
    given = [c for c in rows.columns if c not in keys]
    marked = rows.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in given], F.lit(True).alias("__new"))
    joined = table.join(marked, list(keys), "full_outer")
    return joined.select(*[F.when(F.col("__new"), F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c) for c in table.columns])


def update_by_key(table: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace the columns that `rows` has where their key is known, with null as 'keep'; unknown keys are ignored."""
    given = [c for c in rows.columns if c not in keys]
    joined = table.join(rows.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in given]), list(keys), "left")
    return joined.select(*[F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in given else F.col(c) for c in table.columns])


def additive_merge(table: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add counts to those of the same key."""
    counts = [c for c in table.columns if c not in keys]
    return table.unionByName(delta).groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])


def new_rows(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key isn't known yet."""
    return rows.join(known.select(*keys), list(keys), "left_anti")


def new_rows_of_few(rows: DataFrame, known: DataFrame, keys: Sequence[str], rate: float = 1e-4, most: int = 1 << 24) -> DataFrame:
    """new_rows where the history is long and the rows are few: only what of the history may be among the rows is shuffled.

    The rows' keys are hashed to so many values that about `rate` of other keys meet one of them; these go to all tasks that read the
    history, which pass on the keys that hit. What passes decides exactly, whatever the rate. Rows with more than `most` keys, whose
    hashes (8 bytes each) would be too much to broadcast, are joined as they are."""
    n = rows.select(*keys).distinct().count()
    if n > most:
        return new_rows(rows, known, keys)
    value = F.pmod(F.xxhash64(*keys), F.lit(max(1, int(n / rate)))).alias("__value")
    hashes = rows.select(value).distinct()
    near = known.select(*keys, value).join(F.broadcast(hashes), "__value", "left_semi").select(*keys).distinct()
    return new_rows(rows, near, keys)


def known_rows(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(known.select(*keys), list(keys), "left_semi")


def first_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key. min_by of a struct combines before the shuffle, so a key with very many rows is one row
    from each task."""
    others = [c for c in rows.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*others), rank).alias("__row")).select(*[F.col(f"__row.{c}").alias(c) if c in others else F.col(c) for c in rows.columns])


def claim_first(rows: DataFrame, known: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First rows of keys that nobody has claimed yet."""
    return first_wins(new_rows(rows, known, keys), keys, order)


def claim_top(table: DataFrame, where: Column, order: Sequence[str | Column], k: int) -> DataFrame:
    """The first k rows of those that wait. One writer claims at a time; it replaces row locks."""
    return first_rows(table.filter(where), order, k)


def unexpired(table: DataFrame, at: str, now: Column, days: int = 30) -> DataFrame:
    """Rows whose time is later than `days` before now."""
    return table.filter(F.col(at) > now - F.expr(f"INTERVAL {days} DAYS"))


def with_expiry(table: DataFrame, at: str, now: Column, days: int = 30) -> DataFrame:
    """Rows of a cache with `cached`: whether they are younger than `days`."""
    return table.withColumn("cached", F.col(at) > now - F.expr(f"INTERVAL {days} DAYS"))


def usable_seeds(seeds: DataFrame, now: Column, days: int = 30) -> DataFrame:
    """Seeds with a name that are not invalid, or have been for at least `days`."""
    past = F.col("invalidated_at") <= now - F.expr(f"INTERVAL {days} DAYS")
    return seeds.filter((F.coalesce("channel_username", F.lit("")) != "") & (F.col("invalidated_at").isNull() | past))


def hash_order(seed: str, *keys: str) -> Column:
    """An order that looks random but follows from a seed and the keys."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.col(k).cast("string") for k in keys]))


def random_rows(table: DataFrame, n: int, seed: str, *keys: str) -> DataFrame:
    """n rows, uniformly without replacement; all if there are fewer.

    Where many are asked for, rows whose hash is above all that are likely to be wanted are left out first: the n-th of so many
    uniform hashes lies below the cut but for one case in 10**9, which is then seen and the cut left out."""
    if n > ONE_TASK:
        total = table.count()
        share = (n + 6 * math.sqrt(n) + 40) / max(1, total)
        if share < 0.9:
            below = table.filter(F.substring(hash_order(seed, *keys), 1, 12) <= f"{int(share * 16**12):012x}")
            table = below if below.count() >= n else table
    return first_rows(table, [hash_order(seed, *keys), *keys], n)


def top_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each key."""
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") <= k).drop("__rank")


def check_keys(table: DataFrame, key: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Violations of a key or of required columns: fault, and how many rows or keys have it."""
    missing = [table.filter(F.col(c).isNull()).agg(F.lit(f"null:{c}").alias("fault"), F.count("*").alias("n")) for c in required]
    twice = table.groupBy(*key).count().filter("count > 1").agg(F.lit("repeated:" + ",".join(key)).alias("fault"), F.count("*").alias("n"))
    for m in missing:
        twice = twice.union(m)
    return twice.filter("n > 0")


def missing_parents(rows: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose reference has no parent."""
    return rows.filter(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")
