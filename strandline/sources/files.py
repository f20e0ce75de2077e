"""File sources and sinks: seed lists, JSON lines of posts and channels, page exports, manifests, snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.links import seed_name


def seed_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Seeds of a list: lines trimmed, without empty ones and comments."""
    trimmed = F.trim(F.col(column), F.lit(" \t\r\n"))
    return lines.select(trimmed.alias("seed")).filter((F.col("seed") != "") & ~F.col("seed").startswith("#"))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    return seed_lines(spark.read.text(path)).select(seed_name(F.col("seed")).alias("channel_username"))


def load_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schemas.SEEDS)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_MESSAGES).json(path)


def scan_history(messages: DataFrame, at: str, keys: list[str], since: Column | None = None, until: Column | None = None, most: int = -1, sample: int = 0, seed: str = "") -> DataFrame:
    """Messages from the newest back, bounds included, at most `most` of each channel (0 and -1: all); then, where more are
    left than `sample` (0: none), that many of each channel at random."""
    rows = messages
    if since is not None:
        rows = rows.filter(F.col(at) >= since)
    if until is not None:
        rows = rows.filter(F.col(at) <= until)
    others = [c for c in rows.columns if c not in (*keys, at)]
    for n, order in ((most, [F.desc(at), *others]), (sample, [F.md5(F.concat_ws(":", F.lit(seed), *[F.col(c).cast("string") for c in (at, *others)])), *others])):
        if n > 0:
            rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("__n") <= n).drop("__n")
    return rows


def write_history(messages: DataFrame, path: str, at: str, channel: str) -> None:
    """Messages as JSON lines in folders by channel and day, so that a scan of some time opens the files of its days only."""
    days = messages.withColumns({"channel": F.col(channel).cast("string"), "day": F.to_date(at)})
    days.write.mode("append").partitionBy("channel", "day").json(path)


def history_bounds(at: str, since: Column | None, until: Column | None) -> Column:
    """The bounds of a scan, included, for the messages and, which is what prunes folders, for their days."""
    kept = F.lit(True)
    for bound, holds in ((since, lambda a, b: a >= b), (until, lambda a, b: a <= b)):
        if bound is not None:
            kept = kept & holds(F.col(at), bound) & holds(F.col("day"), F.to_date(bound))
    return kept


def read_history(spark: SparkSession, path: str, schema: str, at: str, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Messages that write_history stored, within the bounds; the plan of the scan has them as partition filters."""
    rows = spark.read.schema(f"{schema}, channel STRING, day DATE").json(path)
    return rows.filter(history_bounds(at, since, until))


def newest_page(messages: DataFrame, at: str, order: list[Column], most: int, since: Column, until: Column) -> DataFrame:
    """The newest messages of a single page, of which those in the range: the limit comes before the range."""
    return messages.orderBy(*order).limit(most).filter(F.col(at).between(since, until))


def playlist(videos: DataFrame, statistics: DataFrame, at: str, since: Column, until: Column, key: str = "id", most: int = -1, channel: str = "channel_id") -> DataFrame:
    """Videos of a range of dates, newest first, with their statistics where there are any."""
    rows = videos.filter(F.col(at).between(since, until))
    if most > 0:
        rows = rows.withColumn("__n", F.row_number().over(Window.partitionBy(channel).orderBy(F.desc(at), key))).filter(F.col("__n") <= most).drop("__n")
    return rows.join(statistics, key, "left")


def by_ids(rows: DataFrame, ids: DataFrame, key: str, date_text: str, languages: tuple[str, str]) -> DataFrame:
    """Rows of the ids asked for whose date can be read; language is the first that is given."""
    found = rows.join(ids.select(key).distinct(), key, "left_semi").withColumn("published_at", F.try_to_timestamp(F.col(date_text))).filter("published_at IS NOT NULL")
    return found.withColumn("language", F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in languages]))


def lookup(rows: DataFrame, dimension: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """Rows with the dimension row that has their reference as either of its two keys; the first key goes before."""
    by_first = dimension.select(F.col(keys[0]).alias("reference"), F.struct(*dimension.columns).alias("__a"))
    by_second = dimension.filter(F.col(keys[1]).isNotNull()).groupBy(F.col(keys[1]).alias("reference")).agg(F.min(F.struct(*dimension.columns)).alias("__b"))
    return rows.join(by_first, "reference", "left").join(by_second, "reference", "left").withColumn("found", F.coalesce("__a", "__b")).drop("__a", "__b")


def by_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """State of the keys asked for, keys once each."""
    return keys.select(key).distinct().join(rows, key)


def write_json(rows: DataFrame, path: str, *partitions: str) -> None:
    rows.write.mode("append").partitionBy(*partitions).json(path)


def write_posts(posts: DataFrame, path: str) -> None:
    """Posts as Parquet by platform and day."""
    posts.withColumn("day", F.to_date("published_at")).write.mode("append").partitionBy("platform_name", "day").parquet(path)


def export_parts(pages: DataFrame, size: str, order: str, part_bytes: int = 100 << 20, slice_rows: int = 1 << 18) -> DataFrame:
    """Pages in the order of a number with the export part they go to: a part closes as it reaches its size.

    The running sum is taken in slices of the order of about `slice_rows` pages, found by quantiles, and the slices' sums are
    added up before; so no task sees all pages."""
    slices = max(1, -(-pages.count() // slice_rows))
    bounds = pages.agg(F.percentile_approx(order, [k / slices for k in range(1, slices)], 10_000)).first()[0] or []
    cuts = F.array(*[F.lit(b) for b in sorted(set(bounds))]) if bounds else F.array().cast("array<bigint>")
    rows = pages.withColumn("__slice", F.size(F.filter(cuts, lambda b: b < F.col(order))))
    sums = rows.groupBy("__slice").agg(F.sum(size).alias("__sum"))
    before = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__slice", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__own", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(F.broadcast(sums), "__slice")
    return rows.withColumn("part", F.floor((F.col("__base") + F.col("__own")) / part_bytes).cast("bigint")).drop("__slice", "__own", "__base")


def write_export(pages: DataFrame, path: str, most_rows: int = 1_000_000) -> None:
    """Export pages as JSON lines; without pages it is an error."""
    if pages.isEmpty():
        raise ValueError("no pages to export")
    pages.write.option("maxRecordsPerFile", most_rows).json(path)


def manifest(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """Files of a folder by age, with size and time; the contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def combine(spark: SparkSession, folder: str, packed: DataFrame, out: str, pattern: str = "*.jsonl") -> None:
    """Write each bin's files (columns path, bin) one after the other, in the order of their paths, as one file under
    out/bin=n; dropped files have no bin. Lines keep their order. A bin is no larger than packing lets it be, so its files
    are read whole; a file that doesn't end with a line break gets one."""
    same = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    whole = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True).select(F.regexp_replace("value", "\n$", "").alias("value"), same(F.col("_metadata.file_path")).alias("path"))
    bins = packed.filter("bin IS NOT NULL").select(same(F.col("path")).alias("path"), "bin")
    placed = whole.join(bins, "path").repartition("bin").sortWithinPartitions("bin", "path")
    placed.select("value", "bin").write.mode("append").partitionBy("bin").text(out)


def write_snapshot(table: DataFrame, path: str, version: int) -> str:
    """A new version of a table beside the old ones; readers go to the newest that is complete."""
    out = f"{path}/version={version}"
    table.write.mode("errorifexists").parquet(out)
    return out


def newest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version of a table; -1 if there is none."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(top)] if fs.exists(top) else []
    done = [p for p in found if p.getName().startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((int(p.getName().removeprefix("version=")) for p in done), default=-1)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a table."""
    return spark.read.parquet(f"{path}/version={newest_version(spark, path)}")


def setting(spark: SparkSession, name: str, fallback: str) -> str:
    """A setting of the session, or the fallback where it is unset or empty."""
    return spark.conf.get(name, None) or fallback


def storage_path(*parts: Column | str) -> Column:
    """Parts of a path joined by slashes; null and empty ones are left out."""
    return F.concat_ws("/", *[F.nullif(F.lit(p) if isinstance(p, str) else p, F.lit("")) for p in parts])
