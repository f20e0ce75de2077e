"""The channel graph: edges, what is known of its vertices, layers, and the random walk over it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.links import prefix_match, username_fault
from . import tables
from .slices import first_rows, shared_dir


def save_edges(edges: DataFrame, rows: DataFrame, crawl_id: str) -> DataFrame:
    """Append edges; an edge's own crawl id goes before the given one. Rows without a destination are left out."""
    return tables.append(edges, rows.filter("destination_channel IS NOT NULL"), crawl_id=F.lit(crawl_id))


def find_edge(edges: DataFrame, crawl_id: str, sequence_id: str, destination: str) -> DataFrame:
    return edges.filter((F.col("crawl_id") == crawl_id) & (F.col("sequence_id") == sequence_id) & (F.col("destination_channel") == destination)).orderBy("edge_id").limit(1)


def delete_edge(edges: DataFrame, crawl_id: str, sequence_id: str, destination: str) -> DataFrame:
    return tables.delete(edges, (F.col("crawl_id") == crawl_id) & (F.col("sequence_id") == sequence_id) & (F.col("destination_channel") == destination))


def promote_edge(edges: DataFrame, crawl_id: str, sequence_id: str, destination: str) -> DataFrame:
    mine = (F.col("crawl_id") == crawl_id) & (F.col("sequence_id") == sequence_id) & (F.col("destination_channel") == destination)
    return tables.update(edges, mine, skipped=F.lit(False))


def random_skipped(edges: DataFrame, where: Column, seed: str, *keys: str) -> DataFrame:
    """One of the skipped edges for which the condition holds."""
    return tables.random_rows(edges.filter(where & F.col("skipped")), 1, seed, *keys)


def vertices(edges: DataFrame, source: str = "source_channel", destination: str = "destination_channel") -> DataFrame:
    """Every channel that an edge names, once."""
    return edges.select(F.col(source).alias("channel")).union(edges.select(F.col(destination).alias("channel"))).filter("channel IS NOT NULL").distinct()


def without_loops(edges: DataFrame, source: str, destination: str) -> DataFrame:
    return edges.filter(F.col(source) != F.col(destination))


def next_layer(found: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Found pages once for each address, the first in order."""
    return tables.first_wins(found, [key], order)


def without_layer_duplicates(pages: DataFrame, order: list[str]) -> DataFrame:
    """Pages of which each address is once in a layer: the first in order."""
    return tables.first_wins(pages, ["depth", "url"], order)


def url_cache(pages: DataFrame) -> DataFrame:
    """url, page_id: the page that stands for each address seen by this crawl or earlier ones, of several the deepest."""
    return pages.groupBy("url").agg(F.max_by("page_id", F.struct("depth", "page_id")).alias("page_id"))


def add_layer(known: DataFrame, found: DataFrame, key: str, order: list[str], max_pages: int, total: int, dead_ends: int) -> DataFrame:
    """New pages of a layer: addresses not known before, each once. Below the cap on pages as many as it leaves room for; at
    the cap as many as there are dead ends, which they replace; without a cap (0) all."""
    fresh = next_layer(tables.new_rows(found, known, [key]), key, order)
    if max_pages <= 0:
        return fresh
    return fresh.orderBy(*order, key).limit(dead_ends if total >= max_pages else max_pages - total)


def unseen_or_all(seeds: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Seeds that earlier crawls haven't seen; all of them if none is left."""
    fresh = tables.new_rows(seeds, seen, [key])
    return seeds if fresh.isEmpty() else fresh


def tandem_edges(messages: DataFrame, invalid: DataFrame, source: str = "source_channel", links: str = "links") -> DataFrame:
    """Edges that a batch of messages gives: one for each channel linked from a source, without links to itself, names that
    can't be a channel's, and channels known to be invalid."""
    rows = messages.select(F.col("batch_id"), F.col(source).alias("source_channel"), F.explode(links).alias("link"))
    rows = rows.select("batch_id", "source_channel", F.col("link.name").alias("destination_channel"), F.col("link.source_type").alias("source_type"))
    rows = without_loops(rows, "source_channel", "destination_channel").filter(username_fault(F.col("destination_channel")).isNull())
    rows = rows.join(invalid.select(F.col("channel_username").alias("destination_channel")), "destination_channel", "left_anti")
    return tables.first_wins(rows, ["batch_id", "destination_channel"], ["source_type", "source_channel"])


def classify(edges: DataFrame, invalid: DataFrame, known: DataFrame, verdicts: DataFrame, order: list[str | Column]) -> DataFrame:
    """Status and reason of pending edges (columns key, channel): invalid if the channel is known as such, duplicate if it is
    known, by the verdict else; the first valid edge of a channel claims it and the others are duplicates. Edges without
    a definite verdict stay pending."""
    rows = edges.join(invalid.select("channel", F.lit(True).alias("__invalid")).distinct(), "channel", "left")
    rows = rows.join(known.select("channel", F.lit(True).alias("__known")).distinct(), "channel", "left").join(verdicts, "channel", "left")
    fresh = F.col("__invalid").isNull() & F.col("__known").isNull()
    winners = rows.filter(fresh & (F.col("verdict") == "valid")).groupBy("channel").agg(F.min_by("key", F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])).alias("__winner"))
    rows = rows.join(winners, "channel", "left")
    status = (
        F.when(F.col("__invalid"), "invalid").when(F.col("__known"), "duplicate")
        .when(F.col("verdict") == "valid", F.when(F.col("key") == F.col("__winner"), "valid").otherwise("duplicate"))
        .when(F.col("verdict").isin("not_channel", "invalid"), F.col("verdict")).otherwise("pending")
    )
    reason = F.when(F.col("__invalid"), "cached_invalid").when(fresh & F.col("verdict").isin("not_channel", "invalid"), F.col("reason")).otherwise("")
    return rows.select("key", "channel", status.alias("status"), reason.alias("reason"))


def hash_ranks(channels: DataFrame, seed: str) -> tuple[DataFrame, int]:
    """channel, rank (from 0, in the order of a hash with the seed) of distinct channels, and how many there are.

    Hashes are cut to buckets by their first digits: ranks are counted in each bucket, and the buckets' sizes are added up
    before, so no task ranks them all."""
    places = channels.select("channel").filter("channel IS NOT NULL").distinct().withColumn("__h", F.md5(F.concat_ws(":", F.lit(seed), "channel")))
    n = places.count()
    digits = max(1, min(5, len(f"{n // 10_000:x}")))
    places = places.withColumn("__bucket", F.substring("__h", 1, digits))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)  # of at most 16**5 rows
    base = places.groupBy("__bucket").agg(F.count("*").alias("__n")).select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy("__h", "channel")) - 1
    return places.withColumn("__own", inside).join(base, "__bucket").select("channel", (F.col("__base") + F.col("__own")).alias("rank")), n


def walkback_targets(back: DataFrame, valid: DataFrame, known: DataFrame, seed: str, draws: int = 10) -> DataFrame:
    """batch_id, back: for each batch (batch_id, source_channel) the first of up to `draws` uniform draws of a known channel
    that is neither its source nor one of its new channels (valid: batch_id, channel). A batch whose draws are all
    excluded has no row. Draws are hashes of seed, batch and attempt."""
    places, n = hash_ranks(known, seed)
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("back"), "batch_id", F.col("attempt").cast("string"))), 1, 15), 16, 10).cast("bigint")
    wanted = back.select("batch_id", "source_channel", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("attempt")).withColumn("rank", F.pmod(drawn, F.lit(max(1, n))))
    found = wanted.join(places.withColumnRenamed("channel", "back"), "rank").filter(F.col("back") != F.col("source_channel"))
    found = found.join(valid.select("batch_id", F.col("channel").alias("back")), ["batch_id", "back"], "left_anti")
    return found.groupBy("batch_id").agg(F.min_by("back", "attempt").alias("back"))


def walk_step(batches: DataFrame, valid: DataFrame, known: DataFrame, walkback_rate: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """Pages and edges that finished batches give, each with its batch.

    batches: batch_id, crawl_id, source_channel, source_page_id, source_depth, sequence_id. valid: batch_id, channel (newly
    claimed ones, each once). A batch without new channels walks back; else a draw of 1..100 up to the rate walks back. Forward goes to
    a uniform new channel; new channels not taken become skipped edges. Back goes to a uniform known channel other than
    the source and the new ones, and starts a new sequence for the page while the edge stays in the old one. A batch whose
    ten draws of a channel to go back to all fail gives no page and no edges. Draws are hashes of seed and batch.
    """
    new = valid.withColumn("__h", F.md5(F.concat_ws(":", F.lit(seed), "batch_id", "channel")))
    chosen = new.groupBy("batch_id").agg(F.count("*").alias("new_channels"), F.min_by("channel", F.struct("__h", "channel")).alias("forward"))
    rows = batches.join(chosen, "batch_id", "left").fillna({"new_channels": 0})
    draw = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "batch_id")), 1, 8), 16, 10).cast("bigint"), F.lit(100)) + 1
    rows = rows.withColumn("walkback", (F.col("new_channels") == 0) | (F.lit(walkback_rate) >= draw))
    targets = walkback_targets(rows.filter("walkback"), valid, known, seed)
    rows = rows.join(targets, "batch_id", "left").withColumn("next", F.when(F.col("walkback"), F.col("back")).otherwise(F.col("forward"))).filter("next IS NOT NULL")
    fresh = F.sha2(F.concat_ws(":", F.lit(seed), F.lit("sequence"), "batch_id"), 256)
    pages = rows.select(
        "batch_id", F.sha2(F.concat_ws(":", F.lit(seed), F.lit("page"), "batch_id"), 256).alias("page_id"), F.col("source_page_id").alias("parent_id"), (F.col("source_depth") + 1).alias("depth"),
        F.col("next").alias("url"), "crawl_id", F.when(F.col("walkback"), fresh).otherwise(F.col("sequence_id")).alias("sequence_id"),
    )
    primary = rows.select("batch_id", F.col("next").alias("destination_channel"), "source_channel", "walkback", F.lit(False).alias("skipped"), "crawl_id", "sequence_id")
    left = rows.select("batch_id", "source_channel", "crawl_id", "sequence_id", "walkback", "next").join(valid, "batch_id")
    left = left.filter(F.col("walkback") | (F.col("channel") != F.col("next")))
    skipped = left.select("batch_id", F.col("channel").alias("destination_channel"), "source_channel", F.lit(False).alias("walkback"), F.lit(True).alias("skipped"), "crawl_id", "sequence_id")
    return pages, primary.union(skipped)


def replacement(failed: DataFrame, edges: DataFrame, seeds: DataFrame, seed: str) -> DataFrame:
    """What takes the place of failed pages (page_id, url, sequence_id): action promote with the channel, or seed with one,
    or walkback.

    The edge that led there decides: none and a seed gives another seed, drawn for each page by itself; none else, or a walk
    back, walks back; a forward edge gives a random skipped edge of its source and sequence, or walks back if there is none."""
    led = edges.select(F.col("destination_channel").alias("url"), "sequence_id", "source_channel", "walkback", "edge_id")
    led = tables.first_wins(led, ["url", "sequence_id"], ["edge_id"])
    skipped = edges.filter("skipped").withColumn("__h", F.md5(F.concat_ws(":", F.lit(seed), "edge_id")))
    # a failed page's own edge doesn't come back
    skipped = skipped.join(failed.select(F.col("url").alias("destination_channel"), "sequence_id"), ["destination_channel", "sequence_id"], "left_anti")
    best = skipped.groupBy("source_channel", "sequence_id").agg(F.min_by("destination_channel", F.struct("__h", "edge_id")).alias("other"))
    usable = seeds.join(failed.select(F.col("url").alias("channel_username")), "channel_username", "left_anti")
    places, n = hash_ranks(usable.select(F.col("channel_username").alias("channel")), seed)
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("seed"), "page_id")), 1, 15), 16, 10).cast("bigint")
    known = seeds.select(F.col("channel_username").alias("url"), F.lit(True).alias("is_seed")).distinct()
    rows = failed.join(led, ["url", "sequence_id"], "left").join(known, "url", "left").join(best, ["source_channel", "sequence_id"], "left")
    no_edge = F.col("edge_id").isNull()
    rows = rows.withColumn("rank", F.when(no_edge & F.col("is_seed"), F.pmod(drawn, F.lit(max(1, n)))))
    rows = rows.join(places.select("rank", F.col("channel").alias("other_seed")), "rank", "left")
    other_seed = F.col("other_seed")
    action = F.when(no_edge & F.coalesce("is_seed", F.lit(False)), F.when(other_seed.isNotNull(), "seed").otherwise("walkback")).when(no_edge | F.col("walkback"), "walkback").when(F.col("other").isNotNull(), "promote").otherwise("walkback")
    return rows.select("page_id", "url", action.alias("action"), F.when(action == "promote", F.col("other")).when(action == "seed", other_seed).alias("channel"))


class Bucketed:
    """Tables of a search in the shared folder, bucketed by a channel, so that joins on it read them without an exchange."""

    def __init__(self, spark: SparkSession):
        self.spark, self.name = spark, uuid.uuid4().hex
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def append(self, table: str, rows: DataFrame, key: str, *folders: str) -> None:
        name = f"strandline_{table}_{self.name}"
        writer = rows.write.mode("append").format("parquet").bucketBy(self.buckets, key).sortBy(key).option("path", f"{shared_dir(self.spark)}/{name}")
        (writer.partitionBy(*folders) if folders else writer).saveAsTable(name)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"strandline_{table}_{self.name}")


def reached(found: Bucketed, depth: int) -> DataFrame:
    """Channels that edges lead to from those of a depth, each once, without those seen: what is shuffled is what the edges lead to,
    neither the edges nor the channels seen."""
    here = found.read("seen").filter(F.col("depth") == depth).select(F.col("channel").alias("source"))
    return found.read("edges").join(here, "source", "left_semi").select(F.col("destination").alias("channel")).distinct()


def layers(edges: DataFrame, roots: DataFrame, max_depth: int = -1, allowed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """channel, depth: breadth-first layers from the roots over edges (source, destination), each channel in its first one.

    Stops at an empty layer or after max_depth layers (-1: none). `allowed` filters the channels of a layer. Edges and the channels
    seen are stored in buckets of their channel, the latter in a folder for each depth, so a layer reads them where they are and its
    lineage doesn't grow with depth."""
    found = Bucketed(edges.sparkSession)
    found.append("edges", without_loops(edges, "source", "destination").select("source", "destination").distinct(), "source")
    found.append("seen", roots.select("channel").distinct().withColumn("depth", F.lit(0)), "channel", "depth")
    depth = 0
    while (max_depth < 0 or depth < max_depth) and not found.read("seen").filter(F.col("depth") == depth).isEmpty():
        layer = reached(found, depth)
        layer = (allowed(layer) if allowed else layer).join(found.read("seen").select("channel"), "channel", "left_anti")
        depth += 1
        found.append("seen", layer.withColumn("depth", F.lit(depth)), "channel", "depth")
    return found.read("seen").select("channel", "depth")


def snowball(edges: DataFrame, seeds: DataFrame, sizes: DataFrame, min_videos: int = 10) -> DataFrame:
    """Layers over mentions in which only channels with more than min_videos videos go on; sizes: channel, video_count."""
    large = sizes.filter(F.col("video_count") > min_videos).select("channel")
    return layers(edges, seeds, -1, lambda df: df.join(large, "channel", "left_semi"))


def snowball_videos(found: DataFrame, videos: DataFrame, at: str, key: str, per_channel: int = 50, limit: int = -1) -> DataFrame:
    """The newest videos (with a column channel) of the channels of a snowball (channel, depth), so many of each; in all at
    most `limit` (-1: no limit), those of nearer layers first."""
    newest = tables.top_per_key(tables.known_rows(videos, found, ["channel"]), ["channel"], [F.desc(at), F.col(key)], per_channel).join(found.select("channel", "depth"), "channel")
    return first_rows(newest, ["depth", "channel", F.desc(at), key], limit) if limit >= 0 else newest


def prefix_sample(videos: DataFrame, prefixes: DataFrame, sizes: DataFrame, n: int, seed: str, per_search: int = 10, min_videos: int = 10) -> DataFrame:
    """n random videos (id, channel, number) found by searches for prefixes of ids (column prefix, each searched once). A search
    gives the videos of at most `per_search` channels, and channels with no more than min_videos videos are left out."""
    searched = prefixes.select(F.lower("prefix").alias("prefix")).distinct()
    hits = videos.withColumn("prefix", F.lower(F.left("id", F.lit(5)))).join(searched, "prefix").filter(prefix_match(F.col("id"), F.col("prefix")))
    channels = tables.top_per_key(hits.select("prefix", "channel").distinct(), ["prefix"], [tables.hash_order(seed, "prefix", "channel"), F.col("channel")], per_search)
    large = sizes.filter(F.col("video_count") > min_videos).select("channel")
    kept = tables.known_rows(hits, tables.known_rows(channels, large, ["channel"]), ["prefix", "channel"])
    return tables.random_rows(kept, n, seed, "number")


def draw_seeds(seeds: DataFrame, n: int, seed: str, key: str = "channel_username") -> DataFrame:
    """n distinct random seeds as first pages, each with a sequence of its own; an error if n isn't in 1..number of seeds."""
    have = seeds.select(key).distinct()
    total = have.count()
    if not 0 < n <= total:
        raise ValueError(f"seed size must be in 1..{total}, not {n}")
    drawn = tables.random_rows(have, n, seed, key)
    return drawn.select(F.col(key).alias("url"), F.sha2(F.concat_ws(":", F.lit(seed), F.lit("sequence"), key), 256).alias("sequence_id"), F.lit(0).alias("depth"))


def pop(buffer: DataFrame, crawl_id: str, n: int) -> DataFrame:
    return first_rows(buffer.filter(F.col("crawl_id") == crawl_id), ["depth", "page_id"], n)


def remove_pages(buffer: DataFrame, crawl_id: str, page_ids: DataFrame) -> DataFrame:
    """The buffer without the pages of a crawl; no ids leave it as it is."""
    mine = page_ids.select("page_id").distinct().withColumn("crawl_id", F.lit(crawl_id))
    return buffer.join(mine, ["page_id", "crawl_id"], "left_anti")
