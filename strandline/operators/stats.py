"""Counts and summaries of crawls, posts and workers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables


def total_views(messages: DataFrame, keys: Sequence[str], views: str = "views") -> DataFrame:
    """Views and number of the messages fetched, by key; a message without interactions has none."""
    return messages.groupBy(*keys).agg(F.sum(F.coalesce(F.col(views), F.lit(0))).alias("total_views"), F.count("*").alias("messages"))


def member_count(kind: Column, members: Column, member_list: Column) -> Column:
    """Members of a chat: counted for supergroups, listed for basic groups, 0 else."""
    return F.when(kind == "supergroup", F.coalesce(members, F.lit(0))).when(kind == "basic", F.coalesce(F.size(member_list), F.lit(0))).otherwise(0)


def hit_rates(rows: DataFrame, hit: Column, keys: Sequence[str]) -> DataFrame:
    """Hits, misses and thousandths of hits by key."""
    counted = rows.groupBy(*keys).agg(F.count_if(hit).alias("hits"), F.count_if(~hit).alias("misses"))
    return counted.withColumn("hit_permille", F.floor(1000 * F.col("hits") / (F.col("hits") + F.col("misses"))).cast("bigint"))


def run_counters(messages: DataFrame, status: str = "status") -> DataFrame:
    kinds = ("fetched", "deleted", "failed")
    return messages.agg(F.count("*").alias("processed"), *[F.count_if(F.col(status) == k).alias(k) for k in kinds])


def status_histogram(pages: DataFrame, depth: str = "depth", status: str = "status") -> DataFrame:
    return pages.groupBy(depth, status).agg(F.count("*").alias("n"))


def max_depth(pages: DataFrame, depth: str = "depth") -> DataFrame:
    """The deepest layer; -1 if there is none."""
    return pages.agg(F.coalesce(F.max(depth), F.lit(-1)).alias("max_depth"))


def progress(pages: DataFrame, status: str = "status") -> DataFrame:
    """Pages, those done and failed, and thousandths done."""
    done = F.col(status).isin("fetched", "deadend")
    out = pages.agg(F.count("*").alias("pages"), F.count_if(done).alias("done"), F.count_if(F.col(status) == "error").alias("failed"))
    return out.withColumn("done_permille", F.when(F.col("pages") > 0, F.floor(1000 * F.col("done") / F.col("pages"))).otherwise(0).cast("bigint"))


def prefix_counts(ids: DataFrame, prefix: Column, match: Column) -> DataFrame:
    return ids.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("total"), F.count_if(match).alias("matches"), F.count_if(~match).alias("misses"))


def latest_open(executions: DataFrame, pages: DataFrame, crawl_id: str) -> DataFrame:
    """The latest execution of a crawl that isn't completed, and whether it has pages left to fetch."""
    latest = executions.filter((F.col("crawl_id") == crawl_id) & (F.col("status") != "completed")).orderBy(F.desc("started_at"), F.desc("execution_id")).limit(1)
    left = pages.filter("status <> 'fetched'").select("execution_id").distinct().withColumn("__left", F.lit(True))
    return latest.join(left, "execution_id", "left").select("execution_id", F.coalesce("__left", F.lit(False)).alias("has_work"))


def active(rows: DataFrame, keys: Sequence[str], at: str, cutoff: Column) -> DataFrame:
    """Keys whose latest time is after the cutoff; without a cutoff all are."""
    latest = rows.groupBy(*keys).agg(F.max(at).alias("latest"))
    return latest.filter(cutoff.isNull() | (F.col("latest") > cutoff))


def dead_end(is_active: Column, messages: Column, members: Column, min_members: int, random_walk: bool) -> Column:
    """Whether a channel leads nowhere: not active, no messages, or outside random walks fewer members than asked for."""
    few = F.lit(not random_walk and min_members > 0) & (F.coalesce(members, F.lit(0)) < min_members)
    return ~F.coalesce(is_active, F.lit(False)) | (F.coalesce(messages, F.lit(0)) == 0) | few


def last_seen(status: DataFrame, worker: str, at: str, *columns: str) -> DataFrame:
    """The latest message of each worker."""
    return status.groupBy(worker).agg(F.max(at).alias("last_seen"), *[F.max_by(c, at).alias(c) for c in columns])


def offline(seen: DataFrame, now: Column, minutes: int = 5) -> DataFrame:
    return seen.filter(F.col("last_seen") < now - F.make_dt_interval(mins=F.lit(minutes)))


def requeue(items: DataFrame, gone: DataFrame, worker: str) -> DataFrame:
    """Work of workers that are gone waits again, with one more try and high priority."""
    lost = items.join(gone.select(F.col(worker).alias("assigned_to")), "assigned_to", "left_semi")
    return lost.withColumns({"retry_count": F.col("retry_count") + 1, "assigned_to": F.lit(""), "priority": F.lit(1)})


def mark_resample(old: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Status of known messages after a new look: fetched ones stay, those found again are to be sampled again, the others
    are deleted."""
    seen = found.select(*keys).distinct().withColumn("__seen", F.lit(True))
    status = F.when(F.col("status") == "fetched", "fetched").when(F.col("__seen"), "resample").otherwise("deleted")
    return old.join(seen, list(keys), "left").withColumn("status", status).drop("__seen")


def resume(pages: DataFrame, same_execution: bool) -> DataFrame:
    """Pages as a crawl takes them up again: in the same execution fetched ones stay so, all others start anew."""
    status = F.when(F.lit(same_execution) & (F.col("status") == "fetched"), "fetched").otherwise("unfetched")
    return pages.withColumns({"status": status, "messages": F.array().cast(pages.schema["messages"].dataType)})


def needs_work(status: Column, retries: Column, max_retries: int = 3) -> Column:
    return (status == "unfetched") | ((status == "error") & (retries < max_retries))


def distribute(pages: DataFrame, unpublished: DataFrame, max_retries: int = 3) -> tuple[DataFrame, DataFrame]:
    """Pages handed out, and the table after it: what needs work is being processed, but pages whose message couldn't be
    published (page_id) go back to the status they had."""
    given = tables.new_rows(pages.filter(needs_work(F.col("status"), F.col("retries"), max_retries)), unpublished, ["page_id"])
    marks = given.select("page_id", F.lit("processing").alias("status"))
    return given, tables.update_by_key(pages, marks, ["page_id"])


def tandem_done(buffered: DataFrame, in_flight: int, incomplete: DataFrame) -> DataFrame:
    """Whether a tandem crawl is over: nothing buffered, nothing in flight, no batch incomplete."""
    left = buffered.agg(F.count("*").alias("n")).union(incomplete.agg(F.sum("n").alias("n")))
    return left.agg(((F.sum("n") == 0) & F.lit(in_flight == 0)).alias("done"))


def tandem_state(buffered: DataFrame, in_flight: DataFrame, batches: DataFrame) -> DataFrame:
    """For each crawl with batches: pages buffered, pages in flight, batches incomplete, and whether it is over (none of them)."""

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("crawl_id").agg(F.count("*").alias(name))

    crawls = batches.select("crawl_id").union(in_flight.select("crawl_id")).distinct()
    out = crawls.join(counted(buffered, "buffered"), "crawl_id", "left").join(counted(in_flight, "in_flight"), "crawl_id", "left")
    out = out.join(counted(batches.filter("status <> 'completed'"), "incomplete"), "crawl_id", "left").fillna(0, ["buffered", "in_flight", "incomplete"])
    return out.withColumn("done", F.col("buffered") + F.col("in_flight") + F.col("incomplete") == 0)


def match_results(pages: DataFrame, results: DataFrame) -> DataFrame:
    """Pages with the status that their result brings, matched by depth and address."""
    got = results.select("depth", "url", F.col("status").alias("__status"), F.col("error").alias("__error"))
    return pages.join(got, ["depth", "url"], "left").withColumns({"status": F.coalesce("__status", "status"), "error": F.coalesce("__error", "error")}).drop("__status", "__error")


def high_water(channels: DataFrame, marks: DataFrame, configured: Column, key: str) -> DataFrame:
    """Earliest date to read from for each channel: the configured one or the last crawl, whichever is later."""
    return channels.join(marks, key, "left").withColumn("min_date", F.greatest(configured, F.col("last_crawled_at")))
