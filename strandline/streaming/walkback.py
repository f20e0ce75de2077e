"""The walk-back processor over stored tables: many finished batches a round, and only their parts rewritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import graph, queues, tables
from ..sources.parts import PartedTables, parts_of

#: Columns that the tables need besides those of schemas.BATCHES, schemas.PAGE_BUFFER, schemas.EDGES and schemas.SOURCE_STATS.
TABLES = {"batches": "claimed_by STRING", "pending_edges": "", "page_buffer": "batch_id STRING", "edges": "batch_id STRING", "source_stats": "batch_id STRING"}


def source_statistics(store: PartedTables) -> DataFrame:
    """Counts by crawl and source type; they are kept by batch, so that counting a batch again changes nothing."""
    return store.read("source_stats").groupBy("crawl_id", "source_type").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("total", *queues.COUNTED)])


def _claim(store: PartedTables, now: Column, k: int, worker: str) -> DataFrame | None:
    """The batches that the worker holds, then the oldest ready ones, up to k; None if there are none."""
    batches = store.read("batches")
    own = batches.filter((F.col("status") == "processing") & (F.col("claimed_by") == worker)).orderBy("created_at", "batch_id").limit(k)
    held = own.checkpoint()
    n = held.count()
    if n < k:
        claimed, _, _ = queues.claim_batches(batches, store.read("pending_edges"), now, k - n)
        claimed = claimed.withColumn("claimed_by", F.lit(worker)).checkpoint()
        parts = parts_of(claimed)
        if parts:
            marks = claimed.select("batch_id", "status", "attempt_count", "claimed_at", "claimed_by")
            store.replace("batches", tables.update_by_key(store.read("batches", parts), marks, ["batch_id"]), parts)
        held = held.unionByName(claimed)
    return None if held.isEmpty() else held.checkpoint()


def _by_batch(store: PartedTables, name: str, claimed: DataFrame, rows: DataFrame, parts: list[str]) -> None:
    """Rows of the claimed batches in the place of those that an earlier try may have left."""
    others = tables.new_rows(store.read(name, parts), claimed, ["batch_id"])
    store.replace(name, others.unionByName(rows, allowMissingColumns=True), parts)


def recover(store: PartedTables, now: Column, stale_minutes: int = 10) -> None:
    """Delete edges that completed batches left, and close stale batches again, each in the parts that have some."""
    orphans = queues.orphan_edges(store.read("pending_edges"), store.read("batches"))
    parts = parts_of(orphans)
    if parts:
        store.replace("pending_edges", queues.without_orphans(store.read("pending_edges", parts), store.read("batches", parts)), parts)
    parts = parts_of(queues.stale_batches(store.read("batches"), now, stale_minutes).filter(F.col("attempt_count") < queues.MAX_ATTEMPTS))
    if parts:
        again, _ = queues.recover_batches(store.read("batches", parts), now, stale_minutes)
        store.replace("batches", again, parts)


def walkback_round(store: PartedTables, known: DataFrame, now: Column, walkback_rate: int, seed: str, k: int = 1000, worker: str = "walkback", stale_minutes: int = 10) -> int:
    """Process up to k batches and return how many there were.

    Writes come in this order, each of the claimed batches' parts alone: the claim; pages and edges; counts; completion; deletion of
    the batches' pending edges. Draws depend on seed and batch, and what a batch gives takes the place of what it gave before, so a
    round that stopped after any write can be run again: the worker takes up the batches it holds, and the tables come out the same. Edges
    that a stop before the last write left go with the next round's recovery."""
    recover(store, now, stale_minutes)
    claimed = _claim(store, now, k, worker)
    if claimed is None:
        return 0
    parts = parts_of(claimed)
    pending = store.read("pending_edges", parts)
    mine = tables.known_rows(pending, claimed, ["batch_id"])
    pages, followed = graph.walk_step(claimed, queues.valid_channels(mine), known, walkback_rate, seed)
    _by_batch(store, "page_buffer", claimed, pages, parts)
    _by_batch(store, "edges", claimed, followed, parts)
    _by_batch(store, "source_stats", claimed, queues.batch_statistics(mine, ("crawl_id", "batch_id")), parts)
    marks = claimed.select("batch_id", F.lit("completed").alias("status"), now.alias("completed_at"))
    store.replace("batches", tables.update_by_key(store.read("batches", parts), marks, ["batch_id"]), parts)
    store.replace("pending_edges", tables.new_rows(pending, claimed, ["batch_id"]), parts)
    return claimed.count()


def walkback_loop(store: PartedTables, known: DataFrame, now: Callable[[], Column], walkback_rate: int, seed: str, rounds: int, k: int = 1000, worker: str = "walkback") -> int:
    """Rounds until no batch is ready or so many are done; returns how many batches were processed."""
    total = 0
    for _ in range(rounds):
        done = walkback_round(store, known, now(), walkback_rate, seed, k, worker)
        if not done:
            break
        total += done
    return total
