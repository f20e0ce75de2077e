"""The edge validator over stored tables: pending edges are claimed, classified and written back until none is left."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import graph, queues, tables
from ..operators.slices import first_rows
from ..sources.parts import PartedTables, parts_of

#: Edges are stored by their batch, what is known of channels by the channel; pending_edges needs validated_by STRING besides
#: schemas.PENDING_EDGES.
KNOWN = "channel STRING, crawl_id STRING, pending_id INT, discovered_at TIMESTAMP"
INVALID = "channel STRING, crawl_id STRING, reason STRING, pending_id INT, invalidated_at TIMESTAMP"
#: Caches hold for all crawls; their rows have this crawl.
ALL_CRAWLS = "all"


def validation_round(edges: PartedTables, channels: PartedTables, verdicts: Callable[[DataFrame], DataFrame], now: Column, k: int = 1000, worker: str = "validator", stale_minutes: int = 10, keep_days: int = 30) -> int:
    """Claim up to k pending edges, those found first, classify them, write them back; returns how many there were.

    `verdicts` takes channels (channel) and gives channel, verdict (valid, not_channel, invalid, or else: wait), reason; it is asked for
    those only that the caches don't know. Valid channels join the known ones, invalid ones the cache, where they hold for keep_days.

    Writes, each of the touched parts alone: stale claims given back, the claim, invalid channels, known channels, the edges. Both caches
    name the edge that found a channel, so a round that stopped before its last write and is run again by the same worker takes up the
    edges that it holds and finds the same."""
    stale = parts_of(edges.read("pending_edges").filter((F.col("validation_status") == "validating") & (F.col("validated_at") < now - F.make_dt_interval(mins=F.lit(max(1, stale_minutes))))))
    if stale:
        edges.replace("pending_edges", queues.recover_edges(edges.read("pending_edges", stale), now, stale_minutes), stale)
    pending = edges.read("pending_edges")
    held = pending.filter((F.col("validation_status") == "validating") & (F.col("validated_by") == worker)).checkpoint()
    n = held.count()
    if n < k:
        waiting = pending.filter("validation_status = 'pending' AND coalesce(validation_reason, '') <> 'no_verdict'")
        claimed = first_rows(waiting, ["discovery_time", "pending_id"], k - n).checkpoint()
        parts = parts_of(claimed)
        if parts:
            marks = claimed.select("pending_id", F.lit("validating").alias("validation_status"), now.alias("validated_at"), F.lit(worker).alias("validated_by"))
            edges.replace("pending_edges", tables.update_by_key(edges.read("pending_edges", parts), marks, ["pending_id"]), parts)
        held = held.unionByName(claimed).checkpoint()
    total = held.count()
    if not total:
        return 0
    # not what these edges found themselves
    invalid = tables.new_rows(tables.unexpired(channels.read("invalid"), "invalidated_at", now, keep_days), held, ["pending_id"])
    known = tables.new_rows(channels.read("known"), held, ["pending_id"])
    rows = held.select(F.col("pending_id").alias("key"), F.col("destination_channel").alias("channel"), "discovery_time")
    asked = tables.new_rows(tables.new_rows(rows.select("channel").distinct(), invalid, ["channel"]), known, ["channel"])
    found = graph.classify(rows, invalid, known, verdicts(asked), ["discovery_time", "key"]).checkpoint()
    _add(channels, "invalid", found.filter("status = 'invalid' AND reason <> 'cached_invalid'").select("channel", F.col("key").alias("pending_id"), "reason", now.alias("invalidated_at")))
    _add(channels, "known", found.filter("status = 'valid'").select("channel", F.col("key").alias("pending_id"), now.alias("discovered_at")))
    reason = F.when(F.col("status") == "pending", "no_verdict").otherwise(F.col("reason"))
    marks = found.select(F.col("key").alias("pending_id"), F.col("status").alias("validation_status"), reason.alias("validation_reason"))
    parts = parts_of(held)
    edges.replace("pending_edges", tables.update_by_key(edges.read("pending_edges", parts), marks, ["pending_id"]), parts)
    return total


def _add(channels: PartedTables, name: str, rows: DataFrame) -> None:
    """Rows of channels, each in the place of what was there."""
    rows = tables.first_wins(rows.withColumn("crawl_id", F.lit(ALL_CRAWLS)), ["channel"], [c for c in rows.columns if c != "channel"])
    placed = rows.withColumn("part", channels.part()).checkpoint()
    parts = parts_of(placed)
    if parts:
        others = tables.new_rows(channels.read(name, parts), placed, ["channel"])
        channels.replace(name, others.unionByName(placed), parts)


def validation_loop(edges: PartedTables, channels: PartedTables, verdicts: Callable[[DataFrame], DataFrame], now: Callable[[], Column], rounds: int, k: int = 1000, worker: str = "validator") -> int:
    """Rounds until nothing is pending that hasn't been tried, or so many are done; returns how many edges were looked at. Edges without a verdict
    are pending again with the reason no_verdict, and wait for `retry`."""
    total = 0
    for _ in range(rounds):
        done = validation_round(edges, channels, verdicts, now(), k, worker)
        if not done:
            break
        total += done
    return total


def retry(edges: PartedTables) -> None:
    """Let edges without a verdict be claimed again."""
    waiting = F.coalesce((F.col("validation_status") == "pending") & (F.col("validation_reason") == "no_verdict"), F.lit(False))
    parts = parts_of(edges.read("pending_edges").filter(waiting))
    if parts:
        edges.replace("pending_edges", edges.read("pending_edges", parts).withColumn("validation_reason", F.when(~waiting, F.col("validation_reason"))), parts)
