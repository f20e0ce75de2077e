"""Work queues: batches of edges that wait for validation, their claims, leases, statistics and clean-up."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import graph, tables
from .slices import first_rows, in_slices, runs

#: A batch is given up after so many attempts.
MAX_ATTEMPTS = 3
OPEN_EDGES = ("pending", "validating")
COUNTED = ("valid", "not_channel", "invalid", "duplicate")


def open_batch(batches: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    return tables.append(batches, rows.withColumns({"status": F.lit("open"), "attempt_count": F.lit(0), "created_at": now}))


def add_pending(edges: DataFrame, rows: DataFrame) -> DataFrame:
    return tables.append(edges, rows.withColumn("validation_status", F.lit("pending")))


def close_batch(batches: DataFrame, batch_id: str, now: Column) -> DataFrame:
    return tables.update(batches, F.col("batch_id") == batch_id, status=F.lit("closed"), closed_at=now)


def complete_batch(batches: DataFrame, batch_id: str, now: Column) -> DataFrame:
    return tables.update(batches, F.col("batch_id") == batch_id, status=F.lit("completed"), completed_at=now)


def claim_edges(edges: DataFrame, k: int, now: Column) -> tuple[DataFrame, DataFrame]:
    """The k pending edges that were found first, and the table in which they are being validated."""
    claimed = tables.claim_top(edges, F.col("validation_status") == "pending", ["discovery_time", "pending_id"], k)
    marks = claimed.select("pending_id", F.lit("validating").alias("validation_status"), now.alias("validated_at"))
    return claimed, tables.update_by_key(edges, marks, ["pending_id"])


def update_edges(edges: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Set status, reason and time of edges by id."""
    return tables.update_by_key(edges, verdicts, ["pending_id"])


def ready_batches(batches: DataFrame, edges: DataFrame) -> DataFrame:
    """Closed batches with attempts left and no edge still open."""
    waiting = edges.filter(F.col("validation_status").isin(*OPEN_EDGES)).select("batch_id")
    return batches.filter((F.col("status") == "closed") & (F.col("attempt_count") < MAX_ATTEMPTS)).join(waiting, "batch_id", "left_anti")


def claim_batches(batches: DataFrame, edges: DataFrame, now: Column, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The k oldest ready batches, each with one more attempt, their edges, and the table in which they are being processed."""
    claimed = first_rows(ready_batches(batches, edges), ["created_at", "batch_id"], k)
    claimed = claimed.withColumns({"status": F.lit("processing"), "attempt_count": F.col("attempt_count") + 1, "claimed_at": now})
    marks = claimed.select("batch_id", "status", "attempt_count", "claimed_at")
    return claimed, tables.known_rows(edges, claimed, ["batch_id"]), tables.update_by_key(batches, marks, ["batch_id"])


def claim_batch(batches: DataFrame, edges: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """claim_batches of one."""
    return claim_batches(batches, edges, now, 1)


def batch_statistics(edges: DataFrame, keys: tuple[str, ...] = ("crawl_id",), status: str = "validation_status", source: str = "source_type") -> DataFrame:
    """Counts of edges by source type; other statuses count in total only."""
    kind = F.coalesce(F.nullif(F.col(source), F.lit("")), F.lit("unknown")).alias("source_type")
    return edges.groupBy(*keys, kind).agg(F.count("*").alias("total"), *[F.count_if(F.col(status) == s).alias(s) for s in COUNTED])


def flush_batch(stats: DataFrame, edges: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Add a batch's counts to the statistics and delete its edges."""
    mine = F.col("batch_id") == batch_id
    return tables.additive_merge(stats, batch_statistics(edges.filter(mine)), ["crawl_id", "source_type"]), tables.delete(edges, mine)


def incomplete_batches(batches: DataFrame, crawl_id: str) -> DataFrame:
    return batches.agg(F.count_if((F.col("crawl_id") == crawl_id) & (F.col("status") != "completed")).alias("n"))


def recover_edges(edges: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Edges whose validation began too long ago wait again."""
    stale = (F.col("validation_status") == "validating") & (F.col("validated_at") < now - F.make_dt_interval(mins=F.lit(max(1, minutes))))
    return tables.update(edges, stale, validation_status=F.lit("pending"), validated_at=F.lit(None).cast("timestamp"))


def stale_batches(batches: DataFrame, now: Column, minutes: int) -> DataFrame:
    return batches.filter((F.col("status") == "processing") & (F.col("claimed_at") < now - F.make_dt_interval(mins=F.lit(max(1, minutes)))))


def recover_batches(batches: DataFrame, now: Column, minutes: int) -> tuple[DataFrame, DataFrame]:
    """The table in which stale batches with attempts left are closed again, and the poison batches without."""
    stale = (F.col("status") == "processing") & (F.col("claimed_at") < now - F.make_dt_interval(mins=F.lit(max(1, minutes))))
    again = stale & (F.col("attempt_count") < MAX_ATTEMPTS)
    return tables.update(batches, again, status=F.lit("closed"), claimed_at=F.lit(None).cast("timestamp")), batches.filter(stale & (F.col("attempt_count") >= MAX_ATTEMPTS))


def orphan_edges(edges: DataFrame, batches: DataFrame) -> DataFrame:
    """Edges that a completed batch left behind."""
    return tables.known_rows(edges, batches.filter("status = 'completed'"), ["batch_id"])


def without_orphans(edges: DataFrame, batches: DataFrame) -> DataFrame:
    return tables.new_rows(edges, batches.filter("status = 'completed'"), ["batch_id"])


class Outcomes:
    """What outcomes in order do to a counter: blocked adds one, transient takes one off down to zero, definitive resets.

    From any counter x, the one behind the k-th is max(low[k], x + sums[k]) until the first reset, and low[k] from there on:
    sums without resets, and the counter that the lowest point so far, or the reset, leaves at least."""

    def __init__(self, kinds: np.ndarray):
        step = np.where(kinds == "blocked", 1, np.where(kinds == "transient", -1, 0)).astype(np.int64)
        reset = (kinds != "blocked") & (kinds != "transient")
        n = len(step)
        self.n, self.first_reset = n, int(reset.argmax()) if reset.any() else n
        sums = np.cumsum(step)
        part = np.cumsum(reset)
        base = np.concatenate([[0], sums[reset]])[part]  # a reset takes no step, so its sum is that before it
        deepest = np.minimum.accumulate(sums - part * (2 * n + 2)) + part * (2 * n + 2)  # within a part, as later parts are far below
        self.sums, self.low = sums, sums - np.where(part > 0, np.minimum(deepest, base), deepest)

    def reached(self, limit: int) -> list[int | None]:
        """For a counter of 0 to limit - 1 before: the outcome, from 1, at which the limit is first reached."""
        high = self.low >= limit
        own = int(high.argmax()) if high.any() else self.n
        most = np.maximum.accumulate(self.sums[: self.first_reset])
        from_ = np.minimum(own, np.searchsorted(most, limit - np.arange(limit)))
        from_ = np.where(from_ >= len(most), own, from_)
        return [int(k) + 1 if k < self.n else None for k in from_]

    def map(self) -> tuple[int, int | None]:
        """(a, b) of the map x -> max(a, x + b) over all of them; b is null after a reset."""
        return (int(self.low[-1]), int(self.sums[-1]) if self.first_reset == self.n else None) if self.n else (0, 0)


def blocked_state(outcomes: DataFrame, keys: list[str], order: list[str], outcome: str = "outcome", limit: int = 5) -> DataFrame:
    """Per key, over its outcomes in order: the counter at the end (blocked adds one, transient takes one off down to zero, all
    else resets) and at which outcome it first reached the limit, from 1; null if never.

    Each outcome is a map of the counter, and such maps compose: a slice of a key's outcomes is one map, and for each
    counter below the limit the place where it is reached. So a key with all outcomes is dealt to many slices, and what one
    task takes in order is a few numbers of each of its slices."""
    rows = outcomes.select(*keys, *[o for o in order if o not in keys], F.col(outcome).alias("__o"))
    dealt = in_slices(rows, keys, order)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, found in runs(batches):
            heads, out = [], []
            for _, part in found:
                own = Outcomes(part.column("__o").to_numpy().astype(str))
                heads.append(part.slice(0, 1).select(keys))
                out.append((number, own.n, *own.map(), own.reached(limit)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)]
            head = pa.concat_tables(heads).combine_chunks()
            yield pa.RecordBatch.from_arrays([*[c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in head.columns], *columns], [*keys, *numbers])

    numbers = ["__slice", "__n", "__a", "__b", "__reached"]
    kept = T.StructType([rows.schema[k] for k in keys])
    summaries = dealt.select(*keys, "__o", "__key", "__slice").mapInArrow(summarise, T.StructType([*kept, *T.StructType.fromDDL("__slice long, __n long, __a long, __b long, __reached array<long>")]))

    def compose(table: pa.Table) -> pa.Table:
        counter, before, first = 0, 0, None
        for r in sorted(table.select(numbers).to_pylist(), key=lambda r: r["__slice"]):
            at = r["__reached"][counter] if first is None else None
            first = before + at if at is not None else first
            counter = r["__a"] if r["__b"] is None else max(r["__a"], counter + r["__b"])
            before += r["__n"]
        return table.slice(0, 1).select(keys).append_column("counter", pa.array([counter], pa.int64())).append_column("blocked_at", pa.array([first], pa.int64()))

    return summaries.groupBy(*keys).applyInArrow(compose, T.StructType([*kept, T.StructField("counter", T.LongType()), T.StructField("blocked_at", T.LongType())]))


def valid_channels(edges: DataFrame) -> DataFrame:
    """batch_id, channel: the channels that a batch's valid edges lead to, each once."""
    return edges.filter("validation_status = 'valid'").select("batch_id", F.col("destination_channel").alias("channel")).distinct()


def walkback_round(batches: DataFrame, edges: DataFrame, statistics: DataFrame, known: DataFrame, now: Column, walkback_rate: int, seed: str, stale_minutes: int = 10, k: int = 1) -> Iterator[dict[str, DataFrame]]:
    """One round of the walk-back processor, as the changes to write one after the other.

    Stale batches are recovered; the k oldest ready batches are claimed; the valid edges of each give a page and edges to follow;
    the batches are completed; then their counts are added to the statistics and their edges deleted. As completion is written before
    that, a crash in between leaves completed batches with edges, which without_orphans deletes; nothing is counted twice."""
    recovered, _ = recover_batches(batches, now, stale_minutes)
    claimed, mine, processing = claim_batches(recovered, edges, now, k)
    yield {"batches": processing}
    pages, followed = graph.walk_step(claimed, valid_channels(mine), known, walkback_rate, seed)
    yield {"page_buffer": pages, "edges": followed}
    marks = claimed.select("batch_id", F.lit("completed").alias("status"), now.alias("completed_at"))
    done = processing if "completed_at" in processing.columns else processing.withColumn("completed_at", F.lit(None).cast(marks.schema["completed_at"].dataType))
    yield {"batches": tables.update_by_key(done, marks, ["batch_id"])}
    counts = tables.additive_merge(statistics, batch_statistics(mine), ["crawl_id", "source_type"])
    yield {"source_stats": counts, "pending_edges": tables.new_rows(edges, claimed, ["batch_id"])}


def validation_round(edges: DataFrame, invalid: DataFrame, known: DataFrame, verdicts: DataFrame, k: int, now: Column) -> DataFrame:
    """The pending edges after one round: the k found first are claimed, classified and updated; those without a definite
    verdict wait again. invalid, known: channel. verdicts: channel, verdict, reason."""
    claimed, validating = claim_edges(edges, k, now)
    rows = claimed.select(F.col("pending_id").alias("key"), F.col("destination_channel").alias("channel"), "discovery_time")
    found = graph.classify(rows, invalid, known, verdicts, ["discovery_time", "key"])
    return update_edges(validating, found.select(F.col("key").alias("pending_id"), F.col("status").alias("validation_status"), F.col("reason").alias("validation_reason")))
