"""The layerless crawl: pages are popped from a buffer, processed and replaced by what they lead to, until a stop rule holds."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph, tables
from ..operators.slices import ensure_checkpoints


class ValidatorStalled(RuntimeError):
    """Nothing is left to do but batches that the validator doesn't complete."""


@dataclass
class Limits:
    """seconds: longest run (0: none). validator_seconds: how long to wait for the validator's batches alone (0: for ever). poll: pause
    while waiting. rounds: most rounds (-1: none)."""

    seconds: float = 0
    validator_seconds: float = 0
    poll: float = 5
    rounds: int = -1


@dataclass
class Tandem:
    """What a validator beside the crawl says: batches not completed yet, and the pages that those completed gave since the
    last look. clock and sleep are those of the machine unless tests bring their own."""

    incomplete: Callable[[], int] = lambda: 0
    pages: Callable[[], DataFrame | None] = lambda: None
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep


@dataclass
class Outcome:
    """Why a run ended (done, time, rounds), how many rounds it took, the pages processed and those still in the buffer."""

    reason: str
    rounds: int
    pages: DataFrame
    buffer: DataFrame
    waited: list[float] = field(default_factory=list)


def links_of(edges: DataFrame) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """A step that follows all edges (source, destination) of its pages; every page is done with."""

    def step(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = pages.join(edges.select(F.col("source").alias("url"), F.col("destination").alias("__to")), "url")
        found = found.select(F.col("__to").cast("string").alias("page_id"), F.col("__to").alias("url"), (F.col("depth") + 1).alias("depth"), "crawl_id")
        return found, pages.select("page_id")

    return step


def run_frontier(buffer: DataFrame, step: Callable[[DataFrame], tuple[DataFrame, DataFrame]], crawl_id: str, n: int, limits: Limits | None = None, tandem: Tandem | None = None, processed: DataFrame | None = None) -> Outcome:
    """Run a crawl's buffer (page_id, url, depth, crawl_id) to its end.

    Each round pops up to n pages, those of least depth and id first, and gives them to `step`, which returns the pages they lead
    to and the ids of those that are done with; others stay in the buffer for another run (a walk back that found nothing, a
    connection lost) and aren't tried again in this one. New pages whose url was processed or is buffered are left out. The run is over
    when nothing can be popped and no batch of the validator is incomplete; while some are, it waits, and raises ValidatorStalled when
    they alone have been waited for too long. The duration is looked at before each round. `processed`: pages of an earlier run.

    Buffer and processed pages are checkpointed each round, so a round's lineage is its own, and a run can go on from an
    Outcome's tables."""
    limits, tandem = limits or Limits(), tandem or Tandem()
    ensure_checkpoints(buffer.sparkSession)
    columns = ["page_id", "url", "depth", "crawl_id"]
    buffer = buffer.select(*columns).checkpoint()
    done = (processed.select(*columns) if processed is not None else buffer.limit(0)).checkpoint()
    tried = buffer.limit(0).select("page_id")
    began, waiting, rounds, waited = tandem.clock(), None, 0, []

    def outcome(reason: str) -> Outcome:
        return Outcome(reason, rounds, done, buffer, waited)

    while True:
        if limits.seconds and tandem.clock() - began >= limits.seconds:
            return outcome("time")
        if limits.rounds >= 0 and rounds >= limits.rounds:
            return outcome("rounds")
        brought = tandem.pages()
        if brought is not None:
            fresh = tables.new_rows(tables.new_rows(brought.select(*columns), done, ["url"]), buffer, ["url"])
            buffer = buffer.unionByName(tables.first_wins(fresh, ["url"], ["depth", "page_id"]).select(*columns)).checkpoint()
        pages = graph.pop(tables.new_rows(buffer, tried, ["page_id"]), crawl_id, n).checkpoint()
        if pages.isEmpty():
            left = tandem.incomplete()
            if not left:
                return outcome("done")
            waiting = tandem.clock() if waiting is None else waiting
            waited.append(tandem.clock() - waiting)
            if limits.validator_seconds and waited[-1] >= limits.validator_seconds:
                raise ValidatorStalled(f"{left} incomplete batches after {waited[-1]:.0f} seconds without progress")
            tandem.sleep(limits.poll)
            continue
        waiting, rounds = None, rounds + 1
        found, finished = step(pages)
        finished = finished.select("page_id").distinct().checkpoint()
        done = done.unionByName(tables.known_rows(pages, finished, ["page_id"])).checkpoint()
        tried = tried.unionByName(tables.new_rows(pages.select("page_id"), finished, ["page_id"])).checkpoint()
        kept = graph.remove_pages(buffer, crawl_id, finished)
        fresh = tables.new_rows(tables.new_rows(found.select(*columns), done, ["url"]), kept, ["url"])
        buffer = kept.unionByName(tables.first_wins(fresh, ["url"], ["depth", "page_id"]).select(*columns)).checkpoint()
