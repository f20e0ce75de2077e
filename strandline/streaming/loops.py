"""Streams of edges, messages and worker status."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators import stats
from ..sources.files import history_bounds


def file_stream(spark: SparkSession, path: str, schema: str, most_files: int = 1000, fmt: str = "json") -> DataFrame:
    """A watched folder: files seen once each, in batches of at most `most_files`."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).format(fmt).load(path)


def history_stream(spark: SparkSession, path: str, schema: str, at: str, since: Column | None = None, most_files: int = 1000) -> DataFrame:
    """Messages of a stored history (files.write_history) as they come: files seen once each, also over restarts, and of those of earlier
    days than the bound nothing is read."""
    rows = spark.readStream.schema(f"{schema}, channel STRING, day DATE").option("maxFilesPerTrigger", most_files).json(path)
    return rows.filter(history_bounds(at, since, None))


def topic(messages: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """JSON messages of a topic (a Kafka value or a text line) as columns; unreadable ones are left out."""
    return messages.select(F.from_json(F.col(value).cast("string"), schema).alias("m")).filter("m IS NOT NULL").select("m.*")


def publish(rows: DataFrame) -> DataFrame:
    """Rows as the JSON text of a topic."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process all that is there in micro-batches. `each` must give the same result when a batch number comes again."""
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


class FirstRow(StatefulProcessor):
    """Per key: whether a row of it was passed on. Of a batch's rows the first in order is."""

    def __init__(self, columns: list[str], order: list[str]):
        self.columns, self.order = columns, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.claimed = handle.getValueState("claimed", "yes boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        first = None
        for part in rows:  # a key with very many rows comes in parts
            best = pd.concat([part, first] if first is not None else [part]).sort_values(self.order, kind="stable").head(1)
            first = best
        if first is not None and not self.claimed.exists():
            self.claimed.update((True,))
            yield first[self.columns]

    def close(self) -> None:
        pass


def first_of_each(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key over all batches, by its state; what a batch costs doesn't depend on those before. Of rows that
    come in one batch the least in `order` is first. Needs RocksDB."""
    return stream.groupBy(key).transformWithStateInPandas(FirstRow(stream.columns, order), stream.schema, "Append", "None")


def first_discoveries(spark: SparkSession, stream: DataFrame, state: str, checkpoint: str, key: str, order: list[str]) -> StreamingQuery:
    """Keep the first row of each key over all batches: batch n adds its new keys as the folder batch=n, which is written
    again if the batch comes again; earlier ones stay as they are and aren't read."""

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/batch={number}")

    return run_available(first_of_each(stream, key, order), each, checkpoint)


def discoveries(spark: SparkSession, state: str) -> DataFrame:
    """What first_discoveries has kept, with the number of the batch."""
    return spark.read.parquet(state)


def validation_loop(spark: SparkSession, stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], DataFrame], out: str) -> StreamingQuery:
    """Run a step on each batch and keep its rows in a folder of its own, so a batch that comes again replaces them."""

    def each(batch: DataFrame, number: int) -> None:
        step(batch, number).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return run_available(stream, each, checkpoint)


def heartbeats(status: DataFrame) -> DataFrame:
    """Last message of each worker, as a streaming aggregate."""
    return stats.last_seen(status, "worker_id", "timestamp", "status")


class Blocked(StatefulProcessor):
    """Per validator: counts blocked outcomes net of transient ones, and tells when it has to pause and when it may go on."""

    LIMIT = 5

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counter = handle.getValueState("counter", "n int, paused boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, paused = self.counter.get() if self.counter.exists() else (0, False)
        out = []
        for r in pd.concat(list(rows)).sort_values("at").itertuples():
            n = n + 1 if r.outcome == "blocked" else max(0, n - 1) if r.outcome == "transient" else 0
            if not paused and n >= self.LIMIT:
                paused = True
                out.append((key[0], r.at, "paused"))
            elif paused and r.outcome == "definitive":
                paused = False
                out.append((key[0], r.at, "resumed"))
        self.counter.update((n, paused))
        yield pd.DataFrame(out, columns=["validator", "at", "event"])

    def close(self) -> None:
        pass


def blocked_events(outcomes: DataFrame) -> DataFrame:
    """validator, at, event (paused or resumed) from a stream of validator, at, outcome; needs the RocksDB state store."""
    return outcomes.groupBy("validator").transformWithStateInPandas(Blocked(), "validator string, at timestamp, event string", "Append", "None")
