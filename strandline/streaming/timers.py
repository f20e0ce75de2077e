"""State that acts when time passes: workers that fall silent, leases that run out, caches whose entries age."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.queues import MAX_ATTEMPTS

DAY_MS = 24 * 3600 * 1000


def _ms(at: pd.Timestamp) -> int:
    return int(at.value // 1_000_000)


def _renew(handle: StatefulProcessorHandle, at: int) -> None:
    """One timer, at this time."""
    for old in list(handle.listTimers()):
        handle.deleteTimer(old)
    handle.registerTimer(at)


class Liveness(StatefulProcessor):
    """Per worker: when it was last heard, and the work it holds. A timer fires when it has been silent too long; then it
    goes offline and its work waits again with one more try. A message afterwards brings it back; Spark gives it to the worker before
    a timer of the same batch, so a silence that lies between two messages is seen there."""

    def __init__(self, silence_ms: int):
        self.silence_ms = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "at long, offline boolean")
        self.items = handle.getMapState("items", "item string", "retries int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        latest, offline = self.seen.get() if self.seen.exists() else (0, False)
        out = []
        for r in pd.concat(list(rows)).sort_values("at").itertuples():
            if latest and not offline and _ms(r.at) - latest > self.silence_ms:
                out += self._offline(key[0], latest)
                offline = True
            latest = max(latest, _ms(r.at))
            if offline:
                offline = False
                out.append((key[0], "online", None, None, r.at))
            if r.kind == "assigned":
                self.items.updateValue((r.item,), (int(r.retries),))
            elif r.kind == "finished":
                self.items.removeKey((r.item,))
        self.seen.update((latest, offline))
        _renew(self.handle, latest + self.silence_ms + 1)
        yield _events(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        latest, _ = self.seen.get()
        self.seen.update((latest, True))
        yield _events(self._offline(key[0], latest))

    def _offline(self, worker: str, latest: int) -> list[tuple]:
        at = pd.Timestamp(latest + self.silence_ms, unit="ms")
        held = [(worker, "requeued", item[0], retries[0] + 1, at) for item, retries in self.items.iterator()]
        self.items.clear()
        return [(worker, "offline", None, None, at), *held]

    def close(self) -> None:
        pass


def _events(out: list[tuple]) -> pd.DataFrame:
    rows = pd.DataFrame(out, columns=["worker", "event", "item", "retries", "at"])
    return rows.astype({"retries": "Int32", "at": "datetime64[ns]"})


def liveness(messages: DataFrame, minutes: int = 5, late: str = "0 seconds") -> DataFrame:
    """worker, event (offline, requeued, online), item, retries, at from a stream of worker, kind (status, assigned, finished), item,
    retries, at. Times are event times: a worker is silent when the others' messages are that much later. Needs RocksDB."""
    rows = messages.withWatermark("at", late).select("worker", "kind", "item", "retries", "at")
    return rows.groupBy("worker").transformWithStateInPandas(Liveness(minutes * 60_000), "worker string, event string, item string, retries int, at timestamp", "Append", "EventTime")


class Leases(StatefulProcessor):
    """Per claimed thing: a claim sets a timer, an end takes it away. When it fires, the thing is free again, or given up if it
    has no attempt left."""

    def __init__(self, lease_ms: int, attempts: int | None):
        self.lease_ms, self.attempts = lease_ms, attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.claim = handle.getValueState("claim", "at long, attempt int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        for r in pd.concat(list(rows)).sort_values("at").itertuples():
            if self.claim.exists() and _ms(r.at) - self.claim.get()[0] > self.lease_ms:
                out.append(self._expired(key[0]))
            if r.kind == "claimed":
                self.claim.update((_ms(r.at), int(r.attempt)))
                _renew(self.handle, _ms(r.at) + self.lease_ms + 1)
            else:
                self.claim.clear()
                for old in list(self.handle.listTimers()):
                    self.handle.deleteTimer(old)
        yield self._rows(out)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._rows([self._expired(key[0])])

    def _expired(self, name: str) -> tuple:
        at, attempt = self.claim.get()
        self.claim.clear()
        status = "poison" if self.attempts is not None and attempt >= self.attempts else "closed"
        return name, status, attempt, pd.Timestamp(at + self.lease_ms, unit="ms")

    def _rows(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["id", "status", "attempt", "at"]).astype({"attempt": "int32", "at": "datetime64[ns]"})

    def close(self) -> None:
        pass


def expired_leases(claims: DataFrame, minutes: int = 10, attempts: int | None = MAX_ATTEMPTS, late: str = "0 seconds") -> DataFrame:
    """id, status (closed: free again; poison: no attempt left), attempt, at from a stream of id, kind (claimed, ended), attempt, at: batches
    as they are, edges with attempts None. Needs RocksDB."""
    rows = claims.withWatermark("at", late).select("id", "kind", "attempt", "at")
    return rows.groupBy("id").transformWithStateInPandas(Leases(minutes * 60_000, attempts), "id string, status string, attempt int, at timestamp", "Append", "EventTime")


class AgingCache(StatefulProcessor):
    """Per bucket: ids with the time they were first seen, in shards of so many. A full shard is closed and the next one opened;
    once a day a timer deletes what is too old, and shards that are left empty, but never the open one."""

    def __init__(self, keep_ms: int, shard_items: int):
        self.keep_ms, self.shard_items = keep_ms, shard_items

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ids = handle.getMapState("ids", "id string", "shard int, at long")
        self.sizes = handle.getMapState("sizes", "shard int", "n int")
        self.open = handle.getValueState("open", "shard int")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        shard = self.open.get()[0] if self.open.exists() else 0
        size = self.sizes.getValue((shard,))[0] if self.sizes.containsKey((shard,)) else 0
        out = []
        for r in pd.concat(list(rows)).sort_values(["at", "id"]).itertuples():
            at = _ms(r.at)
            known = self.ids.getValue((r.id,)) if self.ids.containsKey((r.id,)) else None
            if known is not None and at - known[1] <= self.keep_ms:
                continue
            if known is not None:
                size -= self._forget(r.id, known[0], shard)
            if size >= self.shard_items:
                self.sizes.updateValue((shard,), (size,))
                shard, size = shard + 1, 0
            self.ids.updateValue((r.id,), (shard, at))
            size += 1
            out.append((r.id, r.at, shard))
        self.sizes.updateValue((shard,), (size,))
        self.open.update((shard,))
        if not list(self.handle.listTimers()):
            self.handle.registerTimer(max(timerValues.getCurrentWatermarkInMs(), 0) + DAY_MS)
        yield pd.DataFrame(out, columns=["id", "at", "shard"]).astype({"shard": "int32", "at": "datetime64[ns]"})

    def _forget(self, name: str, shard: int, open_shard: int) -> int:
        """Delete an id; 1 if it was in the open shard, whose size the caller keeps."""
        self.ids.removeKey((name,))
        if shard == open_shard:
            return 1
        n = self.sizes.getValue((shard,))[0] - 1
        if n:
            self.sizes.updateValue((shard,), (n,))
        else:
            self.sizes.removeKey((shard,))
        return 0

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        now, shard = timerValues.getCurrentWatermarkInMs(), self.open.get()[0]
        old = [(name[0], v[0]) for name, v in self.ids.iterator() if now - v[1] > self.keep_ms]
        gone = sum(self._forget(name, s, shard) for name, s in old)
        self.sizes.updateValue((shard,), (self.sizes.getValue((shard,))[0] - gone,))
        self.handle.registerTimer(now + DAY_MS)
        yield pd.DataFrame({"id": pd.Series(dtype=str), "at": pd.Series(dtype="datetime64[ns]"), "shard": pd.Series(dtype="int32")})

    def close(self) -> None:
        pass


def first_seen(rows: DataFrame, buckets: int = 256, days: int = 30, shard_items: int = 5000, late: str = "0 seconds") -> DataFrame:
    """bucket's id, at, shard of the rows (id, at) of a stream whose id wasn't seen within so many days before: media to fetch, or
    channels to look up. Ids are dealt to buckets by hash, so that no state is that of all. Needs RocksDB."""
    placed = rows.withWatermark("at", late).select(F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"), "id", "at")
    return placed.groupBy("bucket").transformWithStateInPandas(AgingCache(days * DAY_MS, shard_items), "id string, at timestamp, shard int", "Append", "EventTime")
