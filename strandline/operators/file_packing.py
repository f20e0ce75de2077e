"""Combining small files: greedy packing in order, with a size that triggers a batch and one that none may exceed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .slices import begins, in_slices, runs

#: Sizes in bytes at which a batch is sent, and that it never exceeds.
TRIGGER, HARD_CAP = 170 << 20, 200 << 20


class Run:
    """Sizes of some files in order, none over the cap: how they are packed from any filling of the bin they begin in.

    If a bin starts at a file, where the next one starts doesn't depend on what was before: at the file that would exceed the cap, or
    after the one that reaches the trigger. So each place has one successor, which sums of sizes find, and
    doubling the successors gives the last bin that a bin leads to, how full it is, and how many bins on."""

    def __init__(self, sizes: np.ndarray, trigger: int | None, cap: int):
        self.n, self.cap = len(sizes), cap
        self.sums = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        over = np.searchsorted(self.sums, self.sums[:-1] + cap, side="right") - 1  # the file that would exceed the cap
        full = np.searchsorted(self.sums, self.sums[:-1] + trigger, side="left") if trigger is not None else np.full(self.n, self.n + 1)
        full = np.maximum(full, np.arange(self.n) + 1)
        #: where the next bin starts; n: with the first file behind these, n + 1: this bin is still open
        self.next = np.append(np.where(np.minimum(over, full) < self.n, np.minimum(over, full), np.where(full == self.n, self.n, self.n + 1)), [self.n + 1, self.n + 1])
        self.next[self.next <= np.arange(self.n + 2)] = self.n + 1
        # the fillings from which the first new bin starts at a file (0..n) or before it
        thresholds = np.concatenate([cap - self.sums[1:] + 1, [np.iinfo(np.int64).max]])
        if trigger is not None:
            thresholds[1:] = np.minimum(thresholds[1:], trigger - self.sums[1:])
        self.thresholds = np.minimum.accumulate(thresholds)
        jump, bins = self.next.copy(), (self.next <= self.n).astype(np.int64)
        last = np.where(self.next <= self.n, self.next, np.arange(self.n + 2))
        while (jump[: self.n + 1] <= self.n).any():
            bins, last, jump = bins + bins[jump], last[jump] * (jump <= self.n) + last * (jump > self.n), jump[jump]
        #: from a bin that starts at a place: bins that start later, and the filling at the end
        self.bins, self.filling = bins[: self.n + 1], self.sums[-1] - self.sums[last[: self.n + 1]]

    def first_start(self, filling: int) -> int | None:
        """The file at which the first new bin starts (n: the one behind), if any does."""
        at = int(np.searchsorted(-self.thresholds, -filling))
        return at if at <= self.n and self.thresholds[at] <= filling else None

    def after(self, filling: int, number: int) -> tuple[int, int]:
        """Filling and number of the bin that is open behind these files."""
        at = self.first_start(filling)
        return (filling + int(self.sums[-1]), number) if at is None else (int(self.filling[at]), number + 1 + int(self.bins[at]))

    def numbers(self, filling: int, number: int) -> np.ndarray:
        """The bin of each file."""
        starts, at = [], self.first_start(filling)
        while at is not None and at < self.n:
            starts.append(at)
            at = int(self.next[at])
        return number + np.searchsorted(np.array(starts, np.int64), np.arange(self.n), side="right")

    def table(self) -> tuple[list[int], list[int], list[int]]:
        """after() for all fillings from 0 to the cap, as rising fillings from which on a filling and a count hold. A negative filling
        (-1 - bytes) says that the bin stays open and grows."""
        from_, filling, bins = [0], [-1 - int(self.sums[-1])], [0]
        at = np.flatnonzero(np.concatenate([[True], self.thresholds[1:] < self.thresholds[:-1]]) & (self.thresholds <= self.cap))
        for k in at[::-1].tolist():
            row = max(0, int(self.thresholds[k])), int(self.filling[k]), 1 + int(self.bins[k])
            if row[0] == from_[-1]:
                from_.pop(), filling.pop(), bins.pop()
            if not from_ or row[1:] != (filling[-1], bins[-1]):
                from_.append(row[0]), filling.append(row[1]), bins.append(row[2])
        return from_, filling, bins


def _take(state: tuple[str | None, int, int], row: dict) -> tuple[str | None, int, int]:
    """The state (key, filling, number of the open bin) behind a slice, from the one before it."""
    key, filling, number = state
    if key != row["first_key"]:
        filling, number = 0, 0
    if row["own_key"]:  # its last key begins inside
        return row["last_key"], row["filling"], row["number"]
    at = int(np.searchsorted(row["from"], filling, side="right")) - 1
    to, more = row["fillings"][at], row["bins"][at]
    return row["last_key"], filling - 1 - to if to < 0 else to, number + more


def _joined(rows: list[dict]) -> dict:
    """What several slices do, one after the other."""
    first = rows[0]
    out = first | {"last_key": rows[-1]["last_key"]}
    apart = next((k for k in range(len(rows)) if rows[k]["own_key"] or k and rows[k]["first_key"] != rows[k - 1]["last_key"]), None)
    if apart is not None:
        state = (None, 0, 0)
        for row in rows[apart:]:
            state = _take(state, row)
        return out | {"own_key": True, "filling": state[1], "number": state[2], "from": [], "fillings": [], "bins": []}
    table: list[tuple[int, int, int]] = []
    for k, start in enumerate(first["from"]):
        end = first["from"][k + 1] if k + 1 < len(first["from"]) else None
        # within a stretch of fillings what comes out is one filling, or grows with what goes in
        points, grows, bins = [start], first["fillings"][k], first["bins"][k]
        for row in rows[1:]:
            if grows >= 0:
                break
            points += [x for x in (f - (-1 - grows) for f in row["from"]) if x > start and (end is None or x < end)]
            grows += min(row["fillings"], default=0) + 1
        for point in sorted(set(points)):
            state = ("", point, 0)
            opened = True
            for row in rows:
                before = state
                state = _take((row["first_key"], *state[1:]), row)
                opened = opened and state[2] == before[2]
            table.append((point, -1 - (state[1] - point) if opened else state[1], state[2]))
    table = [row for k, row in enumerate(table) if not k or row[1:] != table[k - 1][1:]]
    return out | {"from": [r[0] for r in table], "fillings": [r[1] for r in table], "bins": [r[2] for r in table]}


def pack(files: DataFrame, order: list[str], size: str = "size", trigger: int | None = TRIGGER, cap: int = HARD_CAP, keys: list[str] | None = None) -> DataFrame:
    """Files with their bin; files over the cap have bin null (dropped). Within a key (a watched folder) in order.

    A bin closes before it would exceed the cap, and as soon as it reaches the trigger (None: never). A null size counts as 0.
    The order must be that of distinct rows; of equal ones any may come first.

    Where the next bin starts depends on all before. Files are dealt to slices of their order; a slice's summary says for any
    filling of the bin that is open before it what it leaves behind, as a table that is no longer than the files
    of one bin. Summaries are composed in groups (`slices.begins`), then each slice numbers its own files. No task sees more
    files than a slice has."""
    keys = keys or []
    rows = files.select(*keys, *[o for o in order if o not in keys], F.coalesce(F.col(size).cast("bigint"), F.lit(0)).alias(size))
    dealt = in_slices(rows, keys, order)

    def sizes_of(table: pa.Table) -> np.ndarray:
        return table.column(size).to_numpy()

    def run_of(table: pa.Table) -> Run:
        sizes = sizes_of(table)
        return Run(sizes[sizes <= cap], trigger, cap)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, found in runs(batches):
            row = {"slice": number, "first_key": found[0][0], "last_key": found[-1][0], "own_key": len(found) > 1, "filling": 0, "number": 0, "from": [], "fillings": [], "bins": []}
            if len(found) > 1:
                row["filling"], row["number"] = run_of(found[-1][1]).after(0, 0)
            else:
                row["from"], row["fillings"], row["bins"] = run_of(found[0][1]).table()
            yield pa.RecordBatch.from_pylist([row], schema=summary)

    longs = pa.list_(pa.int64())
    summary = pa.schema([("slice", pa.int32()), ("first_key", pa.string()), ("last_key", pa.string()), ("own_key", pa.bool_()), ("filling", pa.int64()), ("number", pa.int64()), ("from", longs), ("fillings", longs), ("bins", longs)])
    summaries = dealt.mapInArrow(summarise, "slice int, first_key string, last_key string, own_key boolean, filling long, number long, from array<long>, fillings array<long>, bins array<long>").checkpoint()
    state = T.StructType.fromDDL("key string, filling long, number long")
    starts = begins(summaries, (None, 0, 0), state, _take, _joined)

    def number(_: tuple, table: pa.Table, given: pa.Table) -> pa.Table:
        table = table.sort_by([("__place", "ascending")])
        (key, filling, first), out = (given.column(c)[0].as_py() for c in ("key", "filling", "number")), []
        for _, found in runs(iter(table.to_batches())):
            for mine, part in found:
                kept = sizes_of(part) <= cap
                bins = np.zeros(len(kept), np.int32)
                bins[kept] = run_of(part).numbers(*((filling, first) if mine == key else (0, 0)))
                out.append(pa.array(bins, mask=~kept))
                key = mine if mine == key else None
        return table.select(names).append_column("bin", pa.chunked_array(out))

    names = rows.columns
    placed = dealt.withColumn("__place", F.monotonically_increasing_id()).withColumn("slice", F.col("__slice").cast("long"))
    return placed.groupBy("slice").cogroup(starts.groupBy("slice")).applyInArrow(number, T.StructType([*rows.schema, T.StructField("bin", T.IntegerType())]))


def stale_files(manifest: DataFrame, now: Column, days: int) -> DataFrame:
    return manifest.filter(F.col("mtime") < now - F.expr(f"INTERVAL {days} DAYS"))


def media_to_store(media: DataFrame, seen: DataFrame, now: Column, most_bytes: int = 150 << 20, days: int = 30) -> DataFrame:
    """Media files small enough and not stored within the last days."""
    fresh = seen.filter(F.col("first_seen") >= now - F.expr(f"INTERVAL {days} DAYS")).select("media_id")
    return media.filter(F.col("size") <= most_bytes).join(fresh, "media_id", "left_anti")
