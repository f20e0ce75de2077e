"""Remove passages that occur earlier in the corpus: a count-min sketch picks windows, an exact grouping settles them."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROLL_BASE_1, ROLL_BASE_2, id_key, materialise, partitions, rolling_hashes, sliding_argmin, span_hashes, text_bytes, text_slices, word_spans

#: Anchors or windows that a task holds before it passes them on, and text bytes of a home, of a shard of the sketch, and of
#: a task.
HELD, HOME_BYTES, SHARD_BYTES, TASK_BYTES = 1 << 20, 1 << 24, 1 << 26, 1 << 27
#: Text bytes for each anchor, at least as far as texts have words of ordinary length; a shard with more anchors overestimates more.
ANCHOR_BYTES = 24
DEPTH, RATE = 3, 0.01
#: Rows that repeat id and text from which on they spread, and such groups that are broadcast at most (16 bytes each).
REPEATS, BROADCAST_ROWS = 1024, 1 << 20
_ROW_FACTORS = (0xC2B2AE3D27D4EB4F, 0x9E3779B185EBCA87, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_START_FACTOR = np.uint64(0x165667B19E3779F9)


class Scan:
    """The windows of some texts. Each window has an anchor: the leftmost least hash of its runs of a few words. Equal
    windows have equal anchors, so an anchor is at least as frequent as any of its windows, and neighbouring windows mostly
    share one; the sketch counts anchors, one for each stretch of windows."""

    def __init__(self, texts: pa.Array, window: int):
        self.data, self.offsets = text_bytes(texts)
        starts, ends, self.first = word_spans(self.data, self.offsets)
        self.n_words = np.diff(self.first)
        self.hashes = span_hashes(self.data, starts, ends)
        n = len(starts)
        if n < window:
            self.where = np.zeros(0, np.int64)
            self.anchors = np.zeros(0, np.uint64)
            self.stretch = np.zeros(0, np.int64)
            return
        text = np.repeat(np.arange(len(self.n_words)), self.n_words)
        gram = max(1, min(8, window // 2))
        values = rolling_hashes(self.hashes, gram)
        at = sliding_argmin(values, window - gram + 1)
        inside = text[: n - window + 1] == text[window - 1 :]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
        #: first words of the windows, their stretches, the anchors of the stretches
        self.where = np.flatnonzero(inside)
        self.stretch = (np.cumsum(opens) - 1)[self.where]
        self.anchors = values[at[opens]]


def sketch_bits(anchors: float, rate: float, depth: int = DEPTH) -> int:
    """Counters of a row, as a power of two, with which at most that share of so many different anchors is overestimated:
    another one shares each of its cells."""
    return max(8, math.ceil(math.log2(max(1.0, anchors) / -math.log(1 - rate ** (1 / depth)))))


class Sketch:
    """A count-min sketch: rows of counters, each of which stops at 2. A value is counted in a cell of each row, sketches
    are merged by addition, and the estimate, the least of a value's counters, is never under its count."""

    def __init__(self, bits: int, depth: int = DEPTH):
        self.bits = bits
        self.counters = np.zeros((depth, 1 << bits), np.uint8)

    def _cells(self, row: int, values: np.ndarray) -> np.ndarray:
        return ((values * np.uint64(_ROW_FACTORS[row])) >> np.uint64(64 - self.bits)).astype(np.int64)

    def add(self, values: np.ndarray) -> None:
        for row, counters in enumerate(self.counters):
            found = np.bincount(self._cells(row, values), minlength=len(counters))
            np.minimum(found + counters, 2, out=counters, casting="unsafe")

    def repeated(self, values: np.ndarray) -> np.ndarray:
        """Which values have an estimate of 2."""
        out = np.ones(len(values), bool)
        for row, counters in enumerate(self.counters):
            out &= counters[self._cells(row, values)] > 1
        return out


def anchor_keys(anchors: np.ndarray) -> np.ndarray:
    """40 bits of each anchor, which travel for it."""
    return (anchors * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(24)


def _narrow(values: np.ndarray) -> bytes:
    """Keys as five bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def repeated_keys(placed: DataFrame, window: int, shards: int, bits: int) -> DataFrame:
    """home, keys: for each home of documents the keys of its anchors that the count-min sketch estimates at two or more.

    The sketch is in shards by key, each with DEPTH rows of 2**bits counters. A task's own sketch is sparse, so what it sends
    for each shard and home is the keys that it counted (twice at most each), from which the counters follow. A shard adds
    up what all tasks sent and answers each home. So no task holds more than a shard, and none of it passes through the
    driver. Anchors that share cells only raise an estimate, so no repeated window is lost."""
    n_parts = max(partitions(placed.sparkSession), shards // 16)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in text_slices(batches, "text"):
            scan = Scan(batch.column("text"), window)
            if len(scan.where):
                opens = np.flatnonzero(np.concatenate([[True], scan.stretch[1:] != scan.stretch[:-1]]))
                text = np.searchsorted(scan.first, scan.where[opens], side="right") - 1
                held.append((batch.column("home").to_numpy()[text], anchor_keys(scan.anchors)))
                n += len(opens)
            if n >= HELD:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        home, cell = (np.concatenate(x) for x in zip(*held, strict=True))
        shard = (cell % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((cell, home, shard))
        home, cell, shard = home[order], cell[order], shard[order]
        same = np.zeros(len(cell), bool)  # a third of one cell in a bucket tells nothing more
        same[2:] = (cell[2:] == cell[:-2]) & (home[2:] == home[:-2])
        home, cell, shard = home[~same], cell[~same], shard[~same]
        new = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (home[1:] != home[:-1])]))
        ends = np.append(new[1:], len(cell))
        blobs = [_narrow(cell[a:b]) for a, b in zip(new, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(shard[new]), pa.array(home[new]), pa.array(blobs, pa.binary())], ["shard", "home", "keys"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "shard"):
            sketch = Sketch(bits)
            blobs = [_wide(x) for x in rows["keys"]]
            sketch.add(np.concatenate(blobs))
            told = [(h, np.unique(b[sketch.repeated(b)])) for h, b in zip(rows["home"], blobs, strict=True)]
            told = [(h, _narrow(b)) for h, b in told if len(b)]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in told], pa.int64()), pa.array([b for _, b in told], pa.binary())], ["home", "keys"])

    counted = placed.mapInArrow(count, "shard long, home long, keys binary")
    return counted.repartition(n_parts, "shard").sortWithinPartitions("shard").mapInArrow(answer, "home long, keys binary")


def _firsts(h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Places of the earliest of each group of equal windows, and of all that tie with it."""
    order = np.lexsort((start, doc, h2, h1))
    a, b = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    return order[(doc[order] == doc[first]) & (start[order] == start[first])]


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, rate: float = RATE) -> DataFrame:
    """The id, n_words, n_removed and kept_sha256 of substring_rows."""
    rows = substring_rows(docs, id_col, text_col, window, rate=rate)
    return rows.select(F.col("row")[id_col].alias(id_col), "n_words", "n_removed", "kept_sha256")


def substring_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, carry: Sequence[str] = (), texts: bool = False, rate: float = RATE) -> DataFrame:
    """Remove each word covered by a window of words that also starts earlier.

    Words are maximal runs of bytes outside [\\x20\\x09-\\x0D]. Earlier means in a document of smaller id, or in the same
    document before it; windows are judged on the input. Returns one row per input row: row (a struct of the id and the
    carried columns, under their own names), n_words, n_removed, kept_sha256 (of the kept words joined by one space) and
    kept_text (null without `texts`).

    Null and empty texts have no words. A null id is the largest id. Rows that share an id count as one document whose
    texts start at the same place: of their equal windows with equal starts both stay. Empty tables give no rows.

    Documents are dealt once to homes of about 16 MB by a hash of id and text, so rows that share an id spread (rows that repeat
    both, too, where they are many), and each pass reads the homes. The first counts anchors in the sketch, whose rows are wide enough that about `rate` of the
    anchors that aren't repeated pass; the second sends the windows estimated repeated to an exact grouping by 128 bits of
    hash, combined in each task first, so that a frequent window is a few rows. The grouping gives the earliest place of
    each window; places go back to the homes, and there a candidate that isn't an earliest place is removed. No home grows
    with a popular passage. Columns of the input may have any names.
    """
    spark = docs.sparkSession
    held = F.struct(*[docs[c].alias(c) for c in dict.fromkeys([id_col, *carry])])
    rows = docs.select(held.alias("row"), id_key(id_col).alias("doc"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    counted = materialise(rows.groupBy(F.xxhash64("doc", "text").alias("same")).agg(F.count("*").alias("often"), F.sum(F.octet_length("text").cast("long")).alias("size")), "rows")
    n_bytes = counted.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    homes = buckets = max(64, n_bytes // HOME_BYTES)
    n_parts = max(partitions(spark), n_bytes // TASK_BYTES)
    shards = max(partitions(spark), n_bytes // SHARD_BYTES)
    same = rows.withColumn("same", F.xxhash64("doc", "text"))
    frequent = counted.filter((F.col("often") > REPEATS) & (F.col("size") > HOME_BYTES // 16)).select("same", F.ceil(F.greatest(F.col("often") / REPEATS, F.col("size") * 16 / HOME_BYTES)).alias("places"))
    n_frequent = frequent.count()
    if n_frequent:  # rows that repeat id and text go to several homes, by their places in the table
        same = same.join(F.broadcast(frequent) if n_frequent <= BROADCAST_ROWS else frequent, "same", "left")
        same = same.withColumn("same", F.when(F.col("places").isNotNull(), F.xxhash64("same", F.pmod(F.monotonically_increasing_id(), F.col("places")))).otherwise(F.col("same")))
    placed = same.select("row", "doc", "text", F.pmod("same", F.lit(homes)).alias("home")).repartition(n_parts, "home")  # all passes read the same shuffle

    def candidates(scan: Scan, repeated: np.ndarray) -> np.ndarray:
        """First words of the windows whose anchor's key is one of the sorted repeated ones."""
        if not len(scan.where) or not len(repeated):
            return scan.where[:0]
        keys = anchor_keys(scan.anchors)
        near = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
        return scan.where[(repeated[near] == keys)[scan.stretch]]

    def repeated_of(right: pa.Table) -> np.ndarray:
        found = [_wide(x.as_py()) for x in right.column("keys") if x.is_valid]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)

    def windows(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        repeated = repeated_of(right)
        parts: list[tuple[np.ndarray, ...]] = []
        out: list[pa.RecordBatch] = []
        n = 0
        for batch in text_slices(iter(left.combine_chunks().to_batches()), "text"):
            scan = Scan(batch.column("text"), window)
            at = candidates(scan, repeated)
            if not len(at):
                continue
            text = np.searchsorted(scan.first, at, side="right") - 1
            doc = batch.column("doc").to_numpy()[text]
            parts.append((rolling_hashes(scan.hashes, window, ROLL_BASE_1)[at], rolling_hashes(scan.hashes, window, ROLL_BASE_2)[at], doc, (at - scan.first[text]).astype(np.int32)))
            n += len(at)
            if n >= HELD:
                out.append(combined(parts, key[0].as_py()))
                parts, n = [], 0
        if parts:
            out.append(combined(parts, key[0].as_py()))
        return pa.Table.from_batches(out, sent_schema)

    def combined(parts: list[tuple[np.ndarray, ...]], home: int) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        least = _firsts(*columns)
        bucket = (columns[0][least] >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        sent = _blobs("bucket", bucket[order].astype(np.int64), [c[least][order] for c in columns], ["h1", "h2", "doc", "start"])
        return sent.add_column(1, "home", pa.array(np.full(sent.num_rows, home)))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "bucket"):
            h1, h2, doc, start = (np.concatenate([np.frombuffer(x, t) for x in rows[c]]) for c, t in (("h1", np.uint64), ("h2", np.uint64), ("doc", np.int64), ("start", np.int32)))
            home = np.repeat(np.array(rows["home"], np.int64), [len(x) // 8 for x in rows["h1"]])
            least = _firsts(h1, h2, doc, start)
            least = least[np.argsort(home[least], kind="stable")]
            yield _blobs("home", home[least], [doc[least], start[least], h1[least]], ["places", "start", "h1"])

    def remove(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        repeated = repeated_of(right)
        doc, start, h1 = (np.concatenate([np.frombuffer(x.as_buffer(), t) for x in right.column(c) if x.is_valid] or [np.zeros(0, t)]) for c, t in (("places", np.int64), ("start", np.int32), ("h1", np.uint64)))
        order = np.argsort(doc, kind="stable")
        doc, place = doc[order], h1[order] + start[order].astype(np.uint64) * _START_FACTOR  # a window at its place
        out: list[tuple] = []
        batches = text_slices(iter(left.combine_chunks().to_batches()), "text")
        rows_done: list[pa.Array] = []
        for batch in batches:
            scan = Scan(batch.column("text"), window)
            flagged = candidates(scan, repeated)
            bounds = np.searchsorted(flagged, scan.first)
            h1 = rolling_hashes(scan.hashes, window, ROLL_BASE_1)[flagged] if len(flagged) else np.zeros(0, np.uint64)
            ids = batch.column("doc").to_numpy()
            lo, hi = np.searchsorted(doc, ids), np.searchsorted(doc, ids, side="right")
            for k in range(batch.num_rows):
                raw = scan.data[scan.offsets[k] : scan.offsets[k + 1]].tobytes()
                found, n = raw.split(), int(scan.n_words[k])
                mine = flagged[bounds[k] : bounds[k + 1]] - scan.first[k]
                at = h1[bounds[k] : bounds[k + 1]] + mine.astype(np.uint64) * _START_FACTOR
                gone = mine[~np.isin(at, place[lo[k] : hi[k]])] if len(mine) else mine
                removed = 0
                if len(gone):
                    edge = np.zeros(n + 1, np.int32)
                    np.add.at(edge, gone, 1)
                    np.add.at(edge, gone + window, -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    removed = n - int(keep.sum())
                    found = list(compress(found, keep.tolist()))
                kept = b" ".join(found)
                out.append((n, removed, hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None))
            rows_done.append(batch.column("row"))
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        row = pa.chunked_array(rows_done, left.schema.field("row").type)
        return pa.table([row, *[pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]], names=["row", "n_words", "n_removed", "kept_sha256", "kept_text"])

    sent_schema = pa.schema([("bucket", pa.int64()), ("home", pa.int64()), *[(c, pa.binary()) for c in ("h1", "h2", "doc", "start")]])
    told = repeated_keys(placed, window, shards, sketch_bits(n_bytes / shards / ANCHOR_BYTES, rate))
    sent = placed.groupBy("home").cogroup(told.groupBy("home")).applyInArrow(windows, "bucket long, home long, h1 binary, h2 binary, doc binary, start binary")
    firsts = sent.repartition(n_parts, "bucket").sortWithinPartitions("bucket").mapInArrow(places, "home long, places binary, start binary, h1 binary")
    none = F.lit(None).cast("binary")
    known = told.select("home", "keys", none.alias("places"), none.alias("start"), none.alias("h1")).union(firsts.select("home", none, "places", "start", "h1"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return placed.groupBy("home").cogroup(known.groupBy("home")).applyInArrow(remove, schema)


def _blobs(name: str, keys: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row for each key, with the key's values of each column as bytes; keys are sorted."""
    bounds = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(bounds[1:], len(keys))
    arrays = [pa.array([c[a:b].tobytes() for a, b in zip(bounds, ends, strict=True)], pa.binary()) for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(keys[bounds], pa.int64()), *arrays], [name, *names])


def _runs(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[dict[str, list]]:
    """The rows of each key of a partition that is sorted by it, by column."""
    key, held = None, None
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        for k, at in enumerate(columns[name]):
            if held is None or at != key:
                if held is not None:
                    yield held
                key, held = at, {c: [] for c in columns}
            for c, values in columns.items():
                held[c].append(values[k])
    if held is not None:
        yield held
