"""Remove bytes of strings that occur more than once: suffixes at chosen places, sorted in range-partitioned buckets.

Every window of so many bytes has an anchor: the place of the least hash of its short runs of bytes, leftmost of equals. Equal
windows have equal anchors, so suffixes that start at anchors are all that needs sorting. The windows of an anchor are a
stretch of bytes around it; each is as many bytes to the left of the anchor (its offset) as to the right that fill it up."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROLL_BASE_1, ROLL_BASE_2, _inverse, materialise, mix, partitions, powers, text_bytes, text_slices
from .substring import _blobs, _narrow, _runs, _wide, anchor_keys

#: Text bytes of a home, of a shard of anchor counts, of a task and of a bucket; keys that a task holds before it passes them on.
HOME_BYTES, SHARD_BYTES, TASK_BYTES, BUCKET_BYTES, HELD = 1 << 24, 1 << 26, 1 << 27, 1 << 26, 1 << 20
#: Buckets of a task at least; text bytes of the sample for each of them, and one of so many of its suffixes.
BUCKETS, SAMPLE_BYTES, SAMPLE_STEP = 4, 1 << 17, 8
#: Of a sampled suffix whose start occurs again in the sample, as against others: these are what buckets will hold.
REPEATED_WEIGHT = 8
#: Windows that are hashed at once, below the places that fit the low bits.
SEGMENT, PLACE_BITS = 1 << 22, 24
#: Groups of equal texts that are broadcast at most; there are 16 bytes for each.
BROADCAST_GROUPS = 1 << 20
GRAM = 32


def _sums(data: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers(base, len(data)), out=out[1:])
    return out


def _hashes(sums: np.ndarray, base: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of the bytes of each span, of whose data these are the sums."""
    return mix((sums[ends] - sums[starts]) * powers(_inverse(base), len(sums))[starts])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, size = values, 1
    while size * 2 <= width:
        out, size = np.minimum(out[:-size], out[size:]), size * 2
    gap = width - size
    return np.minimum(out[: len(out) - gap], out[gap:]) if gap else out


@dataclass
class Stretches:
    """Stretches of some bytes: the text of each, its first byte in the data and in the text, its length, its anchor's distance
    from its first byte (the largest offset of its windows), and a hash of the run of bytes at the anchor."""

    data: np.ndarray
    text: np.ndarray
    at: np.ndarray
    start: np.ndarray
    length: np.ndarray
    high: np.ndarray
    gram: np.ndarray

    def take(self, keep: np.ndarray) -> Stretches:
        return Stretches(self.data, *[x[keep] for x in (self.text, self.at, self.start, self.length, self.high, self.gram)])

    def bytes(self) -> np.ndarray:
        """The stretches' bytes one after the other."""
        return self.data[np.repeat(self.at - np.cumsum(self.length) + self.length, self.length) + np.arange(int(self.length.sum()))]


def stretches(texts: pa.Array, window: int, gram: int) -> Iterator[Stretches]:
    """The stretches of all windows of some texts. One is cut where a segment ends, which changes no window."""
    data, offsets = text_bytes(texts)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    for begin in range(0, len(data) - window + 1, SEGMENT):
        part = data[begin : begin + SEGMENT + window - 1]
        n = len(part) - window + 1
        sums = _sums(part, ROLL_BASE_1)
        grams = mix((sums[gram:] - sums[:-gram]) * powers(_inverse(ROLL_BASE_1), len(sums))[: len(sums) - gram])
        place = (_sliding_min(grams & ~mask | np.arange(len(grams), dtype=np.uint64), window - gram + 1) & mask).astype(np.int64)
        inside = np.ones(n, bool)
        first = max(0, int(np.searchsorted(offsets, begin, side="right")) - 1)
        for end in offsets[first + 1 : int(np.searchsorted(offsets, begin + len(part), side="right"))].tolist():
            inside[max(0, end - window + 1 - begin) : max(0, end - begin)] = False
        same = inside[1:] & inside[:-1] & (place[1:] == place[:-1])
        opens = np.flatnonzero(inside & ~np.concatenate([[False], same]))
        closes = np.flatnonzero(inside & ~np.concatenate([same, [False]]))
        text = np.searchsorted(offsets, begin + opens, side="right") - 1
        yield Stretches(part, text, opens, begin + opens - offsets[text], closes - opens + window, place[opens] - opens, grams[place[opens]])


def multikey_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, and how many leading bytes each has in common with the one before it in that order.

    A multikey quicksort whose characters are eight bytes: rows are sorted by the first, and those with equal ones by
    the next, until all differ or end; the runs of one level are sorted together."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = np.ascontiguousarray(padded.view(">u8").astype(np.uint64).T)
    order, common = np.arange(n), np.zeros(n, np.int64)
    tied, run = np.arange(n), np.zeros(n, np.int64)
    for level in range(len(words)):
        if len(tied) < 2:
            break
        keys = words[level][order[tied]]
        turn = np.lexsort((keys, run)) if level else np.argsort(keys)
        order[tied], keys = order[tied][turn], keys[turn]
        apart = keys[1:] ^ keys[:-1]
        together = run[1:] == run[:-1]
        split = together & (apart != 0)
        equal = sum((apart < np.uint64(1 << 64 - 8 * b)).astype(np.int64) for b in range(1, 8))
        common[tied[1:][split]] = 8 * level + equal[split]
        still = together & (apart == 0)
        common[tied[1:][still]] = 8 * (level + 1)
        in_run = np.concatenate([[False], still]) | np.concatenate([still, [False]])
        run = np.cumsum(~np.concatenate([[False], still]))[in_run]
        tied = tied[in_run]
    return order, np.minimum(common, width)


def _among(order: np.ndarray, common: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """order and common of some of the rows, given by a flag for each; these are numbered anew in the order of their places."""
    at = np.flatnonzero(some[order])
    least = np.minimum.reduceat(common, np.concatenate([[0], at[:-1] + 1])) if len(at) else common[:0]
    # reduceat takes from after the row before up to this row
    return (np.cumsum(some) - 1)[order[at]], least


@dataclass
class Bucket:
    """Stretches whose suffixes lie between two separators. stretch_bytes: one after the other."""

    stretch_bytes: np.ndarray
    high: np.ndarray
    length: np.ndarray
    twice: np.ndarray

    def __post_init__(self) -> None:
        self.first = np.cumsum(self.length) - self.length

    def suffixes(self, window: int) -> np.ndarray:
        """The bytes from the anchors on; what is beyond a stretch is 0."""
        return _window_rows(self.stretch_bytes, self.first + self.high, self.length - self.high, window, 1)

    def prefixes(self, width: int) -> np.ndarray:
        """The bytes before the anchors, nearest first."""
        return _window_rows(self.stretch_bytes, self.first + self.high - 1, self.high, width, -1)


def _window_rows(data: np.ndarray, first: np.ndarray, there: np.ndarray, width: int, step: int) -> np.ndarray:
    out = np.zeros((len(first), width), np.uint8)
    for a in range(0, len(first), 4096):
        part = slice(a, a + 4096)
        inside = np.arange(width) < there[part][:, None]
        at = first[part][:, None] + step * np.arange(width)
        out[part][inside] = data[at[inside]]
    return out


def repeated_windows(bucket: Bucket, window: int, gram: int, bounds: Sequence[bytes | None] = (None, None)) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Which windows occur again in the bucket, and which might in another one.

    Gives stretch, low and high for runs of repeated windows of a stretch, by their offsets, and then the windows that may
    be met beyond a bound, as (stretch, offset, known) in rows; known says that they are repeated here.

    Suffixes are sorted, and so are the prefixes before their anchors, nearest byte first. Windows of an offset o are equal
    just if window - o bytes of their suffixes and o bytes of their prefixes are: if they lie in one run of either order, as common
    leading bytes bound it. Whole stretches that are equal are settled first and stand for each other; then each offset is settled among
    those left whose neighbours in both orders have enough in common. A run goes over a bound of the bucket if it has less bytes
    than the separator, and all of them in common with it; the separator is the shortest that tells its two sides apart."""
    n = len(bucket.high)
    high, low = bucket.high, window - (bucket.length - bucket.high)
    right, left = bucket.suffixes(window), bucket.prefixes(window - gram)
    r_order, r_common = multikey_order(right)
    l_order, l_common = multikey_order(left)
    r_class, l_class = np.empty(n, np.int64), np.empty(n, np.int64)
    r_class[r_order], l_class[l_order] = np.cumsum(r_common < right.shape[1]), np.cumsum(l_common < left.shape[1])
    order = np.lexsort((high, low, l_class, r_class))
    new = np.ones(n, bool)
    for x in (high, low, l_class, r_class):
        new[1:] &= x[order][1:] == x[order][:-1]
    new[1:] = ~new[1:]
    group = np.empty(n, np.int64)
    group[order] = np.cumsum(new) - 1
    settled_group = np.bincount(group, 1 + bucket.twice) >= 2
    settled = settled_group[group]
    some = np.zeros(n, bool)
    some[order[new]] = True
    stretch, lo, hi = [np.flatnonzero(settled)], [low[settled]], [high[settled]]

    own = np.flatnonzero(some)
    done, m = settled[own], len(own)
    r_order, r_common = _among(r_order, r_common, some)
    l_order, l_common = _among(l_order, l_common, some)
    r_common[:1] = l_common[:1] = 0
    r_most, l_most = np.empty(m, np.int64), np.empty(m, np.int64)
    r_most[r_order], l_most[l_order] = np.maximum(r_common, np.append(r_common[1:], 0)), np.maximum(l_common, np.append(l_common[1:], 0))
    a, b = np.maximum(low[own], window - r_most), np.minimum(high[own], l_most)
    able = np.flatnonzero(a <= b)
    wanted = np.zeros(window + 2, np.int64)
    np.add.at(wanted, a[able][~done[able]], 1)
    np.add.at(wanted, b[able][~done[able]] + 1, -1)
    marks: list[tuple[np.ndarray, np.ndarray]] = []
    r_run, l_run = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in np.flatnonzero(np.cumsum(wanted) > 0).tolist():
        here = able[(a[able] <= o) & (b[able] >= o)]
        r_run[r_order], l_run[l_order] = np.cumsum(r_common < window - o), np.cumsum(l_common < o)
        key = r_run[here] * (m + 1) + l_run[here]
        turn = np.argsort(key)
        same = key[turn][1:] == key[turn][:-1]
        hit = here[turn[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
        hit = hit[~done[hit]]
        marks.append((hit, np.full(len(hit), o)))
    hit, offset = (np.concatenate(x) for x in zip(*marks, strict=True)) if marks else (np.zeros(0, np.int64),) * 2
    turn = np.lexsort((offset, hit))
    hit, offset = hit[turn], offset[turn]
    opens = np.ones(len(hit), bool)
    opens[1:] = (hit[1:] != hit[:-1]) | (offset[1:] != offset[:-1] + 1)
    closes = np.append(opens[1:], True) if len(hit) else opens
    stretch, lo, hi = np.concatenate([*stretch, own[hit[opens]]]), np.concatenate([*lo, offset[opens]]), np.concatenate([*hi, offset[closes]])

    reach = np.zeros(m, np.int64)
    for bound in bounds:
        if bound is not None and len(bound) > gram:
            whole = np.hstack([right[own], left[own]])[:, : len(bound)] if len(bound) > window else right[own, : len(bound)]
            equal = np.cumprod(whole == np.frombuffer(bound, np.uint8), axis=1).sum(axis=1)
            reach = np.maximum(reach, np.minimum(equal, len(bound) - 1))
    first = np.maximum(low[own], window - reach)
    count = np.maximum(0, high[own] - first + 1)
    who = np.repeat(np.arange(m), count)
    which = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    known = done[who]
    if len(hit) and len(who):
        known = known | np.isin(who * (window + 1) + which, hit * (window + 1) + offset)
    return stretch, lo, hi, np.column_stack([own[who], which, known])


def separators(sample: DataFrame, buckets: int) -> list[bytes]:
    """Up to about so many shortest separators of the sampled suffixes (key, with the hash of its start, gram), which deal them to
    ranges of equal weight. Spark sorts the sample; a separator for each bucket comes to the driver."""
    distinct = materialise(sample.groupBy("gram", "key").count(), "suffixes")  # equal suffixes can't be told apart by any separator
    often = materialise(distinct.groupBy("gram").agg(F.sum("count").alias("often")).filter("often > 1"), "often")
    often = F.broadcast(often) if often.count() <= BROADCAST_GROUPS else often
    weighed = materialise(distinct.join(often, "gram", "left").select("key", F.when(F.col("often") > 1, REPEATED_WEIGHT).otherwise(1).alias("weight")), "weighed")
    step = (weighed.agg(F.sum("weight")).first()[0] or 0) / buckets

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held, out = None, 0.0, []
        for batch in batches:
            for key, weight in zip(batch.column("key").to_pylist(), batch.column("weight").to_pylist(), strict=True):
                if before is not None and key != before and held >= step:
                    common = bisect_left(range(len(key)), True, key=lambda k: key[: k + 1] != before[: k + 1])
                    out.append(key[: common + 1])
                    held = 0.0
                before, held = key, held + weight
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["separator"])

    parts = min(partitions(sample.sparkSession), max(1, buckets // 8))
    found = weighed.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(cut, "separator binary").collect()
    return sorted({bytes(r.separator) for r in found})


def _dealt(suffixes: np.ndarray, prefixes: np.ndarray, bounds: Sequence[bytes]) -> np.ndarray:
    """The bucket of each suffix, whose bytes are followed by those before it: how many separators aren't above it."""
    if not bounds:
        return np.zeros(len(suffixes), np.int64)
    width = max(map(len, bounds))
    rows = np.ascontiguousarray(np.hstack([suffixes, prefixes])[:, :width])
    return np.searchsorted(np.array(bounds, f"S{width}"), rows.view(f"S{width}").ravel(), side="right")


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 400) -> DataFrame:
    """The id, n_bytes, n_removed, n_spans and kept_sha256 of byte_rows."""
    rows = byte_rows(docs, id_col, text_col, window)
    return rows.select(F.col("row")[id_col].alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def byte_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 400, carry: Sequence[str] = (), texts: bool = False) -> DataFrame:
    """Remove each byte of a text in UTF-8 that is covered by a string of `window` bytes that also starts anywhere else, in the
    same text or another; all places of such a string go. Strings don't cross texts, may overlap, and are judged on the input.

    Returns one row per input row: row (a struct of the id and the carried columns), n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 (of the bytes left, one after the other) and kept (those bytes, null without `texts`; a cut may lie within a
    character). A null text is empty. Ids play no part: rows that share or repeat an id are texts of their own, so
    a repeated row of at least `window` bytes is removed in all its places. Empty tables give no rows.

    Texts that are equal as a whole (by 128 bits of hash) go without further ado, and one of each such group takes part for the
    others; texts under `window` bytes stay. The rest is dealt once to homes of about 16 MB by a hash of the text. Homes send
    their anchors' hashes to shards, which say which occur twice; only stretches around these are sent on, equal ones of a home
    once. Sampled separators, each as short as tells its neighbours apart, deal their suffixes to buckets in sorted order, where
    `repeated_windows` settles them. Windows that may go over a bucket's bounds, which needs a separator of more than 32 common bytes, are sent
    as hashes of 128 bits, once from a bucket, to where they meet those of other buckets. What repeats goes back to the homes.
    So a string that very many texts share is a few hashes from each bucket that its suffixes fill, and no task holds more than a home, a shard or a bucket.
    Columns of the input may have any names.
    """
    spark = docs.sparkSession
    gram = max(1, min(GRAM, window // 2))
    held = F.struct(*[docs[c].alias(c) for c in dict.fromkeys([id_col, *carry])])
    rows = docs.select(held.alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    rows = rows.withColumn("h1", F.xxhash64("text")).withColumn("h2", F.xxhash64(F.lit(1), "text"))
    long = rows.filter(F.col("n_bytes") >= window)
    groups = materialise(long.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("n_bytes").alias("size")), "texts")
    n_bytes = groups.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    copies = groups.filter("n > 1").select("h1", "h2")
    few = F.broadcast(copies) if copies.count() <= BROADCAST_GROUPS else copies
    row_type = rows.schema["row"].dataType.simpleString()
    alike = long.join(few, ["h1", "h2"], "left_semi")
    single = long.join(few, ["h1", "h2"], "left_anti").select("row", "text", "h1", "h2")
    stand_in = alike.groupBy("h1", "h2").agg(F.first("text").alias("text")).select(F.lit(None).cast(row_type).alias("row"), "text", "h1", "h2")
    work = single.unionByName(stand_in)

    homes = max(64, n_bytes // HOME_BYTES)
    n_parts = max(partitions(spark), n_bytes // TASK_BYTES)
    shards = max(partitions(spark), n_bytes // SHARD_BYTES)
    buckets = max(BUCKETS * partitions(spark), n_bytes // BUCKET_BYTES)
    one_of = max(1, n_bytes // max(1, buckets * SAMPLE_BYTES))
    sampled = work.filter(F.pmod("h2", F.lit(one_of)) == 0).select("text")
    bounds = spark.sparkContext.broadcast(separators(sampled.mapInArrow(_sample(window, gram), "gram long, key binary"), buckets))
    placed = work.withColumn("home", F.pmod("h1", F.lit(homes))).withColumn("doc", F.col("h2")).select("row", "text", "home", "doc").repartition(n_parts, "home")
    told = _repeated_anchors(placed, window, gram, shards)
    sent = placed.groupBy("home").cogroup(told.groupBy("home")).applyInArrow(_send(window, gram, bounds), SENT)
    found = sent.repartition(n_parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_settle(window, gram, bounds, n_parts), FOUND)
    spans = found.repartition(n_parts, "place").sortWithinPartitions("place").mapInArrow(_meet(window), "home long, doc binary, start binary, length binary")
    schema = f"row {row_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    cut = placed.groupBy("home").cogroup(spans.groupBy("home")).applyInArrow(_remove(texts), schema).filter("row is not null")

    def whole(some: DataFrame, gone: bool) -> DataFrame:
        kept = F.lit(b"") if gone else F.col("text").cast("binary")
        return some.select("row", "n_bytes", (F.col("n_bytes") if gone else F.lit(0)).cast("long").alias("n_removed"), F.lit(int(gone)).cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"), (kept if texts else F.lit(None)).cast("binary").alias("kept"))

    return cut.unionByName(whole(alike, True)).unionByName(whole(rows.filter(F.col("n_bytes") < window), False))


SENT = "bucket long, home long, settled boolean, doc binary, start binary, length binary, high binary, twice binary, data binary"
FOUND = "place long, home long, homes binary, h1 binary, h2 binary, doc binary, start binary, length binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _sample(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            for s in stretches(batch.column("text"), window, gram):
                s = s.take(np.flatnonzero(mix(s.gram + s.start.astype(np.uint64) * np.uint64(ROLL_BASE_2) + s.length.astype(np.uint64)) % np.uint64(SAMPLE_STEP) == 0))
                part = Bucket(s.bytes(), s.high, s.length, np.zeros(len(s.high), bool))
                keys = np.hstack([part.suffixes(window), part.prefixes(window - gram)])
                yield pa.RecordBatch.from_arrays([pa.array(s.gram.view(np.int64)), pa.array([k.tobytes() for k in keys], pa.binary())], ["gram", "key"])

    return run


def _repeated_anchors(placed: DataFrame, window: int, gram: int, shards: int) -> DataFrame:
    """home, keys: for each home the 40-bit keys of its anchors that occur twice or more in all homes."""
    n_parts = max(partitions(placed.sparkSession), shards // 16)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in text_slices(batches, "text"):
            home = batch.column("home").to_numpy()
            for s in stretches(batch.column("text"), window, gram):
                held.append((home[s.text], anchor_keys(s.gram)))
                n += len(s.gram)
            if n >= HELD:
                yield flush(held)
                held, n = [], 0
        if n:
            yield flush(held)

    def flush(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        home, key = (np.concatenate(x) for x in zip(*held, strict=True))
        shard = (key % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((key, home, shard))
        home, key, shard = home[order], key[order], shard[order]
        third = np.zeros(len(key), bool)  # tells nothing more
        third[2:] = (key[2:] == key[:-2]) & (home[2:] == home[:-2])
        home, key, shard = home[~third], key[~third], shard[~third]
        new = np.flatnonzero(np.concatenate([[True], (shard[1:] != shard[:-1]) | (home[1:] != home[:-1])]))
        blobs = [_narrow(key[a:b]) for a, b in zip(new, np.append(new[1:], len(key)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(shard[new]), pa.array(home[new]), pa.array(blobs, pa.binary())], ["shard", "home", "keys"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "shard"):
            blobs = [_wide(x) for x in rows["keys"]]
            keys = np.sort(np.concatenate(blobs))
            twice = np.unique(keys[1:][keys[1:] == keys[:-1]])
            told = [(h, _narrow(np.intersect1d(b, twice))) for h, b in zip(rows["home"], blobs, strict=True)]
            told = [(h, b) for h, b in told if b]
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in told], pa.int64()), pa.array([b for _, b in told], pa.binary())], ["home", "keys"])

    counted = placed.mapInArrow(count, "shard long, home long, keys binary")
    return counted.repartition(n_parts, "shard").sortWithinPartitions("shard").mapInArrow(answer, "home long, keys binary")


def _send(window: int, gram: int, bounds):
    """For each home the stretches whose anchors are repeated, by bucket, equal ones once; the places of those that are equal
    within the home are settled."""
    schema = _schema(SENT)

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        home, separate = key[0].as_py(), bounds.value
        known = [_wide(x.as_py()) for x in right.column("keys") if x.is_valid]
        repeated = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        if not len(repeated):
            return schema.empty_table()
        parts: list[tuple[np.ndarray, ...]] = []
        spans: list[tuple[np.ndarray, ...]] = []
        for batch in text_slices(iter(left.combine_chunks().to_batches()), "text"):
            doc = batch.column("doc").to_numpy()
            for s in stretches(batch.column("text"), window, gram):
                keys = anchor_keys(s.gram)
                near = np.minimum(np.searchsorted(repeated, keys), len(repeated) - 1)
                s = s.take(np.flatnonzero(repeated[near] == keys))
                if not len(s.at):
                    continue
                hashes = [_hashes(_sums(s.data, base), base, s.at, s.at + s.length) for base in (ROLL_BASE_1, ROLL_BASE_2)]
                own, twice = once([*hashes, s.high, s.length], np.zeros(len(s.at), bool), doc[s.text], s.start, s.length, spans)
                s, hashes = s.take(own), [h[own] for h in hashes]
                parts.append((*hashes, s.high, s.length, doc[s.text], s.start, twice, s.bytes()))
        if not parts:
            return schema.empty_table()
        *columns, data = (np.concatenate(c) for c in zip(*parts, strict=True))
        length, doc, start, twice = columns[3:]
        first = np.cumsum(length) - length
        own, twice = once(columns[:4], twice, doc, start, length, spans)
        high, length, doc, start, first = (x[own] for x in (columns[2], length, doc, start, first))
        rows = []
        bucket_of = Bucket(data, high, length, twice)
        bucket_of.first = first
        at = np.concatenate([_dealt(*_some(bucket_of, slice(a, a + 4096), window, gram), separate) for a in range(0, len(own), 4096)])
        order = np.argsort(at, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) != 0]))
        for a, b in zip(new, np.append(new[1:], len(order)), strict=True):
            some = order[a:b]
            part = Stretches(data, doc[some], first[some], start[some], length[some], high[some], doc[some])
            rows.append((int(at[some[0]]), home, False, *[x[some].astype(np.int64).tobytes() for x in (doc, start, length, high)], twice[some].tobytes(), part.bytes().tobytes()))
        if spans:
            doc, start, length = merged(*(np.concatenate(c) for c in zip(*spans, strict=True)))
            rows.append((home % (len(separate) + 1), home, True, doc.tobytes(), start.tobytes(), length.tobytes(), b"", b"", b""))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def once(columns: list[np.ndarray], twice: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray, spans: list) -> tuple[np.ndarray, np.ndarray]:
        """The first of each group of equal stretches and whether there are several, whose places join the spans."""
        order = np.lexsort(columns)
        same = np.ones(max(0, len(order) - 1), bool)
        for x in columns:
            same &= x[order][1:] == x[order][:-1]
        new = np.concatenate([[True], ~same])
        group = np.cumsum(new) - 1
        several = np.bincount(group, 1 + twice[order]) > 1
        gone = order[several[group] & ~twice[order]]
        if len(gone):
            spans.append((doc[gone], start[gone], length[gone]))
        return order[new], several

    return run


def _some(bucket: Bucket, part: slice, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    first, high, length = bucket.first[part], bucket.high[part], bucket.length[part]
    return _window_rows(bucket.stretch_bytes, first + high, length - high, window, 1), _window_rows(bucket.stretch_bytes, first + high - 1, high, window - gram, -1)


def merged(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each text joined where they touch or overlap, in order."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + length)[order]
    if not len(doc):
        return doc, start, end
    place = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))  # texts one after the other on one line
    line = int(end.max()) + 1
    begin, furthest = start + place * line, np.maximum.accumulate(end + place * line)
    new = np.concatenate([[True], begin[1:] > furthest[:-1]])
    last = np.append(np.flatnonzero(new)[1:], len(doc)) - 1
    return doc[new], start[new], furthest[last] - begin[new]


def _settle(window: int, gram: int, bounds, places: int):
    """Repeated spans of each bucket's stretches, and hashes of windows that may be met in other buckets, which are dealt to so
    many places."""
    schema = _schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separate = bounds.value
        for rows in _runs(batches, "bucket"):
            mine = [k for k, settled in enumerate(rows["settled"]) if not settled]
            for k, settled in enumerate(rows["settled"]):
                if settled:
                    yield spans_of(*[np.array([rows["home"][k]]).repeat(len(rows["doc"][k]) // 8), *[np.frombuffer(rows[c][k], np.int64) for c in ("doc", "start", "length")]])
            if not mine:
                continue
            doc, start, length, high = (np.concatenate([np.frombuffer(rows[c][k], np.int64) for k in mine]) for c in ("doc", "start", "length", "high"))
            home = np.repeat(np.array([rows["home"][k] for k in mine]), [len(rows["doc"][k]) // 8 for k in mine])
            twice = np.concatenate([np.frombuffer(rows["twice"][k], bool) for k in mine])
            bucket = Bucket(np.concatenate([np.frombuffer(rows["data"][k], np.uint8) for k in mine]), high, length, twice)
            b = rows["bucket"][0]
            around = (separate[b - 1] if b else None, separate[b] if b < len(separate) else None)
            stretch, low, most, beyond = repeated_windows(bucket, window, gram, around)
            told = ~(twice[stretch] & (most == high[stretch]) & (low == window - length[stretch] + high[stretch]))  # homes know those of their own
            stretch, low, most = stretch[told], low[told], most[told]
            if len(stretch):
                yield spans_of(home[stretch], doc[stretch], start[stretch] + high[stretch] - most, most - low + window)
            if len(beyond):
                yield windows_of(bucket, home, doc, start, beyond)

    def spans_of(home: np.ndarray, doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(home, kind="stable")
        out = _blobs("home", home[order], [x[order].astype(np.int64) for x in (doc, start, length)], ["doc", "start", "length"])
        none = pa.nulls(out.num_rows, pa.binary())
        place = pa.array(places + out.column("home").to_numpy())
        return pa.RecordBatch.from_arrays([place, out.column("home"), none, none, none, *out.columns[1:]], schema=schema)

    def windows_of(bucket: Bucket, home: np.ndarray, doc: np.ndarray, start: np.ndarray, beyond: np.ndarray) -> pa.RecordBatch:
        who, offset, known = beyond.T
        some, who = np.unique(who, return_inverse=True)
        part = Stretches(bucket.stretch_bytes, some, bucket.first[some], start[some], bucket.length[some], bucket.high[some], some)
        data, first = part.bytes(), np.cumsum(part.length) - part.length
        at = (first + part.high)[who] - offset
        h1, h2 = (_hashes(_sums(data, base), base, at, at + window) for base in (ROLL_BASE_1, ROLL_BASE_2))
        to = np.where(known > 0, -1, home[some][who])  # none, where a window is known to be repeated
        place = ((h1 >> np.uint64(16)) % np.uint64(places)).astype(np.int64)
        order = np.lexsort((h2, h1, to, place))
        keep = np.ones(len(order), bool)  # known ones once
        keep[1:] = ~((to[order][1:] < 0) & (to[order][:-1] < 0) & (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1]))
        k = order[keep]
        starts = start[some][who[k]] + part.high[who[k]] - offset[k]
        out = _blobs("place", place[k], [to[k], h1[k], h2[k], doc[some][who[k]].astype(np.int64), starts.astype(np.int64)], ["homes", "h1", "h2", "doc", "start"])
        return pa.RecordBatch.from_arrays([out.column(0), pa.nulls(out.num_rows, pa.int64()), *out.columns[1:], pa.nulls(out.num_rows, pa.binary())], schema=schema)

    return run


def _meet(window: int):
    """Spans go on to their homes; of windows that came from several buckets the places go with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, "place"):
            if rows["h1"][0] is None:
                yield pa.RecordBatch.from_arrays([pa.array(rows["home"], pa.int64()), *[pa.array(rows[c], pa.binary()) for c in ("doc", "start", "length")]], names)
                continue
            h1, h2 = (np.concatenate([np.frombuffer(x, np.uint64) for x in rows[c]]) for c in ("h1", "h2"))
            doc, start = (np.concatenate([np.frombuffer(x, np.int64) for x in rows[c]]) for c in ("doc", "start"))
            home = np.concatenate([np.frombuffer(x, np.int64) for x in rows["homes"]])
            order = np.lexsort((h2, h1))
            same = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
            again = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
            again = again[home[again] >= 0]
            again = again[np.argsort(home[again], kind="stable")]
            if len(again):
                yield _blobs("home", home[again], [doc[again], start[again], np.full(len(again), window)], ["doc", "start", "length"])

    names = ["home", "doc", "start", "length"]
    return run


def _remove(texts: bool):
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in right.column(c)] or [np.zeros(0, np.int64)]) for c in ("doc", "start", "length")]
        doc, start, length = merged(*columns)
        out = []
        for text, mine in zip(left.column("text"), left.column("doc").to_numpy(), strict=True):
            raw, at, kept = memoryview(text.as_buffer()), 0, []
            lo, hi = np.searchsorted(doc, mine), np.searchsorted(doc, mine, side="right")
            for s, n in zip(start[lo:hi].tolist(), length[lo:hi].tolist(), strict=True):
                kept.append(raw[at:s])
                at = s + n
            kept.append(raw[at:])
            digest = hashlib.sha256()
            for part in kept:
                digest.update(part)
            out.append((len(raw), int(length[lo:hi].sum()), int(hi - lo), digest.hexdigest(), b"".join(kept) if texts else None))
        found = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 5, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
        return pa.table([left.column("row"), *found], names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run
