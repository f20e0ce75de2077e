"""Join of documents by the Jaccard similarity of their word n-grams: MinHash bands find candidates, full sets decide."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, id_key, materialise, mix, partitions, rolling_hashes, span_hashes, split_twins, text_bytes, text_slices, word_spans
from .components import components, join_components, local_roots

#: Bytes of a signature that travel with a candidate, one for each of the first hash functions.
SIGNATURE = 64
#: A bucket or group with more members is dealt to blocks, and each two blocks meet in a cell of their own.
BUCKET, BLOCK, BLOCK_NGRAMS = 1 << 14, 1 << 10, 1 << 22
#: Up to so many keys of rows (16 bytes each) are broadcast to pick those rows before a shuffle.
BROADCAST_KEYS = 1_000_000


def choose_bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows: the most rows, which give the fewest false candidates, with which a pair at the threshold still
    shares a band with a chance of at least `recall`."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("not enough hash functions for this recall")


def ngram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct n-gram hashes of each text, sorted. A text of fewer than n words has one n-gram, of all its words."""
    data, offsets = text_bytes(texts)
    starts, ends, first = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends)
    grams = rolling_hashes(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            out.append(np.array([xxhash.xxh64_intdigest(hashes[a:b].tobytes(), b - a)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(1, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
        self.weights = rng.integers(1, 1 << 63, bands * rows, np.uint64) | np.uint64(1)

    def __call__(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Signatures (a row of bytes each) and band hashes of sets that aren't empty."""
        values = np.concatenate(sets)
        high, low = (values >> np.uint64(32)).astype(np.uint32), values.astype(np.uint32)
        at = np.cumsum([0, *map(len, sets[:-1])])
        least = np.empty((len(self.factors), len(sets)), np.uint32)
        for k, f in enumerate(self.factors):
            np.minimum.reduceat(high * f + low, at, out=least[k])
        signatures = np.ascontiguousarray((least[:SIGNATURE] & 0xFF).astype(np.uint8).T)
        weighed = least.astype(np.uint64) * self.weights[:, None]
        bands = weighed.reshape(self.bands, self.rows, -1).sum(axis=1, dtype=np.uint64)
        return signatures, np.ascontiguousarray(mix(bands + np.arange(1, self.bands + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)).T)


def set_hashes(grams: np.ndarray) -> tuple[int, int]:
    """Two 63-bit hashes of a sorted set of n-grams."""
    raw = grams.tobytes()
    return xxhash.xxh3_64_intdigest(raw) >> 1, xxhash.xxh3_64_intdigest(raw, 1) >> 1


def near_in_bucket(signatures: np.ndarray, least_equal: int) -> np.ndarray:
    """For each member of a bucket the first member of its part, where members with that many equal signature bytes are
    joined. Each member is compared with those not yet reached, so a bucket of near copies takes few passes."""
    n = len(signatures)
    root = np.arange(n)
    left = np.arange(n)
    while len(left) > 1:
        head, left, stack = left[0], left[1:], [left[0]]
        while stack and len(left):
            near = (signatures[left] == signatures[stack.pop()]).sum(axis=1) >= least_equal
            root[left[near]] = head
            stack.extend(left[near].tolist())
            left = left[~near]
    return root


def linked_pairs(sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """Matrix of which sets have a Jaccard similarity of at least the threshold, exactly; no set with itself."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float32)
    width = 2048
    for a in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, (a, a + width))
        block = np.zeros((n, width), np.float32)
        block[owner[lo:hi], column[lo:hi] - a] = 1
        common += block @ block.T
    p, q = threshold.numerator, threshold.denominator
    linked = common.astype(np.int64) * (p + q) >= p * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(linked, False)
    return linked


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.995, hashes: int = 128) -> DataFrame:
    """Links and groups of near-duplicate documents, one row per input row.

    Columns: the id; text_hash; class_id, the smallest id with the same set of n-grams; n_links, the other rows with a
    similarity of at least the threshold; component_id, the smallest id reached by links; kept, whether the row is the
    first of its group by id and text_hash.

    Rows with equal sets are one class, compared once. Bands and rows of the MinHash follow from the recall asked for at
    the threshold (21 bands of 6 rows by default, recall 0.998). Buckets of equal bands join candidates whose signatures agree
    well enough (an estimate 0.2 under the threshold, four standard deviations); the groups so found are compared in full,
    all pairs on whole n-gram sets. A large bucket or group is dealt to blocks, and each two blocks meet in a task of
    their own; pairs are counted there and are never rows.

    Words are runs of bytes outside [\\x20\\x09-\\x0D], as they are. A text of fewer than n words has one n-gram, all of it. A
    null or empty text or one without words has no links and is its own group, and is kept. A null id is the largest id,
    and shown as null. Rows that share id and text are links of each other like any equal texts, and only they can both be
    kept. Other columns are ignored; an empty table gives no rows. Classes are told apart by 126 bits of hash.
    """
    spark = docs.sparkSession
    exact = Fraction(threshold).limit_denominator(1000)
    bands, rows_per_band = choose_bands(threshold, recall, hashes)
    minhash = MinHash(bands, rows_per_band)
    estimate = threshold - 0.2
    least_equal = int(np.floor(SIGNATURE * (estimate + (1 - estimate) / 256)))
    n_parts = partitions(spark)
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(id_key(id_col).alias("doc"), F.xxhash64(text).alias("text_hash"), text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            sets = ngram_sets(batch.column("text"), n)
            some = [k for k, s in enumerate(sets) if len(s)]
            node: list[int | None] = [None] * len(sets)
            check: list[int | None] = [None] * len(sets)
            signature: list[bytes | None] = [None] * len(sets)
            band: list[bytes | None] = [None] * len(sets)
            if some:
                s, b = minhash([sets[k] for k in some])
                for at, k in enumerate(some):
                    node[k], check[k] = set_hashes(sets[k])
                    signature[k], band[k] = s[at].tobytes(), b[at].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_hash"), pa.array(node, pa.int64()), pa.array(check, pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(signature, pa.binary()), pa.array(band, pa.binary())],
                ["doc", "text_hash", "node", "check", "n_grams", "signature", "bands"],
            )

    signed = materialise(rows.mapInArrow(sign, "doc long, text_hash long, node long, check long, n_grams long, signature binary, bands binary"), "signed")

    def classed() -> DataFrame:
        first = [F.min(F.struct("doc", "text_hash")).alias("first"), *(F.first(c).alias(c) for c in ("n_grams", "signature", "bands"))]
        checks = [F.min("check").alias("least_check"), F.max("check").alias("most_check")]
        return materialise(signed.filter("node is not null").groupBy("node").agg(F.count("*").alias("size"), *first, *checks), "classes")

    classes = classed()
    apart = split_twins(signed, classes)
    if apart is not None:
        signed = materialise(apart, "signed")
        classes = classed()

    # candidates
    def band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("bands")])
                each = pa.array(np.repeat(np.arange(batch.num_rows), bands))
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("node").take(each), batch.column("signature").take(each)], ["bucket", "node", "signature"])

    banded = classes.select("node", "signature", "bands").mapInArrow(band_rows, "bucket long, node long, signature binary")
    full = banded.groupBy("bucket").count().filter(F.col("count") > BUCKET)
    full = materialise(full, "full-buckets")
    if not full.isEmpty():
        blocks = F.ceil(F.col("count") / BUCKET).cast("int")
        dealt = banded.join(full, "bucket", "left").withColumn("block", F.pmod("node", blocks).cast("int"))
        cell = lambda j: F.xxhash64("bucket", F.least("block", j), F.greatest("block", j))
        cells = F.when(F.col("count").isNull(), F.array("bucket")).otherwise(F.transform(F.sequence(F.lit(0), blocks - 1), cell))
        banded = dealt.select(F.explode(cells).alias("bucket"), "node", "signature")

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, signatures in _groups(batches, "bucket", ("node", "signature")):
            if len(nodes) > 1:
                nodes = np.array(nodes, np.int64)
                root = near_in_bucket(np.frombuffer(b"".join(signatures), np.uint8).reshape(len(nodes), -1), least_equal)
                far = nodes != nodes[root]
                if far.any():
                    yield pa.RecordBatch.from_arrays([pa.array(nodes[far]), pa.array(nodes[root][far])], ["a", "b"])

    near = banded.repartition(n_parts, "bucket").sortWithinPartitions("bucket").mapInArrow(candidates, "a long, b long")
    groups = components(near)

    # verification
    weighed = groups.join(classes.select(F.col("node").alias("id"), "first", "size", "n_grams"), "id")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_grams") / BLOCK_NGRAMS)).cast("int")
    totals = weighed.groupBy("component").agg(F.count("*").alias("members"), blocks.alias("blocks"))
    targets = join_components(weighed, totals, "id").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.xxhash64("component", F.least("block", j), F.greatest("block", j)).alias("cell"), (F.col("block") == j).alias("own")))
    targets = targets.select(F.col("first.doc").alias("doc"), F.col("first.text_hash").alias("text_hash"), F.col("id").alias("node"), "size", "block", cells.alias("cells"))
    targets = materialise(targets, "targets")
    n_targets = targets.count()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # rows may repeat; a task sends the n-grams of a class once
        for batch in text_slices(batches, "text"):
            nodes = batch.column("node").to_pylist()
            fresh = [k for k, node in enumerate(nodes) if node not in sent and nodes.index(node) == k] if len(set(nodes)) < len(nodes) else [k for k, node in enumerate(nodes) if node not in sent]
            sent.update(nodes)
            batch = batch.take(pa.array(fresh, pa.int64()))
            out: list[tuple] = []
            for s, node, size, block, at in zip(ngram_sets(batch.column("text"), n), batch.column("node").to_pylist(), batch.column("size").to_pylist(), batch.column("block").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                raw = s.tobytes()
                out += [(c["cell"], c["own"], node, size, block, raw) for c in at]
            if out:
                kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["cell", "own", "node", "size", "block", "grams"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, nodes, sizes, block, raw in _groups(_once(batches, "cell", "node"), "cell", ("own", "node", "size", "block", "grams")):
            if len(nodes) < 2:
                continue
            nodes, sizes, block = (np.array(x) for x in (nodes, sizes, block))
            linked = linked_pairs([np.frombuffer(x, np.uint64) for x in raw], exact)
            if not own[0] or (block != block[0]).any():  # two blocks meet: their own pairs have a cell of their own
                linked &= block[:, None] != block[None, :]
            root = local_roots(linked)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root]), pa.array(linked @ sizes)], ["a", "b", "links"])

    keys = targets.select("doc", "text_hash")
    picked = rows.join(F.broadcast(keys), ["doc", "text_hash"], "left_semi") if n_targets <= BROADCAST_KEYS else rows
    sent = picked.join(targets, ["doc", "text_hash"]).select("text", "node", "size", "block", "cells")
    sent = sent.mapInArrow(spread, "cell long, own boolean, node long, size long, block int, grams binary")
    found = sent.repartition(n_parts, "cell").sortWithinPartitions("cell", "node").mapInArrow(verify, "a long, b long, links long")
    found = materialise(found, "links")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b")).withColumnRenamed("id", "node")

    # back to the rows
    info = classes.select("node", "first", "size").join(links, "node", "left").join(joined, "node", "left")
    info = info.withColumn("component", F.coalesce("component", "node"))
    tops = info.groupBy("component").agg(F.min("first").alias("top"), F.count("*").alias("members"))
    info = join_components(info, tops, "node").select("node", "first", "size", "links", "top")
    out = signed.select("doc", "text_hash", "node").join(info, "node", "left")
    me = F.struct("doc", "text_hash")
    shown = lambda c: F.when(c != NULL_ID, c)
    top = F.coalesce("top", me)
    return out.select(
        shown(F.col("doc")).alias(id_col),
        "text_hash",
        shown(F.coalesce("first.doc", "doc")).alias("class_id"),
        F.coalesce(F.col("size") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        shown(top["doc"]).alias("component_id"),
        (top == me).alias("kept"),
    )


def _once(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[pa.RecordBatch]:
    """Rows of a partition that is sorted by some columns (longs), the first of each of their values."""
    last: list[int] | None = None
    for batch in batches:
        if batch.num_rows:
            columns = [batch.column(c).to_numpy() for c in names]
            new = np.ones(batch.num_rows, bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            new[0] = last != [c[0] for c in columns]
            last = [c[-1] for c in columns]
            yield batch.filter(pa.array(new))


def _groups(batches: Iterator[pa.RecordBatch], name: str, columns: Sequence[str]) -> Iterator[list[list]]:
    """The values of each key of a partition that is sorted by it."""
    key, held = None, [[] for _ in columns]
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(name).to_numpy()
        bounds = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        values = [batch.column(c).to_pylist() for c in columns]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if keys[a] != key and key is not None:
                yield held
                held = [[] for _ in columns]
            key = keys[a]
            for h, v in zip(held, values, strict=True):
                h += v[a:b]
    if key is not None:
        yield held
