"""Exact range join of vectors by cosine: pivots partition them, the triangle inequality says which cells a vector visits."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NULL_ID, id_key, materialise, partitions, split_twins
from .components import components, join_components
from .jaccard import _groups

#: Vectors that pivots are chosen from, most pivots, how many comparisons a copy of a vector costs, and most vectors of a side of
#: a cell's part, which are compared in strips with tiles of the other side.
SAMPLE, MOST_PIVOTS, COPY_COST, BLOCK, STRIP, TILE = 4096, 256, 2000, 1 << 16, 128, 8192
#: Bytes of a side of a part, of the copies that are sent on together, and links that are held before they are joined. Vectors
#: of a side that is worth a task of its own, and sides that all vectors make at least, where they are enough.
SIDE_BYTES, SENT_BYTES, HELD, LEAST_SIDE, SIDES = 1 << 25, 1 << 23, 1 << 18, 1024, 8
SLACK = 1e-9
#: What a vector is in a part: one of a block that meets itself, or on either side of two that meet.
ALONE, FIRST, SECOND = 0, 1, 2


def choose_pivots(vectors: np.ndarray, k: int) -> np.ndarray:
    """k of the unit vectors, each the farthest from those before."""
    chosen = [0]
    far = np.linalg.norm(vectors - vectors[0], axis=1)
    while len(chosen) < min(k, len(vectors)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(vectors - vectors[chosen[-1]], axis=1))
    return vectors[chosen]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T))


def visits(d: np.ndarray, lo: np.ndarray, hi: np.ndarray, reach: float) -> np.ndarray:
    """Which cells a vector visits, from its distances to the pivots: those where another vector within reach may be at home.

    For x at home in cell i and |xy| <= reach, the triangle inequality gives d(y,p) - reach <= d(x,p) <= d(y,p) + reach for
    every pivot p; the home's d(x,p) lies in lo..hi, and p_i is x's nearest pivot, so d(y,p_i) <= d(y,p) + 2 reach."""
    out = d <= d.min(axis=1, keepdims=True) + 2 * reach
    for i in range(len(lo)):
        out[:, i] &= ((d >= lo[i] - reach) & (d <= hi[i] + reach)).all(axis=1)
    return out


def visited(d: np.ndarray, home: np.ndarray, lo: np.ndarray, hi: np.ndarray, reach: float) -> np.ndarray:
    """Which cells a vector goes to: its home, and of those it visits the ones before it. So a link is seen once, at the home
    that comes first."""
    there = visits(d, lo, hi, reach) & (np.arange(d.shape[1]) < home[:, None])
    there[np.arange(len(d)), home] = True
    return there


def side_of(n: int) -> int:
    """Most vectors of a side of a part, for n in all."""
    return min(BLOCK, max(LEAST_SIDE, -(-n // SIDES)))


def useful_pivots(vectors: np.ndarray, n: int, reach: float) -> np.ndarray:
    """Pivots for n vectors of which some are given: of 1, 2, 4, 8, ... the number with the least work, as these vectors tell it.
    A vector costs a comparison with each home of the cells that it goes to, and a copy for each part of them; vectors without
    structure visit every cell, so few pivots do for them."""
    pivots = choose_pivots(vectors, MOST_PIVOTS)
    d = distances(vectors, pivots)
    best = (math.inf, 1)
    k = 1
    while k <= len(pivots):
        part = d[:, :k]
        home = part.argmin(axis=1)
        lo, hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for i in np.unique(home).tolist():
            lo[i], hi[i] = part[home == i].min(axis=0), part[home == i].max(axis=0)
        homes = np.bincount(home, minlength=k)
        others = visited(part, home, lo, hi, reach).sum(axis=0) - homes
        home_sides, other_sides = (np.ceil(x * (n / len(vectors) / side_of(n))) for x in (homes, others))
        copies = homes @ (home_sides + other_sides) + others @ home_sides
        compared = (homes @ (homes / 2 + others)) * (n / len(vectors))
        best = min(best, (float(compared + COPY_COST * copies), k))
        k *= 2
    return pivots[: best[1]]


def copies(batch: pa.RecordBatch, at: np.ndarray, dim: int, home: np.ndarray, there: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each cell that a vector of the batch goes to, in batches of SENT_BYTES: there may be hundreds of each vector."""
    goes, to = np.nonzero(there)
    rows = max(1, SENT_BYTES // (8 * dim))
    for a in range(0, len(goes), rows):
        i, cell = goes[a : a + rows], to[a : a + rows]
        each = pa.array(at[i])
        yield pa.RecordBatch.from_arrays([pa.array(dim * MOST_PIVOTS + cell), pa.array(cell == home[i]), *(batch.column(c).take(each) for c in ("node", "size", "unit"))], ["cell", "home", "node", "size", "unit"])


class Links:
    """Links of a block of unit vectors with another, reduced strip by strip: for each vector of either the number of
    others it links with, weighed by their sizes, and for each of both sides a node that all linked with it share."""

    def __init__(self, own: np.ndarray, other: np.ndarray):
        self.own, self.other = own, other
        self.nodes, place = np.unique(np.concatenate([own, other]), return_inverse=True)
        self.own_at, self.other_at = place[: len(own)], place[len(own) :]
        self.root = np.arange(len(self.nodes))
        self.count, self.other_count = np.zeros(len(own), np.int64), np.zeros(len(other), np.int64)

    def compare(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray, threshold: float, own_sizes: np.ndarray | None = None) -> None:
        """Single precision settles most pairs, by the bound of its error; double precision settles the others. The other side
        is counted too where own_sizes are given."""
        error = (x.shape[1] + 4) * 2.0**-24 * 2
        left, narrow = x.astype(np.float32), y.astype(np.float32).T
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for b in range(0, len(y), TILE):
            tile = np.ascontiguousarray(narrow[:, b : b + TILE])
            for a in range(0, len(x), STRIP):
                close = (left[a : a + STRIP] @ tile).ravel()
                at = np.flatnonzero(close >= threshold - error)
                if not len(at):
                    continue
                i, j = np.divmod(at, tile.shape[1])
                i, j = i + a, j + b
                good = self.own[i] != self.other[j]
                unsure = np.flatnonzero(good & (close[at] < threshold + error))
                for c in range(0, len(unsure), 65536):
                    p = unsure[c : c + 65536]
                    good[p] = np.einsum("ij,ij->i", x[i[p]], y[j[p]]) >= threshold
                i, j = i[good], j[good]
                strip = self.count[a : a + STRIP]
                strip += np.bincount(i - a, sizes[j], len(strip)).astype(np.int64)
                if own_sizes is not None:
                    beside = self.other_count[b : b + TILE]
                    beside += np.bincount(j - b, own_sizes[i], len(beside)).astype(np.int64)
                held.append((self.own_at[i], self.other_at[j]))
                n += len(i)
                if n >= HELD:
                    self._join(*(np.concatenate(c) for c in zip(*held, strict=True)))
                    held, n = [], 0
        if held:
            self._join(*(np.concatenate(c) for c in zip(*held, strict=True)))

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def range_join(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = 0.95) -> DataFrame:
    """Links of all vectors with a cosine of at least the threshold, one row per input row: the id, n_links (other rows
    linked directly), component_id (smallest id reached by links, itself included), kept (id = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and vectors link only with
    those of their own length. A null id is the largest and shown as null; it is kept if it is alone. Rows that share an id
    are separate vectors. Equal vectors are one class (by 126 bits of hash), compared once. Other columns are ignored; an empty table gives no rows.

    Pivots come from a sample of up to 4096 classes (those of the least hashes), the farthest from each other, as many as
    `useful_pivots` finds worth it. Every class has its home in the cell of the nearest pivot, and visits those of the cells before it that
    `visits` can't rule out. In each cell those at home meet each other and the visitors, so each link is seen once. A cell with
    many vectors is dealt to blocks of homes and of visitors, bounded in bytes, each two of which meet in a part of their own.
    """
    spark = vectors.sparkSession
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    n_parts = partitions(spark)
    rows = vectors.select(id_key(id_col).alias("id"), vectors[vector_col].cast("array<double>").alias("v"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes: list[int | None] = []
            checks: list[int | None] = []
            units: list[bytes | None] = []
            for v in batch.column("v"):
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) if v.is_valid and v.values.null_count == 0 else np.zeros(0)
                top = np.abs(x).max(initial=0.0)
                if not (len(x) and np.isfinite(x).all() and top > 0):
                    nodes.append(None)
                    checks.append(None)
                    units.append(None)
                    continue
                x = x / top + 0.0  # so that squares neither overflow nor vanish; -0.0 becomes 0.0
                x = x / np.sqrt((x * x).sum())
                nodes.append(xxhash.xxh3_64_intdigest(x.tobytes()) >> 1)
                checks.append(xxhash.xxh3_64_intdigest(x.tobytes(), 1) >> 1)
                units.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nodes, pa.int64()), pa.array(checks, pa.int64()), pa.array(units, pa.binary())], ["id", "node", "check", "unit"])

    signed = materialise(rows.mapInArrow(sign, "id long, node long, check long, unit binary"), "vectors")

    def classed() -> DataFrame:
        checks = [F.min("check").alias("least_check"), F.max("check").alias("most_check")]
        found = signed.filter("node is not null").groupBy("node").agg(F.min("id").alias("first"), F.count("*").alias("size"), F.first("unit").alias("unit"), *checks)
        return materialise(found, "vector-classes")

    classes = classed()
    apart = split_twins(signed, classes)
    if apart is not None:
        signed = materialise(apart, "vectors")
        classes = classed()
    n = classes.count()
    sample: dict[int, list[np.ndarray]] = {}
    for r in classes.select("node", "unit").orderBy("node").limit(SAMPLE).collect():
        sample.setdefault(len(r.unit) // 8, []).append(np.frombuffer(r.unit))
    pivots = {dim: useful_pivots(np.array(x), n, reach) for dim, x in sample.items()}
    shared_pivots = spark.sparkContext.broadcast(pivots)

    def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Length, places in the batch, vectors and their distances to the pivots; a length without pivots has one cell."""
        raw = [x.as_py() for x in batch.column("unit")]
        lengths = np.array([len(x) // 8 for x in raw])
        for dim in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dim)
            x = np.frombuffer(b"".join(raw[i] for i in at)).reshape(len(at), dim)
            p = shared_pivots.value.get(dim)
            yield dim, at, x, np.zeros((len(at), 1)) if p is None else distances(x, p)

    def extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dim, _, _, d in matrices(batch):
                home = d.argmin(axis=1)
                for i in np.unique(home).tolist():
                    lo, hi = d[home == i].min(axis=0), d[home == i].max(axis=0)
                    old = found.get(dim * MOST_PIVOTS + i)
                    found[dim * MOST_PIVOTS + i] = (lo, hi) if old is None else (np.minimum(old[0], lo), np.maximum(old[1], hi))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([lo.tobytes() for lo, _ in found.values()], pa.binary()), pa.array([hi.tobytes() for _, hi in found.values()], pa.binary())], ["cell", "lo", "hi"])

    def widest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for cell, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("cell", "lo", "hi")), strict=True):
                lo, hi = np.frombuffer(lo), np.frombuffer(hi)
                old = found.get(cell)
                found[cell] = (lo, hi) if old is None else (np.minimum(old[0], lo), np.maximum(old[1], hi))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array([lo.tobytes() for lo, _ in found.values()], pa.binary()), pa.array([hi.tobytes() for _, hi in found.values()], pa.binary())], ["cell", "lo", "hi"])

    schema = "cell long, lo binary, hi binary"
    # at most one row for each pivot of a length in the sample
    extent = {r.cell: (np.frombuffer(r.lo), np.frombuffer(r.hi)) for r in classes.select("unit").mapInArrow(extents, schema).repartition(n_parts, "cell").mapInArrow(widest, schema).filter(F.floor(F.col("cell") / MOST_PIVOTS).isin(list(pivots) or [0])).collect()}
    shared_extent = spark.sparkContext.broadcast(extent)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, _, d in matrices(batch):
                home, p = d.argmin(axis=1), shared_pivots.value.get(dim)
                if p is None:
                    there = np.ones((len(at), 1), bool)
                else:
                    never = (np.full(len(p), np.inf), np.full(len(p), -np.inf))
                    lo, hi = (np.array([shared_extent.value.get(dim * MOST_PIVOTS + i, never)[side] for i in range(len(p))]) for side in (0, 1))
                    there = visited(d, home, lo - SLACK, hi + SLACK, reach)
                yield from copies(batch, at, dim, home, there)

    placed = classes.select("node", "size", "unit").mapInArrow(place, "cell long, home boolean, node long, size long, unit binary")
    # a cell's homes are dealt to blocks, its visitors too; each two blocks of homes meet, and each of homes with each of visitors
    counts = materialise(placed.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("others")), "cells")
    dealt = placed.join(counts, "cell")
    side = F.greatest(F.lit(1), F.least(F.lit(side_of(n)), F.floor(F.lit(SIDE_BYTES // 8) / F.floor(F.col("cell") / MOST_PIVOTS))))
    homes, others = F.ceil(F.col("homes") / side).cast("int"), F.ceil(F.col("others") / side).cast("int")
    mine, visiting = (F.pmod(F.xxhash64("node"), F.greatest(x, F.lit(1))).cast("int") for x in (homes, others))

    def part(first: Column, second: Column, kind: int, role: Column) -> Column:
        return F.struct(F.xxhash64("cell", first.cast("bigint"), second.cast("bigint"), F.lit(kind)).alias("part"), role.alias("role"))

    def upto(blocks: Column) -> Column:
        return F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))

    with_homes = F.transform(upto(homes), lambda j: part(F.least(mine, j), F.greatest(mine, j), 0, F.when(mine == j, ALONE).when(mine < j, FIRST).otherwise(SECOND)))
    with_others = F.transform(upto(others), lambda j: part(mine, j, 1, F.lit(FIRST)))
    as_other = F.transform(upto(homes), lambda i: part(i, visiting, 1, F.lit(SECOND)))
    parts = F.when(F.col("home"), F.concat(with_homes, with_others)).otherwise(as_other)
    dealt = dealt.select(F.explode(parts).alias("p"), "node", "size", "unit").select("p.part", "p.role", "node", "size", "unit")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for roles, nodes, sizes, units in _groups(batches, "part", ("role", "node", "size", "unit")):
            roles, nodes, sizes = np.array(roles), np.array(nodes, np.int64), np.array(sizes, np.int64)
            x = np.frombuffer(b"".join(units)).reshape(len(nodes), -1)
            units.clear()
            if roles[0] == ALONE:
                links = Links(nodes, nodes)
                links.compare(x, x, sizes, threshold)
            else:
                first = roles == FIRST
                if not first.any() or first.all():
                    continue
                links = Links(nodes[first], nodes[~first])
                links.compare(x[first], x[~first], sizes[~first], threshold, sizes[first])
            linked, some, others = np.flatnonzero(links.root != np.arange(len(links.root))), np.flatnonzero(links.count), np.flatnonzero(links.other_count)
            if len(some):
                counted = np.concatenate([links.own[some], links.other[others]])
                a = np.concatenate([links.nodes[linked], counted])
                b = np.concatenate([links.nodes[links.root[linked]], counted])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.concatenate([np.zeros(len(linked), np.int64), links.count[some], links.other_count[others]]))], ["a", "b", "links"])

    found = materialise(dealt.repartition(n_parts, "part").sortWithinPartitions("part").mapInArrow(meet, "a long, b long, links long"), "vector-links")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b")).withColumnRenamed("id", "node")
    info = classes.select("node", "first", "size").join(links, "node", "left").join(joined, "node", "left")
    info = info.withColumn("component", F.coalesce("component", "node"))
    tops = info.groupBy("component").agg(F.min("first").alias("top"), F.count("*").alias("members"))
    info = join_components(info, tops, "node").select("node", "size", "links", "top")
    out = signed.select("id", "node").join(info, "node", "left")
    shown = lambda c: F.when(c != NULL_ID, c)
    top = F.coalesce("top", "id")
    return out.select(
        shown(F.col("id")).alias(id_col),
        F.coalesce(F.col("size") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        shown(top).alias("component_id"),
        (top == F.col("id")).alias("kept"),
    )
