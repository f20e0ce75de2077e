"""Whitening of vectors by principal components: a compensated covariance, merged over tasks in double-double."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions
from .double_double import BLOCK, Pair, add, product, ratio, two_sum, whole

#: Bytes of matrices that a task adds up at once. Vectors of so many different lengths that theirs take more are done in rounds.
HELD = 1 << 28
#: Components of less than this share of the largest eigenvalue have no variance that doubles could tell from none.
NO_VARIANCE = 2.0**-80
SCALE, SHIFT = 64, 1_000_000
#: Entries from this size on have no place in a long.
LARGEST = 2.0**55


@dataclass
class Space:
    """Vectors of one length: how many, the sums of their entries, and what is fitted to them."""

    n: int
    sums: list[int]
    components: np.ndarray | None = None  # in columns
    scales: np.ndarray | None = None  # 1 / sqrt(eigenvalue), null where there is no variance
    explained: np.ndarray | None = None
    identity_error: float | None = None

    def centred(self, x: np.ndarray) -> Pair:
        """x - sums / n. The whole part of the mean is taken off first, without error."""
        floor = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([ratio(s % self.n, self.n) for s in self.sums]).reshape(-1, 2)
        high, low = whole(x - floor)
        s, e = two_sum(high, -rest[:, 0])
        return two_sum(s, e + (low - rest[:, 1]))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sums of (n * x - sums)**2 over the entries; null where it doesn't fit a long."""
        floor = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        near = x - floor
        most = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if most**2 * len(self.sums) < 1 << 63:
            return ((near * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = [sum((v * self.n - r) ** 2 for v, r in zip(row, rest.tolist(), strict=True)) for row in near.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """By row, the components that have variance."""
        there = ~np.isnan(self.scales)
        return (self.centred(x)[0] @ self.components[:, there]) * self.scales[there]


def eigen(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (in columns) of a symmetric matrix given as pairs, to double precision.

    LAPACK's symmetric solver reduces the matrix to a tridiagonal one and solves that by divide and conquer; two steps of
    refinement with products of pairs then take away what rounding, and neighbouring eigenvalues, left in the vectors."""
    values, vectors = np.linalg.eigh(high)
    x = vectors, np.zeros_like(vectors)
    same = np.eye(len(high))
    for _ in range(2):
        back = x[0].T, x[1].T
        gram = product(back, x)
        rest = -add(gram, (-same, np.zeros_like(same)))[0]
        image = product(back, product((high, low), x))[0]
        values = np.diag(image) / (1 - np.diag(rest))
        off = image - np.diag(np.diag(image))
        near = 2 * (np.abs(off).max(initial=0) + np.abs(values).max(initial=0) * np.abs(rest).max(initial=0))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > near
        step = np.where(apart, (image + values[None, :] * rest) / np.where(apart, gap, 1), rest / 2)
        x = add(x, product(x, (step, np.zeros_like(step))))
    order = np.argsort(-values, kind="stable")
    return values[order], x[0][:, order]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the vectors of each length and their entries as whole numbers, BLOCK at most at once."""
    column = batch.column("vector")
    offsets = column.offsets.to_numpy().astype(np.int64)
    values, lengths = column.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        for at in range(0, len(rows), BLOCK):
            part = rows[at : at + BLOCK]
            yield part, np.floor(values[offsets[part][:, None] + np.arange(d)] * SCALE).astype(np.int64) + SHIFT


def _merged(vectors: DataFrame, moments: Callable[[np.ndarray], Pair]) -> DataFrame:
    """d, i, sums_high, sums_low: row i of the sum over all vectors of length d of the matrices that `moments` makes of some of
    them. Tasks add up their own pairs and send them by rows; whoever gets a row adds the tasks' pairs in the order of the tasks."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Pair] = {}
        for batch in batches:
            for _, x in _by_length(batch):
                found, d = moments(x), x.shape[1]
                held[d] = add(held[d], found) if d in held else found
        task = TaskContext.get().partitionId()
        for d, (high, low) in held.items():
            yield rows(d, task, high, low)

    def rows(d: int, task: int, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        n = len(high)
        names = ["d", "i", "task", "sums_high", "sums_low"]
        return pa.RecordBatch.from_arrays([pa.array([d] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([task] * n, pa.int32()), *[pa.array([v.tobytes() for v in part], pa.binary()) for part in (high, low)]], names)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for d, i, high, low in zip(*[batch.column(c).to_pylist() for c in ("d", "i", "sums_high", "sums_low")], strict=True):
                here = np.frombuffer(high), np.frombuffer(low)
                if key == (d, i):
                    total = add(total, here)
                else:
                    if key is not None:
                        yield out(key, total)
                    key, total = (d, i), here
        if key is not None:
            yield out(key, total)

    def out(key: tuple[int, int], total: Pair) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in total]], ["d", "i", "sums_high", "sums_low"])

    sent = vectors.select("vector").mapInArrow(collect, "d int, i int, task int, sums_high binary, sums_low binary")
    dealt = sent.repartition(partitions(vectors.sparkSession), "d", "i").sortWithinPartitions("d", "i", "task")
    return dealt.mapInArrow(fold, "d int, i int, sums_high binary, sums_low binary")


def _matrix(table: pa.Table) -> Pair:
    """The rows that `_merged` gives for one length."""
    order = np.argsort(table.column("i").to_numpy())
    return tuple(np.array([np.frombuffer(x) for x in table.column(c).to_pylist()])[order] for c in ("sums_high", "sums_low"))


def spaces(vectors: DataFrame) -> dict[int, Space]:
    """By length, how many vectors there are and the exact sums of their entries as whole numbers."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in _by_length(batch):
                d = x.shape[1]
                n, sums = held.get(d, (0, [0] * d))
                # halves, so that no sum of a block leaves 64 bits
                high, low = (x >> 31).sum(axis=0).tolist(), (x & (1 << 31) - 1).sum(axis=0).tolist()
                held[d] = n + len(x), [s + (a << 31) + b for s, a, b in zip(sums, high, low, strict=True)]
        for d, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([list(map(str, sums))], pa.list_(pa.string()))], ["d", "n", "sums"])

    sent = vectors.select("vector").mapInArrow(collect, "d int, n long, sums array<string>")
    by_place = sent.select("d", "n", F.posexplode("sums").alias("i", "s")).groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    found: dict[int, Space] = {}
    for d, _, n, s in by_place.orderBy("d", "i").collect():
        found.setdefault(d, Space(n, [])).sums.append(int(s))
    return found


def fit(vectors: DataFrame, found: dict[int, Space], most: int) -> None:
    """Adds components, scales and shares of the variance to the spaces, then what the covariance of whitened vectors lacks of
    being the identity."""
    spark = vectors.sparkSession
    sizes = spark.sparkContext.broadcast(found)

    def solve(key: tuple, table: pa.Table) -> pa.Table:
        d, (high, low) = key[0].as_py(), _matrix(table)
        n = sizes.value[d].n
        values, components = eigen(high, low)
        trace = float(np.trace(high))
        k = min(most, d)
        rows = [(d, j, float(values[j]) / n, float(values[j]) / trace if trace > 0 else None, bool(values[j] > NO_VARIANCE * abs(values[0])), np.ascontiguousarray(components[:, j]).tobytes()) for j in range(k)]
        return pa.table([pa.array(c) for c in zip(*rows, strict=True)], schema=solved)

    solved = pa.schema([("d", pa.int32()), ("j", pa.int32()), ("value", pa.float64()), ("share", pa.float64()), ("varies", pa.bool_()), ("component", pa.binary())])
    sums = _merged(vectors, lambda x: _outer(sizes.value[x.shape[1]].centred(x)))
    by_length: dict[int, list] = {}
    for r in sums.groupBy("d").applyInArrow(solve, "d int, j int, value double, share double, varies boolean, component binary").collect():
        by_length.setdefault(r.d, []).append(r)
    for d, rows in by_length.items():
        rows.sort(key=lambda r: r.j)
        found[d].components = np.array([np.frombuffer(r.component) for r in rows]).T
        found[d].scales = np.array([r.value**-0.5 if r.varies else np.nan for r in rows])
        found[d].explained = np.array([np.nan if r.share is None else r.share for r in rows])
    fitted = spark.sparkContext.broadcast(found)

    def whitened(x: np.ndarray) -> Pair:
        w = fitted.value[x.shape[1]].whitened(x)
        return _outer((np.hstack([w, np.ones((len(w), 1))]), np.zeros((len(w), w.shape[1] + 1))))

    rows = {}
    for r in _merged(vectors, whitened).collect():
        rows.setdefault(r.d, {})[r.i] = np.frombuffer(r.sums_high) + np.frombuffer(r.sums_low)
    for d, parts in rows.items():
        total = np.array([parts[i] for i in sorted(parts)]) / found[d].n
        mean = total[-1, :-1]  # of whitened values, which rounding alone keeps from 0
        found[d].identity_error = float(np.abs(total[:-1, :-1] - np.outer(mean, mean) - np.eye(len(mean))).max(initial=0))


def _outer(x: Pair) -> Pair:
    return product((x[0].T, x[1].T), x)


def whiten(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32) -> DataFrame:
    """Every vector in up to `most` whitened principal components: the id, component (from 1, by falling variance), n, deviation,
    whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null, non-finite or huge entries (2**55 or more, which have no place in a long) are
    left out. Each remaining entry c becomes x = floor(64 * c) + 1000000. Vectors of each length are a space of their own, with
    its own fit list of n vectors. deviation is the exact sum of (n * x - sum)**2 over the entries (null beyond a long). Components
    are unit eigenvectors of the covariance (divisor n), whose sign is arbitrary, the same for all rows; whitened is the centred
    vector's projection over the root of the eigenvalue, explained the eigenvalue's share of the trace, identity_error the
    largest entry of the whitened vectors' covariance minus the identity. A component without variance (one vector, equal or
    linearly dependent entries) has a null for whitened and counts for no identity error; without any variance explained is null too.
    Null and repeated ids are carried as they are, an empty table gives no rows, and other columns are ignored.

    Three passes read the vectors: exact sums, the covariance of centred vectors, and that of the whitened ones. Each task adds
    outer products in double-double by error-free products (`double_double`), and rows of its matrices meet the other tasks'
    by place, so a task holds one matrix of each length, whatever the number of vectors. What the driver gets is bounded by the lengths: sums,
    and `most` components of each. The eigen-solve of a length is one task's, of the size of its matrix.
    """
    value = F.col("vector")
    odd = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    rows = docs.select(docs[id_col].alias("id"), docs[vector_col].cast("array<double>").alias("vector"))
    rows = rows.filter(value.isNotNull() & (F.size("vector") > 0) & ~odd)
    schema = f"id {rows.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    out = None
    for held in _rounds(spaces(rows)):
        mine = rows.filter(F.size("vector").isin(list(held)))
        fit(mine, held, most)
        part = mine.mapInArrow(_project(docs.sparkSession.sparkContext.broadcast(held)), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnRenamed("id", id_col)


def _rounds(found: dict[int, Space]) -> Iterator[dict[int, Space]]:
    """The spaces, in groups whose matrices a task can hold."""
    group: dict[int, Space] = {}
    size = 0
    for d, space in sorted(found.items()):
        if group and size + 16 * d * d > HELD:
            yield group
            group, size = {}, 0
        group[d], size = space, size + 16 * d * d
    if group:
        yield group


def _project(fitted) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in _by_length(batch):
                space = fitted.value[x.shape[1]]
                n, k = len(x), len(space.scales)
                values = np.full((n, k), np.nan)
                values[:, ~np.isnan(space.scales)] = space.whitened(x)
                columns = [
                    batch.column("id").take(pa.array(np.repeat(places, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, space.n)),
                    pa.array(space.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                    pa.array(values.ravel(), from_pandas=True),
                    pa.array(np.tile(space.explained, n), from_pandas=True),
                    pa.array(np.full(n * k, space.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run
