"""What the operators share: the cluster's shared folder, tables that cut lineage, Arrow batches, word hashes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands in for a null id where ids are compared or packed into arrays: nulls come last and are one document.
NULL_ID = (1 << 63) - 1

_local_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share. A local session without one gets a folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _local_dir:
        _local_dir.append(tempfile.mkdtemp(prefix="strandline-"))
        atexit.register(shutil.rmtree, _local_dir[0], ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{_local_dir[0]}/checkpoints")
    return f"file://{_local_dir[0]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/strandline/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file systems."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def id_key(name: str) -> Column:
    """The id as a long that is never null."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def split_twins(signed: DataFrame, classes: DataFrame) -> DataFrame | None:
    """None where each node of the classes (a 63-bit hash) stands for one `check` (another one); else the rows, whose nodes
    are made of both hashes where they stood for several. Classes have the columns least_check and most_check. Some n**2 / 2**64
    of n nodes are such."""
    twins = classes.filter("least_check <> most_check").select("node", F.lit(True).alias("twin"))
    if twins.isEmpty():
        return None
    both = F.shiftrightunsigned(F.xxhash64("node", "check"), 1)
    return signed.join(twins, "node", "left").withColumn("node", F.when(F.col("twin"), both).otherwise(F.col("node"))).drop("twin")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about `limit` bytes of text, so that working arrays fit the CPU's caches.
    A longer text is a run of its own and stays whole."""
    for batch in batches:
        offsets = text_offsets(batch.column(column))
        start, n = 0, batch.num_rows
        while start < n:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(n, max(start + 1, end))
            yield batch.slice(start, end - start)
            start = end


def text_offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text starts; null counts as empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    offsets = text_offsets(column)
    buffer = column.buffers()[2] if len(column) else None
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


#: Word bytes are those outside the ASCII white space [\x20\x09-\x0D].
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
BYTE_BASE, ROLL_BASE_1, ROLL_BASE_2 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
_powers: dict[int, np.ndarray] = {}


def _inverse(odd: int) -> int:
    x = 1
    for _ in range(7):
        x = x * (2 - odd * x) & (1 << 64) - 1
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.cumprod(have, dtype=np.uint64, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word of every text, and the index of the first word of each text (one more at the end)."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    inner = offsets[:-1]
    before[inner[inner < len(data)]] = False
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * powers(BYTE_BASE, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(_inverse(BYTE_BASE), len(data) + 1)[starts] + (ends - starts).astype(np.uint64))


def rolling_hashes(hashes: np.ndarray, k: int, base: int = ROLL_BASE_1) -> np.ndarray:
    """A 64-bit hash of each k consecutive word hashes, whichever texts they lie in."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(base, n), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * powers(_inverse(base), n + 1)[: n + 1 - k])


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost position of the least of each `width` consecutive values."""
    at, size = np.arange(len(values)), 1

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[a] <= values[b], a, b)

    while size * 2 <= width:
        at, size = least(at[: len(at) - size], at[size:]), size * 2
    gap = width - size
    return least(at[: len(at) - gap], at[gap:]) if gap else at
