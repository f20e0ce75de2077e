"""Token files: independent zstandard frames, one per document, with a seek table and checksums at the end.

A file is a legal zstandard stream in the public seekable format: a skippable frame with this format's index, one frame per
document, and a skippable frame with the seek table (compressed size, decompressed size and checksum of each frame, footer).
The index has the file's place in the whole (part, chunk), the type of the ids and the documents' own ids in order.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, scratch, text_slices
from .piece_cache import SLICE, LibraryEncoder

#: Fixed values of the zstandard frame format and its seekable variant.
SKIPPABLE_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_FOOTER = b"\xb1\xea\x92\x8f"

#: Text bytes of a write task.
TASK_BYTES = 1 << 27

Document = tuple[int | None, np.ndarray]


def write_file(documents: Iterable[Document], part: int, chunk: int, level: int = 3) -> bytes:
    """One whole file. Ids must be of one unsigned type."""
    compress = zstandard.ZstdCompressor(level=level, write_checksum=False).compress
    frames, sizes, ids, kind = [], [], [], "uint16"
    for doc_id, tokens in documents:
        kind = tokens.dtype.name
        raw = tokens.tobytes()
        frames.append(compress(raw))
        sizes.append((len(frames[-1]), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        ids.append(doc_id)
    head = json.dumps({"part": part, "chunk": chunk, "ids": kind, "documents": len(ids)}).encode()
    index = struct.pack("<I", len(head)) + head + np.array([x or 0 for x in ids], "<i8").tobytes() + bytes(x is None for x in ids)
    first = struct.pack("<II", SKIPPABLE_MAGIC, len(index)) + index
    table = b"".join(struct.pack("<III", *x) for x in [(len(first), 0, 0), *sizes])
    footer = struct.pack("<IB", len(sizes) + 1, 1 << 7) + SEEKABLE_FOOTER
    return first + b"".join(frames) + struct.pack("<II", SEEK_TABLE_MAGIC, len(table) + len(footer)) + table + footer


class TokenFile:
    """Random access to the documents of a file; only the frames asked for are decompressed."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        if len(content) < 17 or content[-4:] != SEEKABLE_FOOTER:
            raise ValueError("no seek table")
        n, flags = struct.unpack("<IB", content[-9:-4])
        width = 12 if flags >> 7 else 8
        table = np.frombuffer(content[-9 - n * width : -9], "<u4").reshape(n, width // 4).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(table[:, 0])])
        if struct.unpack("<II", content[starts[-1] : starts[-1] + 8]) != (SEEK_TABLE_MAGIC, n * width + 9):
            raise ValueError("the seek table doesn't fit the frames")
        size = struct.unpack("<I", content[8:12])[0]
        self.head = json.loads(bytes(self.content[12 : 12 + size]))
        count, at = self.head["documents"], 12 + size
        nulls = np.frombuffer(content, np.uint8, count, at + 8 * count)
        self.doc_ids = [None if null else x for x, null in zip(np.frombuffer(content, "<i8", count, at).tolist(), nulls, strict=True)]
        self.starts, self.table = starts[1:], table[1:]
        self.width = np.dtype(self.head["ids"]).itemsize
        self._decompress = zstandard.ZstdDecompressor().decompress

    def tokens(self) -> int:
        return int(self.table[:, 1].sum()) // self.width

    def document(self, k: int) -> np.ndarray:
        raw = self._decompress(self.content[self.starts[k] : self.starts[k + 1]], max_output_size=max(1, int(self.table[k, 1])))
        if len(raw) != self.table[k, 1] or self.table.shape[1] == 3 and xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, self.head["ids"])


_encoders: dict[bytes, LibraryEncoder] = {}


def worker_encoder(definition: str, pattern: str, keeps_spaces: bool, lower: bool) -> LibraryEncoder:
    key = hashlib.sha256(definition.encode()).digest()
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = LibraryEncoder(definition, pattern, keeps_spaces, lower)
    return _encoders[key]


def write_tokens(docs: DataFrame, tokenizer_file: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", keeps_spaces: bool = True, lower: bool = False, file_bytes: int = 8 << 20, path: str | None = None) -> str:
    """Encode every whole text, append end_id to each document and write token files in ascending order of the id.

    Null texts are empty documents (the end id alone). Null ids come first; documents with an equal id follow each other
    in an order that depends on their texts alone; rows that repeat both may lie in many tasks. An empty table gives a folder without files. A file closes at about
    `file_bytes`, whatever the number of documents; a longer document is still one frame. Other columns are ignored.
    Returns the folder, by default a new one in the shared folder. Files are committed by Spark's own writer, so lost
    executors and repeated tasks leave no half files.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(open(tokenizer_file, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(definition.value, pattern, keeps_spaces, lower)
        part, chunk, size, held = TaskContext.get().partitionId(), 0, 0, []
        end = np.array([end_id], np.uint16).tobytes()

        def close() -> pa.RecordBatch:
            content = write_file(held, part, chunk)[:-4]  # the writer ends each row with the last four bytes
            return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["content"])

        for batch in text_slices(batches, "text", SLICE):
            for doc_id, ids in zip(batch.column("id").to_pylist(), encode.encode_all(batch.column("text")), strict=True):
                held.append((doc_id, np.frombuffer(ids + end, np.uint16)))
                size += held[-1][1].nbytes
                if size >= 2 * file_bytes:  # ids take about half their bytes when compressed
                    yield close()
                    chunk, size, held = chunk + 1, 0, []
        if held:
            yield close()

    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    order = ("id", F.xxhash64("text"), F.monotonically_increasing_id())
    sorted_rows = rows.repartitionByRange(max(partitions(spark), n_bytes // TASK_BYTES), *order).sortWithinPartitions("id", F.xxhash64("text"))
    out = path or scratch(spark, "tokens")
    files = sorted_rows.mapInArrow(run, "content binary").select(F.col("content").cast("string").alias("value"))
    (files.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1").option("lineSep", SEEKABLE_FOOTER.decode("latin-1")).text(out))
    return out


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a folder of token files: doc_id, start (ids before it in the whole), n_tokens, ids_crc32 (of the ids
    as little-endian unsigned 32-bit integers). A damaged frame fails the job, as its checksum tells. Null ids are null again, rows that
    repeat an id are rows again, and a folder without files gives no rows."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = [TokenFile(x.as_py()) for x in batch.column("content")]
            yield pa.RecordBatch.from_arrays([pa.array([f.head["part"] for f in files], pa.int64()), pa.array([f.head["chunk"] for f in files], pa.int64()), pa.array([f.tokens() for f in files], pa.int64())], ["part", "chunk", "tokens"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = TokenFile(content.as_py())
                n = len(file.doc_ids)
                sizes = file.table[:, 1] // file.width
                crcs = [zlib.crc32(file.document(k).astype("<u4").tobytes()) for k in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.head["part"]] * n, pa.int64()), pa.array([file.head["chunk"]] * n, pa.int64()), pa.array(file.doc_ids, pa.int64()), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(crcs, pa.int64())],
                    ["part", "chunk", "doc_id", "offset", "n_tokens", "ids_crc32"],
                )

    files = _files(spark, path)
    # one row per file, then one per part: the running sum over parts is over as many rows as there are write tasks
    by_file = files.mapInArrow(totals, "part long, chunk long, tokens long")
    in_part = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = by_file.groupBy("part").agg(F.sum("tokens").alias("part_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    starts = by_file.withColumn("in_part", F.coalesce(F.sum("tokens").over(in_part), F.lit(0))).join(parts, "part").select("part", "chunk", (F.col("part_start") + F.col("in_part")).alias("file_start"))
    rows = files.mapInArrow(documents, "part long, chunk long, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["part", "chunk"]).select("doc_id", (F.col("file_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The ids of the documents asked for: doc_id, ids (array<int>). Decompresses their frames only. An id that several documents have
    gives each of them, None those with a null id, and one that none has nothing; asking twice is asking once."""
    wanted = set(doc_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = TokenFile(content.as_py())
                found = [k for k, x in enumerate(file.doc_ids) if x in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([file.doc_ids[k] for k in found], pa.int64()), pa.array([file.document(k).astype(np.int32) for k in found], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return _files(spark, path).mapInArrow(run, "doc_id long, ids array<int>")
