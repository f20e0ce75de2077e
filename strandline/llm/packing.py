"""Pack documents into windows with their lexical neighbours, found by BM25 in an inverted index sharded by content."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, partitions, text_slices
from .piece_cache import SLICE
from .token_files import worker_encoder

#: Ids are 16-bit, so a vocabulary has up to VOCABULARY entries; document frequencies travel in chunks of them.
VOCABULARY, _CHUNK = 1 << 16, 1024
#: Saturation of repeated ids and weight of a document's length.
K1, B = 1.2, 0.75
#: Most ids that one task packs, shard by shard, and the share of a shard's documents (one in so many) that makes an id frequent.
TASK_TOKENS, FREQUENT = 1 << 25, 16
#: Ids of a shard; and an id that one in so many documents of the corpus has, or more, may say where a document is dealt.
SHARD_TOKENS, DEAL_SHARE = 1 << 20, 100


def document_terms(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ids of documents: id, document and count, in the order of id and document."""
    kind, bits = (np.uint32, 16) if len(documents) <= 1 << 16 else (np.int64, 32)
    owner = np.repeat(np.arange(len(documents), dtype=kind), [len(d) for d in documents])
    both = np.sort(np.concatenate(documents).astype(kind) << kind(bits) | owner)
    new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
    count = np.diff(np.append(new, len(both)))
    both = both[new].astype(np.int64)
    return both >> bits, both & (1 << bits) - 1, count


class Dealer:
    """A key by which like documents come next to each other: the four ids that weigh most in each, as BM25 has it, of those
    that at least one in DEAL_SHARE documents has. Near copies have the same ones mostly."""

    def __init__(self, frequency: np.ndarray, n_docs: int, mean_length: float):
        self.idf = np.where(DEAL_SHARE * frequency >= n_docs, idf_of(frequency, n_docs), 0.0)
        self.mean_length = mean_length

    def __call__(self, documents: list[np.ndarray]) -> np.ndarray:
        terms, owner, count = document_terms(documents)
        order = np.argsort(owner, kind="stable")
        terms, owner, count = terms[order], owner[order], count[order]
        first = np.searchsorted(owner, np.arange(len(documents)))
        weight = bm25_weights(self.idf[terms], count, np.array([len(d) for d in documents])[owner], self.mean_length)
        key = np.zeros(len(documents), np.int64)
        for _ in range(4):
            at = np.flatnonzero(weight == np.maximum.reduceat(weight, first)[owner])
            at = at[np.unique(owner[at], return_index=True)[1]]
            key = key << 16 | terms[at]
            weight[at] = -1
        return key


def idf_of(frequency: np.ndarray, n_docs: int) -> np.ndarray:
    return np.log1p((n_docs - frequency + 0.5) / (frequency + 0.5))


def bm25_weights(idf: np.ndarray, count: np.ndarray, length: np.ndarray, mean_length: float) -> np.ndarray:
    """What each id of a document adds to its score for a query that has the id."""
    return idf * count * (K1 + 1) / (count + K1 * (1 - B + B * length / mean_length))


TOKEN_SCHEMA = "doc_id long, ids binary, n_tokens long, chunk int, counts binary"
_TOKEN_NAMES = [x.split()[0] for x in TOKEN_SCHEMA.split(", ")]


def encode_documents(docs: DataFrame, tokenizer_file: str, pattern: str, end_id: int, id_col: str, text_col: str, keeps_spaces: bool, lower: bool) -> DataFrame:
    """A row for each document: doc_id, ids (16-bit little-endian bytes with the end id), n_tokens; and for
    each task a row for each chunk of the vocabulary that it met: chunk, counts (64-bit numbers of its documents with each id)."""
    definition = docs.sparkSession.sparkContext.broadcast(open(tokenizer_file, encoding="utf-8").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(definition.value, pattern, keeps_spaces, lower)
        end = np.array([end_id], np.uint16).tobytes()
        total = np.zeros(VOCABULARY, np.int64)
        for batch in text_slices(batches, "text", SLICE):
            n = batch.num_rows
            ids = [x + end for x in encode.encode_all(batch.column("text"))]
            terms, _, _ = document_terms([np.frombuffer(x, np.uint16) for x in ids])
            total += np.bincount(terms, minlength=VOCABULARY)
            columns = [batch.column("doc_id"), pa.array(ids, pa.binary()), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, _TOKEN_NAMES)
        parts = total.reshape(-1, _CHUNK)
        used = np.flatnonzero(parts.any(axis=1))
        none = [pa.nulls(len(used), t) for t in (pa.int64(), pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(used.astype(np.int32)), pa.array([parts[k].tobytes() for k in used], pa.binary())], _TOKEN_NAMES)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, TOKEN_SCHEMA)


def document_frequencies(tokens: DataFrame) -> np.ndarray:
    """Number of documents with each id, over all documents, from the tasks' counts. What comes to the driver is one number
    for each id of the vocabulary."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(counts.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], ["chunk", "counts"])

    parts = tokens.select("chunk", "counts").filter("chunk is not null")
    schema = "chunk int, counts binary"
    found = parts.mapInArrow(add, schema).repartition(VOCABULARY // _CHUNK, "chunk").mapInArrow(add, schema).collect()
    out = np.zeros((VOCABULARY // _CHUNK, _CHUNK), np.int64)
    for row in found:
        out[row.chunk] = np.frombuffer(row.counts, np.int64)
    return out.reshape(-1)


class Bm25Index:
    """An inverted index over the documents of a shard, with the idf and mean length of the whole corpus. Lists of ids that
    many documents have are also kept as dense rows, which take at most FREQUENT times the room of the lists."""

    def __init__(self, documents: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(documents)
        terms, self.owner, count = document_terms(documents)
        self.weight = bm25_weights(idf[terms], count, np.array([len(d) for d in documents])[self.owner], mean_length).astype(np.float32)
        sizes = np.bincount(terms, minlength=len(idf))
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        frequent = np.flatnonzero(FREQUENT * sizes > self.n)
        self.row = np.full(len(idf), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), self.n), np.float32)
        at = self.row[terms]
        self.dense[at[at >= 0], self.owner[at >= 0]] = self.weight[at >= 0]

    def scores(self, terms: np.ndarray) -> np.ndarray:
        """Score of every document for a set of distinct ids."""
        row = self.row[terms]
        terms = terms[row < 0].astype(np.int64)
        lo = self.bounds[terms]
        sizes = self.bounds[terms + 1] - lo
        at = np.repeat(lo - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return self.dense[row[row >= 0]].sum(axis=0) + np.bincount(self.owner[at], self.weight[at], self.n)


Piece = tuple[int, int, int, int, int]


def pack_shard(documents: list[np.ndarray], index: Bm25Index, window: int) -> list[Piece]:
    """Pieces (document, start, length, sequence, offset). A seed's own ids open a window, then its best unused neighbours
    follow until the window is full, earlier ones first where scores are equal. The last one is cut there, and its rest
    seeds the next window. What is left at the end goes to sequences of a power of two, so nothing is padded."""
    unused = np.ones(len(documents), bool)
    pieces: list[Piece] = []
    sequence = filled = 0

    def put(document: int, start: int) -> int:
        """Place ids from start on while the window has room; where it stopped."""
        nonlocal filled
        length = min(len(documents[document]) - start, window - filled)
        pieces.append((document, start, length, sequence, filled))
        filled += length
        return start + length

    next_seed, seed, start = 0, -1, 0
    while True:
        if seed < 0:
            while next_seed < len(documents) and not unused[next_seed]:
                next_seed += 1
            if next_seed == len(documents):
                break
            seed, start = next_seed, 0
            unused[seed] = False
        head, start = seed, put(seed, start)
        if start == len(documents[seed]):
            seed = -1
        if seed < 0 and filled < window:
            left = np.flatnonzero(unused)
            ranked = left[np.argsort(-index.scores(np.unique(documents[head]))[left], kind="stable")]
            for near in ranked:
                unused[near] = False
                stopped = put(int(near), 0)
                if stopped < len(documents[near]):
                    seed, start = int(near), stopped
                if filled == window:
                    break
        if filled == window:
            sequence, filled = sequence + 1, 0
    if not filled:
        return pieces
    # cut the last sequence, which isn't full, into its powers of two
    tail = [p for p in pieces if p[3] == sequence]
    pieces = pieces[: len(pieces) - len(tail)]
    free = 1 << filled.bit_length() - 1
    left, offset = filled - free, 0
    for document, start, length, _, _ in tail:
        while length:
            take = min(length, free - offset)
            pieces.append((document, start, take, sequence, offset))
            start, length, offset = start + take, length - take, offset + take
            if offset == free:
                sequence, offset, free = sequence + 1, 0, 1 << left.bit_length() - 1 if left else 0
                left -= free
    return pieces


PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_PIECE_NAMES = [x.split()[0] for x in PIECE_SCHEMA.split(", ")]


def pack(docs: DataFrame, tokenizer_file: str, pattern: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, shard_tokens: int = SHARD_TOKENS, keeps_spaces: bool = False, lower: bool = True) -> DataFrame:
    """Every id of every document in just one piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are sorted by content (see Dealer), so that near copies and documents of the same words come next to each
    other, and cut into shards of about `shard_tokens` ids. Each shard is an inverted index with the document frequencies
    and mean length of the whole corpus; each seed asks that of its shard, and its best unused neighbours fill its window.
    A window that isn't full at the end of a shard goes to sequences of powers of two.

    Null texts are empty documents (the end id alone). Null and repeated ids are separate documents. Ties of the order go
    by the ids, and what ties in those too are equal texts; rows that repeat id and text are told apart by their place in
    the table, so any number of them is dealt to many tasks. Range bounds are sampled where there are several tasks, so
    shards may differ between runs there. A vocabulary may have 65 536 entries; larger ids raise OverflowError. An empty
    table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    tokens = encode_documents(docs, tokenizer_file, pattern, end_id, id_col, text_col, keeps_spaces, lower)
    tokens = materialise(tokens.withColumn("place", F.monotonically_increasing_id()), "packing-ids")
    n_docs, n_ids = tokens.agg(F.count("n_tokens"), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    frequency = document_frequencies(tokens)
    mean = max(1.0, n_ids / max(1, n_docs))
    idf = spark.sparkContext.broadcast(idf_of(frequency, n_docs))
    dealer = spark.sparkContext.broadcast(Dealer(frequency, n_docs, mean))
    tasks = max(1, -(-n_ids // TASK_TOKENS), min(partitions(spark), n_ids // shard_tokens))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "ids", SLICE):
            if batch.num_rows:
                yield batch.append_column("deal", pa.array(dealer.value([np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column("ids")])))

    order = ("deal", F.xxhash64("ids"), "doc_id", "place")
    dealt = tokens.filter("n_tokens is not null").select("doc_id", "ids", "place").mapInArrow(deal, "doc_id long, ids binary, place long, deal long")
    dealt = dealt.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, np.ndarray]] = []
        size, sequence = 0, TaskContext.get().partitionId() << 32

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            documents = [x for _, x in held]
            rows = []
            for d, start, length, at, offset in pack_shard(documents, Bm25Index(documents, idf.value, mean), window):
                crc = zlib.crc32(documents[d][start : start + length].astype("<u4").tobytes())
                rows.append((held[d][0], start, length, crc, len(documents[d]), sequence + at, offset))
            sequence = rows[-1][5] + 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], _PIECE_NAMES)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                held.append((doc_id, np.frombuffer(ids, np.uint16)))
                size += len(held[-1][1])
                if size >= shard_tokens:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    return dealt.select("doc_id", "ids").mapInArrow(run, PIECE_SCHEMA)
