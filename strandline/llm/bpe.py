"""Byte-level BPE encoding and decoding by an automaton and backtracking, equal to merging by rank."""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices
from .piece_cache import SLICE, PieceEncoder


def load_ranks(lines: bytes) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank in each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


def merge_by_rank(string: bytes, ranks: dict[bytes, int], below: int) -> list[bytes]:
    """Plain BPE with the merges of a rank under `below`; quadratic, for tables and tests."""
    parts = [string[k : k + 1] for k in range(len(string))]
    while len(parts) > 1:
        rank, k = min((ranks.get(a + b, below), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank >= below:
            break
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return parts


class BytePairEncoder:
    """Encodes one pre-token in time linear in its length.

    Bytes are mapped to Latin-1 characters, so that the string automaton reads them. It lists the tokens that start at each
    position. A sequence of tokens is what the merges give just if each two neighbours are compatible: if encoding their
    bytes gives the two back. So the longest token compatible with the one before is taken, a dead end steps back to a
    shorter one, and a position that failed once is never entered again, as the encoding of the text before it is unique.
    Compatibility is worked out by undoing merges at the seam and is memoised.
    """

    def __init__(self, ranks: dict[bytes, int], memo: int = 1 << 20):
        self.ranks, self.memo = {b.decode("latin-1"): r for b, r in ranks.items()}, memo
        self.length = {r: len(b) for b, r in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merge_by_rank(token, ranks, rank)
                if len(parts) != 2:  # no merge makes it; only a pre-token that equals it becomes it
                    continue
                self.halves[rank] = ranks[parts[0]], ranks[parts[1]]
                self.joined[self.halves[rank]] = rank
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.known: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        found = self.known.get((left, right))
        if found is None:
            found = self._compatible(left, right)
            if len(self.known) >= self.memo:
                self.known.clear()
            self.known[left, right] = found
        return found

    def _compatible(self, left: int, right: int) -> bool:
        """Undo merges next to the seam, latest first. The pair fails if a merge across the seam would have come earlier
        than the merge that took its part away; of two equal merges the left one comes first."""
        taken = 1 << 62
        while True:
            if self.joined.get((left, right), taken) < taken:
                return False
            if left in self.halves and (left > right or right not in self.halves):
                taken, left = left, self.halves[left][1]
            elif right in self.halves:
                taken, right = right + 1, self.halves[right][0]
            else:
                return True

    def encode(self, string: str) -> list[int]:
        """Ids of a pre-token given as Latin-1 characters."""
        rank = self.ranks.get(string)
        if rank is not None:
            return [rank]
        n, length = len(string), self.length
        starts: list[list[int]] = [[] for _ in range(n)]
        for end, rank in self.automaton.iter(string):
            starts[end + 1 - length[rank]].append(rank)
        out: list[int] = []
        tried: list[int] = []
        dead = bytearray(n + 1)
        at, k = 0, len(starts[0]) - 1
        while at < n:
            tokens = starts[at]
            while k >= 0 and (dead[at + length[tokens[k]]] or out and not self.compatible(out[-1], tokens[k])):
                k -= 1
            if k >= 0:
                out.append(tokens[k])
                tried.append(k)
                at += length[tokens[k]]
                k = len(starts[at]) - 1 if at < n else -1
            else:
                if not out:
                    raise ValueError("the vocabulary doesn't cover these bytes")
                dead[at] = 1
                at -= length[out.pop()]
                k = tried.pop() - 1
        return out


def text_encoder(lines: bytes, pattern: str) -> PieceEncoder:
    """Encodes whole texts to 16-bit ids, each match of the pattern separately, without special tokens."""
    pairs = BytePairEncoder(load_ranks(lines))

    def token(string: str) -> bytes:
        return array("H", pairs.encode(string.encode().decode("latin-1"))).tobytes()

    def whole(string: str) -> bytes:
        return b"".join(token(x) for x in encoder.find(string))

    encoder = PieceEncoder(token, whole, pattern, keeps_spaces=True)
    return encoder


_encoders: dict[tuple[bytes, str], tuple[PieceEncoder, list[bytes]]] = {}


def _worker_encoder(lines: bytes, pattern: str) -> tuple[PieceEncoder, list[bytes]]:
    key = hashlib.sha256(lines).digest(), pattern
    if key not in _encoders:
        ranks = load_ranks(lines)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        _encoders[key] = text_encoder(lines, pattern), tokens
    return _encoders[key]


def bpe_roundtrip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns one row per input row: the id column, `ids` (array<int>) and `decoded` (binary). A null text counts as empty
    and gives no ids. Rows are independent: null and repeated ids are carried as they are; other columns are left out.
    The rank file is read by the driver (a fixed file of under 2 MB) and broadcast.
    """
    lines = docs.sparkSession.sparkContext.broadcast(open(rank_file, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tokens = _worker_encoder(lines.value, pattern)
        for batch in text_slices(batches, "text", SLICE):
            ids = [np.frombuffer(x, np.uint16) for x in encode.encode_all(batch.column("text"))]
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
            decoded = [b"".join(map(tokens.__getitem__, x.tolist())) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("id"), column, pa.array(decoded, pa.binary())], ["id", "ids", "decoded"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded binary").withColumnRenamed("id", id_col)


def bpe_digest(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256. As bpe_roundtrip, but
    digests are taken where the ids are made, so that the arrays needn't leave the worker."""
    lines = docs.sparkSession.sparkContext.broadcast(open(rank_file, "rb").read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tokens = _worker_encoder(lines.value, pattern)
        decimal = [str(k) for k in range(len(tokens))]
        for batch in text_slices(batches, "text", SLICE):
            counts, shas, decoded = [], [], []
            for raw in encode.encode_all(batch.column("text")):
                ids = array("H", raw).tolist()
                counts.append(len(ids))
                shas.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([tokens[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
