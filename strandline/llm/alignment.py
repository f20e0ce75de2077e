"""Which tokens of two tokenizers stand for the same bytes: groups, links, and corpus-wide counts of linked ids."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, partitions, text_slices
from .piece_cache import byte_letters

#: Text bytes that are handled together, and those of a chunk of documents, whose pairs travel together.
SLICE, CHUNK_BYTES = 1 << 22, 1 << 24
#: Longest piece that is kept for later texts, and bytes of pieces, groups and pairs that are kept; pieces that are encoded
#: together, and those of them that are one string for the first side; and links of a group from which on they are made of its
#: distinct ids.
LONG_PIECE, TABLE_BYTES, LEARNED, JOINED, LARGE_GROUP = 64, 1 << 26, 1 << 14, 1 << 8, 1 << 12
#: Ids of the first side in a stripe, pairs that a task holds before it passes them on, and bytes of asked pairs that a task answers.
STRIPE_IDS, HELD, ANSWER_BYTES = 64, 1 << 21, 1 << 26
#: One space between characters that no tokenizer takes for white space: no token of either side goes across.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_RARE_SPACE, _WIDE_SPACE = re.compile(r"[^\S \n]"), re.compile(r"\s | \s")


class Tokenizers:
    """Side A is a byte-level vocabulary of the tokenizers library (its JSON text), side B a sentencepiece model."""

    def __init__(self, definition: str, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(definition)
        self.first.encode_special_tokens = True
        self.second = SentencePieceProcessor(model_proto=model)
        byte_of = {letter: b for b, letter in byte_letters().items()}
        self.first_bytes = [b""] * self.first.get_vocab_size()
        for letters, k in self.first.get_vocab().items():
            # special tokens aren't written in byte letters, and no text gives them here
            self.first_bytes[k] = bytes(map(byte_of.__getitem__, letters)) if byte_of.keys() >= set(letters) else letters.encode()
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.second_bytes = [bytes([int(p[3:5], 16)]) if self.second.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.first_lengths, self.second_lengths = (np.array(list(map(len, x)), np.int64) for x in (self.first_bytes, self.second_bytes))
        self.decimal = list(map(str, range(max(self.shape))))
        #: merges of the second side stop before a space unless a piece has one behind another character
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.first_bytes), len(self.second_bytes)

    def encode(self, texts: Sequence[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of a space and the text by the first side, and of the text by the second, which adds the space."""
        first = self.first.encode_batch_fast([" " + x for x in texts], add_special_tokens=False)
        return [(x.ids, y) for x, y in zip(first, self.second.encode(list(texts), num_threads=1), strict=True)]

    def encode_joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of the first side for pieces that neither start nor end with white space, one piece after the other, and how many
        each has; None if a token goes across. Many pieces are one string, as calls and results cost more than short pieces."""
        strings = [" " + " ".join(pieces[k : k + JOINED]) for k in range(0, len(pieces), JOINED)]
        ids = np.array(list(chain.from_iterable(x.ids for x in self.first.encode_batch_fast(strings, add_special_tokens=False))), np.int64)
        ends = np.cumsum(self.first_lengths[ids])
        bounds = np.cumsum(np.array(list(map(len, map(str.encode, pieces)))) + 1)
        upto = np.searchsorted(ends, bounds, side="right")
        if not len(ids) or ends[-1] != bounds[-1] or (ends[upto - 1] != bounds).any():
            return None
        return ids, np.diff(upto, prepend=0)


@dataclass
class Groups:
    """The groups of several strings, whose tokens stand one string after the other. For each token of a side its group, rising; for
    each group its string."""

    first: np.ndarray
    second: np.ndarray
    first_group: np.ndarray
    second_group: np.ndarray
    string: np.ndarray

    def links(self) -> np.ndarray:
        """How many each group has."""
        n = len(self.string)
        return np.bincount(self.first_group, minlength=n) * np.bincount(self.second_group, minlength=n)

    def names(self, decimal: list[str], n: int) -> list[str]:
        """`a1,a2|b1;a3|b2` for each of the n strings, all of which have groups."""
        group = np.concatenate([self.first_group, self.second_group])
        side = np.repeat([0, 1], [len(self.first), len(self.second)])
        order = np.lexsort((side, group))
        ids, group, side = np.concatenate([self.first, self.second])[order], group[order], side[order]
        apart = np.full(len(ids), "\n", object)
        apart[:-1] = np.select([side[1:] > side[:-1], group[1:] == group[:-1], self.string[group[1:]] == self.string[group[:-1]]], ["|", ",", ";"], "\n")
        both = [""] * (2 * len(ids))
        both[::2], both[1::2] = map(decimal.__getitem__, ids.tolist()), apart.tolist()
        return "".join(both).split("\n")[:n]

    def pairs(self, width: int, space: int) -> tuple[np.ndarray, np.ndarray]:
        """string * space + a * width + b of the linked pairs, rising, and how many links of a string each has."""
        n = len(self.string)
        in_first, in_second = np.bincount(self.first_group, minlength=n), np.bincount(self.second_group, minlength=n)
        first_at, second_at = np.cumsum(in_first) - in_first, np.cumsum(in_second) - in_second
        large = in_first * in_second > LARGE_GROUP
        each = np.where(large, 0, in_second)[self.first_group]
        at = np.repeat(second_at[self.first_group] - np.cumsum(each) + each, each) + np.arange(int(each.sum()))
        base = self.string[self.first_group].astype(np.int64) * space + self.first.astype(np.int64) * width
        keys, times = [np.repeat(base, each) + self.second[at]], [np.ones(len(at), np.int64)]
        for g in np.flatnonzero(large).tolist():  # made of their distinct ids
            a, n_a = np.unique(self.first[first_at[g] : first_at[g] + in_first[g]], return_counts=True)
            b, n_b = np.unique(self.second[second_at[g] : second_at[g] + in_second[g]], return_counts=True)
            keys.append((self.string[g] * space + (a.astype(np.int64) * width)[:, None] + b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
        return summed(np.concatenate(keys), np.concatenate(times))


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some strings one after the other, and how many each has."""
    n = np.array(list(map(len, lists)), np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


def groups(a: np.ndarray, n_a: np.ndarray, b: np.ndarray, first_lengths: np.ndarray, second_lengths: np.ndarray) -> Groups:
    """The ids of both sides between the byte offsets where tokens of both end. The sides of each string cover the same bytes;
    n_a are the ids that each string has on the first side, lengths the bytes of each id."""
    ends_a, ends_b = np.cumsum(first_lengths[a]), np.cumsum(second_lengths[b])
    near = np.searchsorted(ends_b, ends_a)
    common = ends_a[ends_b[np.minimum(near, max(0, len(ends_b) - 1))] == ends_a] if len(a) else ends_a
    last = ends_a[np.cumsum(n_a) - 1]
    return Groups(a, b, np.searchsorted(common, ends_a), np.searchsorted(common, ends_b), np.searchsorted(last, common))


def summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sums of what belongs to each."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(times, new) if len(new) else times


class Aligner:
    """Aligns texts piece by piece; pieces are what stands between single spaces, so most are found in a table.

    Long pieces are never kept, and a table of over TABLE_BYTES keeps the pieces found again since it was last full, if they fill
    no more than half of it. This bounds memory and changes no result."""

    def __init__(self, sides: Tokenizers):
        self.sides = sides
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.names: list[str] = []
        #: by piece: ids of either side, groups and links (-1 in the first where bytes differ), then pairs from `first` on
        self.counts = np.zeros((0, 4), np.int64)
        self.keys, self.times, self.first = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.held = 0
        self.used = np.zeros(0, bool)

    def _learn(self, pieces: list[str], plain: bool) -> None:
        """plain: no piece starts or ends with white space."""
        sides = self.sides
        for k in range(0, len(pieces), LEARNED):
            part = pieces[k : k + LEARNED]
            raw = (" " + " ".join(part)).encode()
            joined = sides.encode_joined(part) if plain and sides.cuts else None
            if joined is not None:
                b = flat(sides.second.encode(part, num_threads=1))
                if all(b"".join(map(table.__getitem__, x.tolist())) == raw for table, x in ((sides.first_bytes, joined[0]), (sides.second_bytes, b[0]))):
                    self._keep(part, *joined, *b, np.ones(len(part), bool))
                    continue
            coded = sides.encode(part)
            good = [b"".join(map(sides.first_bytes.__getitem__, x)) == b" " + p.encode() == b"".join(map(sides.second_bytes.__getitem__, y)) for (x, y), p in zip(coded, part, strict=True)]
            self._keep(part, *flat([x for (x, _), g in zip(coded, good, strict=True) if g]), *flat([y for (_, y), g in zip(coded, good, strict=True) if g]), np.array(good))

    def _keep(self, pieces: list[str], a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray, good: np.ndarray) -> None:
        """a, b: the ids of the good ones; n_a, n_b: how many each of these has."""
        width = self.sides.shape[1]
        space = self.sides.shape[0] * width
        self.index.update(zip(pieces, range(len(self.names), len(self.names) + len(pieces)), strict=True))
        counts = np.zeros((len(pieces), 4), np.int64)
        counts[~good, 0] = -1
        names, first, keys, times = [""] * len(pieces), np.zeros(len(pieces), np.int64), self.keys[:0], self.times[:0]
        if len(n_a):
            found = groups(a, n_a, b, self.sides.first_lengths, self.sides.second_lengths)
            at = np.flatnonzero(good)
            counts[at, 0], counts[at, 1] = n_a, n_b
            counts[at, 2] = np.bincount(found.string, minlength=len(n_a))
            keys, times = found.pairs(width, space)
            owner, keys = np.divmod(keys, space)
            np.add.at(counts[:, 3], at[owner], times)
            first[at] = np.bincount(owner, minlength=len(n_a))
            for k, name in zip(at.tolist(), found.names(self.sides.decimal, len(n_a)), strict=True):
                names[k] = name
        self.names += names
        self.held += 250 * len(pieces) + sum(map(len, pieces)) + sum(map(len, names)) + 16 * len(keys)
        self.counts = np.concatenate([self.counts, counts])
        self.keys, self.times, self.first = np.concatenate([self.keys, keys]), np.concatenate([self.times, times]), np.concatenate([self.first, self.first[-1] + np.cumsum(first)])

    def _forget(self, n: int) -> None:
        """Drop the pieces from the n-th on."""
        for piece in list(self.index)[n:]:
            self.held -= 250 + len(piece) + len(self.names[self.index.pop(piece)])
        self.held -= 16 * (len(self.keys) - int(self.first[n]))
        self.names, self.counts, self.used = self.names[:n], self.counts[:n], self.used[:n]
        self.keys, self.times, self.first = self.keys[: self.first[n]], self.times[: self.first[n]], self.first[: n + 1]

    def _shrink(self) -> None:
        """Keep the pieces that were found again, and forget that they were."""
        at = np.flatnonzero(self.used)
        index = list(self.index)
        pieces, names, n = [index[k] for k in at.tolist()], [self.names[k] for k in at.tolist()], np.diff(self.first)[at]
        held = 250 * len(pieces) + sum(map(len, pieces)) + sum(map(len, names)) + 16 * int(n.sum())
        if held > TABLE_BYTES // 2:
            self._clear()
            return
        keys = np.repeat(self.first[at] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        self.index, self.names, self.held = dict(zip(pieces, range(len(pieces)), strict=True)), names, held
        self.counts, self.used = self.counts[at], np.zeros(len(at), bool)
        self.keys, self.times, self.first = self.keys[keys], self.times[keys], np.concatenate([[0], np.cumsum(n)])

    def _pieces(self, text: str) -> list[str]:
        if not self.sides.cuts:
            return [text]
        wide = "  " in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace()
        return _CUT.split(text) if wide or _RARE_SPACE.search(text) and _WIDE_SPACE.search(text) else text.split(" ")

    def align(self, texts: list[str | None]) -> list[tuple[tuple[int, int, int, int], str, np.ndarray, np.ndarray]]:
        """Of each text the numbers of ids of either side, of groups and of links, its groups as text, its linked pairs and
        their links. Texts without tokens give zeros."""
        pieces, ends = [], []
        for text in texts:
            if text:
                pieces += self._pieces(text)
            ends.append(len(pieces))
        # Arrow tells distinct pieces apart, so that only these are looked up and kept as strings
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        del pieces
        distinct, at_piece = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        of_distinct = np.fromiter((self.index.get(x, -1) for x in distinct), np.int64, len(distinct))
        known = len(self.index)
        unknown = np.flatnonzero(of_distinct < 0)
        new: dict[tuple[bool, bool], list[int]] = {}
        for k in unknown.tolist():
            x = distinct[k]
            new.setdefault((len(x) > LONG_PIECE, x[:1].isspace() or x[-1:].isspace()), []).append(k)
        for (_, odd), some in sorted(new.items()):  # short ones first
            of_distinct[some] = np.arange(len(self.index), len(self.index) + len(some))
            self._learn([distinct[k] for k in some], not odd)
        short = known + sum(len(some) for (long, _), some in new.items() if not long)
        del distinct
        place = of_distinct[at_piece]
        self.used = np.concatenate([self.used, np.zeros(len(self.index) - known, bool)])
        self.used[of_distinct[of_distinct < known]] = True
        bounds = np.concatenate([[0], ends]).astype(np.int64)
        sums = np.zeros((len(place) + 1, 4), np.int64)
        np.cumsum(self.counts[place], axis=0, out=sums[1:])
        bad = np.concatenate([[0], np.cumsum(self.counts[place, 0] < 0)])
        good = (np.diff(bad[bounds]) == 0) & (np.diff(bounds) > 0)
        # each piece's pairs once for each text, then each pair once for each text
        doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
        there = good[doc]
        code, often = summed(doc[there] * len(self.names) + place[there], np.ones(int(there.sum()), np.int64))
        doc, piece = np.divmod(code, max(1, len(self.names)))
        n = self.first[piece + 1] - self.first[piece]
        at = np.repeat(self.first[piece] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        space = self.sides.shape[0] * self.sides.shape[1]
        key, times = summed(np.repeat(doc, n) * space + self.keys[at], self.times[at] * np.repeat(often, n))
        doc, key = np.divmod(key, space)
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
        names = pa.array(list(map(self.names.__getitem__, of_distinct.tolist())), pa.large_string()).take(pa.array(at_piece))
        names = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), names), pa.scalar(";", pa.large_string())).to_pylist()
        out = []
        for k, ok in enumerate(good.tolist()):
            a, b = bounds[k], bounds[k + 1]
            if ok:
                out.append((tuple((sums[b] - sums[a]).tolist()), names[k], key[cuts[k] : cuts[k + 1]], times[cuts[k] : cuts[k + 1]]))
            else:
                out.append(((0, 0, 0, 0), "", key[:0], times[:0]))
        if short < len(self.index):
            self._forget(short)
        if self.held > TABLE_BYTES:
            self._shrink()
        return out


_aligners: dict[bytes, Aligner] = {}


def _aligner(definition: str, model: bytes) -> Aligner:
    key = hashlib.sha256(definition.encode() + model).digest()
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(Tokenizers(definition, model))
    return _aligners[key]


class Stripe:
    """A dense matrix of counts: some ids of the first side by all of the second. Stripe s of n has the ids s, s + n, s + 2 n, ..."""

    def __init__(self, stripes: int, shape: tuple[int, int]):
        self.stripes, self.width = stripes, shape[1]
        self.counts = np.zeros((-(-shape[0] // stripes), shape[1]), np.int64)
        self.best = np.zeros(len(self.counts), np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.divmod(keys, self.width)
        return a // self.stripes, b

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        np.add.at(self.counts, self._places(keys), counts)

    def settle(self) -> None:
        self.best = self.counts.max(axis=1)

    def scores(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs' counts, and whether each is the highest of its id of the first side."""
        row, column = self._places(keys)
        found = self.counts[row, column]
        return found, found == self.best[row]

    def entries(self, stripe: int) -> tuple[np.ndarray, np.ndarray]:
        row, column = np.nonzero(self.counts)
        return (row * self.stripes + stripe) * self.width + column, self.counts[row, column]


def _pair_type(shape: tuple[int, int]) -> type:
    """Of pairs that are stored or sent."""
    return np.uint32 if shape[0] * shape[1] < 1 << 32 else np.int64


def _ints(raw: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(raw, kind).astype(np.int64)


def _by_stripe(keys: np.ndarray, stripes: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """The stripes that have some of the keys, and the places of these."""
    stripe = keys // width % stripes
    order = np.argsort(stripe, kind="stable")
    at = np.flatnonzero(np.concatenate([[True], np.diff(stripe[order]) != 0])) if len(order) else np.zeros(0, np.int64)
    for a, b in zip(at, np.append(at[1:], len(order)), strict=True):
        yield int(stripe[order[a]]), order[a:b]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def aligned_documents(docs: DataFrame, definition: str, model: bytes, shape: tuple[int, int], id_col: str, text_col: str, texts: bool) -> DataFrame:
    """One row per document: chunk, id, n_a, n_b, n_groups, n_links, groups (text, null without `texts`), groups_sha256, pairs and
    times (its linked pairs, rising, and their links), and for each chunk a row without id (`whole` is true) with its documents' pairs
    and how many of them have each."""
    pair_type = _pair_type(shape)
    sides = docs.sparkSession.sparkContext.broadcast((definition, model))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, task = _aligner(*sides.value), TaskContext.get().partitionId()
        chunk, size, held = task << 32, 0, []

        def close(ids: pa.DataType) -> pa.RecordBatch:
            keys, counts = summed(np.concatenate(held), np.ones(sum(map(len, held)), np.int64))
            return batch_of(chunk, True, pa.nulls(1, ids), [((0, 0, 0, 0), "", keys, counts)])

        for batch in text_slices(batches, "text", SLICE):
            found = aligner.align(batch.column("text").to_pylist())
            yield batch_of(chunk, False, batch.column("id"), found)
            held += [x[2] for x in found]
            size += batch.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield close(batch.column("id").type)
                chunk, size, held = chunk + 1, 0, []
        if held:
            yield close(batch.column("id").type)

    def batch_of(chunk: int, whole: bool, ids: pa.Array, found: list[tuple]) -> pa.RecordBatch:
        n = len(found)
        numbers = [pa.array([x[0][k] for x in found], pa.int64()) for k in range(4)]
        digests = [hashlib.sha256(x[1].encode()).hexdigest() if x[0][0] else "" for x in found]
        names = [pa.array([x[1] if texts else None for x in found], pa.string()), pa.array(digests, pa.string())]
        blobs = [pa.array([x.tobytes() for x in part], pa.binary()) for part in ([x[2].astype(pair_type) for x in found], [x[3] for x in found])]
        columns = [pa.array([chunk] * n, pa.int64()), pa.array([whole] * n), ids, *numbers, *names, *blobs]
        return pa.RecordBatch.from_arrays(columns, ["chunk", "whole", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "groups_sha256", "pairs", "times"])

    return rows.mapInArrow(run, f"chunk long, whole boolean, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, pairs binary, times binary")


def _count_stripes(chunks: DataFrame, stripes: int, shape: tuple[int, int]) -> DataFrame:
    """stripe, pairs, counts: by stripe, in how many documents each linked pair is. Tasks add up their chunks before they send."""
    sent_schema, pair_type = pa.schema([("stripe", pa.int32()), ("pairs", pa.binary()), ("counts", pa.binary())]), _pair_type(shape)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs"), batch.column("times"), strict=True):
                held.append((_ints(pairs.as_py(), pair_type), _ints(counts.as_py())))
                n += len(held[-1][0])
                if n >= HELD:
                    keys, counts = summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held, n = [(keys, counts)], len(keys)
                    if n >= HELD // 2:  # adding up makes them hardly fewer
                        yield from sent(keys, counts)
                        held, n = [], 0
        if held:
            yield from sent(*summed(*(np.concatenate(x) for x in zip(*held, strict=True))))

    def sent(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = [(s, keys[at].astype(pair_type).tobytes(), counts[at].tobytes()) for s, at in _by_stripe(keys, stripes, shape[1])]
        if rows:
            yield _batch(rows, sent_schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, stripe = None, None
        for batch in batches:
            for s, pairs, counts in zip(*[batch.column(c) for c in ("stripe", "pairs", "counts")], strict=True):
                if s.as_py() != at:
                    if stripe is not None:
                        yield summary(at, stripe)
                    at, stripe = s.as_py(), Stripe(stripes, shape)
                stripe.add(_ints(pairs.as_py(), pair_type), _ints(counts.as_py()))
        if stripe is not None:
            yield summary(at, stripe)

    def summary(at: int, stripe: Stripe) -> pa.RecordBatch:
        keys, counts = stripe.entries(at)
        return _batch([(at, keys.astype(pair_type).tobytes(), counts.tobytes())], sent_schema)

    parts = max(partitions(chunks.sparkSession), 1)
    sums = chunks.select("pairs", "times").mapInArrow(send, "stripe int, pairs binary, counts binary")
    return sums.repartition(parts, "stripe").sortWithinPartitions("stripe").mapInArrow(add, "stripe int, pairs binary, counts binary")


def _answers(chunks: DataFrame, counted: DataFrame, stripes: int, shape: tuple[int, int], salts: int) -> DataFrame:
    """chunk, pairs, counts, best: for each chunk the counts of its pairs. A stripe's counts go to `salts` tasks, each of which answers
    some of the chunks, one after the other."""
    asked_schema = pa.schema([("stripe", pa.int32()), ("chunk", pa.int64()), ("pairs", pa.binary())])
    told_schema = pa.schema([("chunk", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary()), ("best", pa.binary())])
    pair_type = _pair_type(shape)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs in zip(batch.column("chunk").to_pylist(), batch.column("pairs"), strict=True):
                keys = _ints(pairs.as_py(), pair_type)
                rows = [(s, chunk, keys[at].astype(pair_type).tobytes()) for s, at in _by_stripe(keys, stripes, shape[1])]
                if rows:
                    yield _batch(rows, asked_schema)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripe = Stripe(stripes, shape)
        for batch in batches:
            rows = []
            for chunk, pairs, counts in zip(batch.column("chunk").to_pylist(), batch.column("pairs"), batch.column("counts"), strict=True):
                keys = _ints(pairs.as_py(), pair_type)
                if chunk is None:  # a stripe's counts come before its questions
                    stripe = Stripe(stripes, shape)
                    stripe.add(keys, _ints(counts.as_py()))
                    stripe.settle()
                else:
                    found, best = stripe.scores(keys)
                    rows.append((chunk, pairs.as_py(), found.tobytes(), best.tobytes()))
            if rows:
                yield _batch(rows, told_schema)

    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts)).cast("int")
    asked = chunks.select("chunk", "pairs").mapInArrow(ask, "stripe int, chunk long, pairs binary").select("stripe", salt.alias("salt"), "chunk", "pairs", F.lit(None).cast("binary").alias("counts"))
    known = counted.select("stripe", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(None).cast("long").alias("chunk"), "pairs", "counts")
    dealt = known.unionByName(asked).repartition(partitions(chunks.sparkSession), "stripe", "salt").sortWithinPartitions("stripe", "salt", F.asc_nulls_first("chunk"))
    return dealt.select("chunk", "pairs", "counts").mapInArrow(answer, "chunk long, pairs binary, counts binary, best binary")


def align_tokenizers(docs: DataFrame, definition_file: str, model_file: str, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """Align the tokens of every whole text by two tokenizers: the id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups
    (`a1,a2|b1;a3|b2`: the groups' ids in order; null without `texts`) and groups_sha256 ('' without tokens) of each document.

    Side A encodes a space and the text, side B the text, to which it adds the space; special tokens' strings are plain text. Byte
    offsets where tokens of both sides end cut the tokens into groups; every A token of a group is linked with every B token of it. A
    pair of ids counts the documents that have it linked. n_best are links whose count is the highest of their A id, ties included,
    count_sum is the sum of counts over links. Null and empty texts, and those whose tokens' bytes differ from a space and
    the text, have no tokens: zeros and ''. Null and repeated ids are rows of their own, an empty table gives no rows, and other columns
    are ignored.

    Counts are dense matrices in stripes of A ids, to which tasks send sums of their documents' pairs. Documents are in chunks of about 16 MB
    of text that lie in the shared folder; a chunk's distinct pairs are asked of the stripes, and the answers meet
    the chunk's links. So a frequent id is one entry of a chunk, however many documents have it, and no task holds
    more than a stripe or a chunk. The vocabularies (fixed files of a few MB) are read by the driver and broadcast.
    """
    spark = docs.sparkSession
    definition, model = open(definition_file, encoding="utf-8").read(), open(model_file, "rb").read()
    shape = Tokenizers(definition, model).shape
    stripes = -(-shape[0] // STRIPE_IDS)
    rows = materialise(aligned_documents(docs, definition, model, shape, id_col, text_col, texts), "aligned")
    chunks = rows.filter("whole")
    asked = chunks.agg(F.coalesce(F.sum(F.octet_length("pairs").cast("long")), F.lit(0))).first()[0]
    told = _answers(chunks, _count_stripes(chunks, stripes, shape), stripes, shape, max(1, asked // (stripes * ANSWER_BYTES)))
    kind = rows.schema["id"].dataType.simpleString()

    pair_type = _pair_type(shape)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        keys, counts, best = (np.concatenate([np.frombuffer(x.as_py(), t) for x in right.column(c)] or [np.zeros(0, t)]) for c, t in (("pairs", pair_type), ("counts", np.int64), ("best", bool)))
        order = np.argsort(keys)
        keys, counts, best = keys[order], counts[order], best[order]
        n_best, count_sum = [], []
        for pairs, times in zip(left.column("pairs"), left.column("times"), strict=True):
            at, links = np.searchsorted(keys, np.frombuffer(pairs.as_py(), pair_type)), _ints(times.as_py())
            n_best.append(int(links[best[at]].sum()))
            count_sum.append(int((links * counts[at]).sum()))
        found = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())]
        return pa.table([*left.select(["id", *numbers]).columns, *found, left.column("groups"), left.column("groups_sha256")], names=["id", *numbers, "n_best", "count_sum", "groups", "groups_sha256"])

    schema = f"id {kind}, {', '.join(f'{c} long' for c in numbers)}, n_best long, count_sum long, groups string, groups_sha256 string"
    scored = rows.filter("not whole").groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, schema)
    return scored.withColumnRenamed("id", id_col)
