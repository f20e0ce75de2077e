"""Tokenise each white-space delimited piece once: texts repeat their words, so most pieces are found in a table.

Batches of texts are cut, compared with the table and put together by Arrow; only pieces new to it are handled one by one."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

_WHITE = r"\s\x1c-\x1f\x85"
#: A space next to other white space, or at either end of the text, is no place to cut for a vocabulary that keeps spaces.
_UNSAFE = re.compile(rf" [{_WHITE}]|[{_WHITE}] |^ | $")
#: Below U+0250 and without control characters Python's and Rust's classes and lower case agree (U+0130 becomes two characters).
_ODD = re.compile(r"[^\n\x20-\x7e\xa1-\xac\xae-ɏ]")
_SYMBOLS = "!#$%&()*+,-./:;=?@[]^_{}~|"
#: Bytes of text that are encoded together; of the longest string that is kept; and of the table of pieces and their ids.
SLICE, LONG_PIECE, TABLE_BYTES = 1 << 22, 64, 1 << 26
_PLAIN = re.compile(r"[\n\x20-\x7e\xa1-\xac\xae-įı-ɏ]*\Z")


class PieceEncoder:
    """Encodes texts piece by piece to little-endian 16-bit ids, with the results of pieces kept in a table.

    token: ids of one match of `pattern` in the folded string. whole: ids of any string, by the library; it takes strings with special tokens or
    rare characters, and with keeps_spaces texts with runs of white space. keeps_spaces: a match may start with one space,
    so a piece carries the space before it; else white space only separates.
    Longer strings than LONG_PIECE bytes (text without white space is one piece) are encoded each time. A table of more than
    `limit` entries or TABLE_BYTES keeps those found again since it was last full. This bounds memory in bytes and changes
    no result.
    """

    def __init__(self, token: Callable[[str], bytes], whole: Callable[[str], bytes], pattern: str, keeps_spaces: bool, fold: Callable[[str], str] = str, limit: int = 450_000):
        self.token, self.whole, self.limit, self.keeps_spaces = token, whole, limit, keeps_spaces
        self.fold = fold
        self.fold_all = pc.ascii_lower if fold is str.lower else lambda x: x  # what else there is to fold is folded piece by piece
        self.find = regex.compile(pattern).findall
        self.bare: dict[str, bytes] = {}  # the ids of strings without a space before them
        self.spaced: dict[str, bytes] = {}  # and of matches with one
        self.table, self.table_ids = pa.array([], pa.string()), pa.array([], pa.large_binary())  # pieces and their ids
        self.used = np.zeros(0, bool)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a string array; null counts as empty."""
        texts = texts.fill_null("").cast(pa.string())
        if not self.keeps_spaces:
            special = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
            rest = iter(self._cut(pc.replace_substring(self.fold_all(texts.filter(pa.array(~special))), "\n", " ")))
            return [self._new(text.as_py()) if odd else b"".join(next(rest)) for text, odd in zip(texts, special.tolist(), strict=True)]
        strings = texts.to_pylist()
        whole = np.array([self._spaces_matter(x) for x in strings], bool)
        rest = iter(self._cut(texts.filter(pa.array(~whole))))
        out = []
        for text, odd in zip(strings, whole.tolist(), strict=True):
            out.append(self._new(text) if odd else self._bare(text.partition(" ")[0]) + next(rest)[1])
        return out

    def _cut(self, texts: pa.Array) -> list[tuple[bytes, bytes]]:
        """The ids of each text's first piece and of its others."""
        if not len(texts):
            return []
        split = pc.split_pattern(texts, " ")
        coded = split.values.dictionary_encode()
        data = self._pieces(coded.dictionary).take(coded.indices)
        bounds = np.frombuffer(data.buffers()[1], np.int64)[: len(data) + 1]
        first = np.frombuffer(split.buffers()[1], np.int32)[: len(texts) + 1]
        ends, heads = bounds[first].tolist(), bounds[first[:-1] + 1].tolist()
        raw = memoryview(data.buffers()[2] or b"")
        return [(bytes(raw[x:y]), bytes(raw[y:z])) for x, y, z in zip(ends[:-1], heads, ends[1:], strict=True)]

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """The ids of distinct pieces. Letters before symbols are a match of their own, so the table holds words without
        the symbols behind them."""
        stems, tails, simple = _stems_and_tails(pieces)
        coded = stems.dictionary_encode()
        words = coded.dictionary
        plain = np.zeros(len(words), bool)
        plain[coded.indices.to_numpy()] = simple
        known = pc.index_in(words, value_set=self.table)
        fresh = known.is_null().to_numpy(zero_copy_only=False)
        place = known.fill_null(0).to_numpy().astype(np.int64)
        self.used[place[~fresh]] = True
        new = words.filter(pa.array(fresh))
        space = " " if self.keeps_spaces else ""
        ids = [(self.token(space + self.fold(x)) if one else self._new(space + x)) if x else b"" for x, one in zip(_strings(new), plain[fresh].tolist(), strict=True)]
        place[fresh] = len(self.table) + np.arange(len(new))
        self.table, self.table_ids = pa.concat_arrays([self.table, new]), pa.concat_arrays([self.table_ids, pa.array(ids, pa.large_binary())])
        self.used = np.concatenate([self.used, np.zeros(len(new), bool)])
        ends = tails.dictionary_encode()
        symbols = pa.array([self._bare(x) if x else b"" for x in _strings(ends.dictionary)], pa.large_binary())
        out = pc.binary_join_element_wise(self.table_ids.take(pa.array(place[coded.indices.to_numpy()])), symbols.take(ends.indices), pa.scalar(b"", pa.large_binary()))
        sizes = pc.binary_length(self.table).to_numpy(zero_copy_only=False)
        if len(new) and sizes[len(sizes) - len(new) :].max() > LONG_PIECE:
            self._keep(sizes <= LONG_PIECE)
        if len(self.table) > self.limit or self.table.nbytes + self.table_ids.nbytes > TABLE_BYTES:
            few = 2 * self.used.sum() <= len(self.used)
            self._keep(self.used if few else np.zeros(len(self.used), bool))
            self.used = np.zeros(len(self.table), bool)
        return out

    def _keep(self, kept: np.ndarray) -> None:
        """Only these entries of the table."""
        self.table, self.table_ids, self.used = self.table.filter(pa.array(kept)), self.table_ids.filter(pa.array(kept)), self.used[kept]

    def _spaces_matter(self, text: str) -> bool:
        """Whether a text has white space that can't be told by cutting it at single spaces."""
        return bool(text) and ("  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " " or _ODD.search(text) is not None and _UNSAFE.search(text) is not None)

    def __call__(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]

    def _bare(self, string: str) -> bytes:
        return self._kept(self.bare, string, self._new)

    def _kept(self, table: dict[str, bytes], string: str, make: Callable[[str], bytes]) -> bytes:
        ids = table.get(string)
        if ids is None:
            ids = make(string)
            if len(string) > LONG_PIECE:
                return ids
            if len(table) >= self.limit // 2:
                table.clear()
            table[string] = ids
        return ids

    def _new(self, string: str) -> bytes:
        """Ids of a string that is in no table, by its matches."""
        if "<|" in string or not _PLAIN.match(string):
            return self.whole(string)
        found = self.find(self.fold(string))
        if len(found) == 1:
            return self.token(found[0])
        out = []
        for x in found:
            if self.keeps_spaces and len(x) > 1 and x[0] == " ":
                out.append(self._kept(self.spaced, x, self.token))
            else:
                out.append(self._kept(self.bare, x, self.token))
        return b"".join(out)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


#: Bytes of ASCII letters, and those that open a letter of U+00C0 to U+024F.
_LETTER, _LEAD, _SYMBOL = (np.zeros(256, bool) for _ in range(3))
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LEAD[0xC3:0xCA] = True
_SYMBOL[[ord(c) for c in _SYMBOLS]] = True
#: Longest run of symbols that is cut off; a piece with a longer one is handled as a whole.
_TAIL = 64


def _stems_and_tails(pieces: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Each piece cut before the symbols at its end if letters of _PLAIN are all that stands before them; else it is a stem
    as it is. The last array says which were letters."""
    n = len(pieces)
    offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + n + 1].astype(np.int64)
    data = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    start, end = offsets[:-1], offsets[1:].copy()
    at = np.flatnonzero(end > start)
    for _ in range(_TAIL):
        at = at[_SYMBOL[data[end[at] - 1]]]
        if not len(at):
            break
        end[at] -= 1
        at = at[end[at] > start[at]]
    following = np.append(data[1:], 0).astype(np.uint8)
    lead = _LEAD[data] & ~((data == 0xC3) & ((following == 0x97) | (following == 0xB7)) | (data == 0xC4) & (following == 0xB0) | (data == 0xC9) & (following > 0x8F))
    bad = np.concatenate([[0], np.cumsum(~(_LETTER[data] | lead | (data & 0xC0 == 0x80)))])
    simple = (end > start) & (bad[end] == bad[start])
    end = np.where(simple, end, offsets[1:])
    kept = np.arange(len(data)) < np.repeat(end, np.diff(offsets))

    def strings(flags: np.ndarray, lengths: np.ndarray) -> pa.Array:
        bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.StringArray.from_buffers(n, pa.py_buffer(bounds.tobytes()), pa.py_buffer(data[flags].tobytes()))

    return strings(kept, end - start), strings(~kept, offsets[1:] - end), simple


def byte_letters() -> dict[int, str]:
    """The printable characters by which byte-level vocabularies write the 256 bytes: those that print stand for themselves,
    the others follow from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in shown)
    return {b: chr(b) for b in shown} | {b: chr(0x100 + k) for k, b in enumerate(others)}


class LibraryEncoder(PieceEncoder):
    """A PieceEncoder for a byte-level vocabulary file of the tokenizers library, given as its JSON text."""

    def __init__(self, definition: str, pattern: str, keeps_spaces: bool, lower: bool, limit: int = 450_000):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(definition)
        letters = byte_letters()
        to_letters = "".join(letters[b] for b in range(256))
        tokenize = library.model.tokenize

        def token(string: str) -> bytes:
            found = tokenize(string if string.isalpha() and string.isascii() else string.encode().decode("latin-1").translate(to_letters))
            return array("H", [x.id for x in found]).tobytes()

        def whole(string: str) -> bytes:
            return array("H", library.encode(string, add_special_tokens=False).ids).tobytes()

        super().__init__(token, whole, pattern, keeps_spaces, str.lower if lower else str, limit)
