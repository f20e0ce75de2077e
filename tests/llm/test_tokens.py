import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import bpe, packing, piece_cache, token_files
from strandline.llm.piece_cache import LibraryEncoder
from strandline.llm.queries import WORD_PATTERN

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "B", "the", "'s", "'ll", " ", "  ", "\n", "\n\n", " \n", "\t", "1", "22", "é", "é", "ñ", "!", "?!", "***", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85", "\xa0", "　", "😀", "漢字", "Σ", "ΑΣ", "\0", "İ", "ß", "'S", "²", "ª", "ǅ"]
ODD_ROWS = [(1, ""), (2, None), (None, "null id"), (3, "same"), (3, "same"), (3, "same id, other text"), (4, " x" * 30_000), (5, "a" * 20_000), (6, "\n"), (7, "tail ")]
SCHEMA = "doc_id long, text string, n_tokens int, id string"


def odd(spark, rows=ODD_ROWS):
    return spark.createDataFrame([(a, b, 1, "x") for a, b in rows], SCHEMA)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.text_encoder(open(RANKS, "rb").read(), P.PATTERN)


def ids(raw):
    return np.frombuffer(raw, np.uint16).tolist()


def test_bpe_equals_the_library_on_odd_strings(reference, own):
    random.seed(3)
    for _ in range(5000):
        text = "".join(random.choices(PARTS, k=random.randint(0, 14)))
        assert ids(own(text)) == reference.encode_ordinary(text), repr(text)
    texts = ["".join(random.choices(PARTS, k=random.randint(0, 14))) for _ in range(5000)]
    assert [ids(x) for x in own.encode_all(pa.array(texts))] == [reference.encode_ordinary(x) for x in texts]


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=60))
def test_bpe_equals_the_library_on_any_text(reference, own, text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids(own(text)) == reference.encode_ordinary(text)


def test_bpe_equals_plain_merging():
    ranks = bpe.load_ranks(open(RANKS, "rb").read())
    pairs = bpe.BytePairEncoder(ranks)
    random.seed(5)
    for _ in range(1500):
        raw = bytes(random.choices(b"abcdehilnorstu ,.\xc3\xa9\xa8", k=random.randint(1, 24)))
        plain = [ranks[raw]] if raw in ranks else [ranks[p] for p in bpe.merge_by_rank(raw, ranks, 1 << 30)]
        assert pairs.encode(raw.decode("latin-1")) == plain


def test_long_pretoken_takes_linear_time(own, reference):
    text = "ab" * 4_000 + "ththth" * 4_000
    assert ids(own(text)) == reference.encode_ordinary(text)


def test_bpe_digest(spark, reference):
    rows = sorted(map(repr, bpe.bpe_digest(odd(spark), RANKS, P.PATTERN).collect()))
    expected = []
    for doc_id, text in ODD_ROWS:
        found = reference.encode_ordinary(text or "")
        expected.append(f"Row(doc_id={doc_id}, n_tokens={len(found)}, ids_sha256={hashlib.sha256(','.join(map(str, found)).encode()).hexdigest()!r}, decoded_sha256={hashlib.sha256((text or '').encode()).hexdigest()!r})")
    assert rows == sorted(expected)


def test_bpe_roundtrip_and_empty_table(spark, reference):
    for row in bpe.bpe_roundtrip(odd(spark), RANKS, P.PATTERN).collect():
        assert reference.decode_bytes(row.ids) == bytes(row.decoded)
    assert bpe.bpe_roundtrip(odd(spark, []), RANKS, P.PATTERN).collect() == []


@pytest.mark.parametrize(("name", "pattern", "spaces", "lower"), [("byte_bpe_50k.json", P.PATTERN, True, False), ("word_bpe_49k.json", WORD_PATTERN, False, True)])
def test_pieces_equal_the_library(name, pattern, spaces, lower):
    library = Tokenizer.from_file(P.path(name))
    own = LibraryEncoder(open(P.path(name), encoding="utf-8").read(), pattern, spaces, lower, limit=50)
    random.seed(7)
    for k in range(6000):
        text = "".join(random.choices(PARTS, k=random.randint(0, 14)))
        text = " ".join(text.split()) if k % 3 == 0 else text
        assert ids(own(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("limit", [50, 100_000])
@pytest.mark.parametrize(("name", "pattern", "spaces", "lower"), [("byte_bpe_50k.json", P.PATTERN, True, False), ("word_bpe_49k.json", WORD_PATTERN, False, True)])
def test_batches_equal_the_library(name, pattern, spaces, lower, limit):
    library = Tokenizer.from_file(P.path(name))
    own = LibraryEncoder(open(P.path(name), encoding="utf-8").read(), pattern, spaces, lower, limit=limit)
    rng = random.Random(8)
    letters = ["a", "The", "zß", "É", "İ", "Ħŏ", "ƻ", "ɏ", "×", "÷", "ª", "ɐ", "Σς", "é", ",", ".", "$$$", "-" * 70, "\n", "\t", "1", "'s", "<|", "|>", "<|endoftext|>", "<|ENDOFTEXT|>", " "]
    for size in (0, 1, 7, 300):
        texts = ["".join(rng.choices(letters, k=rng.randint(0, 12))) for _ in range(size)]
        texts += [" ".join("".join(rng.choices(letters, k=3)).split()) for _ in range(size)]
        texts += ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(5 * size)] + [None, ""]
        for column in (pa.array(texts, pa.string()), pa.array(["x", *texts], pa.string())[1:]):
            for text, found in zip(texts, own.encode_all(column), strict=True):
                assert ids(found) == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_token_files_round_trip(spark):
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    written = token_files.write_tokens(odd(spark), path, P.PATTERN, end_id=0, file_bytes=2_000)
    rows = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read_tokens(spark, written).collect())
    expected = {}
    for doc_id, text in ODD_ROWS:
        found = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.setdefault(doc_id, []).append((len(found), zlib.crc32(np.array(found, "<u4").tobytes())))
    at = 0
    for start, doc_id, n, crc in rows:
        assert start == at
        expected[doc_id].remove((n, crc))
        at += n
    assert not any(expected.values())
    assert [r[1] for r in rows] == sorted((x for x, _ in ODD_ROWS), key=lambda x: (x is not None, x))
    some = token_files.read_documents(spark, written, [7]).collect()
    assert [r.ids for r in some] == [[*library.encode("tail ", add_special_tokens=False).ids, 0]]


def test_token_files_of_an_empty_table(spark):
    written = token_files.write_tokens(odd(spark, []), P.path("byte_bpe_50k.json"), P.PATTERN, end_id=0)
    assert token_files.read_tokens(spark, written).collect() == []


def test_damaged_frame_is_found_and_others_are_read():
    documents = [(1, np.arange(500, dtype=np.uint16)), (None, np.zeros(0, np.uint16)), (2, np.arange(9, dtype=np.uint16))]
    content = bytearray(token_files.write_file(documents, 0, 0))
    file = token_files.TokenFile(bytes(content))
    assert file.doc_ids == [1, None, 2] and file.tokens() == 509
    content[file.starts[1] - 3] ^= 0xFF
    damaged = token_files.TokenFile(bytes(content))
    with pytest.raises(Exception, match="damaged|decompress"):
        damaged.document(0)
    assert damaged.document(2).tolist() == list(range(9))
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(token_files.write_file(documents, 0, 0), read_across_frames=True).read()
    assert whole == b"".join(x.tobytes() for _, x in documents)


@pytest.mark.parametrize("shard_tokens", [1 << 20, 5_000])
def test_packing_covers_every_id_once(spark, shard_tokens):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = ODD_ROWS + [(100 + k, " ".join(random.Random(k).choices(["apple", "river", "stone", "cloud", "Über"], k=40 * k + 1))) for k in range(40)]
    out = packing.pack(odd(spark, rows), path, WORD_PATTERN, end_id=2, window=512, shard_tokens=shard_tokens).collect()
    expected = {}
    for doc_id, text in rows:
        expected.setdefault(doc_id, []).append([*library.encode(text or "", add_special_tokens=False).ids, 2])
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for (doc_id, n), pieces in by_doc.items():
        docs = [d for d in expected[doc_id] if len(d) == n]
        assert docs and sum(p.length for p in pieces) == n * len(docs)
        if len(docs) == 1:
            assert all(zlib.crc32(np.array(docs[0][p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32 for p in pieces)
            pieces.sort(key=lambda p: p.start)
            assert [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
    assert sum(r.length for r in out) == sum(len(d) for ds in expected.values() for d in ds)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        total = sum(p.length for p in pieces)
        assert total <= 512 and total & total - 1 == 0
    assert packing.pack(odd(spark, []), path, WORD_PATTERN, end_id=2).collect() == []


def brute_pack(documents, weight, window):
    """Windows filled greedily, with scores summed id by id: (document, start, length, window)."""
    unused, pieces, at, filled = list(range(len(documents))), [], 0, 0
    rest = None
    while unused or rest:
        head, start = rest or (unused.pop(0), 0)
        rest = None
        queue = [(head, start)]
        ranked = sorted(unused, key=lambda d: (-sum(weight(d, t) for t in set(documents[head])), d))
        for d, start in queue:
            n = min(len(documents[d]) - start, window - filled)
            pieces.append((d, start, n, at))
            filled += n
            if filled == window:
                at, filled = at + 1, 0
                rest = (d, start + n) if start + n < len(documents[d]) else None
                break
            if ranked:
                queue.append((ranked.pop(0), 0))
                unused.remove(queue[-1][0])
    return pieces


def test_windows_are_filled_as_by_brute_force():
    rng = np.random.default_rng(3)
    documents = [np.minimum(rng.zipf(1.3, rng.integers(1, 40)), 60).astype(np.uint16) for _ in range(80)]
    documents += [documents[4], np.full(100, 7, np.uint16), np.array([61], np.uint16)]
    n, mean = len(documents), float(np.mean([len(d) for d in documents]))
    df = np.bincount(np.concatenate([np.unique(d) for d in documents]), minlength=64)
    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    index = packing.Bm25Index(documents, idf, mean)

    def weight(d, t):
        tf = int((documents[d] == t).sum())
        return idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(documents[d]) / mean))

    for head in (0, 4, 81, 82):
        assert np.allclose(index.scores(np.unique(documents[head])), [sum(weight(d, t) for t in set(documents[head].tolist())) for d in range(n)], rtol=1e-4)
    for x in (index.weight, index.dense):
        x[:] = np.round(x * 2**8) / 2**8  # so that sums are exact in any order
    exact = lambda d, t: round(weight(d, t) * 2**8) / 2**8
    pieces = packing.pack_shard(documents, index, 32)
    full = [p[:4] for p in pieces]
    expected = brute_pack([d.tolist() for d in documents], exact, 32)
    last = expected[-1][3]
    assert [p for p in full if p[3] < last] == [p for p in expected if p[3] < last]


def test_ties_go_by_content(spark):
    rows = [(5, "alpha river stone"), (5, "gamma cloud apple"), (5, "delta stone apple"), (None, "alpha river stone"), (6, None), (6, "")] * 2
    shown = []
    for order in (rows, rows[::-1]):
        out = packing.pack(odd(spark, order), P.path("word_bpe_49k.json"), WORD_PATTERN, end_id=2, window=8).collect()
        shown.append(sorted((tuple(-1 if x is None else x for x in r)) for r in out))
    assert shown[0] == shown[1]


def test_like_documents_share_shards(spark):
    words = [f"{a}{b}" for a in ("red", "old", "big", "sea", "sun", "ice", "oak", "fog") for b in ("ship", "bird", "farm", "hill")]
    rows = []
    for topic in range(8):  # 40 documents of each topic, dealt over the table
        rows += [(8 * k + topic, " ".join(random.Random(100 * topic + k).choices(words[4 * topic : 4 * topic + 4], k=12))) for k in range(40)]
    out = packing.pack(odd(spark, sorted(rows)), P.path("word_bpe_49k.json"), WORD_PATTERN, end_id=2, window=64, shard_tokens=600).collect()
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append(r)
    full = [s for s in sequences.values() if sum(p.length for p in s) == 64]
    pure = sum(max(np.bincount([p.doc_id % 8 for p in s], [p.length for p in s])) for s in full)
    assert pure > 0.75 * 64 * len(full)


def test_a_row_repeated_very_often_is_dealt_to_many_tasks(spark):
    rows = [(1, "alpha river stone cloud apple")] * 4000
    out = packing.pack(odd(spark, rows), P.path("word_bpe_49k.json"), WORD_PATTERN, end_id=2, window=64, shard_tokens=500).collect()
    tasks = {}
    for r in out:
        tasks[r.sequence_id >> 32] = tasks.get(r.sequence_id >> 32, 0) + r.length
    assert len(tasks) == 4 and max(tasks.values()) < 0.5 * sum(tasks.values())


def test_most_near_copies_meet_in_a_shard():
    """Share of documents whose best neighbour of the whole corpus, by brute force, is dealt to the same shard."""
    rng = np.random.default_rng(8)
    documents = [np.minimum(rng.zipf(1.2, rng.integers(30, 400)), 3000).astype(np.uint16) for _ in range(600)]
    for k in range(200):  # copies with a tenth of the ids changed
        copy = documents[k].copy()
        copy[rng.random(len(copy)) < 0.1] = 2999
        documents.append(copy)
    n, mean = len(documents), float(np.mean([len(d) for d in documents]))
    df = np.bincount(np.concatenate([np.unique(d) for d in documents]), minlength=packing.VOCABULARY)
    order = np.argsort(packing.Dealer(df, n, mean)(documents), kind="stable")
    held = np.cumsum([len(documents[d]) for d in order])
    shard = np.empty(n, int)
    shard[order] = held // (held[-1] // 20)
    index = packing.Bm25Index(documents, packing.idf_of(df, n), mean)
    same = 0
    for k in range(200):
        scores = index.scores(np.unique(documents[k]))
        scores[k] = -1
        same += shard[scores.argmax()] == shard[k]
    assert same > 0.6 * 200  # one in twenty by chance


def test_text_without_white_space_leaves_tables_bounded(monkeypatch):
    monkeypatch.setattr(piece_cache, "TABLE_BYTES", 1 << 16)
    rng = random.Random(8)
    encoder = piece_cache.LibraryEncoder(open(P.path("byte_bpe_50k.json")).read(), P.PATTERN, True, False)
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for k in range(60):
        texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(2000)) + str(k), "x" * 5000 + f" {k} y{rng.random()} " + "z" * 900] + [f"w{rng.random()}" for _ in range(40)]
        found = encoder.encode_all(pa.array(texts))
        if k % 10 == 0:
            assert [np.frombuffer(x, np.uint16).tolist() for x in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert encoder.table.nbytes + encoder.table_ids.nbytes <= 2 << 16
        assert max(map(len, [*encoder.bare, *encoder.spaced, ""])) <= piece_cache.LONG_PIECE
