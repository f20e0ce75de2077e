from collections import Counter
from fractions import Fraction
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import alignment, double_double, whitening

# ---- whitening


def exact_covariance(vectors):
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(c) for c in zip(*x, strict=True)]
    centred = [[Fraction(n * a - s, n) for a, s in zip(row, sums, strict=True)] for row in x]
    cov = [[sum(r[i] * r[j] for r in centred) / n for j in range(len(sums))] for i in range(len(sums))]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return n, np.array([[float(c) for c in r] for r in centred]), cov, deviations


def test_products_of_pairs_are_exact_to_a_hundred_bits():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(7, 300)) * 10.0 ** rng.integers(-6, 7, (7, 1)), rng.normal(size=(7, 300)) * 1e-20
    b = rng.normal(size=(300, 5)), rng.normal(size=(300, 5)) * 1e-18
    a, b = double_double.two_sum(*a), double_double.two_sum(*b)
    high, low = double_double.product(a, b)
    for i in range(7):
        for j in range(5):
            true = sum((Fraction(a[0][i, k]) + Fraction(a[1][i, k])) * (Fraction(b[0][k, j]) + Fraction(b[1][k, j])) for k in range(300))
            error = abs(Fraction(high[i, j]) + Fraction(low[i, j]) - true)
            assert error < Fraction(2) ** -90 * Fraction(np.abs(a[0][i]).max() * np.abs(b[0][:, j]).max())


def test_whitening_equals_exact_arithmetic(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(90, 6)) @ np.diag([3, 1, 0.5, 0.5, 0.01, 2]) + 40
    rows = [(k, v.tolist(), 7, "x") for k, v in enumerate(base)]
    bad = [(900, None, 1, "x"), (901, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, "x"), (902, [float("nan")] * 6, 1, "x"), (903, [float("inf")] * 6, 1, "x"), (904, [], 1, "x"), (905, [1e300] * 6, 1, "x")]
    repeated = [(None, base[0].tolist(), 1, "x"), (0, base[0].tolist(), 1, "x")]
    docs = spark.createDataFrame(rows + bad + repeated, "vec_id long, embedding array<double>, n int, whitened string").repartition(5)
    found = whitening.whiten(docs).collect()
    n, centred, cov, deviations = exact_covariance([r[1] for r in rows + repeated])
    values, vectors = np.linalg.eigh(np.array(cov, float))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(found) == 92 * 6 and {r.n for r in found} == {n} and Counter(r.vec_id for r in found)[0] == 12
    whitened = centred @ vectors / np.sqrt(values)
    trace = sum(cov[i][i] for i in range(6))
    signs = {}
    for r in found:
        k = 0 if r.vec_id is None else r.vec_id
        true = whitened[k, r.component - 1]
        if abs(true) > 0.1:
            signs.setdefault(r.component, np.sign(true * r.whitened))
        assert r.deviation == deviations[k]
        assert r.explained == pytest.approx(float(Fraction(float(values[r.component - 1])) / trace), rel=1e-10)
        assert r.identity_error < 1e-12
    for r in found:
        assert r.whitened * signs[r.component] == pytest.approx(whitened[0 if r.vec_id is None else r.vec_id, r.component - 1], abs=1e-9)


def test_eigenvectors_of_close_values_are_refined():
    rng = np.random.default_rng(5)
    basis, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    values = np.array([1 + 1e-9 * k for k in range(6)] + [2, 3, 3 + 1e-10, 1e-6, 1e-7, 9])
    scaled = double_double.product((basis * values, np.zeros((12, 12))), (basis.T.copy(), np.zeros((12, 12))))
    found, vectors = whitening.eigen((scaled[0] + scaled[0].T) / 2, (scaled[1] + scaled[1].T) / 2)
    assert np.allclose(found, np.sort(values)[::-1], rtol=1e-13, atol=1e-15)
    assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-14


def test_whitening_of_few_vectors_lengths_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(whitening, "HELD", 1)
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0]), (4, [6.0]), (5, [1.0, 2.0, 3.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {(r.vec_id, r.component): r for r in whitening.whiten(docs).collect()}
    assert sorted(found) == [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (4, 1), (5, 1), (5, 2), (5, 3)]
    assert found[1, 1].whitened is None and found[1, 1].explained is None and found[1, 1].n == 2 and found[1, 1].deviation == 0
    assert abs(found[3, 1].whitened) == pytest.approx(1) and found[3, 1].explained == 1 and found[3, 1].deviation == 64 * 64
    empty = whitening.whiten(docs.filter("vec_id > 9"))
    assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_a_long_are_null():
    space = whitening.Space(3, [3 * 10**15, 3])
    x = np.array([[10**15, 1], [3 * 10**15, 1], [-(10**15), 1]])
    assert space.deviations(x) == [0, None, None]
    assert whitening.Space(3, [3, 6]).deviations(np.array([[0, 1], [1, 2], [2, 3]])) == [18, 0, 18]


# ---- alignment of tokenizers


PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1]), alignment.Tokenizers(open(PATHS[0]).read(), open(PATHS[1], "rb").read())


def brute_alignment(rows, sides):
    """From the whole texts: groups as text, and the links as pairs of ids, one for each pair of tokens."""
    first, second, tables = sides
    out = []
    for doc_id, text in rows:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(tables.first_bytes[x] for x in a) != raw or b"".join(tables.second_bytes[x] for x in b) != raw:
            out.append((doc_id, [], [], [], Counter()))
            continue
        ends_a = np.cumsum([len(tables.first_bytes[x]) for x in a]).tolist()
        ends_b = np.cumsum([len(tables.second_bytes[x]) for x in b]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        found = [([x for x, e in zip(a, ends_a, strict=True) if lo < e <= hi], [x for x, e in zip(b, ends_b, strict=True) if lo < e <= hi]) for lo, hi in zip([0, *cuts], cuts, strict=False)]
        out.append((doc_id, a, b, found, Counter((x, y) for p, q in found for x in p for y in q)))
    counts = Counter(pair for *_, links in out for pair in links)
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    rows = []
    for doc_id, a, b, found, links in out:
        name = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in found)
        n_best = sum(t for pair, t in links.items() if counts[pair] == best[pair[0]])
        rows.append((doc_id, len(a), len(b), len(found), sum(links.values()), n_best, sum(t * counts[pair] for pair, t in links.items()), hashlib.sha256(name.encode()).hexdigest() if name else ""))
    return rows


ODD = ["", None, " ", "  two  spaces ", "tab\tand\nline \n end", "a▁b", "<s> x </s> <|endoftext|> <unk>", "\x00\x1c \x1d x\x85y 　z", "日本語のテキスト、漢字。", "naïve café — “quoted” … ﬁ ½ é", "🙂👍🏽 flags 🇩🇪", "x" * 3000, " " * 700 + "end", "1234567890 3.14 don't we'll", "word " * 900, "  " + "é" * 500]


def test_alignment_equals_brute_force(spark, sides, monkeypatch):
    rng = random.Random(4)
    letters = "ab é\n\t  the.,'s0189日-ß "
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100 + k, "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))) for k in range(150)]
    rows += [(300 + k, f"the {rng.choice(['river', 'Stone', 'überall'])} of {rng.randint(0, 99)} tokens, and more") for k in range(60)]
    rows += [(None, "null id"), (5, "again"), (5, "again")]
    docs = spark.createDataFrame([(*r, 1, b"", b"", "g") for r in rows], "doc_id long, text string, chunk int, pairs binary, best binary, groups string").repartition(3)
    found = alignment.align_tokenizers(docs, *PATHS)
    expected = sorted(map(repr, brute_alignment(rows, sides)))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    kept = found.select(*columns, "groups").collect()
    assert sorted(repr(tuple(r)[:-1]) for r in kept) == expected
    assert all(r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in kept)
    for name, value in (("LEARNED", 7), ("LARGE_GROUP", 5), ("SLICE", 300), ("CHUNK_BYTES", 500), ("HELD", 50), ("ANSWER_BYTES", 1), ("STRIPE_IDS", 7)):
        monkeypatch.setattr(alignment, name, value)
    again = alignment.align_tokenizers(docs, *PATHS, texts=False)
    assert sorted(repr(tuple(r)) for r in again.select(*columns).collect()) == expected and again.filter("groups is not null").isEmpty()
    assert alignment.align_tokenizers(docs.limit(0), *PATHS).collect() == []


def test_alignment_table_is_bounded_in_bytes(sides, monkeypatch):
    monkeypatch.setattr(alignment, "TABLE_BYTES", 20_000)
    own = alignment.Aligner(sides[2])
    whole = alignment.Aligner(sides[2])
    for k in range(40):
        texts = [f"word{k * 100 + j} and {'x' * 300}{k} {chr(0x4E00 + k) * 200}" for j in range(20)]
        a, b = own.align(texts), whole.align(texts)
        assert [x[:2] for x in a] == [x[:2] for x in b] and all((x[2] == y[2]).all() and (x[3] == y[3]).all() for x, y in zip(a, b, strict=True))
        assert all(len(p) <= alignment.LONG_PIECE for p in own.index) and own.held <= 20_000 and len(own.keys) == own.first[-1]


def test_pieces_found_again_are_not_encoded_again(sides, monkeypatch):
    monkeypatch.setattr(alignment, "TABLE_BYTES", 100_000)
    own, often = alignment.Aligner(sides[2]), [f"often{j}" for j in range(50)]
    learned, learn = Counter(), own._learn
    monkeypatch.setattr(own, "_learn", lambda pieces, plain: (learned.update(pieces), learn(pieces, plain))[1])
    for k in range(20):  # the table is full again and again
        own.align([" ".join([*often, *[f"once{k}x{j}" for j in range(100)]])])
        assert own.held <= 100_000 and len(own.index) == len(own.names) == len(own.counts) == len(own.used) == len(own.first) - 1
    assert set(learned.values()) == {1} and len(learned) == 2050


def test_pieces_that_are_one_string_are_encoded_as_each_alone(sides, monkeypatch):
    first, _, tables = sides
    pieces = [f"{a}{k}{b}" for k in range(30) for a in ("the", "Été", "'s", "<|endoftext|>", "日本", "(", "🙂") for b in ("", ",", "a  b\n c", "’s")]
    monkeypatch.setattr(alignment, "JOINED", 16)
    ids, n = tables.encode_joined(pieces)
    alone = [first.encode(" " + x, add_special_tokens=False).ids for x in pieces]
    assert n.tolist() == list(map(len, alone)) and ids.tolist() == [x for y in alone for x in y]


def test_a_stripe_counts_as_a_dictionary():
    rng = np.random.default_rng(2)
    shape, stripes = (50, 30), 7
    total = Counter()
    found = [alignment.Stripe(stripes, shape) for _ in range(stripes)]
    for _ in range(20):
        keys, counts = alignment.summed(rng.integers(0, 1500, 60), np.ones(60, np.int64))
        for s, at in alignment._by_stripe(keys, stripes, shape[1]):
            found[s].add(keys[at], counts[at])
        total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    for s, stripe in enumerate(found):
        stripe.settle()
        keys, counts = stripe.entries(s)
        assert {k: total[k] for k in keys.tolist()} == dict(zip(keys.tolist(), counts.tolist(), strict=True)) and all(k // 30 % stripes == s for k in keys.tolist())
        _, best = stripe.scores(keys)
        assert best.tolist() == [total[k] == max(total[j] for j in total if j // 30 == k // 30) for k in keys.tolist()]
