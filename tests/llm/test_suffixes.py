import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from strandline.llm import suffixes


def brute(rows, window):
    """Every window of every text, counted as it is."""
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(t[k : k + window] for t in texts for k in range(len(t) - window + 1))
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for k in range(len(t) - window + 1):
            if counts[t[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(map(repr, out))


def corpus(seed=3):
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(["river", "stone", "Über", "of", "naïve", "日本"]) + str(rng.randint(0, 999)) for _ in range(n))

    rows = [(k, words(rng.randint(0, 150))) for k in range(40)]
    passage = words(90)
    rows += [(100 + k, words(rng.randint(0, 40)) + passage[rng.randint(0, 30) : len(passage) - rng.randint(0, 60)] + words(rng.randint(0, 40))) for k in range(60)]
    base = words(300)
    for k in range(40):
        text = list(base)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(len(text))] = rng.choice("xyzé")
        rows.append((200 + k, "".join(text)))
    rows += [(300, base), (301, base), (301, base), (None, base), (302, None), (303, ""), (304, "a" * 3000), (305, "ab" * 900 + "c"), (306, base * 3), (307, passage[:399]), (308, "\0" * 900), (309, words(20) + "\0" * 500 + words(20))]
    rows += [(310, words(80)[:-1] + c) for c in "ab"] + [(None, words(100))]
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, row int, home int, doc int, h1 int, h2 int, n_bytes int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6) for r in rows], SCHEMA).repartition(5)


def found(spark, rows, window):
    out = suffixes.byte_rows(frame(spark, rows), window=window, texts=True)
    return sorted(repr((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept))) for r in out.collect())


@pytest.mark.parametrize(("window", "small"), [(400, False), (400, True), (64, True), (9, True)])
def test_bytes_equal_brute_force(spark, monkeypatch, window, small):
    if small:
        for name, value in (("SEGMENT", 1000), ("HELD", 300), ("SAMPLE_BYTES", 1 << 30), ("SAMPLE_STEP", 1), ("BUCKETS", 40)):
            monkeypatch.setattr(suffixes, name, value)
        monkeypatch.setattr(suffixes, "BROADCAST_GROUPS", 0)
    rows = corpus(window)
    assert found(spark, rows, window) == brute(rows, window)


def test_empty_tables_and_repeated_rows(spark):
    assert suffixes.dedup_bytes(frame(spark, [])).collect() == []
    text = "".join(chr(97 + k * 7 % 26) + str(k) for k in range(200))
    rows = suffixes.dedup_bytes(frame(spark, [(1, text), (1, text), (2, None), (None, text[:399])])).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans) for r in rows) == [(0, 399, 0, 0), (1, len(text), len(text), 1), (1, len(text), len(text), 1), (2, 0, 0, 0)]


def test_multikey_order_equals_sorting():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (300, 21)).astype(np.uint8)
    rows[100:200, :17] = rows[0, :17]
    rows[250:] = rows[5]
    order, common = suffixes.multikey_order(rows)
    found = [rows[k].tobytes() for k in order]
    assert found == sorted(r.tobytes() for r in rows)
    for k in range(1, 300):
        a, b = found[k - 1], found[k]
        assert common[k] == next((j for j in range(21) if a[j] != b[j]), 21)


@pytest.mark.parametrize("n_bounds", [0, 1, 12, 60])
def test_buckets_and_what_goes_over_their_bounds_give_all_windows(n_bounds):
    """Hot suffixes, dealt by separators as long as they need to be."""
    rng = random.Random(n_bounds)
    window, gram = 40, 8
    hot = "".join(rng.choice("abcdef") for _ in range(60))
    texts = ["".join(rng.choice("abcdef") for _ in range(rng.randint(0, 40))) + hot[rng.randint(0, 8) : 60 - rng.randint(0, 8)] + "".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    import pyarrow as pa

    found = list(suffixes.stretches(pa.array(texts), window, gram))
    assert len(found) == 1
    s = found[0]
    whole = suffixes.Bucket(s.bytes(), s.high, s.length, np.zeros(len(s.at), bool))
    keys = sorted({k.tobytes() for k in np.hstack([whole.suffixes(window), whole.prefixes(window - gram)])})
    cuts = sorted(rng.sample(range(1, len(keys)), n_bounds))
    bounds = [keys[c][: next(j for j in range(len(keys[c])) if keys[c][j] != keys[c - 1][j]) + 1] for c in cuts]
    at = suffixes._dealt(whole.suffixes(window), whole.prefixes(window - gram), bounds)
    assert len(set(at.tolist())) == n_bounds + 1
    repeated, beyond = set(), []
    for b in range(n_bounds + 1):
        mine = s.take(np.flatnonzero(at == b))
        bucket = suffixes.Bucket(mine.bytes(), mine.high, mine.length, np.zeros(len(mine.at), bool))
        around = (bounds[b - 1] if b else None, bounds[b] if b < n_bounds else None)
        stretch, low, high, out = suffixes.repeated_windows(bucket, window, gram, around)
        repeated |= {(mine.text[k], mine.start[k] + mine.high[k] - o) for k, lo, hi in zip(stretch.tolist(), low.tolist(), high.tolist(), strict=True) for o in range(lo, hi + 1)}
        beyond += [(mine.text[k], mine.start[k] + mine.high[k] - o) for k, o, _ in out.tolist()]
    strings = Counter(texts[t][i : i + window] for t, i in beyond)
    local = {texts[t][i : i + window] for t, i in repeated}
    repeated |= {(t, i) for t, i in beyond if strings[texts[t][i : i + window]] > 1 or texts[t][i : i + window] in local}
    counts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    assert repeated == {(k, i) for k, t in enumerate(texts) for i in range(len(t) - window + 1) if counts[t[i : i + window]] > 1}
    assert n_bounds < 12 or beyond
