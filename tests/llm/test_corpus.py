import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandline.llm import components, html_text, jaccard, licenses, quality, substring, vectors, warc

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words int, row string, doc string, node string"
EXTRA = (1, "x", "y", "z")


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def sentence(rng, n):
    return " ".join(rng.choice(["river", "stone", "the", "of", "cloud", "apple", "Über", "naïve", "a", "to"]) + str(rng.randint(0, 40)) for _ in range(n))


def corpus():
    rng = random.Random(11)
    rows = [(k, sentence(rng, rng.randint(1, 120))) for k in range(60)]
    passage = sentence(rng, 45)
    for k in range(60, 80):
        rows.append((k, f"{sentence(rng, 10)}\n{passage}\t{sentence(rng, rng.randint(0, 30))}"))
    base = sentence(rng, 200).split()
    for k in range(80, 110):
        words = list(base)
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(200)] = f"edit{rng.random()}"
        rows.append((k, " ".join(words)))
    rows += [(k, "short copy") for k in range(110, 116)] + [(k, sentence(random.Random(5), 60)) for k in range(116, 130)]
    rows += [(200, ""), (201, None), (202, " \n\t"), (None, sentence(random.Random(5), 60)), (None, None), (203, "tick " * 3000), (204, "x" * 50_000), (205, " ".join(base[:30] * 3))]
    rng.shuffle(rows)
    return rows


# ---- WARC


def pages():
    long = "<p>" + "same payload " * 20
    return [(5, "http://a/5", long), (2, "http://a/2", long), (9, None, long), (None, "http://a/n", long), (3, "http://a/ \n3", "tiny"), (4, "u", "tiny"), (6, "u", None), (7, "u", ""), (8, "u", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n" * 3000), (2, "again", long)]


def page_frame(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, digest string")


def test_warc_round_trip(spark):
    path = warc.write_warc(page_frame(spark, pages()), file_bytes=300)
    records = warc.read_warc(spark, path)
    assert records.filter("gap is not null").count() == 0
    rows = sorted(map(repr, warc.page_records(records).collect()))
    expected = []
    for page_id, _, html in pages():
        raw = (html or "").encode()
        to = 2 if len(raw) >= 100 and "same" in (html or "") and page_id != 2 else None
        expected.append(f"Row(page_id={page_id}, payload_bytes={len(raw)}, payload_digest={hashlib.sha256(raw).hexdigest()!r}, record_type={'revisit' if to else 'response'!r}, refers_to={to})")
    assert rows == sorted(expected)
    uris = {r.record_id: r.target_uri for r in records.collect()}
    assert uris["urn:strandline:page:3"] == "http://a/%20%0A3" and uris["urn:strandline:page:9"] is None
    assert warc.read_warc(spark, warc.write_warc(page_frame(spark, []))).collect() == []


def record(k, payload):
    return warc.record_bytes(k, f"http://h/{k}", payload, hashlib.sha256(payload).hexdigest(), len(payload))


def gz(data):
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


@pytest.mark.parametrize("pack", [gz, bytes])
def test_salvage_recovers_all_but_the_damaged_record(pack):
    parts = [pack(record(k, random.Random(k).randbytes(400))) for k in range(8)]
    whole = b"".join(parts)
    assert [f.reason for f in warc.salvage(whole)] == [None] * 8
    bounds = np.cumsum([0, *map(len, parts)])
    for at in range(0, len(whole), 37):
        damaged = bytearray(whole)
        damaged[at] ^= 0x5A
        hit = int(np.searchsorted(bounds, at, side="right")) - 1
        found = list(warc.salvage(bytes(damaged)))
        good = {f.headers["warc-record-id"] for f in found if not f.reason}
        lost = {f"<urn:strandline:page:{k}>" for k in range(8)} - good
        assert lost <= {f"<urn:strandline:page:{hit}>"} or len(good) >= 7
        covered = sorted((f.start, f.end) for f in found)
        if lost:  # gaps and records tile the file
            assert covered[0][0] == 0 and covered[-1][1] == len(whole)
            assert all(a[1] == b[0] for a, b in zip(covered, covered[1:], strict=False))


def test_salvage_of_cut_and_foreign_bytes():
    parts = [gz(record(k, b"x" * 300)) for k in range(3)]
    found = list(warc.salvage(parts[0] + b"garbage\x1f\x8b\x08junk" + parts[1] + parts[2][:-20]))
    assert [(f.reason is None) for f in found] == [True, False, True, False]
    assert found[1].start == len(parts[0]) and found[1].end == len(parts[0]) + 14
    assert list(warc.salvage(b"")) == []
    assert [f.reason is None for f in warc.salvage(b"no archive")] == [False]


def test_salvage_inside_members():
    plain = [record(k, random.Random(k).randbytes(400)) for k in range(4)]
    ids = lambda found: [f.headers["warc-record-id"][-2] for f in found if not f.reason]
    damaged = bytearray(b"".join(plain))
    damaged[len(plain[0]) + len(plain[1]) - 50] ^= 0x5A
    found = list(warc.salvage(gz(bytes(damaged)) + gz(record(7, b"x"))))
    assert ids(found) == ["0", "2", "3", "7"] and [f.reason for f in found if f.reason] == [f"payload digest differs (bytes {len(plain[0])} to {len(plain[0] + plain[1])} of the member)"]
    whole = gz(b"".join(plain))
    assert ids(warc.salvage(whole[:-200])) == ["0", "1", "2"]
    crc = bytearray(whole)
    crc[-6] ^= 1
    found = list(warc.salvage(bytes(crc) + gz(record(7, b"x"))))
    assert ids(found) == ["0", "1", "2", "3", "7"] and sum(f.reason is not None for f in found) == 1


def test_digests_of_other_writers_are_checked():
    import base64

    body = b"hello"
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    for stated, good in ((f"sha1:{sha1}", True), (f"sha1:{sha1[:-1]}A", False), ("md5:" + hashlib.md5(body).hexdigest(), True), ("sha1:" + hashlib.sha1(b"x").hexdigest(), False), ("blake9:zz", True)):
        for field in ("WARC-Payload-Digest", "WARC-Block-Digest"):
            record = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <a>\r\n{field}: {stated}\r\nContent-Length: 5\r\n\r\n".encode() + body + b"\r\n\r\n"
            found = list(warc.salvage(record))
            assert [f.reason is None for f in found] == [good], (stated, field)


# ---- substrings


def brute_substrings(rows, window):
    texts = sorted((float("inf") if i is None else i, WORDS.findall(t or "")) for i, t in rows)
    first = {}
    for doc, words in texts:
        for s in range(len(words) - window + 1):
            first.setdefault(tuple(words[s : s + window]), (doc, s))
    out = []
    for doc, words in texts:
        gone = set()
        for s in range(len(words) - window + 1):
            if first[tuple(words[s : s + window])] != (doc, s):
                gone.update(range(s, s + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((None if doc == float("inf") else doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("window", [1, 5, 20])
def test_substrings_equal_brute_force(spark, window):
    rows = corpus()
    found = [(r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring.substring_rows(frame(spark, rows), window=window, texts=True).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, brute_substrings(rows, window)))


def test_substrings_of_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = substring.dedup_substrings(frame(spark, [(1, text), (1, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, 30)]
    assert substring.dedup_substrings(frame(spark, [])).collect() == []


@pytest.mark.parametrize("rate", [0.999999, 0.5])
def test_a_full_sketch_loses_nothing(spark, monkeypatch, rate):
    monkeypatch.setattr(substring, "ANCHOR_BYTES", 24 if rate == 0.5 else 1 << 30)
    rows = corpus()
    found = [(r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring.substring_rows(frame(spark, rows), texts=True, rate=rate).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, brute_substrings(rows, 20)))


def test_sketch_tells_repeated_anchors(spark):
    import pyarrow as pa

    rows = corpus()
    texts = [t or "" for _, t in rows]
    placed = spark.createDataFrame([(k % 3, t) for k, t in enumerate(texts)], "home long, text string")
    told = {}
    for r in substring.repeated_keys(placed, 20, 5, 20).collect():
        told.setdefault(r.home, set()).update(substring._wide(bytes(r["keys"])).tolist())
    anchors = [substring.anchor_keys(substring.Scan(pa.array([t]), 20).anchors).tolist() for t in texts]
    counts = {}
    for a in anchors:
        for x in a:
            counts[x] = counts.get(x, 0) + 1
    for h in range(3):
        mine = {x for k, a in enumerate(anchors) if k % 3 == h for x in a}
        assert told.get(h, set()) == {x for x in mine if counts[x] > 1}


def test_sketch_overestimates_as_stated():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 40, 200_000, np.uint64)
    sketch = substring.Sketch(substring.sketch_bits(len(values), 0.01))
    for part in np.array_split(np.concatenate([values, values[:500]]), 7):
        other = substring.Sketch(sketch.bits)
        other.add(part)
        np.minimum(sketch.counters + other.counters, 2, out=sketch.counters)  # merged by addition
    assert sketch.repeated(values[:500]).all()
    assert sketch.repeated(values[500:]).mean() < 0.01


def test_rows_that_share_an_id_are_judged_by_their_own_windows(spark):
    words = [" ".join(f"{c}{k}" for k in range(25)) for c in "abc"]
    rows = [(None, words[0]), (None, words[1]), (None, words[2]), (5, words[1]), (6, words[0] + " x"), (None, "")]
    found = substring.dedup_substrings(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in found) == [(0, 0, 0), (0, 25, 0), (0, 25, 25), (0, 25, 25), (5, 25, 0), (6, 26, 0)]
    many = [(None, f"q{k} " + words[k % 3]) for k in range(300)] + [(1, words[0]), (2, words[1])]
    found = substring.dedup_substrings(frame(spark, many)).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(x[:4]) for x in brute_substrings(many, 20))


# ---- Jaccard


def brute_sets(rows, n=5):
    out = []
    for doc, text in rows:
        words = WORDS.findall(text or "")
        out.append((doc, frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) or (frozenset([tuple(words)]) if words else frozenset())))
    return out


def brute_groups(rows, threshold=0.8):
    sets = brute_sets(rows)
    m = len(sets)
    linked = [[i != j and bool(a) and len(a & b) >= threshold * len(a | b) - 1e-12 for j, (_, b) in enumerate(sets)] for i, (_, a) in enumerate(sets)]
    least = [float("inf") if d is None else d for d, _ in sets]
    moved = True
    while moved:
        moved = False
        for i in range(m):
            for j in range(m):
                if linked[i][j] and least[j] < least[i]:
                    least[i], moved = least[j], True
    return [(sets[i][0], sum(linked[i]), None if least[i] == float("inf") else least[i]) for i in range(m)]


def test_jaccard_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    expected = sorted(map(repr, brute_groups(rows)))
    for bucket, block in ((1 << 14, 1 << 10), (8, 6)):  # also with buckets and groups dealt to blocks
        monkeypatch.setattr(jaccard, "BUCKET", bucket)
        monkeypatch.setattr(jaccard, "BLOCK", block)
        found = jaccard.jaccard_groups(frame(spark, rows)).collect()
        assert sorted(repr((r.doc_id, r.n_links, r.component_id)) for r in found) == expected
        kept = [r for r in found if r.kept]
        assert len({r.component_id for r in kept if r.component_id is not None}) == sum(r.component_id is not None for r in kept)
    assert jaccard.jaccard_groups(frame(spark, [])).collect() == []


def test_bands_reach_the_recall():
    assert jaccard.choose_bands(0.8, 0.995, 128) == (21, 6)
    rng = random.Random(2)
    minhash = jaccard.MinHash(21, 6)
    found = 0
    for _ in range(300):
        common = [rng.getrandbits(64) for _ in range(160)]
        a, b = (np.unique(np.array(common + [rng.getrandbits(64) for _ in range(20)], np.uint64)) for _ in range(2))
        signatures, bands = minhash([a, b])
        found += bool((bands[0] == bands[1]).any() and (signatures[0] == signatures[1]).sum() >= 38)
    assert found >= 294


# ---- vectors


def brute_vectors(rows, threshold):
    units = []
    for _, v in rows:
        x = np.array(v, float) if v is not None and None not in v else np.zeros(0)
        good = len(x) and np.isfinite(x).all() and x.any()
        units.append(x / np.linalg.norm(x) if good else None)
    m = len(rows)
    linked = [[i != j and units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= threshold for j in range(m)] for i in range(m)]
    least = [float("inf") if d is None else d for d, _ in rows]
    moved = True
    while moved:
        moved = False
        for i in range(m):
            for j in range(m):
                if linked[i][j] and least[j] < least[i]:
                    least[i], moved = least[j], True
    return [(rows[i][0], sum(linked[i]), None if least[i] == float("inf") else least[i]) for i in range(m)]


def test_range_join_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(k, (centres[k % 12] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.4])).tolist()) for k in range(160)]
    rows += [(k, rows[3][1]) for k in range(160, 175)] + [(175, [2 * x for x in rows[3][1]]), (176, None), (177, [0.0] * 16), (178, [float("nan")] + [1.0] * 15), (179, [None] + [1.0] * 15), (180, []), (181, [1.0, 2.0]), (182, [2.0, 4.1]), (None, rows[5][1]), (None, rows[7][1]), (184, [-0.0] + [1.0] * 15), (185, [0.0] + [1.0] * 15), (186, [1e-200] * 16), (187, [1e200] * 16)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, node string, size int")
    expected = sorted(map(repr, brute_vectors([(i, None if v is None else [x / 1e200 if x == 1e200 else x * 1e200 if x == 1e-200 else x for x in [y for y in v]] if v and None not in v else v) for i, v in rows], 0.95)))
    choose = vectors.useful_pivots
    for most, block, strip in ((None, 8192, 1024), (16, 7, 3)):  # also with many pivots and with cells dealt to blocks
        monkeypatch.setattr(vectors, "useful_pivots", choose if most is None else lambda v, n, reach: vectors.choose_pivots(v, most))
        monkeypatch.setattr(vectors, "BLOCK", block)
        monkeypatch.setattr(vectors, "STRIP", strip)
        found = vectors.range_join(df).collect()
        assert sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in found) == expected
        assert all(r.kept == (r.vec_id == r.component_id) for r in found if r.vec_id is not None)
    assert vectors.range_join(df.limit(0)).collect() == []


def test_pivots_pay_where_vectors_have_structure():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 32))
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    clustered = unit(np.repeat(centres, 50, axis=0) + 0.05 * rng.normal(size=(2000, 32)))
    assert len(vectors.useful_pivots(clustered, 100_000, 0.32)) >= 16
    assert len(vectors.useful_pivots(unit(rng.normal(size=(2000, 64))), 100_000, 0.32)) <= 4


def test_links_of_a_dense_block_are_reduced_by_strips():
    rng = np.random.default_rng(6)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(np.concatenate([unit(rng.normal(size=(4, 16)))[rng.integers(0, 4, 600)] + 0.05 * rng.normal(size=(600, 16)), rng.normal(size=(50, 16))]))
    nodes, sizes = rng.permutation(len(x)).astype(np.int64), rng.integers(1, 4, len(x))
    own = np.arange(0, 300)
    links = vectors.Links(nodes[own], nodes)
    links.compare(x[own], x, sizes, 0.95)
    linked = (x[own] @ x.T >= 0.95) & (nodes[own][:, None] != nodes[None, :])
    assert links.count.tolist() == (linked * sizes).sum(axis=1).tolist() and links.count.max() > 50
    edges = [(int(nodes[i]), int(nodes[j])) for i, j in zip(*np.nonzero(linked), strict=True)]
    least = {int(n): int(n) for n in nodes}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            m = min(least[a], least[b])
            moved |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    assert {int(n): int(links.nodes[r]) for n, r in zip(links.nodes, links.root, strict=True)} == least


def test_vectors_without_structure_are_not_copied_to_many_cells():
    """Of 615 384 such vectors each went to 222 of 256 cells, by batches of over a GB: executors ran out of memory."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4096, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert len(vectors.useful_pivots(x, 615_384, 0.32)) <= 4


def test_copies_of_vectors_are_sent_in_bounded_batches():
    n, dim, cells = 1000, 64, 256
    units = [np.full(dim, float(k)).tobytes() for k in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([1] * n, pa.int64()), pa.array(units, pa.binary())], ["node", "size", "unit"])
    home = np.arange(n) % cells
    found = list(vectors.copies(batch, np.arange(n), dim, home, np.arange(cells) <= home[:, None]))
    assert max(b.nbytes for b in found) < 2 * vectors.SENT_BYTES and len(found) > 5
    rows = [r for b in found for r in zip(*(b.column(c).to_pylist() for c in ("node", "cell", "home")), strict=True)]
    assert rows == [(k, dim * vectors.MOST_PIVOTS + c, c == k % cells) for k in range(n) for c in range(k % cells + 1)]


def test_a_link_is_found_at_one_cell_and_counted_on_both_sides():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(9, 16))[rng.integers(0, 9, 400)] + 0.1 * rng.normal(size=(400, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    reach = np.sqrt(0.1) + vectors.SLACK
    d = vectors.distances(x, vectors.choose_pivots(x, 16))
    home = d.argmin(axis=1)
    lo, hi = (np.array([f(d[home == c], axis=0) for c in range(16)]) for f in (np.min, np.max))
    there = vectors.visited(d, home, lo, hi, reach)
    linked = x @ x.T >= 0.95
    met = np.array([[there[b, home[a]] or there[a, home[b]] for b in range(400)] for a in range(400)])
    both = np.array([[home[a] != home[b] and there[b, home[a]] and there[a, home[b]] for b in range(400)] for a in range(400)])
    assert met[linked].all() and not both.any() and there[np.arange(400), home].all()
    sizes = rng.integers(1, 4, 400)
    links = vectors.Links(np.arange(150), np.arange(150, 400))
    links.compare(x[:150], x[150:], sizes[150:], 0.95, sizes[:150])
    assert links.count.tolist() == (linked[:150, 150:] * sizes[150:]).sum(axis=1).tolist()
    assert links.other_count.tolist() == (linked[:150, 150:] * sizes[:150, None]).sum(axis=0).tolist()


def test_classes_that_share_a_hash_are_told_apart(spark):
    from strandline.llm.common import split_twins

    rows = [(1, 10, 100), (2, 10, 200), (3, 10, 100), (4, 11, 300), (5, None, None)]
    signed = spark.createDataFrame(rows, "id long, node long, check long")
    classes = lambda df: df.filter("node is not null").groupBy("node").agg(F.min("check").alias("least_check"), F.max("check").alias("most_check"))
    apart = split_twins(signed, classes(signed))
    nodes = {r.id: r.node for r in apart.collect()}
    assert nodes[1] == nodes[3] != nodes[2] and nodes[4] == 11 and nodes[5] is None
    assert split_twins(apart, classes(apart)) is None


# ---- components


@pytest.mark.parametrize(("large", "most"), [(1024, 500_000), (3, 500_000), (3, 0)])
def test_rows_meet_their_components(spark, monkeypatch, large, most):
    monkeypatch.setattr(components, "LARGE", large)
    monkeypatch.setattr(components, "BROADCAST_ROWS", most)
    rows = spark.createDataFrame([(k, 1 if k < 9 else 20 if k < 12 else k) for k in range(1, 40)], "node long, component long")
    groups = rows.groupBy("component").agg(F.count("*").alias("members"), F.max("node").alias("top"))
    found = {(r.node, r.component, r.members, r.top) for r in components.join_components(rows, groups, "node").collect()}
    assert found == {(k, 1, 8, 8) if k < 9 else (k, 20, 4, 20) if k < 12 or k == 20 else (k, k, 1, k) for k in range(1, 40)}


@pytest.mark.parametrize("most", [500_000, -1])  # also where a round's changes are too many to broadcast
def test_components_equal_union_find(spark, monkeypatch, most):
    monkeypatch.setattr(components, "BROADCAST_ROWS", most)
    rng = random.Random(9)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 600)] + [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(180)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    found = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in parent if x in found} and set(found) == {x for a, b in edges if a != b for x in (a, b)}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- quality


def brute_statistics(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    places = {}
    for s in range(len(words) - 7):
        places.setdefault(tuple(words[s : s + 8]), []).append(s)
    covered = {p for at in places.values() if len(at) > 1 for s in at for p in range(s, s + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_statistics_equal_brute_force(spark):
    rows = corpus() + [(300, "a b\na b\n \na b\nc"), (301, "#x *y $z %% && | <a> 😀"), (302, "one two three four five six seven eight " * 3), (303, "y " * 9), (304, " a\x0bb\x0cc\r\n\td\n\n\x0b\n!!"), (305, "é\u00a0ü\u2003İ ǅ 中文 " * 9), (306, "p q r s t u v w x y p q r s t u v w x")]
    found, _ = quality.quality(frame(spark, rows), carry=["n_words", "row"])
    assert found.columns[0] == "row" and found.select("row.*").columns == ["doc_id", "n_words", "row"]
    got = sorted(repr((r["row"].doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in found.collect())
    expected = []
    for doc, text in rows:
        s = brute_statistics(text)
        expected.append(repr((doc, *s, s[0] < 20 or 100 * s[4] > 30 * s[0])))
    assert got == sorted(expected)
    empty, _ = quality.quality(frame(spark, []))
    assert empty.collect() == []


def test_label_model_finds_planted_accuracies():
    rng = random.Random(1)
    on_good, on_bad, patterns = [0.95, 0.9, 0.99, 0.8], [0.8, 0.6, 0.9, 0.7], {}
    for _ in range(20_000):
        good = rng.random() < 0.7
        votes = tuple(0 if rng.random() < 0.2 else (1 if good else -1) * (1 if rng.random() < (on_good if good else on_bad)[j] else -1) for j in range(4))
        patterns[votes] = patterns.get(votes, 0) + 1
    model = quality.fit(sorted(patterns.items()), 4)
    assert abs(model.prior - 0.7) < 0.03
    assert max(abs(a - b) for a, b in zip(model.on_good + model.on_bad, on_good + on_bad, strict=True)) < 0.06
    assert quality.fit([], 3).prior == 0.8


def test_quality_agrees_with_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found, _ = quality.quality(docs)
    rows = found.filter("not base_failed").select("row.doc_id", "kept").join(labels, "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def brute_votes(text):
    """The default rules, written out."""
    n_words, chars, symbols, dup_lines, repeats = brute_statistics(text)
    words, n = WORDS.findall(text), max(1, n_words)
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    stop = {w for x in quality.STOP_WORDS.values() for w in x}
    stops = sum(w in stop for w in words) / n
    shout, stutter = text.count("!") / n, sum(a == b for a, b in zip(words, words[1:])) / n
    letters = [c for c in text if unicodedata.category(c)[0] == "L"]
    upper = sum(unicodedata.category(c) == "Lu" for c in letters) / max(1, len(letters))
    ended = sum(x.rstrip(" \t\n\x0b\x0c\r")[-1] in ".!?:;\"')…。" for x in lines) / max(1, len(lines))
    dup, mean = dup_lines / max(1, len(lines)), chars / n
    vote = lambda good, bad: -1 if bad else 1 if good else 0
    return (
        vote(symbols / n <= 0.03 or shout <= 0.1 or upper <= 0.2, symbols / n > 0.1 or shout > 0.25 or upper > 0.4),
        vote(2.5 <= mean <= 9.5, mean < 2 or mean > 13),
        vote(n_words >= 20 and stops >= 0.06, n_words >= 20 and stops < 0.03),
        vote(ended >= 0.6, ended < 0.3),
        vote(dup <= 0.1 or repeats / n <= 0.1 or stutter <= 0.05, dup > 0.3 or repeats / n > 0.25 or stutter > 0.2),
    ), n_words < 20 or 100 * repeats > 30 * n_words


def brute_posteriors(votes, rounds=100):
    """Expectation-maximisation over single documents, in products of chances."""
    v = np.array(votes)
    up, down = v > 0, v < 0
    prior, g, b = 0.8, np.full(v.shape[1], 0.95), np.full(v.shape[1], 0.5)
    for k in range(rounds + 1):
        good = prior * np.where(up, g, np.where(down, 1 - g, 1)).prod(axis=1)
        bad = (1 - prior) * np.where(up, 1 - b, np.where(down, b, 1)).prod(axis=1)
        p = (good / (good + bad))[:, None]
        if k < rounds:
            prior = (p.sum() + 1.6) / (len(v) + 2)
            g, b = ((p * up).sum(axis=0) + 1.9) / ((p * (up | down)).sum(axis=0) + 2), (((1 - p) * down).sum(axis=0) + 1) / (((1 - p) * (up | down)).sum(axis=0) + 2)
    return p[:, 0]


def test_quality_verdicts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    judged = {k: brute_votes(t) for k, t in texts.items()}
    passed = [k for k, (_, failed) in judged.items() if not failed]
    expected = dict.fromkeys(texts, False) | dict(zip(passed, brute_posteriors([judged[k][0] for k in passed]), strict=True))
    found = {r["row"].doc_id: r for r in quality.quality(docs)[0].collect()}
    assert found.keys() == expected.keys()
    names = [f"vote_{x.name}" for x in quality.default_rules()]
    for k, r in found.items():
        assert tuple(r[x] for x in names) == judged[k][0]
        assert r.kept == (expected[k] >= 0.5)
        assert not r.kept or abs(r.quality_probability - expected[k]) < 1e-6
    assert 0 < sum(r.kept for r in found.values()) < len(found)


def test_quality_plan_has_no_python(spark):
    found, _ = quality.quality(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString())


# ---- licenses


def test_licenses_are_found_with_their_spans(spark):
    mit = licenses.TEMPLATES["MIT"][3]
    edited = mit.replace("without restriction", "with no limits at all").replace("merge, ", "")
    rows = [(1, "Text é before.\nReleased under the MIT License.\nmore"), (2, f"// {edited}\n code"), (3, "under the License of nothing"), (4, None), (5, ""), (None, "LICENSED under the Apache License,\n# Version 2.0"), (6, "Licensed under CC BY-NC 4.0. " * 2), (7, "word " * 20_000 + "This work is licensed under the GNU General Public License, version 3."), (1, "Released under the MIT License")]
    found = licenses.scan_licenses(frame(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.license) for r in found) == [(0, "Apache-2.0"), (1, "MIT"), (1, "MIT"), (2, "MIT"), (6, "CC-BY-NC-4.0"), (6, "CC-BY-NC-4.0"), (7, "GPL-3.0")]
    texts = {r[0]: r[1] for r in rows[:-1]}
    for r in found:
        if r.doc_id == 7:
            assert texts[7][r.start_char : r.end_char] == "This work is licensed under the GNU General Public License, version 3"
        if r.doc_id == 2:
            assert 0.9 < r.coverage < 1 and texts[2][r.start_char : r.end_char].startswith("Permission") and texts[2][r.start_char : r.end_char].endswith("SOFTWARE")
    assert licenses.scan_licenses(frame(spark, [])).collect() == []


def test_license_lines_of_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = ("Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.")
    expected = sorted((r.doc_id, m.start(), m.end() - 1) for r in docs.collect() for x in lines for m in re.finditer(re.escape(x), r.text))
    found = sorted((r.doc_id, r.start_char, r.end_char) for r in licenses.scan_licenses(docs).collect())
    assert found == expected and expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("SPDX-License-Identifier: BSD-2-Clause", ["BSD-2-Clause"]),
        ("SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0"]),
        ("SPDX-License-Identifier: LGPL-3.0-only", []),
        ("This work is licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
        ("This work is licensed under the GNU Lesser General Public License, version 3", []),
        ("Licensed under CC BY 3.0", ["CC-BY-3.0"]),
        ("Licensed under CC BY-ND 4.0", ["CC-BY-ND-4.0"]),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", ["CC-BY-ND-4.0"]),
        ("This text is licensed under the GNU General Public License, version 3", ["GPL-3.0"]),
        ("SPDX-License-Identifier: MIT\n" * 5, ["MIT"] * 5),
    ],
)
def test_sibling_licenses_and_repeated_lines(text, expected):
    words, index = licenses.Words(pa.array([text])), licenses.TemplateIndex(licenses.TEMPLATES)
    values, at = licenses.fingerprints(words.hashes)
    hits = [(v, k) for v, k in zip(values.tolist(), at.tolist(), strict=True) if v in index.places]
    assert [m.license for m in index.scan(words.hashes, hits, 0.8)] == expected


def brute_scan(index, hashes, least):
    """Every template aligned with the whole text, without fingerprints or bands; each alignment found parts the text."""
    found = []
    for (name, k, template), core in zip(index.entries, index.cores, strict=True):
        rest = [(0, len(hashes))]
        while rest:
            lo, hi = rest.pop()
            rows = [[(0, 0, -1)] * (hi - lo + 1) for _ in range(len(template) + 1)]
            best = (0, 0, -1, -1)
            for i, t in enumerate(template):
                for j in range(hi - lo):
                    score, matched, first = rows[i][j]
                    cell = (score + 2, matched + 1, first if score else j) if hashes[lo + j] == t else (score - 1, matched, first)
                    up, left = rows[i][j + 1], rows[i + 1][j]
                    cell = max(cell, (up[0] - 1, up[1], up[2]), (left[0] - 1, left[1], left[2]), key=lambda c: c[0])
                    rows[i + 1][j + 1] = cell if cell[0] > 0 else (0, 0, -1)
                    if cell[0] > best[0]:
                        best = (*cell, j)
            if best[1] < least * len(template) or not best[0]:
                continue
            first, last = lo + best[2], lo + best[3]
            if licenses.holds(hashes[first : last + 1].tolist(), core):
                found.append(licenses.Match(name, k, best[1] / len(template), best[1], first, last))
            rest += [(lo, first), (last + 1, hi)]
    found.sort(key=lambda m: (-m.matched, -m.coverage, m.first_word, m.license))
    kept = []
    for m in found:
        if all(m.last_word < o.first_word or m.first_word > o.last_word for o in kept):
            kept.append(m)
    return sorted(kept, key=lambda m: m.first_word)


def test_scan_equals_alignment_with_whole_texts():
    rng = random.Random(12)
    short = {name: tuple(t for t in texts if len(t) < 420) for name, texts in licenses.TEMPLATES.items()}
    index = licenses.TemplateIndex(short)
    notices = [t for texts in short.values() for t in texts]
    for _ in range(25):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices("code of the license work is under file public x1 y2 z3".split(), k=rng.randint(0, 12))
            part = rng.choice(notices).split()
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(part))
                part[at : at + rng.randint(0, 1)] = rng.choices(["inserted", "the", "word"], k=rng.randint(0, 2))
            words += part
        text = licenses.Words(pa.array([" ".join(words)]))
        values, at = licenses.fingerprints(text.hashes)
        hits = [(v, k) for v, k in zip(values.tolist(), at.tolist(), strict=True) if v in index.places]
        shown = lambda found: [(m.license, m.template, m.matched, m.first_word, m.last_word) for m in found]
        assert shown(index.scan(text.hashes, hits, 0.8)) == shown(brute_scan(index, text.hashes, 0.8)), " ".join(words)


def test_scanning_takes_linear_time():
    import time

    index = licenses.TemplateIndex(licenses.TEMPLATES)

    def seconds(n):
        text = licenses.Words(pa.array(["Released under the MIT License. SPDX-License-Identifier: MIT\n" * n]))
        values, at = licenses.fingerprints(text.hashes)
        hits = [(v, k) for v, k in zip(values.tolist(), at.tolist(), strict=True) if v in index.places]
        start = time.process_time()
        assert len(index.scan(text.hashes, hits, 0.8)) == 2 * n
        return time.process_time() - start

    seconds(100)
    assert seconds(4000) < 8 * seconds(1000)


# ---- HTML


def text_of(source):
    return html_text.main_text(html_text.Page(source))


@pytest.mark.parametrize(
    ("source", "expected"),
    [
        ("", ""),
        ('<article><p>a</p><section class="related-work"><p>b</p></section><div class="ad-slot">c</div><p class="notice">d</p></article>', "a\nb"),
        ("plain", "plain"),
        ("<p>a&amp;b &lt;i&gt; &#233;&nbsp;c\n d<b>old</b><br>e</p><p>f", "a&b <i> é c dold e\nf"),
        ("<html><head><title>t</title><style>p{}</style></head><body><nav>n</nav><header>h</header><p>x<script>var t='</p>';</script>y</p><aside>s</aside><footer>f</footer>", "xy"),
        ("<body><div class='ad'>buy</div><article><header><h1>T</h1></header><p>a<p>b<form>f</form><div class='share-links'>s</div><section id=comments>c</section></article><p>out</p>", "T\na\nb"),
        ("<main><p>in</p><div role=navigation>n</div></main><p>out</p>", "in"),
        ("<div class='with-sidebar'><article>kept</article></div>", "kept"),
        ("<article><p>body</p><article class='comment'>me too</article></article>", "body"),
        ("<p>a<!-- c > d -->b</p><!-- open", "ab"),
        ("<ul><li>one<li>two</ul>three", "one\ntwo\nthree"),
        ("a < b and <unclosed", "a < b and"),
        ("<div class=cookie-notice>ok?</div><p>x</p>", "x"),
        ("<div class=sideBar>s</div><div id=mainMenu>m</div><div class='Reader-Comments'>c</div><p>x</p>", "x"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ],
)
def test_main_text(source, expected):
    assert text_of(source) == expected


@pytest.mark.parametrize("most", [200_000, 0])  # also where keys are too many to broadcast
def test_style_tree_removes_what_all_pages_of_a_host_share(spark, monkeypatch, most):
    monkeypatch.setattr(html_text, "BROADCAST_KEYS", most)
    rng = random.Random(3)
    page = lambda k: f"<body><div class=top>Same on every page</div><div class=story><p>{sentence(rng, 30)}</p><p>{sentence(rng, 20)}</p></div><div class=end><p>All rights</p></div>"
    rows = [(k, "http://one.example/x", page(k)) for k in range(40)] + [(100 + k, "http://two.example/x", page(k)) for k in range(3)] + [(200, None, "<p>x</p>"), (201, "odd", None), (None, "http://one.example/y", "")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, noise string")
    found = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert len(found) == len(rows)
    for k in range(40):
        assert "Same on every page" not in found[k] and "All rights" not in found[k] and found[k].count("\n") == 1
    assert "Same on every page" in found[100]  # too few pages to tell
    assert found[200] == "x" and found[201] == "" and found[None] == ""
    assert html_text.extract(df.limit(0)).collect() == []


def test_copies_of_one_page_keep_their_text(spark):
    df = spark.createDataFrame([(k, "http://c.example/", "<div><p>the very same story</p></div>") for k in range(30)], "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(df).collect()} == {"the very same story"}


def test_short_stories_lose_long_site_text(spark):
    rng = random.Random(5)
    site = [sentence(rng, 20) for _ in range(3)]
    html = lambda: f"<div class=a><p>{site[0]}</p></div><div class=b><p>{site[1]}</p></div><div class=story><p>{sentence(rng, 40)}</p></div><div class=c><p>{site[2]}</p></div>"
    df = spark.createDataFrame([(k, "http://s.example/", html()) for k in range(40)], "page_id long, url string, html string")
    assert all("\n" not in r.text and len(r.text.split()) == 40 for r in html_text.extract(df).collect())


def test_hosts_of_few_pages_are_cleaned(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(k, "http://f.example/", f"<div class=top>Same on every page</div><div class=story><p>{sentence(rng, 30)}</p></div>") for k in range(5)], "page_id long, url string, html string")
    assert all("Same" not in r.text and r.text for r in html_text.extract(df).collect())


def test_long_and_odd_markup_takes_linear_time():
    for source in ("<" * 50_000, "<a href=\"" * 20_000, "<p>" * 50_000, "<div>" * 3_000 + "deep", "<!--" * 20_000, "&" * 50_000):
        text_of(source)


# ---- repeated rows, quoted records and long headers


def test_blank_lines_and_quoted_records():
    quoted = record(99, b"quoted payload")
    damaged = record(1, b"see:\r\n" + quoted + b"end of it")
    damaged = damaged.replace(b"end of it", b"End of it")  # the payload's digest differs, its length doesn't
    for pack in (bytes, gz):
        found = list(warc.salvage(pack(record(0, b"a")) + pack(damaged) + pack(record(2, b"b"))))
        assert [(f.headers.get("warc-record-id", ""), bool(f.reason)) for f in found] == [("<urn:strandline:page:0>", False), ("", True), ("<urn:strandline:page:2>", False)]
    inside = gz(record(0, b"a") + b"\r\n\r\n" + record(1, b"b") + b"\r\n" + record(2, b"c"))
    assert [f.reason for f in warc.salvage(inside)] == [None] * 3


@pytest.mark.parametrize("pack", [bytes, gz])
def test_version_lines_take_linear_time(pack):
    import time

    def seconds(n):
        content = pack(b"\nWARC/1.1\r\n" * n)
        began = time.process_time()
        assert all(f.reason for f in warc.salvage(content))
        return time.process_time() - began

    seconds(1000)
    assert seconds(80_000) < 12 * max(seconds(10_000), 0.02)


def test_rows_that_repeat_are_one_class(spark):
    """One near copy and a row very many times: links are counted by classes, and of equal keys in order the first is taken."""
    base = sentence(random.Random(1), 80)
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit(base).alias("text")).repartition(4)
    docs = docs.unionByName(spark.createDataFrame([(2, base + " end")], "doc_id long, text string"))
    rows = jaccard.jaccard_groups(docs).groupBy("doc_id", "n_links", "component_id").count().collect()
    assert sorted(map(tuple, rows)) == [(1, 20_000, 1, 20_000), (2, 20_000, 1, 1)]
    batches = [pa.record_batch({"a": a, "b": b}) for a, b in (([1, 1, 1, 2], [5, 5, 6, 6]), ([2, 2], [6, 7]), ([], []), ([2, 3], [7, 7]))]
    batches[2] = batches[0].slice(0, 0)
    assert [r for b in jaccard._once(iter(batches), "a", "b") for r in map(tuple, zip(*b.to_pydict().values()))] == [(1, 5), (1, 6), (2, 6), (2, 7), (3, 7)]


def test_homes_of_rows_that_repeat_id_and_text_spread(spark, monkeypatch):
    monkeypatch.setattr(substring, "REPEATS", 50)
    monkeypatch.setattr(substring, "HOME_BYTES", 1 << 12)
    text = sentence(random.Random(1), 40)
    rows = [(None, text)] * 600 + [(1, text)] + [(k, sentence(random.Random(k), 30)) for k in range(5, 20)]
    found = [(r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in substring.substring_rows(frame(spark, rows), texts=True).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, brute_substrings(rows, 20)))
