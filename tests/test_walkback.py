"""The walk-back processor over stored tables: sets of batches, touched parts, and stops after any write."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strandline import schemas
from strandline.operators import queues
from strandline.sources.parts import PartedTables
from strandline.streaming import validation, walkback

NOW = datetime(2024, 1, 31)
COUNTS = ", ".join(f"{c} bigint" for c in ("total", *queues.COUNTED))


def filled(spark, path, n=12, crawls=2):
    """Batches 0 .. n - 1: every fourth is stale, the last one's edges are still open; each has two valid edges."""
    store = PartedTables(spark, str(path), buckets=4)

    def batch(k):
        stale = k % 4 == 3
        return (f"b{k}", f"2024{k % crawls}", "src", f"p{k}", k, f"q{k}", "processing" if stale else "closed", 1 if stale else 0, NOW - timedelta(minutes=100 - k), None, NOW - timedelta(minutes=30) if stale else None, None, "gone" if stale else None)

    batches = spark.createDataFrame([batch(k) for k in range(n)], schemas.BATCHES + ", claimed_by STRING")
    edges = spark.createDataFrame([(10 * k + j, f"b{k}", f"2024{k % crawls}", f"chan_{k}_{j}", "src", f"q{k}", NOW, "url" if j else "", "pending" if k == n - 1 else "valid" if j else "invalid", None, None) for k in range(n) for j in range(3)], schemas.PENDING_EDGES)
    store.create("batches", batches)
    store.create("pending_edges", edges)
    store.create("source_stats", spark.createDataFrame([], f"batch_id string, crawl_id string, source_type string, {COUNTS}"))
    store.create("page_buffer", spark.createDataFrame([], schemas.PAGE_BUFFER + ", batch_id string"))
    store.create("edges", spark.createDataFrame([], schemas.EDGES + ", batch_id string"))
    return store


def state(store):
    return {name: sorted(repr(r) for r in store.read(name).drop("part").collect()) for name in walkback.TABLES}


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("src",), ("far",), ("away",)], "channel string")


def run(store, known, k, rounds=9):
    return walkback.walkback_loop(store, known, lambda: F.lit(NOW), 30, "s", rounds, k)


def test_sets_of_batches_give_what_single_ones_give(spark, tmp_path, known):
    one, many = filled(spark, tmp_path / "one", 5), filled(spark, tmp_path / "many", 5)
    assert run(one, known, 1) == run(many, known, 5) == 4
    assert state(one) == state(many)
    batches = {r.batch_id: (r.status, r.attempt_count) for r in many.read("batches").collect()}
    assert batches == {f"b{k}": ("closed", 0) if k == 4 else ("completed", 2 if k == 3 else 1) for k in range(5)}
    assert {r.batch_id for r in many.read("pending_edges").collect()} == {"b4"}
    pages = many.read("page_buffer").collect()
    assert sorted(r.batch_id for r in pages) == [f"b{k}" for k in range(4)] and len({r.page_id for r in pages}) == 4
    stats = {(r.crawl_id, r.source_type): (r.total, r.valid, r.invalid) for r in walkback.source_statistics(many).collect()}
    assert stats == {(c, s): (4, 4, 0) if s == "url" else (2, 0, 2) for c in ("20240", "20241") for s in ("url", "unknown")}
    assert run(many, known, 5) == 0


def test_a_stop_after_any_write_changes_nothing(spark, tmp_path, known, monkeypatch):
    whole = filled(spark, tmp_path / "whole", 4)
    assert run(whole, known, 3) == 3
    expected = state(whole)
    replace = PartedTables.replace

    class Stop(Exception):
        pass

    for stop in (1, 2, 4, 6, 8):
        store, left = filled(spark, tmp_path / f"stop{stop}", 4), [stop]

        def counted(self, *args, left=left):
            replace(self, *args)
            left[0] -= 1
            if not left[0]:
                raise Stop

        monkeypatch.setattr(PartedTables, "replace", counted)
        with pytest.raises(Stop):
            run(store, known, 3)
        monkeypatch.setattr(PartedTables, "replace", replace)
        run(store, known, 3)
        assert state(store) == expected, stop


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_size for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_a_round_writes_the_parts_of_its_batches_only(spark, tmp_path, known):
    store = filled(spark, tmp_path, 24, crawls=8)
    walkback.recover(store, F.lit(NOW))
    written = []
    for k in (1, 3, 12):
        before = files(tmp_path)
        assert walkback.walkback_round(store, known, F.lit(NOW), 30, "s", k) == k
        after = files(tmp_path)
        new = after.keys() - before.keys()
        for name in walkback.TABLES:
            touched = {os.path.dirname(f) for f in new | (before.keys() - after.keys()) if f.startswith(f"{tmp_path}/{name}/")}
            assert len(touched) <= k
        written.append(sum(after[f] for f in new))
    assert written[0] < written[1] < written[2]


def test_rows_of_other_parts_are_refused(spark, tmp_path):
    store = filled(spark, tmp_path, 6)
    with pytest.raises(ValueError, match="other parts"):
        store.replace("batches", store.read("batches"), ["part_20240_0"])


# ---- the validator


def filled_edges(spark, path, n=18):
    edges, channels = PartedTables(spark, str(path / "edges"), buckets=3), PartedTables(spark, str(path / "channels"), "channel", 2)
    rows = [(k, f"b{k % 4}", "c", f"chan{k % 8}", "src", "q", NOW + timedelta(minutes=k), "url", "pending", None, None, None) for k in range(n)]
    edges.create("pending_edges", spark.createDataFrame(rows, schemas.PENDING_EDGES + ", validated_by STRING"))
    channels.create("known", spark.createDataFrame([("chan7", "all", None, NOW)], validation.KNOWN))
    channels.create("invalid", spark.createDataFrame([("chan6", "all", "old", None, NOW - timedelta(days=3)), ("chan5", "all", "expired", None, NOW - timedelta(days=31))], validation.INVALID))
    return edges, channels


def verdicts(channels):
    k = F.substring("channel", 5, 9).cast("int")
    return channels.select("channel", F.when(k < 3, "valid").when(k == 3, "not_channel").when(k == 5, "invalid").otherwise("blocked").alias("verdict"), F.lit("seen").alias("reason"))


def edge_state(stores):
    edges, channels = stores
    found = {r.pending_id: (r.validation_status, r.validation_reason) for r in edges.read("pending_edges").collect()}
    return found, sorted((r.channel, r.pending_id) for r in channels.read("known").collect() if r.pending_id is not None), sorted((r.channel, r.reason) for r in channels.read("invalid").collect())


def test_validation_runs_until_nothing_waits(spark, tmp_path, monkeypatch):
    run = lambda stores, k: validation.validation_loop(*stores, verdicts, lambda: F.lit(NOW), 20, k)
    one, many = filled_edges(spark, tmp_path / "one"), filled_edges(spark, tmp_path / "many")
    assert run(one, 100) == run(many, 7) == 18
    whole, found, (_, known, invalid) = edge_state(one)[0], edge_state(many)[0], edge_state(one)
    # a later round finds in the cache what one round asks about twice
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in whole.items()} and edge_state(many)[1:] == (known, invalid) and found[13][1] == "cached_invalid"
    expected = {0: ("valid", ""), 8: ("duplicate", ""), 3: ("not_channel", "seen"), 4: ("pending", "no_verdict"), 5: ("invalid", "seen"), 6: ("invalid", "cached_invalid"), 7: ("duplicate", "")}
    assert {k: whole[k] for k in expected} == expected and known == [("chan0", 0), ("chan1", 1), ("chan2", 2)] and invalid == [("chan5", "seen"), ("chan6", "old")]
    validation.retry(one[0])
    assert run(one, 100) == 2
    replace = PartedTables.replace
    for stop in (2, 4):
        stores, left = filled_edges(spark, tmp_path / f"stop{stop}"), [stop]

        def counted(self, *args, left=left):
            replace(self, *args)
            left[0] -= 1
            if not left[0]:
                raise InterruptedError

        monkeypatch.setattr(PartedTables, "replace", counted)
        with pytest.raises(InterruptedError):
            run(stores, 7)
        monkeypatch.setattr(PartedTables, "replace", replace)
        run(stores, 7)
        assert edge_state(stores) == (found, known, invalid), stop
