"""The frontier loop and its stop rules; timers of workers, leases and caches."""

from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from strandline.operators import posts
from strandline.sources import files
from strandline.streaming import frontier, loops, timers

NOW = datetime(2024, 1, 31)
PAGE = "page_id string, url string, depth int, crawl_id string"


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now

    def sleep(self, seconds):
        self.now += seconds


def chain(spark, n):
    return spark.createDataFrame([(f"c{k}", f"c{k + 1}") for k in range(n)], "source string, destination string")


def test_frontier_runs_to_its_end_and_goes_on_after_a_stop(spark):
    edges = chain(spark, 5).unionByName(spark.createDataFrame([("c5", "c0"), ("c2", "x"), ("c3", "x")], "source string, destination string"))
    start = spark.createDataFrame([("c0", "c0", 0, "c"), ("other", "other", 0, "d")], PAGE)
    step = frontier.links_of(edges)
    whole = frontier.run_frontier(start, step, "c", 2)
    assert whole.reason == "done" and sorted(r.url for r in whole.pages.collect()) == ["c0", "c1", "c2", "c3", "c4", "c5", "x"]
    assert {r.url: r.depth for r in whole.pages.collect()}["x"] == 3 and [r.url for r in whole.buffer.collect()] == ["other"]
    part = frontier.run_frontier(start, step, "c", 2, frontier.Limits(rounds=3))
    assert (part.reason, part.rounds) == ("rounds", 3)
    rest = frontier.run_frontier(part.buffer, step, "c", 2, processed=part.pages)
    assert sorted(map(tuple, rest.pages.collect())) == sorted(map(tuple, whole.pages.collect())) and part.rounds + rest.rounds == whole.rounds


def test_frontier_keeps_pages_that_are_not_done(spark):
    step = frontier.links_of(chain(spark, 3))

    def flaky(pages):
        found, done = step(pages)
        return found, done.filter("page_id <> 'c1'")

    start = spark.createDataFrame([("c0", "c0", 0, "c")], PAGE)
    found = frontier.run_frontier(start, flaky, "c", 5)
    assert found.reason == "done" and {r.url for r in found.buffer.collect()} == {"c1"} and {r.url for r in found.pages.collect()} == {"c0", "c2", "c3"}


def test_frontier_waits_for_the_validator_and_breaks(spark):
    start = spark.createDataFrame([("a", "a", 0, "c")], PAGE)
    none = frontier.links_of(spark.createDataFrame([], "source string, destination string"))
    clock, left, brought = Clock(), [3], [None, None, None, spark.createDataFrame([("b", "b", 1, "c"), ("a2", "a", 1, "c")], PAGE)]

    def incomplete():
        left[0] = max(0, left[0] - 1) if not brought else left[0]
        return left[0]

    tandem = frontier.Tandem(incomplete, lambda: brought.pop(0) if brought else None, clock, clock.sleep)
    found = frontier.run_frontier(start, none, "c", 5, frontier.Limits(validator_seconds=60, poll=5), tandem)
    assert found.reason == "done" and {r.page_id for r in found.pages.collect()} == {"a", "b"}
    stuck = frontier.Tandem(lambda: 2, lambda: None, clock, clock.sleep)
    with pytest.raises(frontier.ValidatorStalled, match="2 incomplete batches after 60 seconds"):
        frontier.run_frontier(start, none, "c", 5, frontier.Limits(validator_seconds=60, poll=20), stuck)
    late = Clock()
    timed = frontier.run_frontier(start, none, "c", 5, frontier.Limits(seconds=30, poll=20), frontier.Tandem(lambda: 1, lambda: None, late, late.sleep))
    assert timed.reason == "time" and late.now == 40


def streamed(spark, tmp_path, batches, schema, made):
    """Rows of a stream of one file each, with all its timers run."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/{k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
    query = made(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


def at(minutes):
    return NOW + timedelta(minutes=minutes)


def test_a_silent_worker_goes_offline_and_its_work_returns(spark, tmp_path):
    schema = "worker string, kind string, item string, retries int, at timestamp"
    batches = [
        [("w1", "status", None, None, at(0)), ("w1", "assigned", "i1", 0, at(1)), ("w1", "assigned", "i2", 2, at(1)), ("w1", "finished", "i1", None, at(2)), ("w2", "status", None, None, at(0))],
        [("w2", "assigned", "i9", 0, at(4))],
        [("w2", "status", None, None, at(8))],
        [("w1", "status", None, None, at(10)), ("w2", "status", None, None, at(12))],
    ]
    found = streamed(spark, tmp_path, batches, schema, timers.liveness).orderBy("at", "event").collect()
    assert [(r.worker, r.event, r.item, r.retries, r["at"]) for r in found] == [("w1", "offline", None, None, at(7)), ("w1", "requeued", "i2", 3, at(7)), ("w1", "online", None, None, at(10))]


def test_leases_run_out(spark, tmp_path):
    schema = "id string, kind string, attempt int, at timestamp"
    batches = [[("b1", "claimed", 1, at(0)), ("b2", "claimed", 3, at(1)), ("b3", "claimed", 1, at(2))], [("b3", "ended", None, at(9)), ("b4", "claimed", 1, at(5))], [("b1", "claimed", 2, at(14)), ("x", "claimed", 1, at(14))], [("y", "claimed", 1, at(20))]]
    found = streamed(spark, tmp_path, batches, schema, timers.expired_leases).orderBy("at").collect()
    assert [(r.id, r.status, r.attempt, r["at"]) for r in found] == [("b1", "closed", 1, at(10)), ("b2", "poison", 3, at(11)), ("b4", "closed", 1, at(15))]


def test_caches_age_and_shards_rotate(spark, tmp_path):
    day = 24 * 60
    batches = [[(f"m{k}", at(k)) for k in range(7)], [("m0", at(day)), ("m1", at(29 * day))], [("m0", at(31 * day)), ("n", at(31 * day))], [("m2", at(61 * day)), ("m0", at(61 * day - 5))], [("m0", at(70 * day))]]
    found = streamed(spark, tmp_path, batches, "id string, at timestamp", lambda s: timers.first_seen(s, buckets=1, shard_items=3)).orderBy("at", "id").collect()
    assert [(r.id, r["at"]) for r in found] == [*((f"m{k}", at(k)) for k in range(7)), ("m0", at(31 * day)), ("n", at(31 * day)), ("m2", at(61 * day)), ("m0", at(70 * day))]
    assert [r.shard for r in found[:7]] == [0, 0, 0, 1, 1, 1, 2] and all(r.shard >= 2 for r in found[7:])


# ---- stored histories and raw messages


def test_history_scans_open_the_days_they_need(spark, tmp_path):
    path = str(tmp_path / "history")
    for day in range(4):
        rows = spark.createDataFrame([(10 * day + k, k % 2, NOW + timedelta(days=day, hours=k)) for k in range(6)], "id long, chat int, at timestamp")
        files.write_history(rows, path, "at", "chat")
    since = F.lit(NOW + timedelta(days=1, hours=3))
    until = F.lit(NOW + timedelta(days=2, hours=1))
    found = files.read_history(spark, path, "id long, at timestamp", "at", since, until)
    assert sorted(r.id for r in found.collect()) == [13, 14, 15, 20, 21]
    opened = {r.f.split("day=")[1][:10] for r in found.select(F.input_file_name().alias("f")).collect()}
    assert opened == {"2024-02-01", "2024-02-02"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]

    def run():
        stream = loops.history_stream(spark, path, "id long, at timestamp", "at", since)
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = run()
    assert first == [13, 14, 15, *range(20, 26), *range(30, 36)]
    files.write_history(spark.createDataFrame([(99, 1, NOW + timedelta(days=3))], "id long, chat int, at timestamp"), path, "at", "chat")
    assert run() == [*first, 99]  # no file twice


def test_raw_messages_of_any_shape(spark):
    lines = [
        '{"id": 1, "chat_id": 7, "date": 1704067200, "content": {"@type": "messageText", "text": {"text": "hi"}, "new": {"a": [1]}}, "interaction_info": {"view_count": 5, "reactions": {"reactions": [{"type": {"@type": "reactionTypeEmoji", "emoji": "x"}, "total_count": 2}, {"type": {"@type": "reactionTypePaid"}, "total_count": 1}]}}}',
        '{"id": 2, "content": {"@type": "messageNobodyKnows", "text": [1, 2]}, "interaction_info": {"view_count": "many"}, "date": "x"}',
        '{"id": 3, "content": {"@type": "messageDocument", "document": {"file_name": "a.pdf", "document": {"remote": {"id": "r1"}}, "thumbnail": {"file": {"remote": {"id": "t1"}}}}}, "media_album_id": "77"}',
        '{"id": 4, "content": {"@type": "messagePhoto", "caption": {"text": "cap"}, "photo": {"sizes": [{"photo": {"remote": {"id": "p1"}}}]}}}',
        '{"id": "x"}', "[1]", "not json", None,
    ]
    found = {r.message_id: r for r in posts.raw_messages(spark.createDataFrame([(x,) for x in lines], "value string")).drop("raw").collect()}
    assert sorted(found) == [1, 2, 3, 4]
    one = found[1]
    assert (one.kind, one.content.text, one.views, one.date) == ("messageText", "hi", 5, datetime(2024, 1, 1)) and [tuple(x) for x in one.reactions] == [("emoji", "x", 2), ("custom", None, 1)]
    assert (found[2].kind, found[2].views, found[2].date, found[2].reactions) == ("messageNobodyKnows", None, None, None)
    assert (found[3].content.file_name, found[3].content.media, found[3].content.thumbnail, found[3].album) == ("a.pdf", "r1", "t1", True)
    assert (found[4].content.caption, found[4].content.media, found[4].album) == ("cap", "p1", False)
