"""Operators on small rows with results worked out by hand."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from strandline import schemas
from strandline.functions import links, parsing
from strandline.operators import checks, file_packing, graph, nulls, posts, queues, stats, tables
from strandline.plans import parameters
from strandline.sources import files
from strandline.streaming import loops

NOW = datetime(2024, 1, 31)


def values(spark, rows, function, schema="a string, b string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(function).collect()]


@pytest.mark.parametrize(
    ("name", "fault"),
    [
        ("testchannel", None), ("test_channel", None), ("channel123", None), ("abcde", None), ("a" * 32, None), ("abcd", "too_short"), ("a", "too_short"), ("", "too_short"), ("a" * 33, "too_long"),
        ("1channel", "invalid_start_char"), ("_channel", "invalid_start_char"), ("échannel", "invalid_start_char"), ("channel_", "ends_with_underscore"), ("test channel", "invalid_char"), ("test-channel", "invalid_char"),
        ("test.channel", "invalid_char"), ("téstchannel", "invalid_char"), ("usr/local", "invalid_char"), ("home~user", "invalid_char"), ("channel\n", "invalid_char"), ("some_bot", "bot_suffix"), ("SomeBot", "bot_suffix"), ("SomeRobot", "bot_suffix"),
    ],
)
def test_username_fault(spark, name, fault):
    assert values(spark, [(name, "")], links.username_fault(F.col("a"))) == [fault]


def test_message_links(spark):
    kind = "text string, entities array<struct<offset:int,length:int,type:string,url:string>>"
    rows = [
        ("Привет @testchan", [(7, 9, "mention", None)]), ("😀 @testchan", [(3, 9, "mention", None)]), ("مرحبا @testchan", [(6, 9, "mention", None)]),
        ("t.me/joinchat/x t.me/share t.me/proxy", []), ("@onechan t.me/OneChan https://t.me/onechan", [(0, 8, "mention", None), (9, 12, "url", None)]),
        ("look here", [(5, 4, "text_url", "https://t.me/hidden_one")]), (None, None), ("", []),
    ]
    found = values(spark, rows, links.message_links(F.col("text"), F.col("entities")), kind)
    assert [[tuple(x) for x in f] for f in found] == [[("testchan", "mention")]] * 3 + [[], [("onechan", "mention")], [("hidden_one", "text_url")], [], []]


def test_verdicts_durations_and_errors(spark):
    assert values(spark, [(x, "") for x in ("PT1H2M3S", "P1DT1S", "P1W", "", "P0D", "PT1.5S", "PT5M\n")], parsing.duration_seconds(F.col("a"))) == [3723, 86401, None, None, None, None, None]
    waits = values(spark, [(x, "") for x in ("FLOOD_WAIT_72560", "retry after 72560", "FLOOD_WAIT_", "nothing", None)], parsing.flood_wait(F.col("a")))
    assert [tuple(w) for w in waits] == [(72560, True), (72560, True), (0, True), (0, False), (0, False)]
    assert values(spark, [(x, "") for x in ("[400] x", "400 USERNAME_INVALID", "no messages found in the chat", "404", None)], parsing.permanent_error(F.col("a"))) == [True, True, True, False, False]
    times = values(spark, [("2024-01-02T03:04:05Z", ""), ("1704164645.0", ""), ("x", "")], parsing.stored_time(F.col("a")))
    assert times[0] == times[1] and times[2] is None
    assert values(spark, [("x", "y")], parsing.letter_prefix(F.col("a"), F.col("b")))[0].isalpha()


def test_upsert_keeps_other_columns_and_update_ignores_new_keys(spark):
    old = spark.createDataFrame([("a", 1, 10), ("b", 2, 20)], "k string, x int, y int")
    new = spark.createDataFrame([("b", 5), ("c", 6), (None, 7)], "k string, x int")
    assert sorted(map(tuple, tables.upsert(old, new, ["k"]).collect()), key=str) == [("a", 1, 10), ("b", 5, 20), ("c", 6, None), (None, 7, None)]
    assert sorted(map(tuple, tables.update_by_key(old, new, ["k"]).collect())) == [("a", 1, 10), ("b", 5, 20)]
    assert tables.delete(old, F.lit(None).cast("boolean")).count() == 2


def test_claims_are_disjoint_and_first_come(spark):
    t = lambda s: datetime(2024, 1, 1) + timedelta(seconds=s)
    rows = [(k, "b1", "c", f"chan{k}", "s", "q", t(9 - k), "url", "pending", None, None) for k in range(9)]
    edges = spark.createDataFrame(rows, schemas.PENDING_EDGES)
    first, after = queues.claim_edges(edges, 4, F.lit(NOW))
    second, _ = queues.claim_edges(after, 4, F.lit(NOW))
    a, b = ({r.pending_id for r in x.collect()} for x in (first, second))
    assert a == {8, 7, 6, 5} and not a & b


def batch(k, status, attempts, at, claimed=None):
    return (f"b{k}", "c", "src", "p", 0, "q", status, attempts, NOW - timedelta(minutes=at), None, claimed, None)


def test_oldest_ready_batch(spark):
    batches = spark.createDataFrame([batch(1, "closed", 0, 30), batch(2, "closed", 3, 90), batch(3, "closed", 0, 60), batch(4, "open", 0, 99), batch(5, "closed", 1, 20)], schemas.BATCHES)
    edge = lambda k, b, s: (k, b, "c", "d", "s", "q", NOW, "url", s, None, None)
    edges = spark.createDataFrame([edge(1, "b3", "validating"), edge(2, "b1", "valid"), edge(3, "b1", "duplicate")], schemas.PENDING_EDGES)
    claimed, mine, after = queues.claim_batch(batches, edges, F.lit(NOW))
    assert [(r.batch_id, r.attempt_count) for r in claimed.collect()] == [("b1", 1)] and mine.count() == 2
    assert {r.batch_id: r.status for r in after.collect()}["b1"] == "processing"
    assert queues.claim_batch(batches.filter("batch_id = 'b3'"), edges, F.lit(NOW))[0].collect() == []


def test_leases(spark):
    batches = spark.createDataFrame([batch(1, "processing", 1, 60, NOW - timedelta(minutes=11)), batch(2, "processing", 3, 60, NOW - timedelta(minutes=11)), batch(3, "processing", 1, 60, NOW - timedelta(minutes=9))], schemas.BATCHES)
    after, poison = queues.recover_batches(batches, F.lit(NOW), 10)
    assert sorted((r.batch_id, r.status) for r in after.collect()) == [("b1", "closed"), ("b2", "processing"), ("b3", "processing")]
    assert [r.batch_id for r in poison.collect()] == ["b2"]


def test_batch_statistics_merge(spark):
    edge = lambda k, kind, s: (k, "b", "c", "d", "s", "q", NOW, kind, s, None, None)
    rows = [edge(1, "mention", "valid"), edge(2, "mention", "invalid"), edge(3, "mention", "valid"), edge(4, "url", "not_channel"), edge(5, "", "duplicate"), edge(6, "url", "odd")]
    edges = spark.createDataFrame(rows, schemas.PENDING_EDGES)
    old = spark.createDataFrame([("c", "url", 10, 1, 1, 1, 1)], schemas.SOURCE_STATS)
    merged, left = queues.flush_batch(old, edges, "b")
    assert {r.source_type: tuple(r)[2:] for r in merged.collect()} == {"mention": (3, 2, 0, 1, 0), "url": (12, 1, 2, 1, 1), "unknown": (1, 0, 0, 0, 1)}
    assert left.count() == 0


def walk_input(spark):
    batches = spark.createDataFrame([("b1", "c", "src", "p1", 0, "q1"), ("b2", "c", "src", "p2", 3, "q2")], "batch_id string, crawl_id string, source_channel string, source_page_id string, source_depth int, sequence_id string")
    valid = spark.createDataFrame([("b2", "chan_a"), ("b2", "chan_b")], "batch_id string, channel string")
    known = spark.createDataFrame([("src",), ("chan_a",), ("chan_b",), ("other",)], "channel string")
    return batches, valid, known


def test_walk_step(spark):
    batches, valid, known = walk_input(spark)
    pages, edges = graph.walk_step(batches, valid, known, 0, "seed")
    found = {r.parent_id: r for r in pages.collect()}
    assert found["p1"].url in ("other", "chan_a", "chan_b") and found["p1"].depth == 1 and found["p1"].sequence_id != "q1"
    assert found["p2"].url in ("chan_a", "chan_b") and found["p2"].depth == 4 and found["p2"].sequence_id == "q2"
    rows = edges.collect()
    assert sorted((r.sequence_id, r.walkback, r.skipped) for r in rows) == [("q1", True, False), ("q2", False, False), ("q2", False, True)]
    pages, edges = graph.walk_step(batches, valid, known, 100, "seed")
    assert {r.parent_id: r.url for r in pages.collect()}["p2"] == "other"
    assert edges.filter("skipped").count() == 2 and edges.filter("NOT skipped AND walkback").count() == 2
    pages, _ = graph.walk_step(batches, valid, known.filter("channel <> 'other'"), 100, "seed")
    assert {r.parent_id for r in pages.collect()} == {"p1"}  # b2 may go nowhere
    pages, _ = graph.walk_step(batches, valid, known.limit(0), 0, "seed")
    assert {r.parent_id for r in pages.collect()} == {"p2"}


def test_replacement(spark):
    edges = spark.createDataFrame([(1, "bad", "src", False, False, NOW, "c", "q"), (2, "spare", "src", False, True, NOW, "c", "q"), (3, "back", "src", True, False, NOW, "c", "q"), (4, "lonely", "alone", False, False, NOW, "c", "q")], schemas.EDGES)
    seeds = spark.createDataFrame([("seed1",), ("seed2",)], "channel_username string")
    failed = spark.createDataFrame([("p1", "bad", "q"), ("p2", "back", "q"), ("p3", "lonely", "q"), ("p4", "seed1", "q"), ("p5", "unknown", "q")], "page_id string, url string, sequence_id string")
    found = {r.page_id: (r.action, r.channel) for r in graph.replacement(failed, edges, seeds, "x").collect()}
    assert found == {"p1": ("promote", "spare"), "p2": ("walkback", None), "p3": ("walkback", None), "p4": ("seed", "seed2"), "p5": ("walkback", None)}


def test_seed_draw_and_layers(spark):
    seeds = spark.createDataFrame([(f"s{k}",) for k in range(10)], "channel_username string")
    drawn = graph.draw_seeds(seeds, 4, "x").collect()
    assert len({r.url for r in drawn}) == len({r.sequence_id for r in drawn}) == 4
    for n in (0, 11):
        with pytest.raises(ValueError, match="seed size"):
            graph.draw_seeds(seeds, n, "x")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("b", "d"), ("d", "e")], "source string, destination string")
    roots = spark.createDataFrame([("a",)], "channel string")
    assert {r.channel: r.depth for r in graph.layers(edges, roots).collect()} == {"a": 0, "b": 1, "c": 2, "d": 2, "e": 3}
    assert {r.channel for r in graph.layers(edges, roots, 1).collect()} == {"a", "b"}
    sizes = spark.createDataFrame([("b", 11), ("c", 10), ("d", 99), ("e", 5)], "channel string, video_count int")
    assert {r.channel for r in graph.snowball(edges, roots, sizes).collect()} == {"a", "b", "d"}


def test_packing_rules(spark):
    sizes = [40, 70, 50, 10, 120, 90]
    df = spark.createDataFrame(list(enumerate(sizes)), "i int, size int")
    found = [r.bin for r in file_packing.pack(df, ["i"], "size", 100, 110).orderBy("i").collect()]
    assert found == [0, 0, 1, 1, None, 2]
    found = [r.bin for r in file_packing.pack(df, ["i"], "size", None, 110).orderBy("i").collect()]
    assert found == [0, 0, 1, 1, None, 2]
    assert file_packing.pack(df.limit(0), ["i"], "size", 100, 110).collect() == []


def test_null_rules(spark):
    schema = schemas.struct(schemas.POST)
    empty = spark.createDataFrame([tuple(None for _ in schema)], schema)
    row = nulls.validate(empty, nulls.merged_rules("telegram")).first()
    assert not row.valid and len(row.errors) == 9 and "post_link" in {e.path for e in row["events"]}
    rules = {"like_count": ("log", "m"), "is_ad": ("log", "m"), "description": ("critical", "m"), "outlinks": ("unavailable", "m"), "video_length": ("log", "m")}
    zero = empty.withColumns({"like_count": F.lit(0).cast("bigint"), "is_ad": F.lit(False), "description": F.lit(""), "outlinks": F.array().cast("array<string>"), "video_length": F.lit(0)})
    row = nulls.validate(zero, rules).first()
    assert [e.path for e in row["events"]] == ["is_ad", "like_count", "description", "outlinks"] or {e.path for e in row["events"]} == {"is_ad", "like_count", "description", "outlinks"}
    assert nulls.merged_rules("youtube", {"url": ("log", "x")})["url"] == ("log", "x")
    assert nulls.message("post_link", "critical", "youtube") == "post_link is required"
    with pytest.raises(ValueError, match="unknown platform"):
        nulls.default_rules("other")


def test_resample_resume_and_dead_ends(spark):
    old = spark.createDataFrame([(1, 1, "fetched"), (1, 2, "new"), (1, 3, "new")], "chat_id int, message_id int, status string")
    found = old.filter("message_id <= 2")
    assert {r.message_id: r.status for r in stats.mark_resample(old, found, ["chat_id", "message_id"]).collect()} == {1: "fetched", 2: "resample", 3: "deleted"}
    pages = spark.createDataFrame([("a", "fetched", [(1, 1, "x", "a")]), ("b", "error", [])], "id string, status string, messages array<struct<chat_id:bigint,message_id:bigint,status:string,page_id:string>>")
    assert {r.id: (r.status, r.messages) for r in stats.resume(pages, True).collect()} == {"a": ("fetched", []), "b": ("unfetched", [])}
    dead = values(spark, [("", "")], F.array(stats.dead_end(F.lit(True), F.lit(3), F.lit(5), 10, False), stats.dead_end(F.lit(True), F.lit(3), F.lit(5), 10, True), stats.dead_end(F.lit(None).cast("boolean"), F.lit(3), F.lit(50), 10, False)))
    assert dead == [[True, False, True]]


def test_checks(spark):
    rows = spark.createDataFrame([("1", "u", 0, "telegram"), ("", "u", 0, "telegram"), ("1", None, 0, "telegram"), ("1", "u", None, "telegram"), ("1", "u", 1, "x")], "id string, url string, depth int, platform string")
    good, bad = checks.split(rows, checks.work_item_fault())
    assert good.count() == 1 and sorted(r.fault for r in bad.collect()) == ["bad_depth", "bad_id", "bad_platform", "bad_url"]
    status = spark.createDataFrame([("w", "idle"), ("", "idle"), ("w", "odd")], "worker_id string, status string")
    assert [r[0] for r in status.select(checks.status_fault()).collect()] == [None, "bad_worker", "bad_status"]
    result = spark.createDataFrame([("i", "w", "success"), ("i", "w", "?")], "work_item_id string, worker_id string, status string")
    assert [r[0] for r in result.select(checks.result_fault()).collect()] == [None, "bad_status"]


def test_parameters():
    assert parameters.relative_time("1m", datetime(2023, 3, 31)) == datetime(2023, 3, 3)
    assert parameters.relative_time("30d", NOW) == NOW - timedelta(days=30) and parameters.relative_time("1y", NOW) == datetime(2023, 1, 31)
    assert parameters.duration("48h30m") == timedelta(hours=48.5)
    assert parameters.date_range("2024-01-01,2024-02-01")[1] == datetime(2024, 2, 1)
    for text in ("30", "d", "1x"):
        with pytest.raises(ValueError):
            parameters.relative_time(text, NOW)
    with pytest.raises(ValueError):
        parameters.date_range("2024-02-01,2024-01-01")
    a, b, c, d = (NOW - timedelta(days=k) for k in range(4))
    assert parameters.date_window(NOW, (b, a), c, d) == (b, a) and parameters.date_window(NOW, (None, a), c, d) == (c, NOW)
    assert parameters.date_window(NOW, min_date=d) == (d, NOW) and parameters.date_window(NOW) == (None, NOW)
    parameters.validate_sampling("telegram", "channel", urls=1)
    parameters.validate_sampling("telegram", "random-walk", seed_size=3, crawl_id="c")
    parameters.validate_sampling("youtube", "random", sample_size=5)
    for bad in (("x", "channel", 1), ("telegram", "random"), ("telegram", "channel"), ("youtube", "random-walk"), ("youtube", "random")):
        with pytest.raises(ValueError):
            parameters.validate_sampling(*bad)
    settings = parameters.CrawlSettings(concurrency=3).overlaid({"concurrency": 0, "max_depth": 2, "crawl_label": ""})
    assert (settings.concurrency, settings.max_depth) == (3, 2)
    assert [parameters.job_kind(n, t) for n, t in (("scheduled-crawl-1", ""), ("crawl", ""), ("maintenance-x", ""), ("other", "Crawl it"), ("crawler", ""))] == ["crawl", "crawl", "maintenance", "crawl", "generic"]
    assert parameters.batch_size(10, 0.5) == 21 and parameters.batch_size(1000, 0.1) == 50 and parameters.batch_size(0, 0.5) == 5
    assert parameters.quota_rounds([30, 80, 80], 100) == (3, 100)
    with pytest.raises(ValueError):
        parameters.validate_mode("worker")
    parameters.validate_mode("worker", "w1")


def test_files_round_trip(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# list\n https://t.me/Chan_One \n\n@two_two\n")
    assert [r[0] for r in files.read_seeds(spark, str(tmp_path / "seeds.txt")).collect()] == ["chan_one", "two_two"]
    (tmp_path / "seeds.csv").write_text("channel_username,chat_id,last_crawled_at,invalidated_at,member_count,inserted_at\nabc,1,,,5,\n")
    assert files.load_seed_csv(spark, str(tmp_path / "seeds.csv")).first().chat_id == 1
    rows = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], "id string, channel_id string, text string")
    files.write_json(rows, str(tmp_path / "posts"), "channel_id")
    assert files.read_messages(spark, str(tmp_path / "posts")).count() == 2
    with pytest.raises(ValueError, match="no pages"):
        files.write_export(rows.limit(0), str(tmp_path / "none"))
    files.write_export(rows, str(tmp_path / "export"), 1)
    watch = tmp_path / "watch"
    watch.mkdir()
    for k, n in enumerate((40, 70, 50)):
        (watch / f"f{k}.jsonl").write_text("x" * (n - 1) + "\n")
    listed = files.manifest(spark, str(watch))
    packed = file_packing.pack(listed, ["path"], "size", 100, 110)
    files.combine(spark, str(watch), packed.select("path", "bin"), str(tmp_path / "combined"))
    for d in (tmp_path / "combined").glob("bin=*"):
        lines = "".join(f.read_text() for f in sorted(d.glob("part-*"))).splitlines()
        assert lines in (["x" * 39, "x" * 69], ["x" * 49])
    sizes = sorted(sum(f.stat().st_size for f in d.glob("part-*")) for d in (tmp_path / "combined").glob("bin=*"))
    assert sizes == [50, 110]
    post = posts.generic_posts(spark.createDataFrame([("1", "c", "s", "n", "t", None, None, NOW, 3, {}, {}, 0, "en", None, "text")], schemas.RAW_MESSAGES), F.lit(NOW)).withColumn("platform_name", F.lit("x"))
    files.write_posts(post, str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).filter("day = '2024-01-31'").count() == 1
    for version in (0, 1):
        files.write_snapshot(rows.limit(version + 1), str(tmp_path / "state"), version)
    assert files.read_snapshot(spark, str(tmp_path / "state")).count() == 2


def test_streamed_first_discoveries_equal_the_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "channel string, n int"
    for k, rows in enumerate(([("a", 3), ("b", 1)], [("a", 1), ("c", 2)], [("c", 0), ("d", 9)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(tmp_path / f"in/{k}"))
    stream = loops.file_stream(spark, str(tmp_path / "in/*"), schema, most_files=1)
    loops.first_discoveries(spark, stream, str(tmp_path / "state"), str(tmp_path / "check"), "channel", ["n"])
    found = loops.discoveries(spark, str(tmp_path / "state")).collect()
    assert sorted(r.batch for r in found) == sorted({"a": 0, "b": 0, "c": 1, "d": 2}.values())
    assert {r.channel for r in found} == {"a", "b", "c", "d"} and len(found) == 4
    # a restart goes on with what it knows
    spark.createDataFrame([("e", 1), ("a", 0), ("e", 0)], schema).coalesce(1).write.json(str(tmp_path / "in/9"))
    stream = loops.file_stream(spark, str(tmp_path / "in/*"), schema, most_files=1)
    loops.first_discoveries(spark, stream, str(tmp_path / "state"), str(tmp_path / "check"), "channel", ["n"])
    found = loops.discoveries(spark, str(tmp_path / "state")).filter("batch > 2").collect()
    assert [(r.channel, r.n) for r in found] == [("e", 0)]


def test_validation_loop_and_topics(spark, tmp_path):
    rows = spark.createDataFrame([("w1", "idle", NOW), ("w1", "busy", NOW + timedelta(minutes=1)), ("w2", "idle", NOW)], "worker_id string, status string, timestamp timestamp")
    loops.publish(rows).write.text(str(tmp_path / "topic"))
    lines = spark.readStream.text(str(tmp_path / "topic"))
    loops.validation_loop(spark, loops.topic(lines, schemas.WORKER_STATUS), str(tmp_path / "check"), lambda df, _: loops.heartbeats(df), str(tmp_path / "out"))
    found = {r.worker_id: r.status for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {"w1": "busy", "w2": "idle"}


def test_blocked_state(spark, tmp_path):
    outcomes = ["blocked"] * 4 + ["transient"] + ["blocked"] * 2 + ["definitive", "blocked"]
    rows = [("v", NOW + timedelta(seconds=k), o) for k, o in enumerate(outcomes)]
    df = spark.createDataFrame(rows, "validator string, at timestamp, outcome string")
    row = queues.blocked_state(df, ["validator"], ["at"]).first()
    assert (row.counter, row.blocked_at) == (1, 7)
    df.write.parquet(str(tmp_path / "in"))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = loops.blocked_events(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.event) for r in spark.read.parquet(str(tmp_path / "out")).orderBy("at").collect()] == ["paused", "resumed"]


def test_walkback_draws_are_uniform_and_run_out(spark):
    known = spark.range(20).select(F.concat(F.lit("chan"), F.col("id").cast("string")).alias("channel"))
    batches = spark.range(4000).select(F.concat(F.lit("b"), F.col("id").cast("string")).alias("batch_id"), F.lit("chan0").alias("source_channel"))
    none = spark.createDataFrame([], "batch_id string, channel string")
    counts = {r.back: r["count"] for r in graph.walkback_targets(batches, none, known, "s").groupBy("back").count().collect()}
    assert len(counts) == 19 and "chan0" not in counts and max(counts.values()) < 1.4 * min(counts.values())
    new = batches.join(known.filter("channel <> 'chan7'")).select("batch_id", "channel")
    found = graph.walkback_targets(batches, new, known, "s")
    assert {r.back for r in found.select("back").distinct().collect()} == {"chan7"}
    assert abs(found.count() / 4000 - (1 - 0.95**10)) < 0.03  # the others have drawn ten channels that they may not go to
