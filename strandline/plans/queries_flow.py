"""Queries over flows: scans, joins, layers, walks, packing, statistics and workers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import file_packing, graph, posts, queues, stats, tables
from ..sources import files
from .catalogue import NOW, Tables, now, query

_SINCE, _UNTIL = "TIMESTAMP '2024-01-05 00:00:00'", "TIMESTAMP '2024-01-25 00:00:00'"


def _ntz(sql: str):
    return F.expr(f"CAST({sql} AS TIMESTAMP_NTZ)")


@query(f"SELECT message_id FROM (SELECT *, row_number() OVER (PARTITION BY chat_id ORDER BY ts DESC, message_id) AS n FROM v_messages WHERE ts >= {_SINCE} AND ts <= {_UNTIL}) WHERE n <= 10")
def b04_topk_window(t: Tables) -> DataFrame:
    rows = t.messages.select("message_id", "chat_id", "ts")
    return files.scan_history(rows, "ts", ["chat_id"], _ntz(_SINCE), _ntz(_UNTIL), 10).select("message_id")


@query(f"SELECT message_id FROM v_messages WHERE ts >= {_SINCE}")
def b05_scan_since(t: Tables) -> DataFrame:
    return files.scan_history(t.messages, "ts", ["chat_id"], _ntz(_SINCE)).select("message_id")


@query(f"SELECT message_id FROM (SELECT * FROM v_messages ORDER BY ts DESC, message_id LIMIT 500) WHERE ts BETWEEN {_SINCE} AND TIMESTAMP '2024-01-30 00:00:00'")
def b06_newest_page(t: Tables) -> DataFrame:
    return files.newest_page(t.messages, "ts", [F.desc("ts"), F.col("message_id")], 500, _ntz(_SINCE), _ntz("TIMESTAMP '2024-01-30 00:00:00'")).select("message_id")


@query(f"SELECT number, likes FROM (SELECT v.*, row_number() OVER (PARTITION BY channel_id ORDER BY published_at DESC, number) AS n FROM v_videos v WHERE published_at BETWEEN {_SINCE} AND {_UNTIL}) LEFT JOIN (SELECT number AS m FROM v_videos WHERE number % 5 > 0) s ON m = number WHERE n <= 5 AND m IS NOT NULL UNION ALL SELECT number, NULL FROM (SELECT v.*, row_number() OVER (PARTITION BY channel_id ORDER BY published_at DESC, number) AS n FROM v_videos v WHERE published_at BETWEEN {_SINCE} AND {_UNTIL}) WHERE n <= 5 AND number % 5 = 0")
def b07_playlist(t: Tables) -> DataFrame:
    statistics = t.videos.filter("number % 5 > 0").select("number", "likes")
    return files.playlist(t.videos.select("number", "channel_id", "published_at"), statistics, "published_at", F.expr(f"CAST({_SINCE} AS TIMESTAMP_NTZ)"), F.expr(f"CAST({_UNTIL} AS TIMESTAMP_NTZ)"), "number", 5).select("number", "likes")


@query("SELECT number, CASE WHEN number % 2 = 0 THEN 'en' WHEN number % 3 = 0 THEN 'de' END AS language FROM v_videos WHERE number % 7 = 0 AND number % 5 <> 0")
def b08_by_ids(t: Tables) -> DataFrame:
    n = F.col("number")
    rows = t.videos.select("number", F.when(n % 5 != 0, "2024-01-02T03:04:05Z").otherwise("soon").alias("when"), F.when(n % 2 == 0, "en").otherwise("").alias("default"), F.when(n % 3 == 0, "de").alias("audio"))
    return files.by_ids(rows, t.videos.filter("number % 7 = 0").select("number"), "number", "when", ("default", "audio")).select("number", "language")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey")
def b09_lookup(t: Tables) -> DataFrame:
    rows = t.read("customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("string")).otherwise(F.concat(F.lit("@"), F.col("c_nationkey").cast("string"))).alias("reference"))
    channels = t.read("nation").select(F.col("n_nationkey").cast("string").alias("id"), F.concat(F.lit("@"), F.col("n_nationkey").cast("string")).alias("handle"), "n_name")
    return files.lookup(rows, channels, ("id", "handle")).select("c_custkey", "found.n_name")


@query("SELECT conv_id, count(*)::BIGINT AS n, md5(string_agg(text, '|' ORDER BY turn)) AS texts FROM conversations WHERE turn IN (SELECT c.turn FROM conversations c WHERE c.conv_id = conversations.conv_id ORDER BY c.turn LIMIT 3) GROUP BY conv_id")
def b10_capped_comments(t: Tables) -> DataFrame:
    rows = posts.first_comments(t.read("conversations"), ["conv_id"], ["turn"], "text", 3)
    return rows.select("conv_id", F.size("comments").cast("bigint").alias("n"), F.md5(F.array_join("comments", "|")).alias("texts"))


@query("SELECT CAST(user_id AS STRING) AS channel_id, count(*)::BIGINT AS n FROM events GROUP BY user_id")
def b11_jsonl_round_trip(t: Tables) -> DataFrame:
    rows = t.read("events").select(F.col("event_id").cast("string").alias("id"), F.col("user_id").cast("string").alias("channel_id"), F.col("event_type").alias("type"))
    text = rows.select(F.to_json(F.struct("id", "channel_id", "type")).alias("value"))
    from ..schemas import RAW_MESSAGES
    from ..streaming.loops import topic

    return topic(text, RAW_MESSAGES).groupBy("channel_id").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN event_id % 2 = 0 THEN 'mine' ELSE 'own' END AS crawl_label, count(*)::BIGINT AS n FROM events GROUP BY 1")
def b12_stored_posts(t: Tables) -> DataFrame:
    rows = t.read("events").select("event_id", F.when(F.col("event_id") % 2 == 0, "").otherwise("own").alias("crawl_label"))
    kept = posts.stored_posts(rows, "channel", "mine").unionByName(posts.stored_posts(rows, "random-walk", "mine"))
    return kept.groupBy("crawl_label").agg(F.count("*").alias("n"))


@query("SELECT doc_id, floor(coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 100000)::BIGINT AS part FROM documents")
def b14_export_parts(t: Tables) -> DataFrame:
    return files.export_parts(t.read("documents"), "n_chars", "doc_id", 100_000).select("doc_id", "part")


@query(f"SELECT number FROM v_videos WHERE size <= 40 AND number NOT IN (SELECT number FROM v_videos WHERE number % 3 = 0 AND published_at >= {NOW} - INTERVAL 20 DAY)")
def b15_media_filter(t: Tables) -> DataFrame:
    media = t.videos.select("number", F.col("number").alias("media_id"), "size")
    seen = t.videos.filter("number % 3 = 0").select(F.col("number").alias("media_id"), F.col("published_at").alias("first_seen"))
    return file_packing.media_to_store(media, seen, now(), 40, 20).select("number")


def _fold(trigger: str) -> str:
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, n_chars AS s, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
    f AS (SELECT 0::BIGINT AS i, 0::BIGINT AS total, 0 AS bin, NULL::BIGINT AS doc_id, NULL::INT AS mine
      UNION ALL SELECT d.i,
        CASE WHEN s > 30000 THEN total WHEN (CASE WHEN total > 0 AND total + s > 30000 THEN s ELSE total + s END) >= {trigger} THEN 0 WHEN total > 0 AND total + s > 30000 THEN s ELSE total + s END,
        CASE WHEN s > 30000 THEN bin ELSE bin + CASE WHEN total > 0 AND total + s > 30000 THEN 1 ELSE 0 END + CASE WHEN (CASE WHEN total > 0 AND total + s > 30000 THEN s ELSE total + s END) >= {trigger} THEN 1 ELSE 0 END END,
        d.doc_id, CASE WHEN s <= 30000 THEN bin + CASE WHEN total > 0 AND total + s > 30000 THEN 1 ELSE 0 END END
      FROM f JOIN d ON d.i = f.i + 1)
    SELECT doc_id, mine AS bin FROM f WHERE doc_id IS NOT NULL"""


@query(_fold("20000"))
def b16_pack_files(t: Tables) -> DataFrame:
    return file_packing.pack(t.read("documents"), ["doc_id"], "n_chars", 20_000, 30_000).select("doc_id", "bin")


@query(_fold("9000000000"))
def b20_pack_leftovers(t: Tables) -> DataFrame:
    return file_packing.pack(t.read("documents"), ["doc_id"], "n_chars", None, 30_000).select("doc_id", "bin")


@query(f"SELECT event_id FROM events WHERE ts < {NOW} - INTERVAL 14 DAY")
def b21_stale_files(t: Tables) -> DataFrame:
    return file_packing.stale_files(t.read("events").withColumnRenamed("ts", "mtime"), now(), 14).select("event_id")


@query("SELECT page_id, status FROM v_pages WHERE page_id IN (SELECT concat('p', CAST(c_custkey * 3 AS STRING)) FROM customer)")
def b23_by_keys(t: Tables) -> DataFrame:
    keys = t.read("customer").select(F.concat(F.lit("p"), (F.col("c_custkey") * 3).cast("string")).alias("page_id"))
    return files.by_keys(t.pages, keys, "page_id").select("page_id", "status")


@query("SELECT page_id AS id, url, depth FROM v_pages")
def b24_topic_round_trip(t: Tables) -> DataFrame:
    from ..schemas import WORK_ITEMS
    from ..streaming.loops import publish, topic

    rows = t.pages.select(F.col("page_id").alias("id"), "url", "depth")
    return topic(publish(rows), WORK_ITEMS).select("id", "url", "depth")


@query("SELECT message_id FROM v_messages WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = message_id AND o_custkey % 150 = chat_id % 150)")
def e01_new_rows(t: Tables) -> DataFrame:
    known = t.messages.join(t.read("orders"), F.col("o_orderkey") == F.col("message_id")).filter("o_custkey % 150 = chat_id % 150").select("chat_id", "message_id")
    return tables.new_rows(t.messages, known, ["chat_id", "message_id"]).select("message_id")


@query("SELECT message_id, CASE WHEN status = 'fetched' THEN 'fetched' WHEN message_id % 3 = 0 THEN 'resample' ELSE 'deleted' END AS status FROM v_messages")
def e02_resample(t: Tables) -> DataFrame:
    found = t.messages.filter("message_id % 3 = 0").select("chat_id", "message_id")
    return stats.mark_resample(t.messages, found, ["chat_id", "message_id"]).select("message_id", "status")


@query("SELECT url, page_id FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS n FROM v_pages) WHERE n = 1")
def e03_next_layer(t: Tables) -> DataFrame:
    return graph.next_layer(t.pages, "url", ["page_id"]).select("url", "page_id")


@query("SELECT DISTINCT url, depth FROM v_pages")
def e04_layer_duplicates(t: Tables) -> DataFrame:
    return graph.without_layer_duplicates(t.pages.select("url", "depth", "page_id"), ["page_id"]).select("url", "depth")


@query("""
    WITH n AS (SELECT url, min(page_id) AS page_id FROM v_pages WHERE url NOT IN (SELECT concat('chan', CAST(c_custkey AS STRING)) FROM customer WHERE c_custkey % 2 = 0) GROUP BY url)
    SELECT url, page_id FROM n ORDER BY page_id, url LIMIT 100""")
def e05_add_layer(t: Tables) -> DataFrame:
    known = t.read("customer").filter("c_custkey % 2 = 0").select(F.concat(F.lit("chan"), F.col("c_custkey").cast("string")).alias("url"))
    return graph.add_layer(known, t.pages, "url", ["page_id"], 300, 200, 7).select("url", "page_id")


@query("SELECT url, min(page_id) AS page_id FROM v_pages WHERE url NOT IN (SELECT concat('chan', CAST(c_custkey AS STRING)) FROM customer WHERE c_custkey % 2 = 0) GROUP BY url ORDER BY page_id LIMIT 7")
def e05_dead_end_slots(t: Tables) -> DataFrame:
    known = t.read("customer").filter("c_custkey % 2 = 0").select(F.concat(F.lit("chan"), F.col("c_custkey").cast("string")).alias("url"))
    return graph.add_layer(known, t.pages, "url", ["page_id"], 300, 300, 7).select("url", "page_id")


@query("SELECT page_id FROM v_pages WHERE url NOT IN (SELECT concat('chan', CAST(c_custkey AS STRING)) FROM customer WHERE c_custkey % 2 = 0)")
def e06_unseen_pages(t: Tables) -> DataFrame:
    known = t.read("customer").filter("c_custkey % 2 = 0").select(F.concat(F.lit("chan"), F.col("c_custkey").cast("string")).alias("url"))
    return tables.new_rows_of_few(t.pages, known, ["url"]).select("page_id")


@query("SELECT 'some' AS run, n_name FROM nation WHERE n_nationkey >= 10 UNION ALL SELECT 'none', n_name FROM nation")
def e07_seed_filter(t: Tables) -> DataFrame:
    n = t.read("nation")
    some = graph.unseen_or_all(n, n.filter("n_nationkey < 10").select("n_nationkey"), "n_nationkey")
    none = graph.unseen_or_all(n, n.select("n_nationkey"), "n_nationkey")
    return some.select(F.lit("some").alias("run"), "n_name").union(none.select(F.lit("none").alias("run"), "n_name"))


@query("SELECT url, max_by(page_id, struct_pack(d := depth, p := page_id)) AS page_id FROM v_pages GROUP BY url")
def e08_url_cache(t: Tables) -> DataFrame:
    return graph.url_cache(t.pages)


@query("SELECT channel FROM (SELECT source_channel AS channel FROM v_edges UNION SELECT destination_channel FROM v_edges) ORDER BY md5(concat_ws(':', '5', channel)), channel LIMIT 1")
def e09_random_discovered(t: Tables) -> DataFrame:
    return tables.random_rows(graph.vertices(t.edges), 1, "5", "channel")


@query("SELECT batch_id, destination_channel, min(source_type) AS source_type FROM v_pending GROUP BY ALL")
def e10_batch_dedup(t: Tables) -> DataFrame:
    return tables.first_wins(t.pending.select("batch_id", "destination_channel", "source_type"), ["batch_id", "destination_channel"], ["source_type"])


@query("SELECT edge_id FROM v_edges WHERE source_channel <> destination_channel")
def e11_no_loops(t: Tables) -> DataFrame:
    return graph.without_loops(t.edges, "source_channel", "destination_channel").select("edge_id")


@query("SELECT number, CASE WHEN number % 4 > 0 THEN likes END AS likes FROM v_videos")
def e12_video_statistics(t: Tables) -> DataFrame:
    return posts.with_statistics(t.videos.select("number"), t.videos.filter("number % 4 > 0").select("number", "likes"), "number")


@query("SELECT number, CASE WHEN CAST(substring(channel_id, 3, 9) AS INT) % 2 = 0 THEN 'known' ELSE channel_id END AS channel_name FROM v_videos")
def e13_channel_fallback(t: Tables) -> DataFrame:
    known = t.videos.filter("substring(channel_id, 3, 9) % 2 = 0").select("channel_id").distinct().withColumn("name", F.lit("known"))
    return posts.with_channel_name(t.videos, known, "channel_id", "name").select("number", "channel_name")


@query("""
    WITH e AS (SELECT pending_id AS key, destination_channel AS channel, CAST(substring(destination_channel, 5, 9) AS INT) AS k, discovery_time FROM v_pending),
    w AS (SELECT channel, min_by(key, struct_pack(t := discovery_time, k := key)) AS winner FROM e WHERE k % 10 >= 2 AND k % 5 = 2 GROUP BY channel)
    SELECT key, e.channel, CASE WHEN k % 10 = 0 THEN 'invalid' WHEN k % 10 = 1 THEN 'duplicate' WHEN k % 5 = 2 THEN CASE WHEN key = winner THEN 'valid' ELSE 'duplicate' END WHEN k % 5 = 3 THEN 'not_channel' WHEN k % 5 = 4 THEN 'invalid' ELSE 'pending' END AS status,
      CASE WHEN k % 10 = 0 THEN 'cached_invalid' WHEN k % 10 > 1 AND k % 5 IN (3, 4) THEN 'seen' ELSE '' END AS reason
    FROM e LEFT JOIN w ON w.channel = e.channel""")
def e14_classify(t: Tables) -> DataFrame:
    edges = t.pending.select(F.col("pending_id").alias("key"), F.col("destination_channel").alias("channel"), "discovery_time")
    channels = edges.select("channel").distinct().withColumn("k", F.substring("channel", 5, 9).cast("int"))
    k = F.col("k") % 5
    verdicts = channels.select("channel", F.when(k == 2, "valid").when(k == 3, "not_channel").when(k == 4, "invalid").otherwise("blocked").alias("verdict"), F.lit("seen").alias("reason"))
    return graph.classify(edges, channels.filter("k % 10 = 0"), channels.filter("k % 10 = 1"), verdicts, ["discovery_time", "key"])


@query("""
    SELECT batch_id, concat('chan_', CAST(pending_id % 40 AS STRING)) AS destination_channel, min(CASE WHEN pending_id % 40 = 9 THEN 'chan_9' ELSE concat('source', CAST(pending_id % 7 AS STRING)) END) AS source_channel
    FROM v_pending WHERE pending_id % 40 NOT IN (7, 9) GROUP BY ALL""")
def e15_tandem_edges(t: Tables) -> DataFrame:
    n = (F.col("pending_id") % 40).cast("string")
    link = lambda name, kind: F.struct(name.alias("name"), F.lit(kind).alias("source_type"))
    source = F.when(F.col("pending_id") % 40 == 9, "chan_9").otherwise(F.concat(F.lit("source"), (F.col("pending_id") % 7).cast("string")))
    rows = t.pending.select("batch_id", source.alias("source_channel"), F.array(link(F.concat(F.lit("chan_"), n), "url"), link(F.lit("somebot"), "mention"), link(F.lit("abc"), "url")).alias("links"))
    invalid = t.spark.range(1).select(F.lit("chan_7").alias("channel_username"))
    return graph.tandem_edges(rows, invalid).select("batch_id", "destination_channel", "source_channel")


@query("SELECT page_id, concat('label', substring(crawl_id, 2)) AS crawl_label, job_id FROM v_pages JOIN (SELECT * FROM (VALUES ('j1', 'c1'), ('j2', 'c2'), ('j3', 'c1')) j(job_id, crawl)) ON crawl = crawl_id")
def e16_posts_of_jobs(t: Tables) -> DataFrame:
    jobs = t.spark.createDataFrame([("j1", "c1", "label1"), ("j2", "c2", "label2"), ("j3", "c1", "label1"), ("j4", "", "none"), ("j5", None, "none")], "job_id string, crawl_id string, crawl_label string")
    rows = t.pages.select("page_id", "crawl_id", F.lit("").alias("crawl_label"))
    return posts.posts_of_jobs(jobs, rows, "crawl_id").select("page_id", "crawl_label", "job_id")


@query("SELECT depth, url, CASE WHEN CAST(substring(url, 5, 9) AS INT) % 2 = 0 THEN 'fetched' ELSE status END AS status, count(*)::BIGINT AS n FROM v_pages GROUP BY ALL")
def e17_match_results(t: Tables) -> DataFrame:
    results = t.pages.filter("substring(url, 5, 9) % 2 = 0").select("depth", "url").distinct().select("depth", "url", F.lit("fetched").alias("status"), F.lit("").alias("error"))
    return stats.match_results(t.pages.withColumn("error", F.lit("")), results).groupBy("depth", "url", "status").agg(F.count("*").alias("n"))


@query(f"SELECT number FROM v_videos WHERE number IN (SELECT number FROM v_videos WHERE published_at >= {NOW} - INTERVAL 30 DAY AND number % 2 = 0)")
def e18_media_seen(t: Tables) -> DataFrame:
    seen = t.videos.filter("number % 2 = 0").withColumnRenamed("published_at", "first_seen")
    return tables.known_rows(t.videos, seen.filter(F.col("first_seen") >= now() - F.expr("INTERVAL 30 DAYS")), ["number"]).select("number")


@query("SELECT chat_id, sum(coalesce(views, 0))::BIGINT AS total_views, count(*)::BIGINT AS messages FROM v_messages GROUP BY chat_id")
def f01_total_views(t: Tables) -> DataFrame:
    return stats.total_views(t.messages, ["chat_id"])


@query(f"SELECT chat_id, count(*)::BIGINT AS messages FROM v_messages WHERE ts BETWEEN {_SINCE} AND {_UNTIL} GROUP BY chat_id")
def f02_message_count(t: Tables) -> DataFrame:
    rows = files.scan_history(t.messages, "ts", ["chat_id"], _ntz(_SINCE), _ntz(_UNTIL))
    return stats.total_views(rows, ["chat_id"]).select("chat_id", "messages")


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_custkey WHEN 1 THEN 2 ELSE 0 END AS members FROM customer")
def f03_member_count(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 3
    kind = F.when(k == 0, "supergroup").when(k == 1, "basic").otherwise("private")
    return t.read("customer").select("c_custkey", stats.member_count(kind, F.col("c_custkey"), F.array(F.lit(1), F.lit(2))).cast("bigint").alias("members"))


@query("SELECT event_type, count(*) FILTER (WHERE value > 50) AS hits, count(*) FILTER (WHERE NOT value > 50) AS misses, floor(1000 * count(*) FILTER (WHERE value > 50) / count(*))::BIGINT AS hit_permille FROM events GROUP BY event_type")
def f04_hit_rate(t: Tables) -> DataFrame:
    return stats.hit_rates(t.read("events"), F.col("value") > 50, ["event_type"])


@query("SELECT count(*)::BIGINT AS processed, count(*) FILTER (WHERE status = 'fetched') AS fetched, count(*) FILTER (WHERE status = 'deleted') AS deleted, count(*) FILTER (WHERE status = 'failed') AS failed FROM v_messages")
def f05_run_counters(t: Tables) -> DataFrame:
    return stats.run_counters(t.messages)


@query("SELECT depth, status, count(*)::BIGINT AS n FROM v_pages GROUP BY ALL")
def f06_status_hist(t: Tables) -> DataFrame:
    return stats.status_histogram(t.pages)


@query("SELECT coalesce(max(depth), -1) AS max_depth FROM v_pages")
def f07_max_depth(t: Tables) -> DataFrame:
    return stats.max_depth(t.pages)


@query("SELECT count(*)::BIGINT AS pages, count(*) FILTER (WHERE status IN ('fetched', 'deadend')) AS done, count(*) FILTER (WHERE status = 'error') AS failed, floor(1000 * count(*) FILTER (WHERE status IN ('fetched', 'deadend')) / count(*))::BIGINT AS done_permille FROM v_pages")
def f08_progress(t: Tables) -> DataFrame:
    return stats.progress(t.pages)


@query("SELECT left(id, 5) AS prefix, count(*)::BIGINT AS total, count(*) FILTER (WHERE substring(id, 6, 1) = '-') AS matches, count(*) FILTER (WHERE substring(id, 6, 1) <> '-') AS misses FROM v_videos GROUP BY 1")
def f09_prefix_counts(t: Tables) -> DataFrame:
    return stats.prefix_counts(t.videos, F.left("id", F.lit(5)), F.substring("id", 6, 1) == "-")


@query("SELECT concat('x', CAST(o_orderkey AS STRING)) AS execution_id, o_orderkey % 2 = 0 AS has_work FROM orders WHERE o_orderkey % 3 = 1 AND o_orderstatus <> 'F' ORDER BY o_orderdate DESC, execution_id DESC LIMIT 1")
def f10_latest_open(t: Tables) -> DataFrame:
    o = t.read("orders")
    name = F.concat(F.lit("x"), F.col("o_orderkey").cast("string")).alias("execution_id")
    runs = o.select(name, F.concat(F.lit("c"), (F.col("o_orderkey") % 3).cast("string")).alias("crawl_id"), F.when(F.col("o_orderstatus") == "F", "completed").otherwise("running").alias("status"), F.col("o_orderdate").alias("started_at"))
    return stats.latest_open(runs, o.select(name, F.when(F.col("o_orderkey") % 2 == 0, "unfetched").otherwise("fetched").alias("status")), "c1")


@query("SELECT CASE WHEN channel_username = '' THEN NULL ELSE channel_username END AS url FROM (SELECT DISTINCT channel_username FROM v_seeds WHERE channel_username <> '') ORDER BY md5(concat_ws(':', '3', channel_username)), channel_username LIMIT 40")
def f12_seed_draw(t: Tables) -> DataFrame:
    return graph.draw_seeds(t.seeds.filter("channel_username <> ''"), 40, "3").select("url")


_WALK = """
    b AS (SELECT * FROM v_batches WHERE status = 'closed'), v AS (SELECT DISTINCT p.batch_id, destination_channel AS channel FROM v_pending p WHERE validation_status = 'valid'),
    n AS (SELECT batch_id, count(*) AS n FROM v GROUP BY batch_id),
    d AS (SELECT b.batch_id, coalesce(n, 0) AS n, ('0x' || substring(md5(concat_ws(':', '9', b.batch_id)), 1, 8))::BIGINT % 100 + 1 AS draw FROM b LEFT JOIN n ON n.batch_id = b.batch_id)"""


_TARGETS = _WALK + """,
    k AS (SELECT channel, row_number() OVER (ORDER BY md5(concat_ws(':', '9', channel)), channel) - 1 AS rank FROM (SELECT source_channel AS channel FROM v_edges UNION SELECT destination_channel FROM v_edges) WHERE channel IS NOT NULL),
    a AS (SELECT b.batch_id, b.source_channel, i, ('0x' || substring(md5(concat_ws(':', '9', 'back', b.batch_id, CAST(i AS STRING))), 1, 15))::BIGINT % (SELECT count(*) FROM k) AS rank FROM b, range(10) r(i)),
    c AS (SELECT a.batch_id, arg_min(k.channel, i) AS back FROM a JOIN k ON k.rank = a.rank WHERE k.channel <> a.source_channel AND NOT EXISTS (SELECT 1 FROM v WHERE v.batch_id = a.batch_id AND v.channel = k.channel) GROUP BY a.batch_id),
    w AS (SELECT batch_id, arg_min(channel, md5(concat_ws(':', '9', batch_id, channel))) AS forward FROM v GROUP BY batch_id),
    g AS (SELECT b.*, n = 0 OR 30 >= draw AS walkback, CASE WHEN n = 0 OR 30 >= draw THEN back ELSE forward END AS next FROM b JOIN d ON d.batch_id = b.batch_id LEFT JOIN c ON c.batch_id = b.batch_id LEFT JOIN w ON w.batch_id = b.batch_id)"""


@query(f"WITH {_TARGETS.strip()} SELECT batch_id, next AS back FROM g WHERE walkback AND next IS NOT NULL")
def f13_walkback_target(t: Tables) -> DataFrame:
    batches, valid, known = _walk_input(t)
    counted = valid.groupBy("batch_id").agg(F.count("*").alias("n"))
    draw = F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit("9"), "batch_id")), 1, 8), 16, 10).cast("bigint"), F.lit(100)) + 1
    back = batches.join(counted, "batch_id", "left").filter(F.col("n").isNull() | (F.lit(30) >= draw))
    return graph.walkback_targets(back, valid, known, "9")


@query(f"""WITH {_TARGETS.strip()} SELECT sha256(concat_ws(':', '9', 'page', batch_id)) AS page_id, source_page_id AS parent_id, (source_depth + 1)::INT AS depth, next AS url, crawl_id,
    CASE WHEN walkback THEN sha256(concat_ws(':', '9', 'sequence', batch_id)) ELSE sequence_id END AS sequence_id FROM g WHERE next IS NOT NULL""")
def f14_walk_step(t: Tables) -> DataFrame:
    return graph.walk_step(*_walk_input(t), 30, "9")[0].drop("batch_id")


@query(f"""WITH {_TARGETS.strip()} SELECT next AS destination_channel, source_channel, walkback, false AS skipped, crawl_id, sequence_id FROM g WHERE next IS NOT NULL
    UNION ALL SELECT v.channel, source_channel, false, true, crawl_id, sequence_id FROM g JOIN v ON v.batch_id = g.batch_id WHERE next IS NOT NULL AND (walkback OR v.channel <> next)""")
def f14_walk_edges(t: Tables) -> DataFrame:
    return graph.walk_step(*_walk_input(t), 30, "9")[1].drop("batch_id")


def _walk_input(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    valid = t.pending.filter("validation_status = 'valid'").select("batch_id", F.col("destination_channel").alias("channel")).distinct()
    return t.batches.filter("status = 'closed'"), valid, graph.vertices(t.edges)


@query("""
    WITH f AS (SELECT concat('p', CAST(event_id AS STRING)) AS page_id, concat('chan', CAST(event_id % 211 AS STRING)) AS url, concat('s', CAST(user_id % 10 AS STRING)) AS sequence_id FROM events WHERE event_id % 40 = 0),
    f2 AS (SELECT page_id, CASE WHEN CAST(substring(page_id, 2, 9) AS INT) % 120 = 0 THEN concat('chan', CAST(1 + CAST(substring(page_id, 2, 9) AS INT) % 7 + 300 AS STRING)) ELSE url END AS url, sequence_id FROM f),
    l AS (SELECT destination_channel AS url, sequence_id, source_channel, walkback FROM (SELECT *, row_number() OVER (PARTITION BY destination_channel, sequence_id ORDER BY edge_id) AS n FROM v_edges) WHERE n = 1),
    s AS (SELECT source_channel, sequence_id, arg_min(destination_channel, md5(concat_ws(':', '1', CAST(edge_id AS STRING)))) AS other FROM v_edges e WHERE skipped AND NOT EXISTS (SELECT 1 FROM f2 WHERE f2.url = e.destination_channel AND f2.sequence_id = e.sequence_id) GROUP BY ALL),
    o AS (SELECT channel_username AS seed, row_number() OVER (ORDER BY md5(concat_ws(':', '1', channel_username)), channel_username) - 1 AS rank FROM (SELECT DISTINCT channel_username FROM v_seeds WHERE channel_username <> '' AND channel_username NOT IN (SELECT url FROM f2))),
    r AS (SELECT page_id, other, CASE WHEN l.url IS NULL THEN CASE WHEN f2.url IN (SELECT channel_username FROM v_seeds) THEN 'seed' ELSE 'walkback' END WHEN walkback THEN 'walkback' WHEN s.source_channel IS NOT NULL THEN 'promote' ELSE 'walkback' END AS action
    FROM f2 LEFT JOIN l ON l.url = f2.url AND l.sequence_id = f2.sequence_id LEFT JOIN s ON s.source_channel = l.source_channel AND s.sequence_id = l.sequence_id)
    SELECT page_id, action, CASE action WHEN 'promote' THEN other WHEN 'seed' THEN seed END AS channel
    FROM r LEFT JOIN o ON rank = ('0x' || substring(md5(concat_ws(':', '1', 'seed', page_id)), 1, 15))::BIGINT % (SELECT count(*) FROM o)""")
def f15_replacement(t: Tables) -> DataFrame:
    n = F.col("edge_id")
    url = F.when(n % 120 == 0, F.concat(F.lit("chan"), (n % 7 + 301).cast("string"))).otherwise(F.col("destination_channel"))
    failed = t.edges.filter("edge_id % 40 = 0").select(F.concat(F.lit("p"), n.cast("string")).alias("page_id"), url.alias("url"), "sequence_id")
    return graph.replacement(failed, t.edges, t.seeds.filter("channel_username <> ''"), "1").select("page_id", "action", "channel")


@query("""
    WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, (o_custkey * 7 + o_orderkey % 3) % 1500 AS b FROM orders),
    r AS (SELECT 1::BIGINT AS channel, 0 AS depth UNION SELECT e.b, depth + 1 FROM r JOIN e ON e.a = r.channel WHERE depth < 4)
    SELECT channel, min(depth) AS depth FROM r GROUP BY channel""")
def f16_layers(t: Tables) -> DataFrame:
    edges = t.read("orders").select(F.col("o_custkey").alias("source"), ((F.col("o_custkey") * 7 + F.col("o_orderkey") % 3) % 1500).alias("destination")).distinct()
    return graph.layers(edges, t.spark.range(1, 2).withColumnRenamed("id", "channel"), 4)


@query("SELECT page_id FROM v_pages WHERE crawl_id = 'c1' AND page_id NOT IN (SELECT page_id FROM v_pages WHERE crawl_id = 'c1' ORDER BY depth, page_id LIMIT 50)")
def f17_frontier_step(t: Tables) -> DataFrame:
    return graph.remove_pages(t.pages.filter("crawl_id = 'c1'"), "c1", graph.pop(t.pages, "c1", 50)).select("page_id")


@query("""
    WITH RECURSIVE c AS (SELECT channel_id, CAST(substring(channel_id, 3) AS INT) AS k, count(*) AS n FROM v_videos GROUP BY 1, 2), e AS (SELECT k AS a, concat('UC', CAST((k * 7 + j) % 120 AS STRING)) AS b FROM c, range(3) r(j)),
    r AS (SELECT 'UC1' AS channel, 0 AS depth UNION SELECT e.b, depth + 1 FROM r JOIN e ON e.a = CAST(substring(r.channel, 3) AS INT) WHERE depth < 12 AND e.b IN (SELECT channel_id FROM c WHERE n > 10)),
    f AS (SELECT channel, min(depth) AS depth FROM r GROUP BY 1),
    v AS (SELECT number, channel_id, depth, published_at, row_number() OVER (PARTITION BY channel_id ORDER BY published_at DESC, number) AS i FROM v_videos JOIN f ON channel = channel_id)
    SELECT channel_id AS channel, number, depth FROM v WHERE i <= 5 ORDER BY depth, channel_id, published_at DESC, number LIMIT 90""")
def f18_snowball(t: Tables) -> DataFrame:
    videos = t.videos.withColumnRenamed("channel_id", "channel")
    sizes = videos.groupBy("channel").agg(F.count("*").alias("video_count"))
    k = F.substring("channel", 3, 9).cast("int")
    edges = sizes.select(F.col("channel").alias("source"), F.explode(F.array(*[F.concat(F.lit("UC"), ((k * 7 + j) % 120).cast("string")) for j in range(3)])).alias("destination"))
    found = graph.snowball(edges, t.spark.range(1).select(F.lit("UC1").alias("channel")), sizes)
    return graph.snowball_videos(found, videos, "published_at", "number", 5, 90).select("channel", "number", "depth")


@query("""
    WITH c AS (SELECT channel_id, count(*) AS n FROM v_videos GROUP BY 1), p AS (SELECT DISTINCT lower(substring(id, 1, 5)) AS prefix FROM v_videos WHERE number % 4 = 0),
    h AS (SELECT number, channel_id, prefix FROM v_videos JOIN p ON prefix = lower(substring(id, 1, 5)) WHERE length(id) = 11 AND substring(id, 6, 1) = '-'),
    q AS (SELECT prefix, channel_id, row_number() OVER (PARTITION BY prefix ORDER BY md5(concat_ws(':', '8', prefix, channel_id)), channel_id) AS i FROM (SELECT DISTINCT prefix, channel_id FROM h))
    SELECT number FROM h JOIN q ON q.prefix = h.prefix AND q.channel_id = h.channel_id JOIN c ON c.channel_id = h.channel_id WHERE i <= 2 AND n > 10 ORDER BY md5(concat_ws(':', '8', CAST(number AS STRING))), number LIMIT 40""")
def f19_prefix_sample(t: Tables) -> DataFrame:
    videos = t.videos.withColumnRenamed("channel_id", "channel")
    prefixes = videos.filter("number % 4 = 0").select(F.left("id", F.lit(5)).alias("prefix"))
    sizes = videos.groupBy("channel").agg(F.count("*").alias("video_count"))
    return graph.prefix_sample(videos, prefixes, sizes, 40, "8", per_search=2).select("number")


@query("""
    WITH c AS (SELECT pending_id, destination_channel AS channel, discovery_time, CAST(substring(destination_channel, 5, 9) AS INT) AS k FROM v_pending WHERE validation_status = 'pending' ORDER BY discovery_time, pending_id LIMIT 200),
    w AS (SELECT channel, arg_min(pending_id, struct_pack(t := discovery_time, i := pending_id)) AS winner FROM c WHERE k % 10 >= 2 AND k % 5 = 2 GROUP BY 1),
    r AS (SELECT pending_id, CASE WHEN k % 10 = 0 THEN 'invalid' WHEN k % 10 = 1 THEN 'duplicate' WHEN k % 5 = 2 THEN CASE WHEN pending_id = winner THEN 'valid' ELSE 'duplicate' END WHEN k % 5 = 3 THEN 'not_channel' WHEN k % 5 = 4 THEN 'invalid' ELSE 'pending' END AS status,
      CASE WHEN k % 10 = 0 THEN 'cached_invalid' WHEN k % 10 > 1 AND k % 5 IN (3, 4) THEN 'seen' ELSE '' END AS reason FROM c LEFT JOIN w ON w.channel = c.channel)
    SELECT p.pending_id, coalesce(r.status, validation_status) AS validation_status, coalesce(r.reason, validation_reason) AS validation_reason FROM v_pending p LEFT JOIN r ON r.pending_id = p.pending_id""")
def h01_validation_round(t: Tables) -> DataFrame:
    channels = t.pending.select(F.col("destination_channel").alias("channel")).distinct().withColumn("k", F.substring("channel", 5, 9).cast("int"))
    k = F.col("k") % 5
    verdicts = channels.select("channel", F.when(k == 2, "valid").when(k == 3, "not_channel").when(k == 4, "invalid").otherwise("blocked").alias("verdict"), F.lit("seen").alias("reason"))
    after = queues.validation_round(t.pending, channels.filter("k % 10 = 0"), channels.filter("k % 10 = 1"), verdicts, 200, now())
    return after.select("pending_id", "validation_status", "validation_reason")


@query("""
    WITH RECURSIVE o AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
    f AS (SELECT DISTINCT user_id, 0::BIGINT AS i, 0::BIGINT AS n, NULL::BIGINT AS first FROM o UNION ALL
      SELECT f.user_id, o.i, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN n + 1 WHEN event_type = 'error' THEN greatest(n - 1, 0) ELSE 0 END,
        coalesce(first, CASE WHEN (CASE WHEN event_type IN ('view', 'click', 'purchase') THEN n + 1 WHEN event_type = 'error' THEN greatest(n - 1, 0) ELSE 0 END) >= 5 THEN o.i END)
      FROM f JOIN o ON o.user_id = f.user_id AND o.i = f.i + 1)
    SELECT user_id, arg_max(n, i) AS counter, arg_max(struct_pack(x := first), i).x AS blocked_at FROM f GROUP BY user_id""")
def h02_blocked_state(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type").isin("view", "click", "purchase"), "blocked").when(F.col("event_type") == "error", "transient").otherwise("definitive")
    rows = t.read("events").select("user_id", "ts", "event_id", kind.alias("outcome"))
    out = queues.blocked_state(rows, ["user_id"], ["ts", "event_id"])
    return out.select("user_id", F.col("counter").cast("bigint").alias("counter"), F.col("blocked_at").cast("bigint").alias("blocked_at"))


@query(f"SELECT channel_username, {NOW} - INTERVAL 30 DAY < invalidated_at AS cached FROM v_seeds WHERE invalidated_at IS NOT NULL")
def h05_ttl_cache(t: Tables) -> DataFrame:
    return tables.with_expiry(t.seeds.filter("invalidated_at IS NOT NULL"), "invalidated_at", now()).select("channel_username", "cached")


@query("SELECT channel_username, strftime(greatest(TIMESTAMP '2024-01-20 00:00:00', last_crawled_at), '%Y-%m-%d') AS min_date FROM v_seeds WHERE channel_username <> ''")
def h06_high_water(t: Tables) -> DataFrame:
    named = t.seeds.filter("channel_username <> ''")
    out = stats.high_water(named.select("channel_username"), named.select("channel_username", "last_crawled_at"), _ntz("TIMESTAMP '2024-01-20 00:00:00'"), "channel_username")
    return out.select("channel_username", F.date_format("min_date", "yyyy-MM-dd").alias("min_date"))


@query("SELECT page_id, CASE WHEN CAST(substring(page_id, 2) AS BIGINT) % 5 <> 0 AND (status = 'unfetched' OR (status = 'error' AND retries < 3)) THEN 'processing' ELSE status END AS status FROM v_pages")
def h07_distribute(t: Tables) -> DataFrame:
    unpublished = t.pages.filter("CAST(substring(page_id, 2) AS BIGINT) % 5 = 0").select("page_id")
    return stats.distribute(t.pages, unpublished)[1].select("page_id", "status")


_ROUND = """
    s AS (SELECT * REPLACE (CASE WHEN status = 'processing' AND attempt_count < 3 THEN 'closed' ELSE status END AS status) FROM v_batches),
    o AS (SELECT * FROM s WHERE status = 'closed' AND attempt_count < 3 AND batch_id NOT IN (SELECT batch_id FROM v_pending WHERE validation_status IN ('pending', 'validating')) ORDER BY created_at, batch_id LIMIT 1)"""


@query(f"WITH {_ROUND.strip()} SELECT s.batch_id, CASE WHEN o.batch_id IS NULL THEN s.status ELSE 'completed' END AS status, (s.attempt_count + CASE WHEN o.batch_id IS NULL THEN 0 ELSE 1 END)::INT AS attempt_count FROM s LEFT JOIN o ON o.batch_id = s.batch_id")
def h03_walkback_round(t: Tables) -> DataFrame:
    return _round(t)[2]["batches"].select("batch_id", "status", "attempt_count")


@query(f"""WITH {_ROUND.strip()}, p AS (SELECT * FROM v_pending WHERE batch_id IN (SELECT batch_id FROM o)),
    a AS (SELECT crawl_id, 'unknown' AS source_type, 10::BIGINT AS total FROM v_batches GROUP BY 1 UNION ALL SELECT crawl_id, coalesce(nullif(source_type, ''), 'unknown'), count(*) FROM p GROUP BY 1, 2)
    SELECT crawl_id, source_type, sum(total)::BIGINT AS total FROM a GROUP BY 1, 2""")
def h03_walkback_stats(t: Tables) -> DataFrame:
    return _round(t)[3]["source_stats"].select("crawl_id", "source_type", "total")


_MANY = _ROUND.replace("LIMIT 1", "LIMIT 60")


@query(f"WITH {_MANY.strip()} SELECT s.batch_id, CASE WHEN o.batch_id IS NULL THEN s.status ELSE 'completed' END AS status, (s.attempt_count + CASE WHEN o.batch_id IS NULL THEN 0 ELSE 1 END)::INT AS attempt_count FROM s LEFT JOIN o ON o.batch_id = s.batch_id")
def h03_walkback_batches(t: Tables) -> DataFrame:
    return _round(t, 60)[2]["batches"].select("batch_id", "status", "attempt_count")


@query(f"""WITH {_MANY.strip()}, v AS (SELECT DISTINCT batch_id, destination_channel FROM v_pending WHERE validation_status = 'valid' AND batch_id IN (SELECT batch_id FROM o)),
    n AS (SELECT o.batch_id, source_page_id, source_depth, count(v.batch_id) AS n FROM o LEFT JOIN v ON v.batch_id = o.batch_id GROUP BY ALL)
    SELECT sha256(concat_ws(':', '9', 'page', batch_id)) AS page_id, source_page_id AS parent_id, (source_depth + 1)::INT AS depth FROM n""")
def h03_walkback_pages(t: Tables) -> DataFrame:
    """A page for each of the claimed batches; with some hundred known channels, ten draws find one to go back to."""
    return _round(t, 60)[1]["page_buffer"].select("page_id", "parent_id", "depth")


@query(f"WITH {_ROUND.strip()} SELECT pending_id FROM v_pending WHERE batch_id NOT IN (SELECT batch_id FROM o) AND batch_id NOT IN (SELECT batch_id FROM v_batches WHERE status = 'completed')")
def h04_orphans_of_a_crash(t: Tables) -> DataFrame:
    """The round stops after its batch is completed and before its edges are deleted; the orphan rule deletes them."""
    completed = _round(t)[2]["batches"]
    return queues.without_orphans(t.pending, completed).select("pending_id")


def _round(t: Tables, k: int = 1) -> list[dict[str, DataFrame]]:
    none = t.batches.select("crawl_id").distinct().select("crawl_id", F.lit("unknown").alias("source_type"), F.lit(10).cast("bigint").alias("total"), *[F.lit(0).cast("bigint").alias(c) for c in queues.COUNTED])
    return list(queues.walkback_round(t.batches, t.pending, none, graph.vertices(t.edges), now(), 30, "9", k=k))


@query("SELECT page_id FROM v_pages WHERE status = 'unfetched' OR (status = 'error' AND retries < 3)")
def d15_needs_work(t: Tables) -> DataFrame:
    return t.pages.filter(stats.needs_work(F.col("status"), F.col("retries"))).select("page_id")


@query("SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen, max_by(event_type, ts) AS event_type FROM events GROUP BY user_id")
def h08_last_seen(t: Tables) -> DataFrame:
    out = stats.last_seen(t.read("events"), "user_id", "ts", "event_type")
    return out.select("user_id", F.date_format("last_seen", "yyyy-MM-dd HH:mm:ss").alias("last_seen"), "event_type")


@query(f"SELECT user_id FROM events GROUP BY user_id HAVING max(ts) < {NOW} - INTERVAL 2880 MINUTE")
def h09_liveness(t: Tables) -> DataFrame:
    return stats.offline(stats.last_seen(t.read("events"), "user_id", "ts"), now(), 2880).select("user_id")


@query(f"SELECT o_orderkey AS id, 3::BIGINT AS retry_count FROM orders WHERE o_custkey % 150 IN (SELECT user_id FROM events GROUP BY user_id HAVING max(ts) < {NOW} - INTERVAL 2880 MINUTE)")
def h09_requeue(t: Tables) -> DataFrame:
    gone = stats.offline(stats.last_seen(t.read("events"), "user_id", "ts"), now(), 2880)
    items = t.read("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 150).alias("assigned_to"), F.lit(2).cast("bigint").alias("retry_count"))
    return stats.requeue(items, gone, "user_id").select("id", "retry_count")


@query("SELECT message_id, CASE WHEN message_id % 3 = 0 THEN 'fetched' ELSE status END AS status FROM v_messages")
def h11_message_status(t: Tables) -> DataFrame:
    rows = t.messages.filter("message_id % 3 = 0").select("message_id", F.lit("fetched").alias("status"))
    return tables.update_by_key(t.messages.select("message_id", "status"), rows, ["message_id"])


@query("SELECT page_id, CASE WHEN status = 'fetched' THEN 'fetched' ELSE 'unfetched' END AS same, 'unfetched' AS other FROM v_pages")
def h12_resume(t: Tables) -> DataFrame:
    pages = t.pages.withColumn("messages", F.array().cast("array<struct<chat_id:bigint>>"))
    same, other = (stats.resume(pages, s).select("page_id", F.col("status").alias(n)) for s, n in ((True, "same"), (False, "other")))
    return same.join(other, "page_id")


@query("""
    SELECT crawl_id, coalesce(p.n, 0)::BIGINT AS buffered, b.flying::BIGINT AS in_flight, b.open::BIGINT AS incomplete, coalesce(p.n, 0) + b.flying + b.open = 0 AS done
    FROM (SELECT crawl_id, count(*) FILTER (WHERE status = 'processing') AS flying, count(*) FILTER (WHERE status <> 'completed' AND attempt_count < 2) AS open FROM v_batches GROUP BY 1) b
    LEFT JOIN (SELECT crawl_id, count(*) AS n FROM v_pages WHERE status = 'unfetched' AND depth > 2 GROUP BY 1) p USING (crawl_id)""")
def h13_tandem_done(t: Tables) -> DataFrame:
    return stats.tandem_state(t.pages.filter("status = 'unfetched' AND depth > 2"), t.batches.filter("status = 'processing'"), t.batches.filter("attempt_count < 2"))


@query("""
    WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, (o_custkey * 7 + o_orderkey % 3) % 1500 AS b FROM orders),
    r AS (SELECT 1::BIGINT AS channel UNION SELECT e.b FROM r JOIN e ON e.a = r.channel)
    SELECT channel FROM r""")
def f17_frontier_loop(t: Tables) -> DataFrame:
    """The graph of orders from one channel to the end, popped 400 pages at a time."""
    from ..streaming import frontier

    edges = t.read("orders").select(F.col("o_custkey").alias("source"), ((F.col("o_custkey") * 7 + F.col("o_orderkey") % 3) % 1500).alias("destination")).distinct()
    start = t.spark.range(1, 2).select(F.col("id").cast("string").alias("page_id"), F.col("id").alias("url"), F.lit(0).alias("depth"), F.lit("c").alias("crawl_id"))
    found = frontier.run_frontier(start, frontier.links_of(edges), "c", 400)
    return found.pages.select(F.col("url").alias("channel"))


@query("SELECT event_type AS source_type, count(*)::BIGINT AS links, count(*) FILTER (WHERE event_id % 9 = 7) AS valid FROM events GROUP BY 1")
def flagship_links_by_source(t: Tables) -> DataFrame:
    """Links out of messages, classified by name and summed by source type."""
    from ..functions.links import channel_links, username_fault
    from .queries_values import _NAME

    rows = t.read("events").withColumn("name", F.expr(_NAME))
    linked = rows.select("event_type", F.coalesce(F.get(channel_links(F.concat(F.lit("t.me/"), "name")), F.lit(0)), F.col("name")).alias("name"), F.col("name").alias("raw"))
    return linked.groupBy(F.col("event_type").alias("source_type")).agg(F.count("*").alias("links"), F.count_if(username_fault(F.col("raw")).isNull()).alias("valid"))
