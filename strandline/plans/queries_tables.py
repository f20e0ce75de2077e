"""Queries over stored tables: edges, frontier, seeds, batches and claims."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph, queues, tables
from .catalogue import NOW, Tables, now, query


@query("SELECT coalesce(nullif(CASE WHEN event_id % 2 = 0 THEN '' ELSE 'own' END, ''), 'given') AS crawl_id, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def a01_append_edges(t: Tables) -> DataFrame:
    rows = t.edges.withColumn("crawl_id", F.when(F.col("edge_id") % 2 == 0, "").otherwise("own"))
    return graph.save_edges(t.edges.limit(0), rows, "given").groupBy("crawl_id").agg(F.count("*").alias("n"))


@query("SELECT edge_id, source_channel FROM v_edges WHERE crawl_id = 'c0' AND sequence_id = 's4' AND destination_channel = 'chan30' ORDER BY edge_id LIMIT 1")
def a02_find_edge(t: Tables) -> DataFrame:
    return graph.find_edge(t.edges, "c0", "s4", "chan30").select("edge_id", "source_channel")


@query("SELECT crawl_id, count(*)::BIGINT AS n FROM v_edges WHERE NOT (crawl_id = 'c0' AND sequence_id = 's4' AND destination_channel = 'chan30') GROUP BY crawl_id")
def a03_delete_edge(t: Tables) -> DataFrame:
    return graph.delete_edge(t.edges, "c0", "s4", "chan30").groupBy("crawl_id").agg(F.count("*").alias("n"))


@query("SELECT edge_id, destination_channel FROM v_edges WHERE skipped AND sequence_id = 's3' ORDER BY md5(concat_ws(':', '42', CAST(edge_id AS STRING))), edge_id LIMIT 1")
def a04_random_skipped(t: Tables) -> DataFrame:
    return graph.random_skipped(t.edges, F.col("sequence_id") == "s3", "42", "edge_id").select("edge_id", "destination_channel")


@query("SELECT source_channel AS channel FROM v_edges UNION SELECT destination_channel FROM v_edges")
def a05_union_distinct(t: Tables) -> DataFrame:
    return graph.vertices(t.edges)


@query("SELECT skipped, count(*)::BIGINT AS n FROM (SELECT CASE WHEN crawl_id = 'c0' AND sequence_id = 's4' AND destination_channel = 'chan30' THEN false ELSE skipped END AS skipped FROM v_edges) GROUP BY skipped")
def a06_promote_edge(t: Tables) -> DataFrame:
    return graph.promote_edge(t.edges, "c0", "s4", "chan30").groupBy("skipped").agg(F.count("*").alias("n"))


@query(f"SELECT channel_username, chat_id FROM v_seeds WHERE channel_username <> '' AND (invalidated_at IS NULL OR invalidated_at <= {NOW} - INTERVAL 30 DAY)")
def a07_usable_seeds(t: Tables) -> DataFrame:
    return tables.usable_seeds(t.seeds, now()).select("channel_username", "chat_id")


@query("""
    WITH n AS (SELECT concat('chan', CAST(s_suppkey * 20 AS STRING)) AS u, -s_suppkey AS c FROM supplier), o AS (SELECT * FROM v_seeds WHERE channel_username <> '')
    SELECT coalesce(u, channel_username) AS channel_username, CASE WHEN u IS NOT NULL THEN c ELSE chat_id END AS chat_id, member_count FROM o FULL JOIN n ON u = channel_username""")
def a08_upsert_seed(t: Tables) -> DataFrame:
    rows = t.read("supplier").select(F.concat(F.lit("chan"), (F.col("s_suppkey") * 20).cast("string")).alias("channel_username"), (-F.col("s_suppkey")).alias("chat_id"))
    return tables.upsert(t.seeds.filter("channel_username <> ''"), rows, ["channel_username"]).select("channel_username", "chat_id", "member_count")


@query("SELECT event_id, CASE WHEN event_id % 3 < 2 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') END AS at FROM events")
def a09_stored_time(t: Tables) -> DataFrame:
    from ..functions.parsing import stored_time

    second = F.date_trunc("second", "ts")
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.concat(F.date_format(second, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))).when(kind == 1, F.unix_timestamp(second.cast("timestamp")).cast("double").cast("string")).otherwise("never")
    return t.read("events").select("event_id", F.date_format(stored_time(text), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(f"""
    WITH n AS (SELECT concat('chan', CAST(s_suppkey * 20 AS STRING)) AS u, -s_suppkey AS c FROM supplier), o AS (SELECT * FROM v_seeds WHERE channel_username <> '')
    SELECT coalesce(u, channel_username) AS channel_username, CASE WHEN u IS NOT NULL THEN c ELSE chat_id END AS chat_id, strftime(CASE WHEN u IS NOT NULL THEN {NOW} ELSE last_crawled_at END, '%Y-%m-%d') AS last_crawled
    FROM o FULL JOIN n ON u = channel_username""")
def a10_mark_crawled(t: Tables) -> DataFrame:
    rows = t.read("supplier").select(F.concat(F.lit("chan"), (F.col("s_suppkey") * 20).cast("string")).alias("channel_username"), (-F.col("s_suppkey")).alias("chat_id"), now().alias("last_crawled_at"))
    out = tables.upsert(t.seeds.filter("channel_username <> ''"), rows, ["channel_username"])
    return out.select("channel_username", "chat_id", F.date_format("last_crawled_at", "yyyy-MM-dd").alias("last_crawled"))


@query(f"""
    WITH n AS (SELECT concat('chan', CAST(s_suppkey * 20 AS STRING)) AS u FROM supplier)
    SELECT channel_username, strftime(CASE WHEN u IS NOT NULL THEN {NOW} ELSE invalidated_at END, '%Y-%m-%d') AS invalidated FROM v_seeds LEFT JOIN n ON u = channel_username WHERE channel_username <> ''""")
def a11_seed_invalid(t: Tables) -> DataFrame:
    rows = t.read("supplier").select(F.concat(F.lit("chan"), (F.col("s_suppkey") * 20).cast("string")).alias("channel_username"), now().alias("invalidated_at"))
    return tables.update_by_key(t.seeds.filter("channel_username <> ''"), rows, ["channel_username"]).select("channel_username", F.date_format("invalidated_at", "yyyy-MM-dd").alias("invalidated"))


@query(f"SELECT channel_username FROM v_seeds WHERE invalidated_at > {NOW} - INTERVAL 30 DAY")
def a12_ttl_scan(t: Tables) -> DataFrame:
    return tables.unexpired(t.seeds, "invalidated_at", now()).select("channel_username")


@query(f"""
    WITH o AS (SELECT channel_username AS k, 'old' AS reason, invalidated_at AS since FROM v_seeds WHERE invalidated_at IS NOT NULL AND channel_username <> ''),
    n AS (SELECT concat('chan', CAST(s_suppkey * 20 AS STRING)) AS u, s_name AS r FROM supplier)
    SELECT coalesce(u, k) AS channel_username, coalesce(r, reason) AS reason, strftime(CASE WHEN u IS NOT NULL THEN {NOW} ELSE since END, '%Y-%m-%d') AS invalidated FROM o FULL JOIN n ON u = k""")
def a13_mark_invalid(t: Tables) -> DataFrame:
    old = t.seeds.filter("invalidated_at IS NOT NULL AND channel_username <> ''").select("channel_username", F.lit("old").alias("reason"), "invalidated_at")
    rows = t.read("supplier").select(F.concat(F.lit("chan"), (F.col("s_suppkey") * 20).cast("string")).alias("channel_username"), F.col("s_name").alias("reason"), now().alias("invalidated_at"))
    return tables.upsert(old, rows, ["channel_username"]).select("channel_username", "reason", F.date_format("invalidated_at", "yyyy-MM-dd").alias("invalidated"))


@query("SELECT coalesce(nullif(CASE WHEN event_id % 2 = 0 THEN '' ELSE concat('c', CAST(event_id % 3 AS STRING)) END, ''), 'mine') AS crawl_id, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def a14_enqueue_page(t: Tables) -> DataFrame:
    rows = t.pages.withColumn("crawl_id", F.when(F.substring("page_id", 2, 20).cast("bigint") % 2 == 0, "").otherwise(F.col("crawl_id")))
    return tables.append(t.pages.limit(0), rows, crawl_id=F.lit("mine")).groupBy("crawl_id").agg(F.count("*").alias("n"))


@query("SELECT page_id FROM v_pages WHERE NOT (crawl_id = 'c1' AND page_id IN (SELECT concat('p', CAST(o_orderkey AS STRING)) FROM orders))")
def a15_delete_pages(t: Tables) -> DataFrame:
    ids = t.read("orders").select(F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("page_id"))
    return graph.remove_pages(t.pages, "c1", ids).select("page_id")


@query("SELECT page_id, depth FROM v_pages WHERE crawl_id = 'c1' ORDER BY depth, page_id LIMIT 25")
def a16_dequeue(t: Tables) -> DataFrame:
    return graph.pop(t.pages, "c1", 25).select("page_id", "depth")


@query(f"SELECT concat('new', CAST(s_suppkey AS STRING)) AS batch_id, 'open' AS status, 0 AS attempt_count, strftime({NOW}, '%Y-%m-%d') AS created FROM supplier")
def a17_open_batch(t: Tables) -> DataFrame:
    rows = t.read("supplier").select(F.concat(F.lit("new"), F.col("s_suppkey").cast("string")).alias("batch_id"))
    out = queues.open_batch(t.batches.limit(0), rows, now())
    return out.select("batch_id", "status", "attempt_count", F.date_format("created_at", "yyyy-MM-dd").alias("created"))


@query("SELECT validation_status, count(*)::BIGINT AS n FROM (SELECT validation_status FROM v_pending UNION ALL SELECT 'pending' FROM supplier) GROUP BY validation_status")
def a18_add_pending(t: Tables) -> DataFrame:
    rows = t.read("supplier").select((-F.col("s_suppkey")).alias("pending_id"), F.col("s_name").alias("destination_channel"))
    return queues.add_pending(t.pending, rows).groupBy("validation_status").agg(F.count("*").alias("n"))


@query(f"SELECT batch_id, CASE WHEN batch_id = 'b8' THEN 'closed' ELSE status END AS status, CASE WHEN batch_id = 'b8' THEN strftime({NOW}, '%Y-%m-%d') END AS closed FROM v_batches")
def a19_close_batch(t: Tables) -> DataFrame:
    rows = t.batches.withColumn("closed_at", F.lit(None).cast("timestamp_ntz"))
    return queues.close_batch(rows, "b8", now()).select("batch_id", "status", F.date_format("closed_at", "yyyy-MM-dd").alias("closed"))


@query("SELECT pending_id, destination_channel FROM v_pending WHERE validation_status = 'pending' ORDER BY discovery_time, pending_id LIMIT 10")
def a20_claim_topk(t: Tables) -> DataFrame:
    return queues.claim_edges(t.pending, 10, now())[0].select("pending_id", "destination_channel")


@query("""
    WITH c AS (SELECT pending_id FROM v_pending WHERE validation_status = 'pending' ORDER BY discovery_time, pending_id LIMIT 10)
    SELECT CASE WHEN c.pending_id IS NOT NULL THEN 'validating' ELSE validation_status END AS validation_status, count(*)::BIGINT AS n FROM v_pending p LEFT JOIN c ON c.pending_id = p.pending_id GROUP BY 1""")
def a20_claimed_table(t: Tables) -> DataFrame:
    return queues.claim_edges(t.pending, 10, now())[1].groupBy("validation_status").agg(F.count("*").alias("n"))


@query("""
    SELECT pending_id, CASE WHEN pending_id % 11 = 0 THEN 'invalid' ELSE validation_status END AS validation_status, CASE WHEN pending_id % 11 = 0 THEN 'checked' END AS validation_reason FROM v_pending""")
def a21_update_edge(t: Tables) -> DataFrame:
    verdicts = t.pending.filter("pending_id % 11 = 0").select("pending_id", F.lit("invalid").alias("validation_status"), F.lit("checked").alias("validation_reason"))
    return queues.update_edges(t.pending, verdicts).select("pending_id", "validation_status", "validation_reason")


_READY = """(SELECT * FROM v_batches b WHERE status = 'closed' AND attempt_count < 3
    AND NOT EXISTS (SELECT 1 FROM v_pending p WHERE p.batch_id = b.batch_id AND validation_status IN ('pending', 'validating')))"""


@query(f"SELECT batch_id, attempt_count FROM {_READY}")
def a22_ready_batches(t: Tables) -> DataFrame:
    return queues.ready_batches(t.batches, t.pending).select("batch_id", "attempt_count")


@query(f"WITH c AS (SELECT * FROM {_READY} ORDER BY created_at, batch_id LIMIT 1) SELECT batch_id, 'processing' AS status, attempt_count + 1 AS attempt_count, (SELECT count(*) FROM v_pending p WHERE p.batch_id = c.batch_id)::BIGINT AS edges FROM c")
def a22_claim_ready_batch(t: Tables) -> DataFrame:
    claimed, edges, _ = queues.claim_batch(t.batches, t.pending, now())
    counted = edges.groupBy("batch_id").agg(F.count("*").alias("edges"))
    return claimed.join(counted, "batch_id", "left").select("batch_id", "status", "attempt_count", F.coalesce("edges", F.lit(0)).cast("bigint").alias("edges"))


@query(f"WITH c AS (SELECT batch_id FROM {_READY} ORDER BY created_at, batch_id LIMIT 40) SELECT b.batch_id, CASE WHEN c.batch_id IS NULL THEN status ELSE 'processing' END AS status, (attempt_count + CASE WHEN c.batch_id IS NULL THEN 0 ELSE 1 END)::INT AS attempt_count FROM v_batches b LEFT JOIN c ON c.batch_id = b.batch_id")
def a22_claim_batches(t: Tables) -> DataFrame:
    """The table in which the 40 oldest ready batches are being processed."""
    return queues.claim_batches(t.batches, t.pending, now(), 40)[2].select("batch_id", "status", "attempt_count")


@query("SELECT status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN batch_id = 'b9' THEN 'completed' ELSE status END AS status FROM v_batches) GROUP BY status")
def a23_complete_batch(t: Tables) -> DataFrame:
    return queues.complete_batch(t.batches.withColumn("completed_at", F.lit(None).cast("timestamp_ntz")), "b9", now()).groupBy("status").agg(F.count("*").alias("n"))


_STATS = "count(*) AS total, count(*) FILTER (WHERE validation_status = 'valid') AS valid, count(*) FILTER (WHERE validation_status = 'not_channel') AS not_channel, count(*) FILTER (WHERE validation_status = 'invalid') AS invalid, count(*) FILTER (WHERE validation_status = 'duplicate') AS duplicate"


@query(f"SELECT crawl_id, CASE WHEN source_type = '' THEN 'unknown' ELSE source_type END AS source_type, {_STATS} FROM v_pending GROUP BY ALL")
def a24_source_stats(t: Tables) -> DataFrame:
    return queues.batch_statistics(t.pending)


@query(f"""
    WITH s AS (SELECT crawl_id, CASE WHEN source_type = '' THEN 'unknown' ELSE source_type END AS source_type, {_STATS} FROM v_pending GROUP BY ALL),
    d AS (SELECT crawl_id, CASE WHEN source_type = '' THEN 'unknown' ELSE source_type END AS source_type, {_STATS} FROM v_pending WHERE batch_id = 'b7' GROUP BY ALL)
    SELECT crawl_id, source_type, sum(total)::BIGINT AS total, sum(valid)::BIGINT AS valid, sum(not_channel)::BIGINT AS not_channel, sum(invalid)::BIGINT AS invalid, sum(duplicate)::BIGINT AS duplicate
    FROM (SELECT * FROM s UNION ALL SELECT * FROM d) GROUP BY ALL""")
def a24_flush_merge(t: Tables) -> DataFrame:
    return queues.flush_batch(queues.batch_statistics(t.pending), t.pending, "b7")[0]


@query(f"SELECT channel_username FROM v_seeds WHERE channel_username <> '' AND (invalidated_at IS NULL OR invalidated_at <= {NOW} - INTERVAL 30 DAY) ORDER BY md5(concat_ws(':', '7', channel_username)), channel_username LIMIT 1")
def a25_random_seed(t: Tables) -> DataFrame:
    return tables.random_rows(tables.usable_seeds(t.seeds, now()), 1, "7", "channel_username").select("channel_username")


@query("""
    SELECT destination_channel, pending_id FROM (SELECT *, row_number() OVER (PARTITION BY destination_channel ORDER BY discovery_time, pending_id) AS n FROM v_pending
    WHERE destination_channel NOT IN (SELECT channel_username FROM v_seeds WHERE chat_id % 2 = 0)) WHERE n = 1""")
def a26_first_claim(t: Tables) -> DataFrame:
    known = t.seeds.filter("chat_id % 2 = 0").select(F.col("channel_username").alias("destination_channel"))
    return tables.claim_first(t.pending, known, ["destination_channel"], ["discovery_time", "pending_id"]).select("destination_channel", "pending_id")


@query("SELECT pending_id FROM v_pending WHERE destination_channel IN (SELECT channel_username FROM v_seeds WHERE chat_id % 2 = 0)")
def a27_is_discovered(t: Tables) -> DataFrame:
    known = t.seeds.filter("chat_id % 2 = 0").select(F.col("channel_username").alias("destination_channel"))
    return tables.known_rows(t.pending, known, ["destination_channel"]).select("pending_id")


@query("SELECT count(*)::BIGINT AS n FROM v_batches WHERE crawl_id = 'c1' AND status <> 'completed'")
def a28_incomplete_batches(t: Tables) -> DataFrame:
    return queues.incomplete_batches(t.batches, "c1")


@query(f"SELECT validation_status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN validation_status = 'validating' AND validated_at < {NOW} - INTERVAL 14400 MINUTE THEN 'pending' ELSE validation_status END AS validation_status FROM v_pending) GROUP BY 1")
def a29_recover_edges(t: Tables) -> DataFrame:
    return queues.recover_edges(t.pending, now(), 14400).groupBy("validation_status").agg(F.count("*").alias("n"))


@query(f"SELECT status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN status = 'processing' AND attempt_count < 3 AND claimed_at < TIMESTAMP '1996-01-01 00:00:00' - INTERVAL 10 MINUTE THEN 'closed' ELSE status END AS status FROM v_batches) GROUP BY 1")
def a30_recover_batches(t: Tables) -> DataFrame:
    return queues.recover_batches(t.batches, F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'"), 10)[0].groupBy("status").agg(F.count("*").alias("n"))


@query("SELECT batch_id FROM v_batches WHERE status = 'processing' AND attempt_count >= 3 AND claimed_at < TIMESTAMP '1996-01-01 00:00:00' - INTERVAL 10 MINUTE")
def a30_poison_batches(t: Tables) -> DataFrame:
    return queues.recover_batches(t.batches, F.expr("TIMESTAMP_NTZ '1996-01-01 00:00:00'"), 10)[1].select("batch_id")


@query("SELECT pending_id FROM v_pending WHERE batch_id IN (SELECT batch_id FROM v_batches WHERE status = 'completed')")
def a31_orphan_edges(t: Tables) -> DataFrame:
    return queues.orphan_edges(t.pending, t.batches).select("pending_id")


@query("SELECT pending_id FROM v_pending WHERE batch_id NOT IN (SELECT batch_id FROM v_batches WHERE status = 'completed')")
def a31_orphan_delete(t: Tables) -> DataFrame:
    return queues.without_orphans(t.pending, t.batches).select("pending_id")


@query("SELECT reason, count(*)::BIGINT AS n FROM (SELECT event_type AS reason FROM events UNION ALL SELECT 'blocked') GROUP BY reason")
def a32_access_event(t: Tables) -> DataFrame:
    log = t.read("events").select(F.col("event_id").alias("id"), F.col("event_type").alias("reason"), F.col("ts").alias("occurred_at"))
    row = t.spark.range(1).select((F.col("id") - 1).alias("id"), F.lit("blocked").alias("reason"), now().alias("occurred_at"))
    return tables.append(log, row).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 3 AND c_mktsegment <> 'x''y'")
def a33_parameterised_sql(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT c_custkey, c_name FROM {customer} WHERE c_nationkey = :nation AND c_mktsegment <> :segment", args={"nation": 3, "segment": "x'y"}, customer=t.read("customer"))


@query("""
    SELECT 'repeated:l_orderkey,l_linenumber' AS fault, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))::BIGINT AS n""")
def a34_key_check(t: Tables) -> DataFrame:
    return tables.check_keys(t.read("lineitem"), ["l_orderkey", "l_linenumber"], ["l_orderkey", "l_shipdate"])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def a34_missing_parents(t: Tables) -> DataFrame:
    return tables.missing_parents(t.read("orders"), t.read("lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey").select("o_orderkey")
