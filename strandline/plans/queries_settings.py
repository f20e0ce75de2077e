"""Queries over files and settings: round trips of sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import file_packing, graph, nulls, posts
from ..sources import files
from .catalogue import Tables, now, query

@query("SELECT event_id, concat_ws(',', CASE WHEN event_type = 'view' THEN 'inner.text' END, CASE WHEN user_id % 2 = 0 THEN 'n' END, CASE WHEN event_id % 3 = 0 THEN 'items' END) AS empty FROM events")
def d03_empty_fields(t: Tables) -> DataFrame:
    """Fields of structs are walked; text, numbers and lists are empty at their zero; a struct has no rule of its own."""
    n = F.col("event_id") % 3
    rows = t.read("events").select("event_id", F.struct(F.when(F.col("event_type") != "view", F.col("event_type")).otherwise("").alias("text")).alias("inner"), (F.col("user_id") % 2).alias("n"), F.when(n > 0, F.array(n)).otherwise(F.array().cast("array<bigint>")).alias("items"))
    rules = {p: ("log", p) for p in ("inner", "inner.text", "n", "items")}
    found = nulls.validate(rows, rules)
    return found.select("event_id", F.array_join("warnings", ",").alias("empty"))


@query("SELECT CAST(event_id AS STRING) AS id, CASE WHEN event_id % 7 = 0 THEN 'error' ELSE 'success' END AS status, CASE WHEN event_id % 7 = 0 THEN 'timed out' ELSE '' END AS error, CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id % 11 END::BIGINT AS post_count, CASE WHEN event_id % 7 = 0 THEN 0 ELSE event_id % 3 END::BIGINT AS discovered FROM events WHERE event_id % 2 = 0")
def h10_work_results(t: Tables) -> DataFrame:
    items = t.read("events").select(F.col("event_id").cast("string").alias("id"), F.lit("c").alias("crawl_id"), F.lit("u").alias("url"))
    n = F.col("event_id")
    outcomes = t.read("events").filter("event_id % 2 = 0").select(n.cast("string").alias("id"), F.when(n % 7 == 0, "timed out").alias("error"), (n % 11).alias("post_count"), F.array_repeat(F.lit("x"), (n % 3).cast("int")).alias("discovered"))
    return posts.work_results(items, outcomes, now()).select("id", "status", "error", "post_count", F.size("discovered").cast("bigint").alias("discovered"))


def _folder(t: Tables, name: str) -> str:
    return f"{graph.shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT channel_username, chat_id, member_count FROM v_seeds WHERE channel_username <> ''")
def a35_seed_csv(t: Tables) -> DataFrame:
    path = _folder(t, "seeds")
    none = F.lit(None).cast("timestamp")
    t.seeds.filter("channel_username <> ''").select("channel_username", "chat_id", none.alias("last_crawled_at"), none.alias("invalidated_at"), "member_count", none.alias("inserted_at")).write.csv(path, header=True)
    return files.load_seed_csv(t.spark, path).select("channel_username", "chat_id", "member_count")


@query("SELECT message_id, message_id % 3 AS channel FROM v_messages WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts <= TIMESTAMP '2024-01-12 18:00:00'")
def b04_stored_history(t: Tables) -> DataFrame:
    """A scan of stored JSON lines; the bounds reach the folders."""
    path = _folder(t, "history")
    files.write_history(t.messages.select("message_id", "ts", (F.col("message_id") % 3).alias("number")), path, "ts", "number")
    since, until = (F.expr(f"CAST('{text}' AS TIMESTAMP_NTZ)") for text in ("2024-01-10 06:00:00", "2024-01-12 18:00:00"))
    rows = files.read_history(t.spark, path, "message_id BIGINT, ts TIMESTAMP_NTZ", "ts", since, until)
    return rows.select("message_id", F.col("channel").cast("bigint").alias("channel"))


@query("SELECT CAST(n_nationkey AS STRING) AS channel_id, n_name AS channel_name FROM nation")
def b13_channel_sink(t: Tables) -> DataFrame:
    path = _folder(t, "channels")
    for half in (0, 1):  # appended
        rows = t.read("nation").filter(F.col("n_nationkey") % 2 == half).select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_nationkey").cast("string").alias("channel_id"), F.col("n_name").alias("channel_name"))
        files.write_json(rows, path, "id")
    return t.spark.read.schema("channel_id string, channel_name string").json(path).select("channel_id", "channel_name")


_LINES = "SELECT n_nationkey AS f, string_agg(n_name || '-' || CAST(r AS STRING), chr(10) ORDER BY r) AS body FROM nation, range(20) t(r) GROUP BY 1"


@query(f"WITH l AS ({_LINES}) SELECT f // 5 AS bin, string_agg(body, chr(10) ORDER BY f) || chr(10) AS content FROM l GROUP BY 1")
def b17_combined_files(t: Tables) -> DataFrame:
    """The lines of five files a bin, one file after the other."""
    folder, out = _folder(t, "parts"), _folder(t, "combined")
    lines = t.read("nation").select(F.format_string("f%03d", F.col("n_nationkey").cast("int")).alias("f"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(19)), lambda r: F.concat("n_name", F.lit("-"), r.cast("string"))), "\n").alias("value"))
    lines.write.partitionBy("f").text(folder)
    listed = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(folder).select("path")
    packed = listed.withColumn("bin", F.floor(F.regexp_extract("path", r"f=f(\d+)", 1).cast("int") / 5).cast("int"))
    files.combine(t.spark, f"{folder}/*", packed, out, pattern="part-*")
    whole = t.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(out)
    return whole.select(F.regexp_extract("path", r"bin=(\d+)", 1).cast("bigint").alias("bin"), F.col("content").cast("string").alias("content"))


@query("SELECT length(n_name) + 1 AS size, count(*)::BIGINT AS files FROM nation GROUP BY 1")
def b19_manifest(t: Tables) -> DataFrame:
    folder = _folder(t, "watched")
    t.read("nation").select("n_name", F.col("n_name").alias("value")).write.partitionBy("n_name").text(folder)
    found = files.manifest(t.spark, f"{folder}/*", "part-*").filter("mtime IS NOT NULL")
    return found.groupBy("size").agg(F.count("*").alias("files"))


@query("SELECT page_id, status FROM v_pages WHERE depth < 3")
def b22_snapshots(t: Tables) -> DataFrame:
    """The newest complete version is read."""
    path = _folder(t, "state")
    for version, depth in enumerate((1, 2, 3)):
        files.write_snapshot(t.pages.filter(F.col("depth") < depth).select("page_id", "status"), path, version)
    return files.read_snapshot(t.spark, path)


@query("SELECT CAST(event_id AS BIGINT) AS event_id FROM events")
def b18_watched_folder(t: Tables) -> DataFrame:
    """Files are taken once each, also when the stream starts again."""
    from ..streaming import loops

    path = _folder(t, "watch")
    stream = loops.file_stream(t.spark, f"{path}/in/*", "event_id bigint")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    for half in (0, 1):
        t.read("events").filter(F.col("event_id") % 2 == half).select("event_id").write.json(f"{path}/in/{half}")
        loops.run_available(stream, keep, f"{path}/checkpoint")
    loops.run_available(stream, keep, f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").select(F.col("event_id").cast("bigint").alias("event_id"))


@query("SELECT CAST(n_nationkey AS BIGINT) AS number, CASE WHEN length(n_name) <= 9 THEN 0 END AS bin FROM nation")
def b16_dropped_files(t: Tables) -> DataFrame:
    """Files over the cap are dropped: they have no bin. Each region's folder is packed by itself."""
    rows = t.read("nation").select(F.col("n_nationkey").cast("bigint").alias("number"), "n_regionkey", F.when(F.length("n_name") <= 9, 1).otherwise(99).alias("size"))
    return file_packing.pack(rows, ["number"], "size", None, 50, ["n_regionkey"]).select("number", "bin")
