"""Queries over functions of values: links, names, times, verdicts, null rules, posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import links, parsing
from ..operators import nulls, posts, stats, tables
from .catalogue import NOW, Tables, now, query

_LINKED = "concat('see https://t.me/Chan', CAST(event_id % 50 AS STRING), '_x and t.me/', CASE WHEN event_id % 4 = 0 THEN 'joinchat' ELSE 'Other_Name' END, ' now t.me/Chan', CAST(event_id % 50 AS STRING), '_x')"
_NAME = "CASE event_id % 9 WHEN 0 THEN 'abcd' WHEN 1 THEN '1channel' WHEN 2 THEN 'channel_' WHEN 3 THEN 'test-channel' WHEN 4 THEN 'SomeBot' WHEN 5 THEN 'téstchannel' WHEN 6 THEN repeat('a', 33) WHEN 7 THEN concat('chan', CAST(event_id AS STRING)) ELSE '' END"


@query(f"SELECT event_id, array_to_string(list_filter(list_transform(regexp_extract_all({_LINKED}, '(https?://)?t\\.me/([a-zA-Z][a-zA-Z0-9_]{{4,31}})', 2), lambda x: lower(x)), lambda x: x <> 'joinchat'), ',') AS names FROM events")
def g01_link_extract(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", F.array_join(links.channel_links(F.expr(_LINKED)), ",").alias("names"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('user_', event_type) END AS name FROM events")
def g02_mention_name(t: Tables) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, "@1").otherwise(F.concat(F.lit("@User_"), "event_type"))
    return t.read("events").select("event_id", links.mention_name(text).alias("name"))


@query("SELECT doc_id, substring(text, 3, 8) AS part FROM documents")
def g03_utf16_slice(t: Tables) -> DataFrame:
    docs = t.read("documents")
    return docs.select("doc_id", links.utf16_slice(F.concat(F.lit("😀"), F.col("text")), F.lit(4), F.lit(8)).alias("part"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN concat('first', CAST(event_id AS STRING), ':mention|hidden', CAST(event_id AS STRING), ':text_url|plain_one:plaintext') ELSE 'plain_one:plaintext' END AS found FROM events")
def g04_message_links(t: Tables) -> DataFrame:
    number = F.col("event_id").cast("string")
    text = F.concat(F.lit("😀 @first"), number, F.lit(" and t.me/plain_one t.me/Plain_One t.me/share"))
    entity = F.struct(F.lit(3).alias("offset"), (F.length(number) + 6).cast("int").alias("length"), F.lit("mention").alias("type"), F.lit(None).cast("string").alias("url"))
    hidden = F.struct(F.lit(0).alias("offset"), F.lit(2).alias("length"), F.lit("text_url").alias("type"), F.concat(F.lit("http://t.me/Hidden"), number).alias("url"))
    entities = F.when(F.col("event_id") % 2 == 0, F.array(entity, hidden, entity))
    text = F.when(F.col("event_id") % 2 == 0, text).otherwise("t.me/plain_one")
    found = F.transform(links.message_links(text, entities), lambda x: F.concat_ws(":", x["name"], x["source_type"]))
    return t.read("events").select("event_id", F.array_join(found, "|").alias("found"))


@query("SELECT event_id, CASE event_type WHEN 'view' THEN concat('text ', props) WHEN 'click' THEN concat('caption ', props) END AS shown FROM events")
def g05_content_text(t: Tables) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "messageText").when(F.col("event_type") == "click", "messagePhoto").otherwise("messageSticker")
    return t.read("events").select("event_id", posts.content_text(kind, F.concat(F.lit("text "), "props"), F.concat(F.lit("caption "), "props")).alias("shown"))


@query("SELECT event_id, concat('http://b.example/', CAST(event_id % 7 AS STRING), ' https://a.example/x') AS urls FROM events")
def g06_url_extract(t: Tables) -> DataFrame:
    u = F.concat(F.lit("http://b.example/"), (F.col("event_id") % 7).cast("string"))
    text = F.concat(F.lit("("), u, F.lit("), https://a.example/x?! and "), u, F.lit("."))
    return t.read("events").select("event_id", F.array_join(links.urls(text), " ").alias("urls"))


@query("SELECT p_partkey, concat('UC_', CAST(p_partkey AS STRING), ' @maker-', CAST(p_size AS STRING)) AS ids FROM part")
def g07_video_channel_ids(t: Tables) -> DataFrame:
    text = F.concat(F.lit("youtube.com/@maker-"), F.col("p_size").cast("string"), F.lit(" then https://www.youtube.com/channel/UC_"), F.col("p_partkey").cast("string"), F.lit(" end"))
    return t.read("part").select("p_partkey", F.array_join(links.video_channel_ids(text), " ").alias("ids"))


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN (event_id % 24) * 3600 + (event_id % 60) * 60 + 3 WHEN 1 THEN 86400 + 1 WHEN 2 THEN NULL WHEN 3 THEN CASE WHEN event_id % 60 > 0 THEN (event_id % 60) * 60 END ELSE NULL END AS seconds FROM events")
def g08_duration(t: Tables) -> DataFrame:
    e = F.col("event_id")
    text = F.when(e % 5 == 0, F.concat(F.lit("PT"), (e % 24).cast("string"), F.lit("H"), (e % 60).cast("string"), F.lit("M3S"))).when(e % 5 == 1, "P1DT1S").when(e % 5 == 2, "P1W").when(e % 5 == 3, F.concat(F.lit("PT"), (e % 60).cast("string"), F.lit("M"))).otherwise("")
    return t.read("events").select("event_id", parsing.duration_seconds(text).cast("bigint").alias("seconds"))


@query("SELECT p_partkey, left(regexp_replace(concat(p_name, ' / ', p_type, ' ', p_brand, ' ', p_name), '[^\\w\\-.]', '_', 'g'), 50) AS name FROM part")
def g09_file_name(t: Tables) -> DataFrame:
    return t.read("part").select("p_partkey", links.file_name(F.concat_ws(" ", "p_name", F.lit("/"), "p_type", "p_brand", "p_name")).alias("name"))


@query("SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS crawl_id FROM events")
def g13_crawl_id(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", parsing.crawl_id(F.col("ts")).alias("crawl_id"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id % 1000 WHEN 1 THEN event_id % 77 ELSE 0 END AS seconds, event_id % 4 < 3 AS found FROM events")
def g14_flood_wait(t: Tables) -> DataFrame:
    e = F.col("event_id")
    text = F.when(e % 4 == 0, F.concat(F.lit("420 FLOOD_WAIT_"), (e % 1000).cast("string"))).when(e % 4 == 1, F.concat(F.lit("[429] retry after "), (e % 77).cast("string"))).when(e % 4 == 2, "FLOOD_WAIT_soon").otherwise("other")
    return t.read("events").select("event_id", parsing.flood_wait(text).alias("w")).select("event_id", "w.seconds", "w.found")


@query("SELECT event_id, event_id % 6 < 4 AS permanent FROM events")
def g15_permanent_error(t: Tables) -> DataFrame:
    texts = F.array(*map(F.lit, ("failed [400] bad", "400 USERNAME_INVALID", "400 USERNAME_NOT_OCCUPIED", "no messages found in the chat", "404 not found", "FLOOD_WAIT_3")))
    return t.read("events").select("event_id", parsing.permanent_error(F.get(texts, (F.col("event_id") % 6).cast("int"))).alias("permanent"))


@query("SELECT event_id, event_id % 5 IN (3, 4) AS retryable FROM events")
def g16_retryable_error(t: Tables) -> DataFrame:
    texts = F.array(*map(F.lit, ("channel not found", "access denied", "forbidden", "timeout", "Forbidden")))
    return t.read("events").select("event_id", parsing.retryable_error(F.get(texts, (F.col("event_id") % 5).cast("int"))).alias("retryable"))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'valid' WHEN 1 THEN 'not_channel' WHEN 2 THEN 'invalid' ELSE 'blocked' END AS status, CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'not_supergroup' WHEN 2 THEN 'not_found' ELSE 'unknown_title' END AS reason FROM pages")
def g17_html_verdict(t: Tables) -> DataFrame:
    k = F.col("page_id") % 4
    title = F.when(k == 0, "<title> Telegram: View @chan\n</title>").when(k == 1, "<title>Telegram: Contact @x</title>").when(k == 2, '<TITLE>Telegram: Contact @x</TITLE><meta name="robots" content="NOINDEX, nofollow">').otherwise("")
    return t.read("pages").select("page_id", parsing.page_verdict(F.concat(title, "html")).alias("v")).select("page_id", "v.status", "v.reason")


@query("SELECT page_id, trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), E' \\t\\r\\n') AS title FROM pages")
def g18_html_title(t: Tables) -> DataFrame:
    return t.read("pages").select("page_id", parsing.html_title(F.col("html")).alias("title"))


@query("SELECT page_id, page_id % 2 = 0 AS noindex FROM pages")
def g19_html_noindex(t: Tables) -> DataFrame:
    robots = F.when(F.col("page_id") % 2 == 0, '<meta name="robots" content="NoIndex">').otherwise('<meta name="robots" content="all"><meta name="robots" content="noindex">')
    return t.read("pages").select("page_id", parsing.html_noindex(F.concat(F.col("html"), robots)).alias("noindex"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'transient' ELSE 'blocked' END AS outcome FROM events")
def g20_http_outcome(t: Tables) -> DataFrame:
    codes = F.array(*map(F.lit, (200, 503, 302, 429)))
    return t.read("events").select("event_id", parsing.http_outcome(F.get(codes, (F.col("event_id") % 4).cast("int"))).alias("outcome"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN concat('https://www.youtube.com/@', p_brand) ELSE concat('https://www.youtube.com/channel/', p_brand) END AS url FROM part")
def g21_channel_url(t: Tables) -> DataFrame:
    name = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("@"), "p_brand")).otherwise(F.col("p_brand"))
    return t.read("part").select("p_partkey", links.channel_url(name).alias("url"))


@query("SELECT event_id, CASE WHEN event_id % 20 < 5 THEN 'cache' WHEN event_id % 20 < 15 THEN 'local' ELSE 'server' END AS source FROM events")
def g22_latency_source(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", parsing.latency_source(F.col("event_id") % 20).alias("source"))


@query("SELECT event_id, left(sha256(concat_ws(':', 'x', CAST(event_id AS STRING))), 8) AS id FROM events")
def g23_hashed_id(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", parsing.hashed_id(F.lit("x"), F.col("event_id").cast("string")).alias("id"))


@query(f"SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'too_short' WHEN 1 THEN 'invalid_start_char' WHEN 2 THEN 'ends_with_underscore' WHEN 3 THEN 'invalid_char' WHEN 4 THEN 'bot_suffix' WHEN 5 THEN 'invalid_char' WHEN 6 THEN 'too_long' WHEN 7 THEN NULL ELSE 'too_short' END AS fault FROM events")
def d06_username_filter(t: Tables) -> DataFrame:
    return t.read("events").select("event_id", links.username_fault(F.expr(_NAME)).alias("fault"))


@query("SELECT number, length(id) = 11 AND lower(left(id, 5)) = concat('abc', CAST(number % 90 + 10 AS STRING)) AND substring(id, 6, 1) = '-' AS matches FROM v_videos")
def d16_prefix_match(t: Tables) -> DataFrame:
    return t.videos.select("number", links.prefix_match(F.col("id"), F.concat(F.lit("abc"), (F.col("number") % 90 + 10).cast("string"))).alias("matches"))


@query("SELECT channel_id, count(*)::BIGINT AS videos FROM v_videos GROUP BY channel_id HAVING count(*) > 10")
def d17_large_channels(t: Tables) -> DataFrame:
    return t.videos.groupBy("channel_id").agg(F.count("*").alias("videos")).filter("videos > 10")


_OWN_RULES = {"text": ("critical", "text is required"), "lang": ("log", "lang is empty"), "quality": ("unavailable", "quality is zero"), "toxic": ("log", "toxic is zero"), "tags": ("optional", "tags is empty")}


def _ruled(t: Tables) -> DataFrame:
    docs = t.read("documents").join(t.read("labels"), "doc_id", "left")
    text = F.when(F.col("doc_id") % 10 == 0, "").when(F.col("doc_id") % 10 == 1, F.lit(None)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"), "lang", "quality", "toxic", F.when(F.col("doc_id") % 2 == 0, F.array().cast("array<string>")).otherwise(F.array("source")).alias("tags"))


_RULED = "(SELECT d.doc_id, CASE WHEN d.doc_id % 10 < 2 THEN '' ELSE text END AS text, coalesce(quality, 0) AS q, coalesce(toxic, 0) AS x FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"


@query(f"SELECT doc_id, text <> '' AS valid, CASE WHEN text = '' THEN 1 ELSE 0 END AS errors, CASE WHEN x = 0 THEN 1 ELSE 0 END AS warnings, CASE WHEN q = 0 THEN 1 ELSE 0 END AS unavailable FROM {_RULED}")
def d04_validation(t: Tables) -> DataFrame:
    out = nulls.validate(_ruled(t), _OWN_RULES)
    return out.select("doc_id", "valid", *[F.size(c).alias(c) for c in ("errors", "warnings", "unavailable")])


@query(f"""
    SELECT doc_id, 'text' AS path, 'critical' AS behavior FROM {_RULED} WHERE text = '' UNION ALL SELECT doc_id, 'quality', 'unavailable' FROM {_RULED} WHERE q = 0
    UNION ALL SELECT doc_id, 'toxic', 'log' FROM {_RULED} WHERE x = 0 UNION ALL SELECT doc_id, 'tags', 'optional' FROM {_RULED} WHERE doc_id % 2 = 0""")
def d04_null_events(t: Tables) -> DataFrame:
    return nulls.events(nulls.validate(_ruled(t), _OWN_RULES), "doc_id").select("doc_id", "path", "behavior")


@query(f"SELECT doc_id FROM {_RULED} WHERE text <> ''")
def d05_valid_channels(t: Tables) -> DataFrame:
    return nulls.valid_channels(nulls.validate(_ruled(t), _OWN_RULES)).select("doc_id")


@query(f"SELECT user_id FROM events GROUP BY user_id HAVING max(ts) > {NOW} - INTERVAL 3 DAY")
def d07_active_channels(t: Tables) -> DataFrame:
    return stats.active(t.read("events"), ["user_id"], "ts", now() - F.expr("INTERVAL 3 DAYS")).select("user_id")


@query("SELECT c_custkey, c_custkey % 3 = 0 OR c_custkey % 4 = 0 OR c_custkey % 1000 < 100 AS dead FROM customer")
def d08_dead_end(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    dead = stats.dead_end(F.when(k % 3 != 0, F.lit(True)), F.when(k % 4 != 0, k), k % 1000, 100, False)
    return t.read("customer").select("c_custkey", dead.alias("dead"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'bad_id' WHEN event_id % 5 = 0 THEN 'bad_depth' END AS fault FROM events")
def d11_message_check(t: Tables) -> DataFrame:
    from ..operators.checks import work_item_fault

    items = t.read("events").select("event_id", F.when(F.col("event_id") % 4 != 0, F.col("event_id").cast("string")).otherwise("").alias("id"), F.lit("u").alias("url"), F.when(F.col("event_id") % 5 == 0, -1).otherwise(1).alias("depth"), F.lit("telegram").alias("platform"))
    return items.select("event_id", work_item_fault().alias("fault"))


@query("SELECT message_id, message_id * 1048576 // 1048576 AS public_id, concat('https://t.me/chan', CAST(chat_id AS STRING), '/', CAST(message_id AS STRING), CASE WHEN message_id % 2 = 0 THEN '?single' ELSE '' END) AS link FROM v_messages")
def c02_message_link(t: Tables) -> DataFrame:
    name, stored = F.concat(F.lit("chan"), F.col("chat_id").cast("string")), F.col("message_id") * 1048576
    return t.messages.select("message_id", links.public_message_id(stored).alias("public_id"), links.message_link(name, stored, F.col("message_id") % 2 == 0).alias("link"))


def _raw(t: Tables) -> DataFrame:
    m = t.messages
    n, none = F.col("message_id").cast("string"), F.lit(None).cast("string")
    text = F.concat(F.lit("go t.me/Next_"), n, F.lit(" t.me/next_"), n)
    kind = F.when(F.col("kind") == "view", "messageText").when(F.col("kind") == "click", "messagePhoto").when(F.col("kind") == "signup", "messageDocument").otherwise("messageSticker")
    content = F.struct(text.alias("text"), F.concat(F.lit("cap "), n).alias("caption"), none.alias("emoji"), none.alias("question"), none.alias("prize"), F.concat(n, F.lit(".pdf")).alias("file_name"), F.concat(F.lit("thumb"), n).alias("thumbnail"), none.alias("media"))
    reaction = lambda kind, emoji, c: F.struct(F.lit(kind).alias("type"), F.lit(emoji).alias("emoji"), c.cast("bigint").alias("count"))
    return m.select(
        (F.col("message_id") * 1048576).alias("message_id"), "chat_id", F.concat(F.lit("chan"), F.col("chat_id").cast("string")).alias("username"), F.concat(F.lit("Title "), F.col("chat_id").cast("string")).alias("chat_title"), kind.alias("kind"), content.alias("content"),
        F.col("ts").cast("timestamp").alias("date"), "views", F.lit(2).alias("shares"), F.lit(False).alias("album"), F.lit(50).alias("member_count"), F.lit(3).alias("post_count"), F.lit(9).alias("total_views"),
        F.array().cast("array<struct<text:string,reactions:map<string,bigint>,view_count:bigint,reply_count:bigint,handle:string>>").alias("comments"),
        F.array(reaction("emoji", "👍", F.col("message_id")), reaction("custom", "x", F.lit(1)), reaction("emoji", "👍", F.col("message_id") + 1)).alias("reactions"),
        F.struct(F.when(F.col("message_id") % 2 == 0, "poster").alias("username"), F.lit("Ann").alias("first"), F.lit("").alias("last")).alias("sender"),
    )


@query(f"""
    SELECT concat(CAST(message_id AS STRING), '-chan', CAST(chat_id AS STRING)) AS post_uid, CAST(chat_id AS STRING) AS channel_id, coalesce(views, 0) AS engagement,
      CASE kind WHEN 'view' THEN concat('go t.me/Next_', CAST(message_id AS STRING), ' t.me/next_', CAST(message_id AS STRING)) WHEN 'click' THEN concat('cap ', CAST(message_id AS STRING)) WHEN 'signup' THEN concat(CAST(message_id AS STRING), '.pdf') ELSE '' END AS description,
      CASE WHEN kind = 'view' THEN concat('next_', CAST(message_id AS STRING)) ELSE '' END AS outlinks, message_id + 1 AS thumbs_up, CASE WHEN message_id % 2 = 0 THEN 'poster' ELSE 'Ann' END AS handle, strftime(ts, '%Y-%m-%d') AS day
    FROM v_messages WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'""")
def c01_message_post(t: Tables) -> DataFrame:
    out = posts.message_posts(_raw(t), F.expr("TIMESTAMP '2024-01-31 00:00:00'"), F.expr("TIMESTAMP '2024-01-10 00:00:00'"))
    return out.select("post_uid", "channel_id", "engagement", "description", F.array_join("outlinks", ",").alias("outlinks"), F.element_at("reactions", F.lit("👍")).alias("thumbs_up"), "handle", F.date_format("published_at", "yyyy-MM-dd").alias("day"))


def _fetched(t: Tables) -> DataFrame:
    """The messages as JSON texts; every seventh has a number where the text should be, and all have a field that nobody reads."""
    m = _raw(t)
    c = lambda name: F.col(f"content.{name}")
    named = lambda name, kind: F.struct(F.lit(kind).alias("@type"), name)
    reaction = lambda r: F.struct(F.struct(F.when(r["type"] == "emoji", "reactionTypeEmoji").otherwise("reactionTypeCustom").alias("@type"), r["emoji"].alias("emoji")).alias("type"), r["count"].alias("total_count"))
    content = F.struct(F.col("kind").alias("@type"), named(c("text").alias("text"), "formattedText").alias("text"), F.struct(c("caption").alias("text")).alias("caption"), F.struct(c("file_name").alias("file_name")).alias("document"), F.lit(1).alias("added_later"))
    info = F.struct(F.col("views").alias("view_count"), F.col("shares").alias("forward_count"), F.struct(F.transform("reactions", reaction).alias("reactions")).alias("reactions"))
    sender = F.struct(F.col("sender.username").alias("username"), F.col("sender.first").alias("first_name"), F.col("sender.last").alias("last_name"))
    whole = F.to_json(F.struct(F.col("message_id").alias("id"), "chat_id", F.unix_timestamp("date").alias("date"), content.alias("content"), info.alias("interaction_info"), sender.alias("sender")))
    odd = F.regexp_replace(whole, r'"text":"go [^"]*"', '"text":12')
    return m.select(F.when(F.col("message_id") / 1048576 % 7 == 0, odd).otherwise(whole).alias("value"), "chat_id", "chat_title", "member_count", "post_count", "total_views", "comments")


@query(f"""
    SELECT concat(CAST(message_id AS STRING), '-chan', CAST(chat_id AS STRING)) AS post_uid, coalesce(views, 0) AS engagement,
      CASE kind WHEN 'view' THEN CASE WHEN message_id % 7 = 0 THEN '12' ELSE concat('go t.me/Next_', CAST(message_id AS STRING), ' t.me/next_', CAST(message_id AS STRING)) END WHEN 'click' THEN concat('cap ', CAST(message_id AS STRING)) WHEN 'signup' THEN concat(CAST(message_id AS STRING), '.pdf') ELSE '' END AS description,
      message_id + 1 AS thumbs_up, CASE WHEN message_id % 2 = 0 THEN 'poster' ELSE 'Ann' END AS handle, strftime(ts, '%Y-%m-%d') AS day FROM v_messages""")
def c01_variant_post(t: Tables) -> DataFrame:
    """Posts from JSON texts by way of variants; what the chat knows is joined."""
    lines = _fetched(t)
    chats = lines.select("chat_id", "chat_title", "member_count", "post_count", "total_views").distinct()
    rows = posts.raw_messages(lines).join(chats, "chat_id").withColumns({"username": F.concat(F.lit("chan"), F.col("chat_id").cast("string")), "comments": F.array().cast("array<struct<text:string,reactions:map<string,bigint>,view_count:bigint,reply_count:bigint,handle:string>>")})
    out = posts.message_posts(rows, F.expr("TIMESTAMP '2024-01-31 00:00:00'"))
    return out.select("post_uid", "engagement", "description", F.element_at("reactions", F.lit("👍")).alias("thumbs_up"), "handle", F.date_format("published_at", "yyyy-MM-dd").alias("day"))


def _videos(t: Tables) -> DataFrame:
    v = t.videos
    thumbs = F.create_map(F.lit("default"), F.lit("d.jpg"), F.lit("high"), F.when(F.col("number") % 2 == 0, "h.jpg").otherwise(""))
    return v.select("number", F.concat("id", F.col("number").cast("string")).alias("id"), "channel_id", "title", F.concat(F.col("description"), F.lit(" http://x.example/"), F.col("number").cast("string"), F.lit(".")).alias("description"), F.col("published_at").cast("timestamp").alias("published_at"), "views", "likes", "comments", thumbs.alias("thumbnails"), F.concat(F.lit("PT"), F.col("size").cast("string"), F.lit("S")).alias("duration"), F.lit("en").alias("language"))


def _video_channels(t: Tables) -> DataFrame:
    return t.videos.filter("substring(channel_id, 3, 9) % 2 = 0").select("channel_id").distinct().select("channel_id", F.concat(F.lit("Name "), "channel_id").alias("name"), F.lit(7).alias("subscribers"))


@query("""
    SELECT concat(id, CAST(number AS STRING)) AS post_uid, likes + comments + views // 100 AS engagement, CASE WHEN number % 2 = 0 THEN 'h.jpg' ELSE 'd.jpg' END AS thumb_url, CAST(size AS INT) AS video_length,
      CASE WHEN CAST(substring(channel_id, 3, 9) AS INT) % 2 = 0 THEN concat('Name ', channel_id) ELSE channel_id END AS channel_name, concat('http://x.example/', CAST(number AS STRING)) AS outlinks, 2::BIGINT AS pictures FROM v_videos""")
def c03_video_post(t: Tables) -> DataFrame:
    out = posts.video_posts(_videos(t), _video_channels(t), F.expr("TIMESTAMP '2024-01-31 00:00:00'"))
    return out.select("post_uid", "engagement", "thumb_url", "video_length", "channel_name", F.array_join("outlinks", ",").alias("outlinks"), F.size("ocr_data").cast("bigint").alias("pictures"))


@query("SELECT concat(id, CAST(number AS STRING)) AS post_uid, views AS view_count, concat(title, chr(10), chr(10), description, ' http://x.example/', CAST(number AS STRING), '.') AS description FROM v_videos")
def c04_generic_post(t: Tables) -> DataFrame:
    rows = posts.video_messages(_videos(t)).withColumns({"language": F.lit("en"), "sender_name": F.col("sender_id"), "type": F.lit("video")})
    return posts.generic_posts(rows, F.expr("TIMESTAMP '2024-01-31 00:00:00'")).select("post_uid", "view_count", "description")


@query("SELECT c_custkey, c_name AS channel_name, c_custkey * 2 AS follower_count, 0::BIGINT AS share_count, '' AS country_code FROM customer")
def c05_channel(t: Tables) -> DataFrame:
    c = posts.channel({"channel_name": F.col("c_name"), "follower_count": F.col("c_custkey") * 2})
    return t.read("customer").select("c_custkey", c.alias("c")).select("c_custkey", "c.channel_name", "c.channel_engagement_data.follower_count", "c.channel_engagement_data.share_count", "c.country_code")


@query("SELECT conv_id, turn, text, 0::BIGINT AS view_count, role AS handle FROM conversations")
def c06_comment(t: Tables) -> DataFrame:
    none = F.lit(None)
    c = posts.comment(F.col("text"), F.create_map().cast("map<string,bigint>"), none, none, F.col("role"))
    return t.read("conversations").select("conv_id", "turn", c.alias("c")).select("conv_id", "turn", "c.text", "c.view_count", "c.handle")


@query("SELECT event_id, event_id % 7 AS up, CASE WHEN event_id % 2 = 0 THEN 1 END AS heart FROM events")
def c07_reactions(t: Tables) -> DataFrame:
    r = lambda kind, emoji, n: F.struct(F.lit(kind).alias("type"), F.lit(emoji).alias("emoji"), n.cast("bigint").alias("count"))
    e = F.col("event_id")
    some = F.array(r("emoji", "up", F.lit(99)), F.struct(F.when(e % 2 == 0, "emoji").otherwise("paid").alias("type"), F.lit("heart").alias("emoji"), F.lit(1).cast("bigint").alias("count")), r("emoji", "up", e % 7))
    m = posts.reaction_counts(some)
    return t.read("events").select("event_id", F.try_element_at(m, F.lit("up")).alias("up"), F.try_element_at(m, F.lit("heart")).cast("int").alias("heart"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'name' WHEN 1 THEN 'Ann Lee' WHEN 2 THEN 'chat' ELSE 'unknown' END AS poster FROM customer")
def c08_poster(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 4
    return t.read("customer").select("c_custkey", posts.poster(F.when(k == 0, "name").otherwise(""), F.when(k == 1, "Ann"), F.when(k == 1, "Lee"), F.when(k == 2, "chat")).alias("poster"))


@query("SELECT concat(id, CAST(number AS STRING)) AS id, length(title) + 2 + length(description) + length(CAST(number AS STRING)) + 19 AS chars, likes AS liked FROM v_videos")
def c09_video_message(t: Tables) -> DataFrame:
    return posts.video_messages(_videos(t)).select("id", F.length("text").cast("bigint").alias("chars"), F.element_at("reactions", F.lit("like")).alias("liked"))


@query("SELECT page_id AS id, url, depth, 0 AS retry_count, 15 AS walkback_rate FROM v_pages")
def c10_work_item(t: Tables) -> DataFrame:
    pages = t.pages.select(F.col("page_id").alias("id"), "url", "depth", "crawl_id", F.lit("telegram").alias("platform"), F.lit(None).cast("string").alias("parent_id"))
    return posts.work_item(pages, now(), walkback_rate=F.lit(15)).select("id", "url", "depth", "retry_count", "config.walkback_rate")


@query("SELECT page_id AS parent_id, url, depth + 1 AS depth, 'unfetched' AS status, sha256(concat_ws(':', page_id, url)) AS id FROM v_pages")
def c11_discovered_page(t: Tables) -> DataFrame:
    return posts.discovered_pages(t.pages.select("url", F.col("page_id").alias("parent_id"), "depth"), now()).select("parent_id", "url", "depth", "status", "id")


@query("SELECT n_nationkey, lower(n_name) AS seed FROM nation")
def b03_seed_name(t: Tables) -> DataFrame:
    k = F.col("n_nationkey") % 4
    line = F.concat(F.when(k == 0, "https://t.me/").when(k == 1, "http://t.me/").when(k == 2, "t.me/@").otherwise("@"), F.upper("n_name"))
    return t.read("nation").select("n_nationkey", links.seed_name(line).alias("seed"))


@query("SELECT seed FROM (SELECT trim(n_name) AS seed FROM nation WHERE n_nationkey % 3 = 0)")
def b01_seed_list(t: Tables) -> DataFrame:
    from ..sources.files import seed_lines

    k = F.col("n_nationkey") % 3
    return seed_lines(t.read("nation").select(F.when(k == 0, F.concat(F.lit("  "), "n_name", F.lit("\t"))).when(k == 1, F.concat(F.lit(" # "), "n_name")).otherwise("   ").alias("value")))


@query("SELECT event_id, concat_ws('/', concat('crawl', CAST(event_id % 3 AS STRING)), CASE WHEN event_id % 2 = 0 THEN event_type END, 'posts') AS path FROM events")
def b25_storage_path(t: Tables) -> DataFrame:
    from ..sources.files import storage_path

    crawl = F.concat(F.lit("crawl"), (F.col("event_id") % 3).cast("string"))
    return t.read("events").select("event_id", storage_path(crawl, F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise(""), "posts").alias("path"))


@query("SELECT event_id FROM events WHERE event_type = 'view' ORDER BY md5(concat_ws(':', '11', CAST(event_id AS STRING))), event_id LIMIT 100")
def f11_hash_sample(t: Tables) -> DataFrame:
    return tables.random_rows(t.read("events").filter("event_type = 'view'"), 100, "11", "event_id").select("event_id")
