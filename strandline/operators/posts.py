"""Raw messages and videos to posts, channels and comments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.links import channel_links, channel_url, message_link, public_message_id, urls
from ..functions.parsing import duration_seconds
from ..schemas import POST, struct
from . import tables

#: Message types whose text is their own, and those with a caption; others have none. Fixed values.
TEXT_TYPES = ("messageText",)
CAPTION_TYPES = ("messageVideo", "messagePhoto", "messageAnimation", "messageAudio", "messageVoiceNote", "messageDocument", "messagePaidMedia")
THUMB_SIZES = ("maxres", "high", "medium", "default")


def as_posts(rows: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """Rows with all columns of a post, in order; those without a value are null."""
    kinds = struct(POST)
    return rows.select(*[(values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds])


def content_text(kind: Column, text: Column, caption: Column) -> Column:
    """The text that a message shows: its own or its caption by type; null for other types."""
    return F.when(kind.isin(*TEXT_TYPES), text).when(kind.isin(*CAPTION_TYPES), caption)


def post_description(kind: Column, content: Mapping[str, Column]) -> Column:
    """Description by content type; empty for types without one."""
    return (
        F.when(kind == "messageText", content["text"])
        .when(kind.isin("messageVideo", "messagePhoto", "messageAnimation", "messagePaidMedia"), content["caption"])
        .when(kind == "messageAnimatedEmoji", content["emoji"])
        .when(kind == "messagePoll", content["question"])
        .when(kind == "messageGiveaway", content["prize"])
        .when(kind == "messageDocument", content["file_name"])
        .otherwise(F.lit(""))
    )


def poster(username: Column, first: Column, last: Column, chat_title: Column) -> Column:
    """Who posted: user name, else full name, else the chat's title, else unknown."""
    full = F.nullif(F.trim(F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit("")))), F.lit(""))
    return F.coalesce(F.nullif(username, F.lit("")), full, F.nullif(chat_title, F.lit("")), F.lit("unknown"))


def reaction_counts(reactions: Column) -> Column:
    """map<emoji, count> of emoji reactions; of one given twice the last counts."""
    emoji = F.filter(F.coalesce(reactions, F.array().cast("array<struct<type:string,emoji:string,count:bigint>>")), lambda r: r["type"] == "emoji")
    # later entries of a key replace earlier ones
    kept = F.aggregate(emoji, F.array().cast("array<struct<key:string,value:bigint>>"), lambda out, r: F.concat(F.filter(out, lambda o: o["key"] != r["emoji"]), F.array(F.struct(r["emoji"].alias("key"), r["count"].alias("value")))))
    return F.map_from_entries(kept)


def comment(text: Column, reactions: Column, views: Column, replies: Column, handle: Column) -> Column:
    return F.struct(F.coalesce(text, F.lit("")).alias("text"), reactions.alias("reactions"), F.coalesce(views, F.lit(0)).cast("bigint").alias("view_count"), F.coalesce(replies, F.lit(0)).cast("bigint").alias("reply_count"), handle.alias("handle"))


def capped(comments: Column, most: int) -> Column:
    """The first comments: none for 0, all for -1."""
    return comments if most < 0 else F.slice(comments, 1, most) if most else F.slice(comments, 1, 0)


def channel(values: Mapping[str, Column]) -> Column:
    """A channel struct from the values given; counts that are missing are 0, texts empty."""
    text = lambda name: F.coalesce(values.get(name, F.lit(None)).cast("string"), F.lit("")).alias(name)
    number = lambda name: F.coalesce(values.get(name, F.lit(None)).cast("bigint"), F.lit(0)).alias(name)
    engagement = F.struct(*[number(n) for n in ("follower_count", "following_count", "like_count", "post_count", "views_count", "comment_count", "share_count")])
    return F.struct(
        *[text(n) for n in ("channel_id", "channel_name", "channel_description", "channel_profile_image")], engagement.alias("channel_engagement_data"),
        *[text(n) for n in ("channel_url_external", "channel_url", "country_code")], values.get("published_at", F.lit(None)).cast("timestamp").alias("published_at"),
    )


def message_posts(messages: DataFrame, now: Column, min_date: Column | None = None) -> DataFrame:
    """Messages (message_id, chat_id, username, chat_title, kind, content struct, date, views, shares, album, member_count,
    post_count, total_views, comments, reactions, sender struct) as posts. Messages before min_date are left out."""
    rows = messages if min_date is None else messages.filter(F.col("date") >= min_date)
    c = lambda name: F.col(f"content.{name}")
    content = {n: c(n) for n in ("text", "caption", "emoji", "question", "prize", "file_name")}
    kind, link = F.col("kind"), message_link(F.col("username"), F.col("message_id"), F.col("album"))
    description, views = post_description(kind, content), F.coalesce("views", F.lit(0))
    address = F.concat(F.lit("https://t.me/c/"), F.col("username"))
    comments = F.size(F.coalesce("comments", F.array()))
    own = channel({"channel_id": F.col("chat_id"), "channel_name": F.col("chat_title"), "follower_count": F.col("member_count"), "post_count": F.col("post_count"), "views_count": F.col("total_views"), "channel_url_external": address, "channel_url": address})
    zero, empty = F.lit(0), F.lit("")
    return as_posts(rows, {
        "post_link": link, "url": link, "channel_id": F.col("chat_id").cast("string"), "post_uid": F.concat(public_message_id(F.col("message_id")).cast("string"), F.lit("-"), F.col("username")),
        "published_at": F.col("date"), "created_at": now, "capture_time": now, "language_code": empty, "engagement": views, "view_count": views, "views_count": views, "like_count": zero, "likes_count": zero,
        "share_count": F.coalesce("shares", zero), "shares_count": F.coalesce("shares", zero), "comment_count": comments, "comments_count": comments, "channel_name": F.col("chat_title"), "is_ad": F.lit(False),
        "transcript_text": empty, "image_text": empty, "searchable_text": empty, "all_text": empty, "channel_data": own, "platform_name": F.lit("Telegram"), "description": description,
        "post_type": F.array(F.coalesce(kind, F.lit("unknown"))), "thumb_url": F.coalesce(c("thumbnail"), empty), "media_url": F.coalesce(c("media"), empty), "comments": F.col("comments"),
        "reactions": reaction_counts(F.col("reactions")), "outlinks": F.array_distinct(channel_links(description)), "handle": poster(F.col("sender.username"), F.col("sender.first"), F.col("sender.last"), F.col("chat_title")),
    })


def best_thumbnail(thumbnails: Column) -> Column:
    """The largest thumbnail there is; empty if none."""
    return F.coalesce(*[F.nullif(F.try_element_at(thumbnails, F.lit(k)), F.lit("")) for k in THUMB_SIZES], F.lit(""))


def video_engagement(likes: Column, comments: Column, views: Column) -> Column:
    """Likes, comments and a hundredth of the views, rounded down."""
    zero = F.lit(0)
    return F.coalesce(likes, zero) + F.coalesce(comments, zero) + F.floor(F.coalesce(views, zero) / 100)


def video_posts(videos: DataFrame, channels: DataFrame, now: Column) -> DataFrame:
    """Videos (id, channel_id, title, description, published_at, views, likes, comments, thumbnails, duration, language) as
    posts, with their channel (channel_id, name, ...) or a bare one where it isn't known."""
    known = channels.select(F.col("channel_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in channels.columns if c != "channel_id"])
    rows = videos.join(known, F.col("channel_id") == F.col("__id"), "left")
    address = channel_url(F.col("channel_id"))
    name = F.coalesce("__name", F.col("channel_id"))
    values = {"channel_id": F.col("channel_id"), "channel_name": name, "channel_url": address, "channel_url_external": address}
    given = {"channel_description": "__description", "follower_count": "__subscribers", "post_count": "__video_count", "views_count": "__view_count", "country_code": "__country", "published_at": "__published_at"}
    values |= {k: F.col(c) for k, c in given.items() if c.removeprefix("__") in channels.columns}
    link = F.concat(F.lit("https://www.youtube.com/watch?v="), F.col("id"))
    zero, text = F.lit(0), F.concat(F.col("title"), F.lit("\n\n"), F.col("description"))
    thumbs = F.transform(F.map_entries(F.coalesce("thumbnails", F.create_map().cast("map<string,string>"))), lambda e: F.struct(F.lit("").alias("ocr_text"), e["value"].alias("thumb_url")))
    likes, comments, views = (F.coalesce(c, zero) for c in ("likes", "comments", "views"))
    return as_posts(rows, {
        "post_link": link, "url": link, "channel_id": F.col("channel_id"), "post_uid": F.col("id"), "published_at": F.col("published_at"), "created_at": now, "capture_time": now, "language_code": F.col("language"),
        "engagement": video_engagement(likes, comments, views), "view_count": views, "views_count": views, "like_count": likes, "likes_count": likes, "share_count": zero, "shares_count": zero, "comment_count": comments,
        "comments_count": comments, "channel_name": name, "is_ad": F.lit(False), "video_length": duration_seconds(F.col("duration")), "channel_data": channel(values), "platform_name": F.lit("YouTube"), "ocr_data": thumbs,
        "performance_scores": F.struct(likes.cast("int").alias("likes"), F.lit(None).cast("int").alias("shares"), comments.cast("int").alias("comments"), views.cast("double").alias("views")),
        "has_embed_media": F.lit(True), "description": F.col("description"), "post_type": F.array(F.lit("video")), "post_title": F.col("title"), "searchable_text": text, "all_text": text,
        "thumb_url": best_thumbnail(F.col("thumbnails")), "media_url": link, "reactions": F.create_map(F.lit("like"), likes.cast("bigint")), "outlinks": urls(F.col("description")), "handle": F.col("channel_id"),
    })


def video_messages(videos: DataFrame) -> DataFrame:
    """Videos in the form of messages: title and description as text, likes as a reaction."""
    return videos.select("id", "channel_id", F.col("channel_id").alias("sender_id"), F.concat("title", F.lit("\n\n"), "description").alias("text"), "title", "description", F.col("published_at").alias("timestamp"), "views", F.create_map(F.lit("like"), F.coalesce("likes", F.lit(0))).alias("reactions"), F.col("comments").alias("comment_count"))


def generic_posts(messages: DataFrame, now: Column) -> DataFrame:
    """Messages of the common form as posts, with the few columns it has."""
    return as_posts(messages, {"post_uid": F.col("id"), "channel_id": F.col("channel_id"), "published_at": F.col("timestamp"), "created_at": now, "capture_time": now, "description": F.col("text"), "view_count": F.col("views"), "views_count": F.col("views"), "engagement": F.col("views"), "comment_count": F.col("comment_count"), "comments_count": F.col("comment_count"), "reactions": F.col("reactions"), "language_code": F.col("language"), "handle": F.col("sender_name"), "post_type": F.array("type")})


def stored_posts(posts: DataFrame, method: str, crawl_label: str) -> DataFrame:
    """Posts that a crawl stores: none for a random walk; an empty label is filled."""
    kept = posts.filter(F.lit(method != "random-walk"))
    return kept.withColumn("crawl_label", F.coalesce(F.nullif(F.col("crawl_label"), F.lit("")), F.lit(crawl_label)))


def first_comments(comments: DataFrame, keys: list[str], order: list[str], text: str, most: int) -> DataFrame:
    """keys, comments (texts in order): the first `most` of each thread; -1 keeps all, 0 none. The cap is applied before
    the texts of a thread are gathered, and in each task before the shuffle."""
    rows = comments if most < 0 else tables.top_per_key(comments, keys, [F.col(c) for c in order], most) if most else comments.limit(0)
    gathered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__text")))).alias("c"))
    return gathered.select(*keys, F.transform("c", lambda x: x["__text"]).alias("comments"))


def posts_of_jobs(jobs: DataFrame, posts: DataFrame, key: str) -> DataFrame:
    """The posts that each job stores: those of its crawl, with the job's id and label. Jobs without a crawl store none; a
    post of several jobs is stored for each."""
    rows = jobs.filter(F.coalesce(key, F.lit("")) != "").select(key, "job_id", F.col("crawl_label").alias("__label"))
    return posts.join(rows, key).withColumn("crawl_label", F.col("__label")).drop("__label")


def work_results(items: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Results of work: success with the number of posts and found channels, or error with its text; items without an
    outcome have none."""
    found = outcomes.select("id", F.col("error").alias("__error"), "post_count", "discovered")
    failed = F.coalesce("__error", F.lit("")) != ""
    return items.join(found, "id").select(
        "id", "crawl_id", "url", F.when(failed, "error").otherwise("success").alias("status"), F.when(failed, F.col("__error")).otherwise("").alias("error"),
        F.when(failed, 0).otherwise(F.coalesce("post_count", F.lit(0))).cast("bigint").alias("post_count"),
        F.when(failed, F.array().cast("array<string>")).otherwise(F.coalesce("discovered", F.array().cast("array<string>"))).alias("discovered"), now.alias("completed_at"),
    )


def work_item(pages: DataFrame, now: Column, **config: Column) -> DataFrame:
    """Pages as work for a worker, with the settings of the crawl as a struct."""
    settings = F.struct(*[v.alias(k) for k, v in config.items()]) if config else F.lit(None).alias("config")
    return pages.select("id", "url", "depth", "crawl_id", "platform", "parent_id", F.lit(0).alias("retry_count"), F.lit("").alias("assigned_to"), now.alias("created_at"), settings.alias("config"))


def pages_of_work(items: DataFrame) -> DataFrame:
    return items.select("id", "url", "depth", F.lit("unfetched").alias("status"), "crawl_id", "platform", "parent_id")


def discovered_pages(found: DataFrame, now: Column) -> DataFrame:
    """Channels found on a page (url, parent_id, depth) as pages of the next layer."""
    return found.select(F.sha2(F.concat_ws(":", "parent_id", "url"), 256).alias("id"), "url", (F.col("depth") + 1).alias("depth"), F.lit("unfetched").alias("status"), "parent_id", now.alias("timestamp"))


def with_statistics(videos: DataFrame, statistics: DataFrame, key: str) -> DataFrame:
    """Videos with their statistics; those without have nulls. A key's statistics are one row."""
    return videos.join(statistics, key, "left")


def with_channel_name(videos: DataFrame, channels: DataFrame, key: str, name: str) -> DataFrame:
    """Videos with channel_name: that of their channel, or the key where the channel isn't known."""
    named = channels.select(key, F.col(name).alias("__name"))
    return videos.join(named, key, "left").withColumn("channel_name", F.coalesce("__name", F.col(key).cast("string"))).drop("__name")


#: Places of media and thumbnails in a message's content, by type. Fixed values.
MEDIA_PATHS = ("video.video", "animation.animation", "audio.audio", "voice_note.voice", "document.document", "photo.sizes[0].photo")
THUMBNAIL_PATHS = ("video.thumbnail", "animation.thumbnail", "document.thumbnail", "audio.album_cover_thumbnail")


def raw_messages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Messages as they were fetched, JSON texts, with the columns of message_posts that a message has itself: message_id, chat_id, kind,
    content, date, views, shares, album, reactions, sender, and raw (the whole message as a variant).

    Messages are variants, so types of content that nobody knew and fields that were added later pass as they are; a value that
    can't be cast to what is asked for is null (a number is a text, a list isn't a number). Texts that aren't JSON objects with an id are left out."""
    rows = lines.select(F.try_parse_json(column).alias("raw"))

    def get(path: str, kind: str = "string", of: Column | None = None) -> Column:
        return F.try_variant_get(F.col("raw") if of is None else of, f"$.{path}", kind)

    def first(paths: tuple[str, ...], end: str) -> Column:
        return F.coalesce(*[get(f"content.{p}.{end}") for p in paths])

    content = F.struct(
        get("content.text.text").alias("text"), get("content.caption.text").alias("caption"), get("content.emoji").alias("emoji"), get("content.poll.question.text").alias("question"),
        get("content.prize.name").alias("prize"), get("content.document.file_name").alias("file_name"), first(THUMBNAIL_PATHS, "file.remote.id").alias("thumbnail"), first(MEDIA_PATHS, "remote.id").alias("media"),
    )
    reactions = F.transform(
        get("interaction_info.reactions.reactions", "array<variant>"),
        lambda r: F.struct(
            F.when(get('type["@type"]', of=r) == "reactionTypeEmoji", "emoji").otherwise("custom").alias("type"), get("type.emoji", of=r).alias("emoji"), get("total_count", "bigint", of=r).alias("count")
        ),
    )
    sender = F.struct(get("sender.username").alias("username"), get("sender.first_name").alias("first"), get("sender.last_name").alias("last"))
    return rows.filter(get("id", "bigint").isNotNull()).select(
        get("id", "bigint").alias("message_id"), get("chat_id", "bigint").alias("chat_id"), get('content["@type"]').alias("kind"), content.alias("content"), F.timestamp_seconds(get("date", "bigint")).alias("date"),
        get("interaction_info.view_count", "bigint").alias("views"), get("interaction_info.forward_count", "bigint").alias("shares"), (F.coalesce(get("media_album_id", "bigint"), F.lit(0)) != 0).alias("album"),
        reactions.alias("reactions"), sender.alias("sender"), "raw",
    )
