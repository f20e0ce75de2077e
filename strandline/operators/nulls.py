"""Null rules: which empty fields of a post make it invalid, are logged, or are never there on a platform."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Dotted paths by behaviour, for both platforms and where they differ.
CRITICAL = "channel_data.channel_id channel_data.channel_name channel_data.channel_url post_link channel_id post_uid url published_at platform_name".split()
LOGGED = (
    "channel_data.channel_description channel_data.channel_profile_image channel_data.channel_engagement_data.follower_count channel_data.channel_engagement_data.post_count "
    "channel_data.channel_engagement_data.views_count channel_data.channel_url_external created_at engagement view_count comment_count crawl_label channel_name "
    "description post_type comments_count views_count thumb_url media_url reactions outlinks capture_time handle"
).split()
UNAVAILABLE = (
    "channel_data.channel_engagement_data.following_count channel_data.channel_engagement_data.like_count channel_data.channel_engagement_data.comment_count "
    "channel_data.channel_engagement_data.share_count list_ids search_terms search_term_ids project_ids exercise_ids label_data labels_metadata project_labeled_post_ids "
    "labeler_ids all_labels label_ids transcript_text image_text is_verified shared_id quoted_id replied_id ai_label root_post_id engagement_steps_count "
    "performance_scores.shares repost_channel_data inner_link is_reply ad_fields contrast_agent_project_ids agent_ids segment_ids"
).split()
#: path: (video platform, message platform)
DIFFERENT = {
    "channel_data.country_code": ("optional", "unavailable"),
    "channel_data.published_at": ("log", "unavailable"),
    "language_code": ("log", "unavailable"),
    "like_count": ("log", "unavailable"),
    "likes_count": ("log", "unavailable"),
    "share_count": ("unavailable", "log"),
    "shares_count": ("unavailable", "log"),
    "is_ad": ("unavailable", "log"),
    "video_length": ("log", "unavailable"),
    "ocr_data": ("log", "unavailable"),
    "performance_scores.likes": ("log", "unavailable"),
    "performance_scores.comments": ("log", "unavailable"),
    "performance_scores.views": ("log", "unavailable"),
    "has_embed_media": ("log", "unavailable"),
    "post_title": ("log", "unavailable"),
    "media_data.document_name": ("log", "unavailable"),
    "searchable_text": ("log", "unavailable"),
    "all_text": ("log", "unavailable"),
    "comments": ("unavailable", "log"),
}
PLATFORMS = ("youtube", "telegram")
#: Fields that are true nullables, for which only null is empty.
POINTERS = "video_length is_verified shared_id quoted_id replied_id ai_label root_post_id performance_scores.likes performance_scores.shares performance_scores.comments has_embed_media repost_channel_data post_title is_reply ad_fields".split()

Rules = dict[str, tuple[str, str]]


def message(path: str, behavior: str, platform: str) -> str:
    """What an empty field is told as; texts of this library's own."""
    return f"{path} {({'critical': 'is required', 'unavailable': f'is never there on {platform}'}).get(behavior, 'is empty')}"


def default_rules(platform: str) -> Rules:
    """path: (behaviour, message); an unknown platform is an error."""
    which = PLATFORMS.index(platform) if platform in PLATFORMS else None
    if which is None:
        raise ValueError(f"unknown platform {platform!r}")
    kinds = {p: "critical" for p in CRITICAL} | {p: "log" for p in LOGGED} | {p: "unavailable" for p in UNAVAILABLE} | {p: b[which] for p, b in DIFFERENT.items()}
    return {p: (b, message(p, b, platform)) for p, b in kinds.items()}


def merged_rules(platform: str, own: Mapping[str, tuple[str, str]] | None = None) -> Rules:
    """The default rules with a user's own put over them."""
    return default_rules(platform) | dict(own or {})


def rules_table(spark: SparkSession, rules: Rules) -> DataFrame:
    return spark.createDataFrame([(p, b, m) for p, (b, m) in rules.items()], "path string, behavior string, message string")


def is_empty(value: Column, kind: T.DataType) -> Column:
    """Null, or the zero of the type: empty text, list or map, 0, false."""
    empty = value.isNull()
    if isinstance(kind, T.StringType):
        return empty | (value == "")
    if isinstance(kind, T.BooleanType):
        return empty | ~value
    if isinstance(kind, T.NumericType):
        return empty | (value == 0)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return empty | (F.size(value) == 0)
    return empty


def leaves(schema: T.StructType, above: str = "") -> Iterable[tuple[str, T.DataType]]:
    """Dotted paths of all fields, those of structs in their place."""
    for f in schema:
        path = above + f.name
        if isinstance(f.dataType, T.StructType):
            yield from leaves(f.dataType, path + ".")
        else:
            yield path, f.dataType


def nullable_pointer(path: str) -> bool:
    """Whether a field is a true nullable, for which only null is empty."""
    return path in POINTERS


def empty_fields(schema: T.StructType, rules: Rules) -> Column:
    """array<struct<path, behavior, message>> of the empty fields that have a rule, in the order of the schema."""
    kinds = "array<struct<path:string,behavior:string,message:string>>"
    checks = []
    for path, kind in leaves(schema):
        if path in rules:
            behavior, text = rules[path]
            value = F.col(path)
            empty = value.isNull() if nullable_pointer(path) else is_empty(value, kind)
            checks.append(F.when(empty, F.struct(F.lit(path).alias("path"), F.lit(behavior).alias("behavior"), F.lit(text).alias("message"))))
    return F.array_compact(F.array(*checks)).cast(kinds) if checks else F.array().cast(kinds)


def validate(rows: DataFrame, rules: Rules, schema: T.StructType | None = None) -> DataFrame:
    """Add `events` (empty fields with a rule), errors, warnings, unavailable (messages) and valid (no errors).

    Critical events are errors, logged ones warnings; optional ones are events only. Fields without a rule are ignored."""
    rows = rows.withColumn("events", empty_fields(schema or rows.schema, rules))
    of = lambda b: F.transform(F.filter("events", lambda e: e["behavior"] == b), lambda e: e["message"])
    rows = rows.withColumns({"errors": of("critical"), "warnings": of("log"), "unavailable": of("unavailable")})
    return rows.withColumn("valid", F.size("errors") == 0)


def events(validated: DataFrame, *keys: str) -> DataFrame:
    """One row for each event."""
    return validated.select(*keys, F.explode("events").alias("e")).select(*keys, "e.path", "e.behavior", "e.message")


def valid_channels(validated: DataFrame) -> DataFrame:
    """Invalid channels are left out; invalid posts are stored with their flag."""
    return validated.filter("valid")
