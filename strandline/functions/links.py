"""Links, names and addresses of channels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The link pattern, paths that name no channel, and what closes a URL in running text.
CHANNEL_LINK = r"(https?://)?t\.me/([a-zA-Z][a-zA-Z0-9_]{4,31})"
RESERVED_PATHS = ("joinchat", "addlist", "addstickers", "addtheme", "setlanguage", "share", "c", "s", "iv", "proxy", "socks", "login", "confirm", "bg")
MENTION = r"(?:@)?([a-zA-Z][a-zA-Z0-9_]{4,31})"
URL = r"https?://\S+"
URL_TAIL = ",.;:!?()'\""
CHANNEL_PATH = r"youtube\.com/channel/([\w-]+)"
HANDLE_PATH = r"youtube\.com/(@[\w.-]+)"


def channel_links(text: Column) -> Column:
    """Channel names linked in a text, lower case, in order, reserved paths left out; repeats stay."""
    names = F.transform(F.regexp_extract_all(text, F.lit(CHANNEL_LINK), 2), F.lower)
    return F.filter(names, lambda x: ~x.isin(*RESERVED_PATHS))


def mention_name(text: Column) -> Column:
    """The first username in a mention, lower case; null if there is none."""
    return F.lower(F.nullif(F.regexp_extract(text, MENTION, 1), F.lit("")))


def utf16_slice(text: Column, offset: Column, length: Column) -> Column:
    """Substring by UTF-16 units, as message entities count."""
    return F.decode(F.substring(F.encode(text, "UTF-16LE"), 2 * offset + 1, 2 * length), "UTF-16LE")


def entity_link(text: Column, entity: Column) -> Column:
    """Channel name that one entity (offset, length, type, url) names; null if none. Reserved paths name none."""
    part = utf16_slice(text, entity["offset"], entity["length"])
    linked = lambda x: F.get(channel_links(F.coalesce(x, F.lit(""))), F.lit(0))
    return F.when(entity["type"] == "mention", mention_name(part)).when(entity["type"] == "text_url", linked(entity["url"])).when(entity["type"] == "url", linked(part))


def message_links(text: Column, entities: Column) -> Column:
    """array<struct<name, source_type>>: names by entity in message order, then from the plain text; the first of each stays."""
    empty = F.array().cast("array<struct<name:string,source_type:string>>")
    found = F.transform(F.coalesce(entities, F.array().cast("array<struct<offset:int,length:int,type:string,url:string>>")), lambda e: F.struct(entity_link(text, e).alias("name"), e["type"].alias("source_type")))
    plain = F.transform(channel_links(F.coalesce(text, F.lit(""))), lambda x: F.struct(x.alias("name"), F.lit("plaintext").alias("source_type")))
    every = F.concat(F.filter(found, lambda x: x["name"].isNotNull()), plain)
    return F.aggregate(every, empty, lambda out, x: F.when(F.exists(out, lambda y: y["name"] == x["name"]), out).otherwise(F.concat(out, F.array(x))))


def urls(text: Column) -> Column:
    """Distinct URLs in a text without closing punctuation, sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(URL), 0), lambda x: F.rtrim(x, F.lit(URL_TAIL)))))


def video_channel_ids(text: Column) -> Column:
    """Channel ids, then handles with their @, linked in a text; repeats stay."""
    return F.concat(F.regexp_extract_all(text, F.lit(CHANNEL_PATH), 1), F.regexp_extract_all(text, F.lit(HANDLE_PATH), 1))


def username_fault(name: Column) -> Column:
    """First reason why a name can't be a channel's, null if it can; lengths are in bytes."""
    n = F.octet_length(name)
    return (
        F.when(n < 5, "too_short")
        .when(n > 32, "too_long")
        .when(~name.rlike(r"\A[a-zA-Z]"), "invalid_start_char")
        .when(name.endswith("_"), "ends_with_underscore")
        .when(~name.rlike(r"\A[a-zA-Z0-9_]+\z"), "invalid_char")
        .when(F.lower(name).endswith("bot"), "bot_suffix")
    )


def seed_name(line: Column) -> Column:
    """A seed line as a channel name: one of each prefix is taken off in turn, then lower case."""
    for prefix in (r"https://t\.me/", r"http://t\.me/", r"t\.me/", "@"):
        line = F.regexp_replace(line, f"^{prefix}", "")
    return F.lower(line)


def public_message_id(message_id: Column) -> Column:
    return F.floor(message_id / F.lit(1 << 20)).cast("long")


def message_link(username: Column, message_id: Column, album: Column) -> Column:
    """Public address of a message; one of an album is shown alone."""
    return F.concat(F.lit("https://t.me/"), username, F.lit("/"), public_message_id(message_id).cast("string"), F.when(album, "?single").otherwise(""))


def channel_url(channel: Column) -> Column:
    """Address of a video channel by handle or by id."""
    return F.when(channel.startswith("@"), F.concat(F.lit("https://www.youtube.com/"), channel)).otherwise(F.concat(F.lit("https://www.youtube.com/channel/"), channel))


def prefix_match(video_id: Column, prefix: Column) -> Column:
    """Whether a video id of 11 characters starts with the prefix, whatever the case, and a hyphen."""
    return (F.length(video_id) == 11) & (F.lower(F.left(video_id, F.lit(5))) == prefix) & (F.substr(video_id, F.lit(6), F.lit(1)) == "-")


def file_name(title: Column) -> Column:
    """A title as a file name: other than word characters, hyphen and dot become _, cut to 50."""
    return F.left(F.regexp_replace(title, r"[^\w\-.]", "_"), F.lit(50))
