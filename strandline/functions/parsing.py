"""Durations, dates, error texts and page verdicts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DURATION = r"\AP(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?\z"


def duration_seconds(text: Column) -> Column:
    """Seconds of an ISO 8601 duration of days, hours, minutes and seconds; null for other forms, and for none."""
    part = lambda k, size: F.coalesce(F.regexp_extract(text, _DURATION, k).try_cast("bigint"), F.lit(0)) * size
    total = part(1, 86400) + part(2, 3600) + part(3, 60) + part(4, 1)
    return F.when(text.rlike(_DURATION) & (total > 0), total)


def flood_wait(text: Column) -> Column:
    """struct<seconds, found> of a rate-limit error; found without digits gives 0 seconds."""
    found = text.contains("FLOOD_WAIT_") | text.contains("retry after ")
    seconds = F.regexp_extract(text, r"(?:FLOOD_WAIT_|retry after )(\d+)", 1).try_cast("bigint")
    found = F.coalesce(found, F.lit(False))
    return F.struct(F.when(found, F.coalesce(seconds, F.lit(0))).otherwise(0).cast("bigint").alias("seconds"), found.alias("found"))


#: Texts of errors that no repetition mends, and of those that a worker doesn't try again.
PERMANENT_ERRORS = ("[400]", "400 USERNAME_NOT_OCCUPIED", "400 USERNAME_INVALID", "no messages found in the chat")
FINAL_ERRORS = ("not found", "access denied", "forbidden")


def permanent_error(text: Column) -> Column:
    out = F.lit(False)
    for x in PERMANENT_ERRORS:
        out = out | text.contains(x)
    return F.coalesce(out, F.lit(False))


def retryable_error(text: Column) -> Column:
    """False for errors of the final kinds (case-sensitive), true for all others; null is no error and not retried."""
    out = F.lit(False)
    for x in FINAL_ERRORS:
        out = out | text.contains(x)
    return F.coalesce(~out, F.lit(False))


def html_title(html: Column) -> Column:
    """First title text, trimmed; empty if there is none."""
    return F.trim(F.regexp_extract(html, r"(?is)<title>(.*?)</title>", 1), F.lit(" \t\r\n"))


def html_noindex(html: Column) -> Column:
    """Whether the first robots tag says noindex."""
    return F.contains(F.lower(F.regexp_extract(html, r'(?is)<[^<>]*?name="robots"[^>]*>', 0)), F.lit("noindex"))


def page_verdict(html: Column) -> Column:
    """struct<status, reason> of a channel's preview page: valid, not_channel, invalid, or blocked for unknown pages."""
    title = html_title(html)
    view, contact, home = title.contains("Telegram: View @"), title.contains("Telegram: Contact @"), title == "Telegram Messenger"
    gone = contact & html_noindex(html) | home
    status = F.when(view, "valid").when(gone, "invalid").when(contact, "not_channel").otherwise("blocked")
    reason = F.when(view, "").when(gone, "not_found").when(contact, "not_supergroup").otherwise("unknown_title")
    return F.struct(status.alias("status"), reason.alias("reason"))


def http_outcome(status: Column) -> Column:
    return F.when(status == 200, "ok").when(status >= 500, "transient").otherwise("blocked")


def latency_source(milliseconds: Column) -> Column:
    return F.when(milliseconds < 5, "cache").when(milliseconds < 15, "local").otherwise("server")


def stored_time(value: Column) -> Column:
    """A stored time given as RFC 3339 text or as Unix seconds; null if neither."""
    return F.coalesce(F.try_to_timestamp(value), F.timestamp_seconds(value.try_cast("double")))


def crawl_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMddHHmmss")


def hashed_id(*parts: Column, length: int = 8) -> Column:
    """An id that follows from its parts, in place of a random one."""
    return F.left(F.sha2(F.concat_ws(":", *parts), 256), F.lit(length))


def letter_prefix(*parts: Column) -> Column:
    """Five letters a to z from a hash of the parts."""
    digest = F.sha2(F.concat_ws(":", *parts), 256)
    letter = lambda k: F.chr(F.lit(97) + F.pmod(F.conv(F.substr(digest, F.lit(4 * k + 1), F.lit(4)), 16, 10).cast("int"), F.lit(26)))
    return F.concat(*[letter(k) for k in range(5)])
