"""Checks of messages between the parts of a distributed crawl."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLATFORMS = ("telegram", "youtube")
RESULTS = ("success", "error", "retry")
WORKER_STATES = ("idle", "busy", "offline")


def _blank(name: str) -> Column:
    return F.coalesce(F.trim(F.col(name)), F.lit("")) == ""


def work_item_fault() -> Column:
    """First fault of a work item, null if there is none."""
    return F.when(_blank("id"), "bad_id").when(_blank("url"), "bad_url").when(F.coalesce(F.col("depth"), F.lit(-1)) < 0, "bad_depth").when(~F.coalesce(F.col("platform").isin(*PLATFORMS), F.lit(False)), "bad_platform")


def result_fault() -> Column:
    return F.when(_blank("work_item_id"), "bad_id").when(_blank("worker_id"), "bad_worker").when(~F.coalesce(F.col("status").isin(*RESULTS), F.lit(False)), "bad_status")


def status_fault() -> Column:
    return F.when(_blank("worker_id"), "bad_worker").when(~F.coalesce(F.col("status").isin(*WORKER_STATES), F.lit(False)), "bad_status")


def split(rows: DataFrame, fault: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without a fault, and the others with theirs."""
    checked = rows.withColumn("fault", fault)
    return checked.filter("fault IS NULL").drop("fault"), checked.filter("fault IS NOT NULL")
