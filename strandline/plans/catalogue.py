"""Every query by name, with the DuckDB SQL that gives the same rows on the same tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder, and the views that stand for a crawl's own tables.

    edges, pending, batches, seeds, pages, messages and videos are projections of events, orders, customer and part; the SQL
    of the same projections is in VIEWS."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def view(self, name: str, source: str) -> DataFrame:
        return self.read(source).selectExpr(*VIEWS[name][1])

    @cached_property
    def edges(self) -> DataFrame:
        return self.view("edges", "events")

    @cached_property
    def pending(self) -> DataFrame:
        return self.view("pending", "events")

    @cached_property
    def batches(self) -> DataFrame:
        return self.view("batches", "orders")

    @cached_property
    def seeds(self) -> DataFrame:
        return self.view("seeds", "customer")

    @cached_property
    def pages(self) -> DataFrame:
        return self.view("pages", "events")

    @cached_property
    def messages(self) -> DataFrame:
        return self.view("messages", "events")

    @cached_property
    def videos(self) -> DataFrame:
        return self.view("videos", "part")


#: name: (table, expressions that both Spark and DuckDB read)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "edges": (
        "events",
        (
            "event_id AS edge_id", "concat('chan', CAST(user_id AS STRING)) AS source_channel", "concat('chan', CAST(event_id % 211 AS STRING)) AS destination_channel",
            "event_type = 'error' AS walkback", "event_type = 'view' AS skipped", "ts AS discovery_time", "concat('c', CAST(event_id % 3 AS STRING)) AS crawl_id", "concat('s', CAST(user_id % 10 AS STRING)) AS sequence_id",
        ),
    ),
    "pending": (
        "events",
        (
            "event_id AS pending_id", "concat('b', CAST(event_id % 1500 AS STRING)) AS batch_id", "concat('c', CAST(event_id % 3 AS STRING)) AS crawl_id", "concat('chan', CAST(event_id % 211 AS STRING)) AS destination_channel",
            "concat('chan', CAST(user_id AS STRING)) AS source_channel", "ts AS discovery_time", "CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS source_type",
            "CASE WHEN event_id % 1500 % 3 <> 0 AND event_id % 5 = 0 THEN 'pending' WHEN event_id % 1500 % 3 = 1 AND event_id % 5 = 1 THEN 'validating' WHEN event_id % 4 = 0 THEN 'valid' WHEN event_id % 4 = 1 THEN 'not_channel' WHEN event_id % 4 = 2 THEN 'invalid' ELSE 'duplicate' END AS validation_status",
            "CAST(NULL AS STRING) AS validation_reason", "ts AS validated_at",
        ),
    ),
    "batches": (
        "orders",
        (
            "concat('b', CAST(o_orderkey AS STRING)) AS batch_id", "concat('c', CAST(o_orderkey % 3 AS STRING)) AS crawl_id", "concat('chan', CAST(o_custkey AS STRING)) AS source_channel", "concat('p', CAST(o_orderkey AS STRING)) AS source_page_id",
            "CAST(o_orderkey % 6 AS INT) AS source_depth", "concat('s', CAST(o_orderkey % 10 AS STRING)) AS sequence_id",
            "CASE o_orderkey % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'closed' WHEN 2 THEN 'processing' ELSE 'completed' END AS status", "CAST(o_orderkey % 5 AS INT) AS attempt_count", "o_orderdate AS created_at", "o_orderdate AS claimed_at",
        ),
    ),
    "seeds": (
        "customer",
        (
            "CASE WHEN c_custkey % 50 = 0 THEN '' ELSE concat('chan', CAST(c_custkey AS STRING)) END AS channel_username", "c_custkey AS chat_id",
            "CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '2024-01-31 00:00:00' - (c_custkey % 60) * INTERVAL '1' DAY END AS invalidated_at", "CASE WHEN c_custkey % 4 <> 0 THEN TIMESTAMP '2024-01-15 00:00:00' + (c_custkey % 20) * INTERVAL '1' DAY END AS last_crawled_at",
            "CAST(c_custkey % 1000 AS INT) AS member_count",
        ),
    ),
    "pages": (
        "events",
        (
            "concat('p', CAST(event_id AS STRING)) AS page_id", "concat('chan', CAST(event_id % 997 AS STRING)) AS url", "CAST(event_id % 7 AS INT) AS depth", "concat('c', CAST(event_id % 3 AS STRING)) AS crawl_id",
            "CASE event_type WHEN 'signup' THEN 'unfetched' WHEN 'error' THEN 'error' WHEN 'click' THEN 'fetched' WHEN 'view' THEN 'processing' ELSE 'deadend' END AS status", "concat('s', CAST(user_id % 10 AS STRING)) AS sequence_id", "CAST(event_id % 5 AS INT) AS retries",
        ),
    ),
    "messages": (
        "events",
        (
            "event_id AS message_id", "user_id AS chat_id", "ts", "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS views", "CASE event_type WHEN 'signup' THEN 'fetched' WHEN 'error' THEN 'failed' WHEN 'click' THEN 'deleted' ELSE 'unfetched' END AS status", "event_type AS kind",
        ),
    ),
    "videos": (
        "part",
        (
            "p_partkey AS number", "concat('abc', CAST(p_partkey % 90 + 10 AS STRING), CASE WHEN p_partkey % 2 = 0 THEN '-' ELSE 'x' END, 'AbCdE') AS id", "concat('UC', CAST(p_partkey % 120 AS STRING)) AS channel_id", "p_name AS title", "p_type AS description",
            "TIMESTAMP '2024-01-01 00:00:00' + (p_partkey % 30) * INTERVAL '1' DAY AS published_at", "p_partkey * 7 AS views", "p_partkey % 100 AS likes", "p_partkey % 13 AS comments", "CAST(p_size AS BIGINT) AS size",
        ),
    ),
}
NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def with_views(sql: str) -> str:
    """SQL with the views that it names put before it."""
    used = [n for n in VIEWS if f"v_{n}" in sql]
    parts = [f"v_{n} AS (SELECT {', '.join(VIEWS[n][1])} FROM {VIEWS[n][0]})" for n in used]
    recursive = sql.lstrip().upper().startswith("WITH RECURSIVE")
    body = sql.strip()
    if body.upper().startswith("WITH"):
        body = body[len("WITH RECURSIVE") if recursive else len("WITH") :].lstrip()
        return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}{', ' if parts else ''}{body}"
    return f"WITH {', '.join(parts)} {body}" if parts else body


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query under its function's name."""

    def register(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[make.__name__] = lambda spark, folder: make(Tables(spark, folder))
        if sql:
            ORACLES[make.__name__] = with_views(sql)
        return make

    return register


def now():
    return F.expr(f"CAST({NOW} AS TIMESTAMP_NTZ)")


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """All queries and their SQL."""
    from . import queries_flow, queries_settings, queries_tables, queries_values  # noqa: F401  they register themselves

    return QUERIES, ORACLES
