"""Tables of the channel graph and its upkeep, as Spark DDL."""

from __future__ import annotations

from pyspark.sql import types as T

EDGES = "edge_id INT, destination_channel STRING, source_channel STRING, walkback BOOLEAN, skipped BOOLEAN, discovery_time TIMESTAMP, crawl_id STRING, sequence_id STRING"
PAGE_BUFFER = "page_id STRING, parent_id STRING, depth INT, url STRING, crawl_id STRING, sequence_id STRING"
SEEDS = "channel_username STRING, chat_id BIGINT, last_crawled_at TIMESTAMP, invalidated_at TIMESTAMP, member_count INT, inserted_at TIMESTAMP"
INVALID = "channel_username STRING, reason STRING, invalidated_at TIMESTAMP"
BATCHES = "batch_id STRING, crawl_id STRING, source_channel STRING, source_page_id STRING, source_depth INT, sequence_id STRING, status STRING, attempt_count INT, created_at TIMESTAMP, closed_at TIMESTAMP, claimed_at TIMESTAMP, completed_at TIMESTAMP"
PENDING_EDGES = "pending_id INT, batch_id STRING, crawl_id STRING, destination_channel STRING, source_channel STRING, sequence_id STRING, discovery_time TIMESTAMP, source_type STRING, validation_status STRING, validation_reason STRING, validated_at TIMESTAMP"
SOURCE_STATS = "crawl_id STRING, source_type STRING, total BIGINT, valid BIGINT, not_channel BIGINT, invalid BIGINT, duplicate BIGINT"
DISCOVERED = "channel_username STRING, crawl_id STRING, discovered_at TIMESTAMP"
ACCESS_EVENTS = "id INT, reason STRING, occurred_at TIMESTAMP"
PAGES_STATE = "id STRING, url STRING, depth INT, status STRING, error STRING, timestamp TIMESTAMP, platform STRING, parent_id STRING, sequence_id STRING, crawl_id STRING, messages ARRAY<STRUCT<chat_id:BIGINT,message_id:BIGINT,status:STRING,page_id:STRING>>"
RAW_MESSAGES = "id STRING, channel_id STRING, sender_id STRING, sender_name STRING, text STRING, title STRING, description STRING, timestamp TIMESTAMP, views BIGINT, reactions MAP<STRING,BIGINT>, thumbnails MAP<STRING,STRING>, comment_count BIGINT, language STRING, duration STRING, type STRING"
WORK_ITEMS = "id STRING, url STRING, depth INT, crawl_id STRING, platform STRING, parent_id STRING, retry_count INT, assigned_to STRING, created_at TIMESTAMP"
WORKER_STATUS = "message_type STRING, worker_id STRING, status STRING, current_work STRING, tasks_processed INT, tasks_success INT, tasks_error INT, timestamp TIMESTAMP"
FILE_MANIFEST = "path STRING, size BIGINT, mtime TIMESTAMP"

COMMENT = "STRUCT<text:STRING,reactions:MAP<STRING,BIGINT>,view_count:BIGINT,reply_count:BIGINT,handle:STRING>"
ENGAGEMENT = "STRUCT<follower_count:BIGINT,following_count:BIGINT,like_count:BIGINT,post_count:BIGINT,views_count:BIGINT,comment_count:BIGINT,share_count:BIGINT>"
CHANNEL = f"STRUCT<channel_id:STRING,channel_name:STRING,channel_description:STRING,channel_profile_image:STRING,channel_engagement_data:{ENGAGEMENT},channel_url_external:STRING,channel_url:STRING,country_code:STRING,published_at:TIMESTAMP>"

_TEXTS = "ARRAY<STRING>"
#: Columns of a post; an empty inner link has no columns and is left out.
POST = (
    f"post_link STRING, channel_id STRING, post_uid STRING, url STRING, published_at TIMESTAMP, created_at TIMESTAMP, language_code STRING, "
    f"engagement BIGINT, view_count BIGINT, like_count BIGINT, share_count BIGINT, comment_count BIGINT, crawl_label STRING, list_ids {_TEXTS}, "
    f"channel_name STRING, search_terms {_TEXTS}, search_term_ids {_TEXTS}, project_ids {_TEXTS}, exercise_ids {_TEXTS}, label_data {_TEXTS}, "
    f"labels_metadata {_TEXTS}, project_labeled_post_ids {_TEXTS}, labeler_ids {_TEXTS}, all_labels {_TEXTS}, label_ids {_TEXTS}, is_ad BOOLEAN, "
    f"transcript_text STRING, image_text STRING, video_length INT, is_verified BOOLEAN, channel_data {CHANNEL}, platform_name STRING, "
    f"shared_id STRING, quoted_id STRING, replied_id STRING, ai_label STRING, root_post_id STRING, engagement_steps_count BIGINT, "
    f"ocr_data ARRAY<STRUCT<ocr_text:STRING,thumb_url:STRING>>, performance_scores STRUCT<likes:INT,shares:INT,comments:INT,views:DOUBLE>, "
    f"has_embed_media BOOLEAN, description STRING, repost_channel_data STRING, post_type {_TEXTS}, post_title STRING, "
    f"media_data STRUCT<document_name:STRING>, is_reply BOOLEAN, ad_fields STRING, likes_count BIGINT, shares_count BIGINT, comments_count BIGINT, "
    f"views_count BIGINT, searchable_text STRING, all_text STRING, contrast_agent_project_ids {_TEXTS}, agent_ids {_TEXTS}, segment_ids {_TEXTS}, "
    f"thumb_url STRING, media_url STRING, comments ARRAY<{COMMENT}>, reactions MAP<STRING,BIGINT>, outlinks {_TEXTS}, capture_time TIMESTAMP, handle STRING"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
