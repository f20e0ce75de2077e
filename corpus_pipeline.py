"""From raw documents to packed sequences: quality rules, near duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import jaccard, packing, quality, substring
from strandline.llm.common import id_key, materialise
from strandline.llm.queries import WORD_PATTERN


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep, unchanged."""
    rows, _ = quality.quality(docs, carry=docs.columns)
    return rows.filter("kept").select("row.*").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates, unchanged. Of rows that repeat id and text, one stays.

    Only the keys of rows that may go are looked up, so texts aren't shuffled where those are few enough to be broadcast."""
    groups = jaccard.jaccard_groups(docs).select(id_key("doc_id").alias("doc"), "text_hash", "kept")
    keys = materialise(groups.groupBy("doc", "text_hash").agg(F.max("kept").alias("kept"), F.count("*").alias("n")), "near-duplicates")

    def few(found: DataFrame) -> DataFrame:
        found = found.select("doc", "text_hash")
        return F.broadcast(found) if found.count() <= jaccard.BROADCAST_KEYS else found

    held = docs.select(F.struct(*docs.columns).alias("row"), id_key("doc_id").alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    stay = held.join(few(keys.filter("not kept")), ["doc", "text_hash"], "left_anti")
    repeated = keys.filter("kept and n > 1")
    if not repeated.isEmpty():
        repeated = few(repeated)
        twice = stay.join(repeated, ["doc", "text_hash"], "left_semi").dropDuplicates(["doc", "text_hash"])
        stay = stay.join(repeated, ["doc", "text_hash"], "left_anti").unionByName(twice)
    return stay.select("row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of passages that occur earlier; n_chars is that of the text that stays."""
    out = substring.substring_rows(docs, carry=[c for c in docs.columns if c != "text"], texts=True)
    text = {"text": F.col("kept_text").alias("text"), "n_chars": F.length("kept_text").cast("long").alias("n_chars")}
    return out.select(*[text[c] if c in text else F.col("row")[c].alias(c) for c in docs.columns])


def retrieval_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every id of every document in a piece of a sequence."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), WORD_PATTERN, end_id=2)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", ngram_jaccard_join), ("substring_dedup", substring_dedup), ("retrieval_packing", retrieval_packing)]

#: The label model is fitted by expectation-maximisation, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, name)
    return docs
