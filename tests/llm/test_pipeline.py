import importlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strandline.llm import quality, queries
from strandline.llm.common import materialise

from .test_corpus import brute_groups, brute_substrings


def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def test_stages_equal_brute_force(spark):
    docs = small(spark)
    kept = corpus_pipeline.quality_rules(spark, docs, "")
    assert kept.columns == docs.columns
    scored, _ = quality.quality(docs)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored.filter("kept").select("row.doc_id").collect()}
    single = corpus_pipeline.ngram_jaccard_join(spark, kept, "")
    assert single.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in brute_groups(rows)})
    clean = corpus_pipeline.substring_dedup(spark, single, "")
    assert clean.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in single.collect()]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in clean.collect()) == sorted((d, t, len(t)) for d, _, _, _, t in brute_substrings(rows, 20))
    packed = corpus_pipeline.retrieval_packing(spark, clean, "").collect()
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    expected = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.collect()}
    total = {}
    for r in packed:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == expected


def test_rows_with_null_and_repeated_ids_pass_the_stages(spark):
    text = " ".join(f"the w{k} of" for k in range(40)) + "."
    docs = spark.createDataFrame([(None, text, "en", "s", 1), (1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, None, None, None, None), (3, text.replace("w1 ", "other "), "en", "s", 1)], small(spark).schema)
    single = corpus_pipeline.ngram_jaccard_join(spark, docs, "")
    assert sorted((r.doc_id, r.text is None) for r in single.collect()) == [(1, False), (2, True)]


def test_all_operators_are_registered():
    entry = importlib.import_module("__spark_entry__")
    found = entry.queries()
    assert {f"op{k}" for k in range(1, 14)} <= {name.split("_")[0] for name in found} and "pipeline" in found
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_columns_of_any_name_pass_the_stages(spark):
    names = "row doc text_hash node check home keys n_words n_removed kept_sha256 kept_text kept label base_failed size first n place deal ids start".split()
    docs = small(spark)
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(f"{name} {k}") if k % 2 else F.lit(k))
    plain = small(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs, plain = materialise(stage(spark, docs, ""), "wide"), materialise(stage(spark, plain, ""), "plain")
        if "text" in plain.columns:
            assert docs.columns == [*plain.columns, *names]
            assert {tuple(r[c] for c in names) for r in docs.collect()} == {tuple(f"{name} {k}" if k % 2 else k for k, name in enumerate(names))}
        assert sorted(map(repr, map(tuple, docs.select(*plain.columns).collect()))) == sorted(map(repr, map(tuple, plain.collect())))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_take_tables_with_clashing_columns(spark, tmp_path, name):
    names = "row doc text_hash node check home keys n_words n_removed kept_sha256 kept size first n place deal ids start payload digest of host noise unit cell id content n_chars page".split()
    for table in ("documents", "pages", "embeddings"):
        rows = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(30).coalesce(1)
        rows.write.parquet(f"{tmp_path}/plain/{table}.parquet")
        for k, c in enumerate(names):
            rows = rows if c in rows.columns else rows.withColumn(c, F.lit(k))
        rows.write.parquet(f"{tmp_path}/wide/{table}.parquet")
    found = [queries.QUERIES[name](spark, f"{tmp_path}/{kind}") for kind in ("plain", "wide")]
    assert found[0].columns == found[1].columns
    plain, wide = (sorted(map(repr, map(tuple, df.collect()))) for df in found)
    assert plain == wide
