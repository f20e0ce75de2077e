"""One query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment, bpe, html_text, jaccard, licenses, packing, quality, substring, suffixes, token_files, vectors, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]

#: The words of word_bpe_49k.json, as its own file states them.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.page_records(warc.read_warc(spark, written, payloads=False))


def op2_substring_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_substrings(table(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op4_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = quality.quality(table(spark, sf_dir, "documents"))
    return rows.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    written = token_files.write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, end_id=0)
    return token_files.read_tokens(spark, written)


def op6_pivot_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.range_join(table(spark, sf_dir, "embeddings"))


def op7_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents")).drop("text_hash")


def op8_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), path, WORD_PATTERN, end_id=2)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_compensated_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), *paths, texts=False).drop("groups")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup_bytes(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc_salvage,
        op2_substring_sketch,
        op3_byte_bpe,
        op4_quality_votes,
        op5_token_files,
        op6_pivot_range_join,
        op7_minhash_join,
        op8_retrieval_packing,
        op9_license_scan,
        op10_site_style_tree,
        op11_compensated_whitening,
        op12_tokenizer_alignment,
        op13_suffix_dedup,
    )
}

#: DuckDB SQL for those that SQL can express.
ORACLES: dict[str, str] = {
    "op1_warc_salvage": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS g FROM pages),
        f AS (SELECT g, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY g)
        SELECT page_id, n::BIGINT AS payload_bytes, g AS payload_digest,
               CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN f USING (g)""",
    "op2_substring_sketch": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
        s AS (SELECT doc_id, unnest(range(1, len(a) - 18)) AS i,
                     unnest(list_transform(range(1, len(a) - 18), lambda i: md5(array_to_string(a[i:i + 19], ' ')))) AS h FROM w),
        k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS nth FROM s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM k WHERE nth > 1),
        l AS (SELECT doc_id, unnest(a) AS word, unnest(range(1, len(a) + 1)) AS p FROM w),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM l ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, len(a)::BIGINT AS n_words, (len(a) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)""",
    "op6_pivot_range_join": """
        WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
        SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.c AS component_id, vec_id = c.c AS kept
        FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op7_minhash_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS a FROM documents),
        g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) >= 5
                THEN list_transform(range(1, len(a) - 3), lambda i: md5(array_to_string(a[i:i + 4], ' ')))
                WHEN len(a) > 0 THEN [md5('short ' || array_to_string(a, ' '))] ELSE [] END) AS h FROM w),
        s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM g x JOIN g y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY ALL),
        l AS (SELECT a, b, k = sa.n AND k = sb.n AS equal FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
            WHERE 9 * k >= 4 * (sa.n + sb.n)),
        n AS (SELECT a, count(*) AS n, min(b) FILTER (WHERE equal) AS copy FROM l GROUP BY a),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
        SELECT doc_id, least(doc_id, coalesce(copy, doc_id)) AS class_id, coalesce(n.n, 0)::BIGINT AS n_links,
               c.c AS component_id, doc_id = c.c AS kept
        FROM documents JOIN c ON c.a = doc_id LEFT JOIN n ON n.a = doc_id""",
    "op13_suffix_dedup": """
        WITH t AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
        w AS (SELECT r, i, md5(array_slice(b, i, i + 399)) AS h FROM (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS i FROM t)),
        s AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
        g AS (SELECT r, i, count(*) FILTER (WHERE before IS NULL OR i > before + 400) OVER (PARTITION BY r ORDER BY i) AS span FROM s),
        p AS (SELECT r, span, min(i) AS a, max(i) + 399 AS z FROM g GROUP BY r, span),
        q AS (SELECT r, count(*) AS n_spans, sum(z - a + 1) AS n_removed, max(z) AS z FROM p GROUP BY r),
        c AS (SELECT r, span, coalesce(lag(z) OVER (PARTITION BY r ORDER BY span), 0) + 1 AS x, a - 1 AS y FROM p
              UNION ALL SELECT r, 1000000000, coalesce(z, 0) + 1, octet_length(b) FROM t LEFT JOIN q USING (r)),
        k AS (SELECT r, string_agg(CASE WHEN x > y THEN '' ELSE hex(array_slice(b, x, y)) END, '' ORDER BY span) AS kept FROM c JOIN t USING (r) GROUP BY r)
        SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(kept)) AS kept_sha256
        FROM t JOIN k USING (r) LEFT JOIN q USING (r)""",
    # on these pages the article element is the article
    "op10_site_style_tree": r"""
        WITH a AS (SELECT page_id, url, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
        b AS (SELECT page_id, url, list_transform(string_split_regex(body, '</?(?:h1|p)>'), lambda x: trim(regexp_replace(
                replace(replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))) AS parts FROM a),
        t AS (SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)), '') AS text FROM b)
        SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM t""",
}
