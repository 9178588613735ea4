"""The registered queries of the text operators, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .ball_search import search
from .decontaminate import find_leaks
from .frames import new_path
from .group_join import join_groups
from .licenses import scan, scan_sql
from .minhash import components
from .mixing import mix
from .oracle import SQL as _ORACLE
from .quality import judged
from .spelling import variants
from .suffix_dedup import remove_repeats
from .superkmers import deduplicate
from .token_counts import count_tokens
from .token_files import read_tokens, with_starts, write_tokens
from .url_rules import filter_urls, given_verdicts

BPE = public_tokenizers.path("byte_bpe_50k.json")


#: verdict, host, path
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
MIX_WEIGHTS = (3, 1, 2)


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_files(spark, sf_dir):
    folder = new_path(spark, "tokens")
    write_tokens(_read(spark, sf_dir, "documents"), folder, BPE, end_id=2)
    return with_starts(read_tokens(spark, folder, digest=True)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_mix_sources(spark, sf_dir):
    mixed = mix(_read(spark, sf_dir, "documents"), weights=MIX_WEIGHTS, share=1.5, epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_token_counts(spark, sf_dir):
    return count_tokens(_read(spark, sf_dir, "documents"), BPE, limit=512)


def op9_quality_rules(spark, sf_dir):
    trusted = _read(spark, sf_dir, "labels").where("quality = 1")
    return judged(_read(spark, sf_dir, "documents"), trusted)


def op10_near_duplicates(spark, sf_dir):
    return components(_read(spark, sf_dir, "documents"))


def op8_repeated_passages(spark, sf_dir):
    rows = deduplicate(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _labelled_urls(spark, sf_dir):
    """URLs that the given rules judge, and others by the label of their id, where there is one."""
    labels = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.expr("coalesce(quality = 0, false) or coalesce(toxic = 1, false)").alias("label"))
    judged_urls = given_verdicts(_read(spark, sf_dir, "pages"), URL_RULES).join(labels, "page_id", "left")
    return judged_urls.select("url", F.coalesce(F.col("given") == "block", F.col("label")).alias("bad"))


def op2_url_filters(spark, sf_dir):
    found = filter_urls(_read(spark, sf_dir, "pages"), _labelled_urls(spark, sf_dir), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op6_license_scans(spark, sf_dir):
    return scan(_read(spark, sf_dir, "documents"))


def op3_decontaminate(spark, sf_dir):
    leaks = find_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return leaks.drop("text_key")


def op4_repeated_strings(spark, sf_dir):
    rows = remove_repeats(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling_variants(spark, sf_dir):
    return variants(_read(spark, sf_dir, "documents"), slip=31, length=7, count=2, times=10)


def op12_grouped_join(spark, sf_dir):
    return join_groups(_read(spark, sf_dir, "documents"))


def op13_ranked_search(spark, sf_dir):
    return search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), k=20)


QUERIES = {query.__name__: query for query in (
    op4_repeated_strings, op3_decontaminate, op2_url_filters, op6_license_scans, op8_repeated_passages, op10_near_duplicates, op9_quality_rules,
    op1_token_files, op5_mix_sources, op7_token_counts, op11_spelling_variants, op12_grouped_join, op13_ranked_search,
)}
SQL = _ORACLE | {
    "op6_license_scans": scan_sql(),
    "op5_mix_sources": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   md5(concat_ws(':', '0', coalesce(doc_id::VARCHAR, 'null'), coalesce(text, ''))) AS tie
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM sized GROUP BY source),
        levels AS (  -- the level at which a source with the given ratio is just full
            SELECT s.source, 2.0::DOUBLE * s.source_size / s.weight AS ratio FROM sources s),
        filled AS (  -- what all sources hold at each such level, against the budget
            SELECT l.ratio, sum(least(2.0::DOUBLE * s.source_size, s.weight * l.ratio)) AS held,
                   (SELECT sum(source_size) * 1.5::DOUBLE FROM sources) AS budget
            FROM (SELECT DISTINCT ratio FROM levels) l, sources s GROUP BY l.ratio),
        highest AS (SELECT coalesce(max(ratio), 0.0::DOUBLE) AS full_at FROM filled WHERE held <= budget),
        level AS (
            SELECT full_at,
                   ((SELECT sum(source_size) * 1.5::DOUBLE FROM sources)
                    - coalesce((SELECT sum(2.0::DOUBLE * source_size) FROM sources WHERE 2.0::DOUBLE * source_size / weight <= full_at), 0))
                   AS left_over,
                   (SELECT sum(weight) FROM sources WHERE 2.0::DOUBLE * source_size / weight > full_at) AS open
            FROM highest),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN open IS NULL OR 2.0::DOUBLE * source_size / weight <= full_at THEN 2.0::DOUBLE * source_size
                        ELSE least(weight * left_over / open, 2.0::DOUBLE * source_size) END AS target
            FROM sources, level),
        ordered AS (
            SELECT s.doc_id, s.size, t.source_size, t.target,
                   CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
                   coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.tie, s.doc_id, s.size
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target,
               (size * (whole + CASE WHEN 2 * earlier + size <= 2 * (target - whole * source_size) AND target - whole * source_size > 0
                                     THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM ordered""",
}
