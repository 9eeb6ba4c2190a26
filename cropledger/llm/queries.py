"""Registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cropledger.llm import (
    dart_minhash, decontaminate, exact_dedup, filter_audit, html_text, importance, licences, packing, secrets, spelling, suffix_tree,
    toxicity, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op5_exact_dedup",
    r"""
    WITH clean AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
    )
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(text) AS text_sha256
    FROM clean WINDOW w AS (PARTITION BY text)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.classes(table(spark, sf_dir, "documents"))


@query("op8_bin_slack_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op6_importance_resampling")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return importance.resample(docs, importance.fit(docs, table(spark, sf_dir, "labels")), fraction=0.5)


@query("op7_noisy_or_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op9_layout_html")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query(
    "op10_warc_round_trip",
    """
    WITH payloads AS (
        SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hexed,
               max(page_id) OVER (PARTITION BY coalesce(html, '')) AS leader
        FROM pages
    ), digits AS (
        SELECT page_id, payload, leader,
               list_transform(range(8), lambda i: CAST('0x' || substr(hexed, CAST(5 * i + 1 AS INT), 5) AS INT)) AS parts
        FROM payloads
    )
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda j:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      CAST((parts[j // 4 + 1] >> (15 - 5 * (j % 4))::INT) & 31 AS INT) + 1, 1)), '') AS payload_digest,
           CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = leader THEN NULL ELSE leader END AS refers_to
    FROM digits
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op1_licence_digests", licences.scan_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op2_secret_ledger")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("path").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"),
        "spans", "n_pem", "n_github", "n_jwt",
    )


@query("op3_dart_minhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.classes(table(spark, sf_dir, "documents"))


@query("op4_cgk_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    "op11_filter_audit",
    r"""
    WITH texts AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), flags AS (
        SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
               100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
               doc_id > min(doc_id) OVER (PARTITION BY text) AS e
        FROM texts
    ), rated AS (
        SELECT part, [a, b, c, d, e] AS fails, l.quality = 1 AS good, l.toxic = 1 AS toxic FROM flags LEFT JOIN labels l USING (doc_id)
    ), letters AS (
        SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) AS v(filter, place)
    ), orders AS (
        SELECT p.filter || q.filter || r.filter || s.filter || t.filter AS filter_order,
               [p.place, q.place, r.place, s.place, t.place] AS places
        FROM letters p, letters q, letters r, letters s, letters t
        WHERE len(list_distinct([p.place, q.place, r.place, s.place, t.place])) = 5
    ), grouped AS (
        SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM rated GROUP BY ALL
    ), steps AS (
        SELECT filter_order, step, places[step] AS place, places[1:step - 1] AS earlier FROM orders, range(1, 6) AS s(step)
    ), judged AS (
        SELECT part, filter_order, step, place, n, good, toxic, fails[place] AS failing,
               len(list_filter(earlier, lambda p: fails[p])) = 0 AS present, len(list_filter(fails, lambda f: f)) AS failed
        FROM grouped, steps
    ), summed AS (
        SELECT part, filter_order, step, place, CAST(coalesce(sum(n) FILTER (present AND NOT failing), 0) AS BIGINT) AS kept,
               CAST(coalesce(sum(n) FILTER (present AND failing), 0) AS BIGINT) AS removed,
               CAST(coalesce(sum(n) FILTER (NOT present AND failing), 0) AS BIGINT) AS redundant,
               CAST(coalesce(sum(n) FILTER (failing AND failed = 1), 0) AS BIGINT) AS unique_fails,
               CAST(coalesce(sum(good) FILTER (present AND failing), 0) AS BIGINT) AS good_lost,
               CAST(coalesce(sum(toxic) FILTER (present AND failing), 0) AS BIGINT) AS toxic_lost
        FROM judged GROUP BY ALL
    )
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, place) AS BIGINT) AS shapley, substr(filter_order, CAST(step AS INTEGER), 1) AS filter
    FROM summed
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query("op13_suffix_tree")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))
