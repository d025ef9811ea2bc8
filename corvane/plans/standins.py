"""Stand-ins for the feed's tables, built from the driver's, in SQL that Spark and DuckDB share.

``sql(name)`` gives the text with plain table names; ``frame`` runs it over a folder of tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators.candidates import Conflict

TABLES = "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "labels"
_DAY = "(year({0}) * 10000 + month({0}) * 100 + day({0}))"

#: Opposing sides by nation number; one conflict has two nations on a side, some nations recur.
_SIDES = [((i,), (24 - i,)) for i in range(12)] + [((12,), (3,)), ((13, 20), (1,)), ((14,), (2,))]
PLAN = [Conflict(f"batch_{k}", f"conflict_{k}", tuple(f"N{x}" for x in a), tuple(f"N{x}" for x in b)) for k, (a, b) in enumerate(_SIDES)]
COUNTRIES = sorted({x for c in PLAN for x in (*c.side_a, *c.side_b)})

_NAMES = ["lancer", "AK-47", "ti-reon", "tank", "f-16", "drone swarm", "shot", "T-72"]
STAND_INS = {
    "feed_mentions": f"""
        SELECT o_orderkey AS GLOBALEVENTID,
               concat(CASE WHEN o_orderkey % 11 = 0 THEN 'ftp' WHEN o_orderkey % 2 = 0 THEN 'http' ELSE 'https' END, '://news', cast(o_custkey % 7 AS varchar(9)), '.example/a/', cast(o_custkey AS varchar(19))) AS MentionIdentifier,
               concat('news', cast(o_custkey % 7 AS varchar(9))) AS MentionSourceName,
               cast({_DAY.format("o_orderdate")} AS bigint) * 1000000 + o_orderkey % 24 * 10000 AS MentionTimeDate,
               CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS MentionType,
               cast(o_orderkey % 10 * 10 AS int) AS Confidence, cast(o_orderkey % 2 AS int) AS InRawText, cast(o_orderkey % 5 AS int) AS SentenceID,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' ELSE 'srclc:fra' END AS MentionDocTranslationInfo,
               cast(o_orderdate AS date) AS partition_day
        FROM orders""",
    "feed_events": f"""
        SELECT l_orderkey AS GLOBALEVENTID, {_DAY.format("l_shipdate")} AS SQLDATE, cast({_DAY.format("l_shipdate")} AS bigint) AS DATEADDED,
               c_name AS Actor1Name, s_name AS Actor2Name,
               CASE WHEN l_linenumber = 7 THEN NULL ELSE concat('N', cast(c_nationkey AS varchar(9))) END AS Actor1CountryCode, concat('N', cast(s_nationkey AS varchar(9))) AS Actor2CountryCode,
               cast(150 + l_linenumber * 10 + l_partkey % 3 AS varchar(9)) AS EventCode, cast(14 + l_linenumber AS varchar(9)) AS EventRootCode,
               CASE WHEN l_returnflag = 'N' THEN 3 ELSE 4 END AS QuadClass,
               CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE concat('G', cast(l_partkey % 4 AS varchar(9))) END AS ActionGeo_CountryCode,
               concat('place ', cast(l_partkey % 6 AS varchar(9))) AS ActionGeo_FullName, cast(l_partkey % 4 AS int) AS ActionGeo_Type,
               CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE cast(l_partkey % 90 AS double) END AS ActionGeo_Lat, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE cast(l_suppkey % 90 AS double) END AS ActionGeo_Long,
               cast(l_shipdate AS date) AS partition_day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    # several rows for a page, repeats, addresses that can't be fetched
    "feed_inputs": """
        SELECT page_id * 3 + k AS row_no, concat('A', cast(page_id * 3 + k AS varchar(19))) AS article_id, concat('C', cast((page_id + CASE WHEN k = 2 THEN 1 ELSE 0 END) % 4 AS varchar(9))) AS conflict_id,
               CASE WHEN page_id % 17 = 0 AND k = 2 THEN ' ' ELSE concat('2024-0', cast(1 + page_id % 9 AS varchar(9)), '-1', cast(k AS varchar(9))) END AS published_date,
               CASE WHEN page_id % 13 = 0 THEN concat('ftp', substr(url, 5, 1000)) WHEN page_id % 19 = 0 AND k = 1 THEN 'nowhere' ELSE url END AS url,
               concat('Title ', cast(page_id % 50 AS varchar(9))) AS title
        FROM pages CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2) AS ks""",
    "feed_fetched": """
        SELECT page_id, url, CASE WHEN page_id % 10 = 3 THEN 'https://home.example/' ELSE url END AS final_url,
               CASE WHEN page_id % 10 = 0 THEN NULL WHEN page_id % 10 = 1 THEN 404 ELSE 200 END AS http_status,
               CASE WHEN page_id % 10 = 2 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END AS content_type, page_id % 10 <> 4 AS found,
               CASE WHEN page_id % 10 = 5 THEN 'Just a Moment...' WHEN page_id % 10 = 6 THEN '' ELSE concat('Page ', cast(page_id AS varchar(9))) END AS title,
               CASE WHEN page_id % 10 = 7 THEN substr(html, 1, 399) ELSE html END AS body, '2024-05-01' AS expected_date,
               CASE WHEN page_id % 10 = 8 THEN '2024-05-31' WHEN page_id % 10 = 9 THEN '2024-06-01T08:00' WHEN page_id % 7 = 0 THEN 'soon' END AS extracted_date
        FROM pages""",
    # sentences with a named item and a usage phrase, by number
    "feed_sentences": f"""
        SELECT event_id AS sentence_id, concat('https://site', cast(event_id % 40 AS varchar(9)), '.example/p') AS url, cast(event_id % 23 AS int) AS sentence_no,
               concat(CASE event_id % 6 WHEN 0 THEN 'The army ' WHEN 1 THEN 'It is unclear whether troops ' WHEN 2 THEN 'The navy did not say it ' WHEN 3 THEN 'Forces will, officials hope, ' WHEN 4 THEN 'In a training exercise they ' ELSE 'Reports say the ' END,
                      CASE event_id % 5 WHEN 0 THEN 'used the ' WHEN 1 THEN 'launched an ' WHEN 2 THEN 'can be used with ' WHEN 3 THEN 'crashed a ' ELSE 'fired ' END,
                      CASE event_id % 8 {" ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_NAMES))} END,
                      CASE event_id % 4 WHEN 0 THEN ' missile system.' WHEN 1 THEN '; but the helicopter used it' WHEN 2 THEN ' aircraft while ships waited' ELSE ' yesterday.' END) AS sentence
        FROM events""",
    "feed_terms": " UNION ALL ".join(f"SELECT '{x.lower()}' AS term, '{x}' AS name, '{'T01' if i == 5 else f'W0{2 + i % 6}'}' AS category_id" for i, x in enumerate(_NAMES)),
    # usage forms as a dictionary has them, from the names of parts: alternatives, remarks, none
    "feed_forms": f"""
        SELECT concat('P', cast(p_partkey AS varchar(19))) AS pattern_id,
               CASE p_partkey % 6 {" ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(("can be used", "crashed", "(military) exercise / drill", "claimed")))} ELSE concat(p_name, ' may ', lower(p_type)) END AS base_form,
               CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN '' ELSE concat(p_name, ' (', p_brand, ') / ', p_type, ' /  ', p_brand) END AS trans_form
        FROM part""",
    "feed_usage": " UNION ALL ".join(f"SELECT '{p}' AS pattern_id, '{b}' AS base_form, {t} AS trans_form" for p, b, t in (("P1", "used", "'use / employs'"), ("P2", "launched", "''"), ("P3", "can be used", "NULL"), ("P4", "crashed", "'crash (into)'"), ("P5", "fired", "'may fire'"), ("P6", "(military) exercise / drill", "'training exercise'"))),
}


def sql(name: str) -> str:
    return f"({STAND_INS[name]})"


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in or a driver's table as a DataFrame."""
    if name in STAND_INS:
        text = STAND_INS[name]
        used = [x for x in TABLES if re.search(rf"(?:FROM|JOIN) {x}\b", text)]
        for x in used:
            text = re.sub(rf"\b(FROM|JOIN) {x}\b", rf"\1 {{{x}}}", text)
        return spark.sql(text, **{x: frame(spark, sf_dir, x) for x in used}) if used else spark.sql(text)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
