"""Behaviour-log reports over the events table, search words over lineitem and part."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailtide.catalog import derive
from retailtide.operators import distinct, iprange, metrics, parse
from retailtide.plans import logs

AS_OF = "2024-01-30"

_LOGS = """
logs AS (
    SELECT event_id, ts, CAST(ts AS DATE) AS pt, event_type AS page,
           CASE WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           user_id % 30 AS octet,
           '10.' || (user_id % 30) || '.' || (event_id % 256) || '.1' AS ip
    FROM events
)"""

_REGIONS = """
places AS (
    SELECT n_nationkey AS octet,
           'X|' || CASE WHEN n_nationkey % 4 = 0 THEN '0' ELSE r_name END
                || '|' || CASE WHEN n_nationkey % 5 <> 0 THEN n_name WHEN n_nationkey < 15 THEN '' ELSE '0' END || '|isp'
               AS region_raw
    FROM nation JOIN region ON n_regionkey = r_regionkey
),
located AS (
    SELECT l.*, coalesce(p.region_raw, '未知') AS region_raw
    FROM logs l LEFT JOIN places p ON l.octet = p.octet
)"""


def page_view_users(spark, sf_dir):
    return logs.page_report(derive.logs(spark, sf_dir))


def page_users_spans(spark, sf_dir):
    """Distinct users of a page in the 1, 7 and 30 days up to each day."""
    rows = derive.logs(spark, sf_dir).select(
        "day", F.col("log_type").alias("page"), F.nullif(F.col("user_id").cast("string"), F.lit("")).alias("user_id")
    )
    numbers = distinct.numbered(rows, "user_id")
    sets = distinct.bitmaps(rows.join(numbers, "user_id"), ["day", "page"])
    return distinct.over_days(sets, ["page"], (1, 7, 30))


def device_stats(spark, sf_dir):
    return logs.device_report(derive.logs(spark, sf_dir), AS_OF)


def ip_region(spark, sf_dir):
    located = iprange.with_region(derive.logs(spark, sf_dir), derive.ip_ranges(spark, sf_dir))
    return located.select(
        F.col("log_id").cast("bigint").alias("event_id"), F.col("gis.ip").alias("ip"), "region"
    )


def ip_region_shuffled(spark, sf_dir):
    """The same lookup as it runs when the range table is too large to broadcast."""
    located = iprange.with_region(
        derive.logs(spark, sf_dir), derive.ip_ranges(spark, sf_dir), limit=0
    )
    return located.select(
        F.col("log_id").cast("bigint").alias("event_id"), F.col("gis.ip").alias("ip"), "region"
    )


def region_heat(spark, sf_dir):
    return logs.region_report(
        derive.logs(spark, sf_dir), derive.ip_ranges(spark, sf_dir), AS_OF
    )


def region_heat_merged(spark, sf_dir):
    """The region table: one row per day and label."""
    return logs.region_label_report(
        derive.logs(spark, sf_dir), derive.ip_ranges(spark, sf_dir), AS_OF
    )


def device_texts(spark, sf_dir):
    """The device report as the line JSON a warehouse load takes; unknown fields are left out."""
    return parse.as_json(device_stats(spark, sf_dir))


def region_texts(spark, sf_dir):
    return parse.as_json(region_heat(spark, sf_dir))


def search_word_counts(spark, sf_dir):
    words = parse.keyword_rows(derive.searches(spark, sf_dir))
    return metrics.keyword_counts(words).withColumnRenamed("day", "pt")


def search_word_items(spark, sf_dir):
    return logs.search_word_report(derive.searches(spark, sf_dir))


def search_top10_day(spark, sf_dir):
    return logs.search_top_report(derive.searches(spark, sf_dir))


QUERIES = {
    "page_users_spans": page_users_spans,
    "page_view_users": page_view_users,
    "device_stats": device_stats,
    "ip_region": ip_region,
    "ip_region_shuffled": ip_region_shuffled,
    "region_heat": region_heat,
    "region_heat_merged": region_heat_merged,
    "device_texts": device_texts,
    "region_texts": region_texts,
    "search_word_counts": search_word_counts,
    "search_word_items": search_word_items,
    "search_top10_day": search_top10_day,
}

_IP = f"""WITH {_LOGS}, {_REGIONS}
SELECT event_id, ip, region_raw AS region FROM located"""

_HEAT = f"""WITH {_LOGS}, {_REGIONS},
counts AS (
    SELECT pt, region_raw, count(*) AS "count", arg_max(ip, (ts, ip)) AS ip, max(ts) AS newest
    FROM located GROUP BY ALL
),
parts AS (
    SELECT *,
           contains(region_raw, '|') AS regular,
           nullif(nullif(trim(split_part(region_raw, '|', 2)), ''), '0') AS province,
           nullif(nullif(trim(split_part(region_raw, '|', 3)), ''), '0') AS city,
           nullif(nullif(trim(split_part(region_raw, '|', 4)), ''), '0') AS district
    FROM counts
),
report AS (
    SELECT pt,
           coalesce(province, 'null') || '|' || coalesce(city, 'null') || '|'
               || coalesce(district, 'null') AS region,
           province, city, district, "count", NOT regular AS abnormal, region_raw,
           CASE WHEN pt = DATE '{AS_OF}' THEN 'periodic' ELSE 'history' END AS type,
           CASE WHEN province IS NULL THEN ip END AS ip
    FROM parts
),
merged AS (
    SELECT pt, coalesce(province, 'null') || '|' || coalesce(city, 'null') || '|'
               || coalesce(district, 'null') AS region,
           max(province) AS province, max(city) AS city, max(district) AS district,
           CAST(sum("count") AS BIGINT) AS "count", bool_or(NOT regular) AS abnormal,
           arg_max(region_raw, (newest, ip, region_raw)) AS region_raw,
           CASE WHEN pt = DATE '{AS_OF}' THEN 'periodic' ELSE 'history' END AS type,
           CASE WHEN max(province) IS NULL THEN arg_max(ip, (newest, ip, region_raw)) END AS ip
    FROM parts GROUP BY 1, 2
)"""

DEVICE = f"""WITH {_LOGS},
report AS (
    SELECT pt, lower(page) AS os,
           CASE WHEN k % 10 = 3 THEN 'unknown' ELSE 'b' || (k % 7) END AS brand,
           CASE WHEN k % 10 = 0 THEN 'unk' ELSE 'v' || (k % 5) END AS platv,
           count(*) AS "count",
           CASE WHEN pt = DATE '{AS_OF}' THEN 'periodic' ELSE 'history' END AS type
    FROM logs GROUP BY ALL
)"""

_WORDS = """WITH searches AS (
    SELECT CAST(l.l_shipdate AS DATE) AS pt, unnest(string_split(p.p_name, ' ')) AS keyword
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
counts AS (SELECT pt, keyword, count(*) AS cnt FROM searches GROUP BY ALL),
items AS (
    SELECT *, '{"word":"' || keyword || '","cnt":' || cnt || '}' AS item FROM counts
)"""

ORACLE = {
    "page_users_spans": f"""WITH {_LOGS},
views AS (SELECT DISTINCT pt, page, user_id FROM logs WHERE user_id IS NOT NULL AND user_id <> ''),
ends AS (SELECT DISTINCT pt AS day FROM views)
SELECT page, day,
       count(DISTINCT user_id) FILTER (pt = day) AS users_1,
       count(DISTINCT user_id) FILTER (pt > day - 7) AS users_7,
       count(DISTINCT user_id) AS users_30
FROM ends JOIN views ON pt <= day AND pt > day - 30 GROUP BY page, day""",
    "page_view_users": f"""WITH {_LOGS}
SELECT pt, page, count(*) AS pv,
       '[' || coalesce(string_agg(DISTINCT '"' || user_id || '"', ',' ORDER BY '"' || user_id || '"'), '') || ']' AS user_ids,
       count(DISTINCT user_id) AS users,
       CAST(0 AS INTEGER) AS chunk, CAST(1 AS INTEGER) AS chunks
FROM logs GROUP BY pt, page""",
    "device_stats": f"{DEVICE}\nSELECT * FROM report",
    "device_texts": f"""{DEVICE}
SELECT '{{"pt":"' || pt || '","os":"' || os || '","brand":"' || brand || '","platv":"' || platv
       || '","count":' || "count" || ',"type":"' || type || '"}}' AS "value"
FROM report""",
    "region_texts": f"""{_HEAT}
SELECT '{{"pt":"' || pt || '","region":"' || region || '"'
       || coalesce(',"province":"' || province || '"', '')
       || coalesce(',"city":"' || city || '"', '')
       || coalesce(',"district":"' || district || '"', '')
       || ',"count":' || "count" || ',"abnormal":' || abnormal
       || ',"region_raw":"' || region_raw || '","type":"' || type || '"'
       || coalesce(',"ip":"' || ip || '"', '') || '}}' AS "value"
FROM report""",
    "ip_region": _IP,
    "ip_region_shuffled": _IP,
    "region_heat": f"{_HEAT}\nSELECT * FROM report",
    "region_heat_merged": f"{_HEAT}\nSELECT * FROM merged",
    "search_word_counts": f"{_WORDS}\nSELECT pt, keyword, cnt FROM counts",
    "search_word_items": f"{_WORDS}\nSELECT pt, '[' || item || ']' AS search_item FROM items",
    "search_top10_day": f"""{_WORDS},
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY pt ORDER BY cnt DESC, keyword) AS rn FROM items
)
SELECT pt, '[' || string_agg(item, ',' ORDER BY rn) || ']' AS search_item
FROM ranked WHERE rn <= 10 GROUP BY pt""",
}
