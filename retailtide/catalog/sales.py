"""Cumulative sales windows over the events table."""

from __future__ import annotations

from retailtide.catalog import derive
from retailtide.plans import gmv

AS_OF = "2024-01-15"

_LINES = """
lines AS (
    SELECT json_extract_string(props, '$.k') AS product_id,
           CASE WHEN event_id % 97 <> 0 THEN CAST(value AS DECIMAL(18,2)) END AS amount,
           ts,
           CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start
    FROM events {where}
),
copies AS (
    SELECT product_id, amount, window_start,
           unnest(generate_series(time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE,
                                  window_start + INTERVAL 1 DAY,
                                  INTERVAL 10 MINUTE)) AS window_end
    FROM lines
),
per_product AS (
    SELECT window_start, window_end, product_id,
           CAST(sum(amount) AS DECIMAL(18,2)) AS product_gmv
    FROM copies GROUP BY ALL
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY window_start, window_end
                                 ORDER BY product_gmv DESC NULLS LAST, product_id) AS rn
    FROM per_product
),
tops AS (
    SELECT window_start, window_end,
           string_agg(product_id, ',' ORDER BY rn) AS top5_product_ids,
           sum(product_gmv) AS top_gmv
    FROM ranked WHERE rn <= 5 GROUP BY ALL
)"""

_ALL = _LINES.format(where="") + """,
firsts AS (
    SELECT window_start, product_id, min(window_end) AS first_end FROM copies GROUP BY ALL
),
totals AS (
    SELECT p.window_start, p.window_end, sum(p.product_gmv) AS win_gmv,
           string_agg(p.product_id, ',' ORDER BY f.first_end, p.product_id) AS win_gmv_ids
    FROM per_product p JOIN firsts f USING (window_start, product_id)
    GROUP BY ALL
)"""

_TEXTS = """
       CAST({a}.window_start AS DATE) AS ds,
       strftime({a}.window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime({a}.window_end, '%Y-%m-%d %H:%M:%S') AS window_end,"""


def gmv_cumulate_all(spark, sf_dir):
    return gmv.gmv_all(derive.orders(spark, sf_dir))


def gmv_cumulate_today_top5(spark, sf_dir):
    return gmv.gmv_today_top(derive.orders(spark, sf_dir, since=AS_OF), as_of=AS_OF)


def product_window_gmv(spark, sf_dir):
    return _as_text(gmv.product_windows(derive.orders(spark, sf_dir)))


def window_topk_products(spark, sf_dir):
    return _as_text(gmv.top_products(derive.orders(spark, sf_dir)))


def _as_text(df):
    return df.withColumns(
        {c: df[c].cast("string") for c in ("window_start", "window_end")}
    )


QUERIES = {
    "gmv_cumulate_all": gmv_cumulate_all,
    "gmv_cumulate_today_top5": gmv_cumulate_today_top5,
    "product_window_gmv": product_window_gmv,
    "window_topk_products": window_topk_products,
}

ORACLE = {
    "gmv_cumulate_all": f"""WITH {_ALL}
SELECT {_TEXTS.format(a="t")}
       CAST(t.win_gmv AS DECIMAL(18,2)) AS win_gmv, t.win_gmv_ids, r.top5_product_ids
FROM totals t JOIN tops r ON t.window_start = r.window_start AND t.window_end = r.window_end""",
    "gmv_cumulate_today_top5": f"""WITH {_LINES.format(where=f"WHERE ts >= TIMESTAMP '{AS_OF}'")}
SELECT {_TEXTS.format(a="r")}
       CAST(r.top_gmv AS DECIMAL(18,2)) AS win_gmv,
       r.top5_product_ids AS win_gmv_ids, r.top5_product_ids
FROM tops r""",
    "product_window_gmv": f"""WITH {_LINES.format(where="")}
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, product_id, product_gmv
FROM per_product""",
    "window_topk_products": f"""WITH {_LINES.format(where="")}
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end, product_id, product_gmv,
       CAST(rn AS INTEGER) AS rn
FROM ranked WHERE rn <= 5""",
}

# The same report when the lines that are {late} count only in the windows that are {open}
ORDER_BY_ARRIVAL = (
    ORACLE["gmv_cumulate_all"]
    .replace("           ts,\n", "           ts, {late} AS late,\n")
    .replace(
        """    SELECT product_id, amount, window_start,
           unnest(""",
        """    SELECT * FROM (SELECT product_id, amount, window_start, late,
           unnest(""",
    )
    .replace("AS window_end\n    FROM lines", "AS window_end\n    FROM lines) WHERE NOT late OR {open}")
)
