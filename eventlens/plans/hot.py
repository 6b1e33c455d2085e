"""Hot items and hot URLs: sliding-window counts and top-N per window end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import messages, parsing
from ..operators import ranking, windows
from ..sources import stand_ins
from .registry import query

PV_VIEWS = """
WITH pv AS (SELECT user_id AS item_id, ts FROM events WHERE event_type = 'view'),
panes AS (SELECT item_id, time_bucket(INTERVAL 5 MINUTE, ts) AS pane FROM pv),
w AS (SELECT item_id, pane + to_minutes(CAST(5 * k AS BIGINT)) AS window_end
      FROM panes CROSS JOIN range(1, 13) t(k))
SELECT item_id, window_end, count(*) AS cnt FROM w GROUP BY item_id, window_end
"""

HOT_ITEMS = f"""
WITH c AS ({PV_VIEWS}),
r AS (SELECT window_end, item_id, cnt,
             row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id ASC) AS rk
      FROM c)
SELECT window_end, rk, item_id, cnt FROM r WHERE rk <= 3
"""

URL_VIEWS = """
WITH p AS (SELECT e.ts, coalesce(g.url, '/item/' || CAST(e.user_id AS VARCHAR)) AS url
           FROM events e LEFT JOIN pages g ON e.user_id = g.page_id),
panes AS (SELECT url, time_bucket(INTERVAL 5 SECOND, date_trunc('second', ts)) AS pane FROM p),
w AS (SELECT url, pane + to_seconds(CAST(5 * k AS BIGINT)) AS window_end
      FROM panes CROSS JOIN range(1, 13) t(k))
SELECT url, window_end, count(*) AS cnt FROM w GROUP BY url, window_end
"""

HOT_URLS = f"""
WITH c AS ({URL_VIEWS}),
r AS (SELECT window_end, url, cnt,
             row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url ASC) AS rk
      FROM c)
SELECT window_end, rk, url, cnt FROM r WHERE rk <= 3
"""


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2: user behaviour rows with ``behavior = 'pv'``.  The predicate is
    put on the stored column (``pv`` is the stand-in for ``view``) so it
    reaches the parquet scan as a pushed filter."""
    return stand_ins.user_behavior(spark, sf_dir, source_filter=F.col("event_type") == "view")


@query("sliding_counts", PV_VIEWS)
def sliding_counts(spark, sf_dir):
    """STR8 + AGG1 + PRJ12: views per item in 1 h windows sliding by 5 min."""
    return windows.window_counts(page_views(spark, sf_dir), "item_id", "ts", "1 hour", "5 minutes")


@query("sliding_counts_panes", PV_VIEWS)
def sliding_counts_panes(spark, sf_dir):
    """The same counts through 5-minute panes (fan-out after the partial
    aggregate)."""
    return windows.window_counts_panes(page_views(spark, sf_dir), "item_id", "ts", "1 hour", "5 minutes")


def hot_items(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    counts = windows.window_counts_panes(page_views(spark, sf_dir), "item_id", "ts", "1 hour", "5 minutes")
    return (ranking.top_n(counts, "window_end", "cnt", n, tie="item_id")
            .select("window_end", "rk", "item_id", "cnt"))


@query("hot_items_topn", HOT_ITEMS)
def hot_items_topn(spark, sf_dir):
    """Entry point B: top 3 items by views per sliding-window end."""
    return hot_items(spark, sf_dir, 3)


HOT_REPORT = f"""
WITH t AS ({HOT_ITEMS})
SELECT window_end, '{messages.TOPN_RULE}' || chr(10) || '{messages.TOPN_TIME}' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg('{messages.TOPN_RANK}' || rk || ':' || '{messages.TOPN_ITEM}' || item_id || '{messages.TOPN_VIEWS}' || cnt, chr(10) ORDER BY rk)
       || chr(10) || '{messages.TOPN_RULE}' || chr(10) AS report
FROM t GROUP BY window_end
"""


@query("hot_items_report", HOT_REPORT)
def hot_items_report(spark, sf_dir):
    """The printed form of the top-N: one text per window end."""
    return ranking.top_n_report(hot_items(spark, sf_dir, 3), "window_end", "item_id", "cnt")


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parse_access_log(stand_ins.access_log_lines(spark, sf_dir))


@query("hot_urls_topn", HOT_URLS)
def hot_urls_topn(spark, sf_dir):
    """STR9 + AGG14 + RNK2: parsed access log, views per url in 1 min windows
    sliding by 5 s, top 3 per window end (the reference's unfinished hot-URL
    job, counting properly), through 5-second panes: a row is counted once
    before the fan-out to twelve windows."""
    counts = windows.window_counts_panes(access_log(spark, sf_dir), "url", "ts", "1 minute", "5 seconds")
    return ranking.top_n(counts, "window_end", "cnt", 3, tie="url").select("window_end", "rk", "url", "cnt")
