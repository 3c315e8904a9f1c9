"""Summaries, rankings and grouped reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics, reads
from ..sources import tables
from ..sources.tables import table
from .registry import report, with_views
from .views import ACTIVE, DOCS, PAGE_URLS, RECORDS

NEWEST = '(SELECT max("timestamp") FROM records)'
ON_RECORDS = with_views(RECORDS, ACTIVE)
SHARE = "round(count(*) FILTER (WHERE processed) / count(*) * 100, 2)"


def _hourly(average: str, low_high: str, where: str = "", extra: str = "") -> str:
    return f"""{ON_RECORDS} SELECT date_trunc('hour', "timestamp")::TIMESTAMP AS hour, count(*) AS record_count,
      count(*) FILTER (WHERE processed) AS processed_count, round(avg({average}), 4) AS avg_value,
      min({low_high}) AS min_value, max({low_high}) AS max_value, count(DISTINCT source) AS unique_sources,
      {SHARE} AS processed_pct{extra} FROM active {where} GROUP BY 1"""


WEEK = f'WHERE "timestamp" >= {NEWEST} - INTERVAL 168 HOUR'
STATS = _hourly(
    "coalesce(value, 0)", "value", "",
    f", array_to_string(list_sort(list(DISTINCT source)), ',') AS source_list, {NEWEST} AS materialized_at",
)


@report("hourly_summary_zero", _hourly("coalesce(value, 0)", "coalesce(value, 0)", WEEK))
def hourly_summary_zero(spark, sf):
    rows = tables.records(spark, sf)
    return analytics.summary_zero(rows, 168, tables.newest(rows))


@report("hourly_summary_skip", _hourly("value", "value", WEEK))
def hourly_summary_skip(spark, sf):
    rows = tables.records(spark, sf)
    return analytics.summary_skip(rows, 168, tables.newest(rows))


@report("hourly_stats", STATS)
def hourly_stats(spark, sf):
    rows = tables.records(spark, sf)
    return analytics.hourly_stats(rows, tables.newest(rows))


@report("latest_hourly_stats", f"{STATS} ORDER BY hour DESC LIMIT 24")
def latest_hourly_stats(spark, sf):
    rows = tables.records(spark, sf)
    return reads.stats_latest(analytics.hourly_stats(rows, tables.newest(rows)), 24)


@report(
    "hourly_stats_fallback",
    _hourly("value", "value", "", f", array_to_string(list_sort(list(DISTINCT source)), ',') AS source_list, {NEWEST} AS materialized_at")
    + " ORDER BY hour DESC LIMIT 48",
)
def hourly_stats_fallback(spark, sf):
    rows = tables.records(spark, sf)
    return analytics.hourly_stats_fallback(rows, 48, tables.newest(rows))


@report(
    "processed_share",
    f"""{ON_RECORDS} SELECT source, count(*) AS record_count, count(*) FILTER (WHERE processed) AS processed_count,
    {SHARE} AS processed_pct FROM active GROUP BY source""",
)
def processed_share(spark, sf):
    return analytics.processed_share(tables.records(spark, sf))


@report("distinct_sources", f"{ON_RECORDS} SELECT count(DISTINCT source) AS unique_sources FROM active")
def distinct_sources(spark, sf):
    return analytics.distinct_sources(tables.records(spark, sf))


@report(
    "sources_by_hour",
    f"""{ON_RECORDS} SELECT date_trunc('hour', "timestamp")::TIMESTAMP AS hour,
    array_to_string(list_sort(list(DISTINCT source)), ',') AS source_list FROM active GROUP BY 1""",
)
def sources_by_hour(spark, sf):
    return analytics.source_list_by_hour(tables.records(spark, sf))


@report(
    "ingestion_health",
    f"""{with_views(RECORDS)} SELECT max(created_at) AS last_created_at,
    count(*) FILTER (WHERE created_at >= {NEWEST} - INTERVAL 1 DAY) AS records_24h FROM records""",
)
def ingestion_health(spark, sf):
    rows = tables.records(spark, sf)
    return analytics.ingestion_health(rows, tables.newest(rows))


@report(
    "percentile_by_value",
    f"""{ON_RECORDS} SELECT id, source, "timestamp", coalesce(value, 0) AS value, processed,
      round(percent_rank() OVER (PARTITION BY source ORDER BY coalesce(value, 0) DESC), 4) AS percentile_rank
    FROM active WHERE source = 'click' ORDER BY coalesce(value, 0) DESC, id LIMIT 100""",
)
def percentile_by_value(spark, sf):
    return analytics.percentile_by_value(tables.records(spark, sf), "click")


@report(
    "percentile_by_recency",
    f"""{ON_RECORDS} SELECT id, "timestamp", value, round((ROW_NUMBER() OVER (ORDER BY "timestamp" DESC, id DESC) - 1) /
      greatest(count(*) OVER () - 1, 1), 4) AS percentile_rank
    FROM (SELECT * FROM active WHERE source = 'click' ORDER BY "timestamp" DESC, id DESC LIMIT 100)""",
)
def percentile_by_recency(spark, sf):
    return analytics.percentile_by_recency(tables.records(spark, sf), "click")


RANKED = f"""{ON_RECORDS}, ranked AS (
  SELECT id, source, "timestamp", coalesce(value, 0) AS value, processed,
    RANK() OVER (PARTITION BY source ORDER BY coalesce(value, 0) DESC) AS rank FROM active {WEEK})"""


@report("top_by_source", f"{RANKED} SELECT * FROM ranked WHERE rank <= 5")
def top_by_source(spark, sf):
    rows = tables.records(spark, sf)
    return analytics.top_by_source(rows, 5, 168, tables.newest(rows))


@report(
    "top_by_source_positional",
    f"""{ON_RECORDS} SELECT id, source, "timestamp", value, processed, rank FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY value DESC NULLS LAST, "timestamp" DESC, id) AS rank
      FROM active {WEEK}) WHERE rank <= 5""",
)
def top_by_source_positional(spark, sf):
    rows = tables.records(spark, sf)
    return analytics.top_by_source_positional(rows, 5, 168, tables.newest(rows))


@report(
    "top_nested_by_source",
    f"""{RANKED} SELECT source, CAST(0 AS BIGINT) AS part, count(*) AS n, string_agg(rank || ':' || id, ',' ORDER BY rank, id) AS ids
    FROM ranked WHERE rank <= 5 GROUP BY source""",
)
def top_nested_by_source(spark, sf):
    rows = tables.records(spark, sf)
    nested = analytics.nest_by_source(analytics.top_by_source(rows, 5, 168, tables.newest(rows)))
    item = F.transform("rows", lambda r: F.concat(r["rank"].cast("string"), F.lit(":"), r["id"].cast("string")))
    return nested.select("source", "part", F.size("rows").alias("n"), F.array_join(item, ",").alias("ids"))


@report(
    "percentile_outliers",
    f"""{ON_RECORDS} SELECT id, source, "timestamp", value, processed, round(p, 4) AS percentile_rank FROM (
      SELECT id, source, "timestamp", coalesce(value, 0) AS value, processed,
        percent_rank() OVER (PARTITION BY source ORDER BY coalesce(value, 0) DESC) AS p FROM active) WHERE p <= 0.1""",
)
def percentile_outliers(spark, sf):
    return analytics.percentile_outliers(tables.records(spark, sf), 0.1)


@report(
    "tier_union",
    f"""{with_views(RECORDS)} SELECT id, source, CASE WHEN "timestamp" >= TIMESTAMP '2024-01-15' THEN 'hot' ELSE 'archive' END AS tier FROM records""",
)
def tier_union(spark, sf):
    rows = tables.records(spark, sf)
    hot = rows.filter("timestamp >= TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    archive = rows.filter("timestamp < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    return reads.tier_union(hot, archive).select("id", "source", "tier")


@report(
    "tier_overlap",
    f"""{with_views(RECORDS)} SELECT id, source FROM records
    WHERE "timestamp" >= TIMESTAMP '2024-01-15' AND "timestamp" < TIMESTAMP '2024-01-16'""",
)
def tier_overlap(spark, sf):
    rows = tables.records(spark, sf)
    hot = rows.filter("timestamp >= TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    archive = rows.filter("timestamp < TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    return reads.tier_overlap(hot, archive).select("id", "source")


@report("documents_per_source", f"{with_views(DOCS)} SELECT source, count(*) AS n FROM docs GROUP BY source")
def documents_per_source(spark, sf):
    return analytics.count_by(tables.scraped_docs(spark, sf), "source")


@report("distinct_urls", f"{with_views(PAGE_URLS)} SELECT DISTINCT url FROM page_urls")
def distinct_urls(spark, sf):
    return tables.page_urls(spark, sf).select("url").distinct()


@report(
    "price_by_brand",
    """SELECT p_brand, p_type, round(avg(p_retailprice), 6) AS p_retailprice_mean, max(p_retailprice) AS p_retailprice_max,
    CAST(sum(p_size) AS BIGINT) AS p_size_sum FROM part GROUP BY 1, 2""",
)
def price_by_brand(spark, sf):
    grouped = analytics.group_summary(table(spark, sf, "part"), ["p_brand", "p_type"], "p_retailprice", "p_size")
    return grouped.withColumn("p_retailprice_mean", F.round("p_retailprice_mean", 6))


ORDER_SUMMARY = """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day, count(*) AS order_count,
  CAST(sum(CAST(o_totalprice AS DECIMAL(20, 2))) AS DOUBLE) AS total_amount FROM orders GROUP BY 1, 2"""


@report("order_summary", ORDER_SUMMARY)
def order_summary(spark, sf):
    return analytics.order_summary(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice")


@report("merged_order_summary", ORDER_SUMMARY)
def merged_order_summary(spark, sf):
    orders = table(spark, sf, "orders")
    parts = [
        analytics.order_summary(orders.filter(condition), "o_custkey", "o_orderdate", "o_totalprice")
        for condition in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'")
    ]
    return analytics.merge_order_summary(*parts)


@report(
    "revenue_by_nation",
    """SELECT n_name, CAST(sum(CAST(o_totalprice AS DECIMAL(20, 2))) AS DOUBLE) AS revenue FROM orders
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
)
def revenue_by_nation(spark, sf):
    summary = analytics.order_summary(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("n_nationkey"))
    named = customers.join(table(spark, sf, "nation").select("n_nationkey", "n_name"), "n_nationkey")
    return analytics.revenue_by(summary, named, "n_name")
