"""Pages, documents, files and composed jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import documents, sketch
from ..schemas import BLOOM_CAPACITY
from ..session import fresh_path
from ..sources import files, months, tables, versions
from ..sources.tables import table
from . import flows
from .registry import report, with_views
from .views import ACTIVE, CHECKED, COLUMNS, DOCS, PAGE_URLS, POSTS, RECORDS, REQUESTS

AS_OF = "2024-02-01 00:00:00"
SITE = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"

# Links of the page navigation, found by pattern instead of by parsing.
LINKS = f"""WITH found AS (
  SELECT page_id, url AS page_url, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hrefs,
    regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS names FROM pages),
links AS (
  SELECT page_id, i - 1 AS position, hrefs[i] AS href, names[i] AS name, {SITE.replace('url', 'page_url')} AS site
  FROM found, LATERAL (SELECT unnest(generate_series(1, len(hrefs))) AS i)),
items AS (
  SELECT page_id, position, CASE WHEN starts_with(href, 'http') THEN href ELSE site || '/' || href END AS url,
    trim(replace(replace(replace(name, '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS title, '' AS content, 'hn' AS source FROM links)"""


def _links(spark, sf):
    return documents.extract_links(table(spark, sf, "pages"), "nav li", "a")


@report("page_links", f"{LINKS} SELECT * FROM items")
def page_links(spark, sf):
    return _links(spark, sf)


@report(
    "distinct_page_links",
    f"{LINKS} SELECT * FROM items QUALIFY ROW_NUMBER() OVER (PARTITION BY url ORDER BY page_id, position) = 1",
)
def distinct_page_links(spark, sf):
    return documents.dedupe_urls(_links(spark, sf), "page_id", "position")


@report("limited_page_links", f"{LINKS} SELECT * FROM items WHERE position < 3")
def limited_page_links(spark, sf):
    """The limit is part of the extractor: rows per page."""
    return documents.extract_links(table(spark, sf, "pages"), "nav li", "a", limit=3)


@report(
    "page_quotes",
    """SELECT page_id, CAST(0 AS BIGINT) AS position, replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1),
      '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS content, replace(regexp_extract(html, '<nav><ul><li><a href="[^"]*">([^<]*)</a>', 1), '&amp;', '&') AS title,
      'playwright' AS source FROM pages""",
)
def page_quotes(spark, sf):
    quotes = documents.extract_quotes(table(spark, sf, "pages"), "body", "article > h1", "nav li > a")
    return quotes.drop("url")


@report(
    "page_quote_urls",
    """SELECT page_id, url || '#' || right(sha256(replace(replace(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1),
      '&lt;', '<'), '&gt;', '>'), '&amp;', '&')), 6) AS url FROM pages""",
)
def page_quote_urls(spark, sf):
    return documents.extract_quotes(table(spark, sf, "pages"), "body", "article > h1", "nav li > a").select("page_id", "url")


@report(
    "post_items",
    f"""{with_views(POSTS)} SELECT 'https://posts.example/posts/' || id AS url, coalesce(title, '') AS title, coalesce(body, '') AS content,
    'jsonplaceholder' AS source, id FROM posts""",
)
def post_items(spark, sf):
    """Posts written as landed JSON, read back and shaped."""
    path = fresh_path(spark, "posts")
    tables.posts(spark, sf).write.json(path)
    items = documents.posts_to_items(files.scan_posts_json(spark, path), "https://posts.example")
    return items.withColumnRenamed("page_id", "id").drop("position")


@report(
    "first_urls",
    f"""{with_views(PAGE_URLS)} SELECT url, min(page_id) AS page_id, CAST(arg_min(seen_no, page_id * 10 + seen_no) AS BIGINT) AS seen_no,
    arg_min(title, page_id * 10 + seen_no) AS title FROM page_urls GROUP BY url""",
)
def first_urls(spark, sf):
    return documents.dedupe_urls(tables.page_urls(spark, sf), "page_id", "seen_no")


# Bit positions of an address under six seeds, the digest read as one number.
BLOOM_BITS = """SELECT url, CAST(((((a * s + b) % 95850) * s + c) % 95850 * s + d) % 95850 AS BIGINT) AS position FROM (
  SELECT url, CAST('0x' || substr(h, 1, 16) AS UBIGINT)::HUGEINT % 95850 AS a, CAST('0x' || substr(h, 17, 16) AS UBIGINT)::HUGEINT AS b,
    CAST('0x' || substr(h, 33, 16) AS UBIGINT)::HUGEINT AS c, CAST('0x' || substr(h, 49, 16) AS UBIGINT)::HUGEINT AS d,
    18446744073709551616::HUGEINT AS s
  FROM (SELECT url, sha256(seed || ':' || url) AS h FROM page_urls, (SELECT unnest(generate_series(0, 5)) AS seed)))"""


@report(
    "bloom_words",
    f"""{with_views(PAGE_URLS)}, bits AS ({BLOOM_BITS}), words AS (
      SELECT position // 64 AS word, CAST(bit_or(1::UBIGINT << CAST(position % 64 AS UBIGINT)) AS HUGEINT) AS bits FROM bits GROUP BY 1)
    SELECT word, CAST(CASE WHEN bits >= 9223372036854775808::HUGEINT THEN bits - 18446744073709551616::HUGEINT ELSE bits END AS BIGINT) AS bits
    FROM words""",
)
def bloom_words(spark, sf):
    return sketch.bloom_build(tables.page_urls(spark, sf), "url", BLOOM_CAPACITY)


@report(
    "bloom_set_bits",
    f"""{with_views(PAGE_URLS)}, bits AS ({BLOOM_BITS}) SELECT position // 64 AS word, count(DISTINCT position) AS set_bits FROM bits GROUP BY 1""",
)
def bloom_set_bits(spark, sf):
    return sketch.bloom_build(tables.page_urls(spark, sf), "url", BLOOM_CAPACITY).select("word", F.bit_count("bits").cast("bigint").alias("set_bits"))


@report(
    "bloom_probe",
    f"""{with_views(PAGE_URLS)}, bits AS ({BLOOM_BITS.replace('FROM page_urls', 'FROM (SELECT url FROM pages)')}),
    stored AS (SELECT DISTINCT b.position FROM bits b JOIN pages p USING (url) WHERE p.url LIKE 'https:%')
    SELECT url, bool_and(position IN (SELECT position FROM stored)) AS maybe_seen FROM bits GROUP BY url""",
)
def bloom_probe(spark, sf):
    """All addresses against a filter of the https ones."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    return sketch.bloom_probe(pages, "url", sketch.bloom_build(pages.filter("url LIKE 'https:%'"), "url", BLOOM_CAPACITY), BLOOM_CAPACITY)


@report("unseen_urls", "SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE url LIKE 'https:%')")
def unseen_urls(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    seen = pages.filter("url LIKE 'https:%'")
    return sketch.unseen_urls(pages, seen, sketch.bloom_build(seen, "url", BLOOM_CAPACITY), BLOOM_CAPACITY)


@report(
    "sharded_urls",
    f"{with_views(PAGE_URLS)} SELECT url, page_id, CAST('0x' || substr(sha256(url), 1, 8) AS BIGINT) % 16 AS shard FROM page_urls",
)
def sharded_urls(spark, sf):
    return documents.shard_urls(tables.page_urls(spark, sf).select("url", "page_id"), 16)


def _newest_docs(source: str) -> str:
    return f"""{with_views(DOCS)} SELECT substr(sha256(url || '|' || strftime(scraped_at, '%Y-%m-%dT%H:%M:%S')), 1, 24) AS id,
      source, url, title, content, strftime(scraped_at, '%Y-%m-%dT%H:%M:%S') AS scraped_at FROM docs WHERE source = '{source}' ORDER BY docs.scraped_at DESC, url LIMIT 50"""


@report("newest_docs_of_source", _newest_docs("src3"))
def newest_docs_of_source(spark, sf):
    return documents.find_by_source(tables.scraped_docs(spark, sf), "src3")


@report("stored_docs", f"{with_views(DOCS)} SELECT source, count(*) AS n, sum(length(content))::BIGINT AS chars, max(scraped_at) AS newest FROM docs GROUP BY source")
def stored_docs(spark, sf):
    """Documents appended to the store and read from there."""
    path = fresh_path(spark, "doc-store")
    files.doc_store_append(tables.scraped_docs(spark, sf), path)
    stored = spark.read.parquet(path)
    return stored.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("content")).alias("chars"), F.max("scraped_at").alias("newest")
    )


@report("scrape_counts", f"{LINKS} SELECT count(DISTINCT url) AS scraped, count(DISTINCT url) AS stored, CAST(0 AS BIGINT) AS failed FROM items")
def scrape_counts(spark, sf):
    counts, _ = flows.scrape_job(
        table(spark, sf, "pages"), "hn", fresh_path(spark, "doc-store"), AS_OF, row_selector="nav li", link_selector="a"
    )
    return counts


@report("scrape_counts_second_run", f"{LINKS} SELECT count(DISTINCT url) AS scraped, CAST(0 AS BIGINT) AS stored, CAST(0 AS BIGINT) AS failed FROM items")
def scrape_counts_second_run(spark, sf):
    """What the first run has stored is not stored again."""
    pages, store = table(spark, sf, "pages"), fresh_path(spark, "doc-store")
    flows.scrape_job(pages, "hn", store, AS_OF, row_selector="nav li", link_selector="a")
    counts, _ = flows.scrape_job(pages, "hn", store, AS_OF, row_selector="nav li", link_selector="a")
    return counts


@report(
    "scrape_messages",
    f"""{LINKS} SELECT '{{"event_type":"doc.scraped","payload":{{"source":"hn","count":' || count(DISTINCT url) || '}}}}' AS value FROM items""",
)
def scrape_messages(spark, sf):
    _, messages = flows.scrape_job(
        table(spark, sf, "pages"), "hn", fresh_path(spark, "doc-store"), AS_OF, row_selector="nav li", link_selector="a"
    )
    return messages


ON_CHECKED = with_views(RECORDS, ACTIVE, REQUESTS, CHECKED)


@report(
    "ingest_summary",
    f"""{ON_CHECKED} SELECT batch_id, count(*) FILTER (WHERE len(errs) = 0) AS inserted, count(*) FILTER (WHERE len(errs) > 0) AS errors,
      arg_min(array_to_string(errs, ','), event_id) FILTER (WHERE len(errs) > 0) AS first_error FROM checked GROUP BY batch_id""",
)
def ingest_summary(spark, sf):
    root = months.new_table(spark, tables.records(spark, sf))
    summary, _ = flows.ingest_job(spark, root, tables.record_requests(spark, sf), "event_id", AS_OF)
    return summary


@report(
    "ingest_messages",
    f"""{ON_CHECKED} SELECT '{{"event_type":"record.created","payload":{{"record_id":' || ((SELECT max(id) FROM records) +
      ROW_NUMBER() OVER (ORDER BY first_id)) || ',"source":"' || source || '"}}}}' AS value
    FROM (SELECT source, parsed_at, min(event_id) AS first_id FROM checked WHERE len(errs) = 0 GROUP BY 1, 2)""",
)
def ingest_messages(spark, sf):
    root = months.new_table(spark, tables.records(spark, sf))
    _, messages = flows.ingest_job(spark, root, tables.record_requests(spark, sf), "event_id", AS_OF)
    return messages


NEWEST = '(SELECT max("timestamp") FROM records)'


@report(
    "archive_job",
    f"""{with_views(RECORDS)} SELECT count(*) FILTER (WHERE old AND NOT "timestamp" < TIMESTAMP '2024-01-08') AS archived,
      count(*) AS hot_before, count(*) FILTER (WHERE NOT old) AS hot_after
    FROM (SELECT *, created_at < {NEWEST} - INTERVAL 10 DAY AND deleted_at IS NULL AS old FROM records)""",
)
def archive_job(spark, sf):
    rows = tables.records(spark, sf)
    return flows.archive_job(spark, months.new_table(spark, rows), _archived(spark, rows), 10, tables.newest(rows))


def _archived(spark, rows):
    return months.new_table(spark, rows.filter("timestamp < TIMESTAMP_NTZ '2024-01-08 00:00:00'"))


@report(
    "archive_job_twice",
    f"""{with_views(RECORDS)} SELECT CAST(0 AS BIGINT) AS archived, n AS hot_before, n AS hot_after FROM (
      SELECT count(*) FILTER (WHERE deleted_at IS NOT NULL OR created_at >= {NEWEST} - INTERVAL 10 DAY) AS n FROM records)""",
)
def archive_job_twice(spark, sf):
    """A second run finds nothing to move."""
    rows = tables.records(spark, sf)
    hot, archive = months.new_table(spark, rows), _archived(spark, rows)
    flows.archive_job(spark, hot, archive, 10, tables.newest(rows))
    return flows.archive_job(spark, hot, archive, 10, tables.newest(rows))


@report("ingest_twice", f"""{ON_CHECKED} SELECT (SELECT count(*) FROM records) + count(DISTINCT (source, parsed_at)) AS n,
      count(DISTINCT (source, parsed_at)) AS logged FROM checked WHERE len(errs) = 0""")
def ingest_twice(spark, sf):
    """Rows of the table and of the run log after the same batch came twice."""
    root, runs = months.new_table(spark, tables.records(spark, sf)), fresh_path(spark, "runs")
    for _ in range(2):
        flows.ingest_job(spark, root, tables.record_requests(spark, sf), "event_id", AS_OF, runs=runs)
    logged = spark.read.parquet(runs).agg(F.sum("rows").alias("logged"))
    return months.read_months(spark, root).agg(F.count(F.lit(1)).alias("n")).withColumn("logged", logged.scalar())


@report(
    "export_and_trim",
    f"""{with_views(RECORDS)} SELECT count(*) FILTER (WHERE NOT cold) AS kept, count(*) FILTER (WHERE cold) AS exported
    FROM (SELECT "timestamp" < {NEWEST} - INTERVAL 20 DAY AS cold FROM records)""",
)
def export_and_trim(spark, sf):
    rows = tables.records(spark, sf)
    root = months.new_table(spark, rows)
    return flows.export_and_trim(spark, root, fresh_path(spark, "cold-export"), 20, tables.newest(rows))


@report("refreshed_version", "SELECT CAST(2 AS BIGINT) AS version, count(DISTINCT date_trunc('hour', ts)) AS hours FROM events WHERE event_id % 11 <> 0")
def refreshed_version(spark, sf):
    rows = tables.records(spark, sf)
    root = fresh_path(spark, "hourly-stats")
    flows.refresh_stats(spark, rows.filter("processed"), root, tables.newest(rows))
    version = flows.refresh_stats(spark, rows, root, tables.newest(rows))
    return versions.read_version(spark, root).agg(F.count(F.lit(1)).alias("hours")).withColumn("version", F.lit(version).cast("bigint"))


@report(
    "scanned_requests",
    f"""{with_views(REQUESTS, CHECKED)} SELECT event_id, source, parsed_at AS "timestamp",
      data, tags FROM checked""",
)
def scanned_requests(spark, sf):
    """Requests written as JSON lines, with the data as an object, and scanned with defaults."""
    path = fresh_path(spark, "requests")
    body = F.coalesce(F.concat(F.lit(',"data":'), "data"), F.lit(""))
    head = F.to_json(F.struct("event_id", "source", "timestamp", F.transform("tags", F.lower).alias("tags")))
    line = F.concat(F.regexp_replace(head, r"\}$", ""), body, F.lit("}"))
    tables.record_requests(spark, sf).select(line.alias("value")).write.text(path)
    return files.scan_requests_json(spark, path, AS_OF, "event_id BIGINT")


@report(
    "generated_records",
    """SELECT ['sensor-alpha', 'sensor-beta', 'api-ingest', 'etl-pipeline', 'webhook-receiver'][1 + event_id % 5] AS source,
      TIMESTAMP '2024-01-01 00:00:00' + to_seconds(event_id) AS "timestamp",
      '{"value":' || event_id || ',"batch":' || (event_id // 1000) || '}' AS raw_data, 'tag-' || (event_id % 10) || ',bucket-' || (event_id % 5) AS tags FROM events""",
)
def generated_records(spark, sf):
    return files.generate_records(table(spark, sf, "events").select(F.col("event_id").alias("n")))


CUSTOMERS = """WITH customers AS (
  SELECT c_custkey AS id, CASE WHEN c_nationkey = 3 THEN 'nobody' ELSE 'C' || c_custkey || '@Mail.example' END AS email,
    CASE WHEN c_nationkey = 5 THEN 200 WHEN c_nationkey = 7 THEN -1 ELSE 20 + c_nationkey END AS age, DATE '2024-01-15' AS day,
    c_nationkey = 9 AS broken FROM customer)"""


def _customer_csv(spark, sf):
    """Customers as CSV lines: some with a bad email or age, some with a field too many."""
    path = fresh_path(spark, "customers")
    email = F.when(F.expr("c_nationkey = 3"), "nobody").otherwise(F.concat(F.lit("C"), F.col("c_custkey").cast("string"), F.lit("@Mail.example")))
    age = F.when(F.expr("c_nationkey = 5"), 200).when(F.expr("c_nationkey = 7"), -1).otherwise(F.col("c_nationkey") + 20)
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), email, age.cast("string"), F.lit("2024-01-15"))
    broken = F.when(F.expr("c_nationkey = 9"), F.concat(line, F.lit(",extra"))).otherwise(line)
    table(spark, sf, "customer").select(broken.alias("value")).write.text(path)
    from ..operators.quality import validate_customers

    return validate_customers(files.scan_customers_csv(spark, path, header="false"))


@report(
    "imported_customers",
    f"""{CUSTOMERS} SELECT id, lower(email) AS email, CAST(age AS BIGINT) AS age, day AS purchase_date FROM customers
    WHERE NOT broken AND email <> 'nobody' AND age BETWEEN 0 AND 150""",
)
def imported_customers(spark, sf):
    from ..operators.quality import split_valid

    valid, _ = split_valid(_customer_csv(spark, sf), ["id"])
    return valid.select(F.col("id").cast("bigint").alias("id"), "email", F.col("age").cast("bigint").alias("age"), "purchase_date")


@report(
    "quarantined_customers",
    f"""{CUSTOMERS} SELECT CAST(id AS VARCHAR) AS id, CASE WHEN broken THEN 'row_malformed' WHEN email = 'nobody' THEN 'email_invalid'
      ELSE 'age_out_of_range' END AS errors FROM customers WHERE broken OR email = 'nobody' OR age NOT BETWEEN 0 AND 150""",
)
def quarantined_customers(spark, sf):
    from ..operators.quality import split_valid

    _, rejected = split_valid(_customer_csv(spark, sf), ["id", "email", "age"])
    return rejected.select("id", "errors")


@report("file_round_trip", "SELECT p_partkey, p_name, p_retailprice FROM part")
def file_round_trip(spark, sf):
    """Through CSV, JSON and parquet."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    schema = "p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE"
    csv_path, json_path, parquet_path = (fresh_path(spark, name) for name in ("csv", "json", "parquet"))
    parts.write.options(**files.CSV_FORMAT).csv(csv_path)
    files.read_csv(spark, csv_path, schema).write.json(json_path)
    spark.read.schema(schema).json(json_path).write.parquet(parquet_path)
    return files.scan_records(spark, parquet_path)
