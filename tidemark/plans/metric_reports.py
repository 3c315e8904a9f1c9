"""Job health, counters, histograms, rates, alerts and admission decisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics, ratelimit
from ..schemas import BATCH_SIZE_BUCKETS, ENRICH_SECONDS_BUCKETS, JOB_SECONDS_BUCKETS
from ..session import fresh_path
from ..sources import files, tables
from .registry import report, with_views
from .views import JOB_RUNS, REQUEST_LOG, REQUESTS, SAMPLES

ON_RUNS = with_views(JOB_RUNS)
ON_SAMPLES = with_views(SAMPLES)
ON_REQUEST_LOG = with_views(REQUEST_LOG)
WIDTH = 300

# Rates per series and window: steps inside a series with restarts, grouped by the window of the later sample.
RATES = f"""{ON_SAMPLES}, steps AS (
  SELECT *, time_bucket(INTERVAL {WIDTH} SECOND, ts, TIMESTAMP '1970-01-01') AS window_start,
    lag(value) OVER (PARTITION BY handler, status ORDER BY ts) AS before FROM samples),
rates AS (
  SELECT handler, status, window_start,
    sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END) AS increase,
    sum(CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END) / {WIDTH} AS rate
  FROM steps GROUP BY 1, 2, 3)"""


def _tasks(spark, sf):
    status = F.when(F.col("status") == "success", "succeeded").otherwise("failed")
    return tables.job_runs(spark, sf).select("run_id", status.alias("status"))


@report(
    "task_status_counts",
    f"""{ON_RUNS}, tasks AS (SELECT CASE WHEN status = 'success' THEN 'succeeded' ELSE 'failed' END AS status FROM job_runs)
    SELECT s.status, count(t.status) AS n, (SELECT count(*) FROM tasks) AS tracked
    FROM (VALUES ('queued'), ('running'), ('succeeded'), ('failed'), ('cancelled')) s(status) LEFT JOIN tasks t ON t.status = s.status GROUP BY 1""",
)
def task_status_counts(spark, sf):
    return metrics.status_counts(_tasks(spark, sf))


@report(
    "job_health",
    f"""{ON_RUNS}, per_job AS (
      SELECT job_name, max(started_at) AS last_run_at,
        arg_max(duration_seconds, started_at) FILTER (WHERE status = 'success') AS last_run_duration_seconds,
        count(*) FILTER (WHERE status = 'success') AS success_count, count(*) FILTER (WHERE status <> 'success') AS failure_count,
        arg_max(coalesce(error, ''), started_at) AS newest_error
      FROM job_runs GROUP BY job_name)
    SELECT job_name, last_run_at, last_run_duration_seconds, success_count, failure_count, nullif(newest_error, '') AS last_error,
      success_count / (success_count + failure_count) AS success_rate,
      newest_error = '' AND success_count / (success_count + failure_count) >= 0.8 AS is_healthy FROM per_job""",
)
def job_health(spark, sf):
    return metrics.job_health(tables.job_runs(spark, sf))


@report("executions_by_label", f"{ON_RUNS} SELECT job_name, status, count(*) AS total FROM job_runs GROUP BY 1, 2")
def executions_by_label(spark, sf):
    return metrics.counters_by_label(tables.job_runs(spark, sf).withColumn("one", F.lit(1)), ["job_name", "status"], "one")


def _histogram(source: str, value: str, bounds: list[float], by: str = "") -> str:
    listed = ", ".join(f"({float(b)}::DOUBLE)" for b in bounds) + ", ('Infinity'::DOUBLE)"
    group = f"{by}, " if by else ""
    return f"""SELECT {group}le, round(sum({value}), 4) AS sum, count({value}) AS count, count(*) FILTER (WHERE {value} <= le) AS cumulative
    FROM {source}, (VALUES {listed}) b(le) GROUP BY {group}le"""


@report("job_duration_histogram", f"{ON_RUNS} {_histogram('job_runs', 'duration_seconds', JOB_SECONDS_BUCKETS, 'job_name')}")
def job_duration_histogram(spark, sf):
    rows = metrics.bucket_histogram(tables.job_runs(spark, sf), "duration_seconds", JOB_SECONDS_BUCKETS, ["job_name"])
    return rows.withColumn("sum", F.round("sum", 4))


@report("enrich_duration_histogram", f"{ON_RUNS} {_histogram('(SELECT duration_seconds / 10 AS v FROM job_runs)', 'v', ENRICH_SECONDS_BUCKETS)}")
def enrich_duration_histogram(spark, sf):
    spent = tables.job_runs(spark, sf).select((F.col("duration_seconds") / 10).alias("v"))
    return metrics.bucket_histogram(spent, "v", ENRICH_SECONDS_BUCKETS).withColumn("sum", F.round("sum", 4))


@report(
    "batch_size_histogram",
    f"""{with_views(REQUESTS)} {_histogram('(SELECT CAST(count(*) AS DOUBLE) AS v FROM requests GROUP BY batch_id)', 'v', BATCH_SIZE_BUCKETS)}""",
)
def batch_size_histogram(spark, sf):
    sizes = tables.record_requests(spark, sf).groupBy("batch_id").agg(F.count(F.lit(1)).cast("double").alias("v"))
    return metrics.bucket_histogram(sizes, "v", BATCH_SIZE_BUCKETS)


QUANTILE = f"""{ON_RUNS}, histogram AS ({_histogram('job_runs', 'duration_seconds', JOB_SECONDS_BUCKETS, 'job_name')}),
placed AS (SELECT job_name, le, cumulative, coalesce(lag(le) OVER (PARTITION BY job_name ORDER BY le), 0) AS lower,
    coalesce(lag(cumulative) OVER (PARTITION BY job_name ORDER BY le), 0) AS below,
    <q> * max(cumulative) OVER (PARTITION BY job_name) AS target FROM histogram)
SELECT job_name, round(arg_min(CASE WHEN isinf(le) THEN lower WHEN cumulative = below THEN lower
    ELSE lower + (le - lower) * (target - below) / (cumulative - below) END, le), 6) AS quantile
FROM placed WHERE cumulative >= target GROUP BY job_name"""


def _quantile(spark, sf, q):
    histogram = metrics.bucket_histogram(tables.job_runs(spark, sf), "duration_seconds", JOB_SECONDS_BUCKETS, ["job_name"])
    return metrics.histogram_quantile(histogram, q, ["job_name"]).withColumn("quantile", F.round("quantile", 6))


@report("duration_p95", QUANTILE.replace("<q>", "0.95"))
def duration_p95(spark, sf):
    return _quantile(spark, sf, 0.95)


@report("duration_p50", QUANTILE.replace("<q>", "0.5"))
def duration_p50(spark, sf):
    return _quantile(spark, sf, 0.5)


def _rates(spark, sf):
    return metrics.counter_rate(tables.metric_samples(spark, sf), ["handler", "status"], WIDTH)


@report("request_rates", f"{RATES} SELECT handler, status, window_start, increase, round(rate, 9) AS rate FROM rates")
def request_rates(spark, sf):
    return _rates(spark, sf).withColumn("rate", F.round("rate", 9))


RATIO = f"""{RATES}, ratios AS (
  SELECT window_start, CASE WHEN sum(increase) = 0 THEN NULL ELSE sum(CASE WHEN starts_with(status, '<class>') THEN increase ELSE 0 END) / sum(increase) END AS ratio
  FROM rates GROUP BY 1)"""
SEVERITY = "CASE WHEN ratio > 0.05 THEN 'critical' WHEN ratio > 0.01 THEN 'warning' ELSE 'ok' END AS severity"


@report("server_error_ratio", f"{RATIO.replace('<class>', '5')} SELECT window_start, round(ratio, 9) AS ratio, {SEVERITY} FROM ratios")
def server_error_ratio(spark, sf):
    return metrics.error_ratio(_rates(spark, sf)).withColumn("ratio", F.round("ratio", 9))


@report("client_error_ratio", f"{RATIO.replace('<class>', '4')} SELECT window_start, round(ratio, 9) AS ratio, {SEVERITY} FROM ratios")
def client_error_ratio(spark, sf):
    return metrics.error_ratio(_rates(spark, sf), prefix="4").withColumn("ratio", F.round("ratio", 9))


@report("traffic_drops", f"{RATES} SELECT window_start, round(sum(increase) / {WIDTH}, 9) AS total_rate FROM rates GROUP BY 1 HAVING sum(increase) / {WIDTH} < 0.012")
def traffic_drops(spark, sf):
    return metrics.traffic_drop(_rates(spark, sf), WIDTH, 0.012).withColumn("total_rate", F.round("total_rate", 9))


@report(
    "services_down",
    """SELECT job, CAST(0 AS BIGINT) AS up, last_seen FROM (
      SELECT event_type || '-' || (user_id % 7) AS job, arg_max(CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END, ts) AS up, max(ts) AS last_seen
      FROM events GROUP BY 1) WHERE up = 0""",
)
def services_down(spark, sf):
    job = F.concat_ws("-", "event_type", (F.col("user_id") % 7).cast("string"))
    up = F.when(F.expr("event_id % 4 = 0"), 0).otherwise(1)
    return metrics.service_down(tables.table(spark, sf, "events").select(job.alias("job"), up.alias("up"), "ts"))


@report(
    "sustained_traffic",
    f"""{RATES}, marked AS (
      SELECT handler, window_start, rate > 0.003 AS firing FROM rates WHERE status = '200'),
    changed AS (SELECT *, CASE WHEN firing <> lag(firing) OVER (PARTITION BY handler ORDER BY window_start) THEN 1 ELSE 0 END AS c FROM marked),
    stretched AS (SELECT *, sum(c) OVER (PARTITION BY handler ORDER BY window_start) AS stretch FROM changed)
    SELECT handler, min(window_start) AS started_at, max(window_start) AS ended_at, count(*) AS points,
      date_diff('second', min(window_start), max(window_start)) AS held_seconds
    FROM stretched WHERE firing GROUP BY handler, stretch HAVING date_diff('second', min(window_start), max(window_start)) >= 300""",
)
def sustained_traffic(spark, sf):
    points = _rates(spark, sf).filter("status = '200'").select("handler", "window_start", (F.col("rate") > 0.003).alias("firing"))
    return metrics.sustained_alert(points, ["handler"], "firing", 300)


def _write_metric_text(spark, sf):
    """Job counters as exposition text, with comments, broken lines and names that are not wanted."""
    counts = tables.job_runs(spark, sf).groupBy("job_name", "status").agg(F.count(F.lit(1)).alias("n"))
    label = F.concat(F.lit('{job="'), "job_name", F.lit('",status="'), "status", F.lit('"}'))
    lines = F.array(
        F.lit("# HELP http_requests_total requests"), F.lit(""),
        F.concat(F.lit("http_requests_total"), label, F.lit(" "), F.col("n").cast("string")),
        F.concat(F.lit("records_created_total"), label, F.lit("  "), (F.col("n") * 2).cast("string"), F.lit(" 1700000000")),
        F.concat(F.lit("http_responses_total"), label, F.lit(" broken")),
        F.concat(F.lit("process_cpu_seconds"), label, F.lit(" 1.5")),
        F.lit("lonely"),
    )
    path = fresh_path(spark, "metric-text")
    counts.select(F.explode(lines).alias("value")).write.text(path)
    return path


METRIC_NAMES = f"""{ON_RUNS}, counts AS (SELECT job_name, status, count(*) AS n FROM job_runs GROUP BY 1, 2),
  named AS (SELECT *, '{{job="' || job_name || '",status="' || status || '"}}' AS label FROM counts)"""
METRIC_TEXT = f"""{METRIC_NAMES} SELECT 'http_requests_total' || label AS name, CAST(n AS DOUBLE) AS value FROM named
  UNION ALL SELECT 'records_created_total' || label, CAST(n * 2 AS DOUBLE) FROM named"""


@report("metric_text", METRIC_TEXT)
def metric_text(spark, sf):
    return files.scan_metric_text(spark, _write_metric_text(spark, sf))


@report(
    "metric_text_labels",
    f"""{METRIC_NAMES} SELECT job_name AS job, status, 'http_requests_total' || label AS name, CAST(n AS DOUBLE) AS value FROM named
    UNION ALL SELECT job_name, status, 'records_created_total' || label, CAST(n * 2 AS DOUBLE) FROM named""",
)
def metric_text_labels(spark, sf):
    labels = files.metric_labels("name")
    return metric_text(spark, sf).select(labels["job"].alias("job"), labels["status"].alias("status"), "name", "value")


TOKEN_FOLD = f"""WITH RECURSIVE {REQUEST_LOG.strip()},
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts, event_id) AS n FROM request_log),
fold AS (
  SELECT event_id, key, ts, n, CAST(19 AS DOUBLE) AS tokens, TRUE AS allowed FROM numbered WHERE n = 1
  UNION ALL
  SELECT event_id, key, ts, n, CASE WHEN t >= 1 THEN t - 1 ELSE t END, t >= 1 FROM (
    SELECT l.event_id, l.key, l.ts, l.n, least(20.0::DOUBLE, f.tokens + date_diff('second', f.ts, l.ts) * (10::DOUBLE / 60)) AS t
    FROM fold f JOIN numbered l ON l.key = f.key AND l.n = f.n + 1))
SELECT event_id, key, ts, allowed, round(tokens, 6) AS remaining, round(greatest(0, (1 - tokens) / (10::DOUBLE / 60)), 5) AS wait_seconds FROM fold"""


@report("token_bucket", TOKEN_FOLD)
def token_bucket(spark, sf):
    decided = ratelimit.token_bucket(tables.request_log(spark, sf))
    return decided.withColumn("remaining", F.round("remaining", 6)).withColumn("wait_seconds", F.round("wait_seconds", 5))


SLIDING_FOLD = f"""WITH RECURSIVE {REQUEST_LOG.strip()},
numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts, event_id) AS n FROM request_log),
fold AS (
  SELECT event_id, key, ts, n, [ts] AS times, TRUE AS allowed, 9 AS remaining FROM numbered WHERE n = 1
  UNION ALL
  SELECT event_id, key, ts, n, CASE WHEN len(kept) < 10 THEN list_append(kept, ts) ELSE kept END, len(kept) < 10,
    CASE WHEN len(kept) < 10 THEN 9 - len(kept) ELSE 0 END FROM (
      SELECT l.event_id, l.key, l.ts, l.n, list_filter(f.times, lambda x : x >= l.ts - INTERVAL 60 SECOND) AS kept
      FROM fold f JOIN numbered l ON l.key = f.key AND l.n = f.n + 1))
SELECT event_id, key, ts, allowed, CAST(remaining AS DOUBLE) AS remaining,
  CAST(greatest(0, 60 - date_diff('second', times[1], ts)) AS DOUBLE) AS reset_in FROM fold"""


@report("sliding_window", SLIDING_FOLD)
def sliding_window(spark, sf):
    return ratelimit.sliding_window(tables.request_log(spark, sf))


@report(
    "fixed_window",
    f"""{ON_REQUEST_LOG} SELECT event_id, key, ts, date_trunc('minute', ts)::TIMESTAMP AS window_start,
      ROW_NUMBER() OVER (PARTITION BY key, date_trunc('minute', ts) ORDER BY ts, event_id) <= 10 AS allowed FROM request_log""",
)
def fixed_window(spark, sf):
    return ratelimit.fixed_window(tables.request_log(spark, sf), limit=10)
