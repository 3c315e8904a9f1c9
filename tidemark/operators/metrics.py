"""Job and metric reports: status counts, counters, histograms, rates and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import TASK_STATUSES


def status_counts(tasks: DataFrame, statuses: Sequence[str] = tuple(TASK_STATUSES)) -> DataFrame:
    """Tasks per state, with a row for every state, and the total of tracked tasks."""
    spine = tasks.sparkSession.createDataFrame([(s,) for s in statuses], "status string")
    counts = tasks.groupBy("status").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return spine.join(counts, "status", "left").select("status", F.coalesce("_n", F.lit(0)).alias("n")).withColumn("tracked", total)


def job_health(runs: DataFrame) -> DataFrame:
    """Health per job from its runs ``(run_id, job_name, started_at, duration_seconds, status, error)``."""
    newest = F.struct("started_at", "run_id")
    ok = F.col("status") == "success"
    per_job = runs.groupBy("job_name").agg(
        F.max("started_at").alias("last_run_at"),
        F.max_by(F.when(ok, F.col("duration_seconds")), F.when(ok, newest)).alias("last_run_duration_seconds"),
        F.count_if(ok).alias("success_count"),
        F.count_if(~ok).alias("failure_count"),
        F.max_by(F.when(~ok, F.col("error")), newest).alias("last_error"),
    )
    rate = F.coalesce(F.try_divide(F.col("success_count"), F.col("success_count") + F.col("failure_count")), F.lit(1.0))
    return per_job.withColumn("success_rate", rate).withColumn("is_healthy", F.col("last_error").isNull() & (rate >= 0.8))


def counters_by_label(increments: DataFrame, labels: Sequence[str], amount: str) -> DataFrame:
    return increments.groupBy(*labels).agg(F.sum(amount).alias("total"))


def bucket_histogram(df: DataFrame, value: str, buckets: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative ``le`` counts with sum and count, in one pass of conditional counts."""
    bounds = [float(b) for b in buckets] + [float("inf")]
    counts = [F.count_if(F.col(value) <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    totals = df.groupBy(*by).agg(F.sum(value).alias("sum"), F.count(value).alias("count"), *counts)
    pairs = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"_b{i}").alias("cumulative")) for i, b in enumerate(bounds)])
    return totals.select(*by, "sum", "count", F.inline(pairs))


def histogram_quantile(histogram: DataFrame, q: float, by: Sequence[str]) -> DataFrame:
    """Quantile by linear interpolation inside the first bucket that reaches it.

    The lowest bucket starts at 0; a quantile in the open last bucket is the highest finite bound.
    """
    order = Window.partitionBy(*by).orderBy("le")
    target = F.lit(float(q)) * F.col("_total")
    reached = (
        histogram.withColumn("_lower", F.coalesce(F.lag("le").over(order), F.lit(0.0)))
        .withColumn("_below", F.coalesce(F.lag("cumulative").over(order), F.lit(0)))
        .withColumn("_total", F.max("cumulative").over(Window.partitionBy(*by)))
        .filter((F.col("cumulative") >= target) & (F.col("_total") > 0))
    )
    share = F.try_divide(target - F.col("_below"), F.col("cumulative") - F.col("_below"))
    inside = F.col("_lower") + (F.col("le") - F.col("_lower")) * F.coalesce(share, F.lit(0.0))
    value = F.when(F.col("le") == float("inf"), F.col("_lower")).otherwise(inside)
    return reached.groupBy(*by).agg(F.min_by(value, "le").alias("quantile"))


def counter_rate(samples: DataFrame, series: Sequence[str], width_seconds: int) -> DataFrame:
    """Increase and rate per series and window; a drop of the counter counts as a restart from 0.

    Rows are compared inside a window only. What happens between two windows follows from their last and first
    values, so a long series is never sorted as a whole. Samples of one time count in the order of their values.
    """
    series = list(series)
    windowed = samples.withColumn("window_start", F.window("ts", f"{width_seconds} seconds")["start"])
    inside = Window.partitionBy(*series, "window_start").orderBy("ts", "value")
    before = F.lag("value").over(inside)
    step = F.when(before.isNull(), 0.0).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    per_window = (
        windowed.withColumn("_step", step)
        .groupBy(*series, "window_start")
        .agg(F.sum("_step").alias("_inside"), F.min_by("value", F.struct("ts", "value")).alias("_first"), F.max_by("value", F.struct("ts", "value")).alias("_last"))
    )
    previous = F.lag("_last").over(Window.partitionBy(*series).orderBy("window_start"))
    across = (
        F.when(previous.isNull(), 0.0).when(F.col("_first") < previous, F.col("_first")).otherwise(F.col("_first") - previous)
    )
    return (
        per_window.withColumn("increase", F.col("_inside") + across)
        .withColumn("rate", F.col("increase") / F.lit(width_seconds))
        .drop("_inside", "_first", "_last")
    )


def error_ratio(rates: DataFrame, status: str = "status", prefix: str = "5", warning: float = 0.01, critical: float = 0.05) -> DataFrame:
    """Share of the rate with a status of the given class per window, with its severity.

    All rates of a window cover the same time, so the increases give the same share; they are whole numbers for
    counters, whose sum does not depend on the order of the rows.
    """
    bad = F.sum(F.when(F.startswith(F.col(status), F.lit(prefix)), F.col("increase")).otherwise(0.0))
    totals = rates.groupBy("window_start").agg(F.try_divide(bad, F.sum("increase")).alias("ratio"))
    severity = F.when(F.col("ratio") > critical, "critical").when(F.col("ratio") > warning, "warning").otherwise("ok")
    return totals.withColumn("severity", severity)


def traffic_drop(rates: DataFrame, width_seconds: int, threshold: float = 0.01) -> DataFrame:
    """Windows whose total rate is below the threshold."""
    total = (F.sum("increase") / F.lit(width_seconds)).alias("total_rate")
    return rates.groupBy("window_start").agg(total).filter(F.col("total_rate") < threshold)


def service_down(ups: DataFrame, job: str = "job", at: str = "ts") -> DataFrame:
    """Jobs whose last ``up`` sample is 0."""
    return ups.groupBy(job).agg(F.max_by("up", F.struct(at, "up")).alias("up"), F.max(at).alias("last_seen")).filter(F.col("up") == 0)


def sustained_alert(
    points: DataFrame, series: Sequence[str], firing: str, hold_seconds: int, at: str = "window_start", slice_seconds: int = 86_400
) -> DataFrame:
    """Stretches of consecutive points where the condition holds for at least ``hold_seconds``.

    ``points`` are evaluations, one per series and step, not raw samples; those without a time or with an unknown condition
    take no part. A series is cut into slices of time. Only the first and the last run of a slice can go on in another, so
    a task sorts one slice, or two rows per slice, even if there is no series and all points are one timeline.
    """
    series = list(series)
    known = points.filter(F.col(firing).isNotNull() & F.col(at).isNotNull())
    known = known.withColumn("_slice", F.floor(F.col(at).cast("timestamp").cast("long") / F.lit(slice_seconds)))
    inside = Window.partitionBy(*series, "_slice").orderBy(at)
    changed = F.coalesce((F.col(firing) != F.lag(firing).over(inside)).cast("int"), F.lit(0))
    runs = (
        known.withColumn("_changed", changed)
        .withColumn("_run", F.sum("_changed").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy(*series, "_slice", "_run")
        .agg(F.max(firing).alias("_on"), F.min(at).alias("started_at"), F.max(at).alias("ended_at"), F.count(F.lit(1)).alias("points"))
        .withColumn("_edge", (F.col("_run") == 0) | (F.col("_run") == F.max("_run").over(Window.partitionBy(*series, "_slice"))))
        .withColumns({"_own_slice": F.when(~F.col("_edge"), F.col("_slice")), "_own_run": F.when(~F.col("_edge"), F.col("_run"))})
    )
    across = Window.partitionBy(*series, "_own_slice", "_own_run").orderBy("_slice", "_run")
    goes_on = F.col("_on") & F.lag("_on").over(across) & (F.lag("_slice").over(across) != F.col("_slice"))
    stretches = (
        runs.withColumn("_new", F.when(goes_on, 0).otherwise(1))
        .withColumn("_stretch", F.sum("_new").over(across.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .filter("_on")
        .groupBy(*series, "_own_slice", "_own_run", "_stretch")
        .agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"), F.sum("points").alias("points"))
        .drop("_own_slice", "_own_run", "_stretch")
    )
    held = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    return stretches.withColumn("held_seconds", held).filter(F.col("held_seconds") >= hold_seconds)
