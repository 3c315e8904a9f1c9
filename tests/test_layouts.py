"""Layouts that tell a reader where to look: zones of a column per file, positions per range of ids."""

import random
import re

from pyspark.sql import functions as F

from tidemark.operators import mutations, reads
from tidemark.plans import flows
from tidemark.session import fresh_path
from tidemark.sources import months, positions, zones

DAY = "2024-01-15 10:00:00"


def spread_records(make_records, months_of_year, per_month, first=0):
    return make_records(*[
        (first + m * per_month + i, "ab"[i % 2], f"2023-{m + 1:02d}-15 10:00:{i % 60:02d}", '{"value": %d}' % i) for m in range(months_of_year) for i in range(per_month)
    ])


def touch(df, at):
    return mutations.mark_processed(df, df.select("id"), at)


def test_only_files_with_a_change_are_read(spark, make_records):
    read = {}
    for size in (1, 12):
        path, log = months.new_table(spark, spread_records(make_records, size, 20)), fresh_path(spark, "log")
        zone = zones.ZoneMap(spark, path)
        files = zone.note()
        assert files >= size and zone.note() == 0 and zone.files_since("2024-01-01") == []
        assert zone.changed_since("2024-01-01").collect() == []
        flows.change_records(spark, path, log, 1, spark.createDataFrame([(3,), (7,)], "id BIGINT"), lambda df: touch(df, DAY))
        unnoted = zone.files_since("2024-01-01")
        assert sorted(r.id for r in zone.changed_since("2024-01-01").collect()) == [3, 7]  # before any note of the new files
        zone.note()
        assert set(zone.files_since("2024-01-01")) <= set(unnoted)
        changed = zone.changed_since("2024-01-01")
        assert sorted(r.id for r in changed.collect()) == [3, 7] and "ym" not in changed.columns
        assert set(changed.inputFiles()) == set(zone.files_since("2024-01-01"))
        read[size] = len(zone.files_since("2024-01-01"))
        assert zone.changed_since(DAY).count() == 0
        whole = months.read_months(spark, path)
        for moment in ("2000-01-01", "2023-01-15 10:00:05"):
            assert zone.changed_since(moment).exceptAll(reads.modified_since(whole.drop("ym"), moment)).count() == 0
            assert zone.changed_since(moment).count() == reads.modified_since(whole, moment).count()
        before = zone.notes().count()
        zone.tidy()
        assert zone.notes().count() == len(whole.inputFiles()) < before and zone.note() == 0
    assert read[12] <= read[1]  # files follow the change, not the table


def test_extracts_continue_where_the_last_run_ended(spark, make_records):
    path, log, target, runs = months.new_table(spark, spread_records(make_records, 3, 10)), *(fresh_path(spark, n) for n in ("log", "extract", "runs"))
    assert flows.extract_changes(spark, path, target, runs, "2023-12-31 00:00:00") == 30
    assert flows.extract_changes(spark, path, target, runs, "2024-01-01 00:00:00") == 0
    flows.change_records(spark, path, log, 1, spark.createDataFrame([(3,), (25,)], "id BIGINT"), lambda df: touch(df, DAY))
    assert flows.extract_changes(spark, path, target, runs, "2024-01-15 09:00:00") == 0  # the change lies after it
    # A run that stopped before it was logged is repeated; one that was logged stays as it is.
    flows.change_records(spark, path, log, 2, spark.createDataFrame([(4,)], "id BIGINT"), lambda df: touch(df, "2024-01-15 11:00:00"))
    spark.range(5).select(F.lit(99).cast("bigint").alias("id")).write.parquet(f"{target}/run=20240116000000000000")
    for rows in (3, 0):
        assert flows.extract_changes(spark, path, target, runs, "2024-01-16 00:00:00") == rows
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == sorted([*range(30), 3, 4, 25])


def test_zones_of_nulls_and_of_nothing(spark, make_records):
    rows = make_records((1, "a", DAY, "{}"), (2, "a", "2024-02-15 10:00:00", "{}"))
    path = months.new_table(spark, rows.withColumn("updated_at", F.lit(None).cast("timestamp_ntz")))
    zone = zones.ZoneMap(spark, path)
    zone.note()
    assert zone.files_since("2000-01-01") == [] and zone.changed_since("2000-01-01").count() == 0
    missing = zones.ZoneMap(spark, fresh_path(spark, "nothing"))
    assert missing.note() == 0 and missing.changed_since("2000-01-01").collect() == []


def test_pages_equal_plain_offsets_after_deletes(spark, make_records):
    rnd = random.Random(3)
    rows = make_records(*[(i * 3 - 50, rnd.choice("ab"), "2024-01-15 10:00:00", "{}", False, rnd.choice([None, None, DAY])) for i in range(200)])
    path, log = months.new_table(spark, rows), fresh_path(spark, "log")
    index = positions.PositionIndex(spark, fresh_path(spark, "positions"), width=32, fan=4)
    assert index.page(rows, 0, 5).count() == 0
    flows.log_change(log, 1, rows.limit(0), rows)
    flows.refresh_positions(spark, index, log)
    for step in range(2, 5):
        ids = rows.filter(F.col("id").isin(rnd.sample(range(-50, 550), 150))).select("id")
        change = (lambda df: mutations.undelete(df, df.select("id"))) if step == 3 else (lambda df: mutations.soft_delete(df, df.select("id"), DAY))
        flows.change_records(spark, path, log, step, ids, change)
        flows.refresh_positions(spark, index, log)
    table = months.read_months(spark, path).drop("ym")
    for skip, limit, source in ((0, 10, None), (37, 20, "a"), (90, 500, None), (1_000, 5, "b"), (10, 1, "none")):
        expected = [r.id for r in reads.offset_page(table, skip, limit, source).collect()]
        assert [r.id for r in index.page(table, skip, limit, source).collect()] == expected
    index.merge(least=2)
    assert index.spans() == [(1, 4)] == index._all_spans()
    flows.refresh_positions(spark, index, log)
    assert [r.id for r in index.page(table, 20, 7).collect()] == [r.id for r in reads.offset_page(table, 20, 7).collect()]


def test_a_deep_page_reads_two_ranges(spark):
    rows = spark.range(50_000).select(
        "id", F.lit("a").alias("source"), F.lit(DAY).cast("timestamp_ntz").alias("timestamp"), F.lit("{}").alias("raw_data"),
        F.lit(False).alias("processed"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
    )
    path, log = fresh_path(spark, "table"), fresh_path(spark, "log")
    rows.write.parquet(path)
    flows.log_change(log, 1, rows.limit(0), rows)
    index = positions.PositionIndex(spark, fresh_path(spark, "positions"), width=1_000)
    flows.refresh_positions(spark, index, log)
    assert index.bounds(40_950, 100) == (40_000, 42_000, 40_000) and index.bounds(40_100, 100) == (40_000, 41_000, 40_000)
    page = index.page(spark.read.parquet(path), 40_950, 100)
    assert [r.id for r in page.collect()] == list(range(40_950, 41_050))
    formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = page._jdf.queryExecution().explainString(formatted)
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(id,40000\), LessThan\(id,42000\)", plan)
