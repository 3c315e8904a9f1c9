"""Keyed runs: lookups that open few folders, merges, repeated batches."""

import re

from pyspark.sql import functions as F

from tidemark.session import fresh_path, scratch, settle, shared_dir
from tidemark.sources.runs import KeyedRuns

SCHEMA = "id BIGINT, k STRING, payload STRING"


def frame(spark, low, high):
    return spark.range(low, high).select((F.col("id") + 1).alias("id"), F.concat(F.lit("key-"), "id").alias("k"), F.repeat(F.lit("x"), 200).alias("payload"))


def keys(spark, *numbers):
    return spark.createDataFrame([(f"key-{n}",) for n in numbers], "k STRING")


def size_of(spark, table, kind, pairs):
    total = 0
    for run, buckets in pairs.items():
        for bucket in buckets:
            where = spark._jvm.org.apache.hadoop.fs.Path(f"{table.path}/{kind}/run={run}/bucket={bucket}")
            files = where.getFileSystem(spark._jsc.hadoopConfiguration())
            total += files.getContentSummary(where).getLength() if files.exists(where) else 0
    return total


def test_lookup_opens_only_buckets_that_may_hold_a_key(spark):
    table = KeyedRuns(spark, fresh_path(spark, "runs"), SCHEMA, "k", rows_a_bucket=50)
    table.add(frame(spark, 0, 2000), 0)
    assert [r.buckets for r in table.runs()] == [40]
    asked, opened = table.folders(keys(spark, 5, 1999, 70_000, 70_001))
    assert 1 <= len(asked["0-0-0-40"]) <= 4 and len(opened["0-0-0-40"]) == 2
    found = table.holding(keys(spark, 5, 1999, 70_000))
    assert {"key-5", "key-1999"} <= {r.k for r in found.collect()} and found.count() < 200
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert table.holding(keys(spark, *range(70_000, 70_005))).count() < 100
    # No false negative, and few false positives among unseen keys.
    assert {f"key-{n}" for n in range(2000)} <= {r.k for r in table.holding(frame(spark, 0, 2000).select("k")).collect()}
    hits = sum(len(b) for n in range(5) for b in table.folders(keys(spark, 80_000 + n))[1].values())
    assert hits <= 1


def test_bytes_read_stay_flat_while_the_table_grows_tenfold(spark):
    table = KeyedRuns(spark, fresh_path(spark, "runs"), SCHEMA, "k", rows_a_bucket=100, fan=4)
    wanted = keys(spark, 3, 17, 100_001, 100_002)
    read = {}
    for batch in range(20):
        table.merge(batch)
        table.add(frame(spark, batch * 500, batch * 500 + 500), batch)
        if batch in (1, 19):
            asked, opened = table.folders(wanted)
            read[batch] = size_of(spark, table, "rows", opened), size_of(spark, table, "filters", asked) / len(table.runs())
    assert table.rows().count() == 10_000 and table.top() == 10_000
    assert read[19][0] <= 1.5 * read[1][0] and read[19][1] <= 1.5 * read[1][1]
    assert len(table.runs()) <= 4 * 3


def test_merges_and_repeated_batches(spark):
    table = KeyedRuns(spark, fresh_path(spark, "runs"), SCHEMA, "k", rows_a_bucket=10, fan=3)
    for batch in range(7):
        table.merge(batch)
        table.add(frame(spark, batch * 10, batch * 10 + 10), batch)
        table.add(frame(spark, batch * 10, batch * 10 + 10), batch)
    assert sorted(r.id for r in table.rows().collect()) == list(range(1, 71))
    assert [(r.level, r.first, r.last) for r in table.runs()] == [(1, 0, 2), (1, 3, 5), (0, 6, 6)]
    # A merged batch that comes again adds nothing; its rows are held under a run of its own no more.
    table.add(frame(spark, 0, 10), 0)
    assert table.rows().count() == 70 and table.holding(keys(spark, 4), but=0).count() >= 1
    assert table.top(but=6) == 60 and table.holding(keys(spark, 65), but=6).filter("k = 'key-65'").count() == 0
    # A run whose rows are not complete is no run.
    where, files = table._file("rows", f"run={table.runs()[-1].name}", "_SUCCESS")
    files.delete(where, False)
    assert [r.level for r in table.runs()] == [1, 1] and table.top() == 60


def test_settled_tables_of_a_scope_are_removed(spark):
    def folders():
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark")
        files = where.getFileSystem(spark._jsc.hadoopConfiguration())
        return {s.getPath().getName() for s in files.listStatus(where) if "scope-test" in s.getPath().getName()} if files.exists(where) else set()

    with scratch(spark):
        assert settle(spark.range(3), "scope-test").count() == 3
        with scratch(spark):
            settle(spark.range(2), "scope-test")
        assert len(folders()) == 1
    assert folders() == set()
    kept = settle(spark.range(1), "scope-test")
    assert len(folders()) == 1 and kept.count() == 1
