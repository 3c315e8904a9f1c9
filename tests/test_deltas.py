"""Hourly parts kept up by changes, and joins of heavy keys."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import analytics, mutations, spread
from tidemark.plans import flows
from tidemark.session import fresh_path
from tidemark.sources import months

SHAPE = "id BIGINT, source STRING, timestamp STRING, raw_data STRING, processed BOOLEAN, deleted_at STRING"


def hours_of(df):
    return sorted((tuple(r) for r in df.drop("materialized_at").collect()), key=repr)


def test_refreshes_equal_the_full_rebuild(spark, make_records):
    rnd = random.Random(8)
    rows = []
    for i in range(120):
        at = datetime(2024, 1, 30) + timedelta(minutes=rnd.randrange(60 * 24 * 4))
        raw = rnd.choice(['{"value": %d}' % rnd.randint(-3, 3), "{}", '{"value": "n/a"}'])
        rows.append((i, rnd.choice("abc"), str(at), raw, rnd.random() < 0.5, rnd.choice([None, None, "2024-03-01 00:00:00"])))
    table = make_records(*rows)
    path, parts, log = months.new_table(spark, table), fresh_path(spark, "parts"), fresh_path(spark, "log")
    flows.log_change(log, 1, table.limit(0), table)
    assert flows.refresh_hours(spark, path, parts, log) == ["202401", "202402"]
    now = "2024-03-02 00:00:00"
    for step in range(2, 7):
        ids = spark.createDataFrame([(i,) for i in rnd.sample(range(120), 25)], "id BIGINT")
        change = [
            lambda df: mutations.soft_delete(df, df.select("id"), now), lambda df: mutations.undelete(df, df.select("id")),
            lambda df: df.withColumn("raw_data", F.format_string('{"value": %d}', F.col("id") % 5)),
        ][step % 3]
        flows.change_records(spark, path, log, step, ids, change)
        if step != 4:
            flows.refresh_hours(spark, path, parts, log)
            whole = analytics.hourly_stats(months.read_months(spark, path).drop("ym"), now)
            assert hours_of(flows.read_hours(spark, parts).select(*whole.drop("materialized_at").columns)) == hours_of(whole)
    assert flows.refresh_hours(spark, path, parts, log) == []


def test_a_refresh_reads_only_touched_months(spark, make_records):
    """Rows of the other month are beyond reading, in the table and in the parts."""
    table = make_records(*[(i, "a", f"2024-0{1 + i % 2}-15 10:00:00", '{"value": %d}' % i) for i in range(10)])
    path, parts, log = months.new_table(spark, table), fresh_path(spark, "parts"), fresh_path(spark, "log")
    flows.log_change(log, 1, table.limit(0), table)
    flows.refresh_hours(spark, path, parts, log)
    ids = spark.createDataFrame([(9,)], "id BIGINT")  # the highest value of February
    flows.change_records(spark, path, log, 2, ids, lambda df: mutations.soft_delete(df, df.select("id"), "2024-03-01"))
    for root in (path, parts):
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/ym=202401")
        disk = where.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in disk.listStatus(where):
            out = disk.create(status.getPath(), True)
            out.write(bytearray(b"broken"))
            out.close()
    assert flows.refresh_hours(spark, path, parts, log) == ["202402"]
    february = months.read_months(spark, parts, flows.deltas.PARTS, ["202402"]).first()
    assert (february.rows, february.low, february.high, february.applied) == (4, 1.0, 7.0, 2)


def test_a_refresh_that_stopped_is_not_applied_twice(spark, make_records):
    table = make_records(*[(i, "a", f"2024-01-15 1{i}:00:00", '{"value": 1}') for i in range(4)])
    path, parts, log = months.new_table(spark, table), fresh_path(spark, "parts"), fresh_path(spark, "log")
    flows.log_change(log, 1, table.limit(0), table)
    flows.refresh_hours(spark, path, parts, log)
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{parts}-refreshed")
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)  # as if it had stopped before its last step
    flows.refresh_hours(spark, path, parts, log)
    assert {r.record_count for r in flows.read_hours(spark, parts).collect()} == {1}
    # So is a change that runs again.
    ids = spark.createDataFrame([(0,)], "id BIGINT")
    for _ in range(2):
        flows.change_records(spark, path, log, 2, ids, lambda df: mutations.soft_delete(df, df.select("id"), "2024-03-01"))
    flows.refresh_hours(spark, path, parts, log)
    assert flows.read_hours(spark, parts).count() == 3


def test_only_heavy_keys_are_copied(spark, monkeypatch):
    many = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500).alias("k"))
    one = spark.range(-1, 500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    heavy = spread.heavy_keys(many, ["k"], 16)
    assert len(heavy) == 1 and 5 <= heavy[0][1] <= 8
    for how in ("inner", "left", "left_semi"):
        joined = spread.salted_join(many, one, ["k"], how, salts=16)
        assert "_salt" in joined._jdf.queryExecution().toString()
        assert joined.exceptAll(many.join(one, ["k"], how)).count() == 0 and joined.count() == 20_000
    copies = []
    inner = spread.F.explode
    monkeypatch.setattr(spread.F, "explode", lambda c: copies.append(c) or inner(c))
    spread.salted_join(many, one, ["k"], salts=16)
    assert len(copies) == 1  # one side only, whose rows become keys + copies of the heavy one
    even = spark.range(5000).select((F.col("id") % 1000).alias("k"))
    assert spread.heavy_keys(even, ["k"], 16) == [] and "_salt" not in spread.salted_join(even, one, ["k"], salts=16)._jdf.queryExecution().toString()
