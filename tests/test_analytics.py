import random
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import analytics, spread

NOON = "2024-03-01 12:00:00"


def values(*numbers):
    return [f'{{"value": {n}}}' if n is not None else "{}" for n in numbers]


def test_three_null_policies(make_records):
    rows = make_records(*[(i, "s", "2024-03-01 11:00:00", raw) for i, raw in enumerate(values(100, None, 200))])
    zero = analytics.summary_zero(rows, 24, NOON).first()
    skip = analytics.summary_skip(rows, 24, NOON).first()
    stored = analytics.hourly_stats(rows, NOON).first()
    assert (zero.record_count, zero.avg_value, zero.min_value, zero.max_value) == (3, 100.0, 0.0, 200.0)
    assert (skip.record_count, skip.avg_value, skip.min_value, skip.max_value) == (3, 150.0, 100.0, 200.0)
    assert (stored.avg_value, stored.min_value, stored.max_value, stored.source_list) == (100.0, 100.0, 200.0, ["s"])


def test_hour_without_values_and_zero_stays_zero(make_records):
    none = make_records((1, "s", "2024-03-01 11:00:00", "{}"), (2, "s", "2024-03-01 11:00:00", '{"value": "n/a"}'))
    row = analytics.summary_skip(none, 24, NOON).first()
    assert (row.record_count, row.avg_value, row.min_value, row.processed_pct) == (2, None, None, 0.0)
    zero = make_records((1, "s", "2024-03-01 11:00:00", '{"value": 0}'))
    assert analytics.summary_skip(zero, 24, NOON).first().max_value == 0.0


def test_empty_input(make_records):
    empty = make_records((1, "s", "2024-03-01 11:00:00", "{}")).filter("false")
    assert analytics.summary_zero(empty, 24, NOON).count() == 0
    assert analytics.percentile_by_value(empty, "s").count() == 0
    assert analytics.top_by_source(empty, 5, 24, NOON).count() == 0


def test_window_border_and_bounds(make_records):
    rows = make_records((1, "s", "2024-02-29 12:00:00", "{}"), (2, "s", "2024-02-29 11:59:59", "{}"))
    assert [r.record_count for r in analytics.summary_zero(rows, 24, datetime(2024, 3, 1, 12)).collect()] == [1]
    for hours in (0, 169):
        try:
            analytics.summary_zero(rows, hours, NOON)
            raise AssertionError("out of range hours were accepted")
        except ValueError:
            pass


def test_rounding_is_half_up(make_records):
    rows = make_records((1, "s", "2024-03-01 11:00:00", '{"value": 123.45685}'))
    assert analytics.summary_zero(rows, 24, NOON).first().avg_value == 123.4569


def ranks(make_records, numbers, limit=5):
    rows = make_records(*[(i, "s", "2024-03-01 11:00:00", raw) for i, raw in enumerate(values(*numbers))])
    return sorted(r["rank"] for r in analytics.top_by_source(rows, limit, 24, NOON).collect())


def test_rank_ties(make_records):
    assert ranks(make_records, [100, 100, 50]) == [1, 1, 3]
    assert ranks(make_records, [100, 50, 50]) == [1, 2, 2]
    assert ranks(make_records, [100, 90, 80]) == [1, 2, 3]
    assert ranks(make_records, [100, 50, 50, 50], limit=2) == [1, 2, 2, 2]


def test_positional_rank_puts_missing_last(make_records):
    rows = make_records(*[(i, "s", f"2024-03-01 11:00:0{i}", raw) for i, raw in enumerate(values(None, 5, 5, 0))])
    found = analytics.top_by_source_positional(rows, 4, 24, NOON).orderBy("rank").collect()
    assert [(r["rank"], r.id) for r in found] == [(1, 2), (2, 1), (3, 3), (4, 0)]


def test_percent_rank(make_records):
    rows = make_records(*[(i, "s", "2024-03-01 11:00:00", raw) for i, raw in enumerate(values(10, 30, 20))])
    found = analytics.percentile_by_value(rows, "s").collect()
    assert [(r.value, r.percentile_rank) for r in found] == [(30.0, 0.0), (20.0, 0.5), (10.0, 1.0)]
    single = rows.filter("id = 0")
    assert analytics.percentile_by_value(single, "s").first().percentile_rank == 0.0
    assert analytics.percentile_by_recency(single, "s").first().percentile_rank == 0.0


def test_percent_rank_below_the_limit_uses_the_whole_source(make_records):
    rows = make_records(*[(i, "s", "2024-03-01 11:00:00", f'{{"value": {i}}}') for i in range(11)])
    assert [r.percentile_rank for r in analytics.percentile_by_value(rows, "s", limit=3).collect()] == [0.0, 0.1, 0.2]


def test_nested_lists_split_large_sources(make_records):
    rows = make_records(*[(i, "s", "2024-03-01 11:00:00", '{"value": 1}') for i in range(50)])
    nested = analytics.nest_by_source(analytics.top_by_source(rows, 1, 24, NOON), rows_per_part=10).collect()
    assert {part["part"]: [item["id"] for item in part["rows"]] for part in nested} == {p: list(range(10 * p, 10 * p + 10)) for p in range(5)}


def test_positions_by_cell(spark):
    ids = sorted([-7, -1, 0, 3, 4, 5, 17, 100, 101, 9_000_000_000, 1 << 62] + [(i + 1) << 21 for i in range(60)])
    rows = spark.createDataFrame([(i, "ab"[i % 2]) for i in ids], "id BIGINT, k STRING")
    found = {r.id: r.position for r in spread.running_position(rows, "id").collect()}
    assert [found[i] for i in ids] == list(range(1, len(ids) + 1))
    by_key = {(r.k, r.id): r.position for r in spread.running_position(rows, "id", ["k"]).collect()}
    for key in "ab":
        own = [i for i in ids if "ab"[i % 2] == key]
        assert [by_key[key, i] for i in own] == list(range(1, len(own) + 1))


def test_rank_levels_equal_the_plain_rank(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("source"), (F.hash("id") % 700).cast("double").alias("value")
    )
    ranked = spread.rank_levels(spread.value_levels(rows, "source", "value"), "source", "value", cuts=9).collect()
    plain = rows.collect()
    for level in ranked:
        own = [r.value for r in plain if r.source == level.source]
        assert level["rank"] == 1 + sum(v > level.value for v in own) and level.total == len(own)


def test_salted_join_equals_the_join(spark):
    many = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    one = spark.createDataFrame([("hot", 1), ("950", 2), ("nobody", 3)], "k STRING, v INT")
    for how in ("inner", "left", "left_semi", "left_anti"):
        expected = sorted(many.join(one, "k", how).collect(), key=str)
        assert sorted(spread.salted_join(many, one, ["k"], how, salts=4).collect(), key=str) == expected


def test_stored_sketches_unite_over_ranges_and_batches(spark):
    rows = spark.range(60_000).select(
        F.concat(F.lit("s"), F.col("id") % 20_000).alias("source"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"),
        F.timestamp_micros(F.col("id") * 1_000_000 + 1_704_067_200_000_000).cast("timestamp_ntz").alias("timestamp"),
    )
    halves = [analytics.distinct_sketches(rows.filter(F.crc32("source") % 2 == i)) for i in (0, 1)]
    both = halves[0].unionByName(halves[1])
    found = analytics.estimated_distinct(both, "2024-01-01", "2024-01-02").first()["estimate"]
    assert abs(found - 20_000) <= 0.05 * 20_000
    hour = analytics.estimated_distinct(both, "2024-01-01 01:00:00", "2024-01-01 02:00:00").first()["estimate"]
    assert abs(hour - 3600) <= 0.05 * 3600
    assert analytics.estimated_distinct(both, "2030-01-01", "2030-01-02").first()["estimate"] == 0


def outlier_rows(df):
    return sorted((r.id, r.source, r.value, r.percentile_rank) for r in df.collect())


def test_outliers_by_bars_equal_the_full_ranking(spark, make_records):
    rnd = random.Random(6)
    raw = lambda i: rnd.choice(['{"value": %d}' % rnd.randint(-50, 50), '{"value": %f}' % rnd.gauss(0, 9), "{}", '{"value": 7}'])
    many = [(i, "big" if i < 2500 else "few", f"2024-0{1 + i % 3}-15 10:00:00", raw(i), False, None if i % 9 else "2024-04-01 00:00:00") for i in range(2520)]
    same = [(5000 + i, "same", "2024-01-15 10:00:00", '{"value": 1}') for i in range(50)] + [(6000, "one", "2024-01-15 10:00:00", "{}"), (6001, None, "2024-01-15 10:00:00", "{}")]
    rows = make_records(*many, *same)
    sketches = analytics.value_sketches(rows)
    for share in (0.0, 0.02, 0.3, 1.0):
        assert outlier_rows(analytics.percentile_outliers_over(rows, sketches, share)) == outlier_rows(analytics.percentile_outliers(rows, share))
    few = analytics.value_bars(sketches, 0.02).filter("source = 'big'").first()
    above = rows.filter(f"source = 'big' AND deleted_at IS NULL AND coalesce(try_cast(get_json_object(raw_data, '$.value') AS double), 0) >= {few.bar}")
    assert few.total == 2222 and above.count() < 0.1 * few.total  # a small share is shuffled


def test_a_bar_that_is_too_high_loses_nothing(spark, make_records, monkeypatch):
    rows = make_records(*[(i, "ab"[i % 2], "2024-01-15 10:00:00", '{"value": %d}' % i) for i in range(100)])
    sketches = analytics.value_sketches(rows)
    whole = outlier_rows(analytics.percentile_outliers(rows, 0.2))
    true_bars = analytics.value_bars
    monkeypatch.setattr(analytics, "value_bars", lambda s, share: true_bars(s, share).withColumn("bar", F.when(F.col("source") == "a", 96.0).otherwise(F.col("bar"))))
    assert outlier_rows(analytics.percentile_outliers_over(rows, sketches, 0.2)) == whole


def test_outliers_of_nothing(spark, make_records):
    rows = make_records((1, "a", "2024-01-15 10:00:00", "{}")).limit(0)
    assert analytics.percentile_outliers_over(rows, analytics.value_sketches(rows), 0.1).collect() == []
