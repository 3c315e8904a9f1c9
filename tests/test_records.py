from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.cursor import decode_cursor, encode_cursor
from tidemark.operators import joins, mutations, quality, reads
from tidemark.session import fresh_path
from tidemark.sources import files, versions

NOW = "2024-03-02 00:00:00"


@pytest.fixture
def rows(make_records):
    return make_records(
        (1, "a", "2024-03-01 10:00:00", "{}"), (2, "a", "2024-03-01 10:00:00.000001", "{}"), (3, "b", "2024-03-01 10:00:00", "{}"),
        (4, "a", "2024-03-01 12:00:00", "{}"), (5, "b", "2024-03-01 11:00:00", "{}", True, "2024-03-01 13:00:00"),
    )


def ids(df):
    return [r.id for r in df.collect()]


def table(df):
    return {r.id: r for r in df.collect()}


def test_range_includes_start_and_excludes_end(rows):
    found = reads.newest_first(reads.date_range(rows, "2024-03-01 10:00:00", "2024-03-01 12:00:00"))
    assert ids(found) == [2, 3, 1]
    both = reads.unprocessed_by_source(rows, "a", "2024-03-01 10:00:00", "2024-03-01 12:00:00")
    assert ids(both) == [4, 2, 1]


def test_keyset_pages_cover_everything_once(rows):
    seen, cursor = [], None
    while True:
        page = reads.keyset_page(rows, cursor, 2).collect()
        seen += [r.id for r in page]
        cursor = next((r.next_cursor for r in page if r.next_cursor), None)
        if not page[0].has_more:
            break
    assert seen == [1, 3, 2, 4]


def test_cursor_round_trip_and_invalid_cursor(rows):
    assert decode_cursor(encode_cursor(3, datetime(2024, 3, 1, 10))) == (3, datetime(2024, 3, 1, 10))
    for broken in ("", "!!", "bm90IGpzb24=", "W10="):
        assert decode_cursor(broken) is None
    assert ids(reads.keyset_page(rows, "!!", 2)) == [1, 3]


def test_deep_offset_equals_plain_offset(spark):
    many = spark.range(500).select((F.col("id") * 7 - 1000).alias("id"), F.lit("s").alias("source"), F.lit(None).alias("deleted_at"))
    for skip in (0, 3, 250, 498, 700):
        assert ids(reads.offset_page(many, skip, 20)) == [i * 7 - 1000 for i in range(skip, min(500, skip + 20))]


def test_missing_ids_keep_the_first_position(spark, rows):
    wanted = spark.createDataFrame([(0, 9), (1, 5), (2, 9), (3, 1)], "position INT, id BIGINT")
    assert sorted((r.id, r.position) for r in reads.missing_ids(rows, wanted).collect()) == [(5, 1), (9, 0)]


def test_upsert_against_a_deleted_row(spark, rows):
    incoming = spark.createDataFrame(
        [(1, "b", "2024-03-01 11:00:00"), (2, "a", "2024-03-01 10:00:00"), (4, "c", "2024-03-01 10:00:00"), (3, "c", "2024-03-01 10:00:00")],
        "arrival BIGINT, source STRING, timestamp STRING",
    ).select("arrival", "source", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), F.lit("{}").alias("raw_data"), F.array().cast("array<string>").alias("tags"))
    found = {r.arrival: (r.outcome, r.record_id) for r in mutations.resolve_upsert(rows, incoming, "arrival").collect()}
    assert found == {1: ("conflict_deleted", 5), 2: ("existing", 1), 3: ("created", 6), 4: ("existing", 6)}
    after = mutations.upsert_records(rows, incoming, "arrival", NOW)
    assert sorted(ids(after)) == [1, 2, 3, 4, 5, 6]
    assert mutations.upsert_records(after, incoming, "arrival", NOW).count() == 6


def test_second_mark_keeps_the_first_time_and_touches_deleted_rows(spark, rows):
    wanted = spark.createDataFrame([(1,), (5,)], "id BIGINT")
    once = mutations.mark_processed(rows, wanted, "2024-03-02 00:00:00")
    twice = table(mutations.mark_processed(once, wanted, "2024-03-03 00:00:00"))
    assert twice[1].processed and twice[1].processed_at == datetime(2024, 3, 2) and twice[5].processed_at == datetime(2024, 3, 2)
    assert not twice[2].processed


def test_update_keeps_nulls_and_touches_deleted_rows(spark, rows):
    changes = spark.createDataFrame([(1, '{"value": 7}', None), (5, None, ["x"])], "id BIGINT, raw_data STRING, tags ARRAY<STRING>")
    after = table(mutations.partial_update(rows, changes, NOW))
    assert (after[1].raw_data, after[1].tags) == ('{"value": 7}', ["a"])
    assert (after[5].raw_data, after[5].tags, after[5].updated_at) == ("{}", ["x"], datetime(2024, 3, 2))


def test_soft_delete_and_undelete(spark, rows):
    wanted = spark.createDataFrame([(1,), (5,), (9,)], "id BIGINT")
    after = table(mutations.soft_delete(rows, wanted, NOW))
    assert after[1].deleted_at == datetime(2024, 3, 2) and after[5].deleted_at == datetime(2024, 3, 1, 13)
    report = {r.id: r.outcome for r in mutations.soft_delete_report(rows, wanted).collect()}
    assert report == {1: "deleted", 5: "already_deleted", 9: "not_found"}
    assert table(mutations.undelete(rows, wanted))[5].deleted_at is None


def test_enrichment_outcomes(spark, rows):
    wanted = spark.createDataFrame([(0, 9), (1, 2), (2, 4), (3, 2)], "position INT, id BIGINT")
    posts = spark.createDataFrame([(2, "t", "b"), (200, "far", "away")], "id BIGINT, title STRING, body STRING")
    found = joins.enrich_left_join(wanted, rows, posts).orderBy("position").collect()
    assert [(r.record_id, r.source, r.external_title, r.enriched, r.error) for r in found] == [
        (9, "unknown", None, False, "Record 9 not found"), (2, "a", "t", True, None),
        (4, "a", None, False, "Post 4 not found"), (2, "a", "t", True, None),
    ]


def test_validation_matrix(spark):
    cases = {
        "ok": ("api.example.com", "2024-01-15T10:00:00Z", '{"price": 1}', ["Stock"]),
        "": ("", None, "{}", None), "long": ("x" * 256, None, "{}", None), "edge": ("x" * 255, None, "{}", None),
        "reserved": ("LOCALHOST", None, "{}", None), "ip": ("::1", None, "{}", None),
        "future": ("s", "2999-01-01T00:00:00", "{}", None), "bad time": ("s", "yesterday", "{}", None),
        "no data": ("s", None, None, None), "list": ("s", None, "[1]", None), "number": ("s", None, "3", None),
        "tags": ("s", None, "{}", [str(i) for i in range(11)]), "many": (None, "x", None, None),
    }
    frame = spark.createDataFrame(
        [(name, *case) for name, case in cases.items()], "name STRING, source STRING, timestamp STRING, data STRING, tags ARRAY<STRING>"
    )
    found = {r.name: r for r in quality.validate_requests(frame, NOW).collect()}
    errors = {name: row.errors for name, row in found.items()}
    assert errors == {
        "ok": [], "": ["source_length"], "long": ["source_length"], "edge": [], "reserved": ["source_reserved"], "ip": ["source_reserved"],
        "future": ["timestamp_future"], "bad time": ["timestamp_invalid"], "no data": ["data_missing"], "list": ["data_not_object"],
        "number": ["data_not_object"], "tags": ["too_many_tags"], "many": ["source_missing", "data_missing", "timestamp_invalid"],
    }
    assert found["ok"].tags == ["stock"] and found[""].parsed_at == datetime(2024, 3, 2)


def test_zone_is_dropped_not_converted(spark):
    frame = spark.createDataFrame([("s", "2024-01-15T10:00:00+05:00", "{}", None)], "source STRING, timestamp STRING, data STRING, tags ARRAY<STRING>")
    assert quality.normalize_requests(frame, NOW).first().parsed_at == datetime(2024, 1, 15, 10)


def test_batch_sizes(spark):
    sizes = spark.range(1001).select(F.lit(1).alias("batch_id")).union(spark.range(1000).select(F.lit(2).alias("batch_id")))
    assert {r.batch_id: r.size_ok for r in quality.batch_sizes(sizes).collect()} == {1: False, 2: True}


def test_versions_follow_the_log(spark, rows):
    root = fresh_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, root)
    assert versions.write_version(rows, root) == 1
    broken = rows.withColumn("id", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception):
        versions.write_version(broken, root)
    assert versions.read_version(spark, root).count() == 5
    assert versions.write_version(versions.read_version(spark, root).filter("id > 2"), root) == 2
    assert versions.read_version(spark, root).count() == 3 and versions.read_version(spark, root, 1).count() == 5


def test_month_filter_prunes_partitions(spark, rows):
    path = fresh_path(spark, "months")
    files.write_by_month(rows, path)
    stored = spark.read.parquet(path).withColumn("ym", F.col("ym").cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stored.schema)
    pruned = mutations.month_range(spark.read.schema(schema).parquet(path), "2024-02-10 00:00:00", "2024-03-01 10:30:00")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "202402" in plan and "202403" in plan
    assert sorted(ids(pruned)) == [1, 2, 3]


def test_csv_keeps_quotes_and_microseconds(spark, rows):
    path = fresh_path(spark, "csv")
    sample = rows.select("id", "timestamp", F.lit('{"a": "x,\\"y\\""}').alias("raw_data"))
    files.write_csv_gz(sample, path)
    again = files.read_csv(spark, path, "id BIGINT, timestamp TIMESTAMP_NTZ, raw_data STRING")
    assert sorted(again.collect()) == sorted(sample.collect())


def test_filters_reach_the_scan(spark):
    path = fresh_path(spark, "scan")
    spark.range(10).select("id", F.lit("s").alias("source"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"), F.lit("x").alias("unused")).write.parquet(path)
    plan = reads.by_source(reads.active_only(spark.read.parquet(path)), "s").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(deleted_at)" in plan and "EqualTo(source,s)" in plan and "unused" not in plan


def test_active_view_and_approximate_count(spark, rows):
    from tidemark.operators.analytics import distinct_sources

    reads.register_active_view(rows, "v_active_records")
    assert spark.sql("SELECT count(*) AS n FROM v_active_records").first().n == 4
    assert distinct_sources(rows, approximate=True).first().unique_sources == 2


def test_backoff_grows_to_its_ceiling_with_bounded_jitter(spark):
    from tidemark.functions.scalars import backoff_seconds

    delays = spark.range(8).select(
        "id", backoff_seconds("id", 1.0, 30.0).alias("plain"), backoff_seconds("id", 1.0, 30.0, 0.2).alias("spread")
    ).collect()
    assert [r.plain for r in delays] == [1, 2, 4, 8, 16, 30, 30, 30]
    assert all(0.8 * r.plain <= r.spread <= 1.2 * r.plain for r in delays)


def test_synthetic_records(spark):
    from datetime import date

    found = files.generate_records(spark.range(1002).withColumnRenamed("id", "n")).collect()
    assert (found[0].source, found[4].source, found[5].source) == ("sensor-alpha", "webhook-receiver", "sensor-alpha")
    assert found[1001].raw_data == '{"value":1001,"batch":1}' and found[1001].tags == ["tag-1", "bucket-1"]
    assert files.dated_path("s3://cold/", date(2024, 3, 1)) == "s3://cold/2024-03-01"
