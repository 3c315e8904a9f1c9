import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests", f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_records(spark):
    """Records from ``(id, source, timestamp, raw_data[, processed[, deleted_at]])`` tuples."""

    def make(*rows):
        from pyspark.sql import functions as F

        full = [(list(row) + [False, None])[:6] if len(row) == 4 else (list(row) + [None])[:6] for row in rows]
        base = spark.createDataFrame(
            full, "id BIGINT, source STRING, timestamp STRING, raw_data STRING, processed BOOLEAN, deleted_at STRING"
        )
        at = F.col("timestamp").cast("timestamp_ntz")
        return base.select(
            "id", "source", at.alias("timestamp"), "raw_data", F.array(F.lit("a")).alias("tags"), "processed",
            F.lit(None).cast("timestamp_ntz").alias("processed_at"), at.alias("created_at"), at.alias("updated_at"),
            F.col("deleted_at").cast("timestamp_ntz").alias("deleted_at"),
        )

    return make
