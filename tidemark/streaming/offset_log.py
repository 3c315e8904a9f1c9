"""An event log whose positions are offsets, as a streaming source.

The log lies in folders ``part=k/segment=s`` that hold the offsets from ``s * rows_a_segment`` on. A stream's position is the next
offset of every partition: it is what the checkpoint keeps, where a restart goes on, and what a replay names as its start. Executors
open only segments of the asked range.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..schemas import LOG

SEGMENT_ROWS = 100_000


def land_log(log: DataFrame, path: str, rows_a_segment: int = SEGMENT_ROWS) -> None:
    """Append rows with the columns of ``schemas.LOG``; offsets of a partition must not come twice."""
    placed = log.withColumn("segment", F.expr(f"off div {rows_a_segment}"))
    placed.hint("rebalance", "part", "segment").write.mode("append").partitionBy("part", "segment").parquet(path)


class OffsetRange(InputPartition):
    def __init__(self, part: int, start: int, end: int):
        self.part, self.start, self.end = part, start, end


def _segments(path: str) -> dict[int, list[int]]:
    """Numbers of the segments of every partition."""
    from pyarrow import fs

    disk, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    found: dict[int, list[int]] = {}
    for item in disk.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        if item.type == fs.FileType.Directory and "segment=" in item.base_name:
            part = int(item.path.split("part=")[1].split("/")[0])
            found.setdefault(part, []).append(int(item.base_name.removeprefix("segment=")))
    return {part: sorted(numbers) for part, numbers in sorted(found.items())}


def _table(path: str, part: int, segment: int, columns: list[str], keep=None):
    from pyarrow import dataset

    return dataset.dataset(f"{path}/part={part}/segment={segment}", format="parquet").to_table(columns=columns, filter=keep)


class OffsetReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.rows = int(options.get("rowsasegment", SEGMENT_ROWS))
        self.starting = json.loads(options.get("startingoffsets", "{}"))

    def initialOffset(self) -> dict:
        return {str(part): int(at) for part, at in self.starting.items()}

    def latestOffset(self) -> dict:
        """One past the newest offset of each partition, from its last segment."""
        from pyarrow import compute

        ends = {str(p): compute.max(_table(self.path, p, numbers[-1], ["off"])["off"]).as_py() + 1 for p, numbers in _segments(self.path).items()}
        return {part: max(end, int(self.starting.get(part, 0))) for part, end in ends.items()}

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        """A task per segment and partition that has offsets of the range."""
        out = []
        for part, stop in end.items():
            low = int(start.get(part, 0))
            for segment in range(low // self.rows, -(-int(stop) // self.rows)):
                a, b = max(low, segment * self.rows), min(int(stop), (segment + 1) * self.rows)
                if a < b:
                    out.append(OffsetRange(int(part), a, b))
        return out

    def read(self, partition: OffsetRange):
        import pyarrow as pa
        from pyarrow import dataset

        off = dataset.field("off")
        keep = (off >= partition.start) & (off < partition.end)
        table = _table(self.path, partition.part, partition.start // self.rows, ["topic", "off", "key", "ts", "value"], keep)
        for batch in table.to_batches():
            part = pa.array([partition.part] * batch.num_rows, pa.int32())
            columns = {name: batch.column(name) for name in ("topic", "off", "key", "ts", "value")} | {"part": part}
            yield pa.RecordBatch.from_pydict({name: columns[name] for name in ("topic", "part", "off", "key", "ts", "value")})


class OffsetLog(DataSource):
    """Options: ``path``, ``rowsasegment`` as the log was landed with, ``startingoffsets`` as JSON ``{partition: offset}``."""

    @classmethod
    def name(cls) -> str:
        return "offset_log"

    def schema(self) -> str:
        return LOG

    def streamReader(self, schema) -> OffsetReader:
        return OffsetReader(self.options)


def offset_log(spark: SparkSession, path: str, starting: dict[int, int] | None = None, rows_a_segment: int = SEGMENT_ROWS) -> DataFrame:
    """The log as a stream from the given offsets on, from its beginning without."""
    spark.dataSource.register(OffsetLog)
    start = json.dumps({str(p): n for p, n in (starting or {}).items()})
    return spark.readStream.format("offset_log").options(path=path, rowsasegment=str(rows_a_segment), startingoffsets=start).load()
