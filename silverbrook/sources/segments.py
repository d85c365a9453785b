"""Messages with offsets: a stream over the segments of a topic's partitions.

A topic's export lies in folders ``partition=<n>/first=<offset>``, a segment each: text files, in order
of their names, with a message a line; the folder names the offset of its first message. The reader is a
Spark data source, so the checkpoint holds offsets per partition: a stream starts at the earliest message
that is kept, goes on where the last finished batch ended, and reads the very same messages again when a
batch has failed. A task reads at most ``perTask`` messages. Segments that are complete may be removed from
the front; a stream that still needs them fails and says so.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

PER_TASK = 1_000_000
Offsets = dict[str, int]


@dataclass
class Span(InputPartition):
    """Messages [begin, end) of one partition, and the segments that hold them."""

    partition: int
    begin: int
    end: int
    segments: list[tuple[int, str]]


class SegmentReader(DataSourceStreamReader):
    def __init__(self, path: str, per_task: int) -> None:
        self.path, self.per_task = path, per_task

    def _segments(self) -> dict[str, list[tuple[int, str]]]:
        """(first offset, folder) of every segment by partition, in order."""
        store, root = fs.FileSystem.from_uri(self.path)
        out: dict[str, list[tuple[int, str]]] = {}
        for found in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            parts = found.path.rsplit("/", 2)
            if found.type == fs.FileType.Directory and parts[-1].startswith("first="):
                out.setdefault(parts[-2].removeprefix("partition="), []).append(
                    (int(parts[-1].removeprefix("first=")), found.path))
        return {name: sorted(segments) for name, segments in sorted(out.items())}

    def _lines(self, folder: str) -> Iterator[str]:
        store, _ = fs.FileSystem.from_uri(self.path)
        files = sorted(f.path for f in store.get_file_info(fs.FileSelector(folder))
                       if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))
        for name in files:
            with store.open_input_stream(name) as raw:
                held = b""
                while block := raw.read(1 << 20):
                    *lines, held = (held + block).split(b"\n")
                    yield from (line.decode() for line in lines)
                if held:
                    yield held.decode()

    def initialOffset(self) -> Offsets:
        return {name: segments[0][0] for name, segments in self._segments().items()}

    def latestOffset(self) -> Offsets:
        """Only the last segment of each partition is counted."""
        return {name: segments[-1][0] + sum(1 for _ in self._lines(segments[-1][1]))
                for name, segments in self._segments().items()}

    def partitions(self, start: Offsets, end: Offsets) -> list[Span]:
        out, known = [], self._segments()
        for name, stop in end.items():
            segments = known.get(name, [])
            begin = start.get(name, segments[0][0] if segments else stop)
            if begin < stop and (not segments or segments[0][0] > begin):
                raise ValueError(f"messages of partition {name} from {begin} on are gone")
            for at in range(begin, stop, self.per_task):
                upto = min(at + self.per_task, stop)
                nexts = [first for first, _ in segments[1:]] + [stop]
                held = [s for s, after in zip(segments, nexts, strict=True) if s[0] < upto and after > at]
                out.append(Span(int(name), at, upto, held))
        return out

    def read(self, partition: Span) -> Iterator[tuple[int, int, str]]:
        for first, folder in partition.segments:
            for offset, line in enumerate(self._lines(folder), first):
                if offset >= partition.end:
                    return
                if offset >= partition.begin:
                    yield partition.partition, offset, line


class Segments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_segments"

    def schema(self) -> str:
        return "partition int, offset bigint, value string"

    def streamReader(self, schema: StructType) -> SegmentReader:
        return SegmentReader(self.options["path"], int(self.options.get("perTask", PER_TASK)))


def message_segments(spark: SparkSession, path: str, per_task: int = PER_TASK) -> DataFrame:
    """A topic's segments as a stream of (partition, offset, value)."""
    spark.dataSource.register(Segments)
    return spark.readStream.format("message_segments").option("perTask", per_task).load(path)
