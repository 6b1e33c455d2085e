"""A line source with offsets of its own: a folder of text files as a stream.

Files are taken in the order of their names (new ones must sort behind those
already there), ``filesPerTrigger`` per trigger; the offset is the number of
files read.  Files are cut into byte ranges, which executors read on their
own, so a trigger's lines never pass through the driver; ``at`` is a line's
byte position, and (``file``, ``at``) is the order of arrival.

The engine keeps the offsets; a trigger that has to be run again reads the
same ranges.  ``progress`` names a small file on shared storage with the last
planned offset, from which a restarted stream counts on.  No port is opened.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SPLIT_BYTES = 64 << 20
SCHEMA = "value string, file string, at bigint"


class LineRange(InputPartition):
    """The lines that begin in [begin, end) of a file."""

    def __init__(self, file: str, begin: int, end: int):
        self.file, self.begin, self.end = file, begin, end


def _storage(path: str):
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class LineReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.progress = options["path"], options["progress"]
        self.limit = int(options.get("filesPerTrigger", 1))
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.planned = self._load()

    def _load(self) -> int:
        from pyarrow import fs
        store, path = _storage(self.progress)
        if store.get_file_info(path).type == fs.FileType.NotFound:
            return 0
        with store.open_input_stream(path) as f:
            return json.loads(f.read())["files"]

    def _files(self) -> list:
        from pyarrow import fs
        store, path = _storage(self.path)
        found = store.get_file_info(fs.FileSelector(path, recursive=False))
        return sorted((f for f in found if f.is_file and f.base_name[0] not in "._"), key=lambda f: f.base_name)

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        return {"files": max(self.planned, min(len(self._files()), self.planned + self.limit))}

    def partitions(self, start: dict, end: dict) -> list[LineRange]:
        self.planned = end["files"]
        store, path = _storage(self.progress)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(path) as f:
            f.write(json.dumps(end).encode())
        return [LineRange(f.path, at, min(f.size, at + self.split))
                for f in self._files()[start["files"]:end["files"]] for at in range(0, f.size, self.split)]

    def read(self, partition: LineRange) -> Iterator[tuple]:
        store, _ = _storage(self.path)
        with store.open_input_file(partition.file) as raw:
            import io
            f = io.BufferedReader(raw, 1 << 20)
            at = partition.begin
            if at:                      # a line belongs to the range it begins in
                f.seek(at - 1)
                at += len(f.readline()) - 1
            while at < partition.end:
                line = f.readline()
                if not line:
                    break
                yield line.rstrip(b"\r\n").decode("utf-8", "replace"), partition.file, at
                at += len(line)

    def commit(self, end: dict) -> None:
        pass                            # files are the user's: nothing is removed

    def stop(self) -> None:
        pass


class LineFolder(DataSource):
    """``spark.readStream.format("line_folder")``."""

    @classmethod
    def name(cls) -> str:
        return "line_folder"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LineReader:
        return LineReader(self.options)


def stream_lines(spark: SparkSession, path: str, progress: str, files_per_trigger: int = 1,
                 split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """SRC7: the folder's lines as a stream (value, file, at)."""
    spark.dataSource.register(LineFolder)
    return (spark.readStream.format("line_folder").option("path", path).option("progress", progress)
            .option("filesPerTrigger", files_per_trigger).option("splitBytes", split_bytes).load())
