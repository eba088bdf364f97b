"""A scan of Markdown headers that reads no more of a file than its header: a Spark data source.

A folder's files are a task (a large folder's are several), which lists the folder itself: the
driver walks folders only. Files are opened through pyarrow's file systems, so a URI of any
store that it knows will do, and a local path where all executors share it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.frontmatter import field_in, list_in
from ..functions.text import unquoted

SCHEMA = "path string, header string, bytes_read long, error string"
#: Fixed value: lines of a header at most. Bytes of a read, files of a task, rows of a batch.
LINES, BLOCK, FILES, ROWS = 100, 1024, 10_000, 1000


def head(stream) -> tuple[str, int]:
    """The lines between the marks, each with its line feed ('' without a mark in the first line), and the bytes that were read for it."""
    raw, lines, done = b"", [], False
    while not done:
        block = stream.read(BLOCK)
        raw += block
        lines = raw.replace(b"\r\n", b"\n").split(b"\n")
        whole = lines if not block else lines[:-1]  # what comes last may go on
        done = not block or len(whole) > LINES + 1 or bool(whole) and (whole[0] != b"---" or b"---" in whole[1:])
    if lines[0] != b"---":
        return "", len(raw)
    end = lines.index(b"---", 1) if b"---" in lines[1:] else len(lines)
    ended = end < len(lines) or end > LINES + 1
    inner = lines[1 : min(end, LINES + 1)]
    text = b"".join(x + b"\n" for x in inner) if ended else b"\n".join(inner)
    return text.decode("utf-8"), len(raw)


@dataclass
class Folder(InputPartition):
    place: str
    nth: int
    of: int


class _Reader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def _opened(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root) if "://" in self.root else (fs.LocalFileSystem(), self.root)

    def partitions(self) -> list[Folder]:
        store, base = self._opened()
        found, left = [], [base.rstrip("/")]
        while left:
            place, n = left.pop(), 0
            for info in store.get_file_info(fs.FileSelector(place, allow_not_found=True)):
                if info.type == fs.FileType.Directory:
                    left.append(info.path)
                n += info.type == fs.FileType.File
            tasks = -(-n // FILES)
            found += [Folder(place, k, tasks) for k in range(tasks)]
        return found or [Folder(base.rstrip("/"), 0, 1)]

    def read(self, folder: Folder) -> Iterator[pa.RecordBatch]:
        store, base = self._opened()
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)], names=["path", "header", "bytes_read", "error"])

        for info in store.get_file_info(fs.FileSelector(folder.place, allow_not_found=True)):
            if info.type != fs.FileType.File or not info.path.endswith(".md") or crc32(info.base_name.encode()) % folder.of != folder.nth:
                continue
            path, n, error = info.path[len(base.rstrip("/")) + 1 :], 0, None
            try:
                with store.open_input_stream(info.path) as stream:
                    text, n = head(stream)
            except (OSError, UnicodeDecodeError) as failed:
                text, error = "", str(failed)
            rows.append((path, text, n, error))
            if len(rows) == ROWS:
                yield batch()
                rows.clear()
        if rows:
            yield batch()


class HeaderSource(DataSource):
    """``spark.read.format("markdown_headers").load(root)``."""

    @classmethod
    def name(cls) -> str:
        return "markdown_headers"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def read_headers(spark: SparkSession, root: str) -> DataFrame:
    """path (below ``root``), header, bytes_read, error of every Markdown file; a file that can't be read has an empty header and its error."""
    spark.dataSource.register(HeaderSource)
    return spark.read.format("markdown_headers").load(root)


def fields(headers: DataFrame) -> DataFrame:
    """path and the fields of :func:`sijill.sources.files.fields`, of headers alone."""
    names = ("title", "source", "source_url", "doc_type", "category", "status", "etag", "last_modified", "retrieved_at")
    h = F.col("header")
    return headers.select("path", *(unquoted(field_in(h, n)).alias(n) for n in names), list_in(h, "also_available_from").alias("also_available_from"))
