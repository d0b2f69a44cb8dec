"""One file from many tasks: tasks write parts beside it, the commit strings them together."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

CHUNK = 1 << 22


def _store(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    return (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(path)


@dataclass
class Part(WriterCommitMessage):
    number: int
    name: str
    rows: int


class SingleFileWriter(DataSourceWriter):
    """Texts of the first column as one file: head, texts with `between` between them, tail; or `empty` if there are none.

    A part is named by partition and attempt, and only parts that commit names are read, so lost or repeated tasks change nothing. The file
    appears under its name when it is complete; an older one is there until then. Commit streams bytes of parts, CHUNK at a time.
    """

    def __init__(self, options: dict):
        self.files, self.path = _store(options["path"])
        self.head, self.between, self.tail, self.empty = (options.get(k, "").encode() for k in ("head", "between", "tail", "empty"))
        self.folder = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Part:
        task = TaskContext.get()
        name = f"{self.folder}/{task.partitionId():06d}-{task.taskAttemptId()}"
        self.files.create_dir(self.folder, recursive=True)
        rows = 0
        with self.files.open_output_stream(name, buffer_size=CHUNK) as out:
            for row in iterator:
                out.write((self.between if rows else b"") + (row[0] or "").encode())
                rows += 1
        return Part(task.partitionId(), name, rows)

    def commit(self, messages: list) -> None:
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.number)
        whole = f"{self.folder}/whole"
        self.files.create_dir(self.folder, recursive=True)
        with self.files.open_output_stream(whole, buffer_size=CHUNK) as out:
            out.write(self.head if parts else self.empty)
            for i, part in enumerate(parts):
                out.write(self.between if i else b"")
                with self.files.open_input_stream(part.name) as read:
                    while some := read.read(CHUNK):
                        out.write(some)
            out.write(self.tail if parts else b"")
        self.files.move(whole, self.path)
        self.files.delete_dir(self.folder)

    def abort(self, messages: list) -> None:
        if self.files.get_file_info(self.folder).type == fs.FileType.Directory:
            self.files.delete_dir(self.folder)


class SingleFile(DataSource):
    @classmethod
    def name(cls) -> str:
        return "single_file"

    def writer(self, schema, overwrite: bool) -> SingleFileWriter:
        return SingleFileWriter(dict(self.options))


def write_single_file(texts: DataFrame, path: str, order: list[str], head: str = "", between: str = "\n", tail: str = "", empty: str = "") -> None:
    """texts (text, and the columns of order) as one file at a path of a store that pyarrow.fs knows; see SingleFileWriter. A path without a scheme is
    one of Spark's default store."""
    spark = texts.sparkSession
    spark.dataSource.register(SingleFile)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    path = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    dealt = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("text")
    dealt.write.format("single_file").mode("append").option("head", head).option("between", between).option("tail", tail).option("empty", empty).save(path)
