"""Input columns, batch sizes and shared files of the operators."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch. Texts differ in length by orders of magnitude, so a
#: batch must stay small when all of its rows are long ones.
ARROW_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches at ARROW_ROWS rows or fewer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """The id (as long) and the text (null as empty), and nothing else, so
    that further columns of the input can't clash with those of an operator."""
    small_batches(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), *more,
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filesystem(path: str):
    """(pyarrow file system, path on it) of a shared folder or file."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        if path.startswith("file:"):
            return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class SharedFile:
    """A file written under a name of its own and moved to its final name when
    whole, so that a lost or repeated task never leaves a part of one."""

    def __init__(self, folder: str, name: str):
        self.fs, top = filesystem(folder)
        self.fs.create_dir(top, recursive=True)
        self.path = posixpath.join(top, name)
        self.draft = posixpath.join(top, f".{name}.{uuid.uuid4().hex}")
        self.out = self.fs.open_output_stream(self.draft)
        self.size = 0

    def write(self, data: bytes) -> int:
        """Append; returns where the data begin."""
        at, self.size = self.size, self.size + len(data)
        self.out.write(data)
        return at

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.draft, self.path)


def read_range(folder: str, name: str, at: int, size: int) -> bytes:
    fs, top = filesystem(folder)
    with fs.open_input_file(posixpath.join(top, name)) as f:
        return f.read_at(size, at)
