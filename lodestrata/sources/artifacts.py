"""A folder of artifacts (configurations, logs, reports) as a table: a Python data source that plans partitions of files by size,
and takes filters on path, name, suffix, length and time before a file is opened."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith

from .files import decode_log
from .package import filesystem

FORMAT = "artifact_files"
SCHEMA = "path string, name string, suffix string, length long, modified timestamp, content binary"
PARTITION = 16 << 20  # bytes of files in a partition, but for larger single files
BATCH = 4 << 20
_TESTS = {
    EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x, LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x,
    StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x), StringContains: lambda v, x: x in v,
}


@dataclass
class Files(InputPartition):
    """(path, length, time in microseconds) of a partition's files."""

    files: list[tuple[str, int, int]]


class ArtifactReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.tests = dict(options), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on what a listing knows are taken; the others stay with Spark."""
        for f in filters:
            test = _TESTS.get(type(f))
            if test and f.attribute in (("path",), ("name",), ("suffix",), ("length",)):
                self.tests.append((f.attribute[0], test, f.value))
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs as pafs

        fs, root = filesystem(self.options["path"])
        single = fs.get_file_info(root)
        if single.type == pafs.FileType.NotFound:
            return [Files([])]
        every = [single] if single.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        found = []
        for i in every:
            facts = {"path": i.path, "name": i.base_name, "suffix": suffix(i.base_name), "length": i.size}
            hidden = any(p.startswith((".", "_")) for p in i.path[len(root) :].split("/"))
            if i.type == pafs.FileType.File and not hidden and all(test(facts[c], v) for c, test, v in self.tests):
                found.append((i.path, i.size, (i.mtime_ns or 0) // 1000))
        out, size = [Files([])], 0
        for f in sorted(found):
            if out[-1].files and size + f[1] > PARTITION:
                out.append(Files([]))
                size = 0
            out[-1].files.append(f)
            size += f[1]
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.options["path"])
        kept, size = [], 0
        for path, length, time in partition.files:
            with fs.open_input_file(path) as f:
                kept.append((path, path.rpartition("/")[2], suffix(path), length, time, f.read()))
            size += length
            if size > BATCH:
                yield _batch(kept)
                kept, size = [], 0
        if kept:
            yield _batch(kept)


def suffix(name: str) -> str:
    """The last suffix of a name in lower case, with its dot; empty without one."""
    base = name.rpartition("/")[2].lstrip(".")
    return f".{base.rpartition('.')[2].lower()}" if "." in base else ""


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.timestamp("us", tz="UTC"), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["path", "name", "suffix", "length", "modified", "content"])


class ArtifactSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArtifactReader:
        return ArtifactReader(self.options)


def artifact_files(spark: SparkSession, path: str) -> DataFrame:
    """S01, S19, S21, S23. Files below a folder, or one file: path, name, suffix, length, modified, content. Hidden files and folders
    (names that begin with a dot or an underscore) are left out; a folder that is missing or empty gives no rows. Turns filter
    pushdown for Python data sources on in the session, as plans are made later."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArtifactSource)
    return spark.read.format(FORMAT).option("path", path).load()


def artifact_texts(spark: SparkSession, path: str) -> DataFrame:
    """The files with their text and charset, sniffed as console logs are."""
    return artifact_files(spark, path).withColumn("t", decode_log(F.col("content"))).select("path", "name", "suffix", "length", "modified", "t.text", "t.charset")
