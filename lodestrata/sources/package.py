"""Packages: files of each source written in parallel, and a manifest, sources.csv and checksums made from what the tasks report.

A Python data source: each task writes its files to a place of its own and returns their names, digests and counts in its commit
message; the commit moves them to their names and writes the manifest. A task that is run again leaves nothing but
unreferenced files, which the commit removes."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators.scan import numbered
from .shared import store

FORMAT = "catalog_package"
STAGING = "_staging"


def filesystem(path: str):
    """(file system, path in it) of a URI or an absolute path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (staged path, path in the package, source, sha256, records, bytes)."""

    files: list[tuple[str, str, str, str, int, int]] = field(default_factory=list)


class _Open:
    def __init__(self, fs, staged: str, path: str, source: str):
        self.out, self.staged, self.path, self.source = fs.open_output_stream(staged), staged, path, source
        self.digest, self.records, self.size = hashlib.sha256(), 0, 0

    def add(self, lines: list[str]) -> None:
        data = "".join(f"{x}\n" for x in lines).encode()
        self.out.write(data)
        self.digest.update(data)
        self.records += len(lines)
        self.size += len(data)

    def close(self) -> tuple:
        self.out.close()
        return (self.staged, self.path, self.source, self.digest.hexdigest(), self.records, self.size)


class PackageWriter(DataSourceArrowWriter):
    """Rows (source_id, part, line), those of one file together and in order."""

    def __init__(self, target: str):
        self.target = target.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = filesystem(self.target)
        place, out, now, key = f"{root}/{STAGING}/{uuid.uuid4().hex}", Written(), None, None
        fs.create_dir(place, recursive=True)
        for b in iterator:
            source, part, line = (b.column(n).to_pylist() for n in ("source_id", "part", "line"))
            at = 0
            while at < len(line):
                end = at
                while end < len(line) and (source[end], part[end]) == (source[at], part[at]):
                    end += 1
                if (source[at], part[at]) != key:
                    if now:
                        out.files.append(now.close())
                    key = (source[at], part[at])
                    now = _Open(fs, f"{place}/{len(out.files)}", f"sources/{file_name(source[at])}/part-{part[at]:05d}.jsonl", source[at])
                now.add(line[at:end])
                at = end
        if now:
            out.files.append(now.close())
        return out

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = filesystem(self.target)
        files = sorted(f for m in messages if m for f in m.files)
        for staged, path, *_ in files:
            fs.create_dir(f"{root}/{path.rpartition('/')[0]}", recursive=True)
            fs.move(staged, f"{root}/{path}")
        files.sort(key=lambda f: f[1])
        totals: dict[str, list[int]] = {}
        for _, _, source, _, records, size in files:
            t = totals.setdefault(source, [0, 0, 0])
            for i, v in enumerate((1, records, size)):
                t[i] += v
        entries = [{"path": path, "source_id": source, "sha256": digest, "records": records, "bytes": size} for _, path, source, digest, records, size in files]
        manifest = {"sources": len(totals), "files": len(files), "records": sum(t[1] for t in totals.values()), "entries": entries}
        quoted = lambda s: '"' + s.replace('"', '""') + '"' if any(c in s for c in ',"\n\r') else s
        csv = "source_id,files,records,bytes\n" + "".join(f"{quoted(s)},{a},{b},{c}\n" for s, (a, b, c) in sorted(totals.items()))
        made = {"sources.csv": csv, "checksums.sha256": "".join(f"{e['sha256']}  {e['path']}\n" for e in entries), "manifest.json": json.dumps(manifest, sort_keys=True)}
        for name, text in made.items():  # the manifest comes last: a package without one is not finished
            with fs.open_output_stream(f"{root}/{name}") as f:
                f.write(text.encode())
        self.abort(messages)

    def abort(self, messages) -> None:
        fs, root = filesystem(self.target)
        from pyarrow.fs import FileType

        if fs.get_file_info(f"{root}/{STAGING}").type == FileType.Directory:
            fs.delete_dir(f"{root}/{STAGING}")


def file_name(source: str) -> str:
    """A folder's name for a source: letters, digits, dot, dash and underscore stay, others as %XX of their bytes."""
    from urllib.parse import quote

    return quote(source, safe="") if source not in ("", ".", "..") else f"%{source.encode().hex()}_"


class PackageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "source_id string, part int, line string"

    def writer(self, schema, overwrite: bool) -> PackageWriter:
        return PackageWriter(self.options["target"])


def build_package(rows: DataFrame, path: str, source: str, order: list[str], line: Column, records_per_file: int = 100_000) -> DataFrame:
    """K05, K06, K08-K10. Write a package to a new folder and return its manifest's entries (path, source_id, sha256, records, bytes).

    Each source's rows, in order, are the lines of files of ``records_per_file``; a source with most of the rows is many
    files, written by many tasks. The driver holds one entry for each file. Null sources are named "null"; no rows give
    an empty manifest."""
    spark = rows.sparkSession
    spark.dataSource.register(PackageSource)
    lines = rows.select(F.coalesce(F.col(source).cast("string"), F.lit("null")).alias("source_id"), *[c for c in order if c != source], line.alias("line"))
    placed = numbered(store(lines), ["source_id"], order, "n")
    placed = placed.select("source_id", F.floor((F.col("n") - 1) / records_per_file).cast("int").alias("part"), "n", "line")
    placed = placed.repartition("source_id", "part").sortWithinPartitions("source_id", "part", "n").select("source_id", "part", "line")
    placed.write.format(FORMAT).mode("append").option("target", path).save()
    found = spark.read.schema("entries array<struct<path:string,source_id:string,sha256:string,records:long,bytes:long>>").json(f"{path}/manifest.json", multiLine=True)
    return found.select(F.inline("entries"))


def verify_package(entries: DataFrame, path: str) -> DataFrame:
    """J19, Z52. The manifest's entries, and files that it does not list, with the digest of the file as it is and whether it agrees."""
    spark = entries.sparkSession
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").load(f"{path}/sources")
    files = files.select(F.regexp_extract("path", r"/(sources/[^/]+/[^/]+)$", 1).alias("path"), F.sha2("content", 256).alias("actual"))
    return entries.join(files, "path", "full_outer").withColumn("matches", F.coalesce(F.col("sha256") == F.col("actual"), F.lit(False)))
