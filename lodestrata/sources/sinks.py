"""Sinks: nested exports, append logs, checksums, packages. Data go through Spark's writers; single documents are small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def snapshot_documents(resources: DataFrame, by: list[str], fields: list[str], form: str = "map") -> DataFrame:
    """K01. One JSON document for each snapshot: 'map' (by resource_key), 'compact' (two columns) or 'tree' (by discovering
    page). Documents are as large as their snapshot."""
    if form == "tree":
        pages = resources.groupBy(*by, "discovered_from_url").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("resources"))
        body = F.sort_array(F.collect_list(F.struct("discovered_from_url", "resources")))
        return pages.groupBy(*by).agg(F.to_json(body).alias("document"))
    cols = fields if form == "map" else fields[:2]
    item = F.struct(*cols)
    body = F.map_from_entries(F.sort_array(F.collect_list(F.struct("resource_key", item.alias("v"))))) if form == "map" else F.sort_array(F.collect_list(item))
    return resources.groupBy(*by).agg(F.to_json(body).alias("document"))


def upsert(current: DataFrame, changes: DataFrame, key: list[str], at: str) -> DataFrame:
    """K02, Z20. The newest row of each key of both tables; to be written over the old table's partitions."""
    every = current.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    w = Window.partitionBy(*key).orderBy(F.col(at).desc(), F.col("__new").desc())
    return every.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__new")


def append(rows: DataFrame, path: str, partition: list[str]) -> None:
    """K03."""
    rows.write.mode("append").partitionBy(*partition).parquet(path)


def write_partitions(rows: DataFrame, path: str, partition: list[str], fmt: str = "json") -> None:
    """K05, K08, K09, K10. A file set for each value of the partition columns; the rows of one value go to one task."""
    rows.repartition(*partition).write.mode("overwrite").partitionBy(*partition).format(fmt).save(path)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """K06, D07. (path, sha256, line) of every file below a folder, hashed where the file is read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    out = f.select("path", F.sha2("content", 256).alias("sha256"))
    return out.withColumn("line", F.concat_ws("  ", "sha256", "path"))


def parse_checksums(lines: DataFrame, line: str = "value") -> DataFrame:
    """Z46. (path, sha256, n) of checksum lines; n > 1 tells a path listed twice."""
    parts = F.split(F.col(line), "  ", 2)
    out = lines.where(F.trim(line) != "").select(parts[1].alias("path"), parts[0].alias("sha256"))
    return out.groupBy("path").agg(F.min("sha256").alias("sha256"), F.count("*").alias("n"))


def zip_package(files: list[tuple[str, bytes]]) -> bytes:
    """K07. A ZIP archive whose bytes depend on names and contents alone. For single packages, on the driver."""
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in sorted(files):
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), data, zipfile.ZIP_DEFLATED)
    return out.getvalue()


def fingerprint(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """A26, D08. One hash of a small table's rows in order, from JSON with sorted names."""
    row = F.to_json(F.struct(*sorted(columns)))
    hashed = F.transform(F.array_sort(F.collect_list(F.struct(*order, row.alias("__json")))), lambda x: x["__json"])
    return df.agg(F.sha2(F.array_join(hashed, "\n"), 256).alias("fingerprint"))


def stable_hash(*columns: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)
