"""Tables in the cluster's shared folder: lineage is cut there, and a lost executor costs one stage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where that is unset, a folder of this machine serves a session that runs on this machine
    alone; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (base or "/tmp/checkpoints").rstrip("/")


def store(df: DataFrame, *by: str) -> DataFrame:
    """Write a table, in folders by the values of ``by``, and read it back."""
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd")
    (out.partitionBy(*by) if by else out).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def spread(df: DataFrame, *keys: str, rows: int = 20_000) -> DataFrame:
    """``df`` dealt by ``keys`` over as many tasks as its rows ask for, for work that costs much a row: files of few row groups, and
    shuffles that are joined again by their bytes, would leave it to few tasks. ``df`` should be a table or a cheap view of one, as
    it is counted."""
    return df.repartition(df.count() // rows + 1, *keys)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``store`` wrote, once all that reads them is written."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
