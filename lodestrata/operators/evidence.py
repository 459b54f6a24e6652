"""Audits that join what was planned with what logs, checkpoints and resources show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rules as R
from .audit import unique_rows

# Extensions by the kind of evidence that they are.
DATA_FILES = [".csv", ".xlsx", ".xls", ".ods", ".json", ".xml", ".parquet"]
DOCUMENT_FILES = [".pdf", ".doc", ".docx", ".ppt", ".pptx"]
ARCHIVE_FILES = [".zip", ".rar", ".7z", ".gz"]
CATALOG_APIS = ["CMS_WORDPRESS_API", "CMS_DRUPAL_API", "API_DOCUMENTATION"]


def segment_audit(matrix: DataFrame, segments: DataFrame, checkpoint: DataFrame, ready: str = "READY_FOR_B10_LIVE") -> DataFrame:
    """J08. The operational rows of the matrix (source_id, logical_code, execution_state, expected_workflow), each with its log
    segment (source_id, actual_workflow, text, resource_count) and its checkpoint state (source_id, state): signals,
    classification, blocks, severity. A source without a segment is MISSING_LOG_SEGMENT, an error that blocks. A repeated segment
    or state fails the query."""
    seg = unique_rows(segments.select("source_id", "actual_workflow", "text", "resource_count"), "source_id").withColumn("__seg", F.lit(True))
    states = unique_rows(checkpoint.select("source_id", F.col("state").alias("checkpoint_state")), "source_id")
    rows = matrix.where(F.col("execution_state") == ready).select("source_id", "logical_code", "expected_workflow").join(seg, "source_id", "left").join(states, "source_id", "left")
    missing = F.col("__seg").isNull()
    rows = rows.withColumn("error_signals", F.when(missing, F.array(F.lit("MISSING_LOG_SEGMENT"))).otherwise(R.error_signals(F.coalesce("text", F.lit("")))))
    found = R.log_class(F.col("expected_workflow"), F.col("actual_workflow"), F.col("checkpoint_state"), F.size("error_signals"), F.col("resource_count"))
    lost = F.struct(F.lit("MISSING_LOG_SEGMENT").alias("classification"), F.lit(True).alias("blocks"), F.lit("ERROR").alias("severity"))
    return rows.withColumn("c", F.when(missing, lost).otherwise(found)).select("source_id", "logical_code", "expected_workflow", "actual_workflow", "checkpoint_state", "resource_count", "error_signals", "c.*")


def evidence_quality(resources: DataFrame, by: str = "source_id") -> DataFrame:
    """A30. Of each source's resources (url, extension, api), unique by URL: counts, and what its APIs and files are evidence of.
    APIs only of content systems or documentation are metadata; files rank data, documents, archives, then links."""
    one = resources.groupBy(by, "url").agg(F.max("extension").alias("extension"), F.bool_or("api").alias("api"))
    kind = R.api_url_class(F.col("url"))
    ext = lambda names: F.count_if(F.col("extension").isin(*names))
    q = one.groupBy(by).agg(
        F.count("*").alias("resource_count"), F.count_if("api").alias("api_resource_count"), F.count_if(F.col("api") & kind.isin(*CATALOG_APIS)).alias("catalog"), F.count_if(F.col("api") & (kind == "POSSIBLE_DATA_API")).alias("possible"),
        ext(DATA_FILES).alias("data_files"), ext(DOCUMENT_FILES).alias("document_files"), ext(ARCHIVE_FILES).alias("archive_files"),
    )
    api = F.when(F.col("api_resource_count") == 0, "NO_API_EVIDENCE").when(F.col("catalog") == F.col("api_resource_count"), "CMS_OR_METADATA_ONLY").when(F.col("possible") > 0, "DATA_API_EVIDENCE").otherwise("GENERIC_API_REVIEW")
    files = F.when(F.col("data_files") > 0, "STRUCTURED_FILE_EVIDENCE").when(F.col("document_files") > 0, "DOCUMENT_FILE_EVIDENCE").when(F.col("archive_files") > 0, "ARCHIVE_EVIDENCE").otherwise("LINK_OR_API_EVIDENCE")
    return q.select(by, "resource_count", "api_resource_count", "data_files", "document_files", "archive_files", api.alias("api_quality"), files.alias("file_quality"))
