"""JSON records: parsed filings as lines of many files, audit records as one file each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def whole_files(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """content and provenance of every file, a row each; as a stream, each file once, so many a batch at most."""
    reader = spark.readStream if stream else spark.read
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.text(path, wholetext=True)
    return files.select(
        F.col("value").alias("content"), F.col("_metadata.file_path").alias("source_file"), F.md5("value").alias("source_content_key"), F.col("_metadata.file_modification_time").alias("source_last_modified")
    )


def filing_records(files: DataFrame) -> DataFrame:
    """One row per line: record (variant), source_row and provenance. A file with a line that is no JSON is left out whole."""
    lines = F.filter(F.split("content", r"\r?\n"), lambda x: F.trim(x) != "")
    parsed = files.withColumn("_lines", lines).withColumn("_bad", F.exists("_lines", lambda x: F.try_parse_json(x).isNull()))
    rows = parsed.where("not _bad").select("source_file", "source_content_key", "source_last_modified", F.posexplode("_lines").alias("_at", "_line"))
    return rows.select(F.parse_json("_line").alias("record"), (F.col("_at") + 1).cast("long").alias("source_row"), "source_file", "source_content_key", "source_last_modified")


def rejected_files(files: DataFrame) -> DataFrame:
    """The files that ``filing_records`` leaves out, and how many of their lines are no JSON."""
    lines = F.filter(F.split("content", r"\r?\n"), lambda x: F.trim(x) != "")
    bad = F.size(F.filter(lines, lambda x: F.try_parse_json(x).isNull()))
    return files.select("source_file", bad.alias("bad_lines")).where("bad_lines > 0")


def audit_records(files: DataFrame) -> DataFrame:
    """One row per file whose content is a JSON object."""
    parsed = files.withColumn("record", F.try_parse_json("content"))
    return parsed.where("record is not null").select("record", "source_file", "source_content_key", "source_last_modified")


def read_filing_records(spark: SparkSession, path: str) -> DataFrame:
    return filing_records(whole_files(spark, path))


def read_audit_records(spark: SparkSession, path: str) -> DataFrame:
    return audit_records(whole_files(spark, path))
