"""File arrival as streams: each new file is read once, kept whole or left out whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarterdeck.operators import lineage as L
from quarterdeck.sources.records import audit_records, filing_records, whole_files


def _land(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return rows.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_filings(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the lines of new parsed-filing files to a table; variants are kept as JSON text.

    The checkpoint remembers files, so that a restart loads nothing twice. A filing that is written again comes in as
    another version, of which staging keeps the last.
    """
    rows = filing_records(whole_files(spark, path, stream=True))
    return _land(rows.withColumn("record", F.to_json("record")), out, checkpoint)


def ingest_audit(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """The same for audit records, one a file."""
    rows = audit_records(whole_files(spark, path, stream=True))
    return _land(rows.withColumn("record", F.to_json("record")), out, checkpoint)


def loaded_records(spark: SparkSession, out: str) -> DataFrame:
    """What a stream has appended, records as variants again."""
    return spark.read.parquet(out).withColumn("record", F.parse_json("record"))


def affected_lineages(new_filings: DataFrame) -> DataFrame:
    """The filers and periods that new filings touch."""
    return new_filings.select(*L.LINEAGE).distinct()


def recompute_lineages(touched: DataFrame, filings: DataFrame, holdings: DataFrame, before: DataFrame) -> DataFrame:
    """The lineage table after new filings: touched lineages anew, the others as they were.

    A lineage's roles depend on its own filings and holdings only, so that the result equals a full rebuild.
    """
    keys = list(L.LINEAGE)
    own = filings.join(touched, keys, "left_semi")
    held = holdings.join(own.select("accession_number"), "accession_number", "left_semi")
    fresh = L.lineage_filings(own, L.addition_coverage(own, held))
    return before.join(touched, keys, "left_anti").unionByName(fresh)
