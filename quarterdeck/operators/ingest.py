"""What a daily walk has to do, as set operations, and the parse of landed filings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.operators.reconcile import reconcile_filing_totals
from quarterdeck.sources.filing_xml import cover_pages, table_holdings

SWEEP_DAYS = 7


def missing_days(published: DataFrame, landed: DataFrame, day: str, since: str) -> DataFrame:
    """Published days of the week before ``day`` (not before ``since``) whose index has not landed, and ``day`` itself; late ones too."""
    first = F.greatest(F.lit(since).cast("date"), F.date_sub(F.lit(day).cast("date"), SWEEP_DAYS))
    days = published.where((F.col("day") >= first) & (F.col("day") <= F.lit(day).cast("date")))
    return days.join(landed.select("day"), "day", "left_anti")


def filing_ingest_status(entries: DataFrame, documents: DataFrame, parsed: DataFrame) -> DataFrame:
    """Each index entry's status: parsed, to parse, or not landed.

    ``documents`` has accession_number and kind (cover or table) of what has landed. A filing has landed with its cover
    and, unless it is a notice, its table.
    """
    there = documents.groupBy("accession_number").agg(F.bool_or(F.col("kind") == "cover").alias("_cover"), F.bool_or(F.col("kind") == "table").alias("_table"))
    done = parsed.select("accession_number").distinct().withColumn("_parsed", F.lit(True))
    rows = entries.join(there, "accession_number", "left").join(done, "accession_number", "left")
    notice = F.col("form_type").startswith("13F-NT")
    landed = F.coalesce(F.col("_cover") & (notice | F.col("_table")), F.lit(False))
    return rows.select(*entries.columns, F.when(F.col("_parsed"), "parsed").when(landed, "to parse").otherwise("not landed").alias("status"))


def parse_filings(covers: DataFrame, tables: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """covers, holdings, failures and reconcile gaps of landed filings (accession_number, xml), all or nothing for each filing.

    A failure names the first bad row and its field. A summary that disagrees is a gap, not a failure.
    """
    pages, rows = cover_pages(covers), table_holdings(tables)
    bad_rows = rows.where("error is not null").groupBy("accession_number").agg(F.min("row_index").alias("_row"), F.min_by("error", "row_index").alias("_error"))
    bad_rows = bad_rows.select("accession_number", F.when(F.col("_row") == 0, F.col("_error")).otherwise(F.concat(F.lit("row "), F.col("_row").cast("string"), F.lit(": "), F.col("_error"))).alias("_table_error"))
    judged = pages.join(bad_rows, "accession_number", "left").withColumn("error", F.coalesce("error", "_table_error")).drop("_table_error")
    good, failed = judged.where("error is null").drop("error"), judged.where("error is not null").select("accession_number", F.col("submission_type").alias("form_type"), "error")
    holdings = rows.join(good.select("accession_number"), "accession_number", "left_semi").drop("error")
    totals = reconcile_filing_totals(good.withColumnRenamed("table_value_total", "table_value_total_as_filed"), holdings.withColumnRenamed("value", "value_as_filed"))
    return good, holdings, failed, totals.where("not matches")
