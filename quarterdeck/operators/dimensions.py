"""Filers, periods and securities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import columns as C
from quarterdeck.functions import cusip as S

#: How a holding spells its security, by period.
SPELLING = ("cusip", "period_of_report", "name_of_issuer", "title_of_class", "figi")


def filers(filings: DataFrame) -> DataFrame:
    """One row per filer: the last name filed and the span of its periods, in one aggregate."""
    named = F.when(F.col("filing_manager_name").isNotNull(), F.struct("filing_date", "accession_number"))
    return filings.groupBy("cik").agg(
        F.max_by("filing_manager_name", named).alias("filer_name"), F.min("period_of_report").alias("first_period"), F.max("period_of_report").alias("last_period")
    )


def periods(lineage: DataFrame) -> DataFrame:
    """Every period named, its calendar quarter and, for a quarter end, the quarter end before."""
    p = F.col("period_of_report")
    return lineage.select("period_of_report").distinct().select(
        p, C.is_quarter_end(p).alias("is_quarter_end"), C.previous_quarter_end(p).alias("previous_period"), F.year(p).cast("long").alias("calendar_year"), F.quarter(p).cast("long").alias("calendar_quarter")
    )


def securities(canonical: DataFrame) -> DataFrame:
    """One row per CUSIP: its names in its last period, its identifier if there is one only, its form and check digit.

    Holdings are first counted by the few columns that matter, so that the rest works on one row per spelling.
    """
    return named_securities(canonical.groupBy(*SPELLING).count())


def named_securities(spelled: DataFrame) -> DataFrame:
    """The same from the counts of spellings."""
    span = spelled.groupBy("cusip").agg(F.min("period_of_report").alias("first_period"), F.max("period_of_report").alias("last_period"), F.count_distinct("figi").alias("figi_count"), F.min("figi").alias("any_figi"))
    last = spelled.join(span.select("cusip", F.col("last_period").alias("period_of_report")), ["cusip", "period_of_report"])
    last = last.select("cusip", "name_of_issuer", "title_of_class", F.col("count").alias("n"))

    def most(column: str) -> DataFrame:
        counted = last.where(F.col(column).isNotNull()).groupBy("cusip", column).agg(F.sum("n").alias("n"))
        rank = F.row_number().over(Window.partitionBy("cusip").orderBy(F.desc("n"), column))
        return counted.withColumn("rank", rank).where("rank = 1").select("cusip", column)

    c = F.col("cusip")
    return (
        span.join(most("name_of_issuer"), "cusip", "left")
        .join(most("title_of_class"), "cusip", "left")
        .select(
            c, "name_of_issuer", "title_of_class", F.when(F.col("figi_count") == 1, F.col("any_figi")).alias("figi"), F.col("figi_count").cast("long").alias("figi_count"),
            S.is_well_formed(c).alias("is_well_formed"), S.has_valid_check_digit(c).alias("has_valid_check_digit"), "first_period", "last_period",
        )
    )
