"""Lineages: the filings of one filer and period in filing order, their roles, and which of them count.

All windows are over (cik, period_of_report), so that position, role and effect share one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LINEAGE = ("cik", "period_of_report")
BASE_ROLES = ("original", "restatement")


def filing_order() -> list[Column]:
    """Filing date, then amendment number with originals first, then accession number."""
    return [F.col("filing_date"), F.col("amendment_no").asc_nulls_first(), F.col("accession_number")]


def with_position(filings: DataFrame) -> DataFrame:
    """Adds filing_position, 1-based, in each lineage."""
    return filings.withColumn("filing_position", F.row_number().over(Window.partitionBy(*LINEAGE).orderBy(*filing_order())).cast("long"))


def with_typed_role(positioned: DataFrame) -> DataFrame:
    """Adds typed_role as types say it: notice, original (the first 13F-HR), restatement or addition."""
    is_report = F.col("submission_type") == "13F-HR"
    first = F.min(F.when(is_report, F.col("filing_position"))).over(Window.partitionBy(*LINEAGE))
    role = (
        F.when(F.col("submission_type").startswith("13F-NT"), "notice")
        .when(is_report & (F.col("filing_position") == first), "original")
        .when(~is_report & F.coalesce(F.col("amendment_type") == "NEW HOLDINGS", F.lit(False)), "addition")
        .otherwise("restatement")
    )
    return positioned.withColumn("typed_role", role)


def addition_coverage(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """For each addition: the filing it is compared with and how many of that filing's securities it repeats.

    The compared filing is the latest earlier original or restatement, found by one running window rather than a join on
    ``<``. An addition that repeats nine tenths or more of it is read as a restatement.
    """
    typed = with_typed_role(with_position(filings))
    earlier = Window.partitionBy(*LINEAGE).orderBy("filing_position").rowsBetween(Window.unboundedPreceding, -1)
    base = F.last(F.when(F.col("typed_role").isin(*BASE_ROLES), F.col("accession_number")), ignorenulls=True).over(earlier)
    pairs = typed.withColumn("compared_accession_number", base).where("typed_role = 'addition'").select("accession_number", *LINEAGE, "compared_accession_number")
    # Only the holdings of filings in a pair are made distinct: both sides of each pair, keyed by the addition.
    sides = pairs.select(F.col("accession_number").alias("addition"), F.explode(F.array(F.struct(F.lit(0).alias("is_base"), F.col("accession_number").alias("a")), F.struct(F.lit(1).alias("is_base"), F.col("compared_accession_number").alias("a")))).alias("s"))
    sides = sides.select("addition", "s.is_base", F.col("s.a").alias("accession_number")).where("accession_number is not null")
    cusips = holdings.where("cusip is not null").select("accession_number", "cusip")
    per_cusip = sides.join(cusips, "accession_number").groupBy("addition", "cusip").agg(F.max("is_base").alias("in_base"), F.min("is_base").alias("only_base"))
    counts = per_cusip.groupBy(F.col("addition").alias("accession_number")).agg(F.sum("in_base").alias("b"), F.sum(F.when((F.col("in_base") == 1) & (F.col("only_base") == 0), 1).otherwise(0)).alias("r"))
    has_base = F.col("compared_accession_number").isNotNull()
    counted = pairs.join(counts, "accession_number", "left").select(
        *pairs.columns, F.when(has_base, F.coalesce("b", F.lit(0)).cast("long")).alias("compared_securities"), F.when(has_base, F.coalesce("r", F.lit(0)).cast("long")).alias("repeated_securities")
    )
    c, r = F.col("compared_securities"), F.col("repeated_securities")
    return counted.select("*", F.when(c > 0, r / c).alias("coverage"), F.coalesce((c > 0) & (r * 10 >= c * 9), F.lit(False)).alias("is_read_as_restatement"))


def lineage_filings(filings: DataFrame, coverage: DataFrame) -> DataFrame:
    """Each filing's position and role, the effective position of its lineage, and whether it is superseded or contributes."""
    typed = with_typed_role(with_position(filings))
    read_as = coverage.where("is_read_as_restatement").select("accession_number", F.lit(True).alias("_restates"))
    role = F.when((F.col("typed_role") == "addition") & F.col("_restates").isNotNull(), "restatement").otherwise(F.col("typed_role"))
    roled = typed.join(read_as, "accession_number", "left").withColumn("filing_role", role)
    effective = F.max(F.when(F.col("filing_role").isin(*BASE_ROLES), F.col("filing_position"))).over(Window.partitionBy(*LINEAGE))
    at, top = F.col("filing_position"), F.col("effective_position")
    superseded = (F.col("filing_role") != "notice") & F.coalesce(at < top, F.lit(False))
    contributing = at.eqNullSafe(top) | ((F.col("filing_role") == "addition") & F.coalesce(at > top, F.lit(True)))
    return roled.withColumn("effective_position", effective).select(
        "accession_number", *LINEAGE, "filing_position", "filing_role", "effective_position", superseded.alias("is_superseded"), contributing.alias("is_contributing")
    )
