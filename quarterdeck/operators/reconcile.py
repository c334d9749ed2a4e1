"""Reconciliation of what was expected with what was loaded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile_loads(expected: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose expected and loaded rows differ, either side possibly missing; both have the keys and ``rows``."""
    both = expected.withColumnRenamed("rows", "expected_rows").join(loaded.withColumnRenamed("rows", "loaded_rows"), keys, "full_outer")
    return both.where(~F.col("expected_rows").eqNullSafe(F.col("loaded_rows")))


def load_mismatches(extracted: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """The same for what this run has loaded only."""
    both = extracted.withColumnRenamed("rows", "extracted_rows").join(loaded.withColumnRenamed("rows", "loaded_rows"), keys)
    return both.where("extracted_rows <> loaded_rows")


def reconcile_filing_totals(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """Summary totals against each filing's holdings; matches is null without a summary page."""
    held = holdings.groupBy("accession_number").agg(F.count(F.lit(1)).alias("entries"), F.sum("value_as_filed").alias("value"))
    rows = filings.select("accession_number", "table_entry_total", "table_value_total_as_filed").join(held, "accession_number", "left")
    n, v = F.coalesce("entries", F.lit(0)), F.coalesce("value", F.lit(0)).cast("long")
    same = (F.col("table_entry_total") == n) & (F.col("table_value_total_as_filed") == v)
    return rows.select("accession_number", "table_entry_total", "table_value_total_as_filed", n.alias("entries"), v.alias("value"), F.when(F.col("table_entry_total").isNotNull() & F.col("table_value_total_as_filed").isNotNull(), same).alias("matches"))


def gaps(totals: DataFrame) -> DataFrame:
    """The filings whose summary disagrees; a gap is reported, never an error."""
    return totals.where("not matches")
