"""Filings and holdings of both origins, value units, and canonical holdings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.columns import WIDE
from quarterdeck.functions.medians import medians
from quarterdeck.operators.lineage import LINEAGE

UNIT_RULE_DATE = "2023-01-03"
#: What makes a holding of an addition a copy of an earlier one, besides its lineage; managers compare in filed order.
COPY_KEY = ("cusip", "put_call", "shares_or_principal_amount", "shares_or_principal_amount_type", "investment_discretion")


def filings(submissions: DataFrame, covers: DataFrame, summaries: DataFrame, walk_covers: DataFrame) -> DataFrame:
    """Data-set filings (submission with its cover, and summary where there is one) and the walk's, tagged by origin.

    Provenance is the submission's.
    """
    source = ("source_file", "source_row", "source_content_key", "source_last_modified")
    joined = submissions.join(covers.drop(*source), "accession_number").join(summaries.drop(*source), "accession_number", "left").withColumn("origin", F.lit("data_set"))
    return joined.unionByName(walk_covers.withColumn("origin", F.lit("walk")), allowMissingColumns=True)


def value_per_share() -> Column:
    """A share row's value per share as filed, fixed-point with six decimals; null for other rows."""
    priced = (F.col("shares_or_principal_amount_type") == "SH") & (F.col("shares_or_principal_amount") > 0)
    return F.when(priced, F.col("value_as_filed").cast(WIDE) / F.col("shares_or_principal_amount").cast(WIDE)).cast("double")


def with_units(read: DataFrame) -> DataFrame:
    """Adds the units that the filing date and the median value per share say, and the multiplier."""
    by_date = F.when(F.col("filing_date") < F.lit(UNIT_RULE_DATE).cast("date"), "thousands").otherwise("dollars")
    m = F.col("median_value_per_share")
    unit = F.when(m.isNull(), F.col("filing_date_unit")).when(m < 1, "thousands").otherwise("dollars")
    return (
        read.withColumn("filing_date_unit", by_date)
        .withColumn("value_unit", unit)
        .withColumn("value_multiplier", F.when(F.col("value_unit") == "thousands", 1000).otherwise(1).cast("long"))
    )


def filing_value_units(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """Whether a filing's values are in dollars or thousands.

    By the median value per share as filed: below 1 it can only be thousands. Without a share row the filing date
    decides. Quotients are fixed-point with six decimals, so that a median of exactly 1 is exactly 1.
    """
    read = medians(holdings.select("accession_number", value_per_share().alias("price")), ("accession_number",), "price", "median_value_per_share")
    read = read.withColumn("median_value_per_share", F.round("median_value_per_share", 7))
    return with_units(read.join(filings.select("accession_number", "filing_date"), "accession_number"))


def holdings(as_filed: DataFrame, units: DataFrame) -> DataFrame:
    """Holdings with value_unit and value_usd. Both sides are keyed by accession, as units were made from holdings."""
    return with_value_usd(as_filed.join(units.select("accession_number", "value_unit", "value_multiplier"), "accession_number"))


def with_value_usd(rows: DataFrame) -> DataFrame:
    return rows.withColumn("value_usd", (F.col("value_as_filed") * F.col("value_multiplier")).cast("long")).drop("value_multiplier")


def managers_text() -> Column:
    """The managers of a holding in filed order, as one text."""
    return F.array_join("other_manager_sequence_numbers", ",")


def is_copied(*first: str, position: str = "filing_position") -> Column:
    """Whether an earlier filing of the lineage has the same holding; nulls are alike, one filing's rows never copy each other.

    Needs a column _managers, the text of the managers. ``first`` may name hashes of key columns, to sort by first.
    """
    same = Window.partitionBy(*first, *LINEAGE, *COPY_KEY, "_managers")
    return F.min(position).over(same) < F.col(position)


def canonical_holdings(holdings: DataFrame, lineage: DataFrame, filings: DataFrame) -> DataFrame:
    """The holdings in effect: those of contributing filings, without an addition's copies.

    Only lineages with a contributing addition can hold copies; the rest go past the window unsorted.
    """
    own = Window.partitionBy(*LINEAGE)
    counted = lineage.where("is_contributing").withColumn("has_addition", F.max(F.col("filing_role") == "addition").over(own))
    counted = counted.select("accession_number", *LINEAGE, "filing_position", "filing_role", "has_addition")
    counted = counted.join(filings.select("accession_number", "filing_date"), "accession_number")
    contributing = holdings.join(counted, "accession_number")
    plain = contributing.where("not has_addition").withColumn("is_copied", F.lit(False))
    checked = contributing.where("has_addition").withColumn("_managers", managers_text()).withColumn("_hash", F.xxhash64(*LINEAGE, *COPY_KEY, "_managers"))
    checked = checked.withColumn("is_copied", is_copied("_hash")).drop("_hash", "_managers")
    kept = plain.unionByName(checked).where("not (filing_role = 'addition' and is_copied)")
    return kept.drop("is_copied", "has_addition", "filing_position")
