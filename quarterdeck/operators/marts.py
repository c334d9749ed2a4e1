"""Positions, filer periods, position changes and portfolio overlap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION = ("cik", "period_of_report", "cusip", "put_call")
TOP_FILERS, TOP_POSITIONS = 100, 10


def positions(canonical: DataFrame) -> DataFrame:
    """One row per filer, period, security and side; an amount only where all rows have one amount type.

    Whether types agree is read off their minimum, maximum and count, so that only filings are counted distinct. Holdings go to
    their filer's period at once: that one exchange serves the count of filings, the sums, and storage by filer and period.
    """
    kind = F.col("shares_or_principal_amount_type")
    alike = (F.min(kind) == F.max(kind)) & (F.count(kind) == F.count(F.lit(1)))
    needed = canonical.select(*POSITION, "accession_number", "value_usd", "shares_or_principal_amount_type", "shares_or_principal_amount")
    return needed.repartition(*POSITION[:2]).groupBy(*POSITION).agg(
        F.count(F.lit(1)).alias("holding_count"), F.count_distinct("accession_number").alias("filing_count"), F.sum("value_usd").alias("value_usd"),
        F.when(alike, F.min(kind)).alias("shares_or_principal_amount_type"), F.when(alike, F.sum("shares_or_principal_amount")).alias("shares_or_principal_amount"),
    ).withColumn("is_option", F.col("put_call").isNotNull())


def portfolios(positions: DataFrame, top: int = TOP_POSITIONS) -> DataFrame:
    """Counts and values of a filer's period, the share of its largest positions, and its concentration.

    Rank, total and weight are windows of one exchange over (cik, period); the weights' squares are summed in double.
    """
    period = ("cik", "period_of_report")
    plain, v = ~F.col("is_option"), F.col("value_usd")
    rank = F.row_number().over(Window.partitionBy(*period, "is_option").orderBy(F.desc("value_usd"), "cusip"))
    total = F.sum(F.when(plain, v)).over(Window.partitionBy(*period))
    weight = F.when(plain & (F.col("_total") > 0), v.cast("double") / F.col("_total").cast("double"))
    return (
        positions.withColumn("_total", total)
        .withColumn("_rank", rank)
        .withColumn("_weight", weight)
        .groupBy(*period)
        .agg(
            F.count_if(plain).alias("position_count"), F.count_if(~plain).alias("option_position_count"), F.coalesce(F.sum(F.when(plain, v)), F.lit(0)).alias("value_usd"), F.coalesce(F.sum(F.when(~plain, v)), F.lit(0)).alias("option_value_usd"),
            F.sum(F.when(plain & (F.col("_rank") <= top), v)).alias("_top"), F.sum(F.col("_weight") * F.col("_weight")).alias("hhi"),
        )
        .withColumn("top_ten_share", F.when(F.col("value_usd") > 0, F.col("_top").cast("double") / F.col("value_usd").cast("double")))
        .drop("_top")
    )


def confidential_omission(contributing: DataFrame) -> Column:
    """True if any filing omits holdings, false if all say they don't, else unknown."""
    c = F.col("is_confidential_omitted")
    return F.when(F.count_if(c) > 0, True).when(F.count_if(~c) == F.count(F.lit(1)), False)


def filer_periods(positions: DataFrame, periods: DataFrame, filers: DataFrame, lineage: DataFrame, filings: DataFrame, quality: DataFrame) -> DataFrame:
    """One row per filer and period with holdings: its portfolio, what it compares with, and its flags."""
    period = ["cik", "period_of_report"]
    own = portfolios(positions)
    quality = quality.where(F.col("check_name").isin("value_unit_overrides_filing_date_rule", "value_off_yardstick_by_a_thousand"))
    flags = quality.groupBy("accession_number").agg(
        F.bool_or(F.col("check_name") == "value_unit_overrides_filing_date_rule").alias("_unit"), F.bool_or(F.col("check_name") == "value_off_yardstick_by_a_thousand").alias("_yardstick")
    )
    facts = lineage.join(filings.select("accession_number", "is_confidential_omitted"), "accession_number", "left").join(flags, "accession_number", "left")
    counts = F.col("is_contributing")
    omitted = F.when(counts, F.col("is_confidential_omitted"))
    per_lineage = facts.groupBy(*period).agg(
        F.count_if(F.col("filing_role") != "notice").alias("_reports"),
        F.when(F.count_if(counts) > 0, F.when(F.count_if(omitted) > 0, True).when(F.count_if(~omitted) == F.count_if(counts), False)).alias("confidential_omission"),
        F.coalesce(F.bool_or(counts & F.col("_unit")), F.lit(False)).alias("has_value_unit_override"), F.coalesce(F.bool_or(counts & F.col("_yardstick")), F.lit(False)).alias("has_value_off_yardstick"),
    )
    before = per_lineage.select("cik", F.col("period_of_report").alias("previous_period"), F.col("_reports").alias("_before_reports"), F.lit(True).alias("_before"))
    before_held = own.select("cik", F.col("period_of_report").alias("previous_period"), F.lit(True).alias("_before_held"))
    basis = (
        F.when(F.col("_before_held"), "previous period")
        .when(F.col("_before_reports") > 0, "previous report lists none")
        .when(F.col("_before"), "previous notice only")
        .otherwise("no previous filing")
    )
    return (
        own.join(periods.select("period_of_report", "previous_period"), "period_of_report", "left")
        .join(filers.select("cik", "filer_name"), "cik", "left")
        .join(per_lineage.drop("_reports"), period, "left")
        .join(before_held, ["cik", "previous_period"], "left")
        .join(before, ["cik", "previous_period"], "left")
        .select(
            "cik", "filer_name", "period_of_report", "previous_period", basis.alias("comparison_basis"), "position_count", "option_position_count", "value_usd", "option_value_usd", "top_ten_share", "hhi",
            "confidential_omission", F.coalesce("has_value_unit_override", F.lit(False)).alias("has_value_unit_override"), F.coalesce("has_value_off_yardstick", F.lit(False)).alias("has_value_off_yardstick"),
        )
    )


def position_changes(filer_periods: DataFrame, positions: DataFrame, securities: DataFrame) -> DataFrame:
    """Each comparable filer's positions against its previous period's, with the names of securities."""
    return with_names(unnamed_changes(filer_periods, positions), securities)


def with_names(changes: DataFrame, securities: DataFrame) -> DataFrame:
    """Changes with name_of_issuer and title_of_class behind the security."""
    at = changes.columns.index("cusip") + 1
    named = changes.join(securities.select("cusip", "name_of_issuer", "title_of_class"), "cusip", "left")
    return named.select(*changes.columns[:at], "name_of_issuer", "title_of_class", *changes.columns[at:])


def unnamed_changes(filer_periods: DataFrame, positions: DataFrame) -> DataFrame:
    """The changes of a filer's positions: entry, exit, increase, decrease, unchanged or not comparable; they need that filer's rows only.

    A null-safe full outer join on the security and side; each side is first limited to periods that compare.
    """
    compared = filer_periods.where("comparison_basis = 'previous period'").select("cik", "filer_name", "period_of_report", "previous_period")
    kept = ("shares_or_principal_amount_type", "shares_or_principal_amount", "value_usd")
    now = positions.select(*POSITION, *kept).join(compared, ["cik", "period_of_report"])
    then = positions.select("cik", F.col("period_of_report").alias("previous_period"), "cusip", "put_call", *kept).join(compared, ["cik", "previous_period"])
    a, b = now.alias("a"), then.alias("b")
    same = (F.col("a.cik") == F.col("b.cik")) & (F.col("a.period_of_report") == F.col("b.period_of_report")) & F.col("a.cusip").eqNullSafe(F.col("b.cusip")) & F.col("a.put_call").eqNullSafe(F.col("b.put_call"))
    either = lambda c: F.coalesce(f"a.{c}", f"b.{c}").alias(c)
    paired = a.join(b, same, "full_outer").select(
        *[either(c) for c in ("cik", "filer_name", "period_of_report", "previous_period", "cusip", "put_call")], F.col("a.cik").isNotNull().alias("_held"), F.col("b.cik").isNotNull().alias("_was_held"),
        *[F.col(f"a.{c}").alias(c) for c in kept], *[F.col(f"b.{c}").alias(f"previous_{c}") for c in kept],
    )
    amount, previous = F.col("shares_or_principal_amount"), F.col("previous_shares_or_principal_amount")
    comparable = F.coalesce(F.col("_held") & F.col("_was_held") & (F.col("shares_or_principal_amount_type") == F.col("previous_shares_or_principal_amount_type")) & amount.isNotNull() & previous.isNotNull(), F.lit(False))
    kind = (
        F.when(~F.col("_was_held"), "entry").when(~F.col("_held"), "exit").when(~comparable, "not comparable").when(amount > previous, "increase").when(amount < previous, "decrease").otherwise("unchanged")
    )
    return paired.select(
        "cik", "filer_name", "period_of_report", "previous_period", "cusip", "put_call", F.col("put_call").isNotNull().alias("is_option"), kind.alias("change_kind"),
        "shares_or_principal_amount_type", "shares_or_principal_amount", "previous_shares_or_principal_amount_type", "previous_shares_or_principal_amount",
        F.when(comparable, amount - previous).alias("amount_change"), "value_usd", "previous_value_usd",
    )


def filer_overlaps(filer_periods: DataFrame, positions: DataFrame, top_n: int = TOP_FILERS) -> DataFrame:
    """For each pair of a period's largest filers the securities that both hold and the weight that they share.

    Filers are cut to the largest before any pair is made, so that pairs stay below top_n squared a period.
    """
    rank = F.row_number().over(Window.partitionBy("period_of_report").orderBy(F.desc("value_usd"), "cik"))
    ranked = filer_periods.where("value_usd > 0").withColumn("_rank", rank).where(F.col("_rank") <= top_n)
    ranked = ranked.select("cik", "filer_name", "period_of_report", F.col("value_usd").alias("_total"))
    held = positions.where("not is_option").join(ranked, ["cik", "period_of_report"])
    held = held.select("cik", "period_of_report", "cusip", (F.col("value_usd").cast("double") / F.col("_total").cast("double")).alias("weight"))
    later = held.select(F.col("cik").alias("other_cik"), "period_of_report", "cusip", F.col("weight").alias("_other"))
    shared = (
        held.join(later, ["period_of_report", "cusip"])
        .where("other_cik > cik")
        .groupBy("period_of_report", "cik", "other_cik")
        .agg(F.count(F.lit(1)).alias("shared_securities"), F.sum(F.least("weight", "_other")).alias("weight_overlap"))
    )
    other = ranked.select("period_of_report", F.col("cik").alias("other_cik"), F.col("filer_name").alias("other_filer_name"))
    pairs = ranked.select("period_of_report", "cik", "filer_name").join(other, "period_of_report").where("other_cik > cik")
    return pairs.join(shared, ["period_of_report", "cik", "other_cik"], "left").select(
        "period_of_report", "cik", "filer_name", "other_cik", "other_filer_name", F.coalesce("shared_securities", F.lit(0)).cast("long").alias("shared_securities"), F.coalesce("weight_overlap", F.lit(0.0)).alias("weight_overlap")
    )
