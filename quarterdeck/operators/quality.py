"""Sixteen data-quality checks. Each flags filings: check_name, cik, period_of_report, accession_number, origin, detail.

The names of checks and the wording of details are fixed values: readers of these tables match on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions.medians import in_middle, medians, with_places
from quarterdeck.operators.holdings import COPY_KEY, is_copied, managers_text
from quarterdeck.operators.lineage import LINEAGE, filing_order

COLUMNS = ("check_name", *LINEAGE, "accession_number", "origin", "detail")
#: Rows that a yardstick price needs, and the ratios beyond which a filing is off by a thousand.
YARDSTICK_ROWS, LOW, HIGH = 5, 0.01, 100.0


def filing_state(filings: DataFrame, lineage: DataFrame) -> DataFrame:
    """Filings with their place and role; most checks are filters over this."""
    return filings.join(lineage.drop(*LINEAGE), "accession_number")


def _flag(name: str, rows: DataFrame, detail: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("check_name"), *LINEAGE, "accession_number", "origin", detail.cast("string").alias("detail"))


def _say(template: str, *parts: Column | str) -> Column:
    """The template with its {} replaced by parts; a missing part makes the text missing, as || does."""
    texts = template.split("{}")
    out = [F.lit(texts[0])]
    for part, text in zip(parts, texts[1:]):
        out += [(F.col(part) if isinstance(part, str) else part).cast("string"), F.lit(text)]
    return F.concat(*out)


def _flags(rows: DataFrame, rules: list[tuple[str, Column, Column]]) -> DataFrame:
    """All rules (name, condition, detail) over one pass of the rows."""
    hits = F.array_compact(F.array(*[F.when(condition, F.struct(F.lit(name).alias("check_name"), detail.cast("string").alias("detail"))) for name, condition, detail in rules]))
    return rows.select(*LINEAGE, "accession_number", "origin", F.explode(hits).alias("_hit")).select("_hit.check_name", *LINEAGE, "accession_number", "origin", "_hit.detail")


def with_facts(state: DataFrame, holdings: DataFrame, coverage: DataFrame, units: DataFrame) -> DataFrame:
    """The state with each filing's holdings totals, unit reading and coverage, all keyed by accession."""
    totals = holdings.groupBy("accession_number").agg(F.count(F.lit(1)).alias("holdings_count"), F.sum("value_as_filed").alias("_value"))
    read = units.select("accession_number", "median_value_per_share", "value_unit", "filing_date_unit")
    covered = coverage.select("accession_number", "compared_accession_number", "compared_securities", "repeated_securities", "is_read_as_restatement")
    return state.join(totals, "accession_number", "left").join(read, "accession_number", "left").join(covered, "accession_number", "left")


def filing_checks(facts: DataFrame) -> DataFrame:
    """The checks of a filing by itself and its own facts, in one pass."""
    c = F.col
    box = F.when(c("cover_is_amendment"), "Y").when(~c("cover_is_amendment"), "N").otherwise("blank")
    n, v = F.coalesce("holdings_count", F.lit(0)), F.coalesce("_value", F.lit(0))
    off = ~c("table_entry_total").eqNullSafe(n) | ~c("table_value_total_as_filed").eqNullSafe(v)
    totals = F.when(c("table_entry_total").isNull(), _say("no summary page; the table holds {} holdings", n)).otherwise(
        _say("summary {} entries worth {} as filed; the table holds {} worth {}", "table_entry_total", "table_value_total_as_filed", n, v)
    )
    rules = [
        ("untyped_amendment", c("is_amendment") & c("amendment_type").isNull(), _say("{} names no amendment type on its cover; read as a restatement", "submission_type")),
        ("second_original", (c("submission_type") == "13F-HR") & (c("filing_role") == "restatement"), _say("13F-HR at position {} of its lineage; read as a restatement", "filing_position")),
        ("cover_box_disagrees_with_submission_type", F.coalesce("cover_is_amendment", F.lit(False)) != c("is_amendment"), _say("submission type {}, amendment box {}", "submission_type", box)),
        ("report_type_disagrees_with_submission_type", c("submission_type").startswith("13F-NT") != (c("report_type") == "13F NOTICE"), _say("submission type {}, report type {}", "submission_type", "report_type")),
        ("period_disagrees_with_cover", ~c("report_calendar_or_quarter").eqNullSafe(c("period_of_report")), _say("cover period {}", F.coalesce(c("report_calendar_or_quarter").cast("string"), F.lit("missing")))),
        ("summary_disagrees_with_holdings", (c("filing_role") != "notice") & off, totals),
        ("notice_with_holdings", (c("filing_role") == "notice") & c("holdings_count").isNotNull(), _say("a notice that lists {} holdings; they are left out of canonical holdings", "holdings_count")),
        ("addition_read_as_restatement", c("is_read_as_restatement"), _say("repeats {} of the {} securities of {}, the filing it amends; read as a restatement", "repeated_securities", "compared_securities", "compared_accession_number")),
        ("value_unit_overrides_filing_date_rule", c("value_unit") != c("filing_date_unit"), _say("median value per share as filed is {}; read as {} where the filing date says {}", F.round("median_value_per_share", 4), "value_unit", "filing_date_unit")),
    ]
    return _flags(facts, rules)


def order_checks(state: DataFrame) -> DataFrame:
    """The checks of a filing's place among the holdings filings of its lineage; all windows share one exchange."""
    c = F.col
    own, day = Window.partitionBy(*LINEAGE), Window.partitionBy(*LINEAGE, "filing_date")
    submitter = F.substring("accession_number", 1, 10)
    placed = state.where("filing_role <> 'notice'").withColumns({
        "_nth": F.row_number().over(own.orderBy(*filing_order())), "_by_number": F.row_number().over(own.orderBy("filing_date", "accession_number")),
        "_least": F.min(submitter).over(day), "_greatest": F.max(submitter).over(day),
    })
    number = F.coalesce(c("amendment_no").cast("string"), F.lit("none"))
    rules = [
        ("lineage_starts_with_amendment", (c("_nth") == 1) & (c("submission_type") == "13F-HR/A"), _say("the first holdings filing of the lineage is a {} filed as 13F-HR/A", "filing_role")),
        ("filings_of_one_date_across_submitters", c("_least") != c("_greatest"), _say("filed {} beside a filing from another submitter; accession order between them is arbitrary", "filing_date")),
        ("filing_order_set_by_amendment_number", c("_nth") != c("_by_number"), _say("amendment {} takes position {} among the filings of {}, against accession order", number, "filing_position", "filing_date")),
    ]
    return _flags(placed, rules)


def unrestated_addition(state: DataFrame, holdings: DataFrame) -> DataFrame:
    """Securities of a superseded addition that the effective filing lacks; a missing CUSIP counts as lacking.

    Both filings of each pair meet the holdings in one join, and their securities in one aggregation.
    """
    added = state.where("filing_role = 'addition' and is_superseded").select(*LINEAGE, "accession_number", "origin", F.col("effective_position").alias("_at"))
    effective = state.select(*LINEAGE, F.col("filing_position").alias("_at"), F.col("accession_number").alias("_effective"))
    pair = (*LINEAGE, "_added", "origin", "_effective")
    pairs = added.join(effective, [*LINEAGE, "_at"]).withColumnRenamed("accession_number", "_added").select(*pair)
    sides = F.array(F.struct(F.lit(0).alias("restates"), F.col("_added").alias("a")), F.struct(F.lit(1).alias("restates"), F.col("_effective").alias("a")))
    both = pairs.select(*pair, F.explode(sides).alias("_side")).select(*pair, "_side.restates", F.col("_side.a").alias("accession_number"))
    held = both.join(holdings.select("accession_number", "cusip"), "accession_number")
    per = held.groupBy(*pair, "cusip").agg(F.min("restates").alias("_least"), F.max("restates").alias("_most"))
    lacking = per.where((F.col("_least") == 0) & ((F.col("_most") == 0) | F.col("cusip").isNull()))
    rows = lacking.groupBy(*pair).count().withColumnRenamed("_added", "accession_number")
    return _flag("superseded_addition_not_restated", rows, _say("{} of the securities it added are not in {}, the restatement that supersedes it", "count", "_effective"))


def _with_additions(state: DataFrame) -> DataFrame:
    """Contributing filings of lineages with a contributing addition."""
    has = F.max((F.col("filing_role") == "addition") & F.col("is_contributing")).over(Window.partitionBy(*LINEAGE))
    return state.withColumn("_has", has).where("_has and is_contributing").select("accession_number", *LINEAGE, "origin", "filing_position", "filing_role")


def addition_checks(state: DataFrame, holdings: DataFrame) -> DataFrame:
    """Securities of additions that are in effect already, and holdings that copy earlier ones.

    By the least position of a security, or of a whole holding, in its lineage, instead of joins of filings with their
    earlier ones; both windows share the exchange over the security and one sort.
    """
    held = _with_additions(state).join(holdings.drop("origin").withColumn("_managers", managers_text()), "accession_number")
    held = held.repartition(*LINEAGE, "cusip").withColumn("_hash", F.xxhash64(*LINEAGE, "cusip")).sortWithinPartitions("_hash", *LINEAGE, *COPY_KEY, "_managers")
    earliest = F.min("filing_position").over(Window.partitionBy("_hash", *LINEAGE, "cusip"))
    repeats = (F.col("_first") < F.col("filing_position")) & F.col("cusip").isNotNull()
    per = held.withColumn("_first", earliest).withColumn("_copied", is_copied("_hash")).where("filing_role = 'addition'")
    per = per.groupBy(*LINEAGE, "accession_number", "origin").agg(F.count_distinct(F.when(repeats, F.col("cusip"))).alias("r"), F.count_if("_copied").alias("n"), F.count(F.lit(1)).alias("of"))
    rules = [
        ("repeated_security_in_addition", F.col("r") > 0, _say("{} of its securities are already in effect from an earlier filing", "r")),
        ("copied_holding_in_addition", F.col("n") > 0, _say("{} of its {} holdings copy holdings already in effect; they are left out of canonical holdings", "n", "of")),
    ]
    return _flags(per, rules)


def unit_overrides(units: DataFrame) -> DataFrame:
    """check_name and accession_number of filings whose values are read in another unit than the filing date says."""
    return units.where("value_unit <> filing_date_unit").select(F.lit("value_unit_overrides_filing_date_rule").alias("check_name"), "accession_number")


def priced(holdings: DataFrame, *more: str) -> DataFrame:
    """accession_number, the columns named, cusip and price of every holding of shares that is no option."""
    return holdings.where("shares_or_principal_amount_type = 'SH' and shares_or_principal_amount > 0 and put_call is null").select(
        "accession_number", *more, "cusip", (F.col("value_usd").cast("double") / F.col("shares_or_principal_amount")).alias("price")
    )


def prices(filings: DataFrame, holdings: DataFrame) -> DataFrame:
    """accession_number, cusip, price, period_of_report of every holding of shares that is no option."""
    return priced(holdings).join(filings.select("accession_number", "period_of_report"), "accession_number")


def ratios_off_yardstick(prices: DataFrame) -> DataFrame:
    """accession_number, period_of_report and ratio of filings whose prices are off the median price of the same security and period by a factor of about a thousand."""
    # Yardsticks and the ratios to them share one exchange and one sort.
    security = ("period_of_report", "cusip")
    placed = with_places(prices, security, "price")
    placed = placed.withColumn("yard", F.avg(F.when(in_middle("_place", "_n"), F.col("price"))).over(Window.partitionBy("_hash", *security)))
    against = placed.where((F.col("_n") >= YARDSTICK_ROWS) & (F.col("yard") > 0)).select("accession_number", "period_of_report", (F.col("price") / F.col("yard")).alias("against"))
    return medians(against, ("accession_number", "period_of_report"), "against", "ratio").where((F.col("ratio") < LOW) | (F.col("ratio") > HIGH))


def yardstick_flags(ratios: DataFrame) -> DataFrame:
    """check_name and accession_number of the filings that ``ratios_off_yardstick`` names."""
    return ratios.select(F.lit("value_off_yardstick_by_a_thousand").alias("check_name"), "accession_number")


def off_yardstick(state: DataFrame, ratios: DataFrame) -> DataFrame:
    """Filings whose prices are off the median price of the same security and period by a factor of about a thousand."""
    rows = state.join(ratios.drop("period_of_report"), "accession_number")
    return _flag("value_off_yardstick_by_a_thousand", rows, _say("median value per share is {} times the median across filers of the same security and period", F.round("ratio", 5)))


def data_quality_rows(state: DataFrame, holdings: DataFrame, coverage: DataFrame, units: DataFrame, ratios: DataFrame | None = None) -> DataFrame:
    """All checks. The inputs should be written tables, as several checks read them; ``ratios`` are those of ``ratios_off_yardstick``, where they are made already."""
    ratios = ratios_off_yardstick(prices(state, holdings)) if ratios is None else ratios
    facts = with_facts(state, holdings, coverage, units)
    parts = [filing_checks(facts), order_checks(state), unrestated_addition(state, holdings), addition_checks(state, holdings), off_yardstick(state, ratios)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_counts(rows: DataFrame) -> DataFrame:
    """Flagged filings and lineages of each check and origin."""
    return rows.groupBy("check_name", "origin").agg(F.count(F.lit(1)).alias("filings"), F.count_distinct(F.struct(*LINEAGE)).alias("lineages"))
