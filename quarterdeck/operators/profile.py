"""Profiles of data sets: counts, histograms, and lists of filings worth a look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import columns as C
from quarterdeck.plans.build import written


#: Ranges of values that the search for a median counts first.
RANGES = 256


def table_counts(rows: DataFrame) -> DataFrame:
    """Rows of each data set and table; ``rows`` has both as columns."""
    return rows.groupBy("dataset", "table").agg(F.count(F.lit(1)).alias("rows"))


def totals(counts: DataFrame, submissions: DataFrame, covers: DataFrame) -> DataFrame:
    """what, value, n over all data sets: rows by table (from ``table_counts``), filings by submission type, amendments by kind."""
    tables = counts.groupBy(F.col("table").alias("value")).agg(F.sum("rows").alias("n")).select(F.lit("table").alias("what"), "value", "n")
    kinds = histogram(covers.where("amendment_type is not null"), F.col("amendment_type"), "amendment type")
    return tables.unionByName(histogram(submissions, F.col("submission_type"), "submission type")).unionByName(kinds)


def samples(rows: DataFrame, order: str, keys: list[str], n: int = 3) -> DataFrame:
    """The first rows of each group; Spark cuts groups to the limit before it shuffles them."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return rows.withColumn("_n", place).where(F.col("_n") <= n).drop("_n")


def histogram(df: DataFrame, column: Column, what: str, *keys: str) -> DataFrame:
    """what, value, n: how often each value occurs; missing ones count as (blank)."""
    value = F.coalesce(column.cast("string"), F.lit("(blank)"))
    return df.groupBy(*keys, value.alias("value")).agg(F.count(F.lit(1)).alias("n")).select(*keys, F.lit(what).alias("what"), "value", "n")


def submission_profile(submissions: DataFrame) -> DataFrame:
    """Filings, filers, and the spans of filing dates and periods."""
    return submissions.agg(
        F.count(F.lit(1)).alias("filings"), F.count_distinct("cik").alias("filers"), F.min("filing_date").alias("first_filed"), F.max("filing_date").alias("last_filed"), F.min("period_of_report").alias("first_period"), F.max("period_of_report").alias("last_period")
    )


def cover_histograms(covers: DataFrame) -> DataFrame:
    box = F.when(F.col("cover_is_amendment"), "Y").when(~F.col("cover_is_amendment"), "N")
    parts = [histogram(covers, box, "amendment box"), histogram(covers, F.col("amendment_type"), "amendment type"), histogram(covers, F.col("report_type"), "report type")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def holdings_profile(raw: DataFrame) -> DataFrame:
    """Sum, least, upper median and greatest of the values as filed, the shares of small values and of rows with a FIGI, and bad values.

    ``raw`` has value and figi as text. The upper median is the value at index n // 2 of the sorted values, found from
    counts of distinct values rather than by sorting all rows in one task.
    """
    typed = raw.select(C.number("value", strict=False).cast("long").alias("v"), (C.text("value").isNotNull()).alias("given"), C.text("figi").isNotNull().alias("has_figi"))
    base = typed.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("v").alias("value_sum"), F.min("v").alias("value_min"), F.max("v").alias("value_max"), F.count_if(F.col("v").isNull()).alias("bad_values"),
        F.round(F.count_if(F.col("v") < 1000) / F.count("v"), 4).alias("share_below_1000"), F.round(F.count_if("has_figi") / F.count(F.lit(1)), 4).alias("figi_share"), F.count("v").alias("_n"),
    )
    # Two rounds: rows of each range of values first, then the distinct values of the one range that holds the median.
    cuts = typed.agg(F.percentile_approx("v", [k / RANGES for k in range(1, RANGES)], 10_000).alias("_cuts"))
    counts = typed.where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("c")).crossJoin(F.broadcast(cuts))
    counts = counts.select("v", "c", F.size(F.filter("_cuts", lambda x: x <= F.col("v"))).alias("_range"))
    ranges = counts.groupBy("_range").agg(F.sum("c").alias("_rows")).withColumn("_upto", F.sum("_rows").over(Window.orderBy("_range")))
    at = ranges.crossJoin(base.select(F.floor(F.col("_n") / 2).alias("_k"))).where("_upto > _k").agg(F.min_by(F.struct("_range", (F.col("_k") - F.col("_upto") + F.col("_rows")).alias("_k")), "_range").alias("_at")).select("_at.*")
    ranked = counts.join(F.broadcast(at), "_range").withColumn("upto", F.sum("c").over(Window.orderBy("v")))
    median = ranked.where("upto > _k").agg(F.min("v").alias("value_upper_median"))
    return base.drop("_n").crossJoin(median)


def holdings_profiles(raw: DataFrame, key: str = "dataset") -> DataFrame:
    """``holdings_profile`` of every data set at once, a row each; ``raw`` has the data set's name besides.

    Medians go by rounds of digits (``kth_values``): no task sorts a data set's values.
    """
    typed = raw.select(key, C.number("value", strict=False).cast("long").alias("v"), C.text("figi").isNotNull().alias("has_figi"))
    base = typed.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("v").alias("value_sum"), F.min("v").alias("value_min"), F.max("v").alias("value_max"), F.count_if(F.col("v").isNull()).alias("bad_values"),
        F.round(F.count_if(F.col("v") < 1000) / F.count("v"), 4).alias("share_below_1000"), F.round(F.count_if("has_figi") / F.count(F.lit(1)), 4).alias("figi_share"),
    )
    return base.join(kth_values(typed.select(key, "v"), key, "v", "value_upper_median"), key, "left")


def kth_values(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """key and the value at index n // 2 of each group's n sorted values (long); groups without values are left out.

    Exact, for all groups at once: four rounds count the values of each group by their next 16 bits and keep those that
    share the bits of the one looked for, so that a window has 65,536 rows a group at most.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    # Of the highest digit the sign turns, so that digits order as values do.
    digit = lambda k: F.shiftrightunsigned("_v", 48 - 16 * k).bitwiseAND(0xFFFF).bitwiseXOR(0x8000 if k == 0 else 0).cast("int")
    left = counts.groupBy(key).agg(F.floor(F.sum("_c") / 2).cast("long").alias("_k"))
    # Written, so that a round reads the counts and the last round's outcome instead of making them again.
    counts, found = written(counts, "counts"), []
    left = written(left, "places")
    for k in range(4):
        own = counts.join(left, key).withColumn("_digit", digit(k))
        for j in found:
            own = own.where(digit(j) == F.col(f"_d{j}"))
        upto = F.sum("_n").over(Window.partitionBy(key).orderBy("_digit"))
        bins = own.groupBy(*left.columns, "_digit").agg(F.sum("_c").alias("_n")).withColumn("_upto", upto)
        hit = bins.where((F.col("_upto") > F.col("_k")) & (F.col("_upto") - F.col("_n") <= F.col("_k")))
        left = written(hit.select(key, *(f"_d{j}" for j in found), F.col("_digit").alias(f"_d{k}"), (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_k")), "places")
        found.append(k)
    own = counts.join(left, key)
    for j in found:
        own = own.where(digit(j) == F.col(f"_d{j}"))
    return own.select(key, F.col("_v").alias(name))


def holdings_histograms(raw: DataFrame, key: str = "dataset") -> DataFrame:
    """key, what, value, n: the amount types and the sides (put or call) of each data set's holdings; missing ones count as (blank)."""
    kinds = histogram(raw, C.text("sshprnamttype"), "amount type", key)
    return kinds.unionByName(histogram(raw, C.text("putcall"), "put or call", key))


def filer_index(filings: DataFrame, entries: DataFrame) -> DataFrame:
    """For each filer and period its filings in order, with types and numbers of holdings (accession_number, entries)."""
    rows = filings.join(entries, "accession_number", "left")
    item = F.struct("filing_date", "accession_number", "submission_type", "amendment_type", F.coalesce("entries", F.lit(0)).alias("entries"))
    return rows.groupBy("cik", "period_of_report").agg(F.sort_array(F.collect_list(item)).alias("filings"))


def candidate_filers(filings: DataFrame, entries: DataFrame, top: int = 10, least: int = 50, most: int = 3_000) -> DataFrame:
    """Filers with the messiest histories of moderate size: cik, periods with amendments, restatements, additions, largest table, score."""
    rows = filings.where("submission_type like '13F-HR%'").join(entries, "accession_number", "left")
    per_period = rows.groupBy("cik", "period_of_report").agg(
        F.count(F.lit(1)).alias("reports"), F.count_if(F.col("amendment_type") == "RESTATEMENT").alias("restatements"), F.count_if(F.col("amendment_type") == "NEW HOLDINGS").alias("additions"), F.max(F.coalesce("entries", F.lit(0))).alias("largest")
    )
    per_filer = per_period.groupBy("cik").agg(
        F.count(F.lit(1)).alias("periods"), F.count_if(F.col("reports") >= 2).alias("messy"), F.sum("restatements").alias("restatements"), F.sum("additions").alias("additions"), F.max("largest").alias("largest")
    )
    both = (F.col("restatements") > 0) & (F.col("additions") > 0)
    scored = per_filer.where(F.col("largest").between(least, most)).withColumn("score", F.col("messy") * 10 + F.when(both, 5).otherwise(0))
    return scored.orderBy(F.desc("score"), F.desc("periods"), "cik").limit(top)
