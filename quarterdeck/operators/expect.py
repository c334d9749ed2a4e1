"""Expectations on tables; each returns the rows that break it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.operators.lineage import BASE_ROLES, LINEAGE


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; nulls are alike."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(" or ".join(f"`{c}` is null" for c in columns))


def missing(*columns: str) -> str:
    """The rule of rows that lack one of these."""
    return " or ".join(f"`{c}` is null" for c in columns)


def not_among(column: str, *values: str) -> str:
    """The rule of rows with another value; a missing one passes."""
    texts = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return f"coalesce(`{column}` not in ({texts}), false)"


def broken_rows(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that break any rule, and in ``broken`` the names of those they break, in order; one pass for all rules."""
    hits = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn("broken", hits).where(F.size("broken") > 0)


def accepted_values(df: DataFrame, column: str, *values: str) -> DataFrame:
    """Rows with another value; a missing one passes."""
    return df.where(~F.col(column).isin(*values))


def relationship(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Rows whose value, unless missing, the other table lacks."""
    keys = to.select(F.col(field).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def covered_both_ways(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one of the tables has, and which."""
    only = lambda x, y, name: x.select(key).distinct().join(y.select(key).distinct(), key, "left_anti").withColumn("only_in", F.lit(name))
    return only(a, b, "left").unionByName(only(b, a, "right"))


def one_effective_filing(lineage: DataFrame) -> DataFrame:
    """Lineages with another number of effective filings than one, where any has a base role."""
    effective = F.count_if(F.col("filing_position") == F.col("effective_position"))
    base = F.count_if(F.col("filing_role").isin(*BASE_ROLES))
    return lineage.groupBy(*LINEAGE).agg(effective.alias("effective"), base.alias("base")).where("effective <> if(base > 0, 1, 0)")


def consistent_states(lineage: DataFrame) -> DataFrame:
    """Filings that are superseded and contribute, notices that do either, and filings that do neither without being notices."""
    return lineage.where("(is_superseded and is_contributing) or (filing_role = 'notice' and (is_superseded or is_contributing)) or (filing_role <> 'notice' and not is_superseded and not is_contributing)")


def symmetric_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows, with repeats, that only one side has, and which."""
    expected = expected.select(*actual.columns)
    return actual.exceptAll(expected).withColumn("only_in", F.lit("actual")).unionByName(expected.exceptAll(actual).withColumn("only_in", F.lit("expected")))


def balance(df: DataFrame, left: str, right: str) -> DataFrame:
    """Rows in which two expressions differ."""
    return df.where(~F.expr(left).eqNullSafe(F.expr(right)))


def untouched(rows: DataFrame, filings: DataFrame) -> DataFrame:
    """Rows of the lineages to which no filing of the walk belongs; counts pinned for the data sets alone are held against these."""
    walked = filings.where("origin = 'walk'").select(*LINEAGE).distinct()
    return rows.join(walked, list(LINEAGE), "left_anti")


def pinned_counts(counts: DataFrame, expected: dict[str, int], key: str = "check_name", value: str = "filings") -> DataFrame:
    """Keys whose count is not the pinned one; absent keys count 0."""
    spark = counts.sparkSession
    pinned = spark.createDataFrame(list(expected.items()), f"{key} string, expected long")
    got = counts.groupBy(key).agg(F.sum(value).alias("actual"))
    return pinned.join(got, key, "left").withColumn("actual", F.coalesce("actual", F.lit(0))).where("actual <> expected")
