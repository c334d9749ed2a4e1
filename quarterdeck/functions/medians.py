"""Exact medians by rank: rows are sorted, and spilled, by Spark; no buffer holds all values of a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def in_middle(place: str, n: str) -> Column:
    """Whether a 1-based place is the middle one, or one of the middle two, of n."""
    return F.abs(2 * F.col(place) - F.col(n) - 1) <= 1


def with_places(rows: DataFrame, keys: tuple[str, ...], value: str, place: str = "_place", n: str = "_n") -> DataFrame:
    """Adds each row's place by value in its group, nulls last, the group's count of values, and _hash, the hash of the keys.

    One exchange, by the keys, and one sort. That goes by the hash first: eight bytes that tell groups apart, as the first
    bytes of keys padded with zeros do not.
    """
    own = Window.partitionBy("_hash", *keys)
    rows = rows.repartition(*keys).withColumn("_hash", F.xxhash64(*keys))
    return rows.withColumn(place, F.row_number().over(own.orderBy(F.col(value).asc_nulls_last()))).withColumn(n, F.count(value).over(own))


def with_median(rows: DataFrame, dealt: tuple[str, ...], keys: tuple[str, ...], value: str, name: str) -> DataFrame:
    """Adds the median of a double by ``dealt`` and the keys, null in a group without values. Rows that are dealt by ``dealt`` are not exchanged; they end in its order."""
    own = Window.partitionBy(*dealt, "_hash", *keys)
    rows = rows.withColumn("_hash", F.xxhash64(*keys))
    placed = rows.withColumn("_place", F.row_number().over(own.orderBy(F.col(value).asc_nulls_last()))).withColumn("_n", F.count(value).over(own))
    middle = F.when((F.col("_n") > 0) & in_middle("_place", "_n"), F.col(value))
    return placed.withColumn(name, F.avg(middle).over(own)).drop("_hash", "_place", "_n")


def medians(rows: DataFrame, keys: tuple[str, ...], value: str, name: str) -> DataFrame:
    """The median of a double by keys; null for a group without values."""
    placed = with_places(rows.select(*keys, value), keys, value)
    middle = placed.where((F.col("_n") > 0) & in_middle("_place", "_n") | (F.col("_n") == 0) & (F.col("_place") == 1))
    return middle.groupBy(*keys).agg(F.avg(value).alias(name))
