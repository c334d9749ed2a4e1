"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The same build then runs over $BENCH_COPIES copies of the input under other filers (0: not at all), for rates that the
fixed costs of a stage do not hide.
"""

from __future__ import annotations

import json
import os
import time

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators import dimensions, holdings, lineage, marts, quality
from quarterdeck.plans.build import BUCKETED, written
from quarterdeck.plans.shaped import shaped

#: Filers among which the orders are spread, so that lineages are of realistic depth.
FILERS = 1_000


def copied(df: DataFrame, copies: int) -> DataFrame:
    """Every row ``copies`` times, each copy with accession numbers, filers and order numbers of its own."""
    out = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn("k", F.col("k") * copies + F.col("_copy"))
    two = F.lpad(F.col("_copy").cast("string"), 2, "0")
    for name in ("accession_number", "cik"):
        if name in df.columns:
            out = out.withColumn(name, F.concat(two, F.substring(name, 3, 30)))
    return out.drop("_copy")


def timed_build(filings: DataFrame, as_filed: DataFrame) -> tuple[dict[str, float], dict[str, int]]:
    """Seconds and rows of each table, every one written to the shared folder."""
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def stage(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        began = time.time()
        out = written(make(), name, BUCKETED.get(name, ()))
        seconds[name] = round(time.time() - began, 3)
        rows[name] = out.count()
        return out

    units = stage("filing_value_units", lambda: holdings.filing_value_units(filings, as_filed))
    held = stage("holdings", lambda: holdings.holdings(as_filed, units))
    coverage = stage("addition_coverage", lambda: lineage.addition_coverage(filings, held))
    chain = stage("lineage_filings", lambda: lineage.lineage_filings(filings, coverage))
    canonical = stage("canonical_holdings", lambda: holdings.canonical_holdings(held, chain, filings))
    checks = stage("data_quality_rows", lambda: quality.data_quality_rows(written(quality.filing_state(filings, chain), "state", BUCKETED.get("state", ())), held, coverage, units))
    who, when = dimensions.filers(filings), dimensions.periods(chain)
    what = stage("securities", lambda: dimensions.securities(canonical))
    where = stage("positions", lambda: marts.positions(canonical))
    spans = stage("filer_periods", lambda: marts.filer_periods(where, when, who, chain, filings, checks))
    stage("position_changes", lambda: marts.position_changes(spans, where, what))
    stage("filer_overlaps", lambda: marts.filer_overlaps(spans, where))
    return seconds, rows


def main() -> None:
    sf_dir, cpus, copies = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_COPIES", "5"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stored(filings: DataFrame, as_filed: DataFrame) -> tuple[DataFrame, DataFrame, float]:
        """The inputs as stored, and the seconds that bucketing them takes once they are made."""
        plain = written(filings, "plain-filings"), written(as_filed, "plain-as-filed")
        began = time.time()
        return *(written(df, name, BUCKETED[name]) for df, name in zip(plain, ("filings", "as_filed"))), round(time.time() - began, 3)

    filings, as_filed, stored_in = stored(*shaped(spark, sf_dir, FILERS))
    written(as_filed.groupBy("cusip").count(), "warm-up")
    seconds, rows = timed_build(filings, as_filed)
    total = round(sum(seconds.values()), 3)
    result = {"metric": "full build of all tables", "value": total, "unit": "sec", "queries": seconds, "rows": rows, "inputs_bucketed_in": stored_in, "sf": sf_dir}
    if copies:
        more, more_as_filed, stored_in = stored(copied(filings, copies), copied(as_filed, copies))
        seconds, rows = timed_build(more, more_as_filed)
        read = more_as_filed.count()
        result["copied"] = {"copies": copies, "holdings_read": read, "inputs_bucketed_in": stored_in, "seconds": seconds, "total": round(sum(seconds.values()), 3), "rows": rows, "rows_per_sec": {k: round(n / seconds[k]) for k, n in rows.items()}}
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
