"""Pipeline health: walk days and failures, row counts, backfill tables, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.operators.lineage import BASE_ROLES, LINEAGE

#: Hours after which a source is late: (warn, fail).
FRESHNESS = {"filings": (100, 124), "audit": (30, 54)}


def walk_days(days: DataFrame, filings: DataFrame) -> DataFrame:
    """The latest audit record of each day against the filings loaded for it."""
    own = Window.partitionBy("walk_day")
    latest = days.withColumns({"audit_records": F.count(F.lit(1)).over(own), "_n": F.row_number().over(own.orderBy(F.desc("recorded_at"), F.desc("source_file")))}).where("_n = 1")
    a = F.col("accession_number")
    loaded = filings.groupBy(F.col("filing_date").alias("walk_day")).agg(F.count_distinct(a).alias("loaded"), F.count_distinct(F.when(F.col("origin") == "data_set", a)).alias("loaded_from_data_sets"))
    n, sets = F.coalesce("loaded", F.lit(0)), F.coalesce("loaded_from_data_sets", F.lit(0))
    return latest.join(loaded, "walk_day", "left").select(
        "walk_day", "discovered", "holdings_reports", "holdings_report_amendments", "notices", "notice_amendments", n.alias("loaded"), sets.alias("loaded_from_data_sets"), (F.col("discovered") - n).alias("not_loaded"), "audit_records", "run_id", "recorded_at"
    )


def walk_failures(failures: DataFrame, loaded: DataFrame) -> DataFrame:
    """Each filing's failures by stage: attempts, the last error, and whether it has been loaded since."""
    last = F.col("recorded_at")
    at = lambda c, name: F.max_by(c, last).alias(name)
    per = failures.groupBy("accession_number", "failure_stage").agg(
        at("submission_type", "submission_type"), at("walk_day", "walk_day"), F.count(F.lit(1)).alias("failed_attempts"), F.min(last).alias("first_failed_at"), F.max(last).alias("last_failed_at"), at("error", "last_error"), at("run_id", "last_run_id")
    )
    there = loaded.select("accession_number").distinct().withColumn("_there", F.lit(True))
    return per.join(there, "accession_number", "left").withColumn("is_loaded", F.coalesce("_there", F.lit(False))).drop("_there")


def set_aside(filings: DataFrame, lineage: DataFrame) -> DataFrame:
    """Data-set filings that are superseded but would contribute if only data-set filings were there."""
    paths = lineage.join(filings.select("accession_number", "origin"), "accession_number").where("origin = 'data_set'")
    alone = F.max(F.when(F.col("filing_role").isin(*BASE_ROLES), F.col("filing_position"))).over(Window.partitionBy(*LINEAGE))
    at = F.col("filing_position")
    counts = (at == F.col("_alone")) | ((F.col("filing_role") == "addition") & F.coalesce(at > F.col("_alone"), F.lit(True)))
    return paths.withColumn("_alone", alone).where(F.col("is_superseded") & F.coalesce(counts, F.lit(False))).select("accession_number")


def row_counts(raw: DataFrame, filings: DataFrame, lineage: DataFrame, holdings: DataFrame, canonical: DataFrame) -> DataFrame:
    """Where each origin's raw rows went. ``raw`` has origin and raw_rows.

    Holdings are counted per filing first; the rest is joins of filings.
    """
    aside = set_aside(filings, lineage).withColumn("_aside", F.lit(True))
    per_filing = holdings.groupBy("origin", "accession_number").count()
    state = lineage.drop(*LINEAGE).join(aside, "accession_number", "left")
    n = F.col("count")
    total = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    held = per_filing.join(state, "accession_number", "left").groupBy("origin").agg(
        F.sum(n).alias("holdings"), total(F.col("is_superseded")).alias("superseded_holdings"), total(F.col("is_contributing")).alias("contributing_holdings"), total(F.col("filing_role") == "notice").alias("notice_holdings"), total(F.col("_aside")).alias("set_aside_by_walk")
    )
    kept = canonical.groupBy("origin").agg(F.count(F.lit(1)).alias("canonical_holdings"))
    filed = lineage.join(filings.select("accession_number", "origin"), "accession_number").groupBy("origin").agg(F.count(F.lit(1)).alias("filings"), F.count_if("is_superseded").alias("superseded_filings"))
    out = raw.join(held, "origin", "left").join(kept, "origin", "left").join(filed, "origin", "left")
    return out.select(
        "origin", "raw_rows", "holdings", "superseded_holdings", "contributing_holdings", "notice_holdings", "canonical_holdings", (F.col("contributing_holdings") - F.col("canonical_holdings")).alias("copied_holdings"),
        (F.col("holdings") - F.col("superseded_holdings") - F.col("contributing_holdings") - F.col("notice_holdings")).alias("unresolved_holdings"), "set_aside_by_walk", "filings", "superseded_filings",
    )


def backfill_tables(audit: DataFrame, raw_counts: DataFrame) -> DataFrame:
    """Each table's latest extracted rows, all rows and files loaded, and raw rows (table_name, raw_rows)."""
    loads = audit.groupBy("table_name").agg(
        F.max_by("extracted_rows", "recorded_at").alias("extracted_rows"), F.sum("rows_loaded").alias("rows_loaded"), F.sum("files_loaded").alias("files_loaded"), F.count(F.lit(1)).alias("backfill_runs")
    )
    return loads.join(raw_counts, "table_name", "left")


def pipeline_freshness(runs: DataFrame, records: DataFrame, filings: DataFrame) -> DataFrame:
    """One row: the last day walked, audit record, filing and file, and now."""
    a = runs.agg(F.max("walk_day").alias("last_walk_day"), F.max("recorded_at").alias("last_audit_recorded_at"))
    b = records.agg(F.max("filing_date").alias("last_filing_date_in_raw"), F.max("source_last_modified").alias("last_parsed_file_written_at"))
    c = filings.where("origin = 'walk'").agg(F.max("filing_date").alias("last_filing_date_in_core"))
    return a.crossJoin(b).crossJoin(c).withColumn("read_at", F.current_timestamp())


def source_freshness(loads: DataFrame, now: Column | None = None) -> DataFrame:
    """Each source's last load (source, loaded_at), its age in hours and state: pass, warn, error, or unknown for other sources."""
    spans = F.create_map(*[F.lit(x) for s, (w, e) in FRESHNESS.items() for x in (s, f"{w},{e}")])
    limit = lambda k: F.split(F.try_element_at(spans, F.col("source")), ",")[k].cast("int")
    last = loads.groupBy("source").agg(F.max("loaded_at").alias("loaded_at"))
    hours = (F.unix_timestamp(now if now is not None else F.current_timestamp()) - F.unix_timestamp("loaded_at")) / 3600
    state = F.when(limit(0).isNull(), "unknown").when(F.col("age_hours") > limit(1), "error").when(F.col("age_hours") > limit(0), "warn").otherwise("pass")
    return last.withColumn("age_hours", hours).withColumn("state", state)
