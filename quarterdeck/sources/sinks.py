"""Sinks: filings as JSON lines by filing date, and audit records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_name(column: Column, kind: T.DataType) -> Column:
    """The value with the fields of its structs in order of their names, at every depth."""
    if isinstance(kind, T.StructType):
        fields = [by_name(column[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: by_name(x, kind.elementType))
    return column


def filing_lines(covers: DataFrame, holdings: DataFrame, source_key: str = "") -> DataFrame:
    """accession, filed, ord, line: each filing's cover (ord 0), then its holdings in order; keys sorted at every depth, nulls left out.

    ``covers`` has filing_date and the fields of a cover record, ``holdings`` accession_number, row_index and the rest.
    """

    def lines(df: DataFrame, kind: str, order: Column, extra: list[str]) -> DataFrame:
        record = F.struct(*[by_name(F.col(c), df.schema[c].dataType).alias(c) for c in sorted(set(df.columns) - set(extra))])
        envelope = F.struct(F.col("accession_number").alias("accession"), record.alias("record"), F.lit(kind).alias("record_type"), F.lit(source_key).alias("source_key"))
        return df.select("accession_number", "filing_date", order.cast("long").alias("ord"), F.to_json(envelope).alias("line"))

    dated = holdings.join(covers.select("accession_number", "filing_date"), "accession_number")
    cover = lines(covers, "cover", F.lit(0), ["filing_date"])
    return cover.unionByName(lines(dated, "holding", F.col("row_index"), ["filing_date", "accession_number"]))


def write_filing_lines(lines: DataFrame, path: str, files_per_day: int = 1, compression: str = "none") -> None:
    """One folder ``filed=...`` a day; a filing's lines stay together and in order. Days are replaced whole, so a rerun repeats nothing."""
    spread = F.pmod(F.xxhash64("accession_number"), F.lit(files_per_day))
    ordered = lines.repartition("filing_date", spread).sortWithinPartitions("filing_date", "accession_number", "ord")
    ordered.select(F.col("filing_date").alias("filed"), F.col("line").alias("value")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("filed").text(path, compression=compression)


def walk_audit(days: DataFrame, landed: DataFrame, failures: DataFrame) -> DataFrame:
    """One JSON audit record per run and day.

    ``days``: run_id, recorded_at, walk_day, form_type, discovered. ``landed``: run_id, walk_day, landed, already_present, parsed.
    ``failures``: run_id, walk_day, stage, accession, form_type, error.
    """
    key = ["run_id", "walk_day"]
    found = days.groupBy(*key).agg(F.max("recorded_at").alias("recorded_at"), F.sum("discovered").alias("discovered"), F.map_from_entries(F.collect_list(F.struct("form_type", "discovered"))).alias("by_form"))
    failed = failures.groupBy(*key).agg(*[F.collect_list(F.when(F.col("stage") == s, F.struct("accession", "form_type", "error"))).alias(n) for s, n in (("land", "failed"), ("parse", "parse_failed"))])
    none = F.from_json(F.lit("[]"), "array<struct<accession: string, form_type: string, error: string>>")
    day = F.date_format("walk_day", "yyyy-MM-dd")
    rows = found.join(landed, key, "left").join(failed, key, "left").withColumn("key", F.concat(F.lit("index/"), day))
    record = F.struct(
        "already_present", day.alias("day"), F.create_map(day, F.struct("by_form", "discovered", "key")).alias("days"), "discovered", F.coalesce("failed", none).alias("failed"), "landed",
        F.coalesce("parse_failed", none).alias("parse_failed"), "parsed", F.lit(True).alias("published"), F.date_format("recorded_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("recorded_at"), "run_id",
    )
    return rows.select(*key, F.to_json(record).alias("value"))


def backfill_audit(extracted: DataFrame, loaded: DataFrame, run_id: str, recorded_at: str) -> DataFrame:
    """The JSON audit record of a backfill: rows extracted, rows and files loaded by table, and what disagrees.

    ``extracted``: table, dataset, rows. ``loaded``: table, dataset, rows (a file each). The tables are seven, so that the
    record is one row of bounded size but for its mismatches, which are as many as went wrong.
    """
    both = extracted.withColumnRenamed("rows", "extracted").join(loaded.withColumnRenamed("rows", "loaded"), ["table", "dataset"], "full_outer")
    per_table = both.groupBy("table").agg(F.sum("extracted").alias("e"), F.coalesce(F.sum("loaded"), F.lit(0)).alias("l"), F.count("loaded").alias("f"))
    wrong = both.where("extracted is distinct from loaded and loaded is not null").agg(F.collect_list(F.struct("dataset", "extracted", "loaded", "table")).alias("mismatches"))
    missing = both.where("loaded is null").agg(F.collect_list(F.struct("dataset", "table")).alias("not_loaded"))
    as_map = lambda c: F.map_from_entries(F.collect_list(F.struct("table", c)))
    totals = per_table.agg(as_map("e").alias("extracted_rows"), as_map("f").alias("files_loaded"), as_map("l").alias("rows_loaded"))
    record = F.struct("extracted_rows", "files_loaded", "mismatches", "not_loaded", F.lit(recorded_at).alias("recorded_at"), "rows_loaded", F.lit(run_id).alias("run_id"))
    return totals.crossJoin(wrong).crossJoin(missing).select(F.to_json(record).alias("value"))
