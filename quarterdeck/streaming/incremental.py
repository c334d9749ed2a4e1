"""The build kept up to date batch by batch: lineages, canonical holdings and marts of touched filers' years anew, the others as they are.

Inputs are kept as they came, a folder a batch, so that a batch that is written again replaces itself. Holdings are stored this
once only, with the unit that their filing's lines tell; those of each filing's last version count. Tables that depend on a
filer's own filings are partitioned by a bucket of filers and the year of the period; the parts that a batch touches are made
anew from the inputs, never from what they held before, and replace their partitions. So a replayed batch, or one that failed
halfway, leaves the tables of a full build. A period compares with the one before, so that filer periods and their changes are
also made anew for the year that follows a touched one. Shuffle files go with each write. Four things reach further: the versions of a filing, of which those that
came more than once are noted; the last name of a filer, which is kept by part; yardstick prices, which are read from the holdings of
the touched periods only; and the names of securities, which come from counts of their spellings kept by part.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarterdeck.functions.medians import with_median
from quarterdeck.operators import dimensions, holdings as H, lineage as L, marts, quality, staging
from quarterdeck.plans.build import dropping_shuffles
from quarterdeck.sources.records import filing_records, whole_files

BUCKETS = 256
FILING_TYPES = {
    "accession_number": "string", "cik": "string", "period_of_report": "date", "filing_date": "date", "submission_type": "string", "is_amendment": "boolean", "cover_is_amendment": "boolean", "amendment_type": "string",
    "amendment_no": "bigint", "report_type": "string", "report_calendar_or_quarter": "date", "filing_manager_name": "string", "is_confidential_omitted": "boolean", "origin": "string", "table_entry_total": "bigint",
    "table_value_total_as_filed": "bigint", "source_last_modified": "timestamp", "source_content_key": "string",
}
HOLDING_TYPES = {
    "accession_number": "string", "origin": "string", "holding_key": "bigint", "name_of_issuer": "string", "title_of_class": "string", "cusip": "string", "figi": "string", "put_call": "string",
    "shares_or_principal_amount": "bigint", "shares_or_principal_amount_type": "string", "investment_discretion": "string", "value_as_filed": "bigint", "other_manager_sequence_numbers": "array<bigint>",
    "voting_sole": "bigint", "voting_shared": "bigint", "voting_none": "bigint",
}
#: Stored holdings also have their filing's period, so that prices need no join, and what their unit follows from.
HELD_TYPES = HOLDING_TYPES | {"period_of_report": "date", "median_value_per_share": "double", "value_unit": "string", "value_usd": "bigint"}
#: What holdings take from their filing; those that come with it are not joined to find it.
OF_FILING = ("cik", "period_of_report", "filing_date")
#: Slices of a part, by accession number, and rows up to which accession numbers are broadcast.
SLICES, FEW = 16, 100_000
#: What the parts of the tables are told by: a bucket of filers, and the year of the period (0 if it is missing).
PART = ("bucket", "year")
VERSION = ("accession_number", "batch", *PART)
#: Tables that readers see, by part.
TABLES = ("filing_value_units", "addition_coverage", "lineage_filings", "canonical_holdings", "positions", "filer_periods", "position_changes")


@dataclass
class Current:
    """The tables as the batches so far have left them."""

    filing_value_units: DataFrame
    holdings: DataFrame
    addition_coverage: DataFrame
    lineage_filings: DataFrame
    canonical_holdings: DataFrame
    securities: DataFrame
    positions: DataFrame
    filer_periods: DataFrame
    position_changes: DataFrame


def _typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The columns of these names, missing ones null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()])


def bucket_of(cik: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(cik), F.lit(buckets)).cast("int")


def _in_parts(df: DataFrame, buckets: int) -> DataFrame:
    """``df``, which has filers and periods, with the part that each row is in."""
    return df.withColumns({"bucket": bucket_of("cik", buckets), "year": F.coalesce(F.year("period_of_report"), F.lit(0))})


def _among(parts: set[tuple[int, int]]) -> Column:
    """Whether a row's part is one of these; Spark reads the folders of these only."""
    by_year = [(F.col("year") == year) & F.col("bucket").isin(sorted(b for b, y in parts if y == year)) for year in sorted({y for _, y in parts})]
    return reduce(Column.__or__, by_year)


def _write(df: DataFrame, path: str, by: tuple[str, ...], touched: DataFrame | None = None) -> None:
    """Replaces the partitions that ``df`` has; with ``touched`` (the columns ``by``) also those that it has no row for.

    Such a partition gets a row that says so, as a partition without any row would stay as it was.
    """
    if touched is not None:
        df = df.unionByName(touched.withColumn("_none", F.lit(True)), allowMissingColumns=True)
    with dropping_shuffles(df):
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _read(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A table without the rows that stand for empty parts; with a schema no file is opened to find it."""
    reader = spark.read.schema(schema.add("_none", "boolean")) if schema else spark.read
    return reader.parquet(f"{root}/{name}").where("_none is null").drop("_none")


def _inputs(spark: SparkSession, root: str, name: str, types: dict[str, str], parts: tuple[str, ...] = PART) -> DataFrame:
    """What all batches have brought; an empty batch has no files."""
    types = types | {"batch": "bigint"} | {c: "int" for c in parts}
    return spark.read.schema(", ".join(f"{c} {t}" for c, t in types.items())).parquet(f"{root}/{name}")


def _latest(filings: DataFrame) -> DataFrame:
    """The version of each filing that was written last; of versions without a time the one of the last batch."""
    order = [F.col("source_last_modified").desc_nulls_last(), F.col("source_content_key").desc_nulls_last(), F.col("batch").desc()]
    return filings.withColumn("_n", F.row_number().over(Window.partitionBy("accession_number").orderBy(*order))).where("_n = 1").drop("_n")


def _few(accessions: DataFrame) -> DataFrame:
    """Accession numbers, broadcast if they are few, as counted, so that the holdings they meet stay where they are."""
    return F.broadcast(accessions) if accessions.limit(FEW + 1).count() <= FEW else accessions


def _again(spark: SparkSession, root: str) -> DataFrame:
    """Filings that came more than once. Only these are looked for in all parts."""
    return _few(_inputs(spark, root, "again", {"accession_number": "string"}, ()).select("accession_number").distinct())


def _counting(spark: SparkSession, root: str, again: DataFrame) -> DataFrame:
    """Of filings that came more than once: the batch and part of the version that counts."""
    every = _inputs(spark, root, "filings", FILING_TYPES).select(*VERSION, "source_last_modified", "source_content_key")
    return _latest(every.join(again, "accession_number", "left_semi")).select(*VERSION)


def _of_last(rows: DataFrame, again: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of the versions that count."""
    repeated = rows.join(again, "accession_number", "left_semi").join(counts, list(VERSION), "left_semi")
    return rows.join(again, "accession_number", "left_anti").unionByName(repeated)


def _with_unit(held: DataFrame) -> DataFrame:
    """Holdings, which have their filing's date and part, with their unit: a part's slice has whole filings, so that one exchange serves the medians and the files."""
    dealt = held.withColumn("_slice", F.pmod(F.xxhash64("accession_number"), F.lit(SLICES))).repartition(*PART, "_slice").withColumn("_price", H.value_per_share())
    read = with_median(dealt, (*PART, "_slice"), ("accession_number",), "_price", "median_value_per_share")
    return H.with_value_usd(H.with_units(read.withColumn("median_value_per_share", F.round("median_value_per_share", 7))))


def apply_batch(spark: SparkSession, root: str, filings: DataFrame, as_filed: DataFrame, batch: int, buckets: int = BUCKETS) -> None:
    """Take a batch of filings and their holdings in, and bring the tables up to date.

    A filing may come again, in this batch's number (then it replaces what that batch brought) or in another's (then the
    version that was written last counts). ``buckets`` must be the same for all batches.
    """
    new = _in_parts(_typed(filings, FILING_TYPES), buckets)
    with dropping_shuffles(new):
        new.hint("rebalance", *PART).write.mode("overwrite").partitionBy(*PART).parquet(f"{root}/filings/batch={batch}")
    every = _inputs(spark, root, "filings", FILING_TYPES)
    keyed = every.where(F.col("batch") == batch).select("accession_number", "period_of_report", "filing_date", *PART)
    if set(OF_FILING) <= set(as_filed.columns):
        held = _in_parts(_typed(as_filed, HOLDING_TYPES | {c: FILING_TYPES[c] for c in OF_FILING}), buckets)
    else:
        held = _typed(as_filed, HOLDING_TYPES).join(keyed, "accession_number")
    held = _with_unit(held).select(*HELD_TYPES, *PART, F.lit(None).cast("boolean").alias("_none"))
    with dropping_shuffles(held):
        held.write.mode("overwrite").partitionBy(*PART).parquet(f"{root}/holdings/batch={batch}")

    # Other versions of this batch's filings may name other filers and periods.
    versions = every.select("accession_number").join(keyed, "accession_number", "left_semi")
    with dropping_shuffles(versions):
        versions.groupBy("accession_number").count().where("count > 1").select("accession_number").write.mode("overwrite").parquet(f"{root}/again/batch={batch}")
    repeated = _inputs(spark, root, "again", {"accession_number": "string"}, ()).where(F.col("batch") == batch)
    others = every.join(repeated, "accession_number", "left_semi")
    found = keyed.select(*PART, "period_of_report").distinct().unionByName(others.select(*PART, "period_of_report").distinct()).distinct().collect()
    if not found:
        return
    parts, days = {(v.bucket, v.year) for v in found}, sorted({v.period_of_report for v in found if v.period_of_report})
    later = parts | {(b, y + 1) for b, y in parts if y}
    around = later | {(b, y - 1) for b, y in parts if y}
    mine = _among(parts)

    def put(name: str, df: DataFrame, touched: set[tuple[int, int]] = parts) -> DataFrame:
        _write(df, f"{root}/{name}", PART, spark.createDataFrame(sorted(touched), "bucket int, year int"))
        return _read(spark, root, name, StructType(df.schema.fields)).where(_among(touched))

    again = _again(spark, root)
    counts = _counting(spark, root, again)
    came = every.where(mine)
    once = came.join(again, "accession_number", "left_anti")
    own = put("latest", once.unionByName(_latest(came.join(again, "accession_number", "left_semi")).join(counts, list(VERSION), "left_semi")).drop("source_last_modified", "source_content_key", "batch"))
    lines = _of_last(_inputs(spark, root, "holdings", HELD_TYPES), again, counts).drop("batch")
    held = lines.where(mine)

    here = lambda df: _in_parts(df, buckets)
    read = held.groupBy("accession_number").agg(F.first("median_value_per_share").alias("median_value_per_share"))
    units = put("filing_value_units", H.with_units(read.join(own.select("accession_number", "filing_date", *PART), "accession_number"))).drop(*PART)
    own, held = own.drop(*PART), held.drop("median_value_per_share", "period_of_report", *PART)
    coverage = put("addition_coverage", here(L.addition_coverage(own, held))).drop(*PART)
    chain = put("lineage_filings", here(L.lineage_filings(own, coverage))).drop(*PART)
    contributing = _few(chain.where("is_contributing").select("accession_number"))
    in_effect = held.join(contributing, "accession_number", "left_semi")  # others stay out of the exchanges that tell copies
    canonical = put("canonical_holdings", here(H.canonical_holdings(in_effect, chain, own)))
    put("positions", here(marts.positions(canonical)))
    put("spellings", canonical.groupBy(*PART, *dimensions.SPELLING).count())
    last = F.max(F.struct("filing_date", "accession_number", "filing_manager_name")).alias("last")
    put("filer_names", here(own.where("filing_manager_name is not null")).groupBy("cik", *PART).agg(last))

    where, chain, own, units = (_read(spark, root, name).where(_among(around)).drop(*PART) for name in ("positions", "lineage_filings", "latest", "filing_value_units"))
    unnamed = own.where(F.lit(False)).select("cik", F.lit(None).cast("string").alias("filer_name"))
    spans = here(marts.filer_periods(where, dimensions.periods(chain), unnamed, chain, own, quality.unit_overrides(units))).where(_among(later))
    spans = put("filer_periods", spans, later).drop(*PART)
    put("position_changes", here(marts.unnamed_changes(spans, where)), later)

    dimensions.named_securities(_read(spark, root, "spellings").groupBy(*dimensions.SPELLING).agg(F.sum("count").alias("count"))).write.mode("overwrite").parquet(f"{root}/securities")
    if days:
        read = lines.where(F.col("year").isin(sorted({d.year for d in days})) & F.col("period_of_report").isin(days))
        off = quality.ratios_off_yardstick(quality.priced(read, "period_of_report"))
        _write(off, f"{root}/off_yardstick", ("period_of_report",), spark.createDataFrame([(d,) for d in days], "period_of_report date"))


def current(spark: SparkSession, root: str) -> Current:
    """The tables under ``root``. Names of filers and securities and yardstick flags are joined on here."""
    t = {name: _read(spark, root, name).drop(*PART) for name in TABLES}
    again = _again(spark, root)
    t["holdings"] = _of_last(_inputs(spark, root, "holdings", HELD_TYPES), again, _counting(spark, root, again)).select(*HOLDING_TYPES, "value_unit", "value_usd")
    what = spark.read.parquet(f"{root}/securities")
    names = _read(spark, root, "filer_names").groupBy("cik").agg(F.max("last").getField("filing_manager_name").alias("filer_name"))
    off = _read(spark, root, "off_yardstick").select("accession_number")
    flagged = t["lineage_filings"].where("is_contributing").join(off, "accession_number", "left_semi").select(*L.LINEAGE).distinct().withColumn("_off", F.lit(True))
    named = {name: t[name].drop("filer_name").join(names, "cik", "left").select(*t[name].columns) for name in ("filer_periods", "position_changes")}
    spans = named["filer_periods"].join(flagged, list(L.LINEAGE), "left").withColumn("has_value_off_yardstick", F.coalesce("_off", F.lit(False))).drop("_off")
    t |= {"filer_periods": spans.select(*t["filer_periods"].columns), "position_changes": marts.with_names(named["position_changes"], what)}
    return Current(securities=what, **t)


def walk_batch(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Filings and holdings as filed of the rows of parsed filings (``staging.filing_records``, the last version of each)."""
    version = rows.where("record_type = 'cover'").select("accession_number", "source_last_modified", "source_content_key")
    covers = staging.xml_cover_pages(rows).join(version, "accession_number").withColumn("origin", F.lit("walk"))
    return covers, staging.xml_holdings(rows).withColumnRenamed("row_index", "holding_key").withColumn("origin", F.lit("walk"))


def stream_build(spark: SparkSession, path: str, root: str, checkpoint: str, buckets: int = BUCKETS, files_per_batch: int | None = None) -> StreamingQuery:
    """A stream over parsed-filing files that brings the tables under ``root`` up to date, batch by batch, until it has had all.

    The checkpoint may replay its last batch; its number is then the same, and the tables stay as they are.
    """

    def each(records: DataFrame, batch: int) -> None:
        rows = staging.filing_records(records).persist()  # covers, their versions and holdings are read from one parse
        try:
            apply_batch(spark, root, *walk_batch(rows), batch, buckets)
        finally:
            rows.unpersist()

    rows = filing_records(whole_files(spark, path, stream=True, files_per_batch=files_per_batch))
    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
