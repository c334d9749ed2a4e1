"""Daily form indexes and directory listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions.columns import accession_of

FORM_TYPES = ("13F-HR", "13F-HR/A", "13F-NT", "13F-NT/A")
#: A row is read from its right end, as names hold spaces: form type (one word), company, CIK, date filed, path in the
#: publisher's tree. Fixed by the format.
ROW = r"^(\S+)\s(.*)\s(\d+)\s+(\d{8})\s+(edgar/\S+)\s*$"
LISTING = "struct<directory: struct<item: array<struct<name: string>>>>"


def index_lines(files: DataFrame) -> DataFrame:
    """Every line behind the dashed one, with its number in the file; ``files`` has path and content (bytes).

    The place of the dashed line is found below the explode: beside it every line would carry the lines of its whole file.
    """
    lines = F.split(F.decode("content", "ISO-8859-1"), r"\r?\n")
    rule = F.coalesce(F.array_position(F.transform("_lines", lambda x: x.rlike("^-{10,}\\s*$")), True), F.lit(0))
    return (
        files.select(F.col("path").alias("source_file"), lines.alias("_lines"))
        .select("source_file", "_lines", rule.alias("_rule"))
        .select("source_file", "_rule", F.posexplode("_lines").alias("_at", "line"))
        .where((F.col("_rule") > 0) & (F.col("_at") >= F.col("_rule")) & (F.trim("line") != ""))
        .select("source_file", (F.col("_at") + 1).cast("long").alias("line_no"), "line")
    )


def index_entries(files: DataFrame, forms: tuple[str, ...] | None = FORM_TYPES) -> DataFrame:
    """form_type, company, cik, filed, path and accession of the wanted entries (all, if forms is None)."""
    part = lambda k: F.regexp_extract("line", ROW, k)
    rows = index_lines(files).where(F.col("line").rlike(ROW)).select(
        "source_file", "line_no", part(1).alias("form_type"), F.trim(part(2)).alias("company"), F.lpad(part(3), 10, "0").alias("cik"), F.to_date(part(4), "yyyyMMdd").alias("filed"), part(5).alias("path")
    )
    rows = rows.withColumn("accession_number", accession_of("path"))
    return rows if forms is None else rows.where(F.col("form_type").isin(*forms))


def index_errors(files: DataFrame) -> DataFrame:
    """Rows that are no entry, of whatever form, with file and line number. A file with any should not be used."""
    return index_lines(files).where(~F.col("line").rlike(ROW))


def read_index_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def published_days(listings: DataFrame) -> DataFrame:
    """The days whose index a directory listing (column listing, JSON) names."""
    names = listings.select(F.explode(F.from_json("listing", LISTING)["directory"]["item"]["name"]).alias("name"))
    stamp = F.regexp_extract("name", r"^form\.(\d{8})\.idx$", 1)
    return names.where(stamp != "").select(F.try_to_timestamp(stamp, F.lit("yyyyMMdd")).cast("date").alias("day")).where("day is not null").distinct()


def filing_documents(listings: DataFrame) -> DataFrame:
    """For each filing (accession_number, form_type, listing) its cover and table document, or why its layout is wrong.

    The cover must be there; a holdings report has exactly one other XML document, a notice none.
    """
    names = F.from_json("listing", LISTING)["directory"]["item"]["name"]
    xml = F.filter(names, lambda n: F.lower(n).endswith(".xml"))
    others = F.filter(xml, lambda n: F.lower(n) != "primary_doc.xml")
    cover = F.exists(xml, lambda n: F.lower(n) == "primary_doc.xml")
    notice = F.col("form_type").startswith("13F-NT")
    error = (
        F.when(~F.coalesce(cover, F.lit(False)), "no cover document").when(notice & (F.size(others) > 0), "a notice with a table").when(~notice & (F.size(others) != 1), F.concat(F.lit("table documents: "), F.size(others).cast("string")))
    )
    return listings.select("accession_number", "form_type", F.when(error.isNull(), F.lit("primary_doc.xml")).alias("cover"), F.when(error.isNull() & ~notice, F.element_at(others, 1)).alias("table"), error.alias("error"))
