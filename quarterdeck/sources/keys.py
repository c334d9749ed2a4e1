"""Where files are landed, as columns: the keys below a root under which readers and sinks find them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarterdeck.functions.columns import safe_text

# The layout of the landing area.
INDEXES, FILINGS, WALKS = "raw/edgar/index", "raw/edgar/filings", "raw/edgar/audit/walk"
PARSED = "parsed/edgar/filings"
ARCHIVES, EXTRACTED, BACKFILLS = "raw/sec/datasets", "extracted/sec/datasets", "raw/sec/audit/backfill"
COVER_NAME, TABLE_NAME = "primary_doc.xml", "infotable.xml"


def _day(day: str) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def _path(*parts: Column | str) -> Column:
    """Parts joined by slashes, texts as they are; missing if a column is."""
    out = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat(out[0], *[x for p in out[1:] for x in (F.lit("/"), p)])


def index_key(day: str) -> Column:
    """The daily form index of a date."""
    return _path(INDEXES, F.concat(F.lit("form."), F.date_format(day, "yyyyMMdd"), F.lit(".idx")))


def filing_file_key(filed: str, accession: str, name: str) -> Column:
    """A file of a filing, by filing date and accession number."""
    return _path(FILINGS, F.concat(F.lit("filed="), _day(filed)), F.col(accession), name)


def parsed_key(filed: str, accession: str) -> Column:
    """The JSON lines of a filing."""
    return _path(PARSED, F.concat(F.lit("filed="), _day(filed)), F.concat(F.col(accession), F.lit(".jsonl")))


def walk_audit_key(day: str, run: str, recorded_at: str) -> Column:
    """The record of one attempt of a walk, under the day that the run was for."""
    return _path(WALKS, F.concat(F.lit("day="), _day(day)), safe_text(run), F.concat(safe_text(recorded_at), F.lit(".json")))


def backfill_audit_key(run: str, recorded_at: str) -> Column:
    """The record of one attempt of a backfill."""
    return _path(BACKFILLS, safe_text(run), F.concat(safe_text(recorded_at), F.lit(".json")))


def archive_key(name: str) -> Column:
    """A data set's archive, under the publisher's name for it."""
    return _path(ARCHIVES, F.col(name))


def extracted_key(table: Column | str, dataset: Column | str) -> Column:
    """One compressed table of a data set; those of a table share a folder."""
    table, dataset = (F.col(c) if isinstance(c, str) else c for c in (table, dataset))
    return _path(EXTRACTED, F.concat(F.lit("table="), table), F.concat(dataset, F.lit(".tsv.gz")))
