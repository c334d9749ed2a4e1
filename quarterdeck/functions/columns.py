"""Column functions for the text conventions of the sources and for calendar quarters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER, WIDE = "decimal(18,0)", "decimal(38,0)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Trimmed; empty counts as missing."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def upper_text(c: Column | str) -> Column:
    """An identifier: trimmed and in upper case."""
    return F.upper(text(c))


def day(c: Column | str, strict: bool = True) -> Column:
    """DD-MON-YYYY. Bad text raises, or is missing if not strict."""
    t = F.initcap(F.lower(text(c)))
    return F.to_date(t, "dd-MMM-yyyy") if strict else F.try_to_timestamp(t, F.lit("dd-MMM-yyyy")).cast("date")


def us_day(c: Column | str, strict: bool = True) -> Column:
    """MM-DD-YYYY."""
    return F.to_date(text(c), "MM-dd-yyyy") if strict else F.try_to_timestamp(text(c), F.lit("MM-dd-yyyy")).cast("date")


def number(c: Column | str, strict: bool = True) -> Column:
    """A whole number. Bad text raises, or is missing if not strict."""
    return text(c).cast(NUMBER) if strict else text(c).try_cast(NUMBER)


def flag(c: Column | str) -> Column:
    """Y or N; anything else is missing."""
    return F.when(text(c) == "Y", True).when(text(c) == "N", False)


def loose_flag(c: Column | str) -> Column:
    """true, 1, y or yes in any case; any other text is false, none is missing."""
    return F.lower(text(c)).isin("true", "1", "y", "yes")


def sequence_numbers(c: Column | str) -> Column:
    """Every run of digits of a list; none for missing text or NONE."""
    runs = F.regexp_extract_all(text(c), F.lit(r"(\d+)"), F.lit(1))
    return F.coalesce(F.transform(runs, lambda d: d.cast("long")), F.array().cast("array<bigint>"))


def cik_text(c: Column | str) -> Column:
    """A filer number as ten digits."""
    return F.lpad(_c(c).cast("string"), 10, "0")


def is_amendment(submission_type: Column | str) -> Column:
    return _c(submission_type).endswith("/A")


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def accession_of(path: Column | str) -> Column:
    """The accession number that a document's path ends with."""
    return F.regexp_extract(_c(path), r"([0-9]{10}-[0-9]{2}-[0-9]{6})[^/]*$", 1)


def filed_in(path: Column | str) -> Column:
    """The date of a ``filed=YYYY-MM-DD`` folder."""
    return F.to_date(F.nullif(F.regexp_extract(_c(path), r"filed=(\d{4}-\d{2}-\d{2})", 1), F.lit("")))


def folder_of(cik: Column | str, accession: Column | str) -> Column:
    """The folder of a filing's documents: the filer's number without leading zeros and the accession without dashes."""
    return F.concat_ws("/", F.lit("edgar/data"), F.regexp_replace(_c(cik), "^0+", ""), F.regexp_replace(_c(accession), "-", ""))


def safe_text(c: Column | str) -> Column:
    """Text for keys: letters, digits, dots, dashes and underscores stay, any other character becomes a dash."""
    return F.regexp_replace(_c(c), "[^A-Za-z0-9_.-]", "-")


def quarter_path(d: Column | str) -> Column:
    """YYYY/QTRn of a date, as daily indexes are laid out."""
    return F.concat(F.year(_c(d)).cast("string"), F.lit("/QTR"), F.quarter(_c(d)).cast("string"))


def is_quarter_end(d: Column | str) -> Column:
    return (_c(d) == F.last_day(_c(d))) & F.month(_c(d)).isin(3, 6, 9, 12)


def previous_quarter_end(d: Column | str) -> Column:
    """The quarter end before a quarter end; missing for other days."""
    return F.when(is_quarter_end(d), F.last_day(F.add_months(_c(d), -3)))
