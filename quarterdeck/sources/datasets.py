"""Quarterly data sets: archives of tab-separated tables, read as text with their provenance."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of each table, in order: fixed by the publisher.
TABLES: dict[str, tuple[str, ...]] = {
    "SUBMISSION": ("accession_number", "filing_date", "submissiontype", "cik", "periodofreport"),
    "COVERPAGE": (
        "accession_number", "reportcalendarorquarter", "isamendment", "amendmentno", "amendmenttype", "confdeniedexpired", "datedeniedexpired", "datereported", "reasonfornonconfidentiality",
        "filingmanager_name", "filingmanager_street1", "filingmanager_street2", "filingmanager_city", "filingmanager_stateorcountry", "filingmanager_zipcode", "reporttype",
        "form13ffilenumber", "crdnumber", "secfilenumber", "provideinfoforinstruction5", "additionalinformation",
    ),
    "INFOTABLE": (
        "accession_number", "infotable_sk", "nameofissuer", "titleofclass", "cusip", "figi", "value", "sshprnamt", "sshprnamttype", "putcall", "investmentdiscretion", "othermanager",
        "voting_auth_sole", "voting_auth_shared", "voting_auth_none",
    ),
    "OTHERMANAGER": ("accession_number", "othermanager_sk", "cik", "form13ffilenumber", "crdnumber", "secfilenumber", "name"),
    "OTHERMANAGER2": ("accession_number", "sequencenumber", "cik", "form13ffilenumber", "crdnumber", "secfilenumber", "name"),
    "SIGNATURE": ("accession_number", "name", "title", "phone", "signature", "city", "stateorcountry", "signaturedate"),
    "SUMMARYPAGE": ("accession_number", "otherincludedmanagerscount", "tableentrytotal", "tablevaluetotal", "isconfidentialomitted"),
}
LINES = "dataset string, table string, line_no long, line string"
BLOCK_CHARS = 1 << 24
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in TABLES[table]])


def read_dataset_table(spark: SparkSession, path: str, table: str, row_numbers: bool = False, content_keys: bool = False) -> DataFrame:
    """One table of one or more data sets: every column as text, with source_file and source_last_modified.

    No quoting and no escapes; an empty field is null; a ragged row or another header fails the read. Compressed files
    are read whole by one task each. ``row_numbers`` adds source_row (1-based within the file, by the places of its splits), and
    ``content_keys`` source_content_key (MD5 of the file; one more read of it).
    """
    df = (
        spark.read.schema(raw_schema(table))
        .options(sep="\t", header=True, quote="", escape="", enforceSchema=False, mode="FAILFAST", encoding="UTF-8", nullValue="", emptyValue="")
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("source_last_modified"), F.col("_metadata.file_block_start").alias("_split"))
    )
    if row_numbers:
        df = with_row_numbers(df.withColumn("_at", F.monotonically_increasing_id()))
    df = df.drop("_split")
    if content_keys:
        df = df.join(content_key(spark, path), "source_file", "left")
    return df


def with_row_numbers(rows: DataFrame) -> DataFrame:
    """Adds source_row, 1-based within source_file, to rows that know their split's place in the file (_split) and, in _at, their order in it.

    Rows are numbered within their split, so that no task has a whole file; the rows of a file's earlier splits are added from
    the splits' counts. How splits are dealt to tasks makes no difference.
    """
    split = ("source_file", "_split")
    earlier = Window.partitionBy("source_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    own = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*split).orderBy("_at")))
    return own.join(counts, list(split)).withColumn("source_row", (F.col("_before") + F.col("_n")).cast("long")).drop("_at", "_n", "_before")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """value and source_file of every line, its split's place (_split), and its order in the split (_at)."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_at"))


def content_key(spark: SparkSession, path: str) -> DataFrame:
    """source_file and the MD5 of its bytes."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("source_file"), F.md5("content").alias("source_content_key"))


def header_violations(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Files whose first line is not the table's header, in upper or lower case; empty if all are right."""
    first = _lines(spark, path).groupBy("source_file").agg(F.min_by("value", F.struct("_split", "_at")).alias("header"))
    expected = "\t".join(TABLES[table]).upper()
    return first.where(F.upper("header") != expected).withColumn("expected", F.lit(expected))


def ragged_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows whose number of fields differs from their file's header."""
    lines = _lines(spark, path).withColumn("fields", F.size(F.split("value", "\t")))
    header = lines.groupBy("source_file").agg(F.min_by("fields", F.struct("_split", "_at")).alias("expected"))
    return lines.join(header, "source_file").where("fields <> expected").select("source_file", "value", "fields", "expected")


def open_path(path: str) -> BinaryIO:
    """A file at a local path or a URI, opened for reading from any place in it."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return open("/" + rest.lstrip("/") if colon else path, "rb")
    try:
        system, place = pyarrow.fs.FileSystem.from_uri(path)
    except pa.ArrowInvalid as e:
        raise ValueError(f"{path}: give extract_archives an opener for this store, or read archives of up to 2 GB by unpack_archives") from e
    return system.open_input_file(place)


def _blocks(name: str, file: BinaryIO, tables: Iterable[str], block: int) -> Iterator[pd.DataFrame]:
    """The lines of an archive's tables, at most ``block`` of them or about BLOCK_CHARS at a time; an archive that lacks any table fails."""
    dataset = name.rsplit("/", 1)[-1].removesuffix(".zip")
    with zipfile.ZipFile(file) as archive:
        members = {m.rsplit("/", 1)[-1].upper(): m for m in archive.namelist()}
        for table in TABLES:
            if f"{table}.TSV" not in members:
                raise ValueError(f"{name} has no {table}.tsv")
        for table in tables:
            made = lambda no, lines: pd.DataFrame({"dataset": dataset, "table": table, "line_no": range(no, no + len(lines)), "line": lines})  # noqa: B023, E731
            with archive.open(members[f"{table}.TSV"]) as f:
                lines, no, size = [], 0, 0
                for line in io.TextIOWrapper(f, "utf-8", newline="\n"):
                    lines.append(line.rstrip("\r\n"))
                    size += len(line)
                    if len(lines) == block or size >= BLOCK_CHARS:
                        yield made(no, lines)
                        lines, no, size = [], no + len(lines), 0
                if lines:
                    yield made(no, lines)


def extract_archives(spark: SparkSession, path: str, block: int = 20_000, opener: Callable[[str], BinaryIO] = open_path) -> DataFrame:
    """dataset, table, line_no (0: the header), line of the members of every archive at a path, of any size.

    Spark lists the files; their bytes pass no cell. Each table of each archive is a task, which opens the archive by
    ``opener``, reads its directory, and holds one block of one member's lines. Members are matched by base name, in whatever
    folder; an archive that lacks a table fails.
    """
    files = spark.read.format("binaryFile").load(path).select("path")
    members = files.select("path", F.explode(F.array(*map(F.lit, TABLES))).alias("table"))

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, table in zip(batch["path"], batch["table"]):
                with opener(name) as f:
                    yield from _blocks(name, f, [table], block)

    return members.repartition(max(1, len(TABLES) * files.count())).mapInPandas(unpack, LINES)


def unpack_archives(files: DataFrame, block: int = 20_000) -> DataFrame:
    """The same of archives (path, content) that are held in a table, of up to 2 GB each; an archive is a task's."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                yield from _blocks(name, io.BytesIO(content), TABLES, block)

    return files.mapInPandas(unpack, LINES)


def write_extracted(lines: DataFrame, out: str) -> DataFrame:
    """The lines as one folder of text for each table and data set, and their numbers of rows (without headers) beside it.

    Lines of one table and data set stay in order in one file; rows are spread by table and data set.
    """
    ordered = lines.repartition("table", "dataset").sortWithinPartitions("table", "dataset", "line_no")
    ordered.select("table", "dataset", F.col("line").alias("value")).write.mode("overwrite").partitionBy("table", "dataset").option("compression", "gzip").text(f"{out}/tables")
    # Counted from the files, so that nothing is unpacked twice; each has one header.
    kept = lines.sparkSession.read.schema("value string, table string, dataset string").text(f"{out}/tables")
    counts = kept.groupBy("table", "dataset").agg((F.count(F.lit(1)) - 1).alias("rows")).where("rows > 0")
    counts.write.mode("overwrite").parquet(f"{out}/counts")
    return lines.sparkSession.read.parquet(f"{out}/counts")


def dataset_window(name: Column) -> Column:
    """struct(first, last): the filing dates that an archive named 2013q2_... or 01jan2024-29feb2024_... covers; null for other names."""
    name = F.lower(name)
    month = lambda m: F.floor((F.position(m, F.lit("".join(MONTHS))) + 2) / 3).cast("int")
    q = F.regexp_extract(name, r"^(\d{4})q([1-4])_", 1)
    quarter_end = F.last_day(F.make_date(q.try_cast("int"), F.regexp_extract(name, r"^(\d{4})q([1-4])_", 2).try_cast("int") * 3, F.lit(1)))
    by_quarter = F.struct(F.add_months(F.date_add(quarter_end, 1), -3).alias("first"), quarter_end.alias("last"))
    span = r"^(\d{2})([a-z]{3})(\d{4})-(\d{2})([a-z]{3})(\d{4})_"
    part = lambda k: F.regexp_extract(name, span, k)
    date = lambda d, m, y: F.try_to_timestamp(F.concat_ws("-", part(y), F.lpad(month(part(m)).cast("string"), 2, "0"), part(d)), F.lit("yyyy-MM-dd")).cast("date")
    by_span = F.struct(date(1, 2, 3).alias("first"), date(4, 5, 6).alias("last"))
    return F.when(q != "", by_quarter).when((part(1) != "") & by_span["first"].isNotNull() & by_span["last"].isNotNull() & (by_span["first"] <= by_span["last"]), by_span)


def catalog(links: DataFrame, column: str = "link") -> DataFrame:
    """dataset, first, last of every link to an archive, oldest first."""
    name = F.regexp_extract(column, r"([^/]+)\.zip$", 1)
    return links.select(name.alias("dataset"), dataset_window(F.concat(name, F.lit("_"))).alias("w")).select("dataset", "w.first", "w.last").orderBy("first")


def untiled(windows: DataFrame) -> DataFrame:
    """Windows that do not end the day before the next one starts; one row per data set, so one small sort."""
    following = F.lead("first").over(Window.orderBy("first"))
    return windows.withColumn("next_first", following).where("next_first is not null and next_first <> date_add(last, 1)")
