"""Filing XML: cover pages and information tables, read on the executors with ``from_xml``, and validated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions import columns as C

OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE"}
MANAGER = "struct<sequenceNumber: string, cik: string, crdNumber: string, form13FFileNumber: string, secFileNumber: string, name: string, otherManager: struct<cik: string, crdNumber: string, form13FFileNumber: string, secFileNumber: string, name: string>>"
COVER = f"""
headerData struct<submissionType: string, filerInfo: struct<filer: struct<credentials: struct<cik: string>>, periodOfReport: string>>,
formData struct<
  coverPage: struct<reportCalendarOrQuarter: string, isAmendment: string, amendmentNo: string,
    amendmentInfo: struct<amendmentType: string, confDeniedExpired: string>,
    filingManager: struct<name: string, address: struct<street1: string, street2: string, city: string, stateOrCountry: string, zipCode: string>>,
    reportType: string, form13FFileNumber: string, crdNumber: string, secFileNumber: string, provideInfoForInstruction5: string, additionalInformation: string,
    otherManagersInfo: struct<otherManager: array<{MANAGER}>>>,
  summaryPage: struct<otherIncludedManagersCount: string, tableEntryTotal: string, tableValueTotal: string, isConfidentialOmitted: string,
    otherManagers2Info: struct<otherManager2: array<{MANAGER}>>>>,
_corrupt_record string
"""
HOLDING = "struct<nameOfIssuer: string, titleOfClass: string, cusip: string, figi: string, value: string, shrsOrPrnAmt: struct<sshPrnamt: string, sshPrnamtType: string>, putCall: string, investmentDiscretion: string, otherManager: string, votingAuthority: struct<Sole: string, Shared: string, None: string>>"
TABLE = f"infoTable array<{HOLDING}>, _corrupt_record string"
SUBMISSION_TYPES = ("13F-HR", "13F-HR/A", "13F-NT", "13F-NT/A")
AMENDMENT_TYPES = ("RESTATEMENT", "NEW HOLDINGS")
REPORT_TYPES = ("13F HOLDINGS REPORT", "13F NOTICE", "13F COMBINATION REPORT")


def _root(xml: Column, name: str) -> Column:
    """Whether the root element has this local name; another root would be read as empty."""
    return xml.rlike(rf"(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<(?:[\w.-]+:)?{name}[\s>/]")


def _managers(items: Column) -> Column:
    def one(m: Column) -> Column:
        inner = lambda f: C.text(F.coalesce(m["otherManager"][f], m[f]))
        return F.struct(
            C.text(m["sequenceNumber"]).try_cast("long").alias("sequence_number"), inner("cik").alias("cik"), inner("crdNumber").alias("crd_number"),
            inner("form13FFileNumber").alias("form_13f_file_number"), inner("secFileNumber").alias("sec_file_number"), inner("name").alias("name"),
        )

    return F.coalesce(F.transform(items, one), F.from_json(F.lit("[]"), "array<struct<sequence_number: bigint, cik: string, crd_number: string, form_13f_file_number: string, sec_file_number: string, name: string>>"))


def cover_pages(files: DataFrame) -> DataFrame:
    """Cover pages of ``files`` (accession_number, xml): typed fields, and error where the page can't be used.

    Elements are found by local name. Empty elements count as missing, as does a summary page without totals.
    """
    d = files.withColumn("_x", F.from_xml("xml", COVER, OPTIONS))
    page, head, total = (lambda f: F.col(f"_x.formData.coverPage.{f}")), (lambda f: F.col(f"_x.headerData.{f}")), (lambda f: F.col(f"_x.formData.summaryPage.{f}"))
    whole = lambda c: C.text(c).try_cast("long")
    out = d.select(
        "accession_number", C.cik_text(C.text(head("filerInfo.filer.credentials.cik"))).alias("cik"), C.text(head("submissionType")).alias("submission_type"),
        C.us_day(head("filerInfo.periodOfReport"), strict=False).alias("period_of_report"), C.us_day(page("reportCalendarOrQuarter"), strict=False).alias("report_calendar_or_quarter"),
        F.coalesce(C.loose_flag(page("isAmendment")), F.lit(False)).alias("is_amendment"), whole(page("amendmentNo")).alias("amendment_no"), C.text(page("amendmentInfo.amendmentType")).alias("amendment_type"),
        C.loose_flag(page("amendmentInfo.confDeniedExpired")).alias("conf_denied_expired"), C.text(page("filingManager.name")).alias("filing_manager_name"),
        F.struct(*[C.text(page(f"filingManager.address.{a}")).alias(b) for a, b in (("street1", "street1"), ("street2", "street2"), ("city", "city"), ("stateOrCountry", "state_or_country"), ("zipCode", "zip_code"))]).alias("filing_manager_address"),
        C.text(page("reportType")).alias("report_type"), C.text(page("form13FFileNumber")).alias("form_13f_file_number"), C.text(page("crdNumber")).alias("crd_number"), C.text(page("secFileNumber")).alias("sec_file_number"),
        (C.text(page("provideInfoForInstruction5")) == "Y").alias("provide_info_for_instruction5"), C.text(page("additionalInformation")).alias("additional_information"),
        _managers(page("otherManagersInfo.otherManager")).alias("other_managers"), whole(total("otherIncludedManagersCount")).alias("other_included_managers_count"), whole(total("tableEntryTotal")).alias("table_entry_total"),
        whole(total("tableValueTotal")).alias("table_value_total"), C.loose_flag(total("isConfidentialOmitted")).alias("is_confidential_omitted"), _managers(total("otherManagers2Info.otherManager2")).alias("summary_managers"),
        F.when(~_root(F.col("xml"), "edgarSubmission"), "the root is not edgarSubmission").when(F.col("_x._corrupt_record").isNotNull(), "not well-formed XML").alias("_broken"),
    )
    return out.withColumn("error", F.coalesce("_broken", cover_error())).drop("_broken")


def cover_error() -> Column:
    """The first rule that a cover page breaks, or null."""
    c = F.col
    typed = c("amendment_type").isNotNull()
    rules = [
        (c("submission_type").isNull() | ~c("submission_type").isin(*SUBMISSION_TYPES), "submission type"), (c("period_of_report").isNull(), "period of report"), (c("cik").isNull() | ~c("cik").rlike(r"^\d{10}$"), "cik"),
        (c("filing_manager_name").isNull(), "filing manager"), (c("report_type").isNull() | ~c("report_type").isin(*REPORT_TYPES), "report type"), (typed & ~c("amendment_type").isin(*AMENDMENT_TYPES), "amendment type"),
        (c("is_amendment") != c("submission_type").endswith("/A"), "the amendment box disagrees with the submission type"), (c("is_amendment") & ~typed, "an amendment without a type"),
        (~c("is_amendment") & (typed | c("amendment_no").isNotNull()), "amendment fields on an original"), ((c("table_entry_total") < 0) | (c("table_value_total") < 0), "a negative total"),
    ]
    return F.coalesce(*[F.when(broken, message) for broken, message in rules])


def table_holdings(files: DataFrame) -> DataFrame:
    """Every holding of ``files`` (accession_number, xml), 1-based in order; error names the first field that is wrong.

    A file that can't be read gives one row with row_index 0 and its error.
    """
    # Parsed once: a filter or a second branch over an expression that Spark takes as repeatable would each parse again.
    d = files.withColumn("_x", F.when(F.spark_partition_id() >= 0, F.from_xml("xml", TABLE, OPTIONS)))
    broken = F.when(~_root(F.col("xml"), "informationTable"), "the root is not informationTable").when(F.col("_x._corrupt_record").isNotNull(), "not well-formed XML")
    d = d.withColumn("_broken", broken)
    listed = F.transform("_x.infoTable", lambda h, at: F.struct((at + 1).cast("long").alias("row_index"), h.alias("h"), F.lit(None).cast("string").alias("broken")))
    unread = F.array(F.struct(F.lit(0).cast("long").alias("row_index"), F.lit(None).cast(HOLDING).alias("h"), F.col("_broken").alias("broken")))
    rows = d.select("accession_number", F.explode(F.when(F.col("_broken").isNull(), listed).otherwise(unread)).alias("_r")).select("accession_number", "_r.row_index", "_r.h", "_r.broken")
    whole = lambda f: C.text(F.col(f"h.{f}")).try_cast("long")
    text = lambda f: C.text(F.col(f"h.{f}"))
    typed = rows.select(
        "accession_number", "row_index", text("nameOfIssuer").alias("name_of_issuer"), text("titleOfClass").alias("title_of_class"), F.upper(text("cusip")).alias("cusip"), F.upper(text("figi")).alias("figi"),
        whole("value").alias("value"), whole("shrsOrPrnAmt.sshPrnamt").alias("shares_or_principal"), text("shrsOrPrnAmt.sshPrnamtType").alias("shares_or_principal_type"), text("putCall").alias("put_call"),
        text("investmentDiscretion").alias("investment_discretion"), C.sequence_numbers(F.col("h.otherManager")).alias("other_managers"), whole("votingAuthority.Sole").alias("voting_sole"), whole("votingAuthority.Shared").alias("voting_shared"), whole("votingAuthority.None").alias("voting_none"), "broken",
    )
    return typed.withColumn("error", F.coalesce("broken", holding_error())).drop("broken")


def holding_error() -> Column:
    """The first field of a holding that breaks its rule, or null. A blank issuer is allowed."""
    c = F.col
    negative = lambda f: c(f).isNull() | (c(f) < 0)
    rules = [
        (c("title_of_class").isNull(), "titleOfClass"), (c("cusip").isNull() | ~c("cusip").rlike("^[0-9A-Z]{9}$"), "cusip"), (c("figi").isNotNull() & ~c("figi").rlike("^[0-9A-Z]{12}$"), "figi"), (negative("value"), "value"),
        (negative("shares_or_principal"), "sshPrnamt"), (c("shares_or_principal_type").isNull() | ~c("shares_or_principal_type").isin("SH", "PRN"), "sshPrnamtType"), (c("put_call").isNotNull() & ~c("put_call").isin("Put", "Call"), "putCall"),
        (c("investment_discretion").isNull() | ~c("investment_discretion").isin("SOLE", "DFND", "OTR"), "investmentDiscretion"), (negative("voting_sole") | negative("voting_shared") | negative("voting_none"), "votingAuthority"),
    ]
    return F.coalesce(*[F.when(broken, name) for broken, name in rules])


def read_xml_files(spark: SparkSession, path: str) -> DataFrame:
    """accession_number (from the path) and xml of every file."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(C.accession_of(F.regexp_replace("path", r"/[^/]*$", "")).alias("accession_number"), F.decode("content", "UTF-8").alias("xml"), "path")
