"""Typed projections of the raw tables and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.functions import columns as C

PROVENANCE = ("source_file", "source_row", "source_content_key", "source_last_modified")


def _typed(raw: DataFrame, *columns: Column | str) -> DataFrame:
    return raw.select(*columns, *[c for c in PROVENANCE if c in raw.columns])


def submissions(raw: DataFrame) -> DataFrame:
    kind = C.text("submissiontype")
    return _typed(raw, "accession_number", C.day("filing_date").alias("filing_date"), kind.alias("submission_type"), C.cik_text(C.text("cik")).alias("cik"), C.day("periodofreport").alias("period_of_report"), C.is_amendment(kind).alias("is_amendment"))


def cover_pages(raw: DataFrame) -> DataFrame:
    t = lambda a, b: C.text(a).alias(b)
    return _typed(
        raw, "accession_number", C.day("reportcalendarorquarter").alias("report_calendar_or_quarter"), C.flag("isamendment").alias("cover_is_amendment"), C.number("amendmentno").alias("amendment_no"), t("amendmenttype", "amendment_type"),
        C.flag("confdeniedexpired").alias("conf_denied_expired"), C.day("datedeniedexpired").alias("date_denied_expired"), C.day("datereported").alias("date_reported"), t("reasonfornonconfidentiality", "reason_for_non_confidentiality"),
        t("filingmanager_name", "filing_manager_name"), t("filingmanager_street1", "filing_manager_street1"), t("filingmanager_street2", "filing_manager_street2"), t("filingmanager_city", "filing_manager_city"),
        t("filingmanager_stateorcountry", "filing_manager_state_or_country"), t("filingmanager_zipcode", "filing_manager_zip_code"), t("reporttype", "report_type"), t("form13ffilenumber", "form_13f_file_number"),
        t("crdnumber", "crd_number"), t("secfilenumber", "sec_file_number"), C.flag("provideinfoforinstruction5").alias("provide_info_for_instruction5"), t("additionalinformation", "additional_information"),
    )


def info_table(raw: DataFrame) -> DataFrame:
    t = lambda a, b: C.text(a).alias(b)
    return _typed(
        raw, "accession_number", C.number("infotable_sk").alias("infotable_sk"), t("nameofissuer", "name_of_issuer"), t("titleofclass", "title_of_class"), C.upper_text("cusip").alias("cusip"), C.upper_text("figi").alias("figi"),
        C.number("value").alias("value_as_filed"), C.number("sshprnamt").alias("shares_or_principal_amount"), t("sshprnamttype", "shares_or_principal_amount_type"), t("putcall", "put_call"), t("investmentdiscretion", "investment_discretion"),
        t("othermanager", "other_manager"), C.sequence_numbers("othermanager").alias("other_manager_sequence_numbers"), C.number("voting_auth_sole").alias("voting_sole"), C.number("voting_auth_shared").alias("voting_shared"), C.number("voting_auth_none").alias("voting_none"),
    )


def _managers(raw: DataFrame, key: str, name: str) -> DataFrame:
    t = lambda a, b: C.text(a).alias(b)
    return _typed(raw, "accession_number", C.number(key).alias(name), t("cik", "cik"), t("form13ffilenumber", "form_13f_file_number"), t("crdnumber", "crd_number"), t("secfilenumber", "sec_file_number"), t("name", "name"))


def other_managers(raw: DataFrame) -> DataFrame:
    return _managers(raw, "othermanager_sk", "other_manager_sk")


def other_managers_2(raw: DataFrame) -> DataFrame:
    return _managers(raw, "sequencenumber", "sequence_number")


def signatures(raw: DataFrame) -> DataFrame:
    t = lambda a, b: C.text(a).alias(b)
    return _typed(raw, "accession_number", t("name", "name"), t("title", "title"), t("phone", "phone"), t("signature", "signature"), t("city", "city"), t("stateorcountry", "state_or_country"), C.day("signaturedate").alias("signature_date"))


def summary_pages(raw: DataFrame) -> DataFrame:
    return _typed(
        raw, "accession_number", C.number("otherincludedmanagerscount").alias("other_included_managers_count"), C.number("tableentrytotal").alias("table_entry_total"),
        C.number("tablevaluetotal").alias("table_value_total_as_filed"), C.flag("isconfidentialomitted").alias("is_confidential_omitted"),
    )


def _get(path: str, kind: str, column: str = "record") -> Column:
    return F.variant_get(F.col(column), path, kind)


def one_per_file(audit: DataFrame) -> DataFrame:
    """One audit record per file, as two loaders may have read it."""
    n = F.row_number().over(Window.partitionBy("source_file").orderBy("source_content_key"))
    return audit.withColumn("_n", n).where("_n = 1").drop("_n")


def walk_runs(audit: DataFrame) -> DataFrame:
    """One row per walk record; what older records lack stays null."""
    number = lambda f: _get(f"$.{f}", "bigint").alias(f)
    size = lambda f, name: F.size(_get(f"$.{f}", "array<variant>")).cast("long").alias(name)
    return one_per_file(audit).select(
        _get("$.run_id", "string").alias("run_id"), _get("$.day", "date").alias("walk_day"), _get("$.recorded_at", "timestamp").alias("recorded_at"), _get("$.published", "boolean").alias("is_index_published"),
        number("discovered"), number("landed"), number("already_present"), size("failed", "landing_failures"), number("parsed"), number("parsed_already_present"), number("not_landed"), size("parse_failed", "parse_failures"),
        size("reconcile_gaps", "reconcile_gaps"), number("requests_made"), number("retries"), "source_file", "source_last_modified",
    )


def walk_days(audit: DataFrame) -> DataFrame:
    """One row per day of each walk record; a form type that a day lacks counts 0."""
    days = _get("$.days", "map<string, struct<key: string, discovered: bigint, by_form: map<string, bigint>>>")
    rows = one_per_file(audit).select("record", "source_file", "source_last_modified", F.explode(days).alias("day", "d"))
    form = lambda f, name: F.coalesce(F.try_element_at("d.by_form", F.lit(f)), F.lit(0)).alias(name)
    return rows.select(
        _get("$.run_id", "string").alias("run_id"), _get("$.recorded_at", "timestamp").alias("recorded_at"), F.to_date("day").alias("walk_day"), F.col("d.discovered").alias("discovered"), form("13F-HR", "holdings_reports"),
        form("13F-HR/A", "holdings_report_amendments"), form("13F-NT", "notices"), form("13F-NT/A", "notice_amendments"), "source_file", "source_last_modified",
    )


def walk_failures(audit: DataFrame) -> DataFrame:
    """One row per filing that a record names as failed to land or to parse."""
    one = one_per_file(audit)
    failure = "array<struct<accession: string, form_type: string, error: string>>"

    def stage(name: str, field: str) -> DataFrame:
        return one.select("record", "source_file", F.lit(name).alias("failure_stage"), F.explode(_get(f"$.{field}", failure)).alias("f"))

    return stage("land", "failed").unionByName(stage("parse", "parse_failed")).select(
        _get("$.run_id", "string").alias("run_id"), _get("$.recorded_at", "timestamp").alias("recorded_at"), _get("$.day", "date").alias("walk_day"), "failure_stage",
        F.col("f.accession").alias("accession_number"), F.col("f.form_type").alias("submission_type"), F.col("f.error").alias("error"), "source_file",
    )


def backfill_tables(audit: DataFrame) -> DataFrame:
    """One row per table of each backfill record."""
    count = lambda f: _get(f"$.{f}", "map<string, bigint>")
    rows = one_per_file(audit).select("record", "source_file", F.explode(count("extracted_rows")).alias("table_name", "extracted_rows"))
    at = lambda f: F.try_element_at(count(f), F.col("table_name")).alias(f)
    return rows.select(_get("$.run_id", "string").alias("run_id"), _get("$.recorded_at", "timestamp").alias("recorded_at"), "table_name", "extracted_rows", at("rows_loaded"), at("files_loaded"), "source_file")


def filing_records(raw: DataFrame) -> DataFrame:
    """The lines of parsed filings, of the file version of each filing that was written last, whole."""
    df = raw.select(
        _get("$.accession", "string").alias("accession_number"), _get("$.record_type", "string").alias("record_type"), _get("$.source_key", "string").alias("source_key"), F.variant_get("record", "$.record", "variant").alias("parsed"),
        C.filed_in("source_file").alias("filing_date"), "source_file", "source_row", "source_content_key", "source_last_modified",
    )
    latest = F.first("source_content_key").over(Window.partitionBy("accession_number").orderBy(F.desc("source_last_modified"), F.desc("source_content_key")))
    return df.withColumn("_latest", latest).where("source_content_key = _latest").drop("_latest")


def xml_cover_pages(records: DataFrame) -> DataFrame:
    p = lambda path, kind, name: _get(f"$.{path}", kind, "parsed").alias(name)
    return records.where("record_type = 'cover'").select(
        "accession_number", "filing_date", p("submission_type", "string", "submission_type"), C.cik_text(_get("$.cik", "string", "parsed")).alias("cik"), p("period_of_report", "date", "period_of_report"),
        C.is_amendment(_get("$.submission_type", "string", "parsed")).alias("is_amendment"), p("report_calendar_or_quarter", "date", "report_calendar_or_quarter"), p("is_amendment", "boolean", "cover_is_amendment"), p("amendment_no", "bigint", "amendment_no"),
        p("amendment_type", "string", "amendment_type"), p("filing_manager_name", "string", "filing_manager_name"), p("report_type", "string", "report_type"), p("summary.table_entry_total", "bigint", "table_entry_total"),
        p("summary.table_value_total", "bigint", "table_value_total_as_filed"), p("summary.is_confidential_omitted", "boolean", "is_confidential_omitted"), "source_file", "source_row",
    )


def xml_holdings(records: DataFrame) -> DataFrame:
    p = lambda path, kind, name: _get(f"$.{path}", kind, "parsed").alias(name)
    return records.where("record_type = 'holding'").select(
        "accession_number", p("row_index", "bigint", "row_index"), p("name_of_issuer", "string", "name_of_issuer"), p("title_of_class", "string", "title_of_class"), p("cusip", "string", "cusip"), p("figi", "string", "figi"), p("value", "bigint", "value_as_filed"),
        p("shares_or_principal", "bigint", "shares_or_principal_amount"), p("shares_or_principal_type", "string", "shares_or_principal_amount_type"), p("put_call", "string", "put_call"), p("investment_discretion", "string", "investment_discretion"),
        p("other_managers", "array<bigint>", "other_manager_sequence_numbers"), p("voting_sole", "bigint", "voting_sole"), p("voting_shared", "bigint", "voting_shared"), p("voting_none", "bigint", "voting_none"), "source_file", "source_row",
    )


def xml_other_managers(records: DataFrame) -> DataFrame:
    """Managers that covers and summary pages list."""
    kind = "array<struct<sequence_number: bigint, cik: string, form_13f_file_number: string, crd_number: string, sec_file_number: string, name: string>>"
    covers = records.where("record_type = 'cover'")
    part = lambda path, where: covers.select("accession_number", F.lit(where).alias("listed_on"), F.explode(_get(f"$.{path}", kind, "parsed")).alias("m"))
    rows = part("other_managers", "cover").unionByName(part("summary.other_managers", "summary"))
    return rows.select("accession_number", "listed_on", "m.sequence_number", C.cik_text("m.cik").alias("cik"), "m.form_13f_file_number", "m.crd_number", "m.sec_file_number", "m.name")
