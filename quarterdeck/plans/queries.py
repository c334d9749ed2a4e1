"""The registered queries over the star-schema tables, and their oracles."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions import columns as C
from quarterdeck.operators import expect, holdings as H, ingest, lineage as L, marts, observability as O, profile as P, quality, reconcile as R
from quarterdeck.plans import landed as S, oracles as Q
from quarterdeck.plans.build import BUCKETED, LAYERS, Tables, build, build_layers, shared_folder, written, written_checked
from quarterdeck.sources import datasets as D, indexes as I, keys as K

Query = Callable[[SparkSession, str], DataFrame]
_built: dict[tuple[str, str], Tables] = {}
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The build over these tables, each of which is made at its first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _built:
        _built[key] = build(*_given(spark, sf_dir), write=True)
    return _built[key]


def _given(spark: SparkSession, sf_dir: str) -> tuple[Callable[[], DataFrame], Callable[[], DataFrame]]:
    """What makes the inputs of a build, each stored once in a session."""
    return lambda: S.shaped_filings(spark, sf_dir), lambda: S.shaped_as_filed(spark, sf_dir)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


def largest_filer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the largest filer of the latest comparable period bought and sold."""
    t = tables(spark, sf_dir)
    last = t.filer_periods.where("comparison_basis = 'previous period'").orderBy(F.desc("period_of_report"), F.desc("value_usd"), "cik").limit(1)
    changes = t.position_changes.where("change_kind <> 'unchanged'")
    return changes.join(F.broadcast(last.select("cik", "period_of_report")), ["cik", "period_of_report"], "left_semi")


query("flagship_largest_filer_changes", Q.of("select c.* from changes c join (select cik, period_of_report from filer_periods where comparison_basis = 'previous period' order by period_of_report desc, value_usd desc, cik limit 1) l using (cik, period_of_report) where change_kind <> 'unchanged'", "changes"))(largest_filer_changes)


@query("filing_value_units", Q.of("select accession_number, filing_date, median_value_per_share, filing_date_unit, value_unit, case when value_unit = 'thousands' then cast(1000 as bigint) else cast(1 as bigint) end as value_multiplier from units", "units"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).filing_value_units.select("accession_number", "filing_date", "median_value_per_share", "filing_date_unit", "value_unit", "value_multiplier")


@query("holdings", Q.of("select accession_number, origin, holding_key, cusip, put_call, value_as_filed, value_unit, value_usd, array_to_string(managers, ',') as managers from holdings", "holdings"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).holdings.select("accession_number", "origin", "holding_key", "cusip", "put_call", "value_as_filed", "value_unit", "value_usd", F.array_join("other_manager_sequence_numbers", ",").alias("managers"))


@query("typed_roles", Q.of("select accession_number, cik, period_of_report, filing_position, typed_role from typed", "typed"))
def _(spark, sf_dir):
    return L.with_typed_role(L.with_position(tables(spark, sf_dir).filings)).select("accession_number", *L.LINEAGE, "filing_position", "typed_role")


@query("addition_coverage", Q.of("select accession_number, cik, period_of_report, compared_accession_number, compared_securities, repeated_securities, round(case when compared_securities > 0 then repeated_securities / compared_securities end, 9) as coverage, coalesce(compared_securities > 0 and repeated_securities * 10 >= compared_securities * 9, false) as is_read_as_restatement from coverage", "coverage"))
def _(spark, sf_dir):
    return rounded(tables(spark, sf_dir).addition_coverage, "coverage")


@query("lineage_filings", Q.of("select * from lineage", "lineage"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).lineage_filings


@query("canonical_holdings", Q.of("select cik, period_of_report, accession_number, filing_role, origin, holding_key, cusip, value_usd from canonical", "canonical"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).canonical_holdings.select("cik", "period_of_report", "accession_number", "filing_role", "origin", "holding_key", "cusip", "value_usd")


@query("filers", Q.of("select * from filers", "filers"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).filers


@query("periods", Q.of("select * from periods", "periods"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).periods


@query("securities", Q.of("select * from securities", "securities"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).securities


@query("positions", Q.of("select * from positions", "positions"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).positions


@query("filer_periods", Q.of("select * replace (round(top_ten_share, 9) as top_ten_share, round(hhi, 9) as hhi) from filer_periods", "filer_periods"))
def _(spark, sf_dir):
    return rounded(tables(spark, sf_dir).filer_periods, "top_ten_share", "hhi")


@query("position_changes", Q.of("select * from changes", "changes"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).position_changes


@query("filer_overlaps", Q.of("select * from overlapping", "overlapping"))
def _(spark, sf_dir):
    return rounded(tables(spark, sf_dir).filer_overlaps, "weight_overlap")


def _check(name: str) -> Query:
    return lambda spark, sf_dir: tables(spark, sf_dir).data_quality_rows.where(F.col("check_name") == name).select(*L.LINEAGE, "accession_number", "origin")


for _name in Q.CHECKS:
    query(f"dq_{_name}", Q.of(f"select {Q._KEYS} from dq where check_name = '{_name}'", "dq"))(_check(_name))


@query("data_quality_check_counts", Q.of("select check_name, origin, count(*) as filings, count(distinct (cik, period_of_report)) as lineages from dq group by 1, 2", "dq"))
def _(spark, sf_dir):
    return quality.check_counts(tables(spark, sf_dir).data_quality_rows)


@query("row_counts", Q.of("""
  , aside as (select s.accession_number from state s join (select cik, period_of_report, max(case when filing_role in ('original', 'restatement') then filing_position end) as e from state where origin = 'data_set' group by 1, 2) d using (cik, period_of_report)
     where s.origin = 'data_set' and s.is_superseded and (s.filing_position = d.e or (s.filing_role = 'addition' and (d.e is null or s.filing_position > d.e)))),
  h as (select h.origin, count(*) as holdings, count(*) filter (where s.is_superseded) as superseded_holdings, count(*) filter (where s.is_contributing) as contributing_holdings, count(*) filter (where s.filing_role = 'notice') as notice_holdings, count(a.accession_number) as set_aside_by_walk
        from holdings h left join state s on s.accession_number = h.accession_number left join aside a on a.accession_number = h.accession_number group by 1),
  c as (select origin, count(*) as canonical_holdings from canonical group by 1), r as (select origin, count(*) as raw_rows from raw_holdings group by 1), f as (select origin, count(*) as filings, count(*) filter (where is_superseded) as superseded_filings from state group by 1)
  select origin, raw_rows, holdings, superseded_holdings, contributing_holdings, notice_holdings, canonical_holdings, contributing_holdings - canonical_holdings as copied_holdings,
    holdings - superseded_holdings - contributing_holdings - notice_holdings as unresolved_holdings, set_aside_by_walk, filings, superseded_filings from r left join h using (origin) left join c using (origin) left join f using (origin)""", "state", "canonical"))  # fmt: skip
def _(spark, sf_dir):
    t = tables(spark, sf_dir)
    raw = t.holdings.groupBy("origin").agg(F.count(F.lit(1)).alias("raw_rows"))
    return O.row_counts(raw, t.filings, t.lineage_filings, t.holdings, t.canonical_holdings)


# Sources, staging and sinks: landed files are written from the shaped tables and read back.

_DS = "where origin = 'data_set'"


@query("staged_submissions", Q.of(f"select accession_number, filing_date, submission_type, cik, period_of_report, is_amendment from filings {_DS}"))
def _(spark, sf_dir):
    return S.staged(spark, sf_dir, "SUBMISSION").select("accession_number", "filing_date", "submission_type", "cik", "period_of_report", "is_amendment")


@query("staged_cover_pages", Q.of(f"select accession_number, report_calendar_or_quarter, cover_is_amendment, amendment_no, amendment_type, filing_manager_name, report_type from filings {_DS}"))
def _(spark, sf_dir):
    return S.staged(spark, sf_dir, "COVERPAGE").select("accession_number", "report_calendar_or_quarter", "cover_is_amendment", F.col("amendment_no").cast("long").alias("amendment_no"), "amendment_type", "filing_manager_name", "report_type")


@query("staged_info_table", Q.of(f"select accession_number, holding_key as infotable_sk, name_of_issuer, title_of_class, cusip, figi, value_as_filed, shares_or_principal_amount, shares_or_principal_amount_type, put_call, investment_discretion, array_to_string({Q._SEQ.format('other_manager')}, ',') as managers, voting_sole from raw_holdings {_DS}"))
def _(spark, sf_dir):
    whole = lambda c: F.col(c).cast("long").alias(c)
    return S.staged(spark, sf_dir, "INFOTABLE").select("accession_number", whole("infotable_sk"), "name_of_issuer", "title_of_class", "cusip", "figi", whole("value_as_filed"), whole("shares_or_principal_amount"), "shares_or_principal_amount_type", "put_call", "investment_discretion", F.array_join("other_manager_sequence_numbers", ",").alias("managers"), whole("voting_sole"))


@query("staged_other_managers", Q.of(f"select accession_number, cast(1 as bigint) as other_manager_sk, cik, concat('MANAGER ', cast(k % 9 as string)) as name from filings {_DS} and k % 4 = 0"))
def _(spark, sf_dir):
    return S.staged(spark, sf_dir, "OTHERMANAGER").select("accession_number", F.col("other_manager_sk").cast("long").alias("other_manager_sk"), "cik", "name")


@query("staged_other_managers_2", Q.of(f"select accession_number, cast(k % 5 as bigint) as sequence_number, cik, concat('MANAGER ', cast(k % 9 as string)) as name from filings {_DS} and k % 3 = 0"))
def _(spark, sf_dir):
    return S.staged(spark, sf_dir, "OTHERMANAGER2").select("accession_number", F.col("sequence_number").cast("long").alias("sequence_number"), "cik", "name")


@query("staged_signatures", Q.of(f"select accession_number, concat('SIGNER ', cast(k % 11 as string)) as name, filing_date as signature_date from filings {_DS}"))
def _(spark, sf_dir):
    return S.staged(spark, sf_dir, "SIGNATURE").select("accession_number", "name", "signature_date")


@query("staged_summary_pages", Q.of(f"select accession_number, table_entry_total, table_value_total_as_filed, is_confidential_omitted from filings {_DS} and table_entry_total is not null"))
def _(spark, sf_dir):
    whole = lambda c: F.col(c).cast("long").alias(c)
    return S.staged(spark, sf_dir, "SUMMARYPAGE").select("accession_number", whole("table_entry_total"), whole("table_value_total_as_filed"), "is_confidential_omitted")


_WALK = "where origin = 'walk'"


@query("staged_walk_covers", Q.of(f"select accession_number, filing_date, submission_type, cik, period_of_report, is_amendment, report_calendar_or_quarter, cover_is_amendment, amendment_no, amendment_type, filing_manager_name, report_type, table_entry_total, table_value_total_as_filed, is_confidential_omitted from filings {_WALK}"))
def _(spark, sf_dir):
    return S.walk_covers(spark, sf_dir).select("accession_number", "filing_date", "submission_type", "cik", "period_of_report", "is_amendment", "report_calendar_or_quarter", "cover_is_amendment", "amendment_no", "amendment_type", "filing_manager_name", "report_type", "table_entry_total", "table_value_total_as_filed", "is_confidential_omitted")


@query("staged_walk_holdings", Q.of(f"select accession_number, holding_key as row_index, name_of_issuer, cusip, figi, value_as_filed, shares_or_principal_amount, put_call, array_to_string({Q._SEQ.format('other_manager')}, ',') as managers from raw_holdings {_WALK}"))
def _(spark, sf_dir):
    return S.walk_holdings(spark, sf_dir).select("accession_number", "row_index", "name_of_issuer", "cusip", "figi", "value_as_filed", "shares_or_principal_amount", "put_call", F.array_join("other_manager_sequence_numbers", ",").alias("managers"))


@query("staged_walk_managers", Q.of(f"select accession_number, w as listed_on, concat('MANAGER ', cast(k % 9 as string)) as name from filings, (values ('cover'), ('summary')) v(w) {_WALK} and k % 4 = 0 and (w = 'cover' or table_entry_total is not null)"))
def _(spark, sf_dir):
    return S.walk_managers(spark, sf_dir).select("accession_number", "listed_on", "name")


@query("filings_of_both_origins", Q.of("select accession_number, cik, period_of_report, filing_date, submission_type, is_amendment, amendment_type, amendment_no, report_type, table_entry_total, table_value_total_as_filed, is_confidential_omitted, origin from (select * replace (case when origin = 'data_set' and table_entry_total is null then null else is_confidential_omitted end as is_confidential_omitted) from filings)"))
def _(spark, sf_dir):
    whole = lambda c: F.col(c).cast("long").alias(c)
    df = H.filings(S.staged(spark, sf_dir, "SUBMISSION"), S.staged(spark, sf_dir, "COVERPAGE"), S.staged(spark, sf_dir, "SUMMARYPAGE"), S.walk_covers(spark, sf_dir))
    return df.select("accession_number", "cik", "period_of_report", "filing_date", "submission_type", "is_amendment", "amendment_type", whole("amendment_no"), "report_type", whole("table_entry_total"), whole("table_value_total_as_filed"), "is_confidential_omitted", "origin")


@query("index_entries", Q.of(f"select accession_number, submission_type as form_type, cik, filing_date as filed, coalesce(filing_manager_name, 'NO  NAME') as company from filings {_WALK}"))
def _(spark, sf_dir):
    return S.index_entries(spark, sf_dir).select("accession_number", "form_type", "cik", "filed", "company")


#: Which orders have a row in each table of the data sets.
_TABLE_ROWS = " union all ".join(
    f"select '{t}' as t, k from {df} {_DS} {more}"
    for t, df, more in (
        ("SUBMISSION", "filings", ""), ("COVERPAGE", "filings", ""), ("INFOTABLE", "raw_holdings", ""), ("OTHERMANAGER", "filings", "and k % 4 = 0"), ("OTHERMANAGER2", "filings", "and k % 3 = 0"),
        ("SIGNATURE", "filings", ""), ("SUMMARYPAGE", "filings", "and table_entry_total is not null"),
    )
)
_ARCHIVED = Q.of(f"select t as \"table\", concat('set', cast(cast(floor(k / {S.ARCHIVE_ORDERS}.0) as bigint) as string)) as dataset, count(*) as rows from ({_TABLE_ROWS}) group by 1, 2")


@query("archive_row_counts", _ARCHIVED)
def _(spark, sf_dir):
    lines = D.unpack_archives(S.archives(spark, sf_dir))
    return P.table_counts(lines.where("line_no > 0"))


@query("extracted_row_counts", _ARCHIVED)
def _(spark, sf_dir):
    return S.extracted(spark, sf_dir).select("table", "dataset", "rows")


@query("ragged_rows", Q.of(f"select 6 as fields, 5 as expected, count(*) as n from filings {_DS} and k % 10 = 0 having count(*) > 0"))
def _(spark, sf_dir):
    return D.ragged_rows(spark, S.ragged_folder(spark, sf_dir)).groupBy("fields", "expected").agg(F.count(F.lit(1)).alias("n"))


_HEADERS = {t: "\t".join(D.TABLES[t]).upper() for t in ("SUBMISSION", "SUMMARYPAGE")}


@query("header_violations", Q.of(f"select distinct '{_HEADERS['SUBMISSION']}' as header, '{_HEADERS['SUMMARYPAGE']}' as expected from filings {_DS}"))
def _(spark, sf_dir):
    return D.header_violations(spark, S.ragged_folder(spark, sf_dir), "SUMMARYPAGE").select("header", "expected").distinct()


@query("profile_totals", Q.of(f"select 'table' as what, t as value, count(*) as n from ({_TABLE_ROWS}) group by 2 union all select 'submission type', submission_type, count(*) from filings group by 2 union all select 'amendment type', amendment_type, count(*) from filings where amendment_type is not null group by 2"))
def _(spark, sf_dir):
    filings = tables(spark, sf_dir).filings
    return P.totals(S.raw_counts(spark, sf_dir), filings, filings)


@query("published_days", Q.of("select distinct filing_date as day from filings"))
def _(spark, sf_dir):
    return I.published_days(S.index_listings(spark, sf_dir))


@query("filing_documents", Q.of(f"""
  , w as (select *, case when submission_type like '13F-NT%' then 0 else 1 end + case when k % 13 = 0 then 1 else 0 end as n from filings {_WALK})
  select accession_number, submission_type as form_type, case when e is null then 'primary_doc.xml' end as cover, case when e is null and submission_type not like '13F-NT%' then 'table.xml' end as "table", e as error
  from (select *, case when k % 11 = 0 then 'no cover document' when submission_type like '13F-NT%' and n > 0 then 'a notice with a table' when submission_type not like '13F-NT%' and n <> 1 then concat('table documents: ', cast(n as string)) end as e from w)"""))
def _(spark, sf_dir):
    return I.filing_documents(S.listings(spark, sf_dir))


@query("dataset_catalog", Q.of("select distinct concat(cast(year(filing_date) as string), 'q', cast(quarter(filing_date) as string), '_form13f') as dataset, cast(date_trunc('quarter', filing_date) as date) as first, cast(last_day(cast(date_trunc('quarter', filing_date) + interval 2 month as date)) as date) as last from filings"))
def _(spark, sf_dir):
    return D.catalog(S.archive_links(spark, sf_dir))


@query("untiled_windows", Q.of("select q as first, cast(q + interval 3 month - interval 1 day as date) as last, n as next_first from (select q, lead(q) over (order by q) as n from (select distinct cast(date_trunc('quarter', filing_date) as date) as q from filings where quarter(filing_date) <> 3)) where n is not null and n <> cast(q + interval 3 month as date)"))
def _(spark, sf_dir):
    return D.untiled(D.catalog(S.archive_links(spark, sf_dir)).where(F.quarter("first") != 3)).select("first", "last", "next_first")


@query("parsed_xml_holdings", Q.of(f"select h.accession_number, holding_key as row_index, cusip, value_as_filed as value, put_call from raw_holdings h {_WALK} and not exists (select 1 from raw_holdings b where b.accession_number = h.accession_number and not regexp_full_match(b.cusip, '[0-9A-Z]{{9}}')) and h.accession_number in (select accession_number from filings where {S.GOOD_COVER})"))
def _(spark, sf_dir):
    return S.parsed(spark, sf_dir, 1).select("accession_number", "row_index", "cusip", "value", "put_call")


@query("parse_failures", Q.of(f"select accession_number, submission_type as form_type from filings f {_WALK} and (not ({S.GOOD_COVER}) or exists (select 1 from raw_holdings b where b.accession_number = f.accession_number and not regexp_full_match(b.cusip, '[0-9A-Z]{{9}}')))"))
def _(spark, sf_dir):
    return S.parsed(spark, sf_dir, 2).select("accession_number", "form_type")


@query("walk_days", Q.of(f"select d.filing_date as walk_day, cast(d.n as bigint) as discovered, d.hr as holdings_reports, d.hra as holdings_report_amendments, d.nt as notices, d.nta as notice_amendments, l.n as loaded, l.s as loaded_from_data_sets, d.n - l.n as not_loaded, cast(2 as bigint) as audit_records, 'run-2' as run_id from (select filing_date, count(*) as n, count(*) filter (where submission_type = '13F-HR') as hr, count(*) filter (where submission_type = '13F-HR/A') as hra, count(*) filter (where submission_type = '13F-NT') as nt, count(*) filter (where submission_type = '13F-NT/A') as nta from filings {_WALK} group by 1) d join (select filing_date, count(*) as n, count(*) filter (where origin = 'data_set') as s from filings group by 1) l using (filing_date)"))
def _(spark, sf_dir):
    return O.walk_days(S.audit_days(spark, sf_dir), tables(spark, sf_dir).filings).drop("recorded_at")


@query("walk_failures", Q.of(f"select accession_number, s as failure_stage, submission_type, filing_date as walk_day, cast(2 as bigint) as failed_attempts, 'run-2' as last_run_id, concat(s, ' error of run-2') as last_error, k % 3 = 0 as is_loaded from filings, (values ('land', 17), ('parse', 13)) v(s, m) {_WALK} and k % m = 0"))
def _(spark, sf_dir):
    loaded = tables(spark, sf_dir).filings.where("k % 3 = 0")
    return O.walk_failures(S.audit_failures(spark, sf_dir), loaded).drop("first_failed_at", "last_failed_at")


@query("walk_runs", Q.of(f"select r as run_id, filing_date as walk_day, count(*) as discovered, count(*) filter (where k % 17 = 0) as landing_failures, count(*) filter (where k % 13 = 0) as parse_failures from filings, (values ('run-1'), ('run-2')) v(r) {_WALK} group by 1, 2"))
def _(spark, sf_dir):
    return S.audit_runs(spark, sf_dir).select("run_id", "walk_day", "discovered", "landing_failures", "parse_failures")


@query("audit_history", ORACLES["walk_runs"])
def _(spark, sf_dir):
    return S.audit_history(spark, sf_dir).select("run_id", "walk_day", "discovered", "landing_failures", "parse_failures")


@query("stream_audit_records", ORACLES["walk_runs"])
def _(spark, sf_dir):
    return S.streamed_audit(spark, sf_dir).select("run_id", "walk_day", "discovered", "landing_failures", "parse_failures")


@query("backfill_tables", Q.of(f"""
  , n as (select 'SUBMISSION' as table_name, k from filings {_DS} union all select 'COVERPAGE', k from filings {_DS} union all select 'INFOTABLE', k from raw_holdings {_DS} union all select 'OTHERMANAGER', k from filings {_DS} and k % 4 = 0
    union all select 'OTHERMANAGER2', k from filings {_DS} and k % 3 = 0 union all select 'SIGNATURE', k from filings {_DS} union all select 'SUMMARYPAGE', k from filings {_DS} and table_entry_total is not null)
  select table_name, count(*) as extracted_rows, count(*) as rows_loaded, count(distinct k % 8) as files_loaded, cast(1 as bigint) as backfill_runs, count(*) as raw_rows from n group by 1"""))
def _(spark, sf_dir):
    return O.backfill_tables(S.backfill_audit(spark, sf_dir), S.raw_counts(spark, sf_dir).groupBy(F.col("table").alias("table_name")).agg(F.sum("rows").alias("raw_rows")))


@query("pipeline_freshness", Q.of(f"select max(filing_date) as last_walk_day, max(filing_date) as last_filing_date_in_raw, max(filing_date) as last_filing_date_in_core from filings {_WALK}"))
def _(spark, sf_dir):
    df = O.pipeline_freshness(S.audit_runs(spark, sf_dir), S.walk_records(spark, sf_dir), tables(spark, sf_dir).filings)
    return df.select("last_walk_day", "last_filing_date_in_raw", "last_filing_date_in_core")


#: Times at which the sources' freshness is read: filings and audit records pass, warn and fail at some of them.
_READ_AT = ("2024-02-01 18:00:00", "2024-02-04 08:00:00", "2024-02-05 10:00:00")
_SOURCE = "case event_type when 'view' then 'filings' when 'error' then 'audit' else event_type end"
_STATES = ", ".join(
    f"case when source not in ('filings', 'audit') then 'unknown' when age_{k} > case source when 'filings' then 124 else 54 end then 'error' when age_{k} > case source when 'filings' then 100 else 30 end then 'warn' else 'pass' end as state_{k}"
    for k in range(3)
)


@query("source_freshness", f"select source, loaded_at, {_STATES} from (select source, loaded_at, {', '.join(f"(epoch(timestamp '{t}') - epoch(loaded_at)) / 3600 as age_{k}" for k, t in enumerate(_READ_AT))} from (select {_SOURCE} as source, max(ts) as loaded_at from events group by 1))")
def _(spark, sf_dir):
    loads = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.expr(_SOURCE).alias("source"), F.col("ts").alias("loaded_at"))
    out = None
    for k, at in enumerate(_READ_AT):
        own = O.source_freshness(loads, F.lit(at).cast("timestamp")).withColumnRenamed("state", f"state_{k}").drop("age_hours")
        out = own if out is None else out.join(own.drop("loaded_at"), "source")
    return out


# Profiles, reconciliation and ingest plans.


@query("submission_profile", Q.of("select count(*) as filings, count(distinct cik) as filers, min(filing_date) as first_filed, max(filing_date) as last_filed, min(period_of_report) as first_period, max(period_of_report) as last_period from filings"))
def _(spark, sf_dir):
    return P.submission_profile(tables(spark, sf_dir).filings)


@query("submission_types", Q.of("select 'submission type' as what, submission_type as value, count(*) as n from filings group by 2"))
def _(spark, sf_dir):
    return P.histogram(tables(spark, sf_dir).filings, F.col("submission_type"), "submission type")


@query("cover_histograms", Q.of("select 'amendment box' as what, coalesce(case when cover_is_amendment then 'Y' when not cover_is_amendment then 'N' end, '(blank)') as value, count(*) as n from filings group by 2 union all select 'amendment type', coalesce(amendment_type, '(blank)'), count(*) from filings group by 2 union all select 'report type', coalesce(report_type, '(blank)'), count(*) from filings group by 2"))
def _(spark, sf_dir):
    return P.cover_histograms(tables(spark, sf_dir).filings)


@query("holdings_profile", Q.of("select count(*) as rows, cast(sum(value_as_filed) as bigint) as value_sum, min(value_as_filed) as value_min, max(value_as_filed) as value_max, cast(0 as bigint) as bad_values, round(count(*) filter (where value_as_filed < 1000) / count(*), 4) as share_below_1000, round(count(figi) / count(*), 4) as figi_share, (list(value_as_filed order by value_as_filed))[count(*) // 2 + 1] as value_upper_median from raw_holdings"))
def _(spark, sf_dir):
    return P.holdings_profile(tables(spark, sf_dir).holdings.select(F.col("value_as_filed").cast("string").alias("value"), "figi"))


_SET = f"concat('set', cast(k % {S.FILES} as string))"


def _by_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings as their text columns say it, with a data set."""
    text = {"value": "value_as_filed", "figi": "figi", "sshprnamttype": "shares_or_principal_amount_type", "putcall": "put_call"}
    return tables(spark, sf_dir).holdings.select(F.expr(_SET).alias("dataset"), *[F.col(c).cast("string").alias(t) for t, c in text.items()])


@query("holdings_profile_by_data_set", Q.of(f"select {_SET} as dataset, count(*) as rows, cast(sum(value_as_filed) as bigint) as value_sum, min(value_as_filed) as value_min, max(value_as_filed) as value_max, cast(0 as bigint) as bad_values, round(count(*) filter (where value_as_filed < 1000) / count(*), 4) as share_below_1000, round(count(figi) / count(*), 4) as figi_share, (list(value_as_filed order by value_as_filed))[count(*) // 2 + 1] as value_upper_median from raw_holdings group by 1"))
def _(spark, sf_dir):
    return P.holdings_profiles(_by_set(spark, sf_dir))


@query("holdings_histograms", Q.of(f"select {_SET} as dataset, 'amount type' as what, coalesce(shares_or_principal_amount_type, '(blank)') as value, count(*) as n from raw_holdings group by 1, 3 union all select {_SET}, 'put or call', coalesce(put_call, '(blank)'), count(*) from raw_holdings group by 1, 3"))
def _(spark, sf_dir):
    return P.holdings_histograms(_by_set(spark, sf_dir))


_ENTRIES = "(select accession_number, count(*) as e from raw_holdings group by 1)"


@query("filer_index", Q.of(f"select cik, period_of_report, string_agg(concat(accession_number, ' ', submission_type, ' ', coalesce(amendment_type, '-'), ' ', cast(coalesce(e, 0) as string)), ';' order by filing_date, accession_number) as filings from filings left join {_ENTRIES} using (accession_number) group by 1, 2"))
def _(spark, sf_dir):
    t = tables(spark, sf_dir)
    entries = t.holdings.groupBy("accession_number").agg(F.count(F.lit(1)).alias("entries"))
    text = F.transform("filings", lambda f: F.concat_ws(" ", f["accession_number"], f["submission_type"], F.coalesce(f["amendment_type"], F.lit("-")), f["entries"].cast("string")))
    return P.filer_index(t.filings, entries).select("cik", "period_of_report", F.array_join(text, ";").alias("filings"))


@query("candidate_filers", Q.of(f"""
  , p as (select cik, period_of_report, count(*) as reports, count(*) filter (where amendment_type = 'RESTATEMENT') as r, count(*) filter (where amendment_type = 'NEW HOLDINGS') as a, max(coalesce(e, 0)) as l from filings left join {_ENTRIES} using (accession_number) where submission_type like '13F-HR%' group by 1, 2),
  c as (select cik, count(*) as periods, count(*) filter (where reports >= 2) as messy, cast(sum(r) as bigint) as restatements, cast(sum(a) as bigint) as additions, max(l) as largest from p group by 1)
  select *, messy * 10 + case when restatements > 0 and additions > 0 then 5 else 0 end as score from c where largest between 3 and 3000 order by score desc, periods desc, cik limit 10"""))
def _(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.candidate_filers(t.filings, t.holdings.groupBy("accession_number").agg(F.count(F.lit(1)).alias("entries")), least=3)


@query("reconcile_filing_totals", Q.of("select accession_number, table_entry_total, table_value_total_as_filed, coalesce(n, 0) as entries, cast(coalesce(v, 0) as bigint) as value, case when table_entry_total is not null and table_value_total_as_filed is not null then table_entry_total = coalesce(n, 0) and table_value_total_as_filed = coalesce(v, 0) end as matches from filings left join totals using (accession_number)", "totals"))
def _(spark, sf_dir):
    t = tables(spark, sf_dir)
    return R.reconcile_filing_totals(t.filings, t.holdings)


@query("reconcile_loads", Q.of("select cik, n as expected_rows, nullif(m, 0) as loaded_rows from (select cik, count(*) as n, count(*) filter (where k % 50 <> 0) as m from filings group by 1) where n is distinct from nullif(m, 0)"))
def _(spark, sf_dir):
    f = tables(spark, sf_dir).filings
    count = lambda df: df.groupBy("cik").agg(F.count(F.lit(1)).alias("rows"))
    return R.reconcile_loads(count(f), count(f.where("k % 50 <> 0")), ["cik"])


@query("load_mismatches", Q.of("select cik, n as extracted_rows, m as loaded_rows from (select cik, count(*) as n, count(*) filter (where k % 50 <> 0) as m from filings group by 1) where n <> m and m > 0"))
def _(spark, sf_dir):
    f = tables(spark, sf_dir).filings
    count = lambda df: df.groupBy("cik").agg(F.count(F.lit(1)).alias("rows"))
    return R.load_mismatches(count(f), count(f.where("k % 50 <> 0")), ["cik"])


@query("missing_days", Q.of("select distinct filing_date as day from filings where filing_date between date '2025-05-01' and date '2025-05-08' and day(filing_date) % 2 = 0"))
def _(spark, sf_dir):
    days = tables(spark, sf_dir).filings.select(F.col("filing_date").alias("day")).distinct()
    return ingest.missing_days(days, days.where("day(day) % 2 <> 0"), "2025-05-08", "2025-01-01")


@query("filing_ingest_status", Q.of("select accession_number, submission_type as form_type, case when k % 7 = 0 then 'parsed' when k % 5 <> 0 and (submission_type like '13F-NT%' or k % 3 <> 0) then 'to parse' else 'not landed' end as status from filings"))
def _(spark, sf_dir):
    f = tables(spark, sf_dir).filings
    documents = f.where("k % 5 <> 0").select("accession_number", F.lit("cover").alias("kind")).unionByName(f.where("k % 3 <> 0").select("accession_number", F.lit("table").alias("kind")))
    return ingest.filing_ingest_status(f.select("accession_number", F.col("submission_type").alias("form_type")), documents, f.where("k % 7 = 0"))


# Expectations.


@query("expect_unique", "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1")
def _(spark, sf_dir):
    return expect.unique(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey", "l_linenumber")


@query("expect_not_null", Q.of("select accession_number from filings where amendment_type is null or filing_manager_name is null"))
def _(spark, sf_dir):
    return expect.not_null(tables(spark, sf_dir).filings, "amendment_type", "filing_manager_name").select("accession_number")


@query("expect_accepted_values", Q.of("select accession_number, amendment_type from filings where amendment_type not in ('RESTATEMENT')"))
def _(spark, sf_dir):
    return expect.accepted_values(tables(spark, sf_dir).filings, "amendment_type", "RESTATEMENT").select("accession_number", "amendment_type")


@query("expect_relationship", Q.of("select accession_number from filings where accession_number not in (select accession_number from raw_holdings)"))
def _(spark, sf_dir):
    t = tables(spark, sf_dir)
    return expect.relationship(t.filings, "accession_number", t.holdings, "accession_number").select("accession_number")


@query("expect_covered_both_ways", Q.of("select accession_number, 'left' as only_in from filings where k % 50 = 0 union all select accession_number, 'right' from filings where k % 60 = 0 and k % 50 <> 0 and false"))
def _(spark, sf_dir):
    f = tables(spark, sf_dir).filings
    return expect.covered_both_ways(f, f.where("k % 50 <> 0"), "accession_number")


#: Lineage rows with faults: some filers lack their effective filing, some filings are said to be superseded besides.
_NO_EFFECTIVE, _SUPERSEDED = "not (coalesce(filing_position = effective_position, false) and substring(cik, 10, 1) = '3')", "(is_superseded or filing_position % 3 = 0)"


@query("expect_one_effective_filing", Q.of(f"select cik, period_of_report from lineage where {_NO_EFFECTIVE} group by 1, 2 having count(*) filter (where filing_position = effective_position) <> case when count(*) filter (where filing_role in ('original', 'restatement')) > 0 then 1 else 0 end", "lineage"))
def _(spark, sf_dir):
    return expect.one_effective_filing(tables(spark, sf_dir).lineage_filings.where(_NO_EFFECTIVE)).select(*L.LINEAGE)


@query("expect_consistent_states", Q.of(f"select accession_number from (select * exclude (is_superseded), {_SUPERSEDED} as is_superseded from lineage) where (is_superseded and is_contributing) or (filing_role = 'notice' and (is_superseded or is_contributing)) or (filing_role <> 'notice' and not is_superseded and not is_contributing)", "lineage"))
def _(spark, sf_dir):
    return expect.consistent_states(tables(spark, sf_dir).lineage_filings.withColumn("is_superseded", F.expr(_SUPERSEDED))).select("accession_number")


@query("expect_symmetric_difference", Q.of("select cik, period_of_report, 'actual' as only_in from filings where k % 50 = 0"))
def _(spark, sf_dir):
    f = tables(spark, sf_dir).filings
    return expect.symmetric_difference(f.select(*L.LINEAGE), f.where("k % 50 <> 0").select(*L.LINEAGE))


@query("expect_balance", Q.of("select accession_number from filings left join totals using (accession_number) where table_entry_total is distinct from coalesce(n, 0)", "totals"))
def _(spark, sf_dir):
    t = tables(spark, sf_dir)
    return expect.balance(R.reconcile_filing_totals(t.filings, t.holdings), "table_entry_total", "entries").select("accession_number")


@query("expect_pinned_counts", Q.of("select check_name, expected, actual from (select 'second_original' as check_name, cast(-1 as bigint) as expected, count(*) as actual from dq where check_name = 'second_original') where actual <> expected", "dq"))
def _(spark, sf_dir):
    return expect.pinned_counts(quality.check_counts(tables(spark, sf_dir).data_quality_rows), {"second_original": -1})


@query("expect_pinned_counts_without_walk", Q.of("select check_name, expected, actual from (select 'second_original' as check_name, cast(-1 as bigint) as expected, count(*) as actual from dq where check_name = 'second_original' and not exists (select 1 from filings f where f.origin = 'walk' and f.cik = dq.cik and f.period_of_report = dq.period_of_report)) where actual <> expected", "dq"))
def _(spark, sf_dir):
    t = tables(spark, sf_dir)
    return expect.pinned_counts(quality.check_counts(expect.untouched(t.data_quality_rows, t.filings)), {"second_original": -1})


# Streams and incremental recomputation.


@query("stream_filing_records", Q.of(f"select 'cover' as record_type, count(*) as n from filings {_WALK} union all select 'holding', count(*) from raw_holdings {_WALK}"))
def _(spark, sf_dir):
    return S.streamed(spark, sf_dir).groupBy("record_type").agg(F.count(F.lit(1)).alias("n"))


@query("recomputed_lineages", Q.of("select * from lineage", "lineage"))
def _(spark, sf_dir):
    from quarterdeck.streaming.ingest import affected_lineages, recompute_lineages

    t = tables(spark, sf_dir)
    old = t.filings.where("k % 20 <> 0")
    before = L.lineage_filings(old, L.addition_coverage(old, t.holdings))
    return recompute_lineages(affected_lineages(t.filings.where("k % 20 = 0")), t.filings, t.holdings, before)


# The build taken in batch by batch: data sets first, then two batches of the walk's files, of which the last is replayed.


@query("incremental_value_units", ORACLES["filing_value_units"])
def _(spark, sf_dir):
    return S.incremental(spark, sf_dir).filing_value_units.select("accession_number", "filing_date", "median_value_per_share", "filing_date_unit", "value_unit", "value_multiplier")


@query("incremental_lineages", ORACLES["lineage_filings"])
def _(spark, sf_dir):
    return S.incremental(spark, sf_dir).lineage_filings


@query("incremental_addition_coverage", ORACLES["addition_coverage"])
def _(spark, sf_dir):
    return rounded(S.incremental(spark, sf_dir).addition_coverage, "coverage")


@query("incremental_canonical_holdings", ORACLES["canonical_holdings"])
def _(spark, sf_dir):
    return S.incremental(spark, sf_dir).canonical_holdings.select("cik", "period_of_report", "accession_number", "filing_role", "origin", "holding_key", "cusip", "value_usd")


@query("incremental_securities", ORACLES["securities"])
def _(spark, sf_dir):
    return S.incremental(spark, sf_dir).securities


@query("incremental_positions", ORACLES["positions"])
def _(spark, sf_dir):
    return S.incremental(spark, sf_dir).positions


@query("incremental_filer_periods", ORACLES["filer_periods"])
def _(spark, sf_dir):
    return rounded(S.incremental(spark, sf_dir).filer_periods, "top_ten_share", "hhi")


@query("incremental_position_changes", ORACLES["position_changes"])
def _(spark, sf_dir):
    return S.incremental(spark, sf_dir).position_changes


@query("cusip_check_digits",Q.of("select cusip, is_well_formed, has_valid_check_digit from securities", "securities"))
def _(spark, sf_dir):
    return tables(spark, sf_dir).securities.select("cusip", "is_well_formed", "has_valid_check_digit")


@query("portfolio_concentration", Q.of("select cik, period_of_report, round(top_ten_share, 9) as top_ten_share, round(hhi, 9) as hhi from filer_periods", "filer_periods"))
def _(spark, sf_dir):
    return rounded(marts.portfolios(tables(spark, sf_dir).positions), "top_ten_share", "hhi").select(*L.LINEAGE, "top_ten_share", "hhi")


# Rules in the scan that writes a table, layers of a stored build, and keys of landed files.

#: Rules of rows by table, as what breaks them; the oracle counts the same by SQL of its own.
RULES = {
    "filings": {"no cover": expect.missing("filing_manager_name"), "no cover period": expect.missing("report_calendar_or_quarter"), "other origin": expect.not_among("origin", "data_set", "walk")},
    "lineage_filings": {"other role": expect.not_among("filing_role", "original", "restatement", "addition", "notice"), "neither superseded nor contributing": "not is_superseded and not is_contributing", "no base": expect.missing("effective_position")},
    "holdings": {"no identifier": expect.missing("figi"), "an option or no amount": "put_call is not null or shares_or_principal_amount is null", "not in dollars": expect.not_among("value_unit", "dollars")},
    "position_changes": {"other kind": expect.not_among("change_kind", "entry", "exit", "increase", "decrease", "unchanged", "not comparable"), "no change of amount": expect.missing("amount_change")},
}
_SAME_RULES = {
    ("filings", "filings"): {"no cover": "filing_manager_name is null", "no cover period": "report_calendar_or_quarter is null", "other origin": "origin <> 'data_set' and origin <> 'walk'"},
    ("lineage_filings", "lineage"): {"other role": "filing_role <> 'original' and filing_role <> 'restatement' and filing_role <> 'addition' and filing_role <> 'notice'", "neither superseded nor contributing": "not (is_superseded or is_contributing)", "no base": "effective_position is null"},
    ("holdings", "holdings"): {"no identifier": "figi is null", "an option or no amount": "coalesce(put_call, '') <> '' or shares_or_principal_amount is null", "not in dollars": "value_unit <> 'dollars'"},
    ("position_changes", "changes"): {"other kind": "change_kind not in ('entry', 'exit', 'increase', 'decrease', 'unchanged', 'not comparable')", "no change of amount": "amount_change is null"},
}
_COUNTED = " union all ".join(
    f"select '{table}' as table_name, '{name}' as rule, count(*) as n from {source} where {broken}" for (table, source), rules in _SAME_RULES.items() for name, broken in ({"rows": "true"} | rules).items()
)


@query("rules_of_written_tables", Q.of(_COUNTED, "lineage", "holdings", "changes"))
def _(spark, sf_dir):
    counted = {}

    def checked(table: str) -> Callable[[DataFrame], DataFrame]:
        def store(df: DataFrame) -> DataFrame:
            out, counted[table] = written_checked(df, f"checked-{table}", RULES[table], BUCKETED.get(table, ()))
            return out

        return store

    filings, as_filed = _given(spark, sf_dir)
    t = build(filings, as_filed, write=True, stores={table: checked(table) for table in RULES})
    for table in RULES:
        getattr(t, table)
    rows = [(table, rule, n) for table in RULES for rule, n in counted[table].items()]
    return spark.createDataFrame(rows, "table_name string, rule string, n long")


_NAMED = ", ".join(f"case when {broken} then '{name}' end" for name, broken in _SAME_RULES["filings", "filings"].items())


@query("filings_that_break_rules", Q.of(f"select accession_number, broken from (select accession_number, concat_ws('; ', {_NAMED}) as broken from filings) where broken <> ''"))
def _(spark, sf_dir):
    return expect.broken_rows(tables(spark, sf_dir).filings, RULES["filings"]).select("accession_number", F.array_join("broken", "; ").alias("broken"))


_CTE_OF = {"filing_value_units": "units", "addition_coverage": "coverage", "lineage_filings": "lineage", "canonical_holdings": "canonical", "data_quality_rows": "dq", "position_changes": "changes", "filer_overlaps": "overlapping"}


@query("stored_layers", Q.of(" union all ".join(f"select '{layer}' as layer, '{name}' as table_name, count(*) as n from {_CTE_OF.get(name, name)}" for layer, names in LAYERS.items() for name in names), *[n for n in Q.CORE if n in {_CTE_OF.get(x, x) for names in LAYERS.values() for x in names}]))
def _(spark, sf_dir):
    prefix, out = f"build_{uuid.uuid4().hex[:12]}_", None
    for layer, name in build_layers(spark, *_given(spark, sf_dir), prefix, shared_folder(spark)):
        part = spark.table(f"{prefix}{layer}.{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


_FILED = "filed=' || strftime(filing_date, '%Y-%m-%d') || '/"


@query("landing_keys", Q.of(f"""
  select accession_number, 'raw/edgar/index/form.' || strftime(filing_date, '%Y%m%d') || '.idx' as index_key,
    'raw/edgar/filings/{_FILED}' || accession_number || '/primary_doc.xml' as cover_key, 'raw/edgar/filings/{_FILED}' || accession_number || '/infotable.xml' as table_key,
    'parsed/edgar/filings/{_FILED}' || accession_number || '.jsonl' as parsed_key,
    'raw/edgar/audit/walk/day=' || strftime(filing_date, '%Y-%m-%d') || '/walk--' || regexp_replace(submission_type, '[^A-Za-z0-9_.-]', '-', 'g') || '-/' || strftime(filing_date, '%Y-%m-%d') || 'T06-00.json' as walk_key,
    'raw/sec/audit/backfill/walk--' || regexp_replace(submission_type, '[^A-Za-z0-9_.-]', '-', 'g') || '-/' || strftime(filing_date, '%Y-%m-%d') || 'T06-00.json' as backfill_key,
    'raw/sec/datasets/' || year(filing_date) || 'q' || quarter(filing_date) || '_form13f.zip' as archive_key,
    'extracted/sec/datasets/table=SUBMISSION/' || year(filing_date) || 'q' || quarter(filing_date) || '.tsv.gz' as extracted_key,
    year(filing_date) || '/QTR' || quarter(filing_date) as quarter_path
  from filings"""))
def _(spark, sf_dir):
    quarter = F.concat(F.year("filing_date").cast("string"), F.lit("q"), F.quarter("filing_date").cast("string"))
    f = tables(spark, sf_dir).filings.withColumns({
        "run": F.concat(F.lit("walk: "), "submission_type", F.lit("+")), "at": F.concat(F.col("filing_date").cast("string"), F.lit("T06:00")), "set": quarter, "zip": F.concat(quarter, F.lit("_form13f.zip")),
    })
    return f.select(
        "accession_number", K.index_key("filing_date").alias("index_key"), K.filing_file_key("filing_date", "accession_number", K.COVER_NAME).alias("cover_key"),
        K.filing_file_key("filing_date", "accession_number", K.TABLE_NAME).alias("table_key"), K.parsed_key("filing_date", "accession_number").alias("parsed_key"),
        K.walk_audit_key("filing_date", "run", "at").alias("walk_key"), K.backfill_audit_key("run", "at").alias("backfill_key"), K.archive_key("zip").alias("archive_key"),
        K.extracted_key(F.lit("SUBMISSION"), "set").alias("extracted_key"), C.quarter_path("filing_date").alias("quarter_path"),
    )
