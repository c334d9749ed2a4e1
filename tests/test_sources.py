"""Readers, sinks, staging, ingest plans and streams on small files."""

import datetime as dt
import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import expect, ingest, observability, profile, staging
from quarterdeck.sources import datasets, filing_xml, indexes, records
from quarterdeck.streaming import ingest as streams


def tsv(path, table, rows):
    header = "\t".join(datasets.TABLES[table]).upper()
    with gzip.open(path, "wt") as f:
        f.write("\n".join([header, *("\t".join(r) for r in rows)]) + "\n")


def test_tsv_is_literal_and_numbered(spark, tmp_path):
    tsv(tmp_path / "a.tsv.gz", "SUBMISSION", [('a"1', "30-JUN-2018", "13F-HR", "7", "31-MAR-2018"), ("b\\t", "", "13F-NT", "8", "31-MAR-2018")])
    df = datasets.read_dataset_table(spark, str(tmp_path), "SUBMISSION", row_numbers=True, content_keys=True)
    rows = df.orderBy("source_row").collect()
    assert [(r.accession_number, r.filing_date, r.source_row) for r in rows] == [('a"1', "30-JUN-2018", 1), ("b\\t", None, 2)]
    assert len(rows[0].source_content_key) == 32 and rows[0].source_file.endswith("a.tsv.gz")
    assert datasets.header_violations(spark, str(tmp_path), "SUBMISSION").count() == 0
    assert staging.submissions(df).orderBy("cik").first().cik == "0000000007"


def test_ragged_rows_and_headers(spark, tmp_path):
    tsv(tmp_path / "a.tsv.gz", "SUBMISSION", [("a", "b")])
    assert datasets.ragged_rows(spark, str(tmp_path)).first().fields == 2
    with pytest.raises(Exception):
        datasets.read_dataset_table(spark, str(tmp_path), "SUBMISSION").collect()
    assert datasets.header_violations(spark, str(tmp_path), "COVERPAGE").count() == 1


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "2013q2_form13f.zip", "w") as z:
        for t in datasets.TABLES:
            z.writestr(f"nested/{t}.tsv", "\t".join(datasets.TABLES[t]).upper() + "\nx\ty" + ("\nlast" if t == "SIGNATURE" else "\n"))
    lines = datasets.extract_archives(spark, str(tmp_path / "*.zip"))
    counts = {r.table: r.rows for r in datasets.write_extracted(lines, str(tmp_path / "out")).collect()}
    assert counts == {t: 2 if t == "SIGNATURE" else 1 for t in datasets.TABLES}
    assert spark.read.text(str(tmp_path / "out/tables")).count() == 15
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as z:
        z.writestr("SUBMISSION.tsv", "x")
    with pytest.raises(Exception, match="COVERPAGE"):
        datasets.extract_archives(spark, str(tmp_path / "bad.zip")).collect()


def test_archives_of_any_size_are_read_a_member_a_task(spark, tmp_path):
    """More than a cell can hold: 2.2 GB in one member, in long lines, read in blocks."""
    n, width = 2200, 1 << 20
    path = tmp_path / "large 2013q3_form13f.zip"
    try:
        with zipfile.ZipFile(path, "w") as z:
            for t in datasets.TABLES:
                with z.open(f"{t}.tsv", "w", force_zip64=True) as f:
                    f.write(b"header\r\n")
                    for k in range(n if t == "INFOTABLE" else 3):
                        f.write(b"%07d" % k + b"x" * (width - 7 if t == "INFOTABLE" else 1) + b"\n")
        assert path.stat().st_size > 2**31
        lines = datasets.extract_archives(spark, str(tmp_path / "*.zip"))
        assert lines.rdd.getNumPartitions() == len(datasets.TABLES)
        per_task = lines.select(F.spark_partition_id().alias("task"), "table").distinct().groupBy("task").count()
        assert [r["count"] for r in per_task.collect()] == [1] * len(datasets.TABLES)
        found = lines.groupBy("dataset", "table").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("size"), F.sum((F.substring("line", 1, 7) == F.lpad((F.col("line_no") - 1).cast("string"), 7, "0")).cast("int")).alias("numbered"))
        got = {(r.dataset, r.table): (r.n, r["size"], r.numbered) for r in found.collect()}
        assert got == {(path.stem, t): (n + 1, n * width + 6, n) if t == "INFOTABLE" else (4, 3 * 8 + 6, 3) for t in datasets.TABLES}
    finally:
        path.unlink()


def test_archives_by_another_opener(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for t in datasets.TABLES:
            z.writestr(f"{t}.tsv", "h\n" + "\n".join(f"{t}{k}" for k in range(7)) + "\n")
    lines = datasets.extract_archives(spark, str(tmp_path), block=3, opener=lambda p: open(p.removeprefix("file:"), "rb"))
    got = sorted((r.table, r.line_no, r.line) for r in lines.collect())
    assert got == sorted((t, k, "h" if k == 0 else f"{t}{k - 1}") for t in datasets.TABLES for k in range(8))
    packed = datasets.unpack_archives(spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content"), block=2)
    assert sorted((r.table, r.line_no, r.line) for r in packed.collect()) == got
    with pytest.raises(ValueError, match="opener"):
        datasets.open_path("unheardof://store/a.zip")


def test_catalog(spark):
    links = spark.createDataFrame([("/x/01jan2024-29feb2024_form13f.zip",), ("/x/2013q2_form13f.zip",), ("/x/31feb2024-01mar2024_form13f.zip",), ("/x/other.zip",)], "link string")
    got = {r.dataset: (r["first"], r["last"]) for r in datasets.catalog(links).collect()}
    assert got["2013q2_form13f"] == (dt.date(2013, 4, 1), dt.date(2013, 6, 30))
    assert got["01jan2024-29feb2024_form13f"] == (dt.date(2024, 1, 1), dt.date(2024, 2, 29))
    assert got["31feb2024-01mar2024_form13f"] == (None, None) and got["other"] == (None, None)
    w = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 2, 29)), (dt.date(2024, 3, 1), dt.date(2024, 5, 31)), (dt.date(2024, 6, 2), dt.date(2024, 8, 31))], "first date, last date")
    assert datasets.untiled(w).count() == 1


def line(accession, kind, record):
    return json.dumps({"accession": accession, "record": record, "record_type": kind, "source_key": "k"})


def test_filing_records_are_file_atomic_and_latest(spark, tmp_path):
    day = tmp_path / "filed=2026-08-14"
    day.mkdir()
    (day / "good.jsonl").write_text(line("a", "cover", {"cik": 7, "submission_type": "13F-HR/A", "is_amendment": True}) + "\n" + line("a", "holding", {"row_index": 1, "cusip": "X", "other_managers": [1, 2]}) + "\n\n")
    (day / "bad.jsonl").write_text(line("b", "cover", {}) + "\n{broken\n")
    files = records.whole_files(spark, str(tmp_path / "*"))
    raw = records.filing_records(files)
    assert raw.count() == 2 and records.rejected_files(files).first().bad_lines == 1
    staged = staging.filing_records(raw)
    assert staged.first().filing_date == dt.date(2026, 8, 14)
    assert staging.xml_cover_pages(staged).first().cik == "0000000007"
    assert staging.xml_holdings(staged).first().other_manager_sequence_numbers == [1, 2]
    again = raw.withColumns({"source_content_key": F.lit("z"), "source_last_modified": F.col("source_last_modified") + F.expr("interval 1 day")}).where("source_row = 1")
    assert [r.source_content_key for r in staging.filing_records(raw.unionByName(again)).collect()] == ["z"]


def test_audit_staging(spark):
    record = {"run_id": "r", "day": "2026-01-05", "recorded_at": "2026-01-06T00:00:00Z", "published": True, "discovered": 3, "days": {"2026-01-05": {"key": "k", "discovered": 3, "by_form": {"13F-HR": 2}}}, "failed": [{"accession": "a", "form_type": "13F-HR", "error": "e"}]}
    files = spark.createDataFrame([(json.dumps(record), "f", "k1", None), (json.dumps(record), "f", "k2", None), ("not json", "g", "k", None)], "content string, source_file string, source_content_key string, source_last_modified timestamp")
    audit = records.audit_records(files)
    run = staging.walk_runs(audit).collect()
    assert len(run) == 1 and (run[0].discovered, run[0].landing_failures, run[0].parse_failures, run[0].parsed) == (3, 1, None, None)
    day = staging.walk_days(audit).first()
    assert (day.walk_day, day.holdings_reports, day.notices) == (dt.date(2026, 1, 5), 2, 0)
    assert [(r.failure_stage, r.accession_number) for r in staging.walk_failures(audit).collect()] == [("land", "a")]


INDEX = "Description: x\n\nForm Type   Company Name\n" + "-" * 40 + "\n13F-HR      A  B  CAPITAL, L.P.          123         20260105    edgar/data/123/0000000123-26-000001.txt\n8-K         OTHER CO   9   20260105   edgar/data/9/0000000009-26-000001.txt\n"


def test_index(spark):
    files = spark.createDataFrame([("good", INDEX.encode("latin-1")), ("bad", (INDEX + "4 broken row\n").encode()), ("empty", INDEX.split("13F")[0].encode())], "path string, content binary")
    rows = indexes.index_entries(files.where("path = 'good'")).collect()
    assert [(r.form_type, r.company, r.cik, r.filed, r.accession_number) for r in rows] == [("13F-HR", "A  B  CAPITAL, L.P.", "0000000123", dt.date(2026, 1, 5), "0000000123-26-000001")]
    assert indexes.index_entries(files.where("path = 'good'"), None).count() == 2
    assert [(r.source_file, r.line_no) for r in indexes.index_errors(files).collect()] == [("bad", 7)]
    assert indexes.index_entries(files.where("path = 'empty'"), None).count() == 0


def test_listings(spark):
    listing = lambda *names: json.dumps({"directory": {"item": [{"name": n} for n in names]}})
    days = spark.createDataFrame([(listing("form.20260105.idx", "form.20261399.idx", "company.20260106.idx"),)], "listing string")
    assert [r.day for r in indexes.published_days(days).collect()] == [dt.date(2026, 1, 5)]
    rows = [("a", "13F-HR", listing("primary_doc.xml", "table.xml", "x.txt")), ("b", "13F-NT", listing("primary_doc.xml")), ("c", "13F-HR", listing("table.xml")), ("d", "13F-HR", listing("primary_doc.xml", "t1.xml", "t2.xml")), ("e", "13F-NT", listing("primary_doc.xml", "t.xml"))]
    got = {r.accession_number: (r.table, r.error) for r in indexes.filing_documents(spark.createDataFrame(rows, "accession_number string, form_type string, listing string")).collect()}
    assert got["a"] == ("table.xml", None) and got["b"] == (None, None) and all(got[x][1] for x in "cde")


COVER = """<?xml version="1.0"?><edgarSubmission xmlns="u" xmlns:com="v"><headerData><submissionType>{kind}</submissionType><filerInfo><filer><credentials><cik>0000000123</cik></credentials></filer><periodOfReport>03-31-2024</periodOfReport></filerInfo></headerData>
<formData><coverPage><reportCalendarOrQuarter>03-31-2024</reportCalendarOrQuarter><isAmendment>{box}</isAmendment>{info}<filingManager><name>F</name><address><com:street1>S</com:street1></address></filingManager><reportType>13F HOLDINGS REPORT</reportType></coverPage>{summary}</formData></edgarSubmission>"""
ROW = "<n:infoTable><n:nameOfIssuer></n:nameOfIssuer><n:titleOfClass>COM</n:titleOfClass><n:cusip>{cusip}</n:cusip><n:value>{value}</n:value><n:shrsOrPrnAmt><n:sshPrnamt>2</n:sshPrnamt><n:sshPrnamtType>SH</n:sshPrnamtType></n:shrsOrPrnAmt><n:investmentDiscretion>SOLE</n:investmentDiscretion><n:otherManager>1,2</n:otherManager><n:votingAuthority><n:Sole>1</n:Sole><n:Shared>0</n:Shared><n:None>0</n:None></n:votingAuthority></n:infoTable>"


def table(*rows):
    return '<n:informationTable xmlns:n="t">' + "".join(ROW.format(cusip=c, value=v) for c, v in rows) + "</n:informationTable>"


def test_xml(spark):
    total = "<summaryPage><tableEntryTotal>1</tableEntryTotal><tableValueTotal>5</tableValueTotal></summaryPage>"
    amended = "<amendmentNo>1</amendmentNo><amendmentInfo><amendmentType>RESTATEMENT</amendmentType></amendmentInfo>"
    covers = [("ok", COVER.format(kind="13F-HR", box="false", info="", summary=total)), ("gap", COVER.format(kind="13F-HR/A", box="Y", info=amended, summary=total)), ("box", COVER.format(kind="13F-HR/A", box="false", info="", summary="<summaryPage/>")), ("root", "<other/>"), ("broken", "<edgarSubmission><a></edgarSubmission>"), ("row", COVER.format(kind="13F-HR", box="0", info="", summary=""))]
    tables = [("ok", table(("037833100", 5))), ("gap", table(("037833100", 5), ("037833100", 5))), ("row", table(("037833100", 5), ("03783-100", 5), ("x", -1)))]
    frame = lambda rows: spark.createDataFrame(rows, "accession_number string, xml string")
    good, holdings, failed, gaps = ingest.parse_filings(frame(covers), frame(tables))
    assert sorted(r.accession_number for r in good.collect()) == ["gap", "ok"]
    assert [(r.row_index, r.name_of_issuer, r.other_managers) for r in holdings.where("accession_number = 'gap'").orderBy("row_index").collect()] == [(1, None, [1, 2]), (2, None, [1, 2])]
    errors = {r.accession_number: r.error for r in failed.collect()}
    assert set(errors) == {"box", "root", "broken", "row"} and errors["row"] == "row 2: cusip" and errors["root"] == "the root is not edgarSubmission"
    assert [r.accession_number for r in gaps.collect()] == ["gap"]
    page = {r.accession_number: r for r in filing_xml.cover_pages(frame(covers)).collect()}
    assert page["ok"].filing_manager_address.street1 == "S" and page["box"].table_entry_total is None and page["gap"].is_amendment


def test_plans(spark):
    day = lambda *ds: spark.createDataFrame([(dt.date(2026, 4, d),) for d in ds], "day date")
    assert [r.day.day for r in ingest.missing_days(day(1, 3, 8, 9, 10), day(3), "2026-04-09", "2026-04-02").orderBy("day").collect()] == [8, 9]
    now = F.lit("2026-01-10 00:00:00").cast("timestamp")
    loads = spark.createDataFrame([("filings", dt.datetime(2026, 1, 1)), ("audit", dt.datetime(2026, 1, 8, 12)), ("x", dt.datetime(2026, 1, 9))], "source string, loaded_at timestamp")
    assert {r.source: r.state for r in observability.source_freshness(loads, now).collect()} == {"filings": "error", "audit": "warn", "x": "unknown"}


def test_expectations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k long, v string")
    assert [tuple(r) for r in expect.unique(df, "k").collect()] == [(1, 2)]
    assert expect.not_null(df, "v").count() == 1 and expect.accepted_values(df, "v", "a").count() == 1
    assert expect.relationship(df, "v", df.where("k = 1"), "v").count() == 1
    assert expect.symmetric_difference(df, df.where("k <> 3").limit(3)).count() == 1
    assert expect.balance(df.withColumn("w", F.col("v")), "v", "w").count() == 0


def test_profiles(spark):
    rows = spark.createDataFrame([("1", None), ("5000", "f"), ("x", None), ("7", ""), ("2000", None)], "value string, figi string")
    r = profile.holdings_profile(rows).first()
    assert (r.rows, r.value_sum, r.value_min, r.value_max, r.bad_values, r.share_below_1000, r.figi_share, r.value_upper_median) == (5, 7008, 1, 5000, 1, 0.5, 0.2, 2000)
    assert profile.samples(spark.range(10).withColumn("g", F.col("id") % 2), "id", ["g"]).count() == 6


def test_streams_take_each_file_once(spark, tmp_path):
    src = tmp_path / "in" / "filed=2026-08-14"
    src.mkdir(parents=True)
    run = lambda: streams.ingest_filings(spark, str(tmp_path / "in" / "*"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    (src / "a.jsonl").write_text(line("a", "cover", {}) + "\n")
    run()
    run()
    (src / "b.jsonl").write_text(line("b", "cover", {}) + "\n{x\n")
    (src / "c.jsonl").write_text(line("c", "cover", {}) + "\n")
    run()
    got = staging.filing_records(streams.loaded_records(spark, str(tmp_path / "out")))
    assert sorted(r.accession_number for r in got.collect()) == ["a", "c"]


def test_row_numbers_and_headers_of_a_file_of_many_splits(spark, tmp_path):
    """Splits are read in an order of Spark's own: numbers and the header go by their places in the file."""
    lines = ["\t".join(datasets.TABLES["SUBMISSION"]).upper(), *(f"{k:020d}\t31-MAR-2024\t13F-HR\t{k}\t31-DEC-2023" for k in range(1, 4001))]
    lines[2000] += "\tmore"
    (tmp_path / "good").mkdir()
    (tmp_path / "good" / "a.tsv").write_text("\n".join(x.removesuffix("\tmore") for x in lines) + "\n")
    (tmp_path / "bad.tsv").write_text("\n".join(lines) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = datasets.read_dataset_table(spark, str(tmp_path / "good"), "SUBMISSION", row_numbers=True)
        assert spark.read.text(str(tmp_path / "good")).rdd.getNumPartitions() > 10 and "_split" not in df.columns
        rows = df.select("accession_number", "source_row").collect()
        assert len(rows) == 4000 and all(int(r.accession_number) == r.source_row for r in rows)
        assert datasets.header_violations(spark, str(tmp_path / "bad.tsv"), "SUBMISSION").collect() == []
        assert [(r.fields, r.expected) for r in datasets.ragged_rows(spark, str(tmp_path / "bad.tsv")).collect()] == [(6, 5)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
