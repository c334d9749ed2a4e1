"""Rules of lineages, holdings, dimensions and marts on hand-made rows."""

import datetime as dt
import random
from dataclasses import fields
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarterdeck.functions import columns as C
from quarterdeck.functions import cusip as S
from quarterdeck.functions.medians import medians
from quarterdeck.operators import dimensions, expect, holdings, lineage, marts, quality
from quarterdeck.plans.build import Tables, save

Q = dt.date(2024, 3, 31)
FILING = "accession_number string, cik string, period_of_report date, filing_date date, submission_type string, amendment_type string, amendment_no long"


def filings(spark, *rows):
    """(accession, filed day of May, type, amendment type, number)"""
    return spark.createDataFrame([(a, "1", Q, dt.date(2024, 5, d), t, at, n) for a, d, t, at, n in rows], FILING)


def cusips(spark, **held):
    return spark.createDataFrame([(a, c) for a, cs in held.items() for c in cs] or [("none", "x")], "accession_number string, cusip string")


def roles(spark, f, h=None):
    cover = lineage.addition_coverage(f, h if h is not None else cusips(spark))
    return {r.accession_number: (r.filing_position, r.filing_role, r.is_superseded, r.is_contributing) for r in lineage.lineage_filings(f, cover).collect()}


def test_restatement_supersedes(spark):
    got = roles(spark, filings(spark, ("a", 1, "13F-HR", None, None), ("b", 2, "13F-HR/A", "RESTATEMENT", 1)))
    assert got == {"a": (1, "original", True, False), "b": (2, "restatement", False, True)}


def test_addition_supplements(spark):
    got = roles(spark, filings(spark, ("a", 1, "13F-HR", None, None), ("b", 2, "13F-HR/A", "NEW HOLDINGS", 1)))
    assert got == {"a": (1, "original", False, True), "b": (2, "addition", False, True)}


def test_addition_before_restatement_is_superseded(spark):
    got = roles(spark, filings(spark, ("a", 1, "13F-HR", None, None), ("b", 2, "13F-HR/A", "NEW HOLDINGS", 1), ("c", 3, "13F-HR/A", "RESTATEMENT", 2)))
    assert got["b"] == (2, "addition", True, False) and got["c"][3]


def test_second_original_restates_and_untyped_restates(spark):
    got = roles(spark, filings(spark, ("a", 1, "13F-HR", None, None), ("b", 2, "13F-HR", None, None), ("c", 3, "13F-HR/A", None, 1)))
    assert [got[x][1] for x in "abc"] == ["original", "restatement", "restatement"] and got["c"][3]


def test_additions_only_all_contribute(spark):
    got = roles(spark, filings(spark, ("a", 1, "13F-HR/A", "NEW HOLDINGS", 1), ("b", 2, "13F-HR/A", "NEW HOLDINGS", 2)))
    assert got == {"a": (1, "addition", False, True), "b": (2, "addition", False, True)}


def test_notice_is_inert(spark):
    got = roles(spark, filings(spark, ("a", 1, "13F-HR", None, None), ("b", 2, "13F-NT/A", None, 1)))
    assert got["b"] == (2, "notice", False, False) and got["a"][3]


def test_order_within_a_date(spark):
    got = roles(spark, filings(spark, ("z", 1, "13F-HR", None, None), ("b", 1, "13F-HR/A", "RESTATEMENT", 2), ("c", 1, "13F-HR/A", "RESTATEMENT", 1)))
    assert [got[x][0] for x in "zcb"] == [1, 2, 3]


@pytest.mark.parametrize(("repeated", "restates"), [(9, True), (8, False)])
def test_nine_tenths_restate(spark, repeated, restates):
    f = filings(spark, ("a", 1, "13F-HR", None, None), ("b", 2, "13F-HR/A", "NEW HOLDINGS", 1))
    h = cusips(spark, a=[*map(str, range(10)), "0", "0"], b=[*map(str, range(repeated)), "new", "new2"])
    row = lineage.addition_coverage(f, h).first()
    assert (row.compared_accession_number, row.compared_securities, row.repeated_securities, row.is_read_as_restatement) == ("a", 10, repeated, restates)
    assert roles(spark, f, h)["b"][1] == ("restatement" if restates else "addition")


def test_coverage_without_compared_filing_and_of_two_resubmissions(spark):
    f = filings(spark, ("a", 1, "13F-HR/A", "NEW HOLDINGS", 1), ("b", 2, "13F-HR", None, None), ("c", 3, "13F-HR/A", "NEW HOLDINGS", 1), ("d", 4, "13F-HR/A", "NEW HOLDINGS", 2))
    got = {r.accession_number: (r.compared_accession_number, r.coverage) for r in lineage.addition_coverage(f, cusips(spark, b=["x"], c=["x"], d=["x"])).collect()}
    assert got == {"a": (None, None), "c": ("b", 1.0), "d": ("b", 1.0)}


HOLDING = "accession_number string, cusip string, put_call string, shares_or_principal_amount long, shares_or_principal_amount_type string, investment_discretion string, other_manager_sequence_numbers array<long>, n long"


def canonical(spark, f, rows):
    h = spark.createDataFrame([(a, c, p, s, "SH", "SOLE", m, k) for k, (a, c, p, s, m) in enumerate(rows)], HOLDING)
    chain = lineage.lineage_filings(f, lineage.addition_coverage(f, h.where("false")))
    return sorted(r.n for r in holdings.canonical_holdings(h, chain, f).collect())


def test_copies_of_an_addition_are_left_out(spark):
    f = filings(spark, ("a", 1, "13F-HR", None, None), ("b", 2, "13F-HR/A", "NEW HOLDINGS", 1))
    rows = [("a", "x", None, 5, [1, 2]), ("a", "x", None, 5, [1, 2]), ("b", "x", None, 5, [1, 2]), ("b", "x", None, 5, [2, 1]), ("b", "x", "Put", 5, [1, 2]), ("b", "y", None, 5, []), ("b", "y", None, 5, [])]
    assert canonical(spark, f, rows) == [0, 1, 3, 4, 5, 6]


def test_copies_of_superseded_filings_stay(spark):
    f = filings(spark, ("a", 1, "13F-HR", None, None), ("r", 2, "13F-HR/A", "RESTATEMENT", 1), ("b", 3, "13F-HR/A", "NEW HOLDINGS", 2))
    assert canonical(spark, f, [("a", "x", None, 5, []), ("b", "x", None, 5, [])]) == [1]


def test_cusips(spark):
    valid, wrong = ["037833100", "594918104", "G1151C101", "88160R101", "12345*@#7"], ["037833101", "88160R102", "12345*@#0"]
    malformed = ["03783310", "03783a100", "03783-100", "03783310A", "0378331000", "", None]
    df = spark.createDataFrame([(c,) for c in valid + wrong + malformed], "c string")
    got = [r[0] for r in df.select(S.has_valid_check_digit(F.col("c"))).collect()]
    assert got == [True] * 5 + [False] * 3 + [None] * 7


def test_units(spark):
    f = filings(spark, ("old", 1, "13F-HR", None, None), ("one", 1, "13F-HR", None, None), ("low", 1, "13F-HR", None, None), ("none", 1, "13F-HR", None, None))
    rows = [("one", "SH", 3, 3), ("one", "SH", 1, 1), ("low", "SH", 9, 10), ("none", "PRN", 1, 5), ("none", "SH", 1, 0)]
    h = spark.createDataFrame(rows, "accession_number string, shares_or_principal_amount_type string, value_as_filed long, shares_or_principal_amount long")
    got = {r.accession_number: (r.value_unit, r.value_multiplier) for r in holdings.filing_value_units(f, h).collect()}
    assert got == {"one": ("dollars", 1), "low": ("thousands", 1000), "none": ("dollars", 1)}


def test_periods_and_names(spark):
    days = [dt.date(2024, 6, 30), dt.date(2024, 3, 31), dt.date(2023, 12, 31), dt.date(2024, 6, 29), dt.date(2024, 2, 29)]
    got = {r.period_of_report: r.previous_period for r in dimensions.periods(spark.createDataFrame([(d,) for d in days], "period_of_report date")).collect()}
    assert got == {days[0]: days[1], days[1]: days[2], days[2]: dt.date(2023, 9, 30), days[3]: None, days[4]: None}
    f = spark.createDataFrame([("1", "a1", Q, Q, "Old"), ("1", "a2", Q, dt.date(2024, 5, 1), None), ("2", "a3", Q, Q, None)], "cik string, accession_number string, period_of_report date, filing_date date, filing_manager_name string")
    assert {r.cik: r.filer_name for r in dimensions.filers(f).collect()} == {"1": "Old", "2": None}


def test_security_names(spark):
    rows = [("c", Q, "B", "X", "f1"), ("c", Q, "A", None, "f2"), ("c", Q, "A", None, None), ("c", Q, "B", "Y", None), ("c", dt.date(2023, 1, 1), "Old", "Z", None)]
    r = dimensions.securities(spark.createDataFrame(rows, "cusip string, period_of_report date, name_of_issuer string, title_of_class string, figi string")).first()
    assert (r.name_of_issuer, r.title_of_class, r.figi, r.figi_count, r.first_period) == ("A", "X", None, 2, dt.date(2023, 1, 1))


POSITION = "cik string, period_of_report date, cusip string, put_call string, value_usd long, is_option boolean, shares_or_principal_amount_type string, shares_or_principal_amount long"


def positions(spark, *rows):
    return spark.createDataFrame([(k, p, c, o, v, o is not None, t, n) for k, p, c, o, v, t, n in rows], POSITION)


def test_concentration(spark):
    values = [8, 8, 8, 8, 8, 8, 8, 2, 2, 2, 1, 1]
    rows = [("1", Q, f"c{k:02}", None, v, "SH", 1) for k, v in enumerate(values)] + [("1", Q, "c00", "Put", 99, "SH", 1), ("2", Q, "c", None, 0, "SH", 1)]
    got = {r.cik: r for r in marts.portfolios(positions(spark, *rows)).collect()}
    assert (got["1"].top_ten_share, got["1"].hhi) == (62 / 64, sum((v / 64) ** 2 for v in values))
    assert (got["1"].option_value_usd, got["1"].option_position_count) == (99, 1)
    assert (got["2"].top_ten_share, got["2"].hhi, got["2"].value_usd) == (None, None, 0)


def test_change_kinds(spark):
    before = dt.date(2023, 12, 31)
    now = [("entry", None, "SH", 1), ("up", "Put", "SH", 3), ("down", None, "SH", 1), ("same", None, "SH", 2), ("type", None, "PRN", 2), ("mixed", None, None, None)]
    was = [("exit", None, "SH", 1), ("up", "Put", "SH", 2), ("up", None, "SH", 9), ("down", None, "SH", 2), ("same", None, "SH", 2), ("type", None, "SH", 2), ("mixed", None, "SH", 2)]
    p = positions(spark, *[("1", Q, c, o, 5, t, n) for c, o, t, n in now], *[("1", before, c, o, 5, t, n) for c, o, t, n in was])
    spans = spark.createDataFrame([("1", "F", Q, before, "previous period"), ("1", "F", before, None, "no previous filing")], "cik string, filer_name string, period_of_report date, previous_period date, comparison_basis string")
    names = spark.createDataFrame([("up", "U", "COM")], "cusip string, name_of_issuer string, title_of_class string")
    got = {(r.cusip, r.put_call): (r.change_kind, r.amount_change) for r in marts.position_changes(spans, p, names).collect()}
    assert got == {
        ("entry", None): ("entry", None), ("exit", None): ("exit", None), ("up", "Put"): ("increase", 1), ("up", None): ("exit", None), ("down", None): ("decrease", -1), ("same", None): ("unchanged", 0),
        ("type", None): ("not comparable", None), ("mixed", None): ("not comparable", None),
    }


def test_overlap(spark):
    p = positions(spark, ("1", Q, "x", None, 2, "SH", 1), ("1", Q, "y", None, 2, "SH", 1), ("2", Q, "x", None, 1, "SH", 1), ("2", Q, "z", None, 3, "SH", 1), ("3", Q, "w", None, 1, "SH", 1), ("4", Q, "w", None, 0, "SH", 1))
    spans = spark.createDataFrame([(c, "F" + c, Q, v) for c, v in (("1", 4), ("2", 4), ("3", 1), ("4", 0))], "cik string, filer_name string, period_of_report date, value_usd long")
    got = {(r.cik, r.other_cik): (r.shared_securities, r.weight_overlap) for r in marts.filer_overlaps(spans, p).collect()}
    assert got == {("1", "2"): (1, 0.25), ("1", "3"): (0, 0.0), ("2", "3"): (0, 0.0)}
    assert marts.filer_overlaps(spans, p, top_n=2).count() == 1


def test_position_amounts_need_one_type(spark):
    cols = "cik string, period_of_report date, cusip string, put_call string, accession_number string, value_usd long, shares_or_principal_amount long, shares_or_principal_amount_type string"
    rows = [("1", Q, "x", None, "a", 1, 2, "SH"), ("1", Q, "x", None, "a", 1, 2, "SH"), ("1", Q, "y", None, "a", 1, 2, "SH"), ("1", Q, "y", None, "b", 1, 2, "PRN"), ("1", Q, "z", None, "a", 1, 2, None)]
    got = {r.cusip: (r.holding_count, r.filing_count, r.shares_or_principal_amount_type, r.shares_or_principal_amount) for r in marts.positions(spark.createDataFrame(rows, cols)).collect()}
    assert got == {"x": (2, 1, "SH", 4), "y": (2, 2, None, None), "z": (1, 1, None, None)}


def test_text_conventions(spark):
    df = spark.createDataFrame([(" a ", "30-JUN-2018", " 12 ", "Y", "1, 02"), ("", "", "", "", "NONE"), (None, None, None, "N", None), ("x", "01-jan-2020", "7", "maybe", "0")], "t string, d string, n string, f string, m string")
    got = df.select(C.text("t"), C.day("d"), C.number("n"), C.flag("f"), C.sequence_numbers("m")).collect()
    assert [tuple(r) for r in got] == [("a", dt.date(2018, 6, 30), Decimal(12), True, [1, 2]), (None, None, None, None, []), (None, None, None, False, []), ("x", dt.date(2020, 1, 1), Decimal(7), None, [0])]
    assert df.select(C.day(F.lit("bad"), strict=False), C.number(F.lit("1x"), strict=False)).first() == (None, None)
    with pytest.raises(Exception):
        df.select(C.number(F.concat("t", F.lit("1x")))).collect()


def test_quality_details(spark):
    state = spark.createDataFrame([("a", "1", Q, dt.date(2024, 5, 1), "13F-HR/A", True, None, None, None, "13F NOTICE", None, "walk", 1, "restatement", 1, False, True)], FILING.split(", submission")[0] + ", submission_type string, is_amendment boolean, cover_is_amendment boolean, amendment_type string, amendment_no long, report_type string, report_calendar_or_quarter date, origin string, filing_position long, filing_role string, effective_position long, is_superseded boolean, is_contributing boolean")
    state = state.withColumns({"table_entry_total": F.lit(1).cast("long"), "table_value_total_as_filed": F.lit(5).cast("long")})
    held = spark.createDataFrame([("a", 5)], "accession_number string, value_as_filed long")
    units = spark.createDataFrame([("a", 1.0, "dollars", "dollars")], "accession_number string, median_value_per_share double, value_unit string, filing_date_unit string")
    cover = spark.createDataFrame([], "accession_number string, compared_accession_number string, compared_securities long, repeated_securities long, is_read_as_restatement boolean")
    facts = quality.with_facts(state, held, cover, units)
    got = {r.check_name: r.detail for r in quality.filing_checks(facts).unionByName(quality.order_checks(state)).collect()}
    assert got["cover_box_disagrees_with_submission_type"] == "submission type 13F-HR/A, amendment box blank"
    assert set(got) == {"untyped_amendment", "cover_box_disagrees_with_submission_type", "report_type_disagrees_with_submission_type", "period_disagrees_with_cover", "lineage_starts_with_amendment"}


def test_medians_by_rank(spark):
    values = {"even": [4.0, 1.0, 2.0, 8.0], "odd": [3.0, 1.0, None, 9.0], "ties": [2.0, 2.0, 5.0], "none": [None, None], None: [7.0]}
    rows = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double")
    got = {r.k: r.m for r in medians(rows, ("k",), "v", "m").collect()}
    assert got == {"even": 3.0, "odd": 3.0, "ties": 2.0, "none": None, None: 7.0}
    assert medians(rows.where("false"), ("k",), "v", "m").collect() == []


def test_unrestated_additions(spark):
    state = spark.createDataFrame(
        [("1", Q, "add", "walk", 2, "addition", True, 3), ("1", Q, "last", "walk", 3, "restatement", False, 3), ("2", Q, "kept", "walk", 1, "addition", True, 2), ("2", Q, "base", "walk", 2, "restatement", False, 2)],
        "cik string, period_of_report date, accession_number string, origin string, filing_position long, filing_role string, is_superseded boolean, effective_position long",
    )
    held = cusips(spark, add=["A", "A", "B", None, None], last=["B", None, "C"], kept=["D"], base=["D", "E"])
    got = [(r.accession_number, r.detail) for r in quality.unrestated_addition(state, held).collect()]
    assert got == [("add", "2 of the securities it added are not in last, the restatement that supersedes it")]


def test_tables_are_saved_whole(spark, tmp_path):
    spark.sql(f"create database saved location '{(tmp_path / 'saved').as_uri()}'")
    try:
        for n in (5, 3):  # a second build replaces the first
            save(Tables(*[spark.range(n + k) for k in range(len(fields(Tables)))]), "saved")
        assert [spark.table(f"saved.{f.name}").count() for f in fields(Tables)] == [3 + k for k in range(len(fields(Tables)))]
    finally:
        spark.sql("drop database saved cascade")


def test_kth_values_of_many_groups(spark):
    from quarterdeck.operators import profile

    rng = random.Random(7)
    rows = [(f"g{k % 5}", rng.choice([0, -1, 1, rng.randrange(-(1 << 62), 1 << 62), rng.randrange(-70_000, 70_000), (1 << 63) - 1, -(1 << 63)])) for k in range(600)] + [("one", -5), ("none", None), ("g0", None)]
    want = {}
    for g in {g for g, v in rows if v is not None}:
        own = sorted(v for x, v in rows if x == g and v is not None)
        want[g] = own[len(own) // 2]
    assert {r.g: r.m for r in profile.kth_values(spark.createDataFrame(rows, "g string, v long"), "g", "v", "m").collect()} == want


def test_stored_tables_meet_without_an_exchange(spark):
    from quarterdeck.plans.build import buckets, written

    by, old = ("accession_number",), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = written(spark.range(200).selectExpr("cast(id % 20 as string) as accession_number", "id as v"), "left", by)
        b = written(spark.range(20).selectExpr("cast(id as string) as accession_number", "id as w"), "right", by)
        joined = a.join(b, "accession_number").groupBy("accession_number").agg(F.sum("v").alias("v"), F.max("w").alias("w"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort [" not in plan
        assert {(r.accession_number, r.v, r.w) for r in joined.collect()} == {(str(k), sum(range(k, 200, 20)), k) for k in range(20)}
        assert len(a.inputFiles()) <= buckets(spark)  # one file a bucket, so that their order can be trusted
        assert written(a.where("false"), "none", by).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_rules_are_counted_by_the_write(spark):
    from quarterdeck.plans.build import written_checked

    rows = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), ("b", "z")], "k string, v string")
    rules = {"no key": expect.missing("k"), "other value": expect.not_among("v", "x", "y", "it's"), "it's both": "k is null and v is null"}
    for by in ((), ("k",)):
        out, found = written_checked(rows, "checked", rules, by)
        assert found == {"rows": 4, "no key": 1, "other value": 1, "it's both": 0} and out.count() == 4
        assert written_checked(rows.where("v = 'q'"), "checked", rules, by)[1] == dict.fromkeys(["rows", *rules], 0)
    assert sorted((r.v, r.broken) for r in expect.broken_rows(rows, rules).collect()) == [("y", ["no key"]), ("z", ["other value"])]


def test_keys_of_landed_files(spark):
    from quarterdeck.sources import keys as K

    df = spark.sql("select date '2024-02-05' as d, '0001-24-000001' as a, 'manual__a b/\u00e9:1' as run, '2024-02-05T06:00:00+00:00' as at, cast(null as string) as none")
    got = df.select(K.index_key("d"), K.filing_file_key("d", "a", K.COVER_NAME), K.parsed_key("d", "a"), K.walk_audit_key("d", "run", "at"), K.extracted_key("a", "none")).first()
    assert tuple(got) == (
        "raw/edgar/index/form.20240205.idx", "raw/edgar/filings/filed=2024-02-05/0001-24-000001/primary_doc.xml", "parsed/edgar/filings/filed=2024-02-05/0001-24-000001.jsonl",
        "raw/edgar/audit/walk/day=2024-02-05/manual__a-b---1/2024-02-05T06-00-00-00-00.json", None,
    )
