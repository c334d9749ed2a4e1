"""What larger tables need: numbers that stay apart, rows that don't carry their file, tables made only where they are read."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarterdeck.plans.queries import ORACLES, QUERIES
from quarterdeck.plans.shaped import shaped
from quarterdeck.sources import filing_xml, indexes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def far(spark, tmp_path_factory):
    """The smallest tables with order numbers of seven digits."""
    root = str(tmp_path_factory.mktemp("far"))
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        spark.read.parquet(f"{SF}/{name}.parquet").withColumn(key, F.col(key) + 1_234_000).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", ["lineage_filings", "candidate_filers", "dq_summary_disagrees_with_holdings", "dq_filing_order_set_by_amendment_number", "dq_second_original", "dq_copied_holding_in_addition"])
def test_filings_keep_apart_beyond_a_million_orders(spark, far, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("orders", "lineitem"):
        c.execute(f"create view {t} as select * from '{far}/{t}.parquet/*.parquet'")
    df = QUERIES[name](spark, far)
    cursor = c.execute(ORACLES[name])
    names = [x[0] for x in cursor.description]
    rows = cursor.fetchall()
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr) == sorted(rows, key=repr) and rows
    numbers = QUERIES["filing_ingest_status"](spark, far)
    assert numbers.count() == numbers.select("accession_number").distinct().count() == 1_500


def test_index_lines_do_not_carry_their_file(spark):
    text = "Description\n" + "-" * 60 + "\n" + "x\n\n" + "y\n"
    lines = indexes.index_lines(spark.createDataFrame([("form.20250101.idx", text.encode())], "path string, content binary"))
    assert [(r.line_no, r.line) for r in lines.orderBy("line_no").collect()] == [(3, "x"), (5, "y")]
    above = lines._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode")[0]
    assert "_lines" not in above and "array_position" not in above


def test_a_query_makes_the_tables_it_needs_only(spark, tmp_path):
    from quarterdeck.plans import queries

    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(200).write.parquet(f"{tmp_path}/{name}.parquet")
    assert QUERIES["periods"](spark, str(tmp_path)).count() > 0
    made = vars(queries.tables(spark, str(tmp_path)))
    assert {"filings", "periods"} <= set(made) and not {"as_filed", "holdings", "lineage_filings", "state"} & set(made)


def test_the_walk_is_made_without_holdings_of_data_sets(spark, tmp_path):
    from quarterdeck.plans import landed

    for name in ("orders", "lineitem"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    whole = {tuple(r) for r in shaped(spark, str(tmp_path))[1].where("origin = 'walk'").select("accession_number", "holding_key", "cusip", "value_as_filed").collect()}
    assert QUERIES["parse_failures"](spark, str(tmp_path)).count() > 0
    kept = {what: df for (_, folder, what), df in landed._kept.items() if folder == str(tmp_path)}
    assert "holdings" not in kept and {tuple(r) for r in kept["walk holdings"].select("accession_number", "holding_key", "cusip", "value_as_filed").collect()} == whole
    assert {r.origin for r in kept["walk holdings"].select("origin").distinct().collect()} == {"walk"}


def test_a_table_of_xml_is_parsed_once(spark):
    good = '<informationTable><infoTable><cusip>037833100</cusip></infoTable><infoTable/></informationTable>'
    files = spark.createDataFrame([("a", good), ("b", "<other/>"), ("c", "<informationTable><infoTable>"), ("d", "<informationTable></informationTable>")], "accession_number string, xml string")
    rows = filing_xml.table_holdings(files.repartition(3))
    got = sorted((r.accession_number, r.row_index, r.cusip, r.error) for r in rows.collect())
    assert [g[:3] for g in got] == [("a", 1, "037833100"), ("a", 2, None), ("b", 0, None), ("c", 0, None)]
    assert [g[3] for g in got] == ["titleOfClass", "titleOfClass", "the root is not informationTable", "not well-formed XML"]
    bad = rows.where("error is not null").groupBy("accession_number").agg(F.min("row_index"))
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") + plan.count("xmltostructs(") + plan.count("invoke(XmlToStructsEvaluator") == 1, plan


def test_archives_store_no_holdings_first(spark, tmp_path):
    from quarterdeck.plans import landed

    (tmp_path / "sf").symlink_to("/root/testdata/sf0.001")
    landed.archives(spark, f"{tmp_path}/sf")
    assert not [what for _, sf_dir, what in landed._kept if sf_dir == f"{tmp_path}/sf" and what == "holdings"]


def test_rules_are_counted_without_other_checks_and_a_second_write(spark, tmp_path, monkeypatch):
    from quarterdeck.plans import build as B, queries

    (tmp_path / "sf").symlink_to(SF)
    kept, store = [], B._store
    monkeypatch.setattr(B, "_store", lambda df, table, *more: kept.append(table.rsplit("_", 1)[0]) or store(df, table, *more))
    rows = QUERIES["rules_of_written_tables"](spark, f"{tmp_path}/sf").collect()
    assert {r.table_name for r in rows} == set(queries.RULES)
    assert not [t for t in kept if t in ("holdings", "lineage_filings", "data_quality_rows", "state")]  # only the checked ones are written
    assert len([t for t in kept if "checked_holdings" in t]) == 1


def test_layers_hold_the_only_copy_of_their_tables(spark, tmp_path, monkeypatch):
    from quarterdeck.plans import build as B

    (tmp_path / "sf").symlink_to(SF)
    kept, store = [], B._store
    monkeypatch.setattr(B, "_store", lambda df, table, *more: kept.append(table) or store(df, table, *more))
    assert QUERIES["stored_layers"](spark, f"{tmp_path}/sf").count() == sum(map(len, B.LAYERS.values()))
    for layer, names in B.LAYERS.items():
        for name in names:
            assert len([t for t in kept if t.endswith(f"{layer}`.{name}")]) == 1
    assert not [t for t in kept if t.split("_")[0] in ("holdings", "positions", "lineage") and "`" not in t]


@pytest.mark.parametrize("name", ["cover_box_disagrees_with_submission_type", "filings_of_one_date_across_submitters", "lineage_starts_with_amendment", "notice_with_holdings", "period_disagrees_with_cover", "repeated_security_in_addition", "report_type_disagrees_with_submission_type"])
def test_other_checks_beyond_a_million_orders(spark, far, name):
    test_filings_keep_apart_beyond_a_million_orders(spark, far, f"dq_{name}")


def test_lines_meet_their_orders_once_for_batches_and_land_compressed(spark, monkeypatch):
    from quarterdeck.plans import landed

    monkeypatch.setattr(landed, "_kept", {})
    dated = landed._dated_holdings(spark, SF)
    walk = landed._walk_holdings(spark, SF)
    assert walk.inputFiles() and all("dated-holdings" in f for f in walk.inputFiles())
    plain = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    filings, holdings = shaped(spark, SF)
    assert plain(walk) == plain(holdings.where("origin = 'walk'").select(*walk.columns))
    assert dated.count() == holdings.count()
    stored = landed.shaped_filings(spark, SF)
    assert plain(stored) == plain(filings.select(*stored.columns))
    taken = ("accession_number", "cik", "period_of_report", "filing_date")
    assert plain(dated.select(*taken).distinct()) == plain(stored.join(dated.select("accession_number").distinct(), "accession_number", "left_semi").select(*taken))
    files = spark.read.text(f"{landed._lines_folder(spark, SF)}/*/*", wholetext=True).inputFiles()
    assert files and all(f.endswith(".gz") for f in files)
