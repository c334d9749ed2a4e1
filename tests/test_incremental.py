"""The build taken in batch by batch against the whole build."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quarterdeck.operators import holdings as H
from quarterdeck.plans.build import build, written
from quarterdeck.plans.shaped import shaped
from quarterdeck.streaming import incremental as I

SF = "/root/testdata/sf0.001"
NAMES = ("filing_value_units", "addition_coverage", "lineage_filings", "canonical_holdings", "securities", "positions", "filer_periods", "position_changes")


def at(hour):
    return F.lit(dt.datetime(2026, 1, 1, hour)).cast("timestamp")


def rows_of(df):
    columns = sorted(df.columns)
    plain = lambda v: round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(plain(r[c]) for c in columns) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def versions(spark):
    """Old and new filings: the new ones of some name another filer or period."""
    filings, holdings = shaped(spark, SF, 20)
    filings, holdings = written(filings.where("k % 6 = 0"), "filings"), written(holdings.where("k % 6 = 0"), "as-filed")
    old = filings.withColumns({"source_last_modified": at(1), "source_content_key": F.lit("a")})
    moved = filings.where("k % 9 = 0").withColumns({"source_last_modified": at(2), "source_content_key": F.lit("b")})
    moved = moved.withColumn("cik", F.when(F.col("k") % 2 == 0, F.lit("0000000777")).otherwise(F.col("cik"))).withColumn("period_of_report", F.when(F.col("k") % 4 == 1, F.last_day(F.add_months("period_of_report", 3))).otherwise(F.col("period_of_report")))
    return written(old, "old"), written(moved, "moved"), holdings


def held_by(holdings, filings):
    return holdings.join(filings.select("accession_number"), "accession_number", "left_semi")


def test_batches_equal_a_whole_build(spark, versions, tmp_path):
    old, moved, holdings = versions
    root = f"file://{tmp_path}/tables"
    first, second = old.where("k % 7 < 4"), old.where("k % 7 >= 4").unionByName(moved.where("k % 7 < 4"))
    late = moved.where("k % 7 >= 4")
    stale = old.where("k % 7 = 2")  # written before what batch 1 brought, but taken in after it
    for number, batch in enumerate((first, second, late, stale)):
        I.apply_batch(spark, root, batch, held_by(holdings, batch), number, 4)
    latest = old.join(moved, "accession_number", "left_anti").unionByName(moved)
    whole = build(written(latest, "latest"), holdings, write=True)

    def same():
        now = I.current(spark, root)
        for name in NAMES:
            got, want = getattr(now, name), getattr(whole, name)
            assert rows_of(got.select(*[c for c in got.columns if c in want.columns])) == rows_of(want.select(*[c for c in want.columns if c in got.columns])), name

    same()
    for number, batch in ((1, second), (0, first)):  # replayed batches, the last and an earlier one
        I.apply_batch(spark, root, batch, held_by(holdings, batch), number, 4)
    same()


def test_an_empty_batch_changes_nothing(spark, versions, tmp_path):
    old, _, holdings = versions
    root = f"file://{tmp_path}/tables"
    some = old.where("k % 40 = 0")
    I.apply_batch(spark, root, some, held_by(holdings, some), 0, 2)
    before = rows_of(I.current(spark, root).positions)
    I.apply_batch(spark, root, some.limit(0), holdings.limit(0), 1, 2)
    assert rows_of(I.current(spark, root).positions) == before


def test_a_batch_replaces_the_buckets_it_touches_only(spark, versions, tmp_path):
    old, _, holdings = versions
    root = f"{tmp_path}/tables"
    I.apply_batch(spark, f"file://{root}", old, holdings, 0, 8)
    files = lambda: {str(p) for p in (tmp_path / "tables" / "positions").rglob("*.parquet")}
    before = files()
    one = old.where(F.col("cik") == old.agg(F.min("cik")).first()[0])
    I.apply_batch(spark, f"file://{root}", one, held_by(holdings, one), 1, 8)
    after = files()
    gone = {p.split("bucket=")[1].split("/")[0] for p in before - after}
    assert len(gone) == 1 and {p.split("bucket=")[1].split("/")[0] for p in after - before} == gone


def test_a_batch_makes_its_years_only_and_no_older_version_comes_back(spark, versions, tmp_path):
    old, moved, holdings = versions
    root = f"{tmp_path}/tables"
    away = moved.where("cik = '0000000777'").join(old.select("accession_number", F.col("cik").alias("was")), "accession_number").orderBy("accession_number").first()
    own = old.where(F.col("cik") == away["was"]).orderBy("accession_number").collect()
    late = max((r for r in own if r["accession_number"] != away["accession_number"]), key=lambda r: (r["period_of_report"].year, r["accession_number"]))
    is_late, is_away = F.col("accession_number") == late["accession_number"], F.col("accession_number") == away["accession_number"]
    files = lambda: {str(p) for p in (tmp_path / "tables" / "lineage_filings").rglob("*.parquet")}
    batches = (old.where((F.col("cik") == away["was"]) & ~is_late), moved.where(is_away), old.where(is_late))
    for number, batch in enumerate(batches):
        before = files() if number else set()
        I.apply_batch(spark, f"file://{root}", batch, held_by(holdings, batch), number, 64)
    gone = {p for p in before if p not in files()}
    assert len(before) > len(gone)
    assert not [p for p in gone if f"year={late['period_of_report'].year}/" not in p]
    now = I.current(spark, f"file://{root}").lineage_filings
    assert [r["cik"] for r in now.where(is_away).collect()] == ["0000000777"]
    assert now.count() == len(own)


def test_prices_are_read_from_holdings_of_the_touched_periods(spark, versions, tmp_path):
    old, _, holdings = versions
    root = f"file://{tmp_path}/tables"
    I.apply_batch(spark, root, old, holdings, 0, 2)
    assert not (tmp_path / "tables" / "prices").exists()
    periods = spark.read.parquet(f"{root}/holdings").where("_none is null").select("accession_number", "period_of_report").distinct()
    assert rows_of(periods) == rows_of(old.join(periods.select("accession_number"), "accession_number", "left_semi").select("accession_number", "period_of_report"))
    assert "period_of_report" not in I.current(spark, root).holdings.columns


def test_holdings_are_stored_once_with_their_units(spark, versions, tmp_path):
    old, moved, holdings = versions
    some = old.where("k % 4 = 0")
    again = moved.where("k % 4 = 0")
    both = [held_by(holdings, batch) for batch in (some, again)]
    ready = both[1].join(again.select("accession_number", *I.OF_FILING), "accession_number")  # these are not joined to find their filing
    for number, (batch, held) in enumerate(((some, both[0]), (again, ready))):
        I.apply_batch(spark, f"file://{tmp_path}/tables", batch, held, number, 2)
    files = [pq.ParquetFile(p) for p in (tmp_path / "tables").rglob("*.parquet")]
    stored = [f.metadata.num_rows for f in files if "voting_sole" in f.schema_arrow.names and "filing_role" not in f.schema_arrow.names]
    assert sum(stored) == sum(df.count() for df in both) > 0
    latest = some.join(again, "accession_number", "left_anti").unionByName(again)
    want = H.holdings(both[0], H.filing_value_units(latest, both[0]))
    got = I.current(spark, f"file://{tmp_path}/tables").holdings
    assert rows_of(got) == rows_of(want.select(*got.columns))


def test_holdings_that_are_not_in_effect_stay_out_of_canonical_holdings(spark, versions, tmp_path, monkeypatch):
    old, _, holdings = versions
    some = old.where("k % 4 = 0")
    held, seen, canonical = held_by(holdings, some), [], I.H.canonical_holdings
    monkeypatch.setattr(I.H, "canonical_holdings", lambda *tables: seen.append(tables) or canonical(*tables))
    found = []
    for few in (I.FEW, 0):  # broadcast or not
        monkeypatch.setattr(I, "FEW", few)
        I.apply_batch(spark, f"file://{tmp_path}/{few}", some, held, 0, 2)
        found.append(rows_of(I.current(spark, f"file://{tmp_path}/{few}").canonical_holdings))
    assert found[0] == found[1] != []
    read, chain, _ = seen[0]
    assert 0 < read.count() < held.count()
    assert read.join(chain.where("is_contributing"), "accession_number", "left_anti").count() == 0
