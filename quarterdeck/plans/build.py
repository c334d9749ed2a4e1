"""The build of all tables from filings and holdings as filed."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterdeck.operators import dimensions, holdings, lineage, marts, quality


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or one of our own where it is unset and all run in this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.quarterdeck.folder", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="spark-")
            spark.conf.set("spark.quarterdeck.folder", folder)
    return folder.rstrip("/")


@contextmanager
def dropping_shuffles(df: DataFrame) -> Iterator[None]:
    """What is written meanwhile from the session of ``df`` drops its shuffle files at once, rather than when the driver collects garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        yield
    finally:
        conf.set(key, before)


#: What tables are bucketed by where they are stored: the keys by which others join and group them.
ACCESSION, LINEAGE = ("accession_number",), lineage.LINEAGE
BUCKETED = {
    "filings": ACCESSION, "as_filed": ACCESSION, "filing_value_units": ACCESSION, "holdings": ACCESSION, "addition_coverage": ACCESSION, "lineage_filings": ACCESSION, "state": ACCESSION,
    "positions": LINEAGE, "filer_periods": LINEAGE,
}
#: The layers of a stored build, each a database, and their tables.
LAYERS = {
    "core": ("filings", "filing_value_units", "holdings", "addition_coverage", "lineage_filings", "canonical_holdings", "data_quality_rows"),
    "marts": ("filers", "periods", "securities", "positions", "filer_periods", "position_changes", "filer_overlaps"),
}


def buckets(spark: SparkSession) -> int:
    """The buckets of stored tables: ``spark.quarterdeck.buckets``, or the shuffle's partitions. Tables meet without an exchange if theirs are equal."""
    return int(spark.conf.get("spark.quarterdeck.buckets", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def _same(df: DataFrame) -> DataFrame:
    return df


def _store(df: DataFrame, table: str, by: tuple[str, ...], path: str | None = None, watch: Callable[[DataFrame], DataFrame] = _same) -> DataFrame:
    """``df`` as a table, replaced whole; bucketed and sorted by ``by``, a file a bucket. The exchange goes where ``df`` is partitioned so.

    Spark trusts the order of buckets of one file each where ``spark.sql.legacy.bucketedTableScan.outputOrdering`` is set, as it is here.
    """
    n = buckets(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", True)
    out = (watch(df.repartition(n, *by)).write.bucketBy(n, *by).sortBy(*by) if by else watch(df).write).mode("overwrite")
    with dropping_shuffles(df):
        (out.option("path", path) if path else out).saveAsTable(table)
    return df.sparkSession.table(table)


def written(df: DataFrame, name: str, by: tuple[str, ...] = (), watch: Callable[[DataFrame], DataFrame] = _same) -> DataFrame:
    """``df`` written to the shared folder and read back: several tables read it, and a lost executor costs no rebuild.

    With ``by`` it is bucketed by these columns, so that what joins or groups by them reads it without an exchange. ``watch`` may
    add an observation to what is written; it goes behind the last exchange.
    """
    spark, own = df.sparkSession, uuid.uuid4().hex
    path = f"{shared_folder(spark)}/{name}-{own}"
    if by:
        return _store(df, f"{re.sub('[^a-z0-9]', '_', name)}_{own}", by, path, watch)
    with dropping_shuffles(df):
        watch(df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_checked(df: DataFrame, name: str, rules: dict[str, str], by: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, int]]:
    """``df`` as written, its number of rows, and how many break each rule, counted by the tasks that write it.

    The counts are of the last stage, of which each partition counts once, whatever tasks were lost. ``expect.broken_rows`` has the rows.
    """
    seen = Observation()
    names = {f"_{k}": rule for k, rule in enumerate(rules)}
    metrics = [F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.expr(rules[rule])).alias(k) for k, rule in names.items()]]
    out = written(df, name, by, lambda d: d.observe(seen, *metrics))
    found = seen.get
    return out, {"rows": found.get("_rows", 0)} | {rule: found.get(k, 0) for k, rule in names.items()}


@dataclass
class Tables:
    """The tables of a build. Core tables that several others read are written."""

    filings: DataFrame
    filing_value_units: DataFrame
    holdings: DataFrame
    addition_coverage: DataFrame
    lineage_filings: DataFrame
    canonical_holdings: DataFrame
    data_quality_rows: DataFrame
    filers: DataFrame
    periods: DataFrame
    securities: DataFrame
    positions: DataFrame
    filer_periods: DataFrame
    position_changes: DataFrame
    filer_overlaps: DataFrame


class LazyTables(Tables):
    """The tables of a build, each made, and written, when it is first asked for: what reads one pays for it and what it needs only."""

    def __init__(self, makers: dict[str, Callable[[LazyTables], DataFrame]]) -> None:
        self._makers = makers

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self._makers:
            raise AttributeError(name)
        df = self._makers[name](self)
        setattr(self, name, df)
        return df


def build(
    filings: DataFrame | Callable[[], DataFrame], as_filed: DataFrame | Callable[[], DataFrame], top_n: int = marts.TOP_FILERS, write: bool = False,
    stores: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> Tables:
    """All tables; with ``write`` those that are read often are written to the shared folder at their first use, else all stay lazy.

    Written tables are bucketed as ``BUCKETED`` says. Inputs that are, too, spare the holdings every exchange by accession. An
    input may be given as a function that makes it, called where a table needs it first. ``stores`` has tables that are kept in a
    way of their own, each a function that keeps what it is given and gives back what others shall read.
    """

    def keep(name: str, make: Callable[[LazyTables], DataFrame], often: bool = True) -> Callable[[LazyTables], DataFrame]:
        if stores and name in stores:
            return lambda t: stores[name](make(t))
        return (lambda t: written(make(t), name, BUCKETED.get(name, ()))) if write and often else make

    def flags(t: LazyTables) -> DataFrame:
        """The two checks that filer periods show, without the others."""
        return quality.unit_overrides(t.filing_value_units).unionByName(quality.yardstick_flags(t.off_yardstick))

    made = {
        "filing_value_units": lambda t: holdings.filing_value_units(t.filings, t.as_filed),
        "holdings": lambda t: holdings.holdings(t.as_filed, t.filing_value_units),
        "addition_coverage": lambda t: lineage.addition_coverage(t.filings, t.holdings),
        "lineage_filings": lambda t: lineage.lineage_filings(t.filings, t.addition_coverage),
        "canonical_holdings": lambda t: holdings.canonical_holdings(t.holdings, t.lineage_filings, t.filings),
        "state": lambda t: quality.filing_state(t.filings, t.lineage_filings),
        "off_yardstick": lambda t: quality.ratios_off_yardstick(quality.prices(t.filings, t.holdings)),
        "data_quality_rows": lambda t: quality.data_quality_rows(t.state, t.holdings, t.addition_coverage, t.filing_value_units, t.off_yardstick),
        "securities": lambda t: dimensions.securities(t.canonical_holdings),
        "positions": lambda t: marts.positions(t.canonical_holdings),
        "filer_periods": lambda t: marts.filer_periods(t.positions, t.periods, t.filers, t.lineage_filings, t.filings, flags(t)),
    }
    small = {
        "filers": lambda t: dimensions.filers(t.filings),
        "periods": lambda t: dimensions.periods(t.filings),  # every filing is in one lineage, so their periods are the same
        "position_changes": lambda t: marts.position_changes(t.filer_periods, t.positions, t.securities),
        "filer_overlaps": lambda t: marts.filer_overlaps(t.filer_periods, t.positions, top_n),
    }
    given = {name: keep(name, lambda t, df=df: df() if callable(df) else df, False) for name, df in (("filings", filings), ("as_filed", as_filed))}
    return LazyTables(given | {name: keep(name, make) for name, make in made.items()} | {name: keep(name, make, False) for name, make in small.items()})


def save(tables: Tables, database: str) -> None:
    """Every table of a build as a table of the database, replaced whole and bucketed as ``BUCKETED`` says."""
    for f in fields(tables):
        df = getattr(tables, f.name)
        _store(df, f"{database}.{f.name}", tuple(c for c in BUCKETED.get(f.name, ()) if c in df.columns))


def _create(spark: SparkSession, layer: str, prefix: str, root: str | None) -> None:
    spark.sql(f"create database if not exists `{prefix}{layer}`" + (f" location '{root}/{prefix}{layer}'" if root else ""))


def save_layers(tables: Tables, prefix: str = "", root: str | None = None) -> list[tuple[str, str]]:
    """Every table of a build in the database of its layer, whose name ``prefix`` comes before; gives layers and tables.

    Databases that don't exist are created below ``root``, or where the warehouse has them.
    """
    spark = tables.filings.sparkSession
    for layer, names in LAYERS.items():
        _create(spark, layer, prefix, root)
        for name in names:
            _store(getattr(tables, name), f"`{prefix}{layer}`.{name}", BUCKETED.get(name, ()))
    return [(layer, name) for layer, names in LAYERS.items() for name in names]


def build_layers(spark: SparkSession, filings: DataFrame | Callable[[], DataFrame], as_filed: DataFrame | Callable[[], DataFrame], prefix: str = "", root: str | None = None) -> list[tuple[str, str]]:
    """The same for a build that is made now: each table is written once, into its layer, and read from there by the others."""
    stores = {}
    for layer, names in LAYERS.items():
        _create(spark, layer, prefix, root)
        stores |= {name: (lambda df, table=f"`{prefix}{layer}`.{name}", by=BUCKETED.get(name, ()): _store(df, table, by)) for name in names}
    tables = build(filings, as_filed, write=True, stores=stores)
    for names in LAYERS.values():
        for name in names:
            getattr(tables, name)
    return [(layer, name) for layer, names in LAYERS.items() for name in names]
