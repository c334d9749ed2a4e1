"""Filings and holdings shaped from the star-schema tables, as inputs of the queries.

The statements run in Spark and in DuckDB alike; queries use them as DataFrames, oracles as leading CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterdeck.functions import columns as C

FILERS = 100

FILINGS_SQL = """
select k,
  concat(lpad(cast(k % 7 + 7 * cast(floor(k/1000000.0) as bigint) as string),10,'0'),'-',substr(cast(year(per) as string),3,2),'-',lpad(cast(k % 1000000 as string),6,'0')) as accession_number,
  lpad(cast(cu % {filers} as string),10,'0') as cik,
  per as period_of_report,
  per + cast(10 + k % 40 as int) as filing_date,
  submission_type,
  submission_type like '%/A' as is_amendment,
  case when k % 53 = 0 then null when k % 59 = 0 then not (submission_type like '%/A') else submission_type like '%/A' end as cover_is_amendment,
  case when t between 4 and 7 and a < 2 then 'RESTATEMENT' when t between 4 and 7 and a < 7 then 'NEW HOLDINGS' end as amendment_type,
  cast(case when t in (4,5,6,7,9) then k % 4 + 1 end as bigint) as amendment_no,
  case when k % 61 = 0 then '13F COMBINATION REPORT' when t in (8,9) then '13F NOTICE' else '13F HOLDINGS REPORT' end as report_type,
  case when k % 67 = 0 then per - 1 else per end as report_calendar_or_quarter,
  case when k % 71 <> 0 then concat('FILER ', cast(cu % {filers} as string), case when k % 5 = 0 then ' LLC' else '' end) end as filing_manager_name,
  case k % 3 when 0 then true when 1 then false end as is_confidential_omitted,
  case when per >= date '2025-01-01' then 'walk' else 'data_set' end as origin
from (
  select *, case when t = 8 then '13F-NT' when t = 9 then '13F-NT/A' when t <= 3 then '13F-HR' else '13F-HR/A' end as submission_type
  from (
    select k, cu, cast(last_day(cast(date_trunc('quarter', od) + interval 2 month as date)) as date) as per,
      cast(floor(k/7.0) as bigint) % 10 as t, cast(floor(k/3.0) as bigint) % 8 as a
    from (select o_orderkey as k, o_custkey as cu, cast(o_orderdate + interval 24 year as date) as od from {orders}) o) p) f
"""

HOLDINGS_SQL = """
select f.k, f.accession_number, f.origin,
  cast(row_number() over (partition by f.k order by l_linenumber,l_partkey,l_suppkey,l_quantity,l_extendedprice,l_discount,l_tax) as bigint) as holding_key,
  concat('ISSUER ', cast(l_partkey % 12 as string), case when l_suppkey % 4 = 0 then ' INC' else '' end) as name_of_issuer,
  case l_linestatus when 'O' then 'COM' else 'CL A' end as title_of_class,
  case l_partkey % 12 when 0 then '037833100' when 1 then '594918104' when 2 then '037833101' when 3 then '88160R101'
    when 4 then '12345*@#7' when 5 then '03783310' when 6 then '03783-100' when 7 then 'G1151C101'
    else concat(lpad(cast((l_partkey % 12) * 3711 as string),8,'0'), cast(l_partkey % 12 - 8 as string)) end as cusip,
  case when l_partkey % 12 in (0,1) then concat('BBG00000000', cast(l_partkey % 12 as string)) when l_partkey % 12 = 2 then concat('BBG00000001', cast(l_suppkey % 2 as string)) end as figi,
  case when l_returnflag='A' and l_partkey % 5 = 0 then 'Put' when l_returnflag='R' and l_partkey % 5 = 1 then 'Call' end as put_call,
  cast(l_quantity as bigint) % 5 + 1 as shares_or_principal_amount,
  case when l_partkey % 41 = 0 then 'PRN' else 'SH' end as shares_or_principal_amount_type,
  case l_suppkey % 3 when 0 then 'SOLE' when 1 then 'DFND' else 'OTR' end as investment_discretion,
  case l_suppkey % 4 when 0 then '1, 2' when 1 then '1' when 2 then 'NONE' else '' end as other_manager,
  cast(case when f.k % 97 = 0 then floor(l_extendedprice) * 100000 when f.k % 3 = 0 then floor(l_extendedprice / 50000.0) else floor(l_extendedprice) end as bigint) as value_as_filed,
  cast(l_quantity as bigint) as voting_sole
from {filings} f join {lineitem} on l_orderkey = f.k
where f.submission_type like '13F-HR%' or f.k % 50 = 1
"""

#: Totals of the summary page, right for most filings.
SUMMARY_SQL = """
select f.*,
  case when f.k % 19 <> 0 then cast(coalesce(h.n, 0) + case when f.k % 6 = 0 then 1 else 0 end as bigint) end as table_entry_total,
  case when f.k % 19 <> 0 then cast(coalesce(h.v, 0) as bigint) end as table_value_total_as_filed
from {filings} f left join (select k as hk, count(*) as n, sum(value_as_filed) as v from {holdings} group by k) h on h.hk = f.k
"""


def bare_filings(spark: SparkSession, sf_dir: str, filers: int = FILERS) -> DataFrame:
    """Filings without summary totals."""
    return spark.sql(FILINGS_SQL.replace("{filers}", str(filers)), orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))


def shaped(spark: SparkSession, sf_dir: str, filers: int = FILERS, origin: str | None = None, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """filings (with summary totals) and holdings as filed, made from orders and lineitem; of one origin, only its orders meet their lines.

    Where all holdings are ``stored``, totals are taken from these.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    bare = bare_filings(spark, sf_dir, filers)
    if origin:
        bare = bare.where(F.col("origin") == origin)
    holdings = spark.sql(HOLDINGS_SQL, filings=bare, lineitem=lineitem)
    filings = spark.sql(SUMMARY_SQL, filings=bare, holdings=holdings if stored is None else stored)
    zero = F.lit(0).cast("long")
    return filings, holdings.withColumns({"other_manager_sequence_numbers": C.sequence_numbers("other_manager"), "voting_shared": zero, "voting_none": zero})


def shaped_ctes(filers: int = FILERS) -> str:
    """The same as DuckDB CTEs: bare_filings, raw_holdings, filings."""
    bare = FILINGS_SQL.replace("{filers}", str(filers)).format(orders="orders")
    holdings = HOLDINGS_SQL.format(filings="bare_filings", lineitem="lineitem")
    summary = SUMMARY_SQL.format(filings="bare_filings", holdings="raw_holdings")
    return f"bare_filings as materialized ({bare}), raw_holdings as materialized ({holdings}), filings as materialized ({summary})"
