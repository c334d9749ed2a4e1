"""The queries' results in DuckDB SQL, over the same shaped inputs, as plainly as SQL says them."""

from __future__ import annotations

import re

from quarterdeck.functions.cusip import ALPHABET
from quarterdeck.plans.shaped import shaped_ctes

_ORDER = "filing_date, amendment_no nulls first, accession_number"
_SEQ = "list_transform(regexp_extract_all(coalesce({0}, ''), '[0-9]+'), lambda d: cast(d as bigint))"

CORE: dict[str, str] = {
    "units": """
      select m.accession_number, f.filing_date, m.median_value_per_share,
        case when f.filing_date < date '2023-01-03' then 'thousands' else 'dollars' end as filing_date_unit,
        case when m.median_value_per_share is null then case when f.filing_date < date '2023-01-03' then 'thousands' else 'dollars' end
             when m.median_value_per_share < 1 then 'thousands' else 'dollars' end as value_unit
      from (select accession_number, round(median(case when shares_or_principal_amount_type = 'SH' and shares_or_principal_amount > 0
              then round(cast(value_as_filed as double) / shares_or_principal_amount, 6) end), 7) as median_value_per_share
            from raw_holdings group by 1) m join filings f using (accession_number)""",
    "holdings": f"""
      select h.*, u.value_unit, cast(value_as_filed * case when u.value_unit = 'thousands' then 1000 else 1 end as bigint) as value_usd,
        {_SEQ.format('other_manager')} as managers
      from raw_holdings h join units u using (accession_number)""",
    "typed": f"""
      select *, case when submission_type like '13F-NT%' then 'notice'
          when submission_type = '13F-HR' and filing_position = min(case when submission_type = '13F-HR' then filing_position end) over (partition by cik, period_of_report) then 'original'
          when submission_type = '13F-HR' then 'restatement' when amendment_type = 'NEW HOLDINGS' then 'addition' else 'restatement' end as typed_role
      from (select *, row_number() over (partition by cik, period_of_report order by {_ORDER}) as filing_position from filings)""",
    "compared": """
      select a.accession_number, a.cik, a.period_of_report,
        (select e.accession_number from typed e where e.cik = a.cik and e.period_of_report = a.period_of_report
           and e.typed_role in ('original', 'restatement') and e.filing_position < a.filing_position order by e.filing_position desc limit 1) as compared_accession_number
      from typed a where a.typed_role = 'addition'""",
    "coverage": """
      select c.*, case when compared_accession_number is not null then (select count(distinct cusip) from holdings h where h.accession_number = c.compared_accession_number) end as compared_securities,
        case when compared_accession_number is not null then (select count(distinct h.cusip) from holdings h
          where h.accession_number = c.accession_number and h.cusip in (select cusip from holdings b where b.accession_number = c.compared_accession_number)) end as repeated_securities
      from compared c""",
    "lineage": """
      select accession_number, cik, period_of_report, filing_position, filing_role, effective_position,
        coalesce(filing_role <> 'notice' and filing_position < effective_position, false) as is_superseded,
        (filing_position is not distinct from effective_position or (filing_role = 'addition' and (effective_position is null or filing_position > effective_position))) as is_contributing
      from (select *, max(case when filing_role in ('original', 'restatement') then filing_position end) over (partition by cik, period_of_report) as effective_position
        from (select t.*, case when typed_role = 'addition' and v.compared_securities > 0 and v.repeated_securities * 10 >= v.compared_securities * 9 then 'restatement' else typed_role end as filing_role
              from typed t left join coverage v using (accession_number)))""",
    "canonical": """
      select * from (
        select h.*, l.cik, l.period_of_report, l.filing_role, l.filing_position,
          min(l.filing_position) over (partition by l.cik, l.period_of_report, cusip, put_call, shares_or_principal_amount, shares_or_principal_amount_type, investment_discretion, array_to_string(managers, ',')) < l.filing_position as is_copied
        from holdings h join lineage l using (accession_number) where l.is_contributing)
      where not (filing_role = 'addition' and is_copied)""",
    "state": "select f.*, l.filing_position, l.filing_role, l.effective_position, l.is_superseded, l.is_contributing from filings f join lineage l using (accession_number)",
    "totals": "select accession_number, count(*) as n, sum(value_as_filed) as v from holdings group by 1",
    "filers": """
      select cik, (select f.filing_manager_name from filings f where f.cik = c.cik and f.filing_manager_name is not null order by filing_date desc, accession_number desc limit 1) as filer_name,
        min(period_of_report) as first_period, max(period_of_report) as last_period from filings c group by cik""",
    "periods": """
      select distinct period_of_report, period_of_report = last_day(period_of_report) and month(period_of_report) in (3, 6, 9, 12) as is_quarter_end,
        case when period_of_report = last_day(period_of_report) and month(period_of_report) in (3, 6, 9, 12) then cast(last_day(cast(period_of_report - interval 3 month as date)) as date) end as previous_period,
        year(period_of_report) as calendar_year, quarter(period_of_report) as calendar_quarter from lineage""",
    "securities": f"""
      with s as (select cusip, min(period_of_report) as first_period, max(period_of_report) as last_period, count(distinct figi) as figi_count, min(figi) as f from canonical group by 1),
      l as (select c.* from canonical c join s on s.cusip = c.cusip and s.last_period = c.period_of_report),
      n as (select cusip, name_of_issuer from (select cusip, name_of_issuer, row_number() over (partition by cusip order by count(*) desc, name_of_issuer) as r from l where name_of_issuer is not null group by 1, 2) where r = 1),
      t as (select cusip, title_of_class from (select cusip, title_of_class, row_number() over (partition by cusip order by count(*) desc, title_of_class) as r from l where title_of_class is not null group by 1, 2) where r = 1)
      select s.cusip, n.name_of_issuer, t.title_of_class, case when figi_count = 1 then f end as figi, figi_count,
        regexp_full_match(s.cusip, '[0-9A-Z*@#]{{8}}[0-9]') as is_well_formed,
        case when regexp_full_match(s.cusip, '[0-9A-Z*@#]{{8}}[0-9]') then
          (10 - cast(list_sum(list_transform(range(1, 9), lambda i: ((instr('{ALPHABET}', s.cusip[i]) - 1) * (2 - i % 2)) // 10 + ((instr('{ALPHABET}', s.cusip[i]) - 1) * (2 - i % 2)) % 10)) as bigint) % 10) % 10 = cast(s.cusip[9] as bigint) end as has_valid_check_digit,
        first_period, last_period
      from s left join n using (cusip) left join t using (cusip)""",
    "positions": """
      select cik, period_of_report, cusip, put_call, put_call is not null as is_option, count(*) as holding_count, count(distinct accession_number) as filing_count, cast(sum(value_usd) as bigint) as value_usd,
        case when count(distinct shares_or_principal_amount_type) = 1 and count(shares_or_principal_amount_type) = count(*) then min(shares_or_principal_amount_type) end as shares_or_principal_amount_type,
        case when count(distinct shares_or_principal_amount_type) = 1 and count(shares_or_principal_amount_type) = count(*) then cast(sum(shares_or_principal_amount) as bigint) end as shares_or_principal_amount
      from canonical group by 1, 2, 3, 4""",
    "dq_unit": "select s.*, u.median_value_per_share from state s join units u using (accession_number) where u.value_unit <> u.filing_date_unit",
    "prices": """
      select h.accession_number, s.period_of_report, h.cusip, round(cast(value_usd as double) / shares_or_principal_amount, 6) as price from holdings h join state s using (accession_number)
      where shares_or_principal_amount_type = 'SH' and shares_or_principal_amount > 0 and put_call is null""",
    "dq_yardstick": """
      select s.* from state s join (
        select p.accession_number, median(p.price / y.yard) as ratio from prices p
        join (select period_of_report, cusip, median(price) as yard from prices group by 1, 2 having count(*) >= 5 and median(price) > 0) y using (period_of_report, cusip) group by 1) r using (accession_number)
      where ratio < 0.01 or ratio > 100""",
    "portfolios": """
      select cik, period_of_report, count(*) filter (where not is_option) as position_count, count(*) filter (where is_option) as option_position_count,
        cast(coalesce(sum(value_usd) filter (where not is_option), 0) as bigint) as value_usd, cast(coalesce(sum(value_usd) filter (where is_option), 0) as bigint) as option_value_usd,
        sum(value_usd) filter (where not is_option and r <= 10) as top
      from (select *, row_number() over (partition by cik, period_of_report, is_option order by value_usd desc, cusip) as r from positions) group by 1, 2""",
    "filer_periods": """
      select p.cik, f.filer_name, p.period_of_report, d.previous_period,
        case when exists (select 1 from portfolios b where b.cik = p.cik and b.period_of_report = d.previous_period) then 'previous period'
             when exists (select 1 from lineage b where b.cik = p.cik and b.period_of_report = d.previous_period and b.filing_role <> 'notice') then 'previous report lists none'
             when exists (select 1 from lineage b where b.cik = p.cik and b.period_of_report = d.previous_period) then 'previous notice only' else 'no previous filing' end as comparison_basis,
        p.position_count, p.option_position_count, p.value_usd, p.option_value_usd,
        case when p.value_usd > 0 then cast(p.top as double) / cast(p.value_usd as double) end as top_ten_share,
        case when p.value_usd > 0 then (select sum((cast(q.value_usd as double) / cast(p.value_usd as double)) ** 2) from positions q where q.cik = p.cik and q.period_of_report = p.period_of_report and not q.is_option) end as hhi,
        c.confidential_omission,
        exists (select 1 from dq_unit q where q.cik = p.cik and q.period_of_report = p.period_of_report and q.is_contributing) as has_value_unit_override,
        exists (select 1 from dq_yardstick q where q.cik = p.cik and q.period_of_report = p.period_of_report and q.is_contributing) as has_value_off_yardstick
      from portfolios p left join periods d using (period_of_report) left join filers f using (cik)
      left join (select cik, period_of_report, case when count(*) filter (where is_confidential_omitted) > 0 then true when count(*) filter (where not is_confidential_omitted) = count(*) then false end as confidential_omission
                 from state where is_contributing group by 1, 2) c using (cik, period_of_report)""",
    "changes": """
      with k as (select cik, filer_name, period_of_report as p, previous_period as b from filer_periods where comparison_basis = 'previous period'),
      a as (select q.*, k.filer_name, k.p, k.b from positions q join k on k.cik = q.cik and k.p = q.period_of_report),
      z as (select q.*, k.filer_name, k.p, k.b from positions q join k on k.cik = q.cik and k.b = q.period_of_report),
      j as (select coalesce(a.cik, z.cik) as cik, coalesce(a.filer_name, z.filer_name) as filer_name, coalesce(a.p, z.p) as period_of_report, coalesce(a.b, z.b) as previous_period, coalesce(a.cusip, z.cusip) as cusip, coalesce(a.put_call, z.put_call) as put_call,
          a.cik is not null as held, z.cik is not null as was, a.shares_or_principal_amount_type as t, a.shares_or_principal_amount as n, z.shares_or_principal_amount_type as pt, z.shares_or_principal_amount as pn, a.value_usd as v, z.value_usd as pv
        from a full join z on a.cik = z.cik and a.p = z.p and a.cusip = z.cusip and coalesce(a.put_call, '') = coalesce(z.put_call, '')),
      c as (select *, coalesce(held and was and t = pt and n is not null and pn is not null, false) as ok from j)
      select c.cik, filer_name, period_of_report, previous_period, c.cusip, s.name_of_issuer, s.title_of_class, put_call, put_call is not null as is_option,
        case when not was then 'entry' when not held then 'exit' when not ok then 'not comparable' when n > pn then 'increase' when n < pn then 'decrease' else 'unchanged' end as change_kind,
        t as shares_or_principal_amount_type, n as shares_or_principal_amount, pt as previous_shares_or_principal_amount_type, pn as previous_shares_or_principal_amount, case when ok then n - pn end as amount_change, v as value_usd, pv as previous_value_usd
      from c left join securities s on s.cusip = c.cusip""",
    "overlapping": """
      with r as (select cik, filer_name, period_of_report, value_usd from (select *, row_number() over (partition by period_of_report order by value_usd desc, cik) as n from filer_periods where value_usd > 0) where n <= 100),
      w as (select p.cik, p.period_of_report, p.cusip, cast(p.value_usd as double) / cast(r.value_usd as double) as weight from positions p join r using (cik, period_of_report) where not p.is_option),
      s as (select a.period_of_report, a.cik, b.cik as other_cik, count(*) as n, sum(least(a.weight, b.weight)) as o from w a join w b on a.period_of_report = b.period_of_report and a.cusip = b.cusip and b.cik > a.cik group by 1, 2, 3)
      select a.period_of_report, a.cik, a.filer_name, b.cik as other_cik, b.filer_name as other_filer_name, coalesce(s.n, 0) as shared_securities, round(coalesce(s.o, 0), 9) as weight_overlap
      from r a join r b on a.period_of_report = b.period_of_report and b.cik > a.cik left join s on s.period_of_report = a.period_of_report and s.cik = a.cik and s.other_cik = b.cik""",
}
_KEYS = "cik, period_of_report, accession_number, origin"
_HELD = "(select s.*, h.cusip, h.put_call, h.shares_or_principal_amount, h.shares_or_principal_amount_type, h.investment_discretion, h.managers from state s join holdings h using (accession_number) where s.is_contributing)"
CHECKS: dict[str, str] = {
    "untyped_amendment": f"select {_KEYS} from state where is_amendment and amendment_type is null",
    "second_original": f"select {_KEYS} from state where submission_type = '13F-HR' and filing_role = 'restatement'",
    "cover_box_disagrees_with_submission_type": f"select {_KEYS} from state where coalesce(cover_is_amendment, false) <> is_amendment",
    "report_type_disagrees_with_submission_type": f"select {_KEYS} from state where (submission_type like '13F-NT%') <> (report_type = '13F NOTICE')",
    "period_disagrees_with_cover": f"select {_KEYS} from state where report_calendar_or_quarter is distinct from period_of_report",
    "lineage_starts_with_amendment": f"select {_KEYS} from state s where filing_role <> 'notice' and submission_type = '13F-HR/A' and filing_position = (select min(filing_position) from state b where b.cik = s.cik and b.period_of_report = s.period_of_report and b.filing_role <> 'notice')",
    "filings_of_one_date_across_submitters": f"select {_KEYS} from state s where filing_role <> 'notice' and exists (select 1 from state b where b.filing_role <> 'notice' and b.cik = s.cik and b.period_of_report = s.period_of_report and b.filing_date = s.filing_date and left(b.accession_number, 10) <> left(s.accession_number, 10))",
    "filing_order_set_by_amendment_number": f"select {_KEYS} from (select *, row_number() over (partition by cik, period_of_report order by {_ORDER}) as a, row_number() over (partition by cik, period_of_report order by filing_date, accession_number) as b from state where filing_role <> 'notice') where a <> b",
    "summary_disagrees_with_holdings": f"select {_KEYS} from state left join totals using (accession_number) where filing_role <> 'notice' and (table_entry_total is distinct from coalesce(n, 0) or table_value_total_as_filed is distinct from coalesce(v, 0))",
    "superseded_addition_not_restated": f"select {_KEYS} from state a where filing_role = 'addition' and is_superseded and exists (select 1 from holdings h where h.accession_number = a.accession_number and not exists (select 1 from state e join holdings g on g.accession_number = e.accession_number where e.cik = a.cik and e.period_of_report = a.period_of_report and e.filing_position = a.effective_position and g.cusip = h.cusip))",
    "repeated_security_in_addition": f"select distinct {_KEYS} from (select *, min(filing_position) over (partition by cik, period_of_report, cusip) as f from {_HELD}) where filing_role = 'addition' and f < filing_position",
    "addition_read_as_restatement": f"select {_KEYS} from state join coverage v using (accession_number, cik, period_of_report) where v.compared_securities > 0 and v.repeated_securities * 10 >= v.compared_securities * 9",
    "copied_holding_in_addition": f"select distinct {_KEYS} from (select *, min(filing_position) over (partition by cik, period_of_report, cusip, put_call, shares_or_principal_amount, shares_or_principal_amount_type, investment_discretion, array_to_string(managers, ',')) as f from {_HELD}) where filing_role = 'addition' and f < filing_position",
    "value_unit_overrides_filing_date_rule": f"select {_KEYS} from dq_unit",
    "value_off_yardstick_by_a_thousand": f"select {_KEYS} from dq_yardstick",
    "notice_with_holdings": f"select {_KEYS} from state where filing_role = 'notice' and accession_number in (select accession_number from holdings)",
}
CORE["dq"] = " union all ".join(f"select '{name}' as check_name, {_KEYS} from ({sql})" for name, sql in CHECKS.items())


def over(select: str, *needed: str) -> str:
    """A query over the shaped inputs and the named core tables, which are listed in order."""
    ctes = ", ".join(f"{name} as materialized ({CORE[name]})" for name in CORE if name in needed)
    return f"with {shaped_ctes()}{', ' + ctes if ctes else ''} {select}"


def needs(*names: str) -> list[str]:
    """The core tables that these need, themselves among them."""
    order = list(CORE)
    found = set(names)
    for name in reversed(order):
        if name in found:
            found |= {n for n in order if n != name and order.index(n) < order.index(name) and _mentions(CORE[name], n)}
    return [n for n in order if n in found]


def _mentions(sql: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", sql) is not None


def of(select: str, *names: str) -> str:
    return over(select, *needs(*names))
