"""DuckDB oracle SQL, written against the base tables (not the triples).

The graph mapping rules (``sources.testdata_kg``) are restated here in SQL so
the check is independent of the DataFrame code it verifies.
"""

from __future__ import annotations

RES = "http://example.org/res/"


def alpha2(nk: str) -> str:
    return f"(chr(cast(65 + (({nk}) // 26) % 26 as integer)) || chr(cast(65 + ({nk}) % 26 as integer)))"


def alpha3(nk: str) -> str:
    return f"({alpha2(nk)} || 'X')"


def nuts3(key: str, nk: str) -> str:
    return (f"({alpha2(nk)} || chr(cast(65 + ({key}) % 3 as integer)) || cast(1 + (({key}) // 3) % 4 as varchar)"
            f" || cast(1 + (({key}) // 12) % 5 as varchar))")


def cpv(pk: str) -> str:
    return (f"(cast(10 + ({pk}) % 40 as varchar) || cast((({pk}) // 40) % 4 as varchar) || "
            f"cast((({pk}) // 160) % 3 as varchar) || cast((({pk}) // 480) % 3 as varchar) || '000')")


def currency(key: str) -> str:
    return f"(['EUR','PLN','RON','BGN','XYZ'])[({key}) % 5 + 1]"


def row_iri(kind: str, a: str = "l") -> str:
    return (f"('{RES}id_' || {a}.l_orderkey || '_{kind}_' || {a}.l_linenumber || '-' || {a}.l_partkey || '-' "
            f"|| {a}.l_suppkey)")


def order_iri(kind: str, ok: str = "o.o_orderkey") -> str:
    return f"('{RES}id_' || {ok} || '_{kind}')"


def notice_iri(ok: str = "o.o_orderkey", d: str = "o.o_orderdate") -> str:
    return f"('{RES}id_' || year({d}) || '-S-001-' || {ok} || '_Notice')"


def org_iri(role: str, key: str, kind: str = "Organization") -> str:
    return f"('{RES}id_{role}_' || {key} || '_{kind}')"


COUNTRY = "'http://example.org/country/'"
CPV_NS = "'http://example.org/cpv/'"
CUR_NS = "'http://example.org/currency/'"
LOTKEY = "(l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey)"

# Number of distinct CPV codes over the lines of each order (procedure purpose multiplicity).
PROC_NCPV = f"(select l_orderkey, count(distinct {cpv('l_partkey')}) as n_cpv from lineitem group by 1)"


def _eu_tender_value(country_expr: str, country_col: str, buyer_factor: bool) -> str:
    nb = ""
    factor = "x.n_cpv"
    if buyer_factor:
        nb = (f" join (select {COUNTRY} || {alpha3('c.c_nationkey')} as cc, count(*) as n_b from orders o "
              f"join customer c on c.c_custkey = o.o_custkey group by 1) b on b.cc = {COUNTRY} || {country_expr}")
        factor = "x.n_cpv * b.n_b"
    return f"""
select {COUNTRY} || {country_expr} as {country_col},
       count(distinct {row_iri('Winner')}) as Nr_of_winners,
       cast(sum(cast(l.l_extendedprice as decimal(20,2)) * {factor}) as double) as TotalProcurementValue,
       min({CUR_NS} || {currency('l.l_suppkey')}) as CurrencyID
from lineitem l join supplier s on s.s_suppkey = l.l_suppkey
join {PROC_NCPV} x on x.l_orderkey = l.l_orderkey
join orders o on o.o_orderkey = l.l_orderkey{nb}
where l.l_returnflag = 'R'
group by 1"""


REPORT_SQL = {
    "report_q1": f"""
select {COUNTRY} || {alpha3('c.c_nationkey')} as BuyerCountry, count(distinct {LOTKEY}) as Lots_using_EU_Funds
from lineitem l join orders o on o.o_orderkey = l.l_orderkey join customer c on c.c_custkey = o.o_custkey
where l.l_returnflag = 'R' group by 1""",
    "report_q2": f"""
select {alpha3('s.s_nationkey')} as Winner_Country, count(distinct {LOTKEY}) as Lots_using_EU_Funds
from lineitem l join supplier s on s.s_suppkey = l.l_suppkey
where l.l_returnflag = 'R' group by 1""",
    "report_q3": _eu_tender_value(alpha3("s.s_nationkey"), "Country", True),
    "report_q3_dedup": _eu_tender_value(alpha3("s.s_nationkey"), "Country", False).replace(
        "where l.l_returnflag = 'R'",
        f"where l.l_returnflag = 'R' and s.s_nationkey in (select c_nationkey from customer c join orders o "
        f"on o.o_custkey = c.c_custkey)"),
    "report_q4": _eu_tender_value(alpha3("s.s_nationkey"), "WinnerCountry", False),
    "report_q5": """
select count(distinct c.c_custkey) as Nr_of_Organizations
from orders o join customer c on c.c_custkey = o.o_custkey""",
    "report_q6": f"""
select distinct {org_iri('customer', 'c.c_custkey')} as Organization, cast(cast(o.o_orderdate as date) as varchar) as DispatchDate,
       {alpha3('c.c_nationkey')} as CountryCode
from orders o join customer c on c.c_custkey = o.o_custkey""",
    "report_q7": f"""
select {order_iri('Procedure')} as Procedure, {order_iri('Technique')} as TechniqueUsage
from orders o where o.o_orderstatus <> 'F'""",
    "report_q8": f"""
select {order_iri('Procedure')} as Procedure from orders o where o.o_orderstatus = 'P'""",
    "report_q9": f"""
select {order_iri('Procedure')} as Procedure, cast(cast(o.o_orderdate as date) as varchar) as DispatchDate,
       count(*) as Nr_of_lots_per_Procedure
from lineitem l join orders o on o.o_orderkey = l.l_orderkey
where cast(l.l_quantity as integer) % 5 = 1 group by 1, 2""",
    "report_q10": f"""
select {order_iri('Procedure')} as Procedure, cast(cast(o.o_orderdate as date) as varchar) as DispatchDate,
       count(*) as Nr_of_lots_per_Procedure
from lineitem l join orders o on o.o_orderkey = l.l_orderkey
where cast(l.l_quantity as integer) % 5 = 1 and date_trunc('month', o.o_orderdate) = date '1999-01-01'
group by 1, 2""",
    "report_q14": f"""
select {row_iri('Winner')} as Winner, cast(cast(o.o_orderdate as date) as varchar) as AnnounceDate,
       {alpha3('s.s_nationkey')} as CountryCode
from lineitem l join orders o on o.o_orderkey = l.l_orderkey join supplier s on s.s_suppkey = l.l_suppkey""",
    "report_q15": """
select cast(sum(n) as bigint) as Total_Awardet_Lots from (
  select l.l_orderkey, count(*) as n from lineitem l join orders o on o.o_orderkey = l.l_orderkey
  where cast(o.o_orderdate as date) > date '2000-01-01' and cast(o.o_orderdate as date) < date '2030-12-31'
  group by 1 having count(*) > 1)""",
    "report_q16": """
select cast(sum(n) as bigint) as Total_Awardet_Lots from (
  select l.l_orderkey, count(*) as n from lineitem l join orders o on o.o_orderkey = l.l_orderkey
  where cast(o.o_orderdate as date) > date '2000-01-01' and cast(o.o_orderdate as date) < date '2030-12-31'
  group by 1 having count(*) = 1)""",
    "report_q24": f"""
select distinct case when s.s_acctbal > 1000 then 'SUPP-' || s.s_suppkey end as IdValue,
       {org_iri('supplier', 's.s_suppkey')} as Business, {alpha3('s.s_nationkey')} as CountryCode
from supplier s""",
    "report_q25": f"""
select distinct case when c.c_acctbal > 1000 then 'CUST-' || c.c_custkey end as IdValue,
       {order_iri('Buyer')} as Buyer, {alpha3('c.c_nationkey')} as CountryCode
from orders o join customer c on c.c_custkey = o.o_custkey""",
    "report_q26": f"""
with names as (
  select s_suppkey, s_name as nm from supplier where s_acctbal > 0
  union all select s_suppkey, 'Fournisseur ' || s_suppkey from supplier)
select distinct 'supplier' || l.l_suppkey || '@supplier.example' as CustomerEmail, n.nm as CustomerName,
       'Contract ' || l.l_orderkey as ContractTitle, {CPV_NS} || {cpv('l.l_partkey')} as LotCPV,
       cast(cast(o.o_orderdate as date) as varchar) as ContractConclusionDate,
       cast(cast(l.l_extendedprice as decimal(20,2)) as double) as TotalValue, {CUR_NS} || {currency('l.l_suppkey')} as Currency
from lineitem l join orders o on o.o_orderkey = l.l_orderkey join names n on n.s_suppkey = l.l_suppkey""",
    "report_q27": """
select count(*) as nr_of_tenders, count(*) filter (where l_tax >= 0.05) as nr_of_subc,
       round(count(*) filter (where l_tax >= 0.05) / count(*) * 100, 6) as percent
from lineitem""",
    "kpi_sme": """
select count(distinct s.s_suppkey) as Nr_of_SME from lineitem l join supplier s on s.s_suppkey = l.l_suppkey
where s.s_acctbal < 5000""",
    "kpi_missing_seller_reg": """
select round(100.0 * count(*) filter (where s_acctbal <= 1000) / count(*), 2) as Missing_seller_reg_numbers
from supplier""",
    "kpi_missing_buyer_reg": """
select round(100.0 * count(*) filter (where c.c_acctbal <= 1000) / count(*), 2) as Missing_buyer_reg_numbers
from orders o join customer c on c.c_custkey = o.o_custkey""",
    "kpi_organizations": """
select count(distinct o_custkey) as Nr_of_Organizations from orders o join customer c on c.c_custkey = o.o_custkey""",
    "report_delta": """
with m as (select cast(date_trunc('month', l_shipdate)::date as varchar) as month,
                  count(distinct (l_orderkey, l_linenumber, l_partkey, l_suppkey)) as awarded_lots
           from lineitem group by 1)
select month, awarded_lots, cast(awarded_lots - lag(awarded_lots) over (order by month) as double) as delta from m""",
}
