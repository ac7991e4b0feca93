"""DuckDB oracles for the table builds (T1-T19), dimensions and conversions."""

from __future__ import annotations

from .oracle_sql import alpha2, alpha3, cpv, currency, nuts3

RES = "http://example.org/res/"


def lid(kind: str, a: str = "l") -> str:
    """Local name of a per-line entity."""
    return f"('id_' || {a}.l_orderkey || '_{kind}_' || {a}.l_linenumber || '-' || {a}.l_partkey || '-' || {a}.l_suppkey)"


def oid(kind: str, ok: str = "o.o_orderkey") -> str:
    return f"('id_' || {ok} || '_{kind}')"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"


RATES = """
rates as (
  select c.currency, m.day, round(c.base * (1 + ((year(m.day) * 12 + month(m.day)) % 7) / 100.0), 5) as rate
  from (select cast(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate),
                                            interval 1 month)) as date) as day from orders) m,
       (values ('PLN', 4.25), ('RON', 4.75), ('BGN', 1.95583)) c(currency, base)),
latest as (select currency, arg_max(rate, day) as rate from rates group by 1)"""


def eur(amount: str, cur: str, lr: str) -> str:
    """Latest-rate conversion to EUR truncated to bigint; unknown currency -> 0."""
    return (f"cast(trunc(coalesce(case when {cur} = 'EUR' then {amount} else {amount} / {lr}.rate end, 0))"
            f" as bigint)")


LINK = "'https://notices.example.org/udl?uri=NOTICE:' || o.o_orderkey || '-' || year(o.o_orderdate) || ':TEXT:EN:HTML'"
PTYPE = ("case o.o_orderpriority when '1-URGENT' then 'open' when '2-HIGH' then 'restricted' "
         "when '3-MEDIUM' then 'neg-w-call' when '4-NOT SPECIFIED' then 'comp-dial' when '5-LOW' then 'neg-wo-call' end")

# Organisations announced in a role: customers with an order, suppliers with a line.
ORGS = f"""
orgs as (
  select 'customer' as role, c.c_custkey as k, c.c_nationkey as nk, c.c_acctbal as bal,
         case when c.c_acctbal > 0 then c.c_name else c.c_mktsegment || ' ' || c.c_custkey end as legal_name,
         c.c_name as contact_name
  from customer c where c.c_custkey in (select o_custkey from orders)
  union all
  select 'supplier', s.s_suppkey, s.s_nationkey, s.s_acctbal,
         case when s.s_acctbal > 0 then s.s_name else 'Fournisseur ' || s.s_suppkey end, s.s_name
  from supplier s where s.s_suppkey in (select l_suppkey from lineitem))"""

CPV_CODES = f"""
cpv_codes as (
  select code, min(label) as label from (
    select {cpv('p_partkey')} as code, {initcap('p_name')} as label from part
    union all
    select substr({cpv('p_partkey')}, 1, 2) || '000000', 'Division ' || substr({cpv('p_partkey')}, 1, 2) from part)
  group by code)"""

NUTS_CODES = f"""
nuts_org as (
  select {nuts3('c_custkey', 'c_nationkey')} as code from customer
  union all select {nuts3('s_suppkey', 's_nationkey')} from supplier),
nuts_codes0 as (
  select distinct c as code, lvl as level from (
    select substr(code, 1, 2) as c, 0 as lvl from nuts_org union all
    select substr(code, 1, 3), 1 from nuts_org union all
    select substr(code, 1, 4), 2 from nuts_org union all
    select code, 3 from nuts_org union all
    select substr({nuts3('l_partkey', 'l_suppkey % 25')}, 1, 2), 0 from lineitem union all
    select {nuts3('l_partkey', 'l_suppkey % 25')}, 3 from lineitem)),
nuts_codes as (
  select n.code, case when n.level = 0 then c.name else 'Region ' || n.code end as label, n.level
  from nuts_codes0 n left join (select {alpha2('n_nationkey')} as a2, n_name as name from nation) c on c.a2 = n.code)"""


def _walk(tax: str, name: str) -> str:
    """Recursive parent walk over (code, parent): (code, anc, depth); a missing parent ends it."""
    return f"""
{name} as (
  with recursive w(code, anc, depth, known) as (
    select code, code, 0, true from (select distinct code from {tax})
    union all
    select w.code, p.parent, w.depth + 1, p.parent in (select code from {tax})
    from w join (select code, min(parent) as parent from {tax} group by code) p on p.code = w.anc
    where w.known and p.parent is not null)
  select * from w)"""


CPV_TAX = f"""
cpv_tax as (
  select code, label,
         case when length(rtrim(code, '0')) < 2 then null
              when length(rtrim(code, '0')) > 5 then substr(code, 1, 5) || '000'
              else rpad(substr(code, 1, length(rtrim(code, '0')) - 1), 8, '0') end as parent
  from cpv_codes)"""


def _cpv_table() -> str:
    sel = []
    for k in range(6):
        sel.append(f"(select anc from cpv_walk w where w.code = t.code and w.depth = lv.level - {k}) as CPV{k}")
    inner = ",\n       ".join(sel)
    outer = ", ".join([f"CPV{k}, (select label from cpv_lab where code = CPV{k}) as CPV{k}Label" for k in range(6)])
    return f"""
with {CPV_CODES}, {CPV_TAX}, {_walk('cpv_tax', 'cpv_walk')},
cpv_lab as (select code, min(label) as label from cpv_tax group by code),
lv as (select code, max(depth) as level from cpv_walk group by code),
base as (
  select t.code as OriginalCPV, t.label as OriginalCPVLabel, cast(lv.level as integer) as OriginalCPVLevel,
       {inner}
  from cpv_tax t join lv on lv.code = t.code)
select distinct OriginalCPV, OriginalCPVLabel, OriginalCPVLevel, {outer} from base"""


def _nuts_table() -> str:
    sel = ",\n       ".join(
        f"(select anc from nuts_walk w where w.code = t.code and w.depth = lv.level - {k}) as NUTS{k}" for k in range(4))
    outer = ", ".join(f"NUTS{k}, (select label from tax_lab where code = NUTS{k}) as NUTS{k}Label, "
                      f"(select label from eng where code = NUTS{k}) as NUTS{k}LabelEng" for k in range(4))
    return f"""
with {NUTS_CODES},
nuts_tax as (
  select code, label, case when level > 0 then substr(code, 1, length(code) - 1) end as parent from nuts_codes
  union all
  select code, lower(label), substr(code, 1, length(code) - 1) from nuts_codes where level > 0),
{_walk('nuts_tax', 'nuts_walk')},
tax_lab as (select code, min(label) as label from nuts_tax group by code),
eng as (select code, min(label) as label from nuts_codes group by code),
lv as (select code, max(depth) as level from nuts_walk group by code),
base as (
  select t.code as NUTSId, t.label as NUTSLabel, (select label from eng where code = t.code) as NUTSLabelEng,
       {sel}
  from nuts_tax t join lv on lv.code = t.code)
select distinct NUTSId, NUTSLabel, NUTSLabelEng, {outer} from base"""


TABLE_SQL = {
    "table_notice": f"""
with {RATES}
select {oid('Notice').replace("'id_' || o.o_orderkey", "'id_' || year(o.o_orderdate) || '-S-001-' || o.o_orderkey")}
         as NoticeId,
       cast(cast(o.o_orderdate as date) as varchar) as NoticePublicationDate, {oid('Procedure')} as ProcedureId,
       case when o.o_orderstatus = 'F' then {eur('o.o_totalprice', currency('o.o_custkey'), 'lr')} else 0 end
         as TotalAwardedValueEUR,
       {LINK} as NoticeLink, cast(year(o.o_orderdate) as varchar) as NoticeYear,
       cast(o.o_orderkey as varchar) as NoticeNumber
from orders o left join latest lr on lr.currency = {currency('o.o_custkey')}""",
    "table_procedure": f"""
with {RATES}
select {oid('Procedure')} as ProcedureId,
       case when o.o_orderstatus = 'F' then 'Procedure ' else 'Verfahren ' end || o.o_orderkey as ProcedureTitle,
       'PROC-' || o.o_orderkey as ReferenceNumber,
       {eur('o.o_totalprice', currency('o.o_custkey'), 'lr')} as ProcedureEstimatedValueEUR,
       {PTYPE} as ProcedureType, o.o_orderstatus = 'F' as isCoveredByGPA,
       case when o.o_orderstatus = 'O' then 'Order of customer ' || o.o_custkey
            else 'Description du marche ' || o.o_orderkey end as ProcedureDescription,
       case when o.o_orderstatus = 'P' then 'Additional information ' || o.o_orderkey end
         as ProcedureAdditionalInformation
from orders o left join latest lr on lr.currency = {currency('o.o_custkey')}""",
    "table_lot": f"""
with {RATES}
select distinct {lid('Lot')} as LotId, {oid('Procedure', 'l.l_orderkey')} as ProcedureId,
       case when l.l_linestatus = 'F' then 'Lot ' || l.l_linenumber || ' of ' || l.l_orderkey
            else 'Czesc ' || l.l_linenumber || ' z ' || l.l_orderkey end as LotTitle,
       l.l_returnflag = 'R' as isUsingEUFunds,
       {eur('l.l_extendedprice', currency('l.l_suppkey'), 'lr')} as LotEstimatedValueEUR,
       case when l.l_returnflag = 'A' then 'Supply of part ' || l.l_partkey else 'Descriere lot ' || l.l_partkey end
         as LotDescription
from lineitem l left join latest lr on lr.currency = {currency('l.l_suppkey')}""",
    "table_lot_award_outcome": f"""
with {RATES}
select distinct {lid('LotAwardOutcome')} as LotAwardOutcomeId,
       case l.l_linestatus when 'F' then 'selec-w' when 'O' then 'open-nw' end as AwardStatus,
       {eur('l.l_extendedprice', currency('l.l_suppkey'), 'lr')} as LotAwardedValueEUR,
       cast(0 as bigint) as LotBargainPriceEUR,
       cast(cast(l.l_shipdate as date) as varchar) as AwardDecisionDate
from lineitem l left join latest lr on lr.currency = {currency('l.l_suppkey')}""",
    "table_lot_award": f"""
select distinct {lid('Lot')} || {lid('LotAwardOutcome')} as LotAwardId, {lid('LotAwardOutcome')} as LotAwardOutcomeId,
       {lid('Lot')} as LotId
from lineitem l""",
    "table_submission_statistics": f"""
with {RATES}
select distinct {lid('SubmissionStatisticalInformation')} as SubmissionStatisticalInformationId,
       cast(cast(l.l_quantity as integer) % 3 as double) as hasReceivedSMETenders,
       cast(cast(l.l_quantity as integer) % 5 as double) as hasReceivedTenders,
       {eur('l.l_extendedprice', currency('l.l_suppkey'), 'lr')} as HighestReceivedTenderValueEUR,
       case when l.l_linestatus = 'F' then {eur('l.l_extendedprice', currency('l.l_suppkey'), 'lr')} else 0 end
         as LowestReceivedTenderValueEUR,
       cast(cast(l.l_quantity as integer) % 4 as double) as hasEUReceivedTenders,
       case when l.l_returnflag <> 'N' then cast(l.l_linenumber % 2 as double) end as hasReceivedNonEUTenders,
       cast(l.l_linenumber % 3 as double) as hasElectronicTenders,
       {lid('LotAwardOutcome')} as LotAwardOutcomeId
from lineitem l left join latest lr on lr.currency = {currency('l.l_suppkey')}""",
    "table_buyer": f"""
select distinct {oid('Procedure')} || 'id_customer_' || o.o_custkey || '_Organization' as ProcedureOrganizationId,
       {oid('Procedure')} as ProcedureId, 'id_customer_' || o.o_custkey || '_Organization' as OrganizationId,
       {oid('BuyerContactPoint')} as ContactPointId
from orders o where o.o_orderpriority = '1-URGENT'""",
    "table_winner": f"""
select distinct {lid('LotAwardOutcome')} || 'id_supplier_' || l.l_suppkey || '_Organization'
         as LotAwardOutcomeOrganizationId,
       {lid('LotAwardOutcome')} as LotAwardOutcomeId, 'id_supplier_' || l.l_suppkey || '_Organization' as OrganizationId,
       'id_supplier_' || l.l_suppkey || '_ContactPoint' as ContactPointId
from lineitem l""",
    "table_organization": f"""
with {ORGS}
select distinct 'id_' || role || '_' || k || '_Organization' as OrganizationId, legal_name as LegalName from orgs""",
    "table_address": f"""
with {ORGS}
select distinct 'id_' || role || '_' || k || '_Address' as AddressId, {alpha3('nk')} as CountryCode,
       {nuts3('k', 'nk')} as NUTSId, cast(k + 10000 as varchar) as PostCode, 'City ' || nk as PostName,
       case when bal > 1000 then 'Street ' || k end as Thoroughfare
from orgs""",
    "table_organization_address": f"""
with {ORGS}
select distinct 'id_' || role || '_' || k || '_Organization' || 'id_' || role || '_' || k || '_Address'
         as OrganizationAddressId,
       'id_' || role || '_' || k || '_Organization' as OrganizationId, 'id_' || role || '_' || k || '_Address' as AddressId
from orgs""",
    "table_contact_point": f"""
with {ORGS}
select distinct 'id_' || role || '_' || k || '_ContactPoint' as ContactPointId,
       case when bal > 5000 then '+32 3 ' || k end as ContactPointFax, '+32 2 ' || k as ContactPointTelephone,
       contact_name as ContactPointName
from orgs
union
select {oid('BuyerContactPoint')}, null, null, null from orders o where o.o_orderpriority = '1-URGENT'""",
    "table_contact_point_email": f"""
with {ORGS}
select distinct 'id_' || role || '_' || k || '_ContactPoint' || role || k || '@' || role || '.example'
         as ContactPointEmailId,
       'id_' || role || '_' || k || '_ContactPoint' as ContactPointId, role || k || '@' || role || '.example' as Email
from orgs
union
select {oid('BuyerContactPoint')} || 'procurement' || o.o_orderkey || '@buyer.example', {oid('BuyerContactPoint')},
       'procurement' || o.o_orderkey || '@buyer.example'
from orders o where o.o_orderpriority = '1-URGENT'""",
    "table_contact_point_internet_address": f"""
with {ORGS}
select distinct 'id_' || role || '_' || k || '_ContactPoint' || 'http://www.' || role || k || '.example'
         as ContactPointInternetAddressId,
       'id_' || role || '_' || k || '_ContactPoint' as ContactPointId, 'http://www.' || role || k || '.example'
         as InternetAddress
from orgs where bal < 2000""",
    "table_place_of_performance": f"""
select distinct {lid('Lot')} || {lid('LotAddress')} as LotAddressId, {lid('Lot')} as LotId,
       {nuts3('l.l_partkey', 'l.l_suppkey % 25')} as NUTSId,
       case when l.l_linestatus = 'O' then 'Site of part ' else 'Lieu ' end || l.l_partkey as FullAddress
from lineitem l""",
    "table_lot_cpv": f"""
select distinct {lid('Lot')} || {cpv('l.l_partkey')} as LotCPVId, {lid('Lot')} as LotId,
       {cpv('l.l_partkey')} as OriginalCPV
from lineitem l""",
    "table_procedure_cpv": f"""
select distinct {oid('Procedure', 'l.l_orderkey')} || {cpv('l.l_partkey')} as ProcedureCPVId,
       {oid('Procedure', 'l.l_orderkey')} as ProcedureId, {cpv('l.l_partkey')} as OriginalCPV
from lineitem l""",
    "table_cpv": _cpv_table(),
    "table_nuts": _nuts_table(),
}
