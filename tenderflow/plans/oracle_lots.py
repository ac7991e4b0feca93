"""DuckDB oracles for the wide lot table, its tiers and the CPV dimension."""

from __future__ import annotations

from .oracle_sql import alpha2, cpv, currency, nuts3
from .oracle_tables import CPV_CODES, PTYPE, RATES, lid

RES = "http://example.org/res/"
SEP = " ||| "


def rank(x: str) -> str:
    return (f"(case when {x} like '%000000' then 0 when {x} like '%00000' then 1 when {x} like '%0000' then 2 "
            f"when {x} like '%000' then 3 else 4 end)")


CPV_DIM = f"""
{CPV_CODES},
cands as (
  select c.code, t.k, rpad(substr(c.code, 1, t.k), 8, '0') as cand
  from cpv_codes c, range(1, 6) t(k)
  where t.k <= case when length(rtrim(c.code, '0')) > 5 then 5 else length(rtrim(c.code, '0')) - 1 end),
ex as (select cands.* from cands join cpv_codes cc on cc.code = cands.cand),
anc as (
  select code, arg_max(cand, k) as parent,
         {", ".join(f"arg_max(cand, k) filter (where {rank('cand')} <= {r}) as a{r}" for r in range(5))}
  from ex group by code),
cpv_dim as (
  select c.code, c.label, {rank('c.code')} as rank, a.parent,
         {", ".join(f"case when {rank('c.code')} = {r} then c.code when {rank('c.code')} < {r} or {rank('c.code')} = 0 "
                    f"then null else a.a{r} end as anc{r}" for r in range(5))}
  from cpv_codes c left join anc a on a.code = c.code)"""

CPV_DIM_SQL = f"""
with {CPV_DIM}
select code, label, rank, parent, anc0, anc1, anc2, anc3, anc4 from cpv_dim"""


def _label(code_expr: str) -> str:
    return f"(select label from cpv_dim where code = {code_expr})"


def lots_sql(tier: str = "premium") -> str:
    cpv_ranks = {"free": [0], "starter": [0, 1], "premium": [0, 1, 2, 3, 4]}[tier]
    lot_nuts = {"free": [0], "starter": [0, 1], "premium": [0, 1, 2, 3]}[tier]
    org_limit = {"free": 1, "starter": 2, "premium": 4}[tier]
    pop = nuts3("l.l_partkey", "l.l_suppkey % 25")
    bnuts = nuts3("c.c_custkey", "c.c_nationkey")
    wnuts = nuts3("s.s_suppkey", "s.s_nationkey")
    cols = [
        f"'{RES}' || {lid('Lot')} as lot",
        "cast(cast(o.o_orderdate as date) as varchar) as publication_date",
        "case when c.c_acctbal > 0 then c.c_name else c.c_mktsegment || ' ' || c.c_custkey end as buyer_names",
        f"{bnuts} as buyer_nuts",
        "'id_' || o.o_orderkey || '_Procedure' as procedure",
        "'PROC-' || o.o_orderkey as procedure_id",
        "'Description du marche ' || o.o_orderkey as procedure_description",
        "case when s.s_acctbal > 0 then s.s_name else 'Fournisseur ' || s.s_suppkey end as winner_names",
        f"{wnuts} as winner_nuts",
        "l.l_extendedprice as lot_amount",
        f"{currency('l.l_suppkey')} as lot_currency",
        f"{pop} as place_of_performance",
        f"{_label(cpv('l.l_partkey'))} as main_cpvs",
        "case when o.o_orderstatus = 'F' then 'Procedure ' else 'Verfahren ' end || o.o_orderkey as procedure_title",
        f"{PTYPE} as procedure_type",
        f"""case when {currency('l.l_suppkey')} = 'EUR' then l.l_extendedprice
                 else coalesce(l.l_extendedprice / (select rate from rates r where r.currency = {currency('l.l_suppkey')}
                               and r.day = cast(o.o_orderdate as date)), 0.0) end as amount_value_eur""",
        "'https://notices.example.org/udl?uri=NOTICE:' || o.o_orderkey || '-' || year(o.o_orderdate) || "
        "':TEXT:EN:HTML' as notice_link",
        "case when l.l_tax >= 0.05 then 100 else 0 end as indicator_transparency_subcontract_info_available",
        "case when l.l_linestatus = 'O' then 100 else 0 end as indicator_transparency_duration_available",
        "100 as indicator_transparency_implementation_location_available",
        "case when l.l_returnflag = 'R' then 100 else 0 end as indicator_transparency_funding_info_available",
        "100 as indicator_transparency_product_codes_available",
        "100 as indicator_transparency_bidder_name_available",
        "case when l.l_extendedprice <> 0 then 100 else 0 end as indicator_transparency_contract_value_available",
        "case when o.o_orderpriority = '2-HIGH' then 100 else 0 end as indicator_administrative_joint_procurement",
        "case when o.o_orderstatus = 'F' then 100 else 0 end as indicator_administrative_use_of_framework_agreement",
        "case when o.o_orderstatus = 'O' then 100 else 0 end as indicator_administrative_electronic_auction",
        "case when o.o_orderstatus = 'F' then 100 else 0 end as indicator_administrative_use_of_wto",
        "case when o.o_orderpriority = '1-URGENT' then 100 else 0 end as indicator_integrity_procedure_type",
        f"""(select case when d.rank >= 1 then {_label("(case d.rank when 1 then d.anc0 when 2 then d.anc1 when 3 "
                                                      "then d.anc2 when 4 then d.anc3 end)")} end
             from cpv_dim d where d.code = {cpv('l.l_partkey')}) as cpv_parent""",
        f"cast((select rank from cpv_dim d where d.code = {cpv('l.l_partkey')}) as varchar) as cpv_level",
        f"(select name from ctry where a2 = substr({pop}, 1, 2)) as lots_country",
    ]
    ptype = "case when o.o_orderpriority = '1-URGENT' then 100 else 0 end"
    adm = ("((case when o.o_orderstatus = 'F' then 100 else 0 end) + (case when o.o_orderstatus = 'O' then 100 else 0 end)"
           " + (case when o.o_orderstatus = 'F' then 100 else 0 end) + (case when o.o_orderpriority = '2-HIGH' then 100 "
           "else 0 end))")
    tr = ("((case when l.l_tax >= 0.05 then 100 else 0 end) + (case when l.l_linestatus = 'O' then 100 else 0 end) + 100"
          " + (case when l.l_returnflag = 'R' then 100 else 0 end) + 100 + 100 + "
          "(case when l.l_extendedprice <> 0 then 100 else 0 end))")
    cols += [f"round(({ptype}) / 1.0, 2) as integrity_score", f"round({adm} / 4.0, 2) as administrative_score",
             f"round({tr} / 7.0, 2) as transparency_score",
             f"round((round(({ptype}) / 1.0, 2) + round({adm} / 4.0, 2) + round({tr} / 7.0, 2)) / 3.0, 2)"
             f" as good_procurement_score"]
    for r in cpv_ranks:
        cols.append(f"(select {_label(f'd.anc{r}')} from cpv_dim d where d.code = {cpv('l.l_partkey')}) as cpv{r}")
    for n in lot_nuts:
        cols.append(f"substr({pop}, 1, {n + 2}) as lots_nuts_{n}")
    for n in range(org_limit):
        cols.append(f"substr({bnuts}, 1, {n + 2}) as buyer_nuts_{n}")
        cols.append(f"substr({wnuts}, 1, {n + 2}) as winner_nuts_{n}")
    return f"""
with {RATES}, {CPV_DIM},
ctry as (select {alpha2('n_nationkey')} as a2, n_name as name from nation)
select distinct {", ".join(cols)}
from lineitem l join orders o on o.o_orderkey = l.l_orderkey join customer c on c.c_custkey = o.o_custkey
join supplier s on s.s_suppkey = l.l_suppkey"""
