"""DuckDB SQL of record linkage: all pairs of a block compared, recursive reachability for the clusters."""

from __future__ import annotations

from ..operators.linkage import DEFAULT_MODEL
from ..vocab import LINK_THRESHOLD
from .oracle_tables import ORGS, alpha3


def _case(levels: dict, tests: dict[str, str]) -> str:
    whens = " ".join(f"when {tests[lvl]} then log2({m}::double / {u}::double)" for lvl, (m, u) in levels.items() if lvl != "else")
    m, u = levels["else"]
    return f"case when {tests['null']} then 0 {whens} else log2({m}::double / {u}::double) end"


def link_sql(records: str, out: str, known: str = "select null as id where false", rest: str = "") -> str:
    """``records``: SELECT of (id, name, address, block); ``out``: SELECT list over (src, dst, p); ``known``: SELECT of the ids of
    reference records, which head their clusters; ``rest``: what follows the last FROM."""
    name = _case(DEFAULT_MODEL["name"], {
        "null": "l.name is null or r.name is null", "exact": "l.name = r.name",
        "dl1": "damerau_levenshtein(l.name, r.name) <= 1", "jw90": "jaro_winkler_similarity(l.name, r.name) >= 0.9",
        "jw80": "jaro_winkler_similarity(l.name, r.name) >= 0.8"})
    address = _case(DEFAULT_MODEL["address"], {
        "null": "l.address is null or r.address is null", "exact": "l.address = r.address",
        "jw90": "jaro_winkler_similarity(l.address, r.address) >= 0.9",
        "jw70": "jaro_winkler_similarity(l.address, r.address) >= 0.7"})
    prior = DEFAULT_MODEL["prior"]
    return f"""
with recursive raw as ({records}),
known as materialized ({known}),
rec as materialized (
  select id, nullif(lower(trim(name)), '') as name, nullif(lower(trim(address)), '') as address, block from raw),
scored as materialized (
  select l.id as l, r.id as r, log2({prior}::double / (1 - {prior}::double)) + {name} + {address} as w
  from rec l join rec r on l.block = r.block and l.id < r.id),
hit as materialized (
  select l, r, pow(2, w) / (1 + pow(2, w)) as p from scored where pow(2, w) / (1 + pow(2, w)) >= {LINK_THRESHOLD}),
both_ways as materialized (select l as a, r as b, p from hit union all select r, l, p from hit),
reach as (select a as node, a as seen from both_ways
          union select reach.node, x.b from reach join both_ways x on x.a = reach.seen),
cluster as (select node, coalesce(min(seen) filter (where seen in (select id from known)), min(seen)) as dst from reach group by node),
best as (select a, max(p) as p from both_ways group by a),
linked as (select rec.id as src, coalesce(c.dst, rec.id) as dst,
                  case when coalesce(c.dst, rec.id) = rec.id then 1.0::double else best.p end as p
           from rec left join cluster c on c.node = rec.id left join best on best.a = rec.id)
select {out} from linked {rest}"""


LINK_RECORDS_SQL = link_sql(
    "select cast(p_partkey as varchar) as id, p_name as name, p_brand as address, p_type as block from part",
    "src as unique_id_src, dst as unique_id_dst, round(p, 9) as match_probability")

_PARTS = "select cast(p_partkey as varchar) as id, p_name as name, p_brand as address, p_type as block from part"
_KNOWN_PARTS = "select cast(p_partkey as varchar) as id from part where p_size > 25"
REFERENCE_LINKS_SQL = link_sql(_PARTS, "src as unique_id_src, dst as unique_id_dst, round(p, 9) as match_probability",
                               _KNOWN_PARTS, "where src not in (select id from known)")
REFERENCE_GROWN_SQL = link_sql(_PARTS, "src as id, src not in (select id from known) as is_new", _KNOWN_PARTS,
                               "where src in (select id from known) or src = dst")

_ORG_ADDRESS = f"""
with {ORGS}
select distinct 'id_' || role || '_' || k || '_Organization' || 'id_' || role || '_' || k || '_Address' as id,
       legal_name as name,
       concat_ws(' ', case when bal > 1000 then 'Street ' || k end, cast(k + 10000 as varchar), 'City ' || nk) as address,
       {alpha3('nk')} as block
from orgs"""

ORGANIZATION_DEDUPLICATION_SQL = link_sql(
    _ORG_ADDRESS,
    "src as OrganizationAddressId, dst as ReferenceOrganizationAddressId, round(p, 9) as MatchProbability, "
    "src || dst as OrganizationDeduplicationId")
