"""Queries over files that Spark writes from the given tables and reads again: JSON arrays, CSV, reindexed copies."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import keyed as K
from ..operators import search as S
from ..operators.taxonomy import lookup
from ..session import scratch_path
from ..sources import csv_tables as C
from ..sources import dims as D
from ..sources import tender_files as TF
from ..sources.tables import Tables
from ..sources.testdata_kg import currency_of, nuts3
from .catalog import register
from .oracle_sql import alpha2, currency
from .oracle_sql import nuts3 as nuts3_sql
from .oracle_tables import NUTS_CODES

ORDERS_A_FILE = 2000


def _tenders(spark, sf_dir: str, fields: list[str]) -> DataFrame:
    docs = TF.order_tenders(spark, sf_dir)
    path = scratch_path(spark, f"tenders-{uuid.uuid4().hex}")
    TF.write_json_arrays(docs, path, docs_a_file=ORDERS_A_FILE)
    return TF.read_json_arrays(spark, path, fields)


def _tender_rows(spark, sf_dir: str) -> DataFrame:
    """A row per buyer, lot, bid and bidder; only where there is a bidder."""
    d = _tenders(spark, sf_dir, ["tender.id", "tender.buyers.name", "tender.lots.lotId", "tender.lots.bids.bidId",
                                 "tender.lots.bids.price.netAmount", "tender.lots.bids.bidders.id", "tender.lots.bids.bidders.isSme"])
    d = d.select(F.col("tender.id").alias("tender_id"), F.explode("tender.buyers").alias("buyer"), "tender.lots")
    d = d.select("tender_id", F.col("buyer.name").alias("buyer_name"), F.explode("lots").alias("lot"))
    d = d.select("tender_id", "buyer_name", F.col("lot.lotId").alias("lot_id"), F.explode("lot.bids").alias("bid"))
    d = d.select("tender_id", "buyer_name", "lot_id", "bid.bidId", "bid.price.netAmount", F.explode("bid.bidders").alias("b"))
    return d.select("tender_id", "buyer_name", "lot_id", F.col("bidId").alias("bid_id"), F.col("netAmount").alias("bid_price"),
                    F.col("b.id").alias("bidder_id"), F.col("b.isSme").alias("bidder_is_sme"))


def _tender_bids(spark, sf_dir: str) -> DataFrame:
    """Every level kept, a bid without bidders and a tender without lots too."""
    d = _tenders(spark, sf_dir, ["tender.id", "tender.lots.lotId", "tender.lots.bids.bidId", "tender.lots.bids.bidders.id"])
    d = d.select(F.col("tender.id").alias("tender_id"), F.explode_outer("tender.lots").alias("lot"))
    d = d.select("tender_id", F.col("lot.lotId").alias("lot_id"), F.explode_outer("lot.bids").alias("bid"))
    d = d.select("tender_id", "lot_id", F.col("bid.bidId").alias("bid_id"), F.explode_outer("bid.bidders").alias("b"))
    return d.select("tender_id", "lot_id", "bid_id", F.col("b.id").alias("bidder_id"))


_BID = "(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey)"
_WITH = f"""
bids as (select 'T' || l_orderkey as tender_id, l_orderkey, l_returnflag as lot_id, {_BID} as bid_id, l_extendedprice as bid_price,
                l_linestatus = 'F' as winning, l_linenumber, l_suppkey, {currency('l_suppkey')} as currency,
                row_number() over () as bid_no from lineitem),
bidders as (select bid_no, s.* from bids join supplier s on s.s_suppkey = l_suppkey where l_linenumber % 3 <> 0
            union all
            select bid_no, s.* from bids join supplier s on s.s_suppkey = l_suppkey % 5 + 1
            where l_linenumber % 3 <> 0 and l_linenumber % 2 = 0),
buyers as (select o_orderkey, c.* from orders join customer c on c_custkey = o_custkey
           union all
           select o_orderkey, c.* from orders join customer c on c_custkey = o_custkey % 7 + 1 where o_orderkey % 3 = 0)"""

register("tender_rows", f"""
with {_WITH}
select tender_id, y.c_name as buyer_name, lot_id, bid_id, bid_price, 'S' || s_suppkey as bidder_id, s_acctbal < 5000 as bidder_is_sme
from bids join bidders using (bid_no) join buyers y on y.o_orderkey = l_orderkey""")(_tender_rows)
register("tender_bids", f"""
with {_WITH}
select 'T' || o.o_orderkey as tender_id, lot_id, bid_id, 'S' || s_suppkey as bidder_id
from orders o left join bids on l_orderkey = o.o_orderkey left join bidders using (bid_no)""")(_tender_bids)

_SEARCH_FIELDS = ["tender.id", "tender.title", "tender.buyers.address.country", "tender.lots.bids.isWinning", "tender.lots.bids.price",
                  "tender.lots.bids.bidders"]
#: one winning bid of 40,000 or more with a small bidder in it
WINNING_SME = S.nested("tender.lots.bids", S.all_of(S.term("isWinning", True), S.between("price.netAmount", low=40000.0),
                                                    S.term("bidders.isSme", True)))
#: a bid in euros somewhere, no bidder of the country AB anywhere, a buyer of AC or AD or an urgent or low priority title
MIXED = S.all_of(S.term("tender.lots.bids.price.currency", "EUR"), S.none_of(S.term("tender.lots.bids.bidders.address.country", "AB")),
                 S.any_of(S.terms("tender.buyers.address.country", ["AC", "AD"]), S.match("tender.title", "urgent LOW")))
#: no bid has a bidder
NO_BIDDER = S.none_of(S.exists("tender.lots.bids.bidders.id"))


def _search(condition):
    return lambda spark, sf_dir: S.search(_tenders(spark, sf_dir, _SEARCH_FIELDS), condition, ["tender.id"])


register("search_nested", f"""
with {_WITH}
select distinct tender_id as id from bids join bidders using (bid_no) where winning and bid_price >= 40000 and s_acctbal < 5000""")(
    _search(WINNING_SME))
register("search_mixed", f"""
with {_WITH}
select 'T' || o.o_orderkey as id from orders o
where exists (select 1 from bids where l_orderkey = o.o_orderkey and currency = 'EUR')
  and not exists (select 1 from bids join bidders using (bid_no) where l_orderkey = o.o_orderkey and {alpha2('s_nationkey')} = 'AB')
  and (exists (select 1 from buyers y where y.o_orderkey = o.o_orderkey and {alpha2('c_nationkey')} in ('AC', 'AD'))
       or o_orderpriority in ('1-URGENT', '5-LOW'))""")(_search(MIXED))
register("search_missing", f"""
with {_WITH}
select 'T' || o.o_orderkey as id from orders o
where not exists (select 1 from bids join bidders using (bid_no) where l_orderkey = o.o_orderkey)""")(_search(NO_BIDDER))


# ---- S5-S7: CSV ------------------------------------------------------------------
def _csv_report(spark, sf_dir: str) -> DataFrame:
    """Orders as CSV text, some with an unreadable amount or day; read in declared types and reported per code."""
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    last = F.col("o_orderkey") % 10
    C.write_csv(Tables(spark, sf_dir).orders.select(
        F.lpad((F.col("o_custkey") % 13).cast("string"), 5, "0").alias("code"),
        F.when(last == 7, "19981399").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("day"),
        F.when(last == 3, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("amount"),
        F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", twice')).alias("note")), path)
    return C.load_report(C.read_csv(spark, path, "code string, day date, amount double, note string"), "code", "day", "amount")


register("csv_report", """
select lpad(cast(o_custkey % 13 as varchar), 5, '0') as code, count(*) as n_rows,
       count(*) filter (where o_orderkey % 10 in (3, 7)) as bad_rows,
       cast(min(cast(o_orderdate as date)) filter (where o_orderkey % 10 not in (3, 7)) as varchar) as first_day,
       round(sum(o_totalprice) filter (where o_orderkey % 10 not in (3, 7)), 2) as total
from orders group by 1""")(_csv_report)


# ---- K15: reindex ------------------------------------------------------------------
def _reindexed(spark, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders.select(
        F.when(F.col("o_orderkey") % 11 == 0, F.concat(F.lit("N-"), F.col("o_orderkey"))).otherwise(F.col("o_orderkey").cast("string"))
        .alias("number"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), currency_of("o_custkey").alias("currency"))
    copied, conflicts = K.reindex(orders, scratch_path(spark, f"reindex-{uuid.uuid4().hex}"), {"number": "long", "day": "date"},
                                  {"year": F.year("day")})
    return copied.groupBy(F.col("year").cast("string").alias("part")).agg(F.count("*").alias("n"), F.min(F.col("number").cast("string")).alias("least")) \
        .unionByName(conflicts.groupBy(F.lit("conflict").alias("part")).agg(F.count("*").alias("n"), F.min("number").alias("least")))


register("reindexed", """
select cast(year(o_orderdate) as varchar) as part, count(*) as n, min(cast(o_orderkey as varchar)) as least
from orders where o_orderkey % 11 <> 0 group by 1
union all
select 'conflict', count(*), min('N-' || o_orderkey) from orders where o_orderkey % 11 = 0""")(_reindexed)


# ---- N2, N4: what the list says of a code ---------------------------------------------
register("nuts_labels", f"""
with {NUTS_CODES}
select c_custkey, n.level as level, n.original_label as original_label
from customer left join (select code, min(level) as level, min(lower(label)) as original_label from nuts_codes group by 1) n
  on n.code = {nuts3_sql('c_custkey', 'c_nationkey')}""")(lambda spark, sf_dir: lookup(
    Tables(spark, sf_dir).customer.select("c_custkey", nuts3(F.col("c_custkey"), F.col("c_nationkey")).alias("code")), "code",
    D.nuts_codes(spark, sf_dir), "code", ["level", "original_label"]).drop("code"))
