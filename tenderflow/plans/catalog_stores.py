"""Queries over stores that the library keeps: reference records, graph unions, parts in a folder, documents, reports, days."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import yesterday
from ..operators import graph as G
from ..operators import keyed as K
from ..operators import linkage as LK
from ..operators import registry as R
from ..session import scratch_path
from ..sources import tables as S
from ..sources import triples as TR
from ..sources.testdata_kg import build_graph
from . import reports as Q
from .catalog import register
from .oracle_linkage import REFERENCE_GROWN_SQL, REFERENCE_LINKS_SQL
from .oracle_sql import REPORT_SQL


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ---- M7: linking to a stored reference table --------------------------------------
def _parts_and_reference(spark, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Parts of more than size 25 are the reference, stored as such; all others are new."""
    part = S.Tables(spark, sf_dir).part.select(F.col("p_partkey").cast("string").alias("id"), "p_name", "p_brand", "p_type", "p_size")
    path = _folder(spark, "reference")
    K.load_keyed(part.where("p_size > 25").drop("p_size"), path, ["id"])
    return part.where("p_size <= 25 or p_size is null").drop("p_size"), spark.read.parquet(path)


def _reference_links(spark, sf_dir: str) -> DataFrame:
    new, known = _parts_and_reference(spark, sf_dir)
    return LK.link_to_reference(new, known, "id", "p_name", "p_brand", "p_type") \
        .withColumn("match_probability", F.round("match_probability", 9))


def _reference_grown(spark, sf_dir: str) -> DataFrame:
    new, known = _parts_and_reference(spark, sf_dir)
    linked = LK.link_to_reference(new, known, "id", "p_name", "p_brand", "p_type").checkpoint()
    grown = LK.grown_reference(known, new, linked, "id").select("id")
    return grown.join(new.select("id", F.lit(True).alias("is_new")), "id", "left").withColumn("is_new", F.coalesce("is_new", F.lit(False)))


register("reference_links", REFERENCE_LINKS_SQL)(_reference_links)
register("reference_grown", REFERENCE_GROWN_SQL)(_reference_grown)


# ---- U2, G24: union of graphs, dump -------------------------------------------------
def _graph_union(spark, sf_dir: str) -> DataFrame:
    """What the customers and what the orders say of customers: triples of both, and repeated ones, stand once in the dump."""
    t = S.Tables(spark, sf_dir)
    who = F.concat(F.lit("http://example.org/res/customer_"), "c_custkey")
    land = F.concat(F.lit("http://example.org/res/nation_"), "c_nationkey")
    placed = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    a = TR.Graph(spark, branches={"country": [lambda: TR.branch(t.customer, who, land)],
                                  "segment": [lambda: TR.branch(t.customer, who, F.col("c_mktsegment"), "literal", "en")]})
    b = TR.Graph(spark, branches={"country": [lambda: TR.branch(placed, who, land)],
                                  "priority": [lambda: TR.branch(placed, who, F.col("o_orderpriority"), "literal")]})
    return G.dump(TR.union_graphs(a, b))


register("graph_union", """
with c as (select *, 'http://example.org/res/customer_' || c_custkey as s from customer)
select s, 'country' as p, 'http://example.org/res/nation_' || c_nationkey as o from c where c_nationkey is not null
union select s, 'segment', c_mktsegment from c where c_mktsegment is not null
union select s, 'priority', o_orderpriority from orders join c on c_custkey = o_custkey where o_orderpriority is not null""")(_graph_union)

# ---- K14, S12, U3: bounded parts, chosen by name, columns of all of them ---------------
ROWS_A_PART = 2000


def _exported_parts(spark, sf_dir: str) -> DataFrame:
    """Orders and lines exported to one folder in parts of at most 2,000 rows, customers beside them in another codec; the parts
    of the first codec are read together."""
    t, path = S.Tables(spark, sf_dir), _folder(spark, "parts")
    for df, codec in ((t.orders.select(F.col("o_orderkey").alias("order"), F.col("o_totalprice").alias("price")), "gzip"),
                      (t.lineitem.select(F.col("l_orderkey").alias("order"), F.col("l_quantity").alias("quantity")), "gzip"),
                      (t.customer.select(F.col("c_custkey").alias("order"), F.col("c_acctbal").alias("price")), "zstd")):
        K.append(df, path, max_records_per_file=ROWS_A_PART, compression=codec)
    parts = S.read_many(spark, path, "part-", ".gz.parquet")
    parts = parts.groupBy(F.input_file_name().alias("file")).agg(
        F.count("*").alias("n"), F.count("price").alias("priced"), F.count("quantity").alias("counted"), F.sum("price").alias("price"),
        F.sum("quantity").alias("quantity"))
    return parts.agg(F.sum("n").alias("rows"), F.sum("priced").alias("priced"), F.sum("counted").alias("counted"),
                     F.round(F.sum("price"), 2).alias("price"), F.round(F.sum("quantity"), 2).alias("quantity"),
                     (F.max("n") <= ROWS_A_PART).alias("bounded"))


register("exported_parts", """
select (select count(*) from orders) + (select count(*) from lineitem) as rows, (select count(o_totalprice) from orders) as priced,
       (select count(l_quantity) from lineitem) as counted, (select round(sum(o_totalprice), 2) from orders) as price,
       (select round(sum(l_quantity), 2) from lineitem) as quantity, true as bounded""")(_exported_parts)


# ---- K9, K10, K11: a document store filled, cleared and filled again --------------------
def _document_store(spark, sf_dir: str) -> DataFrame:
    t, path = S.Tables(spark, sf_dir), _folder(spark, "documents")
    customers = t.customer.select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.struct(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).alias("body"))
    suppliers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.struct(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")).alias("body"))

    def stored(step: str) -> DataFrame:  # told before the store changes again
        docs = spark.read.schema(customers.schema).json(path)
        return docs.agg(F.lit(step).alias("step"), F.count("*").alias("count"), F.countDistinct("kind", "id").alias("different"),
                        F.round(F.sum("body.balance"), 2).alias("balance")).checkpoint()
    K.append(customers, path, "json")
    K.append(customers, path, "json")
    steps = [stored("1 customers twice")]
    K.clear(customers, path, "json")
    steps.append(stored("2 cleared"))
    for batch in (customers, suppliers):
        K.append(batch, path, "json")
    steps.append(stored("3 customers and suppliers"))
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


register("document_store", """
with c as (select count(*) as n, sum(c_acctbal) as b from customer), s as (select count(*) as n, sum(s_acctbal) as b from supplier)
select '1 customers twice' as step, 2 * n as count, n as different, round(2 * b, 2) as balance from c
union all select '2 cleared', 0, 0, null
union all select '3 customers and suppliers', c.n + s.n, c.n + s.n, round(c.b + s.b, 2) from c, s""")(_document_store)

# ---- K13: reports kept as tables -----------------------------------------------------------
_KEPT = {"report_q1": Q.q1_eu_lots_by_buyer_country, "report_q2": Q.q2_eu_lots_by_winner_country}


def _kept_reports(spark, sf_dir: str) -> DataFrame:
    """Two reports written over what an earlier run left, then read back."""
    path, g = _folder(spark, "reports"), build_graph(spark, sf_dir)
    K.materialise({"report_q1": S.Tables(spark, sf_dir).nation}, path)
    K.materialise({name: report(g) for name, report in _KEPT.items()}, path)
    q1, q2 = (spark.read.parquet(f"{path}/{name}") for name in _KEPT)
    return q1.select(F.lit("report_q1").alias("report"), F.col("BuyerCountry").alias("country"), F.col("Lots_using_EU_Funds").alias("lots")) \
        .unionByName(q2.select(F.lit("report_q2").alias("report"), F.col("Winner_Country").alias("country"),
                               F.col("Lots_using_EU_Funds").alias("lots")))


register("kept_reports", f"""
select 'report_q1' as report, BuyerCountry as country, Lots_using_EU_Funds as lots from ({REPORT_SQL["report_q1"]})
union all select 'report_q2', Winner_Country, Lots_using_EU_Funds from ({REPORT_SQL["report_q2"]})""")(_kept_reports)


# ---- I1, F20: all days up to yesterday in one job --------------------------------------------
def _day_extracts(spark, sf_dir: str) -> DataFrame:
    """Orders of every day of the year up to the day before the run (a day after the last order), one folder a day; the last 30
    days are run again, as after a late delivery, and nothing changes."""
    t, path = S.Tables(spark, sf_dir), _folder(spark, "days")
    run = t.orders.agg(F.date_add(F.to_date(F.max("o_orderdate")), 1).alias("run")).first().run
    if run is None:
        return spark.createDataFrame([], "day string, orders long, value double")
    last = spark.range(1).select(yesterday(run)).first()[0]
    first = last - dt.timedelta(days=364)
    R.run_days(t.orders, "o_orderdate", first, last, path)
    R.run_days(t.orders, "o_orderdate", last - dt.timedelta(days=29), last, path)
    stored = R.read_days(spark, path).groupBy(F.to_date("o_orderdate").alias("day")) \
        .agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("value"))
    return R.days(spark, first, last).join(stored, "day", "left").select(
        F.col("day").cast("string").alias("day"), F.coalesce("orders", F.lit(0)).alias("orders"),
        F.round(F.coalesce("value", F.lit(0.0)), 2).alias("value"))


register("day_extracts", """
with l as (select max(cast(o_orderdate as date)) as last from orders),
d as (select unnest(generate_series(last - 364, last, interval 1 day))::date as day from l)
select cast(d.day as varchar) as day, count(o_orderkey) as orders, round(coalesce(sum(o_totalprice), 0), 2) as value
from d left join orders on cast(o_orderdate as date) = d.day group by 1""")(_day_extracts)
