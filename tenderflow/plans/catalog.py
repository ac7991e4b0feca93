"""Query catalogue: name -> (spark builder(spark, sf_dir) -> DataFrame, oracle SQL or None)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.testdata_kg import build_graph
from . import reports as R
from .oracle_sql import REPORT_SQL

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _graph_query(fn, **kw) -> Builder:
    return lambda spark, sf_dir: fn(build_graph(spark, sf_dir), **kw)


for _name, _fn in R.REPORTS.items():
    register(f"report_{_name}", REPORT_SQL.get(f"report_{_name}"))(_graph_query(_fn))
register("report_q3_dedup", REPORT_SQL["report_q3_dedup"])(_graph_query(R.q3_winners_value_same_country, dedup=True))
register("report_q10", REPORT_SQL["report_q10"])(_graph_query(R.q9_single_tender_lots, month="1999-01"))
register("kpi_sme", REPORT_SQL["kpi_sme"])(_graph_query(R.kpi_sme))
register("kpi_missing_seller_reg", REPORT_SQL["kpi_missing_seller_reg"])(_graph_query(R.kpi_missing_seller_reg))
register("kpi_missing_buyer_reg", REPORT_SQL["kpi_missing_buyer_reg"])(_graph_query(R.kpi_missing_buyer_reg))
register("kpi_organizations", REPORT_SQL["kpi_organizations"])(_graph_query(R.kpi_organizations))
register("report_delta", REPORT_SQL["report_delta"])(
    lambda spark, sf_dir: R.report_delta(R.monthly_awards(build_graph(spark, sf_dir)), "month", "awarded_lots"))

# ---- T1-T19: star-schema table builds (whole tables: no date window) -------
from ..sources import dims as D  # noqa: E402
from . import tables as T  # noqa: E402
from .oracle_tables import TABLE_SQL  # noqa: E402

_RATED = {"table_notice": T.t_notice, "table_procedure": T.t_procedure, "table_lot": T.t_lot,
          "table_lot_award_outcome": T.t_lot_award_outcome, "table_submission_statistics": T.t_submission_statistics}
_PLAIN = {"table_lot_award": T.t_lot_award, "table_buyer": T.t_buyer, "table_winner": T.t_winner,
          "table_organization": T.t_organization, "table_address": T.t_address,
          "table_organization_address": T.t_organization_address, "table_contact_point": T.t_contact_point,
          "table_contact_point_email": T.t_contact_point_email,
          "table_contact_point_internet_address": T.t_contact_point_internet_address,
          "table_place_of_performance": T.t_place_of_performance, "table_lot_cpv": T.t_lot_cpv,
          "table_procedure_cpv": T.t_procedure_cpv}
for _name, _fn in _RATED.items():
    register(_name, TABLE_SQL.get(_name))(
        lambda spark, sf_dir, fn=_fn: fn(build_graph(spark, sf_dir), D.rates(spark, sf_dir)))
for _name, _fn in _PLAIN.items():
    register(_name, TABLE_SQL.get(_name))(lambda spark, sf_dir, fn=_fn: fn(build_graph(spark, sf_dir)))
register("table_cpv", TABLE_SQL["table_cpv"])(lambda spark, sf_dir: T.t_cpv(build_graph(spark, sf_dir)))
register("table_nuts", TABLE_SQL["table_nuts"])(
    lambda spark, sf_dir: T.t_nuts(build_graph(spark, sf_dir), D.nuts_codes(spark, sf_dir)))

# ---- X1-X13: wide lot table and tiers --------------------------------------
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as _T  # noqa: E402

from . import lots as X  # noqa: E402
from .oracle_lots import CPV_DIM_SQL, lots_sql  # noqa: E402


def as_text(df: DataFrame) -> DataFrame:
    """Comparison view: lists as ' ||| '-joined text (the transport format), dates as ISO text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _T.ArrayType):
            cols.append(F.array_join(F.col(f.name).cast("array<string>"), " ||| ", "NULL").alias(f.name))
        elif isinstance(f.dataType, (_T.DateType, _T.TimestampType)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def enriched_lots(spark: SparkSession, sf_dir: str, window=None) -> DataFrame:
    g = build_graph(spark, sf_dir)
    # the lot-grain extract (X1-X3) is written once to the checkpoint dir: enrichment and the three
    # tiers then start from a short lineage instead of re-planning the ~40 pattern joins; as parquet, since
    # its texts repeat and a plain checkpoint is many times as large
    path = _scratch(spark, f"lots-{_uuid.uuid4().hex}")
    with settings(spark, X.in_place(spark)):
        lots = X.clean(X.build_lots(g, window))
        lots.write.option("compression", "zstd").parquet(path)
    lots = spark.read.schema(lots.schema).parquet(path)
    return X.enrich(lots, D.cpv_codes(spark, sf_dir), D.rates(spark, sf_dir), D.countries(spark, sf_dir))


for _tier in ("free", "starter", "premium"):
    register(f"tier_{_tier}", lots_sql(_tier))(
        lambda spark, sf_dir, t=_tier: as_text(X.tier(enriched_lots(spark, sf_dir), t)))
register("cpv_dim", CPV_DIM_SQL)(lambda spark, sf_dir: __import__(
    "tenderflow.operators.taxonomy", fromlist=["cpv_dim"]).cpv_dim(D.cpv_codes(spark, sf_dir)))

# ---- K2-K7, W1/W2: keyed loading; R1-R9: registry; I5: stream ---------------
from ..operators import keyed as K  # noqa: E402
from ..operators import registry as RG  # noqa: E402
from ..sources.tables import Tables  # noqa: E402

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
_LINE_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def _lines(spark, sf_dir):
    return Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_shipdate", "l_extendedprice")


def _ts_text(df):
    return df.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


register("keep_first", f"""
select {_LINE_COLS}, cast(l_shipdate as varchar) as l_shipdate from (
  select *, row_number() over (partition by l_orderkey, l_linenumber
                               order by l_partkey, l_suppkey, l_shipdate, l_extendedprice) as rn from lineitem)
where rn = 1""")(lambda spark, sf_dir: K.keep_first(_lines(spark, sf_dir), LINE_KEY, LINE_ORDER)
                 .withColumn("l_shipdate", F.col("l_shipdate").cast("string")))
register("pk_violations", """
select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1""")(
    lambda spark, sf_dir: K.pk_violations(_lines(spark, sf_dir), LINE_KEY))
register("fk_orphans", """
select 'l_suppkey' as fk, count(*) as child_rows,
       count(*) filter (where l_suppkey not in (select s_suppkey from supplier)) as orphan_rows from lineitem""")(
    lambda spark, sf_dir: K.fk_summary(Tables(spark, sf_dir).lineitem, ["l_suppkey"], Tables(spark, sf_dir).supplier,
                                       ["s_suppkey"], "l_suppkey"))
register("insert_if_absent", f"""
with e as (select * from (select *, row_number() over (partition by l_orderkey, l_linenumber
             order by l_partkey, l_suppkey, l_shipdate, l_extendedprice) rn from lineitem
           where l_shipdate < timestamp '1998-01-01') where rn = 1),
     n as (select * from (select *, row_number() over (partition by l_orderkey, l_linenumber
             order by l_partkey, l_suppkey, l_shipdate, l_extendedprice) rn from lineitem
           where l_shipdate >= timestamp '1998-01-01') where rn = 1)
select {_LINE_COLS}, cast(l_shipdate as varchar) as l_shipdate from e
union all
select {_LINE_COLS}, cast(l_shipdate as varchar) from n
where (l_orderkey, l_linenumber) not in (select (l_orderkey, l_linenumber) from e)""")(
    lambda spark, sf_dir: K.insert_if_absent(
        K.keep_first(_lines(spark, sf_dir).where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")),
                     LINE_KEY, LINE_ORDER),
        K.keep_first(_lines(spark, sf_dir).where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")),
                     LINE_KEY, LINE_ORDER), LINE_KEY).withColumn("l_shipdate", F.col("l_shipdate").cast("string")))
_LATEST_EVENTS = """
select user_id, event_type, arg_max(event_id, (ts, event_id)) as event_id,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as ts, arg_max(value, (ts, event_id)) as value
from events group by 1, 2"""


def _upsert_events(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("user_id", "event_type", "event_id", "ts", "value")
    first_half = ev.where(F.col("ts") < F.lit("2024-01-15").cast("timestamp"))
    second_half = ev.where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"))
    return _ts_text(K.upsert(K.keep_last(first_half, ["user_id", "event_type"], ["ts", "event_id"]), second_half,
                             ["user_id", "event_type"], ["ts", "event_id"]))


register("upsert_last", _LATEST_EVENTS)(_upsert_events)
#: the events arrive in three batches
_BATCHES = ["2024-01-10", "2024-01-20"]


def _events_in_batches(mode):
    def run(spark, sf_dir):
        from ..streaming.ingest import events_in_batches
        return events_in_batches(spark, sf_dir, mode, _BATCHES)
    return run


register("incremental_load", _LATEST_EVENTS)(_events_in_batches("upsert"))
register("incremental_insert", _LATEST_EVENTS.replace("arg_max", "arg_min").replace("max(ts)", "min(ts)"))(
    _events_in_batches("insert"))

_STATUS_SQL = ("case event_type when 'signup' then 'RAW' when 'view' then 'NORMALISED_METADATA' when 'click' "
               "then 'DISTILLED' when 'purchase' then 'VALIDATED' when 'error' then 'PACKAGED' end")


def _reg(spark, sf_dir):
    return RG.registry_from_events(Tables(spark, sf_dir).events)


register("select_notices", f"""
select event_id as notice_id from events
where {_STATUS_SQL} in ('RAW', 'NORMALISED_METADATA') and cast(ts as date) between date '2024-01-05' and date '2024-01-20'""")(
    lambda spark, sf_dir: RG.select_notices(_reg(spark, sf_dir), ["RAW", "NORMALISED_METADATA"],
                                            start="2024-01-05", end="2024-01-20"))
for _b, _st in RG.BACKLOG.items():
    _in = ", ".join(f"'{x}'" for x in _st)
    register(f"backlog_{_b}", f"select event_id as notice_id from events where {_STATUS_SQL} in ({_in})")(
        lambda spark, sf_dir, b=_b: RG.backlog(_reg(spark, sf_dir), b))
register("reset_status", f"""
select event_id as notice_id,
       case when {_STATUS_SQL} = 'RAW' and value < 100 then 'INDEXED' else {_STATUS_SQL} end as status,
       'F' || user_id as form_number, case when value < 100 then 'R2.0.8' else 'R2.0.9' end as xsd_version,
       cast(cast(ts as date) as varchar) as publication_date
from events""")(lambda spark, sf_dir: RG.reset_status(
    _reg(spark, sf_dir), _reg(spark, sf_dir).where(F.col("xsd_version") == "R2.0.8"), "RAW", "INDEXED")
    .withColumn("publication_date", F.col("publication_date").cast("string")))
register("dashboard_selection", f"""
select event_id as notice_id from events
where {_STATUS_SQL} in ('DISTILLED', 'VALIDATED', 'PACKAGED') and cast(ts as date) = date '2024-01-10'""")(
    lambda spark, sf_dir: RG.dashboard_selection(_reg(spark, sf_dir), "2024-01-10", "2024-01-10"))
register("best_version", """
with reg as (select event_id as notice_id, 'F' || user_id as form_number,
                    case when value < 100 then 'R2.0.8' else 'R2.0.9' end as xsd_version, cast(ts as date) as d
             from events),
forms as (select form_number, min(d) as lo from reg group by 1),
pk as (select f.form_number, p.* from forms f, (values
         (0, '1.0.0', 1, 0, 0, 'R2.0.8', 'R2.0.9', 0, 30), (1, '1.2.0', 1, 2, 0, 'R2.0.9', 'R2.0.9', 0, 14),
         (2, '1.10.0-rc1', 1, 10, 0, 'R2.0.8', 'R2.0.8', 10, 30)) p(position, version, ma, mi, pa, min_xsd, max_xsd, d0, d1)),
el as (select r.notice_id, k.form_number || '-' || k.version as package_id, k.ma, k.mi, k.pa, k.position
       from reg r join pk k on k.form_number = r.form_number join forms f on f.form_number = r.form_number
       where r.xsd_version between k.min_xsd and k.max_xsd and r.d between f.lo + k.d0 and f.lo + k.d1)
select notice_id, arg_max(package_id, (ma, mi, pa, -position)) as package_id, true as eligible from el group by 1""")(
    lambda spark, sf_dir: RG.best_version(_reg(spark, sf_dir), RG.packages_from_registry(_reg(spark, sf_dir))))

# ---- E1-E7, D1-D7: nested tender documents -----------------------------------
from ..operators import documents as DOC  # noqa: E402
from ..sources import json_docs as J  # noqa: E402
from .oracle_sql import alpha2 as _a2, cpv as _cpv, currency as _cur, nuts3 as _n3  # noqa: E402
from .oracle_tables import CPV_CODES as CPV_CODES_SQL  # noqa: E402

_DOC_FROM = """from lineitem l join orders o on o.o_orderkey = l.l_orderkey join customer c on c.c_custkey = o.o_custkey
join supplier s on s.s_suppkey = l.l_suppkey"""
_TID = "(l.l_orderkey || '-' || l.l_linenumber || '-' || l.l_partkey || '-' || l.l_suppkey)"


def _ind_sql(names, a, b, prefix=""):
    return ", ".join(f"case when ({b} + {i}) % 4 <> 0 then cast((({a} + {i}) % 3) * 50 as double) end as {prefix}{n}"
                     for i, n in enumerate(names))


def _docs(spark, sf_dir, *fields):
    return J.tender_documents(spark, sf_dir, list(fields) or None)


def _explode_tenders(spark, sf_dir):
    d = _docs(spark, sf_dir, "id", "title", "buyers", "lots.bids").select(F.col("tender.id").alias("tender_id"), F.col("tender.title").alias("tender_title"),
                                    F.explode("tender.buyers").alias("buyer"), "tender.lots")
    d = d.select("tender_id", "tender_title", F.col("buyer.name").alias("buyer_name"), F.explode("lots").alias("lot"))
    d = d.select("tender_id", "tender_title", "buyer_name", F.col("lot.lotId").alias("lot_id"),
                 F.explode("lot.bids").alias("bid"))
    d = d.select("tender_id", "tender_title", "buyer_name", "lot_id", F.col("bid.bidId").alias("bid_id"),
                 F.col("bid.price.netAmount").alias("bid_price"), F.explode("bid.bidders").alias("b"))
    return d.select("tender_id", "tender_title", "buyer_name", "lot_id", "bid_id", "bid_price",
                    F.col("b.id").alias("bidder_id"), F.col("b.name").alias("bidder_name"),
                    F.col("b.isSme").alias("bidder_is_sme"))


register("explode_tenders", f"""
select {_TID} as tender_id, 'Contract ' || l.l_orderkey as tender_title, c.c_name as buyer_name,
       cast(l.l_linenumber as varchar) as lot_id, {_TID} as bid_id, l.l_extendedprice as bid_price,
       'S' || s.s_suppkey as bidder_id, s.s_name as bidder_name, s.s_acctbal < 5000 as bidder_is_sme
{_DOC_FROM}""")(_explode_tenders)
register("tender_cpvs", f"""
select {_TID} as tender_id, {_cpv('l.l_partkey')} as main_cpv,
       {_cpv('l.l_partkey')} || ' ||| ' || substr({_cpv('l.l_partkey')}, 1, 2) || '000000' as all_cpvs
from lineitem l""")(lambda spark, sf_dir: as_text(_docs(spark, sf_dir, "id", "cpvs").select(
    F.col("tender.id").alias("tender_id"), DOC.main_cpv("tender.cpvs").alias("main_cpv"),
    DOC.all_cpvs("tender.cpvs").alias("all_cpvs"))))
register("flatten_struct", f"""
select {_TID} as tender_id, 'Contract ' || l.l_orderkey as tender_title, {_a2('c.c_nationkey')} as tender_country,
       case o.o_orderpriority when '1-URGENT' then 'open' when '2-HIGH' then 'restricted' when '3-MEDIUM' then
         'neg-w-call' when '4-NOT SPECIFIED' then 'comp-dial' when '5-LOW' then 'neg-wo-call' end as tender_procedureType,
       case when s.s_acctbal < 5000 then 'SME' end as tender_size,
       o.o_totalprice as tender_estimatedPrice_netAmount, {_cur('o.o_custkey')} as tender_estimatedPrice_currency,
       {_a2('c.c_nationkey')} as tender_ot_country, {_cpv('l.l_partkey')} as tender_ot_cpv,
       cast(cast(o.o_orderdate as date) as varchar) as tender_ot_date,
       {_n3('l.l_partkey', 'l.l_suppkey % 25')} as tender_addressOfImplementation_nuts
{_DOC_FROM}""")(lambda spark, sf_dir: DOC.flatten_struct(_docs(spark, sf_dir), "_", keep_arrays=False))
register("bidders", f"""
select 'S' || s.s_suppkey as bidder_id, s.s_name as bidder_name,
       'supplier' || s.s_suppkey || '@supplier.example' as bidder_email, s.s_acctbal < 5000 as bidder_isSme,
       {_a2('s.s_nationkey')} as bidder_address_country, {_n3('s.s_suppkey', 's.s_nationkey')} as bidder_address_nuts
{_DOC_FROM}""")(lambda spark, sf_dir: DOC.flatten_struct(
    DOC.explode_path(_docs(spark, sf_dir, "lots.bids"), "tender", ["lots", "bids", "bidders"]).select(F.col("_n3").alias("bidder")),
    "_"))
register("sme_share", f"""
select round(100.0 * count(*) filter (where s.s_acctbal < 5000) / count(*), 2) as sme_share {_DOC_FROM}""")(
    lambda spark, sf_dir: DOC.share(_explode_tenders(spark, sf_dir), "bidder_is_sme", "sme_share"))
register("ot_nuts", f"""
select {_TID} as tender_id, {", ".join(f"substr({_n3('l.l_partkey', 'l.l_suppkey % 25')}, 1, {n + 2}) as nuts{n}"
                                      for n in (1, 2, 3))}
from lineitem l""")(lambda spark, sf_dir: _docs(spark, sf_dir, "id", "addressOfImplementation").select(
    F.col("tender.id").alias("tender_id"), *DOC.nuts_levels("tender.addressOfImplementation.nuts", [1, 2, 3], "nuts")))
register("score_columns", f"""
select {_TID} as tender_id, {", ".join(f"cast(((l.l_orderkey + {i}) % 5) * 25 as double) as {n}"
                                      for i, n in enumerate(J.SCORES))}
from lineitem l""")(lambda spark, sf_dir: DOC.with_indicators(_docs(spark, sf_dir, "id", "ot").select(
    F.col("tender.id").alias("tender_id"), F.col("tender.ot.scores").alias("scores")), "scores", J.SCORES).drop("scores"))
register("indicator_columns", f"""
select {_TID} as tender_id, {_ind_sql(J.TENDER_INDICATORS, 'l.l_orderkey', 'l.l_partkey')}
from lineitem l""")(lambda spark, sf_dir: DOC.with_indicators(_docs(spark, sf_dir, "id", "indicators").select(
    F.col("tender.id").alias("tender_id"), F.col("tender.indicators").alias("listed")), "listed", J.TENDER_INDICATORS)
    .drop("listed"))
register("lot_indicator_columns", f"""
select {_TID} as tender_id, cast(l.l_linenumber as varchar) as lot_id,
       {_ind_sql(J.LOT_INDICATORS, 'l.l_linenumber', 'l.l_suppkey', 'lot_')}
from lineitem l""")(lambda spark, sf_dir: DOC.with_indicators(_docs(spark, sf_dir, "id", "lots.indicators").select(
    F.col("tender.id").alias("tender_id"), F.explode("tender.lots").alias("lot")).select(
    "tender_id", F.col("lot.lotId").alias("lot_id"), F.col("lot.indicators").alias("listed")),
    "listed", J.LOT_INDICATORS, "lot_").drop("listed"))


def _static_lookup(spark, sf_dir):
    from ..operators.taxonomy import lookup
    d = _docs(spark, sf_dir, "id", "ot").select(F.col("tender.id").alias("tender_id"), F.col("tender.ot.cpv").alias("cpv"),
                                    F.col("tender.ot.country").alias("country"))
    d = lookup(d, "cpv", D.cpv_codes(spark, sf_dir).withColumnRenamed("label", "cpv_label"), "code", ["cpv_label"])
    d = lookup(d, "country", D.countries(spark, sf_dir).withColumnRenamed("name", "country_name"), "alpha2",
               ["country_name"])
    return d.select("tender_id", "cpv_label", "country_name")


register("static_lookup", f"""
with {CPV_CODES_SQL}
select {_TID} as tender_id, (select label from cpv_codes where code = {_cpv('l.l_partkey')}) as cpv_label,
       n.n_name as country_name
{_DOC_FROM} left join nation n on n.n_nationkey = c.c_nationkey""")(_static_lookup)

# ---- M1-M8, T20: record linkage -----------------------------------------------
from ..operators import linkage as LK  # noqa: E402
from .oracle_linkage import LINK_RECORDS_SQL, ORGANIZATION_DEDUPLICATION_SQL  # noqa: E402


def t_organization_deduplication(spark, sf_dir):
    src = T.org_dedup_input(build_graph(spark, sf_dir))
    src = src.withColumn("address", F.concat_ws(" ", "Thoroughfare", "PostCode", "PostName"))
    links = LK.link(src, "OrganizationAddressId", name="LegalName", address="address", block="CountryCode")
    return links.select(F.col("unique_id_src").alias("OrganizationAddressId"),
                        F.col("unique_id_dst").alias("ReferenceOrganizationAddressId"),
                        F.round("match_probability", 9).alias("MatchProbability"),
                        F.concat("unique_id_src", "unique_id_dst").alias("OrganizationDeduplicationId"))


def _link_records(spark, sf_dir):
    part = Tables(spark, sf_dir).part.select(F.col("p_partkey").cast("string").alias("id"), "p_name", "p_brand", "p_type")
    return LK.link(part, "id", name="p_name", address="p_brand", block="p_type") \
        .withColumn("match_probability", F.round("match_probability", 9))


register("table_organization_deduplication", ORGANIZATION_DEDUPLICATION_SQL)(t_organization_deduplication)
register("link_records", LINK_RECORDS_SQL)(_link_records)

# ---- K1-K4: the star schema loaded under its keys ------------------------------
_STAR = {"".join(w.capitalize() for w in k[len("table_"):].split("_")): k for k in [*_RATED, *_PLAIN]}
_STAR["SubmissionStatisticalInformation"] = _STAR.pop("SubmissionStatistics")
_STAR["ProcedureCPV"], _STAR["LotCPV"] = _STAR.pop("ProcedureCpv"), _STAR.pop("LotCpv")
_STAR |= {"CPV": "table_cpv", "NUTS": "table_nuts"}


def _star_fk_report(spark, sf_dir):
    from ..session import scratch_path
    path = scratch_path(spark, f"star-{__import__('uuid').uuid4().hex}")
    keys = {t: [T.TABLE_KEYS[t][0], *T.TABLE_KEYS[t][1]] for t in _STAR}  # the columns that the report is about
    report = T.load_star({t: QUERIES[q](spark, sf_dir).select(*dict.fromkeys(keys[t])) for t, q in _STAR.items()}, path, "report")
    return spark.createDataFrame(report, "foreign_key string, filled long, orphans long")


def _star_fk_sql() -> str:
    parts = []
    for table, (_, fks) in T.TABLE_KEYS.items():
        for col, (parent, key) in fks.items():
            if table in _STAR and parent in _STAR:
                parts.append(f"""
select '{table}.{col}' as foreign_key, count(c.{col}) as filled,
       count(*) filter (where c.{col} is not null and c.{col} not in (select {key} from ({TABLE_SQL[_STAR[parent]]}) p)) as orphans
from ({TABLE_SQL[_STAR[table]]}) c""")
    return " union all ".join(parts)


register("star_fk_report", _star_fk_sql())(_star_fk_report)

# ---- scalar functions, sources, graph operators on the driver tables ----------
from ..functions import columns as FC  # noqa: E402
from ..operators.currency import convert as _convert, rate_bounds as _rate_bounds  # noqa: E402
from ..operators.graph import preferred_text as _preferred  # noqa: E402
from ..sources.testdata_kg import alpha2 as _alpha2, alpha3 as _alpha3, currency_of as _currency_of, nuts3 as _nuts3  # noqa: E402
from ..sources.triples import Graph as _Graph, parse_ntriples, to_ntriples  # noqa: E402
from ..vocab import GRAPH_CPV as _GCPV, V  # noqa: E402
from .oracle_sql import alpha3 as _sa3  # noqa: E402
from .oracle_tables import NUTS_CODES as NUTS_CODES_SQL, RATES as RATES_SQL  # noqa: E402

register("local_name", """
select page_id, regexp_extract(url, '([^/#]*)$', 1) as local_name, string_split(url, '/')[-1] as last_segment
from pages""")(lambda spark, sf_dir: Tables(spark, sf_dir).pages.select(
    "page_id", FC.local_name("url").alias("local_name"), FC.last_segment("url").alias("last_segment")))


def _country_name(spark, sf_dir):
    from ..operators.taxonomy import lookup
    c = Tables(spark, sf_dir).customer.select(
        "c_custkey", F.when(F.col("c_acctbal") > 0, _alpha2(F.col("c_nationkey")))
        .otherwise(_alpha3(F.col("c_nationkey"))).alias("code"))
    ctry = D.countries(spark, sf_dir)
    by2 = ctry.select(F.col("alpha2").alias("k"), F.col("name").alias("n2"))
    by3 = ctry.select(F.col("alpha3").alias("k3"), F.col("name").alias("n3"))
    j = lookup(c, "code", by2, "k", ["n2"])
    j = lookup(j, "code", by3, "k3", ["n3"])
    return j.select("c_custkey", "code", F.when(F.length("code") == 2, F.col("n2")).otherwise(F.col("n3"))
                    .alias("country_name"))


register("country_name", f"""
select c_custkey, case when c_acctbal > 0 then {_a2('c_nationkey')} else {_sa3('c_nationkey')} end as code,
       n.n_name as country_name
from customer c left join nation n on n.n_nationkey = c.c_nationkey""")(_country_name)


def _orders_money(spark, sf_dir):
    return Tables(spark, sf_dir).orders.select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("amount"),
                                               _currency_of("o_custkey").alias("currency"))


register("convert_dated", f"""
with {RATES_SQL}
select o_orderkey, case when {_cur('o_custkey')} = 'EUR' then o_totalprice
       else coalesce(o_totalprice / (select rate from rates r where r.currency = {_cur('o_custkey')}
                                     and r.day = cast(o_orderdate as date)), 0.0) end as amount_eur
from orders""")(lambda spark, sf_dir: _convert(_orders_money(spark, sf_dir), "amount", "currency",
                                              D.rates(spark, sf_dir), "amount_eur", day="o_orderdate")
                .select("o_orderkey", "amount_eur"))
register("convert_last", f"""
with {RATES_SQL}
select o_orderkey, case when {_cur('o_custkey')} = 'EUR' then o_totalprice
       else coalesce(o_totalprice / lr.rate, 0.0) end as amount_eur,
       case when {_cur('o_custkey')} = 'EUR' then null else cast(lr.day as varchar) end as rate_day
from orders left join (select currency, max(day) as day, arg_max(rate, day) as rate from rates group by 1) lr
  on lr.currency = {_cur('o_custkey')}""")(lambda spark, sf_dir: _convert(
    _orders_money(spark, sf_dir), "amount", "currency", D.rates(spark, sf_dir), "amount_eur", day_out="rate_day")
    .select("o_orderkey", "amount_eur", F.col("rate_day").cast("string").alias("rate_day")))
register("rate_bounds", f"""
with {RATES_SQL}
select currency, cast(min(day) as varchar) as first_day, cast(max(day) as varchar) as last_day from rates group by 1""")(
    lambda spark, sf_dir: _rate_bounds(D.rates(spark, sf_dir)).select(
        "currency", F.col("first_day").cast("string").alias("first_day"),
        F.col("last_day").cast("string").alias("last_day")))


def _doc_graph(spark, sf_dir):
    from ..sources.triples import branch
    docs = Tables(spark, sf_dir).documents
    return _Graph(spark, branches={"text": [lambda: branch(docs, F.col("source"), F.col("text"), "literal",
                                                            F.col("lang"))]})


register("preferred_text", """
select source, coalesce(min(text) filter (where lang = 'en'), min(text)) as text from documents group by 1""")(
    lambda spark, sf_dir: _preferred(_doc_graph(spark, sf_dir), "text", "source", "text"))
register("preferred_text_required", """
select source, min(text) as text from documents where lang = 'en' group by 1""")(
    lambda spark, sf_dir: _preferred(_doc_graph(spark, sf_dir), "text", "source", "text", require_preferred=True))
register("date_window", f"""
select 'http://example.org/res/id_' || year(o_orderdate) || '-S-001-' || o_orderkey || '_Notice' as Notice,
       strftime(o_orderdate, '%Y%m%d') as NoticePublicationDate
from orders where cast(o_orderdate as date) between date '1998-01-01' and date '1998-03-31'""")(
    lambda spark, sf_dir: T.notices(build_graph(spark, sf_dir), ("19980101", "19980331")))


def _cpv_graph_counts(spark, sf_dir, round_trip: bool):
    g = build_graph(spark, sf_dir)
    from ..vocab import V as _V
    parts = [g.pred(_V[p]).where(F.col("g") == _GCPV).withColumn("p", F.lit(_V[p]))
             for p in ("identifier", "prefLabel", "broader")]
    t = parts[0].unionByName(parts[1]).unionByName(parts[2])
    if round_trip:  # S1/S15: serialise to N-Quads text and parse it back
        t, _rejected = parse_ntriples(to_ntriples(t))
    return t.groupBy("p", "o_kind", F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count(F.lit(1)).alias("n"))


_CPV_COUNTS = f"""
with {CPV_CODES_SQL}
select 'http://purl.org/dc/elements/1.1/identifier' as p, 'literal' as o_kind, '' as lang, count(*) as n from cpv_codes
union all select 'http://www.w3.org/2004/02/skos/core#prefLabel', 'literal', 'en', count(*) from cpv_codes
union all select 'http://www.w3.org/2004/02/skos/core#broader', 'iri', '', count(*) from cpv_codes
  where length(rtrim(code, '0')) >= 2"""
register("named_graph", _CPV_COUNTS)(lambda spark, sf_dir: _cpv_graph_counts(spark, sf_dir, False))
register("scan_taxonomy", _CPV_COUNTS)(lambda spark, sf_dir: _cpv_graph_counts(spark, sf_dir, True))


# ---- S1, S15, S16, U2: the whole graph as text and as a store -------------------
import uuid as _uuid  # noqa: E402

from ..session import scratch_path as _scratch, settings  # noqa: E402
from ..sources import bulk as BULK  # noqa: E402
from ..sources.triples import read_triples as _read_triples, write_lines as _write_lines, write_triples as _write_triples  # noqa: E402
from .oracle_graph import graph_counts_sql  # noqa: E402


def _scan_triples(spark, sf_dir):
    """The whole graph written as N-Quads text, read back and counted."""
    path = _scratch(spark, f"quads-{_uuid.uuid4().hex}")
    _write_lines(to_ntriples(build_graph(spark, sf_dir).triples()), path)
    g, rejected = _read_triples(spark, path, "nt", dedup=False)
    return g.triples().select("p", "o_kind", F.coalesce("lang", F.lit("")).alias("lang")) \
        .unionByName(rejected.select(F.lit("rejected").alias("p"), F.lit("").alias("o_kind"), F.lit("").alias("lang"))) \
        .groupBy("p", "o_kind", "lang").agg(F.count(F.lit(1)).alias("n"))


register("scan_triples", graph_counts_sql(_cpv("l_partkey")))(_scan_triples)


def _stored_q2(spark, sf_dir):
    """Q2 on a stored copy of the whole graph."""
    path = _scratch(spark, f"graph-{_uuid.uuid4().hex}")
    _write_triples(build_graph(spark, sf_dir), path)
    return R.q2_eu_lots_by_winner_country(_read_triples(spark, path, dedup=False)[0])


register("stored_q2", REPORT_SQL["report_q2"])(_stored_q2)


def _notice_quads(spark, sf_dir):
    """The triples of every notice in a graph named after it; every 50th order's dispatch date lost its opening quote."""
    t = build_graph(spark, sf_dir).triples(of=V["ResultNotice"]).withColumn("g", F.col("s"))
    order = F.regexp_extract("value", r"-S-001-(\d+)_Notice", 1).cast("long")
    broken = (order % 50 == 0) & F.contains("value", F.lit("hasDispatchDate"))
    return to_ntriples(t).select(F.when(broken, F.regexp_replace("value", '"([0-9])', "$1")).otherwise(F.col("value")).alias("value"))


def _load_status(spark, sf_dir):
    text, store = (_scratch(spark, f"{n}-{_uuid.uuid4().hex}") for n in ("notices", "store"))
    _write_lines(_notice_quads(spark, sf_dir), text)
    status = BULK.load_quads(spark, text, store)
    stored = BULK.stored_graph(spark, store).triples().groupBy(F.col("g").alias("notice")).agg(F.count("*").alias("stored"))
    return status.join(stored, "notice", "left").withColumn("stored", F.coalesce("stored", F.lit(0)))


register("load_status", """
with n as (select l_orderkey, count(*) as n, count(distinct (l_linenumber, l_partkey, l_suppkey)) as d from lineitem group by 1)
select 'http://example.org/res/id_' || year(o_orderdate) || '-S-001-' || o_orderkey || '_Notice' as notice,
       6 + (o_orderstatus = 'F')::int + 2 * coalesce(n, 0) as lines, (o_orderkey % 50 = 0)::int as bad_lines,
       case when o_orderkey % 50 = 0 then 'quarantined' else 'loaded' end as status,
       case when o_orderkey % 50 = 0 then 0 else 6 + (o_orderstatus = 'F')::int + 2 * coalesce(d, 0) end as stored
from orders left join n on l_orderkey = o_orderkey""")(_load_status)

# ---- S4, X13, I2: windows and lagged tiers on the last day of the data ---------
def _last_day(spark, sf_dir):
    return Tables(spark, sf_dir).orders.agg(F.to_date(F.max("o_orderdate")).alias("d")).first().d


def _tier_lagged(spark, sf_dir, name):
    last = _last_day(spark, sf_dir)
    day = X.publication_day(name, last).strftime("%Y%m%d")
    return as_text(X.tier(enriched_lots(spark, sf_dir, (day, day)), name, last))


for _tier in ("free", "starter"):
    register(f"tier_{_tier}_lagged", f"""
select * from ({lots_sql(_tier)}) lagged
where publication_date = (select cast(cast(max(o_orderdate) as date) - {X.TIER_LAG_DAYS[_tier]} as varchar) from orders)""")(
        lambda spark, sf_dir, t=_tier: _tier_lagged(spark, sf_dir, t))


def _table_lot_window(spark, sf_dir):
    last = _last_day(spark, sf_dir).strftime("%Y%m%d")
    return T.t_notice(build_graph(spark, sf_dir), D.rates(spark, sf_dir), (last[:6] + "01", last))


register("table_notice_window", f"""
select * from ({TABLE_SQL['table_notice']}) w
where substr(NoticePublicationDate, 1, 7) = (select strftime(max(o_orderdate), '%Y-%m') from orders)""")(_table_lot_window)
register("run_plan", f"""
with d as (select cast(max(o_orderdate) as date) as day from orders)
{" union all ".join(f"select 'tier_{t}' as target, cast(day - {lag} as varchar) as start_day, cast(day - {lag} as varchar) as end_day from d" for t, lag in X.TIER_LAG_DAYS.items())}
union all select t, cast(day as varchar), cast(day as varchar) from d, (values ('Notice'), ('Lot'), ('Winner')) v(t)""")(
    lambda spark, sf_dir: RG.plan(spark, _last_day(spark, sf_dir) + _dt.timedelta(days=1), ["Notice", "Lot", "Winner"])
    .select("target", F.col("start").cast("string").alias("start_day"), F.col("end").cast("string").alias("end_day")))

# ---- F3, F4, F14, K5, K11, K12, P6, P9, N5: operators on whole tables -----------
register("list_columns", """
select p_partkey, replace(p_type, ' ', '; ') as words, upper(replace(p_type, ' ', '; ')) as tails from part""")(
    lambda spark, sf_dir: Tables(spark, sf_dir).part.select(
        "p_partkey", F.array_join(FC.split_list(F.regexp_replace("p_type", " ", " ||| ")), "; ").alias("words"),
        F.array_join(FC.split_last_segments(F.concat(F.lit("x/"), F.regexp_replace(F.upper("p_type"), " ", " ||| y/z/"))),
                     "; ").alias("tails")))
register("lot_links", """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'https://notices.example.org/udl?uri=NOTICE:' || l_orderkey || '-'
       || year(l_shipdate) || ':TEXT:EN:HTML' as link
from lineitem""")(lambda spark, sf_dir: Tables(spark, sf_dir).lineitem.select(
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", FC.lot_notice_link(F.concat(
        F.lit("http://example.org/res/id_"), F.year("l_shipdate"), F.lit("-S-001-"), F.col("l_orderkey"), F.lit("_Lot_"),
        F.col("l_linenumber"))).alias("link")))
register("document_count", "select count(*) as count from documents")(
    lambda spark, sf_dir: K.count(Tables(spark, sf_dir).documents))
register("document_page", """
select doc_id, source, n_chars from documents where lang = 'en' and n_chars >= 1000 order by n_chars desc, doc_id limit 50""")(
    lambda spark, sf_dir: K.query(Tables(spark, sf_dir).documents.orderBy(F.desc("n_chars"), "doc_id"),
                                  (F.col("lang") == "en") & (F.col("n_chars") >= 1000), ["doc_id", "source", "n_chars"], 50))
register("required_documents", """
select doc_id, lang from documents where text is not null and lang is not null""")(
    lambda spark, sf_dir: DOC.required(Tables(spark, sf_dir).documents, ["text", "lang", "absent"]).select("doc_id", "lang"))
register("cast_documents", """
select cast(doc_id as varchar) as doc_id, cast(n_chars as double) as n_chars, lang from documents""")(
    lambda spark, sf_dir: DOC.cast_fields(Tables(spark, sf_dir).documents.select("doc_id", "n_chars", "lang"), ["n_chars"]))
register("insert_if_absent_raw", """
with old as (select * from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey)
                            as rn from lineitem where l_linestatus = 'F') where rn = 1),
new as (select * from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey)
                       as rn from lineitem where l_orderkey not in (select l_orderkey from old)) where rn = 1)
select l_orderkey, l_linenumber, l_partkey, l_suppkey from old union all
select l_orderkey, l_linenumber, l_partkey, l_suppkey from new""")(lambda spark, sf_dir: (
    lambda t: K.insert_if_absent(K.keep_first(t.where("l_linestatus = 'F'").drop("l_linestatus"), ["l_orderkey"], ["l_linenumber"]),
                                 t.drop("l_linestatus"), ["l_orderkey"]))(
    Tables(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus")))


def _nuts_by_level(spark, sf_dir):
    from ..operators.taxonomy import nuts_code_by_level
    c = Tables(spark, sf_dir).customer.select("c_custkey", _nuts3(F.col("c_custkey"), F.col("c_nationkey")).alias("code"))
    for level in range(4):
        c = nuts_code_by_level(c, "code", D.nuts_codes(spark, sf_dir), level, f"level{level}")
    return c


register("nuts_by_level", f"""
with {NUTS_CODES_SQL}, c as (select c_custkey, {_n3('c_custkey', 'c_nationkey')} as code from customer)
select c_custkey, code, {", ".join(
    f"case when length(code) >= {n + 2} then (select min(x.code) from nuts_codes x where x.code = substr(c.code, 1, {n + 2})) end as level{n}"
    for n in range(4))} from c""")(_nuts_by_level)

from . import catalog_files, catalog_stores  # noqa: E402, F401
