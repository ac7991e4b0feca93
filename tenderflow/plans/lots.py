"""Wide lot table and its three commercial tiers.

``build_lots`` asks star patterns (``operators.star``): one for the lot with its
notice and procedure, one for buyers, one for award outcomes, one for CPV codes.
Each is aggregated to lot grain *before* joining (distinct lists and samples do
not depend on multiplicity, so the result equals the un-fanned pattern); the
lot-grain frames are all hash-partitioned on ``lot``, or, where the graph knows
one and the session is set for it (``in_place``), on a column that IRIs of lots
and their notices hold, so the joins need no further exchange. ``enrich`` adds conversions, links, indicators, code
hierarchies and scores; ``tier`` selects a tier's columns and its lagged
publication day. The three tiers share one enriched plan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (equals_indicator, last_segment, notice_link, prefix_level, prefix_level_list, present, row_mean,
                                 strip)
from ..operators.currency import convert
from ..operators.star import dealt_stars, node, star, text, value
from ..operators.taxonomy import cpv_dim, cpv_list_columns, lookup
from ..sources.triples import Graph
from ..vocab import TIER_CPV_RANKS, TIER_LAG_DAYS, TIER_LOT_NUTS, TIER_ORG_NUTS_LIMIT
from .tables import notice

IND = {
    "subcontract": "indicator_transparency_subcontract_info_available",
    "duration": "indicator_transparency_duration_available",
    "location": "indicator_transparency_implementation_location_available",
    "funding": "indicator_transparency_funding_info_available",
    "cpv": "indicator_transparency_product_codes_available",
    "bidder": "indicator_transparency_bidder_name_available",
    "value": "indicator_transparency_contract_value_available",
    "joint": "indicator_administrative_joint_procurement",
    "framework": "indicator_administrative_use_of_framework_agreement",
    "eauction": "indicator_administrative_electronic_auction",
    "wto": "indicator_administrative_use_of_wto",
    "ptype": "indicator_integrity_procedure_type",
}


def _sorted_set(c: str, out: str):
    return F.array_sort(F.collect_set(c)).alias(out)


def _organization(org: str) -> node:
    """A typed organisation: English-preferred name, NUTS of the registered address."""
    return node(org, {"hasLegalName": text("_name"),
                      "registeredAddress": node("_address", {"hasNutsCode": value("_nuts", required=True)})}, cls="Organization")


def build_lots(g: Graph, window=None) -> DataFrame:
    """X1 -- one row per lot of the notices published in the window."""
    proc = node("_proc", {
        "hasDescription": text("_desc", lang=None), "hasTitle": text("_title", lang=None), "hasProcedureType": text("_ptype", lang=None),
        "hasID": node("_ident", {"hasIdentifierValue": value("_pid", required=True)}),
        "isSubjectToProcedureSpecificTerm": node("_pterm", {"isAwardedByCPB": value("_cpb", required=True)}),
        "usesTechnique": [node("_ea", {}, cls="EAuctionTechniqueUsage"), node("_fa", {}, cls="FrameworkAgreementTechniqueUsage")],
        "isCoveredByGPA": text("_gpa", lang=None)}, cls="Procedure")
    place = node("_place", {"hasNutsCode": value("_pop", required=True)})
    term = node("_term", {"definesSpecificPlaceOfPerformance": place,
                          "definesContractDuration": node("_dur", {}, cls="SpecificDuration")}, cls="ContractTerm")
    base = node("lot", {"^refersToLot": notice(window), "^hasProcurementScopeDividedIntoLot": proc,
                                "foreseesContractSpecificTerm": term, "isUsingEUFunds": text("_eu", lang=None)}, cls="Lot")

    # buyers are aggregated per notice first, then joined many-to-one to its lots: a notice with many lots and roles
    # never produces lot x role pairs
    announced = value("Notice", required=True) if window is None else notice(window)
    buyers = node("_role", {"^announcesRole": announced, "playedBy": _organization("_borg")}, cls="Buyer")

    tender = node("_tender", {"foreseesSubcontracting": value("_sub", required=True)})
    winner = node("_winner", {"playedBy": replace(_organization("_worg"), cls=None, required=True)}, required=True)
    money = node("_mv", {"hasAmountValue": value("_amt", required=True, cast="double"),
                         "hasCurrency": value("_cur", required=True)}, cls="MonetaryValue")
    outcome = node("_tao", {"indicatesAwardOfLotToWinner": winner, "describesTender": tender}, cls="TenderAwardOutcome", required=True)
    # only what the window's lots need: their outcomes and codes, not everybody's
    shown = {} if window is None else {"^refersToLot": notice(window)}
    described = node("lot", shown, cls="Lot", required=True) if shown else value("lot", required=True)
    win = node("_lao", {"describesLot": described, "comprisesTenderAwardOutcome": outcome, "hasAwardedValue": money}, cls="LotAwardOutcome")
    cpvs = node("lot", {**shown, "hasPurpose": node("_purpose", {"hasAdditionalClassification": value("_cpv", required=True)}, required=True)})

    pays = g.spark.conf.get(CO_PARTITION, "true") == "false"
    by, (base, buyers, win, cpvs) = dealt_stars(g, base, buyers, win, cpvs) if pays else ([], [star(g, n) for n in (base, buyers, win, cpvs)])
    deal = lambda df: df.repartition(*by) if by else df
    buyers = deal(buyers).groupBy("Notice", *by).agg(F.collect_set("_name").alias("_n"), F.collect_set("_nuts").alias("_u"))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    lots = base.join(buyers, ["Notice", *by], "left").groupBy("lot", *by).agg(
        F.min("NoticePublicationDate").alias("publication_date"), F.min("Notice").alias("notice"),
        union("_n").alias("buyer_names"), union("_u").alias("buyer_nuts"),
        F.min("_proc").alias("procedure"), F.min("_pid").alias("procedure_id"),
        F.min("_desc").alias("procedure_description"), F.min("_title").alias("procedure_title"),
        F.min("_ptype").alias("procedure_type"), F.min("_cpb").alias("awarded_cpb"),
        F.min("_ea").alias("ea_technique"), F.min("_fa").alias("fa_technique"), F.min("_gpa").alias("is_gpa"),
        F.min("_pop").alias("place_of_performance"), F.min("_dur").alias("contract_duration"), F.min("_eu").alias("using_eu_funds"))
    winners = deal(win).groupBy("lot", *by).agg(_sorted_set("_name", "winner_names"), _sorted_set("_nuts", "winner_nuts"),
                                                F.min("_sub").alias("subcontracting"),
                                                F.min(F.when(F.col("_amt").isNotNull(), F.struct("_amt", "_cur"))).alias("_value")) \
        .withColumns({"lot_amount": F.col("_value._amt"), "lot_currency": F.col("_value._cur")}).drop("_value")
    cpvs = deal(cpvs).groupBy("lot", *by).agg(_sorted_set("_cpv", "main_cpvs"))
    return lots.join(winners, ["lot", *by], "left").join(cpvs, ["lot", *by], "left").drop(*by)


#: whether a join by several columns deals rows again that lie together by one of them
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def in_place(spark: SparkSession) -> dict[str, str]:
    """Settings under which ``build_lots`` is best called and run: what is dealt by ``dealt_stars``' column is then not dealt again for
    a join by it and an IRI. As a task then sorts and groups its rows several times, tasks are smaller than usual: more partitions, which
    Spark puts together as far as they stay small."""
    return {CO_PARTITION: "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(10 * int(spark.conf.get("spark.sql.shuffle.partitions")))}


def clean(lots: DataFrame) -> DataFrame:
    """X3 -- P1 (drop all-null rows) and the column clean-up: last segments, strip, typed values."""
    lots = lots.dropna(how="all")
    # an empty concatenation is no value at all (null), as the text transport gives it
    nonempty = lambda c: F.when(F.size(c) > 0, F.col(c))
    seg_list = lambda c: F.transform(nonempty(c), lambda x: F.substring_index(x, "/", -1))
    return lots.select(
        "lot", "notice", F.to_date(F.try_to_timestamp(F.col("publication_date"), F.lit("yyyyMMdd"))).alias(
            "publication_date"),
        nonempty("buyer_names").alias("buyer_names"), seg_list("buyer_nuts").alias("buyer_nuts"), last_segment("procedure").alias("procedure"),
        "procedure_id", strip("procedure_description").alias("procedure_description"), nonempty("winner_names").alias("winner_names"),
        seg_list("winner_nuts").alias("winner_nuts"), "subcontracting",
        F.col("lot_amount").try_cast("double").alias("lot_amount"), last_segment("lot_currency").alias("lot_currency"),
        last_segment("place_of_performance").alias("place_of_performance"), "contract_duration",
        seg_list("main_cpvs").alias("main_cpvs"), strip("procedure_title").alias("procedure_title"),
        last_segment("procedure_type").alias("procedure_type"), "awarded_cpb", "ea_technique", "fa_technique",
        (F.col("is_gpa") == "true").alias("is_gpa"), (F.col("using_eu_funds") == "true").alias("using_eu_funds"))


def enrich(lots: DataFrame, cpv_codes: DataFrame, rates: DataFrame, countries: DataFrame) -> DataFrame:
    """X4-X12 over cleaned lots (premium column set; tiers select from it)."""
    df = convert(lots, "lot_amount", "lot_currency", rates, "amount_value_eur", day="publication_date")
    df = df.withColumn("notice_link", notice_link("notice"))
    df = df.withColumns({
        IND["subcontract"]: present("subcontracting"), IND["duration"]: present("contract_duration"),
        IND["joint"]: present("awarded_cpb"), IND["framework"]: present("fa_technique"),
        IND["eauction"]: present("ea_technique"), IND["wto"]: present("is_gpa", "boolean"),
        IND["funding"]: present("using_eu_funds", "boolean"), IND["location"]: present("place_of_performance"),
        IND["cpv"]: present("main_cpvs", "array"), IND["bidder"]: present("winner_names", "array"),
        IND["value"]: present("lot_amount", "number"),
        IND["ptype"]: equals_indicator("procedure_type", "open")})
    # C5-C7 and the label replacement (X11) in one explode / lookup / regroup pass
    df = cpv_list_columns(df, "lot", "main_cpvs", cpv_dim(cpv_codes))
    for n in range(4):
        df = df.withColumn(f"lots_nuts_{n}", prefix_level("place_of_performance", n))
        df = df.withColumn(f"buyer_nuts_{n}", F.when(F.size("buyer_nuts") > 0,
                                                     prefix_level_list("buyer_nuts", n)))
        df = df.withColumn(f"winner_nuts_{n}", F.when(F.size("winner_nuts") > 0,
                                                      prefix_level_list("winner_nuts", n)))
    df = lookup(df, "lots_nuts_0", countries.withColumn("lots_country", F.col("name")), "alpha2", ["lots_country"])
    df = df.withColumn("integrity_score", row_mean(IND["ptype"]))
    df = df.withColumn("administrative_score", row_mean(IND["wto"], IND["eauction"], IND["framework"], IND["joint"]))
    df = df.withColumn("transparency_score", row_mean(IND["subcontract"], IND["duration"], IND["location"],
                                                      IND["funding"], IND["cpv"], IND["bidder"], IND["value"]))
    return df.withColumn("good_procurement_score", row_mean("integrity_score", "administrative_score",
                                                            "transparency_score"))


BASE_COLUMNS = ["lot", "publication_date", "buyer_names", "buyer_nuts", "procedure", "procedure_id",
                "procedure_description", "winner_names", "winner_nuts", "lot_amount", "lot_currency",
                "place_of_performance", "main_cpvs", "procedure_title", "procedure_type", "amount_value_eur",
                "notice_link", *IND.values(), "cpv_parent", "cpv_level", "lots_country", "integrity_score",
                "administrative_score", "transparency_score", "good_procurement_score"]


def tier_columns(name: str) -> list[str]:
    """P8 -- the column set of a tier."""
    cols = list(BASE_COLUMNS)
    cols += [f"cpv{r}" for r in TIER_CPV_RANKS[name]]
    cols += [f"lots_nuts_{n}" for n in TIER_LOT_NUTS[name]]
    cols += [f"buyer_nuts_{n}" for n in range(TIER_ORG_NUTS_LIMIT[name])]
    cols += [f"winner_nuts_{n}" for n in range(TIER_ORG_NUTS_LIMIT[name])]
    return cols


def publication_day(name: str, day: str | dt.date) -> dt.date:
    """X13 -- the publication day that a tier shows when ``day`` (the day being processed) is loaded."""
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return day - dt.timedelta(days=TIER_LAG_DAYS[name])


def tier(enriched: DataFrame, name: str, day: str | dt.date | None = None) -> DataFrame:
    """X13/P8 -- a tier: its columns, and with ``day`` only the lots published ``lag`` days before it. Pass the
    same day as the extract's window to keep other days out of the extract too."""
    df = enriched.select(*tier_columns(name))
    if day is not None:
        df = df.where(F.col("publication_date") == F.lit(publication_day(name, day)))
    return df
