"""The 20 star-schema table builds (T1-T20): graph extract + transform, one plan each.

Every build is windowed by notice publication day (S4/G9): ``window`` is
``(start, end)`` as ``yyyyMMdd`` text, or ``None`` for every notice. The
window is a range filter on the publication date, which reaches the scan.

Each extract is one star pattern (``operators.star``): on the virtual graph one
projection of a source's rows, on a stored one a pivot per kind of subject.

Key metadata (PK, FKs) of every table is in ``TABLE_KEYS``; ``load_star``
writes the tables in dependency order and checks it as they are written.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import (local_name, notice_link, notice_number, notice_year, parse_yyyymmdd,
                                 surrogate_key, truncate_money, after_first_space, last_segment)
from ..operators.currency import convert
from ..operators.graph import any_of, match, optional
from ..operators.keyed import dependency_order, load_checked
from ..operators.star import node, star, text, value
from ..operators.taxonomy import taxonomy_levels
from ..sources.triples import Graph
from ..vocab import GRAPH_CPV, GRAPH_NUTS

# PK and FKs per table (the reference's key metadata).
TABLE_KEYS = {
    "Lot": ("LotId", {"ProcedureId": ("Procedure", "ProcedureId")}),
    "LotAwardOutcome": ("LotAwardOutcomeId", {}),
    "LotAward": ("LotAwardId", {"LotAwardOutcomeId": ("LotAwardOutcome", "LotAwardOutcomeId"),
                                "LotId": ("Lot", "LotId")}),
    "SubmissionStatisticalInformation": ("SubmissionStatisticalInformationId",
                                         {"LotAwardOutcomeId": ("LotAwardOutcome", "LotAwardOutcomeId")}),
    "Procedure": ("ProcedureId", {}),
    "Notice": ("NoticeId", {"ProcedureId": ("Procedure", "ProcedureId")}),
    "Buyer": ("ProcedureOrganizationId", {"ProcedureId": ("Procedure", "ProcedureId"),
                                          "OrganizationId": ("Organization", "OrganizationId"),
                                          "ContactPointId": ("ContactPoint", "ContactPointId")}),
    "Winner": ("LotAwardOutcomeOrganizationId", {"LotAwardOutcomeId": ("LotAwardOutcome", "LotAwardOutcomeId"),
                                                 "OrganizationId": ("Organization", "OrganizationId"),
                                                 "ContactPointId": ("ContactPoint", "ContactPointId")}),
    "Organization": ("OrganizationId", {}),
    "Address": ("AddressId", {"NUTSId": ("NUTS", "NUTSId")}),
    "NUTS": ("NUTSId", {}),
    "CPV": ("OriginalCPV", {}),
    "ProcedureCPV": ("ProcedureCPVId", {"ProcedureId": ("Procedure", "ProcedureId"),
                                        "OriginalCPV": ("CPV", "OriginalCPV")}),
    "LotCPV": ("LotCPVId", {"LotId": ("Lot", "LotId"), "OriginalCPV": ("CPV", "OriginalCPV")}),
    "ContactPoint": ("ContactPointId", {}),
    "ContactPointEmail": ("ContactPointEmailId", {"ContactPointId": ("ContactPoint", "ContactPointId")}),
    "ContactPointInternetAddress": ("ContactPointInternetAddressId",
                                    {"ContactPointId": ("ContactPoint", "ContactPointId")}),
    "OrganizationAddress": ("OrganizationAddressId", {"OrganizationId": ("Organization", "OrganizationId"),
                                                      "AddressId": ("Address", "AddressId")}),
    "PlaceOfPerformance": ("LotAddressId", {"LotId": ("Lot", "LotId"), "NUTSId": ("NUTS", "NUTSId")}),
    "OrganizationDeduplication": ("OrganizationDeduplicationId",
                                  {"OrganizationAddressId": ("OrganizationAddress", "OrganizationAddressId"),
                                   "ReferenceOrganizationAddressId": ("OrganizationAddress",
                                                                      "OrganizationAddressId")}),
}


def load_star(tables: dict[str, DataFrame], path: str, mode: str = "fail") -> list[tuple]:
    """K1-K4 -- load the star schema in dependency order, all keys of ``TABLE_KEYS`` checked as the tables are written.

    Returns (foreign key, rows that fill it, orphans) for every foreign key; foreign keys to tables not given are left out.
    """
    keys = {t: (pk, {c: p for c, p in fks.items() if p[0] in tables}) for t, (pk, fks) in TABLE_KEYS.items() if t in tables}
    report = []
    for name in dependency_order(keys):
        pk, fks = keys[name]
        counts = load_checked(tables[name], f"{path}/{name}", pk, {c: (f"{path}/{p}", k) for c, (p, k) in fks.items()}, mode)
        report += [(f"{name}.{c}", counts[f"filled {c}"], counts[f"orphans {c}"]) for c in fks]
    return report


def _distinct(rows: DataFrame, key: str) -> DataFrame:
    """Distinct rows dealt by the table's key alone, for tables whose rows hardly repeat: the loader's check of the key, and
    whatever else goes by it, then finds them in place."""
    return rows.repartition(F.col(key)).distinct()


def window_days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """F18/F19 -- inclusive list of days between two yyyyMMdd dates, as yyyyMMdd text."""
    return spark.range(1).select(F.explode(F.sequence(parse_yyyymmdd(F.lit(start)), parse_yyyymmdd(F.lit(end)),
                                                      F.expr("interval 1 day"))).alias("d")) \
        .select(F.date_format("d", "yyyyMMdd").alias("NoticePublicationDate"))


def notice(window=None, required: bool = True, **links) -> node:
    """S4/G9 -- a result notice published in the window, with its publication day and further links."""
    return node("Notice", {"hasPublicationDate": value("NoticePublicationDate", required=True, between=window), **links},
                cls="ResultNotice", required=required)


def notices(g: Graph, window: tuple[str, str] | None = None) -> DataFrame:
    """S4/G9 -- (Notice, NoticePublicationDate) of result notices published in the window."""
    return star(g, notice(window))


def _money(amount: str) -> node:
    """G23 -- a monetary value with both amount and currency, asked from its owner."""
    return node(f"_{amount}", {"hasAmountValue": value(amount, required=True, cast="double"),
                               "hasCurrency": value(f"{amount}Currency", required=True)}, cls="MonetaryValue")


def _eur(df: DataFrame, amount: str, rates: DataFrame, out: str) -> DataFrame:
    """Transform: latest-rate conversion to EUR, truncated to an integer; currency dropped."""
    cur = f"{amount}Currency"
    return convert(df.withColumn(cur, local_name(cur)), amount, cur, rates, "_eur") \
        .withColumn(out, truncate_money("_eur")).drop(amount, cur, "_eur")


def _roles(g: Graph, window, **links) -> DataFrame:
    """(Notice, Role, Organization, ...) for Buyer or Winner roles announced by notices in the window."""
    return star(g, node("Role", {"^announcesRole": notice(window, refersToProcedure=value("_proc", required=True)),
                                 "playedBy": value("Organization", required=True), **links}, cls=("Buyer", "Winner")))


def t_notice(g: Graph, rates: DataFrame, window=None) -> DataFrame:
    n = star(g, notice(window, refersToProcedure=value("Procedure", required=True), announcesNoticeAwardInformation=node(
        "_nai", {"hasTotalAwardedValue": replace(_money("TotalAwardedValue"), required=True)})))
    n = n.select(local_name("Notice").alias("NoticeId"), "NoticePublicationDate", local_name("Procedure")
                 .alias("ProcedureId"), "TotalAwardedValue", "TotalAwardedValueCurrency")
    n = _eur(n, "TotalAwardedValue", rates, "TotalAwardedValueEUR")
    return _distinct(n.select("NoticeId", parse_yyyymmdd("NoticePublicationDate").cast("string").alias("NoticePublicationDate"),
                    "ProcedureId", "TotalAwardedValueEUR", notice_link("NoticeId").alias("NoticeLink"),
                    notice_year("NoticeId").alias("NoticeYear"), notice_number("NoticeId").alias("NoticeNumber")), "NoticeId")


def t_procedure(g: Graph, rates: DataFrame, window=None) -> DataFrame:
    p = star(g, node("Procedure", {
        "^refersToProcedure": notice(window), "hasTitle": text("ProcedureTitle", of="Procedure"),
        "hasID": node("_id", {"hasIdentifierValue": value("ReferenceNumber", required=True)}),
        "hasEstimatedValue": _money("ProcedureEstimatedValue"), "hasProcedureType": value("ProcedureType"),
        "isCoveredByGPA": value("isCoveredByGPA", cast="boolean"),
        "hasDescription": text("ProcedureDescription", of="Procedure"),
        "hasAdditionalInformation": text("ProcedureAdditionalInformation", only=True)}))
    p = p.select(local_name("Procedure").alias("ProcedureId"), "ProcedureTitle", "ReferenceNumber", "ProcedureEstimatedValue",
                 "ProcedureEstimatedValueCurrency", local_name("ProcedureType").alias("ProcedureType"), "isCoveredByGPA",
                 "ProcedureDescription", "ProcedureAdditionalInformation")
    p = _eur(p, "ProcedureEstimatedValue", rates, "ProcedureEstimatedValueEUR")
    return _distinct(p.select("ProcedureId", "ProcedureTitle", "ReferenceNumber", "ProcedureEstimatedValueEUR", "ProcedureType",
                    "isCoveredByGPA", "ProcedureDescription", "ProcedureAdditionalInformation"), "ProcedureId")


def _lot(window, required: bool = True, **links) -> node:
    """A lot of the notices in the window."""
    return node("Lot", {"^refersToLot": notice(window), **links}, cls="Lot", required=required)


def t_lot(g: Graph, rates: DataFrame, window=None) -> DataFrame:
    lots = star(g, _lot(window, **{
        "^hasProcurementScopeDividedIntoLot": value("Procedure", required=True), "hasTitle": text("LotTitle"),
        "isUsingEUFunds": value("isUsingEUFunds", cast="boolean"), "hasEstimatedValue": _money("LotEstimatedValue"),
        "hasDescription": text("LotDescription")}))
    lots = lots.select(local_name("Lot").alias("LotId"), local_name("Procedure").alias("ProcedureId"), "LotTitle",
                       "isUsingEUFunds", "LotEstimatedValue", "LotEstimatedValueCurrency", "LotDescription")
    lots = _eur(lots, "LotEstimatedValue", rates, "LotEstimatedValueEUR")
    return _distinct(lots.select("LotId", "ProcedureId", "LotTitle", "isUsingEUFunds", "LotEstimatedValueEUR", "LotDescription"), "LotId")


def _outcome(window, **links) -> node:
    """An award outcome of a lot of the notices in the window."""
    return node("LotAwardOutcome", {"describesLot": _lot(window), **links}, cls="LotAwardOutcome", required=True)


def t_lot_award_outcome(g: Graph, rates: DataFrame, window=None) -> DataFrame:
    o = star(g, _outcome(window, hasAwardStatus=value("AwardStatus"), hasAwardedValue=_money("LotAwardedValue"),
                         hasBargainPrice=_money("LotBargainPrice"), hasAwardDecisionDate=value("AwardDecisionDate")))
    o = o.select(local_name("LotAwardOutcome").alias("LotAwardOutcomeId"), local_name("AwardStatus").alias("AwardStatus"),
                 F.col("LotAwardedValue").cast("double"), "LotAwardedValueCurrency", F.col("LotBargainPrice").cast("double"),
                 "LotBargainPriceCurrency", "AwardDecisionDate")
    o = _eur(o, "LotAwardedValue", rates, "LotAwardedValueEUR")
    o = _eur(o, "LotBargainPrice", rates, "LotBargainPriceEUR")
    return _distinct(o.select("LotAwardOutcomeId", "AwardStatus", "LotAwardedValueEUR", "LotBargainPriceEUR",
                    F.to_date("AwardDecisionDate").cast("string").alias("AwardDecisionDate")), "LotAwardOutcomeId")


def t_lot_award(g: Graph, window=None) -> DataFrame:
    o = star(g, _outcome(window))
    return _distinct(o.select(surrogate_key(local_name("Lot"), local_name("LotAwardOutcome")).alias("LotAwardId"),
                    local_name("LotAwardOutcome").alias("LotAwardOutcomeId"), local_name("Lot").alias("LotId")), "LotAwardId")


def t_submission_statistics(g: Graph, rates: DataFrame, window=None) -> DataFrame:
    counts = ["hasReceivedSMETenders", "hasReceivedTenders", "hasEUReceivedTenders", "hasElectronicTenders",
              "hasReceivedNonEUTenders"]
    # counts are nullable (OPTIONAL): typed double, as a table loader infers them
    s = star(g, node("SSI", {
        "summarisesInformationForLotAwardOutcome": _outcome(window), **{c: value(c, cast="double") for c in counts},
        "hasHighestReceivedTenderValue": _money("HighestReceivedTenderValue"),
        "hasLowestReceivedTenderValue": _money("LowestReceivedTenderValue")}, cls="SubmissionStatisticalInformation"))
    s = s.select(local_name("SSI").alias("SubmissionStatisticalInformationId"), *counts,
                 "HighestReceivedTenderValue", "HighestReceivedTenderValueCurrency", "LowestReceivedTenderValue",
                 "LowestReceivedTenderValueCurrency", local_name("LotAwardOutcome").alias("LotAwardOutcomeId"))
    s = _eur(s, "HighestReceivedTenderValue", rates, "HighestReceivedTenderValueEUR")
    s = _eur(s, "LowestReceivedTenderValue", rates, "LowestReceivedTenderValueEUR")
    return _distinct(s.select("SubmissionStatisticalInformationId", "hasReceivedSMETenders", "hasReceivedTenders",
                    "HighestReceivedTenderValueEUR", "LowestReceivedTenderValueEUR", "hasEUReceivedTenders",
                    "hasReceivedNonEUTenders", "hasElectronicTenders", "LotAwardOutcomeId"), "SubmissionStatisticalInformationId")


def t_buyer(g: Graph, window=None) -> DataFrame:
    j = star(g, node("Buyer", {
        "^announcesRole": notice(window, refersToProcedure=value("Procedure", required=True)),
        "hasContactPointInRole": node("ContactPoint", {}, cls="ContactPoint", required=True),
        "playedBy": value("Organization", required=True)}, cls="Buyer"))
    return _distinct(j.select(surrogate_key(local_name("Procedure"), local_name("Organization")).alias("ProcedureOrganizationId"),
                    local_name("Procedure").alias("ProcedureId"), local_name("Organization").alias("OrganizationId"),
                    local_name("ContactPoint").alias("ContactPointId")), "ProcedureOrganizationId")


def t_winner(g: Graph, window=None) -> DataFrame:
    # lot-centred: the notice of the lot must be the one that announces the winner's role, so a notice with many lots
    # and winners never pairs all of them
    cp = node("ContactPoint", {}, cls="ContactPoint", required=True)
    org = node("Organization", {"hasPrimaryContactPoint": cp}, required=True)
    winner = node("Winner", {"^announcesRole": value("_announced", required=True), "playedBy": org}, cls="Winner", required=True)
    j = star(g, _outcome(window, comprisesTenderAwardOutcome=node(
        "Tender", {"indicatesAwardOfLotToWinner": winner}, required=True))).where(F.col("_announced") == F.col("Notice"))
    return _distinct(j.select(surrogate_key(local_name("LotAwardOutcome"), local_name("Organization"))
                    .alias("LotAwardOutcomeOrganizationId"), local_name("LotAwardOutcome").alias("LotAwardOutcomeId"),
                    local_name("Organization").alias("OrganizationId"),
                    local_name("ContactPoint").alias("ContactPointId")), "LotAwardOutcomeOrganizationId")


def t_organization(g: Graph, window=None) -> DataFrame:
    orgs = _roles(g, window).select("Organization").distinct()
    name = star(g, node("Organization", {"hasLegalName": text("LegalName", required=True)}, cls="Organization"))
    return optional(orgs, name).select(local_name("Organization").alias("OrganizationId"), "LegalName").distinct()


#: everything an address tells, optionally
ADDRESS = {"hasCountryCode": value("_cc"), "hasNutsCode": value("_nuts"), "postCode": value("PostCode"),
           "postName": value("PostName"), "thoroughfare": value("Thoroughfare")}


def _org_addresses(g: Graph, window, **links) -> DataFrame:
    orgs = _roles(g, window).select("Organization").distinct()
    a = star(g, node("Organization", {"registeredAddress": node("Address", links, cls="Address", required=True)}))
    return match(orgs, a)


def t_address(g: Graph, window=None) -> DataFrame:
    a = _org_addresses(g, window, **ADDRESS)
    return a.select(local_name("Address").alias("AddressId"), local_name("_cc").alias("CountryCode"),
                    local_name("_nuts").alias("NUTSId"), "PostCode", "PostName", "Thoroughfare").distinct()


def t_organization_address(g: Graph, window=None) -> DataFrame:
    a = _org_addresses(g, window)
    return a.select(surrogate_key(local_name("Organization"), local_name("Address")).alias("OrganizationAddressId"),
                    local_name("Organization").alias("OrganizationId"), local_name("Address").alias("AddressId")) \
        .distinct()


def _contact_points(g: Graph, window) -> DataFrame:
    """G8 -- the organisation's primary contact point, or the role's own one."""
    r = star(g, node("Role", {"^announcesRole": notice(window, refersToProcedure=value("_proc", required=True)),
                              "playedBy": node("Organization", {}, cls="Organization", required=True),
                              "hasContactPointInRole": value("ContactPoint")}, cls=("Buyer", "Winner")))
    org = star(g, node("Organization", {"hasPrimaryContactPoint": value("ContactPoint", required=True)}))
    primary = match(r.select("Organization").distinct(), org).select("ContactPoint")
    return any_of(primary, r.select("ContactPoint").where(F.col("ContactPoint").isNotNull()))


def t_contact_point(g: Graph, window=None) -> DataFrame:
    cp = match(_contact_points(g, window), star(g, node("ContactPoint", {
        "hasContactName": text("ContactPointName"), "hasFax": value("ContactPointFax"),
        "telephone": value("ContactPointTelephone")}, cls="ContactPoint")))
    return cp.select(local_name("ContactPoint").alias("ContactPointId"), "ContactPointFax", "ContactPointTelephone",
                     "ContactPointName").distinct()


def _contact_values(g: Graph, window, pred: str, col: str, id_col: str) -> DataFrame:
    cp = match(_contact_points(g, window), star(g, node("ContactPoint", {pred: value(col, required=True)}, cls="ContactPoint")))
    return cp.select(surrogate_key(local_name("ContactPoint"), F.col(col)).alias(id_col),
                     local_name("ContactPoint").alias("ContactPointId"), col).distinct()


def t_contact_point_email(g: Graph, window=None) -> DataFrame:
    return _contact_values(g, window, "email", "Email", "ContactPointEmailId")


def t_contact_point_internet_address(g: Graph, window=None) -> DataFrame:
    return _contact_values(g, window, "hasInternetAddress", "InternetAddress", "ContactPointInternetAddressId")


def t_place_of_performance(g: Graph, window=None) -> DataFrame:
    address = node("Address", {"fullAddress": text("FullAddress", of="Address")}, required=True)
    place = node("Location", {"address": address, "hasNutsCode": value("_nuts")}, cls="Location", required=True)
    j = star(g, _lot(window, foreseesContractSpecificTerm=node(
        "_term", {"definesSpecificPlaceOfPerformance": place}, required=True)))
    return _distinct(j.select(surrogate_key(local_name("Lot"), local_name("Address")).alias("LotAddressId"),
                    local_name("Lot").alias("LotId"), local_name("_nuts").alias("NUTSId"), "FullAddress"), "LotAddressId")


def t_lot_cpv(g: Graph, window=None) -> DataFrame:
    j = star(g, _lot(window, hasPurpose=node("_purpose", {"hasAdditionalClassification": value("_cpv", required=True)},
                                             required=True))).withColumn("OriginalCPV", local_name("_cpv"))
    return _distinct(j.select(surrogate_key(local_name("Lot"), F.col("OriginalCPV")).alias("LotCPVId"),
                    local_name("Lot").alias("LotId"), "OriginalCPV"), "LotCPVId")


def t_procedure_cpv(g: Graph, window=None) -> DataFrame:
    j = star(g, node("Procedure", {
        "^refersToProcedure": notice(window),
        "hasPurpose": node("_purpose", {"hasMainClassification": value("_cpv", required=True)}, required=True)}, cls="Procedure"))
    j = j.withColumn("OriginalCPV", local_name("_cpv"))
    return _distinct(j.select(surrogate_key(local_name("Procedure"), F.col("OriginalCPV")).alias("ProcedureCPVId"),
                    local_name("Procedure").alias("ProcedureId"), "OriginalCPV"), "ProcedureCPVId")


def _taxonomy(g: Graph, graph_iri: str, lang: str | None) -> DataFrame:
    """S3/G13 -- (code, label, parent) from a named graph; the parent IRI reduced to its last segment."""
    ident = g.pred(g_p("identifier")).where(F.col("g") == graph_iri).select(F.col("s").alias("c"), F.col("o")
                                                                             .alias("code"))
    lab = g.pred(g_p("prefLabel")).where(F.col("g") == graph_iri)
    if lang is not None:
        lab = lab.where(F.col("lang") == lang)
    lab = lab.select(F.col("s").alias("c"), F.col("o").alias("label"))
    par = g.pred(g_p("broader")).where(F.col("g") == graph_iri).select(F.col("s").alias("c"), F.col("o")
                                                                       .alias("parent"))
    return optional(match(ident, lab), par).select("code", "label", last_segment("parent").alias("parent")).distinct()


def g_p(name: str) -> str:
    from ..vocab import V
    return V[name]


def t_cpv(g: Graph, max_level: int = 5) -> DataFrame:
    tax = _taxonomy(g, GRAPH_CPV, "en")
    first_label = tax.groupBy("code").agg(F.min("label").alias("label"))
    lv = taxonomy_levels(tax, max_level=max_level)
    out = tax.select(F.col("code").alias("OriginalCPV"), F.col("label").alias("OriginalCPVLabel")) \
        .join(lv.withColumnRenamed("code", "OriginalCPV"), "OriginalCPV", "left")
    cols = [F.col("OriginalCPV"), F.col("OriginalCPVLabel"), F.col("level").cast("int").alias("OriginalCPVLevel")]
    for k in range(max_level + 1):
        code_k = F.when(F.col("level") >= k, F.col(f"lvl{k}"))
        out = out.join(first_label.select(F.col("code").alias(f"_c{k}"), F.col("label").alias(f"_l{k}")),
                       code_k == F.col(f"_c{k}"), "left")
        cols += [code_k.alias(f"CPV{k}")]
    cols += [F.col(f"_l{k}").alias(f"CPV{k}Label") for k in range(max_level + 1)]
    return out.select(*cols).distinct()


def t_nuts(g: Graph, nuts_list: DataFrame, max_level: int = 3) -> DataFrame:
    tax = _taxonomy(g, GRAPH_NUTS, None).withColumn("label", after_first_space("label"))
    first_label = tax.groupBy("code").agg(F.min("label").alias("label"))
    eng = nuts_list.groupBy("code").agg(F.min("label").alias("eng"))
    lv = taxonomy_levels(tax, max_level=max_level)
    out = tax.select(F.col("code").alias("NUTSId"), F.col("label").alias("NUTSLabel")) \
        .join(lv.withColumnRenamed("code", "NUTSId"), "NUTSId", "left") \
        .join(eng.select(F.col("code").alias("NUTSId"), F.col("eng").alias("NUTSLabelEng")), "NUTSId",
              "left")
    cols = [F.col("NUTSId"), F.col("NUTSLabel"), F.col("NUTSLabelEng")]
    for k in range(max_level + 1):
        code_k = F.when(F.col("level") >= k, F.col(f"lvl{k}"))
        out = out.join(first_label.select(F.col("code").alias(f"_c{k}"), F.col("label").alias(f"_l{k}")),
                       code_k == F.col(f"_c{k}"), "left") \
            .join(eng.select(F.col("code").alias(f"_e{k}c"), F.col("eng").alias(f"_e{k}")),
                  code_k == F.col(f"_e{k}c"), "left")
        cols += [code_k.alias(f"NUTS{k}")]
    cols += [F.col(f"_l{k}").alias(f"NUTS{k}Label") for k in range(max_level + 1)]
    cols += [F.col(f"_e{k}").alias(f"NUTS{k}LabelEng") for k in range(max_level + 1)]
    return out.select(*cols).distinct()


def org_dedup_input(g: Graph, window=None) -> DataFrame:
    """T20 extract -- one row per organisation address with its name and address fields."""
    name = star(g, node("Organization", {"hasLegalName": text("LegalName", required=True)}, cls="Organization"))
    a = optional(_org_addresses(g, window, **ADDRESS), name)
    return a.select(surrogate_key(local_name("Organization"), local_name("Address")).alias("OrganizationAddressId"),
                    "LegalName", local_name("_cc").alias("CountryCode"), local_name("_nuts").alias("NUTSId"), "PostCode",
                    "PostName", "Thoroughfare").distinct()
