"""Competency-question reports (Q1-Q28) as graph-pattern joins.

Every report starts from its most selective anchor and joins outwards. Where
a pattern multiplies solutions only to be summed (Q3's buyers-by-country,
the procedure CPVs of Q3/Q4), the multiplicity is counted per join key first
and carried as a factor, so no group of pairs is ever materialised; the
result equals the bag semantics of the original pattern.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import local_name
from ..operators.graph import match, of_class, optional, pattern, typed, without
from ..operators.star import distinct_star, node, star, value
from ..sources.triples import Graph


def one(name: str, **kw) -> value:
    return value(name, required=True, **kw)


def a(name: str, cls: str | None, **links) -> node:
    return node(name, {k.replace("of_", "^"): t for k, t in links.items()}, cls=cls, required=True)


#: ?Lot a Lot; isUsingEUFunds true
EU = {"isUsingEUFunds": one("eu", equals="true")}


def _org_country(g: Graph, org: str, country: str, org_class: str = "Organization") -> DataFrame:
    """?org a <org_class>; registeredAddress ?a . ?a a Address; hasCountryCode ?country"""
    return star(g, a(org, org_class, registeredAddress=a("_addr", "Address", hasCountryCode=one(country)))).select(org, country)


def _winner() -> node:
    """?tao a TenderAwardOutcome; describesTender ?Tender; awardsLotToWinner ?Winner . ?Winner a Winner; playedBy ?Org"""
    return a("tao", "TenderAwardOutcome", awardsLotToWinner=a("Winner", "Winner", playedBy=one("Organization")))


def q1_eu_lots_by_buyer_country(g: Graph) -> DataFrame:
    buyer = a("Buyer", "Buyer", playedBy=one("Organization"))
    j = star(g, a("Lot", "Lot", **EU, of_includesLot=a("Contract", "Contract", bindsBuyer=buyer)))
    j = match(j.select("Lot", "Organization"), _org_country(g, "Organization", "BuyerCountry"))
    return j.groupBy("BuyerCountry").agg(F.countDistinct("Lot").alias("Lots_using_EU_Funds"))


def q2_eu_lots_by_winner_country(g: Graph) -> DataFrame:
    j = star(g, a("Tender", "Tender", isSubmittedForLot=a("Lot", "Lot", **EU), of_describesTender=_winner()))
    j = match(j.select("Lot", "Organization"), _org_country(g, "Organization", "WinnerCountry"))
    return j.groupBy(local_name("WinnerCountry").alias("Winner_Country")) \
        .agg(F.countDistinct("Lot").alias("Lots_using_EU_Funds"))


def _procedure_cpv_count(g: Graph) -> DataFrame:
    """Number of (Purpose, CPV) solutions per procedure: the multiplicity Q3/Q4 sum over."""
    j = star(g, a("Procedure", "Procedure", hasOverallPurpose=a("Purpose", "Purpose", hasMainClassification=one("CPV"))))
    return j.groupBy("Procedure").agg(F.count(F.lit(1)).alias("_w"))


def _awarded_eu_tenders(g: Graph, country: str) -> DataFrame:
    """EU-funded tenders with winner, amount, currency and country, weighted by their CPV multiplicity."""
    money = a("MonetaryValue", "MonetaryValue", hasAmountValue=one("AmountValue", cast="decimal(20,2)"), hasCurrency=one("Currency"))
    lot = a("Lot", "Lot", **EU, of_hasProcurementScopeDividedIntoLot=one("Procedure"),
            of_includesLot=a("Contract", "Contract", hasContractConclusionDate=one("ContractDate")))
    j = star(g, a("Tender", "Tender", isSubmittedForLot=lot, hasFinancialOfferValue=money, of_describesTender=_winner()))
    return match(j.select("Procedure", "Winner", "Organization", "AmountValue", "Currency"),
                 _org_country(g, "Organization", country), _procedure_cpv_count(g))


def q4_winners_value_by_winner_country(g: Graph) -> DataFrame:
    j = _awarded_eu_tenders(g, "WinnerCountry")
    return j.groupBy("WinnerCountry").agg(
        F.countDistinct("Winner").alias("Nr_of_winners"),
        F.sum(F.col("AmountValue") * F.col("_w")).cast("double").alias("TotalProcurementValue"),
        F.min("Currency").alias("CurrencyID"))


def _buyers_by_country(g: Graph) -> DataFrame:
    b = star(g, a("Buyer", "Buyer", playedBy=one("BuyerOrganization")))
    j = match(b, _org_country(g, "BuyerOrganization", "Country"))
    return j.groupBy("Country").agg(F.count(F.lit(1)).alias("_n_buyers"))


def q3_winners_value_same_country(g: Graph, dedup: bool = False) -> DataFrame:
    """Buyer and winner share only the country value (as written); ``dedup`` drops the buyer multiplicity."""
    # the factor is one number per country: aggregate the tenders first, then join a row per country
    won = _awarded_eu_tenders(g, "Country").groupBy("Country").agg(
        F.countDistinct("Winner").alias("Nr_of_winners"), F.sum(F.col("AmountValue") * F.col("_w")).alias("_value"),
        F.min("Currency").alias("CurrencyID"))
    factor = F.lit(1) if dedup else F.col("_n_buyers")
    return match(won, _buyers_by_country(g)).select(
        "Country", "Nr_of_winners", (F.col("_value") * factor).cast("double").alias("TotalProcurementValue"), "CurrencyID")


def q5_buyer_organizations(g: Graph) -> DataFrame:
    org = of_class(g, "Organization", name="Organization")
    b = typed(pattern(g, "playedBy", "Buyer", "Organization"), g, "Buyer", "Buyer")
    c = typed(pattern(g, "bindsBuyer", "Contract", "Buyer"), g, "Contract", "Contract")
    return match(c, b, org).agg(F.countDistinct("Organization").alias("Nr_of_Organizations"))


def q6_award_notice_publishers(g: Graph) -> DataFrame:
    n = typed(match(pattern(g, "refersToRole", "ResultNotice", "Buyer"),
                    pattern(g, "hasDispatchDate", "ResultNotice", "DispatchDate")),
              g, "ResultNotice", "ResultNotice")
    b = typed(pattern(g, "playedBy", "Buyer", "Organization"), g, "Buyer", "Buyer")
    j = match(n, b, _org_country(g, "Organization", "CountryCodeURL"))
    return j.select("Organization", "DispatchDate", local_name("CountryCodeURL").alias("CountryCode")).distinct()


def q7_non_framework_techniques(g: Graph) -> DataFrame:
    p = typed(pattern(g, "usesTechnique", "Procedure", "TechniqueUsage"), g, "Procedure", "Procedure")
    return without(p, of_class(g, "FrameworkAgreementTechniqueUsage", name="TechniqueUsage"))


def q8_dynamic_purchasing(g: Graph) -> DataFrame:
    p = typed(pattern(g, "usesTechnique", "Procedure", "TechniqueUsage"), g, "Procedure", "Procedure")
    return typed(p, g, "TechniqueUsage", "DynamicPurchaseSystemTechnique").select("Procedure")


def q9_single_tender_lots(g: Graph, month: str | None = None) -> DataFrame:
    """Q9; with ``month`` ('yyyy-MM') it is Q10 (dispatch dates in that month)."""
    pl = typed(pattern(g, "hasProcurementScopeDividedIntoLot", "Procedure", "Lot"), g, "Procedure", "Procedure")
    rn = match(pattern(g, "refersToProcedure", "ResultNotice", "Procedure"),
               pattern(g, "hasDispatchDate", "ResultNotice", "DispatchDate"))
    if month is not None:
        start = dt.date.fromisoformat(month + "-01")
        rn = rn.where(F.trunc(F.to_date("DispatchDate"), "month") == F.lit(start))
    ssi = typed(match(pattern(g, "concernsSubmissionsForLot", "ssi", "Lot"),
                      pattern(g, "hasReceivedTenders", "ssi", "n", cast="bigint").where(F.col("n") == 1)),
                g, "ssi", "SubmissionStatisticalInformation")
    j = typed(match(ssi, pl, rn), g, "Lot", "Lot")
    return j.groupBy("Procedure", "DispatchDate").agg(F.count("Lot").alias("Nr_of_lots_per_Procedure"))


def q14_winner_businesses(g: Graph) -> DataFrame:
    w = typed(pattern(g, "playedBy", "Winner", "Business"), g, "Winner", "Winner")
    biz = match(pattern(g, "hasBusinessSize", "Business", "BusinessSize"),
                _org_country(g, "Business", "CountryCodeURL", org_class="Business"))
    rn = typed(match(pattern(g, "announcesRole", "ResultNotice", "Winner"),
                     pattern(g, "hasDispatchDate", "ResultNotice", "AnnounceDate")),
               g, "ResultNotice", "ResultNotice")
    return match(w, biz, rn)


def q14_report(g: Graph) -> DataFrame:
    return q14_winner_businesses(g).select("Winner", "AnnounceDate", local_name("CountryCodeURL").alias("CountryCode"))


def _awarded_lots_per_procedure(g: Graph, lo: str, hi: str) -> DataFrame:
    lot = a("Lot", "Lot", of_hasProcurementScopeDividedIntoLot=a("Procedure", "Procedure"))
    j = star(g, a("LotAwardOutcome", "LotAwardOutcome", describesLot=lot, of_includesLotAwardOutcome=a(
        "Contract", "Contract", hasContractConclusionDate=one("d", cast="date"))))
    j = j.where((F.col("d") > F.lit(lo).cast("date")) & (F.col("d") < F.lit(hi).cast("date")))
    return j.groupBy("Procedure").agg(F.countDistinct("Lot").alias("Awardet_Lots"))


def q15_awarded_lots_multi_lot(g: Graph, lo: str = "2000-01-01", hi: str = "2030-12-31") -> DataFrame:
    per = _awarded_lots_per_procedure(g, lo, hi).where(F.col("Awardet_Lots") > 1)
    return per.agg(F.sum("Awardet_Lots").cast("bigint").alias("Total_Awardet_Lots"))


def q16_awarded_lots_single_lot(g: Graph, lo: str = "2000-01-01", hi: str = "2030-12-31") -> DataFrame:
    per = _awarded_lots_per_procedure(g, lo, hi).where(F.col("Awardet_Lots") == 1)
    return per.agg(F.sum("Awardet_Lots").cast("bigint").alias("Total_Awardet_Lots"))


def _identifier(g: Graph, owner: str) -> DataFrame:
    i = typed(match(pattern(g, "hasID", owner, "Identifier"),
                    pattern(g, "hasIdentifierValue", "Identifier", "IdValue")), g, "Identifier", "Identifier")
    return i.select(owner, "IdValue")


def q24_business_registration(g: Graph) -> DataFrame:
    biz = _org_country(g, "Business", "CountryCodeURL", org_class="Business")
    return optional(biz, _identifier(g, "Business")) \
        .select("IdValue", "Business", local_name("CountryCodeURL").alias("CountryCode")).distinct()


def q25_buyer_registration(g: Graph) -> DataFrame:
    b = typed(pattern(g, "playedBy", "Buyer", "Organization"), g, "Buyer", "Buyer")
    j = match(b, _org_country(g, "Organization", "CountryCodeURL"))
    return optional(j, _identifier(g, "Organization")) \
        .select("IdValue", "Buyer", local_name("CountryCodeURL").alias("CountryCode")).distinct()


def q26_potential_customers(g: Graph) -> DataFrame:
    contact = a("CustomerContactPoint", "ContactPoint", email=one("CustomerEmail"))
    business = a("Business", "Business", hasLegalName=one("CustomerName"), hasPrimaryContactPoint=contact)
    winner = a("PotentialCostumer", "Winner", playedBy=business)
    award = a(
        "LotAwardOutcome", "LotAwardOutcome",
        of_includesLotAwardOutcome=a("Contract", "Contract", hasContractConclusionDate=one("ContractConclusionDate"),
                                     hasTitle=one("ContractTitle")),
        hasAwardedValue=a("MonetaryValue", "MonetaryValue", hasAmountValue=one("TotalValue", cast="decimal(20,2)"),
                          hasCurrency=one("Currency")),
        describesLot=a("Lot", "Lot", hasPurpose=a("Purpose", "Purpose", hasAdditionalClassification=one("LotCPV"))),
        comprisesTenderAwardOutcome=a("TenderAwardOutcome", "TenderAwardOutcome", indicatesAwardOfLotToWinner=winner))
    return distinct_star(g, award, ["CustomerEmail", "CustomerName", "ContractTitle", "LotCPV", "ContractConclusionDate",
                                    "TotalValue", "Currency"], TotalValue="double")


def q27_subcontracting_share(g: Graph) -> DataFrame:
    t = of_class(g, "Tender", name="tender")
    sc = typed(match(pattern(g, "foreseesSubcontracting", "tender", "subcontract"),
                     pattern(g, "hasSubcontractingEstimatedValue", "subcontract", "value")),
               g, "subcontract", "SubcontractingEstimate").select("tender", "subcontract")
    return optional(t, sc).agg(F.count("tender").alias("nr_of_tenders"), F.count("subcontract").alias("nr_of_subc")) \
        .withColumn("percent", F.round(F.try_divide(F.col("nr_of_subc"), F.col("nr_of_tenders")) * 100, 6))


# ---- Q28: KPI wrappers and W4 delta --------------------------------------
def kpi_number(df: DataFrame, col: str, name: str) -> DataFrame:
    """Single-number KPI: distinct count of a column."""
    return df.agg(F.countDistinct(col).alias(name))


def kpi_null_share(df: DataFrame, col: str, name: str) -> DataFrame:
    """Percentage of rows where ``col`` is null, rounded to 2."""
    return df.agg(F.round(F.lit(100.0) * F.count_if(F.col(col).isNull()) / F.count(F.lit(1)), 2).alias(name))


def kpi_sme(g: Graph) -> DataFrame:
    return kpi_number(q14_winner_businesses(g).where(F.col("BusinessSize") == "sme"), "Business", "Nr_of_SME")


def kpi_missing_seller_reg(g: Graph) -> DataFrame:
    return kpi_null_share(q24_business_registration(g), "IdValue", "Missing_seller_reg_numbers")


def kpi_missing_buyer_reg(g: Graph) -> DataFrame:
    return kpi_null_share(q25_buyer_registration(g), "IdValue", "Missing_buyer_reg_numbers")


def kpi_organizations(g: Graph) -> DataFrame:
    return kpi_number(q6_award_notice_publishers(g), "Organization", "Nr_of_Organizations")


def kpi_pie(df: DataFrame, label: str, value: str) -> DataFrame:
    """Pie KPI: (label, value) rows."""
    return df.select(F.col(label).cast("string").alias("label"), F.col(value).alias("value"))


def report_delta(history: DataFrame, key: str, value: str) -> DataFrame:
    """W4 -- value with the change versus the previous run of the same report.

    ``history`` holds one row per run (``key`` orders runs); it is already
    aggregated, so its size is the number of runs, not of data rows.
    """
    w = Window.orderBy(key)
    return history.select(key, value, (F.col(value) - F.lag(value).over(w)).cast("double").alias("delta"))


def monthly_awards(g: Graph) -> DataFrame:
    """History of one KPI per month: lots whose award decision falls in the month."""
    lao = pattern(g, "hasAwardDecisionDate", "LotAwardOutcome", "d", cast="date")
    per = match(lao, pattern(g, "describesLot", "LotAwardOutcome", "Lot"))
    return per.groupBy(F.trunc("d", "month").cast("string").alias("month")).agg(F.countDistinct("Lot").alias("awarded_lots"))


REPORTS = {
    "q1": q1_eu_lots_by_buyer_country, "q2": q2_eu_lots_by_winner_country, "q3": q3_winners_value_same_country,
    "q4": q4_winners_value_by_winner_country, "q5": q5_buyer_organizations, "q6": q6_award_notice_publishers,
    "q7": q7_non_framework_techniques, "q8": q8_dynamic_purchasing, "q9": q9_single_tender_lots,
    "q14": q14_report, "q15": q15_awarded_lots_multi_lot, "q16": q16_awarded_lots_single_lot,
    "q24": q24_business_registration, "q25": q25_buyer_registration, "q26": q26_potential_customers,
    "q27": q27_subcontracting_share,
}


def materialise(g: Graph, path: str, reports: dict | None = None) -> None:
    """K13 -- write every report as its own table (overwrite), one job per report."""
    for name, fn in (reports or REPORTS).items():
        fn(g).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
