"""The driver's TPC-H-style tables seen as a procurement knowledge graph.

Mapping (one predicate = one projection of one table, no shuffle unless noted):

  orders    -> ResultNotice, Procedure, Contract, Buyer role (one each per order)
  lineitem  -> Lot, Tender, TenderAwardOutcome, LotAwardOutcome, Winner role,
               SubmissionStatisticalInformation, lot purpose/term (one each per row;
               (l_orderkey, l_partkey, l_suppkey) identifies a row)
  customer  -> buyer Organization, Address, ContactPoint, Identifier
  supplier  -> winner Organization + Business, Address, ContactPoint, Identifier
  part      -> CPV code list (sources.dims); nation -> countries and NUTS roots

Two predicates need the order date on a lineitem row (the notice IRI carries
the year): ``refersToLot`` and the winner ``announcesRole``; they join
lineitem with two columns of orders on the order key. The procedure-level CPV
(``hasOverallPurpose/hasMainClassification``) is de-duplicated, since two rows
of one order may carry the same part.

The rules below are the single definition of the mapping; the DuckDB oracles
restate them in SQL against the base tables.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..vocab import (AWARD_STATUS_NS, COUNTRY_NS, CPV_NS, CURRENCIES, CURRENCY_NS, NUTS_NS, PROCEDURE_TYPE_NS,
                     PROCEDURE_TYPES, RDF_TYPE, RES, TECHNIQUES, XSD, AWARD_STATUSES, V)
from .tables import Tables
from .triples import About, Affixed, Graph, Mapped, Mapping, Rows, Term, branch

BOOL, DATE, DEC, INT = XSD + "boolean", XSD + "date", XSD + "decimal", XSD + "integer"


# ---- derivation rules (shared by the graph, the dimensions and the docs) -----
def s(c) -> Column:
    return F.col(c).cast("string")


def iri(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def currency_of(key: str) -> Column:
    """Currency code of a monetary value: CURRENCIES[key % 5]."""
    return F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), (F.col(key) % 5).cast("int") + 1)


def alpha2(nk: Column) -> Column:
    """Two-letter country code of a nation key."""
    return F.concat(F.chr(F.lit(65) + F.floor(nk / 26) % 26), F.chr(F.lit(65) + nk % 26))


def alpha3(nk: Column) -> Column:
    return F.concat(alpha2(nk), F.lit("X"))


def nuts3(key: Column, nk: Column) -> Column:
    """Five-character NUTS-3 code: country (2) + region letter + two digits."""
    return F.concat(alpha2(nk), F.chr(F.lit(65) + key % 3),
                    (F.lit(1) + F.floor(key / 3) % 4).cast("string"),
                    (F.lit(1) + F.floor(key / 12) % 5).cast("string"))


def cpv_code(pk: Column) -> Column:
    """Eight-digit CPV code of a part key: division 10..49 + three digits + '000'."""
    return F.concat((F.lit(10) + pk % 40).cast("string"), (F.floor(pk / 40) % 4).cast("string"),
                    (F.floor(pk / 160) % 3).cast("string"), (F.floor(pk / 480) % 3).cast("string"), F.lit("000"))


def bool_text(cond: Column) -> Column:
    """xsd:boolean literal text; a CASE (not a cast) so that ``o = 'true'`` folds back into ``cond`` and
    reaches the parquet scan as a pushed filter."""
    return F.when(cond, F.lit("true")).otherwise(F.lit("false"))


def money(c: str) -> Column:
    return F.col(c).cast("decimal(20,2)").cast("string")


def yyyymmdd(c: str) -> Column:
    return F.date_format(F.col(c), "yyyyMMdd")


def iso_date(c: str) -> Column:
    return F.to_date(F.col(c)).cast("string")


def notice_iri(ok: str = "o_orderkey", date: str = "o_orderdate") -> Term:
    return Term("Notice", iri(RES + "id_", F.year(F.col(date)).cast("string"), "-S-001-", s(ok), "_Notice"),
                parts=(F.col(date), F.col(ok)))


def order_iri(kind: str, ok: str = "o_orderkey") -> Term:
    return Term(kind, iri(RES + "id_", s(ok), "_" + kind), parts=(F.col(ok),))


def row_iri(kind: str) -> Term:
    return Term(kind, iri(RES + "id_", s("l_orderkey"), "_" + kind + "_", s("l_linenumber"), "-", s("l_partkey"), "-",
                          s("l_suppkey")), parts=tuple(F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))


def org_iri(role: str, key: str, kind: str = "Organization") -> Term:
    made = Affixed(RES + "id_" + role + "_", key, "_" + kind)
    return Term(f"{role} {kind}", made.col, made, parts=(F.col(key),))


def cls(name: str) -> Column:
    return F.lit(V[name])


def _mapped(col: str, mapping: dict, prefix: str) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == k, F.lit(prefix + v)) if expr is None
                else expr.when(F.col(col) == k, F.lit(prefix + v)))
    return expr


# IRIs minted per class by the rules above: every IRI matching a pattern carries that rdf:type
# (the type triple is emitted from the same rows, under the same conditions, as the IRI itself).
# Technique classes depend on the order status, not the IRI, and keep the semi-join.
CLASS_PATTERNS = {V[c]: RES.replace(".", r"\.") + p for c, p in {
    "ResultNotice": r"id_\d+-S-001-\d+_Notice$", "Procedure": r"id_\d+_Procedure$",
    "Contract": r"id_\d+_Contract$", "Buyer": r"id_\d+_Buyer$", "Lot": r"id_\d+_Lot_",
    "Tender": r"id_\d+_Tender_", "TenderAwardOutcome": r"id_\d+_TenderAwardOutcome_",
    "LotAwardOutcome": r"id_\d+_LotAwardOutcome_",
    "SubmissionStatisticalInformation": r"id_\d+_SubmissionStatisticalInformation_",
    "Winner": r"id_\d+_Winner_", "MonetaryValue": r"id_\d+_(ProcedureValue$|LotValue_|TenderValue_|AwardedValue_)",
    "Identifier": r"id_.*Identifier$", "Purpose": r"id_\d+_(ProcedurePurpose$|LotPurpose_)",
    "ContractTerm": r"id_\d+_ContractTerm_", "Location": r"id_\d+_Location_",
    "SpecificDuration": r"id_\d+_Duration_", "SubcontractingEstimate": r"id_\d+_Subcontract_",
    "Organization": r"id_(customer|supplier)_\d+_Organization$", "Business": r"id_supplier_\d+_Organization$",
    "Address": r"id_((customer|supplier)_\d+_Address$|\d+_LotAddress_)",
    "ContactPoint": r"id_((customer|supplier)_\d+_ContactPoint$|\d+_BuyerContactPoint$)",
}.items()}
CLASS_PATTERNS = {k: "^" + v for k, v in CLASS_PATTERNS.items()}


def build_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """Virtual graph over the driver tables in ``sf_dir``."""
    t = Tables(spark, sf_dir)
    B: dict[object, list] = defaultdict(list)
    sources = {"orders": lambda: t.orders, "lineitem": lambda: t.lineitem, "customer": lambda: t.customer,
               "supplier": lambda: t.supplier,
               # lineitem rows with their order (a line's notice IRI needs the order's date)
               "lines": lambda: t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))}
    mapping = Mapping(sources, {n: {"lineitem", "orders"} if n == "lines" else {n} for n in sources},
                      {n: "lineitem" if n == "lines" else n for n in sources},
                      dealt={"orders": "o_orderkey", "lineitem": "l_orderkey", "lines": "l_orderkey"})

    def add(p: str, fn) -> None:
        B[V[p]].append(fn)
        if isinstance(b := fn(), Mapped):
            mapping.home.setdefault(b.s.key, b.rows.source)

    def typ(c: str, fn) -> None:
        B[(RDF_TYPE, V[c])].append(fn)
        mapping.home.setdefault(fn().s.key, fn().rows.source)

    def rows(name: str):
        return lambda: Rows(name, sources[name])

    O, L, C, S, lo = rows("orders"), rows("lineitem"), rows("customer"), rows("supplier"), rows("lines")

    # ---- orders: notice, procedure, contract, buyer role --------------------
    notice, proc, contract, brole = notice_iri(), order_iri("Procedure"), order_iri("Contract"), order_iri("Buyer")
    typ("ResultNotice", lambda: Mapped(O(), notice, cls("ResultNotice")))
    add("hasPublicationDate", lambda: Mapped(O(), notice, yyyymmdd("o_orderdate"), "literal",
                                                raw=F.col("o_orderdate")))
    add("hasDispatchDate", lambda: Mapped(O(), notice, iso_date("o_orderdate"), "literal", dtype=DATE))
    add("refersToProcedure", lambda: Mapped(O(), notice, proc))
    add("announcesRole", lambda: Mapped(O(), notice, brole))
    add("refersToRole", lambda: Mapped(O(), notice, brole))
    add("refersToLot", lambda: Mapped(lo(), notice_iri("l_orderkey"), row_iri("Lot")))
    add("announcesRole", lambda: Mapped(lo(), notice_iri("l_orderkey"), row_iri("Winner")))

    typ("Procedure", lambda: Mapped(O(), proc, cls("Procedure")))
    add("hasProcedureType", lambda: Mapped(O(), proc, _mapped("o_orderpriority", PROCEDURE_TYPES, PROCEDURE_TYPE_NS)))
    add("isCoveredByGPA", lambda: Mapped(O().where(F.col("o_orderstatus").isNotNull()), proc,
                                         bool_text(F.col("o_orderstatus") == "F"), "literal",
                                         dtype=BOOL))
    add("hasTitle", lambda: Mapped(O().where(F.col("o_orderstatus") == "F"), proc,
                                   F.concat(F.lit("Procedure "), s("o_orderkey")), "literal", "en"))
    add("hasTitle", lambda: Mapped(O(), proc, F.concat(F.lit("Verfahren "), s("o_orderkey")), "literal", "de"))
    add("hasDescription", lambda: Mapped(O(), proc, F.concat(F.lit("Description du marche "), s("o_orderkey")),
                                         "literal", "fr"))
    add("hasDescription", lambda: Mapped(O().where(F.col("o_orderstatus") == "O"), proc,
                                         F.concat(F.lit("Order of customer "), s("o_custkey")), "literal", "en"))
    add("hasAdditionalInformation", lambda: Mapped(O(), proc, F.concat(F.lit("Informacion "), s("o_orderkey")),
                                                   "literal", "es"))
    add("hasAdditionalInformation", lambda: Mapped(O().where(F.col("o_orderstatus") == "P"), proc,
                                                   F.concat(F.lit("Additional information "), s("o_orderkey")),
                                                   "literal", "en"))
    pident, pvalue, tech = order_iri("ProcedureIdentifier"), order_iri("ProcedureValue"), order_iri("Technique")
    ppurpose, pterm = order_iri("ProcedurePurpose"), order_iri("ProcedureTerm")
    add("hasID", lambda: Mapped(O(), proc, pident))
    typ("Identifier", lambda: Mapped(O(), pident, cls("Identifier")))
    add("hasIdentifierValue", lambda: Mapped(O(), pident, F.concat(F.lit("PROC-"), s("o_orderkey")), "literal"))
    add("hasEstimatedValue", lambda: Mapped(O(), proc, pvalue))
    typ("MonetaryValue", lambda: Mapped(O(), pvalue, cls("MonetaryValue")))
    add("hasAmountValue", lambda: Mapped(O(), pvalue, money("o_totalprice"), "literal", dtype=DEC))
    add("hasCurrency", lambda: Mapped(O(), pvalue, F.concat(F.lit(CURRENCY_NS), currency_of("o_custkey"))))
    add("usesTechnique", lambda: Mapped(O(), proc, tech))
    for status, tclass in TECHNIQUES.items():
        typ(tclass, lambda st=status, tc=tclass: Mapped(O().where(F.col("o_orderstatus") == st), tech, cls(tc)))
    add("hasOverallPurpose", lambda: Mapped(O(), proc, ppurpose))
    add("hasPurpose", lambda: Mapped(O(), proc, ppurpose))
    nai = order_iri("NoticeAwardInformation")
    add("announcesNoticeAwardInformation", lambda: Mapped(O().where(F.col("o_orderstatus") == "F"), notice, nai))
    add("hasTotalAwardedValue", lambda: Mapped(O().where(F.col("o_orderstatus") == "F"), nai, pvalue))
    typ("Purpose", lambda: Mapped(O(), ppurpose, cls("Purpose")))
    add("hasMainClassification", lambda: About(ppurpose.key, lambda: branch(
        # distinct on the key and the code: the IRIs minted from them are many times as long
        t.lineitem.select("l_orderkey", cpv_code(F.col("l_partkey")).alias("_code")).distinct(),
        order_iri("ProcedurePurpose", "l_orderkey").col, F.concat(F.lit(CPV_NS), F.col("_code")))))
    add("isSubjectToProcedureSpecificTerm", lambda: Mapped(O().where(F.col("o_orderpriority") == "2-HIGH"),
                                                           proc, pterm))
    add("isAwardedByCPB", lambda: Mapped(O().where(F.col("o_orderpriority") == "2-HIGH"), pterm, F.lit("true"),
                                         "literal", dtype=BOOL))

    typ("Contract", lambda: Mapped(O(), contract, cls("Contract")))
    add("bindsBuyer", lambda: Mapped(O(), contract, brole))
    add("hasContractConclusionDate", lambda: Mapped(O(), contract, Affixed("", F.to_date("o_orderdate")), "literal",
                                                    dtype=DATE))
    add("hasTitle", lambda: Mapped(O(), contract, Affixed("Contract ", "o_orderkey"), "literal", "en"))

    bcp = order_iri("BuyerContactPoint")
    typ("Buyer", lambda: Mapped(O(), brole, cls("Buyer")))
    add("playedBy", lambda: Mapped(O(), brole, org_iri("customer", "o_custkey")))
    add("hasContactPointInRole", lambda: Mapped(O().where(F.col("o_orderpriority") == "1-URGENT"), brole, bcp))
    typ("ContactPoint", lambda: Mapped(O().where(F.col("o_orderpriority") == "1-URGENT"), bcp, cls("ContactPoint")))
    add("email", lambda: Mapped(O().where(F.col("o_orderpriority") == "1-URGENT"), bcp,
                                F.concat(F.lit("procurement"), s("o_orderkey"), F.lit("@buyer.example")), "literal"))

    # ---- lineitem: lot, tender, outcomes, winner role ------------------------
    lot, tender, tao, lao = row_iri("Lot"), row_iri("Tender"), row_iri("TenderAwardOutcome"), row_iri("LotAwardOutcome")
    ssi, wrole, lvalue, tvalue = (row_iri("SubmissionStatisticalInformation"), row_iri("Winner"),
                                  row_iri("LotValue"), row_iri("TenderValue"))
    avalue, lpurpose, term, loc = row_iri("AwardedValue"), row_iri("LotPurpose"), row_iri("ContractTerm"), row_iri("Location")
    dur, subc = row_iri("Duration"), row_iri("Subcontract")
    lproc, lcontract = order_iri("Procedure", "l_orderkey"), order_iri("Contract", "l_orderkey")
    lcur = Affixed(CURRENCY_NS, currency_of("l_suppkey"))

    typ("Lot", lambda: Mapped(L(), lot, cls("Lot")))
    add("hasProcurementScopeDividedIntoLot", lambda: Mapped(L(), lproc, lot))
    add("includesLot", lambda: Mapped(L(), lcontract, lot))
    add("isUsingEUFunds", lambda: Mapped(L().where(F.col("l_returnflag").isNotNull()), lot,
                                         bool_text(F.col("l_returnflag") == "R"), "literal",
                                         dtype=BOOL))
    add("hasTitle", lambda: Mapped(L().where(F.col("l_linestatus") == "F"), lot,
                                   F.concat(F.lit("Lot "), s("l_linenumber"), F.lit(" of "), s("l_orderkey")),
                                   "literal", "en"))
    add("hasTitle", lambda: Mapped(L(), lot, F.concat(F.lit("Czesc "), s("l_linenumber"), F.lit(" z "),
                                                      s("l_orderkey")), "literal", "pl"))
    add("hasDescription", lambda: Mapped(L(), lot, F.concat(F.lit("Descriere lot "), s("l_partkey")), "literal", "ro"))
    add("hasDescription", lambda: Mapped(L().where(F.col("l_returnflag") == "A"), lot,
                                         F.concat(F.lit("Supply of part "), s("l_partkey")), "literal", "en"))
    add("hasEstimatedValue", lambda: Mapped(L(), lot, lvalue))
    typ("MonetaryValue", lambda: Mapped(L(), lvalue, cls("MonetaryValue")))
    add("hasAmountValue", lambda: Mapped(L(), lvalue, money("l_extendedprice"), "literal", dtype=DEC))
    add("hasCurrency", lambda: Mapped(L(), lvalue, lcur))
    add("hasPurpose", lambda: Mapped(L(), lot, lpurpose))
    typ("Purpose", lambda: Mapped(L(), lpurpose, cls("Purpose")))
    add("hasMainClassification", lambda: Mapped(L(), lpurpose, F.concat(F.lit(CPV_NS), cpv_code(F.col("l_partkey")))))
    add("hasAdditionalClassification", lambda: Mapped(L(), lpurpose, Affixed(CPV_NS, cpv_code(F.col("l_partkey")))))
    add("foreseesContractSpecificTerm", lambda: Mapped(L(), lot, term))
    typ("ContractTerm", lambda: Mapped(L(), term, cls("ContractTerm")))
    add("definesSpecificPlaceOfPerformance", lambda: Mapped(L(), term, loc))
    typ("Location", lambda: Mapped(L(), loc, cls("Location")))
    add("hasNutsCode", lambda: Mapped(L(), loc, F.concat(F.lit(NUTS_NS), nuts3(F.col("l_partkey"),
                                                                                F.col("l_suppkey") % 25))))
    laddr = row_iri("LotAddress")
    add("address", lambda: Mapped(L(), loc, laddr))
    typ("Address", lambda: Mapped(L(), laddr, cls("Address")))
    add("fullAddress", lambda: Mapped(L(), laddr, F.concat(F.lit("Lieu "), s("l_partkey")), "literal", "fr"))
    add("fullAddress", lambda: Mapped(L().where(F.col("l_linestatus") == "O"), laddr,
                                      F.concat(F.lit("Site of part "), s("l_partkey")), "literal", "en"))
    add("definesContractDuration", lambda: Mapped(L().where(F.col("l_linestatus") == "O"), term, dur))
    typ("SpecificDuration", lambda: Mapped(L().where(F.col("l_linestatus") == "O"), dur, cls("SpecificDuration")))

    typ("Tender", lambda: Mapped(L(), tender, cls("Tender")))
    add("isSubmittedForLot", lambda: Mapped(L(), tender, lot))
    add("hasFinancialOfferValue", lambda: Mapped(L(), tender, tvalue))
    typ("MonetaryValue", lambda: Mapped(L(), tvalue, cls("MonetaryValue")))
    add("hasAmountValue", lambda: Mapped(L(), tvalue, money("l_extendedprice"), "literal", dtype=DEC))
    add("hasCurrency", lambda: Mapped(L(), tvalue, lcur))
    sub = lambda: L().where(F.col("l_tax") >= 0.05)
    add("foreseesSubcontracting", lambda: Mapped(sub(), tender, subc))
    typ("SubcontractingEstimate", lambda: Mapped(sub(), subc, cls("SubcontractingEstimate")))
    add("hasSubcontractingEstimatedValue", lambda: Mapped(sub(), subc, money("l_tax"), "literal", dtype=DEC))

    typ("TenderAwardOutcome", lambda: Mapped(L(), tao, cls("TenderAwardOutcome")))
    add("describesTender", lambda: Mapped(L(), tao, tender))
    add("awardsLotToWinner", lambda: Mapped(L(), tao, wrole))
    add("indicatesAwardOfLotToWinner", lambda: Mapped(L(), tao, wrole))
    typ("Winner", lambda: Mapped(L(), wrole, cls("Winner")))
    add("playedBy", lambda: Mapped(L(), wrole, org_iri("supplier", "l_suppkey")))

    typ("LotAwardOutcome", lambda: Mapped(L(), lao, cls("LotAwardOutcome")))
    add("describesLot", lambda: Mapped(L(), lao, lot))
    add("comprisesTenderAwardOutcome", lambda: Mapped(L(), lao, tao))
    add("hasAwardStatus", lambda: Mapped(L(), lao, _mapped("l_linestatus", AWARD_STATUSES, AWARD_STATUS_NS)))
    add("hasAwardedValue", lambda: Mapped(L(), lao, avalue))
    typ("MonetaryValue", lambda: Mapped(L(), avalue, cls("MonetaryValue")))
    add("hasAmountValue", lambda: Mapped(L(), avalue, money("l_extendedprice"), "literal", dtype=DEC))
    add("hasCurrency", lambda: Mapped(L(), avalue, lcur))
    add("hasAwardDecisionDate", lambda: Mapped(L(), lao, iso_date("l_shipdate"), "literal", dtype=DATE))
    add("includesLotAwardOutcome", lambda: Mapped(L(), lcontract, lao))

    typ("SubmissionStatisticalInformation", lambda: Mapped(L(), ssi, cls("SubmissionStatisticalInformation")))
    add("summarisesInformationForLotAwardOutcome", lambda: Mapped(L(), ssi, lao))
    add("concernsSubmissionsForLot", lambda: Mapped(L(), ssi, lot))
    q = F.col("l_quantity").cast("int")
    add("hasReceivedTenders", lambda: Mapped(L(), ssi, (q % 5).cast("string"), "literal", dtype=INT))
    add("hasReceivedSMETenders", lambda: Mapped(L(), ssi, (q % 3).cast("string"), "literal", dtype=INT))
    add("hasEUReceivedTenders", lambda: Mapped(L(), ssi, (q % 4).cast("string"), "literal", dtype=INT))
    add("hasReceivedNonEUTenders", lambda: Mapped(L().where(F.col("l_returnflag") != "N"), ssi,
                                                  (F.col("l_linenumber") % 2).cast("string"), "literal", dtype=INT))
    add("hasElectronicTenders", lambda: Mapped(L(), ssi, (F.col("l_linenumber") % 3).cast("string"), "literal",
                                               dtype=INT))
    add("hasHighestReceivedTenderValue", lambda: Mapped(L(), ssi, tvalue))
    add("hasLowestReceivedTenderValue", lambda: Mapped(L().where(F.col("l_linestatus") == "F"), ssi, lvalue))

    # ---- organisations: customers (buyers) and suppliers (winners) -----------
    for role, df, key, nk, bal, name, alt in (
            ("customer", C, "c_custkey", "c_nationkey", "c_acctbal", "c_name", "c_mktsegment"),
            ("supplier", S, "s_suppkey", "s_nationkey", "s_acctbal", "s_name", None)):
        org, addr, cp, ident = (org_iri(role, key), org_iri(role, key, "Address"), org_iri(role, key, "ContactPoint"),
                                org_iri(role, key, "Identifier"))
        other_name = (F.concat(F.col(alt), F.lit(" "), s(key)) if alt
                      else F.concat(F.lit("Fournisseur "), s(key)))
        typ("Organization", lambda df=df, org=org: Mapped(df(), org, cls("Organization")))
        add("hasLegalName", lambda df=df, org=org, bal=bal, name=name: Mapped(
            df().where(F.col(bal) > 0), org, F.col(name), "literal", "en"))
        add("hasLegalName", lambda df=df, org=org, on=other_name: Mapped(df(), org, on, "literal", "fr"))
        add("registeredAddress", lambda df=df, org=org, addr=addr: Mapped(df(), org, addr))
        typ("Address", lambda df=df, addr=addr: Mapped(df(), addr, cls("Address")))
        add("hasCountryCode", lambda df=df, addr=addr, nk=nk: Mapped(
            df(), addr, F.concat(F.lit(COUNTRY_NS), alpha3(F.col(nk)))))
        add("hasNutsCode", lambda df=df, addr=addr, key=key, nk=nk: Mapped(
            df(), addr, F.concat(F.lit(NUTS_NS), nuts3(F.col(key), F.col(nk)))))
        add("postCode", lambda df=df, addr=addr, key=key: Mapped(df(), addr, (F.col(key) + 10000).cast("string"),
                                                                  "literal"))
        add("postName", lambda df=df, addr=addr, nk=nk: Mapped(df(), addr, F.concat(F.lit("City "), s(nk)), "literal"))
        add("thoroughfare", lambda df=df, addr=addr, key=key, bal=bal: Mapped(
            df().where(F.col(bal) > 1000), addr, F.concat(F.lit("Street "), s(key)), "literal"))
        add("hasID", lambda df=df, org=org, ident=ident, bal=bal: Mapped(df().where(F.col(bal) > 1000), org, ident))
        typ("Identifier", lambda df=df, ident=ident, bal=bal: Mapped(df().where(F.col(bal) > 1000), ident,
                                                                      cls("Identifier")))
        add("hasIdentifierValue", lambda df=df, ident=ident, key=key, bal=bal, role=role: Mapped(
            df().where(F.col(bal) > 1000), ident, F.concat(F.lit(role[:4].upper() + "-"), s(key)), "literal"))
        add("hasPrimaryContactPoint", lambda df=df, org=org, cp=cp: Mapped(df(), org, cp))
        typ("ContactPoint", lambda df=df, cp=cp: Mapped(df(), cp, cls("ContactPoint")))
        add("email", lambda df=df, cp=cp, key=key, role=role: Mapped(
            df(), cp, Affixed(role, key, "@" + role + ".example"), "literal"))
        add("telephone", lambda df=df, cp=cp, key=key: Mapped(df(), cp, F.concat(F.lit("+32 2 "), s(key)), "literal"))
        add("hasFax", lambda df=df, cp=cp, key=key, bal=bal: Mapped(
            df().where(F.col(bal) > 5000), cp, F.concat(F.lit("+32 3 "), s(key)), "literal"))
        add("hasInternetAddress", lambda df=df, cp=cp, key=key, role=role, bal=bal: Mapped(
            df().where(F.col(bal) < 2000), cp, F.concat(F.lit("http://www." + role), s(key), F.lit(".example")),
            "literal", dtype=XSD + "anyURI"))
        add("hasContactName", lambda df=df, cp=cp, name=name: Mapped(df(), cp, F.col(name), "literal", "en"))
    typ("Business", lambda: Mapped(S(), org_iri("supplier", "s_suppkey"), cls("Business")))
    add("hasBusinessSize", lambda: Mapped(S(), org_iri("supplier", "s_suppkey"),
                                          F.when(F.col("s_acctbal") < 5000, "sme").otherwise("large"), "literal"))
    from .dims import taxonomy_branches  # named graphs of the two code taxonomies (S3)
    for key, builders in taxonomy_branches(spark, sf_dir).items():
        B[key].extend(builders)
    return Graph(spark, branches=dict(B), class_patterns=CLASS_PATTERNS, mapping=mapping)
