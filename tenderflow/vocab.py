"""Vocabulary: IRIs of classes and predicates, and fixed value lists.

Predicate names are parameters: every graph operator takes IRIs from ``V``,
so a graph written with another ontology version only needs a different map.
"""

from __future__ import annotations

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
XSD = "http://www.w3.org/2001/XMLSchema#"
EPO = "http://example.org/epo#"
ORG = "http://www.w3.org/ns/org#"
LOCN = "http://www.w3.org/ns/locn#"
CPOV = "http://data.example.org/cpov#"
RES = "http://example.org/res/"
CPV_NS = "http://example.org/cpv/"
NUTS_NS = "http://example.org/nuts/"
COUNTRY_NS = "http://example.org/country/"
CURRENCY_NS = "http://example.org/currency/"
PROCEDURE_TYPE_NS = "http://example.org/procedure-type/"
AWARD_STATUS_NS = "http://example.org/award-status/"
GRAPH_CPV = "http://example.org/graph/cpv"
GRAPH_NUTS = "http://example.org/graph/nuts"

_EPO_CLASSES = [
    "ResultNotice", "Procedure", "Lot", "Tender", "TenderAwardOutcome", "LotAwardOutcome",
    "SubmissionStatisticalInformation", "Buyer", "Winner", "Contract", "MonetaryValue", "Identifier",
    "Purpose", "ContractTerm", "Location", "SpecificDuration", "SubcontractingEstimate", "Business",
    "FrameworkAgreementTechniqueUsage", "DynamicPurchaseSystemTechnique", "EAuctionTechniqueUsage",
]
_EPO_PREDICATES = [
    "hasPublicationDate", "hasDispatchDate", "refersToProcedure", "refersToLot", "announcesRole", "refersToRole",
    "hasProcedureType", "isCoveredByGPA", "hasTitle", "hasDescription", "hasAdditionalInformation", "hasID",
    "hasIdentifierValue", "hasEstimatedValue", "hasAmountValue", "hasCurrency", "bindsBuyer", "includesLot",
    "includesLotAwardOutcome", "hasContractConclusionDate", "playedBy", "hasContactPointInRole",
    "hasProcurementScopeDividedIntoLot", "usesTechnique", "hasOverallPurpose", "isUsingEUFunds", "hasPurpose",
    "hasMainClassification", "hasAdditionalClassification", "foreseesContractSpecificTerm",
    "definesSpecificPlaceOfPerformance", "hasNutsCode", "definesContractDuration", "isSubmittedForLot",
    "hasFinancialOfferValue", "foreseesSubcontracting", "hasSubcontractingEstimatedValue", "describesTender",
    "awardsLotToWinner", "indicatesAwardOfLotToWinner", "describesLot", "comprisesTenderAwardOutcome",
    "hasAwardStatus", "hasAwardedValue", "hasBargainPrice", "hasAwardDecisionDate",
    "summarisesInformationForLotAwardOutcome", "concernsSubmissionsForLot", "hasReceivedTenders",
    "hasReceivedSMETenders", "hasEUReceivedTenders", "hasReceivedNonEUTenders", "hasElectronicTenders",
    "hasHighestReceivedTenderValue", "hasLowestReceivedTenderValue", "hasLegalName", "hasPrimaryContactPoint",
    "hasBusinessSize", "hasCountryCode", "isSubjectToProcedureSpecificTerm", "isAwardedByCPB",
    "announcesNoticeAwardInformation", "hasTotalAwardedValue",
]


class _Vocab(dict):
    def __getattr__(self, name: str) -> str:
        try:
            return self[name]
        except KeyError as exc:  # pragma: no cover - programming error
            raise AttributeError(name) from exc


V = _Vocab({name: EPO + name for name in _EPO_CLASSES + _EPO_PREDICATES})
V.update({
    "type": RDF_TYPE,
    "Organization": ORG + "Organization",
    "Address": LOCN + "Address",
    "registeredAddress": LOCN + "registeredAddress",
    "postCode": LOCN + "postCode",
    "postName": LOCN + "postName",
    "thoroughfare": LOCN + "thoroughfare",
    "fullAddress": LOCN + "fullAddress",
    "address": LOCN + "address",
    "ContactPoint": CPOV + "ContactPoint",
    "email": CPOV + "email",
    "telephone": CPOV + "telephone",
    "hasFax": EPO + "hasFax",
    "hasInternetAddress": EPO + "hasInternetAddress",
    "hasContactName": EPO + "hasContactName",
    "prefLabel": "http://www.w3.org/2004/02/skos/core#prefLabel",
    "broader": "http://www.w3.org/2004/02/skos/core#broader",
    "identifier": "http://purl.org/dc/elements/1.1/identifier",
})

# ---- fixed values (must stay as they are for results to match) ----------
# Currencies of monetary values, indexed by key % 5; XYZ has no rate on purpose.
CURRENCIES = ["EUR", "PLN", "RON", "BGN", "XYZ"]
# Procedure type by order priority.
PROCEDURE_TYPES = {
    "1-URGENT": "open",
    "2-HIGH": "restricted",
    "3-MEDIUM": "neg-w-call",
    "4-NOT SPECIFIED": "comp-dial",
    "5-LOW": "neg-wo-call",
}
# Technique used by a procedure, by order status.
TECHNIQUES = {"F": "FrameworkAgreementTechniqueUsage", "P": "DynamicPurchaseSystemTechnique", "O": "EAuctionTechniqueUsage"}
# Award status by line status.
AWARD_STATUSES = {"F": "selec-w", "O": "open-nw"}
# Separator of concatenated lists in extracted text.
LIST_SEPARATOR = " ||| "
# Notice link template (a parameter of the link functions); {notice_id} is "<number>-<year>".
NOTICE_LINK = "https://notices.example.org/udl?uri=NOTICE:{notice_id}:TEXT:EN:HTML"
# Days each commercial tier lags behind the run date.
TIER_LAG_DAYS = {"free": 180, "starter": 90, "premium": 0}
# Levels kept per tier: CPV ranks, lot NUTS levels, buyer/winner NUTS levels (exclusive bound).
TIER_CPV_RANKS = {"free": [0], "starter": [0, 1], "premium": [0, 1, 2, 3, 4]}
TIER_LOT_NUTS = {"free": [0], "starter": [0, 1], "premium": [0, 1, 2, 3]}
TIER_ORG_NUTS_LIMIT = {"free": 1, "starter": 2, "premium": 4}
# Record-linkage defaults.
LINK_THRESHOLD = 0.8
LINK_PRIOR = 0.0001
