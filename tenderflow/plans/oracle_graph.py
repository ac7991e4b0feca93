"""DuckDB SQL for the stored and serialised graph: how many triples every predicate has."""

from __future__ import annotations

from ..vocab import RDF_TYPE, V
from .oracle_tables import CPV_CODES, NUTS_CODES

#: what is counted: rows of a table under a condition
_COUNTS = {
    "O": "orders", "OF": "orders where o_orderstatus = 'F'", "OO": "orders where o_orderstatus = 'O'", "OP": "orders where o_orderstatus = 'P'",
    "OS": "orders where o_orderstatus is not null", "OU": "orders where o_orderpriority = '1-URGENT'",
    "OH": "orders where o_orderpriority = '2-HIGH'", "L": "lineitem", "LF": "lineitem where l_linestatus = 'F'",
    "LO": "lineitem where l_linestatus = 'O'", "LA": "lineitem where l_returnflag = 'A'", "LR": "lineitem where l_returnflag is not null",
    "LN": "lineitem where l_returnflag <> 'N'", "LT": "lineitem where l_tax >= 0.05",
    "LW": "lineitem join orders on o_orderkey = l_orderkey", "C": "customer", "S": "supplier",
    **{f"{t}{k}": f"{n} where {c}_acctbal {op}" for t, n, c in (("C", "customer", "c"), ("S", "supplier", "s"))
       for k, op in (("pos", "> 0"), ("1000", "> 1000"), ("5000", "> 5000"), ("low", "< 2000"))},
    "PC": "(select distinct l_orderkey, {cpv} from lineitem)", "CPV": "cpv_codes", "CPVsub": "cpv_codes where length(rtrim(code, '0')) >= 2",
    "NUTS": "nuts_codes", "NUTSsub": "nuts_codes where level > 0",
}
#: predicate, kind, language, sum of counts
_TRIPLES = """
type iri - O+O+O+C1000+S1000+O+L+L+L+OF+OP+OO+O+L+O+O+OU+C+S+L+L+L+L+C+S+LO+L+LT+L+L+L+L+C+S+S
hasPublicationDate literal - O
hasDispatchDate literal - O
refersToProcedure iri - O
announcesRole iri - O+LW
refersToRole iri - O
refersToLot iri - LW
hasProcedureType iri - O
isCoveredByGPA literal - OS
hasTitle literal en OF+O+LF
hasTitle literal de O
hasTitle literal pl L
hasDescription literal fr O
hasDescription literal en OO+LA
hasDescription literal ro L
hasAdditionalInformation literal es O
hasAdditionalInformation literal en OP
hasID iri - O+C1000+S1000
hasIdentifierValue literal - O+C1000+S1000
hasEstimatedValue iri - O+L
hasAmountValue literal - O+L+L+L
hasCurrency iri - O+L+L+L
usesTechnique iri - O
hasOverallPurpose iri - O
hasPurpose iri - O+L
announcesNoticeAwardInformation iri - OF
hasTotalAwardedValue iri - OF
hasMainClassification iri - PC+L
isSubjectToProcedureSpecificTerm iri - OH
isAwardedByCPB literal - OH
bindsBuyer iri - O
hasContractConclusionDate literal - O
playedBy iri - O+L
hasContactPointInRole iri - OU
email literal - OU+C+S
hasProcurementScopeDividedIntoLot iri - L
includesLot iri - L
isUsingEUFunds literal - LR
hasAdditionalClassification iri - L
foreseesContractSpecificTerm iri - L
definesSpecificPlaceOfPerformance iri - L
hasNutsCode iri - L+C+S
address iri - L
fullAddress literal fr L
fullAddress literal en LO
definesContractDuration iri - LO
isSubmittedForLot iri - L
hasFinancialOfferValue iri - L
foreseesSubcontracting iri - LT
hasSubcontractingEstimatedValue literal - LT
describesTender iri - L
awardsLotToWinner iri - L
indicatesAwardOfLotToWinner iri - L
describesLot iri - L
comprisesTenderAwardOutcome iri - L
hasAwardStatus iri - L
hasAwardedValue iri - L
hasAwardDecisionDate literal - L
includesLotAwardOutcome iri - L
summarisesInformationForLotAwardOutcome iri - L
concernsSubmissionsForLot iri - L
hasReceivedTenders literal - L
hasReceivedSMETenders literal - L
hasEUReceivedTenders literal - L
hasReceivedNonEUTenders literal - LN
hasElectronicTenders literal - L
hasHighestReceivedTenderValue iri - L
hasLowestReceivedTenderValue iri - LF
hasLegalName literal en Cpos+Spos
hasLegalName literal fr C+S
registeredAddress iri - C+S
hasCountryCode iri - C+S
postCode literal - C+S
postName literal - C+S
thoroughfare literal - C1000+S1000
hasPrimaryContactPoint iri - C+S
telephone literal - C+S
hasFax literal - C5000+S5000
hasInternetAddress literal - Clow+Slow
hasContactName literal en C+S
hasBusinessSize literal - S
identifier literal - CPV+NUTS
prefLabel literal en CPV+NUTS+NUTSsub
broader iri - CPVsub+NUTSsub
"""


def graph_counts_sql(cpv: str) -> str:
    """(p, o_kind, lang, n) of the whole graph."""
    one = ", ".join(f"(select count(*) from {src.format(cpv=cpv)}) as {name}" for name, src in _COUNTS.items())
    rows = []
    for line in _TRIPLES.split("\n"):
        if line:
            p, kind, lang, total = line.split()
            rows.append(f"('{RDF_TYPE if p == 'type' else V[p]}', '{kind}', '{'' if lang == '-' else lang}', {total})")
    return f"with {CPV_CODES}, {NUTS_CODES}, k as (select {one}) select x.* from k, (values {', '.join(rows)}) x(p, o_kind, lang, n)"
