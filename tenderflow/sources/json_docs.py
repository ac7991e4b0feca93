"""Nested tender documents (S10, S11): tender -> buyers[] / lots[] -> bids[] -> bidders[].

``tender_documents`` builds the documents from the driver tables: one
document per line item (the lot with its single bid and bidder), by
key joins and row-wise ``struct``/``array`` construction, so no group is
ever collected. ``write_json`` / ``read_tenders`` round-trip them through
JSON with an explicit schema (no inference pass over the corpus).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..vocab import PROCEDURE_TYPES
from .tables import Tables
from .testdata_kg import alpha2, cpv_code, currency_of, nuts3

# ---- fixed values: indicator type names of the tender, lot and score lists ----
TENDER_INDICATORS = [
    "ADMINISTRATIVE_CENTRALIZED_PROCUREMENT", "TRANSPARENCY_MISSING_OR_INCOMPLETE_DURATION_INFO",
    "TRANSPARENCY_MISSING_OR_INCOMPLETE_FUNDINGS_INFO", "ADMINISTRATIVE_ELECTRONIC_AUCTION",
    "INTEGRITY_PROCEDURE_TYPE", "ADMINISTRATIVE_FRAMEWORK_AGREEMENT", "ADMINISTRATIVE_NOTICE_AND_AWARD_DISCREPANCIES",
    "TRANSPARENCY_MISSING_ELIGIBLE_BID_LANGUAGES", "INTEGRITY_SINGLE_BID",
    "TRANSPARENCY_MISSING_OR_INCOMPLETE_AWARD_CRITERIA", "ADMINISTRATIVE_COVERED_BY_GPA",
    "TRANSPARENCY_VALUE_MISSING", "TRANSPARENCY_MISSING_SELECTION_METHOD", "INTEGRITY_TAX_HAVEN",
    "INTEGRITY_ADVERTISEMENT_PERIOD", "INTEGRITY_CALL_FOR_TENDER_PUBLICATION",
    "ADMINISTRATIVE_ENGLISH_AS_FOREIGN_LANGUAGE", "TRANSPARENCY_MISSING_OR_INCOMPLETE_CPVS",
    "TRANSPARENCY_MISSING_ADDRESS_OF_IMPLEMENTATION_NUTS", "INTEGRITY_DECISION_PERIOD",
    "TRANSPARENCY_BIDDER_NAME_MISSING", "TRANSPARENCY_MISSING_SUBCONTRACTED_INFO", "INTEGRITY_NEW_COMPANY",
]
LOT_INDICATORS = [
    "TRANSPARENCY_VALUE_MISSING", "TRANSPARENCY_MISSING_OR_INCOMPLETE_DURATION_INFO",
    "TRANSPARENCY_MISSING_SELECTION_METHOD", "TRANSPARENCY_MISSING_OR_INCOMPLETE_FUNDINGS_INFO",
    "INTEGRITY_TAX_HAVEN", "INTEGRITY_NEW_COMPANY", "TRANSPARENCY_MISSING_OR_INCOMPLETE_CPVS", "INTEGRITY_SINGLE_BID",
    "TRANSPARENCY_MISSING_OR_INCOMPLETE_AWARD_CRITERIA", "INTEGRITY_DECISION_PERIOD",
    "TRANSPARENCY_BIDDER_NAME_MISSING", "TRANSPARENCY_MISSING_SUBCONTRACTED_INFO",
]
SCORES = ["INTEGRITY", "TRANSPARENCY", "TENDER", "ADMINISTRATIVE"]

INDICATOR = T.StructType([T.StructField("type", T.StringType()), T.StructField("status", T.StringType()),
                          T.StructField("value", T.DoubleType())])
PRICE = T.StructType([T.StructField("netAmount", T.DoubleType()), T.StructField("currency", T.StringType())])
ADDRESS = T.StructType([T.StructField("country", T.StringType()), T.StructField("nuts", T.StringType())])
PARTY = [T.StructField("id", T.StringType()), T.StructField("name", T.StringType()),
         T.StructField("email", T.StringType())]
TENDER_SCHEMA = T.StructType([T.StructField("tender", T.StructType([
    T.StructField("id", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("procedureType", T.StringType()),
    T.StructField("size", T.StringType()),
    T.StructField("estimatedPrice", PRICE),
    T.StructField("cpvs", T.ArrayType(T.StructType([T.StructField("code", T.StringType()),
                                                    T.StructField("isMain", T.BooleanType())]))),
    T.StructField("indicators", T.ArrayType(INDICATOR)),
    T.StructField("buyers", T.ArrayType(T.StructType(PARTY + [T.StructField("address", ADDRESS)]))),
    T.StructField("lots", T.ArrayType(T.StructType([
        T.StructField("lotId", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("title", T.StringType()), T.StructField("bidsCount", T.IntegerType()),
        T.StructField("indicators", T.ArrayType(INDICATOR)),
        T.StructField("bids", T.ArrayType(T.StructType([
            T.StructField("bidId", T.StringType()), T.StructField("isWinning", T.BooleanType()),
            T.StructField("price", PRICE),
            T.StructField("bidders", T.ArrayType(T.StructType(
                PARTY + [T.StructField("isSme", T.BooleanType()), T.StructField("address", ADDRESS)])))])))]))),
    T.StructField("ot", T.StructType([T.StructField("country", T.StringType()), T.StructField("cpv", T.StringType()),
                                      T.StructField("date", T.StringType()),
                                      T.StructField("scores", T.ArrayType(INDICATOR))])),
    T.StructField("addressOfImplementation", T.StructType([T.StructField("nuts", T.StringType())])),
]))])


def _indicators(names: list[str], a: Column, b: Column) -> Column:
    """Indicator list: value ((a+i)%3)*50 when calculated, status INSUFFICIENT_DATA (no value) when (b+i)%4=0."""
    # three lists of plain values, zipped: built in a lambda, each element is interpreted. The names alone pass through one,
    # which keeps this step apart from the joins below it: with them it is one method, too large for the JVM to compile
    calc = [(b + i) % 4 != 0 for i in range(len(names))]
    return F.arrays_zip(F.transform(F.array(*[F.lit(n) for n in names]), lambda n: n).alias("type"),
                        F.array(*[F.when(c, "CALCULATED").otherwise("INSUFFICIENT_DATA") for c in calc]).alias("status"),
                        F.array(*[F.when(c, (((a + i) % 3) * 50).cast("double")) for i, c in enumerate(calc)]).alias("value"))


def tender_documents(spark: SparkSession, sf_dir: str, fields: list[str] | None = None) -> DataFrame:
    """Nested tender documents, a row each, with the ``fields`` asked for ("id", "lots", "lots.bids" ...; all by default).

    Fields are left out before the document is built, as a reader of written documents leaves columns out: once a document
    with several costly fields is a column, Catalyst keeps it whole.
    """
    def wanted(name: str) -> bool:
        return fields is None or any(f == name or name.startswith(f + ".") or f.startswith(name + ".") for f in fields)

    t = Tables(spark, sf_dir)
    l = t.lineitem.alias("l")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    j = l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")) \
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    key = F.concat_ws("-", *[F.col(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey",
                                                                 "l_suppkey")])
    ptype = None
    for k, v in PROCEDURE_TYPES.items():
        ptype = F.when(F.col("o_orderpriority") == k, v) if ptype is None else ptype.when(F.col("o_orderpriority") == k, v)
    cpv = cpv_code(F.col("l_partkey"))
    price = F.struct(F.col("l_extendedprice").alias("netAmount"), currency_of("l_suppkey").alias("currency"))
    bidder = F.struct(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"),
                      F.concat(F.lit("supplier"), F.col("s_suppkey").cast("string"), F.lit("@supplier.example"))
                      .alias("email"), (F.col("s_acctbal") < 5000).alias("isSme"),
                      F.struct(alpha2(F.col("s_nationkey")).alias("country"),
                               nuts3(F.col("s_suppkey"), F.col("s_nationkey")).alias("nuts")).alias("address"))
    bid = F.struct(key.alias("bidId"), F.lit(True).alias("isWinning"), price.alias("price"),
                   F.array(bidder).alias("bidders"))
    lot = {"lotId": F.col("l_linenumber").cast("string"), "status": F.col("l_linestatus"),
           "title": F.concat(F.lit("Lot "), F.col("l_linenumber").cast("string")), "bidsCount": F.col("l_quantity").cast("int") % 5,
           "indicators": _indicators(LOT_INDICATORS, F.col("l_linenumber"), F.col("l_suppkey")), "bids": F.array(bid)}
    lot = F.struct(*[c.alias(n) for n, c in lot.items() if n == "lotId" or wanted(f"lots.{n}")])
    buyer = F.struct(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"),
                     F.concat(F.lit("customer"), F.col("c_custkey").cast("string"), F.lit("@customer.example"))
                     .alias("email"),
                     F.struct(alpha2(F.col("c_nationkey")).alias("country"),
                              nuts3(F.col("c_custkey"), F.col("c_nationkey")).alias("nuts")).alias("address"))
    scores = F.array(*[F.struct(F.lit(n).alias("type"), F.lit("CALCULATED").alias("status"),
                                (((F.col("l_orderkey") + i) % 5) * 25).cast("double").alias("value"))
                       for i, n in enumerate(SCORES)])
    tender = {
        "id": key, "title": F.concat(F.lit("Contract "), F.col("l_orderkey").cast("string")),
        "country": alpha2(F.col("c_nationkey")), "procedureType": ptype, "size": F.when(F.col("s_acctbal") < 5000, "SME"),
        "estimatedPrice": F.struct(F.col("o_totalprice").alias("netAmount"), currency_of("o_custkey").alias("currency")),
        "cpvs": F.array(F.struct(cpv.alias("code"), F.lit(True).alias("isMain")),
                        F.struct(F.concat(F.substring(cpv, 1, 2), F.lit("000000")).alias("code"), F.lit(False).alias("isMain"))),
        "indicators": _indicators(TENDER_INDICATORS, F.col("l_orderkey"), F.col("l_partkey")),
        "buyers": F.array(buyer), "lots": F.array(lot),
        "ot": F.struct(alpha2(F.col("c_nationkey")).alias("country"), cpv.alias("cpv"),
                       F.to_date("o_orderdate").cast("string").alias("date"), scores.alias("scores")),
        "addressOfImplementation": F.struct(nuts3(F.col("l_partkey"), F.col("l_suppkey") % 25).alias("nuts"))}
    return j.select(F.struct(*[c.alias(n) for n, c in tender.items() if wanted(n)]).alias("tender"))


def write_json(docs: DataFrame, path: str, max_records_per_file: int = 100_000) -> None:
    """K9/K14 -- JSON lines, bounded part size."""
    docs.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).json(path)


def read_tenders(spark: SparkSession, path: str, multi_line: bool = False, glob: str | None = None) -> DataFrame:
    """S10/S12 -- read tender documents with the declared schema (``multi_line`` for JSON arrays)."""
    r = spark.read.schema(TENDER_SCHEMA).option("multiLine", multi_line)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.json(path)
