"""Dimensions derived by Spark from the driver tables (S8, S14, code lists).

The reference reads these from spreadsheets and a bundled rate table; here
they are computed from the data so their size follows it. Every dimension is
bounded by its code space (CPV <= 1 440 leaf codes + 40 divisions, NUTS <=
26*26*60 codes, one rate per currency and month). Nothing relies on these
bounds: joins carry no broadcast hint, Spark decides by measured size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..vocab import CPV_NS, GRAPH_CPV, GRAPH_NUTS, NUTS_NS
from .tables import Tables
from .testdata_kg import alpha2, alpha3, cpv_code, nuts3

# ---- fixed values: base rates (units per EUR) of the derived rate table ------
BASE_RATES = {"PLN": 4.25, "RON": 4.75, "BGN": 1.95583}


def cpv_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 -- CPV code list (code, label, full_code): part codes plus their divisions."""
    part = Tables(spark, sf_dir).part
    codes = part.select(cpv_code(F.col("p_partkey")).alias("code"), F.initcap("p_name").alias("label"))
    divisions = codes.select(F.concat(F.substring("code", 1, 2), F.lit("000000")).alias("code")) \
        .withColumn("label", F.concat(F.lit("Division "), F.substring("code", 1, 2)))
    out = codes.unionByName(divisions).groupBy("code").agg(F.min("label").alias("label"))
    check = F.aggregate(F.transform(F.split("code", ""), lambda d: d.cast("int")), F.lit(0), lambda a, b: a + b) % 10
    return out.withColumn("full_code", F.concat("code", F.lit("-"), check.cast("string")))


def cpv_digit_parent(code) -> F.Column:
    """Immediate parent by zeroing the last significant digit (the taxonomy's parent pointer)."""
    c = F.col(code) if isinstance(code, str) else code
    sig = F.length(F.regexp_replace(c, "0+$", ""))
    return (F.when(sig < 2, F.lit(None).cast("string"))
            .when(sig > 5, F.concat(F.substring(c, 1, 5), F.lit("000")))
            .otherwise(F.rpad(F.substring(c, 1, sig - 1), 8, "0")))


def cpv_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10 -- taxonomy rows (code, label, parent IRI); the parent may be absent from the list."""
    codes = cpv_codes(spark, sf_dir)
    return codes.select("code", "label", F.when(cpv_digit_parent("code").isNotNull(),
                                                F.concat(F.lit(CPV_NS), cpv_digit_parent("code"))).alias("parent"))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country lookup (alpha2, alpha3, name) from the nation table."""
    n = Tables(spark, sf_dir).nation
    return n.select(alpha2(F.col("n_nationkey")).alias("alpha2"), alpha3(F.col("n_nationkey")).alias("alpha3"),
                    F.col("n_name").alias("name"))


def _address_nuts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    t = Tables(spark, sf_dir)
    orgs = t.customer.select(nuts3(F.col("c_custkey"), F.col("c_nationkey")).alias("code")).unionByName(
        t.supplier.select(nuts3(F.col("s_suppkey"), F.col("s_nationkey")).alias("code")))
    lots = t.lineitem.select(nuts3(F.col("l_partkey"), F.col("l_suppkey") % 25).alias("code"))
    return orgs, lots


def nuts_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 -- NUTS list (code, label, original_label, level).

    Organisation addresses contribute every level; places of performance only
    their level 3 code and country, so some of their intermediate codes are
    absent -- which the existence checks (N5) then see.
    """
    orgs, lots = _address_nuts(spark, sf_dir)
    lv = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.substring("code", 1, i + 2).alias("c"))
                             for i in range(4)]))
    org_levels = orgs.select(lv.alias("x")).select("x.*")
    lot_levels = lots.select(F.explode(F.array(F.struct(F.lit(0).alias("level"), F.substring("code", 1, 2).alias("c")),
                                               F.struct(F.lit(3).alias("level"), F.col("code").alias("c")))).alias("x")) \
        .select("x.*")
    codes = org_levels.unionByName(lot_levels).distinct().withColumnRenamed("c", "code")
    ctry = countries(spark, sf_dir)
    out = codes.join(ctry, codes.code == ctry.alpha2, "left")
    label = F.when(F.col("level") == 0, F.col("name")).otherwise(F.concat(F.lit("Region "), F.col("code")))
    return out.select("code", label.alias("label"), F.lower(label).alias("original_label"), "level")


def nuts_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N6 input -- (code, label 'CODE Name', parent IRI); one label per code and language."""
    nl = nuts_codes(spark, sf_dir)
    parent = F.when(F.col("level") > 0, F.concat(F.lit(NUTS_NS), F.expr("substring(code, 1, length(code) - 1)")))
    en = nl.select("code", F.concat("code", F.lit(" "), "label").alias("label"), parent.alias("parent"))
    orig = nl.where(F.col("level") > 0).select("code", F.concat("code", F.lit(" "), "original_label").alias("label"),
                                                parent.alias("parent"))
    return en.unionByName(orig)


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S14 -- (currency, day, rate units per EUR): one rate per currency on the first day of each month
    spanned by the orders; no rate on other days, none for XYZ. EUR is implicit (1.0)."""
    o = Tables(spark, sf_dir).orders
    span = o.agg(F.trunc(F.min("o_orderdate"), "month").alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    months = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("day"))
    cur = F.explode(F.array(*[F.struct(F.lit(k).alias("currency"), F.lit(v).alias("base"))
                              for k, v in BASE_RATES.items()]))
    factor = F.lit(1.0) + ((F.year("day") * 12 + F.month("day")) % 7) / F.lit(100.0)
    return months.select("day", cur.alias("c")).select(
        "c.currency", "day", F.round(F.col("c.base") * factor, 5).alias("rate"))


def taxonomy_branches(spark: SparkSession, sf_dir: str) -> dict:
    """S3 -- the two taxonomies as triples in named graphs (identifier, prefLabel@en, broader)."""
    from ..vocab import V
    from .triples import About, branch

    def cpv(p):
        df = cpv_taxonomy(spark, sf_dir)
        iri = F.concat(F.lit(CPV_NS), F.col("code"))
        if p == "identifier":
            return branch(df, iri, F.col("code"), "literal", g=GRAPH_CPV)
        if p == "prefLabel":
            return branch(df, iri, F.col("label"), "literal", "en", g=GRAPH_CPV)
        return branch(df, iri, F.col("parent"), g=GRAPH_CPV)

    def nuts(p):
        df = nuts_taxonomy(spark, sf_dir)
        iri = F.concat(F.lit(NUTS_NS), F.col("code"))
        if p == "identifier":
            return branch(df.select("code").distinct(), iri, F.col("code"), "literal", g=GRAPH_NUTS)
        if p == "prefLabel":
            return branch(df, iri, F.col("label"), "literal", "en", g=GRAPH_NUTS)
        return branch(df.select("code", "parent").distinct(), iri, F.col("parent"), g=GRAPH_NUTS)

    return {V[p]: [lambda p=p: About("CPV", lambda: cpv(p)), lambda p=p: About("NUTS", lambda: nuts(p))] for p in ("identifier", "prefLabel", "broader")}
