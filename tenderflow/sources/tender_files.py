"""Tender documents with several buyers, lots, bids and bidders, kept as JSON array files.

``order_tenders`` makes one document per order: a lot per return flag, a bid per line, up to two bidders a bid and up to
two buyers; some bids have no bidder. Lines meet only those of their own order, since they are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .json_docs import TENDER_SCHEMA
from .tables import Tables
from .testdata_kg import alpha2, currency_of


def order_tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    supplier = t.supplier.select("s_suppkey", F.struct(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("id"), F.col("s_name").alias("name"),
        (F.col("s_acctbal") < 5000).alias("isSme"), F.struct(alpha2(F.col("s_nationkey")).alias("country")).alias("address")).alias("bidder"))
    customer = t.customer.select("c_custkey", F.struct(F.concat(F.lit("C"), F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"),
                                                        F.struct(alpha2(F.col("c_nationkey")).alias("country")).alias("address")).alias("buyer"))
    partner = supplier.select(F.col("s_suppkey").alias("p_suppkey"), F.col("bidder").alias("partner"))
    second = customer.select(F.col("c_custkey").alias("d_custkey"), F.col("buyer").alias("second"))
    known = lambda *cols: F.filter(F.array(*cols), lambda x: x.isNotNull())
    lines = t.lineitem.withColumn("s_suppkey", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_suppkey"))) \
        .withColumn("p_suppkey", F.when((F.col("l_linenumber") % 3 != 0) & (F.col("l_linenumber") % 2 == 0), F.col("l_suppkey") % 5 + 1)) \
        .join(supplier, "s_suppkey", "left").join(partner, "p_suppkey", "left")
    bid = F.struct(F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("bidId"),
                   (F.col("l_linestatus") == "F").alias("isWinning"),
                   F.struct(F.col("l_extendedprice").alias("netAmount"), currency_of("l_suppkey").alias("currency")).alias("price"),
                   known("bidder", "partner").alias("bidders"))
    # one shuffle by order serves both groupings and the join with the orders
    lots = lines.repartition("l_orderkey").groupBy("l_orderkey", "l_returnflag").agg(F.sort_array(F.collect_list(bid)).alias("bids")) \
        .groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
            F.col("l_returnflag").alias("lotId"), F.size("bids").alias("bidsCount"), F.col("bids")))).alias("lots"))
    orders = t.orders.select("o_orderkey", "o_orderpriority", F.col("o_custkey").alias("c_custkey"),
                             F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey") % 7 + 1).alias("d_custkey")) \
        .join(customer, "c_custkey", "left").join(second, "d_custkey", "left")
    return orders.join(lots, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.struct(
        F.concat(F.lit("T"), F.col("o_orderkey")).alias("id"),
        F.concat(F.lit("Tender "), F.initcap("o_orderpriority")).alias("title"),
        known("buyer", "second").alias("buyers"), F.col("lots")).alias("tender"))


def write_json_arrays(docs: DataFrame, path: str, key: str | None = None, files: int | None = None, docs_a_file: int | None = None) -> None:
    """S10 -- gzip files that each hold one JSON array of bounded length, since a reader's task holds an array whole.

    With ``docs_a_file`` every task puts the documents it has into arrays of that many at most: nothing is shuffled. With
    ``key`` and ``files`` documents are dealt to so many files one by one and collected there: collected before the shuffle
    too, a task would hold a list for every file, and sort and spill them.
    """
    text = docs.select(*([F.pmod(F.xxhash64(key), F.lit(files)).alias("part")] if files else []), F.to_json(F.struct(*docs.columns)).alias("doc"))
    if files:
        value = F.concat(F.lit("[\n"), F.array_join(F.collect_list("doc"), ",\n"), F.lit("\n]"))
        arrays = text.repartition("part").groupBy("part").agg(value.alias("value")).select("value")
    else:
        def chunks(batches):  # local, so that workers need no package of ours
            import pyarrow as pa

            def array(held):
                return pa.RecordBatch.from_pydict({"value": ["[\n" + ",\n".join(held) + "\n]"]}, pa.schema([("value", pa.string())]))
            held = []
            for batch in batches:
                for doc in batch.column(0).to_pylist():
                    held.append(doc)
                    if len(held) >= docs_a_file:
                        yield array(held)
                        held = []
            if held:
                yield array(held)
        arrays = text.mapInArrow(chunks, "value string")
    arrays.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def narrow(schema: T.DataType, paths: list[list[str]]) -> T.DataType:
    """The part of a nested schema that the paths (field names, through arrays) reach: nested column pruning for JSON."""
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(narrow(schema.elementType, paths))
    if not isinstance(schema, T.StructType) or any(not p for p in paths):
        return schema
    missing = {p[0] for p in paths} - set(schema.names)
    if missing:
        raise ValueError(f"no such fields: {sorted(missing)}")
    return T.StructType([T.StructField(f.name, narrow(f.dataType, [p[1:] for p in paths if p[0] == f.name]))
                         for f in schema.fields if any(p[0] == f.name for p in paths)])


def read_json_arrays(spark: SparkSession, path: str, fields: list[str], schema: T.StructType = TENDER_SCHEMA) -> DataFrame:
    """S10/E1 -- documents of array files with only the dotted ``fields``: the others are not parsed."""
    return spark.read.schema(narrow(schema, [f.split(".") for f in fields])).json(path, multiLine=True)
