"""Operator 8: mixing sources to target weights by Sainte-Laguë apportionment (native).

1. Sizes: words per document (built-in regexp functions); sources summed with map-side combine.
2. Targets: the total is shared by weight; a source stops at ``epochs`` times its size and the
   excess is reshared by weight until no source is above (two scalars per round reach the driver).
3. Seats: every source's words are one cyclic stream, cut into equal blocks of ``block`` words. Seat k of a source has
   the quotient target / (2k + 1); the seats with the highest quotients (at least block / 2, which
   makes round(target / block) of them) win. Sorted by quotient they are dealt into shards of
   ``shard_blocks`` seats; counting them gives integer quotas per shard and source. Divisor methods
   are house-monotone, so the quotas of the first shards are themselves an apportionment. Seats are counted, not
   made: the quotients are cut into cells of about ``shard_blocks / CELLS`` seats, a source's seats in a cell are a
   range of k by arithmetic, and only in cells that a shard ends in are seats made and sorted. Ranges come from rows of
   at most ``SEATS_ROW`` seats spread over tasks, so no row or task holds all seats of a source.
4. Seeded selection: a source's documents stand in seeded hash order. Seat k takes the k-th block of
   the cyclic stream from a seeded start on: whole epochs first, then a run of blocks through a
   stream that is already shuffled. What a document gives is the overlap of its words with the blocks
   taken, by arithmetic; a source gives its seats' words exactly, never above ``epochs`` times its size.

The seeded order is a ranged running total over (source, hash): a source with a third of all rows
is spread over many tasks, and no window runs over a whole source.

Defined results: null or wordless text has size 0 and gives nothing; null source is a source of its
own, last in order; null doc_id and repeated rows are kept, each row by itself (rows that tie in
source, hash, doc_id and size are interchangeable, so any order of them gives the same result). An
empty table gives an empty result. Other input columns are carried by ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranges import running_total

#: words of a block, seats of a shard, most times a document is repeated, seed of the selection
BLOCK = 64
SHARD_BLOCKS = 16384
#: most seats that one row is exploded into, most tasks that explode them
SEATS_ROW = 100_000
SEAT_TASKS = 10_000
#: cells that the quotients of a shard's seats are cut into
CELLS = 64
EPOCHS = 3
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weight(rank: Column) -> Column:
    """Weights 1, 2, 3, 1, 2, 3 ... by 0-based source rank."""
    return (rank % 3 + 1).cast("double")


def sources(sizes: DataFrame, weight=cyclic_weight) -> DataFrame:
    """(source, source_size, weight): sources ranked by code point, null last."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_null", F.col("source").isNull())
    ranked = running_total(s, ["_null", "source"], out="rank")
    return ranked.select("source", "source_size", weight(F.col("rank")).alias("weight"))


def targets(src: DataFrame, epochs: int = EPOCHS, share: float = 1.0) -> DataFrame:
    """``src`` plus ``target``: ``share`` of all words by weight, none above ``epochs`` times its source."""
    cap = F.col("source_size") * F.lit(float(epochs))
    total = (src.agg(F.sum("source_size")).first()[0] or 0) * share
    rate, capped = 0.0, -1
    while True:  # ends: the set of capped sources only grows, and stops when nothing joins it
        over = cap <= F.col("weight") * F.lit(rate)
        row = src.agg(F.count(F.when(over, 1)).alias("n"), F.sum(F.when(over, cap)).alias("held"),
                      F.sum(F.when(~over, F.col("weight"))).alias("w")).first() if rate else None
        if row is None:
            row_w = src.agg(F.sum("weight")).first()[0]
            rate = total / row_w if row_w else 0.0
            if not rate:
                break
            continue
        if row.n == capped or not row.w:
            break
        capped = row.n
        rate = (total - (row.held or 0.0)) / row.w
    return src.withColumn("target", F.least(cap, F.col("weight") * F.lit(rate)))


def seat_rows(src: DataFrame, block: int = BLOCK, per_row: int = SEATS_ROW) -> DataFrame:
    """(source, target, first, last): the seats of every source in rows of at most ``per_row``, spread over tasks."""
    n = F.floor(F.col("target") / block + 0.5).cast("long")
    each = src.where(n > 0).select("source", "target", n.alias("n"), F.floor((n - 1) / per_row).cast("long").alias("c"))
    rows = each.agg(F.sum(F.col("c") + 1)).first()[0] or 1
    return each.select("source", "target", "n", F.explode(F.sequence(F.lit(0).cast("long"), "c")).alias("chunk")) \
        .repartition(max(1, min(rows, SEAT_TASKS)), "source", "chunk") \
        .select("source", "target", (F.col("chunk") * per_row).alias("first"),
                (F.least(F.col("n"), (F.col("chunk") + 1) * per_row) - 1).alias("last"))


def seats(src: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(source, k, quotient, shard): the winning seats in order of quotient, dealt into shards."""
    each = seat_rows(src, block).select("source", "target", F.explode(F.sequence("first", "last")).alias("k"))
    seat = each.select("source", "k", (F.col("target") / (F.col("k") * 2 + 1)).alias("quotient"),
                       (-F.col("target") / (F.col("k") * 2 + 1)).alias("_down"), F.col("source").isNull().alias("_null"))
    at = running_total(seat, ["_down", "_null", "source", "k"], out="_at")
    return at.select("source", "k", "quotient", F.floor(F.col("_at") / shard_blocks).cast("int").alias("shard"))


def _cell(k: Column, scale: float) -> Column:
    """Cell of seat ``k``: never falls as the quotient falls, to the last bit of both."""
    return F.floor(F.lit(scale) / (F.col("target") / (k * 2 + 1))).cast("long")


def _first_seat(cell: Column, scale: float) -> Column:
    """The first seat of a source in ``cell`` or a later one: solved for k, then moved by the rounding, one at most."""
    k = F.greatest(F.ceil((cell * (F.col("target") / scale) - 1) / 2).cast("long"), F.lit(1).cast("long"))
    return F.when(_cell(k - 1, scale) >= cell, k - 1).when(_cell(k, scale) >= cell, k).otherwise(k + 1)


def seat_ranges(src: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, per_row: int = SEATS_ROW) -> DataFrame:
    """(source, target, cell, first, last): every winning seat once, in ranges that lie in one cell of the quotients.

    A source has a row for each cell that it has seats in, so never more rows than seats.
    """
    # seats up to a quotient q are about (sum of targets) / 2q
    scale = (src.agg(F.sum("target")).first()[0] or 0.0) / 2 / max(1, shard_blocks // CELLS)
    rows = seat_rows(src, block, per_row).withColumns({"lo": _cell(F.col("first"), scale), "hi": _cell(F.col("last"), scale)})
    sparse, at = F.col("hi") - F.col("lo") > F.col("last") - F.col("first"), F.col("at")
    rows = rows.withColumn("sparse", sparse).withColumn(
        "at", F.explode(F.when(sparse, F.sequence("first", "last")).otherwise(F.sequence("lo", "hi"))))
    return rows.select(
        "source", "target", F.when(F.col("sparse"), _cell(at, scale)).otherwise(at).alias("cell"),
        F.when(F.col("sparse"), at).otherwise(F.greatest("first", _first_seat(at, scale))).alias("first"),
        F.when(F.col("sparse"), at).otherwise(F.least("last", _first_seat(at + 1, scale) - 1)).alias("last")) \
        .where(F.col("first") <= F.col("last"))


def quotas(src: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(shard, source, blocks, first_seat): integer quotas; seats of a source are numbered on across shards.

    The shards are those of ``seats``, counted by ranges.
    """
    ranges = seat_ranges(src, block, shard_blocks)
    n = F.col("last") - F.col("first") + 1
    cells = running_total(ranges.groupBy("cell").agg(F.sum(n).alias("n")), ["cell"], F.col("n"), "_base")
    end = F.col("_base") + F.col("n") - 1
    cells = cells.select("cell", "_base", (F.floor(F.col("_base") / shard_blocks) < F.floor(end / shard_blocks)).alias("cut"))
    # a range of a cell that a shard ends in falls into its seats, one of another cell stays whole
    k = F.explode(F.when(F.col("cut"), F.sequence("first", "last")).otherwise(F.array("first")))
    dealt = ranges.join(cells.hint("merge"), "cell").select("cell", "_base", "cut", "source", "target", k.alias("k"),
                                              F.when(F.col("cut"), 1).otherwise(n).cast("long").alias("n"))
    order = Window.partitionBy("cell").orderBy(-F.col("target") / (F.col("k") * 2 + 1), F.col("source").isNull(), "source", "k")
    at = F.col("_base") + F.when(F.col("cut"), F.row_number().over(order) - 1).otherwise(0)
    return dealt.withColumn("shard", F.floor(at / shard_blocks).cast("int")).groupBy("shard", "source") \
        .agg(F.sum("n").alias("blocks"), F.min("k").alias("first_seat"))


def _start(seed: int) -> Column:
    """Seeded first block of a source's stream."""
    return F.pmod(F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("\x00null"))), F.col("n"))


def mix(docs: DataFrame, weight=cyclic_weight, epochs: int = EPOCHS, block: int = BLOCK, seed: int = SEED,
        shard_blocks: int = SHARD_BLOCKS, doc_id: str = "doc_id", text: str = "text",
        source: str = "source") -> tuple[DataFrame, DataFrame]:
    """The mix, per document, and its quotas per shard.

    First frame: doc_id, size, source_size, target, taken, plus source, ``epochs_whole`` (times the
    whole document is taken) and ``taken_words`` (array of (start, end) word ranges, 0-based and
    end-exclusive, that are taken once more). Second frame: see ``quotas``.
    """
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(F.col(text)).alias("size")) \
        .checkpoint()
    src = targets(sources(sized, weight), epochs).checkpoint()
    quota = quotas(src, block, shard_blocks).checkpoint()
    won = quota.groupBy("source").agg(F.sum("blocks").alias("seats"))

    rows = sized.withColumn("_null", F.col("source").isNull()) \
        .withColumn("_h", F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(-1))))
    stream = running_total(rows, ["_null", "source", "_h", "doc_id", "size"], F.col("size"), "_from")
    base = running_total(src.withColumn("_null", F.col("source").isNull()), ["_null", "source"], F.col("source_size"),
                         "_base")
    size = F.greatest("source_size", F.lit(1))
    s = base.alias("b").join(won.alias("w"), F.col("b.source").eqNullSafe(F.col("w.source")), "left") \
        .select("b.source", "source_size", "target", "_base", F.ceil(size / block).alias("n"),
                F.least(F.coalesce("w.seats", F.lit(0)) * block, F.col("source_size") * epochs).alias("won"))
    s = s.withColumn("whole", F.floor(F.col("won") / size)).withColumn("rest", F.col("won") % size) \
        .withColumn("c", _start(seed) * block).select(F.col("source").alias("_source"), "source_size", "target", "_base",
                                                      "whole", "rest", "c")
    d = stream.join(s, F.col("source").eqNullSafe(F.col("_source"))) \
        .withColumn("a", F.col("_from") - F.col("_base")).withColumn("z", F.col("a") + F.col("size"))
    first_end = F.least(F.col("c") + F.col("rest"), F.col("source_size"))
    wrapped = F.greatest(F.col("c") + F.col("rest") - F.col("source_size"), F.lit(0).cast("long"))

    def part(lo: Column, hi: Column) -> Column:
        return F.struct((F.greatest("a", lo) - F.col("a")).alias("start"), (F.least("z", hi) - F.col("a")).alias("end"))
    ranges = F.filter(F.array(part(F.lit(0).cast("long"), wrapped), part(F.col("c"), first_end)),
                      lambda r: r["end"] > r["start"])
    d = d.withColumn("taken_words", ranges)
    extra = F.aggregate("taken_words", F.lit(0).cast("long"), lambda acc, r: acc + r["end"] - r["start"])
    out = d.select("doc_id", "size", "source_size", "target",
                   (F.col("whole") * F.col("size") + extra).cast("long").alias("taken"), "source",
                   F.col("whole").cast("int").alias("epochs_whole"), "taken_words")
    return out, quota


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs)[0].select("doc_id", "size", "source_size", "target", "taken")
