"""Operator 7: repeated line runs by a suffix array over line IDs (native).

Every document is a sequence of its non-blank lines. Lines that occur once in the corpus cannot be
part of a repeated run and drop out at the start; the others get integer IDs, their group's place
in line order. Distributed prefix doubling then sorts all suffixes by their first 1, 2, 8, 32, ...
lines (one doubling, then two in each round): a suffix's rank at length 2h is the place of its pair
(rank at h, rank of the suffix h lines on) among all sorted pairs, and of its 4-tuple at length 4h,
found by one group-by on position and one ranged running total. Suffixes with equal rank are a
longest-common-prefix interval of at least that length. A suffix alone in its interval has no other
copy of that length and leaves the table, so the rounds shrink and end by themselves after
log4(longest repeated run) of them; there is no round limit.

In every interval all members but the first (smallest doc_id, then line) start a later copy of that
many lines. The maximal repeated runs are the unions of those stretches: every stretch of h lines
inside a run of L >= h lines with an earlier copy has an earlier copy itself, so the stretches that
start at the run's first L - h + 1 lines cover it and nothing else. The union is deleted. A run counts if
it has two lines or more, or if its only line has at least ``min_line_words`` words.

Everything is built-in column functions. Group sizes and first members are aggregates with
partial sums, ranks come from ranged running totals, so a line with a third of all rows meets in no
task; windows run within one document only. Only positions (ids, line numbers, ranks) are
shuffled until the end, when the deleted stretches are joined to the texts once.

Defined results: null text stays null (0 lines). Blank lines (white space alone) are never part of a
run; one is deleted if it stands between two deleted lines. A null doc_id orders after all
others. Rows equal in doc_id and text are one document and get the same result each. Rows come
back once each, all other columns untouched. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranges import running_total

MIN_LINE_WORDS = 2
WORD = r"[^\x20\x09-\x0D]+"
DOC = ["d", "th"]


def _doc_key(doc_id: str, text: str) -> list[Column]:
    """The document: its id (null last) and a hash of its text."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit((1 << 63) - 1)).alias("d"), F.xxhash64(text).alias("th")]


def _non_blank(text: Column) -> Column:
    """array of (line_no, s): the non-blank lines of a text; line_no counts all lines from 0."""
    return F.filter(F.transform(F.split(text, "\n", -1), lambda s, i: F.struct(i.alias("line_no"), s.alias("s"))),
                    lambda x: x["s"].rlike(WORD))


def positions(docs: DataFrame, min_line_words: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, th, j, h1, h2, enough): non-blank lines, numbered from 0; enough: the line may be a run by itself."""
    one = docs.select(*_doc_key(doc_id, text), F.posexplode(_non_blank(F.col(text))).alias("j", "x"))
    s = F.col("x.s")
    # two independent 64-bit hashes: no collisions among trillions of lines
    return one.select(*DOC, "j", F.xxhash64(s).alias("h1"), F.xxhash64(s, F.lit(7)).alias("h2"),
                      (F.regexp_count(s, F.lit(WORD)) >= min_line_words).alias("enough"))


def _first() -> Column:
    return F.min(F.struct(*DOC, "j"))


def _later() -> Column:
    return ~((F.col("first.d") == F.col("d")) & (F.col("first.th") == F.col("th")) & (F.col("first.j") == F.col("j")))


def intervals(pos: DataFrame) -> list[tuple[int, DataFrame]]:
    """[(length, rows)]: for lengths 1, 2, 8, 32, ... the suffixes that share their first ``length`` lines with others.

    rows: d, th, j, rank (place of the suffix's interval in suffix order), first (the interval's first member).
    """
    lines = ["h1", "h2"]
    groups = pos.groupBy(*lines).agg(F.count("*").alias("n"), _first().alias("first"),
                                     F.max(F.struct(*DOC, "j")).alias("last")).where("first <> last").drop("last")
    ranked = running_total(groups, lines, F.col("n"), "rank").drop("n")
    level = pos.join(ranked, lines).select(*DOC, "j", "rank", "first", "enough").dropDuplicates([*DOC, "j"]).checkpoint()
    levels, length = [], 1
    while not level.isEmpty():
        levels.append((length, level))
        steps = 2 if length == 1 else 4  # after the first round two doublings in one
        # every suffix hands its rank to the suffixes 0, 1, ... (steps - 1) lengths before it
        sent = level.select(*DOC, "j", "rank", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("m")) \
            .select(*DOC, (F.col("j") - F.col("m") * length).alias("j"), "rank", "m")
        names = [f"rank{m}" for m in range(steps)]
        tuples = sent.groupBy(*DOC, "j").agg(*[F.max(F.when(F.col("m") == m, F.col("rank"))).alias(n)
                                               for m, n in enumerate(names)]).dropna(subset=names).checkpoint()
        groups = tuples.groupBy(*names).agg(F.count("*").alias("n"), _first().alias("first")).where("n > 1")
        ranked = running_total(groups, names, F.col("n"), "rank").drop("n")
        level = tuples.join(ranked, names).select(*DOC, "j", "rank", "first").checkpoint()
        length *= steps
    return levels


def later_runs(docs: DataFrame, min_line_words: int = MIN_LINE_WORDS, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """(d, th, a, z): maximal stretches of non-blank lines a..z-1 that occur earlier."""
    pos = positions(docs, min_line_words, doc_id, text).checkpoint()
    starts = pos.select(*DOC, "j", F.col("j").alias("reach")).where("false")
    for length, level in intervals(pos):
        counts = level.where("enough") if length == 1 else level
        starts = starts.unionByName(counts.where(_later()).select(*DOC, "j", (F.col("j") + length).alias("reach")))
    by_line = Window.partitionBy(*DOC).orderBy("j", "reach")
    before = F.max("reach").over(by_line.rowsBetween(Window.unboundedPreceding, -1))
    island = starts.withColumn("new", F.coalesce((F.col("j") > before).cast("int"), F.lit(1))) \
        .withColumn("run", F.sum("new").over(by_line.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*DOC, "run").agg(F.min("j").alias("a"), F.max("reach").alias("z")).drop("run")


def dedup(docs: DataFrame, min_line_words: int = MIN_LINE_WORDS, doc_id: str = "doc_id", text: str = "text",
          deleted: str | None = None) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from the text; ``deleted`` names an optional
    column for the number of deleted non-blank lines."""
    runs = later_runs(docs, min_line_words, doc_id, text)
    cut = runs.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("a", "z"))).alias("__runs"),
                                 F.sum(F.col("z") - F.col("a")).alias("__n")).withColumnsRenamed({"d": "__d", "th": "__th"})
    key = [c.alias(f"__key_{n}") for c, n in zip(_doc_key(doc_id, text), DOC)]
    j = docs.select("*", *key).join(cut, (F.col("__key_d") == F.col("__d")) & (F.col("__key_th") == F.col("__th")), "left")
    j = j.withColumn("__at", F.when(F.col("__runs").isNotNull(), F.transform(_non_blank(F.col(text)), lambda x: x["line_no"])))
    every = F.split(F.col(text), "\n", -1)
    # what stays lies between the last line of one run and the first line of the next
    begin = F.concat(F.array(F.lit(0)), F.transform("__runs", lambda r: F.element_at("__at", r["z"]) + 1))
    end = F.concat(F.transform("__runs", lambda r: F.element_at("__at", r["a"] + 1)), F.array(F.size(every)))
    stays = F.flatten(F.transform(F.arrays_zip(begin.alias("b"), end.alias("e")),
                                  lambda p: F.slice(every, p["b"] + 1, p["e"] - p["b"])))
    new = F.when(F.col("__runs").isNull(), F.col(text)).otherwise(F.array_join(stays, "\n"))
    cols = [new.alias(c) if c == text else F.col(c) for c in docs.columns]
    extra = [F.coalesce("__n", F.lit(0)).cast("long").alias(deleted)] if deleted else []
    return j.select(*cols, *extra)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup(docs, deleted="lines_deleted").select(
        "doc_id", "lines_deleted", F.length("text").cast("long").alias("chars_kept"), F.md5("text").alias("text_md5"))


# A line is deleted if it has two words and occurs earlier, or if it and a neighbour (non-blank) occur earlier
# together: every longer run is a union of those. Blank lines go between two deleted lines.
ORACLE_SQL = r"""
with alll as (
  select doc_id, unnest(string_split(text, chr(10))) as s,
         unnest(range(0, len(string_split(text, chr(10))))) as line_no from documents),
l as (select doc_id, line_no, s, row_number() over (partition by doc_id order by line_no) as j,
             len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) as words
      from alll where regexp_matches(s, '[^\x20\x09-\x0D]')),
w as (select *, lead(s) over (partition by doc_id order by j) as nxt from l),
e as (select *, row_number() over (partition by s order by doc_id, j) > 1 and words >= 2 as one,
             nxt is not null and row_number() over (partition by s, nxt order by doc_id, j) > 1 as two from w),
f as (select doc_id, line_no, j,
             one or two or coalesce(lag(two) over (partition by doc_id order by j), false) as gone from e),
g as (select a.doc_id, a.line_no, a.s, f.gone,
             last_value(f.gone ignore nulls) over (partition by a.doc_id order by a.line_no
                rows between unbounded preceding and current row) as before,
             first_value(f.gone ignore nulls) over (partition by a.doc_id order by a.line_no
                rows between current row and unbounded following) as after
      from alll a left join f on a.doc_id = f.doc_id and a.line_no = f.line_no),
k as (select *, coalesce(gone, coalesce(before, false) and coalesce(after, false)) as del from g),
r as (select doc_id, count(*) filter (where gone) as lines_deleted,
             coalesce(string_agg(s, chr(10) order by line_no) filter (where not del), '') as kept from k group by doc_id)
select d.doc_id, coalesce(r.lines_deleted, 0) as lines_deleted, length(r.kept) as chars_kept, md5(r.kept) as text_md5
from documents d left join r on d.doc_id = r.doc_id
"""
