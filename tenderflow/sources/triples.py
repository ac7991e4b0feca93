"""Triples: the graph data model, its sources (S1-S3, S15, S16) and sinks.

A ``Graph`` is accessed one predicate at a time (``graph.pred(p)``). Two
backings exist:

* a physical triples table ``(s, p, o, o_kind, lang, dtype, g)`` -- parquet
  partitioned by ``p`` (partition pruning gives one folder per pattern) or
  N-Triples / N-Quads text;
* a virtual graph whose predicates are projections of relational tables
  (``sources.testdata_kg``); each pattern then scans only the source columns
  of its predicate, which is vertical partitioning by predicate for free.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..vocab import RDF_TYPE, XSD

TRIPLE_SCHEMA = T.StructType([
    T.StructField("s", T.StringType(), False),
    T.StructField("p", T.StringType(), False),
    T.StructField("o", T.StringType(), True),
    T.StructField("o_kind", T.StringType(), True),  # iri | literal | bnode
    T.StructField("lang", T.StringType(), True),
    T.StructField("dtype", T.StringType(), True),
    T.StructField("g", T.StringType(), True),
])
OBJ_COLS = ["s", "o", "o_kind", "lang", "dtype", "g"]

@dataclass(frozen=True)
class Affixed:
    """A text made of one column (named, or computed) between fixed texts: two texts are equal just if its values are."""
    prefix: str
    inner: Column | str
    suffix: str = ""

    @property
    def column(self) -> Column:
        return F.col(self.inner) if isinstance(self.inner, str) else self.inner

    def holds(self, other: Affixed) -> bool:
        """Whether both are made of the same named column."""
        return isinstance(self.inner, str) and isinstance(other.inner, str) and self.inner == other.inner

    def text(self, inner: Column) -> Column:
        parts = [F.lit(self.prefix)] * bool(self.prefix) + [inner.cast("string")] + [F.lit(self.suffix)] * bool(self.suffix)
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    @property
    def col(self) -> Column:
        return self.text(self.column)


@dataclass(frozen=True)
class Term:
    """An IRI minted from a row: ``key`` names the kind of thing, so that equal keys mean equal rules.

    ``made``: how, if it is minted from one column. ``parts``: the columns that it is null without, if they are known: a test
    of them reaches the scan and need not mint the IRI.
    """
    key: str
    col: Column
    made: Affixed | None = None
    parts: tuple = ()

    @property
    def there(self) -> Column:
        return reduce(Column.__and__, [c.isNotNull() for c in self.parts]) if self.parts else self.col.isNotNull()


@dataclass(frozen=True)
class Rows:
    """Rows of a named source of a virtual graph, filtered."""
    source: str
    frame: Callable[[], DataFrame]
    conds: tuple = ()

    def where(self, cond: Column) -> Rows:
        return replace(self, conds=(*self.conds, cond))


@dataclass(frozen=True)
class Mapped:
    """One predicate (or class) as a projection of a source's rows; ``raw`` is the typed column behind a text object."""
    rows: Rows
    s: Term
    o: Term | Affixed | Column
    kind: str = "iri"
    lang: str | None = None
    dtype: str | None = None
    raw: Column | None = None

    @property
    def object(self) -> Column:
        return (self.o.col if isinstance(self.o, (Term, Affixed)) else self.o).cast("string")

    @property
    def object_there(self) -> Column:
        """Whether the object is there, told without minting it if that is possible."""
        return self.o.there if isinstance(self.o, Term) else (self.o.column if isinstance(self.o, Affixed) else self.object).isNotNull()

    @property
    def okey(self) -> str | None:
        return self.o.key if isinstance(self.o, Term) else None

    def frame(self) -> DataFrame:
        df = self.rows.frame()
        for c in self.rows.conds:
            df = df.where(c)
        return branch(df, self.s.col, self.object, self.kind, self.lang, self.dtype, there=self.s.there & self.object_there)


@dataclass(frozen=True)
class About:
    """Triples whose subjects are IRIs of one kind (``key``, as in ``Term``), but that are no projection of a source's rows."""
    key: str
    frame: Callable[[], DataFrame]


@dataclass
class Mapping:
    """What star patterns need to know of a virtual graph: its sources, and which source's rows each kind of IRI names.

    ``provides[x]`` are the sources whose columns x has (itself, and sources joined to it by a foreign key), ``grain[x]``
    the one whose rows its rows are. A key's home is the source whose rows it identifies. ``dealt[x]``, if known, is a column of x
    that every IRI holds whose home is a source of the same family (x, or one that shares its rows): equal IRIs, equal values.
    """
    sources: dict[str, Callable[[], DataFrame]]
    provides: dict[str, set[str]]
    grain: dict[str, str]
    home: dict[str, str] = field(default_factory=dict)
    dealt: dict[str, str] = field(default_factory=dict)


Branch = Callable[[], "DataFrame | Mapped | About"]


def _frame(b: DataFrame | Mapped | About) -> DataFrame:
    return b if isinstance(b, DataFrame) else b.frame()


def branch(df: DataFrame, s: Column, o: Column, kind: str = "iri", lang: Column | str | None = None,
           dtype: str | None = None, g: str | None = None, there: Column | None = None) -> DataFrame:
    """Project rows of a relational frame into (s, o, o_kind, lang, dtype, g) for one predicate.

    ``there``: the rows that have both subject and object; without it they are made to see.
    """
    lang_col = lang if isinstance(lang, Column) else F.lit(lang).cast("string")
    return df.where(s.isNotNull() & o.isNotNull() if there is None else there).select(
        s.cast("string").alias("s"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"),
        lang_col.alias("lang"), F.lit(dtype).cast("string").alias("dtype"), F.lit(g).cast("string").alias("g"))


class Graph:
    """A set of triples addressed by predicate (and by class for rdf:type)."""

    def __init__(self, spark: SparkSession, triples: DataFrame | None = None,
                 branches: dict[object, list[Branch]] | None = None, class_patterns: dict[str, str] | None = None,
                 mapping: Mapping | None = None):
        if (triples is None) == (branches is None):
            raise ValueError("give exactly one of triples or branches")
        self.spark = spark
        self._triples = triples
        self._branches = branches
        # class IRI -> regex that exactly the IRIs minted for that class match (virtual graphs only):
        # a class test on such a variable is then a row filter instead of a semi-join
        self.class_patterns = class_patterns or {}
        self.mapping = mapping

    # -- access ---------------------------------------------------------
    def pred(self, p: str, o: str | None = None) -> DataFrame:
        """Rows (s, o, o_kind, lang, dtype, g) of predicate ``p`` (optionally with a fixed object)."""
        if self._triples is not None:
            cond = F.col("p") == F.lit(p)
            if o is not None:
                cond = cond & (F.col("o") == F.lit(o))
            return self._triples.where(cond).select(*OBJ_COLS)
        key = (p, o) if o is not None and (p, o) in self._branches else p
        builders = self._branches.get(key)
        if builders is None and o is not None:
            # rdf:type branches are keyed by class; union those of the class
            builders = self._branches.get((p, o), [])
        frames = [_frame(b()) for b in (builders or [])]
        if not frames:
            return self.spark.createDataFrame([], T.StructType([f for f in TRIPLE_SCHEMA if f.name != "p"]))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        if o is not None and key == p:
            out = out.where(F.col("o") == F.lit(o))
        return out

    def mapped(self, p: str, o: str | None = None) -> list | None:
        """The projections of predicate ``p`` (of class ``o``) in a virtual graph; None if one of them is no projection."""
        out = [b() for b in self._branches.get((p, o) if o is not None else p, [])]
        return out if all(isinstance(b, Mapped) for b in out) else None

    def triples(self, of: str | None = None) -> DataFrame:
        """All triples as one frame (G24); the virtual graph unions every branch.

        ``of``: those whose subject is of that class. The branches of a virtual graph whose subjects another rule mints than
        the class's are not read then; where no rule is known, its pattern or its members tell.
        """
        if of is None:
            if self._triples is not None:
                return self._triples
            parts = [rows().select("s", F.lit(p).alias("p"), "o", "o_kind", "lang", "dtype", "g") for p, rows in self.by_predicate.items()]
            return reduce(DataFrame.unionByName, parts)
        rules = None if self._triples is not None else self.mapped(RDF_TYPE, of)
        if not rules or of not in self.class_patterns:
            return self.triples().join(self.pred(RDF_TYPE, of).select("s").distinct(), "s", "left_semi").select(*TRIPLE_SCHEMA.names)
        keys, parts = {b.s.key for b in rules}, []
        for key, builders in self._branches.items():
            for b in [b() for b in builders]:
                kind = b.s.key if isinstance(b, Mapped) else getattr(b, "key", None)
                if kind is None or kind in keys:
                    rows = _frame(b).where(F.col("s").rlike(self.class_patterns[of])) if kind is None else _frame(b)
                    parts.append(rows.select("s", F.lit(key[0] if isinstance(key, tuple) else key).alias("p"), "o", "o_kind", "lang", "dtype", "g"))
        return reduce(DataFrame.unionByName, parts)

    @property
    def by_predicate(self) -> dict[str, Callable[[], DataFrame]] | None:
        """Predicate -> all its triples (of every class for rdf:type) in a virtual graph; None on a triples table."""
        if self._triples is not None:
            return None
        found: dict[str, list[Branch]] = {}
        for key, builders in self._branches.items():
            found.setdefault(key[0] if isinstance(key, tuple) else key, []).extend(builders)
        return {p: lambda bs=bs: reduce(DataFrame.unionByName, [_frame(b()).select(*OBJ_COLS) for b in bs]) for p, bs in found.items() if bs}


# ---- S1/S15: N-Triples / N-Quads text -------------------------------------
_IRI = r"<([^>]*)>"
_BNODE = r"(_:[A-Za-z0-9_\-.]+)"
_LIT = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"(?:@([A-Za-z]+(?:-[A-Za-z0-9]+)*)|\^\^<([^>]*)>)?'
NT_LINE = (r"^\s*(?:" + _IRI + "|" + _BNODE + r")\s+" + _IRI + r"\s+(?:" + _IRI + "|" + _BNODE + "|" + _LIT +
           r")\s*(?:" + _IRI + r")?\s*\.\s*$")


#: one token of a literal's text: a run of \\uXXXX (surrogate pairs stay together), one other escape, or plain text
_TOKEN = r"(?s)(?:\\u[0-9A-Fa-f]{4})+|\\U[0-9A-Fa-f]{8}|\\.|[^\\]+"


def _unescape(c: Column) -> Column:
    """Escapes decoded from left to right, each once."""
    def plain(t: Column) -> Column:
        kind = F.substring(t, 2, 1)
        return (F.when(~t.startswith("\\"), t)
                .when(kind == "u", F.decode(F.unhex(F.replace(t, F.lit("\\u"), F.lit(""))), "UTF-16BE"))
                .when(kind == "U", F.decode(F.unhex(F.substring(t, 3, 8)), "UTF-32"))
                .when(kind == "n", "\n").when(kind == "r", "\r").when(kind == "t", "\t")
                .when(kind == "b", "\b").when(kind == "f", "\f").otherwise(kind))
    tokens = F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(F.transform(tokens, plain), "")).otherwise(c)


#: a separator that no term of a line holds outside its literal, which is put last
_SEP = "\u0001"
_PARTS = _SEP + _SEP.join(f"${k}" for k in (1, 2, 3, 4, 5, 7, 8, 9, 6))


def _blank(t: Column) -> Column:
    """Blank and comment lines; one that opens an IRI is neither, whatever follows."""
    return ~t.startswith("<") & F.trim(t).rlike(r"^(#.*)?$")


def parse_lines(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """N-Triples/N-Quads lines with what they say: (line, ok, s, p, o, o_kind, lang, dtype, g). Blank and comment lines are skipped.

    One match a line: its groups are written out with a separator and split again. The match stands in a generator, where it
    is made once: a filter on its outcome would be pushed below a projection and match the line once more for every mention.
    """
    t = F.col(text_col)
    parts = F.when(~t.startswith(_SEP), F.split(F.regexp_replace(t, NT_LINE, _PARTS), _SEP, 10))
    body = lines.where(~_blank(t)).select(t.alias("line"), F.explode(F.array(parts)).alias("part"))
    g = lambda i: F.nullif(F.get("part", F.lit(i)), F.lit(""))
    o_iri, o_bnode = g(4), g(5)
    is_lit = o_iri.isNull() & o_bnode.isNull()
    return body.select(
        "line", F.coalesce((F.size("part") == 10) & (F.get("part", F.lit(0)) == ""), F.lit(False)).alias("ok"),
        F.coalesce(g(1), g(2)).alias("s"), g(3).alias("p"),
        F.when(o_iri.isNotNull(), o_iri).when(o_bnode.isNotNull(), o_bnode)
        .otherwise(_unescape(F.get("part", F.lit(9)))).alias("o"),
        F.when(o_iri.isNotNull(), "iri").when(o_bnode.isNotNull(), "bnode").otherwise("literal").alias("o_kind"),
        F.when(is_lit, F.lower(g(6))).alias("lang"),
        F.when(is_lit, g(7)).alias("dtype"),
        g(8).alias("g"),
    )


def parse_ntriples(lines: DataFrame, text_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Parse N-Triples/N-Quads lines -> (triples, rejected). Blank and comment lines are skipped.

    What is rejected needs only the test of a line, not its parts.
    """
    t = F.col(text_col)
    triples = parse_lines(lines, text_col).where("ok").drop("line", "ok")
    rejected = lines.where(~_blank(t) & ~t.rlike(NT_LINE)).select(t.alias("line"))
    return triples, rejected


def read_triples(spark: SparkSession, path: str, fmt: str = "parquet", dedup: bool = True) -> tuple[Graph, DataFrame]:
    """S1/S15/S16 -- read a triples dataset; returns (graph, rejected lines).

    ``fmt='nt'`` reads N-Triples/N-Quads text (one triple per line, splittable);
    unparsable lines are returned separately instead of failing the job. The
    graph is a set: identical triples are removed once here (U2).
    """
    if fmt == "parquet":
        triples = spark.read.schema(TRIPLE_SCHEMA).parquet(path)
        rejected = spark.createDataFrame([], "line string")
    else:
        triples, rejected = parse_ntriples(spark.read.text(path))
    if dedup:
        triples = triples.dropDuplicates(["s", "p", "o", "o_kind", "lang", "dtype", "g"])
    return Graph(spark, triples=triples), rejected


def _nt_term(kind: Column, o: Column, lang: Column, dtype: Column) -> Column:
    esc = o
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        esc = F.replace(esc, F.lit(raw), F.lit(escaped))
    lit = F.concat(F.lit('"'), esc, F.lit('"'),
                   F.when(lang.isNotNull(), F.concat(F.lit("@"), lang))
                   .when(dtype.isNotNull(), F.concat(F.lit("^^<"), dtype, F.lit(">"))).otherwise(F.lit("")))
    return F.when(kind == "iri", F.concat(F.lit("<"), o, F.lit(">"))).when(kind == "bnode", o).otherwise(lit)


def to_ntriples(triples: DataFrame) -> DataFrame:
    """Serialise triples as N-Quads lines (column ``value``)."""
    subj = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(F.concat(F.lit("<"), F.col("s"), F.lit(">")))
    graph = F.when(F.col("g").isNotNull(), F.concat(F.lit(" <"), F.col("g"), F.lit(">"))).otherwise(F.lit(""))
    return triples.select(F.concat_ws(" ", subj, F.concat(F.lit("<"), F.col("p"), F.lit(">")),
                                      _nt_term(F.col("o_kind"), F.col("o"), F.col("lang"), F.col("dtype")))
                          .alias("t"), graph.alias("gr")) \
        .select(F.concat(F.col("t"), F.col("gr"), F.lit(" .")).alias("value"))


#: lines of one text file: gzip is read whole by one task
LINES_A_FILE = 2_000_000


def write_lines(lines: DataFrame, path: str) -> None:
    """K1 -- lines (column ``value``) as gzip text in files of bounded length: IRIs repeat so much that plain text is many times as
    large. Already at its fastest level gzip makes a tenth of them, in a fourth of its usual time."""
    lines.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED") \
        .option("maxRecordsPerFile", LINES_A_FILE).text(path)


#: how triples are kept: the second version of Parquet's pages writes of an IRI what differs from the one before
STORE_OPTIONS = {"compression": "zstd", "parquet.writer.version": "v2"}


def write_triples(graph: Graph, path: str, mode: str = "overwrite") -> None:
    """K1/S16 -- store a graph as parquet partitioned by predicate (one folder per pattern).

    A virtual graph is written a predicate at a time, straight from its tables: nothing is shuffled or sorted. The rows of
    a triples table are rebalanced by predicate: Spark splits a large predicate over many tasks and files and puts
    small ones together.
    """
    if graph.by_predicate is None:
        graph.triples().hint("rebalance", "p").write.mode(mode).partitionBy("p").options(**STORE_OPTIONS).parquet(path)
        return
    for p, rows in graph.by_predicate.items():
        rows().withColumn("p", F.lit(p)).write.mode(mode).partitionBy("p").options(**STORE_OPTIONS).parquet(path)
        mode = "append"


def union_graphs(*graphs: Graph) -> Graph:
    """U2 -- the union of graphs as a set: a triple that several hold, or one holds twice, stands once."""
    parts = [g.triples().select("s", "p", "o", "o_kind", "lang", "dtype", "g") for g in graphs]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return Graph(graphs[0].spark, triples=out.distinct())


def in_graph(graph: Graph, g: str) -> Graph:
    """S3 -- restrict to one named graph."""
    return Graph(graph.spark, triples=graph.triples().where(F.col("g") == F.lit(g)))


def literal_type(name: str) -> str:
    return XSD + name


__all__ = ["About", "Affixed", "Graph", "branch", "read_triples", "parse_lines", "parse_ntriples", "to_ntriples", "write_lines", "write_triples", "in_graph", "union_graphs",
           "TRIPLE_SCHEMA", "RDF_TYPE", "literal_type"]
