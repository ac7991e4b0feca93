"""Graph-pattern operators (G1-G24) as DataFrame joins over a ``Graph``.

A pattern result is a DataFrame whose columns are variable names. Patterns
are combined by natural equi-joins on shared variables (``match``), left
joins (``optional``), anti joins (``without``) and unions (``any_of``).
Joins are plain equi-joins so Catalyst/AQE choose broadcast, shuffled hash or
sort-merge at run time from measured sizes; nothing here collects data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.triples import Graph
from ..vocab import RDF_TYPE, V


def _p(p: str) -> str:
    return V.get(p, p)


# G1/G11-G13 -- triple pattern ?s p ?o
def pattern(g: Graph, p: str, s: str = "s", o: str = "o", *, lang: str | None = None, keep_lang: bool = False,
            cast: str | None = None, value: object = None) -> DataFrame:
    """Rows (s, o) of predicate ``p``.

    ``lang`` filters the language tag (G13); ``cast`` types the literal with a
    null-on-error cast (G11); ``value`` matches a constant object (G12).
    """
    df = g.pred(_p(p))
    if lang is not None:
        df = df.where(F.col("lang") == F.lit(lang))
    obj = F.col("o")
    if cast is not None:
        obj = obj.try_cast(cast)
    cols = [F.col("s").alias(s), obj.alias(o)]
    if keep_lang:
        cols.append(F.col("lang").alias(f"{o}_lang"))
    out = df.select(*cols)
    if value is not None:
        out = out.where(F.col(o) == F.lit(value))
    return out


# G2 -- class test ?x a C (several classes: union, G7)
def of_class(g: Graph, *classes: str, name: str = "s") -> DataFrame:
    frames = [g.pred(RDF_TYPE, _p(c)).select(F.col("s").alias(name)) for c in classes]
    out = reduce(DataFrame.unionByName, frames)
    return out.distinct() if len(frames) > 1 else out


def typed(df: DataFrame, g: Graph, var: str, cls: str) -> DataFrame:
    """Keep rows whose ``var`` has rdf:type ``cls``.

    A left-semi join with the class's type triples; when the graph declares how IRIs of that class are
    minted (a virtual graph over tables), the same test is a filter on the IRI and needs no shuffle.
    """
    pat = g.class_patterns.get(_p(cls))
    if pat is not None:
        return df.where(F.col(var).rlike(pat))
    return df.join(of_class(g, cls, name=var), var, "left_semi")


# G4 -- property path a / b / ...
def path(g: Graph, preds: list[str], s: str = "s", o: str = "o") -> DataFrame:
    names = [s] + [f"_{s}_{o}_{i}" for i in range(1, len(preds))] + [o]
    out = pattern(g, preds[0], names[0], names[1])
    for i, p in enumerate(preds[1:], start=1):
        out = out.join(pattern(g, p, names[i], names[i + 1]), names[i])
    return out.select(s, o)


# G3/G20 -- conjunction: inner equi-join on all shared variables
def match(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        on = [c for c in f.columns if c in out.columns]
        out = out.join(f, on, "inner") if on else _cross_forbidden(out, f)
    return out


def _cross_forbidden(a: DataFrame, b: DataFrame) -> DataFrame:
    raise ValueError(f"patterns share no variable: {a.columns} / {b.columns}")


# G5/G6 -- OPTIONAL: left join of a (pre-filtered) group on shared variables
def optional(df: DataFrame, group: DataFrame, on: list[str] | None = None) -> DataFrame:
    on = on or [c for c in group.columns if c in df.columns]
    return df.join(group, on, "left")


# G14 -- FILTER NOT EXISTS
def without(df: DataFrame, group: DataFrame, on: list[str] | None = None) -> DataFrame:
    on = on or [c for c in group.columns if c in df.columns]
    return df.join(group, on, "left_anti")


# G7/G8/U1 -- UNION under DISTINCT
def any_of(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


# G21/G22 -- language-preferred text: English if present, else the smallest other value
def preferred_text(g: Graph, p: str, s: str, out: str, lang: str = "en", require_preferred: bool = False) -> DataFrame:
    df = g.pred(_p(p)).select(F.col("s").alias(s), "o", "lang")
    if require_preferred:
        return df.where(F.col("lang") == F.lit(lang)).groupBy(s).agg(F.min("o").alias(out))
    return df.groupBy(s).agg(F.coalesce(F.min(F.when(F.col("lang") == F.lit(lang), F.col("o"))),
                                        F.min("o")).alias(out))


# G24 -- every triple
def dump(g: Graph) -> DataFrame:
    return g.triples().select("s", "p", "o")
