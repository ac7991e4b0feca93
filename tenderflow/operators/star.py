"""Star patterns (G3 fused): everything asked about one subject, and about things it points at, in one pass.

A pattern is a tree of ``node`` (a subject with its links), ``value`` (an object as it is) and ``text`` (a
language-preferred literal, G21/G22). Links are predicate names, or ``^name`` for the inverse direction; one
predicate may carry a list of targets. A link is optional unless its target is ``required``; if a required link inside an
optional node fails, the whole node is null.

* On a stored graph a node is one scan of its predicates and one pivoting ``groupBy(subject)``; nested nodes are stars
  of their own, joined on their IRI. Several values of a link give several rows, as a join would.
* On a virtual graph a tree whose IRIs are all minted from the rows of one source (or of sources joined to it by a foreign
  key) is one projection of that source: no join, no shuffle, and filters reach the scan. A link that leaves those rows
  becomes a join with the star (or the pattern) on its other side.

The number of values of a pivoted link must be small per subject. Links with many values (a notice's lots) are asked
from the other side (``^``), where each has one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.triples import Affixed, Graph, Mapped, Term
from ..vocab import RDF_TYPE, V
from .graph import of_class, pattern


@dataclass(frozen=True)
class value:
    """The object of a link: cast, equal to a constant, or (``yyyyMMdd`` text) between two days, ends included."""
    name: str
    required: bool = False
    cast: str | None = None
    equals: str | None = None
    between: tuple[str, str] | None = None


@dataclass(frozen=True)
class text:
    """English (``lang``) if present, else the smallest other value; ``only``: nothing else; ``lang`` None: no preference.

    ``of``: only for subjects of that class.
    """
    name: str
    lang: str | None = "en"
    only: bool = False
    of: str | None = None
    required: bool = False


@dataclass(frozen=True)
class node:
    """A subject named ``name``, of one of the classes ``cls`` if given, with its links."""
    name: str
    links: dict
    cls: str | tuple | None = None
    required: bool = False

    def classes(self) -> list[str]:
        return [V.get(c, c) for c in ((self.cls,) if isinstance(self.cls, str) else self.cls or ())]

    def targets(self) -> list[tuple[str, bool, object]]:
        """(predicate, inverse, target) of every link."""
        return [(V.get(p.lstrip("^"), p.lstrip("^")), p.startswith("^"), t) for p, ts in self.links.items()
                for t in (ts if isinstance(ts, list) else [ts])]

    def names(self) -> list[str]:
        return [self.name] + [n for _, _, t in self.targets() for n in (t.names() if isinstance(t, node) else [t.name])]


def star(g: Graph, root: node) -> DataFrame:
    """One row per solution, one column per name of the pattern."""
    if g.mapping is None:
        return _stored(g, root).select(*root.names())
    return reduce(DataFrame.unionByName, [_virtual(g, root, k) for k in _root_keys(g, root)])


#: the column of ``dealt_stars`` that rows of one family share, if the graph has one
DEALT = "_dealt"


def dealt_stars(g: Graph, *roots: node) -> tuple[list[str], list[DataFrame]]:
    """Stars that are grouped and joined by their IRIs, and the names of a further column to group and join them by.

    On a virtual graph whose mapping knows a column that those IRIs hold, the stars carry it (``DEALT``): what is dealt by it
    lies together for all groups and joins by IRIs that hold it, however many. Else there is no such column.
    """
    keys = [_root_keys(g, r) for r in roots] if g.mapping is not None else []
    if not keys or not all(g.mapping.home.get(k) in g.mapping.dealt for ks in keys for k in ks):
        return [], [star(g, r) for r in roots]
    return [DEALT], [reduce(DataFrame.unionByName, [_virtual(g, r, k, dealt=True) for k in ks]) for r, ks in zip(roots, keys)]


def distinct_star(g: Graph, root: node, names: list[str], **casts: str) -> DataFrame:
    """The distinct rows of ``names`` (cast as said) among the solutions of ``root``.

    On a virtual graph a text minted from one column is minted last: rows are joined and made distinct by the columns
    inside the texts, which are far shorter, and Spark sees that a join's rows lie together by them already.
    """
    cast = lambda df: df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else c for c in names]).distinct()
    keys = _root_keys(g, root) if g.mapping is not None else []
    if len(keys) != 1:
        return cast(star(g, root))
    inside: dict[str, tuple[Affixed, str]] = {}
    out = _virtual(g, root, keys[0], inside)
    out = out.withColumns({c: F.col(held) for c, (_, held) in inside.items() if c in names and held != c})
    out = out.withColumns({c: inside.pop(c)[0].text(F.col(c)) for c in casts if c in inside})
    return cast(out).select(*[inside[c][0].text(F.col(c)).alias(c) if c in inside else c for c in names])


# ---- stored: one scan, one pivot a node --------------------------------------
def _day(obj: Column, between: tuple[str, str]) -> Column:
    return obj.between(*between) & F.try_to_timestamp(obj, F.lit("yyyyMMdd")).isNotNull()


def _stored(g: Graph, n: node) -> DataFrame:
    links = n.targets()
    fwd, inv = {p for p, i, _ in links if not i}, {p for p, i, _ in links if i}
    wanted = {V.get(t.of, t.of) for _, _, t in links if isinstance(t, text) and t.of} | set(n.classes())
    p, s, o = F.col("p"), F.col("s"), F.col("o")
    typed = (p == RDF_TYPE) & o.isin(*wanted) if wanted else F.lit(False)
    frames = []
    if fwd or wanted:
        frames.append(g.triples().where(p.isin(*fwd) | typed).select(s.alias("k"), "p", o.alias("x"), "lang", F.lit(False).alias("inv")))
    if inv:
        frames.append(g.triples().where(p.isin(*inv)).select(o.alias("k"), "p", s.alias("x"), "lang", F.lit(True).alias("inv")))
    rows = reduce(DataFrame.unionByName, frames)
    wanted = {c: f"is{k}" for k, c in enumerate(sorted(wanted))}
    aggs, later = [F.max((p == RDF_TYPE) & (F.col("x") == c)).alias(is_c) for c, is_c in wanted.items()], []
    for k, (pred, back, t) in enumerate(links):
        mine, x = (p == pred) & (F.col("inv") == F.lit(back)), F.col("x")
        if isinstance(t, text):
            own = F.min(F.when(mine if t.lang is None else mine & (F.col("lang") == t.lang), x))
            aggs.append((own if t.only else F.coalesce(own, F.min(F.when(mine, x)))).alias(f"v{k}"))
            later.append((t, F.when(F.col(wanted[V.get(t.of, t.of)]), F.col(f"v{k}")) if t.of else F.col(f"v{k}")))
            continue
        if isinstance(t, value):
            mine = mine & (x == t.equals) if t.equals is not None else mine
            mine = mine & _day(x, t.between) if t.between else mine
            x = x.try_cast(t.cast) if t.cast else x
        aggs.append(F.collect_set(F.when(mine, x)).alias(f"v{k}"))
        later.append((t, F.col(f"v{k}")))
    base = rows.groupBy(F.col("k").alias(n.name)).agg(*aggs)
    if n.classes():
        base = base.where(reduce(Column.__or__, [F.col(wanted[c]) for c in n.classes()]))
    out = base
    for t, col in later:
        if isinstance(t, text):
            out = out.withColumn(t.name, col)
            out = out.where(F.col(t.name).isNotNull()) if t.required else out
        elif isinstance(t, node) and not t.required and (t.links or t.cls):
            # the group matches as a whole or not at all: its values are joined first, then the group
            group = base.select(n.name, F.explode(col).alias(t.name)).join(_stored(g, t), t.name)
            out = out.join(group, n.name, "left")
        else:
            out = out.withColumn(t.name, (F.explode if t.required else F.explode_outer)(col))
            if isinstance(t, node) and (t.links or t.cls):
                out = out.join(_stored(g, t), t.name)
    return out.drop(*[f"v{k}" for k in range(len(links))], *wanted.values())


# ---- virtual: one projection of one source -----------------------------------
def _types(g: Graph, n: node) -> dict[str, Mapped]:
    """Key -> how its members of the node's classes are typed."""
    return {b.s.key: b for c in n.classes() for b in g.mapped(RDF_TYPE, c) or []}


def _root_keys(g: Graph, n: node) -> list[str]:
    if n.cls is not None:
        return list(_types(g, n))
    ends = []
    for pred, back, _ in n.targets():
        ends.append([b.okey if back else b.s.key for b in g.mapped(pred) or []])
    return list(dict.fromkeys(max(ends, key=len)))


class _Projection:
    """Columns, filter and left-over joins of one tree over one source.

    ``inside``, if given, gets the names whose columns stay as they are inside their texts, with the text around each
    and the name of the column that holds it.
    """

    def __init__(self, g: Graph, key: str, inside: dict[str, tuple[Affixed, str]] | None = None):
        self.g, self.m, self.grain, self.inside = g, g.mapping, g.mapping.home[key], inside
        self.need, self.joins = {self.grain}, []

    def source(self, need: set[str]) -> str | None:
        fits = [s for s, p in self.m.provides.items() if need <= p and self.m.grain[s] == self.grain]
        return min(fits, key=lambda s: len(self.m.provides[s])) if fits else None

    def usable(self, pred: str, back: bool, key: str, t) -> list[Mapped] | None:
        """Projections of the link on rows that ``key`` names one by one; None if some rows lie elsewhere."""
        found = self.g.mapped(pred)
        if found is None:
            return None
        found = [b for b in found if (b.okey if back else b.s.key) == key]
        if isinstance(t, node) and t.cls is not None:
            classes = _types(self.g, t)
            found = [b for b in found if (b.s.key if back else b.okey) in classes]
        for b in found:
            if self.m.grain[b.rows.source] != self.m.home[key] or not self.source(self.need | self.m.provides[b.rows.source]):
                return None
        return found

    def walk(self, n: node, key: str, ok: Column, nested: bool) -> tuple[Column, dict[str, Column]]:
        """(whether the node matches, name -> column of everything below it)."""
        if n.cls is not None:
            ok = reduce(Column.__and__, _types(self.g, n)[key].rows.conds, ok)
        out: dict[str, Column] = {}
        for pred, back, t in n.targets():
            found = self.usable(pred, back, key, t)
            if found is None or (isinstance(t, node) and len(found) > 1):
                if nested and t.required:
                    raise ValueError(f"{t.name}: a required link inside an optional node leaves the node's rows")
                self.joins.append((n.name, pred, back, t, None))
                continue
            if not found:
                ok = ok & F.lit(False) if t.required else ok
                out |= {c: F.lit(None).cast("string") for c in (t.names() if isinstance(t, node) else [t.name])}
                continue
            for b in found:
                self.need |= self.m.provides[b.rows.source]
            if isinstance(t, node):
                got, cols = self.child(t, found[0], back, nested)
            else:
                got, cols = self.leaf(t, found, back, key)
            ok = ok & got if t.required else ok
            out |= cols
        return ok, out

    def child(self, t: node, b: Mapped, back: bool, nested: bool) -> tuple[Column, dict[str, Column]]:
        end, key, there = (b.s.col, b.s.key, b.s.there) if back else (b.object, b.okey, b.object_there)
        here = reduce(Column.__and__, b.rows.conds, there)
        if t.cls is not None:
            here = reduce(Column.__and__, _types(self.g, t)[key].rows.conds, here)
        if not t.links:
            return here, {t.name: end if t.required and not nested else F.when(here, end)}
        if key in self.m.home and self.source(self.need | {self.m.home[key]}):
            self.need |= {self.m.home[key]}
            got, cols = self.walk(t, key, here, nested or not t.required)
            cols = {t.name: end, **cols}
            # a required node's rows are filtered by ``got``: no need to say it in every column
            return got, cols if t.required and not nested else {c: F.when(got, x) for c, x in cols.items()}
        if nested and t.required:
            raise ValueError(f"{t.name}: a required link inside an optional node leaves the node's rows")
        self.joins.append((t.name, None, back, t, key))  # the other side has rows of its own: joined on its IRI
        term = b.s if back else b.o
        if self.inside is not None and term.made and _minted(self.g, t, key).made:
            self.inside[t.name], end = (term.made, t.name), term.made.column
        return here, {t.name: F.when(here, end)}

    def leaf(self, t, found: list[Mapped], back: bool, key: str) -> tuple[Column, dict[str, Column]]:
        def at(b: Mapped) -> tuple[Column, Column]:
            """(whether the link is there, its value); plain conditions, so that filters reach the scan."""
            obj, there = (b.s.col, b.s.there) if back else (b.object, b.object_there)
            conds = list(b.rows.conds)
            if b is plain:
                self.inside[t.name], obj = (b.o, t.name), b.o.column
            elif isinstance(t, value):
                if t.equals is not None:
                    conds.append(obj == t.equals)
                if t.between and b.raw is not None:
                    lo, hi = (F.to_date(F.lit(d), "yyyyMMdd") for d in t.between)
                    conds += [b.raw >= lo.cast("timestamp_ntz"), b.raw < F.date_add(hi, 1).cast("timestamp_ntz")]
                elif t.between:
                    conds.append(_day(obj, t.between))
                obj = obj.try_cast(t.cast) if t.cast else obj
                there = obj.isNotNull() if t.cast else there
            return reduce(Column.__and__, conds, there), F.when(reduce(Column.__and__, conds), obj) if conds else obj
        plain = None  # one column between fixed texts, asked for as it is
        if self.inside is not None and len(found) == 1 and not back and isinstance(found[0].o, Affixed) and t == value(t.name, t.required):
            plain = found[0]
        if isinstance(t, text):
            own = [at(b)[1] for b in found if t.lang in (None, b.lang)]
            rest = own if t.only else [at(b)[1] for b in found]
            low = lambda xs: F.least(*xs) if len(xs) > 1 else xs[0] if xs else F.lit(None).cast("string")
            x = F.coalesce(low(own), low(rest))
            if t.of is not None:
                types = {b.s.key: b for b in self.g.mapped(RDF_TYPE, V.get(t.of, t.of)) or []}
                x = F.when(reduce(Column.__and__, types[key].rows.conds, F.lit(True)), x) if key in types else F.lit(None).cast("string")
            return x.isNotNull(), {t.name: x}
        if len(found) == 1:
            there, x = at(found[0])
            return there, {t.name: x}
        x = F.array_distinct(F.filter(F.array(*[at(b)[1] for b in found]), lambda v: v.isNotNull()))
        return F.size(x) > 0, {t.name: F.when(F.size(x) > 0, x)}


def _virtual(g: Graph, n: node, key: str, inside: dict[str, tuple[Affixed, str]] | None = None, dealt: bool = False) -> DataFrame:
    pr = _Projection(g, key, inside)
    ok, cols = pr.walk(n, key, F.lit(True), False)
    source = pr.source(pr.need)
    rows, extra = g.mapping.sources[source](), [F.col(g.mapping.dealt[source]).alias(DEALT)] if dealt else []
    term = _minted(g, n, key)
    iri = term.col
    if n.name in (inside or ()):  # joined by the column inside its IRI, which other texts of its rows may be made of too
        iri = term.made.column
        for c in [c for c in _always(n) if c in cols and c in inside and inside[c][0].holds(term.made)]:
            inside[c] = inside[c][0], n.name
            del cols[c]
    many = {c: t for c, t in _values(n).items() if c in cols and len(g.mapped(t[0]) or []) > 1}
    out = rows.where(ok & term.there).select(iri.alias(n.name), *[x.alias(c) for c, x in cols.items()], *extra)
    for c in many:
        if out.schema[c].dataType.typeName() == "array":
            out = out.withColumn(c, F.explode_outer(c))
    for at, pred, back, t, child_key in pr.joins:
        out = _join(g, out, at, pred, back, t, child_key, inside)
    return out.select(*[c for c in n.names() if c not in (inside or ()) or inside[c][1] == c], *[DEALT] * dealt)


def _always(n: node) -> list[str]:
    """Values that every match of the node has."""
    return [c for _, _, t in n.targets() if t.required for c in (_always(t) if isinstance(t, node) else [t.name])]


def _values(n: node) -> dict[str, tuple]:
    out: dict[str, tuple] = {}
    for pred, back, t in n.targets():
        out |= _values(t) if isinstance(t, node) else {t.name: (pred, back, t)}
    return out


def _minted(g: Graph, n: node, key: str) -> Term:
    """The IRI of ``key`` as its type or its links mint it."""
    if n.cls is not None:
        return _types(g, n)[key].s
    for pred, back, _ in n.targets():
        for b in g.mapped(pred) or []:
            if (b.okey if back else b.s.key) == key:
                return b.o if back else b.s
    raise ValueError(f"nothing mints {n.name}")


def _join(g: Graph, out: DataFrame, at: str, pred: str | None, back: bool, t, key: str | None,
          inside: dict[str, tuple[Affixed, str]] | None = None) -> DataFrame:
    """A link that leaves the rows: joined on the IRI it starts from (``pred``) or on the IRI it ends at."""
    if pred is not None:
        if isinstance(t, text):
            raise ValueError(f"{t.name}: a text of other rows")
        if at in (inside or ()):
            there = _join(g, out.withColumn("_iri", inside[at][0].text(F.col(at))), "_iri", pred, back, t, key)
            return there.drop("_iri")
        pairs = pattern(g, pred, t.name if back else at, at if back else t.name, cast=getattr(t, "cast", None))
        if isinstance(t, value) and t.equals is not None:
            pairs = pairs.where(F.col(t.name) == t.equals)
        if isinstance(t, node) and t.links:
            pairs = pairs.join(star(g, t), t.name)
        elif isinstance(t, node) and t.cls is not None:
            pairs = pairs.join(of_class(g, *t.classes(), name=t.name), t.name, "left_semi")
        return out.join(pairs, at, "inner" if t.required else "left")
    child = _virtual(g, t, key, inside)
    return out.join(child, t.name) if t.required else out.join(child, t.name, "left")
