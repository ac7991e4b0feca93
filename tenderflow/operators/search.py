"""Document search (K12): conditions on nested documents, compiled to filters and higher-order functions.

A condition is built by ``term``, ``terms``, ``between``, ``exists``, ``match``, ``nested`` and combined by ``all_of``,
``any_of``, ``none_of``. Paths are dotted and pass through arrays: a document holds if some value under the path
does. ``nested`` asks that one and the same element of an array holds. Nothing is exploded and nothing
shuffled. A null value or an empty array holds nothing, so ``none_of`` is a plain complement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: (fields of the scope by name, type of the scope) -> boolean column, never null
Condition = Callable[[Callable[[str], Column], T.StructType], Column]


def _some(value: Column, dtype: T.DataType, path: list[str], test: Callable[[Column], Column]) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.coalesce(F.exists(value, lambda x: _some(x, dtype.elementType, path, test)), F.lit(False))
    if path:
        return _some(value.getField(path[0]), dtype[path[0]].dataType, path[1:], test)
    return F.coalesce(test(value), F.lit(False))


def _at(path: str, test: Callable[[Column], Column]) -> Condition:
    first, *rest = path.split(".")
    return lambda field, scope: _some(field(first), scope[first].dataType, rest, test)


def term(path: str, value) -> Condition:
    return _at(path, lambda v: v == F.lit(value))


def terms(path: str, values: list) -> Condition:
    return _at(path, lambda v: v.isin(list(values)))


def between(path: str, low=None, high=None) -> Condition:
    """Both ends included; an end that is None is open."""
    def test(v: Column) -> Column:
        out = v.isNotNull()
        out = out if low is None else out & (v >= F.lit(low))
        return out if high is None else out & (v <= F.lit(high))
    return _at(path, test)


def exists(path: str) -> Condition:
    return _at(path, lambda v: v.isNotNull())


def match(path: str, text: str, every: bool = False) -> Condition:
    """Some (``every``: each) word of the text is a word of the value, case aside."""
    def test(v: Column) -> Column:
        words = F.filter(F.split(F.lower(F.lit(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
        said = F.split(F.lower(v), r"[^\p{L}\p{N}]+")
        return F.size(F.array_except(words, said)) == 0 if every else F.arrays_overlap(words, said)
    return _at(path, test)


def nested(path: str, condition: Condition) -> Condition:
    """One element under the path meets the whole condition, whose paths start at the element."""
    def compiled(field, scope):
        def element(value: Column, dtype: T.DataType, rest: list[str]) -> Column:
            if isinstance(dtype, T.ArrayType):
                return F.coalesce(F.exists(value, lambda x: element(x, dtype.elementType, rest)), F.lit(False))
            if rest:
                return element(value.getField(rest[0]), dtype[rest[0]].dataType, rest[1:])
            return condition(value.getField, dtype)
        first, *rest = path.split(".")
        return element(field(first), scope[first].dataType, rest)
    return compiled


def all_of(*conditions: Condition) -> Condition:
    def compiled(field, scope):
        out = F.lit(True)
        for c in conditions:
            out = out & c(field, scope)
        return out
    return compiled


def any_of(*conditions: Condition) -> Condition:
    def compiled(field, scope):
        out = F.lit(False)
        for c in conditions:
            out = out | c(field, scope)
        return out
    return compiled


def none_of(*conditions: Condition) -> Condition:
    some = any_of(*conditions)
    return lambda field, scope: ~some(field, scope)


def search(docs: DataFrame, condition: Condition, fields: list[str] | None = None) -> DataFrame:
    """Documents that meet the condition, with the dotted ``fields`` under their last names (None: whole)."""
    found = docs.where(condition(F.col, docs.schema))
    return found if fields is None else found.select(*[F.col(f).alias(f.rsplit(".", 1)[-1]) for f in fields])
