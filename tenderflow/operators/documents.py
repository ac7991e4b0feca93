"""Operators on nested documents.

Everything is a column expression or an ``explode``: documents are never
grouped back together, so each one is processed where it was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import prefix_level


def flatten_struct(df: DataFrame, sep: str = "_", prefix: str = "", keep_arrays: bool = True) -> DataFrame:
    """F28/E3 -- nested struct fields to prefixed top-level columns; lists are kept whole."""
    cols: list[Column] = []

    def walk(dtype: T.DataType, path: list[str], name: str) -> None:
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(f.dataType, path + [f.name], f"{name}{sep}{f.name}" if name else f.name)
        elif keep_arrays or not isinstance(dtype, T.ArrayType):
            c = F.col(path[0])
            for p in path[1:]:
                c = c.getField(p)
            cols.append(c.alias(prefix + name))

    for f in df.schema.fields:
        walk(f.dataType, [f.name], f.name)
    return df.select(*cols)


def explode_path(df: DataFrame, col: str, path: list[str], keep: list[str] | None = None,
                 outer: bool = False) -> DataFrame:
    """S11/E1/E6 -- follow ``col.a[].b[].c[]`` with one explode per level; rows exist only where the last
    level has elements (``outer`` keeps empty ones)."""
    ex = F.explode_outer if outer else F.explode
    cur = df.select(*(keep or []), F.col(col).alias("_n0"))
    for i, p in enumerate(path):
        cur = cur.select(*(keep or []), *[f"_n{k}" for k in range(i + 1)], ex(F.col(f"_n{i}").getField(p))
                         .alias(f"_n{i + 1}"))
    return cur


def main_cpv(cpvs) -> Column:
    """E2 -- the main CPV code (the last element flagged isMain), null if none."""
    c = F.col(cpvs) if isinstance(cpvs, str) else cpvs
    return F.try_element_at(F.transform(F.filter(c, lambda x: x["isMain"]), lambda x: x["code"]), F.lit(-1))


def all_cpvs(cpvs) -> Column:
    """E2 -- every CPV code of the list, in order (one column, not n)."""
    c = F.col(cpvs) if isinstance(cpvs, str) else cpvs
    return F.transform(c, lambda x: x["code"])


def with_indicators(df: DataFrame, arr, names: list[str], prefix: str = "", type_field: str = "type",
                    value_field: str = "value") -> DataFrame:
    """D4/D5/D6 -- ``df`` plus one column per indicator type: the value of the first element of that type.

    The list's types and values are taken apart in a step of its own that Catalyst keeps because many columns read it; each
    column then is one compiled search (inside a lambda a search is interpreted). The first reads the values through a
    lambda: a projection with one is compiled as many small methods, not as one that is too large for the JVM to compile.
    """
    a = F.col(arr) if isinstance(arr, str) else arr
    listed = df.select(*df.columns, F.transform(a, lambda x: x[type_field]).alias("_types"), F.transform(a, lambda x: x[value_field]).alias("_values"))

    def value(i, name):
        values = F.col("_values") if i else F.transform("_values", lambda v: v)
        return F.get(values, F.array_position("_types", F.lit(name)).cast("int") - 1).alias(prefix + name)
    return listed.select(*df.columns, *[value(i, n) for i, n in enumerate(names)])


def nuts_levels(col, levels: list[int], prefix: str) -> list[Column]:
    """D1/D2 -- NUTS code at each level."""
    return [prefix_level(col, n).alias(f"{prefix}{n}") for n in levels]


def required(df: DataFrame, fields: list[str]) -> DataFrame:
    """P6/E4 -- drop rows missing any required field, among the fields that exist."""
    present = [f for f in fields if f in df.columns]
    return df.dropna(subset=present) if present else df


def cast_fields(df: DataFrame, float_fields: list[str]) -> DataFrame:
    """P9 -- listed price fields to double, every other column to text; nulls stay null."""
    return df.select(*[F.col(c).cast("double" if c in float_fields else "string").alias(c) for c in df.columns])


def share(df: DataFrame, flag: str, name: str) -> DataFrame:
    """E7/A10 -- percentage of rows with the flag true, rounded to 2."""
    return df.agg(F.round(F.lit(100.0) * F.count_if(F.col(flag)) / F.count(F.lit(1)), 2).alias(name))
