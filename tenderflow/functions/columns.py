"""Column -> Column helpers (no UDFs): IRIs, lists, dates, codes, indicators.

Every helper returns a built-in expression, so it stays inside whole-stage
codegen and works the same in batch and streaming plans.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..vocab import LIST_SEPARATOR, NOTICE_LINK


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 -- afn:localname: text after the last '/' or '#'
def local_name(c) -> Column:
    # two searches from the end: a pattern for it is tried at every character of the IRI
    return F.substring_index(F.substring_index(_c(c), "/", -1), "#", -1)


# F2 -- last path segment x.split('/')[-1], null-safe
def last_segment(c) -> Column:
    return F.substring_index(_c(c), "/", -1)


# F3 -- split " ||| " joined text into a list (the separator is literal, not a regex)
def split_list(c, sep: str = LIST_SEPARATOR) -> Column:
    c = _c(c)
    return F.when(c.isNull() | (c == ""), None).otherwise(F.split(c, r"\Q" + sep + r"\E"))


# F4 -- split then last segment of each element
def split_last_segments(c, sep: str = LIST_SEPARATOR) -> Column:
    return F.transform(split_list(c, sep), lambda x: F.substring_index(x, "/", -1))


# F5 -- Python str.strip(): all leading/trailing whitespace
def strip(c) -> Column:
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


# F6 -- parse yyyyMMdd text, null on bad input
def parse_yyyymmdd(c) -> Column:
    return F.to_date(F.try_to_timestamp(_c(c), F.lit("yyyyMMdd")))


# F7/F8 -- surrogate key: concatenation, null if any part is null
def surrogate_key(*cols) -> Column:
    return F.concat(*[_c(c) for c in cols])


# F10 -- notice id parts from a notice IRI "…id_<year>-…-<number>_Notice"
def notice_id(c) -> Column:
    m = F.regexp_extract(_c(c), r"id_(.*)_Notice", 1)
    return F.nullif(m, F.lit(""))


def notice_year(c) -> Column:  # F12
    return F.element_at(F.split(notice_id(c), "-"), 1)


def notice_number(c) -> Column:  # F13
    return F.element_at(F.split(notice_id(c), "-"), -1)


def _link(number: Column, year: Column, template: str) -> Column:
    head, tail = template.split("{notice_id}")
    return F.concat(F.lit(head), number, F.lit("-"), year, F.lit(tail))


# F11 -- link to the notice from a notice IRI
def notice_link(c, template: str = NOTICE_LINK) -> Column:
    return _link(notice_number(c), notice_year(c), template)


# F14 -- link to the notice from a lot IRI "…id_<notice id>_Lot_…" (null if no match)
def lot_notice_link(c, template: str = NOTICE_LINK) -> Column:
    nid = F.nullif(F.regexp_extract(_c(c), r"id_(.*)_Lot_", 1), F.lit(""))
    parts = F.split(nid, "-")
    return _link(F.element_at(parts, -1), F.element_at(parts, 1), template)


# F15/F31 -- NUTS code at level n: first n+2 characters, null if shorter
def prefix_level(c, n: int) -> Column:
    c = _c(c)
    return F.when(F.length(c) >= n + 2, F.substring(c, 1, n + 2))


# F16 -- the same element-wise over a list (null list -> null, null elements kept)
def prefix_level_list(c, n: int) -> Column:
    return F.transform(_c(c), lambda x: F.when(F.length(x) >= n + 2, F.substring(x, 1, n + 2)))


# F18 -- inclusive daily date list between two dates
def date_sequence(start, end) -> Column:
    return F.sequence(_c(start), _c(end), F.expr("interval 1 day"))


# F20 -- yesterday relative to a run date (default: today)
def yesterday(run_date=None) -> Column:
    base = F.current_date() if run_date is None else F.to_date(F.lit(str(run_date)))
    return F.date_sub(base, 1)


# F24 -- truncate money toward zero to an integer
def truncate_money(c) -> Column:
    return _c(c).try_cast("double").cast("bigint")


# F25 -- presence indicator with Python truthiness: null/''/0/false/[] -> 0, else 100
def present(c, kind: str = "string") -> Column:
    c = _c(c)
    if kind == "array":
        cond = c.isNotNull() & (F.size(c) > 0)
    elif kind == "number":
        cond = c.isNotNull() & (c != 0)
    elif kind == "boolean":
        cond = c.isNotNull() & c
    else:
        cond = c.isNotNull() & (c != F.lit(""))
    return F.when(cond, F.lit(100)).otherwise(F.lit(0))


# F26 -- equality indicator
def equals_indicator(c, value: str) -> Column:
    return F.when(_c(c) == F.lit(value), F.lit(100)).otherwise(F.lit(0))


# A11 -- row-wise mean of k columns rounded to 2
def row_mean(*cols) -> Column:
    total = cols[0] if not isinstance(cols[0], str) else F.col(cols[0])
    for c in cols[1:]:
        total = total + _c(c)
    return F.round(total / F.lit(float(len(cols))), 2)


# F27 -- text after the first space (empty if there is none)
def after_first_space(c) -> Column:
    c = _c(c)
    return F.when(F.instr(c, " ") == 0, F.lit("")).otherwise(F.substr(c, F.instr(c, " ") + 1))


# F29 -- semantic version "a.b.c" (pre-release tags ignored) as a comparable struct
def semver(c) -> Column:
    core = F.regexp_extract(_c(c), r"^(\d+)(?:\.(\d+))?(?:\.(\d+))?", 0)
    parts = F.split(core, r"\.")
    return F.struct(*[F.coalesce(F.try_element_at(parts, F.lit(i)).try_cast("int"), F.lit(0)).alias(n)
                      for i, n in ((1, "major"), (2, "minor"), (3, "patch"))])


# F30 -- first list element with type = T, its value; null if none
def value_by_type(arr, type_name: str, type_field: str = "type", value_field: str = "value") -> Column:
    return F.try_element_at(
        F.transform(F.filter(_c(arr), lambda x: x[type_field] == F.lit(type_name)), lambda x: x[value_field]),
        F.lit(1))


# F33 -- (a / b) * 100, null on b = 0
def percent(a, b) -> Column:
    return F.try_divide(_c(a), _c(b)) * F.lit(100)
