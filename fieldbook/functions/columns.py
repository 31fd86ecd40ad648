"""Scalar column expressions (all JVM-side, codegen'd)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = " \t\n\x0b\f\r"  # what \s matches in a pattern


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (``str.strip()``), not only blanks."""
    return F.btrim(_c(c), F.lit(_WS))


def list_items(c: str | Column, sep: str = ",", strip: bool = True) -> Column:
    """Split a delimited string into an array; NULL stays NULL, '' gives ['']."""
    parts = F.split(_c(c), sep_pattern(sep))
    return F.transform(parts, strip_ws) if strip else parts


def sep_pattern(sep: str) -> str:
    """Regex that matches a literal separator."""
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def to_text(c: str | Column) -> Column:
    """Cast to string; NULL stays NULL (pandas would write 'nan')."""
    return _c(c).cast("string")


def fill_null_text(c: str | Column, text: str = "null") -> Column:
    """NULL -> the literal text (default 'null'); other values cast to string."""
    return F.coalesce(_c(c).cast("string"), F.lit(text))


def replace_when_contains(c: str | Column, needle: str, replacement: str) -> Column:
    """Whole value becomes ``replacement`` when it contains ``needle`` (substring test)."""
    col = _c(c)
    return F.when(col.contains(needle), F.lit(replacement)).otherwise(col)


def like_pattern(keyword: str) -> str:
    return f"%{keyword}%"


def keyword_match(columns: Iterable[str], keywords: Iterable[str], literal: bool = False) -> Column:
    """OR over keywords of OR over columns of ``CAST(col AS STRING) LIKE '%kw%'``.

    With ``literal=True`` the keyword is a plain substring (``%`` and ``_`` are
    not wildcards).  A NULL cell never matches.
    """
    cols = list(columns)
    kws = list(keywords)
    if not cols or not kws:
        raise ValueError("keyword search needs at least one column and one keyword")
    terms = []
    for kw in kws:
        if kw is None:
            raise ValueError("keyword must not be None")
        for c in cols:
            txt = F.col(c).cast("string")
            terms.append(txt.contains(kw) if literal else txt.like(like_pattern(kw)))
    return F.coalesce(reduce(lambda a, b: a | b, terms), F.lit(False))


# Observation unit by measure column name; anything else is 'unknown'.
UNITS = {
    "feeding": "percentage",
    "weight": "grams",
    "rootgms": "gms",
}
UNKNOWN_UNIT = "unknown"


def unit_for(name_col: str | Column, units: dict[str, str] | None = None) -> Column:
    """Unit of a measure by its column name, via a literal map lookup."""
    units = UNITS if units is None else units
    if not units:
        return F.lit(UNKNOWN_UNIT)
    m = F.create_map(*[x for k, v in units.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, _c(name_col)), F.lit(UNKNOWN_UNIT))


def canonical_array(c: str | Column, sep: str = "|") -> Column:
    """Order-free text form of an array for comparisons: sorted, NULLs skipped,
    NULL when no non-NULL element is left (as SQL ``string_agg``)."""
    vals = F.sort_array(F.filter(_c(c), lambda e: e.isNotNull()))
    return F.when(F.size(vals) > 0, F.array_join(vals, sep))
