"""Text predicates and clean-up as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_AVAILABLE = "Not available"
#: Texts a CSV reader with default missing-value rules takes for missing (fixed values).
PANDAS_NA = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
EXCEL_LIMIT, EXCEL_SUFFIX = 32000, " ...[truncated, see CSV for full text]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def py_strip(c: Column) -> Column:
    """Strip all Unicode white space, non-breaking spaces too (``trim`` only takes blanks)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def strip_chars(c: Column, chars: str) -> Column:
    """Strip any of the characters from both ends."""
    inside = "".join("\\" + x if x in r"\]^-[" else x for x in chars)
    return F.regexp_replace(c, f"^[{inside}]+|[{inside}]+$", "")


def nullif_pandas_na(c: Column) -> Column:
    return F.when(~c.isin(PANDAS_NA), c)


def has_value(c: Column) -> Column:
    """Neither null, blank, ``nan`` nor the sentinel."""
    return c.isNotNull() & ~F.lower(py_strip(c)).isin("", "nan", "not available")


def has_result(c: Column) -> Column:
    """Whether a stored result counts as one; errors do, blanks and missing values do not."""
    return c.isNotNull() & ~F.lower(py_strip(c)).isin("", "nan", "none", "nat")


def or_not_available(c: Column) -> Column:
    return F.coalesce(F.nullif(py_strip(c), F.lit("")), F.lit(NOT_AVAILABLE))


def normalize_time_range(c: Column) -> Column:
    """One spelling of opening times: no ``:00``, an en dash for to and dashes, lower-case am and pm."""
    t = F.regexp_replace(py_strip(c), "[  ]", " ")
    t = F.replace(t, F.lit(":00"), F.lit(""))
    t = F.regexp_replace(t, r"(?U)\s*(to|-|–|—)\s*", "–")
    t = py_strip(F.regexp_replace(t, r"(?U)\s+", " "))
    t = F.regexp_replace(F.regexp_replace(t, r"\bAM\b", "am"), r"\bPM\b", "pm")
    return F.coalesce(t, F.lit(""))


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)[^\d]", "")


def first_digits(*candidates: Column) -> Column:
    """Digits of the first candidate that has any."""
    return F.coalesce(*[F.nullif(digits_only(c), F.lit("")) for c in candidates], F.lit(""))


def title_from(h1: Column, label: Column, card_label: Column) -> Column:
    """The first title given: heading, panel label, then the card's label up to its first separator."""
    given = lambda c: F.nullif(py_strip(c), F.lit(""))
    return F.coalesce(given(h1), given(label), given(F.element_at(F.split(card_label, " · "), 1)), F.lit(NOT_AVAILABLE))


def short_error(c: Column, limit: int = 300) -> Column:
    return F.left(F.element_at(F.split(c, "\n"), 1), F.lit(limit))


def excel_safe(c: Column) -> Column:
    """Without control characters a workbook can't hold; longer cells are cut with a remark."""
    clean = F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    return F.when(F.length(clean) > EXCEL_LIMIT, F.concat(F.left(clean, F.lit(EXCEL_LIMIT)), F.lit(EXCEL_SUFFIX))).otherwise(clean)


def pick_timings(hours: Column, today: Column, summary: Column) -> Column:
    """Opening times from a map day -> hours: the only value of all open days, else today's, else the summary."""
    is_open = F.map_filter(hours, lambda _, h: F.lower(h) != "closed")
    distinct = F.array_distinct(F.map_values(is_open))
    chosen = F.coalesce(F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0))), F.try_element_at(hours, today), F.regexp_replace(summary, "\n", " "))
    return normalize_time_range(chosen)
