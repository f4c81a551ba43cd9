"""Text expressions used by rule matching and the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PREFIX = "NL80_"
MISSING = "nan"

# Tokens the bundle reader takes for an empty cell (fixed values).
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def as_col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: str | Column) -> Column:
    """Null for any of the reader's empty-cell tokens."""
    c = as_col(value)
    return F.when(~c.isin(*NULL_TOKENS), c)


def strip_prefix(value: str | Column) -> Column:
    """Remove every ``NL80_`` from an id; values that are not text are shown as text."""
    return F.replace(as_col(value).cast("string"), F.lit(PREFIX), F.lit(""))


def clean_bundle(value: str | Column) -> Column:
    """Bundle name with blanks in place of plus signs."""
    return F.translate(as_col(value), "+", " ")


def bundle_from_path(path: str | Column) -> Column:
    """File name without folders and last extension, URL escapes resolved."""
    name = F.regexp_extract(as_col(path), r"([^/]+)$", 1)
    stem = F.regexp_extract(name, r"^(.+?)(?:\.[^.]*)?$", 1)
    return F.coalesce(F.try_url_decode(F.replace(stem, F.lit("+"), F.lit("%2B"))), stem)


def bundle_from_event_key(key: str | Column) -> Column:
    """Bundle name from an event's object key, where a plus sign stands for a blank."""
    return bundle_from_path(F.coalesce(F.try_url_decode(as_col(key)), as_col(key)))


def shown(value: str | Column) -> Column:
    """A value as reports show it: missing values read ``nan``."""
    return F.coalesce(as_col(value).cast("string"), F.lit(MISSING))


def same_value(data: str | Column, rule: str | Column) -> Column:
    """Both missing, or both present and equal as text."""
    return as_col(data).cast("string").eqNullSafe(as_col(rule).cast("string"))


def in_list(value: str | Column, listed: str | Column) -> Column:
    """Member of a ``;`` list, untrimmed; missing only matches missing."""
    v, l = as_col(value).cast("string"), as_col(listed).cast("string")
    return F.when(v.isNull() | l.isNull(), v.isNull() & l.isNull()).otherwise(
        F.array_contains(F.split(l, ";"), v)
    )


def parameter_key(code: str | Column = "parameter_code", taxon: str | Column = "biotaxon_naam") -> Column:
    """Lower-cased parameter code or taxon when exactly one of them is filled, else null."""
    c, t = as_col(code), as_col(taxon)
    return F.when(t.isNull(), F.lower(c)).when(c.isNull(), F.lower(t))


def parameter_label(code: str | Column = "parameter_code", taxon: str | Column = "biotaxon_naam") -> Column:
    """The one filled name as written, or ``code / taxon`` when both or none are filled."""
    c, t = as_col(code), as_col(taxon)
    return (
        F.when(t.isNotNull() & c.isNull(), t)
        .when(c.isNotNull() & t.isNull(), c)
        .otherwise(F.concat(shown(c), F.lit(" / "), shown(t)))
    )


def base_code(value: str | Column) -> Column:
    """Base bundle code: the text before the first plus sign, else before the first blank."""
    c = as_col(value)
    return F.trim(
        F.when(c.contains("+"), F.substring_index(c, "+", 1)).otherwise(F.substring_index(c, " ", 1))
    )


def plus_for_blanks(value: str | Column) -> Column:
    """Every run of white space becomes one plus sign."""
    return F.regexp_replace(as_col(value), r"\s+", "+")


def criteria_list(value: str | Column) -> Column:
    """``;`` list split, trimmed, blanks dropped, criterion prefix removed."""
    parts = F.transform(F.split(as_col(value), ";"), lambda p: F.trim(p))
    return F.transform(
        F.filter(parts, lambda p: F.length(p) > 0),
        lambda p: F.regexp_replace(p, r"^ANSNL?-", ""),
    )


def first_filled(*values: str | Column) -> Column:
    """First value that is neither null nor empty, else an empty text."""
    return F.coalesce(*[F.nullif(as_col(v).cast("string"), F.lit("")) for v in values], F.lit(""))


def flag_from_text(value: str | Column) -> Column:
    """``true``, ``1`` and ``yes`` read as true in any case; everything else is false."""
    return F.coalesce(F.lower(as_col(value).cast("string")).isin("true", "1", "yes"), F.lit(False))


def flag_from_status(status: str | Column, label: str) -> Column:
    """The True/False that follows ``label is:`` in a status sentence, false if absent."""
    found = F.regexp_extract(as_col(status), f"(?i){label} is: (True|False)", 1)
    return F.coalesce(F.lower(found) == "true", F.lit(False))
