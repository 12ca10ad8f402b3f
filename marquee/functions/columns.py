"""Column-level helpers: casts, null handling, lists, text predicates.

All functions return ``Column`` expressions built from ``pyspark.sql.functions``
so they are planned by Catalyst (constant folding, predicate pushdown) and run
inside whole-stage codegen. No Python UDFs.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


# ---------------------------------------------------------------- lists (F1, F2)

def split_list(c, sep: str = ",") -> Column:
    """``SPLIT(s, sep)`` -> array<string>. NULL stays NULL; '' gives ['']."""
    # split() takes a regex: quote the separator so '.', '|' etc. are literal.
    import re

    return F.split(as_col(c), re.escape(sep))


def has_value(arr, value) -> Column:
    """``ARRAY_CONTAINS(value, arr)`` with warehouse semantics: never NULL.

    Spark returns NULL when the array holds a NULL and no match; the
    warehouse's variant comparison returns FALSE there, and a NULL array gives
    NULL, which the reference then maps to FALSE anyway (P13).
    """
    v = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(F.array_contains(as_col(arr), v), F.lit(False))


# ------------------------------------------------------------ null handling

def blank_to_null(c) -> Column:
    """``CASE WHEN x = '' THEN NULL ELSE x END``."""
    return F.nullif(as_col(c), F.lit(""))


def null_to_false(c) -> Column:
    """``CASE WHEN x IS NULL THEN FALSE ELSE x END``."""
    return F.coalesce(as_col(c), F.lit(False))


def null_sentinel(df: DataFrame, token="\\N", columns=None) -> DataFrame:
    """Replace a sentinel string (or any of a list) by NULL in every string column.

    One projection; non-string columns cannot hold the token and pass through.
    """
    tokens = [token] if isinstance(token, str) else list(token)
    targets = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}

    def clean(name):
        c = F.col(name)
        if len(tokens) == 1:
            return F.nullif(c, F.lit(tokens[0])).alias(name)
        return F.when(~c.isin(tokens), c).alias(name)

    return df.select([clean(f.name) if f.name in targets else F.col(f.name) for f in df.schema.fields])


# ----------------------------------------------------------------------- casts

def cast_columns(df: DataFrame, spec: dict, strict: bool = False) -> DataFrame:
    """Cast columns by a ``{name: type | [type, type, ...]}`` spec in one select.

    A list is a cast chain (``x::INTEGER::BOOLEAN``). ``strict`` uses ``cast``
    (ANSI: raises on junk); the default uses ``try_cast`` (junk -> NULL).
    """
    def chain(c: Column, types) -> Column:
        if not isinstance(types, (list, tuple)):
            types = [types]
        for t in types:
            c = c.cast(t) if strict else c.try_cast(t)
        return c

    return df.select([
        chain(F.col(n), spec[n]).alias(n) if n in spec else F.col(n) for n in df.columns
    ])


# ------------------------------------------------------------- semi-structured

def variant_field(v, path: str, dtype: str | None = None) -> Column:
    """``$1:path`` on a VARIANT column; ``dtype`` casts like ``$1:path::TYPE``.

    A JSON null at ``path`` is a variant null, not SQL NULL; asking for a type
    turns it into SQL NULL, so always pass ``dtype`` before comparing or
    de-duplicating. A missing parent gives NULL.
    """
    jp = path if path.startswith("$") else "$." + path
    if dtype is None:
        return F.variant_get(as_col(v), jp, "variant")
    return F.try_variant_get(as_col(v), jp, dtype)


def json_field(s, path: str, dtype: str = "string") -> Column:
    """Field of a JSON *string* column: parse to VARIANT, then ``variant_field``."""
    return variant_field(F.try_parse_json(as_col(s)), path, dtype)


# ------------------------------------------------------------- predicates

def contains_any(c, values) -> Column:
    """True when the string contains any of ``values`` (OR of ``contains``)."""
    col = as_col(c)
    return reduce(lambda a, b: a | b, [col.contains(v) for v in values])


def ends_with(c, suffix: str) -> Column:
    return as_col(c).endswith(suffix)


def without(c, part: str) -> Column:
    """The string without any occurrence of ``part`` (``str.replace(part, '')``, F11)."""
    return F.replace(as_col(c), F.lit(part), F.lit(""))


def not_future(c, as_of=None, years_ahead: int = 1) -> Column:
    """``col <= YEAR(as_of) + 1``; NULL years fail the test (dropped by a filter).

    ``as_of`` defaults to ``current_timestamp()`` (folded to a literal by the
    optimizer and pushed into the scan). Pass a date for repeatable runs.
    """
    if as_of is None:
        ref_year = F.year(F.current_timestamp())
    else:
        if isinstance(as_of, str):
            as_of = _dt.date.fromisoformat(as_of[:10])
        ref_year = F.lit(as_of.year)
    return as_col(c) <= ref_year + F.lit(years_ahead)


def between_dates(c, lo, hi) -> Column:
    """Inclusive date window on the *date* part of ``c`` (both bounds may be equal)."""
    return F.to_date(as_col(c)).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))


# ----------------------------------------------------------------- one-hot names

def flag_name(value: str, prefix: str = "is_", suffix: str = "_genre") -> str:
    """``is_<value>_genre`` with '-' -> '_' (``Sci-Fi`` -> ``is_Sci_Fi_genre``)."""
    return f"{prefix}{value.replace('-', '_')}{suffix}"
