"""Hash keys: md5 surrogate keys and SCD2 version ids.

Both are pure column expressions (``md5`` + ``concat_ws``), so they stay inside
whole-stage codegen. The text form of each part is Spark's ``cast(.. as
string)``: ISO dates, so a key over (title, DATE) equals the one a warehouse
computes over the same values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.columns import as_col

# Fixed values of the reference's key macros: part separator and NULL stand-in.
SURROGATE_SEPARATOR = "-"
SCD_ID_SEPARATOR = "|"
NULL_PART = ""


def _parts(cols) -> list[Column]:
    return [F.coalesce(as_col(c).cast("string"), F.lit(NULL_PART)) for c in cols]


def _name_sql(name: str) -> str:
    # the same reference F.col(name) makes: dots select nested fields
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _hash_key(cols, sep: str) -> Column:
    if all(isinstance(c, str) for c in cols):
        # column names: one SQL expression (one JVM call instead of several per part)
        parts = ", ".join(f"coalesce(cast({_name_sql(c)} as string), '{NULL_PART}')" for c in cols)
        return F.expr(f"md5(concat_ws('{sep}', {parts}))")
    return F.md5(F.concat_ws(sep, *_parts(cols)))


def surrogate_key(*cols) -> Column:
    """md5 of the parts joined by '-', NULL parts as ''.

    Known collisions are kept on purpose (they are the reference's keys):
    NULL and '' give the same key, and ('a-b', 'c') equals ('a', 'b-c').
    """
    if len(cols) == 1 and isinstance(cols[0], (list, tuple)):
        cols = tuple(cols[0])
    return _hash_key(cols, SURROGATE_SEPARATOR)


def scd_id(key_cols, updated_at) -> Column:
    """Version id of a snapshot row: md5(key | updated_at)."""
    if not isinstance(key_cols, (list, tuple)):
        key_cols = [key_cols]
    return _hash_key([*key_cols, updated_at], SCD_ID_SEPARATOR)
