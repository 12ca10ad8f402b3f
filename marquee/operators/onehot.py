"""One-hot flags over an array column."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.functions.columns import flag_name


def _sql_string(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_name(n: str) -> str:
    return "`" + n.replace("`", "``") + "`"


def one_hot(df: DataFrame, array_col: str, values, name_fn=flag_name, keep=None,
            place_before: str | None = None) -> DataFrame:
    """Add one boolean flag per value: does ``array_col`` contain it.

    One projection (a ``withColumn`` loop would grow the plan once per value),
    written as SQL expressions so a wide list costs one call to the JVM. Flags
    are never NULL: a NULL array gives FALSE, as the reference's ``CASE WHEN
    flag IS NULL THEN FALSE``; the expression is the one ``has_value`` builds.
    ``keep`` lists the columns to carry (default: all); flags are placed
    before ``place_before`` if given, else at the end.
    """
    keep = list(keep if keep is not None else df.columns)
    arr = _sql_name(array_col)
    flags = [f"coalesce(array_contains({arr}, {_sql_string(v)}), false) AS {_sql_name(name_fn(v))}"
             for v in values]
    cols = [_sql_name(c) for c in keep]
    if place_before and place_before in keep:
        i = keep.index(place_before)
        return df.selectExpr(*cols[:i], *flags, *cols[i:])
    return df.selectExpr(*cols, *flags)
