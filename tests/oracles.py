"""Literal forms of operators, used as test oracles and in ``scripts/forms.py`` only."""

from pyspark.sql import functions as F

from marquee.operators.joins import groups_of_size


def unique_rows_selfjoin(df, keys, cols=None):
    """J3 in two passes: count the groups, then join the single ones back."""
    cols = [c for c in (cols or df.columns) if c not in keys]
    return groups_of_size(df, keys, 1).join(df.select(*keys, *cols), keys, "inner")


def array_match_join_theta(df, arr_col, dim, dim_col, dim_cols=None):
    """J6 as a theta join (nested loops)."""
    dim_cols = list(dim_cols or dim.columns)
    d = dim.select(F.col(dim_col).alias("__elem"), *[F.col(c).alias(f"__d_{c}") for c in dim_cols])
    j = df.join(d, F.array_contains(F.col(arr_col), F.col("__elem")), "left")
    return j.select(*df.columns, *[F.col(f"__d_{c}").alias(c) for c in dim_cols])
