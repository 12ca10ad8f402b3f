"""Joins and the aggregates that feed them.

Scale notes that apply to every function here:

* No action while a plan is built: every function returns a lazy DataFrame.
* No broadcast hint on data of unknown size. Adaptive execution measures each
  side after its shuffle map stage and turns a sort-merge join into a broadcast
  join only when that side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
* Hot keys: group-bys use partial (map-side) aggregation, so a key holding a
  third of all rows is reduced to one row per map task before the shuffle.
  Joins get AQE skew-join splitting of oversized partitions at run time, and
  ``skew_join`` salts hot keys explicitly where AQE cannot split (the right
  side of a left outer join).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.columns import as_col


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


# ------------------------------------------------------------------- J1 / J2 / U3

def anti_by_registry(df: DataFrame, ids: DataFrame, key: str, id_key: str | None = None,
                     null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in the id registry (NOT EXISTS).

    ``null_safe=True`` also drops a NULL key when the registry holds a NULL
    (pandas ``isin`` matches NaN to NaN). One hash-partitioned anti join on the
    key columns alone; AQE broadcasts the registry only if it measures it small.
    """
    reg = ids.select(F.col(id_key or key).alias("__reg_key"))
    cond = (df[key].eqNullSafe(reg["__reg_key"]) if null_safe else df[key] == reg["__reg_key"])
    return df.join(reg, cond, "left_anti")


def append_new(df: DataFrame, target: DataFrame | None, key: str,
               target_key: str | None = None, null_aware: bool = False) -> DataFrame:
    """Rows of ``df`` to append to an insert-only table: ``key NOT IN (target keys)``.

    ``target is None`` is the first run (everything is new). With
    ``null_aware=False`` the key is assumed non-null (md5 surrogate keys) and
    this is a plain left-anti join. With ``null_aware=True`` it has exact SQL
    ``NOT IN`` semantics without the null-aware broadcast join Spark would
    plan (that broadcasts the whole target, which does not scale):

    * target empty            -> every row passes, NULL keys included
    * target holds a NULL key -> no row passes
    * otherwise               -> non-NULL keys absent from the target pass

    The two target facts come from one scalar subquery (one aggregate over
    the target, folded into the filter).
    """
    if target is None:
        return df
    tk = target.select(F.col(target_key or key).alias("__tgt_key"))
    anti = df.join(tk, df[key] == tk["__tgt_key"], "left_anti")
    if not null_aware:
        return anti
    # one scalar subquery (one scan of the target): 2 = empty, 1 = no NULL key, 0 = holds a NULL key
    state = tk.agg(F.when(F.count(F.lit(1)) == 0, F.lit(2))
                   .when(F.count_if(F.col("__tgt_key").isNull()) == 0, F.lit(1))
                   .otherwise(F.lit(0))).scalar()
    return anti.filter((state == 2) | ((state == 1) & F.col(key).isNotNull()))


# ----------------------------------------------------------------------- J3 / A1

def groups_of_size(df: DataFrame, keys, n: int = 1) -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) = n`` (partial, then final aggregate)."""
    keys = _names(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == n).drop("__n")


def unique_rows(df: DataFrame, keys, cols=None) -> DataFrame:
    """Rows whose key combination occurs exactly once, with the row's columns.

    Same result as the reference's "GROUP BY .. HAVING COUNT(*) = 1, then join
    back on the keys" but in one shuffle: each group carries ``any_value`` of
    every other column, exact when the group has one row. NULL keys are
    dropped, as the equi-join back would drop them. A hot key costs nothing
    extra: it is pre-counted map-side and then discarded.
    """
    keys = _names(keys)
    cols = [c for c in (cols or df.columns) if c not in keys]
    nonnull = F.lit(True)
    for k in keys:
        nonnull = nonnull & F.col(k).isNotNull()
    agg = (df.filter(nonnull)
           .groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in cols]))
    return agg.filter(F.col("__n") == 1).drop("__n")


# ------------------------------------------------------------------- hot keys

def skew_join(left: DataFrame, right: DataFrame, on, how: str = "inner", hot_side: str = "left",
              hot_rows: int | None = 1_000_000, key_rows: DataFrame | None = None) -> DataFrame:
    """Equi join (``inner`` or ``left``) that splits keys with more than ``hot_rows`` rows.

    The rows of ``hot_side`` are counted per key (one partially aggregated
    pass), or ``key_rows`` (keys + ``__n``) gives the exact counts when they
    are cheaper to get. A key with ``n > hot_rows`` rows gets
    ``ceil(n / hot_rows)`` buckets: its rows on the hot side go to a bucket
    each, its rows on the other side to every bucket, and the join runs on
    (keys, bucket). All other keys have one bucket. The table of hot keys has
    at most ``rows / hot_rows`` rows and is broadcast; each input is read once.

    Exact for ``inner`` and ``left``: every row meets every matching row in
    exactly one bucket. In a left join with a hot right side, the copies of a
    left row that meet nothing are dropped for hot keys: a hot key has rows on
    the right by definition, so the row appears through another bucket (right
    rows are dealt round robin by a counter per task, then by key hash, so a
    bucket may be empty, never all of them).
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_join supports inner and left joins")
    keys = _names(on)
    if hot_rows is None:
        return left.join(right, keys, how)
    if key_rows is None:
        key_rows = (left if hot_side == "left" else right).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = F.broadcast(hot_key_buckets(key_rows, keys, hot_rows))
    if hot_side == "left":
        return (_deal(left, hot, keys).join(_replicate(right, hot, keys).drop("__hot"), keys + ["__bucket"], how)
                .drop("__bucket"))
    dealt = _deal(right, hot, keys).withColumn("__met", F.lit(True))
    joined = _replicate(left, hot, keys).join(dealt, keys + ["__bucket"], how)
    return joined.filter(F.col("__met") | ~F.col("__hot")).drop("__bucket", "__hot", "__met")


def hot_key_buckets(key_rows: DataFrame, keys, hot_rows: int) -> DataFrame:
    """Keys whose row count (``__n``) exceeds ``hot_rows``, with a bucket count ``__b`` (bigint)."""
    return (key_rows.filter(F.col("__n") > hot_rows)
            .select(*_names(keys), F.ceil(F.col("__n") / F.lit(hot_rows)).cast("long").alias("__b")))


def _deal(df: DataFrame, hot: DataFrame, keys) -> DataFrame:
    """One bucket in [0, __b) per row of a hot key, 0 for other keys."""
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("__b"))
    return (df.join(hot, keys, "left")
            .withColumn("__bucket", F.coalesce(dealt, F.lit(0).cast("long"))).drop("__b"))


def _holds_unhashable(dtype: T.DataType) -> bool:
    return any(t in dtype.simpleString() for t in ("map<", "variant"))


def _replicate(df: DataFrame, hot: DataFrame, keys) -> DataFrame:
    """Each row of a hot key once per bucket, other rows once with bucket 0; ``__hot`` tells them apart.

    Rows with a NULL key meet nothing; they get a bucket of their own by a hash, so that in a left
    join many of them do not go to one task.
    """
    hashed = [f.name for f in df.schema.fields if not _holds_unhashable(f.dataType)]
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    one = F.lit(1).cast("long")
    return (df.withColumn("__apart", F.when(null, -1 - F.pmod(F.xxhash64(*hashed), F.lit(4096))))
            .join(hot, keys, "left").withColumn("__hot", F.col("__b").isNotNull())
            .withColumn("__bucket", F.explode(F.sequence(one - 1, F.coalesce("__b", one) - 1)))
            .withColumn("__bucket", F.coalesce("__apart", "__bucket")).drop("__b", "__apart"))


# ---------------------------------------------------------------- J4 / J5 / J7-J9

def left_lookup(df: DataFrame, dim: DataFrame, on, how: str = "left",
                right_on=None) -> DataFrame:
    """Equi lookup of dimension columns (``how='left'`` keeps unmatched rows).

    ``on`` names the key column(s) on ``df``; ``right_on`` the matching ones
    on ``dim`` when they differ. The dim key columns are not repeated.
    """
    left = _names(on)
    right = _names(right_on) if right_on is not None else left
    tmp = [f"__lk_{i}" for i in range(len(right))]
    alias = dict(zip(right, tmp))
    renamed = dim.select(*[F.col(c).alias(alias[c]) if c in alias else F.col(c) for c in dim.columns])
    cond = None
    for lcol, t in zip(left, tmp):
        c = df[lcol] == renamed[t]
        cond = c if cond is None else cond & c
    return df.join(renamed, cond, how).drop(*tmp)


def fanout_join(left: DataFrame, dim: DataFrame, on, right_on=None,
                hot_rows: int | None = None, key_rows: DataFrame | None = None) -> DataFrame:
    """Inner equi join that may multiply rows (same title, several dim rows).

    Fan-out is the reference's semantics and is kept; a hot title is split
    (AQE skew join at run time, or ``skew_join`` salting with ``hot_rows``),
    never dropped.
    """
    if hot_rows is None:
        return left_lookup(left, dim, on, how="inner", right_on=right_on)
    left_keys = _names(on)
    d = dim
    for lk, rk in zip(left_keys, _names(right_on) if right_on is not None else left_keys):
        d = d.withColumnRenamed(rk, lk)
    return skew_join(left, d, left_keys, "inner", hot_side="left", hot_rows=hot_rows, key_rows=key_rows)


def rated_titles(ratings: DataFrame, basics: DataFrame, key: str = "id") -> DataFrame:
    """Ratings joined to titles on the id (inner)."""
    return ratings.join(basics, key, "inner")


def join_feeds(left: DataFrame, right: DataFrame, keys, extra_keys=(),
               match_extra: bool = False, hot_rows: int | None = None,
               key_rows: DataFrame | None = None) -> DataFrame:
    """Left-join two feeds on ``keys``; ``extra_keys`` join only if ``match_extra``.

    Parity with the reference is ``match_extra=False``: a year is computed on
    both sides but the join condition names only the title (twice).
    A title hot on the left is split by AQE's skew join; ``hot_rows`` also
    splits titles hot on the *right* (``skew_join``), which AQE cannot do
    for a left outer join.
    """
    on = _names(keys) + (list(extra_keys) if match_extra else [])
    r = right
    if not match_extra:
        r = right.drop(*[c for c in extra_keys if c in right.columns])
    if key_rows is not None and match_extra:
        key_rows = None          # counts per title are not counts per (title, year)
    return skew_join(left, r, on, "left", hot_side="right", hot_rows=hot_rows, key_rows=key_rows)


# ------------------------------------------------------------------------------ J6

def array_match_join(df: DataFrame, arr_col: str, dim: DataFrame, dim_col: str,
                     dim_cols=None) -> DataFrame:
    """``df LEFT JOIN dim ON ARRAY_CONTAINS(dim.dim_col, df.arr_col)`` as equi joins.

    Exact for duplicates, NULL and empty arrays, NULL dim values, and dim
    columns of any type:

    1. distinct array values (map-side pre-aggregated),
    2. explode each distinct array's *distinct* elements and equi-join the dim,
    3. left-join rows to their array's matches on the array value: one row per
       matching dim row, or one NULL row.

    The shuffle in step 3 is keyed by the array value; a hot array value is
    a skewed left side that AQE splits. Nothing is gathered per array.
    """
    dim_cols = list(dim_cols or dim.columns)
    arrays = df.select(F.col(arr_col).alias("__arr")).distinct()
    elems = arrays.select("__arr", F.explode(F.array_distinct("__arr")).alias("__elem"))
    d = dim.select(F.col(dim_col).alias("__elem"), *[F.col(c).alias(f"__d_{c}") for c in dim_cols])
    matches = elems.join(d, "__elem", "inner").drop("__elem")
    joined = df.join(matches, df[arr_col] == matches["__arr"], "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(f"__d_{c}").alias(c) for c in dim_cols])


# ---------------------------------------------------------------- J11 / A2-A4

def flatten(df: DataFrame, arr_col: str, out: str = "value", keep=None) -> DataFrame:
    """Lateral ``FLATTEN``: one row per element; NULL and empty arrays vanish."""
    keep = [c for c in (keep if keep is not None else df.columns) if c != arr_col]
    return df.select(*keep, F.explode(F.col(arr_col)).alias(out))


def distinct_values(df: DataFrame, col, alias: str | None = None) -> DataFrame:
    """``SELECT DISTINCT col`` (NULL is one value)."""
    c = as_col(col)
    return df.select(c.alias(alias) if alias else c).distinct()


def distinct_elements(df: DataFrame, arr_col: str, out: str = "value") -> DataFrame:
    """Distinct elements of an array column, pre-reduced on distinct arrays first."""
    arrays = df.select(arr_col).distinct()
    return flatten(arrays, arr_col, out, keep=[]).distinct()

