"""Type-2 history snapshots.

Two forms with the same result:

* merge form (``snapshot_check`` / ``snapshot_timestamp``): one run of a
  snapshot against an incoming batch, as a scheduled job does each day. It is
  a single full outer join of current versions with the batch on the unique
  key; each joined row emits the kept/closed old version and/or the new one
  through one ``explode``. Closed history rows are never joined again.
* history form (``scd2_history``): a whole change feed replayed at once with
  window functions (``lag`` / running ``max`` / ``lead``).

Metadata columns follow the reference's snapshot tables:
``dbt_scd_id = md5(key | updated_at)``, ``dbt_updated_at``,
``dbt_valid_from``, ``dbt_valid_to`` (NULL for the current version).
Missing keys stay current (no hard deletes).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.keys import scd_id
from marquee.session import scratch_path

# Fixed values of the reference: the snapshot metadata column names its models read.
SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = "dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"
META_COLS = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]

# Least rows of a task that sorts the rows of hot keys, once there are more of them than shuffle partitions share out.
RANGE_ROWS = 250_000


def _names(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _lit_ts(now) -> Column:
    if isinstance(now, Column):
        return now
    return F.lit(now).cast("timestamp") if isinstance(now, str) else F.lit(now)


def _any_distinct(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, [~x.eqNullSafe(y) for x, y in zip(a, b)])


# ----------------------------------------------------------------------- SN6 / SN7

def current(snapshot: DataFrame) -> DataFrame:
    """Current versions: ``dbt_valid_to IS NULL``."""
    return snapshot.filter(F.col(VALID_TO).isNull())


def as_of(snapshot: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts``: ``valid_from <= ts < coalesce(valid_to, +inf)``."""
    t = _lit_ts(ts)
    return snapshot.filter((F.col(VALID_FROM) <= t) & (F.col(VALID_TO).isNull() | (t < F.col(VALID_TO))))


def as_of_join(instants: DataFrame, versions: DataFrame, key, at: str, prefix: str = "v_",
               split_rows: int | None = 1_000_000) -> DataFrame:
    """Each row of ``instants`` with the version of its key valid at its time ``at`` (a left join; SN7 for a table).

    Version columns other than the key come with ``prefix``; they are NULL where no version is valid: before the first,
    in a gap, or for a NULL time. ``valid_from <= at < coalesce(valid_to, +inf)`` as in ``as_of``. A NULL key is a key,
    as in the histories.

    Version starts and instants are united on one time line per key, and each instant takes the last start before it:
    one shuffle and one sorted pass, no range condition in a join. Keys with more than ``split_rows`` starts and
    instants together are split into ranges of time, each range taking the last start of those before it as its carry.
    """
    keys = _names(key)
    values = [c for c in versions.columns if c not in keys]
    started = versions.filter(F.col(VALID_FROM).isNotNull() & (F.col(VALID_TO).isNull() | (F.col(VALID_FROM) < F.col(VALID_TO))))
    kind = versions.schema[VALID_FROM].dataType
    rows = started.select(*keys, F.col(VALID_FROM).alias("__at"), F.lit(0).alias("__kind"), F.struct(*values).alias("__v"))
    asked = instants.select(*keys, F.col(at).cast(kind).alias("__at"), F.lit(1).alias("__kind"),
                            F.struct(*instants.columns).alias("__i"))
    line = rows.unionByName(asked, allowMissingColumns=True)
    order = ["__at", "__kind"]
    hot = None
    if split_rows is not None and line.count() > split_rows:
        line, hot = split_hot_keys(line, keys, order, split_rows)

    def last(groups, by):
        return F.last("__v", ignorenulls=True).over(Window.partitionBy(*groups).orderBy(*by)
                                                    .rowsBetween(Window.unboundedPreceding, 0))

    met = line.select("__i", last(keys, order).alias("__v"))
    if hot is not None:
        groups = [*keys, "__chunk"]
        ends = (hot.groupBy(*groups).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__pos"))).alias("__end"))
                .select(*groups, F.last("__end", ignorenulls=True).over(
                    Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)).alias("__carry")))
        carried = _with_carry(hot.withColumn("__v", last(groups, ["__pos"])), ends, keys)
        met = met.unionByName(carried.select("__i", F.coalesce("__v", "__carry").alias("__v")))
    v, t = F.col("__v"), F.col("__i")[at].cast(kind)
    valid = v.isNotNull() & t.isNotNull() & (v[VALID_TO].isNull() | (t < v[VALID_TO]))
    return met.filter(F.col("__i").isNotNull()).select(
        "__i.*", *[F.when(valid, v[c]).alias(f"{prefix}{c}") for c in values])


# ---------------------------------------------------------------------------- SN8

def dedupe_latest(df: DataFrame, key, order) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (a list breaks ties).

    A ``max_by`` aggregate rather than ``row_number`` over a window: it is
    partially aggregated map-side, so a key holding a third of the rows is
    reduced before the shuffle instead of being sorted in one task. Put a
    unique column last in ``order`` for a deterministic winner.
    """
    keys, order = _names(key), _names(order)
    # a key whose equal values look alike is taken from the group: readers of the keys alone need no latest row
    types = {f.name: f.dataType for f in df.schema.fields}
    alike = [k for k in keys if isinstance(types.get(k), (T.StringType, T.IntegralType, T.DateType, T.TimestampType))]
    rest, ordering = [c for c in df.columns if c not in alike], [c for c in order if c not in alike]
    if not ordering:
        alike, rest, ordering = [], df.columns, order

    def struct(columns):
        return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in columns])

    # an order over all columns is the row itself
    latest = F.max(struct(ordering)) if set(ordering) == set(rest) else F.max_by(struct(rest), struct(ordering))
    rows = df.groupBy(*keys).agg(latest.alias("__r"))
    return rows.select(*[F.col("`" + c.replace("`", "``") + "`") if c in alike else F.col("__r").getField(c).alias(c)
                         for c in df.columns])


def total_order(df: DataFrame, *first: str) -> list[str]:
    """``first`` columns, then all others that can be compared: ties only between equal rows."""
    return [*first, *(f.name for f in df.schema.fields
                      if f.name not in first and not any(t in f.dataType.simpleString() for t in ("map<", "variant")))]


# ---------------------------------------------------------------- SN1 / SN2 / SN3

def _merge(snapshot: DataFrame | None, incoming: DataFrame, key, changed_fn, updated_at_fn) -> DataFrame:
    """Shared skeleton of both strategies.

    ``changed_fn(c, i)`` -> Column: does the incoming struct ``i`` replace the
    current struct ``c``. ``updated_at_fn(i)`` -> Column: the new version's
    timestamp (run time for ``check``, the row's own for ``timestamp``).
    """
    keys = _names(key)
    src_cols = [c for c in incoming.columns]
    i_struct = F.struct(*[F.col(c) for c in src_cols])

    if snapshot is None:
        ts = updated_at_fn(i_struct)
        return incoming.select(
            *src_cols,
            scd_id(keys, ts).alias(SCD_ID),
            ts.alias(UPDATED_AT),
            ts.alias(VALID_FROM),
            F.when(F.lit(False), ts).alias(VALID_TO),   # typed NULL of the timestamp type
        )

    snap_cols = src_cols + META_COLS
    hist = snapshot.filter(F.col(VALID_TO).isNotNull()).select(*snap_cols)
    cur = snapshot.filter(F.col(VALID_TO).isNull())
    types = {f.name: f.dataType for f in cur.schema.fields}

    kc = [f"__k{n}" for n in range(len(keys))]
    c = cur.select(*[F.col(k).alias(a) for k, a in zip(keys, kc)],
                   F.struct(*[F.col(x) for x in snap_cols]).alias("__c"))
    i = incoming.select(*[F.col(k).alias(a) for k, a in zip(keys, kc)],
                        F.struct(*[F.col(x).cast(types[x]).alias(x) for x in src_cols]).alias("__i"))
    j = c.join(i, kc, "full_outer")

    cs, ins = F.col("__c"), F.col("__i")
    changed = cs.isNotNull() & ins.isNotNull() & changed_fn(cs, ins)
    new_ts = updated_at_fn(ins).cast(types[VALID_FROM])

    old_row = F.struct(
        *[cs[x].alias(x) for x in src_cols],
        cs[SCD_ID].alias(SCD_ID), cs[UPDATED_AT].alias(UPDATED_AT), cs[VALID_FROM].alias(VALID_FROM),
        F.when(changed, new_ts).otherwise(cs[VALID_TO]).alias(VALID_TO))
    new_row = F.struct(
        *[ins[x].alias(x) for x in src_cols],
        scd_id([ins[k] for k in keys], new_ts).alias(SCD_ID),
        new_ts.cast(types[UPDATED_AT]).alias(UPDATED_AT), new_ts.alias(VALID_FROM),
        F.lit(None).cast(types[VALID_TO]).alias(VALID_TO))
    emit = F.array(
        F.when(cs.isNotNull(), old_row),
        F.when(ins.isNotNull() & (cs.isNull() | changed), new_row))
    rows = j.select(F.explode(F.filter(emit, lambda r: r.isNotNull())).alias("__r"))
    merged = rows.select(*[F.col(f"__r.{x}").alias(x) for x in snap_cols])
    return hist.unionByName(merged)


def snapshot_check(snapshot: DataFrame | None, incoming: DataFrame, key, check_cols, now) -> DataFrame:
    """Check strategy: a new version when any ``check_cols`` IS DISTINCT FROM the current one.

    ``now`` is the run's timestamp (``dbt_updated_at``, ``valid_from`` of new
    versions and ``valid_to`` of closed ones). Columns outside ``check_cols``
    never trigger a version. ``incoming`` must hold one row per key
    (``dedupe_latest``). Returns the complete new snapshot table.
    """
    t = _lit_ts(now)
    checks = list(check_cols)
    return _merge(snapshot, incoming, key,
                  lambda c, i: _any_distinct([c[x] for x in checks], [i[x] for x in checks]),
                  lambda i: t)


def snapshot_timestamp(snapshot: DataFrame | None, incoming: DataFrame, key, updated_at: str) -> DataFrame:
    """Timestamp strategy: a new version iff ``current.valid_from < incoming.updated_at``.

    Older or same-time arrivals are ignored (a DATE ``updated_at`` misses
    same-day edits, as in the reference). ``incoming`` must hold one row per key.
    """
    return _merge(snapshot, incoming, key,
                  lambda c, i: c[VALID_FROM] < i[updated_at],
                  lambda i: i[updated_at])


# ---------------------------------------------------------------------------- SN4

def same_key(left: DataFrame, right: DataFrame, keys, names) -> Column:
    """Join condition: ``keys`` of ``left`` equal ``names`` of ``right``, NULL being a key as in a window."""
    return reduce(lambda x, y: x & y, [left[k].eqNullSafe(right[n]) for k, n in zip(keys, names)])


def split_hot_keys(df: DataFrame, keys, order_cols, split_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows of other keys, rows of keys over ``split_rows`` rows with ``__chunk`` and ``__pos``; None if there are none).

    One partially aggregated count finds the hot keys. Their rows are range-partitioned on key and order, sorted
    within each range, and stored with their place (``__pos``) and the number of their chunk (``__chunk``): ``split_rows``
    rows in a row are a chunk. Chunks are contiguous in the order whatever its type (NULL first), and places settle the
    order of equal rows for every later step. The tasks and files follow the rows, not the number of chunks: a small
    ``split_rows`` makes many chunks, not many tasks.
    """
    names = [f"__hot{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.filter(F.col("__n") > split_rows)
    path = scratch_path(df.sparkSession, "hot-keys")
    counts.write.parquet(path)
    hot = df.sparkSession.read.schema(counts.schema).parquet(path)
    total = hot.agg(F.sum("__n")).first()[0]
    if not total:
        return df, None
    cond = same_key(df, hot, keys, names)
    ranges = min(total // split_rows, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + total // RANGE_ROWS) + 1
    rows = df.join(hot, cond, "left_semi").repartitionByRange(ranges, *keys, *order_cols).sortWithinPartitions(*keys, *order_cols)
    # the id is (task, row of the task): it grows along the order, and the rows of a task are counted in its lower 33 bits
    rows = rows.withColumn("__pos", F.monotonically_increasing_id())
    of_task = F.col("__pos").bitwiseAND(F.lit((1 << 33) - 1))
    rows = rows.withColumn("__chunk", F.col("__pos") - of_task + F.floor(of_task / F.lit(split_rows)))
    path = scratch_path(df.sparkSession, "ranges")
    rows.write.parquet(path)
    return df.join(hot, cond, "left_anti"), df.sparkSession.read.schema(rows.schema).parquet(path)


def _segmented_history(x, keys, order_cols, check_cols, updated_at):
    """Window history of rows whose keys are cut into contiguous chunks (``__chunk``) of the order, kept in ``__pos``.

    A prefix scan: windows run per (key, chunk); what a chunk needs from the rows before it (the last check
    values, or the running maximum) is one carry row per (key, chunk), windowed per key over
    its chunks and joined back on (key, chunk): the big side keeps its (key, chunk) partitioning,
    only the carries move.
    """
    o = order_cols[0]
    columns = [c for c in x.columns if c not in ("__chunk", "__pos")]

    kc = keys + ["__chunk"]
    w = Window.partitionBy(*kc).orderBy("__pos")
    wc = Window.partitionBy(*keys).orderBy("__chunk")
    if check_cols is not None:
        checks = list(check_cols)
        rows = x.select("*", F.lag(F.lit(1)).over(w).isNull().alias("__first"),
                        F.lag(F.struct(*checks)).over(w).alias("__prev"))
        summ = (x.groupBy(*kc).agg(F.max_by(F.struct(*checks), "__pos").alias("__last"))
                .select(*kc, F.lag("__last").over(wc).alias("__carry"),
                        F.lag(F.lit(1)).over(wc).isNotNull().alias("__has_prev")))
        j = _with_carry(rows, summ, keys)
        prev = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__prev"))
        changed = _any_distinct([F.col(c) for c in checks], [prev[c] for c in checks])
        ts = F.col(o)
    else:
        rows = x.select("*", F.lag(F.lit(1)).over(w).isNull().alias("__first"),
                        F.max(updated_at).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("__pm"))
        summ = (x.groupBy(*kc).agg(F.max(updated_at).alias("__cmax"))
                .select(*kc, F.max("__cmax").over(wc.rowsBetween(Window.unboundedPreceding, -1)).alias("__carry"),
                        F.lag(F.lit(1)).over(wc).isNotNull().alias("__has_prev")))
        j = _with_carry(rows, summ, keys)
        changed = F.col(updated_at) > F.greatest(F.col("__pm"), F.col("__carry"))
        ts = F.col(updated_at)
    first_overall = F.col("__first") & ~F.coalesce(F.col("__has_prev"), F.lit(False))
    kept = (j.filter(first_overall | changed).withColumn(VALID_FROM, ts)
            .select(*columns, "__chunk", "__pos", VALID_FROM))

    # valid_to: next kept row, within the chunk or else the first kept row of a later chunk
    nxt = (kept.groupBy(*kc).agg(F.min_by(VALID_FROM, "__pos").alias("__first_vf"))
           .select(*kc, F.lead("__first_vf").over(wc).alias("__next_vf")))
    # a next row may have a NULL valid_from: its presence decides, not its value
    out = _with_carry(kept.select("*", F.lead(VALID_FROM).over(w).alias("__lead"),
                                  F.lead(F.lit(True)).over(w).alias("__followed")), nxt, keys)
    return out.select(
        *columns,
        scd_id(keys, F.col(VALID_FROM)).alias(SCD_ID),
        F.col(VALID_FROM).alias(UPDATED_AT),
        F.col(VALID_FROM),
        F.when(F.col("__followed"), F.col("__lead")).otherwise(F.col("__next_vf")).alias(VALID_TO),
    )


def _with_carry(rows: DataFrame, carries: DataFrame, keys) -> DataFrame:
    """``rows`` with the carry row of their (key, chunk); a NULL key is a key."""
    names = [f"__c{i}" for i in range(len(keys))]
    c = carries.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__chunk").alias("__cc"),
                       *[x for x in carries.columns if x not in (*keys, "__chunk")])
    return rows.join(c, same_key(rows, c, keys, names) & (rows["__chunk"] == c["__cc"]), "left").drop(*names, "__cc")


def scd2_history(df: DataFrame, key, order, check_cols=None, updated_at: str | None = None,
                 tiebreak=None, split_rows: int | None = 1_000_000) -> DataFrame:
    """Replay a whole change feed into snapshot rows with window functions.

    ``order`` is the arrival column (the load time of each row). Exactly one of
    ``check_cols`` / ``updated_at`` selects the strategy:

    * check: keep the first row of a key and every row whose check columns are
      distinct from the previous row's; ``valid_from = order``.
    * timestamp: keep the first row and every row whose ``updated_at`` is
      strictly above all earlier arrivals'; ``valid_from = updated_at``.

    Equal to folding ``snapshot_check`` / ``snapshot_timestamp`` day by day
    (a skipped row always equals the current version, so comparing with the
    previous row is comparing with the current version).

    Hot keys: a key with more than ``split_rows`` rows is split into contiguous ranges of
    ``order`` and ``tiebreak`` processed by separate tasks (``split_hot_keys``, ``_segmented_history``), with the
    same result. A table of at most ``split_rows`` rows (one count) has no such key and
    is not searched for any; ``split_rows=None`` always uses one window per key.
    """
    if (check_cols is None) == (updated_at is None):
        raise ValueError("give exactly one of check_cols or updated_at")
    keys = _names(key)
    order_cols = _names(order) + (_names(tiebreak) if tiebreak else [])
    if split_rows is not None and df.count() > split_rows:      # else no key can be hot
        rest, hot = split_hot_keys(df, keys, order_cols, split_rows)
        if hot is not None:
            return _plain_history(rest, keys, order_cols, check_cols, updated_at).unionByName(
                _segmented_history(hot, keys, order_cols, check_cols, updated_at))
    return _plain_history(df, keys, order_cols, check_cols, updated_at)


def _plain_history(df, keys, order_cols, check_cols, updated_at):
    """One window per key."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order_cols])
    first = F.lag(F.lit(1)).over(w).isNull()
    if check_cols is not None:
        checks = list(check_cols)
        changed = _any_distinct([F.col(c) for c in checks], [F.lag(c).over(w) for c in checks])
        ts = F.col(order_cols[0])
    else:
        prev_max = F.max(updated_at).over(w.rowsBetween(Window.unboundedPreceding, -1))
        changed = F.col(updated_at) > prev_max
        ts = F.col(updated_at)
    kept = (df.withColumn("__keep", first | changed).filter("__keep").drop("__keep")
            .withColumn(VALID_FROM, ts))
    return kept.select(
        *df.columns,
        scd_id(keys, F.col(VALID_FROM)).alias(SCD_ID),
        F.col(VALID_FROM).alias(UPDATED_AT),
        F.col(VALID_FROM),
        F.lead(VALID_FROM).over(w).alias(VALID_TO),
    )
