"""Mixing sources to target weights: hierarchical budgeting in native operations.

A tree domain - language - source has documents at its leaves. A token budget is
passed down from the root: at each node it is split among the children by their
weights, no child gets more than its subtree holds (tokens times ``max_epochs``), and
what a child cannot take goes to its siblings by their weights. A shortage of a leaf is
so made up by the leaf's siblings first, and only what the whole subtree lacks by the
subtree's siblings. Each split is closed: children are sorted by capacity / weight, and
the first ones are full.

A leaf takes its documents in the order of a seeded hash of their ids, epoch after
epoch with a new order each: whole epochs as long as the budget lasts, then of one
more epoch the shortest prefix that reaches the budget. The prefix is known by the
hash of its last document, so documents are chosen where they lie. To find that
hash, tokens are summed by hash bucket; only the documents of the one bucket per leaf
in which the budget ends are sorted.

Defined results: null or blank text has no tokens and is never taken; null names are
nodes of their own; names without a weight have ``default_weight``, weights of 0 or less take
nothing; documents of equal id (null ids, too) share their place in the order, and are
taken together; extra columns pass through, and columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import count_words, lookup_join, stored

LEVELS = ("domain", "lang", "source")
BUCKET_ROWS = 2000           # documents of a hash bucket, about


def split_budget(nodes: DataFrame, parents: list[str], child: str, budget: str = "budget") -> DataFrame:
    """Split each parent's ``budget`` among its rows of ``nodes`` (parent columns, child, weight,
    capacity, budget): the budget becomes the child's share, never above its capacity."""
    w = Window.partitionBy(*parents).orderBy("_ratio", F.col(child).asc_nulls_first())
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    from_here = w.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parents)
    usable = F.col("weight") > 0
    out = nodes.withColumn("_ratio", F.when(usable, F.col("capacity") / F.col("weight")).otherwise(F.lit(-1.0)))
    weight = F.when(usable, F.col("weight")).otherwise(0.0)
    taken = F.coalesce(F.sum(F.when(usable, F.col("capacity")).otherwise(0.0)).over(before), F.lit(0.0))
    out = out.withColumn("_level", F.when(usable, (F.col(budget) - taken) / F.sum(weight).over(from_here)))
    full = usable & (F.col("_ratio") <= F.col("_level"))
    level = F.max(F.when(~full & usable, F.col("_level"))).over(whole)
    share = F.when(~usable, 0.0).when(full, F.col("capacity")).otherwise(F.greatest(F.lit(0.0), F.col("weight") * level))
    return out.withColumn("_full", full).withColumn(budget, share).drop("_ratio", "_level", "_full")


def leaf_budgets(leaves: DataFrame, weights: dict[str, dict[str, float]], total: Column, max_epochs: float = 1.0,
                 default_weight: float = 1.0, levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """(levels, tokens, budget) for ``leaves`` (levels, tokens): the root's budget is ``total``, an
    aggregate of column ``tokens``. ``weights``: by level, the weight of a name."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * F.lit(float(max_epochs)))

    def weight(level: str) -> Column:
        out = F.lit(float(default_weight))
        for name, value in weights.get(level, {}).items():
            out = F.when(F.col(level) == name, float(value)).otherwise(out)
        return out

    out = leaves.groupBy(F.lit(0).alias("_root")).agg(total.cast("double").alias("budget"))
    for depth, level in enumerate(levels, 1):
        above, here = list(levels[:depth - 1]), list(levels[:depth])
        nodes = leaves.groupBy(*here).agg(F.sum("capacity").alias("capacity")).withColumn("weight", weight(level))
        keys = [f"_{c}" for c in above]
        out = out.select(*(F.col(c).alias(f"_{c}") for c in above), "budget")
        same = F.lit(True)
        for c in above:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        nodes = nodes.join(F.broadcast(out) if depth == 1 else out, same).drop(*keys)
        out = split_budget(nodes, above or ["_one"], level) if above else split_budget(
            nodes.withColumn("_one", F.lit(0)), ["_one"], level).drop("_one")
    same = F.lit(True)
    out = out.select(*(F.col(c).alias(f"_{c}") for c in levels), "budget")
    for c in levels:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return leaves.join(out, same).select(*levels, "tokens", "budget")


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Seeded place of a document in an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"),
                             F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def _without_nulls(df: DataFrame, levels: tuple[str, ...]) -> DataFrame:
    """Levels as join keys _k0, _n0, ...: the name (empty for null) and whether it is null."""
    return df.withColumns({k: c for i, level in enumerate(levels) for k, c in (
        (f"_k{i}", F.coalesce(F.col(level).cast("string"), F.lit(""))), (f"_n{i}", F.col(level).isNull()))})


def _keys(levels: tuple[str, ...]) -> list[str]:
    return [k for i in range(len(levels)) for k in (f"_k{i}", f"_n{i}")]


def leaf_cuts(counted: DataFrame, weights: dict[str, dict[str, float]], fraction: float, max_epochs: float, seed: int,
              levels: tuple[str, ...], default_weight: float, bucket_rows: int) -> DataFrame:
    """Per leaf: _whole, the epochs taken whole, and _cut, the last order key taken of epoch _whole
    (null: none). ``counted``: _id, levels, n_tokens (more than 0)."""
    keys = _keys(levels)
    leaves = stored(counted.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")),
                    "leaves")
    budgets = leaf_budgets(leaves.drop("rows"), weights, F.sum("tokens") * fraction, max_epochs, default_weight, levels)
    sizes = _without_nulls(leaves, levels).select(*keys, "rows")
    budgets = _without_nulls(budgets, levels).join(sizes, keys).select(
        *keys, F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("_whole"), "budget", "tokens",
        F.ceil(F.col("rows") / bucket_rows).cast("long").alias("_buckets"))
    budgets = stored(budgets.withColumn("_wanted", F.col("budget") - F.col("_whole") * F.col("tokens"))
                     .drop("budget", "tokens"), "budgets")
    part = lookup_join(_without_nulls(counted, levels).select("_id", "n_tokens", *keys),
                       budgets.filter("_wanted > 0"), keys, "inner")
    part = part.withColumn("_order", order_key(seed, F.col("_whole"), F.col("_id")))
    spot = F.conv(F.substring("_order", 1, 8), 16, 10).cast("long")            # of 2^32
    part = part.withColumn("_bucket", F.floor(spot * F.col("_buckets") / float(1 << 32)).cast("long"))
    sums = part.groupBy(*keys, "_bucket").agg(F.sum("n_tokens").alias("_sum"), F.first("_wanted").alias("_goal"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    edge = stored(sums.filter("_before < _goal AND _before + _sum >= _goal").select(*keys, "_bucket", "_before"),
                  "edge-buckets")
    inside = Window.partitionBy(*keys).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    last = lookup_join(part, edge, [*keys, "_bucket"], "inner").withColumn(
        "_upto", F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    cuts = last.filter("_upto < _wanted").groupBy(*keys).agg(F.max("_order").alias("_cut"))
    return stored(budgets.select(*keys, "_whole").join(cuts, keys, "left"), "leaf-cuts")


def mix(df: DataFrame, weights: dict[str, dict[str, float]], fraction: float = 1.0, max_epochs: float = 1.0,
        seed: int = 1, doc_id: str = "doc_id", text: str = "text", levels: tuple[str, ...] = LEVELS,
        default_weight: float = 1.0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows of ``df`` that make up the mix, once per epoch that takes them, plus n_tokens (words,
    long) and epoch (int, from 0). The budget is ``fraction`` of all tokens; ``levels`` are columns of ``df``."""
    df = df.drop("n_tokens", "epoch")
    tokens = count_words(F.col(text))
    counted = stored(df.select(F.col(doc_id).alias("_id"), *levels, tokens.alias("n_tokens")).filter("n_tokens > 0"),
                     "token-counts", rebalance=True)
    cuts = leaf_cuts(counted, weights, fraction, max_epochs, seed, levels, default_weight, bucket_rows)
    rows = lookup_join(_without_nulls(df, levels).withColumn("n_tokens", tokens).filter("n_tokens > 0"),
                       cuts, _keys(levels), "inner")
    taken = F.col("_cut").isNotNull() & (order_key(seed, F.col("_whole"), F.col(doc_id)) <= F.col("_cut"))
    epochs = F.sequence(F.lit(0), F.col("_whole") - F.when(taken, 0).otherwise(1))
    rows = rows.filter((F.col("_whole") > 0) | taken).withColumn("epoch", F.explode(epochs))
    return rows.select(*df.columns, "n_tokens", "epoch")
