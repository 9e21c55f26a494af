"""Mixing sources to target weights by hierarchical budgeting, in DataFrame
functions only.

A token budget goes down a tree of levels (domain, language, source).  At each
node it is shared out by the children's weights; a child cannot take more than
its subtree holds (its tokens times the allowed epochs), and what it leaves is
redistributed among its siblings; only what a whole subtree cannot take goes
back up to the ancestors' other children.  Each leaf then takes the prefix of
its seeded epochs: whole epochs first, then a prefix of the next epoch's
order.  Prefixes are found by a hash-bucketed prefix sum, so that only one
small bucket of a leaf is ever sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import NULL_ID, is_small, join_groups, ready, row_key, smallest_by

TOKEN = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, int] | None) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*[F.lit(v) for k, w in sorted(weights.items()) for v in (k, int(w))])
    return F.coalesce(table[F.col(level)], F.lit(1)).cast("long")


def share_out(children: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Budget of every child (``cap``, ``w``, and its parent's ``budget``):
    shares by weight, no child above its cap, leftovers to the siblings.
    Integer arithmetic; a share is rounded down."""
    by = Window.partitionBy(*parents)
    ordered = by.orderBy(F.col("cap") / F.col("w"), level)
    x = children.withColumn("before", F.coalesce(F.sum("cap").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    x = x.withColumn("open_w", F.sum("w").over(ordered.rowsBetween(0, Window.unboundedFollowing)))
    x = x.withColumn("full", F.col("cap") * F.col("open_w") <= F.col("w") * (F.col("budget") - F.col("before")))
    x = x.withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0)))
    x = x.withColumn("rest_w", F.sum(F.when(~F.col("full"), F.col("w"))).over(by))
    share = F.expr("((budget - taken) * w) div rest_w")
    return x.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share).cast("long")).drop("before", "open_w", "full", "taken", "rest_w")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], budget: int, max_epochs: int) -> DataFrame:
    """``levels.., tokens, n`` -> the same with ``budget`` per leaf.  A leaf
    with weight 0 anywhere on its path counts in no cap above it."""
    now, given = None, leaves
    for level in levels:
        leaves = leaves.where(_weight(level, weights.get(level)) > 0)
    for depth, level in enumerate(levels):
        parents = levels[:depth]
        nodes = leaves.groupBy(*levels[: depth + 1]).agg((F.sum("tokens") * max_epochs).cast("long").alias("cap"))
        nodes = nodes.withColumn("w", _weight(level, weights.get(level))).where("cap > 0")
        if now is None:
            nodes = nodes.withColumn("budget", F.lit(int(budget)).cast("long")).withColumn("root", F.lit(0))
            now = share_out(nodes, ["root"], level).select(level, "budget")
        else:
            now = share_out(nodes.join(now, parents), parents, level).select(*levels[: depth + 1], "budget")
    return given.join(now, levels)


def mix(
    df: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], budget_share: float = 0.5, max_epochs: int = 1,
    seed: int = 17, id_col: str = "doc_id", text_col: str = "text", rows_per_bucket: int = 2000,
) -> DataFrame:
    """``_id, _th, levels.., n_tokens, epoch, before, leaf_tokens,
    leaf_budget`` of every chosen row and epoch.

    ``levels``: the tree's columns, from the root; a value without a weight
    counts 1, weight 0 leaves a subtree out.  The budget is ``budget_share`` of
    all tokens.  In an epoch a leaf's rows are ordered by md5 of seed, epoch and
    id; a row is chosen when the tokens ``before`` it are under the budget that
    is left, so a leaf overshoots by less than a row.  Null text and texts
    without words have no tokens and ride along where they fall; null levels
    read as ''; null ids sort as their internal id; repeated rows count each.
    An empty table, or one without tokens, gives no rows."""
    ready(df.sparkSession)
    names = list(levels)
    row = [*row_key(id_col, text_col), *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()]]
    meta = df.select(*row, word_count(F.col(f"`{text_col}`")).alias("n_tokens")).checkpoint()
    leaves = meta.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n")).checkpoint()
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    small = is_small(leaves, names)
    plan = leaf_budgets(leaves, names, weights, int(total * budget_share), max_epochs)
    plan = plan.withColumn("whole", F.expr("budget div tokens")).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    plan = plan.withColumn("buckets", F.expr(f"n div {int(rows_per_bucket)} + 1")).checkpoint()
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("_id").cast("string")).cast("binary"))
    keyed = join_groups(meta, plan, names, small).withColumn("key", key)
    keyed = keyed.withColumn("bucket", F.expr("(cast(conv(substr(key, 1, 8), 16, 10) as bigint) * buckets) div 4294967296"))
    # Rows without an id share one key: their bucket is cut on by text hash, in
    # the order of (key, id, text hash), so that no cell holds them all.
    tied = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.lit(str(NULL_ID))).cast("binary"))
    piece = F.expr("((shiftright(_th, 32) + 2147483648) * buckets) div 4294967296")
    sub = F.when(F.col("key") < tied, F.lit(-1).cast("long")).when(F.col("key") == tied, piece).otherwise(F.col("buckets"))
    keyed = keyed.withColumn("cell", F.struct("bucket", sub.alias("sub"))).drop("bucket")
    # The cell in which each leaf's rest runs out, and the tokens before it.
    sums = keyed.groupBy(*names, "rest", "cell").agg(F.sum("n_tokens").alias("t"))
    upto = F.sum("t").over(Window.partitionBy(*names).orderBy("cell"))
    edge = sums.withColumn("upto", upto).where("upto >= rest and upto - t < rest").groupBy(*names)
    edge = edge.agg(F.min(F.struct("cell", (F.col("upto") - F.col("t")).alias("base"))).alias("edge")).checkpoint()
    placed = join_groups(keyed, edge, names, small, "left")
    cols = ["_id", "_th", *names, "n_tokens", "epoch", "before", F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget")]
    whole = keyed.where("whole > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, whole - 1)"))).withColumn("before", F.lit(None).cast("long"))
    early = placed.where("cell < edge.cell").withColumn("epoch", F.col("whole")).withColumn("before", F.lit(None).cast("long"))
    order = Window.partitionBy(*names).orderBy("key", "_id", "_th").rowsBetween(Window.unboundedPreceding, -1)
    last = placed.where("cell = edge.cell").withColumn("epoch", F.col("whole"))
    last = last.withColumn("before", F.col("edge.base") + F.coalesce(F.sum("n_tokens").over(order), F.lit(0))).where("before < rest")
    return whole.select(*cols).unionAll(early.select(*cols)).unionAll(last.select(*cols))


def mixed_rows(df: DataFrame, chosen: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` as often as they were chosen.  A row repeated in
    ``df`` (same id and text) was chosen per repeat: one of them, reduced inside
    each task before the shuffle, stands for all as often as all were chosen:
    the smallest by the columns that have an order."""
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), smallest_by(df, [id_col, text_col]).alias("_order"), *row_key(id_col, text_col))
    one = keyed.groupBy("_id", "_th").agg(F.min_by("_row", "_order").alias("_row"))
    copies = chosen.groupBy("_id", "_th").agg(F.count("*").alias("copies"))
    return one.join(copies, ["_id", "_th"]).withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("_row.*")
