"""Mixing sources to target weights through a tree of domains, languages and sources.

A budget of tokens goes down the tree. At every node the children share it by weight,
but none gets more than its subtree holds in all its epochs; what one cannot use goes to
its siblings first, and only what a whole subtree cannot use reaches the siblings of its
parent. A leaf's budget is a number of whole epochs and a prefix of one more. An epoch is
an order of the leaf's documents by a seeded digest; the prefix ends before the document
that would exceed the budget. The cut is found from totals by the first three digits of
the digest, so only the documents that share the cut's digits are ever put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.llm.stored import SENT_KEYS, free_names, written

DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def shared_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """``nodes(weight, room, total)`` with ``budget``: each parent's total shared by weight within the rooms."""
    ratio = F.when(F.col("weight") > 0, F.col("room") / F.col("weight"))
    # A constant where there is no parent: the children of the root are few.
    group = Window.partitionBy(*(parent or [F.lit(0)]))
    order = group.orderBy(F.asc_nulls_last("_ratio"), "_path")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        nodes.withColumn("_ratio", ratio)
        .withColumn("_used", F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("room"))).over(before), F.lit(0)))
        .withColumn("_open", F.sum("weight").over(after))
    )
    full = (F.col("weight") > 0) & (F.col("_ratio") * F.col("_open") + F.col("_used") <= F.col("total"))
    filled = ranked.withColumn("_full", full)
    spent = F.coalesce(F.sum(F.when(F.col("_full"), F.col("room"))).over(group), F.lit(0))
    weights = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(group)
    level = (F.col("total") - spent) / weights
    budget = F.when(F.col("_full"), F.col("room").cast("double")).when(F.col("weight") > 0, F.col("weight") * level).otherwise(0.0)
    return filled.withColumn("budget", budget).drop("_ratio", "_used", "_open", "_full")


def leaf_budgets(leaves: DataFrame, path: list[str], weights: list[Column], total: int | float, epochs: int) -> DataFrame:
    """``path, tokens, budget`` (whole tokens) for ``leaves(path, tokens)``; ``weights[i]`` reads ``path[: i + 1]``."""
    above = None
    for depth in range(1, len(path) + 1):
        here = path[:depth]
        nodes = leaves.groupBy(*here).agg((F.sum("tokens") * epochs).alias("room"))
        nodes = nodes.withColumn("weight", weights[depth - 1].cast("double")).withColumn("_path", F.to_json(F.struct(*here)))
        if above is None:
            nodes = nodes.withColumn("total", F.lit(float(total)))
        else:
            keys = here[:-1]
            parent = above.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(keys)], F.col("budget").alias("total"))
            same = [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(keys)]
            nodes = nodes.join(parent, same).drop(*[f"_p{i}" for i in range(len(keys))])
        above = shared_out(nodes, here[:-1])
    return above.select(*path, (F.col("room") / epochs).cast("long").alias("tokens"), F.floor("budget").alias("budget"))


def place(seed: int, epoch: Column, key: Column) -> Column:
    """The digest that orders an epoch."""
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(key.cast("string"), F.lit("null"))))


def chosen(docs: DataFrame, path: list[str], weights: list[Column], total: float, epochs: int, seed: int) -> DataFrame:
    """``doc_id, path, n_tokens, copies``: how often each document is taken, 0 included.

    ``total`` is the budget as a share of all tokens. A null in the path is a node of
    its own; a null or empty text has no tokens and is taken in every whole epoch and,
    by its place, in the prefix. Rows that repeat a key and a text share their place
    and are taken together, so their budget may be passed by the copies.
    """
    slim = written(
        docs.select("doc_id", *path, token_count().alias("n_tokens"), F.xxhash64("doc_id", "text").alias("_row")), "mix-rows"
    )
    leaves = slim.groupBy(*path).agg(F.sum("n_tokens").alias("tokens"))
    every = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = leaf_budgets(leaves, path, weights, total * every, epochs)
    plan = plan.withColumn("_whole", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0))
    plan = plan.withColumn("_rest", F.col("budget") - F.col("_whole") * F.col("tokens"))
    plan = written(plan.withColumn("_leaf", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in path])), "mix-plan")
    leaf = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in path])
    # One row for each leaf: sent to all executors where they are counted to be few.
    few = plan.count() <= SENT_KEYS
    sent = lambda df: F.broadcast(df) if few else df
    rows = slim.withColumn("_leaf", leaf).join(sent(plan.select("_leaf", "_whole", "_rest")), "_leaf")
    rows = rows.withColumn("_place", place(seed, F.col("_whole"), F.col("doc_id"))).withColumn("_head", F.substring("_place", 1, DIGITS))
    heads = rows.groupBy("_leaf", "_head").agg(F.sum("n_tokens").alias("_sum"), F.first("_rest").alias("_rest"))
    running = Window.partitionBy("_leaf").orderBy("_head")
    cuts = heads.withColumn("_end", F.sum("_sum").over(running)).filter(F.col("_end") > F.col("_rest"))
    cuts = cuts.groupBy("_leaf").agg(F.min(F.struct("_head", (F.col("_end") - F.col("_sum")).alias("base"))).alias("_cut"))
    placed = rows.join(sent(cuts), "_leaf", "left")
    near = Window.partitionBy("_leaf").orderBy("_place", "_row")
    last = (
        placed.filter(F.col("_head") == F.col("_cut._head"))
        .select("_row", "_rest", "_cut", (F.col("_cut.base") + F.sum("n_tokens").over(near)).alias("_end"))
        .filter(F.col("_end") <= F.col("_rest")).select("_row").distinct()
    )
    last = written(last.withColumn("_in", F.lit(1)), "mix-last")
    kept = placed.join(F.broadcast(last) if last.count() <= SENT_KEYS else last, "_row", "left")
    before = F.col("_cut").isNull() | (F.col("_head") < F.col("_cut._head"))
    extra = F.when(before, 1).otherwise(F.coalesce("_in", F.lit(0)))
    # Where the budget is whole epochs there is no prefix.
    extra = F.when(F.col("_rest") > 0, extra).otherwise(0)
    return kept.select("doc_id", *path, "n_tokens", (F.col("_whole") + extra).cast("int").alias("copies"), "_row")


def mixed_documents(docs: DataFrame, path: list[str], weights: list[Column], total: float, epochs: int, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, each as often as it was chosen, with all their columns, whatever their names."""
    row, copies, copy = free_names(docs, "_row", "_copies", "_copy")
    taken = chosen(docs, path, weights, total, epochs, seed).groupBy("_row").agg(F.max("copies").alias(copies)).filter(F.col(copies) > 0)
    taken = written(taken.withColumnRenamed("_row", row), "mix-taken")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    joined = keyed.join(F.broadcast(taken) if taken.count() <= SENT_KEYS else taken, row)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), copies))).select(*docs.columns)
