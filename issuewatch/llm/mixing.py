"""Mixing sources to target weights: hierarchical budgets over domain, language, source.

A token budget runs down the tree. Among siblings it is shared by weight; a node that
cannot use its share (its leaves' tokens times `max_epochs`) passes the rest to its
siblings first, and only what a whole sibling group cannot use goes to the parent's
siblings. Each leaf then takes whole epochs, and of one more epoch the documents of a
token prefix in that epoch's seeded order.

All arithmetic is on integers, so a result does not depend on the order of a sum.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, words

#: Levels of the tree, from the root.
LEVELS = ("domain", "lang", "source")
#: A leaf's documents are cut into 16**HEX buckets of the seeded order, so that no task
#: ranks a whole leaf.
HEX = 3


def weight_of(level: Column, weights: Mapping[str, int]) -> Column:
    """The integer weight of a node by its name; 1 for names that `weights` lacks (null too)."""
    out = F.lit(1).cast("long")
    for name, weight in weights.items():
        out = F.when(level.eqNullSafe(F.lit(name)), F.lit(weight).cast("long")).otherwise(out)
    return out


def share_out(nodes: DataFrame, parents: list[str], name: str, budget: Column) -> DataFrame:
    """Split `budget` (of each sibling group) over the nodes by weight `w`, at most `cap` each.

    Nodes with the smallest cap for their weight fill up first; what they leave is shared
    by weight among the rest. Adds `got`.
    """
    near = [F.expr("case when w > 0 then cap / w else 1e300D end"), F.col(name)]
    group = Window.partitionBy(F.lit(0), *parents)
    upto = group.orderBy(*near).rowsBetween(Window.unboundedPreceding, -1)
    rest = group.orderBy(*near).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumn("b", budget).withColumn("used", F.coalesce(F.sum("cap").over(upto), F.lit(0))).withColumn("w_rest", F.sum("w").over(rest))
    full = F.expr("w = 0 or cap * w_rest <= (b - used) * w")
    nodes = nodes.withColumn("full", full)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nodes = nodes.withColumn("full_cap", F.sum(F.expr("case when full then cap else 0 end")).over(whole))
    nodes = nodes.withColumn("open_w", F.sum(F.expr("case when full then 0 else w end")).over(whole))
    got = F.expr("case when full then cap else ((b - full_cap) * w) div open_w end")
    return nodes.withColumn("got", got).drop("b", "used", "w_rest", "full", "full_cap", "open_w")


def allocate(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]], budget_percent: int, max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens) -> the same with `quota`, the tokens each leaf may take.

    The budget is `budget_percent` of all tokens. One row per leaf: small, whatever the
    number of documents.
    """
    tree = leaves.select(*LEVELS, "tokens")
    for level in LEVELS:
        tree = tree.withColumn(f"w_{level}", weight_of(F.col(level), weights.get(level, {})))
    usable = F.least(*[F.least(F.col(f"w_{x}"), F.lit(1)) for x in LEVELS])  # 0 under a node of weight 0
    tree = tree.withColumn("leaf_cap", F.col("tokens") * max_epochs * usable)
    tree = tree.withColumn("got", F.expr(f"sum(tokens) over (partition by 0) * {int(budget_percent)} div 100"))
    for k, level in enumerate(LEVELS):
        parents = list(LEVELS[:k])
        keys = [*parents, level]
        node = tree.groupBy(*keys).agg(F.sum("leaf_cap").alias("cap"), F.max(f"w_{level}").alias("w"), F.max("got").alias("budget"))
        node = share_out(node, parents, level, F.col("budget")).select(*[F.col(x).alias(f"k_{x}") for x in keys], F.col("got").alias("next"))
        same = [F.col(x).eqNullSafe(F.col(f"k_{x}")) for x in keys]
        on = same[0]
        for x in same[1:]:
            on = on & x
        tree = tree.join(node, on).withColumn("got", F.col("next")).select(*LEVELS, "tokens", *[f"w_{x}" for x in LEVELS], "leaf_cap", "got")
    return tree.select(*LEVELS, "tokens", F.col("got").alias("quota"))


def mix(
    docs: DataFrame,
    domain: Column,
    weights: Mapping[str, Mapping[str, int]],
    budget_percent: int = 60,
    max_epochs: int = 4,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: (`id_col`, domain, lang, source, n_tokens, copies).

    `copies` (0 to `max_epochs`) is how often the mix holds the document: the leaf's whole
    epochs, and one more if the document lies in the token prefix of the next epoch. That
    epoch's order is the md5 of "seed:epoch:id"; the prefix holds the documents up to the
    last whose running token sum (rows of one id together) is within the leaf's rest.

    `domain` is an expression over the columns of `docs`; `weights` has integers by level
    (domain, lang, source) and name, 1 for names it lacks. Tokens are white-space words; a
    null text has none. A null domain, language or source is a node of its own, a null id
    counts as the empty text. Repeated rows each count and are taken together. An empty
    table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"),
        domain.alias("domain"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("n_tokens"),
    )
    rows = materialise(rows, "sizes")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    quota = allocate(leaves, weights, budget_percent, max_epochs)
    epochs = F.expr(f"case when tokens = 0 then 0 else least(quota div tokens, {max_epochs}) end")
    quota = quota.withColumn("epochs", epochs).withColumn("rest", F.expr(f"case when quota = 0 or epochs = {max_epochs} then -1 else quota - epochs * tokens end"))
    quota = materialise(quota.select(*[F.col(x).alias(f"k_{x}") for x in LEVELS], "epochs", "rest"), "quota")
    on = F.col("domain").eqNullSafe(F.col("k_domain")) & F.col("lang").eqNullSafe(F.col("k_lang")) & F.col("source").eqNullSafe(F.col("k_source"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    rows = rows.join(quota, on).withColumn("key", key).withColumn("bucket", F.substring("key", 1, HEX))
    # running sums by bucket, then within the one bucket where a leaf's rest ends
    sums = rows.groupBy("k_domain", "k_lang", "k_source", "bucket").agg(F.sum("n_tokens").alias("n"))
    up_to = Window.partitionBy("k_domain", "k_lang", "k_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("end", F.sum("n").over(up_to))
    sums = sums.select(*[F.col(f"k_{x}").alias(f"s_{x}") for x in LEVELS], F.col("bucket").alias("s_bucket"), (F.col("end") - F.col("n")).alias("base"), "end")
    same = F.col("bucket") == F.col("s_bucket")
    for x in LEVELS:
        same = same & F.col(f"k_{x}").eqNullSafe(F.col(f"s_{x}"))
    rows = rows.join(sums, same)
    split = F.expr("base <= rest and end > rest")
    within = Window.partitionBy("k_domain", "k_lang", "k_source", "bucket").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    out = [F.col("id").alias(id_col), "domain", "lang", "source", "n_tokens"]
    sure = rows.where(~split).select(*out, (F.col("epochs") + F.expr("case when end <= rest then 1 else 0 end")).alias("copies"))
    ranked = rows.where(split).withColumn("upto", F.col("base") + F.sum("n_tokens").over(within))
    return sure.unionAll(ranked.select(*out, (F.col("epochs") + F.expr("case when upto <= rest then 1 else 0 end")).alias("copies")))


def take_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of `docs` as often as `mixed` (from `mix` over the same rows) holds them."""
    copies = mixed.groupBy(F.col(id_col).alias("__id")).agg(F.max("copies").alias("__copies")).where("__copies > 0")
    taken = docs.join(copies, docs[id_col].eqNullSafe(copies["__id"]))
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*[docs[c] for c in docs.columns])
