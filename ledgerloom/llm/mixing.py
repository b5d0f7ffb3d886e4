"""Mixing sources to target weights: budgets down a tree of domain, language and source.

A parent's budget goes to its children by weight, but no child gets more than its subtree holds; what
a short child leaves goes to its siblings by their weights, and only what all of them leave goes back
to the parent's siblings.  Each leaf then takes whole epochs of its documents and a prefix of the
next epoch, whose order is seeded.  Everything is DataFrame work in whole numbers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from .storage import keep

TOKEN = r"[^\x20\x09-\x0D]+"
TREE = ["domain", "language", "origin"]
#: Leading hex digits of the order key that cut a leaf into parts, so that no leaf is ordered in one task.
PART_DIGITS = 3


@dataclass(frozen=True)
class Mix:
    """domains: sources of each domain (others: ``rest``); *_weights: positive whole numbers, ``other`` for names not listed."""

    domains: dict[str, list[str]]
    domain_weights: dict[str, int]
    language_weights: dict[str, int]
    source_weights: dict[str, int] = field(default_factory=dict)
    rest: str = "rest"
    other: int = 1
    budget: tuple[int, int] = (1, 1)  # tokens wanted, as a share of the tokens there are
    max_epochs: int = 4
    seed: int = 17


def _lookup(column: Column, values: dict[str, int], other: int) -> Column:
    case = F.lit(other)
    for name, value in values.items():
        case = F.when(column == name, value).otherwise(case)
    return case.cast("long")


def pour(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes: parent columns, name, budget (of the parent), held, weight; adds given (whole tokens).

    Children are taken by rising held / weight.  A child is full if its share of what is left
    reaches what it holds; the others share the remainder by weight, rounded down.
    """
    group = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy(F.col("held") / F.col("weight"), name)
    before = F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    marked = nodes.withColumn("_full", F.col("held") * rest <= F.col("weight") * (F.col("budget") - before))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("held"))).over(group), F.lit(0))
    weights = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(group)
    shared = marked.withColumn("_left", left).withColumn("_weights", weights)
    return shared.withColumn(
        "given", F.when(F.col("_full"), F.col("held")).otherwise(F.expr("(_left * weight) div _weights"))
    ).drop("_full", "_left", "_weights")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves: domain, language, origin, tokens; adds given."""
    held = leaves.withColumn("held", F.col("tokens") * mix.max_epochs)
    weights = (mix.domain_weights, mix.language_weights, mix.source_weights)
    top, share = mix.budget
    budgets = leaves.agg(F.expr(f"(coalesce(sum(tokens), 0L) * {top}) div {share}").alias("budget"))
    for depth, values in enumerate(weights):
        parent, name = TREE[:depth], TREE[depth]
        nodes = held.groupBy(*parent, name).agg(F.sum("held").alias("held"))
        nodes = nodes.join(budgets, parent) if parent else nodes.crossJoin(budgets)  # one row: the whole budget
        poured = pour(nodes.withColumn("weight", _lookup(F.col(name), values, mix.other)), parent, name)
        budgets = poured.select(*parent, name, F.col("given").alias("budget"))
    return leaves.join(budgets.withColumnRenamed("budget", "given"), TREE)


def mixed(
    docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """One row per document and epoch that the mix takes: id, domain, language, origin, epoch, n_tokens, taken.

    Tokens are runs of non-blanks; null text has none, and documents without tokens are never taken.
    ``taken`` is below ``n_tokens`` only for the last document of a leaf's prefix.  A null language or
    source is a name of its own, ``(none)``.  Ties in the seeded order go by id; rows that repeat an
    id follow each other.  Null ids are ordered as empty text.  ``row_col``, a number
    that tells such rows apart, is added to the result and breaks their ties.  Other columns are not read; an
    empty table gives no rows.
    """
    domain = F.lit(mix.rest)
    for name, sources in mix.domains.items():
        domain = F.when(F.col("origin").isin(sources), name).otherwise(domain)
    row = [] if row_col is None else ["row"]
    rows = keep(
        docs.select(
            F.col(id_col).alias("id"),
            *[F.col(row_col).alias(c) for c in row],
            F.coalesce(F.col(lang_col), F.lit("(none)")).alias("language"),
            F.coalesce(F.col(source_col), F.lit("(none)")).alias("origin"),
            F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN)).cast("long").alias("n_tokens"),
        )
        .filter("n_tokens > 0")
        .withColumn("domain", domain),
        "mix-tokens",
    )
    leaves = rows.groupBy(*TREE).agg(F.sum("n_tokens").alias("tokens"))
    plan = keep(
        leaf_budgets(leaves, mix).select(
            *TREE, F.expr("given div tokens").alias("epochs"), F.expr("given % tokens").alias("prefix")
        ),
        "mix-plan",
    )
    due = rows.join(plan, TREE)
    whole = due.filter("epochs > 0").select(
        "id", *row, *TREE, F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)).alias("epoch"), "n_tokens", F.col("n_tokens").alias("taken")
    )
    seeded = F.concat_ws(":", F.lit(str(mix.seed)), F.col("epochs").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    ordered = due.filter("prefix > 0").withColumn("_key", F.md5(seeded.cast("binary"))).withColumn("_part", F.substring("_key", 1, PART_DIGITS))
    parts = ordered.groupBy(*TREE, "_part").agg(F.sum("n_tokens").alias("_sum"))
    upto = Window.partitionBy(*TREE).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*TREE, "_part", F.coalesce(F.sum("_sum").over(upto), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*TREE, "_part").orderBy("_key", "id", *row).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        ordered.join(starts, [*TREE, "_part"])
        .filter("_start < prefix")
        .withColumn("_before", F.col("_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    )
    part = placed.filter("_before < prefix").select(
        "id", *row, *TREE, F.col("epochs").alias("epoch"), "n_tokens", F.least(F.col("n_tokens"), F.col("prefix") - F.col("_before")).alias("taken")
    )
    return whole.unionByName(part).withColumnRenamed("id", id_col)
