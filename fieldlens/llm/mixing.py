"""Mixing sources to target weights by hierarchical budgets; DataFrame operations only.

Documents hang on the leaves of a tree of levels (domain, language, source). A leaf can give its tokens ``epochs`` times; a
node can give what its children can. From the root down, a node's budget is dealt to its children in proportion to their
weights, and no child gets more than it can give: what it lacks goes to its siblings, by weight again, until they are full
too. A node's budget never exceeds what its children can give together, so a shortage reaches an ancestor's other
children only when all siblings are full. Amounts are whole tokens, rounded down.

A leaf's budget is spent epoch by epoch: whole epochs first, then the prefix of the last epoch's seeded order (a hash of seed,
epoch and document) that holds the rest; the document across the end gives only its first tokens.

The order is never sorted as a whole: documents are counted in ranges of the hash, a running sum over
a leaf's ranges finds the one in which the budget ends, which is divided again, and only the documents of the last range are put in order.

Defined cases: a null level is the node ``(none)``; documents without tokens are not selected; rows that repeat (id, text and
levels) count as one document; a null doc_id takes part; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.llm.shared import first_rows, text_key, written

#: Ranges of the hash, as hexadecimal digits of it.
BIN_DIGITS = 4
NONE = "(none)"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for value, w in sorted(weights.items()):
        out = F.when(F.col(level) == value, w).otherwise(out)
    return out.cast("decimal(9,0)")


def deal(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children(parent..., name, can, weight, budget)``, budget being the parent's -> the same with the child's own ``budget``.

    Children fill up in the order of can / weight. One is full if the rest of the budget, dealt to it and those after
    it by weight, gives it all it can give.
    """
    sized = children.withColumn("ratio", F.col("can").cast("double") / F.col("weight").cast("double"))
    order = Window.partitionBy(*parent).orderBy("ratio", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    dealt = (sized.withColumn("rest", (F.col("budget") - F.coalesce(F.sum("can").over(before), F.lit(0))).cast("decimal(22,0)"))
             .withColumn("weights", F.sum("weight").over(onward).cast("decimal(15,0)"))
             .withColumn("place", F.row_number().over(order))
             .withColumn("full", F.expr("cast(can as decimal(22,0)) * weights <= rest * weight")))
    first = F.min(F.when(~F.col("full"), F.struct("place", "rest", "weights"))).over(Window.partitionBy(*parent))
    return (dealt.withColumn("first", first)
            .withColumn("budget", F.expr("case when first is null or place < first.place then can else cast((first.rest * weight) div first.weights as bigint) end"))
            .drop("ratio", "rest", "weights", "place", "full", "first"))


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, int]], budget_share: float, epochs: int, default: int = 1) -> DataFrame:
    """``leaves(levels..., tokens)`` -> the same with ``budget``: the leaf's tokens to select."""
    if default < 1 or any(w < 1 for level in weights for w in level.values()):
        raise ValueError("weights are whole numbers from 1")
    nodes = leaves.withColumn("can", F.col("tokens") * epochs)
    total = leaves.agg(F.sum("tokens").alias("all"))
    placed = total.select(F.least((F.col("all") * budget_share).cast("long"), F.col("all") * epochs).alias("budget"))
    for depth, level in enumerate(levels):
        own = nodes.groupBy(*levels[:depth + 1]).agg(F.sum("can").alias("can")).withColumn("weight", _weight(level, weights[depth], default))
        above = levels[:depth]
        children = own.join(placed, above) if above else own.join(F.broadcast(placed))
        placed = deal(children, above, level).select(*levels[:depth + 1], "budget")
    return leaves.join(placed, levels)


#: Leaves up to which their plan is broadcast; a tree of more is joined by shuffling.
PLAN_ROWS = 100_000


def _planned(rows: DataFrame, plan: DataFrame, levels: list[str]) -> DataFrame:
    """``rows`` with their leaf's plan. A leaf may hold any share of the rows, so they are not dealt by leaf while the plan is small, which is counted."""
    return rows.join(F.broadcast(plan) if plan.count() <= PLAN_ROWS else plan, levels)


def _order(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def select(docs: DataFrame, levels: list[str], weights: list[dict[str, int]], budget_share: float = 0.6, epochs: int = 3, seed: int = 11,
           doc_id: str = "doc_id", text: str = "text", attach: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``(doc_id, text_key, levels..., copies, n_tokens, epoch, tokens_taken)``: a row for each document and epoch it is selected in.
    ``attach`` adds levels that ``docs`` lacks to rows without texts, so that a join for them moves no text."""
    held = [F.col(c).cast("string").alias(c) for c in levels if c in docs.columns]
    counted = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("text_key"), *held, token_count(F.col(text)).alias("n_tokens"))
    narrow = attach(counted).select("doc_id", "text_key", *[F.coalesce(F.col(c), F.lit(NONE)).alias(c) for c in levels], "n_tokens")
    rows = written(narrow.where("n_tokens > 0").groupBy(*narrow.columns).agg(F.count("*").alias("copies")), "mix-rows")
    leaves = written(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "mix-leaves")
    plan = (leaf_budgets(leaves, levels, weights, budget_share, epochs)
            .select(*levels, F.expr("cast(budget div tokens as int)").alias("whole"), F.expr("budget % tokens").alias("part")))
    plan = written(plan, "mix-plan")
    # the range in which a budget ends is found two digits at a time, so a leaf's running sum has at most 256 rows each time
    plan = plan.withColumns({"bin": F.lit(""), "start": F.lit(0).cast("long")})
    for digits in range(2, BIN_DIGITS + 1, 2):
        marked = _planned(rows, plan, levels).withColumn("h", _order(seed, F.col("whole") + 1))
        bins = (marked.where((F.col("part") > 0) & F.col("h").startswith(F.col("bin"))).groupBy(*levels, "part", "start", F.substring("h", 1, digits).alias("b"))
                .agg(F.sum("n_tokens").alias("tokens")))
        run = Window.partitionBy(*levels).orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
        ends = (bins.withColumn("at", F.col("start") + F.coalesce(F.sum("tokens").over(run), F.lit(0)))
                .where((F.col("at") < F.col("part")) & (F.col("at") + F.col("tokens") >= F.col("part"))).select(*levels, F.col("b").alias("bin"), F.col("at").alias("start")))
        plan = written(plan.drop("bin", "start").join(ends, levels, "left"), "mix-ends")
    marked = _planned(rows, plan, levels).withColumn("h", _order(seed, F.col("whole") + 1)).withColumn("b", F.substring("h", 1, BIN_DIGITS))
    out = [*("doc_id", "text_key"), *levels, "copies", "n_tokens"]
    whole = marked.where("whole > 0").select(*out, F.explode(F.sequence(F.lit(1), F.col("whole"))).alias("epoch"), F.col("n_tokens").alias("tokens_taken"))
    within = marked.where("b < bin").select(*out, (F.col("whole") + 1).alias("epoch"), F.col("n_tokens").alias("tokens_taken"))
    inside = Window.partitionBy(*levels).orderBy("h", "doc_id", "n_tokens", "text_key").rowsBetween(Window.unboundedPreceding, -1)
    # the few documents of the ranges where budgets end, written first: else the join would deal all rows by leaf for the window
    edge = written(marked.where("b = bin"), "mix-edge")
    last = (edge.withColumn("left", F.col("part") - F.col("start") - F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .where("left > 0").select(*out, (F.col("whole") + 1).alias("epoch"), F.least("left", "n_tokens").alias("tokens_taken")))
    return whole.unionByName(within).unionByName(last)


def selected(docs: DataFrame, chosen: DataFrame, doc_id: str = "doc_id", text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (from ``select``) names, once for each epoch, with the columns ``also`` of ``chosen``, epoch,
    n_tokens and tokens_taken. A row is known by its id, its text and those of the levels that ``docs`` holds; of rows that share them one is taken."""
    extra = [*also, "epoch", "n_tokens", "tokens_taken"]
    mine = [c for c in docs.columns if c not in extra]
    levels = [c for c in chosen.columns if c in mine and c not in ("doc_id", "text_key", "copies")]
    names = chosen.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), *[F.col(c).alias(f"_at_{c}") for c in levels], "copies", *extra)

    def those(part: DataFrame, base: DataFrame, how: str = "inner") -> DataFrame:
        held, named = base.alias("held"), part.alias("named")
        same = F.col(f"held.`{doc_id}`").eqNullSafe(F.col("named._id")) & (text_key(F.col(f"held.`{text}`")) == F.col("named._key"))
        for c in levels:
            same = same & (F.coalesce(F.col(f"held.`{c}`").cast("string"), F.lit(NONE)) == F.col(f"named.`_at_{c}`"))
        joined = held.join(named, same, how)
        return joined if how == "left_semi" else joined.select(*[F.col(f"held.`{c}`") for c in mine], *[F.col(f"named.{c}") for c in extra])

    again = names.where("copies > 1")
    once = again.select("_id", "_key", *[f"_at_{c}" for c in levels]).distinct()
    repeated = first_rows(those(once, docs, "left_semi"), doc_id, text, levels)
    return those(names.where("copies = 1"), docs).unionByName(those(again, repeated))
