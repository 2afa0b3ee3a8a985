"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source; its leaves are the sources of a language of a domain. A total
budget of tokens goes down the tree: each node's budget is split among its children by weight, but no
child gets more than its subtree can supply (``max_epochs`` times its tokens). What a child can't take goes
to its siblings, by weight; only what all siblings together can't take was withheld from their parent in
the first place, and so went to the parent's siblings. Budgets are whole tokens; the odd tokens that division
leaves go to the first children by md5 of the name.

A leaf with budget b and s tokens gives b div s whole epochs, and of the next epoch the documents in
front, in the order of md5(seed:epoch:id): those whose middle token lies within b mod s, so that a leaf ends as near to its
budget as whole documents allow, half a document off at most.

No node's children are held in one place: what fits is found on the different pairs of supply and weight, with
their numbers, and the children's places by name come from a range-partitioned sort.

No document order is ever held in one place: a leaf's order is cut into 4,096 ranges of md5, whose
token sums say which ranges are in, out or cut across; only rows of the cut range are sorted. Texts are
read once, for their number of words; after that only ids and counts move.

Defined cases: a null text has no tokens; such documents are in an epoch where the order reaches them
within the budget. Products of tokens and weights are decimals of 38 digits. Null domains, languages and sources are the empty name. Rows with equal ids are
documents of their own. A budget above what there is gives all of ``max_epochs``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import cut, fresh

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
RANGE_DIGITS = 3


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    """The weight by name, 1 where there is none."""
    out = F.lit(1)
    for k, w in weights.items():
        if int(w) < 1:
            raise ValueError("weights are whole numbers from 1 on")
        out = F.when(name == k, F.lit(int(w))).otherwise(out)
    return out.cast("bigint")


def fill(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """From (parent..., name, w, cap, total), total being the parent's budget: adds ``budget``.

    The windows are over a parent's different (cap, w) pairs, not over its children.
    """
    big = lambda c: F.col(c).cast("decimal(19,0)")
    pairs = children.groupBy(*parent, "cap", "w").agg(F.count("*").alias("k"), F.first("total").alias("total"))
    pairs = pairs.withColumns({"caps": big("cap") * F.col("k"), "ws": big("w") * F.col("k")})
    by = Window.partitionBy(*(parent or [F.lit(0)]))
    order = by.orderBy(F.col("cap").cast("double") / F.col("w"), "cap")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0)).cast("decimal(19,0)")
    rest, weight = big("total") - so_far("caps"), F.sum("ws").over(by).cast("decimal(19,0)") - so_far("ws")
    df = pairs.withColumn("short", (big("cap") * weight <= big("w") * rest).cast("int"))
    # the children that can't take their share come first in this order
    df = df.withColumn("short", F.min("short").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("free", (big("total") - F.sum(F.when(F.col("short") == 1, F.col("caps")).otherwise(0)).over(by)).cast("decimal(19,0)"))
    df = df.withColumn("free_w", F.sum(F.when(F.col("short") == 1, 0).otherwise(F.col("ws"))).over(by).cast("decimal(19,0)"))
    df = df.withColumn("part", F.when(F.col("short") == 1, F.col("cap")).otherwise(F.expr("CAST(w AS decimal(19,0)) * free div free_w")))
    df = df.withColumn("odd", (big("total") - F.sum(big("part") * F.col("k")).over(by)).cast("bigint")).select(*parent, "cap", "w", "short", "part", "odd")
    # a row per child, read several times from here on
    shared = cut(children.join(df, [*parent, "cap", "w"]))
    # what division leaves goes to the first, by md5 of the name, of those that could take more; places come from ranges of the md5
    takers = shared.where("short = 0 AND odd > 0").select(*parent, name, "odd", F.md5(name).alias("h")).withColumn("bin", F.substring("h", 1, RANGE_DIGITS))
    ahead = F.sum("n").over(Window.partitionBy(*(parent or [F.lit(0)])).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = takers.groupBy(*parent, "bin").agg(F.count("*").alias("n")).select(*parent, "bin", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    place = F.col("ahead") + F.row_number().over(Window.partitionBy(*parent, "bin").orderBy("h", name))
    takers = takers.join(bins, [*parent, "bin"]).withColumn("place", place).where("place <= odd").select(*parent, name, F.lit(1).alias("extra"))
    out = shared.join(takers, [*parent, name], "left")
    return out.select(*children.columns, F.least("cap", F.col("part") + F.coalesce("extra", F.lit(0))).alias("budget"))


def leaf_budgets(tokens: DataFrame, weights: Mapping[str, Mapping[str, int]], max_epochs: int, share: tuple[int, int] | None, budget: int | None) -> DataFrame:
    """From (domain, lang, source, n_tokens) rows: (domain, lang, source, supply, budget) per leaf."""
    leaves = tokens.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("supply"))
    leaves = leaves.select(*LEVELS, "supply", (F.col("supply") * max_epochs).alias("cap"))
    whole = leaves.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("s"), F.coalesce(F.sum("cap"), F.lit(0)).alias("c"))
    want = F.lit(budget) if budget is not None else F.expr(f"s * {share[0]} div {share[1]}")
    above = whole.select(F.least(want, F.col("c")).cast("bigint").alias("total"))
    parent: list[str] = []
    for level in LEVELS:
        here = [*parent, level]
        kids = leaves.groupBy(*here).agg(F.sum("cap").alias("cap")).withColumn("w", weight_of(F.col(level), weights.get(level, {})))
        # the first join is with a single row, the total; the others are on the parent's name
        kids = kids.join(above, parent) if parent else kids.crossJoin(F.broadcast(above))
        above = fill(kids, parent, level).select(*here, F.col("budget").alias("total"))
        parent = here
    return leaves.join(above, list(LEVELS)).select(*LEVELS, "supply", F.col("total").alias("budget"))


def choose(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    seed: int,
    max_epochs: int = 1,
    share: tuple[int, int] | None = None,
    budget: int | None = None,
    domain: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    keys: tuple[Column, ...] = (),
) -> DataFrame:
    """Per document: id, domain, lang, source, n_tokens, leaf_budget, copies, and ``keys`` as key0, key1 and so on.

    Either ``budget`` (tokens) or ``share`` (of all tokens, as a fraction of whole numbers) is given. ``domain`` is
    an expression, by default the column of that name.
    """
    if (share is None) == (budget is None):
        raise ValueError("give either share or budget")
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    extra = [k.alias(f"key{i}") for i, k in enumerate(keys)]
    rows = cut(
        docs.select(
            F.col(id_col).alias("id"),
            name(F.col("domain") if domain is None else domain).alias("domain"),
            name(F.col("lang")).alias("lang"),
            name(F.col("source")).alias("source"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("n_tokens"),
            *extra,
        )
    )
    plan = leaf_budgets(rows, weights, max_epochs, share, budget)
    plan = cut(plan.select(*LEVELS, "budget", F.expr("CASE WHEN supply > 0 THEN budget div supply ELSE 0 END").alias("epochs"), F.expr("CASE WHEN supply > 0 THEN budget % supply ELSE 0 END").alias("rest")))
    rows = rows.join(plan, list(LEVELS)).withColumn("h", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")))))
    rows = rows.withColumn("bin", F.substring("h", 1, RANGE_DIGITS))
    bins = rows.groupBy(*LEVELS, "bin").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.partitionBy(*LEVELS).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*LEVELS, "bin", "n", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    rows = rows.join(bins, [*LEVELS, "bin"])
    upto = F.col("ahead") + F.sum("n_tokens").over(Window.partitionBy(*LEVELS, "bin").orderBy("h", "id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0))
    across = (F.col("ahead") <= F.col("rest")) & (F.col("ahead") + F.col("n") > F.col("rest"))
    whole = rows.where(~across).withColumn("in", (F.col("ahead") + F.col("n") <= F.col("rest")).cast("bigint"))
    part = rows.where(across).withColumn("in", (2 * upto - F.col("n_tokens") <= 2 * F.col("rest")).cast("bigint"))
    out = whole.unionByName(part)
    # an epoch is begun only if a token of it is due
    began = F.when(F.col("rest") > 0, F.col("in")).otherwise(0)
    return out.select(F.col("id").alias(id_col), *LEVELS, "n_tokens", F.col("budget").alias("leaf_budget"), (F.col("epochs") + began).alias("copies"), *(f"key{i}" for i in range(len(keys))))


def mix(docs: DataFrame, weights: Mapping[str, Mapping[str, int]], seed: int, id_col: str = "doc_id", text_col: str = "text", domain: Column | None = None, **kw) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as many times as ``choose`` says.

    Rows that are equal in id, text and leaf can't be told apart: together they come as many times as ``choose`` says for all of them,
    shared out as evenly as whole numbers allow.
    """
    one, two, leaf, copies, rows_, place = fresh(docs, "clm_key0", "clm_key1", "clm_key2", "clm_copies", "clm_rows", "clm_place")
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    names = F.xxhash64(name(F.col("domain") if domain is None else domain), name(F.col("lang")), name(F.col("source")))
    key = F.xxhash64(id_col), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.lit(1)), names
    chosen = choose(docs, weights, seed, id_col=id_col, text_col=text_col, keys=key, domain=domain, **kw)
    chosen = chosen.groupBy(F.col("key0").alias(one), F.col("key1").alias(two), F.col("key2").alias(leaf)).agg(F.sum("copies").alias(copies), F.count("*").alias(rows_))
    keyed = docs.select("*", key[0].alias(one), key[1].alias(two), key[2].alias(leaf)).join(chosen.where(F.col(copies) > 0), [one, two, leaf])
    # the order among rows that are equal but for other columns doesn't matter
    keyed = keyed.withColumn(place, F.row_number().over(Window.partitionBy(one, two, leaf).orderBy(one)))
    times = F.expr(f"{copies} div {rows_}") + (F.col(place) <= F.col(copies) % F.col(rows_)).cast("bigint")
    many = keyed.where(times > 0).withColumn(place, F.explode(F.sequence(F.lit(1).cast("bigint"), times)))
    return many.drop(one, two, leaf, copies, rows_, place)
