"""Mixing sources to target weights by hierarchical budgeting. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import stored
from sitewright.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of an epoch's order that deal the documents of a leaf into ranges.
DIGITS = 3


def token_count(text: Column) -> Column:
    """Words of ``text``, as runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _exact(x: str | Column) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(38,0)")


def _parts(path: Sequence[str], weights: Mapping[tuple[str, ...], int], default: int) -> Column:
    """Weight of the node at the end of ``path``."""
    chosen = F.lit(default)
    for key, parts in weights.items():
        if len(key) == len(path):
            same = F.lit(True)
            for name, value in zip(path, key):
                same = same & (F.col(name) == value)
            chosen = F.when(same, F.lit(parts)).otherwise(chosen)
    return chosen.cast("long")


def _share(nodes: DataFrame, parent: Sequence[str], level: str) -> DataFrame:
    """Deals ``given`` of each parent among its children: weight for weight, none above its cap.

    A child is full if its cap per weight is at most what is left per weight once the children
    with a lower ratio are full. What full children lack of their share so goes to their
    siblings. Single tokens left by rounding go to the largest remainders, ties by name.
    """
    keys = [F.col(k) for k in parent] or [F.lit(0)]
    ratio = Window.partitionBy(*keys).orderBy(F.col("cap") / F.col("parts"), level)
    upto = ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = ratio.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*keys)
    out = nodes.withColumn("below", F.coalesce(F.sum(_exact("cap")).over(upto), _exact(F.lit(0)))).withColumn("weight", F.sum(_exact("parts")).over(onward))
    out = out.withColumn("full", _exact("cap") * F.col("weight") + _exact("parts") * F.col("below") <= _exact("parts") * _exact("given"))
    out = out.withColumn("left", _exact("given") - F.coalesce(F.sum(F.when(F.col("full"), _exact("cap"))).over(whole), _exact(F.lit(0)))).withColumn("open", F.sum(F.when(~F.col("full"), _exact("parts"))).over(whole))
    scaled = _exact("parts") * F.col("left")
    out = out.withColumn("base", F.when(F.col("full"), F.col("cap")).otherwise(((scaled - scaled % F.col("open")) / F.col("open")).cast("long")))
    out = out.withColumn("remainder", F.when(F.col("full"), F.lit(-1).cast("decimal(38,0)")).otherwise(scaled % F.col("open")))
    spare = F.col("given") - F.sum("base").over(whole)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("remainder"), level))
    return out.withColumn("given", F.col("base") + F.when(~F.col("full") & (rank <= spare), 1).otherwise(0))


def leaf_budgets(sizes: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int], budget: int | None, max_epochs: int, default: int = 1) -> DataFrame:
    """Tokens for every leaf of the tree: the levels, tokens, given, epochs (whole ones) and rest.

    ``weights`` gives whole-number weights to nodes by their path from the root; other nodes
    have ``default``; a node of weight 0 gets nothing. A leaf holds at most ``max_epochs`` times
    its tokens and an inner node what its children hold, so a shortage below is known above:
    it goes to siblings first, and to siblings of an ancestor only when all of them are full.
    Without ``budget`` the tokens of all documents are dealt; more than the tree holds is not given.
    """
    tables, below = {}, sizes.withColumn("cap", F.col("tokens") * max_epochs)
    for depth in range(len(levels), 0, -1):
        path = list(levels[:depth])
        nodes = below.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("parts", _parts(path, weights, default))
        below = stored(nodes.withColumn("cap", F.when(F.col("parts") > 0, F.col("cap")).otherwise(0)))
        tables[depth] = below.where("parts > 0")
    held = tables[1].agg(F.sum("cap")).scalar()
    asked = F.lit(budget) if budget is not None else sizes.agg(F.sum("tokens")).scalar()
    dealt = _share(tables[1].withColumn("given", F.least(asked, held).cast("long")), [], levels[0])
    for depth in range(2, len(levels) + 1):
        path = list(levels[: depth - 1])
        dealt = _share(tables[depth].join(dealt.select(*path, "given"), path), path, levels[depth - 1])
    out = sizes.where("tokens > 0").join(dealt.select(*levels, "given"), list(levels), "left").withColumn("given", F.coalesce("given", F.lit(0)).cast("long"))
    return out.select(*levels, "tokens", "given", F.expr("given div tokens").alias("epochs"), (F.col("given") % F.col("tokens")).alias("rest"))


def sized(docs: DataFrame, levels: Sequence[str], id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """(doc_id, name, levels, n_tokens and any key) of every document; null names of a level become ''; ``name`` is the id, or the digest of the text where there is none."""
    name = F.coalesce(F.col(id_col).cast("long").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), name.alias("name"), *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in levels], token_count(F.col(text_col).cast("string")).alias("n_tokens"), *([F.col(key_col).alias("key")] if key_col else []))


def mix(docs: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int], budget: int | None = None, max_epochs: int = 2, seed: int = 7, default: int = 1, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """Documents that meet the weights: doc_id, levels, epoch (from 0), n_tokens, take_tokens, tokens and given of the leaf.

    Every leaf gets whole epochs, then the prefix of one more that has the tokens left. An epoch
    is the leaf's documents by md5 of 'seed:epoch:doc_id' (then doc_id, then size). The document in
    which the prefix ends counts with the tokens that fit (take_tokens); a row stands for a whole
    document in one epoch. The takes of a leaf add up to its budget.

    Documents without tokens (null or empty text) are in whole epochs only; rows without doc_id are
    ordered by 'text:' and the md5 of their text in its place; repeated rows count each; ``key_col`` names a column that is passed on as ``key`` and orders what else is equal; null names of a level form the group ''; an empty table gives no rows.

    Only the ids and sizes of documents are dealt. A hot leaf is never one group: its epoch is cut
    into 4096 ranges that are summed; rows are put in order only in the range where the prefix ends,
    equal rows as one with their number.
    """
    keys = list(levels)
    thin = materialise(sized(docs, keys, id_col, text_col, key_col))
    leaves = stored(leaf_budgets(stored(thin.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens"))), keys, weights, budget, max_epochs, default))
    rows = thin.join(leaves, keys)
    whole = rows.where("epochs > 0").withColumn("epoch", F.explode(F.expr("sequence(0, cast(epochs - 1 as int))"))).withColumn("take_tokens", F.col("n_tokens"))
    part = rows.where("rest > 0").withColumn("epoch", F.col("epochs").cast("int"))
    part = part.withColumn("place", F.md5(F.concat_ws(":", F.lit(seed), "epoch", "name")))
    part = part.withColumn("range", F.substring("place", 1, DIGITS))
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = part.groupBy(*keys, "range").agg(F.sum("n_tokens").alias("held"), F.first("rest").alias("rest")).withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0)))
    ends = stored(sums.where("start < rest and start + held >= rest").select(*keys, F.col("range").alias("last"), "start"))
    part = part.join(ends, keys)
    order = Window.partitionBy(*keys).orderBy("place", "doc_id", "n_tokens", *(["key"] if key_col else [])).rowsBetween(Window.unboundedPreceding, -1)
    own = ["doc_id", "epoch", "n_tokens", "tokens", "given", *(["key"] if key_col else [])]
    edge = part.where("range = last").groupBy(*keys, "place", "rest", "start", *own).agg(F.count("*").alias("copies"))
    edge = edge.withColumn("start", F.col("start") + F.coalesce(F.sum(F.col("n_tokens") * F.col("copies")).over(order), F.lit(0))).where("start < rest")
    # copies that begin before the end of the prefix, listed a thousand at a time
    fit = F.when(F.col("n_tokens") > 0, F.least("copies", F.expr("(rest - start + n_tokens - 1) div n_tokens"))).otherwise(F.col("copies"))
    edge = edge.withColumn("fit", fit).withColumn("thousand", F.explode(F.expr("sequence(0L, (fit - 1) div 1000)")))
    edge = edge.withColumn("copy", F.explode(F.expr("sequence(thousand * 1000, least(thousand * 1000 + 999, fit - 1))"))).withColumn("start", F.col("start") + F.col("copy") * F.col("n_tokens"))
    out = [*keys, "epoch", "n_tokens", "take_tokens", "tokens", "given", *(["key"] if key_col else [])]
    picked = whole.select("doc_id", *out)
    picked = picked.union(part.where("range < last").withColumn("take_tokens", F.col("n_tokens")).select("doc_id", *out))
    return picked.union(edge.withColumn("take_tokens", F.least("n_tokens", F.col("rest") - F.col("start"))).select("doc_id", *out))
