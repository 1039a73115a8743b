"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model reads bytes, so no vocabulary has to be chosen and a gram is one whole number: nine bits
for each of its last symbols. Blocks of documents send the distinct grams they hold to shards,
which add up the counts from trusted text; the probabilities are joins of count tables; each
block gets those of its own grams back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import stored, utf8
from sitewright.llm.exchange import ANSWERED, answers, as_table, asked_by, at_keys, blocks_of, cut_like, from_planes, join_blocks, mixed, of_kind, questions_to, replies_to, shards_of
from sitewright.session import materialise, planned_once

ORDER = 5
BITS = 9
#: Symbols: 0 stands before a text, 1 ends it, byte b is b + 2.
SYMBOLS = 257
GRAM = 0
#: Bytes of text whose grams are sorted at a time.
SLICE = 1 << 20
GRAMS = "shard int, gram long, c long"


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The gram that ends at each symbol of each text, and how many each text has."""
    data = [utf8(t) for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data)) + 1
    pad = ORDER - 1
    ends = np.cumsum(sizes + pad)
    symbols = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    own = np.ones(len(symbols), bool)
    starts = ends - sizes - pad
    own[(starts[:, None] + np.arange(pad)).ravel()] = False
    symbols[own] = 1
    inner = own.copy()
    inner[ends - 1] = False
    symbols[inner] = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64) + np.uint64(2)
    out = symbols.copy()
    for back in range(1, ORDER):
        out[back:] |= symbols[:-back] << np.uint64(BITS * back)
    return out[own], sizes


def gram_slices(texts: pa.ChunkedArray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """``grams_of`` the texts, about SLICE bytes at a time: which texts, their grams, and how many each has."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy()) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(ends)]
    for a, b in zip(cuts, cuts[1:]):
        yield slice(a, b), *grams_of(texts.slice(a, b - a).to_pylist())


def distinct_grams(texts: pa.ChunkedArray, learns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct grams of the texts, and how often each occurs in those that ``learns`` marks."""
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for which, grams, sizes in gram_slices(texts):
        own, place = np.unique(grams, return_inverse=True)
        taught = np.bincount(place[np.repeat(learns[which], sizes)], minlength=len(own)).astype(np.uint64)
        del grams, place
        merged = np.union1d(keys, own)
        total = np.zeros(len(merged), np.uint64)
        total[np.searchsorted(merged, keys)] = counts
        total[np.searchsorted(merged, own)] += taught
        keys, counts = merged, total
    return keys, counts


def _stats(grams: DataFrame) -> DataFrame:
    """One row: the discounts of counts 1, 2 and more, from how many grams have count 1 to 4."""
    n = grams.agg(*[F.sum((F.col("c") == r).cast("double")).alias(f"n{r}") for r in range(1, 5)])
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))
    found = [r - (r + 1) * y * F.try_divide(f"n{r + 1}", f"n{r}") for r in (1, 2, 3)]
    return n.select(F.lit(1).alias("one"), *[F.when((d > 0) & (d < r), d).otherwise(F.lit(r / 2)).alias(f"d{r}") for r, d in enumerate(found, 1)])


def probabilities(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(shard, gram, p) for every row of ``grams`` (shard, gram, c), c being the training count, 0 for grams only asked for.

    Modified Kneser-Ney: the highest order counts occurrences, each lower one the distinct
    grams that end so. Counts of 1, 2 and more lose a discount of their own (half of 1, 2 or
    3 where the data give none), and what a context loses goes to the next lower order; below
    single symbols all are equally likely. Each context adds up to 1.
    """
    tables = {order: grams.select("shard", "gram", "c")}
    for k in range(order - 1, 0, -1):
        tables[k] = tables[k + 1].groupBy((F.col("gram").bitwiseAND((1 << BITS * k) - 1)).alias("gram")).agg(F.sum((F.col("c") > 0).cast("long")).alias("c"))
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        own = tables[k].withColumn("context", F.shiftright("gram", BITS)).withColumn("one", F.lit(1))
        within = Window.partitionBy("context")  # as many rows as there are symbols at most
        own = own.withColumn("total", F.sum("c").over(within))
        for r, test in ((1, F.col("c") == 1), (2, F.col("c") == 2), (3, F.col("c") > 2)):
            own = own.withColumn(f"k{r}", F.sum(test.cast("int")).over(within))
        own = own.join(F.broadcast(_stats(tables[k])), "one")
        if lower is None:
            own = own.withColumn("below", F.lit(1.0 / SYMBOLS))
        else:
            own = own.withColumn("suffix", F.col("gram").bitwiseAND((1 << BITS * (k - 1)) - 1)).join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("below")), "suffix")
        off = F.when(F.col("c") > 2, F.col("d3")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d1"))
        passed = (F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total")
        p = F.when(F.col("total") == 0, F.col("below")).otherwise(F.greatest(F.col("c") - off, F.lit(0.0)) / F.col("total") + passed * F.col("below"))
        lower = own.select(*(["shard"] if k == order else []), "gram", p.alias("p"))
    return lower


SCORED = "doc_id long, lang string, trusted boolean, n_symbols long, log10_p double"


def perplexities(docs: DataFrame, trusted: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", key_col: str | None = None) -> DataFrame:
    """(doc_id, lang, trusted, n_symbols, log10_p, perplexity) of every document under a model of trusted text.

    ``trusted`` (doc_id) lists the documents to learn from, of which those with ``train`` (a
    condition on doc_id) are used. Perplexity is per symbol: bytes and one end. ``key_col`` names
    a long column that is passed on as ``key``.
    """
    spark = docs.sparkSession
    n = shards_of(spark)
    own_id = F.col(id_col).cast("long").alias("doc_id")
    texts = docs.select(own_id, F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.lit(True).alias("text_row"), *([F.col(key_col).alias("key")] if key_col else []))
    marks = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    marks = marks.select("doc_id", F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("lang"), F.lit(False).alias("text_row"), *([F.lit(None).cast("long").alias("key")] if key_col else []))
    both = texts.union(marks).withColumn("train", F.coalesce(train, F.lit(False)))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    blocks = blocks_of(both, {c: F.col(c) for c in both.columns}, [spread])

    def shard_of(grams: np.ndarray) -> np.ndarray:
        return (mixed(grams) % np.uint64(n)).astype(np.int64)

    def read(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
        is_text = rows["text_row"].to_numpy(zero_copy_only=False)
        marked = set(rows.filter(pa.array(~is_text))["doc_id"].to_pylist())
        kept = rows.filter(pa.array(is_text))
        return kept, np.array([d in marked for d in kept["doc_id"].to_pylist()], bool)

    def ask(block: int, rows: pa.Table) -> list[tuple]:
        kept, marked = read(rows)
        keys, counts = distinct_grams(kept["text"], marked & kept["train"].to_numpy(zero_copy_only=False))
        return questions_to(block, GRAM, keys, shard_of(keys), counts)[0]

    def totals(rows: pa.Table) -> pa.Table:
        _, keys, notes = of_kind(rows, GRAM)
        found, place = at_keys(keys)
        counts = np.bincount(place, weights=np.concatenate([from_planes(x, np.uint64) for x in notes]), minlength=len(found))
        return pa.table({"shard": pa.array(np.full(len(found), rows["shard"][0].as_py(), np.int32)), "gram": found.view(np.int64), "c": counts.astype(np.int64)})

    def reply(rows: pa.Table, known: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return as_table([], ANSWERED)
        asking, keys, _ = of_kind(rows, GRAM)
        held = known["gram"].to_numpy()
        order = np.argsort(held)
        place = order[np.searchsorted(held[order], np.concatenate(keys).view(np.int64))]
        found = np.log10(known["p"].to_numpy())[place].astype(np.float32)
        shard = rows["shard"][0].as_py()
        return replies_to(shard, [(b, GRAM, x) for b, x in zip(asking, cut_like(found, keys))])

    def score(block: int, rows: pa.Table, replies: pa.Table) -> list[tuple]:
        kept, marked = read(rows)
        keys, _ = distinct_grams(kept["text"], np.zeros(kept.num_rows, bool))
        logs = np.empty(len(keys), np.float32)
        logs[np.lexsort((keys, shard_of(keys)))] = answers(replies, GRAM, np.float32)
        size, total = [], []
        for _, grams, sizes in gram_slices(kept["text"]):
            own = logs[np.searchsorted(keys, grams)].astype(np.float64)
            size += sizes.tolist()
            total += np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=own, minlength=len(sizes)).tolist()
        return list(zip(kept["doc_id"].to_pylist(), kept["lang"].to_pylist(), marked.tolist(), size, total, *([kept["key"].to_pylist()] if key_col else [])))

    asked = asked_by(blocks, ask)
    found = probabilities(asked.groupBy("shard").applyInArrow(totals, GRAMS))
    replies = asked.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(reply, ANSWERED)
    scored = join_blocks(blocks, replies, score, SCORED + (", key long" if key_col else ""))
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("log10_p") / F.col("n_symbols")))


def fold(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def classify(docs: DataFrame, trusted: DataFrame, low: float = 0.05, high: float = 0.95, slack: float = 0.8, least: int = 20, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", key_col: str | None = None) -> DataFrame:
    """Perplexity of every document and whether it is kept: within the quantiles that trusted text of its language has.

    The model learns from four of five folds of the trusted documents; the fifth sets the
    bounds: the ``low`` and ``high`` quantiles of its perplexities in each language, moved
    apart by the factor 1 + ``slack``, as short texts vary more than the quantiles show. Noise lies above. Languages with fewer than
    ``least`` documents in that fold take the bounds of all languages together; without any
    document in it everything is kept.

    One row per row of ``docs``: doc_id, lang, n_symbols, perplexity, lower, upper, keep, and key if ``key_col`` names one. Null
    text counts as empty (one symbol), a null lang is a language of its own, a null doc_id is
    never trusted, repeated rows give a row each and count again in training, other columns are ignored, an empty table gives none.
    """
    with planned_once(docs.sparkSession):  # the tables of all orders go back to the same grams, ten times in all
        scored = materialise(perplexities(docs, trusted, fold() > 0, id_col, text_col, lang_col, key_col))
    sets = scored.where("trusted").where(fold() == 0)
    bounds = [F.percentile_approx("perplexity", q, 10_000) * w for q, w in ((low, 1 / (1 + slack)), (high, 1 + slack))]
    each = sets.groupBy(F.coalesce("lang", F.lit("")).alias("of"), F.col("lang").isNull().alias("no_lang")).agg(F.count("*").alias("n"), *[b.alias(k) for b, k in zip(bounds, ("lower", "upper"))])
    every = stored(sets.agg(*[b.alias(k) for b, k in zip(bounds, ("all_lower", "all_upper"))]).withColumn("one", F.lit(1)))
    out = scored.withColumn("of", F.coalesce("lang", F.lit(""))).withColumn("no_lang", F.col("lang").isNull()).withColumn("one", F.lit(1))
    out = out.join(stored(each.where(F.col("n") >= least).drop("n")), ["of", "no_lang"], "left").join(F.broadcast(every), "one")
    lower, upper = F.coalesce("lower", "all_lower"), F.coalesce("upper", "all_upper")
    keep = F.coalesce((F.col("perplexity") >= lower) & (F.col("perplexity") <= upper), F.lit(True))
    return out.select("doc_id", "lang", "n_symbols", "perplexity", lower.alias("lower"), upper.alias("upper"), keep.alias("keep"), *(["key"] if key_col else []))


def trusted_labels(labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic."""
    return labels.where((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id")
