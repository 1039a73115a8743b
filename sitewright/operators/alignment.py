"""Multi-taxon site alignments.

An alignment is a table with one row per site and a string ``column`` that holds one
character per taxon, taxa in sorted order. Selection, classification, slicing and
recoding then work row by row without a shuffle.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions.pileup import occurrences
from sitewright.functions.text import has_two_kinds, letter, locus_name, percent, recode_gaps, valid_symbols
from sitewright.schema import ANALYTIC_SYMBOLS, CALLED_SYMBOLS, MISSING, locus_keys
from sitewright.session import local_table

COUNTS = {s: f"n_{'gap' if s == '-' else s.lower()}" for s in CALLED_SYMBOLS}
# The five output alignments and the sites each one keeps.
VARIANTS = ["all", "bi", "pi", "pi_singletons", "singletons"]


def taxa_of(calls: DataFrame) -> list:
    """Sorted taxon names (a short list: one per sequenced sample)."""
    return sorted(r[0] for r in calls.select("taxon").distinct().collect())


def site_columns(calls: DataFrame, taxa: Sequence) -> DataFrame:
    """One ``column`` string per site, with its allele counts, from the calls.

    There is at most one call per taxon and site; a second one is an error. A taxon
    without a call counts as ``N``. The group of a site has as many members as there
    are taxa.
    """
    keys = locus_keys(calls)
    slots = local_table(calls.sparkSession, [(t, i) for i, t in enumerate(taxa)], "taxon string, slot int")
    present = calls.filter(F.col("base") != MISSING).join(slots, "taxon")
    per_site = present.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("slot", "base"))).alias("seen"),
        *[F.sum(F.when(F.col("base") == s, 1).otherwise(0)).cast("int").alias(c) for s, c in COUNTS.items()],
    )

    def with_gap(entry: Column, i: Column) -> Column:
        skipped = entry["slot"] - F.coalesce(F.get("seen", i - 1)["slot"], F.lit(-1)) - 1
        again = F.raise_error(F.lit("two calls of one taxon at one site"))
        return F.when(skipped < 0, again).otherwise(F.concat(F.repeat(F.lit(MISSING), skipped), entry["base"]))

    column = F.rpad(F.array_join(F.transform("seen", with_gap), ""), len(taxa), MISSING)
    return per_site.select(*keys, column.alias("column"), *COUNTS.values())


def with_counts(sites: DataFrame) -> DataFrame:
    """Allele counts of sites that come from an alignment file."""
    counts = {c: occurrences(F.col("column"), s).cast("int") for s, c in COUNTS.items()}
    return sites.withColumns(counts)


def _number(condition) -> Column:
    """How many allele counts fulfil a condition."""
    flags = [F.when(condition(F.col(c)), 1).otherwise(0) for c in COUNTS.values()]
    return reduce(operator.add, flags)


def variable_sites(sites: DataFrame, n_taxa: int, num_missing: int | None = None) -> DataFrame:
    """Sites with at most ``num_missing`` taxa missing and two or more alleles.

    By default all but two taxa may be missing.
    """
    allowed = n_taxa - 2 if num_missing is None else num_missing
    called = reduce(operator.add, [F.col(c) for c in COUNTS.values()])
    return sites.filter((n_taxa - called <= allowed) & (_number(lambda c: c > 0) > 1))


def classify_sites(sites: DataFrame) -> DataFrame:
    """Add ``n_alleles``, ``site_class`` and ``biallelic`` to variable sites.

    A site whose alleles beyond the commonest all occur once is a singleton; one with
    some allele that occurs once is ``othersingle``; the rest are informative.
    """
    alleles, ones = _number(lambda c: c > 0), _number(lambda c: c == 1)
    kind = F.when(ones >= alleles - 1, "singleton").when(ones > 0, "othersingle").otherwise("informative")
    return sites.select(
        *[c for c in sites.columns if c not in COUNTS.values()],
        alleles.alias("n_alleles"),
        kind.alias("site_class"),
        ((ones == 0) & (alleles == 2)).alias("biallelic"),
    )


def select_variant(classified: DataFrame, variant: str) -> DataFrame:
    """Sites of one of the five output alignments."""
    kind = F.col("site_class")
    rules = {
        "all": F.lit(True),
        "bi": F.col("biallelic"),
        "pi": kind == "informative",
        "pi_singletons": kind != "singleton",
        "singletons": kind == "singleton",
    }
    return classified.filter(rules[variant])


def class_totals(classified: DataFrame) -> DataFrame:
    """One row: total, singleton, othersingle, informative and biallelic sites."""

    def tally(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    kind = F.col("site_class")
    return classified.agg(
        F.count("*").cast("bigint").alias("variable_sites"),
        tally(kind == "singleton").alias("singleton_sites"),
        tally(kind == "othersingle").alias("with_singleton_sites"),
        tally(kind == "informative").alias("informative_sites"),
        tally(F.col("biallelic")).alias("biallelic_sites"),
    )


def refilter(sites: DataFrame, missing: int, gaps: bool = True) -> DataFrame:
    """Keep variable sites with at most ``missing`` taxa uncalled (case matters).

    With ``gaps=False`` sites that show a gap go as well.
    """
    valid = valid_symbols("column", ANALYTIC_SYMBOLS)
    kept = sites.filter(has_two_kinds("column", ANALYTIC_SYMBOLS) & (F.length(valid) >= F.length("column") - missing))
    return kept if gaps else kept.filter(~F.contains("column", F.lit("-")))


def refilter_report(sites: DataFrame, missing: int) -> DataFrame:
    """Sites before and after the missing-data filter, with and without gaps: one scan."""
    valid = valid_symbols("column", ANALYTIC_SYMBOLS)
    ok = has_two_kinds("column", ANALYTIC_SYMBOLS) & (F.length(valid) >= F.length("column") - missing)
    whole = ok & ~F.contains("column", F.lit("-"))

    def tally(cond):
        return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    totals = sites.agg(F.count("*").cast("bigint").alias("before"), tally(ok).alias("gap"), tally(whole).alias("nogap"))
    rows = totals.select("before", F.expr("stack(2, 'gap', gap, 'nogap', nogap) as (variant, after)"))
    lost = F.col("before") - F.col("after")
    return rows.withColumn("lost", lost).withColumn("lost_percent", percent(lost, F.col("before")))


def slice_sites(sites: DataFrame, wanted: DataFrame) -> DataFrame:
    """Sites whose ``locus`` is listed, split into gapless and gapped ones.

    Order columns of ``sites`` stay, so outputs keep the order of the original list.
    ``recoded`` is the 0/1/N form of gapped sites.
    """
    if "locus" not in sites.columns:
        sites = sites.withColumn("locus", locus_name())
    picked = sites.join(wanted.select("locus"), "locus", "left_semi")
    gapped = F.contains("column", F.lit("-"))
    return picked.withColumn("part", F.when(gapped, "gapped").otherwise("nogaps")).withColumn(
        "recoded", F.when(gapped, recode_gaps("column"))
    )


def combined_order(sliced: DataFrame) -> Column:
    """First order key of the combined alignment: gapless sites before gapped ones."""
    return F.when(F.col("part") == "nogaps", 0).otherwise(1)


def to_calls(sites: DataFrame, taxa: Sequence) -> DataFrame:
    """Back to one row per taxon and site."""
    pairs = F.array(*[F.struct(F.lit(t).alias("taxon"), F.lit(i + 1).alias("at")) for i, t in enumerate(taxa)])
    keys = locus_keys(sites)
    return sites.withColumn("t", F.explode(pairs)).select(
        F.col("t.taxon"), *keys, letter("column", F.col("t.at")).alias("base")
    )


def taxon_blocks(sites: DataFrame, taxa: Sequence, order: Sequence[str], block: Column, column: str = "column") -> DataFrame:
    """Turn site columns into sequence pieces, ``(taxon, block, seq)``.

    ``block`` groups neighbouring sites into pieces of bounded size; ``order`` sorts the
    sites inside a piece.
    """
    member = F.struct(*order, F.col(column).alias("symbols"))
    grouped = sites.withColumn("block", block).groupBy("block").agg(F.sort_array(F.collect_list(member)).alias("members"))
    slots = F.array(*[F.struct(F.lit(i).alias("taxon_ord"), F.lit(t).alias("taxon")) for i, t in enumerate(taxa)])
    piece = F.array_join(
        F.transform("members", lambda m: letter(m["symbols"], F.col("t.taxon_ord") + 1)), ""
    )
    return grouped.withColumn("t", F.explode(slots)).select("t.taxon_ord", "t.taxon", "block", piece.alias("seq"))
