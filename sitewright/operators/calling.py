"""From pileup evidence to one base per taxon and site, with quality accounting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions import pileup as P
from sitewright.functions.text import percent
from sitewright.schema import LOCUS, MISSING, PILEUP_SYMBOLS

COUNT_COLUMNS = {b: f"n_{'del' if b == '*' else b.lower()}" for b in PILEUP_SYMBOLS}


def _counts() -> dict:
    return {b: F.col(c) for b, c in COUNT_COLUMNS.items()}


def decode_pileup(pileup: DataFrame) -> DataFrame:
    """Add ``decoded`` to pileup rows that have depth."""
    seen = pileup.filter(F.col("depth") > 0).withColumn("_seen", P.without_starts(F.col("bases")))
    return seen.withColumn("decoded", P.decode(F.col("ref"), F.col("_seen"))).drop("_seen")


def depth_mismatches(pileup: DataFrame) -> DataFrame:
    """Pileup rows whose decoded length differs from the stated depth."""
    decoded = decode_pileup(pileup)
    return decoded.filter(F.length("decoded") != F.col("depth"))


def pool_evidence(pileup: DataFrame) -> DataFrame:
    """Votes per taxon and site when a site may have several pileup rows.

    Votes are counted per row and added up with map-side partial sums, so a site that
    holds a large share of all rows costs one short record per input task.
    """
    decoded = decode_pileup(pileup)
    votes = decoded.select("taxon", *LOCUS, *[n.alias(COUNT_COLUMNS[b]) for b, n in P.vote_counts(F.col("decoded")).items()])
    return votes.groupBy("taxon", *LOCUS).agg(*[F.sum(c).alias(c) for c in COUNT_COLUMNS.values()])


def majority_from_votes(votes: DataFrame) -> DataFrame:
    """Majority base per taxon and site from pooled votes."""
    return votes.select("taxon", *LOCUS, P.majority_base(_counts()).alias("base")).filter(F.col("base").isNotNull())


def majority_from_pileup(pileup: DataFrame) -> DataFrame:
    """Majority base from one pileup row per taxon and site: no shuffle."""
    decoded = decode_pileup(pileup)
    base = P.majority_base(P.vote_counts(F.col("decoded")))
    return decoded.select("taxon", *LOCUS, base.alias("base")).filter(F.col("base").isNotNull())


def calls_from_votes(votes: DataFrame, minread: int, thresh: float) -> DataFrame:
    """Thresholded calls from pooled votes (``thresh`` above 0.5)."""
    called = votes.withColumn("c", P.call(_counts(), minread, thresh))
    return called.select("taxon", *LOCUS, "c.base", "c.penalty")


def calls_from_pileup(pileup: DataFrame, minread: int, thresh: float) -> DataFrame:
    """Thresholded calls from one pileup row per taxon and site: no shuffle."""
    d = F.col("decoded")
    called = decode_pileup(pileup).withColumn("c", P.call(P.vote_counts(d), minread, thresh, P.first_positions(d)))
    return called.select("taxon", *LOCUS, "c.base", "c.penalty")


def call_vectors(sites: DataFrame, calls: DataFrame, taxa: Sequence) -> DataFrame:
    """One row per taxon and site of the universe; sites without a call are ``N``.

    The calls of a site (one per taxon) meet the site in one left join; the taxa come
    from a short literal list.
    """
    per_site = calls.groupBy(*LOCUS).agg(
        F.map_from_entries(F.collect_list(F.struct("taxon", "base"))).alias("by_taxon")
    )
    names = F.array(*[F.lit(t) for t in taxa])
    return (
        sites.join(per_site, LOCUS, "left")
        .withColumn("taxon", F.explode(names))
        .select(
            "taxon",
            *[c for c in sites.columns],
            F.coalesce(F.try_element_at("by_taxon", F.col("taxon")), F.lit(MISSING)).alias("base"),
        )
    )


def _quality(calls: DataFrame, n_sites: Column) -> DataFrame:
    """Figures per taxon from calls marked ``known`` when they lie in the universe.

    Positions are the site universe plus evidence outside it, so the site by taxon
    product is never formed.
    """

    def tally(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    qc = calls.groupBy("taxon").agg(
        tally(F.col("base") != MISSING).alias("called"),
        tally(F.col("known").isNull()).alias("outside"),
        tally(F.col("penalty") == "thresh").alias("lost_threshold"),
        tally(F.col("penalty") == "min").alias("lost_coverage"),
        tally(F.col("penalty") == "both").alias("lost_both"),
    )
    return (
        qc.withColumn("positions", (n_sites + F.col("outside")).cast("bigint"))
        .withColumn("n_calls", F.col("positions") - F.col("called"))
        .withColumn("no_data", F.col("n_calls") - F.col("lost_threshold") - F.col("lost_coverage") - F.col("lost_both"))
        .withColumn("called_percent", percent(F.col("called"), F.col("positions")))
        .withColumn("n_percent", percent(F.col("n_calls"), F.col("positions")))
        .drop("outside")
    )


def call_quality(sites: DataFrame, calls: DataFrame) -> DataFrame:
    """Positions, called sites and the reasons for each ``N``, per taxon."""
    universe = sites.select(*LOCUS).withColumn("known", F.lit(1))
    return _quality(calls.join(universe, LOCUS, "left"), sites.agg(F.count("*")).scalar())


def contig_quality(lengths: DataFrame, calls: DataFrame) -> DataFrame:
    """The same figures when the universe is every base of the contigs.

    The table of contig lengths stands in for the sites, so the calls are not shuffled
    against them.
    """
    spans = lengths.select("contig", F.col("length").alias("_length"))
    known = F.when(F.col("pos").between(1, F.col("_length")), F.lit(1))
    marked = calls.join(spans, "contig", "left").withColumn("known", known)
    return _quality(marked, lengths.agg(F.sum("length")).scalar())


def quality_lines(qc: DataFrame) -> DataFrame:
    """The two report lines of each taxon, as ``(taxon, line_no, line)``."""
    # Sentences of the site report.
    first = F.format_string(
        "Of %d positions, %s has good calls for %d sites (%s%%). There were %d N calls (%s%%).",
        "positions", "taxon", "called", "called_percent", "n_calls", "n_percent",
    )
    second = F.format_string(
        "Of %d Ns, %s lost %d via homozygosity threshold, %d from low coverage, and %d from both."
        " %d sites had no pileup data.",
        "n_calls", "taxon", "lost_threshold", "lost_coverage", "lost_both", "no_data",
    )
    return qc.select("taxon", F.posexplode(F.array(first, second)).alias("line_no", "line"))


def taxa_without_calls(qc: DataFrame) -> DataFrame:
    """Taxa that fail the run because no site was called."""
    return qc.filter(F.col("called") == 0).select("taxon")
