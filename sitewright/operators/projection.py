"""Projection of aligned contigs onto a genome, base by base."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.functions import cigar as C
from sitewright.functions.text import thousands
from sitewright.operators.genome import explode_range

#: Bases of a chromosome that one group sweeps.
RANGE = 1 << 16

# Alignment flags of a forward and a reverse hit, and the unmapped bit.
FORWARD, REVERSE, UNMAPPED = 0, 16, 4


def mapped_only(sam: DataFrame) -> DataFrame:
    """Alignments whose flag lacks the unmapped bit."""
    return sam.filter(F.col("flag").bitwiseAND(F.lit(UNMAPPED)) == 0)


def with_query_length(maps: DataFrame) -> DataFrame:
    return C.with_segments(maps).withColumn("length", C.query_length()).drop("segs")


def aligned_runs(maps: DataFrame) -> DataFrame:
    """One row per matched run with the genome and contig position of its first base.

    Offsets are sums over the earlier segments of the same row, so no shuffle is needed.
    """
    placed = maps.filter(F.col("direction").isin(FORWARD, REVERSE))
    walked = C.with_segments(placed).withColumn("w", C.walk())
    runs = walked.select("*", F.col("w.contig").alias("length"), F.explode_outer("w.runs").alias("run"))
    runs = runs.filter(F.col("run").isNotNull())
    forward = F.col("direction") == FORWARD
    return runs.select(
        "contig",
        "chrom",
        "direction",
        (F.col("start") + F.col("run.genome")).alias("genome_pos"),
        F.when(forward, F.col("run.contig") + 1).otherwise(F.col("length") - F.col("run.contig")).alias("contig_pos"),
        F.col("run.size").alias("size"),
    )


def project(maps: DataFrame) -> DataFrame:
    """BED rows ``(chrom, start, end, name)``, one per aligned contig base."""
    runs = explode_range(aligned_runs(maps), F.lit(0), F.col("size") - 1, "step")
    at = F.col("genome_pos") + F.col("step")
    on_contig = F.col("contig_pos") + F.when(F.col("direction") == FORWARD, F.col("step")).otherwise(-F.col("step"))
    return runs.select("chrom", (at - 1).alias("start"), at.alias("end"), F.concat_ws("/", "contig", on_contig).alias("name"))


def keep_unique(bed: DataFrame) -> DataFrame:
    """Drop every row whose ``(chrom, start)`` occurs more than once.

    A count with map-side partial sums; the surviving groups hold one row, so the
    maximum is that row's name. A position hit by a large share of all rows stays cheap.
    """
    grouped = bed.groupBy("chrom", "start").agg(F.count("*").alias("hits"), F.max("name").alias("name"))
    return grouped.filter(F.col("hits") == 1).select("chrom", "start", (F.col("start") + 1).alias("end"), "name")


def _report(totals: DataFrame) -> DataFrame:
    removed = F.col("mapped") - F.col("kept")
    return totals.select(
        "mapped", removed.alias("removed"), "kept",
        thousands("mapped").alias("mapped_text"), thousands(removed).alias("removed_text"), thousands("kept").alias("kept_text"),
    )


def overlap_report(bed: DataFrame) -> DataFrame:
    """Projected, removed and remaining site counts, with thousands separators."""
    hits = bed.groupBy("chrom", "start").agg(F.count("*").alias("hits"))
    return _report(hits.agg(
        F.coalesce(F.sum("hits"), F.lit(0)).cast("bigint").alias("mapped"),
        F.coalesce(F.sum(F.when(F.col("hits") == 1, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("kept"),
    ))


def _swept(runs: DataFrame, kept: list[str], width: int) -> DataFrame:
    """Every run cut at multiples of ``width``: ``chrom``, its own ``bases``, ``low`` and ``high`` of a stretch that one run alone covers, and ``kept`` of that run.

    Runs of a range stand in order of their start. Up to the next start only the run that reaches
    farthest so far is open beyond the second farthest end, which is the farthest of the ends that
    lost against another. So a run is one row of one shuffle, however long it is and whatever it carries.
    """
    ranges = F.sequence(F.expr(f"genome_pos div {width}"), F.expr(f"(genome_pos + size - 1) div {width}"))
    cut = runs.filter(F.col("size") > 0).select("chrom", "genome_pos", "size", *[k for k in kept if k not in ("chrom", "genome_pos", "size")], F.explode_outer(ranges).alias("range"))
    low = F.greatest(F.when(F.col("range").isNotNull(), F.col("range") * width), F.col("genome_pos"))
    high = F.when(F.col("genome_pos").isNotNull(), F.least((F.col("range") + 1) * width, F.col("genome_pos") + F.col("size")))
    cut = cut.withColumns({"at": low, "end": high}).withColumn("bases", F.coalesce(F.col("end") - F.col("at"), "size"))
    swept = W.partitionBy("chrom", "range").orderBy("at")
    so_far, before = swept.rowsBetween(W.unboundedPreceding, W.currentRow), swept.rowsBetween(W.unboundedPreceding, -1)
    top = F.max(F.struct("end", *kept)).over(so_far)
    lost = F.max("end").over(before)
    placed = cut.select("chrom", "range", "at", "bases", top.alias("top"), F.when(lost.isNotNull(), F.least("end", lost)).alias("lost"), F.lead("at").over(swept).alias("next"))
    second = F.max("lost").over(so_far)
    return placed.select("chrom", "bases", F.greatest("at", second).alias("low"), F.least("top.end", "next").alias("high"), *[F.col(f"top.{k}") for k in kept if k != "chrom"])


def single_stretches(runs: DataFrame, width: int = RANGE, kept: list[str] | None = None) -> DataFrame:
    """``(chrom, low, high, run)``: stretches of a genome that one run covers and no other, by a sweep.

    ``runs`` has ``chrom``, ``genome_pos``, ``size`` and the columns ``kept`` (``run`` if not given), which
    the stretches tell of the run that covers them. Each range of a chromosome is swept on its own.
    """
    return _swept(runs, kept or ["run"], width).filter("low < high").drop("bases")


def overlap_report_of_runs(runs: DataFrame) -> DataFrame:
    """``overlap_report`` from ``aligned_runs``: no row per base is made, and the runs are read once."""
    kept = F.sum(F.when(F.col("low") < F.col("high"), F.col("high") - F.col("low")))
    return _report(_swept(runs, [], RANGE).agg(
        F.coalesce(F.sum("bases"), F.lit(0)).cast("bigint").alias("mapped"), F.coalesce(kept, F.lit(0)).cast("bigint").alias("kept"),
    ))


def unique_bases(runs: DataFrame) -> DataFrame:
    """``keep_unique`` of ``aligned_runs``: bases are listed only where one run covers the genome."""
    found = single_stretches(runs, kept=["genome_pos", "contig", "contig_pos", "direction"])
    listed = explode_range(found, F.col("low"), F.col("high") - 1, "at")
    step = F.col("at") - F.col("genome_pos")
    on_contig = F.col("contig_pos") + F.when(F.col("direction") == FORWARD, step).otherwise(-step)
    return listed.select("chrom", (F.col("at") - 1).alias("start"), F.col("at").alias("end"), F.concat_ws("/", "contig", on_contig).alias("name"))
