"""Contigs, site enumeration and taxon-specific genomes.

Sequences travel as chunks ``(contig, chunk, offset, seq)`` with ``offset`` the number
of bases before the chunk, so no task ever holds a whole chromosome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions.text import locus_name
from sitewright.schema import locus_keys
from sitewright.session import local_table

SPAN = 4096


def explode_range(df: DataFrame, low: Column, high: Column, name: str, span: int = SPAN) -> DataFrame:
    """One row per integer of ``[low, high]``, in two steps of bounded arrays."""
    bounds = df.withColumn("_low", low.cast("bigint")).withColumn("_high", high.cast("bigint"))
    bounds = bounds.filter(F.col("_low") <= F.col("_high"))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_high - _low) div {span}"))
    # never empty after the filter above; the outer form keeps the planner from adding a
    # second evaluation of the arrays as a filter on the input
    starts = bounds.withColumn("_block", F.explode_outer(blocks))
    starts = starts.withColumn("_block", F.col("_low") + F.col("_block") * span)
    last = F.least(F.col("_block") + (span - 1), F.col("_high"))
    return starts.withColumn(name, F.explode_outer(F.sequence("_block", last))).drop("_low", "_high", "_block")


def contig_lengths(chunks: DataFrame) -> DataFrame:
    keys = [c for c in ("contig_ord", "contig") if c in chunks.columns]
    return chunks.groupBy(*keys).agg(F.sum(F.length("seq")).cast("bigint").alias("length"))


def enumerate_sites(lengths: DataFrame) -> DataFrame:
    """Every 1-based position of every contig."""
    sites = explode_range(lengths, F.lit(1), F.col("length"), "pos")
    return sites.select(*locus_keys(sites))


def site_names(sites: DataFrame) -> DataFrame:
    return sites.withColumn("locus", locus_name())


def rename_contigs(lengths: DataFrame, prefix: str) -> DataFrame:
    """Prefix contig ids that were cut at the first blank."""
    short = F.regexp_extract("contig", r"^\s*(\S*)", 1)
    return lengths.withColumn("contig", F.concat_ws("_", F.lit(prefix), short))


def rechunk(chunks: DataFrame, span: int = SPAN) -> DataFrame:
    """Split long chunks into pieces of at most ``span`` bases (offsets kept)."""
    step = F.sequence(F.lit(0), F.greatest(F.length("seq") - 1, F.lit(0)), F.lit(span))
    raw = F.col("seq").cast("binary")
    return (
        chunks.withColumn("_at", F.explode_outer(step))
        .withColumn("seq", F.substring(raw, F.col("_at") + 1, F.lit(span)).cast("string"))
        .withColumn("offset", (F.col("offset") + F.col("_at")).cast("bigint"))
        .drop("_at")
    )


def unknown_contigs(chunks: DataFrame, consensus: DataFrame) -> DataFrame:
    """Contigs with evidence but without a sequence."""
    return consensus.select("contig").distinct().join(chunks.select("contig").distinct(), "contig", "left_anti")


def overlay(chunks: DataFrame, consensus: DataFrame, taxa, span: int = SPAN, tile: int = 64) -> DataFrame:
    """Composite sequence per taxon with the taxon's consensus bases put in.

    Chunks are aligned to multiples of ``span``. Edits of up to ``tile`` taxa are grouped per chunk,
    at most ``span`` for each taxon, and meet the chunk in one join; taxa are listed after it, so
    the genome is shuffled once for every ``tile`` taxa. Bases are spliced between the untouched stretches.
    """
    taxa = list(taxa)
    spark = chunks.sparkSession
    slots = local_table(spark, [(t, i // tile) for i, t in enumerate(taxa)], "taxon string, tile int")
    pieces = rechunk(chunks, span).withColumn("chunk", F.expr(f"offset div {span}"))
    pieces = pieces.withColumn("tile", F.explode_outer(F.sequence(F.lit(0), F.lit((len(taxa) - 1) // tile))))
    placed = consensus.join(slots, "taxon").withColumn("chunk", F.expr(f"(pos - 1) div {span}"))
    # partitioned by chunk and tile, so the second aggregation does not shuffle again
    each = placed.repartition("contig", "chunk", "tile").groupBy("contig", "chunk", "tile", "taxon").agg(F.sort_array(F.collect_list(F.struct("pos", "base"))).alias("edits"))
    edits = each.groupBy("contig", "chunk", "tile").agg(F.map_from_entries(F.collect_list(F.struct("taxon", "edits"))).alias("by_taxon"))
    members = F.filter(F.array(*[F.struct(F.lit(t).alias("taxon"), F.lit(i // tile).alias("tile")) for i, t in enumerate(taxa)]), lambda m: m["tile"] == F.col("tile"))
    joined = pieces.join(edits, ["contig", "chunk", "tile"], "left").withColumn("taxon", F.explode_outer(F.transform(members, lambda m: m["taxon"])))
    joined = joined.withColumn("edits", F.element_at("by_taxon", F.col("taxon"))).drop("by_taxon")

    def place(i: Column) -> Column:
        return (F.get("edits", i)["pos"] - F.col("offset")).cast("int")

    # the stretch after edit i ends where edit i + 1 begins
    spliced = F.transform(
        F.col("edits"),
        lambda e, i: F.concat(
            e["base"],
            F.substring(F.col("seq"), place(i) + 1, F.coalesce(place(i + 1), F.length("seq") + 1) - place(i) - 1),
        ),
    )
    head = F.substring(F.col("seq"), F.lit(1), place(F.lit(0)) - 1)
    edited = F.when(F.col("edits").isNull(), F.col("seq")).otherwise(F.concat(head, F.array_join(spliced, "")))
    keep = [c for c in ("contig_ord", "contig", "chunk", "offset") if c in joined.columns]
    return joined.select("taxon", *keep, edited.alias("seq"))
