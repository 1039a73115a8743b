"""Sequencing budget per sample, read statistics and read subsampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.session import written

BUCKET_DIGITS = 3


def read_statistics(reads: DataFrame) -> DataFrame:
    """Read and base count per sample from ``(sample_id, seq)``."""
    return reads.groupBy("sample_id").agg(
        F.count("*").cast("bigint").alias("read_count"), F.sum(F.length("seq")).cast("bigint").alias("base_count")
    )


def join_statistics(manifest: DataFrame, stats: DataFrame) -> DataFrame:
    """Manifest rows with the counts of their sample."""
    return manifest.join(stats, "sample_id", "inner")


def group_depths(stats: DataFrame, genome_size: int, coverage: float) -> DataFrame:
    """Bases, samples and requested depth per group; ``takes_all`` when it falls short."""
    per_group = stats.groupBy("grp").agg(
        F.sum("base_count").cast("bigint").alias("group_bases"), F.count("*").cast("bigint").alias("group_samples")
    )
    n_groups = per_group.agg(F.count("*")).scalar()
    depth = F.floor(F.lit(float(coverage) * genome_size) / n_groups).cast("bigint")
    return per_group.withColumn("depth", depth).withColumn("takes_all", F.col("group_bases") < F.col("depth"))


def allocate(stats: DataFrame, genome_size: int, coverage: float = 10.0) -> DataFrame:
    """Add ``to_sample``, the bases to draw from each sample.

    A group below its depth gives everything. Otherwise samples below an equal share
    are taken whole and the rest split what is left, once, rounded down. Groups are
    summed with map-side partials and joined back; AQE broadcasts the group table when
    its measured size is small and splits a hot group when it is not. ``stats`` (a row per
    sample) is read several times: pass a stored table, not a count still to be made.
    """
    depths = group_depths(stats, genome_size, coverage)
    marked = stats.join(depths, "grp").withColumn("low", F.col("base_count") < F.col("depth") / F.col("group_samples"))
    rest = marked.groupBy("grp").agg(
        F.sum(F.when(F.col("low"), F.col("base_count")).otherwise(0)).cast("bigint").alias("low_bases"),
        F.sum(F.when(F.col("low"), 0).otherwise(1)).cast("bigint").alias("n_high"),
    )
    share = F.expr("(depth - low_bases) div n_high").cast("bigint")
    amount = F.when(F.col("takes_all") | F.col("low"), F.col("base_count")).otherwise(share)
    return marked.join(rest, "grp").select(*stats.columns, amount.alias("to_sample"))


def allocation_log(stats: DataFrame, genome_size: int, coverage: float) -> DataFrame:
    """Log lines of the allocation, ``(line_no, line)``."""
    depths = group_depths(stats, genome_size, coverage)
    head = depths.agg(F.count("*").alias("n"), F.max("depth").alias("depth")).select(
        F.posexplode(
            F.array(
                F.format_string("Genome size estimate: %d bp", F.lit(genome_size)),
                F.concat(F.lit("Desired coverage: "), F.lit(str(float(coverage))), F.lit("X")),
                F.format_string("Found %d pangenome groups", "n"),
                F.format_string("Requested subset depth: %d bp per group", "depth"),
            )
        ).alias("line_no", "line")
    )
    short = depths.filter("takes_all").select(
        F.lit(4).alias("line_no"),
        F.format_string("NOTE: %s samples have only %d bp. All reads will be used.", "grp", "group_bases").alias("line"),
    )
    return head.unionByName(short)


def _cuts(ranked: DataFrame, targets: DataFrame) -> DataFrame:
    """Per sample the hash bucket in which the target is crossed and the bases before it.

    ``cut`` is NULL for a sample that stays within its target. One short row per sample.
    """
    sums = ranked.groupBy("sample_id", "_bucket").agg(F.sum("length").cast("bigint").alias("_in"))
    upto = W.partitionBy("sample_id").orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    steps = sums.withColumn("_until", F.sum("_in").over(upto)).join(targets.select("sample_id", "to_sample"), "sample_id")
    crossing = F.struct(F.col("_bucket").alias("bucket"), (F.col("_until") - F.col("_in")).alias("before"))
    return steps.groupBy("sample_id", "to_sample").agg(
        F.min(F.when(F.col("_until") > F.col("to_sample"), crossing)).alias("cut")
    )


def subsample(reads: DataFrame, targets: DataFrame, read_key: Column, seed: str = "0", digits: int = BUCKET_DIGITS) -> DataFrame:
    """Reads of each sample, in seeded hash order, up to the base target of the sample.

    ``reads`` has ``sample_id`` and ``length``, ``targets`` has ``sample_id`` and
    ``to_sample``; ``read_key`` tells reads apart. Sums per hash bucket show which bucket
    crosses the target. Reads before it are kept without a shuffle and only those in the
    crossing bucket (one in ``16 ** digits`` of a sample) are ranked read by read. The
    result equals that of ranking the whole sample in one window.
    """
    ranked = reads.withColumn("_key", read_key).withColumn("_rank", F.md5(F.concat(F.lit(seed), F.lit(":"), F.col("_key"))))
    ranked = ranked.withColumn("_bucket", F.substring("_rank", 1, digits))
    cuts = written(_cuts(ranked, targets), "sample_id")  # its size is known, so the planner broadcasts it only while it is small
    placed = ranked.join(cuts, "sample_id")
    whole = placed.filter(F.col("cut").isNull() | (F.col("_bucket") < F.col("cut.bucket")))
    inside = W.partitionBy("sample_id").orderBy("_rank", "_key").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = (
        placed.filter(F.col("_bucket") == F.col("cut.bucket"))
        .withColumn("_sum", F.col("cut.before") + F.sum("length").over(inside))
        .filter(F.col("_sum") <= F.col("to_sample"))
    )
    return whole.select(*reads.columns).unionByName(edge.select(*reads.columns))


def subsample_pairs(ends: DataFrame, targets: DataFrame, seed: str = "0", digits: int = BUCKET_DIGITS) -> DataFrame:
    """Reads of each sample up to its base target, both ends of a pair or neither.

    ``ends`` has ``sample_id``, ``read_no``, ``end`` and ``seq``. A pair counts with the bases
    of both ends; a read without mate is a unit of its own.
    """
    units = ends.groupBy("sample_id", "read_no").agg(F.sum(F.length("seq")).cast("bigint").alias("length"))
    kept = subsample(units, targets, F.col("read_no").cast("string"), seed, digits)
    return ends.join(kept.select("sample_id", "read_no"), ["sample_id", "read_no"], "left_semi").select(*ends.columns)
