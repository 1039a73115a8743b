"""CIGAR strings as arrays of ``(size, op)`` segments; runs are never written out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUNS = "array<struct<genome:bigint,contig:bigint,size:bigint>>"


def with_segments(df: DataFrame, cigar: str = "cigar") -> DataFrame:
    """Add ``segs``, the segments of a CIGAR column."""
    cut = df.withColumns({"_sizes": F.split(cigar, r"\D"), "_ops": F.split(cigar, r"\d+")})
    pair = lambda op, i: F.struct(F.get("_sizes", i).cast("bigint").alias("size"), op.alias("op"))
    return cut.withColumn("segs", F.transform(F.expr("slice(_ops, 2, size(_ops) - 1)"), pair)).drop("_sizes", "_ops")


def query_length(segs: Column | str = "segs") -> Column:
    """Contig length by the segments: matches plus insertions."""
    return F.aggregate(
        segs, F.lit(0).cast("bigint"), lambda acc, s: acc + F.when(s["op"].isin("M", "I"), s["size"]).otherwise(F.lit(0))
    )


def walk(segs: Column | str = "segs") -> Column:
    """``struct(genome, contig, runs)`` of one pass over the segments.

    ``runs`` holds each match with the genome and contig bases before it; the other two
    are the total bases consumed. ``M``, ``D`` move on the genome and ``M``, ``I`` on the
    contig; other operations move on neither.
    """

    def moved(acc, s, name, *ops):
        return (acc[name] + F.when(s["op"].isin(*ops), s["size"]).otherwise(F.lit(0))).alias(name)

    def step(acc, s):
        run = F.struct(acc["genome"].alias("genome"), acc["contig"].alias("contig"), s["size"].alias("size"))
        runs = F.when(s["op"] == "M", F.array_append(acc["runs"], run)).otherwise(acc["runs"])
        return F.struct(moved(acc, s, "genome", "M", "D"), moved(acc, s, "contig", "M", "I"), runs.alias("runs"))

    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        segs, F.struct(zero.alias("genome"), zero.alias("contig"), F.array().cast(RUNS).alias("runs")), step
    )
