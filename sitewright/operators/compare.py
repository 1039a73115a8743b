"""Pairwise identity of taxa and classification of samples against references."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.functions.text import pair_name
from sitewright.schema import ANALYTIC_SYMBOLS

TILE, SITES = 512, 1024


def _pair_counter(n_taxa: int, tile: int):
    """Task body: co-called and identical sites of every pair of taxa, all tiles from one pass over the columns.

    Columns become 0/1 matrices, ``SITES`` at a time, and each pair of tiles takes one matrix
    product per symbol, so no pair of taxa is written out per site. A task holds the counts of
    all pairs, 16 bytes a pair.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = [slice(x, min(x + tile, n_taxa)) for x in range(0, n_taxa, tile)]
        tables = {(x, y): np.zeros((2, cuts[x].stop - cuts[x].start, cuts[y].stop - cuts[y].start), np.int64) for x in range(len(cuts)) for y in range(x, len(cuts))}
        for batch in batches:
            for low in range(0, batch.num_rows, SITES):
                part = batch["column"].slice(low, SITES)
                letters = np.frombuffer("".join(part.to_pylist()).encode("ascii"), np.uint8).reshape(len(part), n_taxa)
                present = [s for s in ANALYTIC_SYMBOLS.encode() if (letters == s).any()]
                hits = [(letters == s).astype(np.float32) for s in present]
                called = sum(hits, np.zeros(letters.shape, np.float32))
                for (x, y), (both, same) in tables.items():
                    both += np.rint(called[:, cuts[x]].T @ called[:, cuts[y]]).astype(np.int64)
                    for hit in hits:
                        same += np.rint(hit[:, cuts[x]].T @ hit[:, cuts[y]]).astype(np.int64)
        for (x, y), (both, same) in tables.items():
            rows = np.flatnonzero(both.any(1))
            if len(rows):
                yield pa.RecordBatch.from_pydict({
                    "i": pa.array(rows + cuts[x].start, pa.int32()), "at": pa.array(np.full(len(rows), cuts[y].start), pa.int32()),
                    "both": pa.array(both[rows].tolist(), pa.list_(pa.int64())), "same": pa.array(same[rows].tolist(), pa.list_(pa.int64())),
                })

    return count


def pairwise_identity(sites: DataFrame, taxa: Sequence[str], tile: int = TILE) -> DataFrame:
    """Co-called sites, identical sites and their ratio for every pair of taxa.

    The sites are read once. Each task sums the matrix products of all tiles of taxa over its
    sites and hands on a row of counts for each taxon and tile, at most one number per pair;
    these are summed before they are shuffled. Pairs without a co-called site come out as 0.
    """
    taxa = list(taxa)
    rows = sites.select("column").mapInArrow(_pair_counter(len(taxa), tile), "i int, at int, both array<bigint>, same array<bigint>")
    cells = rows.select("i", "at", F.posexplode(F.arrays_zip("both", "same")).alias("k", "c")).select("i", (F.col("at") + F.col("k")).alias("j"), "c.both", "c.same")
    sums = (
        cells.filter((F.col("i") < F.col("j")) & (F.col("both") > 0))
        .groupBy("i", "j")
        .agg(F.sum("both").alias("cocalled"), F.sum("same").alias("identical"))
    )
    spark = sites.sparkSession
    index = F.array(*[F.lit(str(t)) for t in taxa])
    first = spark.range(len(taxa)).select(F.col("id").cast("int").alias("i"))
    pairs = first.filter(F.col("i") < len(taxa) - 1).withColumn(
        "j", F.explode(F.sequence(F.col("i") + 1, F.lit(len(taxa) - 1)))
    )
    full = pairs.join(sums, ["i", "j"], "left").na.fill(0, ["cocalled", "identical"])
    a, b = F.get(index, F.col("i")), F.get(index, F.col("j"))
    named = full.select(
        F.least(a, b).alias("Sample_A"),
        F.greatest(a, b).alias("Sample_B"),
        pair_name(a, b).alias("Comparison"),
        F.col("cocalled").alias("Cocalled_Sites"),
        F.col("identical").alias("Identical_Sites"),
    )
    ratio = F.when(F.col("Cocalled_Sites") > 0, F.col("Identical_Sites") / F.col("Cocalled_Sites")).otherwise(F.lit(0.0))
    return named.withColumn("Prop_Identical", ratio)


def classify_samples(sites: DataFrame, taxa: Sequence[str], references: Sequence[str]) -> DataFrame:
    """Per sample: sites matching one reference only, several, or none.

    Only sites where the sample and every reference are called count. Each site yields
    one short row per taxon inside the task and is summed there before the shuffle.
    """
    taxa = [str(t) for t in taxa]
    references = sorted(str(r) for r in references)
    unknown = [r for r in references if r not in taxa]
    if unknown:
        raise ValueError(f"references are not in the alignment: {unknown}")
    samples = [t for t in taxa if t not in references]
    panel = F.concat(*[F.substring("column", taxa.index(r) + 1, 1) for r in references])
    known = f"^[{ANALYTIC_SYMBOLS}]+$"
    base, refs = F.col("base"), F.col("panel")
    matches = F.length(refs) - F.length(F.replace(refs, base, F.lit("")))
    outcome = F.when(matches == 0, F.lit(0)).when(matches == 1, F.instr(refs, base)).otherwise(F.lit(-1))
    counted = (
        sites.select("column", panel.alias("panel"))
        .filter(refs.rlike(known))
        .select("panel", F.posexplode_outer(F.split("column", "")).alias("at", "base"))
        .filter(base.rlike(known))
        .groupBy("at", outcome.alias("outcome"))
        .agg(F.count("*").alias("n"))
    )
    roster = sites.sparkSession.createDataFrame([(s, taxa.index(s)) for s in samples], "Sample_ID string, at int")

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("bigint")

    o = F.col("outcome")
    return (
        roster.join(counted, "at", "left")
        .groupBy("Sample_ID")
        .agg(
            *[total(o == k + 1).alias(f"Count_{r}") for k, r in enumerate(references)],
            total(o > 0).alias("Classifier_Sites"),
            total(o.isNotNull()).alias("All_Sites"),
            total(o == 0).alias("Count_Singleton"),
            total(o == -1).alias("Count_Background"),
        )
    )
