"""Pileups, genome maps, distance triangles and read statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions.text import isolate_id
from sitewright.schema import MAP_DATA, READ_STATS
from sitewright.session import spread
from sitewright.sources.lines import parent_folder, read_records


# A line with at least five fields whose fourth is a positive number.
WITH_DEPTH = r"^\s*\S+\s+\S+\s+\S+\s+0*[1-9]\d*\s+\S"


def parse_pileup(lines: DataFrame) -> DataFrame:
    """Pileup lines (``taxon, value``) with depth, split into six fields.

    Lines of at most four fields or without depth are skipped; others must have six.
    """
    deep = F.col("value").rlike(WITH_DEPTH)
    cut = lines.filter(deep).select("taxon", F.split(F.trim("value"), r"\s+").alias("f"), deep.alias("deep"))
    # The planner may judge a line before the filter drops it.
    fields = F.when(F.size("f") == 6, F.col("f")).when(
        F.col("deep"), F.raise_error(F.concat(F.lit("pileup line without six fields: "), F.array_join("f", " ")))
    )
    g = F.col("g")
    return cut.withColumn("g", fields).select(
        "taxon",
        g[0].alias("contig"),
        g[1].cast("bigint").alias("pos"),
        g[2].alias("ref"),
        g[3].cast("int").alias("depth"),
        g[4].alias("bases"),
        g[5].alias("quals"),
    )


def read_pileups(spark: SparkSession, root: str) -> DataFrame:
    """All ``<taxon>/<taxon>.pileups`` files below ``root``."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pileups").text(root)
    return parse_pileup(spread(lines.select(parent_folder(F.col("_metadata.file_path")).alias("taxon"), "value")))


def taxa_with_many_pileups(files: DataFrame) -> DataFrame:
    """Folders (from one ``path`` per pileup file) that hold more than one pileup."""
    return files.groupBy(parent_folder("path").alias("taxon")).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def taxon_roster(folders: DataFrame, files: DataFrame) -> DataFrame:
    """Every taxon folder (``taxon``) with the number of its pileup files (from one ``path`` per file)."""
    counts = files.groupBy(parent_folder("path").alias("taxon")).agg(F.count("*").alias("n"))
    return folders.join(counts, "taxon", "full").select("taxon", F.coalesce("n", F.lit(0)).alias("n"))


def read_map_data(spark: SparkSession, path: str) -> DataFrame:
    if not path.rstrip("/").endswith("_MapData.tsv"):
        raise ValueError("a genome map must be named <genome>_MapData.tsv")
    return spread(spark.read.schema(MAP_DATA).csv(path, sep="\t", mode="FAILFAST"))


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Read statistics CSV as ``(sample_id, grp, reads, read_count, base_count)``."""
    return spark.read.schema(READ_STATS).csv(path, header=True).toDF("sample_id", "grp", "reads", "read_count", "base_count")


def parse_triangle(lines: DataFrame, trim_name: str = "") -> tuple[DataFrame, DataFrame]:
    """Isolates ``(id, path, ord)`` and edges ``(id_a, id_b, dist)`` of a lower triangle.

    Line 0 is a count; each further line is a path and its distances to the isolates of
    all earlier lines. Ids are ordinals.
    """
    rows = lines.filter((F.col("line_no") > 0) & (F.length(F.trim("value")) > 0))
    rows = rows.select((F.col("line_no") - 1).alias("id"), F.split(F.trim("value"), r"\s+").alias("t"))
    isolates = rows.select(
        "id", F.col("t")[0].alias("path"), F.col("id").alias("ord"), isolate_id(F.col("t")[0], trim_name).alias("isolate")
    )
    tokens = rows.select("id", F.posexplode_outer(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))).alias("other", "d"))
    tokens = tokens.filter(F.col("d").isNotNull())
    edges = tokens.select(
        F.col("id").alias("id_a"), F.col("other").cast("bigint").alias("id_b"), F.col("d").cast("double").alias("dist")
    )
    return isolates, edges


def read_triangle(spark: SparkSession, path: str, trim_name: str = "") -> tuple[DataFrame, DataFrame]:
    return parse_triangle(read_records(spark, path), trim_name)
