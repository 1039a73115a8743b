"""Alignments in NEXUS, PHYLIP and FASTA form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.schema import ALIGNMENT_FORMATS
from sitewright.functions.text import locus_name
from sitewright.sources import ranges
from sitewright.sources.lines import is_folder, read_ordered, read_records
from sitewright.sources.sequences import parse_fasta

BLOCK = 1024


def alignment_format(path: str) -> str:
    extension = path.rstrip("/").rsplit(".", 1)[-1]
    if extension not in ALIGNMENT_FORMATS:
        raise ValueError(f"unknown alignment format: {path}")
    return ALIGNMENT_FORMATS[extension]


def _named(lines: DataFrame) -> DataFrame:
    text = F.trim("value")
    return lines.select(
        "line_no",
        F.regexp_extract(text, r"^(\S+)", 1).alias("taxon"),
        F.regexp_replace(F.regexp_replace(text, r"^\S+", ""), r"\s", "").alias("seq"),
    )


def parse_nexus(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sequences ``(taxon, line_no, seq)`` and loci ``(site_ord, locus)`` of a NEXUS file."""
    text = F.trim("value")
    marked = lines.withColumn("word", F.upper(F.substring(text, 1, 7)))
    begin = marked.agg(F.min(F.when(F.col("word") == "MATRIX", F.col("line_no")))).scalar()
    matrix = marked.filter(F.col("line_no") > begin)
    end = matrix.agg(F.min(F.when(F.startswith(text, F.lit(";")), F.col("line_no")))).scalar()
    body = matrix.filter((F.col("line_no") < end) & (F.length(text) > 0)).drop("word")
    comment = F.startswith(text, F.lit("["))
    inner = F.trim(F.regexp_replace(F.regexp_replace(text, r"^\[", ""), r"\]$", ""))
    loci = body.filter(comment & (F.length(inner) > 0)).select(F.posexplode(F.split(inner, r"\s+")).alias("site_ord", "locus"))
    return _named(body.filter(~comment)), loci.withColumn("site_ord", F.col("site_ord").cast("bigint"))


def parse_phylip(lines: DataFrame) -> DataFrame:
    """Sequences of a (relaxed) PHYLIP file: a name, blanks, the sequence."""
    return _named(lines.filter((F.col("line_no") > 0) & (F.length(F.trim("value")) > 0)))


def read_sequences(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Aligned sequences ``(taxon, line_no, seq)`` in parts, and the loci for NEXUS.

    Files are read in byte ranges, so neither a sequence nor the list of loci has to fit into a
    record. ``strict`` PHYLIP names are ten letters long and may hold blanks. Compressed files and
    stores that only Spark opens are read line by line.
    """
    kind = alignment_format(path)
    listing = ranges.listed(spark, path)
    if ranges.can_cut(listing):
        blobs = ranges.blobs_of(listing)
        if kind == "nexus":
            return ranges.nexus_fragments(blobs)
        if kind == "phylip":
            return ranges.phylip_fragments(blobs, strict), None
        rows = ranges.fasta_fragments(blobs, ranges.FRAGMENT)
        return rows.select((F.col("contig_ord") + F.col("offset")).alias("line_no"), F.col("contig").alias("taxon"), "seq"), None
    if kind == "fasta":
        records = parse_fasta(read_ordered(spark, path, line_sep="\n>"))
        return records.select(F.col("contig_ord").alias("line_no"), F.col("contig").alias("taxon"), "seq"), None
    lines = read_records(spark, path)
    return parse_nexus(lines) if kind == "nexus" else (parse_phylip(lines), None)


def sequence_columns(sequences: DataFrame, n_taxa: int, block: int = BLOCK) -> DataFrame:
    """Turn sequences into site columns ``(site_ord, column)``, taxa in sorted order.

    Only the lengths of a taxon's lines are put in order. Sequences are cut at multiples of ``block``; the blocks of all taxa at one
    offset meet in one group of ``n_taxa`` members and are transposed there. Lines of different taxa may end at different places.
    """
    earlier = W.partitionBy("taxon").orderBy("line_no").rowsBetween(W.unboundedPreceding, -1)
    lengths = sequences.select("taxon", "line_no", F.length("seq").alias("n"))
    offsets = lengths.select("taxon", "line_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).cast("bigint").alias("offset"))
    placed = sequences.join(offsets, ["taxon", "line_no"])
    numbers = F.sequence(F.expr(f"offset div {block}"), F.expr(f"(offset + length(seq) - 1) div {block}"))
    pieces = placed.filter(F.length("seq") > 0).withColumn("block", F.explode_outer(numbers))
    low = F.greatest(F.col("block") * block, F.col("offset"))
    high = F.least((F.col("block") + 1) * block, F.col("offset") + F.length("seq"))
    cut = F.substring("seq", (low - F.col("offset") + 1).cast("int"), (high - low).cast("int"))
    # partitioned by block, so neither aggregation shuffles again
    cells = pieces.select("block", "taxon", low.alias("at"), cut.alias("seq")).repartition("block")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "seq"))), lambda p: p["seq"]), "")
    rows = cells.groupBy("block", "taxon").agg(joined.alias("seq"))
    stacked = rows.groupBy((F.col("block") * block).alias("offset")).agg(F.sort_array(F.collect_list(F.struct("taxon", "seq"))).alias("rows"))
    same = (F.size("rows") == n_taxa) & (F.size(F.array_distinct(F.transform("rows", lambda r: F.length(r["seq"])))) == 1)
    checked = stacked.withColumn(
        "letters",
        F.when(same, F.transform("rows", lambda r: F.split(r["seq"], ""))).otherwise(
            F.raise_error(F.lit("aligned sequences differ in length"))
        ),
    )
    width = F.length(F.get("rows", F.lit(0))["seq"])
    column = F.array_join(F.transform("letters", lambda letters: F.get(letters, F.col("i"))), "")
    return checked.withColumn("i", F.explode_outer(F.sequence(F.lit(0), width - 1))).select(
        (F.col("offset") + F.col("i")).alias("site_ord"), column.alias("column")
    )


def read_stored(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Site columns ``(contig_ord, contig, pos, locus, column)`` and taxa of an alignment stored as Parquet.

    The taxa lie beside it in ``<path>_taxa``. No site is numbered; contig and position give the order.
    """
    taxa = sorted(r[0] for r in spark.read.parquet(path.rstrip("/") + "_taxa").collect())
    return spark.read.parquet(path).select("contig_ord", "contig", "pos", locus_name().alias("locus"), "column"), taxa


def read_alignment(spark: SparkSession, path: str, block: int = BLOCK, strict: bool = False) -> tuple[DataFrame, list[str]]:
    """Site columns ``(site_ord, locus, column)`` and the sorted taxa of an alignment file.

    Without a list of loci the site's ordinal is its locus. A folder without one of the known
    extensions is an alignment stored as Parquet: see ``read_stored``.
    """
    if path.rstrip("/").rsplit(".", 1)[-1] not in ALIGNMENT_FORMATS and is_folder(spark, path):
        return read_stored(spark, path)
    sequences, loci = read_sequences(spark, path, strict)
    taxa = sorted(r[0] for r in sequences.select("taxon").distinct().collect())
    columns = sequence_columns(sequences, len(taxa), block)
    if loci is None:
        return columns.select("site_ord", F.col("site_ord").cast("string").alias("locus"), "column"), taxa
    return columns.join(loci, "site_ord", "left").select("site_ord", "locus", "column"), taxa
