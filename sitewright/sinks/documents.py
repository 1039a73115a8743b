"""Alignments, sequences, site lists and reports as text documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.functions.text import locus_name
from sitewright.operators.alignment import taxon_blocks
from sitewright.schema import SAMPLE_SHEET_HEADER
from sitewright.sinks.pieces import write_pieces

BLOCK = 4096


def _order_and_block(sites: DataFrame) -> tuple[list[str], Column]:
    """Order keys of a site table and a block key that follows the same order."""
    if "site_ord" in sites.columns:
        lead = [c for c in ("part_ord",) if c in sites.columns]
        keys = [*lead, "site_ord"]
    else:
        keys = [c for c in ("contig_ord", "contig", "pos") if c in sites.columns]
    last = F.expr(f"{keys[-1]} div {BLOCK}").alias(keys[-1])
    return keys, F.struct(*[F.col(k) for k in keys[:-1]], last)


def _pieces(df: DataFrame, section: Column, block: Column, text: Column) -> DataFrame:
    return df.select(section.cast("int").alias("section"), block.alias("block"), text.alias("text"))


def _fixed(sites: DataFrame, block: Column, rows: list[tuple[int, str]]) -> DataFrame:
    """Literal pieces, each in a section of its own."""
    kind = sites.select(block.alias("block")).schema["block"].dataType.simpleString()
    made = sites.sparkSession.createDataFrame(rows, "section int, text string")
    return made.select("section", F.lit(None).cast(kind).alias("block"), "text")


def _with_locus(sites: DataFrame) -> DataFrame:
    return sites if "locus" in sites.columns else sites.withColumn("locus", locus_name())


def _sequence_pieces(sites, taxa, keys, block, column, names, end: str = "\n"):
    """Sections 3i (name), 3i + 1 (sequence), 3i + 2 (line end) after the header sections."""
    base = 10
    seqs = taxon_blocks(sites, taxa, keys, block, column)
    body = _pieces(seqs, F.col("taxon_ord") * 3 + (base + 1), F.col("block"), F.col("seq"))
    frame = []
    for i, name in enumerate(names):
        frame += [(base + 3 * i, name), (base + 3 * i + 2, end)]
    return body.unionByName(_fixed(sites, block, frame)), base + 3 * len(names)


def nexus_pieces(sites: DataFrame, taxa: Sequence[str]) -> DataFrame:
    """NEXUS document with the loci in a bracketed line before the sequences.

    Rows ``(section, block, text)``; read in that order the texts are the document.
    """
    sites = _with_locus(sites)
    keys, block = _order_and_block(sites)
    nchar = sites.count()
    # Header of a NEXUS data block.
    head = (
        f"#NEXUS\n\nBEGIN DATA;\nDIMENSIONS NTAX={len(taxa)} NCHAR={nchar};\n"
        "FORMAT MISSING=? GAP=- DATATYPE=DNA;\nMATRIX\n["
    )
    grouped = sites.withColumn("block", block).groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct(*keys, "locus"))).alias("m")
    )
    loci = _pieces(grouped, F.lit(1), F.col("block"), F.concat(F.lit(" "), F.array_join(F.col("m.locus"), " ")))
    body, after = _sequence_pieces(sites, taxa, keys, block, "column", [f"{t}\t" for t in taxa])
    fixed = _fixed(sites, block, [(0, head), (2, " ]\n" if nchar else "  ]\n"), (after, ";\nend;")])
    return fixed.unionByName(loci).unionByName(body)


def write_nexus(sites: DataFrame, taxa: Sequence[str], path: str, overwrite: bool = True) -> None:
    write_pieces(nexus_pieces(sites, taxa), ["section", "block"], path, overwrite=overwrite)


def phylip_pieces(sites: DataFrame, taxa: Sequence[str], column: str = "column") -> DataFrame:
    """Relaxed PHYLIP document: counts, then a padded name and the sequence per taxon."""
    keys, block = _order_and_block(sites)
    width = max((len(t) for t in taxa), default=0) + 1
    body, _ = _sequence_pieces(sites, taxa, keys, block, column, [t.ljust(width) for t in taxa])
    head = _fixed(sites, block, [(0, f" {len(taxa)} {sites.count()}\n")])
    return head.unionByName(body)


def write_phylip(sites: DataFrame, taxa: Sequence[str], path: str, column: str = "column", overwrite: bool = True) -> None:
    write_pieces(phylip_pieces(sites, taxa, column), ["section", "block"], path, overwrite=overwrite)


def write_text(lines: DataFrame, order: list, path: str, column: str = "line", overwrite: bool = True, by: str | None = None) -> None:
    """Lines as text in the given order, by Spark's own writer: its parts in name order are the document.

    ``by`` makes a document of its own for each value, in a folder ``<by>=<value>``, all in one job.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    if by is None:
        lines.orderBy(*order).select(F.col(column).alias("value")).write.mode(mode).text(path)
        return
    keys = [by, *order]
    ordered = lines.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.select(by, F.col(column).alias("value")).write.mode(mode).partitionBy(by).text(path)


def fasta_lines(chunks: DataFrame) -> DataFrame:
    """Header and sequence lines of contigs, a line per chunk; in order of contig and offset they are a FASTA document."""
    with_head = F.when(F.col("offset") == 0, F.array(F.concat(F.lit(">"), "contig"), F.col("seq"))).otherwise(F.array("seq"))
    keep = [c for c in ("taxon", "contig", "offset") if c in chunks.columns]
    return chunks.select(*keep, F.posexplode(with_head).alias("part", "line"))


def write_fasta(chunks: DataFrame, path: str, overwrite: bool = True, by: str | None = None) -> None:
    """FASTA document, contigs sorted by id, one line per chunk; one document for each value of ``by``."""
    write_text(fasta_lines(chunks), ["contig", "offset", "part"], path, overwrite=overwrite, by=by)


def write_lines(df: DataFrame, order: list, path: str, column: str = "line", overwrite: bool = True) -> None:
    """One value per line, in order."""
    write_text(df, order, path, column, overwrite)


def write_fastq(reads: DataFrame, path: str, mode: str = "overwrite") -> None:
    """FASTQ text in a folder for each sample and end, mates in the same order in both."""
    record = F.concat(F.lit("@"), F.col("name"), F.lit("\n"), F.col("seq"), F.lit("\n+\n"), F.col("qual"))
    ordered = reads.repartitionByRange("sample_id", "read_no").sortWithinPartitions("sample_id", "end", "read_no")
    ordered.select("sample_id", "end", record.alias("value")).write.mode(mode).partitionBy("sample_id", "end").text(path)


def write_loci(sites: DataFrame, path: str, overwrite: bool = True) -> None:
    """Site names in site order."""
    keys, _ = _order_and_block(sites)
    write_lines(_with_locus(sites), keys, path, "locus", overwrite)


def write_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True, mode: str = "overwrite") -> None:
    """Delimited table (manifest, allocation, pairs, classes, BED, selection)."""
    flat = df.select([F.array_join(c, ";").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes])
    flat.write.mode(mode).csv(path, sep=sep, header=header)


def sample_sheet() -> str:
    """Empty sample sheet: the header a user fills in below."""
    return "\t".join(SAMPLE_SHEET_HEADER) + "\n"


def partition_document(folder: str, dataset: str) -> str:
    """NEXUS partition file for the gapless DNA part and the recoded gap part."""
    # Names of the two parts, lines of the partition file and its models.
    dna, gaps = (f"{folder}/{dataset}_{part}.phylip-relaxed" for part in ("NoGaps", "RecodedGaps"))
    rows = [
        "#nexus",
        "begin sets;",
        f"\tcharset part1 = {dna}:*;",
        f"\tcharset part2 = {gaps}:*;",
        "\tcharpartition mine = GTR+G+ASC:part1, GTR2+ASC:part2;",
        "end;",
    ]
    return "\n".join(rows)
