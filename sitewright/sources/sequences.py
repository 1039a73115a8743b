"""FASTA and FASTQ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.operators.genome import SPAN, rechunk
from sitewright.sources import ranges
from sitewright.sources.lines import read_ordered, read_records


def parse_fasta(records: DataFrame) -> DataFrame:
    """FASTA records (text between ``>`` marks at line starts) as ``(file, contig_ord, contig, seq)``."""
    body = F.regexp_replace("value", "^>", "")
    head = F.regexp_extract(body, r"^[^\n]*", 0)
    seq = F.regexp_replace(F.substring(body, F.length(head) + 1, F.length(body)), r"\s", "")
    return records.filter(F.length(F.trim(body)) > 0).select(
        "file", F.col("line_no").alias("contig_ord"), F.regexp_extract(head, r"^\s*(\S*)", 1).alias("contig"), seq.alias("seq")
    )


def read_fasta(spark: SparkSession, path, glob: str | None = None, span: int = SPAN) -> DataFrame:
    """Sequences as chunks ``(file, contig_ord, contig, offset, seq)`` of bounded size.

    Files are read in byte ranges, so a contig may be longer than any record, on one line or many;
    compressed files and stores that only Spark opens are read contig by contig.
    """
    listing = ranges.listed(spark, path, glob)
    if ranges.can_cut(listing):
        return ranges.fasta_chunks(ranges.blobs_of(listing), span)
    whole = parse_fasta(read_ordered(spark, path, line_sep="\n>", glob=glob))
    return rechunk(whole.withColumn("offset", F.lit(0).cast("bigint")), span)


def parse_fastq(lines: DataFrame) -> DataFrame:
    """The sequence line of each four-line record as ``(file, read_no, seq)``."""
    return lines.filter(F.col("line_no") % 4 == 1).select(
        "file", F.expr("line_no div 4").alias("read_no"), F.trim("value").alias("seq")
    )


def parse_fastq_records(lines: DataFrame) -> DataFrame:
    """Whole four-line records as ``(file, read_no, name, seq, qual)``; the name has no ``@``."""
    at = lambda n: F.max(F.when(F.col("line_no") % 4 == n, F.trim("value")))
    records = lines.groupBy("file", F.expr("line_no div 4").alias("read_no")).agg(at(0).alias("name"), at(1).alias("seq"), at(3).alias("qual"))
    return records.filter(F.col("seq").isNotNull()).withColumn("name", F.regexp_replace("name", "^@", ""))


def read_fastq(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    return parse_fastq(read_records(spark, path, glob=glob))


def reads_of_samples(manifest: DataFrame, reads: DataFrame) -> DataFrame:
    """Reads with the sample whose manifest row names their file."""
    owner = manifest.select("sample_id", F.explode("reads").alias("path"))
    located = reads.withColumn("path", F.regexp_replace("file", "^file:/*", "/"))
    return located.join(owner, "path").select("sample_id", F.concat_ws(":", "path", "read_no").alias("read_key"), "seq")


def ends_of_samples(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """FASTQ records with their sample and end (1, or 2 for the reverse file); mates have the same ``read_no``."""
    owner = manifest.select("sample_id", F.posexplode("reads").alias("end", "path")).withColumn("end", F.col("end") + 1)
    located = records.withColumn("path", F.regexp_replace("file", "^file:/*", "/"))
    return located.join(owner, "path").select("sample_id", "end", "read_no", "name", "seq", "qual")
