"""Run reports from the logs of the tools and from our own figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.schema import PANGENOME_FILES

# What marks a mapping report, and which lines of the listing belong to
# the first and to the second mapping.
MARK = "of these"
AFTER = 4
RANGES = {"composite": (2, 6), "specific": (9, 13)}
SITE_LINE = "Of "


def context_lines(lines: DataFrame, mark: str = MARK, after: int = AFTER, upto: int = 13) -> DataFrame:
    """First ``upto`` listed lines per taxon: marked lines and those just after them.

    A ``--`` line separates stretches that do not touch. The row number limit is applied
    before the shuffle, so a taxon with a very long log stays small.
    """
    wanted = (
        lines.filter(F.contains("line", F.lit(mark)))
        .select("taxon", F.explode_outer(F.sequence(F.col("line_no"), F.col("line_no") + after)).alias("line_no"))
        .distinct()
    )
    per_taxon = W.partitionBy("taxon").orderBy("line_no")
    found = (
        lines.join(wanted, ["taxon", "line_no"], "left_semi")
        .withColumn("rank", F.row_number().over(per_taxon))
        .filter(F.col("rank") <= upto)
    )
    gap = F.col("line_no") - F.lag("line_no").over(per_taxon) > 1
    placed = found.withColumn("new", F.coalesce(gap, F.lit(False)).cast("int")).withColumn(
        "at", F.col("rank") + F.sum("new").over(per_taxon)
    )
    text = F.struct("at", "line")
    rule = F.struct((F.col("at") - 1).alias("at"), F.lit("--").alias("line"))
    rows = placed.select("taxon", F.explode_outer(F.when(F.col("new") == 1, F.array(rule, text)).otherwise(F.array(text))).alias("r"))
    return rows.select("taxon", F.col("r.at").cast("int").alias("at"), F.col("r.line").alias("line")).filter(F.col("at") <= upto)


def mapping_reports(lines: DataFrame, mark: str = MARK) -> DataFrame:
    """Mapping figures per taxon as ``(taxon, section, at, line)``."""
    listed = context_lines(lines, mark)
    section = None
    for name, (low, high) in RANGES.items():
        inside = F.col("at").between(low, high)
        section = F.when(inside, name) if section is None else section.when(inside, name)
    return listed.select("taxon", section.alias("section"), "at", "line").filter(F.col("section").isNotNull())


def site_reports(lines: DataFrame, prefix: str = SITE_LINE) -> DataFrame:
    """Site selection lines of a taxon's log."""
    return lines.filter(F.startswith("line", F.lit(prefix))).select("taxon", "line_no", "line")


def run_log(tool_lines: DataFrame, site_lines: DataFrame, alignment_lines: DataFrame, mark: str = MARK, prefix: str = SITE_LINE) -> DataFrame:
    """Whole run log as ordered ``(part, taxon, section, at, line)`` rows."""
    mapping = mapping_reports(tool_lines, mark).select(F.lit(0).alias("part"), "taxon", "section", F.col("at").cast("bigint").alias("at"), "line")
    sites = site_reports(site_lines, prefix).select(F.lit(0).alias("part"), "taxon", F.lit("taxon sites").alias("section"), F.col("line_no").cast("bigint").alias("at"), "line")
    final = alignment_lines.select(
        F.lit(1).alias("part"), F.lit(None).cast("string").alias("taxon"), F.lit("alignment").alias("section"),
        F.col("line_no").cast("bigint").alias("at"), "line",
    )
    return mapping.unionByName(sites).unionByName(final)


# Headings of the run log's sections.
OPENING = "Read Mapping and Site Selection:"
HEADINGS = {"composite": "Composite Genome Mapping:", "specific": "Specific Genome Mapping:", "taxon sites": "Site Selection:"}
CLOSING = "Alignment Filtering:"


def log_document(log: DataFrame) -> DataFrame:
    """The run log with a heading before each section, between blank lines; a taxon's headings are there even if a section is empty."""
    blank = lambda text: [("", -3), (text, -2), ("", -1)]
    row = lambda part, section, at, line: F.struct(F.lit(part).alias("part"), F.lit(section).cast("string").alias("section"), F.lit(at).cast("bigint").alias("at"), line.alias("line"))
    each = [row(0, section, at, F.concat(F.col("taxon"), F.lit(" " + text)) if text else F.lit("")) for section, head in HEADINGS.items() for text, at in blank(head)]
    per_taxon = log.where("taxon is not null").select("taxon").distinct().select("taxon", F.explode(F.array(*each)).alias("h"))
    whole = log.sparkSession.createDataFrame([(0, None, None, -2, ""), (0, None, None, -1, OPENING), *[(1, None, None, at, text) for text, at in blank(CLOSING)]], "part int, taxon string, section string, at bigint, line string")
    return log.unionByName(per_taxon.select("h.part", "taxon", "h.section", "h.at", "h.line")).unionByName(whole)


def missing_entries(listing: DataFrame, required: DataFrame | None = None) -> DataFrame:
    """Required names (those of a finished pangenome by default) that ``listing`` lacks."""
    if required is None:
        required = listing.sparkSession.createDataFrame([(n,) for n in PANGENOME_FILES], "name string")
    return required.select("name").join(listing.select("name").distinct(), "name", "left_anti")


def class_lines(totals: DataFrame) -> DataFrame:
    """Alignment summary lines, ``(line_no, line)``."""
    # Sentences of the alignment summary and the file each one is about.
    say = lambda col, text: F.format_string("%d " + text, col)
    return totals.select(
        F.posexplode(
            F.array(
                say("variable_sites", "total variable sites [alignment.nex]"),
                say("singleton_sites", "variable sites are singletons [alignment_singletons.nex]"),
                say("with_singleton_sites", "variable sites contain singletons [alignment_pi_singletons.nex]"),
                say("informative_sites", "variable sites contain no singletons [alignment_pi.nex]"),
                say("biallelic_sites", "variable sites are biallelic without singletons [alignment_bi.nex]"),
            )
        ).alias("line_no", "line")
    )
