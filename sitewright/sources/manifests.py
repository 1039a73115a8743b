"""Read manifests from a CSV file or from a folder of read files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.operators import manifest as M
from sitewright.schema import MANIFEST
from sitewright.sources.lines import is_folder, list_files, qualified


def read_manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a four-column manifest with absolute paths; other widths are an error."""
    rows = M.drop_header(spark.read.schema(MANIFEST).csv(path, header=False, mode="FAILFAST"))
    return M.absolute_paths(rows, os.getcwd())


def named_files(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The files in the folders that the rows name; a folder reaches the driver once, however many files it has."""
    paths = rows.select(F.explode(F.array_compact(F.array("forward", "reverse"))).alias("path"))
    folders = [r[0] for r in paths.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1)).distinct().collect()]
    there = [f or "/" for f in folders if is_folder(spark, f or "/")]
    return list_files(spark, there, recursive=False) if there else spark.createDataFrame([], "path string")


def manifest_from_csv(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """Checked rows of a CSV manifest; ``files`` (one ``path`` per row) are the files that exist, looked up if not given."""
    rows = read_manifest_rows(spark, path)
    M.raise_all(M.manifest_errors(rows, named_files(spark, rows) if files is None else files), "unusable rows")
    return M.resolve_manifest(rows)


def read_folder(spark: SparkSession, root: str, filetype: str = "fastq.gz") -> DataFrame:
    """Read files of a folder and its direct subfolders as ``(grp, path)``; ``root`` may be relative or a URI."""
    dot = filetype if filetype.startswith(".") else "." + filetype
    files = list_files(spark, root, dot)
    grouped = files.select(M.group_of("path", qualified(spark, root)).alias("grp"), "path").filter(F.col("grp").isNotNull())
    if grouped.isEmpty():
        raise M.ManifestError(f"no {dot} files in {root}")
    return grouped


def fetch_manifest(
    spark: SparkSession,
    location: str,
    filetype: str = "fastq.gz",
    forward_suffix: str = "_1.fastq.gz",
    reverse_suffix: str = "_2.fastq.gz",
    ignore_undetermined: bool = False,
    files: DataFrame | None = None,
) -> DataFrame:
    """Checked manifest ``(sample_id, grp, reads)`` from a CSV file or a folder."""
    if location.endswith(".csv"):
        return M.check_manifest(manifest_from_csv(spark, location, files))
    found = read_folder(spark, location, filetype)
    if ignore_undetermined:
        found = M.skip_undetermined(found)
    return M.check_manifest(M.pair_reads(found, filetype, forward_suffix, reverse_suffix))
