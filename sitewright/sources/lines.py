"""Text records with their exact position in the file."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewright.session import written


def _raw(spark: SparkSession, path, line_sep: str | None, glob: str | None) -> DataFrame:
    reader = spark.read
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"),
        "value",
    )


def read_ordered(spark: SparkSession, path, line_sep: str | None = None, glob: str | None = None) -> DataFrame:
    """Records as ``(file, line_no, value)`` with rising but not dense numbers: no join.

    A number is the byte at which the split begins plus the record's place in its task.
    A task holds fewer records than bytes, so numbers of later splits are higher.
    """
    place = F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))
    return _raw(spark, path, line_sep, glob).select("file", (F.col("block") + place).alias("line_no"), "value")


def read_records(spark: SparkSession, path, line_sep: str | None = None, glob: str | None = None) -> DataFrame:
    """Lines as ``(file, line_no, value)``, numbered from 0 in file order.

    Each input split is numbered on its own; the number of records before a split comes
    from a stored table with one row per split, which the planner broadcasts while its bytes are
    few. Nothing is sorted or gathered.
    """
    raw = _raw(spark, path, line_sep, glob)
    splits = raw.groupBy("file", "block").agg(F.min("mid").alias("first"), F.count("*").alias("n"))
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    offsets = written(offsets, "file")
    return raw.join(offsets, ["file", "block"]).select(
        "file", (F.col("mid") - F.col("first") + F.col("before")).alias("line_no"), "value"
    )


def read_list(spark: SparkSession, path) -> DataFrame:
    """A site list, one locus per line, as ``(site_ord, locus)``."""
    lines = read_records(spark, path).filter(F.length(F.trim("value")) > 0)
    return lines.select(F.col("line_no").alias("site_ord"), F.trim("value").alias("locus"))


def read_log(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """Log lines as ``(taxon, line_no, line)``; the folder names the taxon."""
    lines = read_records(spark, path, glob=glob)
    return lines.select(parent_folder("file").alias("taxon"), "line_no", F.col("value").alias("line"))


def parent_folder(path):
    return F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` from the root of its file system, in the form in which listings show it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return re.sub("^file:/*", "/", whole)


def is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def entries(spark: SparkSession, path: str, folders_only: bool = False) -> list[str]:
    """Names in a folder of any file system, in order."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    return sorted(f.getPath().getName() for f in found if f.isDirectory() or not folders_only)


def _opened(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder below an existing one."""
    at, fs = _opened(spark, qualified(spark, path))
    if not fs.exists(at):
        if at.getParent() is not None and not fs.exists(at.getParent()):
            raise FileNotFoundError(at.getParent().toString())
        fs.mkdirs(at)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder another name, in place of what had it."""
    at, fs = _opened(spark, path)
    to, _ = _opened(spark, target)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{path} cannot be moved to {target}")


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A short file, written whole."""
    at, fs = _opened(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def list_files(spark: SparkSession, root: str | list[str], suffix: str = "", recursive: bool = True) -> DataFrame:
    """Paths below ``root`` that end in ``suffix``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if suffix:
        found = found.option("pathGlobFilter", "*" + suffix)
    return found.load(root).select(F.regexp_replace("path", "^file:/*", "/").alias("path"))
