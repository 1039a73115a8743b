"""Read manifests: validation, pairing of read files and duplicate checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewright.schema import UNKNOWN_GROUP


class ManifestError(ValueError):
    """A manifest that the run cannot use; ``offenders`` is the table of all rows at fault, if there is one."""

    def __init__(self, message: str, offenders: DataFrame | None = None) -> None:
        super().__init__(message)
        self.offenders = offenders


def raise_all(offenders: DataFrame, what: str, error: type = ManifestError) -> None:
    """Raise if there are offenders: their number and one of them in the message, all of them as a table."""
    number = offenders.count()
    if number:
        first = offenders.orderBy(*offenders.columns).first()
        raise error(f"{what}: {number}, such as {': '.join(str(x) for x in first)}", offenders)


def drop_header(rows: DataFrame) -> DataFrame:
    """Remove the header row of a manifest read without header."""
    return rows.filter(F.coalesce(F.col("sample_id") != "Sample_ID", F.lit(True)))


def absolute_paths(rows: DataFrame, base: str) -> DataFrame:
    """Read paths without a leading slash or scheme, taken from ``base``."""
    for end in ("forward", "reverse"):
        path = F.col(end)
        rows = rows.withColumn(end, F.when(path.rlike(r"^(/|\w+:)"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path)))
    return rows


def manifest_errors(rows: DataFrame, files: DataFrame | None = None, reverse_only: bool = False) -> DataFrame:
    """Problems as ``(sample_id, problem)``. ``files`` (one ``path`` per row) checks existence.

    ``reverse_only`` admits rows that name a reverse read alone, as flat listings do.
    """
    sid, fwd, rev = F.col("sample_id"), F.col("forward"), F.col("reverse")
    problem = (
        F.when(sid.isNull(), "sample id is empty")
        .when(fwd.isNull() & rev.isNull(), "both reads are empty")
        .when(fwd.isNull() & F.lit(not reverse_only), "reverse read without forward read")
    )
    found = rows.select(sid, problem.alias("problem")).filter(F.col("problem").isNotNull())
    if files is not None:
        named = rows.select(sid, F.explode_outer(F.array(fwd, rev)).alias("path")).filter("path is not null")
        absent = named.join(files.select("path"), "path", "left_anti")
        found = found.unionByName(absent.select(sid, F.concat(F.lit("read file is missing: "), "path").alias("problem")))
    return found


def resolve_manifest(rows: DataFrame) -> DataFrame:
    """Valid rows as ``(sample_id, grp, reads)``; an empty group becomes ``Unknown``."""
    return rows.select(
        "sample_id",
        F.coalesce("grp", F.lit(UNKNOWN_GROUP)).alias("grp"),
        F.array_compact(F.array("forward", "reverse")).alias("reads"),
    )


def reads_text(reads: Column | str = "reads") -> Column:
    """One path, or both joined by ``;``."""
    return F.array_join(reads, ";")


def _without(name: Column, suffix: str) -> Column:
    return F.replace(name, F.lit(suffix), F.lit(""))


def pair_reads(
    files: DataFrame,
    filetype: str = "fastq.gz",
    forward_suffix: str = "_1.fastq.gz",
    reverse_suffix: str = "_2.fastq.gz",
) -> DataFrame:
    """Pair read files of ``(grp, path)`` by their stem; the rest are single-end.

    Pairs are found by one aggregation on group and stem, in place of a self-join.
    """
    dot = filetype if filetype.startswith(".") else "." + filetype
    path, name = F.col("path"), F.regexp_extract("path", r"([^/]*)$", 1)
    side = F.when(F.endswith(path, F.lit(forward_suffix)), "f").when(F.endswith(path, F.lit(reverse_suffix)), "r")
    stem = F.when(side == "f", _without(path, forward_suffix)).when(side == "r", _without(path, reverse_suffix))
    base = F.when(side == "f", _without(name, forward_suffix)).otherwise(_without(name, dot))
    tagged = files.select("grp", path.alias("path"), side.alias("side"), F.coalesce(stem, path).alias("stem"), base.alias("base"))
    pick = lambda which, col: F.max(F.when(F.col("side") == which, F.col(col)))
    grouped = tagged.groupBy("grp", "stem").agg(
        pick("f", "path").alias("fwd"),
        pick("r", "path").alias("rev"),
        pick("f", "base").alias("fwd_base"),
        pick("r", "base").alias("rev_base"),
        F.max(F.when(F.col("side").isNull(), F.col("path"))).alias("single"),
        F.max(F.when(F.col("side").isNull(), F.col("base"))).alias("single_base"),
    )
    entry = lambda sid, *reads: F.struct(sid.alias("sample_id"), F.array(*reads).alias("reads"))
    fwd, rev = F.col("fwd"), F.col("rev")
    entries = F.array_compact(
        F.array(
            F.when(fwd.isNotNull() & rev.isNotNull(), entry(F.col("fwd_base"), fwd, rev))
            .when(fwd.isNotNull(), entry(F.col("fwd_base"), fwd))
            .when(rev.isNotNull(), entry(F.col("rev_base"), rev)),
            F.when(F.col("single").isNotNull(), entry(F.col("single_base"), F.col("single"))),
        )
    )
    return grouped.select("grp", F.explode_outer(entries).alias("e")).select("e.sample_id", "grp", "e.reads")


def group_of(path: Column | str, root: str) -> Column:
    """Group of a read file: its subfolder below ``root``, else ``Unknown``.

    Deeper levels give NULL, for they are not scanned.
    """
    path = F.col(path) if isinstance(path, str) else path
    rest = F.substring(path, F.lit(len(root.rstrip("/")) + 2), F.length(path))
    parts = F.split(rest, "/")
    return F.when(F.size(parts) == 1, F.lit(UNKNOWN_GROUP)).when(F.size(parts) == 2, F.get(parts, F.lit(0)))


def skip_undetermined(files: DataFrame) -> DataFrame:
    """Leave out read files a sequencer could not assign."""
    return files.filter(~F.startswith(F.regexp_extract("path", r"([^/]*)$", 1), F.lit("Undetermined_")))


def legacy_listing(paired: DataFrame) -> DataFrame:
    """Flat-folder form: ``base, Paired|Single, paths``."""
    return paired.select(
        F.col("sample_id").alias("base"),
        F.when(F.size("reads") == 2, "Paired").otherwise("Single").alias("layout"),
        reads_text().alias("paths"),
    )


def duplicates(manifest: DataFrame, key: Column | str) -> DataFrame:
    """Values of ``key`` that occur more than once, with their count."""
    key = F.col(key) if isinstance(key, str) else key
    return manifest.groupBy(key.alias("value")).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_manifest(manifest: DataFrame) -> DataFrame:
    """Raise when a manifest is empty or repeats a sample or its reads."""
    if manifest.isEmpty():
        raise ManifestError("no reads detected")
    for label, key in (("sample ids", F.col("sample_id")), ("reads", reads_text())):
        raise_all(duplicates(manifest, key), f"duplicate {label}")
    return manifest
