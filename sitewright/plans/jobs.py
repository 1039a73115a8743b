"""Whole runs from files to files. Tables between steps are Parquet."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.operators import alignment as AL
from sitewright.operators import allocation as B
from sitewright.operators import assembly as A
from sitewright.operators import calling as CA
from sitewright.operators import clustering as K
from sitewright.operators import compare as CO
from sitewright.operators import distance as D
from sitewright.operators import genome as G
from sitewright.operators import manifest as M
from sitewright.operators import projection as P
from sitewright.operators import reports as R
from sitewright.operators import selection as S
from sitewright.session import materialise
from sitewright.sinks import documents as DOC
from sitewright.sources import alignments, evidence, lines, manifests, sequences


def _stored(df: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None) -> DataFrame:
    """Write a table and read it back; ``by`` makes one folder per value.

    Rebalancing on that column keeps the number of files low and splits a large value.
    """
    if by is not None:
        df = df.hint("rebalance", by)
    df.write.mode(mode).parquet(path, partitionBy=by)
    return df.sparkSession.read.parquet(path)


def _renamed_folders(spark: SparkSession, path: str, by: str, values: list, target: str) -> None:
    """Folders ``<by>=<value>`` of one job under the names of their documents; only names are changed."""
    for value in values:
        lines.move_folder(spark, f"{path}/{by}={value}", target.format(value))


def _reported(spark: SparkSession, out: str, step):
    """Run ``step``; before a refusal goes on, all rows at fault are written to ``out``/offenders."""
    try:
        return step()
    except M.ManifestError as refusal:
        if refusal.offenders is not None:
            DOC.write_table(refusal.offenders, f"{out}/offenders")
        raise


class PileupError(M.ManifestError):
    """Pileups that cannot stand for their taxa."""


def check_roster(spark: SparkSession, pileups: str, calls: DataFrame | None = None) -> DataFrame:
    """Taxa below ``pileups``; raises unless each has one pileup file, and rows in ``calls`` if these are given."""
    folders = spark.createDataFrame([(n,) for n in lines.entries(spark, pileups, folders_only=True)], "taxon string")
    roster = materialise(evidence.taxon_roster(folders, lines.list_files(spark, pileups, ".pileups")))
    M.raise_all(roster.filter("n <> 1"), "taxa without exactly one pileup file", PileupError)
    if calls is not None:
        M.raise_all(roster.select("taxon").join(calls.select("taxon").distinct(), "taxon", "left_anti"), "taxa without data", PileupError)
    return roster


# Column names of the subset scheme and of the reference table, as users know them.
SCHEME_NAMES = {"sample_id": "Sample_ID", "grp": "Pangenome_Group", "reads": "Read_Location", "read_count": "Read_Count", "base_count": "Base_Count", "to_sample": "ToSample"}
REFERENCE_NAMES = {"isolate": "Isolate_ID", "cluster": "Cluster", "path": "Path"}
REFERENCE_COLUMNS = ["Isolate_ID", "Cluster", "Path", "Contigs", "Length", "N50", "N90", "L50", "L90", "N50_Zscore", "Mean_Distance", "Mean_Distance_Zscore", "Base_Score", "Prop", "Is_Ref"]


def published_scheme(scheme: DataFrame) -> DataFrame:
    """The subset scheme under its published column names."""
    return scheme.select(*[F.col(c).alias(n) for c, n in SCHEME_NAMES.items() if c in scheme.columns])


def published_references(chosen: DataFrame, isolates: DataFrame) -> DataFrame:
    """The considered assemblies under their published column names, references first in order of choice, then by falling base score."""
    named = chosen if "isolate" in chosen.columns else chosen.join(isolates.select("id", "isolate"), "id", "left")
    ordered = S.output_order(named.withColumnsRenamed(REFERENCE_NAMES))
    return ordered.select(*[c for c in REFERENCE_COLUMNS if c in ordered.columns])


def prepare_reads(
    spark: SparkSession,
    reads: str,
    out: str,
    genome_size: int,
    coverage: float = 10.0,
    filetype: str = "fastq.gz",
    forward_suffix: str = "_1.fastq.gz",
    reverse_suffix: str = "_2.fastq.gz",
    seed: str = "0",
) -> DataFrame:
    """Manifest, counts, allocation and subsampled reads, as tables and as FASTQ text. Returns the allocation.

    The reads are parsed once; statistics and sample come from the stored table.
    """
    found = _reported(spark, out, lambda: manifests.fetch_manifest(spark, reads, filetype, forward_suffix, reverse_suffix))
    manifest = _stored(found, f"{out}/manifest")
    files = manifest.select(F.explode("reads").alias("path"))
    paths = [r["path"] for r in files.toLocalIterator()]
    parsed = sequences.parse_fastq_records(lines.read_records(spark, paths))
    records = _stored(sequences.ends_of_samples(manifest, parsed), f"{out}/reads", by="sample_id")
    stats = _stored(B.join_statistics(manifest, B.read_statistics(records)), f"{out}/read_statistics")
    scheme = _stored(B.allocate(stats, genome_size, coverage), f"{out}/subset_scheme")
    DOC.write_table(published_scheme(scheme), f"{out}/subset_scheme_csv", sep=",")
    DOC.write_lines(B.allocation_log(stats, genome_size, coverage), ["line_no", "line"], f"{out}/subset_log")
    kept = _stored(B.subsample_pairs(records, scheme, seed), f"{out}/subset_reads", by="sample_id")
    DOC.write_fastq(kept, f"{out}/subset_fastq")
    return scheme


def process_pangenome(spark: SparkSession, fasta: str, out: str, prefix: str = "PG") -> tuple[str, str]:
    """Contig table, lengths, site list and metrics of an assembly; never overwrites."""
    if lines.is_folder(spark, out):
        raise FileExistsError(out)
    chunks = G.rename_contigs(sequences.read_fasta(spark, fasta), prefix)
    contigs = _stored(chunks.drop("file"), f"{out}/contigs")
    lengths = _stored(G.contig_lengths(contigs), f"{out}/lengths")
    DOC.write_fasta(contigs, f"{out}/contigs.fa")
    ordered = lengths.withColumn("line", F.concat_ws("\t", "contig", "length"))
    DOC.write_lines(ordered, ["contig_ord"], f"{out}/contigs_SeqLength.tsv")
    DOC.write_loci(G.enumerate_sites(lengths), f"{out}/contigs_LocList")
    DOC.write_table(A.assembly_metrics(lengths.withColumn("path", F.lit(fasta))), f"{out}/metrics")
    return posixpath.basename(out.rstrip("/")), out


def validate_pangenome(spark: SparkSession, path: str, required=None) -> tuple[str, str]:
    """Name and folder of a pangenome; the folder is empty when entries are missing."""
    listing = spark.createDataFrame([(n,) for n in lines.entries(spark, path)], "name string")
    names = None if required is None else spark.createDataFrame([(n,) for n in required], "name string")
    whole = R.missing_entries(listing, names).isEmpty()
    return posixpath.basename(path.rstrip("/")), path if whole else ""


# Entries that `process_pangenome` writes.
OWN_ENTRIES = ["contigs", "contigs.fa", "contigs_LocList", "contigs_SeqLength.tsv", "lengths", "metrics"]


def fetch_pangenome(spark, path: str = "", ref_path: str = "", name: str = "", root: str = "") -> tuple[str, str]:
    """A given pangenome, one made from a reference, or one known by name."""
    if path:
        return validate_pangenome(spark, path, OWN_ENTRIES)
    if ref_path:
        return process_pangenome(spark, ref_path, posixpath.join(root, name or "pangenome"))
    if name:
        return validate_pangenome(spark, posixpath.join(root, name), OWN_ENTRIES)
    raise ValueError("no pangenome information provided")


def pangenome(spark, out: str, reads: str = "", ref_path: str = "", name: str = "pangenome", **options) -> tuple[str, str]:
    """Build a pangenome when reads are given, else fetch one.

    Assembly happens outside, so reads need the contigs in ``ref_path`` as well.
    """
    if reads and not ref_path:
        raise ValueError("a reference path is required with reads")
    if reads and not options.get("genome_size"):
        raise ValueError("a genome size is required with reads")
    lines.make_folder(spark, out)
    if not reads:
        return fetch_pangenome(spark, ref_path=ref_path, name=name, root=out)
    prepare_reads(spark, reads, f"{out}/prep_{name}", **options)
    return process_pangenome(spark, ref_path, f"{out}/{name}")


def write_call_vectors(spark, calls_path: str, pangenome: str, out: str) -> None:
    """One list per taxon: the base of every site, in site order."""
    calls = spark.read.parquet(calls_path)
    taxa = AL.taxa_of(calls)
    sites = G.enumerate_sites(spark.read.parquet(f"{pangenome}/lengths"))
    vectors = _stored(CA.call_vectors(sites, calls, taxa), f"{out}/vectors", mode="overwrite", by="taxon")
    DOC.write_text(vectors, ["contig_ord", "pos"], f"{out}/lists", column="base", by="taxon")
    _renamed_folders(spark, f"{out}/lists", "taxon", taxa, f"{out}/{{}}_LocList")


def call_taxa(spark, pileups: str, pangenome: str, out: str, minread: int, thresh: float) -> DataFrame:
    """Calls and quality of every taxon below ``pileups``."""
    _reported(spark, out, lambda: check_roster(spark, pileups))
    rows = evidence.read_pileups(spark, pileups)
    calls = _stored(CA.calls_from_pileup(rows, minread, thresh), f"{out}/calls", by="taxon")
    qc = materialise(CA.contig_quality(spark.read.parquet(f"{pangenome}/lengths"), calls))
    DOC.write_table(qc, f"{out}/call_quality")
    DOC.write_lines(CA.quality_lines(qc), ["taxon", "line_no"], f"{out}/call_log")
    called = calls.join(CA.taxa_without_calls(qc).select("taxon"), "taxon", "left_anti")
    _reported(spark, out, lambda: check_roster(spark, pileups, called))
    return calls


def taxon_genomes(spark, pileups: str, pangenome: str, out: str) -> DataFrame:
    """Taxon-specific genomes, one FASTA document per taxon."""
    _reported(spark, out, lambda: check_roster(spark, pileups))
    rows = evidence.read_pileups(spark, pileups)
    consensus = materialise(CA.majority_from_pileup(rows))
    chunks = spark.read.parquet(f"{pangenome}/contigs")
    _reported(spark, out, lambda: check_roster(spark, pileups, consensus))
    _reported(spark, out, lambda: M.raise_all(G.unknown_contigs(chunks, consensus), "contigs without sequence", PileupError))
    taxa = AL.taxa_of(consensus)
    genomes = _stored(G.overlay(chunks, consensus, taxa), f"{out}/genomes", by="taxon")
    DOC.write_fasta(genomes, f"{out}/fasta", by="taxon")
    _renamed_folders(spark, f"{out}/fasta", "taxon", taxa, f"{out}/{{}}/contigs.fa")
    return genomes


def build_alignment(spark, calls_path: str, pangenome: str, out: str, num_missing: int | None = None) -> DataFrame:
    """The five NEXUS alignments and the class report."""
    calls = spark.read.parquet(calls_path)
    taxa = AL.taxa_of(calls)
    order = spark.read.parquet(f"{pangenome}/lengths").select("contig", "contig_ord")
    variable = AL.variable_sites(AL.site_columns(calls, taxa), len(taxa), num_missing)
    classified = _stored(AL.classify_sites(variable).join(order, "contig"), f"{out}/alignment", mode="overwrite")
    _stored(spark.createDataFrame([(t,) for t in taxa], "taxon string"), f"{out}/alignment_taxa", mode="overwrite")
    for v in AL.VARIANTS:
        name = "alignment.nex" if v == "all" else f"alignment_{v}.nex"
        DOC.write_nexus(AL.select_variant(classified, v), taxa, f"{out}/{name}.parts")
    DOC.write_lines(R.class_lines(AL.class_totals(classified)), ["line_no"], f"{out}/alignment_log")
    return classified


def filter_alignment(spark, path: str, missing: int, out: str) -> DataFrame:
    """PHYLIP alignments with at most ``missing`` taxa uncalled, with and without gaps."""
    sites, taxa = alignments.read_alignment(spark, path)
    sites = materialise(sites)
    for gaps, tail in ((True, ""), (False, "_nogap")):
        kept = AL.refilter(sites, missing, gaps)
        DOC.write_phylip(kept, taxa, f"{out}/m{missing}{tail}.phylip-relaxed.parts")
        DOC.write_loci(kept, f"{out}/locs_m{missing}{tail}.txt.parts")
    report = AL.refilter_report(sites, missing)
    DOC.write_table(report, f"{out}/report_m{missing}")
    return report


def slice_alignment(spark, all_loci: str, wanted: str, path: str, dataset: str, out: str) -> DataFrame:
    """Gapless, recoded and combined alignments of the wanted loci."""
    columns, taxa = alignments.read_alignment(spark, path)
    known = lines.read_list(spark, all_loci)
    named = columns.drop("locus").join(known, "site_ord") if "site_ord" in columns.columns else columns.select("locus", "column").join(known, "locus")
    sliced = materialise(AL.slice_sites(named, lines.read_list(spark, wanted)))
    sliced = sliced.withColumn("part_ord", AL.combined_order(sliced))
    dna, gapped = sliced.filter("part = 'nogaps'"), sliced.filter("part = 'gapped'")
    DOC.write_phylip(dna, taxa, f"{out}/{dataset}_NoGaps.phylip-relaxed.parts")
    DOC.write_loci(dna, f"{out}/{dataset}_NoGaps_LocList.txt.parts")
    if not gapped.isEmpty():
        DOC.write_phylip(gapped, taxa, f"{out}/{dataset}_RecodedGaps.phylip-relaxed.parts", column="recoded")
        DOC.write_loci(gapped, f"{out}/{dataset}_Gapped_LocList.txt.parts")
        DOC.write_phylip(sliced, taxa, f"{out}/{dataset}_AllSites.phylip-relaxed.parts")
        DOC.write_loci(sliced, f"{out}/{dataset}_AllSites_LocList.txt.parts")
        lines.put_text(spark, f"{out}/{dataset}_Partition.nex", DOC.partition_document(out, dataset))
    return sliced


def _strict(path: str) -> bool:
    """Comparisons read ``.phy`` and ``.phylip`` files with names of ten letters, other PHYLIP files with names up to a blank."""
    return path.rsplit(".", 1)[-1] in ("phy", "phylip")


def compare_taxa(spark, path: str, out: str) -> DataFrame:
    sites, taxa = alignments.read_alignment(spark, path, strict=_strict(path))
    pairs = CO.pairwise_identity(sites, taxa)
    DOC.write_table(pairs, out)
    return pairs


def classify_samples(spark, path: str, references: str, out: str) -> DataFrame:
    """``references``: names joined by ``;``."""
    sites, taxa = alignments.read_alignment(spark, path, strict=_strict(path))
    classes = CO.classify_samples(sites, taxa, references.split(";"))
    DOC.write_table(classes, out)
    return classes


def map_genome(spark, path: str, out: str) -> DataFrame:
    """Whole and overlap-free BED of a genome map, and the overlap report."""
    maps = evidence.read_map_data(spark, path)
    runs = materialise(P.aligned_runs(maps))
    bed = _stored(P.project(maps), f"{out}/mapped", mode="overwrite")
    DOC.write_table(bed, f"{out}/mapped_bed", header=False)
    DOC.write_table(P.unique_bases(runs), f"{out}/mapped_nondup_bed", header=False)
    report = P.overlap_report_of_runs(runs)
    DOC.write_table(report, f"{out}/report")
    return report


def choose_references(spark, triangle: str, ref_count: int, out: str, trim_name: str = "") -> DataFrame:
    """Reference isolates from a distance triangle that names the assembly files."""
    isolates, edges = evidence.read_triangle(spark, triangle, trim_name)
    isolates, edges = materialise(isolates), materialise(edges)
    files = [r["path"] for r in isolates.select("path").toLocalIterator()]
    located = G.contig_lengths(sequences.read_fasta(spark, files).withColumn("contig", F.struct("file", "contig_ord")))
    contigs = located.select(F.regexp_replace("contig.file", "^file:/*", "/").alias("path"), "length")
    chosen = materialise(S.select_references(isolates, contigs, edges, ref_count))
    DOC.write_table(published_references(chosen, isolates), out)
    return chosen


def _labelled(spark, triangle: str, labels: str, trim_name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Isolates and edges of a triangle, and ``(id, grp)`` from lines ``isolate<TAB>group``; -1 or no line is no group."""
    isolates, edges = evidence.read_triangle(spark, triangle, trim_name)
    isolates = materialise(isolates)
    given = spark.read.schema("isolate string, grp int").csv(labels, sep="\t", mode="FAILFAST")
    groups = isolates.select("id", "isolate").join(given, "isolate", "left").select("id", F.when(F.col("grp") >= 0, F.col("grp")).alias("grp"))
    return isolates, materialise(edges), materialise(groups)


def check_groups(spark, triangle: str, labels: str, out: str, trim_name: str = "") -> DataFrame:
    """Whether isolates are closer within their groups than between them; isolates without group do not count."""
    _, edges, groups = _labelled(spark, triangle, labels, trim_name)
    found = D.validate_groups(edges, groups.filter("grp is not null"))
    DOC.write_table(found, out)
    return found


def assign_groups(spark, triangle: str, labels: str, out: str, threshold: float = 1.0, trim_name: str = "") -> DataFrame:
    """Groups of all isolates, those without one from their nearest grouped isolate."""
    isolates, edges, groups = _labelled(spark, triangle, labels, trim_name)
    found = isolates.select("id", "isolate").join(D.assign_unknown(edges, groups, threshold), "id").select("isolate", "grp")
    DOC.write_table(found, out)
    return found


def cluster_isolates(spark, triangle: str, out: str, method: str = "gmm", max_clusters: int = 10, trim_name: str = "") -> DataFrame:
    """Clusters of isolates by their distance rows."""
    isolates, edges = evidence.read_triangle(spark, triangle, trim_name)
    isolates = materialise(isolates)
    rows = materialise(K.distance_rows(edges, isolates.select("id")))
    found = isolates.select("id", "isolate").join(K.by_smallest(K.cluster_unknown(rows, max_clusters, method)), "id").select("isolate", "cluster")
    DOC.write_table(found, out)
    return found


def run_log(spark, root: str, alignment_log: str, out: str) -> DataFrame:
    """Mapping, site selection and alignment figures of a run in one document."""
    tool = lines.read_log(spark, root, glob="err_*")
    site = lines.read_log(spark, root, glob="out_*")
    log = R.run_log(tool, site, lines.read_log(spark, alignment_log))
    DOC.write_lines(R.log_document(materialise(log)), ["part", "taxon", "section", "at"], out)
    return log


def check_manifest(spark, location: str, out: str, **options) -> DataFrame:
    manifest = _reported(spark, out, lambda: manifests.fetch_manifest(spark, location, **options))
    DOC.write_table(manifest, out, sep=",", header=False)
    return M.check_manifest(manifest)
