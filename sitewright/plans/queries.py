"""Registered queries: the operators on tables derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.functions import cigar as C
from sitewright.functions.text import isolate_id
from sitewright.operators import agglomerate as AG
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
from sitewright.operators import stacks as ST
from sitewright.plans import adapters as X
from sitewright.plans import jobs
from sitewright.session import materialise
from sitewright.sinks import documents as DOC
from sitewright.sources import alignments, ranges
from sitewright.sources.evidence import parse_pileup, parse_triangle, taxa_with_many_pileups
from sitewright.sources.evidence import taxon_roster as roster_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

GENOME_SIZE, COVERAGE = 20_000_000_000, 10.0


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---- evidence and calls


def _votes(spark, sf_dir):
    return CA.pool_evidence(X.pileup(spark, sf_dir))


def _calls(spark, sf_dir):
    return CA.calls_from_votes(_votes(spark, sf_dir), X.MINREAD, X.THRESH)


def _columns(spark, sf_dir):
    return AL.site_columns(_calls(spark, sf_dir), X.TAXA)


def _variable(spark, sf_dir):
    return AL.variable_sites(_columns(spark, sf_dir), len(X.TAXA), X.NUM_MISSING)


def _classified(spark, sf_dir):
    return AL.classify_sites(_variable(spark, sf_dir))


@query
def pileup_scan(spark, sf_dir):
    return parse_pileup(X.pileup_lines(spark, sf_dir))


@query
def pileup_decode(spark, sf_dir):
    decoded = CA.decode_pileup(X.pileup(spark, sf_dir))
    return decoded.select("taxon", "contig", "pos", "depth", "decoded")


@query
def depth_mismatches(spark, sf_dir):
    bad = CA.depth_mismatches(X.mixed_pileup(spark, sf_dir))
    return bad.groupBy("taxon").agg(F.count("*").alias("n_rows"))


@query
def mixed_decode(spark, sf_dir):
    """Pileup strings of many reads: starts, ends, indels, skips and unknown bases in one."""
    return CA.decode_pileup(X.mixed_pileup(spark, sf_dir)).select("taxon", "contig", "pos", "depth", "decoded")


@query
def site_calls(spark, sf_dir):
    """The production path: a call from each pileup row, without pooling votes."""
    return CA.calls_from_pileup(X.mixed_pileup(spark, sf_dir), 3, 0.8)


@query
def site_calls_half(spark, sf_dir):
    """Calls at half the votes, where the base seen first wins a tie."""
    return CA.calls_from_pileup(X.mixed_pileup(spark, sf_dir), 1, 0.5)


@query
def site_majority(spark, sf_dir):
    return CA.majority_from_pileup(X.mixed_pileup(spark, sf_dir))


@query
def base_votes(spark, sf_dir):
    return _votes(spark, sf_dir)


@query
def majority_consensus(spark, sf_dir):
    return CA.majority_from_votes(_votes(spark, sf_dir))


@query
def thresholded_calls(spark, sf_dir):
    return _calls(spark, sf_dir)


@query
def call_vectors(spark, sf_dir):
    calls = _calls(spark, sf_dir).drop("penalty")
    return CA.call_vectors(X.sites(spark, sf_dir), calls, X.TAXA).drop("contig_ord")


@query
def call_quality(spark, sf_dir):
    return CA.call_quality(X.sites(spark, sf_dir), _calls(spark, sf_dir))


@query
def contig_quality(spark, sf_dir):
    return CA.contig_quality(G.contig_lengths(X.composite(spark, sf_dir)), _calls(spark, sf_dir))


@query
def quality_lines(spark, sf_dir):
    return CA.quality_lines(CA.call_quality(X.sites(spark, sf_dir), _calls(spark, sf_dir)))


@query
def taxon_genomes(spark, sf_dir):
    """Genomes put together from chunks shorter than the contigs."""
    consensus = CA.majority_from_votes(_votes(spark, sf_dir))
    chunks = G.overlay(X.composite(spark, sf_dir), consensus, X.TAXA, span=16, tile=3)
    parts = F.array_sort(F.collect_list(F.struct("offset", "seq")))
    return chunks.groupBy("taxon", "contig").agg(F.array_join(F.transform(parts, lambda p: p["seq"]), "").alias("seq"))


# ---- contigs and sites


@query
def fasta_reading(spark, sf_dir):
    """Chunks of contigs whose header and letters lie in different pieces of a file."""
    return ranges.fasta_chunks(X.fasta_pieces(spark, sf_dir), 16).drop("contig_ord")


@query
def phylip_reading(spark, sf_dir):
    """Columns of an interleaved alignment with names of ten letters."""
    return alignments.sequence_columns(ranges.phylip_fragments(X.phylip_pieces(spark, sf_dir), strict=True), 6)


@query
def nexus_reading(spark, sf_dir):
    """Columns of an alignment whose loci and sequences go on over many pieces, with their loci."""
    sequences, loci = ranges.nexus_fragments(X.nexus_pieces(spark, sf_dir))
    return alignments.sequence_columns(sequences, 6).join(loci, "site_ord", "left")


@query
def contig_lengths(spark, sf_dir):
    return G.contig_lengths(X.composite(spark, sf_dir)).drop("contig_ord")


@query
def site_enumeration(spark, sf_dir):
    return G.site_names(G.enumerate_sites(G.rename_contigs(X.contig_table(spark, sf_dir), "PG")))


@query
def renamed_contigs(spark, sf_dir):
    return G.rename_contigs(X.contig_table(spark, sf_dir), "PG")


# ---- alignments


@query
def variable_sites(spark, sf_dir):
    return _variable(spark, sf_dir)


@query
def site_classes(spark, sf_dir):
    return _classified(spark, sf_dir)


@query
def site_class_counts(spark, sf_dir):
    return _classified(spark, sf_dir).groupBy("site_class", "biallelic").agg(F.count("*").alias("n_sites"))


@query
def class_totals(spark, sf_dir):
    return AL.class_totals(_classified(spark, sf_dir))


@query
def class_report(spark, sf_dir):
    return R.class_lines(AL.class_totals(_classified(spark, sf_dir)))


@query
def alignment_blocks(spark, sf_dir):
    """Sequence pieces (one per contig) of the five alignments."""
    classified = materialise(_classified(spark, sf_dir))
    out = None
    for v in AL.VARIANTS:
        blocks = AL.taxon_blocks(AL.select_variant(classified, v), X.TAXA, ["pos"], F.col("contig"))
        rows = blocks.select(F.lit(v).alias("variant"), "taxon", F.col("block").alias("contig"), "seq")
        out = rows if out is None else out.unionByName(rows)
    return out


def _pieces(pieces):
    return pieces.select("section", F.coalesce("block.contig", F.lit("")).alias("contig"), "text")


@query
def nexus_document(spark, sf_dir):
    return _pieces(DOC.nexus_pieces(materialise(AL.select_variant(_classified(spark, sf_dir), "pi")), X.TAXA))


@query
def phylip_document(spark, sf_dir):
    return _pieces(DOC.phylip_pieces(materialise(AL.refilter(_variable(spark, sf_dir), 2, gaps=False)), X.TAXA))


@query
def missing_refilter(spark, sf_dir):
    kept = AL.refilter(_variable(spark, sf_dir), 2)
    return kept.drop(*AL.COUNTS.values()).withColumn("gapless", ~F.contains("column", F.lit("-")))


@query
def missing_report(spark, sf_dir):
    return AL.refilter_report(_variable(spark, sf_dir), 2)


@query
def site_slice(spark, sf_dir):
    """Sites on the list of loci whose part is larger than 25."""
    part = X.table(spark, sf_dir, "part").filter("p_size > 25")
    wanted = part.select(F.expr(f"concat('c', p_partkey div {X.SPAN}, '/', 1 + p_partkey % {X.SPAN})").alias("locus"))
    return AL.slice_sites(_variable(spark, sf_dir), wanted).select("locus", "column", "part", "recoded")


@query
def long_calls(spark, sf_dir):
    return AL.to_calls(_variable(spark, sf_dir), X.TAXA)


# ---- comparisons


@query
def pairwise_identity(spark, sf_dir):
    return CO.pairwise_identity(_variable(spark, sf_dir), X.TAXA)


@query
def pairwise_gaps(spark, sf_dir):
    """Pairs in small tiles; the first two taxa are never called at one site."""
    odd = F.col("pos") % 2 == 1
    first = F.when(odd, F.substring("column", 1, 1)).otherwise(F.lit("N"))
    second = F.when(odd, F.lit("N")).otherwise(F.substring("column", 2, 1))
    sites = _variable(spark, sf_dir).withColumn("column", F.concat(first, second, F.substring("column", 3, len(X.TAXA))))
    return CO.pairwise_identity(sites, X.TAXA, tile=3)


@query
def sample_classification(spark, sf_dir):
    return CO.classify_samples(_variable(spark, sf_dir), X.TAXA, X.REFERENCES)


# ---- genome projection


@query
def mapped_alignments(spark, sf_dir):
    return P.mapped_only(X.sam_rows(spark, sf_dir))


@query
def cigar_segments(spark, sf_dir):
    maps = C.with_segments(X.map_rows(spark, sf_dir))
    return maps.select("contig", "cigar", F.posexplode_outer("segs").alias("segment", "s")).select(
        "contig", "cigar", "segment", "s.size", "s.op"
    )


@query
def query_lengths(spark, sf_dir):
    lengths = P.with_query_length(X.map_rows(spark, sf_dir))
    return lengths.groupBy("direction").agg(F.count("*").alias("n_rows"), F.sum("length").alias("total_length"))


@query
def genome_projection(spark, sf_dir):
    return P.project(X.map_rows(spark, sf_dir))


@query
def unique_projection(spark, sf_dir):
    return P.unique_bases(P.aligned_runs(X.map_rows(spark, sf_dir)))


@query
def overlap_report(spark, sf_dir):
    return P.overlap_report_of_runs(P.aligned_runs(X.map_rows(spark, sf_dir)))


@query
def alignment_pileup(spark, sf_dir):
    """Pileups of aligned reads, decoded again: depth and bases of the reads at every site."""
    stacked = ST.pileup_of_reads(X.aligned_reads(spark, sf_dir), X.composite(spark, sf_dir), span=16)
    return CA.decode_pileup(stacked).select("contig", "pos", "ref", "depth", "decoded")


# ---- manifests


def _usable(rows):
    return rows.filter("sample_id is not null and forward is not null")


@query
def manifest_errors(spark, sf_dir):
    return M.manifest_errors(X.manifest_rows(spark, sf_dir))


@query
def missing_read_files(spark, sf_dir):
    """Manifest entries whose read file is not listed: customers without orders, and every seventh."""
    orders = X.table(spark, sf_dir, "orders").filter("o_custkey % 7 <> 0")
    files = orders.select(F.explode(F.array(*[F.expr(f"concat('/reads/', o_custkey, '_{i}.fastq.gz')") for i in (1, 2)])).alias("path"))
    return M.manifest_errors(X.manifest_rows(spark, sf_dir), files.distinct()).filter(F.startswith("problem", F.lit("read file")))


@query
def read_manifest(spark, sf_dir):
    resolved = M.resolve_manifest(_usable(X.manifest_rows(spark, sf_dir)))
    return resolved.select("sample_id", "grp", M.reads_text().alias("reads"))


@query
def read_pairing(spark, sf_dir):
    return M.pair_reads(X.read_files(spark, sf_dir)).select("sample_id", "grp", M.reads_text().alias("reads"))


@query
def legacy_listing(spark, sf_dir):
    return M.legacy_listing(M.pair_reads(M.skip_undetermined(X.read_files(spark, sf_dir))))


@query
def duplicate_samples(spark, sf_dir):
    return M.duplicates(M.pair_reads(X.read_files(spark, sf_dir)), "sample_id")


@query
def missing_entries(spark, sf_dir):
    """Required names that a listing lacks: customers that no order names, and every seventh."""
    names = lambda t, k: X.table(spark, sf_dir, t).select(F.concat(F.lit("S"), k).alias("name"))
    return R.missing_entries(names("orders", "o_custkey").filter("substr(name, 2) % 7 <> 0"), names("customer", "c_custkey"))


# ---- budget


def _stats(spark, sf_dir):
    return B.join_statistics(X.sample_groups(spark, sf_dir), X.sample_stats(spark, sf_dir))


@query
def read_statistics(spark, sf_dir):
    turns = X.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("sample_id"), F.col("text").alias("seq"))
    return B.read_statistics(turns)


@query
def sample_statistics(spark, sf_dir):
    return _stats(spark, sf_dir)


@query
def group_depths(spark, sf_dir):
    return B.group_depths(materialise(_stats(spark, sf_dir)), GENOME_SIZE, COVERAGE)


@query
def budget_allocation(spark, sf_dir):
    return B.allocate(materialise(_stats(spark, sf_dir)), GENOME_SIZE, COVERAGE)


@query
def allocation_log(spark, sf_dir):
    return B.allocation_log(materialise(_stats(spark, sf_dir)), GENOME_SIZE, COVERAGE)


@query
def read_subsample(spark, sf_dir):
    """Half the bases of each order priority, drawn from its orders."""
    reads = X.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("sample_id"), "o_orderkey", F.expr("cast(floor(o_totalprice) as bigint)").alias("length")
    )
    targets = reads.groupBy("sample_id").agg(F.expr("sum(length) div 2").alias("to_sample"))
    return B.subsample(reads, targets, F.col("o_orderkey").cast("string"))


@query
def paired_subsample(spark, sf_dir):
    """Both ends of the pairs that fit into two fifths of each customer segment's bases: a pair per order."""
    orders = X.table(spark, sf_dir, "orders")
    ends = orders.select(
        F.expr("concat('S', o_custkey % 40)").alias("sample_id"), F.col("o_orderkey").alias("read_no"), F.explode(F.array(F.lit(1), F.lit(2))).alias("end"),
        "o_custkey",
    )
    size = F.when(F.col("end") == 1, 20 + F.col("read_no") % 31).otherwise(10 + F.col("o_custkey") % 17).cast("int")
    ends = ends.withColumn("seq", F.repeat(F.lit("A"), size)).drop("o_custkey")
    targets = ends.groupBy("sample_id").agg((F.sum(F.length("seq")) * 2).alias("twice")).select("sample_id", F.expr("twice div 5").alias("to_sample"))
    return B.subsample_pairs(ends, targets).select("sample_id", "read_no", "end", F.length("seq").alias("length"))


# ---- assemblies


@query
def isolate_ids(spark, sf_dir):
    paths = X.assemblies(spark, sf_dir).select("path").distinct()
    return paths.select("path", isolate_id("path", "_trim").alias("isolate"))


@query
def assembly_metrics(spark, sf_dir):
    return A.assembly_metrics(X.assemblies(spark, sf_dir))


@query
def assembly_zscores(spark, sf_dir):
    return A.with_zscores(A.assembly_metrics(X.assemblies(spark, sf_dir)))


def _inliers(spark, sf_dir):
    metrics = A.assembly_metrics(X.isolate_contigs(spark, sf_dir))
    scored = A.with_zscores(materialise(X.isolates(spark, sf_dir).join(metrics, "path")))
    return materialise(A.inliers(scored))


@query
def assembly_inliers(spark, sf_dir):
    return _inliers(spark, sf_dir).drop("ord")


# ---- distances and groups


@query
def distance_triangle(spark, sf_dir):
    _, edges = parse_triangle(X.triangle_lines(spark, sf_dir), "_trim")
    return D.symmetric(edges)


@query
def triangle_isolates(spark, sf_dir):
    isolates, _ = parse_triangle(X.triangle_lines(spark, sf_dir), "_trim")
    return isolates


@query
def mean_distances(spark, sf_dir):
    return D.mean_distance(X.edges(spark, sf_dir))


@query
def group_validation(spark, sf_dir):
    return D.validate_groups(X.edges(spark, sf_dir), X.groups(spark, sf_dir))


@query
def unknown_assignment(spark, sf_dir):
    partly = X.groups(spark, sf_dir).withColumn("grp", F.expr("CASE WHEN id % 4 <> 1 THEN grp END"))
    return D.assign_unknown(X.edges(spark, sf_dir), partly, threshold=500.0)


@query
def cluster_shares(spark, sf_dir):
    return K.cluster_shares(X.groups(spark, sf_dir).select("id", F.col("grp").alias("cluster")))


@query
def identical_rows(spark, sf_dir):
    return K.identical_rows(X.vector_rows(spark, sf_dir))


@query
def silhouettes(spark, sf_dir):
    labels = X.groups(spark, sf_dir).select("id", F.col("grp").alias("cluster"))
    scores = K.silhouettes(X.vector_rows(spark, sf_dir), labels)
    return scores.withColumn("silhouette", F.round("silhouette", 6))


@query
def kmeans_clusters(spark, sf_dir):
    return K.by_smallest(K.kmeans(X.separated_rows(spark, sf_dir, 4, 4), 4)[0])


@query
def optimal_k(spark, sf_dir):
    """Chosen number of clusters of four groups, with its cost and mean silhouette."""
    rows = materialise(X.separated_rows(spark, sf_dir, 4, 4))
    best, trace = K.optimal_k(rows, 3)
    chosen = [(k, round(cost, 3), round(score, 6)) for k, cost, score in trace if k == best]
    return spark.createDataFrame(chosen, "k int, cost double, score double")


@query
def mixture_clusters(spark, sf_dir):
    return K.by_smallest(K.mixture(X.separated_rows(spark, sf_dir, 3, 2))[0])


@query
def hierarchical_clusters(spark, sf_dir):
    """Isolates merged along distances below a cut, by a minimum spanning forest."""
    return K.cluster_unknown(X.groups(spark, sf_dir), method="hierarchical", edges=X.edges(spark, sf_dir), cut=400.0)


@query
def merge_steps(spark, sf_dir):
    """How many clusters of suppliers' isolates merge at each distance of their complete triangle."""
    return AG.merges(X.full_edges(spark, sf_dir).withColumn("dist", F.col("dist").cast("bigint")))


@query
def mixture_of_rows(spark, sf_dir):
    """A mixture of rows of 64 dimensions, fitted to their principal coordinates."""
    return K.by_smallest(K.mixture(X.wide_rows(spark, sf_dir), max_clusters=4)[0])


# ---- reference selection


def _scored(spark, sf_dir):
    inliers = _inliers(spark, sf_dir)
    return S.base_scores(inliers, D.among(X.edges(spark, sf_dir), inliers.select("id")))


@query
def base_scores(spark, sf_dir):
    return _scored(spark, sf_dir).select("id", "Mean_Distance_Zscore", F.round("Base_Score", 6).alias("Base_Score"))


@query
def top_reference(spark, sf_dir):
    return S.top_by(_scored(spark, sf_dir), "Base_Score", 1).select("id", "path")


@query
def greedy_references(spark, sf_dir):
    """Three references by the greedy rule, with the known labels as clusters."""
    labels = X.groups(spark, sf_dir).select("id", F.col("grp").alias("cluster"))
    scored = materialise(_scored(spark, sf_dir).join(labels, "id"))
    candidates = scored.join(K.cluster_shares(scored).select("cluster", "Prop"), "cluster")
    edges = materialise(D.among(X.edges(spark, sf_dir), scored.select("id")))
    chosen = S.greedy(candidates, edges, 3)
    return S.mark_references(candidates, chosen).select("id", "cluster", "Is_Ref", "choice")


@query
def reference_selection(spark, sf_dir):
    """The whole selection on a complete triangle of distances in three groups."""
    chosen = S.select_references(X.isolates(spark, sf_dir), X.isolate_contigs(spark, sf_dir), X.full_edges(spark, sf_dir), 3)
    return chosen.select("id", "path", F.round("Base_Score", 6).alias("Base_Score"), "Is_Ref", "choice")


# ---- run reports


@query
def mapping_reports(spark, sf_dir):
    return R.mapping_reports(X.log_lines(spark, sf_dir), mark="qu")


@query
def site_report_lines(spark, sf_dir):
    return R.site_reports(X.log_lines(spark, sf_dir), prefix="Le")


@query
def run_log_document(spark, sf_dir):
    """The whole run log with its headings: mapping and site figures of each taxon, then those of the alignment."""
    lines = X.log_lines(spark, sf_dir)
    final = X.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("line_no"), F.col("n_name").alias("line"))
    return R.log_document(R.run_log(lines, lines, final, mark="qu", prefix="Le"))


# ---- orders and documents


@query
def reference_order(spark, sf_dir):
    """Place of every assembly in the reference table: references in order of choice, then by falling base score."""
    candidates = materialise(_scored(spark, sf_dir)).withColumn("Base_Score", F.round("Base_Score", 6))
    marked = S.mark_references(candidates, [r["id"] for r in S.top_by(candidates, "Base_Score", 1).select("id").collect()])
    placed = S.output_order(marked).select("id", F.monotonically_increasing_id().alias("at"))
    return K.numbered(materialise(placed), "at").select("id", F.col("slot").alias("place"))


@query
def slice_order(spark, sf_dir):
    """Place of every wanted site in the combined alignment: gapless sites first."""
    part = X.table(spark, sf_dir, "part").filter("p_size > 25")
    wanted = part.select(F.expr(f"concat('c', p_partkey div {X.SPAN}, '/', 1 + p_partkey % {X.SPAN})").alias("locus"))
    sliced = AL.slice_sites(_variable(spark, sf_dir), wanted)
    keyed = sliced.select("locus", F.struct(AL.combined_order(sliced).alias("part"), "contig", "pos").alias("k"))
    return K.numbered(keyed, "k").select("locus", F.col("slot").alias("place"))


@query
def fasta_document(spark, sf_dir):
    """Lines of the composite genome as FASTA, a line per chunk."""
    return DOC.fasta_lines(G.rechunk(X.composite(spark, sf_dir), 16))


@query
def taxon_roster(spark, sf_dir):
    """Taxon folders with the number of their pileup files: customers as folders, some of the orders as files."""
    folders = X.table(spark, sf_dir, "customer").select(F.expr("concat('t', c_custkey)").alias("taxon"))
    orders = X.table(spark, sf_dir, "orders").filter("o_orderkey % 5 < 2")
    return roster_of(folders, orders.select(F.expr("concat('/run/t', o_custkey, '/', o_orderkey, '.pileups')").alias("path")))


@query
def many_pileups(spark, sf_dir):
    """Folders with more than one pileup file."""
    orders = X.table(spark, sf_dir, "orders").filter("o_orderkey % 5 < 2")
    return taxa_with_many_pileups(orders.select(F.expr("concat('/run/t', o_custkey, '/', o_orderkey, '.pileups')").alias("path")))


@query
def subset_scheme(spark, sf_dir):
    """The subset scheme under its published names."""
    return jobs.published_scheme(B.allocate(materialise(_stats(spark, sf_dir)), GENOME_SIZE, COVERAGE))
