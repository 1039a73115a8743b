"""Readers, writers and whole runs on small files."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from sitewright.__main__ import main
from sitewright.operators import manifest as M
from sitewright.plans import jobs
from sitewright.sinks import documents as DOC
from sitewright.sinks.pieces import join_parts, write_pieces
from sitewright.sources import alignments, evidence, lines, manifests, sequences
from sitewright.streaming.calls import call_arriving


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if str(path).endswith(".gz") else open
    with opener(path, "wt", encoding="utf-8") as out:
        out.write(text)
    return str(path)


def read(path):
    with open(path, encoding="utf-8") as handle:
        return handle.read()


def table(path):
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    return [row.split("\t") for n in names for row in read(os.path.join(path, n)).splitlines()]


def test_line_numbers_follow_the_file(spark, tmp_path):
    put(tmp_path / "a.txt", "\n".join(f"row {i} " + "x" * 300 for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400000")
    try:
        records = lines.read_records(spark, str(tmp_path / "a.txt"))
        assert records.select("file").rdd.getNumPartitions() >= 1
        wrong = records.filter(F.split("value", " ")[1].cast("bigint") != F.col("line_no"))
        assert (records.count(), wrong.count()) == (20_000, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_ordered_numbers_rise(spark, tmp_path):
    for name in ("a.fa", "b.fa"):
        put(tmp_path / "fa" / name, "".join(f">k{i}\n{'A' * (i % 90)}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        got = sequences.read_fasta(spark, str(tmp_path / "fa")).select("file", "contig_ord", "contig").distinct()
        rows = sorted((r["file"], r["contig_ord"], r["contig"]) for r in got.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[2] for r in rows] == [f"k{i}" for i in range(5000)] * 2


def test_fasta(spark, tmp_path):
    put(tmp_path / "c.fa", ">one first > contig\nACGT\nAC\n>two\n\nGG\n>three\n" + "ACGTA" * 100 + "\n")
    got = sequences.read_fasta(spark, str(tmp_path / "c.fa"), span=64).orderBy("contig_ord", "offset").collect()
    seqs = {}
    for r in got:
        assert r["offset"] == len(seqs.get(r["contig"], "")) and len(r["seq"]) <= 64
        seqs[r["contig"]] = seqs.get(r["contig"], "") + r["seq"]
    assert seqs == {"one": "ACGTAC", "two": "GG", "three": "ACGTA" * 100}


def test_fastq_counts(spark, tmp_path):
    put(tmp_path / "a.fastq.gz", "@r1\nACGT\n+\nIIII\n@r2\nAC\n+\nII\n")
    put(tmp_path / "b.fastq", "@r1\nA\n+\nI\n")
    reads = sequences.read_fastq(spark, [str(tmp_path / "a.fastq.gz"), str(tmp_path / "b.fastq")])
    assert sorted(r["seq"] for r in reads.collect()) == ["A", "AC", "ACGT"]


def test_pileup_scan(spark):
    rows = [("t", "c 1 A 2 .. II"), ("t", "c 2 A 0 * *"), ("t", "c 3 A 0"), ("t", "c\t4\tG\t1\t^].\tI")]
    got = evidence.parse_pileup(spark.createDataFrame(rows, "taxon string, value string")).collect()
    assert [(r["pos"], r["depth"], r["bases"]) for r in got] == [(1, 2, ".."), (4, 1, "^].")]
    bad = evidence.parse_pileup(spark.createDataFrame([("t", "c 1 A 2 ..")], "taxon string, value string"))
    with pytest.raises(Exception, match="six fields"):
        bad.collect()


def test_triangle(spark, tmp_path):
    path = put(tmp_path / "m.tri", "\t3\n/x/a_t.fa\n/x/b_t.fa\t0.5\n/x/c_t.fa\t0.25\t1\n")
    isolates, edges = evidence.read_triangle(spark, path, "_t")
    assert [r["isolate"] for r in isolates.orderBy("ord").collect()] == ["a", "b", "c"]
    assert sorted(map(tuple, edges.collect())) == [(1, 0, 0.5), (2, 0, 0.25), (2, 1, 1.0)]


def test_manifest_csv(spark, tmp_path):
    files = [put(tmp_path / n, "x") for n in ("a_1.fq", "a_2.fq", "b.fq")]
    path = put(tmp_path / "m.csv", f"Sample_ID,Group,Forward,Reverse\na,g1,{files[0]},{files[1]}\nb,,{files[2]},\n")
    listing = lines.list_files(spark, str(tmp_path), ".fq")
    got = sorted(map(tuple, manifests.fetch_manifest(spark, path, files=listing).collect()))
    assert got == [("a", "g1", [files[0], files[1]]), ("b", "Unknown", [files[2]])]
    for body, problem in [
        (f",g,{files[0]},", "empty"), ("a,g,,", "both"), (f"a,g,,{files[1]}", "without forward"),
        (f"a,g,{files[0]},\na,g,{files[2]},", "duplicate sample"), (f"a,g,{files[0]},\nb,g,{files[0]},", "duplicate reads"),
        ("a,g,/none.fq,", "missing"), ("Sample_ID,Group,Forward,Reverse", "no reads"),
    ]:
        with pytest.raises(M.ManifestError, match=problem):
            manifests.fetch_manifest(spark, put(tmp_path / "bad.csv", body + "\n"), files=listing)
    with pytest.raises(Exception):
        manifests.fetch_manifest(spark, put(tmp_path / "wide.csv", "a,b,c,d,e\n")).collect()


def test_manifest_folder(spark, tmp_path):
    root = str(tmp_path / "reads")
    for n in ("g1/a_1.fastq.gz", "g1/a_2.fastq.gz", "g1/b_2.fastq.gz", "c.fastq.gz", "d_1.fastq.gz", "g1/deep/e.fastq.gz", "Undetermined_x.fastq.gz", "z.txt"):
        put(f"{root}/{n}", "x")
    got = sorted((r["sample_id"], r["grp"], len(r["reads"])) for r in manifests.fetch_manifest(spark, root, ignore_undetermined=True).collect())
    assert got == [("a", "g1", 2), ("b_2", "g1", 1), ("c", "Unknown", 1), ("d", "Unknown", 1)]
    with pytest.raises(M.ManifestError):
        manifests.fetch_manifest(spark, root, filetype="bam")


SITES = [(0, "c", 9, "AC-"), (0, "c", 10, "ANC"), (1, "d", 1, "GGT")]


def site_table(spark):
    return spark.createDataFrame(SITES, "contig_ord bigint, contig string, pos bigint, column string").repartition(3)


def test_nexus_round_trip(spark, tmp_path):
    DOC.write_nexus(site_table(spark), ["x", "y", "z"], str(tmp_path / "p"))
    path = join_parts(str(tmp_path / "p"), str(tmp_path / "a.nex"))
    assert read(path) == (
        "#NEXUS\n\nBEGIN DATA;\nDIMENSIONS NTAX=3 NCHAR=3;\nFORMAT MISSING=? GAP=- DATATYPE=DNA;\nMATRIX\n"
        "[ c/9 c/10 d/1 ]\nx\tAAG\ny\tCNG\nz\t-CT\n;\nend;"
    )
    sites, taxa = alignments.read_alignment(spark, path, block=2)
    assert taxa == ["x", "y", "z"]
    assert [tuple(r) for r in sites.orderBy("site_ord").collect()] == [(0, "c/9", "AC-"), (1, "c/10", "ANC"), (2, "d/1", "GGT")]


def test_empty_nexus(spark, tmp_path):
    DOC.write_nexus(site_table(spark).limit(0), ["x"], str(tmp_path / "p"))
    assert "MATRIX\n[  ]\nx\t\n;\nend;" in read(join_parts(str(tmp_path / "p"), str(tmp_path / "a.nex")))


def test_phylip_and_fasta_alignments(spark, tmp_path):
    DOC.write_phylip(site_table(spark), ["x", "yy", "z"], str(tmp_path / "p"))
    path = join_parts(str(tmp_path / "p"), str(tmp_path / "a.phylip-relaxed"))
    assert read(path) == " 3 3\nx  AAG\nyy CNG\nz  -CT\n"
    fasta = put(tmp_path / "a.fa", ">x\nAA\nG\n>z\n-CT\n>yy\nCNG\n")
    for p in (path, fasta):
        sites, taxa = alignments.read_alignment(spark, p)
        assert taxa == ["x", "yy", "z"]
        assert [tuple(r) for r in sites.orderBy("site_ord").collect()] == [(0, "0", "AC-"), (1, "1", "ANC"), (2, "2", "GGT")]
    with pytest.raises(ValueError):
        alignments.read_alignment(spark, "a.doc")
    with pytest.raises(Exception, match="differ in length"):
        alignments.read_alignment(spark, put(tmp_path / "b.fa", ">x\nAA\n>y\nA\n"))[0].collect()


def test_pieces_overwrite_and_refuse(spark, tmp_path):
    path = str(tmp_path / "p")
    write_pieces(spark.range(100).selectExpr("id", "cast(id as string) as text"), ["id"], path)
    write_pieces(spark.range(3).selectExpr("id", "cast(id as string) as text"), ["id"], path)
    assert read(join_parts(path, str(tmp_path / "t"))) == "012"
    assert [n for n in os.listdir(path) if n.startswith(".")] == []
    with pytest.raises(FileExistsError):
        write_pieces(spark.range(3).selectExpr("id", "'x' as text"), ["id"], path, overwrite=False)


PILEUPS = {
    "t1": "PG_c1 1 A 3 ... III\nPG_c1 2 C 3 TTT III\nPG_c1 4 A 4 GG-1CGg IIII\nPG_c2 1 G 3 ,,, III\n",
    "t2": "PG_c1 1 A 3 ... III\nPG_c1 2 C 3 TTt III\nPG_c1 4 A 3 ... III\nPG_c2 1 G 3 *** III\n",
    "t3": "PG_c1 1 A 3 CCC III\nPG_c1 2 C 3 ... III\nPG_c1 4 A 3 GGG III\nPG_c2 1 G 1 A I\n",
    "t4": "PG_c1 1 A 3 CCC III\nPG_c1 2 C 3 ... III\nPG_c1 4 A 3 ^]... III\nPG_c2 1 G 2 .. II\n",
}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    fasta = put(root / "in.fa", ">c1 a\nACGA\n>c2\nG\n")
    for t, body in PILEUPS.items():
        put(root / "taxa" / t / f"{t}.pileups", body)
    name, pangenome = jobs.process_pangenome(spark, fasta, str(root / "pan"))
    jobs.call_taxa(spark, str(root / "taxa"), pangenome, str(root / "calls"), 3, 0.8)
    jobs.build_alignment(spark, str(root / "calls" / "calls"), pangenome, str(root / "out"))
    return root


def test_pangenome_files(spark, run):
    pan = str(run / "pan")
    text = {n: read(join_parts(f"{pan}/{n}", str(run / "t"))) for n in ("contigs.fa", "contigs_SeqLength.tsv", "contigs_LocList")}
    assert text["contigs.fa"] == ">PG_c1\nACGA\n>PG_c2\nG\n"
    assert text["contigs_SeqLength.tsv"] == "PG_c1\t4\nPG_c2\t1\n"
    assert text["contigs_LocList"] == "PG_c1/1\nPG_c1/2\nPG_c1/3\nPG_c1/4\nPG_c2/1\n"
    with pytest.raises(FileExistsError):
        jobs.process_pangenome(spark, str(run / "in.fa"), pan)
    assert jobs.fetch_pangenome(spark, path=pan) == ("pan", pan)
    assert jobs.validate_pangenome(spark, pan) == ("pan", "")
    with pytest.raises(ValueError):
        jobs.fetch_pangenome(spark)


def test_alignment_files(spark, run):
    text = {v: read(join_parts(str(run / "out" / f"alignment{v}.nex.parts"), str(run / "t"))) for v in ("", "_bi", "_pi", "_singletons", "_pi_singletons")}
    assert "[ PG_c1/1 PG_c1/2 PG_c1/4 PG_c2/1 ]\nt1\tATGG\nt2\tATA-\nt3\tCCGN\nt4\tCCAN\n" in text[""]
    assert "[ PG_c1/1 PG_c1/2 PG_c1/4 ]" in text["_bi"] and text["_bi"] == text["_pi"] == text["_pi_singletons"]
    assert "[ PG_c2/1 ]\nt1\tG\nt2\t-\n" in text["_singletons"]
    log = read(join_parts(str(run / "calls" / "call_log"), str(run / "t")))
    assert "Of 5 positions, t3 has good calls for 3 sites (60.00%). There were 2 N calls (40.00%)." in log


def test_call_vectors(spark, run):
    main(["call-vectors", "--calls-path", str(run / "calls" / "calls"), "--pangenome", str(run / "pan"), "--out", str(run / "v")])
    got = {t: read(join_parts(str(run / "v" / f"{t}_LocList"), str(run / "t"))).split() for t in PILEUPS}
    assert got == {"t1": list("ATNGG"), "t2": list("ATNA-"), "t3": list("CCNGN"), "t4": list("CCNAN")}


def test_pangenome_dispatch(spark, run, tmp_path):
    out = str(tmp_path / "all")
    with pytest.raises(ValueError):
        jobs.pangenome(spark, out, reads="x")
    with pytest.raises(FileNotFoundError):
        jobs.pangenome(spark, str(tmp_path / "no" / "where"), ref_path=str(run / "in.fa"))
    made = jobs.pangenome(spark, out, ref_path=str(run / "in.fa"), name="p")
    assert made == ("p", f"{out}/p") == jobs.pangenome(spark, out, name="p")


def test_read_stats_and_lists(spark, tmp_path):
    path = put(tmp_path / "s.csv", "Sample_ID,Pangenome_Group,Read_Location,Read_Count,Base_Count\na,g,/x;/y,2,300\n")
    assert tuple(evidence.read_stats(spark, path).first()) == ("a", "g", "/x;/y", 2, 300)
    loci = lines.read_list(spark, put(tmp_path / "l.txt", "c/1\nc/2\n"))
    assert sorted(map(tuple, loci.collect())) == [(0, "c/1"), (1, "c/2")]
    assert DOC.sample_sheet() == "Sample_ID\tGroup\tForward\tReverse\n"


def test_relative_and_reverse_only_rows(spark):
    rows = spark.createDataFrame([("a", None, None, "x.fq"), ("b", None, "s3://k/y.fq", None)], "sample_id string, grp string, forward string, reverse string")
    assert [r["sample_id"] for r in M.manifest_errors(rows).collect()] == ["a"]
    assert M.manifest_errors(rows, reverse_only=True).isEmpty()
    got = M.absolute_paths(rows, "/base").orderBy("sample_id").collect()
    assert (got[0]["reverse"], got[0]["forward"], got[1]["forward"]) == ("/base/x.fq", None, "s3://k/y.fq")


def test_taxon_genomes(spark, run):
    jobs.taxon_genomes(spark, str(run / "taxa"), str(run / "pan"), str(run / "gen"))
    got = {t: read(join_parts(str(run / "gen" / t / "contigs.fa"), str(run / "t"))) for t in ("t1", "t2")}
    assert got == {"t1": ">PG_c1\nATGG\n>PG_c2\nG\n", "t2": ">PG_c1\nATGA\n>PG_c2\nN\n"}


@pytest.mark.parametrize("stored", [False, True])
def test_filter_slice_compare(spark, run, stored):
    """On the NEXUS document and on the Parquet table, with the same results."""
    path = str(run / "out" / "alignment") if stored else join_parts(str(run / "out" / "alignment.nex.parts"), str(run / "alignment.nex"))
    jobs.filter_alignment(spark, path, 0, str(run / "f"))
    assert read(join_parts(str(run / "f" / "locs_m0.txt.parts"), str(run / "t"))) == "PG_c1/1\nPG_c1/2\nPG_c1/4\n"
    loci = put(run / "all.txt", "PG_c1/1\nPG_c1/2\nPG_c1/4\nPG_c2/1\n")
    os.makedirs(run / "s", exist_ok=True)
    jobs.slice_alignment(spark, loci, put(run / "want.txt", "PG_c2/1\nPG_c1/4\nPG_c1/1\n"), path, "D", str(run / "s"))
    parts = {n: read(join_parts(str(run / "s" / f"D_{n}.phylip-relaxed.parts"), str(run / "t"))) for n in ("NoGaps", "RecodedGaps", "AllSites")}
    assert parts["NoGaps"] == " 4 2\nt1 AG\nt2 AA\nt3 CG\nt4 CA\n"
    assert parts["RecodedGaps"] == " 4 1\nt1 0\nt2 1\nt3 N\nt4 N\n"
    assert parts["AllSites"] == " 4 3\nt1 AGG\nt2 AA-\nt3 CGN\nt4 CAN\n"
    assert "charset part2" in read(run / "s" / "D_Partition.nex")
    jobs.compare_taxa(spark, path, str(run / "pairs"))
    assert ["t1", "t2", "t1;t2", "4", "2", "0.5"] in table(str(run / "pairs"))
    jobs.classify_samples(spark, path, "t1;t3", str(run / "cls"))
    rows = table(str(run / "cls"))
    assert ["t2", "2", "0", "2", "3", "1", "0"] in rows and ["t4", "0", "2", "2", "3", "1", "0"] in rows


def test_genome_map(spark, tmp_path):
    path = put(tmp_path / "hg_MapData.tsv", "c\th\t101\t0\t2M1D1M1I1M\nd\th\t102\t16\t1M\n")
    report = jobs.map_genome(spark, path, str(tmp_path / "o")).first()
    assert (report["mapped"], report["removed"], report["kept"]) == (5, 2, 3)
    assert sorted(r[1] for r in table(str(tmp_path / "o" / "mapped_nondup_bed"))) == ["100", "103", "104"]
    with pytest.raises(ValueError):
        jobs.map_genome(spark, put(tmp_path / "x.tsv", ""), str(tmp_path / "o2"))


def test_prepare_reads(spark, tmp_path):
    def fastq(n, size):
        return "".join(f"@r{i}\n{'A' * size}\n+\n{'I' * size}\n" for i in range(n))

    root = str(tmp_path / "reads")
    for name, n in (("g1/a_1", 6), ("g1/a_2", 6), ("g1/b_1", 2), ("g2/c_1", 3)):
        put(f"{root}/{name}.fastq.gz", fastq(n, 10))
    scheme = jobs.prepare_reads(spark, root, str(tmp_path / "o"), 100, 1.0)
    got = {r["sample_id"]: (r["read_count"], r["base_count"], r["to_sample"]) for r in scheme.collect()}
    assert got == {"a": (12, 120, 30), "b": (2, 20, 20), "c": (3, 30, 30)}
    kept = {r["sample_id"]: r["n"] for r in spark.read.parquet(str(tmp_path / "o" / "subset_reads")).groupBy("sample_id").agg(F.count("*").alias("n")).collect()}
    assert kept == {"a": 2, "b": 2, "c": 3}  # a pair of 20 bases fits into 30, a second one does not
    text = {}
    for folder, _, names in sorted(os.walk(tmp_path / "o" / "subset_fastq")):
        for name in sorted(n for n in names if n.startswith("part-")):
            text.setdefault(os.path.relpath(folder, tmp_path / "o" / "subset_fastq"), []).append(read(os.path.join(folder, name)))
    ends = {k: "".join(v) for k, v in text.items()}
    assert set(ends) == {"sample_id=a/end=1", "sample_id=a/end=2", "sample_id=b/end=1", "sample_id=c/end=1"}
    assert ends["sample_id=a/end=1"] == ends["sample_id=a/end=2"] and ends["sample_id=b/end=1"] == fastq(2, 10)


def test_run_log(spark, tmp_path):
    block = "10 reads; of these:\n  10 were unpaired; of these:\n a\n b\n c\nrate\n"
    put(tmp_path / "r" / "t1" / "err_t1", block + "x\ny\nz\n" + block)
    put(tmp_path / "r" / "t1" / "out_t1", "hello\nOf 5 positions\n")
    jobs.run_log(spark, str(tmp_path / "r"), put(tmp_path / "al", "4 total\n"), str(tmp_path / "log"))
    got = read(join_parts(str(tmp_path / "log"), str(tmp_path / "t"))).splitlines()
    assert got.count("rate") == 2 and got[-1] == "4 total" and "Of 5 positions" in got and len(got) == 26
    heads = [x for x in got if x.endswith(":") and not x.startswith(" ")]
    assert got[:2] == ["", "Read Mapping and Site Selection:"] and heads[1:] == ["t1 Composite Genome Mapping:", "t1 Specific Genome Mapping:", "t1 Site Selection:", "Alignment Filtering:"]


def test_choose_references_from_files(spark, tmp_path):
    files = [put(tmp_path / f"i{k}.fa", "".join(f">k{j}\n{'A' * (20 + k + j)}\n" for j in range(3))) for k in range(4)]
    rows = [files[0], f"{files[1]}\t1", f"{files[2]}\t1\t1", f"{files[3]}\t9\t9\t9"]
    tri = put(tmp_path / "d.tri", "\t4\n" + "\n".join(rows) + "\n")
    chosen = jobs.choose_references(spark, tri, 1, str(tmp_path / "o")).filter("Is_Ref").collect()
    assert [r["path"] for r in chosen] == [files[2]]
    table = spark.read.csv(str(tmp_path / "o"), sep="\t", header=True)
    assert table.columns == ["Isolate_ID", "Path", "Contigs", "Length", "N50", "N90", "L50", "L90", "N50_Zscore", "Mean_Distance", "Mean_Distance_Zscore", "Base_Score", "Is_Ref"]
    assert table.first()["Isolate_ID"] == "i2"


def test_streaming_calls(spark, run, tmp_path):
    out = str(tmp_path / "calls")
    for _ in range(2):
        call_arriving(spark, str(run / "taxa"), out, str(tmp_path / "cp"), 3, 0.8).awaitTermination(120)
    keys = ["taxon", "contig", "pos", "base"]
    batch = spark.read.parquet(str(run / "calls" / "calls")).select(keys)
    stream = spark.read.parquet(out).select(keys)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))
