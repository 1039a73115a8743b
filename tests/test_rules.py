"""Hand-derived fixtures, one per rule."""

import random

import pytest
from pyspark.sql import functions as F

from sitewright.functions import pileup as P
from sitewright.functions import text as TX
from sitewright.operators import alignment as AL
from sitewright.operators import allocation as B
from sitewright.operators import assembly as A
from sitewright.operators import calling as CA
from sitewright.operators import compare as CO
from sitewright.operators import distance as D
from sitewright.operators import genome as G
from sitewright.operators import projection as PR
from sitewright.operators import reports as R


def one(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "ref,bases,want",
    [("A", ".,^].$", "AAA"), ("c", ".+2AGt*", "CT*"), ("G", "^+.-1A,", "GG"), ("A", "^.,", "A"), ("T", "N.", "T"),
     ("A", "+120" + "C" * 120 + ".", "A"), ("A", ".^~.-3NNN,", "AAA"), ("A", "><", "")],
)
def test_decode(spark, ref, bases, want):
    df = spark.createDataFrame([("t", "c", 1, ref, 1, bases, "I")], "taxon string, contig string, pos int, ref string, depth int, bases string, quals string")
    assert CA.decode_pileup(df).first()["decoded"] == want


def scan(ref, bases):
    """Left-to-right scanner of the pileup grammar."""
    out, i = [], 0
    while i < len(bases):
        c = bases[i]
        if c == "^":
            i += 2
            continue
        if c in "+-":
            j = i + 1
            while bases[j].isdigit():
                j += 1
            i = j + int(bases[i + 1 : j])
            continue
        out.append((ref if c in ".," else c).upper())
        i += 1
    return "".join(b for b in out if b in "ACGT*")


def test_decode_random(spark):
    rng, rows = random.Random(3), []
    for k in range(400):
        parts = []
        for _ in range(rng.randint(1, 12)):
            token = rng.choice([".", ",", "a", "G", "*", "$", "N", "^].", "^+,", "^-t", "^9.", "indel"])
            if token == "indel":
                n = rng.choice([1, 2, 3, 10, 12, 99, 120])
                token = "." + rng.choice("+-") + str(n) + "".join(rng.choice("ACGTNacgtn") for _ in range(n))
            parts.append(token)
        rows.append((k, rng.choice("ACGTacgt"), "".join(parts)))
    df = spark.createDataFrame(rows, "k int, ref string, bases string").withColumn("depth", F.lit(1))
    got = {r["k"]: r["decoded"] for r in CA.decode_pileup(df).collect()}
    assert got == {k: scan(ref, b) for k, ref, b in rows}


@pytest.mark.parametrize("bases,want", [("AA*", "A"), ("**", "N"), ("**A", "N"), ("A*", "A"), ("TC", "C"), ("", None), ("GGTT*", "G")])
def test_majority(spark, bases, want):
    df = spark.createDataFrame([(bases,)], "d string")
    assert df.select(P.majority_base(P.vote_counts(F.col("d")))).first()[0] == want


@pytest.mark.parametrize(
    "bases,minread,thresh,want",
    [("AAAA", 3, 0.8, ("A", None)), ("****", 3, 0.8, ("-", None)), ("AA", 3, 0.8, ("N", "min")), ("AAAC", 3, 0.8, ("N", "thresh")),
     ("AAC", 3, 0.8, ("N", "both")), ("TTAA", 2, 0.5, ("T", None)), ("*A", 1, 0.5, ("-", None)), ("", 3, 0.8, ("N", "min"))],
)
def test_call(spark, bases, minread, thresh, want):
    d = F.col("d")
    c = spark.createDataFrame([(bases,)], "d string").select(P.call(P.vote_counts(d), minread, thresh, P.first_positions(d)).alias("c"))
    assert tuple(c.first()["c"]) == want


def test_low_threshold_needs_order():
    with pytest.raises(ValueError):
        P.call({}, 1, 0.5)


def sites_of(spark, columns):
    rows = [("c", i + 1, c) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "contig string, pos bigint, column string")


@pytest.mark.parametrize(
    "column,missing,want",
    [("AAAC", 2, ("singleton", False)), ("ACGT", 2, ("singleton", False)), ("AAA-", 2, ("singleton", False)),
     ("AACC", 2, ("informative", True)), ("AACCG", 2, ("othersingle", False)), ("AACCGG", 2, ("informative", False)),
     ("AANC", 1, ("singleton", False)), ("AANC", 0, None), ("AAAA", 2, None)],
)
def test_site_class(spark, column, missing, want):
    variable = AL.variable_sites(AL.with_counts(sites_of(spark, [column])), len(column), missing)
    rows = AL.classify_sites(variable).collect()
    assert (rows and (rows[0]["site_class"], rows[0]["biallelic"]) or None) == want


def test_site_columns_fill_missing_taxa(spark):
    calls = spark.createDataFrame([("a", "c", 1, "A"), ("b", "c", 1, "N"), ("d", "c", 1, "-")], "taxon string, contig string, pos bigint, base string")
    assert AL.site_columns(calls, ["a", "b", "d"]).first()["column"] == "AN-"


def test_call_quality_counts_whole_universe(spark):
    sites = G.enumerate_sites(spark.createDataFrame([(0, "c", 4)], "contig_ord bigint, contig string, length int"))
    calls = spark.createDataFrame(
        [("a", "c", 1, "A", None), ("a", "c", 2, "N", "min"), ("a", "x", 9, "C", None)],
        "taxon string, contig string, pos bigint, base string, penalty string",
    )
    r = CA.call_quality(sites, calls).first()
    assert (r["positions"], r["called"], r["n_calls"], r["lost_coverage"], r["no_data"]) == (5, 2, 3, 1, 2)
    assert (r["called_percent"], r["n_percent"]) == ("40.00", "60.00")


def test_overlay_across_chunks(spark):
    chunks = spark.createDataFrame([(0, "c", 0, "ACGTACGTAC"), (1, "d", 0, "GG")], "contig_ord bigint, contig string, offset bigint, seq string")
    edits = spark.createDataFrame([("t", "c", 1, "T"), ("t", "c", 4, "N"), ("t", "c", 5, "C"), ("t", "c", 10, "G")], "taxon string, contig string, pos bigint, base string")
    got = G.overlay(chunks, edits, ["t"], span=4).orderBy("contig", "offset").collect()
    assert "".join(r["seq"] for r in got if r["contig"] == "c") == "TCGNCCGTAG"
    assert [r["seq"] for r in got if r["contig"] == "d"] == ["GG"]


def test_unknown_contig(spark):
    chunks = spark.createDataFrame([("c",)], "contig string")
    assert one(G.unknown_contigs(chunks, spark.createDataFrame([("x",), ("c",)], "contig string"))) == [("x",)]


def test_long_ranges_are_whole(spark):
    df = spark.createDataFrame([(0, "c", 10_001)], "contig_ord bigint, contig string, length int")
    got = [r["pos"] for r in G.enumerate_sites(df).collect()]
    assert sorted(got) == list(range(1, 10_002))


def test_allocation(spark):
    rows = [("x1", "X", 10), ("x2", "X", 30), ("x3", "X", 60), ("y1", "Y", 20), ("y2", "Y", 20)]
    df = spark.createDataFrame(rows, "sample_id string, grp string, base_count bigint")
    got = {r["sample_id"]: r["to_sample"] for r in B.allocate(df, 100, 1).collect()}
    assert got == {"x1": 10, "x2": 20, "x3": 20, "y1": 20, "y2": 20}


@pytest.mark.parametrize("digits", [1, 4])
def test_subsample_equals_plain_ranking(spark, digits):
    import hashlib

    reads = [("s" if i % 5 else "r", str(i), i % 7 + 1) for i in range(500)]
    df = spark.createDataFrame(reads, "sample_id string, k string, length bigint")
    targets = spark.createDataFrame([("s", 700), ("r", 10**6)], "sample_id string, to_sample bigint")
    got = {(r["sample_id"], r["k"]) for r in B.subsample(df, targets, F.col("k"), digits=digits).collect()}
    want = set()
    for s, target in (("s", 700), ("r", 10**6)):
        total = 0
        for _, k, n in sorted((hashlib.md5(f"0:{k}".encode()).hexdigest(), k, n) for t, k, n in reads if t == s):
            total += n
            if total <= target:
                want.add((s, k))
    assert got == want


MAP = "contig string, chrom string, start bigint, direction int, cigar string"


@pytest.mark.parametrize(
    "direction,names", [(0, ["c/1", "c/2", "c/3", "c/5"]), (16, ["c/5", "c/4", "c/3", "c/1"]), (4, [])]
)
def test_projection(spark, direction, names):
    df = spark.createDataFrame([("c", "h", 101, direction, "2M1D1M1I1M")], MAP)
    got = sorted(one(PR.project(df)))
    want = [("h", s, s + 1, n) for s, n in zip((100, 101, 103, 104), names)]
    assert got == want


def test_projection_random(spark):
    rng, rows = random.Random(5), []
    for k in range(200):
        cigar = "".join(f"{rng.randint(1, 12)}{rng.choice('MMMIDSHN')}" for _ in range(rng.randint(1, 6)))
        rows.append((f"q{k}", "h", rng.randint(1, 500), rng.choice([0, 16, 4]), cigar))
    want = []
    for contig, chrom, start, direction, cigar in rows:
        import re

        ops = "".join(int(n) * o for n, o in re.findall(r"(\d+)(\D)", cigar))
        length = ops.count("M") + ops.count("I")
        g, q = start, 1
        for o in ops if direction != 4 else "":
            if o == "M":
                want.append((chrom, g - 1, g, f"{contig}/{q if direction == 0 else length - q + 1}"))
            g += o in "MD"
            q += o in "MI"
    df = spark.createDataFrame(rows, MAP)
    bed = PR.project(df)
    assert sorted(one(bed)) == sorted(want)
    seen = [w[:2] for w in want]
    assert sorted(one(PR.keep_unique(bed))) == sorted(w for w in want if seen.count(w[:2]) == 1)


def test_keep_unique_drops_all_copies(spark):
    df = spark.createDataFrame([("h", s, s + 1, f"n{i}") for i, s in enumerate((1, 2, 2, 3))], "chrom string, start bigint, end bigint, name string")
    assert sorted(r["start"] for r in PR.keep_unique(df).collect()) == [1, 3]


def test_assembly_metrics(spark):
    df = spark.createDataFrame([("a", 50), ("a", 30), ("a", 20), ("z", 0)], "path string, length bigint")
    got = {r["path"]: tuple(r)[1:] for r in A.assembly_metrics(df).collect()}
    assert got["a"] == (3, 100, 50, 20, 1, 3)
    assert got["z"] == (1, 0, 0, 0, 1, 1)


def test_assembly_metrics_random(spark):
    rng = random.Random(1)
    lengths = [rng.choice([5, 7, 7, 11, 100]) for _ in range(300)]
    df = spark.createDataFrame([("a", n) for n in lengths], "path string, length bigint")
    total, cum, want = sum(lengths), 0, {}
    for i, n in enumerate(sorted(lengths, reverse=True), 1):
        cum += n
        for share in (50, 90):
            if cum >= total * share / 100 and share not in want:
                want[share] = (n, i)
    r = A.assembly_metrics(df).first()
    assert {50: (r["N50"], r["L50"]), 90: (r["N90"], r["L90"])} == want


def test_inlier_bounds_are_strict(spark):
    df = spark.createDataFrame([(-3.0, 0.0, 0.0), (0.0, 3.0, 0.0), (0.0, 0.0, 3.0), (4.0, -2.9, -9.0)],
                               "N50_Zscore double, Assembly_Bases_Zscore double, Contig_Count_Zscore double")
    assert A.inliers(df).count() == 1


def test_zscore_without_spread_is_zero(spark):
    df = spark.createDataFrame([("a", 1, 5, 5), ("b", 1, 5, 5)], "path string, Contigs bigint, Length bigint, N50 bigint")
    assert {r["N50_Zscore"] for r in A.with_zscores(df).collect()} == {0.0}


@pytest.mark.parametrize("tile", [1, 2, 512])
def test_pairwise(spark, tile):
    sites = sites_of(spark, ["AAN", "CCN", "GTN", "--N", "NAN", "aAN"])
    got = {r["Comparison"]: tuple(r)[3:] for r in CO.pairwise_identity(sites, ["x", "y", "z"], tile).collect()}
    assert got == {"x;y": (5, 3, 0.6), "x;z": (0, 0, 0.0), "y;z": (0, 0, 0.0)}


def test_classification(spark):
    sites = sites_of(spark, ["AAC", "GAC", "AAA", "ANA", "NAA", "A-A"])
    r = CO.classify_samples(sites, ["S", "R1", "R2"], ["R2", "R1"]).first()
    assert r.asDict() == {"Sample_ID": "S", "Count_R1": 1, "Count_R2": 1, "Classifier_Sites": 2, "All_Sites": 4, "Count_Singleton": 1, "Count_Background": 1}
    with pytest.raises(ValueError):
        CO.classify_samples(sites, ["S", "R1", "R2"], ["R9"])


def test_recode(spark):
    assert spark.createDataFrame([("A-Nc?",)], "s string").select(TX.recode_gaps("s")).first()[0] == "01N0N"


@pytest.mark.parametrize("path,trim,want", [("/a/b.c.fasta", "", "b.c"), ("x_trim.fa", "_trim", "x"), ("/a/noext", "", "noext")])
def test_isolate_id(spark, path, trim, want):
    assert spark.createDataFrame([(path,)], "p string").select(TX.isolate_id("p", trim)).first()[0] == want


def test_refilter_minds_case_and_gaps(spark):
    sites = sites_of(spark, ["Aa", "AA", "A-", "AN", "AC"])
    assert [r["column"] for r in AL.refilter(sites, 0).orderBy("pos").collect()] == ["Aa", "A-", "AC"]
    assert [r["column"] for r in AL.refilter(sites, 0, gaps=False).orderBy("pos").collect()] == ["Aa", "AC"]
    assert one(AL.refilter_report(sites, 0).orderBy("variant").select("variant", "after", "lost_percent")) == [("gap", 3, "40.00"), ("nogap", 2, "60.00")]


def test_group_validation(spark):
    edges = spark.createDataFrame([(1, 0, 1.0), (2, 0, 5.0), (2, 1, 4.0)], "id_a bigint, id_b bigint, dist double")
    groups = spark.createDataFrame([(0, 0), (1, 0), (2, 1)], "id bigint, grp int")
    assert one(D.validate_groups(edges, groups)) == [(1.0, 4.5, True)]


def test_assign_unknown(spark):
    edges = spark.createDataFrame([(3, 0, 0.5), (3, 1, 0.5), (4, 0, 2.0), (4, 3, 0.1)], "id_a bigint, id_b bigint, dist double")
    groups = spark.createDataFrame([(0, 7), (1, 2), (3, None), (4, None)], "id bigint, grp int")
    got = {r["id"]: r["grp"] for r in D.assign_unknown(edges, groups).collect()}
    assert got == {0: 7, 1: 2, 3: 7, 4: 8}


def test_mapping_report(spark):
    block = ["10 reads; of these:", "  10 were unpaired; of these:", "a", "b", "c", "rate"]
    log = ["start"] + block + ["noise"] * 3 + block + ["end"]
    df = spark.createDataFrame([("t", i, x) for i, x in enumerate(log)], "taxon string, line_no bigint, line string")
    got = {(r["section"], r["at"]): r["line"] for r in R.mapping_reports(df).collect()}
    assert [got["composite", i] for i in range(2, 7)] == block[1:]
    assert [got["specific", i] for i in range(9, 14)] == block[1:]


def test_missing_entries(spark):
    listing = spark.createDataFrame([("contigs.fa",), ("logs",), ("ref",)], "name string")
    assert R.missing_entries(listing).count() == 10
