"""Nothing is lost without an error: taxa, read files and groups."""

import os

import pytest

from sitewright.operators import manifest as M
from sitewright.plans import jobs
from sitewright.sources import manifests


def put(path, text="x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)
    return str(path)


def pangenome(spark, root):
    jobs.process_pangenome(spark, put(f"{root}/ref.fa", ">a\nACGT\n"), f"{root}/pan")
    return f"{root}/pan"


LINE = "PG_c1\t1\tA\t3\t...\tIII\n"


@pytest.mark.parametrize("job", [lambda s, r: jobs.call_taxa(s, f"{r}/taxa", f"{r}/pan", f"{r}/out", 3, 0.8), lambda s, r: jobs.taxon_genomes(s, f"{r}/taxa", f"{r}/pan", f"{r}/out")])
def test_every_taxon_needs_one_pileup_with_data(spark, tmp_path, job):
    root = str(tmp_path)
    pangenome(spark, root)
    for t in ("t1", "t2"):
        put(f"{root}/taxa/{t}/{t}.pileups", LINE)
    os.makedirs(f"{root}/taxa/t3")
    with pytest.raises(jobs.PileupError, match="without exactly one pileup file: 1, such as t3: 0"):
        job(spark, root)
    put(f"{root}/taxa/t3/t3.pileups", "PG_c1\t1\tA\t0\n")
    with pytest.raises(jobs.PileupError, match="taxa without data: 1, such as t3"):
        job(spark, root)
    assert [r["taxon"] for r in spark.read.csv(f"{root}/out/offenders", header=True, sep="\t").collect()] in (["t3"], [])


def test_two_pileups(spark, tmp_path):
    for n in ("a", "b"):
        put(f"{tmp_path}/t1/{n}.pileups", LINE)
    with pytest.raises(jobs.PileupError, match="such as t1: 2"):
        jobs.check_roster(spark, str(tmp_path))


def test_groups_of_relative_and_uri_folders(spark, tmp_path, monkeypatch):
    put(f"{tmp_path}/reads/g1/a_1.fastq.gz")
    put(f"{tmp_path}/reads/b_1.fastq.gz")
    monkeypatch.chdir(tmp_path)
    for root in (f"{tmp_path}/reads", f"{tmp_path}/reads/", f"file://{tmp_path}/reads"):
        assert sorted((r["sample_id"], r["grp"]) for r in manifests.fetch_manifest(spark, root).collect()) == [("a", "g1"), ("b", "Unknown")]


def test_missing_read_files_are_all_reported(spark, tmp_path):
    there = put(f"{tmp_path}/r/a_1.fq")
    rows = "".join(f"s{i},g,/nowhere/s{i}.fq,\n" for i in range(9))
    path = put(f"{tmp_path}/m.csv", f"a,g,{there},\n{rows}")
    with pytest.raises(M.ManifestError, match="unusable rows: 9") as refusal:
        jobs.check_manifest(spark, path, f"{tmp_path}/out")
    assert refusal.value.offenders.count() == 9 and os.path.isdir(f"{tmp_path}/out/offenders")
    assert manifests.fetch_manifest(spark, put(f"{tmp_path}/ok.csv", f"a,g,{there},\n")).count() == 1
