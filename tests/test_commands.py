"""Commands for groups, clusters and the pangenome dispatch."""

import os

import pytest

from sitewright.__main__ import main


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write(text)
    return str(path)


def table(spark, path):
    return sorted(tuple(r) for r in spark.read.csv(path, sep="\t", header=True).collect())


TRIANGLE = "5\n/a/i0.fa\n/a/i1.fa\t1\n/a/i2.fa\t9\t9\n/a/i3.fa\t9\t8\t1\n/a/i4.fa\t50\t50\t50\t50\n"


def test_groups(spark, tmp_path):
    triangle = put(f"{tmp_path}/d.tri", TRIANGLE)
    labels = put(f"{tmp_path}/l.tsv", "i0\t0\ni1\t0\ni2\t1\ni3\t-1\n")
    main(["check-groups", "--triangle", triangle, "--labels", labels, "--out", f"{tmp_path}/v"])
    assert table(spark, f"{tmp_path}/v") == [("1.0", "9.0", "true")]
    main(["assign-groups", "--triangle", triangle, "--labels", labels, "--threshold", "5", "--out", f"{tmp_path}/g"])
    assert table(spark, f"{tmp_path}/g") == [("i0", "0"), ("i1", "0"), ("i2", "1"), ("i3", "1"), ("i4", "2")]
    main(["cluster", "--triangle", triangle, "--method", "hierarchical", "--out", f"{tmp_path}/c"])
    assert table(spark, f"{tmp_path}/c") == [(f"i{k}", str(k)) for k in range(5)]


def test_pangenome_dispatch(spark, tmp_path):
    fasta = put(f"{tmp_path}/ref.fa", ">a\nACGT\n")
    main(["build-pangenome", "--ref-path", fasta, "--name", "p", "--out", f"{tmp_path}/all"])
    assert sorted(os.listdir(f"{tmp_path}/all/p"))[:2] == ["contigs", "contigs.fa"]


def test_undetermined_reads(spark, tmp_path):
    for name in ("a_1", "Undetermined_1"):
        put(f"{tmp_path}/r/{name}.fastq.gz", "x")
    main(["manifest", "--location", f"{tmp_path}/r", "--ignore-undetermined", "--out", f"{tmp_path}/m"])
    assert spark.read.csv(f"{tmp_path}/m").count() == 1


def test_chosen_paths_and_missing_genome_size(spark, tmp_path, capsys):
    files = [put(f"{tmp_path}/i{k}.fa", "".join(f">k{j}\n{'A' * (20 + k + j)}\n" for j in range(3))) for k in range(4)]
    rows = [files[0], f"{files[1]}\t1", f"{files[2]}\t1\t1", f"{files[3]}\t9\t9\t9"]
    triangle = put(f"{tmp_path}/d.tri", "\t4\n" + "\n".join(rows) + "\n")
    main(["choose-references", "--triangle", triangle, "--out", f"{tmp_path}/o"])
    assert capsys.readouterr().out.splitlines()[-1] == files[2]
    with pytest.raises(ValueError, match="genome size"):
        main(["build-pangenome", "--reads", f"{tmp_path}/r", "--ref-path", files[0], "--out", f"{tmp_path}/p"])
    with pytest.raises(FileNotFoundError):
        main(["build-pangenome", "--ref-path", files[0], "--out", f"{tmp_path}/no/such/folder"])
