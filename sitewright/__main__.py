"""Command line: ``python -m sitewright <command> ...`` (use ``spark-submit`` on a cluster)."""

from __future__ import annotations

import argparse
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from sitewright.plans import jobs


def scheme_lines(scheme: DataFrame) -> Iterator[str]:
    """The subset scheme as CSV without a header, a row per sample."""
    for row in jobs.published_scheme(scheme).toLocalIterator():
        yield ",".join("" if v is None else ";".join(v) if isinstance(v, list) else str(v) for v in row)


def chosen_paths(chosen: DataFrame) -> Iterator[str]:
    """Paths of the references in order of choice, in one line."""
    yield ",".join(r["path"] for r in chosen.where("Is_Ref").orderBy("choice", "ord").select("path").collect())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sitewright")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name, fn, *args, say=None):
        p = sub.add_parser(name)
        names = []
        for flag, kw in args:
            p.add_argument(flag, **kw)
            names.append(flag.lstrip("-").replace("-", "_"))
        def run(spark, given):
            made = fn(spark, **{n: getattr(given, n) for n in names})
            for line in say(made) if say else ():
                print(line)

        p.set_defaults(run=run)

    need, number = {"required": True}, {"type": int, "required": True}
    suffixes = [
        ("--filetype", {"default": "fastq.gz"}),
        ("--forward-suffix", {"default": "_1.fastq.gz"}),
        ("--reverse-suffix", {"default": "_2.fastq.gz"}),
    ]
    out = ("--out", need)
    command("manifest", jobs.check_manifest, ("--location", need), out, *suffixes, ("--ignore-undetermined", {"action": "store_true"}))
    command(
        "prepare-reads", jobs.prepare_reads, ("--reads", need), out, ("--genome-size", number),
        ("--coverage", {"type": float, "default": 10.0}), *suffixes, say=scheme_lines,
    )
    command("pangenome", jobs.process_pangenome, ("--fasta", need), out, ("--prefix", {"default": "PG"}))
    command(
        "fetch-pangenome", jobs.fetch_pangenome,
        *[(f, {"default": ""}) for f in ("--path", "--ref-path", "--name", "--root")],
    )
    command(
        "call", jobs.call_taxa, ("--pileups", need), ("--pangenome", need), out, ("--minread", number),
        ("--thresh", {"type": float, "required": True}),
    )
    command("call-vectors", jobs.write_call_vectors, ("--calls-path", need), ("--pangenome", need), out)
    command("taxon-genomes", jobs.taxon_genomes, ("--pileups", need), ("--pangenome", need), out)
    command(
        "align", jobs.build_alignment, ("--calls-path", need), ("--pangenome", need), out,
        ("--num-missing", {"type": int, "default": None}),
    )
    command("filter", jobs.filter_alignment, ("--path", need), ("--missing", number), out)
    command("slice", jobs.slice_alignment, *[(f"--{n}", need) for n in ("all-loci", "wanted", "path", "dataset", "out")])
    command("pairwise", jobs.compare_taxa, ("--path", need), out)
    command("classify", jobs.classify_samples, ("--path", need), ("--references", need), out)
    command("map-genome", jobs.map_genome, ("--path", need), out)
    command(
        "choose-references", jobs.choose_references, ("--triangle", need), ("--ref-count", {"type": int, "default": 1}),
        out, ("--trim-name", {"default": ""}), say=chosen_paths,
    )
    labelled = (("--triangle", need), ("--labels", need), out, ("--trim-name", {"default": ""}))
    command("check-groups", jobs.check_groups, *labelled)
    command("assign-groups", jobs.assign_groups, *labelled, ("--threshold", {"type": float, "default": 1.0}))
    command(
        "cluster", jobs.cluster_isolates, ("--triangle", need), out, ("--method", {"choices": ["gmm", "hierarchical"], "default": "gmm"}),
        ("--max-clusters", {"type": int, "default": 10}), ("--trim-name", {"default": ""}),
    )
    command(
        "build-pangenome", jobs.pangenome, out, ("--reads", {"default": ""}), ("--ref-path", {"default": ""}), ("--name", {"default": "pangenome"}),
        ("--genome-size", {"type": int, "default": 0}), ("--coverage", {"type": float, "default": 10.0}), *suffixes,
    )
    command("run-log", jobs.run_log, ("--root", need), ("--alignment-log", need), out)
    return top


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("sitewright").getOrCreate(), args)


if __name__ == "__main__":
    main()
