"""Pileups of aligned reads and sweeps over genome runs, against walks base by base."""

import random
import re

import pyarrow as pa

from sitewright.operators import calling as CA
from sitewright.operators import clustering as K
from sitewright.operators import projection as P
from sitewright.operators import stacks as ST

READS = "read string, contig string, start bigint, flag int, mapq int, cigar string, seq string"


def slow_pileup(reads, genome):
    sites = {}
    for read, contig, start, flag, mapq, cigar, seq in sorted(reads, key=lambda r: (r[2], r[0])):
        if flag & 4:
            continue
        at, q, tokens = start, 0, []
        low = (lambda t: t.lower()) if flag & 16 else (lambda t: t)
        for size, op in ((int(n), o) for n, o in re.findall(r"(\d+)([MIDNSH=X])", cigar)):
            if op in "M=X":
                for i in range(size):
                    ref = (genome[contig] + "N" * 999)[at + i - 1]
                    tokens.append([at + i, ("," if flag & 16 else ".") if seq[q + i] == ref else low(seq[q + i])])
                at, q = at + size, q + size
            elif op == "I":
                if tokens:
                    tokens[-1][1] += low(f"+{size}{seq[q : q + size]}")
                q += size
            elif op in "DN":
                if tokens and op == "D":
                    tokens[-1][1] += low(f"-{size}{'N' * size}")
                tokens += [[at + i, "*" if op == "D" else "<" if flag & 16 else ">"] for i in range(size)]
                at += size
            elif op == "S":
                q += size
        if tokens:
            tokens[0][1] = "^" + chr(33 + min(mapq, 93)) + tokens[0][1]
            tokens[-1][1] += "$"
        for pos, token in tokens:
            sites.setdefault((contig, pos), []).append(token)
    return {k: (len(v), "".join(v)) for k, v in sites.items()}


def test_pileup_of_reads(spark):
    rng = random.Random(9)
    genome = {c: "".join(rng.choices("ACGT", k=90)) for c in "ab"}
    reads = []
    for i in range(150):
        cigar = rng.choice(["10M", "3S4M2I5M", "4M3D4M1S", "2M1I2M1D3M", "5M20N5M", "2H6=1X3M", "4S", "1I5M2D1I3M"])
        need = sum(int(n) for n, o in re.findall(r"(\d+)([MIDNSH=X])", cigar) if o in "MIS=X")
        reads.append((f"r{i:03}", rng.choice("ab"), rng.randint(1, 80), rng.choice([0, 16, 4, 1024]), rng.choice([0, 60, 200]), cigar, "".join(rng.choices("ACGT", k=need))))
    chunks = spark.createDataFrame([(c, 0, s) for c, s in genome.items()], "contig string, offset bigint, seq string")
    for span in (7, 4096):
        got = {(r.contig, r.pos): (r.depth, r.bases) for r in ST.pileup_of_reads(spark.createDataFrame(reads, READS), chunks, span).collect()}
        assert got == slow_pileup(reads, genome)
    back = CA.decode_pileup(ST.pileup_of_reads(spark.createDataFrame([r for r in reads if "N" not in r[5]], READS), chunks)).collect()
    assert all(len(r.decoded) == r.depth == len(r.quals) for r in back if r.ref != "N")
    assert ST.pileup_of_reads(spark.createDataFrame([], READS), chunks).count() == 0


def test_pileup_shuffles_reads_and_not_bases(spark, monkeypatch):
    """Reads of one name, reads over several stretches, and of 80 rows of 40 bases no base but joined ones in a shuffle."""
    reads = [(f"r{i // 2}", "a", 1 + i % 4, 16 * (i % 2), 60, "20M2D20M" if i % 3 else "40M", "ACGT" * 10) for i in range(80)]
    chunks = spark.createDataFrame([("a", 0, "ACGA" * 20)], "contig string, offset bigint, seq string")
    made = ST.pileup_of_reads(spark.createDataFrame(reads, READS), chunks)
    plan = made._jdf.queryExecution().explainString(made._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    below = plan[plan.index("ObjectHashAggregate", plan.index("Generate")) :]
    assert "posexplode" not in plan and "letter" not in plan and "way" in below
    monkeypatch.setattr(ST, "LEAST", 1)
    sorted_ = lambda t: sorted(t.upper())
    want = slow_pileup(reads, {"a": "ACGA" * 20})
    for span, ways in ((7, 1), (4096, 3)):
        got = {(r.contig, r.pos): (r.depth, r.bases) for r in ST.pileup_of_reads(spark.createDataFrame(reads, READS), chunks, span, ways).collect()}
        assert got.keys() == want.keys() and all(got[k][0] == d and sorted_(got[k][1]) == sorted_(t) for k, (d, t) in want.items())


def test_pileup_walks_bases_in_arrays(spark, monkeypatch):
    """No lambda walks a read, and odd rows stay: names that are null or come twice, reads without start, quality or bases, a repeated chunk of the reference."""
    genome = {"a": "ACGTACGTAC", "b": "GGTT"}
    reads = [
        ("r2", "a", 1, 0, 60, "4M", "ACGA"), (None, "a", 1, 16, None, "2M1I2M", "AGTCC"), ("r1", "a", 1, 0, 200, "1M2D1M", "GT"), ("r1", "a", 1, 0, 9, "3M", "GGG"),
        ("s", "a", None, 0, 0, "2M", "AC"), ("t", "a", None, 16, 0, "1M", "G"), ("n", "a", 9, 0, 0, "1M1D1M", None), ("u", "b", 3, 0, 0, "2M2N1M", "T"), ("v", None, 2, 0, 0, "1M", "A"),
    ]
    chunks = spark.createDataFrame([(c, 0, x) for c, x in genome.items()], "contig string, offset bigint, seq string")
    made = ST.pileup_of_reads(spark.createDataFrame(reads, READS), chunks)
    plan = made._jdf.queryExecution().explainString(made._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "lambda" not in plan[plan.index("Generate") :] and "MapInArrow" in plan
    got = {(r.contig, r.pos): (r.ref, r.depth, r.bases) for r in made.collect()}
    assert got == {
        ("a", 1): ("A", 4, "^!,^*G^~G-2NN^]."), ("a", 2): ("C", 4, "g+1t*G."), ("a", 3): ("G", 4, "c*.$."), ("a", 4): ("T", 3, "c$.$A$"),
        ("a", None): ("N", 3, "C$^!A^!g$"), ("a", 9): ("A", 1, ""), ("a", 10): ("C", 1, "*"), ("a", 11): ("N", 1, ""),
        ("b", 3): ("T", 1, "^!."), ("b", 4): ("T", 1, ""), ("b", 5): ("N", 1, ">"), ("b", 6): ("N", 1, ">"), ("b", 7): ("N", 1, "$"), (None, 2): ("N", 1, "^!A$"),
    }
    groups = pa.record_batch({"contig": ["a"], "chunk": [0], "start": [3], "reads": [[{"read": f"r{i}", "flag": 16 * (i % 2), "mapq": 60, "cigar": "3M1I2D4M", "seq": "ACGTACGT"} for i in range(9)]], "refs": [[{"offset": 0, "ref_seq": "ACGTACGTAC"}]]})
    whole = pa.Table.from_batches(list(ST._stacked(256)([groups])))
    monkeypatch.setattr(ST, "TOKENS", 20)  # many reads of one start come two sites at a time
    cut = pa.Table.from_batches(list(ST._stacked(256)([groups])))
    assert len(cut) == 5 and cut["lines"].combine_chunks().flatten().equals(whole["lines"].combine_chunks().flatten())
    twice = ST.pileup_of_reads(spark.createDataFrame(reads[:1], READS), chunks.union(chunks))
    assert {(r.pos, r.depth, r.bases) for r in twice.collect()} == {(1, 2, "^].^]."), (2, 2, ".."), (3, 2, ".."), (4, 2, "A$A$")}


def test_sweep_against_bases(spark):
    rng = random.Random(10)
    runs = [(f"q{i}", rng.choice("xy"), rng.choice([0, 16]), rng.randint(1, 400), 50, rng.choice([1, 2, 9, 40])) for i in range(120)] + [("long", "x", 0, 380, 1, 500), ("z", "y", 0, 5, 1, 0)]
    df = spark.createDataFrame(runs, "contig string, chrom string, direction int, genome_pos bigint, contig_pos bigint, size bigint")
    hits = {}
    for contig, chrom, direction, at, first, size in runs:
        for i in range(size):
            hits.setdefault((chrom, at + i - 1), []).append(f"{contig}/{first + (i if direction == 0 else -i)}")
    want = {k: v[0] for k, v in hits.items() if len(v) == 1}
    assert {(r.chrom, r.start): r.name for r in P.unique_bases(df).collect()} == want
    for width in (16, 1 << 16):
        cut = P.single_stretches(df.selectExpr("*", "monotonically_increasing_id() AS run"), width)
        assert sum(r.high - r.low for r in cut.collect()) == len(want)
    report = P.overlap_report_of_runs(df).first()
    assert (report.mapped, report.kept) == (sum(map(len, hits.values())), len(want))
    assert P.overlap_report_of_runs(df.where("false")).first().mapped == 0


def test_sweep_shuffles_each_run_once(spark):
    runs = [("a", "x", 0, 1, 1, 200), ("b", "x", 0, 5, 1, 3), ("b", "x", 16, 5, 9, 3), ("c", "x", 0, 40, 1, 5), ("d", "x", 0, 150, 1, 80), ("e", None, 0, 3, 1, 2), ("f", "x", 0, None, 1, 7), ("g", "x", 0, 3, 1, None)]
    df = spark.createDataFrame(runs, "contig string, chrom string, direction int, genome_pos bigint, contig_pos bigint, size bigint")
    bases, report = P.unique_bases(df), P.overlap_report_of_runs(df)
    want = {("x", p - 1): f"a/{p}" for p in [*range(1, 5), *range(8, 40), *range(45, 150)]} | {("x", p - 1): f"d/{p - 149}" for p in range(201, 230)} | {(None, 2): "e/1", (None, 3): "e/2"}
    assert {(r.chrom, r.start): r.name for r in bases.collect()} == want
    assert (report.first().mapped, report.first().kept) == (200 + 3 + 3 + 5 + 80 + 2 + 7, len(want))
    for made in (P.unique_bases(df), P.overlap_report_of_runs(df)):
        plan = made._jdf.queryExecution().explainString(made._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "ubquery" not in plan


def test_numbers_without_gaps(spark):
    rows = spark.range(0, 5000, 3).repartition(7).withColumnRenamed("id", "k")
    got = {r.k: r.slot for r in K.numbered(rows, "k").collect()}
    assert got == {3 * i: i + 1 for i in range(len(got))} and len(got) == 1667
    assert K.numbered(rows.where("false"), "k").count() == 0
