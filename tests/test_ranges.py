"""Files in byte ranges, with lines longer than a piece."""

import random

import pytest

from sitewright.sources import alignments, ranges, sequences

SIZE = 100_000  # below the reach of a boundary


def put(path, data):
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def letters(rng, n):
    return "".join(rng.choices("ACGTN", k=n))


def blobs(spark, path):
    return ranges.blobs_of(ranges.listed(spark, path), SIZE)


def test_pieces_give_the_file(spark, tmp_path):
    rng = random.Random(1)
    for name, text in (("a", letters(rng, 950_000)), ("b", "".join(letters(rng, rng.randint(0, 300)) + "\n" for _ in range(3000))), ("c", ""), ("d", " ".join(f"c{i}/1" for i in range(90_000)))):
        path = put(tmp_path / name, text)
        got = sorted((r.start, bytes(r.data), r.fresh) for r in blobs(spark, path).collect())
        assert b"".join(d for _, d, _ in got).decode() == text and all(len(d) < 3 * SIZE for _, d, _ in got)
        assert all(fresh == (start == 0 or text[start - 1] == "\n") for start, _, fresh in got)
        if name == "d":
            assert all(d[:1] == b"c" and d[-1:] in (b" ", b"1") for _, d, _ in got) and len(got) > 5


def test_fasta_with_contigs_over_many_pieces(spark, tmp_path):
    rng = random.Random(2)
    contigs = [("one", letters(rng, 750_001)), ("two", ""), ("three", letters(rng, 5)), ("four", letters(rng, 4096 * 90)), ("five", ""), ("six", letters(rng, 200_000))]
    wrapped = lambda s, n: "\n".join(s[i : i + n] for i in range(0, len(s), n))
    for width in (10**9, 60, 99_999):
        path = put(tmp_path / f"{width}.fa", "".join(f">{c} more > words\r\n{wrapped(s, width)}\n" for c, s in contigs))
        for span in (4096, 1 << 16):
            rows = ranges.fasta_chunks(blobs(spark, path), span).orderBy("contig_ord", "offset").collect()
            assert all(r.offset % span == 0 and len(r.seq) <= span for r in rows)
            joined = {}
            for r in rows:
                assert r.offset == len(joined.get(r.contig, ""))
                joined[r.contig] = joined.get(r.contig, "") + r.seq
            assert joined == dict(contigs) and list(joined) == [c for c, _ in contigs]
        assert sum(len(r.seq) for r in sequences.read_fasta(spark, path).collect()) == sum(len(s) for _, s in contigs)


def columns_of(seqs):
    return ["".join(x) for x in zip(*[s for _, s in sorted(seqs)])]


def read(spark, path, **how):
    sites, taxa = alignments.read_alignment(spark, path, **how)
    return [r.column for r in sites.orderBy("site_ord").collect()], taxa, sites


def test_phylip_sequential_interleaved_and_strict(spark, tmp_path):
    rng = random.Random(3)
    seqs = [(n, letters(rng, 1000)) for n in ("alpha", "be", "c")]
    head = " 3 1000\n"
    spaced = lambda s: " ".join(s[i : i + 10] for i in range(0, len(s), 10))
    relaxed = head + "".join(f"{n}  {s}\n" for n, s in seqs)
    blocks = head + "".join(f"{n} {spaced(s[:400])}\n" for n, s in seqs) + "\n" + "".join(f"  {spaced(s[400:])}\n" for _, s in seqs)
    for name, text in (("a.phylip-relaxed", relaxed), ("b.phy", blocks)):
        got, taxa, _ = read(spark, put(tmp_path / name, text))
        assert got == columns_of(seqs) and taxa == sorted(n for n, _ in seqs)
    strict = [("Homo sap A", seqs[0][1]), ("Homo sap B", seqs[1][1]), ("Pan", seqs[2][1])]
    text = head + "".join(f"{n:10}{spaced(s[:30])}\n" for n, s in strict) + "".join(f"{s[30:]}\n" for _, s in strict)
    got, taxa, _ = read(spark, put(tmp_path / "c.phy", text), strict=True)
    assert got == columns_of(strict) and taxa == sorted(n for n, _ in strict)
    with pytest.raises(ValueError, match="number of lines"):
        read(spark, put(tmp_path / "d.phy", head + "a AC\nb AC\nc AC\na AC\n"))


def test_long_lines_of_alignments(spark, tmp_path):
    rng = random.Random(4)
    n = 330_000
    seqs = [(t, letters(rng, n)) for t in ("x", "yy", "zed")]
    loci = [f"contig{i // 100}/{i % 100}" for i in range(n)]
    want = columns_of(seqs)
    phylip = blobs(spark, put(tmp_path / "a.phy", f"3 {n}\n" + "".join(f"{t} {s}\n" for t, s in seqs)))
    nexus = blobs(spark, put(tmp_path / "a.nex", f"#NEXUS\n[made by hand]\n\nBEGIN DATA;\n\tMatrix\n[ {' '.join(loci)} ]\n" + "".join(f"{t}\t{s}\n" for t, s in seqs) + ";\nend;\n[late]\nw AC\n"))
    assert phylip.count() > 8 and nexus.count() > 30
    taxa, named = ranges.nexus_fragments(nexus)
    for rows in (ranges.phylip_fragments(phylip), taxa):
        found = {}
        for r in rows.orderBy("line_no").collect():
            found[r.taxon] = found.get(r.taxon, "") + r.seq
        assert found == dict(seqs)
        assert [r.column for r in alignments.sequence_columns(rows, 3).orderBy("site_ord").where("site_ord % 997 = 0").collect()] == want[::997]
    assert [r.locus for r in named.orderBy("site_ord").collect()] == loci and named.agg({"site_ord": "max"}).first()[0] == n - 1


def test_nexus_interleaved_and_faults(spark, tmp_path):
    text = "#NEXUS\nbegin data;\nmatrix\n[ c/1 c/2 ]\nx AC\ny GT\n\n[ d/1 ]\nx A\ny T\n;\nend;"
    got, taxa, sites = read(spark, put(tmp_path / "a.nex", text))
    assert got == ["AG", "CT", "AT"] and taxa == ["x", "y"] and [r.locus for r in sites.orderBy("site_ord").collect()] == ["c/1", "c/2", "d/1"]
    with pytest.raises(ValueError, match="no matrix"):
        read(spark, put(tmp_path / "b.nex", "#NEXUS\n"))


def test_compressed_files_are_read_by_lines(spark, tmp_path):
    import gzip

    path = put(tmp_path / "a.fa.gz", gzip.compress(b">a\nACGT\n>b\nGG\n"))
    assert not ranges.can_cut(ranges.listed(spark, path))
    assert sorted((r.contig, r.seq) for r in sequences.read_fasta(spark, path).collect()) == [("a", "ACGT"), ("b", "GG")]
