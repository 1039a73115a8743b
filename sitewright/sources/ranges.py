"""Text files in pieces of bounded size, however long their lines are.

A file is cut into byte ranges that are read on their own; no line has to fit into a record. What a
piece must know of the pieces before it (the contig or taxon it continues, how many lines, bases
or loci came before) is carried in a table with one row per piece: the first pass writes a
summary of each piece, windows over the summaries give the state at its start, and the second
pass parses it with that state. Ends of pieces are moved to the next line, or within a long line
behind the next blank, so names and loci stay whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from sitewright.operators.genome import SPAN, explode_range
from sitewright.session import materialise

#: Bytes of a piece; how far its ends move, longer than any name or locus; bytes searched backwards for the start of a line.
PIECE, REACH, BACK = 4 << 20, 1 << 16, 256
#: Letters of a sequence that travel in one row.
FRAGMENT = 1 << 16
COMPRESSED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")
BLOBS = "file string, start long, data binary, fresh boolean"


def located(file: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, as pyarrow opens it."""
    if re.match("(file:)?/", file):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", file)
    return pafs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", file))


def can_cut(listing: DataFrame) -> bool:
    """Whether byte ranges of all files can be read: not of compressed ones, nor from stores that only Spark opens."""
    found = F.regexp_extract("file", r"^([a-zA-Z0-9]+):", 1).alias("scheme"), F.regexp_extract("file", r"(\.[^./]+)$", 1).isin(*COMPRESSED).alias("packed")
    kinds = listing.select(*found).distinct().collect()
    return bool(kinds) and all(not k["packed"] and k["scheme"] in ("", "file", "hdfs", "s3", "s3a", "s3n", "gs") for k in kinds)


def listed(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``(file, length)`` of the files at ``path``; contents are not read."""
    found = spark.read.format("binaryFile")
    if glob is not None:
        found = found.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    return found.load(path).select(F.col("path").alias("file"), "length")


def _end(file, place: int, size: int) -> tuple[int, bool]:
    """Where a piece that would begin at ``place`` begins, and whether a line does there."""
    if not 0 < place < size:
        return min(place, size), True
    ahead = file.read_at(REACH + 1, place - 1)
    line = ahead.find(b"\n")
    if line >= 0:
        return place + line, True
    low = max(0, place - BACK)
    back = file.read_at(place - low, low).rfind(b"\n")
    if back >= 0 or low == 0:
        return low + back + 1, True
    blank = re.search(rb"[ \t]", ahead)
    return place + (blank.start() if blank else 0), False


def blobs_of(listing: DataFrame, size: int = PIECE) -> DataFrame:
    """Pieces ``(file, start, data, fresh)`` of files; ``fresh`` tells that a line begins at ``start``."""
    pieces = explode_range(listing, F.lit(0), F.expr(f"greatest(length - 1, 0) div {size}"), "piece")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, piece in zip(batch["file"].to_pylist(), batch["piece"].to_pylist()):
                store, path = located(file)
                with store.open_input_file(path) as opened:
                    start, fresh = _end(opened, piece * size, opened.size())
                    stop, _ = _end(opened, (piece + 1) * size, opened.size())
                    data = opened.read_at(max(0, stop - start), start)
                yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "data": pa.array([data], pa.binary()), "fresh": [fresh]})

    return pieces.select("file", "piece").repartition("file", "piece").mapInArrow(read, BLOBS).where("length(data) > 0")


def _per_blob(blobs: DataFrame, parse: Callable[..., Iterator[tuple]], schema: str, *state: str) -> DataFrame:
    """Rows that ``parse(data, start, fresh, *state)`` gives for each piece, after its file and start."""
    fields = [("file", "string"), ("piece", "long")] + [tuple(x.split()) for x in schema.split(",")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    arrow = pa.schema([(n, kinds[t]) for n, t in fields])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            held = batch.to_pydict()
            rows, weight = [], 0
            for i in range(batch.num_rows):
                for row in parse(held["data"][i], held["start"][i], held["fresh"][i], *(held[s][i] for s in state)):
                    rows.append((held["file"][i], held["start"][i], *row))
                    weight += 64 + sum(len(x) for x in row if isinstance(x, str))
                    if weight > 1 << 20:
                        yield emit(rows)
                        rows, weight = [], 0
            if rows:
                yield emit(rows)

    return blobs.select("file", "start", "data", "fresh", *state).mapInArrow(work, ", ".join(f"{n} {t}" for n, t in fields))


def _in_order() -> WindowSpec:
    return W.partitionBy("file").orderBy("piece")


def _before() -> WindowSpec:
    return _in_order().rowsBetween(W.unboundedPreceding, -1)


def _with_state(blobs: DataFrame, state: DataFrame) -> DataFrame:
    return blobs.join(state.withColumnRenamed("piece", "start"), ["file", "start"])


def lines_of(data: bytes, fresh: bool) -> Iterator[tuple[int, bytes, bool]]:
    """``(place, line, begins here)``; only the first line of a piece may have begun before it."""
    place = 0
    for line in data.split(b"\n"):
        yield place, line, fresh or place > 0
        place += len(line) + 1


def _letters(data: bytes) -> str:
    return b"".join(data.split()).decode("ascii", "replace")


def _fragments(letters: str, offset: int, size: int) -> Iterator[tuple[int, str]]:
    """``(offset, letters)`` cut at multiples of ``size``."""
    at = 0
    while at < len(letters):
        stop = min(len(letters), at + size - (offset + at) % size)
        yield offset + at, letters[at:stop]
        at = stop


# ---- FASTA


def _stretches(data: bytes, fresh: bool) -> Iterator[tuple[int | None, bytes, bytes]]:
    """``(place of the header, its line, what follows)``; the first has no header unless one begins the piece."""
    at = 0 if fresh and data[:1] == b">" else None
    if at is None:
        first = data.find(b"\n>")
        yield None, b"", data if first < 0 else data[:first]
        at = None if first < 0 else first + 1
    while at is not None:
        after = data.find(b"\n>", at)
        line, _, body = data[at + 1 : len(data) if after < 0 else after].partition(b"\n")
        yield at, line, body
        at = None if after < 0 else after + 1


def _contig(line: bytes) -> str:
    return (line.split() or [b""])[0].decode("utf-8", "replace")


def _fasta_summary(data: bytes, start: int, fresh: bool) -> Iterator[tuple]:
    found, name, letters, lead = None, None, 0, 0
    for place, line, body in _stretches(data, fresh):
        if place is not None:
            found, name, letters = start + place, _contig(line), 0
        letters += sum(map(len, body.split()))
        lead = letters if place is None else lead
    yield found, name, letters, lead


def _fasta_rows(span: int) -> Callable[..., Iterator[tuple]]:
    def parse(data: bytes, start: int, fresh: bool, contig_ord: int | None, contig: str | None, before: int, goes_on: bool) -> Iterator[tuple]:
        end = data.rstrip()
        for place, line, body in _stretches(data, fresh):
            if place is not None:
                contig_ord, contig, before = start + place, _contig(line), 0
                if not body.strip() and not (goes_on and end.endswith(b">" + line.rstrip())):
                    yield contig_ord, contig, 0, ""
            if contig_ord is not None:
                for offset, seq in _fragments(_letters(body), before, span):
                    yield contig_ord, contig, offset, seq

    return parse


def fasta_fragments(blobs: DataFrame, span: int = SPAN) -> DataFrame:
    """``(file, contig_ord, contig, offset, seq)``: letters of contigs, cut at multiples of ``span`` and where pieces end.

    ``contig_ord`` is the byte of the header in its file. A contig without letters has one row.
    """
    seen = materialise(_per_blob(blobs, _fasta_summary, "found long, name string, letters long, lead long"))
    headed = seen.withColumn("run", F.count("found").over(_in_order()))
    headed = headed.withColumn("so_far", F.sum("letters").over(W.partitionBy("file", "run").orderBy("piece")))
    last = F.last(F.when(F.col("found").isNotNull(), F.struct("found", "name")), ignorenulls=True).over(_before())
    state = headed.select(
        "file", "piece", last.alias("last"), F.coalesce(F.lag("so_far").over(_in_order()), F.lit(0)).cast("long").alias("before"),
        (F.coalesce(F.lead("lead").over(_in_order()), F.lit(0)) > 0).alias("goes_on"),
    )
    state = state.select("file", "piece", F.col("last.found").alias("contig_ord"), F.col("last.name").alias("contig"), "before", "goes_on")
    rows = _per_blob(_with_state(blobs, state), _fasta_rows(span), "contig_ord long, contig string, offset long, seq string", "contig_ord", "contig", "before", "goes_on")
    return rows.drop("piece")


def fasta_chunks(blobs: DataFrame, span: int = SPAN) -> DataFrame:
    """Chunks ``(file, contig_ord, contig, offset, seq)`` aligned to multiples of ``span``; only chunks shorter than it are gathered again."""
    rows = fasta_fragments(blobs, span)
    whole = F.length("seq") == span
    cut = rows.where(~whole).withColumn("chunk", F.expr(f"offset div {span}"))
    parts = F.array_sort(F.collect_list(F.struct("offset", "seq")))
    joined = cut.groupBy("file", "contig_ord", "contig", "chunk").agg(parts.alias("parts"))
    seq = F.array_join(F.transform("parts", lambda p: p["seq"]), "")
    return rows.where(whole).unionByName(joined.select("file", "contig_ord", "contig", F.get("parts", F.lit(0))["offset"].alias("offset"), seq.alias("seq")))


# ---- PHYLIP


def _phylip_summary(data: bytes, start: int, fresh: bool) -> Iterator[tuple]:
    first, n = None, 0
    for _, line, begins in lines_of(data, fresh):
        if begins and line.strip():
            n += 1
            first = first or line.decode("utf-8", "replace").strip()[:100]
    yield n, first


def _phylip_rows(n_taxa: int, strict: bool) -> Callable[..., Iterator[tuple]]:
    def parse(data: bytes, start: int, fresh: bool, before: int) -> Iterator[tuple]:
        number = before - 1  # of the line at hand; the header is line 0
        for place, line, begins in lines_of(data, fresh):
            name = None
            if begins:
                if not line.strip():
                    continue
                number += 1
                if 0 < number <= n_taxa:
                    bare = line.lstrip() if not strict else line
                    cut = 10 if strict else len(bare.split(None, 1)[0])
                    name, line = bare[:cut].decode("utf-8", "replace").strip(), bare[cut:]
            if number > 0:
                letters = _letters(line)
                taxon = (number - 1) % n_taxa
                if name is not None:
                    yield taxon, name, start + place, ""
                for i, (_, seq) in enumerate(_fragments(letters, 0, FRAGMENT)):
                    yield taxon, None, start + place + i, seq

    return parse


def phylip_fragments(blobs: DataFrame, strict: bool = False) -> DataFrame:
    """``(taxon, line_no, seq)`` of one PHYLIP file: sequential or interleaved, names up to a blank or, if ``strict``, ten letters long.

    Blocks after the first have no names; a taxon's lines are one in every ``n_taxa``.
    """
    seen = materialise(_per_blob(blobs, _phylip_summary, "lines long, first string"))
    head = seen.where("first is not null").orderBy("piece").select("first").limit(1).collect()
    total = seen.agg(F.sum("lines")).first()[0]
    shape = head[0]["first"].split() if head else []
    if not shape or not shape[0].isdigit() or not int(shape[0]) or (total - 1) % int(shape[0]):
        raise ValueError("not a PHYLIP file: the number of lines does not fit that of taxa")
    n_taxa = int(shape[0])
    state = seen.select("file", "piece", F.coalesce(F.sum("lines").over(_before()), F.lit(0)).cast("long").alias("before"))
    rows = _per_blob(_with_state(blobs, state), _phylip_rows(n_taxa, strict), "number int, name string, line_no long, seq string", "before")
    names = rows.where("name is not null").select("number", F.col("name").alias("taxon"))  # a row per taxon
    return rows.where("name is null").join(F.broadcast(names), "number").select("taxon", "line_no", "seq")


# ---- NEXUS


def _bare(line: bytes) -> bytes:
    """The words of a comment line without its brackets."""
    return line.strip().removeprefix(b"[").removesuffix(b"]")


def _nexus_summary(data: bytes, start: int, fresh: bool) -> Iterator[tuple]:
    begin = first_end = end_after = None
    lead = own = 0
    last = None
    for place, line, begins in lines_of(data, fresh):
        text = line.strip()
        if not begins:
            lead = len(_bare(text).split())
        elif text[:6].upper() == b"MATRIX" and begin is None:
            begin, own, last = start + place, 0, None
        elif text[:1] == b";":
            first_end = start + place if first_end is None else first_end
            end_after = start + place if begin is not None and end_after is None else end_after
            last = ";"
        elif text[:1] == b"[":
            own += len(_bare(text).split())
            last = "["
        elif text:
            last = text.split(None, 1)[0].decode("utf-8", "replace")
    yield begin, first_end, end_after, lead, own, last


def _nexus_rows(begin: int, end: int) -> Callable[..., Iterator[tuple]]:
    def parse(data: bytes, start: int, fresh: bool, last: str | None, before: int) -> Iterator[tuple]:
        for place, line, begins in lines_of(data, fresh):
            at = start + place
            if begins:
                line = line.strip()
                if not line:
                    continue
                name, *rest = line.split(None, 1)
                last = "[" if line[:1] == b"[" else name.decode("utf-8", "replace")
            if at >= end or (at <= begin if begins else start <= begin):
                continue
            if last == "[":
                for locus in _bare(line).split():
                    yield None, at, None, before, locus.decode("utf-8", "replace")
                    before += 1
            elif last is not None:
                body = line if not begins else rest[0] if rest else b""
                for i, (_, seq) in enumerate(_fragments(_letters(body), 0, FRAGMENT)):
                    yield last, at + i, seq, None, None

    return parse


def nexus_fragments(blobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(taxon, line_no, seq)`` and loci ``(site_ord, locus)`` of one NEXUS file, interleaved or not.

    Loci are the words of comment lines within the matrix.
    """
    seen = materialise(_per_blob(blobs, _nexus_summary, "begin long, first_end long, end_after long, lead long, own long, last string"))
    begin = seen.agg(F.min("begin")).first()[0]
    if begin is None:
        raise ValueError("not a NEXUS file: it has no matrix")
    end = seen.agg(F.min(F.when(F.col("begin") == begin, F.col("end_after")).when(F.col("piece") > begin, F.col("first_end")))).first()[0]
    inside = seen.where((F.col("piece") > begin) | (F.col("begin") == begin))
    lasting = F.last("last", ignorenulls=True).over(_before())
    state = inside.withColumn("last", lasting).join(inside.select("file", "piece", F.col("last").alias("own_last")), ["file", "piece"])
    loci = F.col("own") + F.when(F.col("last") == "[", F.col("lead")).otherwise(F.lit(0))
    state = state.withColumn("before", F.coalesce(F.sum(loci).over(_before()), F.lit(0)).cast("long")).select("file", "piece", "last", "before")
    rows = _per_blob(_with_state(blobs, state), _nexus_rows(begin, (1 << 62) if end is None else end), "taxon string, line_no long, seq string, site_ord long, locus string", "last", "before")
    return rows.where("taxon is not null").select("taxon", "line_no", "seq"), rows.where("locus is not null").select("site_ord", "locus")
