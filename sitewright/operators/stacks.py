"""Pileups from aligned reads: the stack of read bases at every covered reference position."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.operators.genome import rechunk
from sitewright.operators.projection import REVERSE, mapped_only

#: Letters of the shortest stretch of reference: a read is sent to each stretch that it covers.
LEAST = 256

#: Tokens that are laid out at a time.
TOKENS = 1 << 21

LINES = "array<struct<pos:bigint,ref:string,text:string,n:int>>"


def _segments(cigar: str) -> list[tuple[int, str]]:
    """Sizes and operations of a CIGAR string."""
    sizes = re.split("[^0-9]", cigar)
    return [(int(sizes[i]), op) for i, op in enumerate(re.split("[0-9]+", cigar)[1:])]


def _covered(cigars: pa.Array) -> pa.Array:
    """Reference bases of each read: those it matches, lacks or skips."""
    coded = cigars.dictionary_encode()
    sums = [None if c is None else sum(size for size, op in _segments(c) if op in ("M", "=", "X", "D", "N")) for c in coded.dictionary.to_pylist()]
    return pa.array(sums, pa.int64()).take(coded.indices)


def _steps(cigar: str) -> list[tuple[str, int, int, int, list]]:
    """Matched, deleted and skipped stretches of a read ``(op, size, at, base, marks)``.

    ``at`` and ``base`` count reference and read bases before the stretch. ``marks`` are the insertions and
    deletions that follow it, as ``(text, base, size)`` with the read bases that the text ends in. Clips and
    insertions move on the read, deletions and skips on the reference.
    """
    at, base, steps = 0, 0, []
    for size, op in _segments(cigar):
        if op in ("I", "D") and steps:
            steps[-1][4].append((f"+{size}", base, size) if op == "I" else (f"-{size}" + "N" * size, 0, 0))
        aligned = op in ("M", "=", "X")
        if aligned or op in ("D", "N"):
            steps.append(("M" if aligned else op, size, at, base, []))
            at += size
        if aligned or op in ("I", "S"):
            base += size
    return steps


def _ragged(first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``sizes`` so many rows: the row they come from, and ``first`` and on."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes - first, sizes)


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all ``texts`` in a row as code points, and the first and the number of those of each; none for null."""
    raw = texts.cast(pa.binary())
    whole = b"".join(filter(None, raw.to_pylist()))
    if whole.isascii():
        letters, sizes = np.frombuffer(whole, np.uint8), pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    else:
        read = [(x or b"").decode("utf-8", "replace") for x in raw.to_pylist()]
        letters, sizes = np.frombuffer("".join(read).encode("utf-32-le"), "<u4"), np.array([len(x) for x in read], np.int64)
    return letters.astype(np.uint32), np.cumsum(sizes) - sizes, sizes


def _cased(codes: np.ndarray, case: str) -> np.ndarray:
    """``codes`` in upper or lower case, where a letter's other case is one letter."""
    known, place = np.unique(codes, return_inverse=True)
    turned = [getattr(chr(c), case)() for c in known.tolist()]
    return np.array([ord(t) if len(t) == 1 else c for t, c in zip(turned, known.tolist())], np.uint32)[place]


def _bases(letters: np.ndarray, first: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The letter at place ``at`` of its text, counted from 1 (from -1 backward), or 0 where there is none."""
    place = np.where(at > 0, at - 1, np.where(at < 0, sizes + at, 0))
    there = (place >= 0) & (place < sizes)
    found = np.zeros(len(at), np.uint32)
    found[there] = letters[(first + place)[there]]
    return found


class _Stack:
    """Reads with one start in a stretch of the reference, for many starts and stretches at once."""

    def __init__(self, groups: pa.RecordBatch, span: int, known: dict[str, list]) -> None:
        self.n = len(groups)
        start = groups["start"]
        self.placed = start.is_valid().to_numpy(zero_copy_only=False)
        self.start = start.fill_null(0).to_numpy()
        chunk = groups["chunk"].fill_null(0).to_numpy()
        refs = pc.list_value_length(groups["refs"]).fill_null(0).to_numpy().astype(np.int64)
        reads = groups["reads"].flatten()
        group = np.repeat(np.arange(self.n), pc.list_value_length(groups["reads"]).to_numpy())
        names = reads.field("read")
        order = pc.sort_indices(pa.table({"g": group, "read": names}), [("g", "ascending"), ("read", "ascending")], null_placement="at_start").to_numpy()
        self.names, self.rank = names, pc.dictionary_encode(names, null_encoding="encode").indices.to_numpy()
        # a read meets each chunk of its stretch, or none
        row, ref = _ragged((np.cumsum(refs) - refs)[group[order]], np.maximum(refs, 1)[group[order]])
        self.read = order[row]
        self.group = group[self.read]
        same = (self.group[1:] == self.group[:-1]) & (self.rank[self.read][1:] == self.rank[self.read][:-1])
        self.alike = np.zeros(self.n, bool)
        self.alike[self.group[1:][same]] = True
        self.alike |= ~self.placed

        chunks = groups["refs"].flatten()
        self.ref_letters, self.ref_first, self.ref_sizes = (np.append(x, 0) for x in _letters(chunks.field("ref_seq")))
        self.ref_letters = _cased(self.ref_letters, "upper").astype(np.uint32)
        self.ref_offset = np.append(chunks.field("offset").fill_null(0).to_numpy(), 0)
        self.has_ref = (refs > 0) & self.placed
        self.ref = np.where(refs[self.group] > 0, ref, len(self.ref_offset) - 1)
        self.first_ref = np.where(refs > 0, np.cumsum(refs) - refs, len(self.ref_offset) - 1)

        coded = reads.field("cigar").dictionary_encode()
        every = [known.get(c) or known.setdefault(c, _steps(c)) for c in coded.dictionary.to_pylist()]
        self.cigar = coded.indices.to_numpy()[self.read]
        flat = [s for steps in every for s in steps]
        self.op = np.array([ord(s[0]) for s in flat], np.uint8)
        self.size, self.at, self.base = (np.array([s[k] for s in flat], np.int64) for k in (1, 2, 3))
        self.marks = [m for s in flat for m in s[4]]
        self.n_marks = np.array([len(s[4]) for s in flat], np.int64)
        n_steps = np.array([len(x) for x in every], np.int64)
        covered = np.array([sum(s[1] for s in x) for x in every], np.int64)[self.cigar]
        self.covered = covered
        self.n_steps, self.first_step = n_steps, np.cumsum(n_steps) - n_steps
        self.first = np.where(self.placed, np.maximum(0, chunk * span + 1 - self.start), 0)
        self.last = np.where(self.placed[self.group], np.minimum(covered - 1, ((chunk + 1) * span - self.start)[self.group]), covered - 1)

        self.backward = (reads.field("flag").to_numpy()[self.read] & REVERSE) > 0
        self.quality = np.minimum(reads.field("mapq").fill_null(0).to_numpy()[self.read].astype(np.int64), 93) + 33
        seqs = reads.field("seq")
        self.letters, self.seq_first, self.seq_size = _letters(seqs)
        self.no_seq = seqs.is_null().to_numpy(zero_copy_only=False)

    def _within(self, low: int, high: int) -> None:
        """Tokens of the sites ``low`` to ``high - 1`` of each stretch, counted from the first site of its reads; reads without start have one site."""
        begin, last = self.first, self.last
        if self.placed.all():
            begin = self.first + low
            last = np.minimum(last, (self.first + high - 1)[self.group])
        # a row a step of a read, then a row a token
        of, step = _ragged(self.first_step[self.cigar], self.n_steps[self.cigar])
        lowest = np.maximum(self.at[step], begin[self.group[of]])
        highest = np.minimum(self.at[step] + self.size[step] - 1, last[of])
        made, self.offset = _ragged(lowest, np.maximum(0, highest - lowest + 1))
        self.of, self.step = of[made], step[made]
        self._tokens()
        self.lines = np.zeros(self.n, np.int64)
        np.maximum.at(self.lines, self.group, np.maximum(0, last - begin[self.group] + 1))
        self.lines[~self.placed] = 1
        self.line_of, at = _ragged(begin, self.lines)
        self.pos = self.start[self.line_of] + at
        here = self.group[self.of]
        self.line = (np.cumsum(self.lines) - self.lines)[here] + np.where(self.placed[here], self.offset - begin[here], 0)

    def _tokens(self) -> None:
        read = self.read[self.of]
        i = self.offset - self.at[self.step]
        op = self.op[self.step]
        letter = _bases(self.letters, self.seq_first[read], self.seq_size[read], self.base[self.step] + i + 1)
        letter = np.where(op == ord("M"), _cased(letter, "upper"), np.where(op == ord("D"), ord("*"), ord(">"))).astype(np.uint32)
        ref, group = self.ref[self.of], self.group[self.of]
        base = _bases(self.ref_letters, self.ref_first[ref], self.ref_sizes[ref], self.start[group] + self.offset - self.ref_offset[ref])
        base = np.where(self.has_ref[group] & (base > 0), base, ord("N"))
        backward = self.backward[self.of]
        own = np.where(backward, _cased(letter, "lower"), letter)
        self.shown = np.where(letter == base, np.where(backward, ord(","), ord(".")), np.where(letter == ord(">"), np.where(backward, ord("<"), ord(">")), own)).astype(np.uint32)
        # marks after the last base of a step: a literal, then bases of the read
        marked = np.flatnonzero((i == self.size[self.step] - 1) & (self.n_marks[self.step] > 0))
        at, mark = _ragged((np.cumsum(self.n_marks) - self.n_marks)[self.step[marked]], self.n_marks[self.step[marked]])
        self.mark_token = marked[at]
        literals = "".join(m[0] for m in self.marks)
        literal_sizes = np.array([len(m[0]) for m in self.marks], np.int64)
        self.literals = np.frombuffer(literals.encode("ascii"), np.uint8).astype(np.uint32)
        self.literal_first, self.literal_size = (np.cumsum(literal_sizes) - literal_sizes)[mark], literal_sizes[mark]
        base_at, size = (np.array([m[k] for m in self.marks], np.int64)[mark] for k in (1, 2))
        read = self.read[self.of[self.mark_token]]
        self.inserted_first = self.seq_first[read] + base_at
        self.inserted_size = np.maximum(0, np.minimum(size, self.seq_size[read] - base_at))
        self.null = self.no_seq[self.read[self.of]] & (op == ord("M"))
        self.null[self.mark_token[(size > 0) & self.no_seq[read]]] = True

        self.head = np.where(self.offset == 0, 1 + (self.quality[self.of] >= 0), 0)
        self.tail = (self.offset == self.covered[self.of] - 1).astype(np.int64)
        self.mark_size = self.literal_size + self.inserted_size
        self.length = self.head + (self.shown > 0) + self.tail + np.bincount(self.mark_token, self.mark_size, len(op)).astype(np.int64)
        self.length[self.null] = 0

    def laid(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the tokens in ``order``, and the first of each token."""
        first = np.empty(len(order), np.int64)
        sizes = self.length[order]
        first[order] = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.uint32)
        head = np.flatnonzero((self.head > 0) & ~self.null)
        out[first[head]] = ord("^")
        head = head[self.head[head] > 1]
        out[first[head] + 1] = self.quality[self.of[head]]
        shown = np.flatnonzero((self.shown > 0) & ~self.null)
        out[first[shown] + self.head[shown]] = self.shown[shown]
        tail = np.flatnonzero((self.tail > 0) & ~self.null)
        out[first[tail] + self.length[tail] - 1] = ord("$")
        # several marks of a token stand one after the other
        new = np.r_[True, self.mark_token[1:] != self.mark_token[:-1]] if len(self.mark_token) else np.zeros(0, bool)
        before = np.cumsum(self.mark_size) - self.mark_size
        before -= np.maximum.accumulate(np.where(new, before, 0)) if len(before) else 0
        token = self.mark_token
        to = first[token] + self.head[token] + (self.shown[token] > 0) + before
        told = ~self.null[token]
        for source, at, size, shift in ((self.literals, self.literal_first, self.literal_size, 0), (self.letters, self.inserted_first, self.inserted_size, self.literal_size)):
            of, place = _ragged(at[told], size[told])
            _, goes = _ragged((to + shift)[told], size[told])
            found = source[place]
            back = self.backward[self.of[token[told][of]]]
            out[goes] = np.where(back, _cased(found, "lower"), found)
        return out, first

    def table(self, low: int, high: int) -> tuple[np.ndarray, pa.Array]:
        """Number of lines of each group at these sites, and the lines ``(pos, ref, text, n)``."""
        self._within(low, high)
        n = int(self.lines.sum())
        order = np.argsort(self.line.astype(np.uint16) if n <= 1 << 16 else self.line, kind="stable")
        depth = np.bincount(self.line, minlength=n)
        if self.alike.any():
            out, first = self.laid(np.arange(len(self.of)))
            ends = np.cumsum(depth)
            names = self.names.cast(pa.binary()).to_pylist()
            texts = out.astype("<u4").tobytes().decode("utf-32-le")
            read = self.read[self.of]

            def key(t: int) -> tuple:
                name = names[read[t]]
                return name is not None, name or b"", not self.null[t], texts[first[t] : first[t] + self.length[t]].encode("utf-8", "surrogatepass")

            for line in np.flatnonzero(self.alike[self.line_of]).tolist():
                part = slice(ends[line] - depth[line], ends[line])
                order[part] = sorted(order[part].tolist(), key=key)
        out, _ = self.laid(order)
        ends = np.cumsum(np.bincount(self.line, self.length, n).astype(np.int64))
        group = self.line_of
        ref = self.first_ref[group]
        base = _bases(self.ref_letters, self.ref_first[ref], self.ref_sizes[ref], self.pos - self.ref_offset[ref])
        base = np.where(self.has_ref[group] & (base > 0), base, ord("N")).astype(np.uint32)
        columns = [pa.array(self.pos, mask=~self.placed[group]), _strings(base, np.arange(1, n + 1)), _strings(out, ends), pa.array(depth.astype(np.int32))]
        return self.lines, pa.StructArray.from_arrays(columns, names=["pos", "ref", "text", "n"])


def _strings(codes: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Texts of ``codes`` up to each of ``ends``."""
    if codes.max(initial=0) < 128:
        offsets = np.concatenate([[0], ends])
        if offsets[-1] < 1 << 31:
            return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(codes.astype(np.uint8)))
    text = codes.astype("<u4").tobytes().decode("utf-32-le")
    return pa.array([text[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())], pa.string())


def _stacked(span: int):
    """Task body: ``(contig, chunk, start, reads, refs)`` to ``(contig, start, lines)``, the joined tokens of the reads of one start at each site."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list] = {}
        for batch in batches:
            seqs = pc.fill_null(pc.binary_length(batch["reads"].flatten().field("seq")), 0).to_numpy()
            ends = np.cumsum(pc.list_value_length(batch["reads"]).to_numpy())
            work = np.concatenate([[0], np.cumsum(np.minimum(seqs.astype(np.int64) + 32, span))])[ends]
            cuts = np.flatnonzero(np.diff(work // TOKENS, prepend=0))
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if a == b:
                    continue
                if len(known) > 1 << 16:
                    known.clear()
                part = batch.slice(a, b - a)
                stack = _Stack(part, span, known)
                sites = span if b - a > 1 or part["start"].null_count else max(1, TOKENS // len(stack.read))  # very many reads of one start come some sites at a time
                for low in range(0, span, sites):
                    sizes, lines = stack.table(low, low + sites)
                    if not len(lines):
                        break
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                    yield pa.RecordBatch.from_arrays([part["contig"], part["start"], pa.ListArray.from_arrays(offsets, lines)], names=["contig", "start", "lines"])

    return run


def pileup_of_reads(reads: DataFrame, chunks: DataFrame, span: int = 4096, ways: int = 8) -> DataFrame:
    """Pileup rows ``(contig, pos, ref, depth, bases, quals)`` of aligned reads against reference chunks.

    Reads stand in order of their start, then name. Bases equal to the reference are dots, or commas on the
    reverse strand, others letters, lower case on the reverse strand; reads begin with ``^`` and their mapping
    quality, end with ``$``, and insertions and deletions are told after the base before them. Positions without a
    reference base have ``N``.

    Reads are shuffled whole, once for each stretch of the reference that they cover, and meet the reference
    there; bases leave a task only as the joined tokens of all reads with one start. Starts are dealt into
    ``ways`` shares of a stretch, so a very deep site is put in order by many tasks.
    """
    span = max(span, LEAST)
    placed = mapped_only(reads).withColumn("span", F.arrow_udf(_covered, "bigint")("cigar"))
    stretches = F.sequence(F.expr(f"(start - 1) div {span}"), F.expr(f"(start + span - 2) div {span}"))
    pieces = placed.filter("span > 0").select("read", "contig", F.col("start").cast("bigint").alias("start"), "flag", "mapq", "cigar", "seq", F.explode_outer(stretches).alias("chunk"))
    pieces = pieces.withColumn("way", F.pmod(F.xxhash64("start"), F.lit(ways)).cast("int")).repartition("contig", "chunk", "way")
    groups = pieces.groupBy("contig", "chunk", "way", "start").agg(F.collect_list(F.struct("read", "flag", "mapq", "cigar", "seq")).alias("reads"))
    reference = rechunk(chunks, span).select("contig", F.expr(f"offset div {span}").alias("chunk"), F.struct("offset", F.col("seq").alias("ref_seq")).alias("ref"))
    reference = reference.groupBy("contig", "chunk").agg(F.collect_list("ref").alias("refs"))
    reference = reference.withColumn("way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    met = groups.join(reference, ["contig", "chunk", "way"], "left").select("contig", F.col("chunk").cast("bigint").alias("chunk"), "start", "reads", "refs")
    kind = pieces.schema["contig"].dataType.simpleString()
    lines = met.mapInArrow(_stacked(span), f"contig {kind}, start bigint, lines {LINES}")
    lines = lines.select("contig", "start", F.explode_outer("lines").alias("l")).select("contig", "l.pos", "l.ref", "start", "l.text", "l.n")
    joined = lines.groupBy("contig", "pos", "ref").agg(F.sort_array(F.collect_list(F.struct("start", "text", "n"))).alias("parts"))
    depth = F.aggregate("parts", F.lit(0), lambda n, x: n + x["n"])
    bases = F.array_join(F.transform("parts", lambda x: x["text"]), "")
    return joined.select("contig", "pos", "ref", depth.alias("depth"), bases.alias("bases"), F.repeat(F.lit("I"), depth).alias("quals"))
