"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import map_tables, partitions, smallest_reachable, utf8
from sitewright.llm.components import components
from sitewright.session import materialise

#: The grid works for links of up to this many bits: one of two halves then differs by at most one count.
BITS = 3
PAIRS = 0x55555555
#: Rows of one grid cell that a task compares at once; larger cells are compared block by block.
BLOCK = 4096


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-shingle] + 1])
    count = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > count).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""

    def work(rows: pa.Table) -> pa.Table:
        found = np.array([fingerprint(x, shingle, seed) for x in rows["text"].to_pylist()], np.uint64)
        return pa.table({"doc_id": rows["doc_id"], "fp": found.view(np.int64)})

    return map_tables(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), work, "doc_id long, fp long")


def grid_rows(points: DataFrame) -> DataFrame:
    """Cells of the popcount grid that each fingerprint owns or reaches.

    A fingerprint maps to 32 counts, the set bits of its two-bit segments. The Manhattan
    distance of two maps is a lower bound of their differing bits, so with at most 3 bits one
    half of the counts differs by at most 1. Each half gives its own cell and the cells one
    count higher; two points within 1 of each other share one of these.
    """
    halves = F.expr(
        "transform(array(fp & 4294967295L, shiftrightunsigned(fp, 32)), (h, n) -> "
        f"named_struct('half', n, 'own', (h & {PAIRS}L) + (shiftright(h, 1) & {PAIRS}L)))"
    )
    steps = F.expr("concat(array(own), filter(transform(sequence(0, 15), i -> if((shiftright(own, 2 * i) & 3L) < 2L, own + shiftleft(1L, 2 * i), null)), x -> x is not null))")
    rows = points.select("rep", "fp", F.explode(halves).alias("h")).select("rep", "fp", "h.half", "h.own")
    return rows.select("rep", "fp", F.explode(steps).alias("step"), "half").select((F.col("step") * 2 + F.col("half")).alias("cell"), "rep", "fp")


def _near(cell: np.ndarray, rep: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of equal cells; rows are sorted by cell."""
    left, right, alive = [], [], np.arange(len(cell))
    step = 1
    while True:
        alive = alive[alive + step < len(cell)]
        alive = alive[cell[alive] == cell[alive + step]]
        if not len(alive):
            break
        hit = alive[np.bitwise_count((fp[alive] ^ fp[alive + step]).view(np.uint64)) <= bits]
        left.append(rep[hit])
        right.append(rep[hit + step])
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _stars(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as keep the same nodes connected."""
    if not len(left):
        return left, right
    nodes, roots = smallest_reachable(left, right)
    other = nodes != roots
    return nodes[other], roots[other]


def _within_cells(bits: int):
    """Streams rows sorted by cell; emits links (hot = 0), and the rows of oversized cells (hot = 1)."""

    def out(a, b, c, hot) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"u": a, "v": b, "cell": c, "hot": np.full(len(a), hot, np.int32)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, hot_cell = np.zeros((3, 0), np.int64), None
        for batch in batches:
            rows = np.stack([batch[k].to_numpy(zero_copy_only=False) for k in ("cell", "rep", "fp")])
            if hot_cell is not None:
                same = rows[0] == hot_cell
                if same.any():
                    yield out(rows[1, same], rows[2, same], rows[0, same], 1)
                    rows = rows[:, ~same]
                if rows.shape[1]:
                    hot_cell = None
            rows = np.concatenate([carry, rows], axis=1)
            if not rows.shape[1]:
                continue
            last = np.searchsorted(rows[0], rows[0, -1])
            carry, done = rows[:, last:], rows[:, :last]
            if carry.shape[1] > BLOCK:
                hot_cell = carry[0, 0]
                yield out(carry[1], carry[2], carry[0], 1)
                carry = carry[:, :0]
            yield from finish(done)
        yield from finish(carry)

    def finish(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not rows.shape[1]:
            return
        first = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
        size = np.repeat(np.diff(np.r_[first, rows.shape[1]]), np.diff(np.r_[first, rows.shape[1]]))
        big = size > BLOCK
        if big.any():
            yield out(rows[1, big], rows[2, big], rows[0, big], 1)
        kept = rows[:, (size > 1) & ~big]
        a, b = _stars(*_near(*kept, bits))
        if len(a):
            yield out(a, b, np.zeros(len(a), np.int64), 0)

    return run


def _hot_cells(hot: DataFrame, bits: int) -> DataFrame:
    """Links inside cells of any size: members are dealt into blocks, and pairs of blocks compared.

    A task holds two blocks; only links that keep them connected leave it.
    """
    sizes = hot.groupBy("cell").count().withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    dealt = hot.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("v", "u"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    pairs = pairs.select("cell", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), F.col("u").alias("rep"), F.col("v").alias("fp"))

    def work(rows: pa.Table) -> pa.Table:
        rep, fp = (rows[k].to_numpy() for k in ("rep", "fp"))
        a, b = _stars(*_near(np.zeros(len(rep), np.int64), rep, fp, bits))
        return pa.table({"u": a, "v": b})

    return pairs.groupBy("cell", "b1", "b2").applyInArrow(work, "u long, v long")


def fingerprint_links(points: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (u, v) that connect all points (rep, fp) whose fingerprints differ in at most ``bits`` bits.

    Every such pair shares a grid cell and is compared exactly there. What leaves a cell is a
    set of stars over its links, never all its pairs.
    """
    if bits > BITS:
        raise ValueError(f"the grid of this operator holds for up to {BITS} bits")
    spark = points.sparkSession
    dealt = grid_rows(points).repartition(max(partitions(spark), 1), "cell").sortWithinPartitions("cell")
    found = materialise(dealt.mapInArrow(_within_cells(bits), "u long, v long, cell long, hot int"))
    links = found.where("hot = 0").select("u", "v")
    if found.where("hot = 1").limit(1).count():
        links = links.union(_hot_cells(found.where("hot = 1").select("cell", "u", "v"), bits))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Words are runs of characters other than white space (ASCII), A-Z lower-cased; shingles have
    three words, fewer words make one shingle, none give fingerprint zero. Null text counts as
    empty. Documents whose fingerprints differ in at most ``bits`` bits are linked; component_id
    is the smallest doc_id that links reach. Rows with the same doc_id are the same document, so
    they connect their texts. A null doc_id has a fingerprint and links nothing: its component_id
    is that of its fingerprint, null if no other document has it. Other columns are ignored.
    """
    prints = materialise(fingerprints(docs, id_col, text_col))
    points = materialise(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")))
    several = prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a != b").select("doc_id")
    shared = prints.join(several, "doc_id").join(points, "fp").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    roots = components(fingerprint_links(points, bits).union(shared))
    labelled = points.join(roots, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("root", "rep").alias("component_id"))
    return prints.join(labelled, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
