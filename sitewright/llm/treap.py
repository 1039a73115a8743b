"""Ranked lexical search over a term-document grid held as a K2-treap.

Terms are rows and documents columns of a grid whose points carry impacts. A quadtree over the grid
keeps only cells that hold points: for each its highest impact, which of its four quarters hold
points, and where the first of them lies, so a quarter is reached by counting bits. An item's terms
descend together: a range of documents at some level carries, for each term that still has a point
in it, the cell on that term's row path, and the weighted maxima of these cells bound the score
of every document in the range. Ranges are opened best bound first until none can reach the item's
k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import stored, utf8

#: Documents of a grid, items that descend together, ranges an item opens at a time.
COLUMNS, TOGETHER, OPENED = 4096, 64, 24
#: Distinct terms of the items of one pass; more items take more passes.
TERMS = 200_000
#: Bytes that end a term: ASCII but letters and digits. A-Z become a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)
K_SCALE, TF_SCALE, LENGTH_SCALE = 1_000_000_000, 1000, 8


def terms_of(text: str | None) -> list[bytes]:
    return utf8(text).translate(FOLD).split()


def _spread_bits(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2^31 at every second place."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """Cells of all levels in a row, the root first, each level in Morton order."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> None:
        self.levels = max(1, int(max(rows.max(initial=0), columns.max(initial=0))).bit_length())
        codes = (_spread_bits(rows) << np.uint64(1)) | _spread_bits(columns)
        order = np.argsort(codes)
        codes, best = codes[order], impacts[order]
        marks, tops = [np.zeros(len(codes), np.uint8)], [best]
        for _ in range(self.levels):
            own = codes >> np.uint64(2)
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            quarter = np.uint8(1) << (codes & np.uint64(3)).astype(np.uint8)
            marks.append(np.add.reduceat(quarter, first).astype(np.uint8) if len(first) else np.zeros(0, np.uint8))
            best = np.maximum.reduceat(best, first) if len(first) else best[:0]
            tops.append(best)
            codes = own[first]
        self.mark, self.top = np.concatenate(marks[::-1]), np.concatenate(tops[::-1])
        held = BITS[self.mark]
        self.first = 1 + np.cumsum(held) - held

    def quarter(self, cells: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The given quarter of each cell, -1 where it has no point."""
        mark = self.mark[cells].astype(np.int64)
        bit = np.int64(1) << which
        return np.where(mark & bit, self.first[cells] + BITS[mark & (bit - 1)], -1)


def best_first(treap: Treap, items: list[tuple[np.ndarray, np.ndarray]], floors: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(columns, scores) of each item's candidates: all documents with a score above 0 that belong to its k best, and some more.

    ``items`` are rows and weights above 0. Documents below an item's floor, the k-th score it
    has elsewhere, are left out.
    """
    floors = floors.astype(np.int64)
    sizes = np.array([len(r) for r, _ in items], np.int64)
    row, weight = (np.concatenate([x[i] for x in items]).astype(np.int64) for i in (0, 1))
    # the frontier: ranges of documents, and in the pool the terms and cells that each still has
    item = np.flatnonzero(sizes)
    pool_term, pool_cell = [np.arange(len(row))], [np.zeros(len(row), np.int64)]
    start, size = (np.cumsum(sizes) - sizes)[item], sizes[item]
    level, column = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64)
    bound = np.full(len(item), np.iinfo(np.int64).max)
    term, cell = pool_term[0], pool_cell[0]
    done: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] * 3]
    scores = np.zeros((len(items), 0), np.int64)
    if not len(treap.top):
        item = item[:0]
    while len(item):
        order = np.lexsort((-bound, item))
        rank = np.arange(len(order))
        new = np.flatnonzero(np.r_[True, item[order][1:] != item[order][:-1]])
        rank -= np.repeat(new, np.diff(np.r_[new, len(order)]))
        chosen, rest = order[rank < OPENED], order[rank >= OPENED]
        # both halves of each chosen range, term by term
        owner = np.repeat(np.arange(len(chosen)), size[chosen])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size[chosen]) - size[chosen], size[chosen]) + start[chosen][owner]
        t, c = term[at], cell[at]
        low = (row[t] >> (treap.levels - 1 - level[chosen][owner])) & 1
        halves = []
        for side in (0, 1):
            child = treap.quarter(c, 2 * low + side)
            there = np.flatnonzero(child >= 0)
            of, ct, cc = owner[there], t[there], child[there]
            total = np.bincount(of, minlength=len(chosen))
            sums = np.zeros(len(chosen), np.int64)
            np.add.at(sums, of, weight[ct] * treap.top[cc])
            halves.append((side, of, ct, cc, total, sums))
        item_c, level_c, column_c = item[chosen], level[chosen] + 1, column[chosen] * 2
        parts = []
        for side, of, ct, cc, total, sums in halves:
            alive = (total > 0) & (sums > 0) & (sums >= floors[item_c])
            leaf = alive & (level_c == treap.levels)
            done.append([item_c[leaf], column_c[leaf] + side, sums[leaf]])
            inner = alive & ~leaf
            stays = inner[of]
            parts.append((item_c[inner], level_c[inner], column_c[inner] + side, sums[inner], total[inner], ct[stays], cc[stays]))
        # the k-th best score so far raises the floor
        if any(len(d[0]) for d in done[-2:]):
            new_item, new_score = (np.concatenate([d[i] for d in done[-2:]]) for i in (0, 2))
            width = int(np.bincount(new_item).max())
            table = np.zeros((len(items), width), np.int64)
            by = np.argsort(new_item, kind="stable")
            first = np.searchsorted(new_item[by], np.arange(len(items)))
            table[new_item[by], np.arange(len(by)) - first[new_item[by]]] = new_score[by]
            scores = np.sort(np.concatenate([scores, table], axis=1), axis=1)[:, -k:]
            if scores.shape[1] == k:
                floors = np.maximum(floors, scores[:, 0])
        kept = rest[bound[rest] >= floors[item[rest]]]
        owner = np.repeat(np.arange(len(kept)), size[kept])
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size[kept]) - size[kept], size[kept]) + start[kept][owner]
        term, cell = (np.concatenate([old[at], *(p[i] for p in parts)]) for old, i in ((term, 5), (cell, 6)))
        item, level, column, bound, size = (np.concatenate([old[kept], *(p[i] for p in parts)]) for i, old in enumerate((item, level, column, bound, size)))
        start = np.cumsum(size) - size
    found_item, found_column, found_score = (np.concatenate([d[i] for d in done]) for i in range(3))
    by = np.argsort(found_item, kind="stable")
    cuts = np.searchsorted(found_item[by], np.arange(1, len(items)))
    return list(zip(np.split(found_column[by], cuts), np.split(found_score[by], cuts)))


POSTINGS = "doc_id long, n long, terms array<int>, times array<int>"


def postings_of(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, terms, times): number of terms of each document, and which of the vocabulary it has how often; documents without a term are left out."""
    number = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = number.value
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                ids, sizes, terms, times = [], [], [], []
                for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"]):
                    words = terms_of(text.as_py())
                    if words:
                        known = np.fromiter((of.get(w, -1) for w in words), np.int64, len(words))
                        t, f = np.unique(known[known >= 0], return_counts=True)
                        ids.append(doc_id)
                        sizes.append(len(words))
                        terms.append(t)
                        times.append(f)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()), "terms": pa.array(terms, pa.list_(pa.int32())), "times": pa.array(times, pa.list_(pa.int32()))})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, POSTINGS)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def searched(postings: DataFrame, item_ids: list[int | None], items: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item_id long, doc_id long, score long): each task's k best documents of each item, by grids of COLUMNS documents.

    A task keeps the k best of its grids so far, and their k-th score prunes the next grid.
    """
    shared = postings.sparkSession.sparkContext.broadcast((item_ids, items))

    def grid(part: pa.RecordBatch, top: list[np.ndarray], asked: list[tuple[np.ndarray, np.ndarray]]) -> None:
        n = part["n"].to_numpy()
        held, term = _lists(part["terms"])
        _, tf = _lists(part["times"])
        column = np.repeat(np.arange(len(n)), held)
        length = 10 + (90 * n * n_docs) // max(1, n_terms)
        impact = K_SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * length[column])
        here, row = np.unique(term, return_inverse=True)
        treap = Treap(row, column, impact)
        ids = part["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        nameless = part["doc_id"].is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        for low in range(0, len(asked), TOGETHER):
            group = []
            for terms, weights in asked[low : low + TOGETHER]:
                place = np.searchsorted(here, terms)
                known = place < len(here)
                known[known] = here[place[known]] == terms[known]
                group.append((place[known], weights[known]))
            floors = np.array([t[0, -1] if t.shape[1] == k else 0 for t in top[low : low + TOGETHER]])
            for i, (columns, scores) in enumerate(best_first(treap, group, floors, k), low):
                if len(columns):
                    both = np.concatenate([top[i], np.stack([scores, nameless[columns], ids[columns]])], axis=1)
                    top[i] = both[:, np.lexsort((both[2], both[1], -both[0]))[:k]]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked = shared.value
        top = [np.zeros((3, 0), np.int64) for _ in asked]
        for batch in batches:
            for low in range(0, batch.num_rows, COLUMNS):
                grid(batch.slice(low, COLUMNS), top, asked)
        item = [i for i, t in zip(names, top) for _ in range(t.shape[1])]
        score, nameless, ids = np.concatenate([np.zeros((3, 0), np.int64), *top], axis=1)
        yield pa.RecordBatch.from_pydict({"item_id": pa.array(item, pa.int64()), "doc_id": pa.array(ids, mask=nameless > 0), "score": pa.array(score)})

    return postings.mapInArrow(work, "item_id long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", terms_a_pass: int = TERMS) -> DataFrame:
    """The ``k`` best documents of each item by summed term impacts: item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Only
    scores above 0 are returned, equal ones by ascending doc_id; items without such a document
    have no row. Items with the same id (null is an id of its own) are one item with the terms of
    all. Every row of ``docs`` with a term is a document, repeated rows too; those without an id
    rank after others of the same score. Null and empty texts hold no term. Other columns are
    ignored, empty tables give no rows.

    Documents are read once for each ``terms_a_pass`` distinct terms of the items, reduced to
    the postings of those terms and stored; grids are built and searched where the postings lie,
    and only k rows an item and task are shuffled. Words of items travel to the tasks, at most
    those of one pass.
    """
    spark = docs.sparkSession

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, t) for i, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()) for t in set(terms_of(text))]
            yield pa.RecordBatch.from_pydict({"item_id": pa.array([i for i, _ in rows], pa.int64()), "term": pa.array([t for _, t in rows], pa.binary())})

    asked = stored(items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).mapInArrow(split, "item_id long, term binary").distinct())
    passes = max(1, -(-asked.count() // terms_a_pass))
    asked = asked.withColumn("pass", F.pmod(F.xxhash64("item_id"), F.lit(passes)))
    parts = []
    for number in range(passes):
        rows = asked.where(F.col("pass") == number).drop("pass").toArrow().to_pydict()
        vocabulary = sorted(set(rows["term"]))
        if not vocabulary:
            continue
        place = {t: i for i, t in enumerate(vocabulary)}
        terms: dict[int | None, list[int]] = {}
        for i, t in zip(rows["item_id"], rows["term"]):
            terms.setdefault(i, []).append(place[t])
        postings = stored(postings_of(docs, vocabulary, id_col, text_col))
        n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = postings.select(F.explode_outer("terms").alias("term")).where("term is not null").groupBy("term").agg(F.count("*").alias("df"))
        weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
        weights = np.zeros(len(vocabulary), np.int64)
        for r in df.select("term", weight.cast("long").alias("w")).collect():
            weights[r.term] = r.w
        ids = list(terms)
        wanted = [np.sort(np.array(terms[i], np.int64)) for i in ids]
        parts.append(searched(postings, ids, [(t[weights[t] > 0], weights[t][weights[t] > 0]) for t in wanted], n_docs, n_terms, k))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    order = [F.desc("score"), F.col("doc_id").isNull(), "doc_id"]
    few = Window.partitionBy("item_id", "part").orderBy(*order)
    best = out.withColumn("part", F.spark_partition_id() % 64).withColumn("rank", F.row_number().over(few)).where(F.col("rank") <= k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
