"""Toxicity from class-conditional Kneser-Ney models of how words are spelt.

Words are read byte by byte, each byte in the context of all bytes before it in its word. Two models,
of toxic and of ordinary texts, count these contexts in their own class; what a class's discounts
leave over goes to counts shared by both, which back off to the last three bytes and then to all
bytes alike. So a rare form of a word is judged by the beginning it has in common with others,
and where neither class knows more, both give the same chance and the form says nothing.

The beginnings of words form a tree, which lies in ranges of the sorted words, one range a task. Blocks
of documents ask the ranges once for each distinct word; the tree never meets in one place. Words count
whole, however long; what is kept of them is a few numbers a byte.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewright.llm.common import map_tables, stored, utf8
from sitewright.llm.exchange import ANSWERED, answers, as_table, blocks_of, join_blocks, replies_to, shards_of, squeezed, unpacked, unsqueezed
from sitewright.llm.treap import FOLD
from sitewright.session import BYTES_TO_BROADCAST

BUCKETS = 4096
#: Bytes of a word whose beginnings are rows of their own in the model; longer ones lie in runs.
WIDTH = 16
#: Weight of the shared counts besides what the discounts leave, in occurrences.
SHARED = 10.0
#: Share of words in a toxic text that come from the toxic model; the others are ordinary.
MIXED = 0.02
BINS = 4096
#: Of so many texts one helps to place the ends of the ranges.
CUT_SHARE = 64
END = b"\x00"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and characters beyond ASCII."""
    return utf8(text).translate(FOLD).split()


def fold(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def sample_ids(texts: DataFrame, marks: DataFrame, sample: int) -> DataFrame:
    """(doc_id, toxic) of ``marks`` (doc_id, toxic) drawn by hash until the texts of a class reach ``sample`` bytes.

    Each text counts 64 bytes more than it has, so the number of ids is bounded too. Hash
    buckets that alone exceed a sixteenth of the sample are not drawn from.
    """
    sized = texts.select("doc_id", (F.octet_length(F.coalesce("text", F.lit(""))) + 64).alias("size")).join(marks, "doc_id")
    bucket = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(BUCKETS))
    full = sized.groupBy("toxic", bucket.alias("bucket")).agg(F.sum("size").alias("size")).where(F.col("size") <= sample // 16)
    so_far = F.sum("size").over(Window.partitionBy("toxic").orderBy("bucket"))  # at most BUCKETS rows a class
    drawn = full.withColumn("so_far", so_far).where(F.col("so_far") <= sample).select("toxic", "bucket")
    return sized.withColumn("bucket", bucket).join(F.broadcast(drawn), ["toxic", "bucket"]).select("doc_id", "toxic").distinct()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, t, o): occurrences of each whole word in toxic and in ordinary texts (doc_id, text, toxic)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, text in zip(batch["toxic"].to_pylist(), batch["text"]):
                counts[toxic].update(words_of(text.as_py()))
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "t": pa.array([counts[1][w] for w in words], pa.int64()), "o": pa.array([counts[0][w] for w in words], pa.int64())})

    parts = texts.select("text", "toxic").mapInArrow(work, "word binary, t long, o long")
    return parts.groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def spelt(word: bytes, width: int | None = None) -> bytes:
    """The bytes of ``word`` that are judged, ended by a zero byte; those after ``width`` bytes, and then the end, are left out."""
    return word + END if width is None or len(word) < width else word[:width]


def shared_bytes(a: bytes, b: bytes) -> int:
    """How many first bytes two words share."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    low = 0
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


def cuts_of(words: DataFrame, n: int) -> list[bytes]:
    """Ends of at most ``n`` ranges of the sorted words of about equal size, fewer for few words; they only say which task holds a word.

    A cut is no longer than it takes to part the words beside it.
    """
    placed = words.select("word").repartitionByRange(n, "word").withColumn("part", F.spark_partition_id())
    parts = sorted((bytes(r["first"]), bytes(r["last"])) for r in placed.groupBy("part").agg(F.min("word").alias("first"), F.max("word").alias("last")).collect())
    return [first[: shared_bytes(last, first) + 1] for (_, last), (first, _) in zip(parts, parts[1:])]


def gram_of(node: bytes) -> bytes:
    """The last byte of ``node`` after the last three before it; after fewer they are marked by a blank."""
    return b" " + node if len(node) < 4 else node[-4:]


class Tree:
    """All beginnings of the words (word, t, o) and of ``more``, which count nothing: nodes in the order of the sorted words.

    A node is the first ``depth`` bytes of the word ``of``, ``up`` the place of that a byte shorter (-1 for the empty
    one) and ``counts`` its t and o. The nodes that a word adds stand in a row from ``first``, the first of them
    after ``start`` bytes that it shares with earlier ones; so names are made only where they are asked for.
    """

    def __init__(self, rows: pa.Table, more: Iterable[bytes] = ()) -> None:
        own = list(zip(rows["word"].to_pylist(), rows["t"].to_pylist(), rows["o"].to_pylist())) + [(w, 0, 0) for w in {b"", *more}]
        own.sort()
        self.words = [w for w, _, _ in own]
        start, first, at, stack, last, size = [], [], [], [], b"", 0
        for j, word in enumerate(self.words):
            same = shared_bytes(last, word) if j else -1
            while j and start[stack[-1]] >= same:
                stack.pop()
            at.append((stack[-1], first[stack[-1]] + same - start[stack[-1]] - 1) if j else (-1, -1))
            start.append(same)
            first.append(size)
            size += len(word) - same
            if len(word) > same:
                stack.append(j)
            last = word
        totals = [[t, o] for _, t, o in own]
        for j in range(len(own) - 1, 0, -1):
            (t, o), above = totals[j], totals[at[j][0]]
            above[0] += t
            above[1] += o
        self.start, self.first, above = np.array(start), np.array(first), np.array([x for _, x in at])
        sizes = np.fromiter(map(len, self.words), np.int64, len(own))
        added = sizes - self.start
        self.of = np.repeat(np.arange(len(own)), added)
        self.depth = np.arange(size) - np.repeat(self.first - self.start - 1, added)
        self.up = np.arange(-1, size - 1)
        new = np.flatnonzero(added)
        self.up[self.first[new]] = above[new]
        counts, ends = np.zeros((size, 2), np.int64), np.where(added > 0, self.first + added - 1, above)
        np.add.at(counts, ends, np.array([x[1:] for x in own], np.int64))
        np.add.at(counts, above[new[1:]], np.array(totals, np.int64)[new[1:]])
        so_far = counts.cumsum(0)
        self.counts = so_far[(self.first + added - 1)[self.of]] - so_far + counts
        self.starts = np.cumsum(sizes) - sizes

    def along(self, words: Iterable[bytes]) -> dict[bytes, int]:
        """Places of all beginnings of ``words``, which are among those of the tree."""
        found: dict[bytes, int] = {}
        for word in words:
            j = bisect_left(self.words, word)
            i = int(self.first[j] + len(word) - self.start[j] - 1)
            for d in range(len(word), -1, -1):
                found[word[:d]] = i
                i = int(self.up[i])
        return found

    def grams(self, nodes: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Distinct ``gram_of`` of ``nodes`` and the place of each among them."""
        letters = np.frombuffer(b"".join(self.words), np.uint8)
        ends, depth, code = self.starts[self.of[nodes]] + self.depth[nodes], self.depth[nodes], np.zeros(len(nodes), np.int64)
        for back in range(4):
            some = depth > back
            code[some] |= letters[ends[some] - 1 - back].astype(np.int64) << 8 * back
        few = depth < 4
        code[few] |= np.int64(ord(" ")) << 8 * depth[few]
        codes, place = np.unique(code, return_inverse=True)
        return [c.to_bytes((c.bit_length() + 7) // 8, "big") for c in codes.tolist()], place


def kinds_under(up: np.ndarray, counts: np.ndarray, children: np.ndarray) -> np.ndarray:
    """How many of the ``children`` each node has: seen in toxic, in ordinary, in any texts."""
    at = up[children]
    return np.stack([np.bincount(at[c > 0], minlength=len(up)) for c in (counts[children, 0], counts[children, 1], counts[children].sum(1))], axis=1)


GRAM, EDGE, KINDS, FEW = range(4)
SUMMARY = "shard int, sort int, key binary, a long, b long, c long"
MODEL = "shard int, node binary, step double, off double, steps binary, offs binary"


def spelling_model(words: DataFrame, cuts: Sequence[bytes] | None = None, shared: float = SHARED, width: int | None = WIDTH) -> DataFrame:
    """(shard, node, step, off): for each beginning of a word the log ratio of the classes' chances of its last byte, and that of a byte not seen after it.

    Beginnings of more than WIDTH bytes come a word at a time: its last ones that no earlier word has, as
    ``steps`` and ``offs``, under the longest of them; ``step`` and ``off`` are null then.

    A byte after a context has the chance (max(c - D, 0) + (D k + S) p) / (n + S): c, n and k are
    the class's count of it, of the context, and of the different bytes after the context, D = n1
    / (n1 + 2 n2) is the class's discount, S is ``shared``, and p the same for both classes
    together with S = 0, whose own p counts the different beginnings that end in the last three
    bytes. Bytes never seen after a context leave the ratio of what the classes pass on. Words
    are ended by a zero byte. With a ``width`` bytes after it have chances of 1, and so has the end; None counts words whole.

    Each range between ``cuts`` of the sorted words (``shard``) is a task. Only beginnings of cuts have
    words in several ranges; their counts, one for each byte of a cut, pass through the driver, and both
    ranges beside a cut get them.
    """
    cuts = cuts_of(words, shards_of(words.sparkSession)) if cuts is None else list(cuts)

    def place(rows: pa.Table) -> pa.Table:
        found = [spelt(w, width) for w in rows["word"].to_pylist()]
        return pa.table({"shard": pa.array([bisect_right(cuts, w) for w in found], pa.int32()), "word": pa.array(found, pa.binary()), "t": rows["t"], "o": rows["o"]})

    def beside(shard: int) -> Sequence[bytes]:
        """Cuts whose beginnings the words of a range may share with those of others."""
        return cuts[max(shard - 1, 0) : shard + 1]

    def summary(rows: pa.Table) -> pa.Table:
        shard = rows["shard"][0].as_py()
        tree = Tree(rows, beside(shard))
        edges = tree.along([b"", *beside(shard)])
        inner = np.delete(np.arange(len(tree.of)), list(edges.values()))
        kinds = kinds_under(tree.up, tree.counts, inner)
        grams, place = tree.grams(inner)
        out = [(shard, GRAM, k, n, 0, 0) for k, n in zip(grams, np.bincount(place, minlength=len(grams)).tolist())]
        for node, i in edges.items():
            if not node or tree.counts[i].any():
                out += [(shard, EDGE, node, *tree.counts[i].tolist(), 0), (shard, KINDS, node, *kinds[i].tolist())]
        both = np.column_stack([tree.counts[inner], tree.counts[inner].sum(1)])
        out += [(shard, FEW, bytes([n]), *(both == n).sum(0).tolist()) for n in (1, 2)]
        return as_table(out, SUMMARY)

    bare = words.sparkSession.range(len(cuts) + 1).select(F.col("id").cast("int").alias("shard"), F.lit(b"").alias("word"), F.lit(0).alias("t"), F.lit(0).alias("o"))  # a range without words passes on what begins its cuts
    ranged = stored(map_tables(words.select("word", "t", "o"), place, "shard int, word binary, t long, o long").union(bare))
    summed = stored(ranged.groupBy("shard").applyInArrow(summary, SUMMARY))
    edge, kinds, few = {}, defaultdict(lambda: np.zeros(3, np.int64)), np.zeros((3, 3), np.int64)
    for r in summed.where(F.col("sort") != GRAM).groupBy("sort", "key").agg(*[F.sum(x).alias(x) for x in "abc"]).collect():
        key, sums = bytes(r["key"]), [r["a"], r["b"], r["c"]]
        if r["sort"] == EDGE:
            edge[key] = sums[:2]
        elif r["sort"] == KINDS:
            kinds[key] += sums
        else:
            few[key[0]] = sums
    for node, (t, o) in edge.items():
        if node:
            kinds[node[:-1]] += [t > 0, o > 0, t + o > 0]
            for n in (1, 2):
                few[n] += [t == n, o == n, t + o == n]
    kinds, d = dict(kinds), [int(one) / (int(one) + 2 * int(two)) if one and two else 0.5 for one, two in zip(few[1], few[2])]

    grams = summed.where(F.col("sort") == GRAM).select("shard", F.col("key").alias("gram"), F.col("a").alias("n"))
    of_edges = words.sparkSession.createDataFrame([(-1, k, n) for k, n in Counter(gram_of(x) for x in edge if x).items()], "shard int, gram binary, n long")
    grams = grams.union(of_edges).withColumn("tail", F.expr("substring(gram, 1, octet_length(gram) - 1)")).repartition("tail")
    own, by_tail = Window.partitionBy("tail", "gram"), Window.partitionBy("tail")  # a row a shard; 257 grams at most
    grams = grams.withColumn("c", F.sum("n").over(own)).withColumn("first", F.row_number().over(own.orderBy("shard")) == 1)
    lower = stored(grams.select("shard", "gram", "c", "first", F.sum(F.col("first").cast("long")).over(by_tail).alias("k"), F.sum(F.when(F.col("first"), F.col("c"))).over(by_tail).alias("total")))
    one, two = lower.where("first").agg(F.sum((F.col("c") == 1).cast("long")), F.sum((F.col("c") == 2).cast("long"))).first()
    d_low = one / (one + 2 * two) if one and two else 0.5
    lower = lower.select("shard", "gram", ((F.greatest(F.col("c") - d_low, F.lit(0.0)) + d_low * F.col("k") / 257) / F.col("total")).alias("p"))
    edge_p = {bytes(r["gram"]): r["p"] for r in lower.where("shard = -1").collect()}

    def model(rows: pa.Table, chances: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return as_table([], MODEL)
        shard = rows["shard"][0].as_py()
        known = [max((c[:i] for i in range(len(c) + 1) if c[:i] in edge), key=len) for c in beside(shard)]
        tree = Tree(rows, known)
        at = tree.along([b"", *known])
        up, counts = tree.up, tree.counts
        inner = np.delete(np.arange(len(tree.of)), list(at.values()))
        under, low = kinds_under(up, counts, inner), np.ones(len(tree.of))
        p = dict(zip(chances["gram"].to_pylist(), chances["p"].to_pylist()))
        grams, place = tree.grams(inner)
        low[inner] = np.array([p[g] for g in grams])[place]
        for node, i in at.items():
            counts[i], under[i], low[i] = edge[node], kinds[node], edge_p[gram_of(node)] if node else 1.0
        c, n, k = np.column_stack([counts, counts.sum(1)]), counts[up], under[up]
        n = np.column_stack([n, n.sum(1)])
        p = (np.maximum(c[:, 2] - d[2], 0.0) + d[2] * k[:, 2] * low) / n[:, 2]
        of = [np.maximum(c[:, x] - d[x], 0.0) / (n[:, x] + shared) + (d[x] * k[:, x] + shared) / (n[:, x] + shared) * p for x in (0, 1)]
        passed = [(d[x] * under[:, x] + shared) / (counts[:, x] + shared) for x in (0, 1)]
        step, off = np.log(of[0] / of[1]), np.where(under[:, 2] > 0, np.log(passed[0] / passed[1]), 0.0)
        step[at[b""]] = 0.0
        single = np.flatnonzero(tree.depth <= WIDTH)
        runs = [(len(w), slice(int(a) + max(0, WIDTH - int(s)), int(a) + len(w) - int(s)), w) for w, s, a in zip(tree.words, tree.start, tree.first) if len(w) > max(WIDTH, s)]
        names = [tree.words[j][:i] for j, i in zip(tree.of[single].tolist(), tree.depth[single].tolist())]
        short = pa.table({"node": pa.array(names, pa.binary()), "step": step[single], "off": off[single]})
        long = pa.table({"node": pa.array([w for _, _, w in runs], pa.binary()), "steps": pa.array([step[r].tobytes() for _, r, _ in runs], pa.binary()), "offs": pa.array([off[r].tobytes() for _, r, _ in runs], pa.binary())})
        both = pa.concat_tables([short, long], promote_options="default")
        return both.add_column(0, "shard", pa.array(np.full(len(both), shard, np.int32)))

    return ranged.groupBy("shard").cogroup(lower.where("shard >= 0").groupBy("shard")).applyInArrow(model, MODEL)


class Spelling:
    """Part of the model as a mapping from beginnings of words, for use in tasks."""

    def __init__(self, table: pa.Table, width: int | None = WIDTH) -> None:
        self.width = width
        long = pc.is_valid(table["steps"])
        short = table.filter(pc.invert(long))
        self.at = dict(zip(short["node"].to_pylist(), zip(short["step"].to_pylist(), short["off"].to_pylist())))
        runs = table.filter(long).sort_by("node")
        self.words, self.runs, stack = runs["node"].to_pylist(), [], []
        for j, (word, steps, offs) in enumerate(zip(self.words, runs["steps"].to_pylist(), runs["offs"].to_pylist())):
            start = len(word) - len(steps) // 8
            while stack and self.runs[stack[-1]][0] >= start:
                stack.pop()
            above = stack[-1] if stack else -1
            self.runs.append((start, above, np.cumsum(np.frombuffer(steps)) + (self.sum_at(above, start) if stack else 0.0), np.frombuffer(offs)))
            stack.append(j)

    def sum_at(self, run: int, size: int) -> float:
        """Sum of the steps after WIDTH bytes, up to ``size`` bytes of a run."""
        start, _, sums, _ = self.runs[run]
        return float(sums[size - start - 1])

    def ratio(self, word: bytes) -> float:
        """log of the toxic over the ordinary chance of ``word``."""
        return self.ratio_of(spelt(word, self.width))

    def ratio_of(self, word: bytes) -> float:
        """``ratio`` of a word that is ended already."""
        total, before = 0.0, self.at.get(b"", (0.0, 0.0))
        for i in range(1, min(len(word), WIDTH) + 1):
            found = self.at.get(word[:i])
            if found is None:
                return total + before[1]
            total, before = total + found[0], found
        if len(word) <= WIDTH:
            return total
        near = bisect_left(self.words, word)  # the longest known beginning is one of a word beside it
        size, run = max(((shared_bytes(self.words[j], word), j) for j in (near - 1, near) if 0 <= j < len(self.words)), default=(0, 0))
        if size <= WIDTH:
            return total + before[1]
        while self.runs[run][0] >= size:
            run = self.runs[run][1]
        start, _, _, offs = self.runs[run]
        return total + self.sum_at(run, size) + (float(offs[size - start - 1]) if size < len(word) else 0.0)


ASKED_WORDS = "shard int, block int, words binary"
SCORED = "doc_id long, n_words long, evidence double"


def scores_of(texts: DataFrame, model: DataFrame | pa.Table, cuts: Sequence[bytes] = (), mixed: float = MIXED, width: int | None = WIDTH) -> DataFrame:
    """(doc_id, n_words, evidence) of every row of (doc_id, text).

    Evidence is the log-likelihood of a toxic text, whose words come from the toxic model with
    chance ``mixed`` and else from the ordinary one, less that of an ordinary text, over the
    square root of the number of words. ``model`` is that of ``spelling_model`` with the same ``cuts`` and ``width``;
    a block of documents sends each range its distinct words and gets their log ratios back.
    """
    if isinstance(model, pa.Table):
        model = texts.sparkSession.createDataFrame(model.select(["node", "step", "off", "steps", "offs"])).select(F.lit(0).alias("shard"), "*")
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    blocks = blocks_of(texts, {c: F.col(c) for c in ("doc_id", "text")}, [spread])

    def ask(block: int, rows: pa.Table) -> list[tuple]:
        own = set()
        for text in rows["text"]:
            own.update(words_of(text.as_py()))
        words = sorted({spelt(w, width) for w in own})
        ends = [*(bisect_left(words, c) for c in cuts), len(words)]
        return [(s, block, squeezed(b" ".join(words[a:b]))) for s, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]

    def reply(rows: pa.Table, part: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return as_table([], ANSWERED)
        spelling, known = Spelling(part, width), {}

        def ratios() -> Iterator[tuple[int, int, np.ndarray]]:
            for block, packed in zip(rows["block"].to_pylist(), rows["words"]):
                words = unsqueezed(packed.as_py()).split(b" ")
                yield block, 0, np.fromiter((known[w] if w in known else known.setdefault(w, spelling.ratio_of(w)) for w in words), np.float64, len(words))

        return replies_to(rows["shard"][0].as_py(), ratios())

    def score(block: int, rows: pa.Table, replies: pa.Table) -> list[tuple]:
        code: dict[bytes, int] = defaultdict(count().__next__)
        codes = [np.fromiter(map(code.__getitem__, words), np.int64, len(words)) for words in (words_of(t.as_py()) for t in rows["text"])]
        place = {w: i for i, w in enumerate(sorted({spelt(w, width) for w in code}))}
        ratios = answers(replies, 0, np.float64)[np.fromiter((place[spelt(w, width)] for w in code), np.int64, len(code))]
        values = np.log1p(mixed * np.expm1(np.minimum(ratios, 500.0)))
        return [(doc, len(c), float(values[c].sum()) / math.sqrt(max(1, len(c)))) for doc, c in zip(rows["doc_id"].to_pylist(), codes)]

    asked = blocks.groupBy("block").applyInArrow(lambda rows: as_table(ask(rows["block"][0].as_py(), unpacked(rows)), ASKED_WORDS), ASKED_WORDS)
    replies = asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(reply, ANSWERED)
    return join_blocks(blocks, replies, score, SCORED)


def calibration(judged: DataFrame) -> tuple[float, float]:
    """(threshold, slope) from (evidence, toxic): the threshold with the highest F1 of toxic texts, and the slope of a logistic curve through it."""
    place = F.floor((F.atan("evidence") / math.pi + 0.5) * BINS).cast("int")
    rows = judged.groupBy(place.alias("bin")).agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"), F.avg("evidence").alias("x")).orderBy("bin").collect()
    t, o, x = (np.array([r[k] for r in rows], np.float64) for k in ("t", "o", "x"))
    if not len(rows) or not t.sum() or not o.sum():
        return (float(x.max()) + 1 if len(rows) else 0.0), 1.0
    above_t, above_o = np.cumsum(t[::-1])[::-1], np.cumsum(o[::-1])[::-1]
    f1 = 2 * above_t / (above_t + above_o + t.sum())
    best = int(np.argmax(f1))
    threshold = (x[best] + x[best - 1]) / 2 if best else x[0]
    slope, z = 1.0, x - threshold
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * z, -60, 60)))
        gradient, curve = ((t - (t + o) * p) * z).sum() - 1e-3 * slope, ((t + o) * p * (1 - p) * z * z).sum() + 1e-3
        slope = float(np.clip(slope + gradient / curve, 0.1, 1000.0))
    return float(threshold), slope


def score(docs: DataFrame, labels: DataFrame, learn: Column | None = None, check: Column | None = None, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, n_words, score, predicted) of every document; a score of 0.5 or more predicts toxic.

    Labels (doc_id, toxic 0 or 1) are learnt from where ``learn``, a condition on doc_id, holds;
    the others are held out. Of those learnt from, rows under ``check`` set the threshold and
    the rest the spelling models, all of them unless ``sample`` bounds the bytes of text of each
    class (a label given twice counts as the higher one). All texts are learnt from and scored whole, and all bytes of their words. Nothing but the text is
    an input of a score.

    A row for each row of ``docs``: null and empty texts have no words and evidence 0; a null
    doc_id is held out if ``learn`` is null for it; repeated rows give a row each and count again
    in learning; other columns are ignored; an empty table gives none. Without learnt labels of
    both classes nothing is toxic: score 0.
    """
    learn = (fold() != 0) if learn is None else learn
    check = (fold() == 1) if check is None else check
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("toxic in (0, 1)")
    marks = stored(known.where(learn).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    held = F.coalesce(~learn, F.lit(True)).alias("held_out")
    learnt = marks.where(~check)
    learnt = learnt if sample is None else stored(sample_ids(texts, learnt, sample))
    learnt = F.broadcast(learnt) if sample is not None or 32 * learnt.count() <= BYTES_TO_BROADCAST else learnt  # texts then stay where they are
    words = stored(word_counts(texts.join(learnt, "doc_id")))
    classes = words.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("o"), F.lit(0))).first()
    if not all(classes):
        counted = scores_of(texts, as_table([], MODEL))
        return counted.select("doc_id", held, "n_words", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    drawn = texts.where(F.pmod(F.xxhash64("text"), F.lit(CUT_SHARE)) == 0).withColumn("toxic", F.lit(0))  # so that ranges suit the words of all texts
    cuts = cuts_of(words.select("word").union(word_counts(drawn).select("word")), shards_of(docs.sparkSession))
    scored = stored(scores_of(texts, spelling_model(words, cuts, width=None), cuts, width=None))
    threshold, slope = calibration(scored.join(marks.where(check), "doc_id").select("evidence", "toxic"))
    chance = 1 / (1 + F.exp(F.lit(-slope) * (F.col("evidence") - threshold)))
    return scored.select("doc_id", held, "n_words", chance.alias("score"), (chance >= 0.5).cast("int").alias("predicted"))
