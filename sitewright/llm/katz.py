"""Scoring with a Katz backoff bigram model whose tables are partitioned over shards.

Words are numbered by the shards of the vocabulary, frequent ones first. The table of pairs is
partitioned by the first word, so a context lies in one shard and its backoff weight is exact
there; frequent contexts are cut into slots by the second word, and their sums are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import partitions, utf8
from sitewright.llm.exchange import ASKED, answers, asked_by, at_keys, at_shards, blocks_of, cut_like, from_planes, join_blocks, mixed, of_kind, pack, parts_of, planes, questions

#: Counts above HIGH are not discounted.
HIGH = 5
#: Occurrences of a context in training for each slot of its pairs.
SLOT = 1 << 15
START = np.uint64((1 << 32) - 1)  # number of the context before the first word
WORD, COUNT, PLACE, WORD_STATS, PAIR, PAIR_COUNT, CONTEXT, SUMS, SLOT_SUMS, PAIR_STATS = range(10)
WIDE = np.uint64(32)


def discounts(numbers: np.ndarray) -> np.ndarray:
    """Good-Turing discounts of counts 1 to HIGH from the numbers of types with counts 1 to HIGH + 1.

    Where the numbers give no discount between 0 and 1, half an occurrence is taken off.
    """
    n, r = numbers.astype(float), np.arange(1, HIGH + 1)
    with np.errstate(all="ignore"):
        rest = (HIGH + 1) * n[HIGH] / n[0]
        found = ((r + 1) * n[1:] / n[:-1] / r - rest) / (1 - rest)
    return np.where((found > 0) & (found < 1), found, (r - 0.5) / r)


def discounted(counts: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts times their discounts."""
    return counts * np.concatenate([[1.0], off, [1.0]])[np.minimum(counts, HIGH + 1).astype(np.int64)]


class Unigrams:
    """Discounted word probabilities that add up to 1 with one unknown word."""

    def __init__(self, stats: np.ndarray) -> None:
        self.total, self.types = int(stats[0]), int(stats[1])
        self.off = discounts(stats[2:])
        r = np.arange(1, HIGH + 1)
        taken = float(((1 - self.off) * r * stats[2 : 2 + HIGH]).sum())
        self.unknown = taken / self.total if taken else 1 / (self.total + 1)
        self.scale = 1.0 if taken else self.total / (self.total + 1)

    def of(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.scale * discounted(counts, self.off) / max(1, self.total), self.unknown)

    def held(self, sums: np.ndarray) -> np.ndarray:
        """Probability of the words that follow each context, from their sums."""
        return self.scale * (sums[:, 0] + sums[:, 1:] @ (self.off * np.arange(1, HIGH + 1))) / max(1, self.total)


def _binned(counts: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """For each group the sum of the counts above HIGH, then how many counts are 1 to HIGH."""
    high = counts > HIGH
    out = [np.bincount(group[high], weights=counts[high], minlength=size)]
    return np.stack(out + [np.bincount(group[counts == r], minlength=size) for r in range(1, HIGH + 1)], axis=1).astype(np.uint64)


class Tokens:
    """Tokens of a block: words with A-Z lower-cased, and an end after each text."""

    def __init__(self, rows: pa.Table) -> None:
        parts = [[*utf8(t).lower().split(), b""] for t in rows["text"].to_pylist()]
        self.count = np.fromiter(map(len, parts), np.int64, len(parts))
        code, words = pd.factorize(np.array([*chain.from_iterable(parts), None], dtype=object)[:-1])
        digest = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        order = np.argsort(digest)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.keys, self.code = digest[order], place[code]
        self.row = np.repeat(np.arange(len(parts)), self.count)
        self.train = rows["train"].to_numpy(zero_copy_only=False)
        self.first = np.cumsum(self.count) - self.count

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.code[self.train[self.row]], minlength=len(self.keys)).astype(np.uint64)


class Pairs:
    """Distinct pairs of a block as numbers of both words, once the vocabulary has numbered them."""

    def __init__(self, tokens: Tokens, replies: pa.Table, shards: int) -> None:
        self.word_count = answers(replies, COUNT, np.uint64)
        self.number = answers(replies, PLACE, np.uint64)
        second = self.number[tokens.code]
        first = np.concatenate([[START], second[:-1]])[: len(second)]
        first[tokens.first] = START
        self.pairs, at, self.of_token = np.unique(first << WIDE | second, return_index=True, return_inverse=True)
        trained = tokens.train[tokens.row]
        self.train_count = np.bincount(self.of_token[trained], minlength=len(self.pairs)).astype(np.uint64)
        self.second_count = self.word_count[tokens.code[at]]
        self.contexts, self.context = np.unique(self.pairs >> WIDE, return_inverse=True)
        texts = np.uint64(stats_of(replies, WORD_STATS)[-1])
        first_count = np.full(len(self.contexts), texts, np.uint64)
        known = np.append(tokens.code[at - 1], 0)[: len(at)]
        own = self.pairs >> WIDE != START
        first_count[self.context[own]] = self.word_count[known[own]]
        self.slots = np.minimum(np.uint64(1) + first_count // np.uint64(SLOT), np.uint64(shards)).astype(np.int64)
        home = (mixed(self.contexts) % np.uint64(shards)).astype(np.int64)
        slot = (mixed(self.pairs & np.uint64(0xFFFFFFFF)) % self.slots[self.context].astype(np.uint64)).astype(np.int64)
        self.shard = (home[self.context] + slot) % shards
        self.order = np.lexsort((self.pairs, self.shard))
        cut = np.flatnonzero(self.slots > 1)
        ways = self.slots[cut]
        way = np.arange(ways.sum()) - np.repeat(np.cumsum(ways) - ways, ways)
        self.cut_context = np.repeat(cut, ways)
        self.cut_shard = (home[self.cut_context] + way) % shards
        self.cut_order = np.lexsort((self.contexts[self.cut_context], self.cut_shard))


def _by_shard(shard: np.ndarray, shards: int) -> list[tuple[int, slice]]:
    ends = np.searchsorted(shard, np.arange(shards), side="right")
    return [(s, slice(a, b)) for s, (a, b) in enumerate(zip(np.r_[0, ends[:-1]].tolist(), ends.tolist())) if b > a]


def stats_of(replies: pa.Table, kind: int) -> np.ndarray:
    """Sum of what all shards count over their part of a table."""
    return np.sum(parts_of(replies, kind, np.uint64) or [np.zeros(HIGH + 4, np.uint64)], axis=0)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, held_out: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probability of every text under a model of the texts where ``held_out`` is false.

    One row per row of ``docs``: doc_id, held_out, n_tokens (words and one end), n_known (tokens
    seen in training), train_tokens, base_score (add-one unigrams) and score.

    A pair seen in training has its discounted relative frequency; otherwise the context's backoff
    weight times the word's discounted probability, which for a word not seen is that of the one
    unknown word. Discounts are Good-Turing up to a count of 5. A backoff weight is what discounting
    frees in the context over what the words not seen after it have, so each context adds up to
    1; one with no count that is discounted frees one occurrence in c + 1. An unseen context passes on the word's probability.

    Null text counts as empty (only its end), null doc_id passes through, a null ``held_out`` is
    false, repeated rows count again, other columns are ignored, an empty table gives none. Without training text all tokens are the
    unknown word, of probability 1. Words are compared by 64-bit hashes; up to 2^32 - 1 different words.
    """
    n = partitions(docs.sparkSession)
    shards, n_blocks = max(1, 9 * n // 10), 2 * n
    columns = {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("string"), "train": ~F.coalesce(held_out, F.lit(False))}
    blocks = blocks_of(docs, columns, ["doc_id", "text"])

    def ask_words(block: int, rows: pa.Table) -> list[tuple]:
        tokens = Tokens(rows)
        rows_of = questions(block, WORD, tokens.keys, shards, tokens.word_counts())
        texts = int(tokens.train.sum())
        return rows_of + [(0, block, WORD_STATS, pack(np.array([texts], np.uint64)), b"")]

    def count_words(shard: int, rows: pa.Table) -> list[tuple[int, int, np.ndarray]]:
        asking, keys, notes = of_kind(rows, WORD)
        texts = sum(int(x[0]) for x in of_kind(rows, WORD_STATS)[1])
        words, at = at_keys([np.zeros(0, np.uint64), *keys])
        counts = np.bincount(at, weights=np.concatenate([np.zeros(0, np.uint64), *(from_planes(x, np.uint64) for x in notes)]), minlength=len(words)).astype(np.uint64)
        number = np.empty(len(words), np.uint64)
        number[np.argsort(counts, kind="stable")[::-1]] = np.arange(len(words), dtype=np.uint64) * np.uint64(shards) + np.uint64(shard)
        if len(number) and number.max() >= START:
            raise ValueError("more than 2^32 - 1 different words")
        out = [(b, COUNT, x) for b, x in zip(asking, cut_like(counts[at], keys))] + [(b, PLACE, x) for b, x in zip(asking, cut_like(number[at], keys))]
        stats = np.array([counts.sum(), (counts > 0).sum(), *((counts == r).sum() for r in range(1, HIGH + 2)), texts], np.uint64)
        return out + [(b, WORD_STATS, stats) for b in range(n_blocks)]

    def ask_pairs(block: int, rows: pa.Table, replies: pa.Table) -> list[tuple]:
        own = Pairs(Tokens(rows), replies, shards)
        out = []
        for shard, part in _by_shard(own.shard[own.order], shards):
            at = own.order[part]
            out.append((shard, block, PAIR, pack(own.pairs[at]), planes(own.train_count[at]) + planes(own.second_count[at])))
        for shard, part in _by_shard(own.cut_shard[own.cut_order], shards):
            out.append((shard, block, CONTEXT, pack(own.contexts[own.cut_context[own.cut_order[part]]]), b""))
        return out

    def count_pairs(shard: int, rows: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
        asking, keys, notes = of_kind(rows, PAIR)
        none = np.zeros(0, np.uint64)
        pairs, at = at_keys([none, *keys])
        counts, second, start = np.zeros(len(pairs), np.uint64), np.zeros(len(pairs), np.uint64), 0
        for note in notes:  # block by block, each with distinct pairs
            half = len(note) // 2
            own = at[start : start + half // 8]
            counts[own] += from_planes(note[:half], np.uint64)
            second[own] = from_planes(note[half:], np.uint64)
            start += half // 8
        contexts, context = np.unique(pairs >> WIDE, return_inverse=True)
        seen = counts > 0
        sums = np.concatenate([_binned(counts, context, len(contexts)), _binned(second[seen], context[seen], len(contexts))], axis=1)
        for block, own, found in zip(asking, keys, cut_like(at, keys)):  # an answer at a time, each packed before the next
            yield block, PAIR_COUNT, counts[found]
            yield block, SUMS, sums[np.searchsorted(contexts, np.unique(own >> WIDE))].ravel()
        for block, own, _ in zip(*of_kind(rows, CONTEXT)):
            place = np.minimum(np.searchsorted(contexts, own), max(0, len(contexts) - 1))
            there = (contexts[place] == own)[:, None] if len(contexts) else np.zeros((len(own), 1), bool)
            yield block, SLOT_SUMS, (np.where(there, sums[place], 0) if len(contexts) else np.zeros((len(own), sums.shape[1]))).astype(np.uint64).ravel()
        stats = np.array([counts.sum(), seen.sum(), *((counts == r).sum() for r in range(1, HIGH + 2)), 0], np.uint64)
        yield from ((b, PAIR_STATS, stats) for b in range(n_blocks))

    def evaluate(block: int, rows: pa.Table, replies: pa.Table) -> list[tuple]:
        tokens = Tokens(rows)
        own = Pairs(tokens, replies, shards)
        words = stats_of(replies, WORD_STATS)
        unigrams, off = Unigrams(words[:-1]), discounts(stats_of(replies, PAIR_STATS)[2:-1])
        count = np.empty(len(own.pairs), np.uint64)
        count[own.order] = answers(replies, PAIR_COUNT, np.uint64)
        width = 2 * (HIGH + 1)
        sums = np.zeros((len(own.contexts), width), np.uint64)
        by_shard = own.shard[own.order]
        whole = np.unique(by_shard.astype(np.uint64) << WIDE | own.context[own.order].astype(np.uint64))
        at = (whole & np.uint64(0xFFFFFFFF)).astype(np.int64)
        found = answers(replies, SUMS, np.uint64).reshape(-1, width)
        single = own.slots[at] == 1
        sums[at[single]] = found[single]
        np.add.at(sums, own.cut_context[own.cut_order], answers(replies, SLOT_SUMS, np.uint64).reshape(-1, width))
        r = np.arange(1, HIGH + 1)
        sums = sums.astype(float)
        follows, freed = sums[:, 0] + sums[:, 1 : HIGH + 1] @ r, sums[:, 1 : HIGH + 1] @ ((1 - off) * r)
        keeps = np.where(freed > 0, 1.0, follows / (follows + 1))
        with np.errstate(all="ignore"):
            left = np.where(freed > 0, freed / follows, 1 / (follows + 1))
            backoff = np.where(follows > 0, left / (1 - unigrams.held(sums[:, HIGH + 1 :])), 1.0)
            seen = keeps[own.context] * discounted(count, off) / follows[own.context]
            chance = np.where(count > 0, seen, backoff[own.context] * unigrams.of(own.second_count))
        number = len(tokens.count)
        score = np.bincount(tokens.row, weights=np.log10(chance)[own.of_token], minlength=number)
        c = own.word_count[tokens.code]
        base = np.bincount(tokens.row, weights=np.log10((c + 1.0) / (unigrams.total + unigrams.types + 1)), minlength=number)
        known = np.bincount(tokens.row[c > 0], minlength=number)
        cells = (rows["doc_id"].to_pylist(), (~tokens.train).tolist(), tokens.count.tolist(), known.tolist(), [unigrams.total] * number, base.tolist(), score.tolist())
        return list(zip(*cells))

    words = at_shards(asked_by(blocks, ask_words), count_words)
    pairs = at_shards(join_blocks(blocks, words, ask_pairs, ASKED), count_pairs)
    return join_blocks(blocks, words.union(pairs), evaluate, SCORED)


def every_seventh(id_col: str = "doc_id") -> F.Column:
    """Whether crc32 of the id as text leaves 2 by 7; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2
