"""Removal of long repeated passages by prefix-free parsing.

A text is parsed into phrases at triggers, places where the hash of the next bytes is 0 in its
low bits; neighbouring phrases share a trigger, so no phrase starts another. Where a phrase ends
depends on its content alone: equal passages hold equal phrases. The dictionary is the set of
distinct phrases with their number. No suffix array is built and nothing is sorted in the order
of the corpus: phrases, spans and single windows of the length asked for are hashed to 64 bits and
counted in their shard, and the parse only says which windows need not be compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sitewright.llm.common import utf8
from sitewright.llm.exchange import ASKED, answered, answers, asked_by, at_keys, blocks_of, cut_like, from_planes, join_blocks, mixed, questions, shards_of

#: Bytes of a trigger, and one place in how many is one.
TRIGGER, SPARSE = 12, 32
PHRASE, SPAN, WINDOW = 0, 1, 2
ONCE, AGAIN, FIRST = 0, 1, 2
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Powers:
    """Powers of the hash's base and of its inverse, grown to the longest text seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BASE)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, BACK)]), dtype=np.uint64)
        return self.up, self.down


class Parse:
    """Phrases of one text, and keys of any of its parts."""

    def __init__(self, data: bytes, length: int, powers: Powers) -> None:
        self.size, self.length = len(data), length
        up, self.down = powers.upto(self.size + 1)
        sums = np.zeros(self.size + 1, np.uint64)
        np.cumsum(LETTERS[np.frombuffer(data, np.uint8)] * up[: self.size], out=sums[1:])
        self.sums = sums
        self.starts = max(0, self.size - length + 1)  # places where a string of that length starts
        at = np.arange(max(0, self.size - TRIGGER + 1))
        self.triggers = at[self.keys(at, at + TRIGGER) % np.uint64(SPARSE) == 0] if self.starts else at[:0]
        edges = self.triggers[(self.triggers > 0) & (self.triggers < self.starts)]
        self.span_starts = np.concatenate([[0], edges]).astype(np.int64) if self.starts else at[:0]
        self.span_ends = np.append(self.span_starts[1:], self.starts)[: len(self.span_starts)]

    def keys(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Key of every part [start, end): the same for the same bytes."""
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * MORE)

    def phrases(self) -> np.ndarray:
        """Keys of the phrases between neighbouring triggers, both triggers included."""
        return self.keys(self.triggers[:-1], self.triggers[1:] + TRIGGER)

    def spans(self) -> np.ndarray:
        """Keys of all bytes that the strings starting in one phrase cover."""
        return self.keys(self.span_starts, self.span_ends - 1 + self.length)

    def windows(self, start: np.ndarray) -> np.ndarray:
        return self.keys(start, start + self.length)

    def open_starts(self, once: np.ndarray, span_open: np.ndarray) -> np.ndarray:
        """Starts in open spans whose string holds no phrase that the corpus has once."""
        start = np.flatnonzero(np.repeat(span_open, self.span_ends - self.span_starts))
        before = np.concatenate([[0], np.cumsum(once)])
        first = np.searchsorted(self.triggers, start)
        last = np.maximum(first, np.searchsorted(self.triggers, start + self.length - TRIGGER, side="right") - 1)
        held = np.minimum(last, len(once))
        return start[before[held] == before[np.minimum(first, held)]]


MORE = np.uint64(0xA0761D6478BD642F)


def _parses(rows: pa.Table, length: int) -> list[tuple[bytes, Parse]]:
    powers = Powers()
    data = [utf8(x) for x in rows["text"].to_pylist()]
    with np.errstate(over="ignore"):
        return [(x, Parse(x, length, powers)) for x in data]


def _distinct(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending distinct keys, whether the block holds each more than once, and the place of every entry."""
    found, place, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *keys]), return_inverse=True, return_counts=True)
    return found, (count > 1).astype(np.uint8), place


def _status(kind: int, keys: list[np.ndarray], notes: list[bytes]) -> list[np.ndarray]:
    """ONCE for keys that the corpus holds once; of repeated ones the first block gets FIRST, others AGAIN."""
    _, place = at_keys(keys)
    again = np.concatenate([from_planes(x, np.uint8) for x in notes]).astype(np.int64) + 1
    repeated = np.bincount(place, weights=again) > 1
    first = np.zeros(len(place), bool)
    first[np.unique(place, return_index=True)[1]] = True
    return cut_like(np.where(repeated[place], np.where(first, FIRST, AGAIN), ONCE).astype(np.uint8), keys)


def _windows(parses: list[tuple[bytes, Parse]], replies: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray, np.ndarray]:
    """For every text the starts in repeated spans (as a mask) and the starts still open; keys of all windows to compare, and of the open ones."""
    _, _, phrase_at = _distinct([p.phrases() for _, p in parses])
    spans, _, span_at = _distinct([p.spans() for _, p in parses])
    once = answers(replies, PHRASE, np.uint8)[phrase_at] == ONCE
    status = answers(replies, SPAN, np.uint8)
    sole = np.zeros(len(span_at), bool)
    sole[np.unique(span_at, return_index=True)[1]] = True  # one place in this block stands for equal spans
    known, open_, shown, own = [], [], [], []
    i = j = 0
    for _, p in parses:
        n, m = max(0, len(p.triggers) - 1), len(p.span_starts)
        state = status[span_at[j : j + m]]
        known.append(np.repeat(state != ONCE, p.span_ends - p.span_starts))
        start = p.open_starts(once[i : i + n], state == ONCE)
        open_.append(start)
        own.append(p.windows(start))
        shown.append(p.windows(np.flatnonzero(np.repeat((state == FIRST) & sole[j : j + m], p.span_ends - p.span_starts))))
        i, j = i + n, j + m
    none = np.zeros(0, np.uint64)
    return known, open_, np.concatenate([none, *own]), np.concatenate([none, *shown])


def _mask(size: int, length: int, start: np.ndarray) -> np.ndarray:
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, np.minimum(start + length, size), -1)
    return np.cumsum(edge[:-1]) > 0


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, keep_text: bool = True) -> DataFrame:
    """Removes each byte under a string of ``length`` bytes that also starts anywhere else in the corpus.

    One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256, and, with ``keep_text``, kept (the bytes left; cuts can fall inside a character).
    Strings are judged on the input and never cross documents; overlapping occurrences count;
    every occurrence goes, the first too.

    Null text counts as empty; texts shorter than ``length`` stay; a null doc_id passes through;
    repeated rows repeat each other's text; other columns are ignored; an empty table gives none.

    Three rounds. Blocks of documents ask shards which phrases the corpus holds once, and which
    spans (the bytes under all strings that start in one phrase) it holds again: a repeated span
    settles all its strings. Strings in other spans are compared one by one, unless they hold a
    phrase that the corpus has once; of equal spans one shows its strings to be compared with.
    Keys have 64 bits: a false match has a chance of about n^2 / 2^65 for n strings compared.
    """
    columns = {"doc_id": F.col(id_col).cast("long"), "text": F.col(text_col).cast("string")}

    def remove(rows: pa.Table, found: Iterator[tuple[bytes, np.ndarray]]) -> list[tuple]:
        out = []
        for doc_id, (data, gone) in zip(rows["doc_id"].to_pylist(), found):
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if gone.any() else data
            runs = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[:1].sum())
            out.append((doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
        return out

    return _on_repeats(docs, columns, length, remove, REMOVED)


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = 200) -> DataFrame:
    """``docs`` with the repeats taken out of the text, all columns kept.

    See ``remove_repeats``. Characters that a cut goes through are dropped; null texts stay null.
    """
    names = [c for c in docs.columns if c != text_col]
    columns = {"text": F.col(text_col).cast("string"), **{f"c{i}": F.col(c) for i, c in enumerate(names)}}

    def cut(rows: pa.Table, found: Iterator[tuple[bytes, np.ndarray]]) -> pa.Table:
        text = [None if old is None else np.frombuffer(data, np.uint8)[~gone].tobytes().decode("utf-8", "ignore") for old, (data, gone) in zip(rows["text"].to_pylist(), found)]
        return pa.table({"text": pa.array(text, pa.string()), **{f"c{i}": rows[f"c{i}"] for i in range(len(names))}})

    schema = StructType([StructField("text", StringType()), *(StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(names))])
    out = _on_repeats(docs, columns, length, cut, schema)
    return out.select(*[(F.col("text") if c == text_col else F.col(f"c{names.index(c)}")).alias(c) for c in docs.columns])


def _on_repeats(docs: DataFrame, columns: dict[str, Column], length: int, work: Callable, schema: str | StructType) -> DataFrame:
    """``work`` on the rows of every block, with each text's bytes and which of them are repeated."""
    shards = shards_of(docs.sparkSession)
    blocks = blocks_of(docs, columns, list(columns))

    def ask_parse(block: int, rows: pa.Table) -> list[tuple]:
        parses = _parses(rows, length)
        out = []
        for kind, keys in ((PHRASE, [p.phrases() for _, p in parses]), (SPAN, [p.spans() for _, p in parses])):
            found, again, _ = _distinct(keys)
            out += questions(block, kind, found, shards, again)
        return out

    def ask_windows(block: int, rows: pa.Table, replies: pa.Table) -> list[tuple]:
        _, _, own, shown = _windows(_parses(rows, length), replies)
        found, again, _ = _distinct([own, shown])
        return questions(block, WINDOW, found, shards, again)

    def settle(block: int, rows: pa.Table, replies: pa.Table) -> list[tuple] | pa.Table:
        parses = _parses(rows, length)
        known, open_, own, shown = _windows(parses, replies)
        _, _, place = _distinct([own, shown])
        repeated = answers(replies, WINDOW, np.uint8)[place[: len(own)]] != ONCE
        ends = np.cumsum([len(x) for x in open_])
        hits = (start[repeated[end - len(start) : end]] for start, end in zip(open_, ends))
        masks = ((data, _mask(len(data), length, np.concatenate([np.flatnonzero(settled), hit]))) for (data, _), settled, hit in zip(parses, known, hits))
        return work(rows, masks)

    parsed = answered(asked_by(blocks, ask_parse), _status)
    compared = answered(join_blocks(blocks, parsed, ask_windows, ASKED), _status)
    return join_blocks(blocks, parsed.union(compared), settle, schema)
