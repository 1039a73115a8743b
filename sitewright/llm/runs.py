"""Runs of repeated words, found on the diagonals of each document's self-comparison.

A diagonal is a lag: its matches are the words that equal the word ``lag`` places earlier, and its
match length counts them in a row. A run of period q is a diagonal with at least 3 q matches, so
among the places it covers four in a row are multiples of q and hold one word. Only there is a lag
opened: each word looks at its earlier occurrences at lags that divide its place, n/1 + n/2 + n/3
+ ... places in all instead of all pairs of occurrences. An opened diagonal is counted back to its
first match and on to its end, and a run is emitted where it ends. Lags that are multiples of the
period of a run around them stay closed: there they repeat that run's diagonal.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import utf8

#: A run has at least LEAST words and at least REPEATS periods.
LEAST, REPEATS = 6, 4
#: Bytes of text that a task compares at once, or one document.
SLICE = 4 << 20
#: Words compared at once while a diagonal is followed.
STEP = 64


def _reach(codes: np.ndarray, at: int, lag: int, stop: int, step: int) -> int:
    """The last place in the direction of ``step`` up to which words equal those ``lag`` earlier, from the match at ``at``."""
    size = STEP
    while at != stop:
        n = min(size, abs(stop - at))
        here = codes[at + 1 : at + 1 + n] if step > 0 else codes[at - n : at][::-1]
        there = codes[at + 1 - lag : at + 1 - lag + n] if step > 0 else codes[at - n - lag : at - lag][::-1]
        differs = np.flatnonzero(here != there)
        if len(differs):
            return at + step * int(differs[0])
        at, size = at + step * n, size * 4
    return at


def _ends(known: list[tuple[int, int]], place: int) -> int:
    """Where the last of ``known`` runs that start at ``place`` or earlier ends; runs of one period overlap by less than it."""
    i = bisect_right(known, (place, len(known) and known[-1][1]))
    return known[i - 1][1] if i else -1


def runs_of(codes: np.ndarray, starts: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, by start, then period.

    ``codes`` are the words of all documents in a row, equal only within one document; longer
    documents come first. ``starts`` are the places of their first words, and the end.
    """
    sizes = np.diff(starts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    by_period: list[dict[int, list[tuple[int, int]]]] = [{} for _ in sizes]
    for lag in range(1, int(sizes.max(initial=0)) // REPEATS + 1):
        within = int(starts[np.searchsorted(-sizes, -max(LEAST, REPEATS * lag), side="right")])
        grid = codes[:within:lag]
        open_ = np.flatnonzero(grid[3:] == grid[:-3])
        open_ = open_[(grid[open_] == grid[open_ + 1]) & (grid[open_] == grid[open_ + 2])]
        if not len(open_):
            continue
        after = -1
        for at in ((open_ + 1) * lag).tolist():
            if at <= after:
                continue  # the diagonal of this lag is active here
            doc = int(np.searchsorted(starts, at, side="right")) - 1
            low, high = int(starts[doc]), int(starts[doc + 1])
            around = [p for p, known in by_period[doc].items() if lag % p == 0 and _ends(known, at - lag) > at + 2 * lag]
            if around:
                after = _ends(by_period[doc][around[0]], at - lag) - 1
                continue
            last = _reach(codes, at, lag, high - 1, 1)
            first = _reach(codes, at, lag, low + lag, -1)
            after = last
            start, length = first - lag, last - first + 1 + lag
            if length >= max(LEAST, REPEATS * lag):
                found[doc].append((start - low, length, lag))
                by_period[doc].setdefault(lag, []).append((start, start + length))
    for of in found:
        of.sort(key=lambda r: (r[0], r[2]))
    return found


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).split()


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """``words`` with a stretch repeated, for documents whose id says so: every tenth by checksum."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * (-(-(n - a) // len(unit))))[: n - a]


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words outside of all runs, or in the first period of those that hold them."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]


def _rows(slice_: list[tuple], plant: bool, keep_text: bool) -> list[tuple]:
    texts = [(doc_id, planted(words_of(text), doc_id) if plant else words_of(text)) for doc_id, text in slice_]
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i][1]))
    code: dict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(texts[i][1]) for i in order], np.int64)
    codes = np.fromiter((code[w] for i in order for w in texts[i][1]), np.int64, int(sizes.sum()))
    runs = dict(zip(order, runs_of(codes + np.repeat(np.arange(len(order)) * len(code), sizes), np.r_[0, np.cumsum(sizes)])))
    out = []
    for i, (doc_id, words) in enumerate(texts):
        best = max(runs[i], key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs[i] else None
        if best:  # lengths and periods are below 2^26, so unequal quotients stay unequal as doubles
            best = (*best, 1000 * best[1] // best[2])
        collapsed = b" ".join(kept_words(words, runs[i]))
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs[i]).encode()
        row = (doc_id, len(words), len(runs[i]), *(best or (None,) * 4), hashlib.sha256(listed).hexdigest(), hashlib.sha256(collapsed).hexdigest())
        out.append(row + ([r[0] for r in runs[i]], [r[1] for r in runs[i]], [r[2] for r in runs[i]], collapsed.decode("utf-8", "ignore")) if keep_text else row)
    return out


FOUND = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
SPANS = ", starts array<long>, lengths array<long>, periods array<long>, collapsed string"


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, keep_text: bool = True) -> DataFrame:
    """Runs of every document: stretches of words with smallest period q and at least max(6, 4 q) words that no neighbour extends.

    Words are separated by ASCII white space. A row for each row of ``docs``: doc_id, n_words,
    n_runs, start, length, period and exponent_milli (floor of 1000 length / period) of the run
    with the greatest exponent (ties: smallest start, then period; null without a run),
    digests of the list of runs and of the text whose runs are cut to their first period; with
    ``keep_text`` also starts, lengths and periods of all runs and that collapsed text, words
    joined by single spaces. ``plant`` first repeats a stretch of some documents, by their id.

    A null or empty text has no words and no run; a null id is kept and plants nothing; repeated
    rows give a row each; other columns are ignored; an empty table gives none. Texts are read
    whole, a few megabytes at a time in a task; nothing is shuffled.
    """
    cells = [f.strip().split() for f in (FOUND + (SPANS if keep_text else "")).split(",")]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    names = pa.schema([(k, kinds[t]) for k, t in cells])

    def emit(slice_: list[tuple]) -> pa.RecordBatch:
        columns = zip(*_rows(slice_, plant, keep_text))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, names)], schema=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                slice_.append((doc_id, text.as_py()))
                held += len(slice_[-1][1] or "") + 64
                if held >= SLICE:
                    yield emit(slice_)
                    slice_, held = [], 0
        if slice_:
            yield emit(slice_)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, FOUND + (SPANS if keep_text else ""))
