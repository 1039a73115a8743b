"""SentencePiece encoding and decoding by suffix-array matching over whole batches."""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count as counter
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import utf8

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters of segments that are indexed at once; bounds the memory of a task.
INDEXED = 1_000_000
#: Longer segments are merged one by one from a heap instead of in step with the others.
IN_STEP = 48
#: Letters of texts that are encoded together.
SLICE = 4_000_000
#: Segments whose ids a task keeps for its next slices; then it starts over.
REMEMBERED = 500_000
WIDTH = 16
NEVER = np.int32(1 << 30)


@dataclass
class Model:
    """Vocabulary of a byte-pair SentencePiece model, as arrays."""

    pieces: list[str]
    order: np.ndarray  # merge order of each id: 0 goes first; equal scores share a place
    whole: list[bytes]  # what each id decodes to
    bytes_from: int  # id of byte 0, or -1 without byte fallback
    unknown: int
    plain: np.ndarray  # ids that text can match

    def __post_init__(self) -> None:
        own = [self.pieces[i] for i in self.plain]
        letters = sorted({c for p in own for c in p})
        if len(letters) + 2 > 1 << 16 or max(map(len, own), default=0) > WIDTH:
            raise ValueError("the index takes up to 65,534 different letters and pieces of up to 16")
        self.whole_size = np.array([len(x) for x in self.whole], np.int64)
        self.whole_start = np.cumsum(self.whole_size) - self.whole_size
        self.whole_bytes = np.frombuffer(b"".join(self.whole), np.uint8)
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        self.single = {p: int(i) for i, p in zip(self.plain, own) if len(p) == 1}
        joined = "".join(p for p in own if len(p) > 1)
        self.split_spaces = not any(SPACE in p.lstrip(SPACE) for p in own)
        line = "\n" not in joined
        self.segments = re.compile((r"\n|▁+[^▁\n]*|[^▁\n]+" if line else r"▁+[^▁]*|[^▁]+") if self.split_spaces else (r"\n|[^\n]+" if line else r"(?s:.+)"))
        longer = [(i, p) for i, p in zip(self.plain, own) if len(p) > 1]
        self.long_ids = np.array([i for i, _ in longer], np.int64)
        self.long_sizes = np.array([len(p) for _, p in longer], np.int64)
        self.long_codes = np.zeros((len(longer), WIDTH), np.uint16)
        for n, (_, p) in enumerate(longer):
            self.long_codes[n, : len(p)] = self.codes(p)

    def codes(self, text: str) -> np.ndarray:
        """Letters as numbers from 2 on; 1 for letters of no piece."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at + 2, 1).astype(np.uint16)


def _packed(codes: np.ndarray, bits: int) -> np.ndarray:
    """Letters of each row as whole numbers, 64 // bits letters in one, that compare like the row."""
    each = 64 // bits
    parts = codes.reshape(len(codes), WIDTH // each, each).astype(np.uint64)
    out = parts[..., 0]
    for k in range(1, each):
        out = out << np.uint64(bits) | parts[..., k]
    return out


def load(path: str = MODEL) -> Model:
    """Reads the vocabulary; encoding and decoding are this module's own."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.vocab_size())
    pieces = [sp.id_to_piece(i) for i in ids]
    special = {i for i in ids if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
    byte = [i for i in ids if sp.is_byte(i)]
    scores = np.array([sp.get_score(i) for i in ids])
    order = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
    whole = [bytes([i - byte[0]]) if byte and byte[0] <= i <= byte[-1] else b"" if i in special else pieces[i].replace(SPACE, " ").encode() for i in ids]
    if sp.unk_id() >= 0:
        whole[sp.unk_id()] = " ⁇ ".encode()
    plain = np.array([i for i in ids if i not in special and not sp.is_byte(i)], np.int64)
    return Model(pieces, order, whole, byte[0] if byte else -1, sp.unk_id(), plain)


class Index:
    """Suffix array of a text of segments, and the edges that the pieces make in it."""

    def __init__(self, model: Model, codes: np.ndarray) -> None:
        n = len(codes)
        used = np.zeros(1 << 16, bool)
        used[codes] = used[:2] = True
        bits = 8 if used.sum() < 1 << 8 else 16
        number = np.cumsum(used).astype(np.uint64) - np.uint64(1)
        there = np.flatnonzero((used[model.long_codes]).all(1))
        ids, sizes = model.long_ids[there], model.long_sizes[there]
        low = number[model.long_codes[there]]
        high = np.where(np.arange(WIDTH) >= sizes[:, None], np.uint64((1 << bits) - 1), low)
        each = 64 // bits
        padded = np.concatenate([number[codes], np.zeros(2 * WIDTH, np.uint64)])
        runs = padded[: n + WIDTH]
        for k in range(1, each):
            runs = runs << np.uint64(bits) | padded[k : n + WIDTH + k]
        keys = [runs[at : n + at] for at in range(0, WIDTH, each)]
        self.suffixes = np.lexsort(keys[::-1])
        first = self._search(keys, _packed(low, bits), False)
        last = self._search(keys, _packed(high, bits), True)
        count = last - first
        ranks = np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)
        at, size = self.suffixes[ranks], np.repeat(sizes, count)
        by_place = _by_place(at, size)
        self.ids = np.repeat(ids, count)[by_place]
        self.start = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))])
        self.sizes = np.zeros(n + 1, np.uint32)
        np.bitwise_or.at(self.sizes, at, np.uint32(1) << size.astype(np.uint32))

    def _search(self, suffix: list[np.ndarray], keys: np.ndarray, after: bool) -> np.ndarray:
        """Binary search of every key at once: first suffix not below it, or first above it."""
        low, high = np.zeros(len(keys), np.int64), np.full(len(keys), len(self.suffixes), np.int64)
        while (open_ := low < high).any():
            middle = (low + high) // 2
            at = self.suffixes[np.minimum(middle, len(self.suffixes) - 1)]
            less, same = np.zeros(len(keys), bool), np.ones(len(keys), bool)
            for k, runs in enumerate(suffix):
                part = runs[at]
                less |= same & (part < keys[:, k])
                same &= part == keys[:, k]
            right = open_ & (less | (same if after else False))
            low, high = np.where(right, middle + 1, low), np.where(open_ & ~right, middle, high)
        return low

    def edge(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Id of the piece of ``size`` letters at ``at``, -1 if there is none."""
        bits = self.sizes[at]
        bit = np.uint32(1) << np.minimum(size, WIDTH + 1).astype(np.uint32)
        there = (bits & bit) != 0
        place = self.start[at] + np.bitwise_count(bits & (bit - np.uint32(1)))
        return np.where(there, self.ids[np.where(there, place, 0)], -1) if len(self.ids) else np.full(len(at), -1)


def _by_place(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order of edges by place, then size, as a radix sort over 16 bits at a time."""
    order = np.argsort(size.astype(np.uint8), kind="stable")
    for shift in range(0, max(1, int(at.max(initial=0)).bit_length()), 16):
        order = order[np.argsort((at[order] >> shift).astype(np.uint16), kind="stable")]
    return order


def _in_step(model: Model, index: Index, start: np.ndarray, size: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Relaxes all segments together: each round takes, in every segment, the edge that joins two neighbours and goes first."""
    done_at, done_size = [], []
    while len(start):
        pair = index.edge(start[:-1], size[:-1] + size[1:])
        order = np.concatenate([np.where((pair >= 0) & (segment[:-1] == segment[1:]), model.order[pair], NEVER), [NEVER]])
        first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        least = np.minimum.reduceat(order, first)
        count = np.diff(np.r_[first, len(start)])
        hit = (order == np.repeat(least, count)) & (order < NEVER)
        places = np.flatnonzero(hit)
        places = places[np.r_[True, segment[places[1:]] != segment[places[:-1]]]] if len(places) else places
        size[places] += size[places + 1]
        stay = np.ones(len(start), bool)
        stay[places + 1] = False
        ended = np.repeat(least == NEVER, count)
        done_at.append(start[ended])
        done_size.append(size[ended])
        stay &= ~ended
        start, size, segment = start[stay], size[stay], segment[stay]
    at, sizes = np.concatenate(done_at or [start]), np.concatenate(done_size or [size])
    order = np.argsort(at, kind="stable")
    return at[order], sizes[order]


def _by_heap(model: Model, text: str) -> list[int]:
    """Sizes of the symbols of one long segment."""
    rank = {model.pieces[i]: int(model.order[i]) for i in model.plain} if not hasattr(model, "ranks") else model.ranks
    model.ranks = rank
    size, after, before = [1] * len(text), list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(left: int) -> None:
        right = after[left]
        if right < len(text) and (n := size[left] + size[right]) <= WIDTH and (r := rank.get(text[left : left + n])) is not None:
            heapq.heappush(heap, (r, left, n))

    for i in range(len(text) - 1):
        offer(i)
    while heap:
        _, left, n = heapq.heappop(heap)
        right = after[left] if size[left] else len(text)
        if right >= len(text) or size[left] + size[right] != n:
            continue
        size[left], size[right], after[left] = n, 0, after[right]
        if after[left] < len(text):
            before[after[left]] = left
        offer(left)
        if before[left] >= 0:
            offer(before[left])
    return [s for s in size if s]


def encode_segments(model: Model, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all segments in a row, and how many each has."""
    ids: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    at = 0
    sizes = np.fromiter(map(len, segments), np.int64, len(segments))
    ends = np.cumsum(sizes + 1)
    while at < len(segments):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + INDEXED)))
        a, b = _encode_indexed(model, segments[at:stop], sizes[at:stop])
        ids.append(a)
        counts.append(b)
        at = stop
    none = np.zeros(0, np.int64)
    return np.concatenate(ids or [none]), np.concatenate(counts or [none])


def _encode_indexed(model: Model, segments: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    text = "\0".join(segments) + "\0"
    first = np.cumsum(sizes + 1) - sizes - 1
    codes = model.codes(text)
    codes[first + sizes] = 0
    index = Index(model, codes)
    segment = np.repeat(np.arange(len(segments)), sizes)
    letter = np.arange(len(segment)) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
    long = sizes[segment] > IN_STEP
    at, size = _in_step(model, index, letter[~long], np.ones((~long).sum(), np.int64), segment[~long])
    for s in np.flatnonzero(sizes > IN_STEP):
        own = np.array(_by_heap(model, segments[s]), np.int64)
        at = np.concatenate([at, first[s] + np.cumsum(own) - own])
        size = np.concatenate([size, own])
    if (sizes > IN_STEP).any():
        order = np.argsort(at, kind="stable")
        at, size = at[order], size[order]
    found = np.where(size > 1, index.edge(at, size), -1)
    alone = np.flatnonzero(size == 1)
    letters = [text[i] for i in at[alone].tolist()]
    one = np.fromiter((model.single.get(c, -1) for c in letters), np.int64, len(letters))
    found[alone] = one
    width = np.ones(len(at), np.int64)
    lost = alone[one < 0]
    raw = [text[i].encode("utf-8", "surrogatepass") for i in at[lost].tolist()]
    if model.bytes_from >= 0:
        width[lost] = [len(x) for x in raw]
    out = np.repeat(found, width)
    if len(lost):
        starts = (np.cumsum(width) - width)[lost]
        if model.bytes_from >= 0:
            places = np.repeat(starts - (np.cumsum(width[lost]) - width[lost]), width[lost]) + np.arange(width[lost].sum())
            out[places] = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + model.bytes_from
        else:
            out[starts] = model.unknown
    owner = np.searchsorted(first, at, side="right") - 1
    return out, np.bincount(owner, weights=width, minlength=len(segments)).astype(np.int64)


class Encoder:
    """Encodes texts slice by slice; a segment met before is not encoded again."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict(counter().__next__)
        self.ids, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if len(self.number) > REMEMBERED:
            self._forget()
        find, number, old = self.model.segments.findall, self.number, len(self.number)
        count, code = np.zeros(len(texts), np.int64), []
        for i, t in enumerate(texts):
            if t:
                own = find(SPACE + t.replace(" ", SPACE))
                count[i] = len(own)
                code.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
        fresh = list(islice(reversed(number), len(number) - old))[::-1]
        ids, size = encode_segments(self.model, fresh)
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.ids, self.size = np.concatenate([self.ids, ids.astype(np.int32)]), np.concatenate([self.size, size])
        all_codes = np.concatenate([np.zeros(0, np.int32), *code])
        own, ends = self.size[all_codes], np.cumsum(count)
        upto = np.concatenate([[0], np.cumsum(own)])
        flat = self.ids[np.repeat(self.start[all_codes] - upto[:-1], own) + np.arange(upto[-1])]
        return flat, upto[ends] - upto[ends - count]


def encode_batch(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    return Encoder(model)(texts)


def decode_flat(model: Model, ids: np.ndarray, count: np.ndarray) -> list[str]:
    """Texts of ids in a row; bytes that are no UTF-8 become U+FFFD, the space put before a text goes."""
    size = model.whole_size[ids]
    upto = np.concatenate([[0], np.cumsum(size)])
    data = model.whole_bytes[np.repeat(model.whole_start[ids] - upto[:-1], size) + np.arange(upto[-1])].tobytes()
    ends = np.cumsum(count)
    cut = zip(upto[ends - count].tolist(), upto[ends].tolist())
    texts = [data[a:b].decode("utf-8", "replace") for a, b in cut]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def decode_ids(model: Model, ids: list[int]) -> str:
    return decode_flat(model, np.array(ids, np.int64), np.array([len(ids)]))[0]


def _slices(texts: list[str | None], most: int) -> Iterator[slice]:
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= most:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _encoded(docs: DataFrame, model: Model, id_col: str, text_col: str, check: bool, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for part in _slices(texts, SLICE):
                ids, count = encoder(texts[part])
                rows = batch.slice(part.start, part.stop - part.start)
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                cells = {"doc_id": rows["doc_id"], "n_ids": pa.array(count), "ids": pa.ListArray.from_arrays(offsets, pa.array(ids))}
                if check:
                    back = decode_flat(encoder.model, ids, count)
                    cells["decoded_sha256"] = [hashlib.sha256(utf8(t)).hexdigest() for t in back]
                    cells["round_trip"] = [a == (b or "").replace(SPACE, " ") for a, b in zip(back, texts[part])]
                yield pa.RecordBatch.from_pydict(cells)

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(run, schema)


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids) of every row, as the model's own library encodes the text.

    Null and empty texts give no ids, a null doc_id passes through, repeated rows give a row
    each, other columns are ignored. Letters of no piece become their UTF-8 bytes. Nothing is
    shuffled: the vocabulary goes with the tasks, its size is the model's.
    """
    return _encoded(docs, model, id_col, text_col, False, "doc_id long, n_ids long, ids array<int>")


def round_trip(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids, decoded_sha256, round_trip): encoded, decoded again, and whether that is the text.

    A text with the mark of a space in it comes back with a space there; round_trip allows for
    that. See ``encode`` for nulls, empty texts and repeated rows.
    """
    return _encoded(docs, model, id_col, text_col, True, "doc_id long, n_ids long, ids array<int>, decoded_sha256 string, round_trip boolean")


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text) of every row of ``encoded`` (doc_id, ids); null for null ids, '' for none."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["ids"]
            count = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
            text = decode_flat(shared.value, ids.flatten().to_numpy(zero_copy_only=False), count)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "text": pa.array([t if k else None for t, k in zip(text, ids.is_valid().to_pylist())], pa.string())})

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
