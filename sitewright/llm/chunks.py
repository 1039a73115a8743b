"""Document fingerprints from content-defined chunks."""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewright.llm.common import partitions, utf8

#: Chunks have at least LEAST bytes; cuts are rare up to NORMAL bytes, common after it, forced at MOST.
LEAST, NORMAL, MOST = 16, 32, 128
#: A cut depends on the last WINDOW bytes only, as the masks look at the low bits of the hash.
WINDOW = 16
RARE, COMMON = np.uint16(0b1111110000000000), np.uint16(0b1111000000000000)
#: No UTF-8 text holds this byte; it adds nothing to the hash and parts the texts of a batch.
GAP = 0xFF
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b])) & 0xFFFF for b in range(256)], np.uint16)
GEAR[GAP] = 0


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at every byte: h = 2 h + GEAR[byte] modulo 2^16, by doubling the span."""
    out, span = GEAR[data], 1
    while span < WINDOW:
        out[span:] += out[:-span] << np.uint16(span)
        span *= 2
    return out


def cuts(rare: list[int], common: list[int], size: int) -> list[int]:
    """Ends of the chunks, from the places after which a rare or a common cut may fall."""
    ends, start = [], 0
    while size - start > LEAST:
        i = bisect_left(rare, start + LEAST)
        end = rare[i] if i < len(rare) else size
        if end > start + NORMAL:
            i = bisect_left(common, start + NORMAL)
            end = min(common[i] if i < len(common) else size, start + MOST, size)
        ends.append(end)
        start = end
    if start < size:
        ends.append(size)
    return ends


def chunk_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its distinct chunks, ascending: 48 bits of digest, then 8 bits of length."""
    gap = bytes([GAP]) * WINDOW
    data = np.frombuffer(gap.join([b"", *texts, b""]), np.uint8)
    hashes = gear(data)
    digest, out, at = xxhash.xxh64_intdigest, [], WINDOW
    common = np.flatnonzero((hashes & COMMON) == 0) + 1
    rare = common[(hashes[common - 1] & RARE) == 0]
    for text in texts:
        size = len(text)
        inside = [x[np.searchsorted(x, at + 1) : np.searchsorted(x, at + size)] - at for x in (rare, common)]
        start, found = 0, []
        for end in cuts(inside[0].tolist(), inside[1].tolist(), size):
            found.append(digest(text[start:end]) >> 16 << 8 | end - start)
            start = end
        out.append(np.unique(np.array(found, np.uint64)))
        at += size + WINDOW
    return out


def fingerprint_of(chunks: np.ndarray) -> str:
    """Seven bytes a chunk, base64."""
    return base64.b64encode(chunks.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 1:].tobytes()).decode()


def chunks_of(fingerprint: str) -> np.ndarray:
    seven = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 7)
    return np.ascontiguousarray(np.pad(seven, ((0, 0), (1, 0)))).view(">u8").astype(np.uint64).ravel()


def containment(own: np.ndarray, other: np.ndarray) -> float:
    """Share of the bytes of the own chunks that the other has too; 1 for nothing in nothing, 0 for nothing in something."""
    total = int((own & np.uint64(255)).sum())
    if not total:
        return float(not len(other))
    return int((np.intersect1d(own, other, assume_unique=True) & np.uint64(255)).sum()) / total


def _ring(docs: DataFrame, buckets: int) -> DataFrame:
    """Documents dealt by ranges of doc_id; each range also gets the first document of the next one, the last range that of the first."""
    probe = F.coalesce("doc_id", F.lit(-(1 << 63)))
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    bounds = sorted(set(docs.agg(F.percentile_approx(probe, shares, 10_000)).first()[0] or []))
    steps = [1 << k for k in reversed(range(max(1, len(bounds).bit_length())))]
    array = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.expr("cast(array() as array<long>)")
    search = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when((low + step <= len(bounds)) & (F.get(array, low + step - 1) <= probe), low + step).otherwise(low))
    dealt = docs.withColumn("bucket", search)
    firsts = {r["bucket"]: r["first"] for r in dealt.groupBy("bucket").agg(F.min(probe).alias("first")).collect()}
    used = sorted(firsts)
    before = {b: used[i - 1] for i, b in enumerate(used)}
    size = len(bounds) + 1
    first = F.get(F.array(*[F.lit(firsts.get(b)).cast("long") for b in range(size)]), F.col("bucket"))
    prior = F.get(F.array(*[F.lit(before.get(b)).cast("int") for b in range(size)]), F.col("bucket"))
    both = F.array(F.struct("bucket", F.lit(False).alias("guest")), F.struct(prior.alias("bucket"), F.lit(True).alias("guest")))
    homes = F.when(probe == first, both).otherwise(F.slice(both, 1, 1))
    return dealt.select("doc_id", "text", F.explode(homes).alias("home")).select("home.bucket", "home.guest", "doc_id", "text")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of bucket and doc_id; each row is emitted when its successor is known."""
    last: tuple | None = None
    for batch in batches:
        raw = [batch["bucket"].to_pylist(), batch["guest"].to_pylist(), batch["doc_id"].to_pylist(), [x or "" for x in batch["text"].to_pylist()]]
        rows = list(zip(*raw, chunk_sets([utf8(x) for x in raw[3]])))
        pairs = [(a, b) for a, b in zip([last, *rows] if last else rows, rows if last else rows[1:]) if a[0] == b[0] and not a[1]]
        last = rows[-1] if rows else last
        edited = [utf8(a[3][: len(a[3]) - len(a[3]) // 4] + b[3][: len(a[3]) // 4]) for a, b in pairs]
        out = []
        for (a, b), text, parts in zip(pairs, edited, chunk_sets(edited)):
            out.append((a[2], len(a[3]), hashlib.sha256(text).hexdigest(), fingerprint_of(a[4]), fingerprint_of(parts), containment(a[4], parts), containment(a[4], b[4])))
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"), map(list, zip(*out)))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every document and of its edited text, and how much of it the edited and the next text hold.

    The edited text ends with the start of the next document instead of its own last quarter;
    next is ascending by doc_id and, among equal ids, by text, and the first follows the last.
    A fingerprint is the set of a text's chunks, each 48 bits of digest and a length; two
    fingerprints compare by containment, the share of the bytes of the own chunks found in the other.

    Null text counts as empty (an empty fingerprint); a null doc_id comes before all ids;
    repeated rows follow one another and give a row each; other columns are ignored.
    Texts move once, dealt by ranges of doc_id.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = partitions(spark)
    dealt = _ring(read, 4 * n).repartition(n, "bucket").sortWithinPartitions("bucket", "guest", "doc_id", "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(_compare, schema)
