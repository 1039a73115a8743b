"""Questions from blocks of documents to shards of a key space, and the answers back.

Documents are dealt into blocks by a hash. A block sends each distinct 64-bit key once, sorted
and cut by ranges of the key space; the shard of a range sees the key from every block that has
it and answers in the same order. So a key that a third of all rows hold costs one entry a
block, and neither side ever holds more than one block or one shard.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sitewright.llm.common import partitions

ASKED = "shard int, block int, kind int, keys binary, notes binary"
ANSWERED = "block int, shard int, kinds array<int>, parts array<binary>"
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over the whole key space, one to one."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


def planes(values: np.ndarray) -> bytes:
    """Bytes of whole numbers, all lowest bytes first; the high planes are mostly zero and pack well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T).view(kind).ravel()


def pack(keys: np.ndarray) -> bytes:
    """Ascending keys as steps."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


def ranges(keys: np.ndarray, shards: int) -> np.ndarray:
    """Ends of the parts of ascending keys, one for each shard."""
    starts = np.array([(i << 64) // shards for i in range(1, shards)], np.uint64)
    return np.append(np.searchsorted(keys, starts), len(keys))


PACKED = "block int, rows binary"


def shards_of(spark: SparkSession) -> int:
    """Half as many shards as shuffle partitions: every block writes to every shard, so their product stays in bounds."""
    return max(1, partitions(spark) // 2)


def blocks_of(docs: DataFrame, columns: dict[str, F.Column], spread: Iterable[str | F.Column]) -> DataFrame:
    """``columns`` dealt into blocks, twice as many as shuffle partitions, by a hash of ``spread``.

    A task packs the rows it has for a block into one record of compressed Arrow data, so the
    shuffle moves about half of what plain text rows take.
    """
    n = partitions(docs.sparkSession)
    dealt = docs.select(*[c.alias(k) for k, c in columns.items()]).withColumn("block", F.pmod(F.xxhash64(*spread), F.lit(2 * n)).cast("int"))

    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            block = batch["block"].to_numpy()
            order = np.argsort(block, kind="stable")
            blocks, first = np.unique(block[order], return_index=True)
            rows = []
            for b, at in zip(blocks.tolist(), np.split(order, first[1:])):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                    writer.write_batch(batch.take(pa.array(at)))
                rows.append((b, sink.getvalue().to_pybytes()))
            yield from as_table(rows, PACKED).to_batches()

    return dealt.mapInArrow(pack_rows, PACKED).repartition(n, "block")


def unpacked(packed: pa.Table) -> pa.Table:
    return pa.concat_tables(pa.ipc.open_stream(x.as_buffer()).read_all() for x in packed["rows"])


def questions(block: int, kind: int, keys: np.ndarray, shards: int, notes: np.ndarray | None = None) -> list[tuple]:
    """Rows of ASKED for ascending distinct keys, spread over the key space, with a note each."""
    ends = ranges(keys, shards)
    return [_question(s, block, kind, keys, slice(a, b), notes) for s, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends)) if b > a]


def questions_to(block: int, kind: int, keys: np.ndarray, shard: np.ndarray, notes: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """Rows of ASKED for distinct keys of any spread, each with its shard, and the order in which the answers come."""
    order = np.lexsort((keys, shard))
    by_shard = shard[order]
    first = np.flatnonzero(np.r_[True, by_shard[1:] != by_shard[:-1]]) if len(keys) else np.zeros(0, np.int64)
    parts = [slice(a, b) for a, b in zip(first, np.r_[first[1:], len(keys)])]
    return [_question(int(by_shard[p.start]), block, kind, keys[order], p, notes[order]) for p in parts], order


def _question(shard: int, block: int, kind: int, keys: np.ndarray, part: slice, notes: np.ndarray | None) -> tuple:
    return shard, block, kind, pack(keys[part]), b"" if notes is None else planes(np.ascontiguousarray(notes[part]))


def as_table(rows: list[tuple], names: str) -> pa.Table:
    kinds = {"array<int>": pa.list_(pa.int32()), "array<binary>": pa.list_(pa.binary()), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [x.split() for x in names.split(",")]
    cells = list(zip(*rows)) or [()] * len(fields)
    return pa.table({k: pa.array(c, kinds[t]) for (k, t), c in zip(fields, cells)})


def asked_by(blocks: DataFrame, ask: Callable[[int, pa.Table], list[tuple]]) -> DataFrame:
    """Questions of every block; ``ask`` gets the block and its rows."""
    return blocks.groupBy("block").applyInArrow(lambda rows: as_table(ask(rows["block"][0].as_py(), unpacked(rows)), ASKED), ASKED)


def squeezed(data: bytes) -> bytes:
    """Compressed bytes after their length: answers are mostly small numbers and zeros."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def unsqueezed(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def replies_to(shard: int, found: Iterable[tuple[int, int, np.ndarray]]) -> pa.Table:
    """Rows of ANSWERED, one for each block, from (block, kind, answer)."""
    by_block: dict[int, list[tuple[int, bytes]]] = {}
    for block, kind, answer in found:
        by_block.setdefault(block, []).append((kind, squeezed(planes(np.ascontiguousarray(answer)))))
    return as_table([(b, shard, [k for k, _ in x], [y for _, y in x]) for b, x in by_block.items()], ANSWERED)


def at_shards(asked: DataFrame, work: Callable[[int, pa.Table], Iterable[tuple[int, int, np.ndarray]]]) -> DataFrame:
    """``work`` on every shard's questions, in order of kind and block; it gives (block, kind, answer)."""

    def run(rows: pa.Table) -> pa.Table:
        shard = rows["shard"][0].as_py()
        return replies_to(shard, work(shard, rows.sort_by([("kind", "ascending"), ("block", "ascending")])))

    return asked.groupBy("shard").applyInArrow(run, ANSWERED)


def of_kind(rows: pa.Table, kind: int) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    """Blocks, keys and notes of the questions of one kind."""
    part = rows.filter(pa.array(rows["kind"].to_numpy() == kind))
    return part["block"].to_pylist(), [unpack(x) for x in part["keys"].to_pylist()], part["notes"].to_pylist()


def answered(asked: DataFrame, answer: Callable[[int, list[np.ndarray], list[bytes]], list[np.ndarray]]) -> DataFrame:
    """Answers of every shard; ``answer`` gets the kind, each block's keys and notes, and gives an array for each block."""

    def work(_: int, rows: pa.Table) -> list[tuple[int, int, np.ndarray]]:
        out = []
        for kind in np.unique(rows["kind"].to_numpy()).tolist():
            blocks, keys, notes = of_kind(rows, kind)
            out += [(b, kind, x) for b, x in zip(blocks, answer(kind, keys, notes))]
        return out

    return at_shards(asked, work)


def parts_of(replies: pa.Table, kind: int, values: type) -> list[np.ndarray]:
    """Answers of one kind to one block, from every shard that gave one, in order of shards."""
    replies = replies.sort_by("shard")
    pairs = zip(replies["kinds"].to_pylist(), replies["parts"])
    return [from_planes(unsqueezed(parts[i].as_py()), values) for kinds, parts in pairs for i, k in enumerate(kinds) if k == kind]


def answers(replies: pa.Table, kind: int, values: type) -> np.ndarray:
    """All answers of one kind to one block, in the order of its keys."""
    return np.concatenate([np.zeros(0, values), *parts_of(replies, kind, values)])


def join_blocks(blocks: DataFrame, replies: DataFrame, work: Callable[[int, pa.Table, pa.Table], list[tuple] | pa.Table], schema: str | StructType) -> DataFrame:
    """``work`` on every block with the answers it got; it gives rows, or a table."""

    def run(rows: pa.Table, replies: pa.Table) -> pa.Table:
        if not rows.num_rows:  # answers of shards that speak to every block
            return empty
        out = work(rows["block"][0].as_py(), unpacked(rows), replies)
        return out if isinstance(out, pa.Table) else as_table(out, schema)

    empty = to_arrow_schema(schema).empty_table() if isinstance(schema, StructType) else as_table([], schema)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(run, schema)


def at_keys(sorted_lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several lists, and for each entry of the lists in a row its place among them."""
    everything = np.concatenate(sorted_lists)
    keys, place = np.unique(everything, return_inverse=True)
    return keys, place


def cut_like(values: np.ndarray, lists: list[np.ndarray]) -> list[np.ndarray]:
    return np.split(values, np.cumsum([len(x) for x in lists])[:-1])
