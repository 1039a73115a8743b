"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewright.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the one knob for the number of blocks and shards."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back, so its size is known to the planner."""
    spark = df.sparkSession
    materialise(spark.range(0))  # makes the session's shared folder known
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def map_tables(df: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on every Arrow batch of ``df``, inside the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(pa.Table.from_batches([batch])).to_batches()

    return df.mapInArrow(run, schema)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def lower_ascii(column) -> F.Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def smallest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links ``a``-``b`` and the smallest node each can reach."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        for side in (root[left], root[right]):
            np.minimum.at(new, side, low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new
