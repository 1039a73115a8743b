"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "sitewright") -> SparkSession:
    """Session for tests and the bench. On a cluster pass your own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def planned_once(spark: SparkSession) -> Iterator[None]:
    """Plans what is run within as a whole, not anew after each stage.

    Adaptive execution holds, plans and describes the rest of a plan once a stage in the driver. For a plan of
    tables that are used many times over this takes more of its memory than anything else; such
    plans gain nothing by it if their partitions are even.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and tables between steps.

    It comes from ``spark.checkpoint.dir`` of the session; only a local session without it
    gets a temporary folder.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all machines share")
            folder = tempfile.mkdtemp(prefix="sitewright-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def written(df: DataFrame, by: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, in ranges of ``by`` and sorted by it if given.

    A filter on one value of ``by`` then reads the row groups that hold it and no others. Unlike a
    checkpoint the table keeps no constraints of its plan, which grow with every round of a loop.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    (df if by is None else df.repartitionByRange(by).sortWithinPartitions(by)).write.parquet(path)
    return df.sparkSession.read.parquet(path)


BYTES_TO_BROADCAST = 8 << 20


def local_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """Short driver-side list as a table; broadcast in joins while its bytes are few.

    The planner knows no size for such a table and would otherwise broadcast or shuffle
    the large side.
    """
    made = spark.createDataFrame(rows, schema)
    size = sum(16 + len(v) if isinstance(v, str) else 16 for row in rows for v in row)
    return F.broadcast(made) if size <= BYTES_TO_BROADCAST else made


def spread(df: DataFrame) -> DataFrame:
    """Share the rows of an input with fewer splits than cores among all cores.

    Helps files that cannot be split (compressed text, a single row group) before heavy
    work on each row. An input with enough splits is passed on as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
