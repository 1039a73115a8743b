"""Calling of pileups as they arrive.

The calls need no state, so this is the batch expression on a streaming source; quality
and alignment then run in batch on the table it fills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitewright.operators.calling import calls_from_pileup
from sitewright.sources.evidence import parse_pileup
from sitewright.sources.lines import parent_folder


def arriving_pileups(spark: SparkSession, root: str) -> DataFrame:
    """Streaming pileup rows of ``<taxon>/<taxon>.pileups`` files below ``root``."""
    lines = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.pileups").text(root)
    return parse_pileup(lines.select(parent_folder(F.col("_metadata.file_path")).alias("taxon"), "value"))


def call_arriving(spark: SparkSession, root: str, out: str, checkpoint: str, minread: int, thresh: float) -> StreamingQuery:
    """Append the calls of new pileup files to the Parquet table ``out``."""
    calls = calls_from_pileup(arriving_pileups(spark, root), minread, thresh)
    writer = calls.writeStream.format("parquet").partitionBy("taxon").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)
