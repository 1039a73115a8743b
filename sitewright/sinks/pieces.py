"""Writes one text document as ordered part files, without gathering it.

The parts concatenated in name order are the document: pieces carry no line break of
their own, so a single line may span many parts.
"""

from __future__ import annotations

import shutil
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from sitewright.sources.ranges import located

FORMAT = "sitewright_pieces"


class _Part(WriterCommitMessage):
    def __init__(self, temporary: str, final: str):
        self.temporary = temporary
        self.final = final


class _PieceWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path = path
        self.overwrite = overwrite
        self.token = uuid.uuid4().hex

    def write(self, iterator):
        from pyspark import TaskContext

        store, folder = located(self.path)
        store.create_dir(folder, recursive=True)
        task = TaskContext.get()
        temporary = f"{folder}/.{self.token}-{task.taskAttemptId()}"
        with store.open_output_stream(temporary) as out:
            for row in iterator:
                out.write(row[0].encode("utf-8"))
        return _Part(temporary, f"{folder}/part-{task.partitionId():06d}")

    def commit(self, messages):
        store, folder = located(self.path)
        for path in _found(store, folder, "part-") if self.overwrite else []:
            store.delete_file(path)
        for m in messages:
            if m is not None:
                store.move(m.temporary, m.final)
        self._sweep()

    def abort(self, messages):
        self._sweep()

    def _sweep(self):
        store, folder = located(self.path)
        for path in _found(store, folder, "." + self.token):
            store.delete_file(path)


def _found(store: pafs.FileSystem, folder: str, prefix: str = "") -> list[str]:
    """Files of a folder whose names begin with ``prefix``, in order; none if there is no folder."""
    listed = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in listed if f.base_name.startswith(prefix) and f.type == pafs.FileType.File)


class PieceSink(DataSource):
    """Sink on a folder that every executor can reach under the same path, on any file system that pyarrow opens."""

    @classmethod
    def name(cls):
        return FORMAT

    def writer(self, schema, overwrite):
        return _PieceWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PieceSink)


def write_pieces(df: DataFrame, order: list, path: str, text: str = "text", overwrite: bool = True) -> None:
    """Write the ``text`` column in the given order to part files in ``path``."""
    if not overwrite and _found(*located(path)):
        raise FileExistsError(path)
    register(df.sparkSession)
    ordered = df.orderBy(*order).select(text)
    ordered.write.format(FORMAT).mode("overwrite").option("path", path).save()


def join_parts(path: str, target: str) -> str:
    """Concatenate the parts into one file, a buffer at a time."""
    store, folder = located(path)
    there, file = located(target)
    with there.open_output_stream(file) as out:
        for part in _found(store, folder, "part-"):
            with store.open_input_stream(part) as opened:
                shutil.copyfileobj(opened, out)
    return target
