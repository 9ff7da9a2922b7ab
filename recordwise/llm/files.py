"""Binary files that tasks write and read in the shared folder, one per partition."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from recordwise.operators.sizing import fresh_path


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        folder = tempfile.mkdtemp(prefix="recordwise-")  # the driver's own; Spark copies it from there
        context.addPyFile(shutil.make_archive(os.path.join(folder, "recordwise"), "zip", root, "recordwise"))
        _shipped.add(context.applicationId)


def opened(uri: str):
    """File system and path of ``uri``; local paths may come as ``file:/x``, ``file:///x`` or ``/x``."""
    from pyarrow import fs

    if uri.startswith(("file:", "/")):
        return fs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


class Replacing:
    """Output file that appears under its name only when complete.

    The content goes to a name of its own first, so a task that is lost or runs twice leaves
    no half-written file, and whichever attempt ends last puts the same bytes there.
    """

    def __init__(self, uri: str, attempt: int):
        self.system, self.path = opened(uri)
        self.system.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.unfinished = f"{self.path}.{attempt}.unfinished"
        self.out = self.system.open_output_stream(self.unfinished, compression=None)

    def write(self, data) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.system.move(self.unfinished, self.path)


def free_name(columns: Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name (names differ by more than case)."""
    taken = {name.lower() for name in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table of its own in the shared folder and read back; nothing of its plan is left.

    Loops use this instead of a checkpoint, which keeps the constraints of all earlier rounds.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the table of ``stored``; for loops that have written their next one."""
    context = df.sparkSession.sparkContext
    for place in {name.rpartition("/")[0] for name in df.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def attempt_number() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.taskAttemptId() if context else 0


def partition_number() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def one_task_each(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """The given file entries, each in a partition of its own (file lists only, never data)."""
    rows = list(rows)
    return spark.createDataFrame(rows, schema).repartition(max(1, len(rows)))
