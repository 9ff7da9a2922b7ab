"""Where intermediate results live, and when one is small enough to broadcast."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return os.path.join(shared_folder(spark), "recordwise", f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and continue from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def bytes_of(value: Column, kind: T.DataType) -> Column:
    """Upper estimate of what one value takes in memory; texts, binaries and nested values by what they hold."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(kind, T.StructType):
        size = sum((bytes_of(value.getField(f.name), f.dataType) for f in kind.fields), F.lit(16))
    elif isinstance(kind, T.ArrayType):
        each = F.transform(value, lambda v: bytes_of(v, kind.elementType).cast("long"))
        size = F.aggregate(each, F.lit(24).cast("long"), lambda total, v: total + v)
    elif isinstance(kind, T.MapType):
        pairs = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        size = bytes_of(F.map_keys(value), pairs[0]) + bytes_of(F.map_values(value), pairs[1])
    else:
        return F.lit(16)
    return F.coalesce(size, F.lit(16))


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of a frame, counted by Spark from the rows themselves."""
    row = sum((bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when its measured size allows it.

    ``df`` is settled first, so measuring it does not compute it a second time. Beyond
    the limit the frame is returned unmarked and the join shuffles, where adaptive
    execution splits skewed partitions.
    """
    settled = settle(df)
    return F.broadcast(settled) if measured_bytes(settled) <= limit_bytes else settled
