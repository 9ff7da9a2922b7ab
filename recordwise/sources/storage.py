"""Stage tables, exports and run records on files."""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_RECORD_SCHEMA = "run_id string, attempt int, stage string, metric string, value double, note string, ts timestamp"
STAGE_RUN_SCHEMA = "run_id string, written_at timestamp, schema string, folder string"
LOG_FILES = 64  # a log with more files is rewritten as one


def _filesystem(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def _data_files(spark: SparkSession, path: str) -> list[str]:
    system, place = _filesystem(spark, path)
    return [f.getPath().toString() for f in system.listStatus(place) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]


def append_log(entries: DataFrame, path: str, schema: str, most_files: int = LOG_FILES) -> None:
    """Add a few rows to a log, and rewrite the log as one file when it has gathered too many.

    The rewritten file is added before the files that it holds are deleted, so a failure in between leaves
    entries twice, never none; ``read_log`` reads equal entries once.
    """
    spark = entries.sparkSession
    entries.coalesce(1).write.mode("append").parquet(path)
    old = _data_files(spark, path)
    if len(old) > most_files:
        spark.read.schema(schema).parquet(*old).distinct().coalesce(1).write.mode("append").parquet(path)
        for file in old:
            system, place = _filesystem(spark, file)
            system.delete(place, False)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path).distinct()


def raw_path(base: str, run_id: str, fmt: str = "parquet") -> str:
    return posixpath.join(base, "raw", f"run_id={run_id}", f"records.{fmt}")


def write_raw(df: DataFrame, base: str, run_id: str) -> dict[str, str]:
    """Raw records of one run as Parquet, and a JSON copy for reading by eye (``zcat``); other runs' records stay."""
    paths = {fmt: raw_path(base, run_id, fmt) for fmt in ("parquet", "json")}
    df.write.mode("overwrite").parquet(paths["parquet"])
    write_json(df.sparkSession.read.schema(df.schema).parquet(paths["parquet"]), paths["json"])
    return paths


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, gzipped: a table's column names stand in every row, so plain text is over ten times its Parquet."""
    df.write.mode("overwrite").option("compression", "gzip").json(path)


def stage_path(base: str, stage: str) -> str:
    return posixpath.join(base, stage)


def write_stage(df: DataFrame, base: str, stage: str, run_id: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write one run of a stage to a folder of this attempt's own; the run becomes what this write holds.

    With ``partition_by`` the rows are rebalanced by these columns first: few files per
    partition, and a partition with very many rows is still written by several tasks. Only a
    finished write is entered in the log ``_runs`` beside the runs, with its time, schema and folder, and
    readers follow the log: until then, and after a failed write, they see the run's earlier rows.
    """
    spark = df.sparkSession
    folder = posixpath.join(f"run_id={run_id}", f"write-{uuid.uuid4().hex}")
    path = posixpath.join(stage_path(base, stage), folder)
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    rows.write.partitionBy(*partition_by).parquet(path)
    entry = spark.createDataFrame([(run_id, df.schema.json(), folder)], "run_id string, schema string, folder string")
    entry = entry.select("run_id", F.current_timestamp().alias("written_at"), "schema", "folder")
    append_log(entry, posixpath.join(stage_path(base, stage), "_runs"), STAGE_RUN_SCHEMA)
    return path


def stage_runs(spark: SparkSession, base: str, stage: str) -> DataFrame:
    """One row per finished write of a stage: run id, time, schema and folder."""
    return read_log(spark, posixpath.join(stage_path(base, stage), "_runs"), STAGE_RUN_SCHEMA)


def read_stage(spark: SparkSession, base: str, stage: str, run_id: str) -> DataFrame:
    """Rows of the last finished write of a run with the schema they were written with; nothing is inferred, no other run is listed."""
    last = F.max_by(F.struct("schema", "folder"), "written_at")
    found = stage_runs(spark, base, stage).where(F.col("run_id") == run_id).agg(last).first()[0]
    if found is None:
        raise FileNotFoundError(f"no run {run_id!r} of stage {stage!r} under {base}")
    schema = T.StructType.fromJson(json.loads(found["schema"]))
    path = posixpath.join(stage_path(base, stage), found["folder"])
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    return rows.select(*[F.col(f"`{name}`") for name in schema.names])


def remove_superseded(spark: SparkSession, base: str, stage: str, run_id: str) -> list[str]:
    """Delete the folders of a run that no reader is led to any more: earlier writes and unfinished ones.

    For the end of a run, when nothing reads its earlier attempts and no other attempt of it is at work.
    """
    last = stage_runs(spark, base, stage).where(F.col("run_id") == run_id).agg(F.max_by("folder", "written_at")).first()[0]
    system, place = _filesystem(spark, posixpath.join(stage_path(base, stage), f"run_id={run_id}"))
    old = [f.getPath() for f in system.listStatus(place) if f.isDirectory() and f.getPath().getName() != posixpath.basename(last or "")] if last else []
    for path in old:
        system.delete(path, True)
    return [path.toString() for path in old]


def latest_run(spark: SparkSession, base: str, stage: str) -> str | None:
    """The run of a stage that was written last, from the stage's list of runs; no data file is listed."""
    return stage_runs(spark, base, stage).agg(F.max_by("run_id", "written_at")).first()[0]


def read_latest(spark: SparkSession, base: str, stage: str) -> DataFrame:
    run_id = latest_run(spark, base, stage)
    if run_id is None:
        raise FileNotFoundError(f"no run of stage {stage!r} under {base}")
    return read_stage(spark, base, stage, run_id)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header; ``single_file`` writes one file in one task, for frames that a top-n or a few groups bound."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def side_by_side(
    spark: SparkSession, writes: Mapping[str, Callable[[], object]], at_once: int = 4
) -> dict[str, Exception | None]:
    """Run independent writes, a few at a time, and return the error of each or None.

    The last stages of a report have few tasks; running several reports together keeps
    the executors busy.
    """
    def attempt(write: Callable[[], object]) -> Exception | None:
        try:
            write()
        except Exception as error:  # returned to the caller, who decides
            return error
        return None

    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(at_once) as pool:
        started = {name: pool.submit(inherit(attempt), write) for name, write in writes.items()}
        return {name: future.result() for name, future in started.items()}


def save_results(spark: SparkSession, results: Mapping, base: str) -> DataFrame:
    """Write named results and return what was written: name, kind, path.

    A DataFrame goes to Parquet, a dictionary of DataFrames to sub-folders, a dictionary of
    plain values to one JSON row; anything else is listed as skipped.
    """
    written, writes = [], {}

    def add(name: str, kind: str, path: str, write: Callable[[], object]) -> None:
        written.append((name, kind, path))
        writes[name] = write

    def to_parquet(frame: DataFrame, path: str) -> Callable[[], object]:
        return lambda: frame.write.mode("overwrite").parquet(path)

    for name, result in results.items():
        path = posixpath.join(base, name)
        if isinstance(result, DataFrame):
            add(name, "table", path, to_parquet(result, path))
        elif isinstance(result, Mapping) and any(isinstance(v, DataFrame) for v in result.values()):
            for inner, frame in result.items():
                inner_path = posixpath.join(path, inner)
                add(f"{name}/{inner}", "table", inner_path, to_parquet(frame, inner_path))
        elif isinstance(result, Mapping) and result:
            row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in result.items()]).coalesce(1)
            add(name, "values", f"{path}.json", lambda r=row, p=path: r.write.mode("overwrite").json(f"{p}.json"))
        else:
            written.append((name, "skipped", None))
    for error in side_by_side(spark, writes).values():
        if error is not None:
            raise error
    return spark.createDataFrame(written, "name string, kind string, path string")


def export_tables(
    df: DataFrame, tables: Mapping[str, Callable[[DataFrame], DataFrame]], base: str
) -> DataFrame:
    """Compute and write each table on its own; a failing one does not stop the others.

    Returns name, path (NULL on failure) and error (NULL on success).
    """
    paths = {name: posixpath.join(base, f"metrics_{name}") for name in tables}
    writes = {
        name: (lambda build=build, path=paths[name]: build(df).write.mode("overwrite").parquet(path))
        for name, build in tables.items()
    }
    errors = side_by_side(df.sparkSession, writes)
    status = [
        (name, paths[name], None) if error is None else (name, None, f"{type(error).__name__}: {error}")
        for name, error in errors.items()
    ]
    return df.sparkSession.createDataFrame(status, "name string, path string, error string")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, frame in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in memory or on disk while several outputs are written from it."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def next_attempt(spark: SparkSession, base: str, run_id: str) -> int:
    """1 for a new run id, otherwise one more than its last recorded attempt."""
    try:
        records = read_run_records(spark, base)
        return (records.where(F.col("run_id") == run_id).agg(F.max("attempt")).first()[0] or 0) + 1
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 1


def append_run_records(spark: SparkSession, base: str, records: list[tuple]) -> str:
    """Append ``(run_id, attempt, stage, metric, value, note)`` rows with the current time."""
    path = posixpath.join(base, "run_records")
    rows = spark.createDataFrame(
        records, "run_id string, attempt int, stage string, metric string, value double, note string"
    ).withColumn("ts", F.current_timestamp())
    append_log(rows, path, RUN_RECORD_SCHEMA)
    return path


def read_run_records(spark: SparkSession, base: str) -> DataFrame:
    return read_log(spark, posixpath.join(base, "run_records"), RUN_RECORD_SCHEMA)
