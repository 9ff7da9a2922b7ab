"""The full batch run: raw records to stage tables, reports and run records.

Every stage reads what the stage before it wrote, so a lost executor costs at most the
stage at work, and a run can be taken up again from any stage table.
"""

from __future__ import annotations

import posixpath
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordwise.operators import cleaning, features, quality
from recordwise.plans import dashboards, kpis, metrics, searches
from recordwise.plans.rankings import RANKINGS
from recordwise.sources import storage
from recordwise.sources.records import RECORD_SCHEMA, read_records

CLEANED, FEATURES, QUALITY, SPARSE = "cleaned", "features", "quality", "sparse_rows"


@dataclass
class RunConfig:
    """Parameters of a run; rules and searches are plain dictionaries.

    ``as_of`` is the day against which future dates are judged, by default today.
    ``years`` are the columns of the rating matrix; without them it comes as rows. ``repairs`` are
    the arguments of the missing-value repair, ``partition_by`` the columns of the feature table,
    ``formats`` the copies of it (Parquet is always written). ``franchise`` names columns and aggregations of
    the collection matrix, ``charts`` further charts. The two floors apply to rankings by return and by
    rating that have no filter of their own. ``declared_checks`` run only with ``check_data``. Rows with more than
    ``max_null_columns`` NULL columns are counted and listed where that number is given. ``monitored`` names the
    metrics that the run must have measured, ``director_metrics`` the columns of the directors' table.
    """

    as_of: str | None = None
    years: Sequence[int] | None = None
    dropped: Sequence[str] = ()
    repairs: Mapping = field(default_factory=dict)
    partition_by: Sequence[str] = ("release_year",)
    formats: Sequence[str] = ("parquet", "csv")
    franchise: Mapping = field(default_factory=dict)
    charts: Sequence[Mapping] = ()
    min_budget_for_roi: float | None = None
    min_votes_for_rating: float | None = None
    ranges: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    patterns: Mapping[str, str] = field(default_factory=dict)
    declared_checks: Sequence[Mapping] = ()
    check_data: bool = True
    max_null_columns: int | None = None
    monitored: Sequence[str] = ()
    director_metrics: Sequence[str] = ()
    min_health_score: float = quality.MIN_HEALTH_SCORE
    rankings: Sequence[Mapping] = RANKINGS
    ranked: int = 10
    min_director_movies: int = 1
    genre_cast_search: Mapping = field(default_factory=dict)
    cast_director_search: Mapping = field(default_factory=dict)

    @classmethod
    def from_dict(cls, settings: Mapping) -> RunConfig:
        """Take what a nested settings dictionary names; the rest keeps its default, an unknown name is an error."""
        given = {}
        for path, value in _leaves(settings):
            if path[0] in ELSEWHERE or path[:2] in ELSEWHERE:
                continue
            if path not in SETTINGS:
                raise ValueError(f"unknown setting {'.'.join(path)!r}")
            target, *inner = SETTINGS[path]
            if inner:
                given.setdefault(target, {})[inner[0]] = value
            else:
                given[target] = value
        if not given.pop("partitioned", True):
            given["partition_by"] = ()
        if not given.pop("monitors", True):
            given["monitored"] = ()
        return cls(**given)

    def ranked_specs(self) -> list[Mapping]:
        """The rankings, with the floors where a ranking has no filter of its own."""
        floors = {"roi": ("budget_musd", self.min_budget_for_roi), "vote_average": ("vote_count", self.min_votes_for_rating)}
        specs = []
        for spec in self.rankings:
            column, least = floors.get(spec["column"], (None, None))
            specs.append({**spec, "filter": f"{column} >= {least}"} if least is not None and not spec.get("filter") else spec)
        return specs


# Settings by their path: the parameter of a run, and the key within it where it is a dictionary.
SETTINGS = {
    ("processing", "columns_to_drop"): ("dropped",),
    ("processing", "replacements", "zero_to_null"): ("repairs", "zero_columns"),
    ("processing", "replacements", "placeholder_columns"): ("repairs", "placeholder_columns"),
    ("processing", "replacements", "placeholder_values"): ("repairs", "placeholders"),
    ("processing", "quality", "min_non_null_columns"): ("repairs", "min_values"),
    ("processing", "quality", "min_budget_for_roi"): ("min_budget_for_roi",),
    ("processing", "quality", "min_votes_for_rating"): ("min_votes_for_rating",),
    ("output", "partitioning", "columns"): ("partition_by",),
    ("output", "partitioning", "enabled"): ("partitioned",),
    ("output", "formats"): ("formats",),
    ("kpis", "franchise", "metrics"): ("franchise", "columns"),
    ("kpis", "franchise", "aggregations"): ("franchise", "aggregations"),
    ("visualization", "charts"): ("charts",),
    ("validation", "ranges"): ("ranges",),
    ("validation", "patterns"): ("patterns",),
    ("testing", "data_validation", "checks"): ("declared_checks",),
    ("testing", "data_validation", "enabled"): ("check_data",),
    ("validation", "min_health_score"): ("min_health_score",),
    ("validation", "max_null_columns"): ("max_null_columns",),
    ("monitoring", "enabled"): ("monitors",),
    ("monitoring", "metrics"): ("monitored",),
    ("kpis", "director", "metrics"): ("director_metrics",),
    ("kpis", "rankings", "metrics"): ("rankings",),
    ("kpis", "rankings", "top_n"): ("ranked",),
    ("kpis", "director", "min_movies"): ("min_director_movies",),
    ("queries", "search_1"): ("genre_cast_search",),
    ("queries", "search_2"): ("cast_director_search",),
}


# Settings of other parts: the client, the session, logging, alerts, drawing. The record schema fixes the JSON columns.
ELSEWHERE = {
    "api", "data", "spark", "logging", ("monitoring", "alerts"), ("visualization", "output_format"), ("output", "base_path"),
    ("output", "reports"), ("processing", "json_columns"),
}


def _leaves(settings: Mapping, path: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], object]]:
    """The named settings; a dictionary that is itself a value is not entered."""
    found = []
    for name, value in settings.items():
        here = (*path, name)
        if here not in SETTINGS and isinstance(value, Mapping):
            found += _leaves(value, here)
        else:
            found.append((here, value))
    return found


def _run_folder(base: str, kind: str, run_id: str, *rest: str) -> str:
    return posixpath.join(base, kind, f"run_id={run_id}", *rest)


def _counted(df: DataFrame, write: Callable[[DataFrame], object]) -> int:
    """Rows of ``df``, counted by the write itself."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def ingest(spark: SparkSession, raw: DataFrame, base: str, run_id: str) -> dict[str, float]:
    return {"record_count": _counted(raw, lambda rows: storage.write_raw(rows, base, run_id))}


def clean_stage(spark: SparkSession, base: str, run_id: str, config: RunConfig) -> dict[str, float]:
    raw = read_records(spark, storage.raw_path(base, run_id), schema=RECORD_SCHEMA)
    rows = _counted(cleaning.clean(raw, config.dropped, settle_repeated=True, **config.repairs), lambda df: storage.write_stage(df, base, CLEANED, run_id))
    return {"record_count": rows}


def feature_stage(spark: SparkSession, base: str, run_id: str, config: RunConfig) -> dict[str, float]:
    cleaned = storage.read_stage(spark, base, CLEANED, run_id)
    rows = _counted(
        features.derive_features(cleaned),
        lambda df: storage.write_stage(df, base, FEATURES, run_id, tuple(config.partition_by)),
    )
    table = storage.read_stage(spark, base, FEATURES, run_id)
    flat = cleaning.join_names(table, {"cast": None})
    unknown = set(config.formats) - {"parquet", "csv", "json"}
    if unknown:
        raise ValueError(f"unknown output formats {sorted(unknown)}")
    if "csv" in config.formats:
        storage.write_csv(flat, _run_folder(base, "csv", run_id, FEATURES))
    if "json" in config.formats:
        storage.write_json(table, _run_folder(base, "json", run_id, FEATURES))
    return {"record_count": rows}


def quality_stage(spark: SparkSession, base: str, run_id: str, config: RunConfig) -> dict[str, float]:
    table = storage.read_stage(spark, base, FEATURES, run_id)
    report = quality.quality_report(table, config.as_of, ranges=config.ranges, patterns=config.patterns)
    if config.declared_checks and config.check_data:
        report = report.unionByName(quality.declared_checks(table, config.declared_checks))
    storage.write_stage(report, base, QUALITY, run_id)
    written = storage.read_stage(spark, base, QUALITY, run_id)
    # a few rows per column: one file for reading by eye
    written.coalesce(1).write.mode("overwrite").json(_run_folder(base, "reports", run_id, "quality.json"))
    score = quality.health_score(written, config.min_health_score).first()
    null_share = written.where("metric = 'completeness_percentage'").agg(100 - F.avg("value")).first()[0]
    facts = {
        "data_quality_score": score["health_score"],
        "healthy": float(score["healthy"]),
        "null_percentage": null_share,
    }
    if config.max_null_columns is not None:
        sparse = quality.rows_with_many_nulls(table, config.max_null_columns).select("id", "null_columns")
        facts["rows_with_many_nulls"] = _counted(sparse, lambda rows: storage.write_stage(rows, base, SPARSE, run_id))
    return facts


def report_stage(spark: SparkSession, base: str, run_id: str, config: RunConfig) -> dict[str, float]:
    """KPI tables with a summary of their row counts, and each ranking as one CSV file."""
    table = storage.read_stage(spark, base, FEATURES, run_id)
    results = kpis.all_kpis(table, config.ranked, config.ranked_specs(), config.min_director_movies)
    results |= kpis.plain_kpis(table, config.min_director_movies)
    if config.director_metrics:
        results["top_directors"] = results["top_directors"].select("director", *config.director_metrics)
    if config.franchise:
        results["franchise_matrix"] = kpis.franchise_matrix(table, **config.franchise)
    folder = _run_folder(base, "kpis", run_id)
    saved = storage.save_results(spark, results, folder)
    written = {name: spark.read.parquet(posixpath.join(folder, "rankings", name)) for name in results["rankings"]}
    csv = _run_folder(base, "csv", run_id)
    errors = storage.side_by_side(
        spark,
        {
            name: (lambda name=name, rows=rows: storage.write_csv(rows, posixpath.join(csv, name), True))
            for name, rows in written.items()
        },
    )
    for error in errors.values():
        if error is not None:
            raise error
    tables = {row["name"]: row["path"] for row in saved.where("kind = 'table'").collect()}
    counts = storage.row_counts({name: spark.read.parquet(path) for name, path in tables.items()})
    counts.coalesce(1).write.mode("overwrite").json(_run_folder(base, "reports", run_id, "kpi_rows.json"))
    return {"tables": len(tables)}


def metric_stage(spark: SparkSession, base: str, run_id: str) -> dict[str, float]:
    table = storage.read_stage(spark, base, FEATURES, run_id)
    builders = dict(metrics.METRIC_TABLES)
    try:  # the plain tables share one scan; should one of them fail, each is computed on its own and fails alone
        builders |= {name: (lambda _, rows=rows: rows) for name, rows in metrics.plain_tables(table).items() if name in builders}
    except PySparkException:
        pass
    status = storage.export_tables(table, builders, _run_folder(base, "metrics", run_id))
    failed = [f"{r['name']}: {r['error']}" for r in status.where("error is not null").collect()]
    facts = {"tables": status.count() - len(failed), "failed_tables": len(failed)}
    return facts | ({"failure": "; ".join(failed)} if failed else {})


def search_stage(spark: SparkSession, base: str, run_id: str, config: RunConfig) -> dict[str, float]:
    table = storage.read_stage(spark, base, FEATURES, run_id)
    found = {
        "genre_cast": searches.genre_cast_search(table, config.genre_cast_search),
        "cast_director": searches.cast_director_search(table, config.cast_director_search),
    }
    folder = _run_folder(base, "csv", run_id)
    counts = {}
    for name, rows in found.items():
        flat = cleaning.join_names(rows, {"cast": None})
        path = posixpath.join(folder, f"search_{name}")
        counts[f"{name}_found"] = _counted(flat, lambda df: storage.write_csv(df, path))
    return counts


def chart_stage(spark: SparkSession, base: str, run_id: str, config: RunConfig) -> dict[str, float]:
    table = storage.read_stage(spark, base, FEATURES, run_id)
    datasets = dashboards.all_datasets(table, config.years)
    datasets |= {f"declared_{dashboards.chart_name(spec)}": dashboards.declared_chart(table, spec) for spec in config.charts}
    for spec in config.charts:
        datasets |= {f"declared_{dashboards.chart_name(spec)}_{name}": cells for name, cells in dashboards.declared_cells(table, spec).items()}
    saved = storage.save_results(spark, datasets, _run_folder(base, "charts", run_id))
    return {"tables": saved.where("kind = 'table'").count()}


STAGE_TABLES = {"clean": (CLEANED,), "features": (FEATURES,), "quality": (QUALITY,)}


def monitored_metrics(spark: SparkSession, base: str, run_id: str, config: RunConfig) -> DataFrame:
    """The run records of the monitored metrics in a run's last attempt; NULL with a note for what no stage measured."""
    records = storage.read_run_records(spark, base).where(F.col("run_id") == run_id)
    last = records.agg(F.max("attempt")).scalar()
    return records.where((F.col("attempt") == last) & F.col("metric").isin(list(config.monitored)))


def run_batch(spark: SparkSession, raw: DataFrame, base: str, run_id: str, config: RunConfig) -> DataFrame:
    """Run all stages and return the run records of this attempt.

    A failing stage is recorded with its error and ends the run; what earlier stages wrote
    stays. Failed metric tables fail their stage too, but the other tables and the stages that
    don't need them are still written. A monitored metric that no stage measured is recorded as such.
    """
    stages: dict[str, Callable[[], dict]] = {
        "ingest": lambda: ingest(spark, raw, base, run_id),
        "clean": lambda: clean_stage(spark, base, run_id, config),
        "features": lambda: feature_stage(spark, base, run_id, config),
        "quality": lambda: quality_stage(spark, base, run_id, config),
        "kpis": lambda: report_stage(spark, base, run_id, config),
        "metrics": lambda: metric_stage(spark, base, run_id),
        "searches": lambda: search_stage(spark, base, run_id, config),
        "charts": lambda: chart_stage(spark, base, run_id, config),
    }
    records, attempt = [], storage.next_attempt(spark, base, run_id)
    for stage, work in stages.items():
        started = time.monotonic()
        broken = None
        try:
            facts = dict(work())
        except Exception as failure:  # recorded below; later stages need this one
            broken, facts = f"{type(failure).__name__}: {failure}", {}
        error = facts.pop("failure", broken)
        facts = {**facts, "execution_time": time.monotonic() - started, "succeeded": float(error is None)}
        records += [
            (run_id, attempt, stage, metric, None if value is None else float(value), error if metric == "succeeded" else None)
            for metric, value in facts.items()
        ]
        if broken:
            break
        for table in STAGE_TABLES.get(stage, ()):
            storage.remove_superseded(spark, base, table, run_id)
    measured = {record[3] for record in records}
    records += [(run_id, attempt, "monitoring", name, None, "not measured") for name in config.monitored if name not in measured]
    storage.append_run_records(spark, base, records)
    return storage.read_run_records(spark, base).where((F.col("run_id") == run_id) & (F.col("attempt") == attempt))
