"""Every registered query against its SQL, and the entry points."""

import importlib

import pytest

from verify.check import compare, connect
from verify.registry import CASES

pytestmark = pytest.mark.tables


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


@pytest.mark.parametrize("case", CASES, ids=lambda c: c.name)
def test_query_agrees_with_sql(spark, connection, folder, case):
    problem, _ = compare(spark, connection, case, folder)
    assert problem is None


def test_names_are_unique():
    assert len({c.name for c in CASES}) == len(CASES)


def test_entry_points(spark, folder):
    module = importlib.import_module("__spark_entry__")
    rows = module.entry(spark).collect()
    assert len(rows) == 10 and [r["rank"] for r in rows] == list(range(1, 11))
    assert set(module.oracle_sql()) <= set(module.queries())


def test_failed_run_is_recorded(spark, folder, monkeypatch):
    from recordwise.operators.sizing import fresh_path
    from recordwise.plans import batch
    from verify.base import raw

    def broken(*_):
        raise ValueError("no quality today")

    monkeypatch.setattr(batch, "quality_stage", broken)
    config = batch.RunConfig(as_of="2000-01-01", years=(1999,))
    records = batch.run_batch(spark, raw(spark, folder), fresh_path(spark, "t"), "r1", config)
    outcome = {r["stage"]: (r["value"], r["note"]) for r in records.where("metric = 'succeeded'").collect()}
    assert list(sorted(outcome)) == ["clean", "features", "ingest", "quality"]
    assert outcome["features"] == (1.0, None)
    assert outcome["quality"] == (0.0, "ValueError: no quality today")


def test_settings_dictionary():
    from recordwise.plans.batch import RunConfig
    from recordwise.plans.rankings import RANKINGS

    settings = {
        "processing": {"columns_to_drop": ["homepage"], "replacements": {"placeholder_values": ["N/A"], "zero_to_null": ["budget"]}},
        "kpis": {"rankings": {"top_n": 3, "metrics": [{"name": "x", "column": "roi"}]}, "director": {"min_movies": 2}},
        "queries": {"search_1": {"cast": "Someone"}},
        "validation": {"ranges": {"vote_average": {"min": 0, "max": 10}}},
        "output": {"partitioning": {"columns": ["decade"]}},
        "testing": {"data_validation": {"checks": [{"name": "null_check", "columns": ["id"]}]}},
    }
    config = RunConfig.from_dict(settings)
    assert (config.ranked, config.min_director_movies, config.dropped) == (3, 2, ["homepage"])
    assert config.rankings[0]["name"] == "x" and config.genre_cast_search == {"cast": "Someone"}
    assert config.declared_checks and config.ranges and config.partition_by == ["decade"]
    assert config.repairs == {"placeholders": ["N/A"], "zero_columns": ["budget"]}
    # the rest of a full settings file: what a run has no use for is passed over, not refused
    full = {
        "api": {"timeout": 30}, "data": {"movie_ids": [1]}, "spark": {"config": {"spark.sql.adaptive.enabled": "true"}},
        "processing": {"json_columns": ["genres"], "quality": {"min_non_null_columns": 10, "min_budget_for_roi": 10.0, "min_votes_for_rating": 10}},
        "kpis": {"director": {"min_movies": 1, "metrics": ["total_movies"]}, "franchise": {"metrics": ["roi"], "aggregations": ["mean"]}},
        "queries": {"search_2": {"cast": "A", "director": "B", "sort_by": "runtime", "ascending": True}},
        "visualization": {"output_format": "html", "charts": [{"type": "scatter", "x": "budget_musd", "y": "revenue_musd"}]},
        "output": {"base_path": "/x", "formats": ["parquet"], "partitioning": {"enabled": True, "columns": ["decade"]}, "reports": {"format": "html"}},
        "logging": {"level": "INFO"}, "monitoring": {"enabled": True, "metrics": ["record_count"], "alerts": {"email": {"enabled": False}}},
        "testing": {"data_validation": {"enabled": False, "checks": [{"name": "null_check", "columns": ["id"]}]}},
    }
    config = RunConfig.from_dict(full)
    assert (config.check_data, list(config.monitored), config.director_metrics) == (False, ["record_count"], ["total_movies"])
    assert RunConfig.from_dict({"monitoring": {"enabled": False, "metrics": ["x"]}}).monitored == ()
    empty = RunConfig.from_dict({})
    assert empty.rankings is RANKINGS and empty.years is None and empty.min_health_score == 80
    with pytest.raises(ValueError, match="processing.typo"):
        RunConfig.from_dict({"processing": {"typo": 1}})


def test_failed_tables_show_and_a_later_attempt_counts_alone(spark, folder, monkeypatch):
    from recordwise.operators.sizing import fresh_path
    from recordwise.plans import batch, metrics
    from verify.base import raw

    base, rows = fresh_path(spark, "t"), raw(spark, folder).limit(200)
    config = batch.RunConfig(as_of="2000-01-01", years=(1999,))
    with monkeypatch.context() as patch:
        patch.setitem(metrics.METRIC_TABLES, "broken", lambda df: df.select("absent"))
        first = {(r["stage"], r["metric"]): r["value"] for r in batch.run_batch(spark, rows, base, "r", config).collect()}
    assert (first["metrics", "succeeded"], first["metrics", "failed_tables"], first["charts", "succeeded"]) == (0.0, 1.0, 1.0)
    second = batch.run_batch(spark, rows, base, "r", config)
    assert {r["attempt"] for r in second.collect()} == {2}
    assert second.where("metric = 'succeeded' and value = 0").count() == 0


def test_command_line(spark, folder, capsys):
    from recordwise.__main__ import main
    from recordwise.operators.sizing import fresh_path
    from verify.base import raw

    landed, base, out = (fresh_path(spark, name) for name in ("landed", "base", "out"))
    raw(spark, folder).limit(300).write.parquet(landed)
    assert main(["run", "--raw", landed, "--base", base, "--run-id", "r1"]) == 0
    assert main(["charts", "--base", base, "--out", out]) == 0
    assert spark.read.parquet(f"{out}/executive_kpis").count() == 1
    assert spark.read.json(f"{base}/reports/run_id=r1/kpi_rows.json").count() == 19


def test_sparse_rows_and_unmeasured_metrics(spark, folder):
    from recordwise.operators.sizing import fresh_path
    from recordwise.plans import batch
    from recordwise.sources import storage
    from verify.base import raw

    base, rows = fresh_path(spark, "t"), raw(spark, folder).limit(60)
    checks = [{"name": "null_check", "columns": ["backdrop_path"]}]
    config = batch.RunConfig(as_of="2000-01-01", max_null_columns=1, monitored=("rows_with_many_nulls", "lag"), declared_checks=checks, check_data=False)
    batch.ingest(spark, rows, base, "r")
    batch.clean_stage(spark, base, "r", config)
    batch.feature_stage(spark, base, "r", config)
    facts = batch.quality_stage(spark, base, "r", config)
    table = storage.read_stage(spark, base, batch.FEATURES, "r").collect()
    sparse = {r["id"]: sum(v is None for v in r) for r in table if sum(v is None for v in r) > 1}
    assert facts["rows_with_many_nulls"] == len(sparse)
    assert {r["id"]: r["null_columns"] for r in storage.read_stage(spark, base, batch.SPARSE, "r").collect()} == sparse
    assert storage.read_stage(spark, base, batch.QUALITY, "r").where("check = 'null_check'").count() == 0
