"""Command line: a whole run, or the chart datasets of the latest run.

    python -m recordwise run --raw PATH --base PATH --run-id ID [--settings FILE.json]
    python -m recordwise charts --base PATH --out PATH
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from recordwise.plans import batch, dashboards
from recordwise.sources import storage
from recordwise.sources.records import read_records


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="recordwise")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="raw records to stage tables and reports")
    run.add_argument("--raw", required=True, help="landed raw records")
    run.add_argument("--format", default="parquet", choices=("parquet", "json"))
    run.add_argument("--base", required=True, help="output folder")
    run.add_argument("--run-id", required=True)
    run.add_argument("--settings", help="JSON file with nested settings")
    charts = commands.add_parser("charts", help="chart datasets of the latest run")
    charts.add_argument("--base", required=True, help="output folder of the runs")
    charts.add_argument("--out", required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    chosen = arguments(argv)
    spark = SparkSession.builder.appName("recordwise").getOrCreate()
    if chosen.command == "charts":
        table = storage.read_latest(spark, chosen.base, batch.FEATURES)
        storage.save_results(spark, dashboards.all_datasets(table), chosen.out)
        return 0
    settings = {}
    if chosen.settings:
        with open(chosen.settings) as file:
            settings = json.load(file)
    raw = read_records(spark, chosen.raw, chosen.format)
    records = batch.run_batch(spark, raw, chosen.base, chosen.run_id, batch.RunConfig.from_dict(settings))
    records.orderBy("ts", "stage", "metric").show(records.count(), truncate=False)
    return 0 if records.where("metric = 'succeeded'").agg(F.min("value")).first()[0] == 1.0 else 1


if __name__ == "__main__":
    raise SystemExit(main())
