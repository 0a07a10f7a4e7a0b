"""Run stages of the harvest lakehouse: python -m granary BASE STAGE [STAGE ...]

Stages: land weather facts validate gold synthetic train analyse charts, or all (land only with --source).
Reports: keys, split, sources, export (with --target).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from granary.plans.harvest import HarvestLake
from granary.presets.harvest import SYNTHETIC_ROWS
from granary.sources.workspace import clear_scratch

STAGES = ("land", "weather", "facts", "validate", "gold", "synthetic", "train", "analyse", "charts")
REPORTS = ("keys", "split", "sources", "export")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="granary")
    parser.add_argument("base", help="folder that holds bronze and receives the other layers")
    parser.add_argument("stages", nargs="+", choices=[*STAGES, *REPORTS, "all"])
    parser.add_argument("--weather", default="bronze/weather")
    parser.add_argument("--facts", default="bronze/facts")
    parser.add_argument("--history", default="bronze/history")
    parser.add_argument("--source", help="folder of raw files to land")
    parser.add_argument("--folders", nargs="*", default=(), help="folders that the source must hold")
    parser.add_argument("--target", help="where to export gold")
    parser.add_argument("--rows", type=int, default=SYNTHETIC_ROWS, help="synthetic rows")
    parser.add_argument("--without-history", action="store_true", help="build gold from facts and weather")
    args = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("granary").getOrCreate()
    lake = HarvestLake(spark, args.base, args.weather, args.facts, args.history)
    run = {
        "land": lambda: lake.land(args.source, tuple(args.folders)).show(),
        "charts": lake.write_charts,
        "keys": lambda: lake.key_report().show(100, truncate=False),
        "split": lambda: lake.split_report().show(),
        "sources": lambda: lake.compare_sources().show(100, truncate=False),
        "export": lambda: lake.export_gold(args.target),
        "weather": lake.build_weather,
        "facts": lake.build_facts,
        "validate": lambda: lake.validate().show(100, truncate=False),
        "gold": lambda: lake.build_gold(not args.without_history).show(),
        "synthetic": lambda: lake.build_synthetic(args.rows),
        "train": lambda: lake.train().metrics.show(truncate=False),
        "analyse": lambda: lake.analyse()["summary"].show(100, truncate=False),
    }
    every = [s for s in STAGES if s != "land" or args.source]
    for stage in every if "all" in args.stages else args.stages:
        run[stage]()
    clear_scratch(spark)


if __name__ == "__main__":
    main()
