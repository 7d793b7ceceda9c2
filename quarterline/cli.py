"""bronze, silver, gold, and all three in order; each prints one JSON line per layer."""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from pyspark.sql import SparkSession

from quarterline.plans import layers
from quarterline.sources import store
from quarterline.sources.rows import read_json_array

_OBJECTS = {"bronze": ("bronze",), "silver": ("bronze", "silver"), "gold": ("silver", "gold"), "run-all": ("bronze", "silver", "gold")}


def _arguments(job: str, argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog=job)
    for name in ("catalog", "schema"):  # accepted for the job's sake; the objects' names are qualified
        parser.add_argument(f"--{name}", required=True)
    for layer in _OBJECTS[job]:
        parser.add_argument(f"--{layer}-object", required=True)
    if "bronze" in _OBJECTS[job][0] and job != "silver":
        parser.add_argument("--input-mode", required=True, choices=["fixture"])
        parser.add_argument("--input-fixture-path")
    return parser.parse_args(argv)


def _report(layer: str, result) -> None:
    print(json.dumps({"layer": layer, "status": "success", "metrics": asdict(result)}, default=str, sort_keys=True))


def run(job: str, argv: list[str] | None = None) -> None:
    """Layers of the job in order; the first failure ends it. One run at a time works on the same last object."""
    a = _arguments(job, argv)
    if job in ("bronze", "run-all") and not a.input_fixture_path:
        raise ValueError("Bronze requires --input-fixture-path with input mode fixture")
    spark = SparkSession.builder.getOrCreate()
    with store.exclusive(spark, getattr(a, f"{_OBJECTS[job][-1]}_object")):
        if job in ("bronze", "run-all"):
            _report("bronze", layers.load_bronze_observations(spark, read_json_array(a.input_fixture_path), a.bronze_object))
        if job in ("silver", "run-all"):
            _report("silver", layers.load_silver_observations(spark, a.bronze_object, a.silver_object))
        if job in ("gold", "run-all"):
            _report("gold", layers.load_gold_observations(spark, a.silver_object, a.gold_object))


def bronze(argv: list[str] | None = None) -> None:
    run("bronze", argv)


def silver(argv: list[str] | None = None) -> None:
    run("silver", argv)


def gold(argv: list[str] | None = None) -> None:
    run("gold", argv)


def run_all(argv: list[str] | None = None) -> None:
    run("run-all", argv)
