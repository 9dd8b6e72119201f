"""What the jobs' command lines share: settings from a config file, a log, a session that ends with the job."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

log = logging.getLogger("jobs")


def settings(config: str, defaults: dict, given: dict) -> dict:
    """Settings of a config file over defaults, and what the command line gives over these. Names that the job doesn't know are an error."""
    found = json.loads(Path(config).read_text())
    if unknown := sorted(set(found) - set(defaults)):
        raise ValueError(f"{config}: unknown settings {', '.join(unknown)}")
    return defaults | found | {k: v for k, v in given.items() if v is not None}


def main(name: str, run: Callable[..., object], defaults: dict) -> None:
    """Reads arguments, runs a job in a session of its own, and stops it. A submitter's settings of Spark stand."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=run.__doc__)
    parser.add_argument("--config", default=str(Path(__file__).with_name(f"{name}.json")), help="settings in JSON")
    for key in ("tables", "out"):
        parser.add_argument(f"--{key}", help=f"in place of the config's {key}")
    given = vars(parser.parse_args())
    chosen = settings(given.pop("config"), defaults, given)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        log.info("%s with %s", name, json.dumps(chosen))
        run(spark, **chosen)
    finally:
        spark.stop()
