"""Command line of the daily run: ``python -m spendtide --help``.

Every setting of ``JobConfig`` is an option, so ``--no-load-data`` skips the load and
``--run-date 2024-05-23`` processes the day before that date.
"""

from __future__ import annotations

import argparse
from dataclasses import MISSING, fields
from datetime import date

from pyspark.sql import SparkSession

from spendtide.config import JobConfig
from spendtide.plans.daily_job import run


def parse(arguments: list[str] | None = None) -> JobConfig:
    parser = argparse.ArgumentParser(prog="spendtide")
    for f in fields(JobConfig):
        option = "--" + f.name.replace("_", "-")
        if "bool" in f.type:
            parser.add_argument(option, action=argparse.BooleanOptionalAction, default=f.default)
            continue
        kind = next((t for t in (date, float, int) if t.__name__ in f.type), str)
        parser.add_argument(
            option,
            type=date.fromisoformat if kind is date else kind,
            default=f.default_factory() if f.default is MISSING else f.default,
        )
    return JobConfig(**vars(parser.parse_args(arguments)))


def main(arguments: list[str] | None = None) -> None:
    cfg = parse(arguments)
    if not (cfg.fact_path and cfg.output_path):
        raise SystemExit("--fact-path and --output-path are needed")
    run(SparkSession.builder.appName("spendtide").getOrCreate(), cfg)


if __name__ == "__main__":
    main()
