"""Command line: python -m tidemark.cli ingest|commit -c FILE -C FOLDER [--once]."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tidemark import __version__
from tidemark.plans.config import ConfigError, load
from tidemark.streaming.commit import Committer
from tidemark.streaming.ingest import Ingester
from tidemark.streaming.metrics import Metrics
from tidemark.streaming.polling import Stop, poll, run_side_by_side


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidemark")
    out.add_argument("stage", choices=["ingest", "commit"])
    out.add_argument("-c", "--config", action="append", default=[], help="a YAML file; may be repeated")
    out.add_argument("-C", "--config-dir", action="append", default=[], help="a folder of YAML files; may be repeated")
    out.add_argument("--once", action="store_true", help="one poll, then end")
    out.add_argument("--version", action="version", version=__version__)
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    given = parser().parse_args(args)
    try:
        config = load(given.config, given.config_dir)
    except ConfigError as error:
        print(error, file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName("tidemark").getOrCreate()
    metrics, stop = Metrics(), Stop()
    server = None if given.once else metrics.serve(config.metrics.address)
    if not given.once:
        stop.on_signals()
    runs = {}
    if given.stage == "ingest":
        for name, p in config.pipelines.items():
            interval = next(iter(p.sources.values())).poll_interval_secs
            runs[name] = lambda name=name, p=p, i=interval: _poll(Ingester(spark, name, p, metrics), i)
    else:
        for name, t in config.tables.items():
            runs[name] = lambda name=name, t=t: _poll(Committer(spark, name, t, metrics), t.poll_interval_secs)

    def _poll(worker, interval: float) -> int:
        step = worker.step if given.stage == "commit" else lambda: len(worker.step())
        return poll(step, interval, 0 if given.once else config.global_.poll_jitter_secs, stop, given.once)

    results = run_side_by_side(runs, config.global_.total_concurrency)
    if server:
        server.shutdown()
    for name, result in results.items():
        print(f"{name}: {result if isinstance(result, int) else f'failed: {result}'}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
