"""``spark-submit`` entry point of the feed job. A failed run ends with a non-zero exit code."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import functions as F

from feedquality.model import TableModel
from feedquality.plans.job import FeedSpec, JobSpec, run_job
from feedquality.rules import RuleSet
from feedquality.session import session_builder, size_shuffles, staging
from feedquality.sinks.writers import SinkSpec, sink_for
from feedquality.sources.feeds import feed_listing, require_feed, sources_from


def parser() -> argparse.ArgumentParser:
    # The option names up to create_disposition.
    p = argparse.ArgumentParser(prog="feedquality", description="Check, clean and total two feeds.")
    p.add_argument("--app_name", default="feedquality")
    p.add_argument("--input_path", required=True, help="dimension feed,fact feed")
    p.add_argument("--sink", required=True, choices=["file", "bq", "mongo", "table"])
    p.add_argument("--output_path", required=True)
    p.add_argument("--connection_uri")
    p.add_argument("--write_disposition")
    p.add_argument("--create_disposition")
    p.add_argument("--file_format", help="format of a file sink; default: the extension of output_path")
    p.add_argument("--models", required=True, help="dimension model,fact model (JSON files)")
    p.add_argument("--suites", required=True, help="dimension suite,fact suite (JSON files)")
    p.add_argument("--names", default="users,purchase", help="names of the two feeds")
    p.add_argument("--read_mode", default="declared", choices=["declared", "infer"])
    p.add_argument("--discard_mode", default="predicate", choices=["predicate", "by_value"])
    p.add_argument("--key", default="user_id")
    p.add_argument("--measure", default="Quantity")
    p.add_argument("--group", default="user_address")
    p.add_argument("--report_path", help="write the quality reports here, as JSON")
    p.add_argument("--quarantine_path", help="write rejected rows below here, one folder per feed, as JSON")
    p.add_argument("--run_id", help="name of this run; a second run of the name replaces what the first one appended")
    p.add_argument("--max_corrupt", type=float, help="share of a declared feed's lines that may be unparsable")
    return p


def _two(p: argparse.ArgumentParser, option: str, text: str) -> list[str]:
    parts = [t.strip() for t in text.split(",")]
    if len(parts) != 2:
        p.error(f"--{option} needs two entries, got {len(parts)}")
    return parts


def job_spec(argv: Sequence[str] | None = None) -> tuple[str, JobSpec]:
    """Application name and job of a command line. Needs a running session for the types."""
    p = parser()
    a = p.parse_args(argv)
    names = _two(p, "names", a.names)
    _two(p, "input_path", a.input_path)
    models = {n: TableModel.from_json(path, n) for n, path in zip(names, _two(p, "models", a.models))}
    sources = sources_from(a.input_path, names, schemas={n: m.schema for n, m in models.items()}, mode=a.read_mode)
    feeds = [FeedSpec(sources[n], models[n], RuleSet.from_json(path))
             for n, path in zip(names, _two(p, "suites", a.suites))]
    quarantine = {n: SinkSpec("json", f"{a.quarantine_path.rstrip('/')}/{n}", mode=a.write_disposition, run_id=a.run_id)
                  for n in names} if a.quarantine_path else {}
    return a.app_name, JobSpec(
        dimension=feeds[0], fact=feeds[1], key=a.key, measure=a.measure, group=a.group, mode=a.discard_mode,
        sink=sink_for(a.sink, a.output_path, a.file_format, a.connection_uri,
                      a.write_disposition, a.create_disposition, a.run_id),
        reports=SinkSpec("json", a.report_path, mode=a.write_disposition, run_id=a.run_id) if a.report_path else None,
        quarantine=quarantine, max_corrupt=a.max_corrupt)


def main(argv: Sequence[str] | None = None) -> None:
    spark = session_builder(parser().parse_args(argv).app_name).getOrCreate()
    try:
        _, spec = job_spec(argv)
        paths = [f.source.path for f in (spec.dimension, spec.fact)]
        for path in paths:
            require_feed(spark, path)
        size_shuffles(spark, feed_listing(spark, paths).agg(F.sum("length")).first()[0])
        with staging(spark):
            run_job(spark, spec)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
