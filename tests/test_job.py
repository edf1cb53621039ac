from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from feedquality import (CorruptFeedError, EmptyFeedError, FeedSpec, JobSpec, MissingFeedError, SchemaMismatchError, SinkSpec,
                         SourceSpec, run_job)
from feedquality.__main__ import job_spec
from feedquality.plans.queries import PURCHASE_MODEL, USER_MODEL, rule
from tests.fixtures import PURCHASES, USERS, models, suites, write_lines

ROOT = Path(__file__).parent.parent


def spec(paths, mode="declared", **options):
    feeds = [FeedSpec(SourceSpec(str(p), schema=m.schema, mode=mode), m, r)
             for p, m, r in zip(paths, models(), suites())]
    return JobSpec(*feeds, **options)


@pytest.fixture()
def paths(tmp_path):
    return write_lines(tmp_path / "users.json", USERS), write_lines(tmp_path / "purchase.json", PURCHASES)


@pytest.mark.parametrize("mode", ["declared", "infer"])
def test_totals_per_address(spark, paths, mode):
    result = run_job(spark, spec(paths, mode)).result
    assert result.schema.simpleString() == "struct<user_address:struct<city:string,state:string>,Quantity:bigint>"
    assert [(tuple(r["user_address"]), r["Quantity"]) for r in result.collect()] == [(("Pune", "MH"), 10)]


def test_by_value_loses_everything(spark, paths):
    job = spec(paths)
    assert run_job(spark, JobSpec(job.dimension, job.fact, mode="by_value")).result.isEmpty()


def test_sinks_of_a_run(spark, paths, tmp_path):
    Path(paths[1]).write_text(Path(paths[1]).read_text() + "{bad\n")
    result = run_job(spark, spec(
        paths, sink=SinkSpec("json", str(tmp_path / "out")), reports=SinkSpec("parquet", str(tmp_path / "reports")),
        quarantine={n: SinkSpec("json", str(tmp_path / n)) for n in ("users", "purchase")}))
    assert spark.read.json(str(tmp_path / "out")).select("user_address.city", "Quantity").collect() == [("Pune", 10)]
    reports = spark.read.parquet(str(tmp_path / "reports"))
    assert reports.count() == 13 and reports.where("not success").count() == 6
    assert {r["feed"] for r in reports.collect()} == {"users", "purchase"}
    rejected = spark.read.json(str(tmp_path / "purchase"))
    assert rejected.count() == 4
    assert rejected.where("raw_record = '{bad'").select("failed_rules").first()[0] == ["corrupt_record"]
    assert spark.read.json(str(tmp_path / "users")).count() == 3
    assert set(result.cleaned) == {"users", "purchase"}


def test_a_bad_feed_stops_the_run(spark, paths, tmp_path):
    (tmp_path / "empty.json").write_text("")
    with pytest.raises(EmptyFeedError):
        run_job(spark, spec((paths[0], tmp_path / "empty.json")))
    with pytest.raises(MissingFeedError):
        run_job(spark, spec((paths[0], tmp_path / "missing.json")))
    extra = write_lines(tmp_path / "extra.json", [{**r, "Note": 1} for r in PURCHASES])
    with pytest.raises(SchemaMismatchError, match="purchase.Note"):
        run_job(spark, spec((paths[0], extra), "infer", sink=SinkSpec("json", str(tmp_path / "never"))))
    assert not (tmp_path / "never").exists()


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan json"), plan.count("FileScan parquet")


def test_feeds_are_parsed_once(spark, paths, tmp_path):
    assert scans(run_job(spark, spec(paths)).result) == (0, 2)
    assert scans(run_job(spark, spec(paths, "infer")).result) == (2, 0)
    again = spec(paths, "infer", quarantine={"purchase": SinkSpec("json", str(tmp_path / "q"))})
    assert again.rereads(again.fact) and not again.rereads(again.dimension)
    assert scans(run_job(spark, again).result) == (1, 1)


def test_a_line_is_corrupt_whatever_columns_are_used(spark, paths):
    """The total needs neither date nor price, but the broken price still takes the line out."""
    bad = json.dumps({**PURCHASES[0], "Quantity": 1000, "Unit_Price": [1]}).replace("[1]", "1.2.3")
    Path(paths[1]).write_text(Path(paths[1]).read_text() + bad + "\n")
    with pytest.raises(CorruptFeedError, match="purchase: 1 of 8"):
        run_job(spark, spec(paths))
    result = run_job(spark, spec(paths, max_corrupt=0.2))
    assert result.result.first()["Quantity"] == 10
    assert result.corrupt["purchase"].count() == 1
    row = result.report.where("feed = 'purchase' and rule_id = 'corrupt_record'").first()
    assert (row["element_count"], row["unexpected_count"], row["success"]) == (8, 1, True)


def test_the_default_mode_refuses_what_is_no_feed_of_the_model(spark, paths, tmp_path):
    (tmp_path / "broken.json").write_text("{bad\n" * 5)
    without = write_lines(tmp_path / "without.json", [{k: v for k, v in r.items() if k != "Quantity"} for r in PURCHASES])
    extra = write_lines(tmp_path / "extra.json", [*PURCHASES, {**PURCHASES[0], "Note": 1}])
    for path, column in ((tmp_path / "broken.json", "Date"), (without, "Quantity"), (extra, "Note")):
        with pytest.raises(SchemaMismatchError, match=f"purchase.{column}"):
            run_job(spark, spec((paths[0], path), sink=SinkSpec("json", str(tmp_path / "never"))))
    assert not (tmp_path / "never").exists()


def test_failed_rules_are_logged_without_a_report(spark, paths, caplog):
    run_job(spark, spec(paths))
    assert any("rule" in r.message and "failed" in r.message for r in caplog.records)


def test_a_second_run_appends_everywhere(spark, paths, tmp_path):
    _, job = job_spec(arguments(paths, tmp_path, write_disposition="append", quarantine_path=str(tmp_path / "q"),
                                report_path=str(tmp_path / "r")))
    for runs in (1, 2):
        run_job(spark, job)
        assert spark.read.json(str(tmp_path / "out.json")).count() == runs
        assert spark.read.json(str(tmp_path / "q" / "users")).count() == 3 * runs


def test_a_repeated_user_counts_once_per_repetition(spark, paths):
    write_lines(Path(paths[0]), [*USERS, USERS[0]])
    assert run_job(spark, spec(paths)).result.first()["Quantity"] == 15


def arguments(paths, tmp_path, **options):
    for name, config in (("um.json", USER_MODEL), ("pm.json", PURCHASE_MODEL)):
        (tmp_path / name).write_text(json.dumps(config))
    base = [rule("ColumnValuesToNotBeNull", "user_id", mostly=1), rule("ColumnValueLengthsToEqual", "user_id", value=3)]
    for name, rules in (("us.json", [*base, rule("ColumnValuesToNotBeNull", "user_address")]),
                        ("ps.json", [*base, rule("ColumnValuesToNotBeNull", "Quantity")])):
        (tmp_path / name).write_text(json.dumps({"expectation_suite_name": name, "expectations": rules}))
    given = {"app_name": "totals", "input_path": ",".join(paths), "sink": "file",
             "output_path": str(tmp_path / "out.json"), "models": f"{tmp_path}/um.json,{tmp_path}/pm.json",
             "suites": f"{tmp_path}/us.json,{tmp_path}/ps.json", **options}
    return [x for k, v in given.items() for x in (f"--{k}", v)]


def test_command_line_options(spark, paths, tmp_path):
    name, job = job_spec(arguments(paths, tmp_path, sink="mongo", output_path="db.totals",
                                   connection_uri="mongodb://h:1/", write_disposition="append",
                                   create_disposition="create_if_needed"))
    assert name == "totals"
    assert job.sink.options == {"spark.mongodb.write.connection.uri": "mongodb://h:1/db.totals"}
    assert (job.dimension.model.name, job.fact.model.name) == ("users", "purchase")
    assert job.dimension.source.path == paths[0] and job.fact.source.mode == "declared"


def run(argv):
    return subprocess.run([sys.executable, "-m", "feedquality", *argv], cwd=ROOT, capture_output=True, text=True,
                          timeout=300, env={**os.environ, "PYTHONPATH": str(ROOT)})


def test_command_line_run(spark, paths, tmp_path):
    done = run(arguments(paths, tmp_path, quarantine_path=str(tmp_path / "q"), report_path=str(tmp_path / "r")))
    assert done.returncode == 0, done.stderr[-2000:]
    assert spark.read.json(str(tmp_path / "out.json")).select("Quantity").collect() == [(10,)]
    assert spark.read.json(str(tmp_path / "q" / "users")).count() == 3
    failed = run(arguments((paths[0], str(tmp_path / "missing.json")), tmp_path))
    assert failed.returncode != 0 and "MissingFeedError" in failed.stderr
