"""The command line jobs, chained as a user would run them."""

import json

from pyspark.sql import functions as F

from jobsieve.__main__ import main
from jobsieve.plans.ingest import ingest_batch
from jobsieve.schemas import ENRICHED_POST, POST, POST_FIELDS
from jobsieve.sources import sinks


def post(**values):
    return {f: values.get(f, "x") for f in POST_FIELDS}


def test_landing_to_report(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    landing = tmp_path / "landing"
    landing.mkdir()
    events = [
        post(Job_ID="1", Title="iOS Developer", Description="Python and S3", Pubblication_date="2024-01-02"),
        post(Job_ID="1", Title="iOS Developer", Description=""),
        post(Job_ID="2", Title="Cook", Description="Kubernetes, python3", Pubblication_date="2024-02-02"),
    ]
    (landing / "a.json").write_text("\n".join(json.dumps({**e, "host": "h"}) for e in events))
    main(["ingest", "--source", str(landing), "--table", at("deduped"), "--topic", at("topic"), "--progress", at("p1"), "--available-now"], spark)
    (landing / "b.json").write_text(json.dumps(post(Job_ID="2", Description="late")))
    main(["ingest", "--source", str(landing), "--table", at("deduped"), "--topic", at("topic"), "--progress", at("p1"), "--available-now"], spark)
    main(["compact", "--table", at("deduped"), "--out", at("small-posts"), "--posts"], spark)
    (landing / "c.json").write_text("\n".join(json.dumps(post(Job_ID=i, Description="again")) for i in ("1", "2", "3")))
    main(["ingest", "--source", str(landing), "--table", at("small-posts"), "--topic", at("topic2"), "--progress", at("p3"), "--available-now"], spark)
    kept = sinks.read_versions(spark, at("small-posts"), POST).collect()
    assert sorted((r.Job_ID, r.batch) for r in kept) == [("1", -1), ("2", -1), ("3", 0)]
    (landing / "c.json").unlink()
    enrich = ["enrich", "--source", at("topic") + "/run=0/*", "--table", at("enriched"), "--progress", at("p2"), "--available-now"]
    main(enrich, spark)
    main([*enrich, "--run", "1"], spark)
    state = sinks.merge_by_key(sinks.read_versions(spark, at("enriched"), ENRICHED_POST))
    got = {r.Job_ID: (r.Title, r.Skills.raw_skills) for r in state.collect()}
    assert got == {"1": ("ios dev", ["python", "s3"]), "2": ("cook", ["kubernetes", "python"])}
    main(["report", "--table", at("enriched"), "--out", at("report"), "--k", "1", "--filter", "Title=cook"], spark)
    assert [tuple(r) for r in spark.read.json(at("report/top_skills")).select("skill", "posts").collect()] == [("kubernetes", 1)]
    main(["compact", "--table", at("enriched"), "--out", at("small")], spark)
    assert sinks.read_versions(spark, at("small"), ENRICHED_POST).count() == 2


def test_ingest_with_state_store(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "landing").mkdir()
    job = ["ingest", "--source", at("landing"), "--table", at("t"), "--topic", at("o"), "--progress", at("p"), "--available-now", "--state-store"]
    for name, events in {
        "a": [post(Job_ID="1", Description="x"), post(Job_ID="1", Description="y"), post(Job_ID="2", Description="")],
        "b": [post(Job_ID="1", Description="z"), post(Job_ID="2", Description="late")],
    }.items():
        (tmp_path / "landing" / f"{name}.json").write_text("\n".join(map(json.dumps, events)))
        main(job, spark)
    stored = sinks.read_versions(spark, at("t"), POST)
    assert sorted((r.Job_ID, r.batch) for r in stored.collect()) == [("1", 0), ("2", 1)]


def test_batch_extraction(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps([post(Job_ID="1", Description="GCP and Go"), post(Job_ID="2", Description=None)]))
    main(["extract", "--source", str(tmp_path / "in.json"), "--out", str(tmp_path / "out"), "--stop-terms", "go"], spark)
    out = {r.Job_ID: r.Skills for r in spark.read.schema("Job_ID string, Skills array<string>").json(str(tmp_path / "out")).collect()}
    assert out == {"1": ["gcp"], "2": []}
    main(["enrich-files", "--source", str(tmp_path / "in.json"), "--out", str(tmp_path / "rich")], spark)
    rich = {r.Job_ID: r.Skills.raw_skills for r in spark.read.parquet(str(tmp_path / "rich")).collect()}
    assert rich == {"1": ["go", "google cloud platform"], "2": []}


def test_pages_job(spark, tmp_path):
    card = '<ul><li><div class="base-card" data-entity-urn="u:r:n:7"><a><span>T</span></a></div></li></ul>'
    spark.createDataFrame([(card,)], "html string").write.parquet(str(tmp_path / "l"))
    detail = '<div class="show-more-less-html__markup">D</div>'
    spark.createDataFrame([("7", detail)], "Job_ID string, html string").write.parquet(str(tmp_path / "d"))
    main(["pages", "--listings", str(tmp_path / "l"), "--details", str(tmp_path / "d"), "--out", str(tmp_path / "o")], spark)
    row = spark.read.schema(POST).json(str(tmp_path / "o")).first()
    assert (row.Job_ID, row.Title, row.Description) == ("7", "T", "D")


def test_prepare_job(spark, tmp_path):
    labelled = tmp_path / "labelled"
    labelled.mkdir()
    for i in range(10):
        tokens = [{"position": p, "text": f"w{p}", "label": "O" if i != 3 else "?"} for p in range(i)]
        (labelled / f"{i}.json").write_text(json.dumps({"tokens": tokens}))
    (tmp_path / "vocab.json").write_text('{"token":"w0","id":5}\n{"token":"w1","id":6}')
    main(["prepare", "--source", str(labelled), "--vocab", str(tmp_path / "vocab.json"), "--out", str(tmp_path / "o")], spark)
    encoded = spark.read.parquet(str(tmp_path / "o/encoded"))
    sizes = encoded.groupBy("split").agg(F.count("*").alias("n"), F.countDistinct(F.size("input_ids")).alias("lengths"))
    assert {r.split: (r.n, r.lengths) for r in sizes.collect()} == {"train": (6, 1), "val": (2, 1)}
    assert spark.read.json(str(tmp_path / "o/rejects")).count() == 2


def test_bulk_ingest_does_not_depend_on_partitioning(spark):
    rows = [("1", "2024-01-02", "b"), ("1", "2024-01-01", "a2"), ("1", "2024-01-01", "a1"), ("2", "2024-01-01", "")]
    df = spark.createDataFrame(rows, "Job_ID string, Pubblication_date string, Description string")
    for n in (1, 4):
        assert [r.Description for r in ingest_batch(df.repartition(n)).collect()] == ["a1"]
    known = spark.createDataFrame([("1", "z")], "Job_ID string, Description string")
    assert ingest_batch(df, known).count() == 0


def test_ingest_keeps_the_first_line_and_sets_bad_lines_aside(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "landing").mkdir()
    keyless = [{k: v for k, v in post(Description=d).items() if k != "Job_ID"} for d in ("a", "b")]
    events = [
        post(Job_ID="1", Description="first in file", Pubblication_date="2024-05-01"),
        post(Job_ID="1", Description="second in file", Pubblication_date="2024-01-01"),
        *keyless,
    ]
    (tmp_path / "landing" / "a.json").write_text("\n".join([*map(json.dumps, events), "{broken"]))
    main(["ingest", "--source", at("landing"), "--table", at("t"), "--topic", at("o"), "--progress", at("p"), "--available-now"], spark)
    assert [r.Description for r in sinks.read_versions(spark, at("t"), POST).collect()] == ["first in file"]
    bad = spark.read.parquet(at("t-quarantine"))
    assert sorted((r.Description or "", r.malformed or "") for r in bad.collect()) == [("", "{broken"), ("a", ""), ("b", "")]


def test_enrich_job_keeps_undecodable_payloads(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("not json\n" + json.dumps(post(Job_ID="1", Description="Java")))
    main(["enrich", "--source", at("in"), "--table", at("t"), "--progress", at("p"), "--available-now"], spark)
    assert [r.value for r in spark.read.parquet(at("t-quarantine")).collect()] == ["not json"]
    assert [r.Job_ID for r in sinks.read_versions(spark, at("t"), ENRICHED_POST).collect()] == ["1"]


def test_kept_counts_report_what_a_recount_reports(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    day = {"Pubblication_date": "2024-03-15", "Title": "Cook", "Industry_type": "Food"}
    first = [{"Job_ID": "1", "Description": "java and aws", **day}, {"Job_ID": "2", "Description": "python, java"}]
    second = [{"Job_ID": "1", "Description": "sql", "Pubblication_date": "2024-04-01"}, {"Description": "java"}]
    enrich = ["enrich", "--source", at("in"), "--table", at("t"), "--progress", at("p"), "--available-now"]
    for part in (first, second):
        spark.createDataFrame([(json.dumps(p),) for p in part], "value string").coalesce(1).write.mode("append").text(at("in"))
        main([*enrich, "--insights", at("kept")], spark)
    main(["report", "--table", at("t"), "--out", at("full")], spark)
    main(["insights-report", "--insights", at("kept"), "--out", at("quick")], spark)
    for name in ("top_skills", "by_Title", "by_Industry_type", "categories", "months"):
        full, quick = (spark.read.json(at(f"{kind}/{name}")) for kind in ("full", "quick"))
        in_order = lambda df: sorted(str(r.asDict()) for r in df.select(*sorted(df.columns)).collect())
        assert in_order(full) == in_order(quick), name
    assert {(r.skill, r.posts) for r in spark.read.json(at("quick/top_skills")).collect()} == {("java", 1), ("python", 1), ("sql", 1)}


def test_score_job(spark, tmp_path):
    rows = [([-100, 1, 2, 0, -100], [[1.0, 0.0, 0.0], [0.0, 2.0, 1.0], [0.0, 0.0, 1.0], [3.0, 0.0, 0.0], [0.0, 0.0, 1.0]]), ([1], [[1.0, 0.0, 0.0]])]
    source = str(tmp_path / "scored")
    spark.createDataFrame(rows, "labels array<int>, scores array<array<double>>").write.parquet(source)
    main(["score", "--source", source, "--out", str(tmp_path / "out")], spark)
    r = spark.read.json(str(tmp_path / "out")).first()
    assert (r.tp, r.gold_spans, r.pred_spans, r.precision, r.recall) == (1, 2, 1, 1.0, 0.5)
