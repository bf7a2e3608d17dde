"""Streaming results equal batch results; repeats and replays change nothing."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from jobsieve.functions.tokens import lexicon_pattern, tagged_tokens
from jobsieve.operators import clean, dedupe
from jobsieve.plans.enrich import enrich_posts
from jobsieve.schemas import POST, POST_FIELDS
from jobsieve.session import scratch_dir
from jobsieve.sources import readers, sinks
from jobsieve.sources.dictionaries import Dictionaries
from jobsieve.streaming import jobs

ARRIVING = "arrival int, Job_ID string, Description string"


def run(stream, sink, progress, run_no=0):
    jobs.start(stream, sink, progress, run=run_no, available_now=True).awaitTermination()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def folders(spark, tmp_path):
    return [str(tmp_path / n) for n in ("source", "table", "progress", "topic")]


def feed(spark, source, data, schema=ARRIVING):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(source)


def test_upsert_over_batches_and_replay(spark, folders):
    source, table, progress, _ = folders
    schema = "Job_ID string, a string, s struct<x:array<string>,y:string>"
    batches = [
        [("1", "a1", (["p"], "y1")), ("2", None, (["q"], None))],
        [("1", None, ([], None)), ("2", "a2", (None, "y2")), ("3", "a3", None)],
    ]
    struct = spark.createDataFrame([], schema).schema
    for batch in batches:
        feed(spark, source, batch, schema)
        run(spark.readStream.schema(struct).parquet(source), jobs.upsert_sink(table), progress)
    state = lambda: sinks.merge_by_key(sinks.read_versions(spark, table, struct))
    got = {r.Job_ID: (r.a, r.s.x, r.s.y) for r in state().collect()}
    assert got == {"1": ("a1", [], "y1"), "2": ("a2", ["q"], "y2"), "3": ("a3", None, None)}
    before = rows(state())
    run(spark.readStream.schema(struct).parquet(source), jobs.upsert_sink(table), progress, run_no=1)
    versions = sinks.read_versions(spark, table, struct)
    assert {r.run for r in versions.select("run").distinct().collect()} == {0, 1}
    replayed = {r.Job_ID: (r.a, sorted(r.s.x or []), r.s.y) for r in state().collect()}
    assert set(replayed) == {"1", "2", "3"} and len(before) == 3
    compacted = table + "-compact"
    sinks.compact(spark, table, struct, compacted)
    assert rows(sinks.merge_by_key(sinks.read_versions(spark, compacted, struct))) == rows(state())


def test_repeated_batch_replaces_itself(spark, folders):
    _, table, _, _ = folders
    df = spark.createDataFrame([("1", "x")], "Job_ID string, t string")
    for _ in range(2):
        sinks.append_version(df, table, batch=4)
    assert sinks.read_versions(spark, table, df.schema).count() == 1


def test_versions_of_a_missing_table_are_empty(spark, folders):
    assert sinks.read_versions(spark, folders[1] + "/none", POST).count() == 0


def test_dedupe_stream_across_batches(spark, folders):
    source, table, progress, _ = folders
    schema = spark.createDataFrame([], ARRIVING).schema
    feed(spark, source, [(1, "1", "x"), (2, "2", ""), (3, "3", None)])
    stream = lambda: jobs.dedupe_stream(spark.readStream.schema(schema).parquet(source))
    run(stream(), jobs.upsert_sink(table), progress)
    feed(spark, source, [(4, "1", "later"), (5, "2", "first text"), (6, "hot", "a")] + [(i, "hot", f"t{i}") for i in range(7, 300)])
    run(stream(), jobs.upsert_sink(table), progress)
    kept = sinks.read_versions(spark, table, schema).collect()
    assert sorted(r.Job_ID for r in kept) == ["1", "2", "hot"]
    assert {r.Job_ID: r.arrival for r in kept}["1"] == 1


def test_ingest_is_exact_and_repeatable(spark, folders):
    source, table, progress, topic = folders
    schema = spark.createDataFrame([], ARRIVING).schema
    seed = spark.createDataFrame([(0, "5", "", False), (0, "6", "known", True)], ARRIVING + ", has_text boolean")
    sinks.append_version(seed, table, -1, 0, ["has_text"])
    sink = jobs.ingest_sink(table, schema, forward=[jobs.payload_version_sink(topic)])
    first = [(3, "1", "third"), (2, "1", "second"), (1, "1", ""), (4, "5", "fills"), (5, "6", "dropped"), (6, "7", " ")]
    feed(spark, source, first)
    run(spark.readStream.schema(schema).parquet(source), sink, progress)
    feed(spark, source, [(7, "1", "late"), (8, "8", "new")])
    run(spark.readStream.schema(schema).parquet(source), sink, progress)
    # The driver died after writing batch 1 but before recording it: the batch comes again.
    sink(spark.createDataFrame([(7, "1", "late"), (8, "8", "new")], ARRIVING), 1, 0)
    state = sinks.latest_by_key(sinks.read_versions(spark, table, schema))
    got = {r.Job_ID: (r.arrival, r.Description) for r in state.collect()}
    assert got == {"1": (2, "second"), "5": (4, "fills"), "6": (0, "known"), "7": (6, " "), "8": (8, "new")}
    sent = clean.decode_payload(spark.read.text(topic, recursiveFileLookup=True).select("value"), schema)
    assert sorted(r.Job_ID for r in sent.collect()) == ["1", "5", "7", "8"]


def test_enrichment_stream_equals_batch(spark, folders):
    source, table, progress, _ = folders
    dicts = Dictionaries()
    posts = [
        tuple({"Job_ID": str(i), "Title": "iOS Developer", "Description": d}.get(f) for f in POST_FIELDS)
        for i, d in enumerate(["Java, SQL and AWS", "", None, "S3. Kubernetes!", "nothing here"])
    ]
    df = spark.createDataFrame(posts, POST)
    batch = enrich_posts(df, dicts)
    for part in (0, 1):
        sinks.to_payload(df.filter(F.col("Job_ID").cast("int") % 2 == part)).write.mode("append").text(source)
        spark.createDataFrame([("not json",)], "value string").write.mode("append").text(source)
        stream = readers.read_posts_stream(spark, source, fmt="text", schema="value string")
        jobs.run_stream(stream, table, progress, dicts, available_now=True).awaitTermination()
    state = sinks.merge_by_key(sinks.read_versions(spark, table, batch.schema))
    assert rows(state.select(*batch.columns)) == rows(batch)


def test_stream_dedupe_with_ttl(spark, folders):
    source, table, progress, _ = folders
    data = [("1", "x", "2024-01-01 00:00:00"), ("1", "y", "2024-01-01 00:01:00")]
    df = spark.createDataFrame(data, "Job_ID string, Description string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(source)
    stream = jobs.dedupe_stream(spark.readStream.schema(df.schema).parquet(source), ttl="1 hour", event_time="ts")
    run(stream, jobs.upsert_sink(table), progress)
    assert sinks.read_versions(spark, table, df.schema).count() == 1


def test_scratch_follows_the_cluster_setting(tmp_path):
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": str(tmp_path)}.get(key, default))
    assert scratch_dir(SimpleNamespace(conf=conf, sparkContext=context), "x").startswith(str(tmp_path))
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(unset, "x")


def test_dedupe_with_table(spark):
    table = spark.createDataFrame([("1", "t"), ("2", "")], "Job_ID string, Description string")
    batch = spark.createDataFrame([(1, "1", "n"), (2, "2", "n"), (3, "3", "")], ARRIVING).withColumn("host", F.lit("h"))
    out = jobs.dedupe_with_table(batch, table)
    assert [r.Job_ID for r in out.collect()] == ["2"] and "host" not in out.columns
    assert dedupe.overwrite_by_key(out.drop("arrival"), table).count() == 2


def test_merge_does_not_depend_on_row_order(spark):
    data = [("1", "new title", "x", 0, 0), ("1", "old title", None, 0, 0)]
    got = set()
    for rows_in in (data, data[::-1]):
        df = spark.createDataFrame(rows_in, "Job_ID string, Title string, Location string, run long, batch long")
        got.add(str(sinks.merge_by_key(df.coalesce(1)).collect()))
    assert len(got) == 1


def test_stream_merges_updates_of_a_key_in_offset_order(spark, folders):
    source, table, progress, _ = folders
    title = lambda t, place: {**dict.fromkeys(POST_FIELDS), "Job_ID": "1", "Title": t, "Location": place}
    data = [(2, json.dumps(title("last", None))), (1, json.dumps(title("first", "rome")))]
    df = spark.createDataFrame(data, "offset long, value string")
    df.coalesce(1).write.parquet(source)
    labeler = lambda text: tagged_tokens(text, lexicon_pattern(["java"]))
    stream = spark.readStream.schema(df.schema).parquet(source)
    jobs.run_stream(stream, table, progress, available_now=True, labeler=labeler).awaitTermination()
    assert [(r.Title, r.Location) for r in spark.read.parquet(table).collect()] == [("last", "rome")]
