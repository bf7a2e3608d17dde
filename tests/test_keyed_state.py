"""Rows kept by key and the counts kept by their differences equal a recount, whatever is repeated, replayed or put together."""

import os
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from jobsieve.operators import insights
from jobsieve.plans.enrich import enrich_posts
from jobsieve.schemas import POST, POST_FIELDS
from jobsieve.session import scratch_dir
from jobsieve.sources import sinks
from jobsieve.sources.dictionaries import Dictionaries
from jobsieve.sources.keyed_state import KeyedState
from jobsieve.streaming import jobs

DICTS = Dictionaries()


FOLDERS = {}


def enriched(spark, posts):
    """Enriched rows of some posts, computed once and stored."""
    rows = [tuple(p.get(f) for f in POST_FIELDS) for p in posts]
    if str(rows) not in FOLDERS:
        FOLDERS[str(rows)] = scratch_dir(spark, "batch")
        enrich_posts(spark.createDataFrame(rows, POST).coalesce(1), DICTS).write.parquet(FOLDERS[str(rows)])
    return spark.read.parquet(FOLDERS[str(rows)])


def post(key, text, title="Plumber", day="2024-03-15", **more):
    return {"Job_ID": key, "Description": text, "Title": title, "Pubblication_date": day, **more}


BATCHES = [
    [post("1", "java and aws"), post("2", "python"), post(None, "java"), post("3", "", day=None)],
    # An update takes skills back, moves a month and a title; NULL leaves stay as they were.
    [post("1", "sql", "iOS Developer", "2024-04-01"), post("4", "java", Industry_type="IT"), post("2", None, None, None)],
    [post("3", "S3. Kubernetes!"), post("4", "java", Industry_type="Oil"), post("1", "sql", "iOS Developer", "2024-02-30")],
]


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def job(spark, tmp_path):
    state, counts, table = (str(tmp_path / n) for n in ("state", "counts", "table"))
    schema = enriched(spark, []).schema

    class Job:
        path = state
        sink = staticmethod(jobs.fan_out([jobs.upsert_sink(table), jobs.counts_sink(state, counts, schema)]))
        store = KeyedState(spark, state, schema)

        def check(self):
            full = sinks.merge_by_key(sinks.read_versions(spark, table, schema).filter("Job_ID IS NOT NULL"))
            kept = insights.current_counts(spark.read.option("basePath", counts).parquet(counts))
            assert rows(self.store.current()) == rows(full)
            assert rows(kept) == rows(insights.facts(full).groupBy("view", "group", "term").agg(F.count("*").alias("posts")))
            return kept

    return Job()


def test_counts_equal_a_recount(spark, job):
    for i, batch in enumerate(BATCHES):
        job.sink(enriched(spark, batch), i, 0)
    kept = job.check()
    # The same numbers as those of the queries over the whole table.
    top = {(r.skill, r.posts) for r in insights.top_skills(job.store.current(), 100).collect()}
    assert {(r.term, r.posts) for r in insights.ranked_counts(kept, "skill", 100).collect()} == top
    by = {(r.Title, r.skill, r.posts, r.rank) for r in insights.skills_by(job.store.current(), "Title").collect()}
    assert {(r.group, r.term, r.posts, r.rank) for r in insights.ranked_counts(kept, "title").collect()} == by
    months = {(str(r.period) if r.period else None, r.posts) for r in insights.posts_over_time(job.store.current()).collect()}
    assert {(r.term, r.posts) for r in kept.filter("view = 'period'").collect()} == months


def test_repeats_and_replays_change_nothing_twice(spark, job):
    for i, batch in enumerate(BATCHES):
        for _ in range(2):
            job.sink(enriched(spark, batch), i, 0)
    before = rows(job.check())
    for i, batch in enumerate(BATCHES):
        job.sink(enriched(spark, batch), i, 1)
        if i == 1:
            job.check()
    assert rows(job.check()) == before


def test_a_batch_cut_off_before_its_counts_comes_again(spark, job):
    job.sink(enriched(spark, BATCHES[0]), 0, 0)
    # Rows were stored, counts were not; then the table is put together, then the batch is repeated.
    for df in job.store.upsert(enriched(spark, BATCHES[1]), 1, 0):
        df.unpersist()
    job.store.compact()
    job.sink(enriched(spark, BATCHES[1]), 1, 0)
    job.check()


def test_compaction_keeps_one_row_per_key(spark, job):
    for i, batch in enumerate(BATCHES):
        job.sink(enriched(spark, batch), i, 0)
    before = rows(job.store.current())
    job.store.compact()
    number, _, folder = job.store.generation()
    assert number == 1 and rows(job.store.current()) == before
    stored = spark.read.parquet(folder)
    settled = stored.filter("of_run = -1")
    assert settled.count() == settled.select("Job_ID").distinct().count() == 4
    assert stored.filter("of_run >= 0").select("of_batch").distinct().collect() == [(2,)]
    # A run that is cut off leaves a folder without its mark: the whole generation before it counts.
    os.makedirs(f"{job.path}/gen=2-buckets=16/bucket=0")
    assert job.store.generation()[0] == 1
    job.store.drop_superseded()
    assert sorted(n for n in os.listdir(job.path) if n.startswith("gen")) == ["gen=1-buckets=16", "gen=2-buckets=16"]
    job.sink(enriched(spark, BATCHES[0]), 3, 0)
    job.check()
    job.store.compact()
    job.check()


def test_a_batch_reads_its_own_buckets(spark, job):
    one = enriched(spark, [post("k", "java")]).drop("Job_ID")
    many = spark.range(20_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("Job_ID")).join(one)
    job.store.keys_per_bucket = 500
    job.store.rebuild(many.withColumns({"run": F.lit(0), "batch": F.lit(-1)}).select(*job.store.schema.names))
    assert job.store.generation()[1] == 64
    batch = enriched(spark, [post("k7", "java"), post("k8", "sql"), post("new", "sql")])
    assert len(job.store.touched(batch)) <= 3
    old, new = job.store.upsert(batch, 0, 0)
    assert {r.Job_ID for r in old.collect()} == {"k7", "k8"} and new.count() == 3
    assert job.store.current().count() == 20_001
    old.unpersist(), new.unpersist()


def test_empty_batches_and_hot_keys(spark, job):
    job.sink(enriched(spark, []), 0, 0)
    assert job.check().count() == 0
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    hot = spark.range(9_000).select(key.alias("Job_ID")).join(enriched(spark, [post("k", "java")]).drop("Job_ID"))
    job.sink(hot, 1, 0)
    kept = job.check()
    assert {r.posts for r in kept.filter("view = 'skill' AND term = 'java'").collect()} == {6_001}
    plan = plan_of(insights.signed_counts(job.store.current(), job.store.current()))
    assert re.search("partial_sum", plan) and "NestedLoop" not in plan


def test_names_of_the_table_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="own"):
        KeyedState(spark, str(tmp_path), spark.createDataFrame([], "Job_ID string, bucket int").schema)
