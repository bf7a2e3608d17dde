"""Physical plans and hot keys: what must hold when the data is large."""

import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from jobsieve.catalog import inputs
from jobsieve.catalog.queries import DICTS, QUERIES
from jobsieve.operators import dedupe, normalize
from jobsieve.plans.enrich import enrich_posts
from jobsieve.schemas import POST, POST_FIELDS
from jobsieve.sources import dictionaries as dicts_io
from jobsieve.sources import sinks

SF_DIR = "/root/testdata/sf0.001"
STREAMED = [n for n in QUERIES if n.startswith(("r", "s"))]


def posts(spark, n, hot_share=3):
    """n posts of which one in hot_share has the same key."""
    return spark.range(n).select(
        F.col("id").alias("arrival"),
        F.when(F.col("id") % hot_share == 0, "hot").otherwise(F.col("id").cast("string")).alias("Job_ID"),
        F.when(F.col("id") % 7 == 0, "").otherwise(F.concat(F.lit("python "), F.col("id").cast("string"))).alias("Description"),
        *[F.lit("x").alias(f) for f in POST_FIELDS if f not in ("Job_ID", "Description")],
    )


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = posts(spark, 30_000)
    first = dedupe.dedupe_first(df)
    plan = plan_of(first)
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    rows = {r.Job_ID: r.arrival for r in first.filter("Job_ID = 'hot' OR arrival < 3").collect()}
    assert rows["hot"] == 3 and first.count() == 30_000 - 10_000 - sum(1 for i in range(30_000) if i % 3 and i % 7 == 0) + 1


def test_hot_key_lookup(spark):
    df = posts(spark, 3_000)
    table = df.filter("arrival < 10").groupBy("Job_ID").agg(F.max("Description").alias("Description"))
    assert dedupe.lookup_enrich(df, table).count() == 3_000
    assert dedupe.reject_known(df, table).filter("Job_ID = 'hot'").count() == 0


def test_hot_key_upsert(spark):
    df = posts(spark, 3_000).select("Job_ID", "Title", "Description")
    merged = sinks.upsert(df, df.limit(0))
    assert merged.count() == df.select("Job_ID").distinct().count()
    assert "partial_max_by" in plan_of(merged)


def test_enrichment_has_no_shuffle(spark):
    plan = plan_of(enrich_posts(spark.createDataFrame([], POST), DICTS))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and plan.count("regexp_extract_all") == 1


def test_large_alias_table_is_not_broadcast(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("Title"))
    big = spark.range(0, 2_000_000).select(F.col("id").cast("string").alias("alias"), F.lit("c").alias("canonical"))
    plan = plan_of(normalize.normalize_by_map(df, "Title", big))
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan or "BuildLeft" in plan


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "posts")
    posts(spark, 100).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(dedupe.reject_known(stored.select("arrival", "Job_ID"), stored))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("Description" in s and "Title" not in s for s in scans)
    assert "IsNotNull(Description)" in plan


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMED])
def test_no_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_posts_cover_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    p = inputs.posts(spark, SF_DIR)
    assert p.count() == 2 * docs.count()
    whole = p.filter("arrival % 2 = 1").agg(F.sum(F.length("Description"))).first()[0]
    assert whole > docs.agg(F.sum(F.length("text"))).first()[0]


def test_alias_frames_are_small_to_the_optimizer(spark):
    aliases = dicts_io.alias_frame(spark, DICTS.skill_aliases)
    df = spark.range(10).select(F.col("id").cast("string").alias("t"))
    assert "BroadcastHashJoin" in plan_of(normalize.normalize_by_map(df, "t", aliases))
