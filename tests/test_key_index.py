"""The index of known keys: what it reads, how it grows, and what interrupted or repeated writes leave."""

import json
import os

from pyspark.sql import functions as F

from jobsieve.operators import dedupe
from jobsieve.sources.key_index import KeyIndex
from jobsieve.sources.readers import read_posts_json


def keys(spark, start, stop, run=0, batch=0):
    key = F.concat(F.lit("k"), F.col("id").cast("string")).alias("Job_ID")
    return spark.range(start, stop).select(key, F.lit(run).alias("run"), F.lit(batch).alias("batch"))


def files_read(df):
    return [f for f in df.inputFiles() if f.endswith(".parquet")]


def test_a_batch_reads_its_own_buckets_however_large_the_table(spark, tmp_path):
    batch = keys(spark, 0, 5).select("Job_ID").unionByName(keys(spark, -3, 0).select("Job_ID"))
    read, rows = [], []
    for n in (20_000, 200_000):
        index = KeyIndex(spark, str(tmp_path / str(n)), keys_per_bucket=500)
        index.rebuild(keys(spark, 0, n))
        found = index.known(batch)
        assert {os.path.dirname(f.removeprefix("file:").replace("//", "")).split("/bucket=")[1].split("/")[0] for f in files_read(found)} == {
            p.split("bucket=")[1] for p in index.touched(batch)
        }
        read.append(len(files_read(found)))
        rows.append(found.count())
        fresh = {r.Job_ID for r in index.reject_known(batch).collect()}
        assert fresh == {"k-3", "k-2", "k-1"}
    assert max(read) <= 8
    assert rows[1] < 2 * rows[0]  # ten times the keys, as many in a bucket


def test_added_keys_repeats_and_compaction(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path / "keys"), keys_per_bucket=50)
    index.rebuild(keys(spark, 0, 0))
    assert index.known(keys(spark, 0, 9)).count() == 0
    index.add(keys(spark, 0, 100), batch=0)
    index.add(keys(spark, 100, 300), batch=1)
    index.add(keys(spark, 100, 120), batch=1)  # the repeated batch counts
    index.add(keys(spark, 0, 10), batch=0, run=1)
    every = keys(spark, 0, 300)

    def state():
        return sorted((r.Job_ID, r.run, r.batch) for r in index.known(every).distinct().collect())

    before = state()
    in_buckets = {r[0] for r in before if r[1:] == (0, 1)}
    assert {f"k{i}" for i in range(100, 120)} <= in_buckets
    _, few, _ = index.generation()
    index.compact()
    number, more, folder = index.generation()
    assert number == 1 and more >= few and state() == before
    # A rebuild that never ended is as if it had not begun.
    os.makedirs(f"{tmp_path}/keys/gen=2-buckets=64/bucket=1")
    assert index.generation()[2] == folder and state() == before
    nothing = spark.createDataFrame([(None,), (None,)], "Job_ID string")
    assert index.known(nothing).count() == 0 and index.reject_known(nothing).count() == 2


def test_overwrite_keeps_the_last_row_of_a_key(spark):
    schema = "Job_ID string, n int, x string"
    table = spark.createDataFrame([("a", 0, "old"), ("b", 0, "old"), (None, 0, "old")], schema)
    new = spark.createDataFrame([("a", 1, "1"), ("a", 3, "3"), ("a", 2, "2"), ("c", 1, "c"), (None, 9, "z")], schema)
    got = sorted(map(tuple, dedupe.overwrite_by_key(new, table, order="n").collect()), key=str)
    assert got == sorted([("a", 3, "3"), ("b", 0, "old"), ("c", 1, "c"), (None, 0, "old"), (None, 9, "z")], key=str)
    assert dedupe.overwrite_by_key(new, table).filter("Job_ID = 'a'").count() == 1


def test_no_document_of_a_file_is_lost(spark, tmp_path):
    def ids(text, **options):
        path = tmp_path / f"{abs(hash(text))}.json"
        path.write_text(text)
        rows = read_posts_json(spark, str(path), raw="raw", **options).collect()
        return [r.Job_ID for r in rows if r.raw is None], [r.raw.strip() for r in rows if r.raw is not None]

    one, two, three = ({"Job_ID": str(i), "Title": "a\nb } {"} for i in (1, 2, 3))
    lines = "\n".join(map(json.dumps, (one, two, three))) + "\n"
    for options in ({}, {"lines": True}):
        assert ids(lines, **options) == (["1", "2", "3"], [])
        assert ids(lines.replace("\n", "\r\n"), **options) == (["1", "2", "3"], [])
        assert ids(json.dumps(one) + "\nnot json\n" + json.dumps([two, three]), **options) == (["1", "2", "3"], ["not json"])
        assert ids("[]\n" + json.dumps(one), **options) == (["1"], [])
        assert ids("", **options) == ([], [])
        assert ids('{"Job_ID": "1"', **options) == ([], ['{"Job_ID": "1"'])
    pretty = json.dumps([one, two], indent=2)
    assert ids(pretty) == (["1", "2"], [])
    assert ids(pretty + "\n\n" + json.dumps(three, indent=1)) == (["1", "2", "3"], [])
    nested = json.dumps([{"Job_ID": "1", "Title": {"x": [1, {"y": 2}]}}, two], indent=1)
    assert ids(nested) == (["1", "2"], [])
