"""What a query costs must not grow with its keys, batches or passes beyond the input."""

import gzip
import os
import re
import tracemalloc

import pyarrow as pa
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from jobsieve.catalog import queries
from jobsieve.operators import training
from jobsieve.sources import sinks
from jobsieve.streaming import arrivals, jobs

SF_DIR = "/root/testdata/sf0.001"


def counted(df):
    """The frame, and a counter of the rows it was evaluated to."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    return df.mapInPandas(count, df.schema), seen


def test_labelled_files_need_no_folder_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda _, name: f"file://{tmp_path}/{name}")
    found = queries.s5_labelled_files(spark, SF_DIR)
    n = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert found.count() == n and sum(len(files) for _, _, files in os.walk(tmp_path)) == n
    assert sum(len(folders) for _, folders, _ in os.walk(tmp_path)) <= 65


def test_files_of_one_key_are_numbered_and_repeated_tasks_replace_them(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "é"), (2, "c")], "doc bigint, value string")
    for _ in range(2):
        sinks.write_files(rows, str(tmp_path), "doc", "value")
    files = {f.name: f.read_text("utf-8") for f in tmp_path.rglob("*.txt")}
    assert sorted(files) == ["doc=1_0.txt", "doc=1_1.txt", "doc=2_0.txt"]
    assert {files["doc=1_0.txt"], files["doc=1_1.txt"]} == {"a", "é"} and files["doc=2_0.txt"] == "c"


def test_files_of_tokens_take_less_disk_than_their_text_in_json(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda _, name: f"file://{tmp_path}/{name}")
    text = " ".join(f"word{i % 50}" for i in range(1000))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(i, text, "en", "web", len(text)) for i in [2, 2, 3, 26, 50, 51]]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in/documents.parquet")
    found = queries.s5_labelled_files(spark, f"{tmp_path}/in")
    want = [(2, "good", 1000), (2, "good", 1000), (3, "no tokens", 0), (26, "invalid JSON", 0), (50, "good", 1000), (51, "invalid JSON", 0)]
    assert sorted(map(tuple, found.collect())) == want
    sizes = [f.stat().st_size for f in tmp_path.rglob("*.txt*") if "documents" not in str(f)]
    assert len(sizes) == 6 and max(sizes) < 2 * len(text)  # 45 bytes of JSON for each word


def test_files_of_keys_that_do_not_repeat_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    rows = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e"), (4, "f")]
    every = spark.createDataFrame(rows, "doc bigint, value string")
    alone = every.filter("doc > 1")
    assert ["Exchange" in plan_of(x) for x in sinks._by_key(alone, "doc")] == [False]
    once, again = sinks._by_key(every, "doc")
    assert "hashpartitioning" not in plan_of(once) and sorted(r.value for r in once.collect()) == ["c", "f"]
    assert sorted(r.value for r in again.collect()) == ["a", "b", "d", "e"]
    names = ["doc=1_0.gz", "doc=1_1.gz", "doc=2_0.gz", "doc=4_0.gz", "doc=None_0.gz", "doc=None_1.gz"]
    for k, bound in enumerate((100, 1)):
        monkeypatch.setattr(sinks, "FEW_KEYS", bound)
        sinks.write_files(every, f"{tmp_path}/{k}", "doc", "value", suffix=".gz")
        files = sorted((tmp_path / str(k)).rglob("*.gz"), key=lambda f: f.name)
        assert [f.name for f in files] == names
        assert sorted(gzip.decompress(f.read_bytes()).decode() for f in files) == list("abcdef")


def test_labeler_holds_few_texts_as_objects():
    texts = pa.array([" ".join(["word", "extraordinarily", "x" * 12] * 200), None, ""] * 1000)
    tracemalloc.start()
    out = queries._length_labels(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6 and len(out) == 3000 and out.type == pa.list_(pa.struct([("token", pa.string()), ("label", pa.string())]))
    assert out[0].as_py()[:3] == [
        {"token": "word", "label": "O"}, {"token": "extraordinarily", "label": "B-SKILL"}, {"token": "x" * 12, "label": "I-SKILL"}
    ]
    assert out[1].as_py() == [] and len(queries._length_labels(pa.array([], pa.string()))) == 0


def test_padding_leaves_sequences_in_their_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(queries.t4_pad_sequences(spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_split_reads_its_keys_once(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(F.col("doc_id").alias("doc"))
    split = training.split_train_val(docs)
    n = split.count()
    assert split.filter("split = 'val'").count() == -(-n // 5)
    split.collect()
    assert "ReusedExchange" in plan_of(split)


def test_span_scores_read_their_rows_once(spark):
    rows = [(d, i, g, p) for d in range(9) for i, (g, p) in enumerate([("B-SKILL", "B-SKILL"), ("I-SKILL", "O"), ("O", "I-SKILL")])]
    df, seen = counted(spark.createDataFrame(rows, "doc bigint, pos int, gold string, pred string"))
    assert training.span_prf(df).first()[:3] == (0, 9, 18) and seen.value == 27


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_equal_and_missing_positions_keep_their_order(spark, kind):
    items = [(3, "a", "O"), (None, "b", "O"), (-(2**31), "c", None), (3, "d", "O"), None, (2**31 - 1, None, "O"), (0, "f", "O")]
    schema = f"doc int, tokens array<struct<position:{kind},text:string,label:string>>"
    got = training.to_sequences(spark.createDataFrame([(1, items), (2, []), (3, None)], schema)).collect()
    assert [(r.doc, r.tokens, r.labels) for r in got] == [
        (1, ["b", None, "c", "f", "a", "d", None], ["O", None, None, "O", "O", "O", "O"])
    ]


@pytest.mark.parametrize("timed", [False, True])
def test_first_arrivals_hand_few_columns_to_each_key(spark, tmp_path, timed):
    """Every column costs a pandas series for every key, every batch that is returned a round trip."""
    options = {"event_time": "at", "ttl_seconds": 60} if timed else {}
    stream = spark.readStream.schema("Job_ID string, arrival bigint, Description string, at timestamp").parquet(str(tmp_path))
    passed = arrivals.first_arrivals_stream(stream, **options)
    plan = passed._jdf.queryExecution().analyzed()
    sent = next(line for line in reversed(plan.toString().splitlines()) if "MapInArrow" in line)
    names = set(re.findall(r"(\w+)#\d+", sent.split("(", 1)[1].split(")", 1)[1]))
    assert names == {"key", "row", "at"} if timed else names == {"key", "row"}, sent
    rows = arrivals._written(pa.RecordBatch.from_pylist([{"n0": False, "tie": i, "ms": i, "body": {"x": i}} for i in range(500)]))
    got = list(arrivals._read([pa.RecordBatch.from_pydict({"row": rows})]))
    assert len(got) == 1 and got[0].to_pylist() == [{"x": i} for i in range(500)]


def test_sorted_text_is_cut_into_small_tasks(spark, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "SORTED_TEXT", 1 << 14)
    bytes_stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f.is_file())
    tasks = int(re.search(r"RoundRobinPartitioning\((\d+)\), REPARTITION_BY_NUM", plan_of(queries.x1_label_tokens(spark, str(tmp_path)))).group(1))
    assert tasks >= bytes_stored >> 14 > 8


@pytest.mark.parametrize("name", ["a2_distinct_skills", "w1_decode_bio_conll", "w2_span_text", "t7_span_prf_rows"])
def test_decoded_text_is_cut_into_small_tasks(spark, tmp_path, monkeypatch, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "SORTED_TEXT", 1 << 14)
    bytes_stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f.is_file())
    tasks = re.findall(r"RoundRobinPartitioning\((\d+)\), REPARTITION_BY_NUM", plan_of(queries.QUERIES[name](spark, str(tmp_path))))
    assert min(map(int, tasks)) >= bytes_stored >> 14 > 8


def test_micro_batches_use_all_cores(spark, tmp_path, monkeypatch):
    """One file of one row group is one task; its payloads are enriched by all."""
    table, tasks = str(tmp_path / "table"), []
    payload = F.format_string('{"Job_ID": "%d", "Description": "python and java"}', F.col("id")).cast("binary").alias("value")
    spark.range(0, 400, 1, 1).select(payload).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("value binary").parquet(str(tmp_path / "in"))

    real = jobs.enrich_posts
    counted_tasks = lambda df, *a, **k: (tasks.append(df.rdd.getNumPartitions()), real(df, *a, **k))[1]
    monkeypatch.setattr(jobs, "enrich_posts", counted_tasks)
    jobs.run_stream(stream, table, str(tmp_path / "progress"), available_now=True).awaitTermination()
    assert tasks == [spark.sparkContext.defaultParallelism] and spark.read.parquet(table).count() == 400
