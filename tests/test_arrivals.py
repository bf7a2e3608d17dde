"""First arrivals of a stream against a plain simulation of its micro-batches."""

import datetime as dt
import random

import pytest

from jobsieve.sources import sinks
from jobsieve.streaming import jobs
from jobsieve.streaming.arrivals import first_arrivals_stream

SCHEMA = "Job_ID string, arrival bigint, Description string, at timestamp, big bigint, tags array<string>, body struct<x:string>"
START = dt.datetime(2024, 1, 1)
HOUR = 3600


def post(key, arrival, hours, text="x", big=None):
    at = None if hours is None else START + dt.timedelta(hours=hours)
    return (key, arrival, text, at, big, ["a", None] if arrival and arrival % 2 else None, ("y",) if big else None)


def streamed(spark, tmp_path, batches, **options):
    source, table, progress = (str(tmp_path / n) for n in ("source", "table", "progress"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(4).write.mode("append").parquet(source)
        stream = first_arrivals_stream(spark.readStream.schema(schema).parquet(source), **options)
        jobs.start(stream, jobs.upsert_sink(table), progress, available_now=True).awaitTermination()
    return [tuple(r)[: len(schema)] for r in sinks.read_versions(spark, table, schema).select(*schema.names).collect()]


def simulated(batches, ttl=None, delay=0):
    """(key, arrival) that pass: one dictionary of expiry times, one watermark."""
    known, mark, out = {}, dt.datetime.min, []
    for rows in batches:
        rows = [r for r in rows if r[0] is not None and r[2] and (ttl is None or r[3] is not None)]
        for key in {r[0] for r in rows}:
            if key not in known or (ttl is not None and known[key] <= mark):
                first = min((r for r in rows if r[0] == key), key=lambda r: r[1])
                known[key] = max(first[3], mark) + dt.timedelta(hours=ttl) if ttl is not None else None
                out.append((key, first[1]))
        if ttl is not None and rows:
            mark = max(mark, max(r[3] for r in rows) - dt.timedelta(hours=delay))
    return sorted(out)


def test_order_inside_a_batch_is_exact(spark, tmp_path):
    rng = random.Random(5)
    batches = []
    for b in range(3):
        arrivals = rng.sample(range(b * 4000, b * 4000 + 4000), 3000)
        # A third of all rows share one key; some lack a key or a text.
        batches.append(
            [post("hot" if a % 3 == 0 else rng.choice([None, *map(str, range(900))]), a, 0, rng.choice(["", None, "x", "x"])) for a in arrivals]
        )
    got = streamed(spark, tmp_path, batches)
    assert sorted((r[0], r[1]) for r in got) == simulated(batches)


def test_keys_are_forgotten_after_their_time(spark, tmp_path):
    rng = random.Random(6)
    batches = []
    for b in range(4):
        rows = [post("hot" if i % 3 == 0 else str(rng.randrange(60)), b * 1000 + i, b * 4 + rng.randrange(600) / 60) for i in range(600)]
        rng.shuffle(rows)
        batches.append([*rows, post("late", b, b / 10), post("timeless", b, None), post(None, b, 1)])
    got = sorted((r[0], r[1]) for r in streamed(spark, tmp_path, batches, event_time="at", ttl_seconds=3 * HOUR, delay="5 hours"))
    assert got == simulated(batches, ttl=3, delay=5)
    passes = [k for k, _ in got]
    assert passes.count("hot") > 1 and passes.count("late") > 1 and "timeless" not in passes


@pytest.mark.parametrize("timed", [False, True])
def test_rows_come_back_whole(spark, tmp_path, timed):
    big = 2**53 + 1
    rows = [post("a", 1, 1, big=big), post("b", 2, 1), post("b", 2, 1), post("c", None, 1), post("c", 3, 2, big=-big)]
    options = {"event_time": "at", "ttl_seconds": HOUR} if timed else {}
    got = {r[0]: r for r in streamed(spark, tmp_path, [rows, []], **options)}
    assert {k: (r[1], r[4], r[5]) for k, r in got.items()} == {"a": (1, big, ["a", None]), "b": (2, None, None), "c": (3, -big, ["a", None])}
    assert got["a"][6].x == "y" and got["b"][6] is None and got["a"][3] == START + dt.timedelta(hours=1)


def test_plan_cuts_before_the_shuffle(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    (tmp_path / "none").mkdir()
    stream = first_arrivals_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "none")))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert plan.index("FlatMapGroupsInPandasWithState") < plan.rindex("MapInArrow")
