"""Streaming jobs: enrichment, keyed deduplication, fan-out, replay."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import insights
from ..operators.clean import decode_payload, drop_fields, require_non_empty, split_quarantine
from ..operators.dedupe import dedupe_first, reject_known
from ..plans.enrich import enrich_posts
from ..schemas import POST
from ..sources.key_index import KeyIndex
from ..sources.keyed_state import KeyedState
from ..sources.sinks import append_version, merge_by_key, read_versions, to_payload, write_topic


def start(df: DataFrame, write_batch, checkpoint, run=0, available_now=False, query_name=None):
    """Start a query that hands every micro-batch to ``write_batch(df, batch_id, run)``.

    Progress is kept under ``checkpoint/run=<run>``. A restart with the same run resumes; a new
    run number replays the source from its beginning, and its versions supersede the old ones.
    """
    writer = df.writeStream.option("checkpointLocation", f"{checkpoint}/run={run}")
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, run)).start()


def upsert_sink(table, partition_by=()):
    """A ``write_batch`` that adds the micro-batch to a keyed table."""

    def write(batch, batch_id, run):
        append_version(batch, table, batch_id, run, partition_by)

    return write


def topic_sink(target, fmt="kafka", **options):
    """A ``write_batch`` that sends JSON payloads to a topic or folder (at least once)."""

    def write(batch, batch_id, run):
        write_topic(batch, target, fmt, **options)

    return write


def payload_version_sink(folder):
    """A ``write_batch`` for JSON payload files that a repeated micro-batch replaces."""

    def write(batch, batch_id, run):
        to_payload(batch).write.mode("overwrite").text(f"{folder}/run={run}/batch={batch_id}")

    return write


def counts_sink(state, counts, schema, key="Job_ID", order=(), compact_every=0):
    """A ``write_batch`` that keeps the counts of all insights up to date with an upserted table of enriched posts.

    The rows of a micro-batch replace those of their keys in ``state`` (``KeyedState``); what that changes in the counts is
    written as signed differences to ``counts``, so a batch costs what its keys cost, whatever the tables hold.
    Repeated batches replace their own output, and a replay under a new run number corrects counts instead of adding to them.
    ``compact_every`` batches the state is put together; ``current_counts`` reads the counts.
    """

    def write(batch, batch_id, run):
        table = KeyedState(batch.sparkSession, state, schema, key)
        old, new = table.upsert(batch, batch_id, run, order)
        try:
            append_version(insights.signed_counts(old, new), counts, batch_id, run)
        finally:
            old.unpersist()
            new.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            table.compact()

    return write


def fan_out(sinks):
    """A ``write_batch`` that gives one micro-batch to several sinks, computing it once."""

    def write(batch, batch_id, run):
        batch = batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id, run)
        finally:
            batch.unpersist()

    return write


def enrich_stream(payloads: DataFrame, dicts=None, schema=POST, labeler=None) -> DataFrame:
    """Payload rows to enriched posts; payloads without a Job_ID are left out."""
    good, _ = split_quarantine(decode_payload(payloads, schema))
    return enrich_posts(good, dicts, labeler)


def run_stream(
    payloads, table, checkpoint, dicts=None, run=0, available_now=False, labeler=None, quarantine=None, key="Job_ID",
    order=(), lexicon=None, also=(),
):
    """The enrichment job: decode, normalise, extract, categorise, upsert by key.

    Updates of one key in a micro-batch are merged in the source's ``order`` (columns of the payload rows, by default
    the offset where the source has one). Payloads that do not decode, or have no key, are kept as they came
    in the folder ``quarantine`` where one is given. ``lexicon`` may be a table of any size (``plans.enrich``). Other sinks
    of the enriched rows, such as ``counts_sink``, are given in ``also``.
    """
    order = list(order) or [c for c in ("offset", "partition") if c in payloads.columns]

    def write(batch, batch_id, run):
        # Files have as many splits as cores, and yet few row groups that hold rows: payloads are dealt out, which costs
        # far less than to enrich them in a few tasks.
        cores = batch.sparkSession.sparkContext.defaultParallelism
        batch = batch.select("value", *order).repartition(cores)
        if quarantine:  # read twice
            batch = batch.persist()
        try:
            good, bad = split_quarantine(decode_payload(batch, keep=["value", *order]), [key])
            if quarantine:
                append_version(bad.select(F.col("value").cast("string")), quarantine, batch_id, run)
            rich = enrich_posts(good.drop("value"), dicts, labeler, key, lexicon=lexicon)
            versions = rich.withColumns({"run": F.lit(0), "batch": F.lit(0)})
            rows = merge_by_key(versions, key, order).drop(*order)
            (fan_out([upsert_sink(table), *also]) if also else upsert_sink(table))(rows, batch_id, run)
        finally:
            if quarantine:
                batch.unpersist()

    return start(payloads, write, checkpoint, run, available_now)


def dedupe_stream(df: DataFrame, key="Job_ID", column="Description", salt=8, ttl=None, event_time=None) -> DataFrame:
    """Unbounded deduplication: per key the first non-empty post passes, across all batches.

    Keys are kept in the state store. Repeats of a hot key are first dropped per (key, salt),
    spread over ``salt`` tasks, so that only a handful ever meet at the final stage. Which of
    several posts in one micro-batch is first is not defined; ``ingest_sink`` is exact there.
    With ``ttl`` and ``event_time`` keys are forgotten after that time.
    """
    df = require_non_empty(df, column)
    if ttl is not None:
        return df.withWatermark(event_time, ttl).dropDuplicatesWithinWatermark([key])
    if salt > 1:
        # By chance, not by content: exact repeats are the usual hot key.
        spread = F.floor(F.rand() * salt).cast("int")
        df = df.withColumn("_salt", spread).dropDuplicates([key, "_salt"]).drop("_salt")
    return df.dropDuplicates([key])


def dedupe_with_table(batch: DataFrame, table: DataFrame, key="Job_ID", order="arrival", column="Description") -> DataFrame:
    """Posts of a batch that are new, or that fill a row whose Description was empty."""
    return reject_known(dedupe_first(drop_fields(batch), key, order, column), table, key, column)


def ingest_sink(table, schema, key="Job_ID", order="arrival", column="Description", forward=(), quarantine=None, raw=None):
    """A ``write_batch`` for the ingest job: dedupe against the table, store, forward.

    Rows that tie in ``order`` come in the order of their places in the source. Rows without a key, malformed lines among
    them, are no posts; they go to the folder ``quarantine`` where one is given, with the malformed line in ``raw``.

    Keys of stored rows that have a Description lie in an index beside the table, in hash buckets: a micro-batch reads
    the buckets of its own keys, however large the table is. The first batch builds the index where there is none. Rows
    are stored before their keys are, so a batch that was cut off is repeated in full; a repeated batch ignores
    its own earlier output and gives the same result. ``KeyIndex.compact`` puts the files of many batches together.
    """

    def write(batch, batch_id, run):
        index = KeyIndex(batch.sparkSession, f"{table.rstrip('/')}_keys", key)
        if index.generation() is None:
            columns = T.StructType([*schema.fields, T.StructField("has_text", T.BooleanType())])
            stored = read_versions(batch.sparkSession, table, columns)
            index.rebuild(stored.filter("has_text").select(key, "run", "batch"))
        good, bad = split_quarantine(drop_fields(batch), [key])
        if quarantine:
            append_version(bad, quarantine, batch_id, run)
        # Taken before any shuffle, the number follows the place in the source.
        good = (good.drop(raw) if raw else good).withColumn("_place", F.monotonically_increasing_id())
        by = [order] if isinstance(order, str) else list(order)
        first = dedupe_first(good, key, [*by, "_place"], column).drop("_place").persist()
        try:
            # Seeded rows carry a negative batch number and belong to every run.
            earlier = (F.col("batch") < 0) | ((F.col("run") == run) & (F.col("batch") < batch_id))
            known = index.known(first).filter(earlier).select(key).distinct()
            fresh = first.join(known, key, "left_anti")
            sinks = [
                lambda b, i, r: append_version(b.withColumn("has_text", F.lit(True)), table, i, r, ["has_text"]),
                index.add,
                *forward,
            ]
            fan_out(sinks)(fresh, batch_id, run)
        finally:
            first.unpersist()

    return write
