"""First arrivals per key of an unbounded stream: ordered inside a micro-batch, forgotten after a time."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.clean import require_non_empty


def _written(rows):
    """Each row as the bytes of an Arrow stream of its own: values of all types pass pandas unharmed in this form."""
    schema = rows.schema.serialize().to_pybytes()  # the same for all, so it is made once
    return [schema + rows.slice(i, 1).serialize().to_pybytes() for i in range(len(rows))]


def _table(rows):
    return pa.Table.from_batches([part for row in rows for part in pa.ipc.open_stream(row)])


def _place_of_first(keys, order):
    return keys.sort_values([*order, "tie"], kind="stable", na_position="last").index[0]


def _read(batches):
    for batch in batches:
        if len(batch):
            for body in _table(batch.column("row").to_pylist()).combine_chunks().column("body").chunks:
                yield pa.RecordBatch.from_struct_array(body)


def _firsts(order, timed):
    """Rows of each Arrow batch that may be the first of their key, and a mark with the latest time, which is no row.

    A key passes at most once in a micro-batch, with its first row, so dropping the later rows of a batch changes
    no result. Only marks have a time (``at``) that Spark sees: they move the watermark as all rows would, and no
    other row is taken as late.
    """

    def cut(batches):
        for batch in batches:
            if not len(batch):
                continue
            keys = pa.Table.from_batches([batch.select(["key", *order, "tie", "ms"])]).to_pandas()
            ranked = keys.sort_values([*order, "tie"], kind="stable", na_position="last")
            take = ranked.index[~ranked["key"].duplicated()].to_numpy()
            mark = np.zeros(len(take), bool)
            if keys["ms"].notna().any():
                take, mark = np.append(take, keys["ms"].idxmax()), np.append(mark, True)
            kept = batch.take(pa.array(take))
            rows = pa.array(_written(kept.select([*order, "tie", "ms", "body"])), pa.binary(), mask=mark)
            columns = [kept.column("key"), rows]
            if timed:
                at = kept.column("at")
                columns.append(pc.if_else(pa.array(mark), at, pa.scalar(None, at.type)))
            yield pa.RecordBatch.from_arrays(columns, ["key", "row", "at"][: len(columns)])

    return cut


def _arrival(order, ttl_ms):
    """Per key: let the first row pass where the key is not known (any more), and remember it."""

    def settle(key, chunks, state):
        if state.hasTimedOut:
            state.remove()
            return
        watermark = state.getCurrentWatermarkMs() if ttl_ms is not None else 0
        if state.exists and (ttl_ms is None or state.get[0] > watermark):
            if ttl_ms is not None:
                state.setTimeoutTimestamp(state.get[0])
            return
        first = None
        for chunk in chunks:
            rows = [row for row in [first, *chunk["row"]] if row is not None]
            if rows:
                # Most keys have one row.
                place = _place_of_first(_table(rows).select([*order, "tie"]).to_pandas(), order) if len(rows) > 1 else 0
                first = rows[place]
        if first is None:
            if state.exists:
                state.remove()
            return
        expiry = 0 if ttl_ms is None else max(_table([first]).column("ms")[0].as_py(), watermark) + ttl_ms
        state.update((expiry,))
        if ttl_ms is not None:
            state.setTimeoutTimestamp(expiry)
        yield pd.DataFrame({"row": [first]})

    return settle


def first_arrivals_stream(
    df: DataFrame, key="Job_ID", order="arrival", column="Description", event_time=None, ttl_seconds=None, delay="0 seconds"
) -> DataFrame:
    """Per key the first post with a non-empty ``column``, across all micro-batches; the first by ``order`` inside one.

    Rows that tie in ``order`` are settled by content, and a NULL order comes last. With ``ttl_seconds`` a key is
    forgotten once the watermark (latest ``event_time`` so far, less ``delay``) reaches the time of its first post plus
    that many seconds; its next post then passes again. A post that comes later than the watermark counts as one of the
    watermark's time: none is lost for being late. Left out are posts without a key and, with ``ttl_seconds``, without
    an event time. Columns may have any names.

    Repeats are cut to one row per key and Arrow batch before the shuffle, so a key with a third of all rows sends one
    row in ten thousand. The state holds one number per key.
    """
    order = [order] if isinstance(order, str) else list(order)
    by, sorting = [], []
    for i, o in enumerate(order):
        value, kind = F.col(f"`{o}`"), df.schema[o].dataType
        # Whole numbers without NULLs stay whole in pandas.
        known = F.coalesce(value, F.lit(0).cast(kind)) if isinstance(kind, T.IntegralType) else value
        by += [f"n{i}", f"o{i}"]
        sorting += [value.isNull().alias(f"n{i}"), known.alias(f"o{i}")]
    given = require_non_empty(df, column).filter(F.col(f"`{key}`").isNotNull())
    fields = [F.col(f"`{c}`") for c in df.columns]
    timed = ttl_seconds is not None
    if timed:
        given = given.filter(F.col(f"`{event_time}`").isNotNull())
        at = F.col(f"`{event_time}`").cast("timestamp")
    else:
        at = F.lit(None).cast("timestamp")
    rows = given.select(
        F.col(f"`{key}`").alias("key"),
        *sorting,
        F.xxhash64(*fields).alias("tie"), F.unix_millis(at).alias("ms"), at.alias("at"),
        F.struct(*fields).alias("body"),
    )
    body = rows.schema["body"].dataType
    sent = [rows.schema["key"], T.StructField("row", T.BinaryType()), rows.schema["at"]][: 3 if timed else 2]
    rows = rows.mapInArrow(_firsts(by, timed), T.StructType(sent))
    if timed:
        rows = rows.withWatermark("at", delay)
    passed = rows.groupBy("key").applyInPandasWithState(
        _arrival(by, int(ttl_seconds * 1000) if timed else None), "row binary", "expiry bigint", "append",
        GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout,
    )
    return passed.mapInArrow(_read, body)
