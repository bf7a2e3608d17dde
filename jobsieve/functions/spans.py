"""Span decoding of Arrow batches, for the relational decoder: Spark brings the rows of a chunk together."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
# A place is one growing number made of the position and one of these marks.
MARKS = 4
# Chunks that are decoded in one go.
CHUNKS = 100


def decoded(batches: Iterator[pa.RecordBatch], mode, border) -> Iterator[pa.RecordBatch]:
    """Spans closed inside their chunk, or with ``border`` the rows that a span across a border of it could hold.

    Batches hold a chunk a row: (doc, chunk, rows) with its rows as (place, token) in any order.
    """
    for batch in batches:
        for k in range(0, batch.num_rows, CHUNKS):
            yield from _decoded(batch.slice(k, CHUNKS), mode, border)


def _decoded(chunks, mode, border):
    rows = chunks["rows"].flatten()
    places, tokens = rows.field("place"), rows.field("token")
    place = pc.fill_null(places, 0).to_numpy()
    chunk = np.repeat(np.arange(chunks.num_rows), pc.list_value_length(chunks["rows"]).to_numpy())
    pos, at = place // MARKS, np.arange(len(place))
    tied = bool(np.any((chunk[1:] == chunk[:-1]) & (pos[1:] <= pos[:-1])))
    if tied:  # rows that came in another order, or positions that repeat
        at = np.lexsort((place, chunk))
        place, pos, chunk = place[at], pos[at], chunk[at]
    mark = place % MARKS
    head = np.maximum.accumulate(np.where(mark == INSIDE, -1, np.arange(len(place))))
    last = np.flatnonzero(np.append(chunk[1:] != chunk[:-1], len(chunk) > 0))
    last_head = np.repeat(head[last], np.diff(last, prepend=-1))
    # The last head of a chunk may go on in the next one; rows without a position have no chunk.
    settled = (head >= 0) & (chunk[head] == chunk) & (place[head] < place[last_head])
    settled &= chunks["chunk"].is_valid().to_numpy(False)[chunk]
    if border:
        left = np.flatnonzero(~settled)
        missing = places.is_null().to_numpy(False)[at[left]]
        yield pa.RecordBatch.from_arrays(
            [
                chunks["doc"].take(pa.array(chunk[left])),
                pa.array(pos[left], pa.int64(), mask=missing),
                pa.array(place[left], pa.int64(), mask=missing | (mark[left] == INSIDE)),
                tokens.take(pa.array(at[left])),
            ],
            ["doc", "pos", "place", "token"],
        )
        return
    members = np.flatnonzero(settled & (mark != OUTSIDE) & ((mode == "conll") | (mark[head] == BEGIN)))
    opener = place[head[members]]
    opens = np.ones(len(members), bool)
    opens[1:] = (chunk[members][1:] != chunk[members][:-1]) | (opener[1:] != opener[:-1])
    first = np.flatnonzero(opens)
    ends = np.append(first, len(members))
    texts = tokens.take(pa.array(at[members]))
    if tied:  # equal positions go by text
        keys = pa.table({"span": np.cumsum(opens), "pos": pos[members], "text": texts})
        texts = texts.take(pc.sort_indices(keys, [(name, "ascending") for name in keys.column_names]))
    yield pa.RecordBatch.from_arrays(
        [
            chunks["doc"].take(pa.array(chunk[members[first]])),
            pa.array(pos[members[first]]),
            pa.array(pos[members[ends[1:] - 1]]),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), texts),
        ],
        ["doc", "start", "end", "tokens"],
    )
