"""Small helpers shared by the corpus operators."""

import ctypes
import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ..session import scratch_dir

#: A-Z to a-z, and every other ASCII byte that is neither a digit nor a letter to a space.
_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df, name, rows=0):
    """Write to the shared scratch folder and read back: cuts the lineage and survives lost executors.

    ``rows`` bounds the rows of a file, which are written and read as one: for rows that are large.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def alnum_words(data):
    """Words of letters, digits and non-ASCII characters of UTF-8 bytes, A-Z lower-cased."""
    return data.translate(_ALNUM).split()


def key128(data):
    """Two signed 64-bit halves of a digest."""
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def mix64(x):
    """Finaliser of a 64-bit hash over an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word, kept for repeated words up to a bound."""

    def __init__(self, bound=100_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word):
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= self.bound:
            self.clear()
        self[word] = h
        return h

    def of(self, words):
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Best:
    """The k best rows per anchor and window so far: highest scores first, ties to the smaller id."""

    def __init__(self, anchors, windows, k):
        self.k = k
        self.scores = np.full((anchors, windows, k), -np.inf)
        self.ids = np.full((anchors, windows, k), np.iinfo(np.int64).max)
        self.kth = np.full((anchors, windows), -np.inf)

    def add(self, w, q, ids, scores):
        """Candidates of window w: per anchor, the best k of the old and the new ones."""
        own, start = np.unique(q, return_index=True)  # q is sorted
        for a, s, e in zip(own.tolist(), start, np.append(start[1:], len(q)), strict=True):
            both = np.concatenate([self.scores[a, w], scores[s:e]])
            names = np.concatenate([self.ids[a, w], ids[s:e]])
            keep = np.lexsort((names, -both))[: self.k]
            self.scores[a, w], self.ids[a, w] = both[keep], names[keep]
            self.kth[a, w] = both[keep[-1]]


def text_bytes(column):
    """The UTF-8 bytes of a text column; NULL is the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def rows_of(batch, *names, step=500):
    """Rows of an Arrow batch, with bytes columns taken as Python bytes, a few at a time."""
    for at in range(0, len(batch), step):
        yield from zip(*(batch.column(n).slice(at, step).to_pylist() for n in names), strict=True)


def give_back():
    """Return what a task has freed to the system: workers are used again and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(spark, rows=1_000):
    """From now on no more than so many rows, often of long texts, go to Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def batch_of(columns, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def packed(df, *own):
    """(df with the columns `own` and all its columns as one struct `row`): clashing names cannot meet."""
    return df.select(*own, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def fresh(name):
    return f"{name}_{uuid.uuid4().hex}"
