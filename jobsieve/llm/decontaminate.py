"""Benchmark decontamination: a broadcast hash set of test n-grams against all token windows of the corpus.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. Every `n` consecutive words of a
benchmark item are a window; an item of fewer words, but not none, is one window. Window hashes are found by
a rolling pass over whole texts, every hit is then verified word by word.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import GOLDEN, WordHashes, alnum_words, mix64, rows_of, stored, text_bytes

#: Words of benchmark items that are sent to the tasks at once; a larger benchmark is taken in blocks of this size.
BLOCK_WORDS = 2_000_000
#: A sequence of windows of one length; the same for every length below it that items have.
WINDOW = 13

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def rolling(hashes, n):
    """One hash for each `n` consecutive word hashes."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = mix64(out + hashes[k : len(hashes) - n + 1 + k] + GOLDEN)
    return out


class WindowSet:
    """Windows of a block of items: per length the sorted hashes, and the items and words of each hash."""

    def __init__(self, items, n):
        hashes = WordHashes()
        self.vocabulary, self.windows = set(), {}
        for item, text in items:
            words = alnum_words(text)
            if not words:
                continue
            size = min(n, len(words))
            self.vocabulary.update(words)
            of_size = self.windows.setdefault(size, {})
            for i, h in enumerate(rolling(hashes.of(words), size).tolist()):
                of_size.setdefault(h, {}).setdefault(tuple(words[i : i + size]), set()).add(item)
        self.sorted = {size: np.sort(np.fromiter(w, np.uint64, len(w))) for size, w in self.windows.items()}

    def find(self, words, hashes):
        """(start, length, items) of every occurrence."""
        known = np.fromiter(map(self.vocabulary.__contains__, words), bool, len(words))
        runs = np.concatenate([[0], np.cumsum(known)])
        for size, targets in self.sorted.items():
            if len(words) < size:
                continue
            # Only places where all words of the window are words of the benchmark are hashed.
            at = np.flatnonzero(runs[size:] - runs[:-size] == size)
            if not len(at):
                continue
            value = np.zeros(len(at), np.uint64)
            for k in range(size):
                value = mix64(value + hashes[at + k] + GOLDEN)
            near = np.minimum(np.searchsorted(targets, value), len(targets) - 1)
            for i in np.flatnonzero(targets[near] == value):
                start = int(at[i])
                items = self.windows[size][int(value[i])].get(tuple(words[start : start + size]))
                if items is not None:
                    yield start, size, items


def _blocks(benchmark):
    """The items in blocks of bounded size, read one after the other."""
    rows = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_bytes("text").alias("text"))
        .distinct()
        .toLocalIterator()
    )
    block, size = [], 0
    for r in rows:
        block.append((r.item_id, bytes(r.text)))
        size += len(r.text) // 2 + 1
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def scan(docs, benchmark, n=WINDOW):
    """All rows of `docs` with ``n_words``, ``hits`` (start and length of matched windows, in words) and ``items``.

    A benchmark beyond one block is matched by one narrow pass per block over the same rows: no join, no
    shuffle. The rows are written after each block but the last, whose windows are given back then, so no task ever
    holds more than one. Without a benchmark, words are counted alone. NULL texts have no words. Items without an id mark words but are
    not listed; items that share an id are one item. Extra columns stay; columns named like a result are replaced.
    """
    spark = docs.sparkSession
    own = ("n_words", "hits", "items")
    kept = [c for c in docs.columns if c not in own]
    names = [f"c{i}" for i in range(len(kept))]
    out = docs.select(
        *[F.col(f"`{c}`").alias(x) for c, x in zip(kept, names, strict=True)],
        text_bytes("text").alias("words"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast("array<bigint>").alias("starts"),
        F.array().cast("array<bigint>").alias("sizes"),
        F.array().cast("array<string>").alias("items"),
    )
    types = {f.name: f.dataType.simpleString() for f in out.schema}
    schema = ", ".join(f"{c} {t}" for c, t in types.items())
    blocks = _blocks(benchmark)
    block = next(blocks, [])
    while block is not None:
        windows = spark.sparkContext.broadcast(WindowSet(block, n))

        def match(batches, windows=windows):
            target, hashes = windows.value, WordHashes()
            for batch in batches:
                found = {"n_words": [], "starts": [], "sizes": [], "items": []}
                for text, starts, sizes, items in rows_of(batch, "words", "starts", "sizes", "items"):
                    words = alnum_words(text)
                    items = set(items)
                    for start, size, which in target.find(words, hashes.of(words)):
                        starts.append(start)
                        sizes.append(size)
                        items.update(i for i in which if i is not None)
                    for k, v in zip(found, (len(words), starts, sizes, sorted(items)), strict=True):
                        found[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found[f.name], f.type) if f.name in found else batch.column(f.name)
                        for f in batch.schema
                    ],
                    names=batch.schema.names,
                )

        out = out.mapInArrow(match, schema)
        block = next(blocks, None)
        if block is not None:
            out = stored(out, "matched")
            windows.destroy()
    columns = [F.col(x).alias(c) for c, x in zip(kept, names, strict=True)]
    return out.select(*columns, "n_words", F.arrays_zip("starts", "sizes").alias("hits"), "items")


def hit_words(hits):
    """How many words lie in any of the windows."""
    zero = F.lit(0).cast("bigint")

    def add(seen, hit):
        stop = hit["starts"] + hit["sizes"]
        more = F.greatest(zero, stop - F.greatest(hit["starts"], seen["end"]))
        return F.struct(F.greatest(seen["end"], stop).alias("end"), (seen["total"] + more).alias("total"))

    start = F.struct(zero.alias("end"), zero.alias("total"))
    return F.aggregate(F.array_sort(hits), start, add, lambda seen: seen["total"])


def report(docs, benchmark, n=WINDOW, share=20):
    """The rows of `scan` with ``n_hit``, ``n_items`` and ``contaminated``: at least one word in `share` is hit."""
    found = scan(docs, benchmark, n).withColumn("n_hit", hit_words("hits"))
    return found.withColumn("n_items", F.size("items").cast("bigint")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    )


def cut_words(text, hits):
    """The text without the words of the given (start, length) windows; the rest stays as it is."""
    gone = set()
    for start, size in hits:
        gone.update(range(start, start + size))
    out, end = [], 0
    for i, m in enumerate(_WORD.finditer(text)):
        if i in gone:
            out.append(text[end : m.start()])
            end = m.end()
    return "".join([*out, text[end:]])


def decontaminate(docs, benchmark, remove="documents", n=WINDOW, share=20):
    """`docs` less its contaminated documents, or (``remove="spans"``) with the hit words cut from their texts."""
    if remove == "documents":
        found = report(docs, benchmark, n, share)
        return found.filter(~F.col("contaminated")).select(*[f"`{c}`" for c in docs.columns])
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, sizes: pd.Series) -> pd.Series:
        rows = zip(texts, starts, sizes, strict=True)
        return pd.Series([cut_words(t, zip(a, b, strict=True)) if len(a) else t for t, a, b in rows], dtype=object)

    found = scan(docs, benchmark, n)
    return found.select(*[cut("text", "hits.starts", "hits.sizes").alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
