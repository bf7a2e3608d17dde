"""Reversible line deduplication: sharded cuckoo filters over exact reference counts.

State of a corpus, as Parquet in a shared folder:

* ``refs/batch=N``: one row per (line key, document) of each insertion, and one with negative ``refs`` per
  deletion. Their sum is the exact reference-count table.
* ``frequent/version=N``: keys held by at least ``min_docs`` documents, with the largest ``doc_id``.
* ``filters/version=N``: one cuckoo filter per shard over the frequent keys. Fingerprints are put in when a
  key becomes frequent and taken out when deletions make it rare again, so nothing has to be rebuilt.

A cleaning pass asks the filters about every line; only lines that may be frequent meet the exact table.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import batch_of, key128, rows_of, text_bytes

SPACE = b" \t\n\x0b\x0c\r"
SLOTS = 4
KICKS = 500
#: Filters of up to this size are sent to every task; beyond it every line meets the exact table.
FILTER_BYTES = 32 << 20
#: A shard is one group of one task; more keys than this on average double the number of shards.
KEYS_PER_SHARD = 500_000

POSTING = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64()), ("refs", pa.int64())])
HIT = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("doc_id", pa.int64())])


def line_key(line, min_chars):
    """128-bit key of a line, or None for lines of fewer than `min_chars` code points."""
    line = line.strip(SPACE).lower()  # bytes: A-Z only
    if len(line) < min_chars or len(line) < 4 * min_chars and len(line.decode("utf-8", "replace")) < min_chars:
        return None
    return key128(line)


class CuckooFilter:
    """16-bit fingerprints in buckets of four; the second bucket of a key follows from the first."""

    def __init__(self, cells):
        self.cells = cells
        self.mask = len(cells) // SLOTS - 1

    @classmethod
    def sized(cls, keys):
        buckets = 1
        while buckets * SLOTS * 0.85 < keys + 1:
            buckets *= 2
        return cls(np.zeros(buckets * SLOTS, np.uint16))

    @staticmethod
    def fingerprint(k2):
        return np.uint16(k2 & 0xFFFF or 1)

    def buckets(self, k1, fp):
        i = k1 & self.mask
        return i, self.other(i, fp)

    def other(self, i, fp):
        return (i ^ ((int(fp) * 0x5BD1E995) >> 3)) & self.mask

    def _place(self, i, fp):
        cells = self.cells[i * SLOTS : (i + 1) * SLOTS]
        free = np.flatnonzero(cells == 0)
        if len(free):
            cells[free[0]] = fp
        return len(free) > 0

    def insert(self, k1, k2):
        """False if no place was found; the caller rebuilds a larger filter from the exact table."""
        fp = self.fingerprint(k2)
        i, j = self.buckets(k1, fp)
        if self._place(i, fp) or self._place(j, fp):
            return True
        for kick in range(KICKS):
            cells = self.cells[j * SLOTS : (j + 1) * SLOTS]
            fp, cells[kick % SLOTS] = cells[kick % SLOTS].copy(), fp
            j = self.other(j, fp)
            if self._place(j, fp):
                return True
        return False

    def delete(self, k1, k2):
        fp = self.fingerprint(k2)
        for i in self.buckets(k1, fp):
            at = np.flatnonzero(self.cells[i * SLOTS : (i + 1) * SLOTS] == fp)
            if len(at):
                self.cells[i * SLOTS + at[0]] = 0
                return True
        return False

    def may_contain(self, k1, k2):
        fp = self.fingerprint(k2)
        i, j = self.buckets(k1, fp)
        cells = self.cells
        return fp in cells[i * SLOTS : (i + 1) * SLOTS] or fp in cells[j * SLOTS : (j + 1) * SLOTS]

    def contains_all(self, k1, k2):
        """Vector form of may_contain."""
        fp = (k2 & 0xFFFF).astype(np.uint16)
        fp[fp == 0] = 1
        i = k1 & self.mask
        j = (i ^ ((fp.astype(np.int64) * 0x5BD1E995) >> 3)) & self.mask
        grid = self.cells.reshape(-1, SLOTS)
        return ((grid[i] == fp[:, None]) | (grid[j] == fp[:, None])).any(axis=1)


def _build(keys):
    size = len(keys)
    while True:
        filled = CuckooFilter.sized(size)
        if all(filled.insert(a, b) for a, b in keys):
            return filled
        size = max(2 * size, 8)


class LineState:
    """Line counts of a corpus that grows and shrinks by documents.

    Documents are rows with ``doc_id`` and ``text``. NULL text is one empty line. Rows that share an id are one
    document. Rows without an id are counted for nothing and keep all their lines. Deleting takes the same
    texts that were inserted; the state is then the same as if they had never come.
    """

    def __init__(self, spark, path, min_docs=5, min_chars=40):
        self.spark, self.path = spark, path
        self.min_docs, self.min_chars = min_docs, min_chars
        self.version, self.shards = 0, 1

    def insert(self, docs):
        return self._apply(docs, 1)

    def delete(self, docs):
        return self._apply(docs, -1)

    def _postings(self, docs, sign):
        min_chars = self.min_chars

        def scan(batches):
            for batch in batches:
                out = []
                for doc_id, text in rows_of(batch, "doc_id", "text"):
                    refs = {}
                    for line in text.split(b"\n"):
                        if key := line_key(line, min_chars):
                            refs[key] = refs.get(key, 0) + sign
                    out += [(*key, doc_id, n) for key, n in refs.items()]
                yield batch_of(list(zip(*out, strict=True)) or [[]] * 4, POSTING)

        ided = docs.filter(F.col("doc_id").isNotNull()).select(
            F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text")
        )
        return ided.mapInArrow(scan, "k1 bigint, k2 bigint, doc_id bigint, refs bigint")

    def _read(self, name, schema):
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}/version={self.version}")

    def frequent(self):
        return self._read("frequent", "k1 bigint, k2 bigint, n_docs bigint, last_doc bigint")

    def filters(self):
        return self._read("filters", "shard bigint, cells binary")

    def _refs(self):
        # The batches are named one by one: a folder of a failed or parallel run is never taken in.
        paths = [f"{self.path}/refs/batch={n}" for n in range(1, self.version + 1)]
        return self.spark.read.schema("k1 bigint, k2 bigint, doc_id bigint, refs bigint").parquet(*paths)

    def counts(self, refs=None):
        """Exact counts. Documents of one key are first settled apart, so a hot key never meets in one task."""
        held = (refs if refs is not None else self._refs()).groupBy("k1", "k2", "doc_id").agg(F.sum("refs").alias("n"))
        return (
            held.filter("n > 0")
            .groupBy("k1", "k2")
            .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        )

    def _apply(self, docs, sign):
        batch = self.version + 1
        self._postings(docs, sign).write.parquet(f"{self.path}/refs/batch={batch}")
        before = self.frequent() if self.version else None
        filters = self.filters() if self.version else None
        self.version = batch
        refs, old_rest = self._refs(), None
        if before is not None:
            touched = (
                self.spark.read.schema("k1 bigint, k2 bigint")
                .parquet(f"{self.path}/refs/batch={batch}")
                .distinct()
            )
            refs = refs.join(touched, ["k1", "k2"], "left_semi")
            old_rest = before.join(touched, ["k1", "k2"], "left_anti")
        now = self.counts(refs).filter(F.col("n_docs") >= self.min_docs)
        now = now if old_rest is None else now.unionByName(old_rest)
        now.write.parquet(f"{self.path}/frequent/version={batch}")
        self._update_filters(before, filters)
        return self

    def _shard(self):
        return F.pmod(F.shiftright("k1", 40), F.lit(self.shards)).alias("shard")

    def _update_filters(self, before, filters):
        now = self.frequent().select("k1", "k2")
        total, shards = now.count(), self.shards
        while total / shards > KEYS_PER_SHARD:
            shards *= 2
        target = f"{self.path}/filters/version={self.version}"
        if before is None or shards != self.shards:
            self.shards = shards
            self._rebuilt(now).write.parquet(target)
            return
        old = before.select("k1", "k2")
        changes = now.join(old, ["k1", "k2"], "left_anti").withColumn("sign", F.lit(1)).unionByName(
            old.join(now, ["k1", "k2"], "left_anti").withColumn("sign", F.lit(-1))
        )

        def update(_key, old, changes):
            shard = int((old if len(old) else changes)["shard"].iloc[0])
            cells = np.frombuffer(old["cells"].iloc[0], np.uint16).copy() if len(old) else np.zeros(SLOTS, np.uint16)
            filled, ok = CuckooFilter(cells), True
            for k1, k2, sign in changes.sort_values("sign")[["k1", "k2", "sign"]].itertuples(index=False):
                ok = ok and (filled.insert(k1, k2) if sign > 0 else filled.delete(k1, k2))
            return pd.DataFrame({"shard": [shard], "cells": [filled.cells.tobytes() if ok else None]})

        updated = (
            filters.groupBy("shard")
            .cogroup(changes.select(self._shard(), "k1", "k2", "sign").groupBy("shard"))
            .applyInPandas(update, "shard bigint, cells binary")
        )
        tried = f"{self.path}/tried/version={self.version}"
        updated.write.parquet(tried)
        tried = self.spark.read.schema("shard bigint, cells binary").parquet(tried)
        full = tried.filter("cells IS NULL").select("shard")
        again = self._rebuilt(now, full)
        tried.filter("cells IS NOT NULL").unionByName(again).write.parquet(target)

    def _rebuilt(self, keys, only=None):
        keys = keys.select(self._shard(), "k1", "k2")
        if only is not None:
            keys = keys.join(only, "shard", "left_semi")

        def build(rows):
            filled = _build(list(rows[["k1", "k2"]].itertuples(index=False, name=None)))
            return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "cells": [filled.cells.tobytes()]})

        return keys.groupBy("shard").applyInPandas(build, "shard bigint, cells binary")

    def _hits(self, docs, filter_bytes):
        """Lines that may be frequent, as (key, document)."""
        size = self.filters().agg(F.sum(F.length("cells"))).first()[0] or 0
        min_chars, shards = self.min_chars, self.shards
        blobs = None
        if size <= filter_bytes:
            blobs = self.spark.sparkContext.broadcast({r.shard: bytes(r.cells) for r in self.filters().toLocalIterator()})

        def scan(batches):
            asked = blobs and {s: CuckooFilter(np.frombuffer(b, np.uint16)) for s, b in blobs.value.items()}
            for batch in batches:
                out = []
                for doc_id, text in rows_of(batch, "doc_id", "text"):
                    keys = {k for line in text.split(b"\n") if (k := line_key(line, min_chars))}
                    out += [(*k, doc_id) for k in keys]
                if out and asked is not None:
                    k1, k2, _ = (np.array(c, np.int64) for c in zip(*out, strict=True))
                    shard, keep = (k1 >> 40) % shards, np.zeros(len(out), bool)
                    for s in np.unique(shard):
                        if s in asked:
                            at = np.flatnonzero(shard == s)
                            keep[at] = asked[s].contains_all(k1[at], k2[at])
                    out = [out[i] for i in np.flatnonzero(keep)]
                yield batch_of(list(zip(*out, strict=True)) or [[]] * 3, HIT)

        return docs.filter(F.col("doc_id").isNotNull()).select(
            F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text")
        ).mapInArrow(scan, "k1 bigint, k2 bigint, doc_id bigint")

    def clean(self, docs, filter_bytes=FILTER_BYTES):
        """All rows of `docs` with ``text`` less its repeated lines, plus ``n_lines`` and ``n_dropped``.

        A line goes if its key is frequent and the document is not the one with the largest id that holds it.
        Columns of `docs` other than ``text`` are kept as they are; the two counts replace columns of their name.
        """
        drop = (
            self._hits(docs, filter_bytes)
            .join(self.frequent(), ["k1", "k2"])
            .filter("doc_id < last_doc")
            .groupBy("doc_id")
            .agg(F.collect_set(F.struct("k1", "k2")).alias("gone"))
            .select(F.col("doc_id").alias("gone_id"), F.transform("gone", lambda g: g["k1"]).alias("g1"),
                    F.transform("gone", lambda g: g["k2"]).alias("g2"))
        )
        rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
        names = [f"c{i}" for i in range(len(rest))]
        kept = docs.select(
            *[F.col(f"`{c}`").alias(n) for c, n in zip(rest, names, strict=True)],
            F.coalesce("text", F.lit("")).cast("binary").alias("text"),
            F.col("doc_id").cast("bigint").alias("own_id"),
        ).join(drop, F.col("own_id") == F.col("gone_id"), "left")
        kept = kept.select(*names, "text", "g1", "g2")
        min_chars = self.min_chars

        def rewrite(batches):
            for batch in batches:
                texts, lines, dropped = [], [], []
                for text, g1, g2 in rows_of(batch, "text", "g1", "g2"):
                    parts = text.split(b"\n")
                    left = parts
                    if g1:
                        gone = set(zip(g1, g2, strict=True))
                        left = [p for p in parts if line_key(p, min_chars) not in gone]
                    texts.append(b"\n".join(left))
                    lines.append(len(parts))
                    dropped.append(len(parts) - len(left))
                own = [pa.array(texts, pa.binary()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), *own], names=[*names, "text", "n_lines", "n_dropped"]
                )

        types = {f.name: f.dataType.simpleString() for f in kept.schema}
        schema = ", ".join([*(f"{n} {types[n]}" for n in names), "text binary, n_lines bigint, n_dropped bigint"])
        out = kept.mapInArrow(rewrite, schema)
        back = dict(zip(rest, names, strict=True))
        columns = [
            F.col("text").cast("string").alias("text") if c == "text" else F.col(back[c]).alias(c)
            for c in docs.columns
            if c == "text" or c in back
        ]
        return out.select(*columns, "n_lines", "n_dropped")
