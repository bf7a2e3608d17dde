"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of `SIDE` sketches each are computed, a sketch being `ROWS` minhashes. Every pair of one
sketch from either side forms a table key: ``SIDE ** 2`` tables of ``2 * ROWS`` minhashes each, for the work of
``2 * SIDE * ROWS`` minhashes. Two sets of similarity s share no table with a chance of about
``2 * (1 - s ** ROWS) ** SIDE``: 0.15 % at 0.8, 0.01 % at 0.85, and less for members of groups.

Equal sets are one class. In each bucket every class is compared with the smallest one there, and those that this
leaves unconnected with another one. Where buckets still hold several components, their members are compared exactly
in blocks that return links only. So no pair that shares a bucket stays undecided, and a group of copies gives
links in proportion to its size. Every link is confirmed on the full shingle sets.
"""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import GOLDEN, WordHashes, batch_of, give_back, mix64, rows_of, small_batches, stored, text_bytes
from .components import components
from .decontaminate import rolling

ROWS = 3
SIDE = 10
#: Bits of a fixed-size map of the documents whose sets are needed for comparisons.
MAP_BITS = 1 << 25
#: Turns of comparing the members of each bucket with one of them, before all open pairs are compared.
TURNS = 2
#: Documents in a block of a family whose members are compared with each other.
BLOCK = 2_000

HASHES = 2 * SIDE * ROWS
SEEDS = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * GOLDEN)
XOR, ODD = SEEDS[:HASHES], SEEDS[HASHES:] | np.uint64(1)

SIGNATURE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("a", pa.list_(pa.int64())),
        ("b", pa.list_(pa.int64())),
    ]
)


def shingles(text, words, hashes):
    """Sorted distinct 64-bit hashes of all runs of `words` words; fewer words are one shingle, none an empty set."""
    tokens = text.lower().split()  # bytes: A-Z, and ASCII white space
    if not tokens:
        return np.zeros(0, np.uint64)
    return np.unique(rolling(hashes.of(tokens), min(words, len(tokens))))


def minhashes(values):
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(values), 4096):
        part = values[k : k + 4096, None] ^ XOR
        part *= ODD
        np.minimum(low, part.min(axis=0), out=low)
    return low


def sketches(low):
    """The two collections of sketches."""
    low = mix64(low)
    folded = np.zeros(2 * SIDE, np.uint64)
    for r in range(ROWS):
        folded = mix64(folded + low.reshape(2 * SIDE, ROWS)[:, r] + GOLDEN)
    folded = folded.view(np.int64)
    return folded[:SIDE].tolist(), folded[SIDE:].tolist()


def signatures(docs, words):
    def scan(batches):
        hashes = WordHashes()
        for batch in batches:
            out = []
            for doc_id, text in rows_of(batch, "doc_id", "text"):
                values = shingles(text, words, hashes)
                d = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                h1, h2 = np.frombuffer(d, np.int64).tolist()
                a, b = sketches(minhashes(values)) if len(values) else ([], [])
                out.append((doc_id, len(values), h1, h2, a, b))
            yield batch_of(list(zip(*out, strict=True)) or [[]] * 6, SIGNATURE)
        hashes.clear()
        give_back()

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text"))
    schema = "doc_id bigint, n bigint, h1 bigint, h2 bigint, a array<bigint>, b array<bigint>"
    return given.mapInArrow(scan, schema)


def _place(*columns):
    """Where a value stands in a bit map."""
    return F.pmod(F.xxhash64(*columns), F.lit(MAP_BITS))


def _bitmap(places):
    """A bit map of fixed size, sent to the tasks, of a column ``place``."""
    rows = (
        places.select(F.shiftright("place", 6).alias("w"), (F.col("place") % 64).cast("int").alias("bit"))
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("m"))
        .toLocalIterator()
    )
    bitmap = np.zeros(MAP_BITS // 64, np.int64)
    for r in rows:
        bitmap[r.w] = r.m
    return places.sparkSession.sparkContext.broadcast(bitmap)


def _held(bitmap, place):
    return (bitmap[place >> 6] >> (place & 63)) & 1 == 1


def _shared_sketches(reps):
    """(doc_id, a, b) with NULL for sketches that no other document has.

    A key of two sketches can only be shared where both are, so a fifth of the rows is counted instead of all keys,
    and documents that resemble nothing give no key. The bit map may keep a sketch too many, never one too few.
    """
    every = F.concat("a", "b")
    seen = reps.select(F.posexplode(every).alias("i", "x")).groupBy("i", "x").count().filter("count > 1")
    shared = _bitmap(seen.select(_place("x", "i").alias("place")))

    def scan(batches):
        for batch in batches:
            if not len(batch):
                continue
            lone = ~_held(shared.value, batch.column("places").flatten().to_numpy()).reshape(-1, 2 * SIDE)
            lists = [batch.column("doc_id")]
            for name, mask in (("a", lone[:, :SIDE]), ("b", lone[:, SIDE:])):
                values = pa.array(batch.column(name).flatten().to_numpy(), pa.int64(), mask=mask.ravel())
                lists.append(pa.ListArray.from_arrays(np.arange(0, len(values) + 1, SIDE, dtype=np.int32), values))
            some = pa.RecordBatch.from_arrays(lists, names=["doc_id", "a", "b"])
            yield some.filter(pa.array(~(lone[:, :SIDE].all(axis=1) | lone[:, SIDE:].all(axis=1))))

    given = reps.select("doc_id", "a", "b", F.transform(every, lambda x, i: _place(x, i)).alias("places"))
    return given.mapInArrow(scan, "doc_id bigint, a array<bigint>, b array<bigint>")


def _sets(docs, ids, words):
    """(id, shingles) of at least the documents in `ids`: a bit map of fixed size tells which texts to read."""
    place = _place("id")
    needed = _bitmap(ids.select(place.alias("place")))

    def scan(batches):
        hashes, known = WordHashes(), needed.value
        for batch in batches:
            place = batch.column("place").to_numpy()
            take = np.flatnonzero(_held(known, place))
            some = batch.take(pa.array(take))
            for k in range(0, len(some), 500):
                part = some.slice(k, 500)
                values = [shingles(t, words, hashes).view(np.int64) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(values, pa.list_(pa.int64()))], names=["id", "shingles"]
                )
        hashes.clear()
        give_back()

    given = (
        docs.filter("doc_id IS NOT NULL")
        .select(F.col("doc_id").cast("bigint").alias("id"), text_bytes("text").alias("text"))
        .select("id", "text", place.alias("place"))
    )
    return given.mapInArrow(scan, "id bigint, shingles array<bigint>")


def _confirmed(sets, pairs, percent):
    """The pairs (u, v) whose full sets are similar enough."""
    u = sets.select(F.col("id").alias("u"), F.col("shingles").alias("su"))
    v = sets.select(F.col("id").alias("v"), F.col("shingles").alias("sv"))
    shared = F.size(F.array_intersect("su", "sv"))
    return (
        pairs.join(v, "v")
        .join(u, "u")
        .select("u", "v", shared.alias("shared"), (F.size("su") + F.size("sv")).alias("total"))
        .filter(F.col("shared") * 100 >= percent * (F.col("total") - F.col("shared")))
        .select("u", "v")
        .distinct()
    )


def _placed(placed, known):
    """Members of buckets with their components, where a bucket holds more than one."""
    own = known.select(F.col("node").alias("rep"), "component")
    placed = placed.join(own, "rep", "left").select("key", "rep", F.coalesce("component", "c").alias("c"))
    mixed = placed.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low < high")
    return stored(placed.join(mixed.select("key"), "key", "left_semi"), "members")


def _to_heads(placed, turn):
    """Pairs of a member of each bucket, another one each turn, with the members not connected to it yet."""
    order = F.xxhash64("rep", F.lit(turn)) if turn else F.col("rep")
    ordered = placed.withColumn("o", order)
    heads = ordered.groupBy("key").agg(F.min("o").alias("o"))
    heads = ordered.join(heads, ["key", "o"]).select("key", F.col("rep").alias("head"), F.col("c").alias("hc")).distinct()
    pairs = placed.join(heads, "key").filter("c <> hc")
    return pairs.select(F.least("head", "rep").alias("u"), F.greatest("head", "rep").alias("v")).distinct()


def _overlaps(rows, percent):
    """Linked pairs of left and right documents of different components, by counting over an inverted index."""
    left, right = rows[rows["side"] != 1], rows[rows["side"] != 0]
    if not len(left) or not len(right):
        return pd.DataFrame({"u": [], "v": []}, dtype="int64")
    sizes = right["n"].to_numpy()
    every = np.concatenate(right["shingles"].to_list())
    owner = np.repeat(np.arange(len(right)), [len(s) for s in right["shingles"]])
    order = np.argsort(every, kind="stable")
    owner = owner[order].astype(np.int32)
    tokens, start = np.unique(every[order], return_index=True)
    stop = np.append(start[1:], len(every))
    reps, c, out = right["rep"].to_numpy(), right["c"].to_numpy(), []
    for rep, own, n, values in left[["rep", "c", "n", "shingles"]].itertuples(index=False):
        at = np.minimum(np.searchsorted(tokens, values), len(tokens) - 1)
        at = at[tokens[at] == values]
        if not len(at):
            continue
        shared = np.bincount(np.concatenate([owner[a:b] for a, b in zip(start[at], stop[at], strict=True)]), minlength=len(right))
        near = (shared * 100 >= percent * (n + sizes - shared)) & (c != own) & (reps != rep)
        out += [(min(rep, x), max(rep, x)) for x in reps[near].tolist()]
    return pd.DataFrame(sorted(set(out)), columns=["u", "v"], dtype="int64")


def _open_links(placed, sets, percent, block=BLOCK):
    """Links between all members of mixed buckets that are in different components.

    Buckets that share members are a family. The smallest component of a family, around which it lies, needs no
    comparison with itself; the rest is compared with everything. Families of up to a block are put together, larger ones
    are cut into blocks, and each pair of blocks is one task of bounded size that gives back links only.
    """
    low = placed.groupBy("key").agg(F.min("rep").alias("v"))
    family = components(placed.join(low, "key").select(F.col("rep").alias("u"), "v"))
    family = family.select(F.col("node").alias("rep"), F.col("component").alias("family"))
    rows = stored(placed.select("rep", "c").distinct().join(family, "rep"), "families")
    of_family = rows.groupBy("family").agg(
        F.count("*").alias("size"), F.min("c").alias("base")
    )
    inner = F.col("c") == F.col("base")
    rows = rows.join(of_family.select("family", "size", "base"), "family").withColumn("inner", inner)
    counted = rows.groupBy("family", "inner").agg(F.count("*").alias("m"))
    rows = rows.join(counted, ["family", "inner"]).join(
        counted.groupBy("family").agg(
            F.sum(F.when(~F.col("inner"), F.ceil(F.col("m") / block))).alias("outer_blocks"),
            F.sum(F.when(F.col("inner"), F.ceil(F.col("m") / block))).alias("inner_blocks"),
        ),
        "family",
    )
    n_small = rows.filter(F.col("size") <= block).count()
    bins = max(1, -(-n_small // block))
    own = F.pmod(F.xxhash64("rep"), F.ceil(F.col("m") / block))
    rows = rows.withColumn("own", own).withColumn("ob", F.coalesce("outer_blocks", F.lit(0)))
    rows = rows.withColumn("ib", F.coalesce("inner_blocks", F.lit(0)))

    def task(i, j, side):
        return F.struct(i.cast("bigint").alias("i"), j.cast("bigint").alias("j"), F.lit(side).alias("side"))

    # Outer block i meets outer blocks j > i, itself, and all inner blocks (numbered after the outer ones).
    others = F.transform(F.sequence(F.lit(0), F.col("ob") + F.col("ib") - 1), lambda b: b.cast("bigint"))
    o = F.col("own")
    outer = F.transform(
        others,
        lambda b: F.when(b == o, task(o, o, 2)).when(b > o, task(o, b, 0)).otherwise(task(b, o, 1)),
    )
    inner_tasks = F.transform(
        F.filter(others, lambda b: b < F.col("ob")), lambda b: task(b, F.col("ob") + o, 1)
    )
    big = F.when(F.col("inner"), inner_tasks).otherwise(outer)
    small = F.array(task(F.pmod(F.xxhash64("family"), F.lit(bins)), F.lit(-1), 2))
    tasks = rows.select(
        "rep", "c",
        F.when(F.col("size") <= block, F.lit(None).cast("bigint")).otherwise(F.col("family")).alias("f"),
        F.explode(F.when(F.col("size") <= block, small).otherwise(big)).alias("t"),
    )
    full = tasks.join(sets.withColumnRenamed("id", "rep"), "rep").select(
        "f", "t.i", "t.j", "t.side", "rep", "c", F.size("shingles").cast("bigint").alias("n"), "shingles"
    )
    return full.groupBy("f", "i", "j").applyInPandas(lambda rows: _overlaps(rows, percent), "u bigint, v bigint")


def similar_size(x, y, percent):
    return F.least(x, y) * 100 >= percent * F.greatest(x, y)


def link(docs, words=2, percent=80):
    """One row per row of `docs`: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``100 * intersection >= percent * union`` of their shingle sets. The component is the
    smallest ``doc_id`` reachable over links; ``kept`` says that it is the document's own. Texts without words
    (NULL, empty, blank) are linked with nothing. Rows that share an id are one document. Rows
    without an id are linked with nothing: their component is NULL and they are kept.
    """
    small_batches(docs.sparkSession)
    sig = stored(signatures(docs, words), "signatures")
    linkable = sig.filter("doc_id IS NOT NULL AND n > 0")
    classes = linkable.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    copies = linkable.join(classes, ["n", "h1", "h2"]).filter("doc_id <> rep").select("doc_id", "rep")
    reps = linkable.join(
        classes.select(F.col("rep").alias("doc_id"), "h1", "h2"), ["doc_id", "h1", "h2"], "left_semi"
    )
    key = F.flatten(
        F.transform(
            "a",
            lambda x, i: F.transform(
                "b", lambda y, j: F.when(x.isNotNull() & y.isNotNull(), F.xxhash64(x, y, i * F.lit(SIDE) + j))
            ),
        )
    )
    keyed = stored(_shared_sketches(reps), "sketches")
    keys = keyed.select(F.explode(key).alias("key"), F.col("doc_id").alias("rep")).filter("key IS NOT NULL")
    heads = (
        keys.groupBy("key")
        .agg(F.min("rep").alias("head"), F.max("rep").alias("last"))
        .filter("head < last")
        .select("key", "head")
    )
    members = stored(keys.join(heads, "key").select("key", "head", "rep"), "members")
    about = reps.select(F.col("doc_id").alias("id"), "n").dropDuplicates(["id"])

    sets = stored(_sets(docs, members.select(F.explode(F.array("head", "rep")).alias("id")), words), "sets")
    placed = members.select("key", "rep", F.col("rep").alias("c")).distinct()
    links = None
    sizes = about.select("id", "n")
    for turn in range(TURNS):
        pairs = _to_heads(placed, turn)
        pairs = (
            pairs.join(sizes.withColumnRenamed("id", "u").withColumnRenamed("n", "nu"), "u")
            .join(sizes.withColumnRenamed("id", "v").withColumnRenamed("n", "nv"), "v")
            .filter(similar_size(F.col("nu"), F.col("nv"), percent))
            .select("u", "v")
        )
        found = _confirmed(sets, stored(pairs, "pairs"), percent)
        links = stored(found if links is None else links.unionByName(found), "links")
        placed = _placed(placed, components(links))
    links = links.unionByName(_open_links(placed, sets, percent))
    links = links.unionByName(copies.select(F.col("rep").alias("u"), F.col("doc_id").alias("v")))
    final = components(links).select(F.col("node").alias("doc_id"), "component")
    return sig.select("doc_id", F.col("n").alias("n_shingles")).join(final, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component", "doc_id")).alias("kept"),
    )


def drop_copies(docs, words=5, percent=80):
    """`docs` with one document, the one of the smallest id, of each group."""
    gone = link(docs, words, percent).filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")
