"""Approximate nearest neighbours by randomly rotated one-bit codes.

Vectors are assigned to lists around centroids. Within a list, the unit vector of the offset from the centroid is
rotated at random, a few times over, and only the signs are kept, packed into words. With correction scalars per vector
(the length of the offset, and the inner product of the offset with each of its codes) the inner product with a query
is estimated without bias from the bits alone: the turned query is rounded to a few bit planes, and bits are counted.
The error bound holds with high probability. Per query, the best by estimate are ranked by the exact inner product first;
then only vectors whose upper bound reaches the k-th exact score so far are. That score is carried from block to block.

Queries are sent in parts of bounded size, one after the other, and codes are read where they lie: no vector is shuffled.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import Best, stored

#: Rows on which centroids are fitted at most; every valid row is indexed.
FIT_ROWS = 20_000
#: Vectors in a list on average, up to MAX_LISTS lists.
LIST_ROWS = 8_192
MAX_LISTS = 4_096
#: Lists that a query looks into; None is all of them. Fewer save work where the vectors form clusters, at a loss of
#: recall: without clusters, the lists of a query do not tell where its neighbours are.
PROBES = None
#: Queries that meet a block at once, and queries on average that are sent at once.
QUERY_ROWS = 64
QUERY_BLOCK_ROWS = 8_192
#: Vectors that meet queries at once.
VECTOR_ROWS = 4_096
#: Rotations, each of which gives a vector one bit per dimension, and bits of a component of a turned query.
CODES = 4
PLANES = 4
#: Width of the error bound, in standard deviations of the estimate.
EPSILON = 3.5
SEED = 42


def rotation(dim, seed=SEED):
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def centroids(sample, lists, seed=SEED, rounds=8):
    """k-means on a sample; empty clusters keep their last centre."""
    rng = np.random.default_rng(seed)
    lists = min(lists, len(sample))
    centres = sample[rng.choice(len(sample), lists, replace=False)].copy()
    for _ in range(rounds):
        at = np.argmax(sample @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
        sums, n = np.zeros_like(centres), np.bincount(at, minlength=lists)
        np.add.at(sums, at, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def words(bits):
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    gap = -packed.shape[-1] % 8
    packed = np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, gap)])
    return np.ascontiguousarray(packed).view(np.uint64)


def encode(vectors, centres, turns):
    """(list, sign bits per rotation, offset length, <code, offset> / length per rotation) of each vector."""
    at = np.argmax(vectors @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)
    offset = vectors - centres[at]
    length = np.linalg.norm(offset, axis=1)
    unit = np.stack([offset @ t for t in turns], axis=1) / np.where(length > 0, length, 1)[:, None, None]
    fit = np.abs(unit).sum(axis=2) / np.sqrt(vectors.shape[1])
    return at, words(unit > 0), length, np.where(length[:, None] > 0, fit, 1.0)


class Asked:
    """Queries of a part, turned and rounded to bit planes for each rotation."""

    def __init__(self, ids, points, turns):
        self.ids, self.points, self.size = ids, points, np.linalg.norm(points, axis=1)
        turned = np.stack([points @ t for t in turns], axis=1)
        self.low = turned.min(axis=2)
        self.step = (turned.max(axis=2) - self.low) / (2**PLANES - 1)
        level = np.rint((turned - self.low[:, :, None]) / np.where(self.step > 0, self.step, 1)[:, :, None]).astype(int)
        self.planes = np.stack([words(level >> p & 1 == 1) for p in range(PLANES)], axis=2)
        self.sums = self.low * points.shape[1] + self.step * level.sum(axis=2)

    def estimate(self, part, centre, codes, ones, length, fit):
        """(estimates, error bounds) of the inner products of some queries with the vectors behind the codes."""
        dim, rotations = self.points.shape[1], fit.shape[1]
        about = np.repeat((self.points[part] @ centre)[:, None], len(length), axis=1).astype(np.float32)
        for r in range(rotations):
            bits = np.zeros(about.shape, np.uint16)
            for p in range(PLANES):
                for w in range(codes.shape[2]):
                    both = self.planes[part, r, p, w, None] & codes[:, r, w]
                    bits += np.bitwise_count(both).astype(np.uint16) << np.uint16(p)
            scale = (length / fit[:, r] / rotations / np.sqrt(dim)).astype(np.float32)
            low, step, total = (x[part, r, None].astype(np.float32) for x in (self.low, self.step, self.sums))
            about += scale * (2 * (step * bits + low * ones[:, r].astype(np.float32)) - total)
        spread = (length[:, None] ** 2 * np.maximum(0.0, 1 - fit**2) / (fit**2 * max(dim - 1, 1))).mean(axis=1)
        rounding = (self.step[part] ** 2).mean(axis=1)[:, None] / 12 * ((length[:, None] / fit) ** 2).mean(axis=1)
        bound = EPSILON * np.sqrt((self.size[part, None] ** 2 * spread + rounding) / rotations)
        return about, bound + 1e-5 * self.size[part, None] * (1 + length)


def exact(queries, vectors):
    """Inner products of rows in double precision, summed in the order of the components."""
    return np.cumsum(vectors * queries, axis=1)[:, -1]


def rank(asked, best, part, ids, vectors, centre, codes, length, fit, probed=None):
    """Take the nearest of these vectors into `best`; gives back how many inner products were computed exactly."""
    ones = np.bitwise_count(codes).sum(axis=2)
    about, bound = asked.estimate(part, centre, codes, ones, length, fit)
    open_ = asked.ids[part, None] != ids
    if probed is not None:
        open_ &= probed[part, None]
    k, done = best.k, 0

    def take(q, r):
        at = q + part.start
        score = np.einsum("ij,ij->i", asked.points[at], vectors[r])
        near = score >= best.kth[at, 0] - 1e-9 * (1 + np.abs(score))
        q, r, at = q[near], r[near], at[near]
        if len(q):
            best.add(0, at, ids[r], exact(asked.points[at], vectors[r]))

    # The best by estimate first: what they score is the bar for the rest.
    first = np.argpartition(-np.where(open_, about, -np.inf), min(2 * k, len(ids)) - 1, axis=1)[:, : 2 * k]
    reach = np.take_along_axis(about + bound, first, axis=1) >= best.kth[part]
    reach &= np.take_along_axis(open_, first, axis=1)
    q, c = np.nonzero(reach)
    take(q, first[q, c])
    done += len(q)
    np.put_along_axis(open_, first, False, axis=1)
    q, r = np.nonzero(open_ & (about + bound >= best.kth[part]))
    take(q, r)
    return done + len(q)


def valid_vectors(df, id_column, vector_column):
    """(id, vector) of the rows that take part: an id, and finite components of which one is not zero.

    Vectors of another length than most have no inner product with the rest; the length is that of most
    rows, of equally many the shorter.
    """
    vector = F.col(vector_column).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(id_column).cast("bigint").alias("id"), vector.alias("vector")).filter(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0)
    )


class CodeIndex:
    """One-bit codes of all valid rows of a table, in lists of blocks. Rows that share an id are all indexed."""

    def __init__(self, df, id_column="vec_id", vector_column="embedding", list_rows=LIST_ROWS):
        self.spark = df.sparkSession
        rows = valid_vectors(df, id_column, vector_column)
        most = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
        self.dim, n = most or (0, 0)
        self.rows = n
        rows = rows.filter(F.size("vector") == self.dim)
        if not n:
            self.codes = None
            return
        lists = max(1, min(MAX_LISTS, -(-n // list_rows)))
        sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("vector").toPandas()
        self.centres = centroids(np.stack(sample["vector"].to_numpy()), lists)
        self.turns = [rotation(self.dim, SEED + r) for r in range(CODES)]
        centres, turns, dim = self.spark.sparkContext.broadcast(self.centres), self.turns, self.dim

        def scan(batches):
            for batch in batches:
                vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                at, codes, length, fit = encode(vectors, centres.value, turns)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id"),
                        pa.array(at, pa.int32()),
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(length),
                        pa.array(fit.tolist(), pa.list_(pa.float64())),
                        batch.column("vector"),
                    ],
                    names=["id", "list", "code", "length", "fit", "vector"],
                )

        schema = "id bigint, list int, code binary, length double, fit array<double>, vector array<double>"
        # Vectors of a list lie together, and a batch holds those of few lists.
        self.codes = stored(rows.mapInArrow(scan, schema).sortWithinPartitions("list"), "codes")

    def search(self, queries, id_column="vec_id", vector_column="embedding", k=20, probes=PROBES):
        """``query_id, rank, vec_id, score``: the k nearest rows other than the query's own, largest inner product
        first, ties to the smaller id; all of them where there are fewer. Queries that are no valid vectors get none.
        """
        schema = "query_id bigint, rank int, vec_id bigint, score double"
        if self.codes is None:
            return self.spark.createDataFrame([], schema)
        asked = valid_vectors(queries, id_column, vector_column).filter(F.size("vector") == self.dim)
        asked = stored(asked, "queries")
        parts = max(1, -(-asked.count() // QUERY_BLOCK_ROWS))
        found = None
        for p in range(parts):
            some = asked.filter(F.pmod(F.xxhash64("id", "vector"), F.lit(parts)) == p).toPandas()
            if len(some):
                near = self._search(some["id"].to_numpy(np.int64), np.stack(some["vector"].to_numpy()), k, probes)
                found = near if found is None else found.unionByName(near)
        return self.spark.createDataFrame([], schema) if found is None else found

    def _search(self, ids, points, k, probes):
        """The k nearest of a bounded number of queries, written; what was sent for it is given back."""
        lists = len(self.centres)
        probed = None
        if probes and probes < lists:
            near = np.argsort(-(points @ self.centres.T), axis=1, kind="stable")[:, :probes]
            probed = np.zeros((len(ids), lists), bool)
            np.put_along_axis(probed, near, True, axis=1)
        centres, dim, turns = self.centres, self.dim, self.turns
        sent = self.spark.sparkContext.broadcast((ids, points, centres, turns, probed))

        def scan(batches):
            ids, points, centres, turns, probed = sent.value
            asked, best = Asked(ids, points, turns), Best(len(ids), 1, k)
            for batch in batches:
                of_list = batch.column("list").to_numpy()
                edges = [0, *(np.flatnonzero(np.diff(of_list)) + 1).tolist(), len(of_list)]
                for start, stop in zip(edges, edges[1:]):
                    for at in range(start, stop, VECTOR_ROWS):
                        some = batch.slice(at, min(VECTOR_ROWS, stop - at))
                        which = int(of_list[at])
                        codes = np.frombuffer(b"".join(some.column("code").to_pylist()), np.uint64)
                        block = (
                            some.column("id").to_numpy(),
                            some.column("vector").flatten().to_numpy().reshape(-1, dim),
                            centres[which],
                            codes.reshape(len(some), len(turns), -1),
                            some.column("length").to_numpy(),
                            some.column("fit").flatten().to_numpy().reshape(-1, len(turns)),
                        )
                        for q in range(0, len(ids), QUERY_ROWS):
                            part = slice(q, min(q + QUERY_ROWS, len(ids)))
                            rank(asked, best, part, *block, None if probed is None else probed[:, which])
            q, _, i = np.nonzero(best.scores > -np.inf)
            columns = [ids[q], best.ids[q, 0, i], best.scores[q, 0, i]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["query_id", "vec_id", "score"])

        found = self.codes.mapInArrow(scan, "query_id bigint, vec_id bigint, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found = stored(found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "nearest")
        sent.destroy()
        return found
