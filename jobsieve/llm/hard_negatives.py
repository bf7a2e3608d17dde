"""Hard negatives by an STR-packed R-tree.

Vectors are scaled to whole numbers. A sample gives the walls of sort-tile-recursive tiles: by label first, then by one
coordinate after the other, those of most variance first. Every tile is dealt into blocks of bounded size, and a
block is packed into a tree: its rows in tile order, boxes around every `LEAF` rows and around every `FANOUT` boxes.

A box bounds the inner product with an anchor coordinate by coordinate. Per task and batch of anchors a queue gives the
boxes best first. It leaves out boxes that lie outside the score windows, that hold no row of a wanted label, or whose
best score lies strictly below the k-th found so far; that threshold is carried from block to block.

The anchors are sent in parts of bounded size, one after the other, and blocks are searched where they lie: no vector is
shuffled in a search. Results of tasks are cut to k per anchor before they meet.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import Best, stored

#: Rows on which the walls of tiles are fitted at most, and tiles at most; every row is indexed.
FIT_ROWS = 20_000
MAX_TILES = 4_096
#: Rows in a block, in a leaf; boxes in a box.
BLOCK_ROWS = 4_096
LEAF = 64
FANOUT = 8
#: Anchors sent at once, and anchors that share a queue.
PART_ROWS = 8_192
BATCH = 128
NONE = np.iinfo(np.int64).min


def whole(vector, scale):
    """Components as whole numbers: the floor of `scale` times each, taken as a double."""
    return F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))


def str_order(labels, points, leaf):
    """Rows in sort-tile-recursive order: by label, then in slices along one coordinate after the other."""
    axes = np.argsort(-points.astype(np.float64).var(axis=0), kind="stable") if len(points) else []
    out = []

    def tile(rows, depth):
        leaves = -(-len(rows) // leaf)
        left = len(axes) - depth
        if leaves <= 1 or left <= 0:
            out.append(rows)
            return
        slices = max(2, int(np.ceil(leaves ** (1 / left))))
        per = -(-leaves // slices) * leaf
        rows = rows[np.argsort(points[rows, axes[depth]], kind="stable")]
        for at in range(0, len(rows), per):
            tile(rows[at : at + per], depth + 1)

    for label in np.unique(labels):
        tile(np.flatnonzero(labels == label), 0)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def boxes(points, leaf=LEAF, fanout=FANOUT):
    """Levels of (low, high) corners, leaves first and one root last; rows of a box follow one another."""
    at = np.arange(0, len(points), leaf)
    levels = [(np.minimum.reduceat(points, at), np.maximum.reduceat(points, at))]
    while len(levels[-1][0]) > 1:
        low, high = levels[-1]
        at = np.arange(0, len(low), fanout)
        levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
    return levels


def held(labels, leaf=LEAF, fanout=FANOUT):
    """Per level and box the least and the greatest label in it."""
    at = np.arange(0, len(labels), leaf)
    levels = [(np.minimum.reduceat(labels, at), np.maximum.reduceat(labels, at))]
    while len(levels[-1][0]) > 1:
        low, high = levels[-1]
        at = np.arange(0, len(low), fanout)
        levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)))
    return levels


class Tiles:
    """Walls of tiles from a sample: by label, then by coordinate; a row's tile is found by comparing alone."""

    def __init__(self, labels, points, tiles):
        self.nodes = []  # (axis, walls, first child), or None for a tile
        axes = np.argsort(-points.var(axis=0), kind="stable") if len(points) else np.zeros(0, int)
        self.names = np.unique(labels)
        self.roots = []
        self.count = 0

        def build(rows, depth, want):
            me = len(self.nodes)
            self.nodes.append(None)
            if want <= 1 or depth >= len(axes) or len(rows) < 2:
                self.nodes[me] = self.count
                self.count += 1
                return me
            x = np.sort(points[rows, axes[depth]])
            wall = x[len(x) // 2]
            below = points[rows, axes[depth]] < wall
            children = [build(rows[below], depth + 1, want // 2), build(rows[~below], depth + 1, want - want // 2)]
            self.nodes[me] = (int(axes[depth]), wall, *children)
            return me

        for label in self.names:
            rows = np.flatnonzero(labels == label)
            self.roots.append(build(rows, 0, max(1, round(tiles * len(rows) / len(labels)))))

    def of(self, labels, points):
        """The tile of each row; labels that the sample lacks go to the tiles of the next one."""
        out = np.zeros(len(labels), np.int32)
        at = np.minimum(np.searchsorted(self.names, labels), len(self.names) - 1)
        stack = [(self.roots[k], np.flatnonzero(at == k)) for k in range(len(self.names))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if isinstance(self.nodes[node], tuple):
                axis, wall, low, high = self.nodes[node]
                below = points[rows, axis] < wall
                stack += [(low, rows[below]), (high, rows[~below])]
            else:
                out[rows] = self.nodes[node]
        return out


class Block:
    """A packed tree over the rows of one block."""

    def __init__(self, ids, labels, points):
        self.ids, self.labels, self.points = ids, labels, points.astype(np.float64)
        self.boxes, self.held = boxes(self.points), held(labels)

    def search(self, anchors, low, high, kth, take):
        """Best-first over the boxes for anchors that share a queue.

        ``anchors``: (ids, labels, points, same); rows of the same label are sought, or those of other ones. Scores lie
        in one of the windows ``low <= score <= high`` (anchors x windows), and ``kth`` holds what a score must reach.
        Whole numbers below 2 ** 53, so products of doubles are exact. ``take(anchors, rows, scores)`` gets what is
        found and may raise ``kth``.
        """
        ids, labels, points, same = anchors
        plus, minus = np.maximum(points, 0), np.minimum(points, 0)
        top_level = len(self.boxes) - 1

        def judged(level, some):
            """Per box (its greatest score over what an anchor still needs, anchors that may need it)."""
            a, b = self.boxes[level][0][some], self.boxes[level][1][some]
            most, least = plus @ b.T + minus @ a.T, plus @ a.T + minus @ b.T
            first, last = self.held[level][0][some], self.held[level][1][some]
            if same:
                of_label = (labels[:, None] >= first) & (labels[:, None] <= last)
            else:
                of_label = ~((labels[:, None] == first) & (labels[:, None] == last))
            open_ = np.zeros(most.shape, bool)
            for w in range(low.shape[1]):
                reach = np.maximum(low[:, w], kth[:, w])[:, None]
                open_ |= (most >= reach) & (least <= high[:, w, None])
            return most, open_ & of_label

        def push(level, some):
            most, open_ = judged(level, some)
            for k in np.flatnonzero(open_.any(axis=0)):
                best = most[open_[:, k], k].max()
                heapq.heappush(queue, (-best, level, int(some[k])))

        queue = []
        push(top_level, np.arange(len(self.boxes[top_level][0])))
        while queue:
            _, level, box = heapq.heappop(queue)
            if level:
                push(level - 1, np.arange(box * FANOUT, min((box + 1) * FANOUT, len(self.boxes[level - 1][0]))))
                continue
            # What the queue held may have fallen below the threshold meanwhile.
            needed = np.flatnonzero(judged(0, np.array([box]))[1][:, 0])
            if not len(needed):
                continue
            rows = np.arange(box * LEAF, min((box + 1) * LEAF, len(self.ids)))
            score = points[needed] @ self.points[rows].T
            fit = (labels[needed, None] == self.labels[rows]) == same
            fit &= ids[needed, None] != self.ids[rows]
            for w in range(low.shape[1]):
                reach = np.maximum(low[needed, w], kth[needed, w])[:, None]
                q, r = np.nonzero(fit & (score >= reach) & (score <= high[needed, w, None]))
                if len(q):
                    take(w, needed[q], rows[r], score[q, r])


def fresh_ids(rows):
    """Of rows that share an id, the one with the smallest label, then vector."""
    twice = stored(rows.groupBy("id").count().filter("count > 1").select("id"), "repeats")
    if twice.isEmpty():
        return rows
    one = rows.join(twice, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("x"))
    return rows.join(twice, "id", "left_anti").unionByName(one.select("id", "x.label", "x.vector"))


class TreeIndex:
    """Blocks of packed trees over all rows that take part: an id, a label, and a vector of finite components.

    Vectors of another length than most have no inner product with the rest and take no part, nor do vectors
    whose whole numbers are so large that an inner product could pass 2 ** 53. Rows that share an id are one row.
    """

    def __init__(self, df, id_column="vec_id", vector_column="embedding", label_column="label", scale=256):
        self.spark = df.sparkSession
        vector = F.col(f"`{vector_column}`").cast("array<double>")
        given = df.select(
            F.col(f"`{id_column}`").cast("bigint").alias("id"),
            F.col(f"`{label_column}`").cast("bigint").alias("label"),
            vector.alias("vector"),
        )
        fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        given = given.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & fine)
        most = given.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
        self.dim = most["dim"] if most else 0
        self.blocks = None
        if not self.dim:
            return
        greatest = int((2**53 / self.dim) ** 0.5)
        given = given.filter(
            (F.size("vector") == self.dim) & F.forall("vector", lambda x: F.abs(x) < greatest / scale - 1)
        )
        rows = stored(fresh_ids(given.withColumn("vector", whole(F.col("vector"), scale))), "vectors")
        self.rows, n = rows, rows.count()
        if not n:
            return
        sample = rows.orderBy(F.xxhash64("id"), "id").limit(FIT_ROWS).select("label", "vector").toPandas()
        tiles = Tiles(
            sample["label"].to_numpy(np.int64),
            np.stack(sample["vector"].to_numpy()),
            min(MAX_TILES, -(-n // BLOCK_ROWS)),
        )
        self.blocks = self._packed(rows, n, self.spark.sparkContext.broadcast(tiles))

    def _packed(self, rows, n, tiles):
        dim = self.dim

        def place(batches):
            for batch in batches:
                points = batch.column("vector").flatten().to_numpy().reshape(-1, dim)
                at = tiles.value.of(batch.column("label").to_numpy(), points)
                columns = [batch.column(c) for c in ("id", "label", "vector")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(at)], names=["id", "label", "vector", "tile"])

        placed = stored(rows.mapInArrow(place, "id bigint, label bigint, vector array<bigint>, tile int"), "tiles")
        # A tile with more rows than a block, however equal they are, is dealt into blocks.
        sizes = placed.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
        placed = placed.join(F.broadcast(sizes), "tile")  # at most MAX_TILES rows and one per label
        placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))

        def pack(table):
            ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
            points = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
            first = np.argsort(ids, kind="stable")
            order = first[str_order(labels[first], points[first], LEAF)]
            cells = [x[order].astype("<i8").tobytes() for x in (ids, labels, points)]
            return pa.table({k: pa.array([v], pa.binary()) for k, v in zip(("ids", "labels", "points"), cells, strict=True)})

        packed = placed.groupBy("tile", "block").applyInArrow(pack, "ids binary, labels binary, points binary")
        # Searching takes far longer than reading: a few blocks a file, so that all tasks get some.
        return stored(packed.repartition(min(-(-n // BLOCK_ROWS), 10_000)), "trees")

    def _search(self, asked, k, same, schema):
        """(anchor, window, row, score): the k best per anchor and window of every task, for one part of anchors.

        `asked` holds (id, label, vector, lows, highs) of a bounded number of anchors.
        """
        rows = asked.toPandas()
        dim = self.dim
        points = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        windows = max(map(len, rows["lows"]))
        low, high = np.full((len(rows), windows), np.inf), np.full((len(rows), windows), -np.inf)
        for i, (a, b) in enumerate(zip(rows["lows"], rows["highs"], strict=True)):
            low[i, : len(a)], high[i, : len(b)] = a, b
        labels = rows["label"].to_numpy(np.int64)
        order = str_order(labels, points, BATCH)  # anchors of a batch lie close together
        sent = self.spark.sparkContext.broadcast(
            (rows["id"].to_numpy(np.int64)[order], labels[order], points[order], low[order], high[order])
        )

        def scan(batches):
            ids, labels, points, low, high = sent.value
            best = Best(len(ids), low.shape[1], k)
            for batch in batches:
                for a, b, c in zip(*(batch.column(n).to_pylist() for n in ("ids", "labels", "points")), strict=True):
                    block = Block(*(np.frombuffer(x, "<i8") for x in (a, b)), np.frombuffer(c, "<i8").reshape(-1, dim))
                    for at in range(0, len(ids), BATCH):
                        part = slice(at, at + BATCH)

                        def take(w, q, r, scores, at=at, block=block):
                            best.add(w, q + at, block.ids[r], scores)

                        anchors = (ids[part], labels[part], points[part], same)
                        block.search(anchors, low[part], high[part], best.kth[part], take)
            a, w, i = np.nonzero(best.scores > -np.inf)
            columns = [ids[a], w, best.ids[a, w, i], best.scores[a, w, i].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["anchor", "window", "row", "score"])

        found = self.blocks.mapInArrow(scan, "anchor bigint, window bigint, row bigint, score bigint")
        kept = stored(best_rows(found, ["anchor", "window"], k), schema)
        sent.destroy()
        return kept

    def _in_parts(self, asked, k, same, name):
        """One search after the other over parts of the anchors; what a part sends is given back before the next."""
        n = asked.count()
        parts = max(1, -(-n // PART_ROWS))
        part = F.pmod(F.xxhash64("id"), F.lit(parts))
        out = None
        for p in range(parts):
            some = asked.filter(part == p)
            if some.isEmpty():
                continue
            found = self._search(some, k, same, f"{name}-{p}")
            out = found if out is None else out.unionByName(found)
        return out

    def mine(self, is_anchor, positives=5, negatives=3, least=50, most=95):
        """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

        Anchors are the rows for which the expression `is_anchor` over ``id`` holds. An anchor's positives are its
        first other rows of the same label by inner product, ties to the smaller id; per anchor and positive, the first
        rows of other labels with ``least * positive <= 100 * negative <= most * positive`` (scores). Fewer where there
        are fewer, none for an empty table; a negative positive score leaves no such row.
        """
        empty = self.spark.createDataFrame(
            [],
            "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
            "negative_score bigint",
        )
        if self.blocks is None:
            return empty
        anchors = stored(self.rows.filter(is_anchor), "anchors")
        every = anchors.withColumns({
            "lows": F.array(F.lit(float("-inf"))),
            "highs": F.array(F.lit(float("inf"))),
        })
        near = self._in_parts(every, positives, True, "positives")
        if near is None:
            return empty
        # Equal scores share a window; at most `positives` of them per anchor.
        score = F.col("score")
        low = F.ceil((score * least) / F.lit(100)).cast("double")
        high = F.floor((score * most) / F.lit(100)).cast("double")
        windows = near.groupBy(F.col("anchor").alias("id")).agg(
            F.sort_array(F.collect_set(F.struct(score.alias("s"), low.alias("low"), high.alias("high")))).alias("w")
        )
        windows = windows.select(
            "id", F.col("w.s").alias("s"), F.col("w.low").alias("lows"), F.col("w.high").alias("highs")
        )
        found = self._in_parts(anchors.join(windows, "id"), negatives, False, "negatives")
        if found is None:
            return empty
        of_score = windows.select(
            F.col("id").alias("anchor"), F.posexplode("s").alias("window", "positive_score")
        ).withColumn("window", F.col("window").cast("bigint"))
        pairs = near.select("anchor", F.col("row").alias("positive"), F.col("score").alias("positive_score"))
        found = found.withColumnsRenamed({"row": "negative", "score": "negative_score"})
        return (
            pairs.join(of_score, ["anchor", "positive_score"])
            .join(found, ["anchor", "window"])
            .select(
                F.col("anchor").alias("anchor_id"),
                F.col("positive").alias("positive_id"),
                F.col("rank"),
                F.col("negative").alias("negative_id"),
                "positive_score",
                "negative_score",
            )
        )


def best_rows(found, keys, k):
    """The first k rows of each group, ranked from 1."""
    from pyspark.sql import Window

    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
