"""Current rows of an upserted table, in hash buckets of the key.

A micro-batch reads the buckets of its own keys, merges its rows into the stored ones and adds the results; both
the rows as they were and as they are come back, so that counts over the table can follow by differences. Levels are
those of ``KeyIndex``: a generation with one settled row per key, and above it the rows of each micro-batch since.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import first_by_key
from .key_index import _BASE, KeyIndex
from .sinks import VERSION, merge_by_key


class KeyedState(KeyIndex):
    """Rows of ``row_schema`` by a text key; rows without a key are not kept.

    The columns ``run``, ``batch``, ``of_run``, ``of_batch`` and ``bucket`` are the table's own.
    """

    def __init__(self, spark: SparkSession, path, row_schema, key="Job_ID", keys_per_bucket=20_000, max_buckets=65_536):
        super().__init__(spark, path, key, keys_per_bucket, max_buckets)
        taken = {"bucket", *VERSION, *_BASE} & set(row_schema.names)
        if taken:
            raise ValueError(f"columns of the table's own: {sorted(taken)}")
        self.schema = T.StructType(self.schema.fields + [f for f in row_schema.fields if f.name != key])

    def _rows(self, paths, root) -> DataFrame:
        # The levels are named, as a generation without rows has no folders that tell them.
        full = T.StructType(self.schema.fields + [T.StructField(c, T.IntegerType()) for c in _BASE])
        if not paths:
            return self.spark.createDataFrame([], full)
        stored = self.spark.read.schema(full).option("basePath", root).parquet(*paths)
        return stored.select(*self.schema.names, *_BASE)

    def _latest(self, rows) -> DataFrame:
        return first_by_key(rows, self.key, [F.desc(c) for c in VERSION])

    def rebuild(self, rows: DataFrame):
        """Write a new generation of these rows (with ``run`` and ``batch``), the newest of a key as its settled one."""
        self._generation_of(self._latest(rows).withColumns({k: F.lit(v) for k, v in _BASE.items()}))

    def _generation_of(self, rows):
        old = self.generation()
        buckets = self._buckets_for(rows.select(self.key).distinct().count())
        folder = f"{self.path}/gen={old[0] + 1 if old else 0}-buckets={buckets}"
        extra = [F.col(c) for c in _BASE]
        placed = self._placed(rows.withColumn("_level", F.struct(*extra)), buckets, "_level")
        self._write(placed.select("*", "_level.*").drop("_level"), folder, "static")

    def _placed(self, rows, buckets, *keep):
        key = F.col(self.key).cast("string")
        place = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
        return rows.filter(key.isNotNull()).select(key.alias(self.key), *self.schema.names[1:], *keep, place)

    def upsert(self, changes: DataFrame, batch, run=0, order=()):
        """Merge the rows of a micro-batch by key as ``merge_by_key`` does; returns (rows before, rows after).

        Both hold the keys of the batch only. A micro-batch that comes again sees nothing of its first try, replaces what
        that wrote, and returns the same. The frames are persisted: unpersist them when they are used.
        """
        if self.generation() is None:
            self._generation_of(self._rows([], None))
        changes = changes.filter(F.col(self.key).isNotNull()).withColumn(self.key, F.col(self.key).cast("string"))
        version = {"run": F.lit(run).cast("long"), "batch": F.lit(batch).cast("long")}
        paths = self.touched(changes)
        # Levels are partition columns: files of a first try are not even listed.
        earlier = (F.col("of_run") < run) | ((F.col("of_run") == run) & (F.col("of_batch") < batch))
        stored = self._rows(paths, paths[0].rpartition("/")[0] if paths else None).filter(earlier).drop(*_BASE)
        old = self._latest(stored.join(changes.select(self.key), self.key, "left_semi")).persist()
        fresh = changes.withColumns(version)
        merged = merge_by_key(fresh.unionByName(old, allowMissingColumns=True), self.key, order)
        new = merged.select(*[c for c in self.schema.names if c not in VERSION]).persist()
        _, buckets, folder = self.generation()
        levels = {"of_run": F.lit(run), "of_batch": F.lit(batch)}
        self._write(self._placed(new.withColumns(version), buckets).withColumns(levels), folder, "dynamic")
        return old.drop(*VERSION), new

    def current(self) -> DataFrame:
        """One row per key, as the last micro-batch left it."""
        found = self.generation()
        rows = self._rows([found[2]] if found else [], found and found[2])
        return self._latest(rows.drop(*_BASE)).drop(*VERSION)

    def compact(self):
        """A new generation without superseded rows.

        The newest micro-batch keeps its own level, as it may have been cut off and come again. The old generation counts
        until the last file of the new one is there.
        """
        found = self.generation()
        if not found:
            return
        rows = self._rows([found[2]], found[2])
        level = F.struct(*[F.col(c) for c in _BASE])
        newest = rows.agg(F.max(level).alias("m")).first().m
        if newest is None or newest.of_run < 0:
            return
        is_newest = (F.col("of_run") == newest.of_run) & (F.col("of_batch") == newest.of_batch)
        settled = self._latest(rows.filter(~is_newest)).withColumns({k: F.lit(v) for k, v in _BASE.items()})
        self._generation_of(settled.unionByName(rows.filter(is_newest)))

    def drop_superseded(self):
        """Remove the folders of generations before the newest whole one, once no reader holds them."""
        found = self.generation()
        fs, at = self._fs(self.path)
        for status in fs.listStatus(at) if found else []:
            name = status.getPath().getName()
            if name.startswith("gen=") and int(name[4:].split("-")[0]) < found[0]:
                fs.delete(status.getPath(), True)
