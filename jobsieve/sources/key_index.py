"""An index of known keys in hash buckets, so that a lookup reads the buckets of a micro-batch and no others.

A generation is a folder ``gen=G-buckets=N``; the newest one that was written to its end counts. In it,
``bucket=K`` holds the keys whose hash falls there, in one folder for the keys the generation began with and one for each
micro-batch added since. The number of buckets follows the number of keys when a generation is written: buckets
stay about equally large however many keys there are, and a batch of m keys reads at most m of them.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_GENERATION = re.compile(r"gen=(\d+)-buckets=(\d+)")
#: Folders of the keys that a generation began with.
_BASE = {"of_run": -1, "of_batch": -1}


class KeyIndex:
    """Keys with the run and batch that brought them; NULL keys are not kept."""

    def __init__(self, spark: SparkSession, path, key="Job_ID", keys_per_bucket=50_000, max_buckets=65_536):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.keys_per_bucket, self.max_buckets = keys_per_bucket, max_buckets
        self.schema = T.StructType(
            [T.StructField(key, T.StringType()), T.StructField("run", T.LongType()), T.StructField("batch", T.LongType())]
        )

    def _fs(self, path):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def generation(self):
        """(number, buckets, folder) of the newest generation that is whole, or None."""
        fs, at = self._fs(self.path)
        found = []
        if fs.exists(at):
            for status in fs.listStatus(at):
                name = status.getPath().getName()
                m = _GENERATION.fullmatch(name)
                if m and fs.exists(self._fs(f"{self.path}/{name}/_SUCCESS")[1]):
                    found.append((int(m[1]), int(m[2]), f"{self.path}/{name}"))
        return max(found, default=None)

    def _placed(self, keys, buckets):
        key = F.col(self.key).cast("string")
        return keys.filter(key.isNotNull()).select(
            key.alias(self.key), *self.schema.names[1:], F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
        )

    def _buckets_for(self, n):
        need = -(-n // self.keys_per_bucket)
        return min(self.max_buckets, max(16, 1 << max(0, need - 1).bit_length()))

    def _write(self, placed, folder, overwrite):
        # One file for each bucket, sorted, with a filter that tells absent keys. A generation replaces its whole folder
        # and marks its end there; a batch replaces its own folders in the buckets.
        rows = placed.repartition("bucket").sortWithinPartitions("bucket", self.key)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", overwrite)
            .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
            .partitionBy("bucket", *_BASE)
            .parquet(folder)
        )

    def rebuild(self, keys: DataFrame):
        """Write a new generation of these rows (key, ``run``, ``batch``), with as many buckets as they need.

        Until its last file is there the old generation counts, so a run that is cut off leaves nothing to repair.
        """
        old = self.generation()
        buckets = self._buckets_for(keys.count())
        folder = f"{self.path}/gen={old[0] + 1 if old else 0}-buckets={buckets}"
        first = keys.groupBy(self.key, "run").agg(F.min("batch").alias("batch"))
        placed = self._placed(first, buckets).withColumns({k: F.lit(v) for k, v in _BASE.items()})
        self._write(placed, folder, "static")

    def compact(self):
        """A new generation of all keys of this one: one file a bucket, more buckets where there are more keys."""
        found = self.generation()
        if found:
            self.rebuild(self.spark.read.schema(self.schema).parquet(found[2]).select(*self.schema.names))

    def add(self, keys: DataFrame, batch, run=0):
        """Add the keys of a micro-batch; adding the same (run, batch) again replaces them."""
        _, buckets, folder = self.generation()
        rows = keys.select(self.key).withColumns({"run": F.lit(run), "batch": F.lit(batch)})
        placed = self._placed(rows, buckets).withColumns({"of_run": F.lit(run), "of_batch": F.lit(batch)})
        self._write(placed, folder, "dynamic")

    def touched(self, batch: DataFrame):
        """The folders of the buckets in which keys of this batch would lie: no more than there are buckets."""
        found = self.generation()
        if not found:
            return []
        _, buckets, folder = found
        key = F.col(self.key).cast("string")
        wanted = batch.filter(key.isNotNull()).select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("b")).distinct()
        paths = sorted(f"{folder}/bucket={r.b}" for r in wanted.collect())
        return [p for p in paths if (x := self._fs(p))[0].exists(x[1])]

    def known(self, batch: DataFrame) -> DataFrame:
        """Rows (key, ``run``, ``batch``) of the buckets that this batch touches."""
        paths = self.touched(batch)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", paths[0].rpartition("/")[0])
        return reader.parquet(*paths).select(*self.schema.names)

    def reject_known(self, batch: DataFrame) -> DataFrame:
        """Rows of a batch whose key the index does not hold; rows without a key stay."""
        known = self.known(batch).select(F.col(self.key).alias("_known"))
        return batch.join(known, F.col(self.key).cast("string") == F.col("_known"), "left_anti")
