"""Batch sinks, and keyed tables as versioned Parquet folders.

A keyed table is a folder ``run=R/batch=B`` of plain Parquet written once per micro-batch.
Writing costs what the batch holds, a repeated batch replaces its own folder, and the current
state is a view that merges the versions by key. ``compact`` writes that view out.
"""

import gzip
import zlib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import first_by_key
from .readers import spread

#: Keys that are sent to all tasks, at most.
FEW_KEYS = 100_000
VERSION = ["run", "batch"]
_VERSION_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in VERSION])


def to_payload(df: DataFrame, key=None) -> DataFrame:
    """Rows as JSON in a ``value`` column, with an optional ``key`` column."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).alias("key"), value)


def write_topic(df: DataFrame, target, fmt="kafka", **options):
    """Write JSON payloads to a topic, or append them to a folder of text files."""
    if fmt == "kafka":
        to_payload(df).write.format("kafka").options(topic=target, **options).save()
    else:
        to_payload(df).write.mode("append").options(**options).format(fmt).save(target)


def write_posts_json(df: DataFrame, path, mode="errorifexists"):
    """One JSON object per line; text stays unescaped and NULL fields are kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _by_key(df: DataFrame, key):
    """Frames that hold the rows of ``df`` between them, where the rows of a key have one task.

    Only rows of keys that repeat are shuffled, unless these are more than FEW_KEYS: values are large.
    """
    repeated = df.groupBy(F.col(key).alias("_key")).count().filter("count > 1").select("_key")
    found = repeated.limit(FEW_KEYS + 1).collect()
    if not found:
        return [df]
    if len(found) > FEW_KEYS:
        return [df.repartition(key)]
    few = F.broadcast(df.sparkSession.createDataFrame(found, repeated.schema))
    same = df[key].eqNullSafe(few["_key"])
    return [df.join(few, same, "left_anti"), df.join(few, same, "left_semi").repartition(key)]


def write_files(df: DataFrame, path, key, value, suffix=".txt", folders=64):
    """One file per row, named ``<key>=<its value>_<n><suffix>``, in at most ``folders`` folders below ``path``.

    Rows that share a key are numbered. Tasks write through pyarrow's file systems: Spark's own writer would make a folder for
    every key, which the driver renames one after the other. A key has one task, so a repeated task writes the same names.
    The keys are read ahead of the rows. Files are compressed where ``suffix`` ends in ``.gz``; Spark reads them by that name.
    """

    def put(rows):
        from pyarrow.fs import FileSystem

        store, root = FileSystem.from_uri(path)
        copies, made = Counter(), set()
        for k, text in rows:
            folder = f"{root}/{zlib.crc32(str(k).encode()) % folders:02d}"
            if folder not in made:
                store.create_dir(folder, recursive=True)
                made.add(folder)
            data = text.encode()
            if suffix.endswith(".gz"):
                data = gzip.compress(data, 6, mtime=0)
            with store.open_output_stream(f"{folder}/{key}={k}_{copies[k]}{suffix}", compression=None) as out:
                out.write(data)
            copies[k] += 1

    for part in _by_key(spread(df.select(key, value)), key):
        part.foreachPartition(put)


def ensure_table(spark: SparkSession, name, schema, location=None):
    """Create an empty Parquet table unless one of that name exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{at}")
    return spark.table(name)


def append_version(df: DataFrame, path, batch, run=0, partition_by=()):
    """Write one micro-batch; writing the same (run, batch) again replaces it."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/run={run}/batch={batch}")


def read_versions(spark: SparkSession, path, schema) -> DataFrame:
    """All versions of a keyed table, an empty table before the first write."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    full = T.StructType(schema.fields + _VERSION_SCHEMA.fields)
    if not fs.exists(hadoop_path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(path)


def latest_by_key(versions: DataFrame, key="Job_ID", order=()) -> DataFrame:
    """State of a table that is overwritten by key: the row of the last version wins."""
    newest = [F.desc(c) for c in [*VERSION, *order]]
    return first_by_key(versions, key, newest).drop(*VERSION)


def merge_by_key(versions: DataFrame, key="Job_ID", order=()) -> DataFrame:
    """State of a table that is upserted by key: per leaf, the last value that is not NULL.

    Structs merge field by field and arrays are replaced whole. One aggregation, combined
    map-side, gives all leaves. Of rows that tie on version and ``order`` one wins by its content, with all
    its leaves, whatever order the rows come in.
    """
    content = F.xxhash64(*[F.col(c) for c in versions.columns if c not in VERSION])
    newest = F.struct(*[F.col(c) for c in [*VERSION, *order]], content.alias("_content"))
    leaves = _leaves(versions.drop(*VERSION).schema, key)
    merged = versions.groupBy(key).agg(
        *[
            F.max_by(F.col(path), F.when(F.col(path).isNotNull(), newest)).alias(path.replace(".", "__"))
            for path in leaves
        ]
    )
    columns = [c for c in versions.columns if c not in VERSION]
    schema = versions.schema
    return merged.select(*[_rebuilt(schema[c], c, key) for c in columns])


def _leaves(schema, key, prefix=""):
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if path == key:
            continue
        if isinstance(f.dataType, T.StructType):
            out += _leaves(f.dataType, key, path + ".")
        else:
            out.append(path)
    return out


def _rebuilt(field, path, key):
    if isinstance(field.dataType, T.StructType):
        parts = [_rebuilt(f, f"{path}.{f.name}", key).alias(f.name) for f in field.dataType.fields]
        return F.struct(*parts).alias(field.name)
    return F.col(path.replace(".", "__")).alias(field.name)


def upsert(old: DataFrame, new: DataFrame, key="Job_ID", order=()) -> DataFrame:
    """Table after an upsert: values of ``new`` that are not NULL win, leaf by leaf."""
    versions = old.withColumns({"run": F.lit(0), "batch": F.lit(0)}).unionByName(
        new.withColumns({"run": F.lit(0), "batch": F.lit(1)})
    )
    return merge_by_key(versions, key, order)


def compact(spark: SparkSession, path, schema, target, view=merge_by_key, key="Job_ID"):
    """Write the current state of a keyed table as the only version of a new one."""
    append_version(view(read_versions(spark, path, schema), key), target, batch=0)


def compact_posts(spark: SparkSession, path, target):
    """Write all posts of an ingest table as the seed of a new one, whatever the run that goes on with it.

    The columns are those of the stored files; each key is stored once, so nothing is merged.
    """
    posts = spark.read.option("basePath", path).parquet(path).drop(*VERSION)
    append_version(posts, target, batch=-1, partition_by=["has_text"])
