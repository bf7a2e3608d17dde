"""Batch and streaming scans. Schemas are declared, never inferred."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LABELLED_TOKENS, POST

_CORRUPT = "_corrupt_record"
#: After a closing bracket, the end of a line that no document goes on from.
_NEXT_ROOT = r"(?<=[}\]])[ \t\r]*\n\s*(?![\s,\]}])"


def spread(df: DataFrame, partitions=None, task_bytes=None) -> DataFrame:
    """Give a scan of few splits enough partitions for costly text work.

    A scan that already has as many splits as the session has cores is left alone. With ``task_bytes`` it gets as many
    partitions as give each no more of its stored bytes: for work that holds or sorts many times what a task reads.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    if task_bytes:
        stored = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        wanted = max(wanted, -(-stored // task_bytes))
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def read_posts_stream(spark: SparkSession, source, options=None, fmt="kafka", schema=None) -> DataFrame:
    """Unbounded payload rows with a ``value`` column.

    With ``fmt="kafka"``, ``source`` is the topic: read from the earliest offset, tolerating lost
    data, and ``minPartitions`` in ``options`` splits a topic of few partitions into more tasks
    without a shuffle. Any other format reads files under the path ``source``.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        defaults = {"subscribe": source, "startingOffsets": "earliest", "failOnDataLoss": "false"}
        return reader.options(**{**defaults, **(options or {})}).load()
    schema = schema or T.StructType([T.StructField("value", T.BinaryType())])
    return reader.schema(schema).options(**(options or {})).load(source)


def read_landing_stream(spark: SparkSession, directory, schema=POST, raw=None, **options) -> DataFrame:
    """Unbounded JSON events from files that arrive in a directory, one event per line.

    ``raw`` names a column for lines that are no such event, kept as they came.
    """
    if raw:
        schema = T.StructType([*schema.fields, T.StructField(raw, T.StringType())])
        options = {"columnNameOfCorruptRecord": raw, **options}
    return spark.readStream.schema(schema).options(**options).json(directory)


def read_posts_json(spark: SparkSession, path, schema=POST, lines=False, raw=None) -> DataFrame:
    """Posts from JSON documents that hold one object or an array of objects.

    With ``lines`` every line of a file is such a document, and files are split between tasks; this is what
    ``write_posts_json`` and the job ``pages`` write. Without it a file, read by one task, may hold one document or
    several, in any layout: a line that follows a closing bracket and goes on with no comma or closing bracket begins
    another one.

    No record is lost: what is no such document becomes a row of NULLs, with its text in the column ``raw`` where one
    is named.
    """
    documents = spark.read.text(path, wholetext=not lines)
    if not lines:
        roots = F.split("value", _NEXT_ROOT)
        alone = F.transform(roots, lambda x: F.when(x.rlike(r"\A\s*[\[{]"), F.array(x)).otherwise(F.split(x, r"\n")))
        documents = documents.select(F.explode(F.flatten(alone)).alias("value"))
    documents = documents.filter(F.col("value").rlike(r"\S"))
    parsed = F.from_json("value", T.ArrayType(schema))  # a single object is an array of one
    posts = documents.select("value", F.explode_outer(F.when(F.size(parsed) != 0, parsed)).alias("post"), parsed.isNotNull().alias("read"))
    posts = posts.filter("post IS NOT NULL OR NOT read")  # an empty array holds no post
    columns = [F.col(f"post.{f.name}").alias(f.name) for f in schema.fields]
    return posts.select(*columns, *([F.when(~F.col("read"), F.col("value")).alias(raw)] if raw else []))


def read_labelled_tokens(spark: SparkSession, path, glob="*.json"):
    """(good, rejects) from a directory of files, by default ``*.json``, one labelled document each.

    A file that is no JSON, or has no tokens, becomes a reject row with its reason.
    """
    schema = T.StructType(LABELLED_TOKENS.fields + [T.StructField(_CORRUPT, T.StringType())])
    records = (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("pathGlobFilter", glob)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .json(path)
        .select("tokens", _CORRUPT, F.col("_metadata.file_path").alias("file"))
    )
    has_tokens = F.coalesce(F.size("tokens") > 0, F.lit(False))
    reason = F.when(F.col(_CORRUPT).isNotNull(), "invalid JSON").when(~has_tokens, "no tokens")
    marked = records.withColumn("reason", reason)
    good = marked.filter("reason IS NULL").select("file", "tokens")
    return good, marked.filter("reason IS NOT NULL").select("file", "reason")
