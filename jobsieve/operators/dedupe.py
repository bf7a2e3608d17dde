"""Keyed lookups and first-wins deduplication."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import require_non_empty


def _columns(c):
    return [c] if isinstance(c, str) else list(c)


def first_by_key(df: DataFrame, key, order) -> DataFrame:
    """One row per key, the first by ``order`` (columns that make a total order).

    The optimizer limits each map task to one row per key before the shuffle, so a key that
    holds a large share of the rows reaches its reducer as one row per task.
    """
    ranked = Window.partitionBy(*_columns(key)).orderBy(
        *[F.col(c) if isinstance(c, str) else c for c in (order if isinstance(order, (list, tuple)) else [order])]
    )
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def dedupe_first(df: DataFrame, key="Job_ID", order="arrival", column="Description") -> DataFrame:
    """The first post per key that has a non-empty Description."""
    return first_by_key(require_non_empty(df, column), key, order)


def lookup_enrich(df: DataFrame, table: DataFrame, key="Job_ID", fields=None) -> DataFrame:
    """Bring fields of the existing row with the same key under new names, NULL if there is none.

    ``table`` holds one row per key, as every keyed table here does. The join stays a plain
    equi join, so AQE can split a hot key of ``df``.
    """
    fields = fields or {"Description": "old_description"}
    known = table.select(key, *[F.col(src).alias(dst) for src, dst in fields.items()])
    return df.join(known, key, "left")


def reject_known(df: DataFrame, table: DataFrame, key="Job_ID", column="Description") -> DataFrame:
    """Drop rows whose key the table already holds with a non-empty column."""
    return df.join(require_non_empty(table, column).select(key), key, "left_anti")


def overwrite_by_key(df: DataFrame, table: DataFrame, key="Job_ID", order=()) -> DataFrame:
    """Table after writing whole rows by key: new rows replace old ones, of several new rows of a key the last stays.

    The last is that of the greatest ``order``; rows that tie, or come without one, are settled by content. Rows without a
    key are never overwritten and all stay.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    last = first_by_key(df.filter(F.col(key).isNotNull()), key, [*[F.desc(c) for c in _columns(order)], content])
    kept = table.join(last.select(key), key, "left_anti")
    return kept.unionByName(last).unionByName(df.filter(F.col(key).isNull()))
