"""Projections, filters and validation of posts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, is_empty, parsed_date
from ..schemas import DATE_FORMAT, LOWERED_FIELDS, POST, TRANSPORT_FIELDS


def drop_fields(df: DataFrame, names=tuple(TRANSPORT_FIELDS)) -> DataFrame:
    """Remove fields; absent names are ignored."""
    return df.drop(*names)


def require_non_empty(df: DataFrame, column="Description") -> DataFrame:
    """Keep rows whose column is present and not ``''``; white space passes."""
    return df.filter(F.col(column) != "")


def lower_columns(df: DataFrame, columns=tuple(LOWERED_FIELDS)) -> DataFrame:
    """Lower-case the named columns in one projection."""
    return df.withColumns({c: F.lower(c) for c in columns})


def flag_blank(df: DataFrame, column="Description") -> DataFrame:
    """Add both notions of a missing text: empty (ingest) and blank (extraction)."""
    return df.withColumns({"is_empty": is_empty(column), "is_blank": is_blank(column)})


def decode_payload(df: DataFrame, schema=POST, value_col="value", keep=()) -> DataFrame:
    """Binary or string JSON to typed columns; malformed input gives an all-NULL row.

    Columns named in ``keep`` stay in front, such as the raw value or the offset.
    """
    return df.select(*keep, F.from_json(F.col(value_col).cast("string"), schema).alias("data")).select(*keep, "data.*")


def expand_struct(df: DataFrame, column) -> DataFrame:
    """Replace the table by the fields of one struct column."""
    return df.select(f"{column}.*")


def split_quarantine(df: DataFrame, required=("Job_ID",)):
    """(good, quarantine): rows that have all required fields, and the others."""
    valid = F.lit(True)
    for c in required:
        valid = valid & F.col(c).isNotNull()
    return df.filter(valid), df.filter(~valid)


def validate_dates(df: DataFrame, column="Pubblication_date", fmt=DATE_FORMAT):
    """(good, quarantine): the column typed as a date, and rows whose text is no such date.

    A missing date is not an error.
    """
    typed = df.withColumn("_date", parsed_date(column, fmt))
    bad = F.col(column).isNotNull() & F.col("_date").isNull()
    good = typed.filter(~bad).withColumn(column, F.col("_date")).drop("_date")
    return good, df.filter(F.col(column).isNotNull() & parsed_date(column, fmt).isNull())
