"""Counts over enriched posts: top skills, by group, by category, over time."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import parsed_date
from ..schemas import CATEGORY_LEAVES, LOWERED_FIELDS, SERVICE_LEAVES


def _with_skill(df, *columns):
    """One row per post and skill.

    The outer form keeps the optimizer from adding a filter on the array, which would compute
    the skills a second time.
    """
    rows = df.select(*columns, F.explode_outer("Skills.raw_skills").alias("skill"))
    return rows.filter("skill IS NOT NULL")


def top_skills(df: DataFrame, k=10) -> DataFrame:
    """The k skills named by most posts; ties by name."""
    counts = _with_skill(df).groupBy("skill").agg(F.count("*").alias("posts"))
    return counts.orderBy(F.desc("posts"), "skill").limit(k)


def skills_by(df: DataFrame, column, k=10) -> DataFrame:
    """The k most named skills within every value of a column.

    Ranking runs on the counts, at most one row per distinct skill and value.
    """
    counts = _with_skill(df, column).groupBy(column, "skill").agg(F.count("*").alias("posts"))
    ranked = Window.partitionBy(column).orderBy(F.desc("posts"), "skill")
    return counts.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)


def _leaves():
    leaves = [("category", g, F.col(f"Skills.categories.{g}")) for g in CATEGORY_LEAVES]
    return leaves + [("service", g, F.col(f"Skills.cloud_services.{g}")) for g in SERVICE_LEAVES]


def category_counts(df: DataFrame) -> DataFrame:
    """Posts per topic entry, provider and service: rows (kind, group, term, posts)."""

    def rows(kind, group, values):
        return F.transform(
            values,
            lambda t: F.struct(F.lit(kind).alias("kind"), F.lit(group).alias("group"), t.alias("term")),
        )

    terms = F.flatten(F.array(*[rows(*leaf) for leaf in _leaves()]))
    found = df.select(F.inline_outer(terms)).filter("term IS NOT NULL")
    return found.groupBy("kind", "group", "term").agg(F.count("*").alias("posts"))


def posts_over_time(df: DataFrame, unit="month", column="Pubblication_date") -> DataFrame:
    """Posts per calendar unit of the publication date; undated posts count under NULL."""
    kind = dict(df.dtypes)[column]
    date = F.col(column) if kind == "date" else parsed_date(column)
    period = F.to_date(F.date_trunc(unit, date))
    return df.groupBy(period.alias("period")).agg(F.count("*").alias("posts"))


def facet(df: DataFrame, values: dict) -> DataFrame:
    """Posts whose keyword columns have exactly these values; arrays match by membership."""

    def condition(column, value):
        is_array = df.select(column).schema[0].dataType.typeName() == "array"
        return F.array_contains(column, value) if is_array else F.col(column) == value

    return reduce(lambda d, item: d.filter(condition(*item)), values.items(), df)


#: Keyword columns whose values are counted as facets.
FACETS = LOWERED_FIELDS


def facts(df: DataFrame, *keep, unit="month") -> DataFrame:
    """What enriched posts add to every insight: rows (view, group, term), one per post and count it enters.

    Views: ``skill``, ``title`` and ``industry`` (skills within their values), ``category``, ``service``, ``period`` (NULL for
    undated posts) and ``facet`` (values of a keyword column, which is the group). All come out of one pass without a shuffle,
    with the columns ``keep`` of their post.
    """

    def fact(view, group, term):
        return F.struct(view.alias("view"), group.cast("string").alias("group"), term.cast("string").alias("term"))

    def nested(view, group, terms):
        return F.struct(F.lit(view).alias("view"), group.cast("string").alias("group"), terms.alias("terms"))

    raw = F.col("Skills.raw_skills")
    lists = [nested("skill", F.lit(None), raw), nested("title", F.col("Title"), raw), nested("industry", F.col("Industry_type"), raw)]
    lists += [nested(kind, F.lit(group), terms) for kind, group, terms in _leaves()]
    lists += [nested("facet", F.lit(c), F.array(c)) for c in FACETS]
    each = F.transform(F.array(*lists), lambda g: F.transform(g["terms"], lambda t: fact(g["view"], g["group"], t)))
    kind = dict(df.dtypes)["Pubblication_date"]
    date = F.col("Pubblication_date") if kind == "date" else parsed_date("Pubblication_date")
    period = fact(F.lit("period"), F.lit(unit), F.to_date(F.date_trunc(unit, date)))
    # A struct without any skills gives no list at all.
    known = F.flatten(F.filter(each, lambda x: x.isNotNull()))
    rows = df.select(*keep, F.inline_outer(F.concat(known, F.array(period))))
    return rows.filter("term IS NOT NULL OR view = 'period'")


def signed_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """How counts change when the rows ``old`` leave a table and ``new`` come: (view, group, term, n), n never 0.

    Facts are added up per task before the shuffle, so a term that every post holds costs one row a task.
    """
    both = old.withColumn("n", F.lit(-1)).unionByName(new.withColumn("n", F.lit(1)))
    return facts(both, "n").groupBy("view", "group", "term").agg(F.sum("n").alias("n")).filter("n <> 0")


def current_counts(deltas: DataFrame) -> DataFrame:
    """Counts after all signed changes: (view, group, term, posts)."""
    return deltas.groupBy("view", "group", "term").agg(F.sum("n").alias("posts")).filter("posts <> 0")


def ranked_counts(counts: DataFrame, view, k=10) -> DataFrame:
    """The k first terms of a view within each of its groups, ties by name: (group, term, posts, rank)."""
    order = Window.partitionBy("group").orderBy(F.desc("posts"), "term")
    rows = counts.filter(F.col("view") == view).select("group", "term", "posts")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
