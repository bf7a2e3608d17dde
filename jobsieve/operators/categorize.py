"""Sorting skills into topics and cloud services."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from ..schemas import CATEGORY_LEAVES, SERVICE_LEAVES


def match_taxonomy(skills: DataFrame, taxonomy: DataFrame, skill_col="skill") -> DataFrame:
    """Every (skill, group) match of rows with one skill each; a skill may be in several groups."""
    return skills.join(taxonomy, F.lower(F.col(skill_col)) == F.col("term"), "inner")


def distinct_skills(df: DataFrame, key, skill_col="skill") -> DataFrame:
    """The sorted set of skills per key; sets combine map-side before the shuffle."""
    return df.groupBy(key).agg(F.sort_array(F.collect_set(skill_col)).alias("skills"))


def categorize_skills(df: DataFrame, skills_col, topics: dict, services: dict, out="Skills") -> DataFrame:
    """Turn an array of skills into the Skills struct; all leaves sorted, never NULL.

    Matching ignores case; ``raw_skills`` keeps it. A service match adds its provider to
    ``cloud_providers``. Row-local: each leaf is a filter with a constant hash set.
    """
    empty = F.array().cast("array<string>")
    skills = F.coalesce(col(skills_col), empty)
    df = df.withColumns(
        {
            "_raw": F.sort_array(F.array_distinct(skills)),
            "_lower": F.sort_array(F.array_distinct(F.transform(skills, F.lower))),
        }
    )

    def matches(terms):
        # As SQL text a long list of constants is one call, not one per constant.
        if not terms:
            return empty
        return F.expr(f"filter(_lower, s -> s IN ({', '.join(map(_quoted, terms))}))")

    by_provider = {p: matches(services.get(p)) for p in dict.fromkeys([*SERVICE_LEAVES, *services])}
    df = df.withColumn("_services", F.struct(*[c.alias(p) for p, c in by_provider.items()]))
    found = lambda p: F.col("_services")[p]
    providers = [F.when(F.size(found(p)) > 0, F.lit(p)) for p in services]
    implied = F.filter(F.array(*providers), lambda p: p.isNotNull()) if providers else empty
    categories = {leaf: matches(topics.get(leaf)) for leaf in CATEGORY_LEAVES}
    categories["cloud_providers"] = F.sort_array(F.array_union(categories["cloud_providers"], implied))
    struct = F.struct(
        F.col("_raw").alias("raw_skills"),
        F.struct(*[c.alias(leaf) for leaf, c in categories.items()]).alias("categories"),
        F.struct(*[found(p).alias(p) for p in SERVICE_LEAVES]).alias("cloud_services"),
    )
    return df.withColumn(out, struct).drop("_raw", "_lower", "_services")


def _quoted(term):
    escaped = term.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def categorize_relational(matched: DataFrame, key, services_matched: DataFrame) -> DataFrame:
    """Groups per key from joined matches, for taxonomies too large for constants.

    Rows (key, group, skills) with ``group`` a topic or ``service:<provider>``; a service match
    also counts as its provider under ``cloud_providers``.
    """
    topics = matched.select(key, "group", "term")
    by_service = services_matched.select(
        key, F.concat(F.lit("service:"), "group").alias("group"), "term"
    )
    implied = services_matched.select(
        key, F.lit("cloud_providers").alias("group"), F.col("group").alias("term")
    )
    return (
        topics.unionByName(by_service)
        .unionByName(implied)
        .groupBy(key, "group")
        .agg(F.sort_array(F.collect_set("term")).alias("skills"))
    )
