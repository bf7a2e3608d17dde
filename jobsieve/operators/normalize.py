"""Alias lookups with pass-through, for scalar columns and for arrays, and the dictionary audit."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import lookup
from ..functions.text import col, remove_prefix, strip
from ..session import scratch_dir


def normalize_by_map(df: DataFrame, column, aliases: DataFrame, trim=False) -> DataFrame:
    """Replace a value by its canonical form: exact match, one hop, unmapped values pass.

    ``aliases`` has unique keys (alias, canonical). It is broadcast when its estimated size is
    under ``spark.sql.autoBroadcastJoinThreshold``; otherwise this is a shuffled join.
    """
    value = strip(column) if trim else F.col(column)
    renamed = aliases.select(F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical"))
    return (
        df.join(renamed, value == F.col("_alias"), "left")
        .withColumn(column, F.coalesce("_canonical", F.col(column)))
        .drop("_alias", "_canonical")
    )


def normalized_array(values, aliases: dict):
    """Column form for arrays: one leading ``##`` goes, aliases map, empties drop, set semantics.

    Case-sensitive, one hop; NULL gives ``[]``. Row-local, for dictionaries of bounded size.
    """
    def canonical(skill):
        bare = remove_prefix(skill, "##")
        return F.coalesce(lookup(aliases, bare), bare)

    mapped = F.filter(F.transform(col(values), canonical), lambda s: s != "")
    return F.coalesce(F.sort_array(F.array_distinct(mapped)), F.array().cast("array<string>"))


def normalize_array_by_map(df: DataFrame, column, aliases, key=None) -> DataFrame:
    """Normalise an array column.

    A dict of bounded size is applied inside the row. A DataFrame (alias, canonical) of any size
    is joined to the exploded elements, which are then gathered again per ``key``; the distinct
    elements combine map-side.
    """
    if isinstance(aliases, dict):
        return df.withColumn(column, normalized_array(column, aliases))
    elements = (
        df.select(key, F.explode_outer(column).alias("_skill"))
        .filter("_skill IS NOT NULL")
        .withColumn("_skill", remove_prefix("_skill", "##"))
    )
    sets = (
        normalize_by_map(elements, "_skill", aliases)
        .filter(F.col("_skill") != "")
        .groupBy(key)
        .agg(F.sort_array(F.collect_set("_skill")).alias("_skills"))
    )
    empty = F.array().cast("array<string>")
    return (
        df.join(sets, key, "left")
        .withColumn(column, F.coalesce("_skills", empty))
        .drop("_skills")
    )


def dictionary_audit(aliases: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Rows (issue, term, detail) for entries that cannot work as they look.

    unreachable: a taxonomy term that is itself an alias of something else;
    alias_chain: a canonical form that is an alias again (only one hop is followed);
    multi_group: a term in several groups; uncategorised: a canonical form in no group.
    """
    unreachable = (
        taxonomy.join(aliases, F.col("term") == F.col("alias"))
        .filter("alias != canonical")
        .select(F.lit("unreachable").alias("issue"), "term", F.col("canonical").alias("detail"))
        .distinct()
    )
    second = aliases.select(F.col("alias").alias("a2"), F.col("canonical").alias("c2"))
    chains = (
        aliases.join(second, F.col("canonical") == F.col("a2"))
        .filter("a2 != c2")
        .select(F.lit("alias_chain").alias("issue"), F.col("alias").alias("term"), F.col("c2").alias("detail"))
    )
    multi = (
        taxonomy.groupBy("term")
        .agg(F.sort_array(F.collect_set("group")).alias("groups"))
        .filter(F.size("groups") > 1)
        .select(F.lit("multi_group").alias("issue"), "term", F.array_join("groups", ",").alias("detail"))
    )
    uncategorised = (
        aliases.select(F.lower("canonical").alias("term"))
        .distinct()
        .join(taxonomy, "term", "left_anti")
        .select(F.lit("uncategorised").alias("issue"), "term", F.lit("").alias("detail"))
    )
    return unreachable.unionByName(chains).unionByName(multi).unionByName(uncategorised)


def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """Chains of aliases followed to their end: rows (alias, canonical, hops, cyclic), one per alias.

    ``hops`` counts the steps to a name that is no alias, or is its own. An alias whose chain runs into a
    cycle gets the smallest name of that cycle, ``hops`` NULL and ``cyclic`` true; an alias that is its own canonical form is
    no cycle. Of several canonical forms of one alias the smallest counts; NULL aliases and forms are left out.

    Pointers are doubled: each round every alias takes over what its target points at, so a chain of a thousand steps
    takes ten rounds. Each round is written to the scratch folder, which keeps the plan short. Once the number of open
    aliases, the names they point at and the smallest names seen stay the same, all that is open is cyclic.
    """
    spark = aliases.sparkSession
    state = (
        aliases.filter("alias IS NOT NULL AND canonical IS NOT NULL AND alias <> canonical")
        .groupBy("alias")
        .agg(F.min("canonical").alias("canonical"))
    )
    state = state.withColumns({"hops": F.lit(1).cast("bigint"), "least": F.col("alias"), "open": F.lit(True)})
    before = None
    while True:
        target = state.select(
            F.col("alias").alias("_alias"),
            F.col("canonical").alias("_to"),
            F.col("hops").alias("_hops"),
            F.col("least").alias("_least"),
        )
        step = state.filter("open").join(target, F.col("canonical") == F.col("_alias"), "left")
        goes_on = F.col("_alias").isNotNull()
        moved = step.select(
            "alias",
            F.coalesce("_to", "canonical").alias("canonical"),
            (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops"),
            F.when(goes_on, F.least("least", "_least")).otherwise(F.col("least")).alias("least"),
            goes_on.alias("open"),
        )
        path = scratch_dir(spark, "aliases")
        moved.unionByName(state.filter("NOT open")).write.parquet(path)
        state = spark.read.parquet(path)
        waiting = state.filter("open")
        now = waiting.agg(
            F.count("*").alias("open"),
            F.count_distinct("canonical").alias("targets"),
            F.sum(F.xxhash64("alias", "least").cast("decimal(38,0)")).alias("seen"),
        ).first()
        if not now.open or now == before:
            break
        before = now
    # What is still open points at a member of its cycle, and that member has seen the whole cycle.
    members = waiting.select(F.col("alias").alias("_member"), F.col("least").alias("_name"))
    cyclic = waiting.join(members, F.col("canonical") == F.col("_member")).select(
        "alias", F.col("_name").alias("canonical"), F.lit(None).cast("bigint").alias("hops"), F.lit(True).alias("cyclic")
    )
    ended = state.filter("NOT open").select("alias", "canonical", "hops", F.lit(False).alias("cyclic"))
    own = (
        aliases.filter("alias = canonical")
        .select("alias", "canonical", F.lit(0).cast("bigint").alias("hops"), F.lit(False).alias("cyclic"))
        .distinct()
        .join(ended.unionByName(cyclic).select("alias"), "alias", "left_anti")
    )
    return ended.unionByName(cyclic).unionByName(own)
