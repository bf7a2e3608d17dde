"""Alias maps and taxonomies: JSON files as DataFrames, and the bounded set used in literals."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import literal_map
from . import default_dictionaries as defaults

# A dictionary up to this many entries may be turned into literals; larger ones stay tables.
MAX_LITERAL_ENTRIES = 200_000


def load_alias_map(spark: SparkSession, path: str) -> DataFrame:
    """``{alias: canonical}`` file as rows (alias, canonical); an unreadable file raises."""
    entries = _parsed(spark, path, "map<string,string>")
    return entries.select(F.explode("entries").alias("alias", "canonical"))


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """``{group: [term]}`` file as distinct rows (group, term); an unreadable file raises."""
    entries = _parsed(spark, path, "map<string,array<string>>")
    groups = entries.select(F.explode("entries").alias("group", "terms"))
    return groups.select("group", F.explode("terms").alias("term")).distinct()


def _parsed(spark, path, ddl):
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.from_json("value", ddl, {"mode": "FAILFAST"}).alias("entries"))


def alias_frame(spark: SparkSession, aliases: dict) -> DataFrame:
    """A driver-side alias map as a one-row literal, exploded; the optimizer sees it is small."""
    _check_bound(aliases, "alias map")
    return spark.range(0, 1, 1, 1).select(F.explode(literal_map(aliases)).alias("alias", "canonical"))


def taxonomy_frame(spark: SparkSession, taxonomy: dict) -> DataFrame:
    """A driver-side taxonomy as distinct rows (group, term)."""
    _check_bound([t for terms in taxonomy.values() for t in terms], "taxonomy")
    groups = [
        F.struct(
            F.lit(group).alias("group"),
            F.array(*[F.lit(t) for t in dict.fromkeys(terms)]).alias("terms"),
        )
        for group, terms in taxonomy.items()
    ]
    rows = spark.range(0, 1, 1, 1).select(F.inline(F.array(*groups)))
    return rows.select("group", F.explode("terms").alias("term"))


def _check_bound(entries, what):
    if len(entries) > MAX_LITERAL_ENTRIES:
        raise ValueError(f"{what} has more than {MAX_LITERAL_ENTRIES} entries; use the join operators")


def _bounded_rows(df, what):
    """Rows of a small table; refuses one that is too large for literals."""
    rows = df.take(MAX_LITERAL_ENTRIES + 1)
    _check_bound(rows, what)
    return rows


@dataclass(frozen=True)
class Dictionaries:
    """The dictionaries of one enrichment run, bounded in size."""

    title_aliases: dict = field(default_factory=lambda: dict(defaults.TITLE_ALIASES))
    skill_aliases: dict = field(default_factory=lambda: dict(defaults.SKILL_ALIASES))
    topics: dict = field(default_factory=lambda: dict(defaults.TOPICS))
    services: dict = field(default_factory=lambda: dict(defaults.CLOUD_SERVICES))
    stop_terms: frozenset = frozenset()

    @classmethod
    def load(cls, spark, title_aliases, skill_aliases, topics, services, stop_terms=()):
        """Read the four JSON files."""

        def aliases(path):
            rows = _bounded_rows(load_alias_map(spark, path), path)
            return {r["alias"]: r["canonical"] for r in rows}

        def taxonomy(path):
            out = {}
            for r in _bounded_rows(load_taxonomy(spark, path), path):
                out.setdefault(r["group"], []).append(r["term"])
            return {group: sorted(terms) for group, terms in out.items()}

        return cls(
            aliases(title_aliases),
            aliases(skill_aliases),
            taxonomy(topics),
            taxonomy(services),
            frozenset(stop_terms),
        )

    def lexicon(self):
        """All known skill names: alias keys and targets, topic terms and services."""
        terms = set(self.skill_aliases) | set(self.skill_aliases.values())
        for taxonomy in (self.topics, self.services):
            for members in taxonomy.values():
                terms.update(members)
        return sorted(terms - self.stop_terms)
