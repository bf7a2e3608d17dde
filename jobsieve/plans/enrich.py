"""The two extraction plans: full enrichment and the flat batch form."""

from pyspark.sql import DataFrame

from ..operators.categorize import categorize_skills
from ..operators.clean import lower_columns
from ..operators.extract import extract_skills
from ..operators.normalize import normalize_array_by_map, normalize_by_map
from ..sources.dictionaries import Dictionaries, alias_frame


def normalize_posts(df: DataFrame, dicts: Dictionaries) -> DataFrame:
    """Lower-case the keyword columns and map the title to its canonical form."""
    aliases = alias_frame(df.sparkSession, dicts.title_aliases)
    return normalize_by_map(lower_columns(df), "Title", aliases)


def enrich_posts(df: DataFrame, dicts=None, labeler=None, key="Job_ID", max_tokens=None, lexicon=None) -> DataFrame:
    """Posts with normalised title and the Skills struct instead of the Description.

    The plan has no shuffle, with a custom ``labeler`` too, so batch and streaming share it.
    ``lexicon`` replaces the terms of the dictionaries: a list, or a table (``term``, ``canonical``) of any size, which is joined.
    """
    dicts = dicts or Dictionaries()
    posts = normalize_posts(df, dicts)
    posts = extract_skills(
        posts, key, "Description", dicts.lexicon() if lexicon is None else lexicon, labeler, out="_skills", max_tokens=max_tokens
    )
    posts = normalize_array_by_map(posts, "_skills", dicts.skill_aliases)
    posts = categorize_skills(posts, "_skills", dicts.topics, dicts.services)
    return posts.drop("_skills", "Description")


def extract_flat(df: DataFrame, dicts=None, labeler=None, key="Job_ID", max_tokens=None, lexicon=None) -> DataFrame:
    """Posts with a plain array of the skills as found; nothing is lower-cased, mapped or grouped."""
    dicts = dicts or Dictionaries()
    posts = extract_skills(
        df, key, "Description", dicts.lexicon() if lexicon is None else lexicon, labeler, out="Skills", max_tokens=max_tokens
    )
    return posts.drop("Description")
