"""Lexicons as tables of any size, terms of any spelling, chains of aliases."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from test_spans import brute_mentions

from jobsieve.functions.tokens import lexicon_pattern, mentions, normal_forms, unmatchable_terms
from jobsieve.operators import extract, normalize
from jobsieve.plans.enrich import enrich_posts
from jobsieve.schemas import POST, POST_FIELDS
from jobsieve.sources.dictionaries import Dictionaries


def as_table(spark, terms):
    return spark.createDataFrame([(t,) for t in terms], "term string")


def test_terms_that_tokenising_changes(spark):
    terms = ["C (lang)", "node. js", ". net", "...", "java", "a, b", "a; b"]
    assert normal_forms(terms) == {"c lang": "c (lang)", "node js": "node. js", "java": "java", "a b": "a, b"}
    assert unmatchable_terms(terms) == [". net", "..."]
    assert normal_forms(["a (b)", "a b"]) == {"a b": "a b"}
    df = spark.createDataFrame([(1, "C (lang), Node. JS and java; a b. Net"), (2, None), (3, "")], "d int, t string")
    for lexicon in (terms, as_table(spark, terms)):
        got = {r.d: r.skills for r in extract.extract_skills(df, "d", "t", lexicon).collect()}
        assert got == {1: ["a, b", "c (lang)", "java", "node. js"], 2: [], 3: []}


def test_mentions_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(extract, "FOLD", 3)
    rng = random.Random(5)
    words = ["a", "b", "c", "a", "d."]
    texts = [(i, " ".join(rng.choices([*words, "zz"], k=rng.randrange(60)))) for i in range(60)]
    df = spark.createDataFrame(texts, "d int, t string")
    for _ in range(3):
        terms = {" ".join(rng.choices(["a", "b", "c", "d"], k=rng.randrange(1, 5))) for _ in range(20)}
        got = extract.lexicon_mentions(df, "d", "t", as_table(spark, terms)).orderBy("d", "pos").collect()
        for d, text in texts:
            assert [(r.pos, r.n, r.term) for r in got if r.d == d] == [tuple(m) for m in brute_mentions(text, terms)]


def test_one_run_of_overlaps_over_a_whole_text(spark):
    df = spark.createDataFrame([(1, "a " * 30_001)], "d int, t string")
    got = extract.lexicon_mentions(df, "d", "t", as_table(spark, ["a a"]))
    assert got.agg(F.count("*"), F.sum("pos")).first()[:] == (15_000, sum(range(0, 30_000, 2)))


def test_lexicon_of_half_a_million_terms(spark):
    """No refusal; the same rows as a pattern of the terms that matter; canonical names come from the table."""
    many = spark.range(500_000).select(F.concat(F.lit("w"), "id", F.lit(" x")).alias("term"), F.concat(F.lit("c"), "id").alias("canonical"))
    text = "W17 x and w499999, x w42 w7 x x"
    rows = [tuple(text if f == "Description" else str(i) if f == "Job_ID" else "x" for f in POST_FIELDS) for i in range(3)]
    df = spark.createDataFrame([*rows, rows[0]], POST)
    got = enrich_posts(df, Dictionaries(skill_aliases={}), lexicon=many).collect()
    assert [r.Skills.raw_skills for r in got] == [["c17", "c499999", "c7"]] * 4
    terms = ["w17 x", "w499999 x", "w7 x"]
    assert df.select(mentions("Description", lexicon_pattern(terms))).first()[0] == terms


def test_too_many_terms_for_a_pattern_are_joined(spark, monkeypatch):
    monkeypatch.setattr(extract, "MAX_PATTERN_TERMS", 2)
    df = spark.createDataFrame([("k", "java spring sql"), ("k", None)], "Job_ID string, t string")
    out = extract.extract_skills(df, "Job_ID", "t", ["java spring", "sql", "x", "y"])
    assert sorted(r.skills for r in out.collect()) == [[], ["java spring", "sql"]]


def test_texts_do_not_travel(spark):
    df = spark.createDataFrame([("k", "java", 1)], "Job_ID string, t string, n int")
    plan = plan_of(extract.extract_skills(df, "Job_ID", "t", as_table(spark, ["java"])).drop("t"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def brute_aliases(rows):
    first = {}
    for a, c in rows:
        if a is not None and c is not None and a != c:
            first[a] = min(c, first.get(a, c))
    out = {}
    for a in first:
        path, here = [a], first[a]
        while here in first and here not in path:
            path.append(here)
            here = first[here]
        out[a] = (min(path[path.index(here) :]), None, True) if here in path else (here, len(path), False)
    for a, c in rows:
        if a is not None and a == c and a not in out:
            out[a] = (a, 0, False)
    return out


@pytest.mark.parametrize("names", [0, 1, 12, 60])
def test_alias_graphs(spark, names):
    rng = random.Random(names)
    rows = [(f"n{rng.randrange(names)}", f"n{rng.randrange(names)}") for _ in range(names)] + [(None, "x"), ("y", None)]
    got = normalize.resolve_aliases(spark.createDataFrame(rows, "alias string, canonical string")).collect()
    assert {r.alias: (r.canonical, r.hops, r.cyclic) for r in got} == brute_aliases(rows)
    assert len(got) == len({r.alias for r in got})


def test_a_long_chain_a_long_cycle_and_a_tail(spark, monkeypatch):
    rows = [(f"a{i}", f"a{i + 1}") for i in range(1000)] + [(f"c{i}", f"c{(i + 1) % 300}") for i in range(300)]
    rows += [("t0", "t1"), ("t1", "c150")]
    rounds = []
    fresh = normalize.scratch_dir
    monkeypatch.setattr(normalize, "scratch_dir", lambda spark, name: rounds.append(name) or fresh(spark, name))
    got = normalize.resolve_aliases(spark.createDataFrame(rows, "alias string, canonical string")).collect()
    assert {r.alias: (r.canonical, r.hops, r.cyclic) for r in got} == brute_aliases(rows)
    assert len(rounds) <= 13
