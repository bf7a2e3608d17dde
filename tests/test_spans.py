"""Span decoding and lexicon matching against plain loops on random input."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from jobsieve.functions.tokens import (
    MAX_PATTERN_TERMS,
    SEPARATORS, decode_tagged, lexicon_pattern, matchable_terms, mentions, span_text, tagged_tokens, tokens,
)
from jobsieve.functions.text import strip
from jobsieve.operators import extract
from jobsieve.schemas import SPECIAL_TOKENS
from jobsieve.sources.dictionaries import Dictionaries


def strict_loop(rows):
    spans, current = [], []
    for pos, token, label in rows:
        if token in SPECIAL_TOKENS:
            continue
        if label == "B-SKILL":
            if current:
                spans.append(current)
            current = [(pos, token)]
        elif label == "I-SKILL" and current:
            current.append((pos, token))
        elif current:
            spans.append(current)
            current = []
    return spans + ([current] if current else [])


def conll_loop(rows):
    spans, before = [], "O"
    for pos, token, label in rows:
        if token in SPECIAL_TOKENS:
            continue
        if label == "B-SKILL" or (label == "I-SKILL" and before == "O"):
            spans.append([(pos, token)])
        elif label == "I-SKILL":
            spans[-1].append((pos, token))
        before = label
    return spans


def random_docs(n, seed):
    rng = random.Random(seed)
    docs = {}
    for d in range(n):
        size = rng.randrange(0, 30)
        weights = rng.choice([(1, 1, 1), (1, 1, 6), (1, 6, 12), (6, 1, 1)])
        docs[d] = [
            (i, rng.choice(["a", "b", "##c", "[SEP]", "d"]), rng.choices(["O", "B-SKILL", "I-SKILL"], weights)[0])
            for i in range(size)
        ]
    return docs


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 1 << 16])
@pytest.mark.parametrize("mode, loop", [("strict", strict_loop), ("conll", conll_loop)])
def test_decode_rows(spark, chunk, mode, loop):
    docs = random_docs(120, chunk)
    rows = [(d, *r) for d, rs in docs.items() for r in rs]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc int, pos int, token string, label string")
    got = {(r.doc, r.start, r.end, tuple(r.tokens)) for r in extract.decode_bio(df, mode=mode, chunk=chunk).collect()}
    want = {(d, s[0][0], s[-1][0], tuple(t for _, t in s)) for d, rs in docs.items() for s in loop(rs)}
    assert got == want


def test_decode_arrays(spark):
    docs = random_docs(200, 5)
    data = [(d, [(t, label) for _, t, label in rs]) for d, rs in docs.items()]
    df = spark.createDataFrame(data, "doc int, tagged array<struct<token:string,label:string>>")
    got = {r.doc: r.spans for r in df.select("doc", decode_tagged("tagged").alias("spans")).collect()}
    assert got == {d: [[t for _, t in s] for s in strict_loop(rs)] for d, rs in docs.items()}


def test_one_huge_document_is_spread(spark):
    """All rows in one document: several reducers take part and the result is exact."""
    n = 200_000
    df = spark.range(n).select(
        F.lit("only").alias("doc"),
        F.col("id").alias("pos"),
        F.lit("t").alias("token"),
        F.when(F.col("id") % 10 == 0, "B-SKILL").when(F.col("id") % 10 < 4, "I-SKILL").otherwise("O").alias("label"),
    )
    spans = extract.decode_bio(df, chunk=1 << 10)
    assert spans.count() == n // 10
    assert spans.filter("end - start <> 3").count() == 0
    plan = plan_of(spans)
    assert any("hashpartitioning(" in line and "chunk#" in line for line in plan.splitlines())


@pytest.mark.parametrize("chunk", [2, 1 << 16])
def test_rows_of_a_chunk_are_put_together_before_the_shuffle(spark, chunk):
    """One row per chunk and task is shuffled, and no window runs over rows inside of chunks."""
    n = 1000
    df = spark.range(0, n, 1, 1).select(
        (F.col("id") % 2).alias("doc"), F.col("id").alias("pos"), F.lit("t").alias("token"), F.lit("B-SKILL").alias("label")
    )
    spans = extract.decode_bio(df, chunk=chunk)
    plan = plan_of(spans)
    assert plan.count("Window [") == 1 and plan.index("partial_collect_list") > plan.index("chunk#")
    assert spans.count() == n and spans.filter("start = end AND tokens = array('t')").count() == n


@pytest.mark.parametrize("chunk", [2, 1 << 16])
@pytest.mark.parametrize("mode", ["strict", "conll"])
def test_repeated_and_missing_places(spark, chunk, mode):
    """Rows that come twice stand side by side; rows without a position or document still make up spans of their own."""
    text = [(-1, "x", "I-SKILL"), (0, "b", "B-SKILL"), (1, "c", "I-SKILL"), (2, "d", None), (3, None, "B-SKILL"), (4, "e", "I-SKILL")]
    rows = [((d, 0), *r) for d in (None, 7) for r in text + text[::-1]] + [((9, 1), None, "lost", "I-SKILL")]
    df = spark.createDataFrame(rows, "doc struct<k:int,g:int>, pos int, token string, label string")
    got = sorted(((r.doc.k or 0), r.start, r.end, r.tokens) for r in extract.decode_bio(df, mode=mode, chunk=chunk).collect() if r.start is not None)
    want = [(0, 1, ["b", "b", "c", "c"])]
    if mode == "conll":
        want = [(-1, -1, ["x", "x"]), *want, (4, 4, ["e", "e"])]
    assert got == [(d, *w) for d in (0, 7) for w in want]
    lost = [r.tokens for r in extract.decode_bio(df, mode=mode, chunk=chunk).collect() if r.start is None]
    assert lost == ([["lost"]] if mode == "conll" else [])


def brute_tokens(text):
    import re

    parts = re.split(f"[{SEPARATORS}]", text.lower())
    return [p.rstrip(".") for p in parts if p.rstrip(".")]


def brute_mentions(text, terms):
    words, out, i = brute_tokens(text), [], 0
    while i < len(words):
        for n in (4, 3, 2, 1):
            gram = " ".join(words[i : i + n])
            if i + n <= len(words) and gram in terms:
                out.append((i, n, gram))
                i += n
                break
        else:
            i += 1
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    terms = Dictionaries().lexicon()
    pieces = terms + ["the", "a", "of", "net", "js", "..", ".", "x.", "café", "node", "azure", "sql", "server", "spring"]
    seps = [" ", "  ", ", ", ". ", "\n", "; ", " ", " • ", "...", "(", ")", "/", "–", ": "]
    return [
        (i, "".join(rng.choice(pieces).title() if rng.random() < 0.3 else rng.choice(pieces) + rng.choice(seps) for _ in range(rng.randrange(0, 60))))
        for i in range(400)
    ]


def test_mentions_match_brute_force(spark, texts):
    terms = set(matchable_terms(Dictionaries().lexicon()))
    pattern = lexicon_pattern(terms)
    df = spark.createDataFrame(texts, "d int, t string")
    out = df.select(
        "d", tokens("t").alias("w"), mentions("t", pattern).alias("m"), tagged_tokens("t", pattern).alias("g")
    ).withColumn("s", F.transform(decode_tagged("g"), lambda s: span_text(s)))
    for row in out.collect():
        text = texts[row.d][1]
        expected = [term for _, _, term in brute_mentions(text, terms)]
        assert row.w == brute_tokens(text)
        assert row.m == expected
        assert row.s == expected
        assert [g.token for g in row.g] == row.w


def test_labelled_rows_match_tagged_tokens(spark, texts):
    """Rows of labelled tokens come without a lambda that makes a label for every token."""
    terms = Dictionaries().lexicon()
    odd = [(-1, None), (-2, ""), (-3, "java..\u0001java\u0002 x"), (-4, "... Amazon  Web, Services.. sql.")]
    df = spark.createDataFrame(texts + odd, "d int, t string")
    rows = extract.label_tokens(df, "d", "t", terms)
    assert "named_struct(token" not in plan_of(rows)
    want = df.select("d", F.posexplode(tagged_tokens("t", lexicon_pattern(terms)))).select("d", "pos", "col.token", "col.label")
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, want.collect()))


def test_lexicon_hits_match_brute_force(spark, texts):
    terms = set(matchable_terms(Dictionaries().lexicon()))
    lexicon = spark.createDataFrame([(t,) for t in terms], "term string")
    df = spark.createDataFrame(texts, "d int, t string")
    got = {tuple(r) for r in extract.lexicon_hits(df, "d", "t", lexicon).collect()}
    want = set()
    for d, text in texts:
        words = brute_tokens(text)
        hits = [
            (i, n, " ".join(words[i : i + n]))
            for i in range(len(words))
            for n in range(1, 5)
            if i + n <= len(words) and " ".join(words[i : i + n]) in terms
        ]
        want |= {
            (d, *h)
            for h in hits
            if not any(b[1] > h[1] and b[0] <= h[0] and b[0] + b[1] >= h[0] + h[1] for b in hits)
        }
    assert got == want


def test_random_lexicons(spark):
    rng = random.Random(3)
    words = ["a", "ab", "abc", "b", "c+", "c", ".d", "e.f", "aa"]
    for _ in range(5):
        terms = {" ".join(rng.choices(words, k=rng.randrange(1, 5))) for _ in range(25)}
        texts = [(i, " ".join(rng.choices(words + ["zz", "a."], k=25))) for i in range(40)]
        df = spark.createDataFrame(texts, "d int, t string").select("d", mentions("t", lexicon_pattern(terms)).alias("m"))
        for row in df.collect():
            assert row.m == [t for _, _, t in brute_mentions(texts[row.d][1], terms)]


def test_custom_labeler_equals_lexicon(spark, texts):
    lexicon = Dictionaries().lexicon()
    df = spark.createDataFrame(texts, "d int, t string")
    own = extract.extract_skills(df, "d", "t", labeler=lambda text: tagged_tokens(text, lexicon_pattern(lexicon)))
    built_in = extract.extract_skills(df, "d", "t", lexicon)
    assert {r.d: r.skills for r in own.collect()} == {r.d: r.skills for r in built_in.collect()}


def test_custom_labeler_on_repeated_keys(spark):
    df = spark.createDataFrame([("k", "java spring"), ("k", "sql python")], "Job_ID string, t string")
    labeler = lambda text: tagged_tokens(text, lexicon_pattern(["java spring", "sql"]))
    out = extract.extract_skills(df, "Job_ID", "t", labeler=labeler)
    assert {r.t: r.skills for r in out.collect()} == {"java spring": ["java spring"], "sql python": ["sql"]}
    assert "Exchange" not in plan_of(out)


def test_terms_of_any_case_and_length(spark):
    terms = ["a b c d e", "PostgreSQL", "Apache Kafka"]
    df = spark.createDataFrame([(1, "x a b c d e, postgresql on Apache  Kafka")], "d int, t string")
    hits = extract.lexicon_hits(df, "d", "t", spark.createDataFrame([(t,) for t in terms], "term string"))
    found = sorted(r.term for r in hits.collect())
    assert found == ["a b c d e", "apache kafka", "postgresql"]
    assert sorted(df.select(mentions("t", lexicon_pattern(terms))).first()[0]) == found


def test_lexicon_size_is_checked():
    with pytest.raises(ValueError, match="exceed"):
        lexicon_pattern([f"term{i}" for i in range(MAX_PATTERN_TERMS + 1)])


def test_large_lexicon(spark):
    """20,000 terms and aliases give the same as the few that matter."""
    from jobsieve.plans.enrich import enrich_posts
    from jobsieve.schemas import POST, POST_FIELDS
    from jobsieve.sources.dictionaries import Dictionaries

    text = "w17 x and w19999 y, w42 z"
    df = spark.createDataFrame([tuple(text if f == "Description" else "x" for f in POST_FIELDS)], POST)
    aliases = {f"w{i} x": f"c{i}" for i in range(20_000)} | {"w19999 y": "last"}
    skills = enrich_posts(df, Dictionaries(skill_aliases=aliases)).first().Skills
    assert skills.raw_skills == ["c17", "last"]


@pytest.mark.parametrize("run", [" ", ".", "\n", ". ", " .", "a ", "•", "..x ", "c "])
def test_very_long_runs(spark, run):
    """Long runs neither overflow the stack nor take quadratic time."""
    text = "java" + run * 100_000 + " spring" + run * 50_000 + "sql " + "." * 100_000 + "x"
    terms = {"java", "spring", "sql", "c", "java sql"}
    pattern = lexicon_pattern(terms)
    df = spark.createDataFrame([(text,)], "t string").select(
        F.size(tokens("t")).alias("n"), F.size(mentions("t", pattern)).alias("m"), F.length(strip("t")).alias("s")
    )
    row = df.first()
    assert row.n == len(brute_tokens(text)) and row.m == len(brute_mentions(text, terms)) and row.s == len(text.strip())
