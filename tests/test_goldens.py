"""Small cases with known results."""

import pytest
from pyspark.sql import functions as F

from jobsieve.functions import arrays, html, text
from jobsieve.functions.tokens import span_text
from jobsieve.operators import categorize, clean, dedupe, extract, insights, normalize, training
from jobsieve.plans.enrich import enrich_posts, extract_flat
from jobsieve.schemas import CATEGORY_LEAVES, POST, POST_FIELDS, SERVICE_LEAVES
from jobsieve.sources import dictionaries as dicts_io
from jobsieve.sources.dictionaries import Dictionaries

DICTS = Dictionaries()


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first()["x"]


def post(**values):
    return tuple(values.get(f) for f in POST_FIELDS)


def test_dedupe_keeps_first_with_text(spark):
    rows = [(1, "1", "x"), (2, "1", "y"), (3, "2", ""), (4, "2", "late"), (5, "3", None), (6, "4", "   "), (7, "5", "z")]
    df = spark.createDataFrame(rows, "arrival int, Job_ID string, Description string")
    table = spark.createDataFrame([("5", ""), ("1", "old")], "Job_ID string, Description string")
    first = dedupe.dedupe_first(df)
    assert sorted(r.arrival for r in first.collect()) == [1, 4, 6, 7]
    assert sorted(r.arrival for r in dedupe.reject_known(first, table).collect()) == [4, 6, 7]
    looked_up = dedupe.lookup_enrich(first, table)
    assert {r.Job_ID: r.old_description for r in looked_up.collect()} == {"1": "old", "2": None, "4": None, "5": ""}


def test_overwrite_by_key_with_repeated_key(spark):
    table = spark.createDataFrame([("1", "a"), ("2", "b")], "Job_ID string, t string")
    new = spark.createDataFrame([("2", "c"), ("3", "d")], "Job_ID string, t string")
    out = {tuple(r) for r in dedupe.overwrite_by_key(new, table).collect()}
    assert out == {("1", "a"), ("2", "c"), ("3", "d")}


def test_decode_and_quarantine(spark):
    payloads = [
        '{"Job_ID":"1","Title":"t","extra":5}',
        '{"Job_ID":2}',
        "not json",
        "",
        '{"job_id":"3"}',
        '[{"Job_ID":"4"}]',
        '{"Job_ID":"5","Title":{"a": 1}}',
    ]
    df = spark.createDataFrame([(bytearray(p, "utf-8"),) for p in payloads], "value binary")
    good, bad = clean.split_quarantine(clean.decode_payload(df))
    assert {(r.Job_ID, r.Title) for r in good.collect()} == {("1", "t"), ("2", None), ("5", '{"a":1}')}
    assert bad.count() == 4
    assert good.columns == POST_FIELDS


@pytest.mark.parametrize(
    "title, expected",
    [
        ("Frontend Developer", "frontend dev"),
        ("Sviluppatore Back-End", "backend dev"),
        ("iOS Programmer", "ios dev"),
        ("Plumber", "plumber"),
        (" frontend developer", " frontend developer"),
        ("", ""),
        (None, None),
    ],
)
def test_title_map(spark, title, expected):
    df = spark.createDataFrame([(title,)], "Title string")
    aliases = dicts_io.alias_frame(spark, DICTS.title_aliases)
    lowered = clean.lower_columns(df, ["Title"])
    assert normalize.normalize_by_map(lowered, "Title", aliases).first().Title == expected
    if title == " frontend developer":
        trimmed = normalize.normalize_by_map(lowered, "Title", aliases, trim=True)
        assert trimmed.first().Title == "frontend dev"


@pytest.mark.parametrize(
    "skills, expected",
    [
        (["##reactjs", "reactjs", "react", "##"], ["react"]),
        (["####k8s"], ["##k8s"]),
        (["ReactJS"], ["ReactJS"]),
        (["gcp"], ["google cloud platform"]),
        ([], []),
        (None, []),
    ],
)
def test_skill_map(spark, skills, expected):
    df = spark.createDataFrame([(1, skills)], "id int, skills array<string>")
    assert normalize.normalize_array_by_map(df, "skills", DICTS.skill_aliases).first().skills == expected
    joined = normalize.normalize_array_by_map(df, "skills", dicts_io.alias_frame(spark, DICTS.skill_aliases), "id")
    assert joined.first().skills == expected


@pytest.mark.parametrize(
    "skills, leaves",
    [
        (["s3"], {"cloud_providers": ["aws"], "aws": ["s3"]}),
        (["aws"], {"cloud_providers": ["aws"]}),
        (["oracle"], {"cloud_providers": ["oracle"], "databases": ["oracle"]}),
        (["dynamodb"], {"cloud_providers": ["aws"], "aws": ["dynamodb"], "databases": ["dynamodb"]}),
        (
            ["Python", "s3", "bigquery"],
            {"programming_languages": ["python"], "cloud_providers": ["aws", "gcp"], "aws": ["s3"], "gcp": ["bigquery"]},
        ),
        (["google cloud platform"], {}),
        ([], {}),
        (None, {}),
    ],
)
def test_categories(spark, skills, leaves):
    df = spark.createDataFrame([(skills,)], "s array<string>")
    out = categorize.categorize_skills(df, "s", DICTS.topics, DICTS.services).first().Skills
    assert out.raw_skills == sorted(skills or [])
    for leaf in CATEGORY_LEAVES:
        assert out.categories[leaf] == leaves.get(leaf, []), leaf
    for leaf in SERVICE_LEAVES:
        assert out.cloud_services[leaf] == leaves.get(leaf, []), leaf


def test_enrichment_of_one_post(spark):
    rows = [
        post(Job_ID="1", Title="iOS Developer", Description="Node. js on AWS, (K8s); Spring  Boot. Amazon Web Services", Location="Roma"),
        post(Job_ID="2", Title="Cook", Description=" \t"),
        post(Job_ID="3", Title=None, Description=None),
    ]
    df = spark.createDataFrame(rows, POST)
    enriched = enrich_posts(df)
    assert enriched.columns == [c for c in POST_FIELDS if c != "Description"] + ["Skills"]
    out = {r.Job_ID: r for r in enriched.collect()}
    assert out["1"].Title == "ios dev" and out["1"].Location == "roma"
    assert out["1"].Skills.raw_skills == ["aws", "kubernetes", "node.js", "spring boot"]
    assert out["1"].Skills.categories.devops_tools == ["kubernetes"]
    assert out["2"].Skills.raw_skills == [] and out["3"].Skills.categories.databases == []
    flat = {r.Job_ID: r for r in extract_flat(df).collect()}
    assert flat["1"].Title == "iOS Developer"
    assert flat["1"].Skills == ["amazon web services", "aws", "k8s", "node js", "spring boot"]
    assert flat["3"].Skills == []
    short = {r.Job_ID: r.Skills for r in extract_flat(df, max_tokens=4).collect()}
    assert short["1"] == ["aws", "node js"]


def test_stop_terms_and_own_dictionaries(spark):
    dicts = Dictionaries({}, {"foo": "bar baz"}, {"databases": ["bar baz"]}, {}, frozenset({"bar"}))
    df = spark.createDataFrame([post(Job_ID="1", Title="x", Description="Foo, bar  baz bar")], POST)
    skills = enrich_posts(df, dicts).first().Skills
    assert skills.raw_skills == ["bar baz"] and skills.categories.databases == ["bar baz"]


@pytest.mark.parametrize(
    "tokens, expected",
    [
        (["spring", "boot"], "spring boot"),
        (["kube", "##rnetes"], "kubernetes"),
        (["##sql"], "##sql"),
        (["node", ".", "js"], "node . js"),
        ([" "], ""),
    ],
)
def test_span_text(spark, tokens, expected):
    assert one(spark, span_text(F.array(*[F.lit(t) for t in tokens]))) == expected


def test_span_text_clean_up(spark):
    assert one(spark, span_text(F.array(F.lit("node"), F.lit("."), F.lit("js")), clean_up=True)) == "node. js"


def test_blankness(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t\n",), (" ",), ("a",)], "Description string")
    flags = [(r.is_empty, r.is_blank) for r in clean.flag_blank(df).collect()]
    assert flags == [(True, True), (True, True), (False, True), (False, True), (False, False)]
    assert one(spark, text.strip("v"), v=" \t a \n") == "a"


def test_text_helpers(spark):
    assert one(spark, text.remove_prefix("v", "##"), v="####k8s") == "##k8s"
    assert one(spark, text.remove_prefix("v", "##"), v="a##") == "a##"
    assert one(spark, text.urn_part("v"), v="urn:x:job:42") == "42"
    assert one(spark, text.urn_part("v"), v="urn:x") == ""
    assert str(one(spark, text.parsed_date("v"), v="2024-02-29")) == "2024-02-29"
    assert one(spark, text.parsed_date("v"), v="2023-02-29") is None
    assert one(spark, text.parsed_date("v"), v="2024-2-9") is None


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://a.b/s?keywords=Data+Analyst&start=0", "https://a.b/s?keywords=Data+Analyst&start=25"),
        ("https://a.b/s?start=0&x=1#f", "https://a.b/s?start=25&x=1#f"),
        ("https://a.b/s", "https://a.b/s?start=25"),
        ("https://a.b/s?e=&x=%20y&start=1&start=2", "https://a.b/s?x=+y&start=25"),
    ],
)
def test_set_query_param(spark, url, expected):
    assert one(spark, text.set_query_param("u", "start", 25), u=url) == expected


def test_array_helpers(spark):
    assert one(spark, arrays.argmax(F.array(F.lit(0.1), F.lit(0.7), F.lit(0.7)))) == 1
    assert one(spark, arrays.pad_to(F.array(F.lit(1)), F.lit(3), 9)) == [1, 9, 9]
    assert one(spark, arrays.pad_to(F.array(F.lit(1), F.lit(2)), F.lit(1), 9)) == [1, 2]
    assert one(spark, arrays.label_id("v"), v="I-SKILL") == 2
    assert one(spark, arrays.label_id("v"), v="x") is None
    assert one(spark, arrays.id_label("v"), v=1) == "B-SKILL"


def test_html_absent_and_blank(spark):
    page = "<ul><li>none</li></ul><ul><li><span>A</span></li><li><span> </span></li></ul>"
    assert one(spark, html.html_nth_item("h", 1), h=page) == "A"
    assert one(spark, html.html_nth_item("h", 2), h=page) is None
    assert one(spark, html.html_nth_item("h", 3), h=page) == ""
    assert one(spark, html.html_attr("h", "time", "datetime"), h="<time title='x'>") is None
    assert one(spark, html.html_attr("h", "time", "datetime"), h="<time datetime='x'>") == "x"
    assert one(spark, html.html_attr("h", "time", "datetime"), h='<p><time a="b" datetime="2024-01-02">') == "2024-01-02"
    assert one(spark, html.html_attr("h", "time", "datetime"), h="<p>") == ""


def test_html_nested_block(spark):
    page = 'x<div class="show-more-less-html__markup y">a<div>b<div>c</div></div> d<br/>e</div><div>f</div>'
    assert one(spark, html.html_block_text("h"), h=page) == "abc de"
    assert one(spark, html.html_block_text("h"), h="<div>a</div>") == ""
    unclosed = '<div class="show-more-less-html__markup">a<div>b</div>'
    assert one(spark, html.html_block_text("h"), h=unclosed) == "ab"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("a &amp; b", "a & b"),
        ("&amp;lt;", "&lt;"),
        ("&#233;&#x20AC;&copy;", "é€©"),
        ("&#99999999; &nope; & &#xD800;", "&#99999999; &nope; & &#xD800;"),
        ("&#128512;", "\U0001f600"),
        ("plain", "plain"),
    ],
)
def test_unescape(spark, raw, expected):
    assert one(spark, html.unescape("v"), v=raw) == expected


def test_category_facets_and_dates(spark):
    rows = [
        post(Job_ID="1", Title="a", Description="s3 python", Pubblication_date="2024-01-15", Industry_type="X"),
        post(Job_ID="2", Title="a", Description="python", Pubblication_date="2024-01-20", Industry_type="Y"),
        post(Job_ID="3", Title="b", Description="go", Pubblication_date="bad", Industry_type="X"),
    ]
    df = enrich_posts(spark.createDataFrame(rows, POST))
    assert [tuple(r) for r in insights.top_skills(df, 2).collect()] == [("python", 2), ("go", 1)]
    assert {(str(r.period), r.posts) for r in insights.posts_over_time(df).collect()} == {("2024-01-01", 2), ("None", 1)}
    assert {r.Job_ID for r in insights.facet(df, {"Industry_type": "x", "Skills.raw_skills": "s3"}).collect()} == {"1"}
    by_title = {(r.Title, r.skill, r["rank"]) for r in insights.skills_by(df, "Title", 1).collect()}
    assert by_title == {("a", "python", 1), ("b", "go", 1)}
    counts = {(r.kind, r.group, r.term): r.posts for r in insights.category_counts(df).collect()}
    assert counts[("category", "cloud_providers", "aws")] == 1
    assert counts[("category", "programming_languages", "python")] == 2


def test_audit(spark):
    aliases = dicts_io.alias_frame(spark, {"a": "b", "b": "c", "x": "y"})
    taxonomy = dicts_io.taxonomy_frame(spark, {"g1": ["a", "c", "y"], "g2": ["c"]})
    out = {tuple(r) for r in normalize.dictionary_audit(aliases, taxonomy).collect()}
    assert out == {
        ("unreachable", "a", "b"),
        ("alias_chain", "a", "c"),
        ("multi_group", "c", "g1,g2"),
        ("uncategorised", "b", ""),
    }


def test_label_tokens_drop_marks_in_text(spark):
    df = spark.createDataFrame([(1, "a\u0001java\u0002 b")], "d int, t string")
    rows = extract.label_tokens(df, "d", "t", ["java"]).orderBy("pos").collect()
    assert [(r.token, r.label) for r in rows] == [("a", "O"), ("java", "B-SKILL"), ("b", "O")]


def test_padding_and_encoding(spark):
    rows = [(1, "train", ["a", "b", "zz"], ["B-SKILL", "I-SKILL", "O"]), (2, "train", ["b"], ["O"]), (3, "val", [], [])]
    df = spark.createDataFrame(rows, "doc int, split string, tokens array<string>, labels array<string>")
    vocab = spark.createDataFrame([("a", 7), ("b", 8)], "token string, id int")
    encoded = training.encode_sequences(df, vocab, keep=["split"])
    joined = training.encode_sequences(df, vocab, keep=["split"], literal_words=1)
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, encoded.collect()))
    padded = {r.doc: r for r in training.pad_sequences(encoded).collect()}
    assert padded[1].input_ids == [101, 7, 8, 100, 102] and padded[1].labels == [-100, 1, 2, 0, -100]
    assert padded[2].input_ids == [101, 8, 102, 0, 0]
    assert padded[2].attention_mask == [1, 1, 1, 0, 0]
    assert padded[2].labels == [-100, 0, -100, -100, -100]
    assert padded[3].input_ids == [101, 102] and padded[3].attention_mask == [1, 1]


def test_sequences_order_and_unknown_labels(spark):
    tokens = [(2, "c", "O"), (0, "a", "B-SKILL"), (1, "b", "?"), (1, "b2", "O")]
    df = spark.createDataFrame(
        [("x", tokens), ("y", [])], "doc string, tokens array<struct<position:int,text:string,label:string>>"
    )
    seqs = training.to_sequences(df)
    assert [r.tokens for r in seqs.collect()] == [["a", "b", "b2", "c"]]
    good, bad = training.split_unknown_labels(seqs)
    assert good.count() == 0 and bad.count() == 1


@pytest.mark.parametrize("n", [1, 2, 5, 11, 200])
def test_split_has_exact_size(spark, n):
    out = training.split_train_val(spark.range(n).withColumnRenamed("id", "doc"), seed=3)
    counts = {r.split: r.n for r in training.split_report(out).collect()}
    assert counts.get("val", 0) == -(-n // 5) and sum(counts.values()) == n


def test_span_score(spark):
    rows = [
        ("d1", 0, "B-SKILL", "B-SKILL"), ("d1", 1, "I-SKILL", "I-SKILL"), ("d1", 2, "O", "O"),
        ("d1", 3, "B-SKILL", "O"), ("d1", 4, "O", "B-SKILL"),
    ]
    df = spark.createDataFrame(rows, "doc string, pos int, gold string, pred string")
    score = training.span_prf(df).first()
    assert (score.precision, score.recall, score.f1) == (0.5, 0.5, 0.5)
    nothing = training.span_prf(df.withColumn("pred", F.lit("O"))).first()
    assert (nothing.precision, nothing.recall, nothing.f1) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("mode", ["conll", "strict"])
def test_span_score_within_rows(spark, mode):
    """The array form agrees with the form of one row per token, also over ignored and unknown ids."""
    import random

    random.seed(4)
    rows = [
        (d, [random.choice([0, 1, 2, 2, -100, 7]) for _ in range(n)], [random.choice([0, 1, 2, 2, None]) for _ in range(n)])
        for d, n in enumerate([0, 1, 1, 2, 2, 3, 5, 40, 300])
    ] + [(99, None, None)]
    df = spark.createDataFrame(rows, "doc int, labels array<int>, pred_ids array<int>")
    assert training.sequence_prf(df, mode=mode).first() == training.span_prf(training.aligned_labels(df), mode=mode).first()


def test_lookup_in_a_large_map(spark):
    entries = {f"k{i}": f"v{i}" for i in range(3000)} | {"é'": "x", "": "empty"}
    df = spark.createDataFrame([("k7",), ("k2999",), ("é'",), ("",), ("no",), (None,)], "k string")
    assert [r[0] for r in df.select(arrays.lookup(entries, "k")).collect()] == ["v7", "v2999", "x", "empty", None, None]
    assert one(spark, arrays.lookup({}, F.lit("k"))) is None


def test_terms_with_quotes_and_extra_providers(spark):
    df = spark.createDataFrame([(["o'x", "a\\b", "p1"],)], "s array<string>")
    out = categorize.categorize_skills(df, "s", {"databases": ["o'x", "a\\b"]}, {"aws": [], "other": ["p1"]}).first().Skills
    assert out.categories.databases == ["a\\b", "o'x"]
    assert out.categories.cloud_providers == ["other"] and out.cloud_services.aws == []
