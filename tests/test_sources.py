"""File sources and sinks on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from jobsieve.operators import clean, html_records, training
from jobsieve.schemas import DEDUPED_TABLE, POST, POST_FIELDS
from jobsieve.sources import dictionaries as dicts_io
from jobsieve.sources import readers, sinks
from jobsieve.sources.dictionaries import Dictionaries


def test_one_object_or_an_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"Job_ID": "1", "Title": "é", "other": 1}, indent=1), "utf-8")
    (tmp_path / "b.json").write_text(json.dumps([{"Job_ID": "2"}, {"Job_ID": "3"}], indent=1))
    got = {r.Job_ID: r.Title for r in readers.read_posts_json(spark, str(tmp_path)).collect()}
    assert got == {"1": "é", "2": None, "3": None}


def test_labelled_files(spark, tmp_path):
    token = {"position": 0, "text": "a", "label": "O"}
    (tmp_path / "good.json").write_text(json.dumps({"tokens": [token], "x": 1}, indent=2))
    (tmp_path / "empty.json").write_text(json.dumps({"tokens": []}))
    (tmp_path / "none.json").write_text(json.dumps({"y": 1}))
    (tmp_path / "broken.json").write_text('{"tokens": [')
    (tmp_path / "skip.txt").write_text("no")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.json").write_text(json.dumps({"tokens": [token]}))
    good, rejects = readers.read_labelled_tokens(spark, str(tmp_path))
    assert [r.file.rsplit("/", 1)[1] for r in good.collect()] == ["good.json"]
    reasons = {r.file.rsplit("/", 1)[1]: r.reason for r in rejects.collect()}
    assert reasons == {"empty.json": "no tokens", "none.json": "no tokens", "broken.json": "invalid JSON"}
    assert {r.status: r.n for r in training.load_report(good, rejects).collect()} == {"good": 1, "rejected": 3}


def test_dictionaries_from_files(spark, tmp_path):
    defaults = Dictionaries()
    paths = {}
    for name in ("title_aliases", "skill_aliases", "topics", "services"):
        paths[name] = str(tmp_path / f"{name}.json")
        (tmp_path / f"{name}.json").write_text(json.dumps(getattr(defaults, name), indent=2))
    loaded = Dictionaries.load(spark, **paths)
    assert loaded.title_aliases == defaults.title_aliases
    assert loaded.skill_aliases == defaults.skill_aliases
    assert {k: set(v) for k, v in loaded.topics.items()} == {k: set(v) for k, v in defaults.topics.items()}
    assert loaded.lexicon() == defaults.lexicon() and len(loaded.lexicon()) == 462
    assert dicts_io.load_taxonomy(spark, paths["topics"]).count() == 159
    assert dicts_io.load_taxonomy(spark, paths["services"]).count() == 120
    assert dicts_io.load_alias_map(spark, paths["skill_aliases"]).count() == 165
    assert dicts_io.load_alias_map(spark, paths["title_aliases"]).count() == 82


def test_bad_dictionary_raises(spark, tmp_path):
    bad = tmp_path / "bad.json"
    bad.write_text("{")
    with pytest.raises(Exception):
        dicts_io.load_alias_map(spark, str(bad)).collect()
    with pytest.raises(Exception):
        dicts_io.load_alias_map(spark, str(tmp_path / "missing.json")).collect()


def test_oversized_dictionary_is_refused(spark):
    with pytest.raises(ValueError, match="more than"):
        dicts_io.alias_frame(spark, {str(i): "x" for i in range(dicts_io.MAX_LITERAL_ENTRIES + 1)})


def test_json_sink_keeps_nulls_and_text(spark, tmp_path):
    out = str(tmp_path / "out")
    row = tuple({"Job_ID": "1", "Title": "caffè"}.get(f) for f in POST_FIELDS)
    sinks.write_posts_json(spark.createDataFrame([row], POST), out)
    line = spark.read.text(out).first().value
    assert "caffè" in line and json.loads(line)["Location"] is None


def test_payload_round_trip(spark):
    df = spark.createDataFrame([("1", None), ("2", 'q"é\n')], "Job_ID string, Title string")
    payload = sinks.to_payload(df, key="Job_ID")
    assert payload.columns == ["key", "value"]
    assert sorted(map(str, clean.decode_payload(payload, df.schema).collect())) == sorted(map(str, df.collect()))


def test_ensure_table_twice(spark, tmp_path):
    for _ in range(2):
        table = sinks.ensure_table(spark, "t_posts", DEDUPED_TABLE, str(tmp_path / "t"))
    assert table.schema["Pubblication_date"].dataType.typeName() == "date"
    spark.sql("DROP TABLE t_posts")


def test_spread(spark):
    assert readers.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 8
    assert readers.spread(spark.range(0, 10, 1, 16)).rdd.getNumPartitions() == 16


def test_wrapped_and_nested_cards(spark):
    page = """<div class="base-card">outside</div><ul><li><section><div class='a base-card' data-entity-urn="urn:a:b:1">
      <ul><li>x</li></ul><a><span>One</span></a></div></section></li>
      <LI><DIV CLASS="base-card">two<div>in</div></DIV>after</LI><li><div class="base-card--x">no</div></li></ul>"""
    frame = spark.createDataFrame([(1, page), (2, ""), (3, None)], "page_id int, html string")
    cards = html_records.explode_cards(frame)
    got = [(r.card_no, r.card) for r in cards.orderBy("card_no").collect()]
    assert [n for n, _ in got] == [0, 1]
    assert got[0][1].startswith("<div class='a base-card'") and got[0][1].endswith("</a></div>")
    assert got[1][1] == '<DIV CLASS="base-card">two<div>in</div></div>'
    assert [(r.Job_ID, r.Title) for r in html_records.card_fields(cards).orderBy("card_no").collect()][0] == ("1", "One")


def test_posts_from_pages(spark):
    listing = """<ul><li><div class="base-card x" data-entity-urn="urn:a:b:77"><a><span>
      Data Engineer </span></a><h4><a> ACME &amp; Co</a></h4><span class="job-search-card__location">Rome</span>
      <time class="t" datetime="2024-05-01">now</time></div></li>
      <li><div class="base-card" data-entity-urn="urn:a:b:78"><a>no span</a></div></li></ul>"""
    detail = """<div class="show-more-less-html__markup">Needs <b>Python</b><ul><li>SQL</li></ul></div>
      <ul><li><span>Senior</span></li><li><span>Full-time</span></li></ul>"""
    cards = html_records.explode_cards(spark.createDataFrame([(1, listing)], "page_id int, html string"))
    details = spark.createDataFrame([("77", detail)], "Job_ID string, html string")
    posts = {r.Job_ID: r for r in html_records.build_posts(cards, details).collect()}
    assert posts["77"].Title == "Data Engineer" and posts["77"].Company_name == "ACME & Co"
    assert posts["77"].Pubblication_date == "2024-05-01"
    assert posts["77"].Seniority_level == "Senior" and posts["77"].Job_Function == ""
    assert posts["78"].Title == "" and posts["78"].Description is None


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-31",), ("2024-13-01",), ("x",), (None,), ("",)], "Pubblication_date string")
    good, bad = clean.validate_dates(df)
    assert sorted(str(r[0]) for r in good.collect()) == ["2024-01-31", "None"]
    assert sorted(r[0] for r in bad.select(F.col("Pubblication_date")).collect()) == ["", "2024-13-01", "x"]


def test_json_lines_keep_every_post(spark, tmp_path):
    from jobsieve.schemas import POST
    from jobsieve.sources.readers import read_posts_json
    from jobsieve.sources.sinks import write_posts_json

    posts = spark.createDataFrame([[str(i)] * len(POST) for i in range(10)], POST)
    write_posts_json(posts.coalesce(1), str(tmp_path / "p"))
    assert read_posts_json(spark, str(tmp_path / "p"), lines=True).count() == 10
    (tmp_path / "a.json").write_text('[{"Job_ID": "1"}, {"Job_ID": "2"}]\n{"Job_ID": "3"}\n\n')
    assert {r.Job_ID for r in read_posts_json(spark, str(tmp_path / "a.json"), lines=True).collect()} == {"1", "2", "3"}


def test_html_and_url_faults(spark):
    from pyspark.sql import functions as F

    from jobsieve.functions import html, text

    def value(column, s):
        return spark.createDataFrame([(s,)], "c string").select(column.alias("v")).first().v

    assert value(html.text_of("c"), "5 < 6 years and 7 > 3 <b>x</b>&#x000020AC;") == "5 < 6 years and 7 > 3 x€"
    assert value(html.html_attr("c", "time", "datetime"), "<TIME data-datetime='a' DateTime='b'>") == "b"
    assert value(html.html_attr("c", "a", "href"), "<a class=k href=/x>") == "/x"
    assert value(text.set_query_param("c", "z", F.lit("1")), "http://h/?a=1&b=2&a=3") == "http://h/?a=1&a=3&b=2&z=1"


def test_any_split_is_padded(spark):
    from jobsieve.operators.training import pad_sequences

    df = spark.createDataFrame(
        [("test", [1], [1], [1]), ("test", [1, 2], [1, 1], [1, 1]), (None, [1], [1], [1])],
        "split string, input_ids array<int>, attention_mask array<int>, labels array<int>",
    )
    assert sorted(len(r.input_ids) for r in pad_sequences(df).collect()) == [1, 2, 2]
