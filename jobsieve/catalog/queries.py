"""One runnable query per operator over the given tables: name -> f(spark, sf_dir)."""

import json
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import functions as F

from ..functions import arrays, html, text
from ..functions.tokens import decode_tagged, lexicon_pattern, span_text, tagged_tokens, tokens
from ..operators import categorize, clean, dedupe, extract, html_records, insights, normalize, training
from ..plans.enrich import enrich_posts, extract_flat
from ..schemas import CATEGORY_LEAVES, DEDUPED_TABLE, POST, POST_FIELDS, SERVICE_LEAVES
from ..session import scratch_dir
from ..sources import dictionaries as dicts_io
from ..sources import readers, sinks
from ..sources.dictionaries import Dictionaries
from ..sources.key_index import KeyIndex
from ..streaming import jobs
from ..streaming.arrivals import first_arrivals_stream
from . import inputs

QUERIES = {}
DICTS = Dictionaries()


def query(f):
    QUERIES[f.__name__] = f
    return f


def staged(df, name):
    """Write a derived input to the shared scratch folder and return its path."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def joined(column):
    return F.array_join(column, "|")


def flat_enriched(df, key="arrival"):
    """Enriched posts with every array as text."""
    leaves = [joined(f"Skills.categories.{c}").alias(f"cat_{c}") for c in CATEGORY_LEAVES]
    leaves += [joined(f"Skills.cloud_services.{c}").alias(f"svc_{c}") for c in SERVICE_LEAVES]
    kept = [c for c in df.columns if c != "Skills"]
    return df.select(*kept, joined("Skills.raw_skills").alias("raw_skills"), *leaves)


def enriched(spark, sf):
    return enrich_posts(inputs.posts(spark, sf), DICTS, key="arrival")


def found_skills(spark, sf):
    """Posts with their mentions as an array."""
    return extract.extract_skills(inputs.posts(spark, sf), "arrival", "Description", DICTS.lexicon())


def exploded_skills(spark, sf):
    rows = found_skills(spark, sf).select("arrival", F.explode_outer("skills").alias("skill"))
    return rows.filter("skill IS NOT NULL")


# --- sources and sinks ---------------------------------------------------------------------


@query
def s1_payload_stream(spark, sf):
    path = staged(inputs.payloads(spark, sf).select("value"), "payloads")
    stream = readers.read_posts_stream(spark, path, fmt="parquet")
    out = scratch_dir(spark, "decoded")
    jobs.start(
        clean.decode_payload(stream), jobs.upsert_sink(out), scratch_dir(spark, "progress"), available_now=True
    ).awaitTermination()
    return sinks.read_versions(spark, out, POST).select(*POST_FIELDS)


@query
def s2_decode_payload(spark, sf):
    p = inputs.payloads(spark, sf)
    return p.select("arrival", F.from_json(F.col("value").cast("string"), POST).alias("data")).select(
        "arrival", "data.*"
    )


@query
def s2_quarantine(spark, sf):
    good, bad = clean.split_quarantine(clean.decode_payload(inputs.payloads(spark, sf)))
    return training.load_report(good, bad)


@query
def s3_landing_stream(spark, sf):
    landing = scratch_dir(spark, "landing")
    sinks.write_posts_json(inputs.posts(spark, sf), landing)
    stream = clean.require_non_empty(readers.read_landing_stream(spark, landing))
    out = scratch_dir(spark, "landed")
    jobs.start(stream, jobs.upsert_sink(out), scratch_dir(spark, "progress"), available_now=True).awaitTermination()
    return sinks.read_versions(spark, out, POST).select(*POST_FIELDS)


@query
def s4_posts_json(spark, sf):
    """Files of many documents, each an array of two posts or a single post, read back as posts."""
    pairs = (
        inputs.posts(spark, sf)
        .groupBy(F.floor(F.col("arrival") / 2).alias("d"))
        .agg(F.collect_list(F.struct(*POST_FIELDS)).alias("p"))
    )
    single = F.transform("p", lambda x: F.to_json(x))
    docs = pairs.select(F.explode(F.when(F.col("d") % 2 == 0, F.array(F.to_json("p"))).otherwise(single)).alias("value"))
    path = scratch_dir(spark, "arrays")
    docs.write.text(path)
    return readers.read_posts_json(spark, path)


@query
def s4_malformed_documents(spark, sf):
    """Every tenth line is no JSON: it comes back as it was, and takes no other line with it."""
    post = F.to_json(F.struct(*POST_FIELDS))
    broken = F.concat(F.lit("broken "), F.col("arrival").cast("string"))
    path = scratch_dir(spark, "mixed")
    inputs.posts(spark, sf).select(F.when(F.col("arrival") % 10 == 0, broken).otherwise(post).alias("value")).write.text(path)
    return readers.read_posts_json(spark, path, raw="raw").select("Job_ID", "Title", "raw")


@query
def s4_json_lines(spark, sf):
    """All posts through the engine's own JSON-lines sink and back."""
    path = scratch_dir(spark, "lines")
    sinks.write_posts_json(inputs.posts(spark, sf).select(*POST_FIELDS), path)
    return readers.read_posts_json(spark, path, lines=True)


@query
def s5_labelled_files(spark, sf):
    """One file per document; every 25th is cut short and every 40th has no tokens."""
    docs = inputs.labelled_docs(spark, sf)
    d = F.col("doc")
    body = F.to_json(F.struct("doc", F.when(d % 40 != 3, F.col("tokens")).otherwise(F.array()).alias("tokens")))
    body = F.when(d % 25 == 1, F.substr(body, F.lit(1), F.length(body) - 2)).otherwise(body)
    path = scratch_dir(spark, "labelled")
    sinks.write_files(docs.select("doc", body.alias("value")), path, "doc", "value", suffix=".txt.gz")
    good, rejects = readers.read_labelled_tokens(spark, f"{path}/*", glob="*.txt.gz")
    doc = F.regexp_extract("file", r"doc=(\d+)", 1).cast("bigint").alias("doc")
    return good.select(doc, F.lit("good").alias("status"), F.size("tokens").alias("n_tokens")).unionByName(
        rejects.select(doc, F.col("reason").alias("status"), F.lit(0).alias("n_tokens"))
    )


def _dictionary_file(spark, content, name):
    path = scratch_dir(spark, name)
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps(content)).alias("value")).write.text(path)
    return path


@query
def s6_alias_map_usage(spark, sf):
    """The title map read from its file, with the posts that use each alias."""
    aliases = dicts_io.load_alias_map(spark, _dictionary_file(spark, DICTS.title_aliases, "aliases"))
    used = inputs.posts(spark, sf).groupBy(F.lower("Title").alias("alias")).agg(F.count("*").alias("posts"))
    return aliases.join(used, "alias", "left").select(
        "alias", "canonical", F.coalesce("posts", F.lit(0)).alias("posts")
    )


@query
def s7_taxonomy_usage(spark, sf):
    """The topics read from their file, with the posts that name each term."""
    taxonomy = dicts_io.load_taxonomy(spark, _dictionary_file(spark, DICTS.topics, "topics"))
    used = exploded_skills(spark, sf).groupBy(F.col("skill").alias("term")).agg(F.count("*").alias("posts"))
    return taxonomy.join(used, "term", "left").select(
        "group", "term", F.coalesce("posts", F.lit(0)).alias("posts")
    )


def _old_and_new(spark, sf):
    """First scrapes as the table, full posts as the new rows; keyed by document, some by a key of their own."""
    a, doc = F.col("arrival"), F.floor(F.col("arrival") / 2).cast("string")
    only = F.when(a % 10 == 0, "old-").when(a % 14 == 1, "new-").otherwise("")
    p = inputs.posts(spark, sf).withColumn("Job_ID", F.concat(only, doc))
    p = p.withColumn("Location", F.when(a % 6 != 5, F.col("Location")))
    return p.filter("arrival % 2 = 0"), p.filter("arrival % 2 = 1")


@query
def s8_upsert_merge(spark, sf):
    old, new = _old_and_new(spark, sf)
    merged = sinks.upsert(old, new)
    return merged.select("Job_ID", "arrival", "Title", "Location", "Pubblication_date", "Description")


@query
def s8_upsert_stream(spark, sf):
    """The same upsert through two streamed versions of a keyed table."""
    old, new = _old_and_new(spark, sf)
    source = scratch_dir(spark, "updates")
    out, progress = scratch_dir(spark, "keyed"), scratch_dir(spark, "progress")
    schema = old.schema
    for part in (old, new):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        jobs.start(stream, jobs.upsert_sink(out), progress, available_now=True).awaitTermination()
    state = sinks.merge_by_key(sinks.read_versions(spark, out, schema))
    return state.select("Job_ID", "arrival", "Title", "Location", "Pubblication_date", "Description")


@query
def s9_overwrite_by_key(spark, sf):
    old, new = _old_and_new(spark, sf)
    return dedupe.overwrite_by_key(new, old).select("Job_ID", "arrival", "Title", "Location", "Description")


@query
def s9_overwrite_last_wins(spark, sf):
    """Several new rows of a key: the last one that arrived stays."""
    table, posts = _table_and_batch(spark, sf)
    new = posts.filter("Company_name <> 'Company 3'")
    state = dedupe.overwrite_by_key(new, table, order="arrival")
    return state.select("Job_ID", "arrival", "Title", "Description")


@query
def s10_payload_round_trip(spark, sf):
    p = inputs.posts(spark, sf).select(*POST_FIELDS)
    return clean.decode_payload(sinks.to_payload(p, key="Job_ID"))


@query
def s10_topic_folder(spark, sf):
    folder = scratch_dir(spark, "topic")
    sinks.write_topic(inputs.posts(spark, sf).select(*POST_FIELDS), folder, fmt="text")
    return clean.decode_payload(spark.read.text(folder))


@query
def s11_fan_out(spark, sf):
    """One stream stored as a table and forwarded as payloads; both are read back."""
    p = inputs.posts(spark, sf).select("arrival", *POST_FIELDS)
    path = staged(p, "posts")
    table, topic = scratch_dir(spark, "table"), scratch_dir(spark, "topic")
    both = jobs.fan_out([jobs.upsert_sink(table), jobs.payload_version_sink(topic)])
    stream = clean.require_non_empty(spark.readStream.schema(p.schema).parquet(path))
    jobs.start(stream, both, scratch_dir(spark, "progress"), available_now=True).awaitTermination()
    stored = sinks.read_versions(spark, table, p.schema).select(F.lit("table").alias("sink"), "arrival", "Description")
    sent = clean.decode_payload(spark.read.text(topic, recursiveFileLookup=True).select("value"), p.schema)
    return stored.unionByName(sent.select(F.lit("topic").alias("sink"), "arrival", "Description"))


@query
def s12_posts_json_sink(spark, sf):
    path = scratch_dir(spark, "flat")
    sinks.write_posts_json(extract_flat(inputs.posts(spark, sf), DICTS, key="arrival"), path)
    back = spark.read.schema("arrival bigint, Job_ID string, Title string, Skills array<string>").json(path)
    return back.select("arrival", "Job_ID", "Title", joined("Skills").alias("skills"))


@query
def s13_ensure_table(spark, sf):
    """A table created when absent, kept when present, and filled with dated posts."""
    location = scratch_dir(spark, "store")
    name = "posts_" + location.rsplit("-", 1)[1]
    for _ in range(2):
        table = sinks.ensure_table(spark, name, DEDUPED_TABLE, location)
    good, _ = clean.validate_dates(dedupe.dedupe_first(inputs.posts(spark, sf)))
    good.select(*table.columns).write.insertInto(name)
    return spark.table(name).select("Job_ID", "Title", F.col("Pubblication_date").cast("string"))


@query
def s14_validate_dates(spark, sf):
    good, bad = clean.validate_dates(inputs.posts(spark, sf))
    return good.select("arrival", F.lit("good").alias("status"), F.col("Pubblication_date").cast("string")).unionByName(
        bad.select("arrival", F.lit("quarantine").alias("status"), "Pubblication_date")
    )


@query
def s15_resume(spark, sf):
    """A restarted job continues: the second start finds nothing new, the third one more file."""
    p = inputs.posts(spark, sf).select("arrival", "Job_ID")
    source, out, progress = (scratch_dir(spark, n) for n in ("source", "out", "progress"))
    for part in ("arrival % 2 = 0", None, "arrival % 2 = 1"):
        if part:
            p.filter(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(p.schema).parquet(source)
        jobs.start(stream, jobs.upsert_sink(out), progress, available_now=True).awaitTermination()
    return sinks.read_versions(spark, out, p.schema).groupBy("run", "batch").agg(F.count("*").alias("posts"))


# --- HTML records ----------------------------------------------------------------------------


@query
def h1_explode_cards(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    links = html_records.explode_cards(pages, "html", r'(?s)<li>(<a href="[^"]*">.*?</a>)</li>')
    return links.select("page_id", "card_no", "card")


@query
def h2_html_text(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return pages.select(
        "page_id",
        html.html_text("html", r"(?s)<h1[^>]*>(.*?)</h1>").alias("h1"),
        html.html_text("html", r"(?s)<h2[^>]*>(.*?)</h2>").alias("h2"),
        html.html_text("html", r"(?s)<style>p(.*?)\{margin").alias("blank"),
    )


@query
def h3_html_attr(spark, sf):
    return inputs.table(spark, sf, "pages").select(
        "page_id",
        html.html_attr("html", "a", "href").alias("href"),
        html.html_attr("html", "time", "datetime").alias("datetime"),
        html.html_attr("html", "a", "title").alias("title"),
    )


@query
def h4_urn_part(spark, sf):
    cards = html_records.card_fields(html_records.explode_cards(inputs.listing_pages(spark, sf)))
    return cards.select("page_id", "card_no", "Job_ID", text.urn_part("Job_ID", ":", 4).alias("missing"))


@query
def h5_html_block_text(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return pages.select("page_id", html.html_block_text("html", "<article>", "article").alias("body"))


@query
def h5_nested_block_text(spark, sf):
    return inputs.detail_pages(spark, sf).select("Job_ID", html.html_block_text("html").alias("Description"))


@query
def h6_html_nth_item(spark, sf):
    d = inputs.detail_pages(spark, sf)
    return d.select("Job_ID", *[html.html_nth_item("html", k).alias(f"item_{k}") for k in (1, 2, 3, 4, 5)])


@query
def h7_build_posts(spark, sf):
    cards = html_records.explode_cards(inputs.listing_pages(spark, sf))
    return html_records.build_posts(cards, inputs.detail_pages(spark, sf))


@query
def h8_set_query_param(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return pages.select(
        "page_id",
        text.set_query_param("url", "start", F.col("page_id") * 10).alias("added"),
        text.set_query_param("url", "page", 7).alias("replaced"),
    )


# --- projections and filters -----------------------------------------------------------------


@query
def p1_drop_fields(spark, sf):
    p = inputs.posts(spark, sf).withColumns({"http": F.lit("1.1"), "@version": F.lit("1"), "host": F.col("Location")})
    return clean.drop_fields(p).drop("Description")


@query
def p2_require_non_empty(spark, sf):
    return clean.require_non_empty(inputs.posts(spark, sf)).select("arrival", "Job_ID", "Description")


@query
def p3_lower_columns(spark, sf):
    return clean.lower_columns(inputs.posts(spark, sf)).drop("Description")


@query
def p4_blank_guard(spark, sf):
    return clean.flag_blank(inputs.posts(spark, sf)).select("arrival", "is_empty", "is_blank")


@query
def p5_drop_description(spark, sf):
    """The Description goes, the skills found in it stay."""
    flat = extract_flat(inputs.posts(spark, sf), DICTS, key="arrival")
    return flat.withColumns({"n_skills": F.size("Skills"), "Skills": joined("Skills")})


@query
def p6_expand_struct(spark, sf):
    nested = inputs.posts(spark, sf).select(F.struct("arrival", "Job_ID", "Title").alias("data"))
    return clean.expand_struct(nested, "data")


@query
def p7_non_empty_tokens(spark, sf):
    """Every record has a twin without tokens, which is dropped."""
    docs = inputs.labelled_docs(spark, sf)
    twins = docs.select((-1 - F.col("doc")).alias("doc"), F.slice("tokens", 1, 0).alias("tokens"))
    return training.to_sequences(docs.unionByName(twins)).select("doc", F.size("tokens").alias("n"))


@query
def p8_skip_special_tokens(spark, sf):
    spans = F.transform(decode_tagged("tagged"), lambda s: span_text(s))
    return (
        inputs.bio_arrays(spark, sf)
        .select("doc", spans.alias("spans"))
        .select("doc", F.size("spans").alias("n_spans"), joined("spans").alias("spans"))
    )


# --- lookups ---------------------------------------------------------------------------------


def _table_and_batch(spark, sf):
    """Rows already stored, one per key, some without text; and all posts as the batch."""
    posts = inputs.posts(spark, sf)
    stored = dedupe.first_by_key(posts.filter("Company_name <> 'Company 7'"), "Job_ID", "arrival")
    return stored, posts


@query
def j1_lookup_enrich(spark, sf):
    stored, posts = _table_and_batch(spark, sf)
    out = dedupe.lookup_enrich(posts, stored, "Job_ID", {"Description": "old_description", "arrival": "old_arrival"})
    return out.select("arrival", "Job_ID", F.col("old_arrival").cast("string"), "old_description")


@query
def j2_reject_known(spark, sf):
    stored, posts = _table_and_batch(spark, sf)
    return dedupe.reject_known(posts, stored).select("arrival", "Job_ID", "Description")


@query
def j2_known_keys_indexed(spark, sf):
    """The same lookup through an index of hash buckets, of which only those of the batch are read."""
    stored, posts = _table_and_batch(spark, sf)
    index = KeyIndex(spark, scratch_dir(spark, "keys"), keys_per_bucket=500)
    keys = clean.require_non_empty(stored, "Description").select("Job_ID", F.lit(0).alias("run"), F.lit(0).alias("batch"))
    index.rebuild(keys)
    return index.reject_known(posts).select("arrival", "Job_ID", "Description")


@query
def j3_normalize_title(spark, sf):
    aliases = dicts_io.alias_frame(spark, DICTS.title_aliases)
    lowered = clean.lower_columns(inputs.posts(spark, sf), ["Title"])
    return normalize.normalize_by_map(lowered, "Title", aliases).select("arrival", "Title")


@query
def j4_normalize_skills(spark, sf):
    out = normalize.normalize_array_by_map(found_skills(spark, sf), "skills", DICTS.skill_aliases)
    return out.select("arrival", joined("skills").alias("skills"))


@query
def j4_normalize_skills_join(spark, sf):
    aliases = dicts_io.alias_frame(spark, DICTS.skill_aliases)
    out = normalize.normalize_array_by_map(found_skills(spark, sf), "skills", aliases, key="arrival")
    return out.select("arrival", joined("skills").alias("skills"))


@query
def j5_match_taxonomy(spark, sf):
    matched = categorize.match_taxonomy(exploded_skills(spark, sf), dicts_io.taxonomy_frame(spark, DICTS.topics))
    return matched.select("arrival", "skill", "group")


# --- extraction ------------------------------------------------------------------------------


@query
def x0_tokenize(spark, sf):
    return inputs.posts(spark, sf).select("arrival", F.array_join(tokens("Description"), " ").alias("tokens"))


# Stored bytes of text per task where a row per token is sorted before the first shuffle, as for the largest of texts:
# rows take about thirty times as much, and a sort that outgrows its memory spills all of them.
SORTED_TEXT = 16 << 20


@query
def x1_label_tokens(spark, sf):
    labelled = extract.label_tokens(inputs.posts(spark, sf, SORTED_TEXT), "arrival", "Description", DICTS.lexicon())
    return labelled.groupBy("arrival", "label").agg(
        F.count("*").alias("n"), F.sum("pos").alias("pos_sum"), F.max("token").alias("last_token")
    )


@query
def x1_labelled_mentions(spark, sf):
    labelled = extract.label_tokens(inputs.posts(spark, sf), "arrival", "Description", DICTS.lexicon())
    return labelled.filter("label <> 'O'")


@query
def x1_lexicon_hits(spark, sf):
    lexicon = spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(t) for t in DICTS.lexicon()])).alias("term"))
    return extract.lexicon_hits(inputs.posts(spark, sf), "arrival", "Description", lexicon)


@query
def x2_custom_labeler(spark, sf):
    """A labeller of the user's own: a vectorised function over batches of texts."""
    out = extract.extract_skills(
        inputs.posts(spark, sf), "Job_ID", "Description", labeler=_length_labeler
    )
    return out.select("arrival", joined("skills").alias("skills"))


def _length_label(word):
    return "B-SKILL" if len(word) >= 15 else "I-SKILL" if len(word) >= 12 else "O"


def _length_labels(texts: pa.Array) -> pa.Array:
    """Batches hold thousands of texts: only a few at a time become Python objects, and labels leave as Arrow columns."""

    def part(some):
        words = [(t or "").split() for t in some]
        flat = [w for ws in words for w in ws]
        labels = pa.array(map(_length_label, flat), pa.string())
        pairs = pa.StructArray.from_arrays([pa.array(flat, pa.string()), labels], ["token", "label"])
        return pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, words))], pa.int32()), pairs)

    return pa.concat_arrays([part(texts.slice(k, 100).to_pylist()) for k in range(0, max(len(texts), 1), 100)])


def _length_labeler(text):
    """Stands for a model: words of 15 letters or more open a span, 12 to 14 continue it."""
    return F.arrow_udf(_length_labels, "array<struct<token:string,label:string>>")(text)


@query
def x3_truncate_tokens(spark, sf):
    rows = extract.tokenize(inputs.posts(spark, sf, SORTED_TEXT), "arrival", "Description")
    kept = extract.truncate_tokens(rows, 512)
    return kept.groupBy("arrival").agg(F.count("*").alias("n"), F.max_by("token", "pos").alias("last_token"))


def _spans(spark, sf, mode):
    spans = extract.decode_bio(inputs.bio_rows(spark, sf, SORTED_TEXT), mode=mode)
    return spans.select(
        "doc", F.col("start").alias("first_pos"), F.col("end").alias("last_pos"), F.array_join("tokens", " ").alias("tokens")
    )


@query
def w1_decode_bio(spark, sf):
    return _spans(spark, sf, "strict")


@query
def w1_decode_bio_conll(spark, sf):
    return _spans(spark, sf, "conll")


@query
def w2_span_text(spark, sf):
    spans = extract.span_texts(extract.decode_bio(inputs.bio_rows(spark, sf, SORTED_TEXT)))
    return spans.select("doc", F.col("start").alias("first_pos"), "span")


@query
def e1_enrich_posts(spark, sf):
    return flat_enriched(enriched(spark, sf))


def _lexicon_table(spark):
    return spark.range(0, 1, 1, 1).select(F.explode(F.array(*[F.lit(t) for t in DICTS.lexicon()])).alias("term"))


@query
def x1_lexicon_mentions(spark, sf):
    """Mentions without overlap, found by joins with a lexicon table."""
    posts = inputs.posts(spark, sf)
    found = extract.lexicon_mentions(posts, "arrival", "Description", _lexicon_table(spark))
    return found.select("arrival", "pos", "n", "term")


@query
def x1_spelled_lexicon(spark, sf):
    """Terms that tokenising changes are found by what it leaves of them, and come back as they were given."""
    p = inputs.posts(spark, sf)
    spelled = ["Amazon (web) services", "node. js", "oracle, cloud!", "java", "c (or) cpp", ". net"]
    return extract.extract_skills(p, "arrival", "Description", spelled).select("arrival", joined("skills").alias("skills"))


@query
def e1_enrich_lexicon_table(spark, sf):
    """The whole enrichment with its lexicon as a table."""
    return flat_enriched(enrich_posts(inputs.posts(spark, sf), DICTS, key="arrival", lexicon=_lexicon_table(spark)))


@query
def e2_extract_flat(spark, sf):
    flat = extract_flat(inputs.posts(spark, sf), DICTS, key="arrival")
    return flat.withColumn("Skills", joined("Skills"))


# --- aggregates ------------------------------------------------------------------------------


@query
def a1_dedupe_first(spark, sf):
    return dedupe.dedupe_first(inputs.posts(spark, sf))


@query
def a2_distinct_skills(spark, sf):
    mentions = extract.span_texts(
        extract.decode_bio(
            extract.label_tokens(inputs.posts(spark, sf, SORTED_TEXT), "arrival", "Description", DICTS.lexicon()), "arrival"
        )
    )
    sets = categorize.distinct_skills(mentions, "arrival", "span")
    return sets.select("arrival", joined("skills").alias("skills"))


@query
def a3_categorize_skills(spark, sf):
    skills = found_skills(spark, sf).withColumn("skills", F.transform("skills", F.initcap))
    out = categorize.categorize_skills(skills, "skills", DICTS.topics, DICTS.services)
    return flat_enriched(out.select("arrival", "Skills"))


@query
def a3_categorize_relational(spark, sf):
    skills = exploded_skills(spark, sf)
    topics = categorize.match_taxonomy(skills, dicts_io.taxonomy_frame(spark, DICTS.topics))
    services = categorize.match_taxonomy(skills, dicts_io.taxonomy_frame(spark, DICTS.services))
    out = categorize.categorize_relational(topics, "arrival", services)
    return out.select("arrival", "group", joined("skills").alias("skills"))


@query
def a4_sorted_arrays(spark, sf):
    d = inputs.table(spark, sf, "documents")
    return d.select("doc_id", F.array_join(F.sort_array(F.array_distinct(F.split("text", " "))), " ").alias("words"))


@query
def a5_order_tokens(spark, sf):
    seqs = _sequences(spark, sf)
    return seqs.select("doc", F.array_join("tokens", " ").alias("tokens"), F.array_join("labels", " ").alias("labels"))


@query
def a6_load_report(spark, sf):
    good, rejects = clean.validate_dates(inputs.posts(spark, sf))
    return training.load_report(good, rejects)


@query
def a8_top_skills(spark, sf):
    return insights.top_skills(enriched(spark, sf), 10)


@query
def a9_skills_by_title(spark, sf):
    return insights.skills_by(enriched(spark, sf), "Title", 5)


@query
def a10_skills_by_industry(spark, sf):
    return insights.skills_by(enriched(spark, sf), "Industry_type", 5)


@query
def a11_category_counts(spark, sf):
    return insights.category_counts(enriched(spark, sf))


@query
def a12_posts_over_time(spark, sf):
    return insights.posts_over_time(enriched(spark, sf)).withColumn("period", F.col("period").cast("string"))


@query
def a13_facet(spark, sf):
    chosen = insights.facet(
        enriched(spark, sf), {"Seniority_level": "entry level", "Skills.categories.cloud_providers": "aws"}
    )
    return insights.top_skills(chosen, 10)


@query
def a8_counts_kept_up(spark, sf):
    """Counts of all insights after three micro-batches that each replace the posts of the one before.

    Three consecutive documents share a key, so most rows of the later batches take old facts back.
    """
    rows = enrich_posts(inputs.posts(spark, sf).filter("arrival % 2 = 1"), DICTS, key="arrival")
    source, state, counts, progress = (scratch_dir(spark, n) for n in ("posts", "state", "counts", "progress"))
    sink = jobs.counts_sink(state, counts, rows.schema, compact_every=2)
    for part in range(3):
        rows.filter(F.floor(F.col("arrival") / 2) % 3 == part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        jobs.start(stream, sink, progress, available_now=True).awaitTermination()
    deltas = spark.read.option("basePath", counts).parquet(counts)
    return insights.current_counts(deltas)


@query
def c6_dictionary_audit(spark, sf):
    """Doubtful dictionary entries, with the posts that name each."""
    aliases = dicts_io.alias_frame(spark, DICTS.skill_aliases)
    both = dicts_io.taxonomy_frame(spark, DICTS.topics).unionByName(dicts_io.taxonomy_frame(spark, DICTS.services))
    named = exploded_skills(spark, sf).groupBy(F.col("skill").alias("term")).agg(F.count("*").alias("posts"))
    audit = normalize.dictionary_audit(aliases, both)
    return audit.join(named, "term", "left").select(
        "issue", "term", "detail", F.coalesce("posts", F.lit(0)).alias("posts")
    )


@query
def c6_alias_chains(spark, sf):
    """Chains and cycles of aliases followed to their ends."""
    return normalize.resolve_aliases(inputs.alias_chains(spark, sf))


# --- scalar functions ------------------------------------------------------------------------


@query
def f_text_functions(spark, sf):
    p = inputs.posts(spark, sf)
    return p.select(
        "arrival",
        text.strip(F.concat(F.lit(" \t\n"), "Description", F.lit(" \r"))).alias("stripped"),
        text.remove_prefix(F.concat(F.lit("####"), "Title"), "##").alias("bare"),
        F.lower("Company_name").alias("lowered"),
        F.split_part("Company_name", F.lit(" "), F.lit(2)).alias("part"),
        F.col("Title").cast("binary").cast("string").alias("decoded"),
    )


@query
def f_array_functions(spark, sf):
    e = inputs.table(spark, sf, "embeddings")
    ints = F.transform("embedding", lambda x: F.floor(x * 10).cast("int"))
    return e.select(
        "vec_id",
        arrays.argmax("embedding").alias("argmax"),
        joined(F.sort_array(F.array_distinct(ints)).cast("array<string>")).alias("levels"),
        joined(arrays.pad_to(ints, F.size(ints) + 3, -100).cast("array<string>")).alias("padded"),
        F.array_contains(ints, 0).alias("has_zero"),
    )


# --- streams ---------------------------------------------------------------------------------


def _unique_payloads(spark, sf):
    """Posts as payloads with a Job_ID of their own, malformed ones included."""
    p = inputs.posts(spark, sf).withColumn("Job_ID", F.concat(F.lit("P"), F.col("arrival").cast("string")))
    value = F.to_json(F.struct(*POST_FIELDS))
    value = F.when(F.col("arrival") % 50 == 7, "not json").otherwise(value)
    return p.select(value.cast("binary").alias("value"))


def _run_enrichment(spark, sf, runs):
    path = staged(_unique_payloads(spark, sf), "payloads")
    table, progress = scratch_dir(spark, "enriched"), scratch_dir(spark, "progress")
    for run in runs:
        stream = readers.read_posts_stream(spark, path, {"maxFilesPerTrigger": "4"}, fmt="parquet")
        jobs.run_stream(stream, table, progress, DICTS, run=run, available_now=True).awaitTermination()
    schema = enrich_posts(spark.createDataFrame([], POST), DICTS).schema
    return flat_enriched(sinks.merge_by_key(sinks.read_versions(spark, table, schema)))


@query
def r1_enrich_stream(spark, sf):
    return _run_enrichment(spark, sf, [0])


@query
def r2_dedupe_stream(spark, sf):
    p = inputs.posts(spark, sf)
    path = staged(p, "posts")
    stream = jobs.dedupe_stream(spark.readStream.schema(p.schema).parquet(path))
    out = scratch_dir(spark, "deduped")
    jobs.start(stream, jobs.upsert_sink(out), scratch_dir(spark, "progress"), available_now=True).awaitTermination()
    kept = sinks.read_versions(spark, out, p.schema)
    return kept.groupBy("Job_ID").agg(F.count("*").alias("posts"))


@query
def r2_first_arrivals(spark, sf):
    """Posts arrive in two batches that share keys; keys are forgotten two hours of event time after their first post."""
    p = inputs.posts(spark, sf).select("Job_ID", "arrival", "Description")
    doc = F.floor(F.col("arrival") / 2)
    minutes = doc * 37 % 1000 + doc % 2 * 240
    p = p.withColumn("at", F.timestamp_seconds(F.lit(1704067200) + minutes * 60))
    source, out, progress = (scratch_dir(spark, n) for n in ("source", "first", "progress"))
    for n in (0, 1):
        p.filter(doc % 2 == n).write.mode("append").parquet(source)
        stream = first_arrivals_stream(
            spark.readStream.schema(p.schema).parquet(source), event_time="at", ttl_seconds=7200, delay="11 hours"
        )
        jobs.start(stream, jobs.upsert_sink(out), progress, available_now=True).awaitTermination()
    return sinks.read_versions(spark, out, p.schema).select("Job_ID", "arrival", "Description")


@query
def r3_dedupe_with_table(spark, sf):
    """First scrapes arrive in one batch and full posts in the next; some keys were stored before."""
    p = inputs.posts(spark, sf)
    source, table, progress = (scratch_dir(spark, n) for n in ("source", "deduped", "progress"))
    seeds = dedupe.first_by_key(p.filter("Company_name = 'Company 5'"), "Job_ID", F.desc("arrival"))
    seeds = seeds.withColumn("Description", F.when(F.col("Title") == "Plumber", "").otherwise("known"))
    has_text = F.col("Description") != ""
    sinks.append_version(seeds.withColumn("has_text", has_text), table, -1, 0, ["has_text"])
    sink = jobs.ingest_sink(table, p.schema)
    for scrape in (0, 1):
        p.filter(F.col("arrival") % 2 == scrape).write.mode("append").parquet(source)
        stream = spark.readStream.schema(p.schema).parquet(source)
        jobs.start(stream, sink, progress, available_now=True).awaitTermination()
    state = sinks.latest_by_key(sinks.read_versions(spark, table, p.schema))
    return state.select("Job_ID", "arrival", "Description")


@query
def r4_replay(spark, sf):
    return _run_enrichment(spark, sf, [0, 1])


# --- training data ---------------------------------------------------------------------------


def _sequences(spark, sf):
    """Sequences of the labelled documents."""
    return training.to_sequences(inputs.labelled_docs(spark, sf))


def _vocabulary(spark, sf):
    """Words of the benchmark texts, numbered by their hash order."""
    words = inputs.table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("token")).distinct()
    return words.withColumn("id", (F.conv(F.substring(F.md5("token"), 1, 6), 16, 10).cast("int") + 200))


def _split(spark, sf):
    return training.split_train_val(_sequences(spark, sf))


def _encoded(spark, sf, split=None):
    split = split or _split(spark, sf)
    return training.encode_sequences(split, _vocabulary(spark, sf), keep=["split"])


def _joined_ids(df):
    return df.select(
        "doc",
        "split",
        *[joined(F.col(c).cast("array<string>")).alias(c) for c in ("input_ids", "attention_mask", "labels")],
    )


@query
def t1_to_sequences(spark, sf):
    seqs, _ = training.split_unknown_labels(_sequences(spark, sf))
    return seqs.select("doc", F.size("tokens").alias("n"), F.array_join("labels", " ").alias("labels"))


@query
def t2_split_train_val(spark, sf):
    return training.split_train_val(_sequences(spark, sf)).select("doc", "split")


@query
def t3_encode_sequences(spark, sf):
    return _joined_ids(_encoded(spark, sf))


@query
def t4_pad_sequences(spark, sf):
    lengths = training.split_train_val(training.sequence_sizes(inputs.labelled_docs(spark, sf)))
    padded = training.pad_sequences(_encoded(spark, sf), sequences=lengths)
    n = lambda c, v: F.size(c) - F.size(F.array_remove(c, v))
    return padded.select(
        "doc",
        "split",
        *[F.size(c).alias(f"n_{c}") for c in ("input_ids", "attention_mask", "labels")],
        n("attention_mask", 0).alias("masked"),
        n("labels", -100).alias("ignored"),
        n("input_ids", 0).alias("padding"),
    )


def _scored(spark, sf, task_bytes=None):
    """Gold label ids at both ends ignored, and three class scores per position."""
    documents = inputs.table(spark, sf, "documents")
    documents = readers.spread(documents, task_bytes=task_bytes) if task_bytes else documents
    words = documents.select(F.col("doc_id").alias("doc"), F.split("text", " ").alias("w"))
    n = F.size("w")
    gold = F.transform("w", lambda _, i: F.when((i == 0) | (i == n - 1), -100).otherwise(((F.col("doc") * 31 + i * 17) % 5) % 3))
    scores = F.transform(
        "w", lambda t, i: F.array(*[((F.length(t) * (7 + c) + i * (3 + c)) % 11).cast("double") for c in range(3)])
    )
    return words.select("doc", gold.cast("array<int>").alias("labels"), scores.alias("scores"))


@query
def t5_argmax_labels(spark, sf):
    out = training.argmax_labels(_scored(spark, sf))
    return out.select("doc", joined(F.col("pred_ids").cast("array<string>")).alias("pred_ids"))


@query
def t6_aligned_labels(spark, sf):
    rows = training.aligned_labels(training.argmax_labels(_scored(spark, sf)))
    return rows.groupBy("doc", "gold", "pred").agg(F.count("*").alias("n"), F.sum("pos").alias("pos_sum"))


@query
def t7_span_prf(spark, sf):
    return training.sequence_prf(training.argmax_labels(_scored(spark, sf)))


@query
def t7_span_prf_strict(spark, sf):
    return training.sequence_prf(training.argmax_labels(_scored(spark, sf)), mode="strict")


@query
def t7_span_prf_rows(spark, sf):
    """The same from one row per token, for sequences of any length."""
    return training.span_prf(training.aligned_labels(training.argmax_labels(_scored(spark, sf, SORTED_TEXT))))


@query
def t8_split_report(spark, sf):
    return training.split_report(training.split_train_val(_sequences(spark, sf)))


@query
def a7_longest_per_split(spark, sf):
    return _encoded(spark, sf).groupBy("split").agg(F.max(F.size("input_ids")).alias("longest"))


@query
def p9_ignored_positions(spark, sf):
    rows = training.aligned_labels(training.argmax_labels(_scored(spark, sf)))
    return rows.groupBy("doc").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


@query
def w1_decode_arrays(spark, sf):
    """The row-local decoder on the tagged tokens of each post."""
    tagged = tagged_tokens("Description", lexicon_pattern(DICTS.lexicon()))
    p = inputs.posts(spark, sf).select("arrival", tagged.alias("t"))
    return p.select("arrival", joined(F.transform(decode_tagged("t"), lambda s: span_text(s))).alias("spans"))
