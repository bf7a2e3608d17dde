"""The corpus operators over the given tables, with production parameters: name -> f(spark, sf_dir)."""

import os

from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    ann,
    decontaminate,
    hard_negatives,
    html_main,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    pii,
    quality,
    token_align,
    toxicity,
    warc,
)
from .common import table

QUERIES = {}

#: Folder of the tokenizer files, where it is not that of the installed package.
TOKENIZERS = os.environ.get("TOKENIZER_DIR")


def query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer(name="word_bpe_49k.json"):
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def sha256(column):
    return F.sha2(F.coalesce(column, F.lit("")).cast("binary"), 256)


@query
def op1_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    state = line_dedup.LineState(spark, scratch_dir(spark, "lines")).insert(docs)
    return state.clean(docs).select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


@query
def op2_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    scored = model.score(docs)
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op3_license_scan(spark, sf):
    return license_scan.scan(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op4_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.report(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


@query
def op5_personal_data(spark, sf):
    found = pii.find(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[pii.counted("base", k).alias(f"n_{k}") for k in pii.KINDS],
        sha256(pii.written("base")).alias("base_sha256"),
        pii.written("spans").alias("spans"),
        pii.counted("spans", "secret").alias("n_secret"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


@query
def op6_main_text(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return html_main.main_text(pages).withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op7_near_dedup(spark, sf):
    return near_dedup.link(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op8_nearest_neighbours(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return ann.CodeIndex(vectors).search(vectors.filter("vec_id % 20 = 0"), k=20)


@query
def op9_warc_derivatives(spark, sf):
    responses = warc.responses_of_pages(table(spark, sf, "pages"))
    made = warc.derive(responses)
    header = F.col("warc")
    return made.select(
        "record_id",
        "record_type",
        "refers_to",
        header["warc-target-uri"].alias("target_uri"),
        header["warc-source-payload-digest"].alias("payload_digest"),
        header["warc-block-digest"].alias("block_digest"),
        header["content-length"].cast("bigint").alias("content_length"),
    )


@query
def op10_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents").select("doc_id", "text"), tokenizer())


@query
def op11_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.score(docs, table(spark, sf, "labels")).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op12_hard_negatives(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    index = hard_negatives.TreeIndex(table(spark, sf, "embeddings").withColumn("label", label))
    return index.mine(F.col("id") % 50 == 0)


@query
def op13_token_alignment(spark, sf):
    return token_align.report(table(spark, sf, "documents").select("doc_id", "text"))
