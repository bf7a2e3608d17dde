"""Skill extraction: token labels, lexicon hits, span decoding."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import lookup
from ..functions.spans import BEGIN, INSIDE, MARKS, OUTSIDE, decoded
from ..functions.text import is_blank, let, strip
from ..functions.tokens import (
    MAX_PATTERN_TERMS,
    decode_tagged,
    lexicon_pattern,
    marked_tokens,
    matchable_terms,
    mentions,
    respelled_terms,
    span_text,
    tokens,
    truncate,
    unmarked,
)
from ..schemas import SPECIAL_TOKENS

# Positions per piece of a document in the relational decoder.
CHUNK = 1 << 16
# Hits that are chosen from in one go; the list of chosen ones is copied as it grows.
FOLD = 500


def truncate_tokens(df: DataFrame, n, pos="pos") -> DataFrame:
    """Keep the first n token positions of every document; all when n is None."""
    return df if n is None else df.filter(F.col(pos) < n)


def tokenize(df: DataFrame, doc, text) -> DataFrame:
    """Rows (doc, pos, token)."""
    # The outer form keeps the optimizer from filtering on the array, which would build it twice.
    rows = df.select(F.col(doc), F.posexplode_outer(tokens(text)).alias("pos", "token"))
    return rows.filter("token IS NOT NULL")


def label_tokens(df: DataFrame, doc, text, lexicon) -> DataFrame:
    """Rows (doc, pos, token, label): mentions of lexicon terms as B-SKILL / I-SKILL, the rest O.

    Mentions do not overlap: the leftmost wins, then the longest. No shuffle.
    """
    marked = marked_tokens(text, lexicon_pattern(lexicon))
    rows = df.select(F.col(doc), F.posexplode_outer(marked).alias("pos", "_t")).filter("_t IS NOT NULL")
    token, label = unmarked("_t")
    return rows.select(doc, "pos", token.alias("token"), label.alias("label"))


def _longest(terms):
    return terms.agg(F.max(F.size(F.split("term", " ")))).first()[0] or 1


def _all_hits(df, doc, text, terms, max_words):
    """Rows (doc, pos, n, term) of every place where a term stands; ``terms`` holds distinct tokenised terms."""
    firsts = terms.select(F.substring_index("term", " ", 1).alias("first")).distinct()

    def windows(words):
        shifted = [F.slice(words, F.lit(k + 1), F.size(words)).alias(f"t{k + 1}") for k in range(max_words)]
        return F.arrays_zip(*shifted)

    places = df.select(F.col(doc), F.posexplode_outer(let(tokens(text), windows)).alias("pos", "_w"))
    starts = places.filter("_w IS NOT NULL").join(firsts, F.col("_w.t1") == F.col("first"), "left_semi")
    grams = [
        F.struct(
            F.lit(n).alias("n"),
            F.when(
                F.col(f"_w.t{n}").isNotNull(),
                F.concat_ws(" ", *[F.col(f"_w.t{k}") for k in range(1, n + 1)]),
            ).alias("term"),
        )
        for n in range(1, max_words + 1)
    ]
    return starts.select(doc, "pos", F.inline(F.array(*grams))).join(terms, "term")


def lexicon_hits(df: DataFrame, doc, text, lexicon: DataFrame, max_words=None) -> DataFrame:
    """Rows (doc, pos, n, term): every mention not strictly inside a longer one.

    For a lexicon of any size, one ``term`` column in any case; mentions may overlap here. Tokens meet the
    first words of the terms, and only those that match form n-grams, inside the row, to meet the
    whole terms. Containment is settled per exact place, so texts are read once, only hits are
    shuffled, and nothing is gathered per document. ``max_words`` is the length of the longest term, counted
    where it is not given.
    """
    terms = lexicon.select(F.lower("term").alias("term")).filter("term <> ''").distinct()
    max_words = max_words or _longest(terms)
    found = _all_hits(df, doc, text, terms, max_words)
    # A hit speaks for its own place and against every place strictly inside it.
    own = F.struct("pos", "n", F.col("n").alias("reach"), F.lit(True).alias("own"))
    inner = [
        F.struct(
            (F.col("pos") + a).alias("pos"), F.lit(m).alias("n"), F.lit(m + a).alias("reach"), F.lit(False).alias("own")
        )
        for m in range(1, max_words)
        for a in range(0, max_words - m + 1)
    ]
    places = found.select(doc, F.col("n").alias("_n"), F.col("term").alias("_term"), F.inline(F.array(own, *inner)))
    return (
        places.filter("own OR (reach <= _n AND n < _n)")
        .groupBy(doc, "pos", "n")
        .agg(F.bool_and("own").alias("free"), F.max("_term").alias("term"))
        .filter("free")
        .select(doc, "pos", "n", "term")
    )


def normal_terms(lexicon: DataFrame) -> DataFrame:
    """Rows (term, given, canonical): normal forms of a ``term`` table, each once, and what to return for them.

    The relational form of ``functions.tokens.normal_forms``. A column ``canonical`` is taken over where there is one; of
    several canonical names of one form the smallest is.
    """
    given = F.lower("term")
    canonical = F.col("canonical") if "canonical" in lexicon.columns else F.lit(None).cast("string")
    forms = lexicon.select(
        F.array_join(tokens("term"), " ").alias("form"), given.alias("given"), canonical.alias("canonical")
    ).filter("form <> ''")
    forms = forms.filter(F.substr("form", F.lit(1), F.lit(1)) == F.substr(strip("given"), F.lit(1), F.lit(1)))
    first = F.min(F.struct(F.col("form") != F.col("given"), "given"))
    return forms.groupBy(F.col("form").alias("term")).agg(
        first["given"].alias("given"), F.min("canonical").alias("canonical")
    )


def lexicon_mentions(df: DataFrame, doc, text, lexicon: DataFrame, max_words=None) -> DataFrame:
    """Rows (doc, pos, n, term, canonical): mentions that do not overlap, leftmost first, the longest from there.

    The same mentions as those of a pattern, for a lexicon table (``term``, and ``canonical`` where there is one) of any size.
    Tokens meet first words, n-grams meet whole terms, and only hits are shuffled. Where no hit reaches over a place, the
    choice starts afresh: hits are gathered per run of overlapping ones, never more than one text, which
    is a single row already, can hold. Rows that share a ``doc`` must share their text.
    """
    terms = normal_terms(lexicon)
    max_words = max_words or _longest(terms)
    found = _all_hits(df, doc, text, terms.select("term"), max_words)
    best = found.groupBy(doc, F.col("pos").cast("bigint").alias("pos")).agg(F.max(F.struct("n", "term")).alias("hit"))
    hits = best.select(doc, "pos", F.col("hit.n").alias("n"), F.col("hit.term").alias("term"))
    in_order = Window.partitionBy(doc).orderBy("pos")
    reach = F.max(F.col("pos") + F.col("n")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("pos") >= F.col("reach"), F.lit(True)).cast("bigint")
    numbered = hits.withColumn("reach", reach).withColumn(
        "run", F.sum(opens).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    runs = numbered.groupBy(doc, "run").agg(F.sort_array(F.collect_list(F.struct("pos", "n", "term"))).alias("hits"))
    chosen = runs.select(doc, F.explode(_chosen(F.col("hits"))).alias("hit")).select(doc, "hit.pos", "hit.n", "hit.term")
    return chosen.join(terms, "term").select(
        doc, "pos", "n", F.col("given").alias("term"), F.coalesce("canonical", "given").alias("canonical")
    )


def _chosen(hits):
    """The hits that start where, or after, the one chosen before them ends."""
    none = F.slice(hits, 1, 0)

    def end(chosen):
        last = F.get(chosen, F.size(chosen) - 1)
        return last["pos"] + last["n"]

    def choose(before, part):
        return F.aggregate(
            part,
            none,
            lambda kept, hit: F.when(
                hit["pos"] >= F.coalesce(end(kept), end(before), F.lit(0)), F.array_append(kept, hit)
            ).otherwise(kept),
        )

    starts = F.sequence(F.lit(1), F.size(hits), F.lit(FOLD))
    return F.aggregate(
        starts, none, lambda before, at: F.concat(before, choose(before, F.slice(hits, at, F.lit(FOLD))))
    )


def decode_bio(
    df: DataFrame,
    doc="doc",
    pos="pos",
    token="token",
    label="label",
    mode="strict",
    chunk=CHUNK,
) -> DataFrame:
    """Label rows to spans: rows (doc, start, end, tokens).

    ``strict``: a span is a B-SKILL and the I-SKILLs after it; an orphan I-SKILL is ignored.
    ``conll``: an orphan I-SKILL opens a span. Special tokens never end a span.

    A token belongs to its head, the last token up to it that is not I-SKILL. Documents are cut
    into chunks of positions, so one huge document is spread over many tasks. The rows of a chunk become one array,
    already in the task that reads them; its spans are cut out of it without sorting rows. Spans closed inside
    their chunk are assembled there; only what touches a chunk border goes through a second,
    per-document pass. Both read the same shuffle of the input.
    """
    if mode not in ("strict", "conll"):
        raise ValueError(f"unknown mode {mode!r}")
    at = F.col(pos).cast("bigint")
    opens = F.coalesce(F.col(label) == "B-SKILL", F.lit(False))
    continues = F.coalesce(F.col(label) == "I-SKILL", F.lit(False))
    mark = F.when(opens, BEGIN).when(continues, INSIDE).otherwise(OUTSIDE)
    # Only what the spans need is shuffled: the place with its mark, and the text of B/I tokens.
    rows = df.filter(~F.col(token).isin(SPECIAL_TOKENS)).select(
        F.col(doc).alias("doc"),
        F.floor(at / F.lit(chunk)).alias("chunk"),
        F.struct((at * MARKS + mark).alias("place"), F.when(opens | continues, F.col(token)).alias("token")).alias("row"),
    )
    chunks = rows.groupBy("doc", "chunk").agg(F.collect_list("row").alias("rows"))

    def cut(border, fields):
        schema = T.StructType([T.StructField("doc", rows.schema["doc"].dataType), *T.StructType.fromDDL(fields).fields])
        return chunks.mapInArrow(lambda batches: decoded(batches, mode, border), schema)

    settled = cut(False, "start bigint, end bigint, tokens array<string>")
    in_doc = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    member = F.col("place").isNull() | (F.pmod("place", F.lit(MARKS)) == BEGIN)
    if mode == "strict":
        member = member & F.coalesce(F.pmod("head", F.lit(MARKS)) == BEGIN, F.lit(False))
    continued = (
        cut(True, "pos bigint, place bigint, token string")
        .withColumn("head", F.max("place").over(in_doc))
        .filter(member)
        .groupBy("doc", "head")
        .agg(
            F.min("pos").alias("start"),
            F.max("pos").alias("end"),
            F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("parts"),
        )
        .select("doc", "start", "end", F.col("parts.token").alias("tokens"))
    )
    return settled.unionByName(continued).withColumnRenamed("doc", doc)


def span_texts(spans: DataFrame, clean_up=False) -> DataFrame:
    """Add the text of every span; spans without text are dropped."""
    return spans.withColumn("span", span_text("tokens", clean_up)).filter("span != ''")


def extract_skills(df: DataFrame, key, text, lexicon=None, labeler=None, out="skills", max_tokens=None) -> DataFrame:
    """Add the sorted set of skills named in a text; ``[]`` for a blank text.

    By default mentions of ``lexicon`` terms are found inside the row. A lexicon given as a DataFrame (``term``, and
    ``canonical`` to return instead), or as more terms than a pattern takes, is joined: equal texts are one
    text there, and only hits and finished sets are shuffled. ``labeler`` is a function
    from a text column to a column array<struct<token,label>>, such as a ``pandas_udf`` around a
    trained model; its spans are decoded inside the row too, so repeated keys do no harm and streams
    can use it. A NULL array names no skill.
    """
    empty = F.array().cast("array<string>")
    if labeler is None:
        source = F.col(text)
        if max_tokens is not None:
            source = F.array_join(truncate(tokens(text), max_tokens), " ")
        if not isinstance(lexicon, DataFrame):
            terms = matchable_terms(lexicon)
            if len(terms) > MAX_PATTERN_TERMS:
                lexicon = df.sparkSession.createDataFrame([(t,) for t in lexicon if t], "term string")
        if isinstance(lexicon, DataFrame):
            return _extract_by_join(df, source, lexicon, out)
        found = mentions(source, lexicon_pattern(terms))
        respelled = respelled_terms(lexicon)
        if respelled:
            found = F.transform(found, lambda m: F.coalesce(lookup(respelled, m), m))
    else:
        # The labels become a column first: inside the decoder they would be computed once per use.
        df = df.withColumn("_tagged", truncate(labeler(F.col(text)), max_tokens))
        spans = F.transform(decode_tagged("_tagged"), lambda s: span_text(s))
        found = F.coalesce(F.filter(spans, lambda s: s != ""), empty)
    found = F.sort_array(F.array_distinct(found))
    return df.withColumn(out, F.when(is_blank(text), empty).otherwise(found)).drop("_tagged")


def _extract_by_join(df, source, lexicon, out):
    named = df.withColumn("_text_id", F.unhex(F.sha2(source, 256)))
    texts = df.select(F.unhex(F.sha2(source, 256)).alias("_text_id"), source.alias("_source"))
    found = lexicon_mentions(texts.filter("_source IS NOT NULL"), "_text_id", "_source", lexicon)
    sets = found.groupBy("_text_id").agg(F.sort_array(F.collect_set("canonical")).alias("_found"))
    empty = F.array().cast("array<string>")
    joined = named.join(sets, "_text_id", "left")
    return joined.withColumn(out, F.coalesce("_found", empty)).drop("_text_id", "_found")
