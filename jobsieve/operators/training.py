"""Preparing labelled token data for a tagger, and scoring its output."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import argmax, id_label, label_id, lookup, pad_to
from ..functions.text import let
from ..schemas import IGNORED_LABEL_ID, LABEL_IDS
from .extract import decode_bio

# Words of a vocabulary that may become a literal, about 2 MB; a larger one is joined.
MAX_LITERAL_WORDS = 50_000


def to_sequences(df: DataFrame, key="doc", tokens_col="tokens") -> DataFrame:
    """Labelled records to parallel arrays ``tokens`` and ``labels``, ordered by position.

    Equal positions keep their order in the record; records without tokens are dropped.
    """
    if isinstance(df.schema[tokens_col].dataType.elementType["position"].dataType, T.IntegerType):
        ordered = let(F.col(tokens_col), _by_position)
    else:
        ordered = F.sort_array(
            F.transform(
                tokens_col,
                lambda t, i: F.struct(
                    t["position"].alias("position"), i.alias("i"), t["text"].alias("text"), t["label"].alias("label")
                ),
            )
        )
    return (
        df.filter(F.size(tokens_col) > 0)
        .withColumn("_ordered", ordered)
        .select(key, F.col("_ordered.text").alias("tokens"), F.col("_ordered.label").alias("labels"))
    )


def _by_position(items):
    """Items by position, a missing one first, and then by place: whole numbers made of both are sorted, not the items."""
    place = F.lit(1 << 31)
    numbers = F.transform(items, lambda t, i: F.coalesce(t["position"].cast("bigint"), F.lit(-(1 << 31) - 1)) * place + i)
    return F.transform(F.sort_array(numbers), lambda n: F.get(items, n.bitwiseAND(place - 1).cast("int")))


def sequence_sizes(df: DataFrame, key="doc", tokens_col="tokens") -> DataFrame:
    """Rows (key, ``n``): the lengths of what ``to_sequences`` gives, without ordering anything."""
    return df.filter(F.size(tokens_col) > 0).select(key, F.size(tokens_col).alias("n"))


def split_unknown_labels(df: DataFrame):
    """(good, quarantine): sequences whose labels are all known, and the others."""
    known = F.forall("labels", lambda x: label_id(x).isNotNull())
    return df.filter(known), df.filter(~known)


def split_train_val(df: DataFrame, key="doc", fraction=0.2, seed=2, out="split") -> DataFrame:
    """Add ``train`` / ``val``: exactly ceil(fraction * n) rows, those with the smallest hashes.

    ``key`` is unique. The cut is found exactly without sorting everything: a histogram over
    65,536 hash buckets names the bucket the cut falls in, and only that bucket is ranked. The
    wide rows are then labelled by comparing with one scalar, without a shuffle.
    """
    rank_key = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.lit(":"), F.col(key).cast("string"))
    # The histogram and the ranking read one shuffle of the keys, so ``df`` is not evaluated for each: neither side may ask
    # for other columns, or for a filter, that would come before the shuffle.
    keys = df.select(rank_key.alias("h")).withColumn("bucket", F.coalesce(F.substring("h", 1, 4), F.lit(""))).repartition("bucket")
    histogram = keys.groupBy("bucket").agg((F.count("h") + F.count_if(F.col("h").isNull())).alias("n"))
    up_to = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cumulative = histogram.select(
        "bucket",
        "n",
        F.sum("n").over(up_to).alias("upto"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    ).withColumn("wanted", F.ceil(F.col("total") * F.lit(fraction)))
    cut_bucket = cumulative.filter("upto >= wanted AND upto - n < wanted")
    place = cut_bucket.select("bucket", (F.col("wanted") - F.col("upto") + F.col("n")).alias("place"))
    # One row, so the broadcast is bounded.
    in_bucket = keys.join(F.broadcast(place), "bucket")
    cut = (
        in_bucket.withColumn("r", F.row_number().over(Window.partitionBy("bucket").orderBy("h")))
        .filter("r = place")
        .select("h")
    )
    is_val = F.coalesce(rank_key <= cut.scalar(), F.lit(False))
    return df.withColumn(out, F.when(is_val, "val").otherwise("train"))


def split_report(df: DataFrame, split="split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(split).agg(F.count("*").alias("n"))


def load_report(good: DataFrame, rejects: DataFrame) -> DataFrame:
    """Counts of accepted and rejected records."""
    status = good.select(F.lit("good").alias("status")).unionByName(
        rejects.select(F.lit("rejected").alias("status"))
    )
    return status.groupBy("status").agg(F.count("*").alias("n"))


def encode_sequences(
    df: DataFrame, vocab: DataFrame, key="doc", cls_id=101, sep_id=102, unk_id=100, keep=(),
    literal_words=MAX_LITERAL_WORDS,
) -> DataFrame:
    """Arrays ``input_ids``, ``attention_mask`` and ``labels`` with the two boundary tokens added.

    ``vocab`` has unique rows (token, id); unknown tokens get ``unk_id``. A vocabulary of up to ``literal_words``
    is looked up inside the row, without a shuffle. A larger one is joined: the compact arrays are partitioned by
    ``key`` before they are exploded, so gathering the ids shuffles them once. Both ways give the same rows.
    """
    words = vocab.filter("token IS NOT NULL").select("token", "id").take(literal_words + 1)
    ignored = F.array(F.lit(IGNORED_LABEL_ID))
    if len(words) <= literal_words:
        known = {token: str(number) for token, number in words if number is not None}
        coded = F.transform(
            F.coalesce("tokens", F.array().cast("array<string>")),
            lambda t: F.coalesce(lookup(known, t).cast("int"), F.lit(unk_id)),
        )
        return df.withColumn("_ids", coded).select(
            key,
            *keep,
            F.concat(F.array(F.lit(cls_id)), "_ids", F.array(F.lit(sep_id))).alias("input_ids"),
            F.array_repeat(F.lit(1), F.size("_ids") + 2).alias("attention_mask"),
            F.concat(ignored, F.transform("labels", label_id), ignored).alias("labels"),
        )
    ids = vocab.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    label_ids = F.transform("labels", label_id)
    exploded = (
        df.withColumn("labels", label_ids)
        .repartition(key)
        # Outer: an empty sequence keeps its row, and no filter computes the array twice.
        .select(key, *keep, "labels", F.posexplode_outer("tokens").alias("pos", "_text"))
        # One copy of the labels is enough.
        .withColumn("labels", F.when(F.coalesce(F.col("pos") == 0, F.lit(True)), F.col("labels")))
    )
    coded = F.struct("pos", F.coalesce("_id", F.lit(unk_id)).cast("int").alias("id"))
    gathered = (
        exploded.join(ids, F.col("_text") == F.col("_token"), "left")
        .groupBy(key, *keep)
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), coded))).alias("_ids"),
            F.first("labels", ignorenulls=True).alias("_labels"),
        )
    )
    input_ids = F.concat(F.array(F.lit(cls_id)), F.col("_ids.id"), F.array(F.lit(sep_id)))
    return gathered.select(
        key,
        *keep,
        input_ids.alias("input_ids"),
        F.array_repeat(F.lit(1), F.size("_ids") + 2).alias("attention_mask"),
        F.concat(ignored, "_labels", ignored).alias("labels"),
    )


def pad_sequences(
    df: DataFrame, split_col="split", pad_id=0, sequences=None
) -> DataFrame:
    """Pad the three arrays to the longest sequence of their split, whatever splits there are.

    One row per split holds its maximum; those few rows go to the sequences, which stay in their tasks however few
    splits there are.
    ``sequences`` may name the frame ``df`` was encoded from, or its lengths (``sequence_sizes``) with their splits; the
    lengths are then taken from there and nothing is encoded twice, or ordered twice.
    """
    if sequences is None:
        sizes, size = df, F.size("input_ids")
    else:
        sizes, size = sequences, (F.col("n") if "n" in sequences.columns else F.size("tokens")) + 2
    longest = sizes.groupBy(F.col(split_col).alias("_split")).agg(F.max(size).alias("_length"))
    joined = df.join(F.broadcast(longest), F.col(split_col).eqNullSafe(F.col("_split")))
    length = F.col("_length")
    padded = joined.withColumns(
        {
            "input_ids": pad_to("input_ids", length, pad_id),
            "attention_mask": pad_to("attention_mask", length, 0),
            "labels": pad_to("labels", length, IGNORED_LABEL_ID),
        }
    )
    return padded.select(*df.columns)


def argmax_labels(df: DataFrame, scores="scores", out="pred_ids") -> DataFrame:
    """Class scores per position to predicted label ids."""
    return df.withColumn(out, F.transform(scores, argmax))


def aligned_labels(df: DataFrame, key="doc", gold="labels", pred="pred_ids") -> DataFrame:
    """Rows (key, pos, gold, pred) of label texts; positions with the ignored id are dropped."""
    pairs = F.arrays_zip(F.col(gold).alias("g"), F.col(pred).alias("p"))
    return (
        df.select(key, F.posexplode_outer(pairs).alias("pos", "_x"))
        .filter(F.col("_x.g") != IGNORED_LABEL_ID)
        .select(key, "pos", id_label("_x.g").alias("gold"), id_label("_x.p").alias("pred"))
    )


def span_places(labels, pos, mode="conll"):
    """Spans of one row as sorted numbers ``start * 2**31 + end``, from label ids and their positions.

    A span is a B and the I after it; with ``conll`` an I that follows neither opens one, with ``strict`` it is ignored.
    """
    begins, goes_on = F.lit(LABEL_IDS["B-SKILL"]), F.lit(LABEL_IDS["I-SKILL"])

    def is_in(x):
        return F.coalesce((x == begins) | (x == goes_on), F.lit(False))

    def spans(rows):
        label = lambda i: F.get(rows, i)["label"]
        continues = lambda x: F.coalesce(x == goes_on, F.lit(False))
        opens = F.filter(
            rows,
            lambda r, i: is_in(r["label"]) & ~(continues(r["label"]) & (i > 0) & is_in(label(F.greatest(i - 1, F.lit(0))))),
        )
        closes = F.filter(rows, lambda r, i: is_in(r["label"]) & ~continues(label(i + 1)))
        both = F.zip_with(
            opens,
            closes,
            lambda a, b: F.struct(a["label"].alias("first"), (a["pos"].cast("bigint") * F.lit(1 << 31) + b["pos"]).alias("place")),
        )
        return F.transform(both if mode == "conll" else F.filter(both, lambda s: s["first"] == begins), lambda s: s["place"])

    return let(F.arrays_zip(labels.alias("label"), pos.alias("pos")), spans)


def sequence_prf(df: DataFrame, gold="labels", pred="pred_ids", mode="conll") -> DataFrame:
    """``span_prf`` of rows that hold all label ids of a sequence: spans are found and compared inside the row.

    Positions whose gold id is the ignored one do not count, nor do those beyond the gold labels. Only three
    numbers a task are shuffled.
    """
    if mode not in ("strict", "conll"):
        raise ValueError(f"unknown mode {mode!r}")
    pairs = F.transform(
        F.arrays_zip(F.col(gold).alias("g"), F.col(pred).alias("p")),
        lambda x, i: F.struct(x["g"].alias("g"), x["p"].alias("p"), i.alias("pos")),
    )
    kept = df.select(F.filter(pairs, lambda x: x["g"] != IGNORED_LABEL_ID).alias("_x"))
    sides = kept.select(
        span_places(F.col("_x.g"), F.col("_x.pos"), mode).alias("g"),
        span_places(F.col("_x.p"), F.col("_x.pos"), mode).alias("p"),
    )
    counts = sides.agg(
        *[
            F.coalesce(F.sum(F.size(c).cast("bigint")), F.lit(0)).alias(name)
            for name, c in (("tp", F.array_intersect("g", "p")), ("gold_spans", F.col("g")), ("pred_spans", F.col("p")))
        ]
    )
    return _rates(counts)


def span_prf(labels: DataFrame, key="doc", gold="gold", pred="pred", mode="conll") -> DataFrame:
    """One row: entity counts, micro precision, recall and F1; 0 where a denominator is 0.

    Spans of both sides are found in one pass, as those of two documents each, and counted by place; a place with both
    is a true positive.
    """
    sides = F.array(
        F.struct(F.lit(1).alias("g"), F.lit(0).alias("p"), F.col(gold).alias("label")),
        F.struct(F.lit(0).alias("g"), F.lit(1).alias("p"), F.col(pred).alias("label")),
    )
    rows = labels.select(F.col(key).alias("key"), "pos", F.inline(sides))
    rows = rows.select(F.struct("key", "g", "p").alias("doc"), "pos", F.lit("").alias("token"), "label")
    marked = decode_bio(rows, mode=mode).select("doc.key", "start", "end", "doc.g", "doc.p")
    places = marked.groupBy("key", "start", "end").agg(F.max("g").alias("g"), F.max("p").alias("p"))
    totals = places.agg(
        F.coalesce(F.sum(F.col("g") * F.col("p")), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("g"), F.lit(0)).alias("gold_spans"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("pred_spans"),
    )
    return _rates(totals)


def _rates(totals):
    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    return totals.withColumns(
        {
            "precision": ratio(F.col("tp"), F.col("pred_spans")),
            "recall": ratio(F.col("tp"), F.col("gold_spans")),
            "f1": ratio(2 * F.col("tp"), F.col("gold_spans") + F.col("pred_spans")),
        }
    )
