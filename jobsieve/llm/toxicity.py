"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; labelled rows with their label left aside are the unlabelled ones. The
risk is estimated with the class prior: ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``. Where the second part
falls below zero, the step goes against it, which keeps the negative risk from being over-fitted.

Features say which words, and which beginnings of words, a text holds; they do not count, so the length of a
text has no direct effect. Only text enters a score.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import give_back, rows_of, stored, text_bytes

#: Bounds of the training sample; the prior is counted over all labelled training rows.
MAX_POSITIVE = 3_000
MAX_UNLABELLED = 6_000
MAX_FEATURES = 1_024
#: Standard errors by which a feature must be more common in positives than in unlabelled texts.
MIN_Z = 3.0
DIM = 1 << 22
PREFIXES = (3, 4, 5, 6, 7, 8)
THRESHOLD = 0.3

_NOT_LETTERS = bytes(32 if c < 65 or 91 <= c <= 96 or 123 <= c <= 127 else c for c in range(256))


def words_of(text):
    return set(text.decode("utf-8", "replace").lower().encode().translate(_NOT_LETTERS).split())


def features_of_word(word):
    letters = word.decode("utf-8", "replace")
    marks = [b"=" + word] + [b"^" + letters[:n].encode() for n in PREFIXES if len(letters) > n]
    return tuple(zlib.crc32(m) % DIM for m in marks)


class _Cache(dict):
    def __init__(self, of, bound=50_000):
        super().__init__()
        self.of, self.bound = of, bound

    def __missing__(self, word):
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = self.of(word)
        return value


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def train_nnpu(positive, unlabelled, prior, steps=250, rate=0.05, decay=3e-4, gamma=1.0):
    """Weights and bias of a linear model under the non-negative risk, logistic loss, Adam steps."""

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    n = positive.shape[1]
    w, b = np.zeros(n), np.log(prior / (1 - prior))
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        zp, zu = positive @ w + b, unlabelled @ w + b
        sp, su = sigmoid(zp), sigmoid(zu)
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        up = -prior * (1 - sp) / len(sp)  # gradient of prior * R_p(+)
        neg_p, neg_u = -prior * sp / len(sp), su / len(su)  # of R_u(-) - prior * R_p(-)
        dp, du = (up + neg_p, neg_u) if rest >= 0 else (-gamma * neg_p, -gamma * neg_u)
        g = np.append(dp @ positive + du @ unlabelled + decay * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


class ToxicityModel:
    """A fitted model: a few thousand weights at most, sent to every task."""

    def __init__(self, weights, bias):
        self.weights, self.bias = weights, float(bias)

    def score(self, df, text="text", out="score"):
        """All rows of `df` with a score between 0 and 1; NULL and empty texts get that of no word at all."""
        names = [f"c{i}" for i in range(len(df.columns))]
        kept = [c for c in df.columns if c != out]
        weights, bias = self.weights, self.bias

        def scan(batches):
            known = _Cache(lambda w: tuple(f for f in features_of_word(w) if f in weights))
            for batch in batches:
                scores = []
                for value in batch.column("own_text").to_pylist():
                    found = set()
                    for word in words_of(value):
                        if ids := known[word]:
                            found.update(ids)
                    z = bias + sum(weights[f] for f in sorted(found))
                    scores.append(float(1 / (1 + np.exp(-np.clip(z, -40, 40)))))
                rest = [batch.column(n) for n in batch.schema.names if n != "own_text"]
                own = [n for n in batch.schema.names if n != "own_text"]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(scores, pa.float64())], names=[*own, "own_score"])
            known.clear()
            give_back()

        pairs = [(c, n) for c, n in zip(df.columns, names, strict=True) if c in kept]
        given = df.select(*[F.col(f"`{c}`").alias(n) for c, n in pairs], text_bytes(F.col(f"`{text}`")).alias("own_text"))
        types = {f.name: f.dataType.simpleString() for f in given.schema}
        schema = ", ".join([*(f"{n} {types[n]}" for _, n in pairs), "own_score double"])
        scored = given.mapInArrow(scan, schema)
        return scored.select(*[F.col(n).alias(c) for c, n in pairs], F.col("own_score").alias(out))


def fit(docs, labels, max_positive=MAX_POSITIVE, max_unlabelled=MAX_UNLABELLED, max_features=MAX_FEATURES):
    """Fit on labelled rows that are not held out.

    Rows without an id, text-less rows and NULL labels teach nothing; an id with several labels counts as toxic if
    any of them is. Without a toxic training row, the model scores every text 0.
    """
    spark = docs.sparkSession
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .filter(~held_out())
    )
    total, toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic:
        return ToxicityModel({}, -40)
    prior = min(max(toxic / total, 0.01), 0.99)
    order = [F.xxhash64("doc_id"), "doc_id"]
    positive = known.filter("toxic = 1").orderBy(*order).limit(max_positive).select("doc_id", F.lit(1).alias("p"))
    rest = known.orderBy(*order).limit(max_unlabelled).select("doc_id", F.lit(0).alias("p"))
    chosen = positive.unionByName(rest)  # bounded by the two limits

    def scan(batches):
        seen = _Cache(features_of_word)
        for batch in batches:
            p, ids = [], []
            for flag, text in rows_of(batch, "p", "text"):
                found = set()
                for word in words_of(text):
                    found.update(seen[word])
                p.append(flag)
                ids.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int32()), pa.array(ids, pa.list_(pa.int32()))], names=["p", "ids"]
            )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text"))
    sample = texts.join(F.broadcast(chosen), "doc_id").select("p", "text").mapInArrow(scan, "p int, ids array<int>")
    sample = stored(sample, "toxicity-sample")
    n_p, n_u = sample.agg(F.sum("p"), F.sum(1 - F.col("p"))).first()
    if not n_p or not n_u:
        return ToxicityModel({}, -40)
    by_feature = (
        sample.select("p", F.explode("ids").alias("id"))
        .groupBy("id")
        .agg(F.sum("p").alias("in_p"), F.sum(1 - F.col("p")).alias("in_u"))
        .filter("in_p + in_u >= 5")
    )
    share_p, share_u, share = F.col("in_p") / n_p, F.col("in_u") / n_u, (F.col("in_p") + F.col("in_u")) / (n_p + n_u)
    # Only evidence for toxicity: what clean texts say more often says nothing, however long they are.
    error = F.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u) + 1e-12)
    top = [
        r.id
        for r in by_feature.withColumn("z", (share_p - share_u) / error)
        .filter(F.col("z") >= MIN_Z)
        .orderBy(F.desc("z"), "id")
        .limit(max_features)
        .collect()
    ]
    if not top:
        return ToxicityModel({}, np.log(prior / (1 - prior)))
    place = {f: i for i, f in enumerate(top)}
    marked = sample.select("p", F.array_intersect("ids", F.lit(top).cast("array<int>")).alias("ids")).collect()
    x = np.zeros((len(marked), len(top)), np.float32)
    for row, r in zip(x, marked, strict=True):
        row[[place[f] for f in r.ids]] = 1
    is_p = np.array([r.p for r in marked]) == 1
    w, b = train_nnpu(x[is_p], x[~is_p], prior)
    return ToxicityModel({f: float(w[i]) for f, i in place.items()}, b)
