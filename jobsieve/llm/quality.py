"""Quality by regularised quadratic discriminants over statistics of whole texts.

A text is described by a dozen shares and lengths: repeated words, distinct words, capitals, symbols, digits and so on.
Shares are taken to angles and lengths to logarithms, which brings them closer to normal. Each class has a mean
and a covariance, shrunk towards that of both classes together and towards a multiple of the identity. The score is the
posterior that follows from the difference of the two log densities, that is from Mahalanobis distances and log
determinants; the Cholesky factors are computed once and sent along.

The fit takes sums, and sums of products, over all labelled rows that are not held out, so it needs no sample. Only
text enters a score.
"""

from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import stored, text_bytes

THRESHOLD = 0.3
#: Weight of the common covariance, and of the identity, in that of a class.
TO_COMMON, TO_IDENTITY = 0.05, 0.002
#: Steps to which statistics and their products are rounded in sums.
ONE = 1 << 24
#: Rows of which a class has as much weight as the matrices it is shrunk to.
PRIOR_ROWS = 10

STATISTICS = (
    "repeated", "new", "capital", "symbol", "bar", "digit", "stop", "letter", "single", "length", "line", "common",
)

_CAPITAL = bytes(range(65, 91))
_SMALL = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_STOP = b".,;:?'-\"()"
_SPACE = b" \t\n\x0b\x0c\r"
_OTHER = bytes(c for c in range(33, 127) if c not in _CAPITAL + _SMALL + _DIGIT + _STOP)


def angle(part, of):
    """A share as an angle between 0 and pi / 2; that of nothing is 0."""
    return np.arcsin(np.sqrt(min(1.0, part / of))) if of else 0.0


def statistics(text):
    """The transformed statistics of a text given as bytes; of an empty text, all 0."""
    words = text.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    size = len(text)

    def count(chars):
        return size - len(text.translate(None, chars))

    capital, small, filled = count(_CAPITAL), count(_SMALL), sum(map(len, words))
    distinct = set(words)
    lines = text.count(b"\n") + 1
    letters = filled - count(_OTHER + _STOP + _DIGIT)
    return (
        angle(sum(map(eq, words, islice(words, 1, None))), n - 1),
        np.log1p(len(distinct)) / np.log1p(n),
        angle(capital, capital + small),
        angle(count(_OTHER), filled),
        angle(text.count(b" | "), n),
        angle(count(_DIGIT), filled),
        angle(count(_STOP), filled),
        angle(letters, filled),
        angle(sum(map((1).__eq__, map(len, words))), n),
        np.log1p(filled / n),
        np.log1p(n / lines),
        np.log1p(filled / len(distinct) / 8),
    )


class QualityModel:
    """Class means, Cholesky factors of class covariances, and log priors: a few hundred numbers, sent to every task."""

    def __init__(self, means, factors, log_priors):
        self.means, self.factors, self.log_priors = means, factors, log_priors
        self.log_dets = [2 * np.log(np.diag(f)).sum() for f in factors]

    def log_density(self, x, k):
        z = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
        return self.log_priors[k] - 0.5 * ((z * z).sum(axis=0) + self.log_dets[k])

    def posterior(self, x):
        """Probability of class 1 of each row of statistics."""
        if len(self.means) == 1:
            return np.full(len(x), self.log_priors[0])
        return 1 / (1 + np.exp(np.clip(self.log_density(x, 0) - self.log_density(x, 1), -700, 700)))

    def score(self, described, out="score"):
        """Rows with a column ``statistics`` (see `describe`), which gives way to a score from 0 to 1."""
        kept = [c for c in described.columns if c not in ("statistics", out)]
        names = [f"c{i}" for i in range(len(kept))]

        def scan(batches):
            for batch in batches:
                x = batch.column("statistics").flatten().to_numpy().reshape(-1, len(STATISTICS))
                own = [batch.column(n) for n in names]
                yield pa.RecordBatch.from_arrays([*own, pa.array(self.posterior(x))], names=[*names, "own_score"])

        given = described.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)], "statistics")
        schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in given.schema[:-1]), "own_score double"])
        scored = given.mapInArrow(scan, schema)
        return scored.select(
            *[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], F.col("own_score").alias(out)
        )


def describe(docs, text="text"):
    """All rows and columns of `docs` but the text, with ``statistics``; a column of that name is replaced.

    NULL and empty texts have statistics of 0.
    """
    kept = [c for c in docs.columns if c not in (text, "statistics")]
    names = [f"c{i}" for i in range(len(kept))]

    def scan(batches):
        for batch in batches:
            column = batch.column("own_text")
            x = np.array([statistics(column[i].as_py()) for i in range(len(column))], np.float64)
            own = [batch.column(n) for n in names]
            values = pa.array(x.reshape(-1, len(STATISTICS)).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*own, values], names=[*names, "statistics"])

    given = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)],
        text_bytes(F.col(f"`{text}`")).alias("own_text"),
    )
    schema = ", ".join(
        [*(f"{f.name} {f.dataType.simpleString()}" for f in given.schema[:-1]), "statistics array<double>"]
    )
    told = given.mapInArrow(scan, schema)
    return told.select(*[F.col(n).alias(c) for c, n in zip(kept, names, strict=True)], "statistics")


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def moments(rows):
    """Per class its rows, sums and sums of products: added up in every task first, then over tasks.

    Values are rounded to multiples of 1 / ONE row by row, so the sums are exact and no order of rows changes them.
    """
    d = len(STATISTICS)

    def scan(batches):
        total = np.zeros((2, 1 + d + d * d), np.int64)
        for batch in batches:
            x = batch.column("statistics").flatten().to_numpy().reshape(-1, d)
            y = batch.column("y").to_numpy()
            for k in (0, 1):
                of = x[y == k]
                total[k, 0] += len(of)
                total[k, 1 : 1 + d] += np.rint(of * ONE).astype(np.int64).sum(axis=0)
                products = np.rint(of[:, :, None] * of[:, None, :] * ONE).astype(np.int64)
                total[k, 1 + d :] += products.sum(axis=0).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(total.tolist(), pa.list_(pa.int64()))], names=["y", "m"]
        )

    part = rows.mapInArrow(scan, "y int, m array<bigint>")
    summed = part.select("y", F.posexplode("m").alias("at", "m")).groupBy("y", "at").agg(F.sum("m").alias("m"))
    sums = {k: np.zeros(1 + d + d * d) for k in (0, 1)}
    for r in summed.collect():  # two rows for each sum: a few hundred, whatever the input
        sums[r["y"]][r["at"]] = r["m"] if r["at"] == 0 else r["m"] / ONE
    return sums


def discriminants(sums, to_common=TO_COMMON, to_identity=TO_IDENTITY):
    """The model that follows from the moments of the classes."""
    d = len(STATISTICS)
    n = {k: sums[k][0] for k in (0, 1)}
    if not n[0] or not n[1]:  # one class only, or none: its share, whatever the text
        return QualityModel([None], [np.eye(1)], [(n[1] + 0.5) / (n[0] + n[1] + 1)])
    means, scatter = {}, {}
    for k in (0, 1):
        means[k] = sums[k][1 : 1 + d] / n[k]
        scatter[k] = sums[k][1 + d :].reshape(d, d) - n[k] * np.outer(means[k], means[k])
    common = (scatter[0] + scatter[1]) / (n[0] + n[1])
    level = max(np.trace(common) / d, 1e-6)
    factors = []
    for k in (0, 1):
        own = scatter[k] / n[k]
        weight = min(1.0, to_common + PRIOR_ROWS / (PRIOR_ROWS + n[k]))
        shrunk = (1 - weight) * own + weight * common
        factors.append(np.linalg.cholesky((1 - to_identity) * shrunk + to_identity * level * np.eye(d)))
    total = n[0] + n[1]
    return QualityModel([means[0], means[1]], factors, [np.log(n[0] / total), np.log(n[1] / total)])


def fit(described, labels, **shrinkage):
    """Fit on the labelled rows of `described` (see `describe`) that are not held out.

    Rows without an id and NULL labels teach nothing; an id with several labels counts as good if all of them are. Where
    only one class is known, the score is its share.
    """
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .filter("doc_id IS NOT NULL AND y IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("y").alias("y"))
        .filter(~held_out())
    )
    rows = described.select(F.col("doc_id").cast("bigint").alias("doc_id"), "statistics").join(known, "doc_id")
    return discriminants(moments(rows.select("y", "statistics")), **shrinkage)


def score(docs, labels):
    """All rows of `docs` with a ``score`` from 0 to 1, higher for better texts; NULL and empty texts too.

    Texts are read once: their statistics are written, the fit and the scores read those. Extra columns stay, columns
    named ``score`` or ``statistics`` are replaced. Ids that are NULL or repeat stay as they are.
    """
    described = stored(describe(docs), "statistics")
    return fit(described, labels).score(described)
