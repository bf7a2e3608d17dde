"""Personal data by weak supervision: labelers vote, EM weighs them, a trained classifier decides.

Spans of fixed patterns (email, ip, card, phone) are found as they are defined. Wider candidate patterns find what those miss:
spelled-out addresses, numbers without a country code, cards and addresses in other spellings, and secrets (long values
that are assigned to a name). Every candidate, a span of a fixed pattern too, gets votes (yes, no, or none) from regex,
gazetteer and context labelers. The votes of all candidates of the corpus are counted per kind and vote pattern, at most
729 a kind whatever the corpus; expectation-maximisation over these counts estimates how reliable each labeler is,
and how likely each pattern is personal data. On these probabilities a logistic classifier over span features is
trained, which settles every wider candidate; spans of the fixed patterns stay in any case.
"""

import math
import re
from bisect import bisect_right, insort
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import rows_of, stored, text_bytes

#: Kinds with a fixed pattern, and all kinds.
KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
CONTEXT = 24
THRESHOLD = 0.5
#: Distinct (votes, features) patterns on which the classifier is fitted at most; the commonest come first.
MAX_PATTERNS = 20_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: Wider patterns of candidates, per kind.
_WIDE = {
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    "secret": re.compile(r"(?<=[=:\"'\x20])[A-Za-z0-9+/_-]{16,}+(?![A-Za-z0-9])"),
}

#: What stands between the name and the host of a spelled-out address, and the host.
_WIDE_AT = re.compile(
    r"(?: ?[\[(] ?at ?[\])] ?| at |@ | @ ?)[A-Za-z0-9-]{1,63}(?:(?: ?[\[(] ?dot ?[\])] ?| dot |\.)[A-Za-z0-9-]{2,63}){1,4}"
)

#: What stands before a value that is assigned: a sign, at most two blanks and a quote.
_ASSIGNED = re.compile(r"[=:][ ]{0,2}[\"']?\Z")

#: Gazetteers, fixed values: words that stand beside personal data, and endings of host names.
_CUES = {
    "email": ("mail", "email", "e-mail", "contact", "write", "address", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "login", "client", "from"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "api-key", "auth", "bearer", "credential"),
}
_OPENINGS = ("ghp_", "gho_", "sk-", "sk_live_", "AKIA", "xox", "glpat-", "AIza")
_NO_SECRET = ("sha", "sha1", "sha256", "md5", "checksum", "digest", "commit", "hash", "etag", "uuid", "href", "src", "url", "path")
_AGAINST = ("version", "v", "order", "invoice", "isbn", "section", "chapter", "page", "id", "ref", "price", "total")
_ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "it", "info")

LABELERS = ("shape", "check", "gazetteer", "context", "against", "base_near")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s):
    return re.sub(r"[^0-9]", "", s)


def _emails(text):
    """Leftmost matches, found from each @ outwards: linear also on very long runs of letters."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text):
    """(kind, start, end) of the fixed patterns, by kind and start. Failing matches are dropped without a retry."""
    out = [("email", a, b) for a, b in _emails(text)]
    if any(c in text for c in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if p.lstrip("0") else "0") <= 255 for p in m.group().split(".")):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _wide(kind, text):
    if kind == "secret":
        for m in _WIDE[kind].finditer(text):
            if _ASSIGNED.search(text, max(0, m.start() - 4), m.start()):
                yield m.span()
        return
    if kind != "email":
        yield from (m.span() for m in _WIDE[kind].finditer(text))
        return
    end = 0
    for m in _WIDE_AT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, m.end()
        end = m.end()


def candidates(text, base):
    """(kind, start, end) of wider matches that overlap no span of the fixed patterns, nor an earlier candidate."""
    starts, ends = [], []  # of disjoint stretches that are taken, in order
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    out = []
    for kind in ALL_KINDS:
        for a, b in _wide(kind, text):
            i = bisect_right(ends, a)
            if i == len(ends) or starts[i] >= b:
                insort(starts, a)
                insort(ends, b)
                out.append((kind, a, b))
    return out


def _entropy(span):
    return -sum(n / len(span) * math.log2(n / len(span)) for n in Counter(span).values())


def votes_of(text, kind, a, b, base):
    """One vote per labeler: 1 for, -1 against, 0 none. `base` holds (start, end) of the fixed spans, sorted."""
    span = text[a:b]
    before = re.findall(r"\w+(?:-\w+)?", text[max(0, a - CONTEXT) : a].lower())
    after = re.findall(r"\w+", text[b : b + CONTEXT].lower())
    digits = _digits(span)
    if kind == "email":
        shape = 1 if re.search(r"[\[(]", span) else 0
        check = 1 if re.search(r"\d", span.split("at")[0]) else 0
        gazetteer = 1 if re.split(r"[^a-z0-9-]+", span.lower())[-1] in _ENDINGS else -1
    elif kind == "ip":
        shape = 1 if " " not in span else -1
        check = 1 if all(int(p) <= 255 for p in re.findall(r"\d+", span)) else -1
        gazetteer = 1 if digits.startswith(("10", "192", "172")) else 0
    elif kind == "card":
        shape = 1 if len(set(re.findall(r"[^0-9]", span))) < 2 else -1
        check = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[:1] in "3456" else -1
    elif kind == "secret":
        shape = 1 if digits and len(digits) < b - a else -1
        check = 1 if _entropy(span) >= 3 else -1
        gazetteer = 1 if span.startswith(_OPENINGS) or (b - a in (32, 40, 64) and re.fullmatch("[0-9a-fA-F]+", span)) else 0
    else:
        shape = 1 if span[0] == "+" or (len(digits) == 10 and digits[0] not in "01") else -1
        check = 1 if span[0] in "+(" else 0
        gazetteer = 1 if digits[3:6] == "555" else 0
    context = 1 if any(w in _CUES[kind] for w in before[-3:]) else 0
    doubts = _NO_SECRET if kind == "secret" else _AGAINST
    against = -1 if any(w in doubts for w in before[-1:] + after[:1]) else 0
    i = bisect_right(base, (a - 120, math.inf))  # starts of fixed spans, in order
    near = 1 if any((x, y) != (a, b) for x, y in base[i : i + 2] if x < b + 120) else 0
    return shape, check, gazetteer, context, against, near


def features_of(text, kind, a, b):
    """Small integer features of a span and its surroundings, on which the classifier is trained."""
    span = text[a:b]
    return (
        ALL_KINDS.index(kind),
        min(len(_digits(span)), 20),
        min((b - a) // 4, 12),
        int(a > 0 and text[a - 1] in " \n\t("),
        int(b < len(text) and text[b] in " \n\t).,;"),
        min(len(set(span) - _LOCAL), 6),
    )


def expectation_maximisation(votes, counts, rounds=50):
    """(probability of each vote pattern, accuracy of each labeler) of a model of independent labelers."""
    votes, counts = np.asarray(votes), np.asarray(counts, float)
    p = 1 / (1 + np.exp(-votes.sum(axis=1)))
    yes, no = np.full((votes.shape[1], 3), 1 / 3), np.full((votes.shape[1], 3), 1 / 3)
    prior = 0.5
    for _ in range(rounds):
        for j in range(votes.shape[1]):
            for v in (-1, 0, 1):
                at = votes[:, j] == v
                yes[j, v + 1] = ((counts * p)[at].sum() + 0.5) / ((counts * p).sum() + 1.5)
                no[j, v + 1] = ((counts * (1 - p))[at].sum() + 0.5) / ((counts * (1 - p)).sum() + 1.5)
        prior = min(max((counts * p).sum() / counts.sum(), 0.01), 0.99)
        j = np.arange(votes.shape[1])
        odds = np.log(prior / (1 - prior)) + (np.log(yes[j, votes + 1]) - np.log(no[j, votes + 1])).sum(axis=1)
        p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    return p, yes[:, 2] / (yes[:, 2] + no[:, 2])


def _expand(features):
    """Features as numbers around one, with a constant."""
    x = np.asarray(features, float)
    kinds = (x[:, :1] == np.arange(len(ALL_KINDS))).astype(float)
    return np.hstack([kinds, x[:, 1:] / np.array([10, 6, 1, 1, 3]), np.ones((len(x), 1))])


def train_classifier(votes, features, p, counts, steps=300, rate=0.5, decay=1e-3):
    """Weights of a logistic model on votes and features, fitted on probabilities."""
    x = np.hstack([np.asarray(votes, float), _expand(features)])
    w, weight = np.zeros(x.shape[1]), np.asarray(counts, float) / np.sum(counts)
    for _ in range(steps):
        w -= rate * (((1 / (1 + np.exp(-np.clip(x @ w, -40, 40))) - p) * weight) @ x + decay * w)
    return w


def classify(votes, features, w):
    x = np.hstack([np.asarray(votes, float), _expand(features)])
    return 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))


_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_WIDER = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("votes", pa.list_(pa.int32())), ("feats", pa.list_(pa.int32())),
         ("base", pa.bool_())]
    )
)


def _scan(batches):
    for batch in batches:
        bases, wider = [], []
        for (data,) in rows_of(batch, "text"):
            text = data.decode("utf-8", "replace")
            base = base_spans(text)
            bases.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
            places = sorted((a, b) for _, a, b in base)
            judged = [(*c, True) for c in base] + [(*c, False) for c in candidates(text, base)]
            wider.append(
                [
                    {"kind": k, "start": a, "end": b, "votes": votes_of(text, k, a, b, places), "feats": features_of(text, k, a, b),
                     "base": own}
                    for k, a, b, own in judged
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(bases, _SPAN), pa.array(wider, _WIDER)], names=["doc_id", "base", "wider"]
        )


def find(docs, threshold=THRESHOLD):
    """``doc_id, base, spans`` per row of `docs`: arrays of (kind, start, end) in code points, the end exclusive.

    `spans` holds all of `base` and the candidates that the classifier accepts, by kind and start. NULL and empty
    texts have none. Rows with NULL or repeated ids are rows of their own. Labelers and classifier are fitted on
    counts over all candidates of `docs`; without any candidate, nothing is added. Spans that are added overlap no other.
    Columns other than ``doc_id`` and ``text`` are not read.
    """
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text"))
    wider = "array<struct<kind:string,start:bigint,end:bigint,votes:array<int>,feats:array<int>,base:boolean>>"
    found = stored(given.mapInArrow(_scan, f"doc_id bigint, base {_SPANS}, wider {wider}"), "spans")
    judged = found.select(F.explode("wider").alias("c"))
    counted_votes = judged.groupBy("c.kind", "c.votes").count().orderBy("kind", "votes").collect()
    patterns = (
        judged.groupBy("c.kind", "c.votes", "c.feats")
        .count()
        .orderBy(F.desc("count"), "kind", "votes", "feats")
        .limit(MAX_PATTERNS)
        .collect()
    )
    order = {k: i for i, k in enumerate(ALL_KINDS)}
    if patterns:
        sure = {}
        for kind in ALL_KINDS:
            of_kind = [r for r in counted_votes if r.kind == kind]
            if of_kind:
                votes = [tuple(r.votes) for r in of_kind]
                p = expectation_maximisation(votes, np.array([r["count"] for r in of_kind]))[0]
                sure.update({(kind, v): x for v, x in zip(votes, p, strict=True)})
        votes = [tuple(r.votes) for r in patterns]
        p = np.array([sure[r.kind, v] for r, v in zip(patterns, votes, strict=True)])
        w = train_classifier(votes, [r.feats for r in patterns], p, np.array([r["count"] for r in patterns]))
    else:
        w = None

    @F.pandas_udf(_SPANS)
    def settle(base: pd.Series, wider: pd.Series) -> pd.Series:
        out = []
        for b, c in zip(base, wider, strict=True):
            spans = [(s["kind"], s["start"], s["end"]) for s in b]
            c = [s for s in c if not s["base"]]
            if w is not None and c:
                sure = classify([list(s["votes"]) for s in c], [list(s["feats"]) for s in c], w) >= threshold
                spans += [(s["kind"], s["start"], s["end"]) for s, ok in zip(c, sure, strict=True) if ok]
            spans.sort(key=lambda s: (order[s[0]], s[1], s[2]))
            out.append([{"kind": k, "start": x, "end": y} for k, x, y in spans])
        return pd.Series(out)

    return found.select("doc_id", "base", settle("base", "wider").alias("spans"))


def written(spans):
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def counted(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
