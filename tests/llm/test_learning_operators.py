"""Quality, hard negatives and token alignment against brute-force versions, with awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from jobsieve.llm import common, hard_negatives, quality, queries, token_align

DATA = "/root/testdata"
GOOD = "The %s of a river and the hills, where %d people live. They work in the town."
JUNK = "BUY!! NOW!! %s!! %d!! $$$ ### BUY!! NOW!! $$$ ###"


# Quality


def labelled(n=120):
    docs, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        word = chr(97 + i % 26) * (1 + i % 7)
        docs.append((i, ((GOOD if good else JUNK) % (word, i) + " ") * (1 + i % 4)))
        labels.append((i, int(good)))
    return docs, labels


def plain_scores(docs, labels):
    """Means and covariances of the training rows, densities by inverse and determinant."""
    y = dict(labels)
    x = {i: np.array(quality.statistics((t or "").encode())) for i, t in docs}
    train = [i for i in y if i in x and zlib.crc32(str(i).encode()) % 5]
    groups = [np.array([x[i] for i in train if y[i] == k]) for k in (0, 1)]
    common = sum(((g - g.mean(axis=0)).T @ (g - g.mean(axis=0)) for g in groups)) / len(train)
    level = np.trace(common) / common.shape[0]

    def log_density(v, g):
        own = np.cov(g.T, bias=True)
        w = min(1, quality.TO_COMMON + quality.PRIOR_ROWS / (quality.PRIOR_ROWS + len(g)))
        c = (1 - quality.TO_IDENTITY) * ((1 - w) * own + w * common) + quality.TO_IDENTITY * level * np.eye(len(v))
        d = v - g.mean(axis=0)
        return np.log(len(g) / len(train)) - 0.5 * (d @ np.linalg.inv(c) @ d + np.linalg.slogdet(c)[1])

    return {i: 1 / (1 + np.exp(np.clip(log_density(v, groups[0]) - log_density(v, groups[1]), -700, 700))) for i, v in x.items()}


def test_quality_is_the_discriminant_of_all_training_rows(spark):
    docs, labels = labelled()
    docs += [(900, None), (901, ""), (902, " \n\t "), (903, "x" * 300_000), (904, "a b " * 50_000)]
    found = quality.score(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id int, quality int")
    )
    want = plain_scores(docs, labels)
    got = {r.doc_id: r.score for r in found.collect()}
    assert got.keys() == want.keys()
    for i in got:
        assert 0 <= got[i] <= 1 and got[i] == pytest.approx(want[i], abs=1e-4)
    assert all((got[i] >= 0.3) == (y == 1) for i, y in labels)
    assert got[900] == got[901]


def test_quality_awkward_rows(spark):
    docs, labels = labelled()
    rows = [(i, t, "x", 7.0, i) for i, t in docs] + [(5, docs[5][1], "again", 1.0, 0), (None, "no id", None, None, 1)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, score string, statistics double, c0 int")
    known = spark.createDataFrame(
        [*labels, (3, None), (None, 1), (4, 7), (99_999, 0)], "doc_id bigint, quality int"
    )
    found = quality.score(given, known)
    assert found.columns == ["doc_id", "c0", "score"]
    assert found.count() == len(rows)
    same = [r.score for r in found.filter("doc_id = 5").collect()]
    assert len(same) == 2 and same[0] == same[1]
    nothing = quality.score(given.limit(0), known)
    assert nothing.count() == 0
    for only in ([], [(1, 1), (2, 1)]):
        flat = quality.score(given, spark.createDataFrame(only, "doc_id bigint, quality int"))
        assert flat.select("score").distinct().count() == 1


def test_quality_on_held_out_rows(spark):
    found = queries.QUERIES["op11_quality"](spark, f"{DATA}/sf0.01")
    labels = spark.read.parquet(f"{DATA}/sf0.01/labels.parquet")
    held = found.join(labels, "doc_id").filter("held_out")
    right = held.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("share"))
    assert all(r.share >= 0.95 for r in right.collect())


# Hard negatives

MINED = "anchor_id, positive_id, rank, negative_id, positive_score, negative_score"


def brute_mined(rows, anchor, positives=5, negatives=3, scale=256):
    whole = {}
    for i, v, y in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, str(r[1])), reverse=True):
        if i is not None and y is not None and v and all(x is not None and np.isfinite(x) for x in v):
            whole[i] = ([int(np.floor(x * scale)) for x in v], y)
    out = []
    for a, (v, y) in whole.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, z) for i, (w, z) in whole.items() if i != a)
        for p, i, _ in [s for s in scored if s[2] == y][:positives]:
            fit = [s for s in scored if s[2] != y and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out += [(a, i, r, j, -p, -n) for r, (n, j, _) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("dim", [2, 16])
def test_hard_negatives_against_brute_force(spark, dim):
    rng = np.random.default_rng(dim)
    rows = [(int(i), [float(x) for x in rng.standard_normal(dim)], int(rng.integers(4))) for i in range(700)]
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(60)]  # ties
    rows += [(2000 + k, [1.0] * dim, 9) for k in range(150)]  # one vector many times
    rows += [(1, None, 1), (None, rows[0][1], 1), (5000, rows[0][1], None), (5001, [float("nan")] * dim, 1)]
    rows += [(5002, [None] + [1.0] * (dim - 1), 1), (5010, [0.0] * dim, 1), (5011, [float("inf")] * dim, 1)]
    rows = [r for r in rows if r[0] != 1 or r[1] is not None]
    given = spark.createDataFrame(
        [(*r, "more") for r in rows], "vec_id bigint, embedding array<double>, label int, vector string"
    )
    found = hard_negatives.TreeIndex(given).mine(F.col("id") % 10 == 0)
    assert ", ".join(found.columns) == MINED
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute_mined(rows, lambda i: i % 10 == 0)
    assert got


def test_hard_negatives_of_few_or_no_rows(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    none = hard_negatives.TreeIndex(spark.createDataFrame([], schema)).mine(F.col("id") >= 0)
    assert none.count() == 0 and ", ".join(none.columns) == MINED
    alone = spark.createDataFrame([(0, [1.0, 0.0], 1)], schema)
    assert hard_negatives.TreeIndex(alone).mine(F.col("id") >= 0).count() == 0
    # Repeated rows of an id are one row; other lengths take no part.
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.75, 0.5], 2), (3, [1.0], 2)]
    index = hard_negatives.TreeIndex(spark.createDataFrame(rows, schema))
    got = sorted(tuple(r) for r in index.mine(F.col("id") == 0).collect())
    assert got == [(0, 1, 1, 2, 65536, 49152)]
    assert index.mine(F.col("id") == 77).count() == 0


def test_boxes_prune_without_losing_a_row():
    rng = np.random.default_rng(1)
    points = np.floor(256 * rng.standard_normal((4_000, 3)))
    labels = rng.integers(0, 3, 4_000)
    order = hard_negatives.str_order(labels, points, hard_negatives.LEAF)
    assert sorted(order.tolist()) == list(range(4_000))
    block = hard_negatives.Block(order.copy(), labels[order], points[order])
    ids = np.arange(0, 4_000, 100)
    best = hard_negatives.Best(len(ids), 1, 3)
    low, high = np.full((len(ids), 1), 1_000.0), np.full((len(ids), 1), 60_000.0)
    looked = []

    def take(w, q, r, scores):
        looked.append(len(q))
        best.add(w, q, block.ids[r], scores)

    block.search((ids, labels[ids], points[ids], False), low, high, best.kth, take)
    for k, a in enumerate(ids):
        scores = points @ points[a]
        fit = np.flatnonzero((labels != labels[a]) & (scores >= 1_000) & (scores <= 60_000))
        want = sorted(fit, key=lambda i: (-scores[i], i))[:3]
        assert best.ids[k, 0][: len(want)].tolist() == [int(i) for i in want]
    assert sum(looked) < 0.5 * len(ids) * len(points)


# Token alignment

TEXTS = [
    "plain words, and  two spaces; l'été naïve œuvre 日本語 text",
    "emoji 😀😃 👩‍👩‍👧 and \t tabs\nnew lines \r\n end  ",
    "<|endoftext|> <s>special</s> <unk> <0x41> strings",
    "   leading", " ", "  ", "\n", "x", "a\x1cb \x1c c\x85 d\xa0 e　 f", "",
    None, "a ▁ b", "ﬁ ligature ½ Å", "nul \x00 inside", "word " * 500, "z" * 3_000, "don't we'll I'M 12345 ???!!! ",
    "plain words, and  two spaces; l'été naïve œuvre 日本語 text",
]


def whole_alignment(aligner, text):
    """(a, b, groups, links) of a whole text, by decoded bytes and overlapping ranges alone."""
    if not text:
        return [], [], [], []
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    ranges = []
    for ids, decoded in ((a, aligner.a_bytes), (b, aligner.b_bytes)):
        if b"".join(decoded[i] for i in ids) != (" " + text).encode():
            return [], [], [], []
        ends = np.cumsum([len(decoded[i]) for i in ids]).tolist()
        ranges.append(list(zip([0, *ends], ends)))
    links = [(i, j) for i, (s, e) in enumerate(ranges[0]) for j, (u, v) in enumerate(ranges[1]) if s < v and u < e]
    both = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
    groups = [
        ([t for t, (_, e) in zip(a, ranges[0]) if low < e <= high], [t for t, (_, e) in zip(b, ranges[1]) if low < e <= high])
        for low, high in zip([0, *both], both)
    ]
    return a, b, groups, [(a[i], b[j]) for i, j in links]


def test_token_alignment_against_whole_texts(spark):
    aligner = token_align.Aligner()
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").limit(60).collect()]
    found = [whole_alignment(aligner, t) for t in texts]
    held = Counter(p for f in found for p in set(f[3]))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    want = []
    for i, (a, b, groups, links) in enumerate(found):
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(written.encode()).hexdigest() if a else ""
        n_best = sum(held[p] == top[p[0]] for p in links)
        want.append((i, len(a), len(b), len(groups), len(links), n_best, sum(held[p] for p in links), digest))
    given = spark.createDataFrame(
        [(i, t, "x", i) for i, t in enumerate(texts)], "doc_id bigint, text string, pairs string, part int"
    ).repartition(4)
    got = sorted(tuple(r) for r in token_align.report(given).collect())
    assert got == want
    assert sum(1 for w in want if w[1]) >= len(TEXTS) - 6 + 50

    by_group = {r.doc_id: r.groups for r in token_align.groups(given).collect()}
    for i, (_, _, groups, _) in enumerate(found):
        assert [(list(g["a"]), list(g["b"])) for g in by_group[i]] == groups
        if groups:
            assert sum(g["size"] for g in by_group[i]) == len((" " + texts[i]).encode())


def test_token_alignment_awkward_rows(spark):
    schema = "doc_id bigint, text string"
    assert token_align.report(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "one two"), (1, "one two"), (None, "one two"), (2, None), (None, "")]
    got = token_align.report(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5
    same = {tuple(r)[1:] for r in got if r.n_a}
    assert len(same) == 1
    one = next(r for r in got if r.n_a)
    assert one.count_sum == 3 * one.n_links and one.n_best == one.n_links
    assert {tuple(r)[1:] for r in got if not r.n_a} == {(0, 0, 0, 0, 0, 0, "")}
    only_empty = token_align.report(spark.createDataFrame([(7, None)], schema)).collect()
    assert [tuple(r) for r in only_empty] == [(7, 0, 0, 0, 0, 0, 0, "")]


def test_token_alignment_holds_few_parts_at_once(spark, monkeypatch):
    """Wide rows, files of many of them and lists collected by part filled the executors."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 12))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=500)).encode() for _ in range(token_align.PART_BYTES // 3500)]
    part = token_align._part(token_align.Aligner(), 0, list(range(len(texts))), texts)
    assert len(part) == 1 and part.nbytes < 700_000

    made = token_align.report(spark.createDataFrame([(1, "one two"), (2, None)], "doc_id bigint, text string"))
    plan = plan_of(made)
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan


def test_stored_rows_can_be_dealt_to_small_files(spark):
    held = common.stored(spark.range(10).coalesce(1), "few", rows=3)
    assert sorted(r[1] for r in held.groupBy("_metadata.file_path").count().collect()) == [1, 3, 3, 3]


def test_spans_that_do_not_hold_are_refined_by_bytes():
    def ends(lengths, spans):
        return token_align.byte_ends(np.array(lengths), *np.array(spans).T).tolist()

    assert ends([2, 1], [(0, 2), (2, 3)]) == [2, 3]
    assert ends([2, 2, 1], [(0, 4), (0, 4), (4, 5)]) == [2, 4, 5]
    assert ends([1, 1, 1], [(0, 0), (0, 0), (0, 3)]) == [1, 2, 3]
