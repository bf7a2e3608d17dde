"""Each corpus operator against a brute-force version, with awkward rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsieve.llm import (
    ann,
    components,
    decontaminate,
    html_main,
    license_scan,
    line_dedup,
    near_dedup,
    packing,
    pii,
    toxicity,
    warc,
)
from jobsieve.llm.queries import tokenizer

DOCS = "doc_id bigint, text string"
LINE = "this is a line of well over forty characters, number %d, indeed"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def line_key(line):
    key = line.strip(" \t\n\x0b\x0c\r")
    key = "".join(c.lower() if "A" <= c <= "Z" else c for c in key)
    return key if len(key) >= 40 else None


def brute_lines(docs):
    held = defaultdict(set)
    for i, text in docs:
        for line in (text or "").split("\n"):
            if i is not None and line_key(line):
                held[line_key(line)].add(i)
    out = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if i is None or not (k := line_key(x)) or len(held[k]) < 5 or i >= max(held[k])
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.fixture
def line_docs():
    docs = [(i, "\n".join([LINE % 1, f"own {i}", "  " + (LINE % 2).upper() + "\t"])) for i in range(7)]
    docs += [(10, None), (11, ""), (None, LINE % 1), (12, LINE % 3 + "\n" + LINE % 3), (12, LINE % 1), (13, "é" * 39)]
    docs += [(20 + i, LINE % 4) for i in range(4)] + [(30, "x" * 300_000 + "\n" + LINE % 4)]
    return docs


@pytest.mark.parametrize("filter_bytes", [line_dedup.FILTER_BYTES, 0])
def test_line_dedup(spark, tmp_path, line_docs, filter_bytes):
    df = spark.createDataFrame(line_docs, DOCS)
    state = line_dedup.LineState(spark, str(tmp_path / "s")).insert(df)
    assert rows(state.clean(df, filter_bytes)) == brute_lines(line_docs)


def test_line_dedup_is_reversible(spark, tmp_path, line_docs):
    first, second = line_docs[:9], line_docs[9:]
    one, two = spark.createDataFrame(first, DOCS), spark.createDataFrame(second, DOCS)
    state = line_dedup.LineState(spark, str(tmp_path / "s")).insert(one)
    before = rows(state.frequent())
    state.insert(two)
    assert rows(state.clean(one)) == [r for r in brute_lines(line_docs) if r in rows(state.clean(one))]
    state.delete(two)
    assert rows(state.frequent()) == before
    assert rows(state.clean(one)) == brute_lines(first)


def test_line_dedup_empty_and_clashing_columns(spark, tmp_path):
    empty = spark.createDataFrame([], DOCS)
    state = line_dedup.LineState(spark, str(tmp_path / "e")).insert(empty)
    assert state.clean(empty).count() == 0
    df = spark.createDataFrame([(1, "a", 5, 6)], "doc_id bigint, text string, k1 int, g1 int")
    assert rows(state.clean(df)) == [(1, "a", 5, 6, 1, 0)]


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = [tuple(map(int, k)) for k in rng.integers(-(2**62), 2**62, (2_000, 2))]
    filled = line_dedup._build(keys)
    assert all(filled.may_contain(*k) for k in keys)
    k1, k2 = np.array(keys).T
    assert filled.contains_all(k1, k2).all()
    assert all(filled.delete(*k) for k in keys[:1_000])
    assert all(filled.may_contain(*k) for k in keys[1_000:])
    assert sum(filled.may_contain(*k) for k in keys[:1_000]) < 20


def test_toxicity(spark):
    rng = np.random.default_rng(3)
    clean = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        words = list(rng.choice(clean, rng.integers(5, 200)))
        toxic = i % 8 == 0
        if toxic:
            words.insert(3, f"vilest{rng.integers(1000)}")
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs += [(5_000, None), (5_001, ""), (None, "vilest7"), (5_002, "vilest1 " * 50_000)]
    labels += [(None, 1), (5_000, None)]
    df = spark.createDataFrame(docs, DOCS)
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {r.doc_id: r.score for r in model.score(df).collect()}
    assert len(got) == len(docs)
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all((got[i] >= 0.3) == (i % 8 == 0) for i in held)
    assert got[5_000] == got[5_001] < 0.3 <= got[5_002] and got[None] >= 0.3
    nothing = toxicity.fit(df, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert max(r.score for r in nothing.score(df).collect()) < 0.3


def test_decontamination(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    bench = spark.createDataFrame(
        [(1, item), (1, item), (2, "Nur drei Wörter"), (3, None), (4, ""), (None, "no id here")], "item_id bigint, text string"
    )
    docs = [
        (1, f"x {item.upper()}! y"), (2, "nur, DREI wörter"), (3, None), (4, ""), (5, "nothing of it " * 5_000),
        (6, " ".join(item.split()[:12])), (7, "a " * 200 + item), (8, "no id here"), (None, item),
    ]
    df = spark.createDataFrame(docs, DOCS).withColumn("starts", F.lit(1))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.report(df, bench).collect()}
    assert got[1] == (17, 15, 1, True) and got[2] == (3, 3, 1, True)
    assert got[3] == got[4] == (0, 0, 0, False) and got[5][1:] == (0, 0, False) and got[6] == (12, 0, 0, False)
    assert got[7] == (215, 15, 1, True) and got[8] == (3, 3, 0, True) and got[None] == (15, 15, 1, True)
    spans = {r.doc_id: r.text for r in decontaminate.decontaminate(df, bench, "spans").collect()}
    assert re.findall(r"\w+", spans[1]) == ["x", "y"] and spans[3] is None
    assert decontaminate.decontaminate(df, bench).columns == ["doc_id", "text", "starts"]


def test_decontamination_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "c d")], DOCS)
    bench = spark.createDataFrame([(1, "b c"), (2, "d e"), (3, "c d")], "item_id bigint, text string")
    whole = rows(decontaminate.report(docs, bench).drop("hits"))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 1)
    assert rows(decontaminate.report(docs, bench).drop("hits")) == whole == [
        (1, "a b c d e f", 6, ["1", "2", "3"], 4, 3, True), (1, "c d", 2, ["3"], 2, 1, True)
    ]


def brute_near(docs, words, percent=80):
    sets = defaultdict(list)
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        n = min(words, len(w))
        sets[i].append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if w else set())
    ids = [i for i in sets if i is not None]
    root = {i: i for i in ids}
    changed = True
    links = [
        (a, b) for a in ids for b in ids if a < b
        and any(100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b] if x and y)
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return sorted(((i, len(s), root.get(i), root.get(i) == i) for i in sets for s in sets[i]), key=str)


@pytest.mark.parametrize("block", [2_000, 5])
def test_near_dedup(spark, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup._open_links, "__defaults__", (block,))
    rng = np.random.default_rng(5)
    base = [f"t{k}" for k in rng.integers(0, 500, 150)]
    docs = [(i, " ".join(f"u{k}" for k in rng.integers(0, 3_000, 40))) for i in range(20)]
    for i in range(40):  # a family of which some are near, some are not
        words = list(base)
        for k in rng.choice(150, rng.integers(0, 25), replace=False):
            words[k] = f"e{i}_{k}"
        docs.append((100 + i, " ".join(words)))
    docs += [(200 + i, "one and the same text") for i in range(5)]
    docs += [(300, None), (301, ""), (302, " \t\n"), (303, "Single"), (304, "single"), (305, "x " * 60_000)]
    docs += [(100, "another text under a known id"), (400, "another text under a known id"), (None, docs[0][1])]
    df = spark.createDataFrame(docs, DOCS).withColumn("key", F.lit(1))
    assert rows(near_dedup.link(df)) == sorted(
        ((i, n, c, k if i is not None else True) for i, n, c, k in brute_near(docs, 2)), key=str
    )
    kept = near_dedup.drop_copies(df, words=2)
    assert kept.columns == ["doc_id", "text", "key"]
    assert near_dedup.link(spark.createDataFrame([], DOCS)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (7, 7)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    assert all(got[i] == 0 for i in range(61)) and got[101] == got[103] == got[100] == 100


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 16)).round(3)
    x[50:80] = x[50]  # ties
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1_000, None), (1_001, [0.0] * 16), (1_002, [float("nan")] * 16), (1_003, [None] * 16), (None, [1.0] * 16), (1_004, [1.0])]
    df = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<double>").withColumn("list", F.lit(1))
    got = defaultdict(list)
    for r in ann.CodeIndex(df, list_rows=100).search(df.filter("vec_id % 20 = 0"), k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 400, 20))
    found = total = 0
    for q, near in got.items():
        best = sorted((-float(np.cumsum(x[q] * x[i])[-1]), i) for i in range(400) if i != q)[:5]
        total += 5
        found += len({i for i, _ in near} & {i for _, i in best})
        assert all(s == float(np.cumsum(x[q] * x[i])[-1]) for i, s in near)
    assert found >= 0.95 * total
    few = spark.createDataFrame(data[:3], "vec_id bigint, embedding array<double>")
    assert ann.CodeIndex(few).search(few).count() == 6
    none = spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    assert ann.CodeIndex(none).search(none).count() == 0


def test_decontamination_without_items_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, None), (None, "Größe 1")], DOCS)
    items = spark.createDataFrame([], "item_id string, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in decontaminate.report(docs, items).collect()}
    assert got == {(1, 4, 0, 0, False), (2, 0, 0, 0, False), (None, 2, 0, 0, False)}
    blank = spark.createDataFrame([("x", None), ("y", " ,")], "item_id string, text string")
    assert decontaminate.decontaminate(docs, blank).count() == 3
    some = spark.createDataFrame([("x", "a b c d")], "item_id string, text string")
    assert decontaminate.report(docs.limit(0), some).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    items = [(str(k), " ".join(f"w{k}x{j}" for j in range(20))) for k in range(12)]
    docs = spark.createDataFrame([(k, "start " + items[k][1] + " " + items[(k + 5) % 12][1]) for k in range(12)], DOCS)
    bench = spark.createDataFrame(items, "item_id string, text string")
    whole = rows(decontaminate.report(docs, bench).select("doc_id", "n_words", "n_hit", "items", "contaminated"))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 50)
    assert len(list(decontaminate._blocks(bench))) > 5
    assert rows(decontaminate.report(docs, bench).select("doc_id", "n_words", "n_hit", "items", "contaminated")) == whole


def test_nearest_neighbours_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK_ROWS", 16)
    x = np.random.default_rng(3).standard_normal((300, 8)).round(3)
    # The smallest id has an odd length.
    data = [(-1, [1.0, 2.0])] + [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    got = defaultdict(dict)
    for r in ann.CodeIndex(df, list_rows=100).search(df, k=3).collect():
        got[r.query_id][r.rank] = r.vec_id
    assert set(got) == set(range(300))
    want = {q: sorted((-float(np.cumsum(x[q] * x[i])[-1]), i) for i in range(300) if i != q)[:3] for q in got}
    assert sum(got[q][n + 1] == i for q in got for n, (_, i) in enumerate(want[q])) >= 0.95 * 900


def test_packing(spark):
    words = "hello, World. don't stop Größe señor x1 42 É.".split()
    rng = np.random.default_rng(4)
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(0, 400))))) for i in range(120)]
    docs += [(500, None), (501, ""), (None, "no id"), (502, "word " * 9_000), (0, docs[0][1]), (503, "<|endoftext|>")]
    df = spark.createDataFrame(docs, DOCS)
    got = packing.pack_documents(df, tokenizer(), length=512, group=50).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    want = Counter()
    for i, text in docs:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 512):
            part = ids[k : k + 512]
            want[i, k // 512, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    least = -(-sum(r.length for r in got) // 512)
    assert len(bins) <= least + 3
    assert packing.pack_documents(df.limit(0), tokenizer()).count() == 0


def test_local_search_empties_bins():
    lengths = np.array([6, 5, 5, 4, 4, 3, 3])
    bins = packing.improve([[0, 5], [1, 3], [2, 4], [6]], lengths, 10)
    assert sorted(i for b in bins for i in b) == list(range(7))
    assert all(lengths[b].sum() <= 10 for b in bins) and len(bins) == 3


@pytest.mark.parametrize("seed", range(3))
def test_local_search_misses_no_partner(seed):
    """After it, no exchange of one or two pieces for one fills any fuller bin more: many bins, bins of many pieces."""
    rng = np.random.default_rng(seed)
    lengths = np.concatenate([rng.integers(25, 70, 260), np.ones(90, int), np.full(70, 2)])
    length, places = 100, rng.permutation(np.arange(260)).tolist()
    bins = [[i] for i in places] + [list(range(260, 350)), list(range(350, 400)), list(range(400, 420))]
    before = sum(int(lengths[b].sum()) ** 2 for b in bins)
    bins = packing.improve(bins, lengths, length, passes=1000)
    fills = [int(lengths[b].sum()) for b in bins]
    assert sorted(i for b in bins for i in b) == list(range(420)) and max(fills) <= length
    assert sum(f * f for f in fills) > before
    for a, mine in enumerate(bins):
        gifts = {int(lengths[i]) for i in mine} | {int(lengths[i] + lengths[j]) for n, i in enumerate(mine) for j in mine[:n]}
        for b, other in enumerate(bins):
            if a != b and fills[a] <= fills[b] < length:
                assert not any(t < g <= t + length - fills[b] for t in {int(lengths[i]) for i in other} for g in gifts)


def test_license_scan(spark):
    mit = license_scan.NOTICES["MIT"].split()
    changed = [*mit[:25], "changed", *mit[26:]]
    docs = [
        (1, "foo bar " * 300 + " ".join(mit).upper() + " and so on" * 200), (2, "nothing here"), (3, None), (4, ""),
        (5, " ".join(mit[:20])), (6, "x y z " * 7 + " ".join(changed)), (None, license_scan.NOTICES["BSD"]),
    ]
    df = spark.createDataFrame(docs, DOCS).withColumn("template", F.lit("clash"))
    got = {(r.doc_id, r.template): r.containment for r in license_scan.scan(df).collect()}
    assert set(got) == {(1, "MIT"), (6, "MIT"), (None, "BSD")}
    assert got[1, "MIT"] == got[None, "BSD"] == 1 and 0.8 <= got[6, "MIT"] < 1
    assert license_scan.scan(df.limit(0)).count() == 0
    assert license_scan.scan(df, spark.createDataFrame([], "template string, text string")).count() == 0


def brute_licenses(docs, templates, default=0.8):
    """{(id, template): (containment, shingles of the longest such text)} over all stretches of twice a template's shingles."""
    out = {}
    split = [(i, re.findall(r"[^\W_]+", (text or "").lower())) for i, text in docs]
    for name, text, least in templates:
        want = re.findall(r"[^\W_]+", text.lower())
        k = min(5, len(want))
        runs = [tuple(want[i : i + k]) for i in range(len(want) - k + 1)]
        for doc, w in split:
            s = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
            for at in [i for i, x in enumerate(s) if x in set(runs)]:
                share = len(set(s[at : at + 2 * len(runs)]) & set(runs)) / len(set(runs))
                if share >= (least or default) - 1e-9:
                    out[doc, name] = max(out.get((doc, name), (0, 0)), (share, len(set(runs))))
    return out


def test_license_scan_of_short_notices(spark):
    lines = [
        "Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "// SPDX-License-Identifier: MIT",
    ]
    docs = [(i, f"some words first\n{t}\nand then more") for i, t in enumerate(lines)] + [(9, "MIT License, Apache License 2")]
    want = {(0, "Apache-2.0"), (1, "MIT"), (2, "CC-BY-NC-4.0"), (3, "GPL-3.0"), (4, "MIT")}
    got = license_scan.scan(spark.createDataFrame(docs, DOCS)).collect()
    assert {(r.doc_id, r.template) for r in got} == want and all(r.start >= 3 for r in got)


def test_license_scan_of_stretched_notices(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    templates = [(f"t{i}", " ".join(rng.choice(words, int(rng.integers(3, 60)))), None) for i in range(12)]
    templates.append(("same length", " ".join(rng.choice(words, 50)), None))
    docs = []
    for i in range(500):
        w = templates[i % len(templates)][1].split()
        if len(w) > 25 and i % 3:  # insert a block of other words, up to a stretch of twice the template
            at = len(w) // 2
            w[at:at] = ["x"] * int(rng.integers(0, len(w) - 4))
        docs.append((i, " ".join(["y"] * int(rng.integers(0, 90)) + w + ["z"] * int(rng.integers(0, 90)))))
    want = brute_licenses(docs, templates)
    df = spark.createDataFrame([t[:2] for t in templates], "template string, text string")
    got = license_scan.scan(spark.createDataFrame(docs, DOCS), df).collect()
    assert len(want) > 400
    found = {(r.doc_id, r.template): (r.containment, r.n_shingles) for r in got}
    assert all(want[k] == v for k, v in found.items()) and len(found) >= 0.995 * len(want)


def test_license_scan_is_that_of_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    templates = [tuple(r) for r in license_scan.default_templates(spark).collect()]
    near = docs.filter(F.lower("text").rlike("licen[sc]e|permission|redistribut|software|warrant|copyright"))
    want = brute_licenses([tuple(r) for r in near.collect()], templates)
    got = {(r.doc_id, r.template): (r.containment, r.n_shingles) for r in license_scan.scan(docs).collect()}
    assert len(want) >= 39 and got == want


def brute_personal(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m.group())
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_personal_data(spark):
    texts = [
        "a@b.c_d@e.f x@y @z.de q@@r.st é.mail@host-1.example.com.", "1.2.3.4.5.6.7.8 999.1.1.1 00255.0.0.1 1.2.3.x",
        "card 4556 7375-8689 9855 and 4111111111111111 4111111111111112 5", "+1 (555) 123-4567 +12 345 ++49.30.1234567-",
        "call (555) 123-4567 or write to me at host dot com", None, "", "9" * 50_000, "a" * 100_000 + "@", "+1" + "(" * 50_000,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[0])], DOCS)
    for r in pii.find(df).collect():
        text = texts[r.doc_id or 0] or ""
        base = [tuple(s) for s in r.base]
        assert base == brute_personal(text)
        assert set(base) <= {tuple(s) for s in r.spans}
        places = sorted((s.start, s.end) for s in r.spans if tuple(s) not in base)
        assert all(a < b <= len(text) for a, b in places)
    assert pii.find(df.limit(0)).count() == 0


def test_secrets_and_overlaps(spark):
    rng = random.Random(11)
    code = lambda: "".join(rng.choices("0123456789abcdef", k=40))
    secret = [f'la token = "{code()}" and on' for _ in range(40)] + [f"api_key: {code()}." for _ in range(20)]
    clean = [f'title = "{w * 3}" said' for w in ("international", "zzzzzzzz")] + ["a = b", f"see {code()} there", 'x = "' + "a" * 50_000 + '"']
    texts = secret + clean + ["call +49 30 1234567 or (555) 123-4567 (555) 123-4567", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("votes", F.lit("mine"))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(df).collect()}
    for i, text in enumerate(texts):
        found = [text[a:b] for k, a, b in got[i] if k == "secret"]
        assert found == ([re.search("[0-9a-f]{40}", text).group()] if i < len(secret) else [])
    assert [k for k, _, _ in got[len(secret) + len(clean)]].count("phone") == 3


def test_candidates_equal_brute_force():
    rng = random.Random(3)
    parts = ["555-123-4567 ", "+1 555 123 4567", " me at host dot com", "1.2.3.4 ", "1 . 2 . 3 . 4", "4556.7375.8689.9855 ", "key=", "abcdef0123456789abcd ", "a@b.de", " "]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=12))
        base = pii.base_spans(text)
        taken, want = [(a, b) for _, a, b in base], []
        for kind in pii.ALL_KINDS:
            for a, b in pii._wide(kind, text):
                if not any(x < b and a < y for x, y in taken):
                    taken.append((a, b))
                    want.append((kind, a, b))
        assert pii.candidates(text, base) == want


def page(i, body):
    return (
        f"<html><head><title>T{i}</title><script>var a='</p>';</script></head><body><header>Site</header><nav><ul><li><a href='/'>"
        f"Home</a></li></ul></nav><div class='cookie-notice'>We use cookies</div><div id='c'><p>Shared line of this site</p>{body}</div>"
        f"<div class='comments'><p>Nice! {i}</p></div><!-- x <p>no</p> --><footer>&copy; {i}</footer></body></html>"
    )


def test_main_text(spark):
    bodies = [f"<h1>Title {i}</h1><p>Some  text\n&amp; more{i} &eacute;" + "<p>again %d" % i * (i % 3) for i in range(8)]
    rows_ = [(i, "http://a.example.com/%d" % i, page(i, b)) for i, b in enumerate(bodies)]
    rows_ += [(100, None, None), (101, "http://b.example.com/", ""), (102, "x", "<" * 20_000), (None, "http://c.d/", "<p>plain")]
    df = spark.createDataFrame(rows_, "page_id bigint, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r.text for r in html_main.main_text(df).collect()}
    for i in range(8):
        want = [f"Title {i}", f"Some text & more{i} é"] + [f"again {i}"] * (i % 3)
        assert got[i] == "\n".join(want)
    assert got[100] == got[101] == "" and got[None] == "plain" and len(got) == len(rows_)


def test_tags_end_at_their_own_quotes():
    def texts(page):
        return [b[1] for b in html_main.blocks(page)]

    for tag in ("<img alt=\"Author's photo\">", "<a title=\"it's > that\">", "<a title='say \"x'>", "<p title=a'b>", "<p a'b>"):
        assert texts(f"<p>one</p>{tag}two it's <p>three") == ["one", "two it's", "three"]
        assert texts(f"<p>one</p>{tag}two{' long' * 20_000} <p>it's") == ["one", "two" + " long" * 20_000, "it's"]
    assert texts("<p title=\"main content hidden\">kept</p><p hidden>gone") == ["kept", "gone"]
    assert [b[3] for b in html_main.blocks("<p title=\"main content hidden\">kept</p><p hidden>gone")] == [False, True]
    assert texts("<!DOCTYPE html it's><p>one") == ["one"]


def test_raw_elements_end_where_they_must():
    def texts(page):
        return " ".join(b[1] for b in html_main.blocks(page))

    assert texts("<svg viewBox='0 0 1 1'/><p>one</p><math/><p>two</p><svg><text>no</text></svg><p>three") == "one two three"
    assert texts("<svg><path d='M0'><p>one</p><svg><text>no</text></svg><p>two") == "one two"
    options = "<datalist id=x><option value=a><option value=b>B</datalist>"
    assert texts(f"{options}<p>one</p><select><option>no</select><p>two</p><option>no</option>three") == "one two three"
    assert texts("<object data=x><p>one") == "one" and texts("<p>one<script>var a = '<p>no'") == "one"


def test_main_text_by_wrapper(spark):
    """No page has an article or a telling class: the wrapper of the host alone tells what is the text."""
    def one(i, own, first=""):
        return (
            f"<body>{first}<div class=top><p>Hosted by us</p></div><div class='w x9'><section class=zz><h1>T{i}</h1>{own}"
            f"</section></div><div class=low><p>Write to us today</p><p>or {'tomorrow' if i % 7 else 'never'}</p></div></body>"
        )

    rows_ = [(i, "http://h/%d" % i, one(i, f"<p>{'long text %d ' % i * 9}</p>" + "<ul><li>item</ul>" * (i % 2))) for i in range(40)]
    rows_ += [(100, "http://h/100", one(100, f"<p>{'late text ' * 9}</p>", "<script>" + "x" * 300_000 + "</script>"))]
    rows_ += [(200 + i, "http://h/c", one(0, f"<p>{'long text 0 ' * 9}</p>")) for i in range(60)]  # copies of one page
    inside = "<article><h2>In this series</h2><p>See part %d</p><ul><li><a href=/>See also</a></ul></article>"
    rows_ += [(300 + i, "http://s/%d" % i, "<body><p>Site line</p>" + inside % i + "</body>") for i in range(8)]
    rows_ += [(400, "http://deep/", "<div>" * 3_000 + "down here")]
    df = spark.createDataFrame(rows_, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_main.main_text(df).collect()}
    for i in range(40):
        assert got[i] == "\n".join([f"T{i}", ("long text %d " % i * 9).strip()] + ["item"] * (i % 2))
    assert got[100] == "T100\n" + ("late text " * 9).strip() and got[200] == got[0]
    assert all(got[300 + i] == f"In this series\nSee part {i}\nSee also" for i in range(8)) and got[400] == "down here"


def test_wrapper_is_union_free():
    pages = [f"<body><ul>{'<li>a%d</li>' % i * i}</ul>{'<div>x</div>' * (i % 2)}<p>b</p></body>" for i in range(1, 6)]
    learnt = html_main.infer(pages)
    assert learnt["pattern"] == "<body><ul>(<li>#</li>)+</ul>(<div>x</div>)?<p>b</p></body>"


def test_warc_derivatives(spark, tmp_path):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<title>T &amp; x</title><p>Hello <a href='/'>w</a>"), (2, None, None), (3, "http://b/", "")],
        "page_id bigint, url string, html string",
    )
    responses = warc.responses_of_pages(pages)
    made = warc.derive(responses).collect()
    ids = {r.warc["WARC-Record-ID"] for r in responses.collect()}
    assert len(ids) == 3 and {r.refers_to for r in made} == ids
    assert Counter(r.record_type for r in made) == {"metadata": 3, "conversion": 1}
    text = next(r for r in made if r.record_type == "conversion")
    assert text.block.decode() == "Hello w" and text.warc["warc-target-uri"] == "http://a/"
    assert all(r.warc["warc-block-digest"] == warc.digest(bytes(r.block)) for r in made)
    warc.write(warc.derive(responses), str(tmp_path / "w"))
    back = warc.read(spark, str(tmp_path / "w"))
    assert sorted((dict(r.warc)["warc-record-id"], bytes(r.block)) for r in back.collect()) == sorted(
        (r.record_id, bytes(r.block)) for r in made
    )
    none = spark.createDataFrame([(None, None)], "warc map<string,string>, block binary")
    assert warc.derive(none).count() == 0


def test_chunk_ids_are_those_of_the_tokenizer():
    """Parts and chunks joined give the same ids as whole texts, also past the bound of what is kept."""
    import numpy as np
    from tokenizers import Tokenizer

    from jobsieve.llm.packing import ChunkIds
    from jobsieve.llm.queries import tokenizer

    plain = Tokenizer.from_file(tokenizer())
    texts = [
        "", " ", "a'b,'c 's don't x<|endoftext|>y <|startoftext|> A<|b", "İı ſ ß Ŀ é ﬁ 12½ µm ª5 ×2 日本 ''..'' -'re",
        "n'T O'REILLY'S a\x00b \x1c q\x85r\xa0s Ω≠ a,́ x.́ (464) $$$ Straße!!, 3.14", "word, " * 3000,
    ]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for bound in (1_000_000, 3):
        known = ChunkIds(plain, bound)
        assert known.in_parts
        assert known.of([t.encode() for t in texts]) == want
        assert [known.of([t.encode()])[0] for t in texts] == want
