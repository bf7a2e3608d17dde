"""License scans with DataFrame operations only: MinHash bands retrieve templates, exact containment verifies them.

A template is found in a document if at least `CONTAINMENT` of its distinct five-word shingles stand in one stretch of
the document twice as long as the template; templates of fewer than five words are one shingle of their own width. Short
lines and identifiers ask for all of their shingles, as their last word is often the version. A template that is part
of another is found with it.

Such a stretch can begin at a shingle of the template. Documents are cut into windows that begin every quarter of the
template's length, one for each stretch start that counts, and hold every stretch that begins in their first quarter
as a whole. Of a window only shingles of templates of the same length are kept; `least_jaccard` is the similarity that
a window with a match has at least, and `bands` chooses so many bands of two minhashes that the two share one with a
chance of at least `RECALL`. Verification looks at every stretch that begins in the window's first quarter.

Documents are first compared with the set of all template shingles, inside the row, and then with what each template
needs; the work on windows grows with the license texts in a corpus.
"""

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

SHINGLE = 5
CONTAINMENT = 0.8
ROWS = 2
RECALL = 0.999
#: Words of all templates together: bounds what is held inside the row expressions and broadcast.
MAX_TEMPLATE_WORDS = 200_000

#: Well-known public license notices and identifiers.
NOTICES = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"
    ),
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


_CREATIVE = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
_GNU = {"GPL": ("General", "1 2 3"), "LGPL": ("Lesser General", "2.1 3"), "AGPL": ("Affero General", "3")}
#: Identifiers as the public license list writes them.
_IDENTIFIERS = (
    "MIT ISC Apache-2.0 BSD-2-Clause BSD-3-Clause 0BSD Zlib BSL-1.0 Unlicense MPL-2.0 EPL-1.0 EPL-2.0 CDDL-1.0 "
    "GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only "
    "LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later CC0-1.0 PostgreSQL Artistic-2.0"
).split()


def short_templates():
    """(name, text) of one-line notices and identifiers; they must stand in a document in full."""
    out = [
        ("MIT", f"{said} the MIT License") for said in ("Released under", "Licensed under", "Distributed under", "is licensed under")
    ]
    for said in ("Licensed", "Released", "Distributed"):
        out += [
            ("Apache-2.0", f"{said} under the Apache License, Version 2.0"),
            ("Apache-2.0", f"{said} under the Apache License 2.0"),
            ("BSD", f"{said} under the BSD License"),
            ("BSD-2-Clause", f"{said} under the BSD 2-Clause License"),
            ("BSD-3-Clause", f"{said} under the BSD 3-Clause License"),
            ("ISC", f"{said} under the ISC License"),
            ("MPL-2.0", f"{said} under the Mozilla Public License, version 2.0"),
            ("EPL-2.0", f"{said} under the Eclipse Public License, version 2.0"),
            ("Unlicense", f"{said} under the Unlicense"),
            ("BSL-1.0", f"{said} under the Boost Software License, Version 1.0"),
            ("CC0-1.0", f"{said} under CC0 1.0"),
        ]
        for kind in _CREATIVE:
            out += [(f"CC-{kind}-{v}", f"{said} under CC {kind} {v}") for v in ("1.0", "2.0", "2.5", "3.0", "4.0")]
    for name, (title, versions) in _GNU.items():
        for v in versions.split():
            full = v if "." in v else f"{v}.0"
            out += [
                (f"{name}-{full}", f"licensed under the GNU {title} Public License, version {v}"),
                (f"{name}-{full}", f"released under the GNU {title} Public License, version {v}"),
                (f"{name}-{full}", f"licensed under the GNU {title} Public License v{v}"),
            ]
    out += [(name, f"SPDX-License-Identifier: {name}") for name in _IDENTIFIERS]
    for kind, title in _CREATIVE.items():
        out += [(f"CC-{kind}-{v}", f"SPDX-License-Identifier: CC-{kind}-{v}") for v in ("1.0", "2.0", "2.5", "3.0", "4.0")]
        out += [
            (f"CC-{kind}-{v}", f"licensed under a Creative Commons {title} {v} {scope} License")
            for v, scope in (("4.0", "International"), ("3.0", "Unported"))
        ]
    return out


#: Further notices and texts of short licenses, of which parts may differ.
TEXTS = [
    (
        "MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "BSD",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
    ),
    (
        "ISC",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES",
    ),
    (
        "Zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
]


def least_jaccard(need, n, span, every):
    """Of a template of `n` distinct and `span` shingles and a window with `need` of them, of `every` that are kept."""
    return need / min(every, n + 2 * span + max(1, span // 4) - 1 - need)


def bands(jaccard, recall=RECALL, rows=ROWS):
    """Bands of `rows` minhashes, of which sets of this similarity share one with at least this chance."""
    return 1 if jaccard >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - jaccard**rows))


def default_templates(spark):
    rows = [(*r, None) for r in [*sorted(NOTICES.items()), *TEXTS]] + [(*r, 1.0) for r in short_templates()]
    return spark.createDataFrame(rows, "template string, text string, containment double")


def words(text):
    """Lower-cased runs of letters and digits; NULL has none."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.filter(F.split(F.trim(spaced), " "), lambda w: w != "")


def shingles(tokens, width=SHINGLE):
    """A hash of every run of `width` words, in order; of fewer words, nothing."""
    n = F.size(tokens)
    runs = F.transform(
        F.sequence(F.lit(0), n - width),
        lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(width)]),
    )
    return F.when(n >= width, runs).otherwise(F.array().cast("array<bigint>"))


def _minhash(values, k):
    return F.array_min(F.transform(values, lambda s: F.xxhash64(s, k)))


def _band_keys(values, n_bands):
    """One key per band over a set of shingles."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_bands - 1)),
        lambda b: F.xxhash64(b, *[_minhash(values, b * ROWS + r) for r in range(ROWS)]),
    )


def template_sets(templates, containment=CONTAINMENT):
    """``template, shingles (distinct), n, span, width, need`` of each template: repeated names are templates of their own
    text. A column ``containment`` of `templates`, where not NULL, goes before the parameter.

    Templates without words or without a name find nothing.
    """
    own = F.col("containment").cast("double") if "containment" in templates.columns else F.lit(None).cast("double")
    t = templates.select(F.col("template").cast("string").alias("template"), words(F.col("text")).alias("w"), own.alias("own"))
    t = t.filter("template IS NOT NULL AND size(w) > 0")
    t = t.withColumn("width", F.least(F.lit(SHINGLE), F.size("w")))
    all_ = F.coalesce(*[F.when(F.col("width") == k, shingles(F.col("w"), k)) for k in range(1, SHINGLE + 1)])
    t = t.select("template", all_.alias("all"), "width", F.coalesce("own", F.lit(float(containment))).alias("own"))
    t = t.select("template", F.array_distinct("all").alias("shingles"), F.size("all").alias("span"), "width", "own")
    t = t.withColumn("n", F.size("shingles"))
    # Rounded first: 0.8 x 35 is a little more than 28 in floating point.
    need = F.greatest(F.lit(1), F.ceil(F.round(F.col("own") * F.col("n"), 6)).cast("int"))
    return t.withColumn("need", need).drop("own").distinct()


def scan(docs, templates=None, containment=CONTAINMENT):
    """``doc_id, template, start, n_words, matched, n_shingles, containment``: the best place of each template found.

    `docs` has ``doc_id`` and ``text``; rows that share an id give the best of their places, rows without an id are
    one such document with a NULL id. ``start`` is the word at which the best stretch begins, ``n_words`` its length up
    to the last shingle of the template; of equal containment the longest text of that name counts, then the first place.
    A document without words finds nothing.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, template string, start int, n_words int, matched int, n_shingles int, containment double"
    sets = template_sets(templates if templates is not None else default_templates(spark), containment)
    sets = stored(sets.withColumn("text_id", F.monotonically_increasing_id()), "license-templates")
    total, every, least = sets.agg(
        F.sum("span"), F.array_distinct(F.flatten(F.collect_list("shingles"))), F.min("need")
    ).first()
    if not total:
        return spark.createDataFrame([], schema)
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"scan for templates of at most {MAX_TEMPLATE_WORDS} words at a time")
    # One row per length of templates; all of this is bounded by MAX_TEMPLATE_WORDS, checked above.
    lengths = sets.groupBy("width", "span").agg(F.array_distinct(F.flatten(F.collect_list("shingles"))).alias("kept"))
    sizes = sets.join(lengths.select("width", "span", F.size("kept").alias("every")), ["width", "span"])
    sizes = sizes.select("need", "n", "span", "every", "width").distinct().collect()
    n_bands = max(bands(least_jaccard(r.need, r.n, r.span, r.every)) for r in sizes)
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), words(F.col("text")).alias("w"))
    by_width = F.array(
        *[F.struct(F.lit(k).alias("width"), shingles(F.col("w"), k).alias("s")) for k in sorted({r.width for r in sizes})]
    )
    known = F.lit(sorted(every)).cast("array<bigint>")
    hits = F.transform(
        by_width, lambda x: F.struct(x["width"].alias("width"), x["s"].alias("s"), F.array_intersect(x["s"], known).alias("hit"))
    )
    # Through the generator, so that the filter is not pushed into the expressions and worked out for every element.
    found = found.select("doc_id", F.explode_outer(hits).alias("x")).filter(F.size("x.hit") >= least)
    found = found.select("doc_id", "x.width", "x.s", "x.hit", F.monotonically_increasing_id().alias("row"))
    # Written once: what follows must not work out the shingles again.
    marked = stored(found, "license-documents")
    owners = sets.select("width", "text_id", "span", "need", F.explode("shingles").alias("h"))
    wanted = (
        marked.select("row", "width", F.explode("hit").alias("h"))
        .join(F.broadcast(owners), ["width", "h"])
        .groupBy("row", "width", "text_id", "span", "need")
        .count()
        .filter("count >= need")
        .select("row", "width", "span")
        .distinct()
    )
    step = F.greatest(F.lit(1), F.floor(F.col("span") / 4).cast("int"))
    # Windows that hold a shingle of a template in their first quarter.
    starts = F.array_distinct(
        F.filter(
            F.transform("s", lambda x, i: F.when(F.array_contains("own", x), F.floor(i / F.col("step")).cast("int") * F.col("step"))),
            lambda i: i.isNotNull(),
        )
    )
    windows = (
        marked.join(wanted, ["row", "width"])
        .join(F.broadcast(lengths), ["width", "span"])
        .withColumn("own", F.array_intersect("hit", "kept"))
        .withColumn("step", step)
        .select("*", F.explode_outer(starts).alias("start"))
        .select(
            "row", "doc_id", "width", "span", "step", "start", "own",
            F.slice("s", F.col("start") + 1, 2 * F.col("span") + F.col("step") - 1).alias("win"),
        )
    )
    windows = windows.withColumn("win_set", F.array_intersect("win", "own")).drop("own")
    windows = stored(windows, "license-windows")
    keyed = windows.select(
        "row", "doc_id", "width", "span", "step", "start", "win", F.explode_outer(_band_keys(F.col("win_set"), n_bands)).alias("key")
    )
    targets = sets.select("*", F.explode_outer(_band_keys(F.col("shingles"), n_bands)).alias("key"))
    retrieved = keyed.join(F.broadcast(targets.select("text_id", "width", "span", "key")), ["width", "span", "key"])
    # A window meets a template once, however many bands they share.
    retrieved = retrieved.groupBy("row", "text_id", "start").agg(
        F.first("doc_id").alias("doc_id"), F.first("step").alias("step"), F.first("win").alias("win")
    )
    matched = F.transform(
        F.sequence(F.lit(0), F.least(F.col("step"), F.size("win")) - 1),
        lambda i: F.struct(
            F.when(
                F.array_contains("shingles", F.get("win", i)),
                F.size(F.array_intersect("shingles", F.slice("win", i + 1, 2 * F.col("span")))),
            ).alias("matched"),
            (-i).alias("before"),
        ),
    )
    verified = (
        retrieved.join(F.broadcast(sets), "text_id")
        .select("*", F.explode_outer(F.array(F.array_max(matched))).alias("best"))
        .withColumn("matched", F.col("best.matched"))
        .filter(F.col("matched") >= F.col("need"))
        .withColumn("inside", -F.col("best.before"))
    )
    best = Window.partitionBy("doc_id", "template").orderBy(
        F.desc(F.col("matched") / F.col("n")), F.desc("n"), F.col("start") + F.col("inside"), "row", "text_id"
    )
    stretch = F.slice("win", F.col("inside") + 1, 2 * F.col("span"))
    last = F.array_max(F.transform(stretch, lambda x, i: F.when(F.array_contains("shingles", x), i)))
    return (
        verified.withColumn("place", F.row_number().over(best))
        .filter("place = 1")
        .select(
            "doc_id",
            "template",
            (F.col("start") + F.col("inside")).cast("int").alias("start"),
            (last + F.col("width")).cast("int").alias("n_words"),
            F.col("matched").cast("int").alias("matched"),
            F.col("n").cast("int").alias("n_shingles"),
            (F.col("matched") / F.col("n")).alias("containment"),
        )
    )
