"""Main text of web pages by wrappers that are inferred per host.

A page becomes a tree of its structural elements. All distinct structures of a host are aligned, a bounded number at a
time: equal elements are merged, neighbours of the same kind become a repeated group, and what only some pages have
becomes optional. The result is a union-free regular expression over tags, the wrapper of the host. Texts that stand
at the same path on at least half of the host's distinct pages are its literals, all others its slots; the part that
holds most text is where articles stand.

Every page is matched against the wrapper of its host. The text of what matches inside the article's part is the
article, without literals and lists of links; inside an element that is named an article, nothing is left out. Fixed
rules (article, main, names of classes) serve pages whose host has fewer than `MIN_PAGES` distinct ones, and pages of
which no text matches there.
"""

import html
import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import batch_of, key128, rows_of, stored, text_bytes

#: Structures that are aligned by one task at a time, and the share of a host's pages that makes a text a literal.
MERGE_ROWS = 64
SITE_SHARE = 0.5
#: Elements below this depth are aligned as if they stood at it; their texts count and are kept like all others.
DEPTH = 100
#: Distinct pages that must agree on a text before it counts as part of the site.
MIN_PAGES = 4

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr label".split()
)
_RAW = frozenset("script style noscript template textarea title svg math iframe object select option canvas".split())
_SITE = frozenset("nav header footer aside form menu dialog button head fieldset".split())
#: Names of parts that are not the article, as whole words of class, id and role.
_SITE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer cookie cookies consent notice notices newsletter subscribe "
    "subscription popup modal overlay share sharing social related recommended comment comments reply replies respond "
    "disqus discussion widget toolbar pagination pager login signup search skip alert gdpr privacy".split()
)
_ARTICLE_WORDS = frozenset("article content post entry story main body".split())
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
_SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}

_NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9:-]*)")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
#: The rest of a tag after its name: a quote opens a value only right after =, and only the same quote ends it.
_TAG_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+|(?=>)))*+>""")
_UNQUOTED_SLASH = re.compile(r"""=\s*[^\s"'>]*/>$""")
#: Elements that cannot stand in svg or math: they end one that is not closed.
_BREAKOUT = (
    "article|blockquote|body|br|center|div|dl|dd|dt|em|h[1-6]|head|hr|img|li|main|menu|nav|ol|p|pre|section|small|span|strong|"
    "table|ul"
)
_FOREIGN_END = re.compile(rf"<(?:{_BREAKOUT})(?=[\s/>])|</(?:body|html|main|article|section|div|p)\s*>", re.I)
_ANY_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9:-]*)")
#: Raw elements whose text runs to the end of the page if they are not closed.
_RAW_TEXT = frozenset("script style textarea title iframe".split())
_DIGIT = re.compile(r"\d")
_SPACES = re.compile(r"\s+")


def _tag_end(page, at):
    """Index after the > of a tag, from the end of its name; a value without its end quote ends at the first >."""
    if m := _TAG_REST.match(page, at):
        return m.end()
    plain = page.find(">", at)
    return plain + 1 if plain >= 0 else len(page)


def _raw_end(page, name, tag, end):
    """Index after a raw element whose start tag ends at `end`; `end` itself if it has no content of its own."""
    if name in ("svg", "math") and tag.endswith("/>") and not _UNQUOTED_SLASH.search(tag):
        return end
    if name == "option":
        # Ends with its own end tag, or before the next tag that cannot be in it.
        for m in _ANY_TAG.finditer(page, end):
            if m.group(1).lower() not in _INLINE:
                own = m.group().lower() == "</option"
                return _tag_end(page, m.end()) if own else m.start()
        return len(page)
    close = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, end)
    if name in ("svg", "math"):
        out = _FOREIGN_END.search(page, end, close.start() if close else len(page))
        if out and not re.search(r"<(?:foreignobject|desc|title|annotation-xml|m[ions]|mtext)\b", page[end : out.start()], re.I):
            return out.start()
    if close:
        return close.end()
    return len(page) if name in _RAW_TEXT else end


def tokens(page):
    """('text', text) / ('open', name, attributes) / ('close', name); comments and raw elements are left out."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:]
            return
        if lt > at:
            yield "text", page[at:lt]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = end + 3 if end >= 0 else n
        elif page[lt + 1 : lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = end + 1 if end >= 0 else n
        elif m := _NAME.match(page, lt + 1):
            end, name = _tag_end(page, m.end()), m.group(1).lower()
            tag, at = page[m.end() : end], end
            if page[lt + 1] == "/":
                yield "close", name
                continue
            if name in _RAW:
                at = _raw_end(page, name, tag, end)
                continue
            yield "open", name, tag
        else:
            yield "text", "<"
            at = lt + 1


def _names(tag):
    """(class and id words, whether it is hidden)."""
    words, hidden = [], False
    for m in _ATTRIBUTE.finditer(tag):
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'").lower()
        if name in ("hidden", "aria-hidden"):
            hidden |= value != "false"
        elif name in ("class", "id", "role"):
            words += value.split()
    return words, hidden


def _is_site(name, words, hidden):
    if name in _SITE or hidden:
        return True
    parts = {p for w in words for p in re.split(r"[-_]+", w)}
    return bool(parts & _SITE_WORDS) and name not in ("article", "main", "body", "html")


def blocks(page):
    """(path, text, characters in links, site) of each block in page order; `path` are the keys of open elements."""
    stack, out, buffer, link_chars, in_link = [], [], [], 0, 0

    def flush():
        nonlocal buffer, link_chars
        text = _SPACES.sub(" ", html.unescape("".join(buffer))).strip()
        if text:
            out.append((tuple(k for _, k, _ in stack), text, link_chars, any(s for *_, s in stack)))
        buffer, link_chars = [], 0

    for token in tokens(page):
        if token[0] == "text":
            buffer.append(token[1])
            if in_link:
                link_chars += len(token[1].strip())
        elif token[0] == "open":
            name = token[1]
            if name in _INLINE:
                if name == "br":
                    buffer.append(" ")
                elif name == "a":
                    in_link += 1
                continue
            flush()
            if name in _VOID:
                continue
            if name in _CLOSES_P and stack and stack[-1][0] == "p":
                stack.pop()
            if name in _SAME and stack and stack[-1][0] in _SAME[name].split():
                stack.pop()
            words, hidden = _names(token[2])
            key = ".".join([name, *sorted({w for w in words if not _DIGIT.search(w)})])
            stack.append((name, key, _is_site(name, words, hidden)))
        else:
            name = token[1]
            if name in _INLINE:
                if name == "a":
                    in_link = max(0, in_link - 1)
                continue
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
    flush()
    return out


class Node:
    """An element of a wrapper, or a text (`key` is '#'); `text` is its literal, None a slot."""

    def __init__(self, key, text=None):
        self.key, self.text, self.children = key, text, []
        self.optional = self.repeated = False


def tree(page_blocks):
    """The structure of a page, neighbours of one kind folded into repeated groups."""
    root = Node("")
    open_nodes = [root]
    path = ()
    for own, text, _, _ in page_blocks:
        own = own[:DEPTH]
        same = 0
        while same < min(len(path), len(own) - 1) and path[same] == own[same]:
            same += 1
        del open_nodes[same + 1 :]
        for key in own[same:]:
            node = Node(key)
            open_nodes[-1].children.append(node)
            open_nodes.append(node)
        open_nodes[-1].children.append(Node("#", text))
        path = own
    return _folded(root)


def _folded(node):
    out = []
    for child in map(_folded, node.children):
        if out and out[-1].key == child.key:
            out[-1] = merge(out[-1], child)
            out[-1].repeated = True
        else:
            out.append(child)
    node.children = out
    return node


def merge(a, b):
    """The least union-free expression that covers both."""
    out = Node(a.key, a.text if a.text == b.text else None)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    x, y = a.children, b.children
    if [c.key for c in x] == [c.key for c in y]:
        out.children = [merge(c, d) for c, d in zip(x, y, strict=True)]
        return _refold(out)
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below, key = best[i], best[i + 1], x[i].key
        for j in range(len(y) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if key == y[j].key else max(below[j], row[j + 1])
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i].key == y[j].key:
            out.children.append(merge(x[i], y[j]))
            i, j = i + 1, j + 1
            continue
        left = j >= len(y) or i < len(x) and best[i + 1][j] >= best[i][j + 1]
        child = x[i] if left else y[j]
        child.optional = True
        out.children.append(child)
        i, j = i + left, j + (not left)
    return _refold(out)


def _refold(node):
    """Optional neighbours of one kind are one repeated group."""
    out = []
    for child in node.children:
        if out and out[-1].key == child.key:
            optional = out[-1].optional and child.optional
            out[-1] = merge(out[-1], child)
            out[-1].repeated, out[-1].optional = True, optional
        else:
            out.append(child)
    node.children = out
    return node


def pattern(node):
    """The wrapper as an expression: (...)+ repeats, (...)? is optional, # is a slot."""
    if node.key == "#":
        body = "#" if node.text is None else re.escape(node.text)
    else:
        inside = "".join(map(pattern, node.children))
        body = f"<{node.key}>{inside}</{node.key}>" if node.key else inside
    if node.repeated or node.optional:
        body = f"({body})" + ("*" if node.repeated and node.optional else "+" if node.repeated else "?")
    return body


def _content(weight, total):
    """The innermost container with most of the text, or the article around it; single paragraphs are no containers."""
    named = [
        p for p, w in weight.items()
        if w >= 0.6 * total and p and p[-1].split(".")[0] in ("div", "section", "main", "article", "td", "body")
    ]
    path = max(named, key=len, default=())
    around = [k for k in range(len(path)) if path[k].split(".")[0] == "article"]
    return path[: around[0] + 1] if around else path


def weights(found):
    """{path: characters outside links below it} of the blocks of a page that do not belong to the site."""
    weight = {}
    for path, text, link, site in found:
        if not site:
            for k in range(min(len(path), DEPTH) + 1):
                weight[path[:k]] = weight.get(path[:k], 0) + max(0, len(text) - 2 * link)
    return weight


def distinct_key(found):
    """What two copies of a page have in common."""
    return key128(json.dumps([(p, t) for p, t, _, site in found if not site]).encode())


def place_key(path, text):
    """64 bits of a text and where it stands."""
    return key128(json.dumps([path, text]).encode())[0]


def packed_tree(node):
    """A tree as nested lists, without texts."""
    flags = node.optional + 2 * node.repeated
    return [node.key, flags, [packed_tree(c) for c in node.children]]


def unpacked_tree(data):
    node = Node(data[0])
    node.optional, node.repeated = bool(data[1] & 1), bool(data[1] & 2)
    node.children = [unpacked_tree(c) for c in data[2]]
    return node


def infer(pages):
    """``{"tree", "literals" (their `place_key`), "content" (a path), "pages", "pattern"}`` of the pages of one host."""
    seen, wrapper, weight, places = set(), None, {}, {}
    for page in pages:
        found = blocks(page)
        key = distinct_key(found)
        if not found or key in seen:
            continue
        seen.add(key)
        mine = tree(found)
        wrapper = mine if wrapper is None else merge(wrapper, mine)
        for path, w in weights(found).items():
            weight[path] = weight.get(path, 0) + w
        for place in {place_key(p, t) for p, t, _, site in found if not site}:
            places[place] = places.get(place, 0) + 1
    enough = max(MIN_PAGES, SITE_SHARE * len(seen))
    return {
        "tree": packed_tree(wrapper) if wrapper is not None else None,
        "literals": [place for place, n in places.items() if n >= enough],
        "content": list(_content(weight, weight.get((), 0))),
        "pages": len(seen),
        "pattern": pattern(wrapper) if wrapper is not None else "",
    }


def matched(found, wrapper):
    """Whether each block of a page stands at a text of the wrapper, element by element in the order of the expression."""
    out, path = [], ()
    # Per open element: its node in the wrapper (None: none) and the place of its last child among the node's.
    open_nodes = [[wrapper, 0]]

    def step(key):
        node, at = open_nodes[-1]
        children = node.children if node is not None else ()
        for i in range(at, len(children)):
            if children[i].key == key:
                open_nodes[-1][1] = i if children[i].repeated else i + 1
                return children[i]
        return None

    for own, _, _, _ in found:
        own = own[:DEPTH]
        same = 0
        while same < min(len(path), len(own) - 1) and path[same] == own[same]:
            same += 1
        del open_nodes[same + 1 :]
        for key in own[same:]:
            open_nodes.append([step(key), 0])
        out.append(step("#") is not None)
        path = own
    return out


def _inside(path, content):
    """Whether a path lies in the article's part, or in another article beside it, whatever its class."""
    if path[: len(content)] == content:
        return True
    n = len(content) - 1
    beside = n >= 0 and content[n].split(".")[0] == "article" and len(path) > n and path[:n] == content[:n]
    return beside and path[n].split(".")[0] == "article"


def _is_article(path):
    return any(k.split(".")[0] == "article" or _ARTICLE_WORDS & set(re.split(r"[-_.]+", k)[1:]) for k in path)


def by_rules(found):
    """The blocks that fixed rules take for the article: those in article, else in main, else below a telling name."""

    def named(tag):
        return [b for b in found if any(k.split(".")[0] == tag for k in b[0])]

    return named("article") or named("main") or [b for b in found if _is_article(b[0])] or found


def extract(page, wrapper=None):
    """The blocks of the article, one per line."""
    every = blocks(page)
    found = [b for b in every if not b[3]]
    literal, kept = (), []
    if wrapper and wrapper["tree"] is not None and wrapper["pages"] >= MIN_PAGES:
        literal, content = wrapper["literals"], tuple(wrapper["content"])
        known = wrapper["tree"] if isinstance(wrapper["tree"], Node) else unpacked_tree(wrapper["tree"])
        part = [(b, ok) for b, ok in zip(every, matched(every, known), strict=True) if not b[3] and _inside(b[0], content)]
        # What stands in the article's part in an order that the greedy match does not follow is text all the same.
        kept = [b for b, _ in part] if any(ok for _, ok in part) else []
        if not any(k.split(".")[0] == "article" for k in content):
            kept = [b for b in kept if any(k.split(".")[0] == "article" for k in b[0])] or kept
    lines = [
        text for path, text, link, _ in kept or by_rules(found)
        if _is_article(path)
        or not (literal and place_key(path, text) in literal) and not (link >= 0.9 * len(text) and _in_list(path))
    ]
    return "\n".join(lines)


def _in_list(path):
    return any(k.split(".")[0] in ("ul", "ol", "dl") for k in path)


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))


_PARSED = (
    "host string, k1 bigint, k2 bigint, tree string, places array<bigint>, "
    "weights array<struct<path:string,w:bigint>>"
)


def _parse(batches):
    schema = pa.schema(
        [
            ("host", pa.string()),
            ("k1", pa.int64()),
            ("k2", pa.int64()),
            ("tree", pa.string()),
            ("places", pa.list_(pa.int64())),
            ("weights", pa.list_(pa.struct([("path", pa.string()), ("w", pa.int64())]))),
        ]
    )
    for batch in batches:
        out = []
        for host, data in rows_of(batch, "host", "html"):
            found = blocks(data.decode("utf-8", "replace"))
            if found:
                out.append(
                    (
                        host,
                        *distinct_key(found),
                        json.dumps(packed_tree(tree(found))),
                        sorted({place_key(p, text) for p, text, _, site in found if not site}),
                        [{"path": json.dumps(p), "w": w} for p, w in weights(found).items()],
                    )
                )
        if out:
            yield batch_of(list(zip(*out, strict=True)), schema)


def wrappers(pages):
    """(host, wrapper as JSON) from all distinct pages of each host; URLs without a host share one."""
    rows = pages.select(_host(F.col("url")).alias("host"), text_bytes("html").alias("html")).filter(F.length("html") > 0)
    parsed = stored(rows.mapInArrow(_parse, _PARSED).dropDuplicates(["host", "k1", "k2"]), "distinct-pages")
    sizes = parsed.groupBy("host").agg(F.count("*").alias("pages"))
    places = parsed.select("host", F.explode("places").alias("x")).groupBy("host", "x").agg(F.count("*").alias("n"))
    # Each text that is kept stands on half of the pages: no more than twice those of an average page.
    literals = (
        places.filter(F.col("n") >= MIN_PAGES)
        .join(sizes, "host")
        .filter(F.col("n") >= SITE_SHARE * F.col("pages"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("x")).alias("literals"))
    )
    held = parsed.select("host", F.explode("weights").alias("x")).groupBy("host", "x.path").agg(F.sum("x.w").alias("w"))
    total = held.filter("path = '[]'").select("host", F.col("w").alias("total"))
    # Containers of most of the text lie in each other, or hold no text at all.
    heavy = (
        held.join(total, "host")
        .filter("total > 0 AND w >= 0.6 * total")
        .groupBy("host", "total")
        .agg(F.collect_list(F.struct("path", "w")).alias("heavy"))
    )

    def align(rows):
        out = None
        for data in rows["tree"].sort_values():
            node = unpacked_tree(json.loads(data))
            out = node if out is None else merge(out, node)
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "tree": [json.dumps(packed_tree(out))]})

    trees, most = parsed.select("host", "tree").distinct(), None
    while most is None or most > 1:
        most = trees.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        groups = -(-most // MERGE_ROWS)
        bucket = F.pmod(F.xxhash64("tree", F.lit(most)), F.lit(max(1, groups)))
        if most > 1:
            trees = trees.groupBy("host", bucket.alias("bucket")).applyInPandas(align, "host string, tree string")
            trees = stored(trees, "wrapper-trees")
    made = sizes.join(trees, "host").join(literals, "host", "left").join(heavy, "host", "left")

    def finish(batches):
        for batch in batches:
            hosts, out = [], []
            for host, n, data, literal, heavy, total in rows_of(batch, "host", "pages", "tree", "literals", "heavy", "total"):
                weight = {tuple(json.loads(x["path"])): x["w"] for x in heavy or ()}
                wrapper = {
                    "tree": json.loads(data),
                    "literals": literal or [],
                    "content": list(_content(weight, total or 0)),
                    "pages": n,
                }
                hosts.append(host)
                out.append(json.dumps(wrapper))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(out, pa.string())], names=["host", "wrapper"])

    return made.select("host", "pages", "tree", "literals", "heavy", "total").mapInArrow(finish, "host string, wrapper string")


def main_text(pages):
    """``page_id, url, text`` of every row of `pages`; NULL and empty pages give an empty text.

    Rows with NULL or repeated ids and URLs are pages of their own. The wrappers are few and small beside the pages;
    adaptive execution splits a host with very many pages.
    """
    learnt = stored(wrappers(pages), "wrappers")
    given = pages.select("page_id", "url", _host(F.col("url")).alias("host"), text_bytes("html").alias("html"))
    joined = given.join(learnt, "host", "left").select("page_id", "url", "html", "wrapper")

    def scan(batches):
        known = {}
        for batch in batches:
            texts = []
            for data, wrapper in rows_of(batch, "html", "wrapper"):
                if wrapper is not None and wrapper not in known:
                    if len(known) > 2_000:
                        known.clear()
                    w = json.loads(wrapper)
                    known[wrapper] = {**w, "tree": unpacked_tree(w["tree"]), "literals": set(w["literals"])}
                texts.append(extract(data.decode("utf-8", "replace"), known.get(wrapper)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    kind = dict(given.dtypes)["page_id"]
    return joined.mapInArrow(scan, f"page_id {kind}, url string, text string")
