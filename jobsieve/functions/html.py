"""Column helpers that read fields out of stored HTML.

Patterns are arguments, so one job serves the default job pages and any other layout.
A field that is absent is ``''``; a field that is present but blank is NULL.
"""

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import lookup
from .text import col, let, strip

# Selectors of the job pages, as patterns.
CARD_OPEN = r"""<div\b[^>]*\sclass\s*=\s*(?:"(?:[^">]*\s)?base-card[\s"]|'(?:[^'>]*\s)?base-card[\s'])"""
CARD_URN = r'<div[^>]*\bdata-entity-urn="([^"]*)"'
CARD_TITLE = ("a", "span")
CARD_COMPANY = ("h4", "a")
CARD_LOCATION = r'(?s)<span\b[^>]*class="[^"]*\bjob-search-card__location\b[^"]*"[^>]*>(.*?)</span>'
DESCRIPTION_OPEN = r'<div\b[^>]*class="[^"]*\bshow-more-less-html__markup\b[^"]*"[^>]*>'

_LIST = r"(?s)<ul\b[^>]*>(.*?)</ul>"
_ITEM = r"(?s)<li\b[^>]*>(.*?)</li>"
_NOT_TEXT = r"(?is)<(?:!--.*?-->|script\b.*?</script>|style\b.*?</style>|[a-z/!?][^>]*>)"

# Named character references of HTML 5, the frequent ones first.
_COMMON = ["amp", "lt", "gt", "quot", "apos", "nbsp"]
_NAMES = _COMMON + sorted(n[:-1] for n in html5 if n.endswith(";") and n[:-1] not in _COMMON)
ENTITIES = {name: html5[f"{name};"] for name in _NAMES}
_REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"


def _character(code) -> Column:
    """The character of a Unicode code point, NULL if there is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    hexed = F.lpad(F.hex(F.when(valid, code)), 8, "0")
    return F.decode(F.unhex(hexed), "UTF-32")


def unescape(c) -> Column:
    """Decode the numeric and named character references that end in a semicolon."""
    def decoded(piece, i):
        # Every piece after the first starts with what followed an ampersand.
        ref = F.regexp_extract(piece, _REFERENCE, 1)
        code = F.when(
            ref.rlike("^#[0-9]"), F.substr(ref, F.lit(2)).try_cast("bigint")
        ).when(ref.startswith("#"), F.conv(F.substr(ref, F.lit(3)), 16, 10).try_cast("bigint"))
        char = F.coalesce(_character(code), lookup(ENTITIES, ref))
        rest = F.substr(piece, F.length(ref) + 2)
        as_is = F.concat(F.lit("&"), piece)
        return F.when(i == 0, piece).otherwise(F.coalesce(F.concat(char, rest), as_is))

    # Most texts hold no reference and skip the work.
    return let(
        col(c),
        lambda t: F.when(
            F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "&"), decoded), "")
        ).otherwise(t),
    )


def text_of(fragment) -> Column:
    """Text of an HTML fragment, trimmed: tags, comments, scripts and styles go, entities decode."""
    return strip(unescape(F.regexp_replace(col(fragment), _NOT_TEXT, "")))


def _null_if_empty(text) -> Column:
    return F.try_element_at(F.filter(F.array(text), lambda t: t != ""), F.lit(1))


def html_text(c, pattern) -> Column:
    """Text of the first match of a one-group pattern."""
    # The page is scanned once; the field is then read out of the short match.
    return let(
        F.coalesce(F.regexp_extract(col(c), pattern, 0), F.lit("")),
        lambda match: F.when(match == "", "").otherwise(
            _null_if_empty(text_of(F.regexp_extract(match, pattern, 1)))
        ),
    )


def _element(tag):
    return rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>"


def _first_inside(fragments, tag) -> Column:
    """Text of the first ``tag`` in the first fragment that has one."""
    having = F.filter(fragments, lambda f: f.rlike(_element(tag)))
    return html_text(F.coalesce(F.try_element_at(having, F.lit(1)), F.lit("")), _element(tag))


def html_descendant_text(c, outer, inner) -> Column:
    """Text of the first ``inner`` element inside an ``outer`` one."""
    return _first_inside(F.regexp_extract_all(col(c), F.lit(_element(outer)), F.lit(1)), inner)


def html_attr(c, tag, attr) -> Column:
    """An attribute of the first ``tag``; NULL when the tag lacks it or it is empty.

    Names are matched in any case, values with either quote or none.
    """
    value = rf"""(?i)\s{attr}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    return let(
        F.coalesce(F.regexp_extract(col(c), rf"(?i)<{tag}\b[^>]*>", 0), F.lit("")),
        lambda element: F.when(element == "", "").otherwise(
            _null_if_empty(unescape(F.regexp_replace(F.regexp_extract(element, value, 1), "^[\"']|[\"']$", "")))
        ),
    )


def html_block(c, open_pattern, tag="div") -> Column:
    """Inner HTML of a container that may hold nested elements of its own kind; NULL if absent.

    The text after the opening tag is split at the closing tags; the container ends at the
    first closing tag by which as many were opened as closed, or else at the end of the page.
    """
    c = col(c)
    opened = rf"(?i)<{tag}\b"
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("closed_at"), F.lit(0).alias("i"))

    def step(state, piece):
        depth = state["depth"] + F.size(F.split(piece, opened)) - 2
        i = state["i"] + 1
        ends_here = (state["closed_at"] == 0) & (depth == 0)
        return F.struct(
            depth.alias("depth"),
            F.when(ends_here, i).otherwise(state["closed_at"]).alias("closed_at"),
            i.alias("i"),
        )

    def inner(pieces):
        closed_at = F.aggregate(
            pieces, start, step, lambda s: F.when(s["closed_at"] > 0, s["closed_at"]).otherwise(s["i"])
        )
        return F.array_join(F.slice(pieces, F.lit(1), closed_at), f"</{tag}>")

    def after(opening):
        rest = F.substr(c, F.position(opening, c) + F.length(opening))
        return F.when(opening != "", let(F.split(rest, rf"(?i)</{tag}\s*>"), inner))

    return let(F.regexp_extract(c, open_pattern, 0), after)


def html_cards(c, open_pattern=CARD_OPEN, tag="div", within="li") -> Column:
    """All containers, with their tags, that lie anywhere inside a ``within`` element, in page order.

    A container ends where it closes, at the next one that opens, or at the end of the page.
    """

    def depths(pieces):
        change = F.transform(
            pieces, lambda p: F.size(F.split(p, rf"(?i)<{within}\b")) - F.size(F.split(p, rf"(?i)</{within}\b"))
        )
        return let(change, lambda n: F.transform(n, lambda _, i: _total(F.slice(n, F.lit(1), i))))

    def whole(piece):
        opening = rf"(?i)^<{tag}\b[^>]*>"
        return F.concat(F.regexp_extract(piece, opening, 0), html_block(piece, opening, tag), F.lit(f"</{tag}>"))

    def cards(pieces):
        placed = F.arrays_zip(pieces.alias("piece"), depths(pieces).alias("depth"))
        inside = F.filter(placed, lambda p, i: (i > 0) & (p["depth"] > 0))
        return F.transform(inside, lambda p: whole(p["piece"]))

    # A page that starts with a container has nothing before it, and so no element around it.
    return let(F.split(col(c), rf"(?i)(?={open_pattern})"), cards)


def _total(numbers) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def html_block_text(c, open_pattern=DESCRIPTION_OPEN, tag="div") -> Column:
    """All text of a container; ``''`` when it is absent or blank."""
    return F.coalesce(text_of(html_block(c, open_pattern, tag)), F.lit(""))


def html_lists(c) -> Column:
    """Inner HTML of all lists of a page, in page order."""
    return F.regexp_extract_all(col(c), F.lit(_LIST), F.lit(1))


def nth_item_text(lists, k) -> Column:
    """Text of the first span inside the k-th item, over lists in page order."""
    items = F.transform(
        col(lists),
        lambda ul: F.try_element_at(F.regexp_extract_all(ul, F.lit(_ITEM), F.lit(1)), F.lit(k)),
    )
    return _first_inside(items, "span")


def html_nth_item(c, k) -> Column:
    """The same straight from a page, for a single item."""
    return nth_item_text(html_lists(c), k)
