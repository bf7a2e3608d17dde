"""Row-local tokenising, lexicon matching and BIO decoding on array columns.

Nothing here shuffles: one text, however long, is handled inside its own row.
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import SPECIAL_TOKENS
from .text import col, let, strip

# Characters that separate tokens: white space, this punctuation, and the Unicode block of dashes,
# quotes and bullets. A run of dots is also dropped where a token ends, so ``c++``, ``c#``,
# ``.net`` and ``node.js`` stay whole. Latin-1 members are listed one by one because Java then
# looks them up in a bitmap.
SEPARATORS = " \t\n\r\f\x0b\x85\xa0" + ',;:()!?"' + "\u2000-\u206f\u3000"
_SEPARATOR = f"[{SEPARATORS}]"
# Runs of dots and separators that end in a separator. No quantifier stands on a group that has
# one inside: Java would recurse once per repetition, and long runs would overflow the stack.
_BREAK = f"[.{SEPARATORS}]*{_SEPARATOR}"
# The same for splitting, started only at the first of several dots, which keeps it linear.
_SPLIT = rf"{_SEPARATOR}(?:{_BREAK})?|\.(?<!\.\.)\.*(?:\z|{_SEPARATOR}(?:{_BREAK})?)"
_TOKEN_END = rf"(?=\.*(?:{_SEPARATOR}|\z))"
# Alternatives tried one after the other before a look-ahead on the next character narrows them.
_FAN_OUT = 6
# Marks around a lexicon hit inside a text; blanked in the input first.
_OPEN, _CLOSE = "\u0001", "\u0002"

# A lexicon up to this many terms becomes one pattern, which every task holds; larger ones use the join operator.
MAX_PATTERN_TERMS = 200_000


def tokens(text) -> Column:
    """Lower-cased tokens of a text, in order."""
    return F.array_remove(F.split(F.lower(col(text)), _SPLIT), "")


def normalise_term(term):
    """What ``tokens`` makes of a term, joined by single blanks."""
    parts = re.split(rf"{_BREAK}|\.+\Z", term.lower())
    return " ".join(p for p in parts if p)


def normal_forms(terms):
    """``{normal form: lower-cased term}`` of all terms that a text can contain.

    Texts hold a term as tokenising leaves it: ``c (lang)`` is found as the tokens ``c lang``. Where several terms have one
    normal form, the term that is that form itself stands for it, else the smallest. A term whose first character
    tokenising takes away (``. net``) would be found as another word; ``unmatchable_terms`` lists those.
    """
    forms = {}
    for term in sorted({t.lower() for t in terms if t}):
        form = normalise_term(term)
        if _keeps_its_start(term, form) and (form == term or form not in forms):
            forms[form] = term
    return forms


def _keeps_its_start(term, form):
    return bool(form) and form[0] == term.strip()[0]


def unmatchable_terms(terms):
    """Lower-cased terms that no text can contain: nothing, or another word, is left of them."""
    return sorted(t for t in {t.lower() for t in terms} if not _keeps_its_start(t, normalise_term(t)))


def respelled_terms(terms):
    """The part of ``normal_forms`` where the form and the term differ."""
    return {form: term for form, term in normal_forms(terms).items() if form != term}


def matchable_terms(terms):
    """The distinct normal forms of terms, sorted."""
    return sorted(normal_forms(terms))


def _escaped(ch):
    return ch if ch.isalnum() else "\\" + ch


def _any_of(parts):
    """Alternation of (first character, pattern) pairs, nested so that few are tried in vain."""
    if len(parts) <= _FAN_OUT:
        return "|".join(pattern for _, pattern in parts)
    size = -(-len(parts) // _FAN_OUT)
    groups = [parts[i : i + size] for i in range(0, len(parts), size)]
    return "|".join(
        f"(?=[{''.join(_escaped(ch) for ch, _ in g)}])(?:{_any_of(g)})" if len(g) > 1 else g[0][1]
        for g in groups
    )


def _branches(suffixes):
    """Pattern for a set of term suffixes; the longest is tried first."""
    heads = {}
    for s in suffixes:
        if s:
            heads.setdefault(s[0], set()).add(s[1:])
    letters = [(ch, _escaped(ch) + _branches(heads[ch])) for ch in sorted(heads) if ch != " "]
    options = [_any_of(letters)] if letters else []
    if " " in heads:
        options.append(_BREAK + _branches(heads[" "]))
    if "" in suffixes:
        options.append(_TOKEN_END)
    return options[0] if len(options) == 1 and len(letters) < 2 else f"(?:{'|'.join(options)})"


def lexicon_pattern(terms):
    """One regular expression for whole-token mentions: the separator before, then the mention.

    The mention is leftmost and, from there, longest. Texts need one separator in front.
    """
    terms = matchable_terms(terms)
    if not terms:
        raise ValueError("the lexicon has no matchable term")
    if len(terms) > MAX_PATTERN_TERMS:
        raise ValueError(
            f"{len(terms)} terms exceed {MAX_PATTERN_TERMS}; give them as a table"
        )
    return f"({_SEPARATOR})({_branches(set(terms))})"


def mentions(text, pattern) -> Column:
    """Lexicon mentions of a text in order: non-overlapping, leftmost, longest."""
    padded = F.concat(F.lit(" "), F.lower(col(text)))
    found = F.regexp_extract_all(padded, F.lit(pattern), F.lit(2))
    return F.transform(found, lambda m: F.regexp_replace(m, _BREAK, " "))


def truncate(token_array, n) -> Column:
    """The first n tokens; no cut when n is None."""
    token_array = col(token_array)
    return token_array if n is None else F.slice(token_array, 1, n)


def _pieces(text, pattern):
    """The text cut at its mentions: every mention is enclosed in marks, so odd pieces are the mentions."""
    clean = F.translate(F.lower(col(text)), _OPEN + _CLOSE, "  ")
    marked = F.regexp_replace(F.concat(F.lit(" "), clean), pattern, f"$1{_OPEN}$2{_CLOSE}")
    return F.split(marked, f"[{_OPEN}{_CLOSE}]")


def tagged_tokens(text, pattern) -> Column:
    """Tokens with BIO labels: array<struct<token,label>>."""

    def tag(piece, i):
        return F.transform(
            tokens(piece),
            lambda token, j: F.struct(
                token.alias("token"),
                F.when(i % 2 == 0, "O").when(j == 0, "B-SKILL").otherwise("I-SKILL").alias("label"),
            ),
        )

    return F.flatten(F.transform(_pieces(text, pattern), tag))


def marked_tokens(text, pattern) -> Column:
    """The same as plain text, to be exploded: array<string>, with a mark in front of the tokens of mentions.

    Lambdas are interpreted, so none runs over the many tokens outside of mentions. ``unmarked`` takes tokens apart.
    """

    def mark(piece, i):
        mention = F.transform(tokens(piece), lambda token, j: F.concat(F.when(j == 0, _OPEN).otherwise(_CLOSE), token))
        return F.when(i % 2 == 0, tokens(piece)).otherwise(mention)

    return F.flatten(F.transform(_pieces(text, pattern), mark))


def unmarked(marked) -> tuple[Column, Column]:
    """Token and label of one of the ``marked_tokens``."""
    begins, goes_on = F.startswith(col(marked), F.lit(_OPEN)), F.startswith(col(marked), F.lit(_CLOSE))
    token = F.when(begins | goes_on, F.substr(col(marked), F.lit(2))).otherwise(col(marked))
    return token, F.when(begins, "B-SKILL").when(goes_on, "I-SKILL").otherwise("O")


def decode_tagged(tagged) -> Column:
    """Spans of one row's tagged tokens: array<array<string>>.

    Special tokens are skipped without ending a span; an I-SKILL without an open span is ignored.
    """
    kept = F.filter(col(tagged), lambda t: ~t["token"].isin(SPECIAL_TOKENS))
    return let(kept, _spans_of)


def _spans_of(kept):
    # Every token that is not I-SKILL ends the span before it.
    at = F.filter(
        F.transform(
            kept,
            lambda t, i: F.struct(i.alias("at"), t["label"].alias("label")),
        ),
        lambda h: F.coalesce(h["label"] != "I-SKILL", F.lit(True)),
    )

    def cut(heads):
        following = F.transform(F.slice(heads, F.lit(2), F.size(heads)), lambda h: h["at"])
        with_end = F.zip_with(
            heads,
            following,
            lambda h, nxt: F.struct(h.alias("head"), F.coalesce(nxt, F.size(kept)).alias("end")),
        )
        return F.transform(
            F.filter(with_end, lambda b: b["head"]["label"] == "B-SKILL"),
            lambda b: F.transform(
                F.slice(kept, b["head"]["at"] + 1, b["end"] - b["head"]["at"]),
                lambda t: t["token"],
            ),
        )

    return let(at, cut)


def span_text(span_tokens, clean_up=False) -> Column:
    """Text of a span: ``##`` pieces are glued to the token before; NULL stays NULL.

    ``clean_up`` also removes the blank before ``. , ! ?``, as detokenisers do.
    """
    text = F.replace(F.array_join(col(span_tokens), " "), F.lit(" ##"), F.lit(""))
    if clean_up:
        text = F.regexp_replace(text, r" ([.,!?])", "$1")
    return strip(text)
