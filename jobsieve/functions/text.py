"""Column helpers for strings, JSON payload fields, dates and URLs."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) makes \s cover all Unicode white space, as Python's str.strip does. The look-behind starts
# the second part only at the first of several spaces, which keeps long runs linear.
_EDGE_SPACE = r"(?U)^\s+|\s(?<!\s\s)\s*\z"


def col(c):
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, for use inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(col(c), _EDGE_SPACE, "")


def is_empty(c) -> Column:
    """Missing or zero-length; white space counts as content."""
    return F.coalesce(col(c) == "", F.lit(True))


def is_blank(c) -> Column:
    """Missing, empty or white space only."""
    return F.coalesce(~col(c).rlike(r"(?U)\S"), F.lit(True))


def remove_prefix(c, prefix) -> Column:
    """Remove one leading ``prefix``."""
    c = col(c)
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def urn_part(c, sep=":", n=4) -> Column:
    """The n-th part of a separated identifier, ``''`` when there are fewer parts."""
    return F.split_part(col(c), F.lit(sep), F.lit(n))


def parsed_date(c, fmt="yyyy-MM-dd") -> Column:
    """A date if the text has exactly this format, else NULL."""
    c = col(c)
    shape = "^" + "".join(r"\d" if ch.isalpha() else "\\" + ch for ch in fmt) + "$"
    return F.when(c.rlike(shape), F.try_to_date(c, fmt))


def _form_encode(c):
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _reencode(pair):
    decoded = lambda p: F.coalesce(F.try_url_decode(p), p)
    key = F.substring_index(pair, "=", 1)
    value = F.substr(pair, F.length(key) + 2)
    return F.concat(_form_encode(decoded(key)), F.lit("="), _form_encode(decoded(value)))


def set_query_param(c, name, value) -> Column:
    """Set one URL query parameter, replacing its old value or adding it at the end.

    The query string is parsed and rebuilt: blank-valued parameters vanish and the others
    are form-encoded afresh.
    """
    c, value = col(c), value if isinstance(value, Column) else F.lit(str(value))
    base = F.regexp_extract(c, r"^([^?#]*)", 1)
    query = F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(c, r"(#.*)$", 1)
    key = lambda p: F.substring_index(p, "=", 1)
    pair = F.concat(F.lit(f"{name}="), _form_encode(value.cast("string")))
    params = F.filter(F.split(query, "&"), lambda p: p.rlike("^[^=]+=."))
    names = F.transform(params, key)
    first = F.array_position(names, F.lit(name))
    kept = F.filter(
        F.transform(
            params,
            lambda p, i: F.when(key(p) != name, _reencode(p)).when(i + 1 == first, pair),
        ),
        lambda p: p.isNotNull(),
    )
    # Parameters of one name stand together, at the place of the first.
    kept = F.flatten(
        F.transform(F.array_distinct(F.transform(kept, key)), lambda n: F.filter(kept, lambda p: key(p) == n))
    )
    kept = F.when(first > 0, kept).otherwise(F.concat(kept, F.array(pair)))
    return F.concat(base, F.lit("?"), F.array_join(kept, "&"), fragment)
