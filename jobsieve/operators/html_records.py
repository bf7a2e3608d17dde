"""Posts out of stored listing and detail pages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html
from ..functions.text import urn_part
from ..schemas import POST_FIELDS


def explode_cards(df: DataFrame, html_col="html", card_pattern=None) -> DataFrame:
    """One row per repeated card of a page, with its place on the page; pages without cards drop.

    Cards are the containers of the job pages, wherever they lie in a list item, or the first group of a pattern.
    """
    if card_pattern is None:
        cards = html.html_cards(html_col)
    else:
        cards = F.regexp_extract_all(F.col(html_col), F.lit(card_pattern), F.lit(1))
    # The outer form keeps the optimizer from filtering on the array, which would build it twice.
    rows = df.select("*", F.posexplode_outer(cards).alias("card_no", "card")).drop(html_col)
    return rows.filter("card IS NOT NULL")


def card_fields(cards: DataFrame, card_col="card") -> DataFrame:
    """The five fields a listing card shows."""
    c = F.col(card_col)
    return cards.withColumns(
        {
            "Job_ID": urn_part(html.unescape(F.regexp_extract(c, html.CARD_URN, 1)), ":", 4),
            "Title": html.html_descendant_text(c, *html.CARD_TITLE),
            "Company_name": html.html_descendant_text(c, *html.CARD_COMPANY),
            "Location": html.html_text(c, html.CARD_LOCATION),
            "Pubblication_date": html.html_attr(c, "time", "datetime"),
        }
    )


def detail_fields(details: DataFrame, html_col="html") -> DataFrame:
    """The description and the four listed criteria of a detail page."""
    with_lists = details.withColumn("_lists", html.html_lists(html_col))
    return with_lists.withColumns(
        {
            "Description": html.html_block_text(html_col),
            "Seniority_level": html.nth_item_text("_lists", 1),
            "Employment_type": html.nth_item_text("_lists", 2),
            "Job_Function": html.nth_item_text("_lists", 3),
            "Industry_type": html.nth_item_text("_lists", 4),
        }
    ).drop("_lists")


def build_posts(cards: DataFrame, details: DataFrame) -> DataFrame:
    """The ten-field post from card rows (``card``) and detail pages (``Job_ID``, ``html``).

    Fields are read before the join, so pages are not shuffled. A card without a stored detail
    page keeps NULL in the detail fields.
    """
    shown = card_fields(cards).drop("card")
    described = detail_fields(details).drop("html")
    return shown.join(described, "Job_ID", "left").select(*POST_FIELDS)
