"""From stored pages or raw events to deduplicated posts."""

from pyspark.sql import DataFrame

from ..operators.clean import drop_fields, split_quarantine
from ..operators.dedupe import dedupe_first, reject_known
from ..operators.html_records import build_posts, explode_cards
from ..schemas import POST_FIELDS
from ..sources.readers import spread


def posts_from_pages(listings: DataFrame, details: DataFrame) -> DataFrame:
    """Posts from listing pages (``html``) and detail pages (``Job_ID``, ``html``)."""
    return build_posts(explode_cards(spread(listings)), spread(details))


def ingest_batch(events: DataFrame, table: DataFrame | None = None, order="Pubblication_date") -> DataFrame:
    """New posts of a bulk load: transport fields go, first post with text per key stays.

    ``order`` names the arrival order; the other fields break ties, so the result does not depend
    on how the input is partitioned.
    """
    posts, _ = split_quarantine(drop_fields(events))
    ties = [c for c in POST_FIELDS if c in posts.columns and c not in ("Job_ID", order)]
    first = dedupe_first(posts, "Job_ID", [order, *ties])
    return first if table is None else reject_known(first, table)
