"""Text predicates and templates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marker of removed comments and the base of permalinks.
DELETED_MARKER = "[deleted]"
BASE_URL = "https://www.reddit.com"


def not_deleted(text: Column, marker: str = DELETED_MARKER) -> Column:
    """True for text without the marker; NULL text gives NULL, so it is dropped."""
    return ~text.contains(marker)


def full_url(permalink: Column, base: str = BASE_URL) -> Column:
    return F.concat(F.lit(base), permalink)


def escape_html(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text
