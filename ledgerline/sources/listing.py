"""Index pages → names of the files they link to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# First characters of links that are no data files (sorting links, parent folder, layout notes).
SKIPPED_INITIALS = ("?", "/", "L", "a")

# Markup whose anchors are not links.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script>"
HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
# Character references that occur in links. "&amp;" comes last, or it would create new ones.
REFERENCES = {"&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def hrefs(html: Column) -> Column:
    """Array of the link targets of all anchors in a page."""
    visible = F.regexp_replace(html, HIDDEN, "")
    return F.transform(F.regexp_extract_all(visible, F.lit(HREF), F.lit(1)), _unquoted)


def _unquoted(value: Column) -> Column:
    value = F.regexp_replace(value, r"""^["']|["']$""", "")
    for reference, character in REFERENCES.items():
        value = F.replace(value, F.lit(reference), F.lit(character))
    return value


def list_links(
    pages: DataFrame, html: str = "html", skipped: Sequence[str] = SKIPPED_INITIALS, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per link that does not start with a skipped character (case matters), with the ``keep`` columns."""
    return pages.select(*keep, F.explode(hrefs(F.col(html))).alias("file_name")).where(
        ~F.substring("file_name", 1, 1).isin(*skipped) & (F.col("file_name") != "")
    )
