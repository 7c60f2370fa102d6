"""Daily-file listings: extract file links from index pages, one row per link.

The source system fetches one HTML index per station; here a table of pages
``(page_id, url, html)`` is scanned in parallel and every anchor ``href`` that
ends with ``suffix`` and starts with ``prefix_regex`` becomes a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The default file rule is "8 leading digits (YYYYMMDD) and .txt".
DEFAULT_PREFIX_REGEX = "^[0-9]{8}"
DEFAULT_SUFFIX = ".txt"
# An anchor's href in any case, with its value in double, single or no quotes.
ANCHOR_HREF = r"""(?i)<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def listing_links(pages: DataFrame, prefix_regex: str = DEFAULT_PREFIX_REGEX,
                  suffix: str = DEFAULT_SUFFIX, key: str = "page_id", html: str = "html") -> DataFrame:
    """``(page_id, href)`` for matching links, sorted by page then name."""
    links = pages.select(F.col(key), F.explode(F.regexp_extract_all(F.col(html), F.lit(ANCHOR_HREF), 1)).alias("_v"))
    bare = F.regexp_replace("_v", r"""^["']|["']$""", "")
    links = links.select(key, F.replace(bare, F.lit("&amp;"), F.lit("&")).alias("href"))
    keep = (F.col("href") != "") & F.col("href").endswith(suffix) & F.col("href").rlike(prefix_regex)
    return links.filter(keep).orderBy(key, "href")
