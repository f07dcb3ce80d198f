"""Line de-duplication by the share of a site's pages that hold a line.

Markup becomes lines of visible text. For each host the pages with a line are divided by the pages
of the host, and lines above a ratio are boilerplate. All steps are SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jsonstrata.llm.frames import col, keep

#: Fixed patterns: what is never shown, tags that end a line, and all other tags. What is not closed
#: is hidden up to the end of the page, and a tag holds no other, so that every pattern reads a page
#: once.
HIDDEN = r"(?is)<(?:script|style|title)(?:\s[^<>]*)?>.*?(?:</(?:script|style|title)>|\z)|<!--.*?(?:-->|\z)"
BREAKS = r"(?i)</?(p|br|li|ul|ol|div|nav|footer|header|article|section|tr|table|h[1-6]|body|html|head)(\s[^<>]*)?/?>"
TAGS = r"<[^<>]*>"
HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)"


def text_lines(html: Column) -> Column:
    """The lines of visible text: trimmed, inner white space as one space, empty lines left out."""
    shown = F.regexp_replace(html, HIDDEN, "\n")
    shown = F.regexp_replace(shown, BREAKS, "\n")
    shown = F.regexp_replace(shown, TAGS, "")
    lines = F.transform(F.split(shown, r"[\r\n]+", -1), lambda x: F.trim(F.regexp_replace(x, r"[ \t]+", " ")))
    return F.filter(lines, lambda x: x != "")


def drop_site_lines(
    pages: DataFrame,
    max_ratio: float = 0.2,
    min_pages: int = 3,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Pages without the boilerplate of their site: (page_id, host, n_lines, n_removed, kept).

    A line is dropped when it stands on at least ``min_pages`` pages of the host and on more than
    ``max_ratio`` of them; several times on one page count once. ``kept`` has the other lines in
    order. Dropped lines of a host are at most its mean number of lines a page divided by the
    ratio, so a host's list is bounded, and the join that brings it to the pages splits a host with
    many pages.

    A missing url or one without a host belongs to the host of the empty name; a null page has no
    lines. Repeated rows are pages of their own. Empty tables give no rows; other columns may have
    any name.
    """
    lines = pages.select(
        col(id_column).alias("page_id"),
        F.coalesce(F.lower(F.regexp_extract(col(url_column), HOST, 1)), F.lit("")).alias("host"),
        text_lines(F.coalesce(col(html_column), F.lit(""))).alias("lines"),
    )
    # Two seeds make 128 bits, so lines travel as numbers and no two lines meet.
    distinct = F.transform(
        F.array_distinct("lines"),
        lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")),
    )
    counts = (
        lines.select("host", F.inline(distinct))
        .groupBy("host", "a", "b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    # Reads the urls alone.
    totals = lines.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    # As a table of its own it can be broadcast if it is small; if not, both sides of the join are
    # plain exchanges and Spark splits a host with many pages.
    dropped = keep(
        counts.join(totals, "host")
        .where(F.col("n") > F.lit(max_ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("a", "b")).alias("dropped"))
    )
    hashed = lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))
    # The page's own dropped lines come from one pass over both lists, so few are left to look through.
    own = F.array_intersect(F.transform("lines", hashed), F.col("dropped"))
    stays = F.filter("lines", lambda x: ~F.coalesce(F.array_contains("own", hashed(x)), F.lit(False)))
    return (
        lines.join(dropped, "host", "left")
        .withColumn("own", own)
        .withColumn("stays", stays)
        .select(
            "page_id",
            "host",
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("stays")).cast("long").alias("n_removed"),
            F.array_join("stays", "\n").alias("kept"),
        )
    )
