"""Listings: which postings a source's pages refer to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimark.functions.urls import canonical_url, last_segment, sitemap_id

# The path parts that mark a posting's own page, and how many listing pages a source has.
SITEMAP_DETAIL, ANCHOR_DETAIL, LAST_PAGE = "/szczegoly/praca/", "/job-offer/", 30


def listing_pages(spark: SparkSession, base: str, last: int = LAST_PAGE) -> DataFrame:
    """(page, url): the base page and its numbered successors."""
    pages = spark.range(1, last + 1).select(F.col("id").alias("page"))
    return pages.withColumn("url", F.when(F.col("page") == 1, F.lit(base)).otherwise(F.concat(F.lit(base + "?page="), F.col("page").cast("string"))))


def first_wins(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def last_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return first_wins(rows, key, [F.desc(c) for c in order])


def sitemap_refs(sitemaps: DataFrame, detail: str = SITEMAP_DETAIL) -> DataFrame:
    """(page, source_posting_id, url) of sitemap documents (page, body): every <loc>, canonical, last one of an id wins."""
    found = F.regexp_extract_all("body", F.lit(r"<(?:[\w.-]+:)?loc\b[^>]*>\s*([^<]*?)\s*</"), 1)
    rows = sitemaps.select("page", F.posexplode(found).alias("pos", "loc")).withColumn("url", canonical_url(F.regexp_replace("loc", "&amp;", "&")))
    rows = rows.where(F.col("url").contains(detail)).withColumn("source_posting_id", sitemap_id(F.col("url"))).where("source_posting_id IS NOT NULL")
    return last_wins(rows, ["page", "source_posting_id"], ["pos"]).select("page", "source_posting_id", "url")


def joined_url(base: Column, href: Column) -> Column:
    """``href`` against a base URL: absolute, scheme-relative, rooted, query-only or relative to the base's folder."""
    root = F.regexp_extract(base, r"^([a-zA-Z][\w+.-]*://[^/?#]*)", 1)
    path = canonical_url(base)
    folder = F.regexp_replace(path, "[^/]*$", "")
    folder = F.when(F.length(folder) > F.length(root), folder).otherwise(F.concat(root, F.lit("/")))
    return (
        F.when(href.rlike(r"^[a-zA-Z][\w+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-zA-Z][\w+.-]*:)", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href == "", base)
        .when(href.startswith("?") | href.startswith("#"), F.concat(path, href))
        .otherwise(F.concat(folder, F.regexp_replace(href, r"^(\./)+", "")))
    )


def anchors(pages: DataFrame, *base: str, html: str = "html") -> DataFrame:
    """(``base`` or url, pos, href) of every <a href> of a page, by pattern; see details.py for the tolerant parser."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]*)"""), 1)
    return pages.select(*(base or ("url",)), F.posexplode(found).alias("pos", "href"))


def anchor_refs(pages: DataFrame, detail: str = ANCHOR_DETAIL, base: str = "url", html: str = "html", key: str | None = None) -> DataFrame:
    """(``key``, source_posting_id, posting_url): links to postings' pages; the id is the last path segment, of a page's equal ids the last wins.

    A page is known by ``key``; without one by its URL, which then must not occur twice.
    """
    key = key or base
    rows = anchors(pages, *dict.fromkeys((key, base)), html=html).where(F.col("href").contains(detail))
    rows = rows.withColumn("link", canonical_url(joined_url(F.col(base), F.col("href")))).withColumn("source_posting_id", last_segment(F.col("link")))
    return last_wins(rows.where("source_posting_id <> ''"), [key, "source_posting_id"], ["pos"]).select(key, "source_posting_id", F.col("link").alias("posting_url"))


def discover(refs: DataFrame, order: list[str], limit: int) -> DataFrame:
    """Of refs over all listing pages the first of each id, up to ``limit``, as paging in order finds them."""
    return first_wins(refs, ["source_posting_id"], [F.asc(c) for c in order]).orderBy(*order).limit(limit)
