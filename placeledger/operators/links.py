"""Price and service links of pages, and the pages to read next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from placeledger.fixed_values import MAX_PAGES_PER_SALON, PRICE_LINK_WORDS
from placeledger.functions.html import anchor_targets
from placeledger.functions.text import contains_any
from placeledger.functions.urls import page_url, redact_url, resolve_link, split_url
from placeledger.operators.stage import stage


def internal_links(pages: DataFrame, key: str, words: list[str] = PRICE_LINK_WORDS,
                   url: str = "source_url", html: str = "html") -> DataFrame:
    """Links to price or service pages on the page's own host: key, pos, url.

    Only distinct link texts of a page are resolved further down; the html itself
    never leaves the scan.
    """
    found = pages.select(key, F.col(url).alias("_base"), F.posexplode(anchor_targets(html)).alias("pos", "href"))
    resolved = stage(found.filter(F.col("href") != ""), url=resolve_link("_base", "href"))
    split = stage(
        resolved.filter("url IS NOT NULL"),
        _u=split_url("url"), _host=F.lower(split_url(page_url("_base"))["host"]),
    )
    searched = F.lower(F.concat_ws(" ", F.col("_u.path"), F.col("_u.query")))
    same_host = F.lower(F.col("_u.host")) == F.col("_host")
    return split.filter(same_host & contains_any(searched, words, normalize=False)).select(key, "pos", "url")


def crawl_frontier(pages: DataFrame, key: str, max_pages: int = MAX_PAGES_PER_SALON,
                   words: list[str] = PRICE_LINK_WORDS, url: str = "source_url", html: str = "html") -> DataFrame:
    """Per entity the home page and its distinct price or service links in order, at
    most `max_pages`: key, page_no, url (redacted).

    A page's links are made distinct inside the row, and the rank limit is applied
    before the shuffle as well.
    """
    home = pages.select(key, F.lit(-1).alias("pos"), redact_url(page_url(url)).alias("url"))
    links = internal_links(pages, key, words, url, html).select(key, "pos", redact_url("url").alias("url"))
    firsts = home.unionByName(links).groupBy(key, "url").agg(F.min("pos").alias("pos"))
    ranked = firsts.withColumn("page_no", F.row_number().over(W.partitionBy(key).orderBy("pos")))
    return ranked.filter(F.col("page_no") <= max_pages).select(key, "page_no", "url")
