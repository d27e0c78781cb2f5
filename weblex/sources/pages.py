"""URL corpora derived by Spark from the driver's ``pages`` table.

``pages(page_id, url, html)`` holds raw web pages.  Two URL lists come out
of it, both growing with the table:

* page URLs: ``pages.url`` itself;
* link URLs: every ``href="..."`` of a page, resolved against the page's
  host (``http://`` + host + path for site-relative links; absolute links
  as they are).  Ordered by (page_id, position of the link in the page).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.partitioning import spread

HREF_RE = r'href="([^"]+)"'
PAGE_HOST_RE = r"^https?://([^/?#]+)"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def page_urls(pages: DataFrame) -> DataFrame:
    """(page_id, url) straight from the table."""
    return pages.select("page_id", "url")


def resolve_href(host, href):
    """Absolute hrefs unchanged; '//x' gets http:; others join the host."""
    absolute = href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    return (F.when(absolute, href)
             .when(href.startswith("//"), F.concat(F.lit("http:"), href))
             .when(href.startswith("/"), F.concat(F.lit("http://"), host, href))
             .otherwise(F.concat(F.lit("http://"), host, F.lit("/"), href)))


def link_urls(pages: DataFrame) -> DataFrame:
    """(page_id, pos, url): one row per link, pos 0-based within the page.

    A page table held in fewer splits than task slots is spread first, so
    the link extraction (a regex over the whole HTML) runs in parallel.
    """
    host = F.regexp_extract(F.col("url"), PAGE_HOST_RE, 1)
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(HREF_RE), 1)
    pages = spread(pages.select("page_id", "url", "html"))
    links = pages.select("page_id", host.alias("_host"), F.posexplode(hrefs).alias("pos", "_href"))
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                        resolve_href(F.col("_host"), F.col("_href")).alias("url"))


def link_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_urls(read_table(spark, sf_dir, "pages"))
