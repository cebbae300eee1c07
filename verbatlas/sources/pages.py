"""Stored web pages and stored API pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatlas.functions.text import normalise_url
from verbatlas.schemas import API_PAGE

# The harvest modes and the part of a link that each looks for.
HARVEST_NEEDLES = {
    "feedspot": "youtube.com/user/",
    "socialblade": "youtube/c/",
}
LINK_PATTERN = 'href="([^"]*)"'


def _saved_pages(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    reader = spark.read.schema(API_PAGE).option("multiLine", True).option("mode", "PERMISSIVE")
    return reader.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).json(folder)


def read_api_pages(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Video ids of all JSON files below ``folder``; a file that does not parse gives none."""
    items = _saved_pages(spark, folder, pattern).select(F.explode("items").alias("item"))
    return items.select(F.col("item.snippet.resourceId.videoId").alias("video_id")).filter("video_id is not null")


def broken_api_pages(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """Files below ``folder`` that hold no readable page."""
    files = _saved_pages(spark, folder, pattern).select(F.input_file_name().alias("file"), "items")
    return files.filter("items is null").select("file")


def harvest_links(pages: DataFrame, html: str = "html", *keep: str) -> DataFrame:
    """All ``href`` values of a page, in page order."""
    links = F.regexp_extract_all(F.col(html), F.lit(LINK_PATTERN), F.lit(1))
    return pages.select(*keep, F.posexplode(links).alias("place", "link"))


def channel_urls(links: DataFrame, mode: str, needle: str | None = None, link: str = "link") -> DataFrame:
    """Links that point to a channel, in the form the given mode stores them.

    ``feedspot`` keeps them as they are, ``socialblade`` rewrites them and rejects
    percent-encoded ones, ``manual`` takes the list as given.
    """
    if mode == "manual":
        return links
    if mode not in HARVEST_NEEDLES:
        raise ValueError(f"unknown mode {mode!r}; use manual or one of {sorted(HARVEST_NEEDLES)}")
    found = links.filter(F.col(link).contains(needle or HARVEST_NEEDLES[mode]))
    if mode == "socialblade":
        found = found.withColumn(link, normalise_url(F.col(link))).filter(F.col(link).isNotNull())
    return found


def matching(df: DataFrame, column: str, pattern: str = "(?i)^.*") -> DataFrame:
    """Rows whose key matches a pattern; the default matches every key."""
    return df.filter(F.col(column).rlike(pattern))
