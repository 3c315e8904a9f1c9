"""Scraped pages and documents: extraction, URL deduplication, the document store's queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import shard_of, short_hash
from ..functions.html import rows_of
from ..functions.scalars import absolute_url, iso_text
from ..schemas import SCRAPE_ROWS

Extractor = Callable[..., DataFrame]


def _extract_rows(pages: DataFrame, row_selector: str, fields: dict[str, tuple[str, str | None]], limit: int | None) -> DataFrame:
    """One output row per selected element: ``page_id``, ``url``, ``position`` and the fields (null if absent)."""
    names = list(fields)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                (page_id, url, position, *[row.get(name) for name in names])
                for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"])
                for position, row in enumerate(rows_of(html, row_selector, fields)[:limit])
            ]
            yield pd.DataFrame(found, columns=["page_id", "page_url", "position", *names])

    schema = "page_id bigint, page_url string, position int, " + ", ".join(f"`{name}` string" for name in names)
    return pages.select("page_id", "url", "html").mapInPandas(extract, schema)


def site_of(url: str | Column) -> Column:
    return F.regexp_extract(url, r"^(https?://[^/?#]+)", 1)


def extract_links(
    pages: DataFrame, row_selector: str = "tr.athing", link_selector: str = "span.titleline > a",
    base: str | None = None, limit: int | None = None, source: str = "hn",
) -> DataFrame:
    """Links of the selected rows as scraped items; rows without a link are skipped.

    ``limit`` counts rows of a page before anything is skipped. A relative address is put under ``base``, or
    under the site of its page.
    """
    fields = {"href": (link_selector, "href"), "title": (link_selector, None)}
    rows = _extract_rows(pages, row_selector, fields, limit).filter(F.col("href").isNotNull())
    root = F.lit(base) if base else site_of("page_url")
    return rows.select(
        "page_id", "position", absolute_url("href", root).alias("url"), F.trim("title").alias("title"),
        F.lit("").alias("content"), F.lit(source).alias("source"),
    )


def extract_quotes(
    pages: DataFrame, row_selector: str = ".quote", text_selector: str = ".text", author_selector: str = ".author",
    limit: int | None = None, source: str = "playwright",
) -> DataFrame:
    """Quotes with their author; the address is the page plus a stable hash of the text."""
    fields = {"content": (text_selector, None), "title": (author_selector, None)}
    rows = _extract_rows(pages, row_selector, fields, limit)
    text = F.coalesce("content", F.lit(""))
    return rows.select(
        "page_id", "position", F.concat("page_url", F.lit("#"), short_hash(text)).alias("url"),
        F.coalesce("title", F.lit("")).alias("title"), text.alias("content"), F.lit(source).alias("source"),
    )


def posts_to_items(
    posts: DataFrame, base: str = "https://jsonplaceholder.typicode.com", limit: int | None = None, source: str = "jsonplaceholder"
) -> DataFrame:
    """API posts as scraped items; a post is a page of one item."""
    rows = posts if limit is None else posts.orderBy("id").limit(limit)
    return rows.select(
        F.col("id").alias("page_id"), F.lit(0).alias("position"),
        F.concat(F.lit(base + "/posts/"), F.col("id").cast("string")).alias("url"),
        F.coalesce("title", F.lit("")).alias("title"), F.coalesce("body", F.lit("")).alias("content"), F.lit(source).alias("source"),
    )


def dedupe_urls(items: DataFrame, *order: str) -> DataFrame:
    """The first item of every address; one candidate per address and task is shuffled."""
    rest = [c for c in items.columns if c != "url"]
    return items.groupBy("url").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select("url", "_r.*")


def find_by_source(docs: DataFrame, source: str, limit: int = 50) -> DataFrame:
    """Newest documents of a source, with an id that stays the same for the same address and time."""
    newest = (
        docs.filter(F.col("source") == source)
        .select("source", "url", "title", "content", "scraped_at")
        .orderBy(F.desc("scraped_at"), "url")
        .limit(limit)
        .withColumn("scraped_at", iso_text("scraped_at"))
    )
    return newest.withColumn("id", F.substring(F.sha2(F.concat_ws("|", "url", "scraped_at"), 256), 1, 24))


def shard_urls(items: DataFrame, shards: int) -> DataFrame:
    """Each address with the worker it belongs to, laid out by worker."""
    return items.withColumn("shard", shard_of("url", shards)).repartition(shards, "shard", "url")


#: The columns that order the items of a run; every extractor gives them besides url, title, content and source.
ITEM_ORDER = ("page_id", "position")


class ExtractorRegistry:
    """Named extractors ``(pages, **options) -> items`` with ``ITEM_ORDER``, ``url``, ``title``, ``content``, ``source``."""

    def __init__(self) -> None:
        self._extractors: dict[str, Extractor] = {}

    def register(self, name: str, extractor: Extractor) -> None:
        self._extractors[name] = extractor

    @property
    def available_sources(self) -> list[str]:
        return sorted(self._extractors)

    def get(self, name: str) -> Extractor:
        if name not in self._extractors:
            raise ValueError(f"unknown source {name!r}; available: {', '.join(self.available_sources)}")
        return self._extractors[name]

    def apply(self, name: str, pages: DataFrame, **options) -> DataFrame:
        return pages.transform(self.get(name), **options)


def clamp_limit(limit: int) -> int:
    low, high = SCRAPE_ROWS
    return min(max(limit, low), high)


def default_registry() -> ExtractorRegistry:
    registry = ExtractorRegistry()
    registry.register("hn", extract_links)
    registry.register("playwright", extract_quotes)
    registry.register("jsonplaceholder", posts_to_items)
    return registry
