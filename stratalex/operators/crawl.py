"""Crawl: breadth-first over a table of pages, content gates, and a snapshot cache.

Pages: url, html and, where known, institution, lang, language_confidence, http_status, content_type, size. A fetcher may be
any function from a table of URLs to such a table; offline it is a join with stored pages."""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.html import html_to_text
from ..functions.udfs import canonical_url
from ..policies import WebPolicy
from ..sources.shared import cut


def from_pages(pages: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A fetcher over stored pages: the page of each normalised URL."""
    stored = pages.withColumn("__url", tx.normalize_url(F.col("url")))
    return lambda urls: urls.join(stored.drop("url"), F.col("url") == F.col("__url")).drop("__url")


def discovered(pages: DataFrame) -> DataFrame:
    """url, link, at: links of pages by the built-in pattern, resolved against the page, each once, in order."""
    hrefs = F.regexp_extract_all("html", F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"'>]+)["']"""), F.lit(1))
    each = pages.select("url", F.posexplode(F.array_distinct(hrefs)).alias("at", "href"))
    linked = each.select("url", "at", canonical_url(F.col("href"), F.col("url")).alias("link")).where("link is not null")
    return linked.groupBy("url", "link").agg(F.min("at").alias("at"))


def sitemap_urls(bodies: DataFrame, most: int | None = None) -> DataFrame:
    """url, loc, kind (page or sitemap) of sitemap bodies (url, body)."""
    found = bodies.select("url", F.xpath("body", F.lit("//*[local-name()='url']/*[local-name()='loc']/text()")).alias("pages"), F.xpath("body", F.lit("//*[local-name()='sitemap']/*[local-name()='loc']/text()")).alias("maps"))
    pages = F.slice("pages", 1, most) if most else F.col("pages")
    return found.select("url", F.explode(F.concat(F.transform(pages, lambda p: F.struct(F.trim(p).alias("loc"), F.lit("page").alias("kind"))), F.transform("maps", lambda p: F.struct(F.trim(p).alias("loc"), F.lit("sitemap").alias("kind"))))).alias("e")).select("url", "e.loc", "e.kind")


def robots_allow(urls: DataFrame, robots: DataFrame, agent: str = "*") -> DataFrame:
    """Adds allowed and crawl_delay. robots: host, status, body; a missing file or one with an error status allows all."""

    @F.pandas_udf("allowed boolean, crawl_delay double")
    def judge(url: pd.Series, body: pd.Series) -> pd.DataFrame:
        parsers: dict[str, RobotFileParser] = {}
        out = []
        for u, b in zip(url, body):
            if b is None:
                out.append((True, None))
                continue
            if b not in parsers:
                parsers[b] = RobotFileParser()
                parsers[b].parse(b.splitlines())
            delay = parsers[b].crawl_delay(agent)
            out.append((parsers[b].can_fetch(agent, u), float(delay) if delay is not None else None))
        return pd.DataFrame(out, columns=["allowed", "crawl_delay"])

    known = robots.where((F.col("status") < 400) & F.col("body").isNotNull()).select(F.col("host").alias("__host"), "body")
    wide = urls.join(known, tx.host_of(F.col("url")) == F.col("__host"), "left")
    return wide.withColumn("r", judge("url", "body")).select(*urls.columns, "r.allowed", "r.crawl_delay")


def crawl(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], policy: WebPolicy = WebPolicy(), allowed: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Breadth-first: each round fetches the frontier, within the budgets of pages, minutes and depth, and follows links that are new
    and may be followed. seeds: url and priority. Gives the fetched pages with depth. The frontier stays a table; the driver
    counts only."""
    frontier = cut(seeds.select(tx.normalize_url(F.col("url")).alias("url"), F.coalesce("priority", F.lit(0)).alias("priority")).where("url is not null").groupBy("url").agg(F.max("priority").alias("priority")), "frontier")
    visited, pages, left, begin = frontier.select("url"), None, policy.max_pages, time.monotonic()
    for depth in range(policy.max_depth + 1):
        todo = frontier if allowed is None else allowed(frontier).where("allowed").select("url", "priority")
        chosen = todo.orderBy(F.desc("priority"), "url").limit(left).select("url")
        got = cut(fetch(chosen).withColumn("depth", F.lit(depth)), "fetched")
        pages = got if pages is None else pages.unionByName(got, allowMissingColumns=True)
        left -= got.count()
        if left <= 0 or depth == policy.max_depth or time.monotonic() - begin > 60 * policy.max_minutes:
            break
        links = discovered(got.select("url", "html")).where(tx.follows(F.col("link"), policy.allowed_domains, policy.disallowed_paths)).select(F.col("link").alias("url")).distinct()
        frontier = cut(links.join(visited, "url", "left_anti").withColumn("priority", F.lit(0)), "frontier")
        if not frontier.count():
            break
        visited = cut(visited.unionAll(frontier.select("url")), "visited")
    return pages


def content_error(policy: WebPolicy, text: Column, lang: Column, confidence: Column, size: Column | None = None, content_type: Column | None = None, http_status: Column | None = None) -> Column:
    """Why a page is refused; null if it is not."""
    checks = []
    if http_status is not None:
        checks.append(F.when(http_status >= 400, "http_status"))
    if size is not None:
        checks.append(F.when(F.lit(bool(policy.max_content_mb)) & (size > policy.max_content_mb * 1024 * 1024), "content_budget"))
        if content_type is not None:
            checks.append(F.when(F.contains(content_type, F.lit("pdf")) & (size > policy.pdf_size_limit_mb * 1024 * 1024), "pdf_size_limit"))
    checks.append(F.when(F.length(text) < policy.min_text_length, "min_text_length"))
    if policy.language_allowlist:
        checks.append(F.when(~lang.isin(*policy.language_allowlist) & (confidence >= policy.language_confidence_threshold), "language_allowlist"))
    return F.coalesce(*checks)


def snapshots(pages: DataFrame, policy: WebPolicy = WebPolicy()) -> DataFrame:
    """Text, canonical URL, title, description, links, checksum, quality and error of pages (url, html, and what is known)."""
    read = pages.withColumn("r", html_to_text(F.col("html"), F.col("url")))
    known = set(pages.columns)

    def given(name: str, other: Column) -> Column:
        return F.coalesce(F.col(name), other) if name in known else other

    url = tx.normalize_url(F.col("url"))
    text = F.coalesce("r.text", F.lit(""))
    lang, sure = given("lang", F.lit("und")), given("language_confidence", F.lit(0.0))
    error = content_error(policy, text, lang, sure, F.octet_length("html"), given("content_type", F.lit("text/html")), given("http_status", F.lit(200)))
    return read.select(
        given("institution", tx.host_of(F.col("url"))).alias("institution"),
        url.alias("url"),
        F.coalesce("r.canonical", url).alias("canonical_url"),
        given("http_status", F.lit(200)).alias("http_status"),
        given("content_type", F.lit("text/html")).alias("content_type"),
        text.alias("text"),
        lang.alias("lang"),
        sure.alias("language_confidence"),
        tx.checksum(text).alias("checksum"),
        F.col("r.title").alias("title"),
        F.col("r.description").alias("description"),
        F.size("r.links").alias("n_links"),
        F.length(text).alias("text_length"),
        text.rlike(r"\n\s*(?:-|\*|\d+\.)\s").alias("contains_lists"),
        error.alias("error"),
    )


def merge_cache(cache: DataFrame | None, fresh: DataFrame, now: Column | None = None, policy: WebPolicy = WebPolicy()) -> DataFrame:
    """The cache after storing: one entry for each checksum with its first URL, all URLs, newest time and size; expired entries
    go, then, over max_cache_bytes, the oldest. fresh and cache: checksum, url (or alias_urls), stored_at, size."""
    now = now if now is not None else F.current_timestamp()
    add = fresh.select("checksum", "url", F.array("url").alias("alias_urls"), "stored_at", "size")
    every = add if cache is None else cache.select(*add.columns).unionByName(add)
    merged = every.groupBy("checksum").agg(F.min_by("url", F.struct("stored_at", "url")).alias("url"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("alias_urls")))).alias("alias_urls"), F.max("stored_at").alias("stored_at"), F.max("size").alias("size"))
    live = merged.where(F.col("stored_at") + F.make_interval(days=F.lit(policy.ttl_days)) > now)
    if policy.max_cache_bytes is None:
        return live
    return within_bytes(live, policy.max_cache_bytes)


def within_bytes(entries: DataFrame, most: int, buckets: int = 4096) -> DataFrame:
    """The newest entries whose sizes sum to `most` at most. Sizes are summed by time buckets first, so that only the bucket
    where the limit falls is ordered entry by entry."""
    low, high = entries.agg(F.min(F.unix_micros("stored_at")), F.max(F.unix_micros("stored_at"))).first()
    if low is None:
        return entries
    width = max(1, (high - low) // buckets + 1)
    placed = entries.withColumn("__b", F.floor((F.lit(high) - F.unix_micros("stored_at")) / width).cast("int"))
    total, edge = 0, None
    for row in placed.groupBy("__b").agg(F.sum("size").alias("s")).orderBy("__b").collect():  # at most `buckets` rows
        if total + row["s"] > most:
            edge = row["__b"]
            break
        total += row["s"]
    if edge is None:
        return placed.drop("__b")
    sums = W.partitionBy("__b").orderBy(F.desc("stored_at"), "checksum").rowsBetween(W.unboundedPreceding, 0)
    part = placed.where(F.col("__b") == edge).withColumn("__s", F.sum("size").over(sums)).where(F.col("__s") <= most - total).drop("__s")
    return placed.where(F.col("__b") < edge).unionByName(part).drop("__b")


def crawl_metrics(fetched: DataFrame) -> DataFrame:
    """pages, failed, by error counts and sizes of snapshots."""
    return fetched.agg(F.count("*").alias("pages"), F.count_if(F.col("error").isNotNull()).alias("refused"), F.avg("text_length").alias("avg_text"), F.max("text_length").alias("max_text"), F.min("text_length").alias("min_text"))


PAGE = T.StructType([T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
