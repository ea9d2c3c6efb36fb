"""Fetching over the network, as a function from a table of URLs to a table of pages.

The client is any function url -> (status, content_type, body, final_url); tests and offline runs bring their own. Rates and
retries hold for each Python worker; a table of robots rules is joined before (operators.crawl.robots_allow)."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..policies import WebPolicy
from .shared import cut

Client = Callable[[str], tuple[int, str, bytes, str]]
PAGE = "url string, status int, content_type string, body binary, final_url string, error string, attempts int"


@dataclass
class TokenBucket:
    """At most `rate` calls a second over time, and `burst` at once."""

    rate: float
    burst: int
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    tokens: float = field(init=False)
    at: float = field(init=False)

    def __post_init__(self) -> None:
        if self.rate <= 0 or self.burst < 1:
            raise ValueError("rate and burst must be positive")
        self.tokens, self.at = float(self.burst), self.clock()

    def take(self) -> float:
        """Waits for a token; gives the seconds waited."""
        now = self.clock()
        self.tokens = min(self.burst, self.tokens + (now - self.at) * self.rate)
        self.at = now
        wait = max(0.0, (1 - self.tokens) / self.rate)
        if wait:
            self.sleep(wait)
            self.tokens += wait * self.rate
            self.at = now + wait
        self.tokens -= 1
        return wait


def pauses(first: float, most: float, attempts: int, jitter: Callable[[int], float] = lambda k: 0.0) -> list[float]:
    """Doubling pauses between attempts, each capped, jitter included."""
    return [min(most, first * 2**k + jitter(k)) for k in range(max(0, attempts - 1))]


def fetcher(client: Client, policy: WebPolicy = WebPolicy(), rate: float = 6.0, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Callable[[DataFrame], DataFrame]:
    """Server errors and exceptions are tried again; a body over the budget is dropped with an error. Results are stored
    before use, because pages change between runs of a task."""

    def one(url: str) -> tuple:
        error = None
        for k, pause in enumerate([0.0, *pauses(0.5, 10.0, attempts)]):
            if pause:
                sleep(pause)
            try:
                status, kind, body, final = client(url)
            except Exception as e:  # noqa: BLE001
                error = f"{type(e).__name__}: {e}"
                continue
            if status >= 500:
                error = f"status {status}"
                continue
            over = policy.max_content_mb and len(body) > policy.max_content_mb * 1024 * 1024
            said = "content_budget" if over else f"status {status}" if status >= 400 else None
            return url, status, kind, None if over else body, final, said, k + 1
        return url, None, None, None, None, error, attempts

    def run(urls: DataFrame) -> DataFrame:
        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            bucket = TokenBucket(rate, max(1, int(rate)), sleep=sleep)
            for batch in batches:
                rows = []
                for url in batch["url"]:
                    bucket.take()
                    rows.append(one(url))
                yield pd.DataFrame(rows, columns=["url", "status", "content_type", "body", "final_url", "error", "attempts"])

        return cut(urls.select("url").mapInPandas(each, PAGE), "pages")

    return run


def decoded(body: Column, content_type: Column) -> Column:
    """Text of a payload: the declared character set if it is known, else UTF-8 if the bytes are, else Latin-1."""
    declared = F.lower(F.regexp_extract(content_type, r"""(?i)charset\s*=\s*["']?([\w.:-]+)""", 1))
    latin = F.decode(body, "ISO-8859-1")
    utf8 = F.try_validate_utf8(body.cast("string"))
    return F.when(declared.isin("iso-8859-1", "latin-1", "latin1", "windows-1252", "cp1252"), latin).when(declared.isin("utf-16", "utf-16le", "utf-16be"), F.decode(body, "UTF-16")).otherwise(F.coalesce(utf8, latin))


def as_pages(fetched: DataFrame) -> DataFrame:
    """Pages for operators.crawl.snapshots: the good ones, decoded."""
    text = fetched.where("error is null and (content_type like '%html%' or content_type like '%text%')")
    return text.select("url", decoded(F.col("body"), F.col("content_type")).alias("html"), F.col("status").alias("http_status"), "content_type")
