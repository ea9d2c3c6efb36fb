"""HTML to text with its structure: one parser pass, Arrow-batched."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .udfs import canonical

# Tags whose content is dropped, and tags that break lines.
SKIPPED = frozenset({"script", "style", "noscript"})
BLOCKS = frozenset({"p", "blockquote", "pre", "article", "section", "aside", "header", "footer", "main", "nav", "summary", "details", "figure", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "br"})
RESULT = T.StructType([*[T.StructField(n, T.StringType()) for n in ("text", "canonical", "title", "description")], T.StructField("links", T.ArrayType(T.StringType()))])


def clean(text: str) -> str:
    """Single spaces within lines, single blank lines between them, none at the ends."""
    lines = [" ".join(line.split()) for line in text.splitlines()]
    out = [line for i, line in enumerate(lines) if line or (i and lines[i - 1])]
    return "\n".join(out).strip("\n")


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines, self.inline, self.lists, self.skip = [], [], [], 0
        self.title, self.in_title, self.meta, self.links, self.link = [], False, {}, [], None

    def flush(self) -> None:
        found = " ".join(" ".join(self.inline).split())
        self.inline.clear()
        if found:
            self.lines.append(found)

    def handle_starttag(self, tag, attrs) -> None:
        given = {k: v or "" for k, v in attrs}
        if tag in SKIPPED:
            self.skip += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "meta":
            name = given.get("property") or given.get("name")
            if name:
                self.meta.setdefault(name.lower(), given.get("content", ""))
        elif tag == "link" and "canonical" in given.get("rel", "").lower().split():
            self.link = self.link or given.get("href")
        elif tag in ("ul", "ol"):
            self.flush()
            self.lists.append([tag, 0])
        elif tag == "li":
            self.flush()
            if self.lists:
                kind, _ = self.lists[-1]
                self.lists[-1][1] += 1
                self.inline.append("- " if kind == "ul" else f"{self.lists[-1][1]}. ")
        elif tag in BLOCKS:
            self.flush()
        if tag == "a" and given.get("href"):
            self.links.append(given["href"])

    def handle_endtag(self, tag) -> None:
        if tag in SKIPPED:
            self.skip = max(0, self.skip - 1)
        elif tag == "title":
            self.in_title = False
        elif tag in ("ul", "ol"):
            self.flush()
            if self.lists:
                self.lists.pop()
        elif tag == "li" or tag in BLOCKS:
            self.flush()

    def handle_data(self, data) -> None:
        if self.in_title:
            self.title.append(data)
        elif not self.skip:
            self.inline.append(data)


def read(html: str | None, base: str | None = None) -> tuple[str | None, str | None, str | None, str | None, list[str]]:
    """text, canonical URL, title, description and links (canonical, each once, in order)."""
    if html is None:
        return None, None, None, None, []
    page = _Page()
    page.feed(html)
    page.close()
    page.flush()
    text = clean("\n".join(page.lines)) or clean(re.sub(r"<[^>]+>", " ", html))
    link = next((c for c in (canonical(u, base) for u in (page.link, page.meta.get("og:url")) if u) if c), None)
    title = clean("".join(page.title)).replace("\n", " ") or None
    description = next((d for d in (clean(page.meta.get(k, "")).replace("\n", " ") for k in ("description", "og:description")) if d), None)
    links = list(dict.fromkeys(c for c in (canonical(u, base) for u in page.links) if c))
    return text, link, title, description, links


@F.pandas_udf(RESULT)
def html_to_text(html: pd.Series, base: pd.Series) -> pd.DataFrame:
    rows = [read(h, b) for h, b in zip(html, base)]
    return pd.DataFrame(rows, columns=["text", "canonical", "title", "description", "links"])
