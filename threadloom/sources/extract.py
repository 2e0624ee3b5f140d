"""Rows from HTML pages. One Arrow job parses each page once; a profile (plain data) names the classes of a site's theme."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE = """page_id long, title string, text string, links array<struct<href:string,text:string,kind:string>>, images array<struct<src:string,alt:string,caption:string>>,
 quotes array<struct<text:string,attributed_to:string>>, blocks array<struct<type:string,text:string>>, meta map<string,string>, has_next boolean"""
POSTS = "page_id long, post_id string, parent_post_id string, position int, post_type string, author string, role string, raw_time string, content_text string"

BLOCKS = {"p": "paragraph", "blockquote": "quote", "pre": "code", "code": "code", "ul": "list", "ol": "list", **{f"h{n}": "heading" for n in range(1, 7)}}
SKIP = {"script", "style", "nav", "footer"}
VOID = {"br", "img", "meta", "link", "input", "hr", "source"}
THREAD = {"post": "bbp-reply", "author": "bbp-author-name", "role": "bbp-author-role", "time": "bbp-reply-post-date", "content": "bbp-reply-content"}


class _Page(HTMLParser):
    """Collects links, images, quotes and blocks in one pass; unclosed tags end with their parent."""

    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.host = base, urlsplit(base).netloc
        self.links, self.images, self.quotes, self.blocks, self.meta = [], [], [], [], {}
        self.title, self.words, self.open, self.skip = "", [], [], 0
        self.link = self.quote = self.block = self.cite = self.figure = None

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag in SKIP:
            self.skip += 1
        if tag == "a" and a.get("href"):
            href = urljoin(self.base, a["href"])
            self.link = {"href": href, "text": "", "kind": "internal" if urlsplit(href).netloc == self.host else "external"}
        elif tag == "img" and a.get("src"):
            self.images.append({"src": urljoin(self.base, a["src"]), "alt": a.get("alt", ""), "caption": None})
        elif tag == "meta" and a.get("content"):
            self.meta[a.get("property") or a.get("name") or ""] = a["content"]
        elif tag == "blockquote":
            self.quote = {"text": "", "attributed_to": None}
        elif tag in ("cite", "figcaption"):
            self.cite, self.figure = (("", self.figure) if tag == "cite" else (self.cite, ""))
        if tag in BLOCKS and not self.skip:
            self.end_block()
            self.block = {"type": BLOCKS[tag], "text": ""}
        if tag == "br":
            self.handle_data("\n")
        if tag not in VOID:
            self.open.append(tag)

    def end_block(self):
        if self.block and (text := " ".join(self.block["text"].split())):
            self.blocks.append({**self.block, "text": text})
        self.block = None

    def handle_endtag(self, tag):
        if tag in self.open:
            while self.open and self.open.pop() != tag:
                pass
        if tag in SKIP:
            self.skip = max(0, self.skip - 1)
        if tag == "a" and self.link:
            self.links.append({**self.link, "text": " ".join(self.link["text"].split())})
            self.link = None
        elif tag == "blockquote" and self.quote:
            before = self.blocks[-1]["text"] if self.blocks else ""
            said = re.search(r"(.{1,60}?) wrote:$", before)
            who = self.quote["attributed_to"] or (said[1].strip() if said else None)
            self.quotes.append({"text": " ".join(self.quote["text"].split()), "attributed_to": who})
            self.quote = None
        elif tag == "cite" and self.cite is not None:
            if self.quote:
                self.quote["attributed_to"] = self.cite.strip()
            self.cite = None
        elif tag == "figcaption" and self.figure is not None:
            if self.images:
                self.images[-1]["caption"] = self.figure.strip()
            self.figure = None
        if tag in BLOCKS:
            self.end_block()

    def handle_data(self, data):
        if "title" in self.open[-1:]:
            self.title += data
            return
        if self.link:
            self.link["text"] += data
        if self.skip:
            return
        if self.cite is not None:
            self.cite += data
            return
        if self.figure is not None:
            self.figure += data
        if self.quote:
            self.quote["text"] += data
        if self.block:
            self.block["text"] += data
        if "head" not in self.open:
            self.words.append(data)


def parse_page(base: str, html: str) -> dict:
    page = _Page(base)
    page.feed(html)
    page.close()
    page.end_block()
    text = " ".join(" ".join(page.words).split())
    shown = re.search(r"Viewing .*?(\d+) through (\d+) \(of (\d+) total\)", text)
    return {"title": page.meta.get("og:title") or page.title.strip(), "text": text, "links": page.links, "images": page.images, "quotes": page.quotes, "blocks": page.blocks, "meta": dict(page.meta), "has_next": bool(shown and int(shown[2]) < int(shown[3]))}


def portions(pdf: pd.DataFrame, rows: int = 200, most: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """A batch of pages in slices of up to so many rows and characters of html (one row at least): what is parsed stands for a few at a time."""
    ends, at = pdf["html"].str.len().fillna(0).astype("int64").cumsum().to_numpy(), 0
    while at < len(pdf):
        before = ends[at - 1] if at else 0
        n = max(1, min(rows, int(ends.searchsorted(before + most, side="right")) - at))
        yield pdf.iloc[at : at + n]
        at += n


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per page with its links, images, quotes, blocks, meta values and pagination. A null html is an empty page."""
    def run(batches):
        for pdf in (part for batch in batches for part in portions(batch)):
            rows = [{"page_id": i, **parse_page(u or "", h or "")} for i, u, h in zip(pdf["page_id"], pdf["url"], pdf["html"], strict=True)]
            yield pd.DataFrame(rows, columns=["page_id", "title", "text", "links", "images", "quotes", "blocks", "meta", "has_next"])

    return pages.select("page_id", "url", "html").mapInPandas(run, PAGE)


def extract_posts(pages: DataFrame, theme: dict[str, str] = THREAD) -> DataFrame:
    """Posts of thread pages: elements whose class holds theme['post'] with ids post-N; parent and position from classes."""
    def posts_of(html: str):
        for m in re.finditer(rf'<div[^>]*class="([^"]*\b{theme["post"]}\b(?!-)[^"]*)"[^>]*id="post-(\d+)"[^>]*>(.*?)(?=<div[^>]*class="[^"]*\b{theme["post"]}\b(?!-)[^"]*"[^>]*id="post-|\Z)', html, re.DOTALL):
            classes, ident, body = m.groups()
            part = lambda k: (x[1] if (x := re.search(rf'class="[^"]*\b{theme[k]}\b[^"]*"[^>]*>(.*?)</', body, re.DOTALL)) else None)  # noqa: B023, E731
            parent, position = re.search(r"\bparent-(\d+)\b", classes), re.search(r"\bposition-(\d+)\b", classes)
            content = re.search(rf'class="[^"]*\b{theme["content"]}\b[^"]*"[^>]*>(.*?)</div>', body, re.DOTALL)
            yield {
                "post_id": ident, "parent_post_id": parent[1] if parent else None, "position": int(position[1]) if position else None, "post_type": "topic" if re.search(r"\btype-topic\b", classes) else "reply",
                "author": part("author"), "role": part("role"), "raw_time": part("time"), "content_text": parse_page("", f"<p>{content[1]}</p>")["text"] if content else ""}

    def run(batches):
        for pdf in (part for batch in batches for part in portions(batch)):
            rows = [{"page_id": i, **p} for i, h in zip(pdf["page_id"], pdf["html"], strict=True) for p in posts_of(h or "")]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in POSTS.split(", ")]).astype({"position": "Int32"})

    return pages.select("page_id", "html").mapInPandas(run, POSTS)


def clean_content(text: Column, author: Column, raw_time: Column, role: Column) -> Column:
    """Content without a time, an author or a role that leaked to its start."""
    out = text
    for lead in (raw_time, author, role):
        out = F.when(lead.isNotNull() & (lead != "") & out.startswith(lead), F.trim(F.substr(out, F.length(lead) + 1))).otherwise(out)
    return out


def topic_refs(pages: DataFrame) -> DataFrame:
    """(page_id, url, slug, title) of links to topics of forum pages, distinct."""
    links = extract_pages(pages).select("page_id", F.explode("links").alias("l")).filter(F.col("l.href").rlike("/topic/[^/]+/?$"))
    return links.select("page_id", F.col("l.href").alias("url"), F.regexp_extract("l.href", "/topic/([^/]+)/?$", 1).alias("slug"), F.col("l.text").alias("title")).distinct()


def forum_refs(pages: DataFrame) -> DataFrame:
    """(page_id, url, slug, title) of links to forums of an index page: one row per url, with the title of its last link that has one."""
    links = extract_pages(pages).select("page_id", F.posexplode("links").alias("pos", "l"))
    slug = F.regexp_extract(F.parse_url("l.href", F.lit("PATH")), "^/forums/forum/([^/]+)/?$", 1)
    found = links.select("page_id", "pos", F.col("l.href").alias("url"), slug.alias("slug"), F.col("l.text").alias("title")).filter("slug <> '' and title <> ''")
    return found.groupBy("page_id", "url", "slug").agg(F.max_by("title", "pos").alias("title"))


def outcome(html: Column) -> Column:
    return F.when(html.isNull() | (html == ""), "empty").when(html.contains("wpmem_restricted_msg"), "restricted").when(~html.contains("<article"), "no_article").otherwise("parsed")


def json_ld(html: Column) -> Column:
    """The first JSON-LD block of a page as a VARIANT; null if there is none or it is broken."""
    return F.try_parse_json(F.nullif(F.regexp_extract(html, r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1), F.lit("")))


def transcript_between(text: Column, marker: str, end: str, paywall: str) -> Column:
    """Text after a marker and before a disclaimer; null behind a paywall or without the marker."""
    after = F.trim(F.substring_index(F.split_part(text, F.lit(marker), F.lit(2)), end, 1))
    return F.when(text.contains(paywall) | ~text.contains(marker), None).otherwise(after)


def choose_transcript(options: Column) -> Column:
    """Of array<map<string,string>> with type and url: the first plain text, else the first."""
    plain = F.filter(options, lambda o: o["type"].startswith("text/plain"))
    return F.coalesce(F.get(plain, F.lit(0)), F.get(options, F.lit(0)))
