"""Hierarchies in pages: items of nested lists with their parents, films and articles of a menu, subforums and topics of forum pages."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import slug
from threadloom.sources.extract import VOID, portions

ITEM = """page_id long, pos int, depth int, title string, url string, whole_url string, direct boolean, classes string, list_classes string, first_list boolean,
 parent int, parent_title string, parent_url string, parent_direct boolean, parent_classes string"""
REF = "page_id long, pos int, kind string, url string, slug string, title string, started_by string"


class _Lists(HTMLParser):
    """A stack of open tags; an item ends with its list or with the next item of the list, closed or not."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.items = [], []  # entries: (tag, item or list)
        self.link = None

    def _top(self, kind):
        return next((n for _, n in reversed(self.stack) if n is not None and n["kind"] == kind), None)

    def _cut(self, tags):
        """Close everything down to the nearest open tag of these; a list bounds the search for an item."""
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag in tags:
                del self.stack[at:]
                return
            if "li" in tags and tag in ("ul", "ol"):
                return

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        node = None
        if tag in ("ul", "ol"):
            inside = self._top("item")
            node = {"kind": "list", "classes": a.get("class", ""), "item": inside}
            if inside is not None:
                inside["lists"].append(node)
        elif tag == "li":
            self._cut(("li",))
            within = self._top("list")
            parent = within["item"] if within else None
            same = [x for x in parent["lists"] if x["classes"] == within["classes"]] if parent else []
            node = {"kind": "item", "pos": len(self.items), "parent": parent, "depth": parent["depth"] + 1 if parent else 0, "classes": a.get("class", ""), "list": within, "first_list": not same or same[0] is within, "title": None, "url": None, "direct": False, "lists": []}
            self.items.append(node)
        elif tag == "a":
            item = self._top("item")
            self.link = item if item is not None and item["title"] is None else None
            if self.link:
                item.update(title="", url=a.get("href", ""), direct=self.stack[-1][1] is item)
        if tag not in VOID:
            self.stack.append((tag, node))

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = None
        self._cut((tag,))

    def handle_data(self, data):
        if self.link:
            self.link["title"] += data.strip()


def parse_lists(base: str, html: str) -> list[dict]:
    page = _Lists()
    page.feed(html)
    page.close()
    rows = []
    for i in page.items:
        up = i["parent"]
        rows.append({
            **{k: i[k] for k in ("pos", "depth", "title", "url", "direct", "classes", "first_list")}, "whole_url": urljoin(base, i["url"] or "") if i["url"] is not None else None, "list_classes": i["list"]["classes"] if i["list"] else "",
            "parent": up["pos"] if up else None, **{f"parent_{k}": up[k] if up else None for k in ("title", "url", "direct", "classes")}})
    return rows


def _job(pages: DataFrame, rows_of, schema: str) -> DataFrame:
    names = [c.split()[0] for c in schema.replace("\n", " ").split(", ")]

    def run(batches):
        for pdf in (part for batch in batches for part in portions(batch)):
            found = [{"page_id": i, **r} for i, u, h in zip(pdf["page_id"], pdf["url"], pdf["html"], strict=True) for r in rows_of(u or "", h or "")]
            yield pd.DataFrame(found, columns=names).astype({n: "Int32" for n in ("pos", "depth", "parent") if n in names})

    return pages.select("page_id", "url", "html").mapInPandas(run, schema)


def list_items(pages: DataFrame) -> DataFrame:
    """Each item of each list of a page, in order, with its first link, as written and against the page's address, and its parent item's; items without a link have nulls.

    One Arrow job, a page at a time: the parent's columns come with the row, so a hierarchy needs no join. `direct` tells that the link
    is a child of the item, `first_list` that the list is the parent's first of its classes.
    """
    return _job(pages, parse_lists, ITEM)


def film_menu(pages: DataFrame, site: str) -> DataFrame:
    """(page_id, film_title, film_slug, article_title, article_url, article_slug, pos) of menus of films with their articles.

    A film is an item with children whose own link leads nowhere (none, '#', or off the site); its articles are the items of its first
    submenu. An article without an address is left out, and a film without articles has no row.
    """
    of_film = F.col("parent_classes").contains("menu-item-has-children") & F.col("parent_direct")
    nowhere = (F.col("parent_url") == "") | (F.col("parent_url") == "#") | ~F.col("parent_url").contains(site)
    article = F.array_contains(F.split("classes", r"\s+"), "menu-item") & F.array_contains(F.split("list_classes", r"\s+"), "sub-menu") & F.col("first_list") & (F.col("url") != "") & (F.col("url") != "#")
    found = list_items(pages).filter(of_film & nowhere & article)
    path = F.regexp_extract("whole_url", r"^(?:[a-z]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    return found.select("page_id", F.col("parent_title").alias("film_title"), slug(F.col("parent_title")).alias("film_slug"), F.col("title").alias("article_title"), F.col("whole_url").alias("article_url"), F.regexp_extract(path, "([^/]*)/*$", 1).alias("article_slug"), "pos")


class _Forum(HTMLParser):
    """Links to forums and topics with the text of the row, item or box around them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.boxes, self.links, self.link, self.inner = [], [], [], None, 0

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        box = {"words": []} if tag in ("tr", "li", "div") else None
        main = a.get("id") == "bbpress-forums"
        self.inner += main
        if tag == "a":
            self.link = {"href": a.get("href", ""), "words": [], "box": self.boxes[-1] if self.boxes else None, "inside": self.inner > 0}
            self.links.append(self.link)
        if box:
            self.boxes.append(box)
        if tag not in VOID:
            self.stack.append((tag, box, main))

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = None
        if any(t == tag for t, _, _ in self.stack):
            while True:
                t, box, main = self.stack.pop()
                self.inner -= main
                if box:
                    self.boxes.pop()
                if t == tag:
                    break

    def handle_data(self, data):
        if word := data.strip():
            for box in self.boxes:
                box["words"].append(word)
            if self.link:
                self.link["words"].append(word)


def parse_forum(url: str, html: str) -> list[dict]:
    page = _Forum()
    page.feed(html)
    page.close()
    own = re.match(r"^/forums/forum/([^/]+)/?$", urlsplit(url).path)
    inside = 'id="bbpress-forums"' in html
    found: dict[str, dict] = {}
    for link in page.links:
        full = urljoin(url, link["href"])
        m = re.match(r"^/forums/(forum|topic)/([^/]+)/?$", urlsplit(full).path)
        title = " ".join(link["words"])
        if not m or not title or (inside and not link["inside"]) or (m[1] == "forum" and own and m[2] == own[1]):
            continue
        row = " ".join(link["box"]["words"]) if link["box"] and m[1] == "topic" else ""
        by = re.search(r"Started by:\s*([^\n]+)", row)
        found[full] = {"kind": m[1], "url": full, "slug": m[2], "title": title, "started_by": by[1].strip() if by else None}
    return [{"pos": n, **r} for n, r in enumerate(found.values())]


def forum_page_refs(pages: DataFrame) -> DataFrame:
    """Subforums ('forum') and topics ('topic') that a forum page lists, one row per address with its last title; topics with the
    text after 'Started by:' in their row."""
    return _job(pages, parse_forum, REF)
