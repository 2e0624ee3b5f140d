"""Facts of article pages: structured data of their JSON-LD blocks first, then elements and meta tags. JVM-side, no Python."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["WebPage", "Article", "BlogPosting"]
# The character references that attributes and titles use.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&#039;": "'", "&nbsp;": " ", "&amp;": "&"}


def _blank(c: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def plain_text(html: Column) -> Column:
    """Text of a piece of HTML without tags, on one line; null if nothing is left."""
    return _blank(reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), REFERENCES.items(), F.regexp_replace(html, r"<[^>]*>", " ")))


def meta_content(html: Column, *names: str) -> Column:
    """Content of the first meta tag with one of the names as property, name or itemprop, in either order of attributes."""
    which = rf'(?:property|name|itemprop)="(?:{"|".join(names)})"'
    found = [F.regexp_extract(html, rf'(?s)<meta\s[^>]*{which}[^>]*\scontent="([^"]*)"', 1), F.regexp_extract(html, rf'(?s)<meta\s[^>]*content="([^"]*)"[^>]*\s{which}', 1)]
    return F.coalesce(*[plain_text(c) for c in found])


def element_text(html: Column, attribute: str, value: str, tag: str = r"\w+") -> Column:
    """Text of the first element whose attribute holds the value as a word, up to the element's first end tag."""
    return plain_text(F.regexp_extract(html, rf'(?s)<({tag})(?=\s[^>]*\b{attribute}="(?:[^"]*\s)?{value}(?:\s[^"]*)?")[^>]*>(.*?)</\1>', 2))


def link_texts(html: Column, attribute: str, pattern: str) -> Column:
    """Texts of links whose attribute fits a pattern, in order; links without text are left out."""
    links = F.regexp_extract_all(html, F.lit(rf'(?s)<a\s[^>]*\b{attribute}="{pattern}"[^>]*>.*?</a>'), F.lit(0))
    return F.filter(F.transform(links, lambda a: plain_text(a)), lambda t: t.isNotNull())


def ld_node(html: Column, kinds: list[str] = KINDS) -> Column:
    """The page's structured data as a VARIANT: of its JSON-LD blocks the first that is an object without @graph, or that has a node of
    one of the kinds in its @graph, then that node. Broken blocks and blocks of other shapes are passed over; null without one."""
    blocks = F.regexp_extract_all(html, F.lit(r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))

    def node(text: Column) -> Column:
        v = F.try_parse_json(text)
        graph = F.try_variant_get(v, '$["@graph"]', "array<variant>")
        first = F.get(F.filter(graph, lambda n: F.try_variant_get(n, '$["@type"]', "string").isin(kinds)), F.lit(0))
        return F.when(F.try_variant_get(v, '$["@graph"]', "variant").isNotNull(), first).when(F.schema_of_variant(v).startswith("OBJECT"), v)

    return F.get(F.filter(F.transform(blocks, node), lambda v: v.isNotNull()), F.lit(0))


def article_facts(pages: DataFrame) -> DataFrame:
    """(page_id, article_slug, article_id, title, author, date_published, date_modified, description, image, tags, categories, restricted).

    Dates, description and image come from the structured data, else from time elements and meta tags; the author from the page's
    author element, else from the structured data. The id is that of the body's or article's classes, else the slug. Null html has
    nulls, empty lists and the slug.
    """
    html = F.coalesce("html", F.lit(""))
    slug = F.regexp_extract(F.coalesce("url", F.lit("")), r"^(?:[a-z]+:)?(?://[^/?#]*)?(?:[^?#]*/)?([^/?#]+)/*(?:[?#].*)?$", 1)
    ld = pages.select("page_id", "url", html.alias("html"), ld_node(html).alias("_ld"))
    get = lambda path: _blank(F.try_variant_get("_ld", path, "string"))
    text = lambda path: F.when(F.schema_of_variant(F.try_variant_get("_ld", path, "variant")) == "STRING", get(path))
    h = F.col("html")
    shown = F.regexp_extract(h, r'(?s)<time\s(?=[^>]*class="[^"]*\bentry-date\b)[^>]*\bdatetime="([^"]*)"', 1)
    ident = F.coalesce(_blank(F.regexp_extract(h, r'<body\s[^>]*class="(?:[^"]*\s)?postid-(\w+)', 1)), _blank(F.regexp_extract(h, r'<article\s[^>]*id="post-(\d+)', 1)), slug)
    title = F.coalesce(meta_content(h, "og:title"), element_text(h, "class", "entry-title"), plain_text(F.regexp_extract(h, r"(?s)<h1(?:\s[^>]*)?>(.*?)</h1>", 1)), plain_text(F.regexp_extract(h, r"(?s)<title[^>]*>(.*?)</title>", 1)), slug)
    rel = link_texts(h, "rel", r"(?:[^\"]*\s)?category(?:\s[^\"]*)?")
    return ld.select(
        "page_id", slug.alias("article_slug"), ident.alias("article_id"), title.alias("title"),
        F.coalesce(element_text(h, "class", "author"), element_text(h, "rel", "author"), text("$.author.name"), text("$.author[0].name"), meta_content(h, "author")).alias("author"),
        F.coalesce(get("$.datePublished"), _blank(shown), element_text(h, "class", "entry-date", "time"), meta_content(h, "article:published_time", "datePublished")).alias("date_published"),
        F.coalesce(get("$.dateModified"), meta_content(h, "article:modified_time", "dateModified")).alias("date_modified"),
        F.coalesce(get("$.description"), meta_content(h, "description"), meta_content(h, "og:description")).alias("description"),
        F.coalesce(text("$.image"), text("$.image.url"), text("$.image[0]"), text("$.image[0].url"), meta_content(h, "og:image")).alias("image"),
        link_texts(h, "rel", r"(?:[^\"]*\s)?tag(?:\s[^\"]*)?").alias("tags"), F.when(F.size(rel) > 0, rel).otherwise(link_texts(h, "class", r"[^\"]*category[^\"]*")).alias("categories"),
        h.rlike("wpmem_restricted_msg|wpmem_login_form|wpmem_restricted").alias("restricted"))
