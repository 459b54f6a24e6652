"""HTML extraction: anchors, comments, API references, sitemaps; expressions first, a parser where context counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as T
from . import urls as U

ANCHOR = r"(?is)(<a\b[^>]*>.*?</a>)"


def links(pages: DataFrame, html: str = "html", base: str = "url") -> DataFrame:
    """H01, H08, F62. Anchors of pages: ord, href, title, absolute normal link; no fragments, scripts, mail or phone links."""
    found = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 1)
    out = pages.select("*", F.posexplode(found).alias("ord", "__a"))
    out = out.withColumn("href", F.trim(F.regexp_extract("__a", r"(?i)\bhref\s*=\s*[\"']([^\"']*)[\"']", 1)))
    out = out.where((F.col("href") != "") & ~F.lower("href").rlike(r"^(#|javascript:|mailto:|tel:)"))
    title = T.collapse(F.regexp_replace(F.regexp_replace("__a", r"(?is)<[^>]+>", " "), r"&nbsp;", " "))
    return out.withColumn("title", title).withColumn("link", U.normalize(F.col("href"), F.col(base))).drop("__a", html)


def comments(html: Column) -> Column:
    """H03. Texts of the comments."""
    return F.regexp_extract_all(html, F.lit(r"(?s)<!--(.*?)-->"), 1)


def comment_links(pages: DataFrame, html: str = "html", base: str = "url") -> DataFrame:
    """H03. Anchors inside comments."""
    inside = pages.select(*[c for c in pages.columns if c != html], F.explode(comments(F.col(html))).alias(html))
    return links(inside, html, base)


def api_references(pages: DataFrame, html: str = "html", base: str = "url") -> DataFrame:
    """H04, H05. Links of rel service, alternate or describedby with a data type, data-* endpoints, and specification URLs
    in scripts: (ord, kind, link)."""
    tags = F.filter(F.regexp_extract_all(F.col(html), F.lit(r"(?is)(<link\b[^>]*>)"), 1), lambda t: F.lower(t).rlike(r"application/([a-z0-9.+-]*json|[a-z0-9.+-]*yaml)|service-(desc|doc)|describedby"))
    hrefs = F.transform(tags, lambda t: F.struct(F.lit("link").alias("kind"), F.regexp_extract(t, r"(?i)\bhref\s*=\s*[\"']([^\"']+)", 1).alias("href")))
    data = F.transform(F.regexp_extract_all(F.col(html), F.lit(r"(?is)\bdata-(?:api|url|endpoint|source)[\w-]*\s*=\s*[\"']([^\"']+)"), 1), lambda h: F.struct(F.lit("data").alias("kind"), h.alias("href")))
    spec = F.transform(F.regexp_extract_all(F.col(html), F.lit(r"(?is)\burl\s*:\s*[\"']([^\"']*(?:openapi|swagger|api-docs)[^\"']*)[\"']"), 1), lambda h: F.struct(F.lit("openapi").alias("kind"), h.alias("href")))
    keep = [c for c in pages.columns if c != html]
    out = pages.select(*keep, F.posexplode(F.concat(hrefs, data, spec)).alias("ord", "r")).select(*keep, "ord", "r.kind", "r.href").where("href <> ''")
    return out.withColumn("link", U.normalize(F.col("href"), F.col(base)))


def sitemap_locations(xml: Column) -> Column:
    """S10. Locations of a sitemap or index, whatever the namespace."""
    return F.transform(F.xpath(xml, F.lit("//*[local-name()='loc']/text()")), lambda x: F.trim(x))


def sitemap_entries(documents: DataFrame, hosts: DataFrame, max_documents: int = 8, max_urls: int = 500) -> DataFrame:
    """S08, F54. From a table (source_id, url, xml) of fetched sitemap documents: pages in scope, in order, without
    repeats, at most ``max_urls`` of each source from its first ``max_documents`` documents."""
    from pyspark.sql import Window

    doc_no = F.row_number().over(Window.partitionBy("source_id").orderBy("url"))
    docs = documents.withColumn("__d", doc_no).where(F.col("__d") <= max_documents)
    e = docs.where(~F.lower("xml").contains("<sitemapindex")).select("source_id", F.col("url").alias("sitemap_url"), "__d", F.posexplode(sitemap_locations(F.col("xml"))).alias("__p", "loc"))
    e = e.withColumn("link", U.normalize(F.col("loc"))).withColumn("host", U.host(F.col("link")))
    e = e.join(F.broadcast(hosts.select("source_id", "host").distinct()), ["source_id", "host"], "left_semi")
    e = e.withColumn("__r", F.row_number().over(Window.partitionBy("source_id", "link").orderBy("__d", "__p"))).where("__r = 1")
    e = e.withColumn("__n", F.row_number().over(Window.partitionBy("source_id").orderBy("__d", "__p"))).where(F.col("__n") <= max_urls)
    return e.select("source_id", "link", "sitemap_url")


def signals(html: Column) -> Column:
    """A27, A28. Counts of tags that tell a page's kind."""
    n = lambda rx: F.regexp_count(html, F.lit(rx))
    return F.struct(n(r"(?i)<form\b").alias("forms"), n(r"(?i)<input\b").alias("inputs"), n(r"(?i)<select\b").alias("selects"), n(r"(?i)<script\b").alias("scripts"), n(r"(?i)<a\b").alias("anchors"), n(r"(?i)<table\b").alias("tables"))


def contexts(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """H02. For each anchor: its text, its parent's text (3 to 280 characters), and up to two of the eight headings before
    it that name a year, joined without repeats. A streaming parser over Arrow batches: order within a page matters here,
    which expressions cannot follow. Null and broken HTML give what the parser reads of it."""

    def run(frames):
        import re
        from html.parser import HTMLParser

        import pandas as pd

        class Walk(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.stack, self.heads, self.out, self.anchor, self.head = [[]], [], [], None, None

            def handle_starttag(self, tag, attrs):
                if tag in ("p", "li", "td", "div", "section", "article", "tr"):
                    self.stack.append([])
                if tag == "a":
                    self.anchor = (dict(attrs).get("href") or "", [], self.stack[-1], list(self.heads[-8:]))
                if re.fullmatch("h[1-6]", tag):
                    self.head = []

            def handle_endtag(self, tag):
                if tag in ("p", "li", "td", "div", "section", "article", "tr") and len(self.stack) > 1:
                    self.stack.pop()
                if tag == "a" and self.anchor:
                    self.out.append(self.anchor)
                    self.anchor = None
                if re.fullmatch("h[1-6]", tag) and self.head is not None:
                    self.heads.append(" ".join("".join(self.head).split()))
                    self.head = None

            def handle_data(self, data):
                self.stack[-1].append(data)
                if self.anchor:
                    self.anchor[1].append(data)
                if self.head is not None:
                    self.head.append(data)

        clean = lambda parts: " ".join(" ".join(parts).split())
        for f in frames:
            rows = []
            for k, page in zip(f[key], f[html], strict=True):
                w = Walk()
                w.feed(page or "")
                for n, (href, own, parent, heads) in enumerate(w.out):
                    around = clean(parent)
                    named = [h for h in heads if re.search(r"\b(19|20)\d{2}\b", h)][-2:]
                    rows.append((k, n, href, clean(own), " | ".join(dict.fromkeys([*named, *([around] if 3 <= len(around) <= 280 else [])]))))
            yield pd.DataFrame(rows, columns=[key, "ord", "href", "anchor_text", "context_text"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, ord int, href string, anchor_text string, context_text string")
