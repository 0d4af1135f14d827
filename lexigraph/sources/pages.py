"""Raw web pages parsed into title, body and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The entities that HTML defines for its own markup, and the blank.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


LINK = r"""(?is)<a\b[^>]*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)')[^>]*>(.*?)</a\s*>"""


def plain_text(markup: Column) -> Column:
    text = F.regexp_replace(markup, "<[^>]*>", " ")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def parse_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, title, text, anchors)`` of each page's HTML.

    Tags may be in either case and have attributes in any order, in double or single quotes.
    """
    html = F.col("html")
    link = F.lit(LINK)
    return pages.select(
        "page_id",
        "url",
        plain_text(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)).alias("title"),
        plain_text(F.regexp_extract(html, r"(?is)<article\b[^>]*>(.*?)</article\s*>", 1)).alias("text"),
        F.zip_with(
            F.zip_with(
                F.regexp_extract_all(html, link, F.lit(1)), F.regexp_extract_all(html, link, F.lit(2)), lambda a, b: F.concat(a, b)
            ),
            F.regexp_extract_all(html, link, F.lit(3)),
            lambda href, text: F.struct(href.alias("href"), plain_text(text).alias("text")),
        ).alias("anchors"),
    )


def page_links(parsed: DataFrame) -> DataFrame:
    """One row per link, in page order."""
    return parsed.select("page_id", F.posexplode("anchors").alias("pos", "a")).select(
        "page_id", "pos", "a.href", F.col("a.text").alias("anchor")
    )


# Scheme, host and path of a URL, as far as they are there; the fragment is left out.
URL = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?"


def without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments taken out of an absolute path."""
    none = F.array().cast("array<string>")

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))
        return F.when(part == "..", up).when(part == ".", done).otherwise(F.array_append(done, part))

    kept = F.aggregate(F.split(path, "/"), none, step)
    # A path that ends with a dot segment names a folder.
    ends = F.when(path.rlike(r"(?:^|/)\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.regexp_replace(F.concat(F.array_join(kept, "/"), ends), "^$", "/")


def resolve(href: Column, base: Column) -> Column:
    """The absolute URL that ``href`` means on the page ``base``, without its fragment."""
    scheme, host, path, query = (F.regexp_extract(href, URL, k) for k in (1, 2, 3, 4))
    own_scheme, own_host, own_path, own_query = (F.regexp_extract(base, URL, k) for k in (1, 2, 3, 4))
    site = F.concat(own_scheme, F.lit("://"), own_host)
    folder = F.regexp_extract(own_path, "^(.*/)", 1)
    below = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), path))
    return (
        F.when(scheme != "", F.regexp_replace(href, "#.*$", ""))
        .when(host != "", F.concat(own_scheme, F.lit("://"), host, F.when(path == "", F.lit("")).otherwise(without_dots(path)), query))
        .when(path != "", F.concat(site, without_dots(below), query))
        .otherwise(F.concat(site, own_path, F.when(query != "", query).otherwise(own_query)))
    )


def page_edges(parsed: DataFrame) -> DataFrame:
    """``(page_id, url, target)``: the distinct URLs a page links to, and the page that has it, if any.

    Of several pages at one URL the smallest id counts. Links to other schemes than the web's
    (``mailto:`` and the like) are left out.
    """
    links = parsed.select("page_id", F.col("url").alias("base"), F.explode("anchors").alias("a"))
    edges = links.select("page_id", resolve(F.trim("a.href"), F.col("base")).alias("url")).filter(F.col("url").rlike("^(?i:https?)://")).distinct()
    pages = parsed.groupBy(F.regexp_replace("url", "#.*$", "").alias("url")).agg(F.min("page_id").alias("target"))
    return edges.join(pages, "url", "left").select("page_id", "url", "target")
