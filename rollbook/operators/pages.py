"""Links in a table of web pages: extract, filter by suffix, resolve."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markup that holds no links, and the link attribute itself.
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>"
HREF = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
NUMBERED = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
# Generic URI syntax (RFC 3986, appendix B):
# 1 scheme with colon, 2 authority with slashes, 3 path, 4 query, 5 fragment.
URI = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"


def hrefs(html: Column) -> Column:
    """All link targets of a page in document order, duplicates kept."""
    found = F.regexp_extract_all(F.regexp_replace(html, NOT_MARKUP, ""), F.lit(HREF), 1)

    def character(entity: Column) -> Column:
        digits = F.regexp_extract(entity, "([0-9a-fA-F]+);", 1)
        is_hex = F.lower(entity).startswith("&#x")
        point = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("int")
        # Four bytes, big end first, are the character in UTF-32.
        raw = F.unhex(F.lpad(F.hex(point), 8, "0"))
        return F.when(point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF), F.decode(raw, "UTF-32"))

    def numbered(text: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"({NUMBERED})"), 1))
        decoded = F.aggregate(
            found, text, lambda t, e: F.replace(t, e, F.coalesce(character(e), e))
        )
        return F.when(text.contains("&#"), decoded).otherwise(text)

    def plain(raw: Column) -> Column:
        bare = F.regexp_replace(raw, r"(?s)^([\"'])(.*)\1$", "$2")
        *others, ampersand = ENTITIES
        named = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), others, numbered(bare))
        return F.replace(named, F.lit(ampersand[0]), F.lit(ampersand[1]))

    return F.transform(found, plain)


def extract_links(pages: DataFrame, suffix: str, html: str = "html", *keep: str) -> DataFrame:
    """One row per link that ends in ``suffix`` (case counts), with its position."""
    links = pages.select(*keep, F.posexplode(hrefs(F.col(html))).alias("position", "href"))
    return links.filter(F.col("href").endswith(F.lit(suffix)))


def _without_dots(path: Column) -> Column:
    """Resolve '.' and '..' segments of an absolute path."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        return (
            F.when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
            .when(part == ".", done)
            .otherwise(F.concat(done, F.array(part)))
        )

    walked = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    open_end = F.element_at(parts, -1).isin(".", "..")
    return F.when(open_end, F.concat(walked, F.lit("/"))).otherwise(walked)


def resolve(base: Column, href: Column) -> Column:
    """The absolute form of ``href`` as seen from the page ``base``."""

    def part(c: Column, i: int) -> Column:
        return F.regexp_extract(c, URI, i)

    site = F.concat(part(base, 1), part(base, 2))
    base_path = part(base, 3)
    folder = F.when(base_path.contains("/"), F.regexp_extract(base_path, r"(?s)^(.*/)", 1)).otherwise(
        F.lit("/")
    )
    path = part(href, 3)
    joined = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    dotted = joined.rlike(r"/\.\.?(/|$)")
    clean_path = F.when(dotted, _without_dots(joined)).otherwise(joined)
    tail = F.concat(part(href, 4), part(href, 5))
    return (
        F.when(href == "", base)
        .when(part(href, 1) != "", href)
        .when(part(href, 2) != "", F.concat(part(base, 1), href))
        .when(path != "", F.concat(site, clean_path, tail))
        .when(part(href, 4) != "", F.concat(site, base_path, tail))
        .otherwise(F.concat(site, base_path, part(base, 4), part(href, 5)))
    )
