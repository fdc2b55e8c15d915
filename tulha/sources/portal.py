"""Download links of HTML pages, each under the heading that precedes it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.functions.html import absolute_url, decode_references, inner_text, without_hidden
from tulha.functions.names import computed_once, slug

# Heading tag and path marker of the portal's download page.
HEADING_TAG = "h4"
PATH_MARKER = "/downloads/arquivos/"


def page_links(
    pages: DataFrame,
    heading_tag: str = HEADING_TAG,
    path_marker: str = PATH_MARKER,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """`(url, html)` pages to `categoria, tabela, nome_original, url, extensao`.

    The page is cut in front of every heading, so a cut holds one heading and
    the links that follow it up to the next one: carrying the heading forward
    needs neither a window nor a shuffle. Links before the first heading, or
    under a heading without letters, are left out.
    """
    cuts = F.split(without_hidden(F.col("html")), rf"(?i)(?=<{heading_tag}[\s>])")
    sections = pages.select(
        *keep, F.col("url").alias("page_url"), F.posexplode(F.slice(cuts, 2, F.size(cuts))).alias("section", "cut")
    )
    heading = F.regexp_extract("cut", rf"(?is)^<{heading_tag}\b[^>]*>(.*?)</{heading_tag}\s*>", 1)
    titled = computed_once(sections, "categoria", slug(inner_text(heading))).where("categoria <> ''")
    anchors = titled.select(
        *keep,
        "page_url",
        "section",
        "categoria",
        F.posexplode(F.regexp_extract_all("cut", F.lit(r"(?is)<a\b[^>]*>.*?</a\s*>"), F.lit(0))).alias("position", "anchor"),
    )
    value = F.regexp_extract("anchor", r"""(?is)^<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1)
    href = decode_references(F.regexp_replace(value, "^[\"']|[\"']$", ""))
    marked = computed_once(anchors, "href", href).where(F.col("href").contains(path_marker))
    text = inner_text(F.regexp_extract("anchor", r"(?is)^<a\b[^>]*>(.*)</a\s*>$", 1))
    named = computed_once(marked, "nome_original", F.trim(F.regexp_replace(text, "^-+", ""))).where("nome_original <> ''")
    links = computed_once(named, "url", absolute_url(F.col("page_url"), F.col("href")))
    return links.select(
        *keep,
        "section",
        "position",
        "categoria",
        slug(F.col("nome_original")).alias("tabela"),
        "nome_original",
        "url",
        F.when(F.col("url").contains("."), F.lower(F.substring_index("url", ".", -1))).otherwise("").alias("extensao"),
    )
