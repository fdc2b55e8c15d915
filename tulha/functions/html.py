"""Small HTML helpers for heading and link extraction, as Column expressions."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _named_references() -> str:
    """The HTML standard's named references that end in a semicolon, as the standard library lists them, in one text."""
    return "\x1e".join(f"{name}\x1f{text}" for name, text in html5.items() if name.endswith(";"))


def without_hidden(html: Column) -> Column:
    """Drop comments, scripts and styles: their content is no document text."""
    return F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", "")


def decode_references(text: Column) -> Column:
    """Character references to characters, each once: what a reference gives is not read again.

    Named, decimal and hexadecimal references are decoded; an unknown name or a
    number that is no character stays as it is. Values without `&` are left as
    they are.
    """
    table = F.str_to_map(F.lit(_named_references()), F.lit("\x1e"), F.lit("\x1f"))
    reference = r"&#[0-9]{1,8};|&#[xX][0-9a-fA-F]{1,7};|&[A-Za-z][A-Za-z0-9]{1,31};"
    gaps = F.split(text, reference, -1)
    found = F.concat(F.regexp_extract_all(text, F.lit(reference), F.lit(0)), F.array(F.lit("")))

    def one(r: Column) -> Column:
        body = F.substring(r, 2, 40)
        digits = F.when(r.rlike("^&#[xX]"), F.conv(F.regexp_extract(r, "([0-9a-fA-F]+);$", 1), 16, 10)).otherwise(F.regexp_extract(r, "([0-9]+);$", 1))
        code = digits.try_cast("long")
        real = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        letter = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(r == "", "").when(r.startswith("&#"), F.when(real, letter).otherwise(r)).otherwise(F.coalesce(F.try_element_at(table, body), r))

    decoded = F.array_join(F.zip_with(gaps, F.transform(found, one), lambda gap, letter: F.concat(gap, letter)), "")
    return F.when(text.contains("&"), decoded).otherwise(text)


def inner_text(markup: Column) -> Column:
    """Text between tags, each piece stripped, joined without a gap."""
    return decode_references(F.regexp_replace(markup, r"^\s+|\s+$|\s*<[^>]*>\s*", ""))


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link against its page."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    bare = F.regexp_extract(base, r"^([^?#]*)", 1)
    path = F.substr(bare, F.length(origin) + 1)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, _without_dots(href)))
        .when(href.startswith("?"), F.concat(bare, href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), href))
        .otherwise(F.concat(origin, _without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), href))))
    )


def _without_dots(path: Column) -> Column:
    """Resolve `.` and `..` segments of an absolute path."""
    resolved = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda kept, part: F.when(part == ".", kept)
        .when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1))))
        .otherwise(F.concat(kept, F.array(part))),
    )
    return F.when(path.contains("/."), F.array_join(resolved, "/")).otherwise(path)
