"""Name normalisation: Unicode text to plain `a-z0-9_` identifiers."""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable
from functools import cache
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Stand-ins for a blank name and for a name led by a digit.
BLANK_NAME = "column"
DIGIT_PREFIX = "col_"


def _ascii(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def plain_slug(text: str) -> str:
    """The slug of one name held by the driver; `slug` does the same to a column."""
    return re.sub("[^a-z0-9]+", "_", _ascii(text).lower()).strip("_")


def column_name(raw: object) -> str:
    """One safe column name. NUL bytes left by a misread 16-bit file are removed."""
    text = "" if raw is None else str(raw).replace("\0", "").strip()
    name = plain_slug(text or BLANK_NAME) or BLANK_NAME
    return DIGIT_PREFIX + name if name[0].isdigit() else name


def column_names(raw_names: Iterable[object]) -> list[str]:
    """Safe names in order; a repeated name gets the first free suffix from `_2` on."""
    given: set[str] = set()
    names = []
    for base in map(column_name, raw_names):
        suffixes = (f"{base}_{n}" for n in count(2))
        name = base if base not in given else next(s for s in suffixes if s not in given)
        given.add(name)
        names.append(name)
    return names


def _as_landed(spelled: Column) -> Column:
    """Spark's own metadata spells special characters of paths as URLs do."""
    return F.url_decode(F.replace(spelled, F.lit("+"), F.lit("%2B")))


def file_name() -> Column:
    """The name of a row's file as it was landed."""
    return _as_landed(F.col("_metadata.file_name"))


def file_path() -> Column:
    """The path of a row's file as a listing gives it, but for the slashes after the scheme."""
    return _as_landed(F.col("_metadata.file_path"))


def conform_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its safe name; a projection, no job."""
    return df.toDF(*column_names(df.columns))


@cache
def _foldings() -> tuple[str, str, dict[str, str]]:
    """Letters that fold to one ASCII letter (two aligned strings) and those that fold to several."""
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for code in range(0x80, sys.maxunicode + 1):
        letter = chr(code)
        folded = _ascii(letter) if unicodedata.decomposition(letter) else ""
        if len(folded) == 1 and code <= 0xFFFF:
            single[letter] = folded
        elif folded:
            several[letter] = folded
    return "".join(single), "".join(single.values()), several


# Code points of the accented Latin letters of western languages, which all
# fold to one letter or to none (the two ranges leave out the Ĳ ligatures).
_LATIN = [*range(0xC0, 0x132), *range(0x134, 0x180)]


def _is_ascii(text: Column) -> Column:
    """One byte per character; cheaper than a pattern match."""
    return F.octet_length(text) == F.char_length(text)


def fold_accents(text: Column) -> Column:
    """Compatibility-decompose and drop what is not ASCII, without a UDF.

    Plain ASCII values skip the work, accented Latin values take one
    `translate`; only values holding other letters take the longer way.
    """
    source, target, several = _foldings()
    folds = dict(zip(source, target))
    latin = sorted(map(chr, _LATIN), key=lambda letter: letter not in folds)
    latin_target = "".join(folds[letter] for letter in latin if letter in folds)

    special = "[" + _regex_class("".join(several)) + "]"
    # One literal, split when the plan is optimised, keeps the plan small.
    pairs = "\x1e".join(f"{letter}\x1f{folded}" for letter, folded in several.items())
    lookup = F.str_to_map(F.lit(pairs), F.lit("\x1e"), F.lit("\x1f"))
    expanded = F.aggregate(
        F.array_distinct(F.regexp_extract_all(text, F.lit(special), F.lit(0))),
        text,
        lambda acc, letter: F.replace(acc, letter, F.element_at(lookup, letter)),
    )
    latin_folded = F.translate(text, "".join(latin), latin_target)
    return (
        F.when(_is_ascii(text), text)
        .when(_is_ascii(latin_folded), latin_folded)
        .otherwise(F.regexp_replace(F.translate(expanded, source, target), r"[^\x00-\x7F]", ""))
    )


def _regex_class(letters: str) -> str:
    """Letters as a compact regex class of code-point ranges."""
    codes = sorted(map(ord, letters))
    spans: list[list[int]] = []
    for code in codes:
        if spans and code == spans[-1][1] + 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans)


def slug(text: Column) -> Column:
    """`Área Colhida (ha)` to `area_colhida_ha`; may be empty or start with a digit."""
    return F.btrim(F.regexp_replace(F.lower(fold_accents(text)), "[^a-z0-9]+", "_"), F.lit("_"))


def spaced(text: Column) -> Column:
    """The same normalisation with single spaces, for term matching."""
    return F.translate(slug(text), "_", " ")


def mentions(text: Column, terms: Iterable[str]) -> Column:
    """True when normalised text holds any term.

    Terms of up to three letters must stand as whole words; longer ones match
    anywhere. The short terms share one pattern.
    """
    terms = list(terms)
    short = [t for t in terms if len(t) <= 3]
    found = F.lit(False)
    if short:
        found = text.rlike(r"\b(?:" + "|".join(re.escape(t) for t in short) + r")\b")
    for term in terms:
        if len(term) > 3:
            found = found | text.contains(term)
    return found


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters read several times.

    A plain column would be copied into every filter condition that names it;
    the output of a generator is not, so the value is worked out once per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
