"""Secret scans through a trigram inverted index, with built-in functions only.

From each rule's regular expression a Boolean query over trigrams is derived: an
OR of ANDs of trigrams that every match contains. The index holds postings of
the trigrams that some query names, by text; postings are intersected to the
texts that may match a rule, and only those are searched with its expression.
A rule without mandatory trigrams searches every text.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as regex  # the standard library's own parse of a pattern
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tulha.llm.tables import TEXT_KEY, text_key, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of one of its groups."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # A run of the class is matched whole, so its least length can stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/@]{3,64}@"),
)
RULES = BASE_RULES + MORE_RULES

#: A choice of at most so many letters is followed letter by letter; more alternatives than this are not told apart.
LETTER_CHOICES, ALTERNATIVES = 8, 64

_Alternative = tuple[frozenset[str], str]  # trigrams met so far, the letters that just went before


# --- Boolean trigram queries -------------------------------------------------


def trigram_query(pattern: str) -> set[frozenset[str]]:
    """An OR of ANDs: sets of lower-case trigrams, one of which every match contains whole. An empty set asks for nothing."""
    found = {trigrams for trigrams, _ in _follow(regex_parser.parse(pattern), [(frozenset(), "")])}
    return {q for q in found if not any(other < q for other in found)}


def _cut(alternatives: Iterable[_Alternative]) -> list[_Alternative]:
    """The same alternatives with nothing known of what goes before."""
    return list({(trigrams, "") for trigrams, _ in alternatives})


def _letters(alternatives: list[_Alternative], choice: set[str]) -> list[_Alternative]:
    if len(choice) > LETTER_CHOICES or len(alternatives) * len(choice) > ALTERNATIVES:
        return _cut(alternatives)
    result = set()
    for trigrams, before in alternatives:
        for letter in choice:
            run = before + letter
            result.add((trigrams | {run} if len(run) == 3 else trigrams, run[-2:]))
    return list(result)


def _follow(items: Iterable, alternatives: list[_Alternative]) -> list[_Alternative]:
    for kind, value in items:
        if kind is regex.LITERAL:
            alternatives = _letters(alternatives, {chr(value).lower()})
        elif kind is regex.IN and all(k in (regex.LITERAL, regex.RANGE) for k, _ in value):
            codes = [c for k, v in value for c in ([v] if k is regex.LITERAL else range(v[0], min(v[1], v[0] + 200) + 1))]
            alternatives = _letters(alternatives, {chr(c).lower() for c in codes})
        elif kind is regex.SUBPATTERN:
            alternatives = _follow(value[-1], alternatives)
        elif kind is regex.BRANCH:
            alternatives = list({a for branch in value[1] for a in _follow(branch, alternatives)})
        elif kind is regex.MAX_REPEAT:
            least, most, part = value
            with_one = _follow(part, alternatives)
            if least == 0 and most == 1 and len(with_one) + len(alternatives) <= ALTERNATIVES:
                alternatives = list({*with_one, *alternatives})
            elif least == 0:
                alternatives = _cut(alternatives)
            else:
                for _ in range(min(least, 3) - 1):
                    with_one = _follow(part, with_one)
                alternatives = with_one if least == most <= 3 else _cut(with_one)
        elif kind is not regex.AT:
            alternatives = _cut(alternatives)
        if len(alternatives) > ALTERNATIVES:
            alternatives = _cut(alternatives)
    return alternatives


# --- index -------------------------------------------------------------------


def _quoted(letters: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{ord(c):02x}" for c in letters)


def _vocabulary_pattern(trigrams: set[str]) -> str:
    """A look-ahead that captures any of the trigrams at its place, sorted into first, second and third letters."""
    firsts = []
    for first in sorted({t[0] for t in trigrams}):
        seconds = []
        for second in sorted({t[1] for t in trigrams if t[0] == first}):
            thirds = "".join(sorted(t[2] for t in trigrams if t[:2] == first + second))
            seconds.append(f"{_quoted(second)}[{_quoted(thirds)}]")
        firsts.append(f"{_quoted(first)}(?:{'|'.join(seconds)})")
    return f"(?=({'|'.join(firsts)}))"


def build_index(documents: DataFrame, trigrams: set[str]) -> DataFrame:
    """Postings (trigram, text key) of the named trigrams in the lower-cased texts, written."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(_vocabulary_pattern(trigrams)), F.lit(1)))
    postings = documents.select(*text_key(), "text").select(*TEXT_KEY, F.explode(found).alias("trigram"))
    return written(postings.distinct(), "trigrams")


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(text key, kinds): the texts that contain all trigrams of one of a rule's alternatives."""
    asked = []
    for rule in rules:
        for number, trigrams in enumerate(sorted(sorted(q) for q in trigram_query(rule.pattern))):
            asked += [(t, rule.kind, number, len(trigrams)) for t in trigrams]
    # A row per trigram of a rule: the rules bound its size.
    terms = postings.sparkSession.createDataFrame(asked, "trigram string, kind string, number int, whole long")
    met = postings.join(F.broadcast(terms), "trigram").groupBy(*TEXT_KEY, "kind", "number").agg(F.count("*").alias("n"), F.min("whole").alias("whole"))
    return met.filter("n = whole").groupBy(*TEXT_KEY).agg(F.collect_set("kind").alias("kinds"))


# --- verification ------------------------------------------------------------

SPANS = "array<struct<start:int,place:int,end:int>>"


def _spans(rule: Rule, place: int) -> Column:
    """Matches of a rule in `text`: their places follow from the lengths of the stretches between them.

    An array grows by being copied, so n matches are added up in about sqrt(n)
    runs of sqrt(n), each from its own beginning, which are then moved to their
    places: n * sqrt(n) copied spans instead of n * n.
    """
    pattern = F.lit(rule.pattern)
    parts = F.arrays_zip(F.split("text", rule.pattern, -1).alias("gap"), F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def add(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.coalesce(F.length(part["match"]), F.lit(0))
        fits = F.isnotnull(part["match"])
        if rule.least:
            fits &= F.length(F.regexp_extract(part["match"], rule.pattern, rule.group)) >= rule.least
        one = F.array(F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(fits, F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"))

    def move(state: Column, run: Column) -> Column:
        moved = F.transform(
            run["spans"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), s["place"].alias("place"), (s["end"] + state["at"]).alias("end"))
        )
        return F.struct((state["at"] + run["at"]).alias("at"), F.concat(state["runs"], F.array(moved)).alias("runs"))

    def located(found: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(found))).cast("int")
        runs = F.transform(F.sequence(F.lit(1), F.size(found), width), lambda at: F.aggregate(F.slice(found, at, width), start, add))
        none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("runs"))
        return F.aggregate(runs, none, move, lambda state: F.flatten(state["runs"]))

    # Inside the function the zipped parts are one value; written out they would be found anew for each run.
    return F.get(F.transform(F.array(parts), located), F.lit(0))


def find_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (kind, start, end) for each document row, by start and then in the order of the rules.

    Spans are in code points, the end exclusive; those of one rule do not
    overlap, those of two may. NULL and empty texts have none, equal rows equal
    ones, and an empty table gives no rows. Very long texts are searched whole.
    Other columns are ignored.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = tuple(r for r in rules if all(queries[r.kind]))
    vocabulary = {t for r in indexed for q in queries[r.kind] for t in q}
    kinds = candidates(build_index(documents, vocabulary), indexed)
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *text_key()).join(kinds, list(TEXT_KEY), "left")
    none = F.array().cast(SPANS)
    found = []
    for place, rule in enumerate(rules):
        maybe = F.array_contains("kinds", rule.kind) if rule in indexed else F.col("text").rlike(rule.pattern)
        found.append(F.when(maybe, _spans(rule, place)).otherwise(none))
    # The one-element generator keeps later columns from computing the spans once each.
    rows = rows.select("doc_id", F.explode(F.array(F.array_sort(F.concat(*found)))).alias("spans"))
    names = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform("spans", lambda s: F.struct(F.get(names, s["place"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc_id", spans.alias("spans"))
