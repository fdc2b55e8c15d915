"""Personal data: generous candidate generators, boosted trees over format and context, calibrated thresholds.

The base kinds (email, ip, card, phone) are fixed formats and are always
reported. Generators propose further, overlapping spans: obfuscated addresses,
national telephone numbers, bank accounts, social security numbers, IPv6.
Boosted trees score every candidate. They are trained on candidates of a bounded
sample of the documents, labelled by whether they are valid base spans, and on
seeded examples of the other kinds with look-alikes. Scores are calibrated on a
fold of their own, and each kind's threshold keeps the wanted precision there.
"""

from __future__ import annotations

import ast
import ipaddress
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tulha.llm.boosting import BoostedTrees
from tulha.llm.tables import hash_share, with_columns

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("obfuscated_email", "national_phone", "iban", "ssn", "ipv6")
KINDS = BASE_KINDS + MORE_KINDS
#: Documents that the trees learn from (about; copies count once), and candidates of each.
SAMPLE_DOCUMENTS, SAMPLE_CANDIDATES = 4000, 5
EXAMPLES = 250
WANTED_PRECISION = 0.97
CONTEXT_LETTERS = 30
SEED = 7

Span = tuple[int, int, str]


# --- base spans --------------------------------------------------------------

# Fixed formats. Each run of digits or letters is tried from its beginning only, since no later start can match more.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit)
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((start, domain.end(), "email"))
                end = domain.end()
        at = text.find("@", max(at + 1, end))
    return found


def _addresses(text: str) -> list[Span]:
    """Four groups of digits; the whole match is passed over even where a group exceeds 255."""
    return [(m.start(), m.end(), "ip") for m in _IP.finditer(text)]


def valid(text: str, span: Span) -> bool:
    """Whether a match of a base pattern is of its kind."""
    start, end, kind = span
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[start:end].split("."))
    digits = _digits(text[start:end])
    return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_matches(text: str) -> list[Span]:
    """Matches of the base patterns, valid or not."""
    found = _emails(text) if "@" in text else []
    if _DIGITS.search(text):
        if "." in text:
            found += _addresses(text)
        found += [(m.start(), m.end(), "card") for m in _CARD.finditer(text)]
        if "+" in text:
            found += [(m.start(), m.end(), "phone") for m in _PHONE.finditer(text)]
    return found


# --- candidates --------------------------------------------------------------

_DIGITS = re.compile("[0-9]")
_NATIONAL = re.compile(
    r"(?<![\w+.-])(?:(?:\([0-9]{2,5}\)\x20?|00?[0-9]{1,4}[\x20/.-])[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,3}"
    r"|(?:1[\x20.-])?[2-9][0-9]{2}[\x20.-][0-9]{3}[\x20.-][0-9]{4})(?![\w-])"
)
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_HEX = "[0-9A-Fa-f]{1,4}"
#: All groups written, or groups left out at "::", an IPv4 address at the end included.
_IPV6 = re.compile(
    rf"(?<![\w:.])(?:(?:{_HEX}:){{3,7}}{_HEX}|(?:(?:{_HEX}:){{1,7}}|:)(?::{_HEX}){{0,6}}:(?:[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}|{_HEX})|(?:{_HEX}:){{2,7}}:)(?![\w:])"
)
_HIDDEN_AT = re.compile(r"\x20?[\[({]at[\])}]\x20?|\x20at\x20", re.IGNORECASE)
_HIDDEN_HOST = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({]dot[\])}]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{2,63}){1,4}(?![\w])", re.IGNORECASE)


def candidates(text: str) -> list[Span]:
    """Spans of the further kinds; they may overlap each other and base spans."""
    found: list[Span] = []
    if _DIGITS.search(text):
        for kind, pattern in (("national_phone", _NATIONAL), ("iban", _IBAN), ("ssn", _SSN)):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    if "::" in text or text.count(":") > 2:
        found += [(m.start(), m.end(), "ipv6") for m in _IPV6.finditer(text)]
    for m in _HIDDEN_AT.finditer(text):
        host = _HIDDEN_HOST.match(text, m.end())
        start = m.start()
        while host and start and text[start - 1] in _LOCAL:
            start -= 1
        if host and start < m.start():
            found.append((start, host.end(), "obfuscated_email"))
    return found


_HINTS = {
    "phone": re.compile(r"(?i)\b(?:tel|tél|phone|telefon|teléfono|telefone|mobile|mobil|handy|fax|call|whatsapp)"),
    "bank": re.compile(r"(?i)\b(?:iban|account|konto|compte|cuenta|bank|bic|card|visa|karte|carte|tarjeta)"),
    "id": re.compile(r"(?i)\b(?:ssn|social|security|tax|id|passport|ausweis)\b"),
    "mail": re.compile(r"(?i)(?:e-?mail|mail|contact|kontakt|contacto|courriel|correo)"),
    "host": re.compile(r"(?i)\b(?:ip|host|server|login|addr|address|client)"),
    "number": re.compile(r"(?i)\b(?:order|invoice|isbn|version|ver|page|pages|date|price|no|nr|part|serial|ref|code|bestellung|commande|pedido|seite)\b"),
}


def features(text: str, span: Span) -> list[float]:
    start, end, kind = span
    body = text[start:end]
    before, after = text[max(0, start - CONTEXT_LETTERS) : start], text[end : end + 10]
    digits = _digits(body)
    groups = [len(g) for g in re.findall(r"[0-9]+", body)] or [0]
    letters = sum(c.isalpha() for c in body)
    rest = before.rstrip(" :=#")
    return [
        *[float(kind == k) for k in KINDS],
        len(body), len(digits), letters, len(groups), max(groups), min(groups), groups[0], groups[-1],
        sum(c == " " for c in body), sum(c in "-/" for c in body), sum(c == "." for c in body), sum(c in "()" for c in body),
        sum(c in "[]{}" for c in body), sum(c == ":" for c in body), float("::" in body), float(ipv6_valid(body)) if kind == "ipv6" else 0.0,
        float(body[:1] == "+"), float(body[:1] == "0"), float(body[:2] == "00"), float(body[:1] == "("),
        len(set(digits)), float(luhn(digits)) if digits else 0.0, float(iban_valid(body)) if kind == "iban" else 0.0,
        float(max(([int(g) for g in re.findall(r"[0-9]{1,9}", body)]), default=0) <= 255),
        float(re.fullmatch(r"(?:000|666|9..)-.*|...-00-.*|.*-0000", body) is None) if kind == "ssn" else 0.0,
        sum(c.isupper() for c in body), float(len(set(body.lower()) - set("0123456789abcdef:")) == 0),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(after[:1] in "%€$£°"), float(rest[-1:] in "€$£"),
        *[float(bool(p.search(before))) for p in _HINTS.values()],
    ]


def iban_valid(text: str) -> bool:
    plain = re.sub(r"[^A-Z0-9]", "", text)
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def ipv6_valid(text: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


# --- seeded examples ---------------------------------------------------------

_FILL = ("und", "the", "que", "para", "on", "le", "die", "with", "and", "los", "pour")


def _examples(count: int = EXAMPLES) -> list[tuple[str, int]]:
    """Texts with a candidate, and whether it is personal data, from a fixed seed."""
    draw = random.Random(SEED)
    number = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    word = lambda: "".join(draw.choice("abcdefghiklmnoprstu") for _ in range(draw.randint(3, 8)))

    def iban(good: bool) -> str:
        land, body = draw.choice(("DE", "FR", "ES", "PT")), number(18)
        check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
        plain = land + f"{check if good else (check + draw.randint(1, 90)) % 97:02d}" + body
        return " ".join(plain[i : i + 4] for i in range(0, len(plain), 4)) if draw.random() < 0.5 else plain

    made: list[tuple[str, int]] = []
    for _ in range(count):
        left, right = (" ".join(draw.choice(_FILL) for _ in range(3)) for _ in range(2))
        hint = draw.choice(("", "", "tel ", "phone: ", "call ", "Telefon "))
        made += [
            (f"{left} {hint}({number(3)}) {draw.choice('23456789')}{number(2)}-{number(4)} {right}", 1),
            (f"{left} {draw.choice(('tel ', 'phone: ', 'fax '))}0{number(3)} {number(3)} {number(4)} {right}", 1),
            (f"{left} {draw.choice(('order', 'invoice', 'part no', 'isbn', 'page'))} 0{number(3)}-{number(3)}-{number(4)} {right}", 0),
            (f"{left} 0{number(1)}.{number(2)}.{number(4)} {right}", 0),
            (f"{left} 00{number(2)} {number(4)} {number(2)} {right}", 0),
            (f"{left} {draw.choice(('', 'iban ', 'account '))}{iban(True)} {right}", 1),
            (f"{left} {draw.choice(('', 'code ', 'ref '))}{iban(False)} {right}", 0),
            (f"{left} {draw.choice(('ssn ', 'social security ', 'ssn: '))}{draw.randint(100, 665)}-{draw.randint(10, 99)}-{draw.randint(1000, 9999)} {right}", 1),
            (f"{left} {draw.choice(('', 'part ', 'ref ', 'order '))}{number(3)}-{number(2)}-{number(4)} {right}", 0),
            (f"{left} {word()}.{word()} (at) {word()} (dot) {draw.choice(('com', 'org', 'de', 'fr'))} {right}", 1),
            (f"{left} {draw.choice(('mail ', 'contact '))}{word()} at {word()} dot {draw.choice(('com', 'org', 'net'))} {right}", 1),
            (f"{left} meet at {word()} dot {word()}s {right}", 0),
            (f"{left} {':'.join(f'{draw.randint(4096, 65535):x}' for _ in range(8))} {right}", 1),
            (f"{left} {':'.join(number(2) for _ in range(draw.randint(4, 6)))} {right}", 0),
        ]
    for _ in range(count):
        left, right = (" ".join(draw.choice(_FILL) for _ in range(3)) for _ in range(2))
        group = lambda: f"{draw.randint(0, 65535):x}"
        hexed = lambda: "".join(draw.choice("abcdef") for _ in range(draw.randint(3, 4)))
        call, other = draw.choice(("", "tel ", "phone: ", "call ")), draw.choice(("order ", "invoice ", "part no ", "isbn ", "ref "))
        local = "{0}.{1}" if draw.random() < 0.3 else "{0}"
        at, dot = draw.choice((("at", "dot"), ("At", "Dot"), ("AT", "DOT")))
        opened, closed = draw.choice(("()", "[]", "{}"))
        end = draw.choice(("com", "org", "net", "de", "fr"))
        american = lambda by: by.join((draw.choice("23456789") + number(2), number(3), number(4)))
        made += [
            (f"{left} {call}{american('-')} {right}", 1),
            (f"{left} {call}{american('.')} {right}", 1),
            (f"{left} {draw.choice(('tel ', 'phone: ', 'call '))}{american(' ')} {right}", 1),
            (f"{left} {other}{american(draw.choice('-. '))} {right}", 0),
            (f"{left} {american(' ')} {right}", 0),
            (f"{left} {local.format(word(), word())} {opened}{at}{closed} {word()} {opened}{dot}{closed} {end} {right}", 1),
            (f"{left} {local.format(word(), word())}{draw.choice((' ', ''))}{opened}{at}{closed}{draw.choice((' ', ''))}{word()}.{end} {right}", 1),
            (f"{left} {draw.choice(('mail ', 'contact '))}{word()} {at} {word()}.{end} {right}", 1),
            (f"{left} {word()} at {word()}.{draw.choice(_FILL).title()} {right}", 0),
            (f"{left} {':'.join(group() for _ in range(draw.randint(1, 3)))}::{':'.join(group() for _ in range(draw.randint(1, 4)))} {right}", 1),
            (f"{left} {draw.choice(('::', 'fe80::', '2001:db8::'))}{draw.choice(('1', group()))} {right}", 1),
            (f"{left} {hexed()}::{hexed()} {right}", 0),
        ]
    return made


@dataclass
class Selector:
    """The trees, the calibration (slope, intercept) and each kind's least probability."""

    trees: BoostedTrees
    slope: float
    intercept: float
    least: dict[str, float]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.log_odds(x) + self.intercept, -30, 30)))

    def select(self, text: str | None) -> tuple[list[Span], list[Span]]:
        """The base spans, and the further ones: likely enough, and apart from likelier ones; they may overlap base spans."""
        if not text:
            return [], []
        base = [s for s in base_matches(text) if valid(text, s)]
        more = candidates(text)
        chosen: list[Span] = []
        if more:
            chance = self.probability(np.array([features(text, s) for s in more], float))
            taken: list[Span] = []
            for p, s in sorted(zip(chance.tolist(), more, strict=True), key=lambda x: (-x[0], x[1])):
                if p >= self.least[s[2]] and not any(s[0] < e and b < s[1] for b, e, _ in taken):
                    taken.append(s)
            chosen = taken
        return base, chosen


def learn(documents: DataFrame, rows: int = SAMPLE_DOCUMENTS) -> Selector:
    """A selector trained on a sample of about `rows` documents that show a digit or an at sign, and on seeded examples."""
    vector = StructType([StructField("candidates", StringType())])
    sample = hash_share(documents.select("text").filter(F.col("text").rlike("[0-9@]")), "text", rows)

    def make(texts: pa.Array) -> list[pa.Array]:
        made = []
        for text in texts.to_pylist():
            spans = base_matches(text or "")[: 20 * SAMPLE_CANDIDATES]
            spans = sorted(spans, key=lambda s: -len(_digits(text[s[0] : s[1]])))[:SAMPLE_CANDIDATES]
            made.append(repr([(features(text, s), int(valid(text, s))) for s in spans]))
        return [pa.array(made, pa.string())]

    # Copies of a text teach the same, so they count once.
    found = with_columns(sample, "text", vector, make).select("candidates").distinct().collect()
    data = [x for r in found for x in ast.literal_eval(r["candidates"])]
    for text, label in _examples():
        data += [(features(text, s), label) for s in candidates(text)]
    data.sort(key=repr)
    x, y = np.array([f for f, _ in data], float), np.array([v for _, v in data], float)
    fold = np.arange(len(x)) % 4 == 0
    trees = BoostedTrees().fit(x[~fold], y[~fold])
    odds = trees.log_odds(x[fold])
    slope, intercept = _platt(odds, y[fold])
    selector = Selector(trees, slope, intercept, {})
    chance = selector.probability(x[fold])
    for number, kind in enumerate(KINDS):
        mine = x[fold][:, number] == 1
        selector.least[kind] = _least_probability(chance[mine], y[fold][mine])
    return selector


def _platt(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    a = np.stack([odds, np.ones(len(odds))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-6)[:, None]).T @ a + 1e-2 * np.eye(2), a.T @ (y - p) - 1e-2 * (w - [1.0, 0.0]))
        w += np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def _least_probability(chance: np.ndarray, y: np.ndarray, precision: float = WANTED_PRECISION) -> float:
    """The least probability, a half or more, from which on the fold's candidates have the wanted precision."""
    order = np.argsort(-chance, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= precision)
    return max(0.5, float(chance[order[good[-1]]])) if len(good) else 1.1


# --- operator ----------------------------------------------------------------

SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _ordered(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for a, b, k in sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))]


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each stretch of overlapping spans replaced by its first span's kind in brackets."""
    if not spans:
        return text
    parts, at, spans = [], 0, sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))
    end = -1
    for start, stop, kind in spans:
        if start >= end:
            parts += [text[at:start], f"[{kind.upper()}]"]
        end = at = max(end, stop)
    return "".join([*parts, text[at:]])


def find_personal_data(documents: DataFrame, selector: Selector) -> DataFrame:
    """The documents with base_spans, spans (all of them) and redacted text; columns of these names are replaced.

    Spans are (kind, start, end) in code points, the end exclusive, in the order
    of start and kind. NULL and empty texts have none; a NULL stays NULL.
    """
    shared = documents.sparkSession.sparkContext.broadcast(selector)

    def make(texts: pa.Array) -> list[pa.Array]:
        values = texts.to_pylist()
        found = [shared.value.select(t) for t in values]
        return [
            pa.array([_ordered(base) for base, _ in found], _ARROW_SPANS),
            pa.array([_ordered(base + more) for base, more in found], _ARROW_SPANS),
            pa.array([redact(t, base + more) for t, (base, more) in zip(values, found, strict=True)], pa.string()),
        ]

    added = StructType([StructField("base_spans", SPANS), StructField("spans", SPANS), StructField("redacted", StringType())])
    return with_columns(documents, "text", added, make)


def without_personal_data(documents: DataFrame, rows: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """The documents, all columns, with personal data replaced in `text`, and n_chars counted anew where there is such a column."""
    names = documents.columns
    found = find_personal_data(documents.select("text", F.struct(*[f"`{c}`" for c in names]).alias("_document")), learn(documents, rows))
    changed = F.size("spans") > 0
    types = dict(documents.dtypes)

    def column(name: str):
        if name == "text":
            return F.col("redacted").alias("text")
        old = F.col("_document")[name]
        if name == "n_chars":
            return F.when(changed, F.length("redacted").cast(types[name])).otherwise(old).alias(name)
        return old.alias(name)

    return found.select([column(c) for c in names])
