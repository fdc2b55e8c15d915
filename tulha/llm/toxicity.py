"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and context windows.

The lexicon (words, and word beginnings of inflected terms) is learned from a
bounded sample of labelled documents, as are the weights of the score. Every
word of every document is read by the automaton, so misspelled terms count too.
A window around each match tells quotation from abuse; quoted matches add to a
feature of their own.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tulha.llm.automaton import LexiconAutomaton, edits_allowed
from tulha.llm.tables import hash_sample, with_columns, written

#: About so many labelled documents are learned from, twice as many at most.
SAMPLE_ROWS = 20_000
#: A term is in so many toxic sample documents at least, and this many times likelier there than in others.
TERM_DOCUMENTS, TERM_RATIO = 3, 20.0
#: Chance that any word of the sample passes for a term by accident.
ACCIDENT = 0.05
#: Word beginnings of these lengths are terms if so many different words show them.
PREFIX_LENGTHS, PREFIX_WORDS = range(4, 8), 4
#: Letters on each side of a match that tell whether it is quoted.
CONTEXT_LETTERS = 60
HELD_OUT_FOLDS = 5

TOKEN = re.compile(r"[^\W_]+")
#: What a worker remembers: so many words, none of more letters; longer words are read each time they come.
REMEMBERED_WORDS, REMEMBERED_LETTERS = 300_000, 64
#: Sample texts of one least triple hash are near copies if half of so many least hashes agree.
SKETCH_HASHES = 8
_LONG_RUN = re.compile(r"(.)\1{2,}")
_OPENING = re.compile(r"""["“„«‹”»]""")
_REPORTED = re.compile(
    r"\b(?:said|says|say|called|calls|calling|quote|quoted|quotes|word|words|term|terms|wrote|slur|insult|insulted|"
    r"sagte|nannte|genannt|wort|zitat|dit|appelé|mot|terme|dijo|llamó|palabra|término)\b[^.!?]{0,30}$"
)

MATCH = StructType(
    [
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("term", StringType()),
        StructField("edits", IntegerType()),
        StructField("quoted", DoubleType()),
    ]
)
FEATURES = ("exact", "misspelled", "beginning", "quoted", "density")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label must not be learned from; a NULL doc_id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_FOLDS == 0, F.lit(False))


@dataclass
class Model:
    """The lexicon with each term's weight, and the weights of the features."""

    words: dict[str, float]
    beginnings: dict[str, float]
    fuzzy: dict[str, int]
    weights: list[float] = field(default_factory=lambda: [0.0] * (len(FEATURES) + 1))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if not k.startswith("_")}

    def term(self, word: str) -> tuple[int, str, int, float] | None:
        """The feature a word counts for, its term, the edits and the term's weight."""
        cache = self.__dict__.setdefault("_cache", {})
        if word in cache:
            return cache[word]
        found = self._found(word)
        if len(word) <= REMEMBERED_LETTERS:
            if len(cache) > REMEMBERED_WORDS:
                cache.clear()
            cache[word] = found
        return found

    def _found(self, word: str) -> tuple[int, str, int, float] | None:
        if word in self.words:
            return 0, word, 0, self.words[word]
        beginning = next((word[:n] for n in PREFIX_LENGTHS if word[:n] in self.beginnings), None)
        if beginning:
            return 2, beginning, 0, self.beginnings[beginning]
        automaton = self.__dict__.get("_automaton")
        if automaton is None:
            automaton = self._automaton = LexiconAutomaton(self.fuzzy)
        near = automaton.match(word) or next(((plain, 1) for plain in unrepeated(word) if plain in self.fuzzy), None)
        return (1, near[0], near[1], self.words[near[0]]) if near else None

    def read(self, text: str | None) -> tuple[list[float], list[dict]]:
        """The features of a text, and its matches."""
        lowered = (text or "").lower()
        words = TOKEN.findall(lowered)
        if not any(self.term(w) for w in set(words)):
            return [0.0] * len(FEATURES), []
        sums, matches = [0.0] * 4, []
        for m in TOKEN.finditer(lowered):
            found = self.term(m.group())
            if found:
                kind, term, edits, weight = found
                quoted = quotation(lowered, m.start(), m.end())
                sums[kind] += weight * (1 - quoted)
                sums[3] += weight * quoted
                matches.append({"start": m.start(), "end": m.end(), "term": term, "edits": edits, "quoted": quoted})
        abuse = sum(1 - m["quoted"] for m in matches)
        return [math.log1p(x) for x in sums] + [math.sqrt(abuse / len(words))], matches

    def score(self, features: list[float]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features, strict=True))))))


def unrepeated(word: str) -> list[str]:
    """What a word repeats as a whole, and the word with its long runs of a letter cut to one or two."""
    plain = []
    period = (word + word).find(word, 1)
    if period < len(word):
        plain.append(word[:period])
    if _LONG_RUN.search(word):
        plain += [_LONG_RUN.sub(r"\1", word), _LONG_RUN.sub(r"\1\1", word)]
    return plain


def quotation(text: str, start: int, end: int) -> float:
    """How likely a match is quoted rather than said: by quotation marks around it and by words of reporting before it."""
    before, after = text[max(0, start - CONTEXT_LETTERS) : start], text[end : end + CONTEXT_LETTERS]
    inside = len(_OPENING.findall(before.rpartition("\n")[2])) % 2 == 1 and bool(_OPENING.search(after.partition("\n")[0]))
    tight = bool(re.search(r"""["“„«‹'‘]$""", before)) and bool(re.match(r"""["”“»›'’]""", after))
    reported = bool(_REPORTED.search(before))
    return min(1.0, 0.6 * (inside or tight) + 0.2 * tight + 0.3 * reported)


# --- learning ----------------------------------------------------------------


def _sample(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, toxic) of about `rows` labelled documents that are not held out, chosen by a hash.

    Of several labels of a document the higher counts; of several texts the least.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = hash_sample(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", rows)
    # The sample has 2 * `rows` rows of two numbers at most, so it is small enough to broadcast.
    joined = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    texts = joined.groupBy("doc_id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return texts.groupBy("text").agg(F.max("toxic").alias("toxic"))


def _lexicon(sample: DataFrame) -> Model:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(w, int(t > 0)) for x, t in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True) for w in set(TOKEN.findall((x or "").lower()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64())], ["word", "toxic"])

    def keyed(texts: pa.Array) -> list[pa.Array]:
        words = [TOKEN.findall((t or "").lower()) for t in texts.to_pylist()]
        hashes = [heapq.nsmallest(SKETCH_HASHES, {zlib.crc32(" ".join(w[i : i + 3]).encode()) for i in range(max(1, len(w) - 2))}) for w in words]
        return [pa.array(hashes, pa.list_(pa.int64()))]

    # Near copies often share the least hash of their word triples; with half of the other least hashes alike they count
    # once, by the least text, or their rare words would look like terms. A group is within the sample's bound.
    sample = with_columns(sample, "text", StructType([StructField("sketch", ArrayType(LongType()))]), keyed)
    group = Window.partitionBy(F.get("sketch", F.lit(0)), "toxic").orderBy("text")
    sample = sample.withColumns({"place": F.row_number().over(group), "first": F.first("sketch").over(group)})
    alike = 2 * F.size(F.array_intersect("sketch", "first")) >= F.greatest(F.size("sketch"), F.size("first"))
    sample = written(sample.filter((F.col("place") == 1) | ~alike).select("text", "toxic"), "apart")
    totals = sample.agg(F.sum((F.col("toxic") > 0).cast("long")).alias("bad"), F.count("*").alias("n")).first()
    bad, good = totals["bad"] or 0, totals["n"] - (totals["bad"] or 0)
    if not bad or not good:
        return Model({}, {}, {})
    words = sample.mapInArrow(run, "word string, toxic long").groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    words = written(words.select("word", "bad", (F.col("n") - F.col("bad")).alias("good")), "vocabulary")
    # Chernoff's bound on the chance of so many toxic documents among those with the word, for all words together.
    share, n = bad / (bad + good), F.col("bad") + F.col("good")
    part = F.col("bad") / n
    gain = n * (part * F.log(part / share) + F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0))
    sure = gain >= math.log(max(2, words.count()) / ACCIDENT)
    ratio = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
    likely = (F.col("bad") >= TERM_DOCUMENTS) & (ratio >= TERM_RATIO)
    terms = {r["word"]: math.log(r["ratio"]) for r in words.filter(likely & sure & (F.length("word") >= 3)).select("word", ratio.alias("ratio")).collect()}
    starts = words.select(F.explode(F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in PREFIX_LENGTHS])).alias("word"), "bad", "good").filter("word is not null")
    starts = starts.groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.sum((F.col("bad") > 0).cast("long")).alias("kinds"), F.max("bad").alias("most"))
    # What one frequent word owes to itself says nothing about its beginning.
    starts = starts.withColumn("bad", F.col("bad") - F.col("most"))
    starts = starts.filter((F.col("kinds") >= PREFIX_WORDS) & (F.col("bad") >= 2 * TERM_DOCUMENTS)).filter((ratio >= TERM_RATIO) & sure).select("word", ratio.alias("ratio"))
    beginnings: dict[str, float] = {}
    for r in sorted(starts.collect(), key=lambda r: (len(r["word"]), r["word"])):
        if not any(r["word"].startswith(b) for b in beginnings):
            beginnings[r["word"]] = math.log(r["ratio"])
    return Model(terms, beginnings, {w: edits_allowed(w) for w in terms if edits_allowed(w)})


def learn(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model of the labels' `toxic`, from about `rows` labelled documents outside the held-out fold.

    Without labels of both kinds the lexicon is empty and every text gets the
    same score: the sample's share of toxic documents, smoothed.
    """
    sample = written(_sample(documents, labels, rows), "sample")
    model = _lexicon(sample)
    features = StructType([StructField("features", ArrayType(DoubleType())), StructField("misspelled", ArrayType(StringType()))])

    def read(drafted: Model):
        shared = sample.sparkSession.sparkContext.broadcast(drafted)

        def make(texts: pa.Array) -> list[pa.Array]:
            found = [shared.value.read(t) for t in texts.to_pylist()]
            near = [sorted({m["term"] for m in matches if m["edits"]}) for _, matches in found]
            return [pa.array([f for f, _ in found], pa.list_(pa.float64())), pa.array(near, pa.list_(pa.string()))]

        # About `rows` short vectors.
        return with_columns(sample, "text", features, make).select("features", "misspelled", "toxic").collect()

    rows_read = read(model)
    while loose := _loose(rows_read):  # terms that ordinary words resemble must match exactly; such words may then be near to others
        model = Model(model.words, model.beginnings, {t: k for t, k in model.fuzzy.items() if t not in loose})
        rows_read = read(model)
    model.weights = _logistic(np.array([r["features"] for r in rows_read], float).reshape(-1, len(FEATURES)), np.array([r["toxic"] > 0 for r in rows_read], float))
    return model


def _loose(rows: list) -> set[str]:
    """The terms whose misspellings are found in more other documents than toxic ones."""
    hits: dict[str, list[int]] = {}
    for r in rows:
        for term in r["misspelled"]:
            hits.setdefault(term, [0, 0])[int(r["toxic"] > 0)] += 1
    return {t for t, (good, bad) in hits.items() if good > bad}


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.02) -> list[float]:
    """Weights of a logistic regression, the intercept first, by Newton steps; one row is added of either class."""
    x, y = np.vstack([x, np.zeros((2, x.shape[1]))]), np.concatenate([y, [0.0, 1.0]])
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.hstack([np.ones((len(x), 1)), x / scale])
    a[:, 1:][:, x.std(axis=0) == 0] = 0
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-9, *[penalty * len(x) / 10 + 1e-3] * x.shape[1]]) / 10
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return [float(w[0]), *(w[1:] / scale).tolist()]


# --- scoring -----------------------------------------------------------------


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """The documents with score (0 to 1), predicted (1 from 0.5 on) and matches (of the lower-cased text).

    NULL and empty texts have no matches and get the score of a text without
    terms; equal rows get equal scores. Very long texts and words are read
    whole, and an empty table gives no rows. Columns of these names are replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array) -> list[pa.Array]:
        known = shared.value
        found = [known.read(t) for t in texts.to_pylist()]
        scores = [known.score(f) for f, _ in found]
        matches = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()), ("edits", pa.int32()), ("quoted", pa.float64())]))
        return [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([m for _, m in found], matches)]

    added = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("matches", ArrayType(MATCH))])
    return with_columns(documents, "text", added, make)


def toxicity(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted and matches for each document row."""
    scored = score_documents(documents.select("doc_id", "text"), learn(documents, labels, rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted", "matches")


def without_toxic(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents, all columns, that are not predicted to be toxic."""
    names = documents.columns
    kept = score_documents(documents.select("text", F.struct(*[f"`{c}`" for c in names]).alias("_document")), learn(documents, labels, rows))
    return kept.filter("predicted = 0").select([F.col("_document")[c].alias(c) for c in names])
