"""Jaccard join, components, decontamination and mixing against plain versions, with awkward rows."""

import random
import re
from collections import defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from tulha.llm import decontaminate, jaccard_join, mixing
from tulha.llm.components import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, source string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sentence(draw, n):
    return [f"w{draw.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    rows = []
    for group in range(12):
        base = sentence(draw, draw.randint(30, 120))
        for _ in range(draw.randint(1, 9)):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(9999)}"
            rows.append((len(rows), " ".join(copy), f"s{group % 4}"))
    hot = " ".join(sentence(draw, 60))
    rows += [(len(rows) + i, hot, None) for i in range(60)]
    rows += [(len(rows), None, "s1"), (len(rows) + 1, "", "s1"), (len(rows) + 2, "..!", "s2"), (len(rows) + 3, "two words", "s2"), (len(rows) + 4, "Two  words!", "s2")]
    rows += [rows[0], rows[0], (None, rows[1][1], "s0"), (None, "alone without number", None)]
    rows.append((len(rows), " ".join(sentence(draw, 40_000)), "s3"))
    return rows


def plain_links(rows):
    sets = []
    for _, text, _ in rows:
        w = words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                links[i].add(j)
                links[j].add(i)
    return links


def test_jaccard_classes(spark, rows):
    links = plain_links(rows)
    group = list(range(len(rows)))
    for _ in rows:
        group = [min([group[i], *(group[j] for j in links[i])]) for i in range(len(rows))]
    members = defaultdict(list)
    for i, g in enumerate(group):
        members[g].append(rows[i][0])
    want = sorted((str(rows[i][0]), str(min((d for d in members[group[i]] if d is not None), default=None)), len(links[i])) for i in range(len(rows)))
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("sketch", F.lit(1)).repartition(7)
    got = jaccard_join.jaccard_classes(frame).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in got) == want
    kept = jaccard_join.one_of_each(frame)
    assert kept.columns == frame.columns
    assert kept.count() == len(members)


def test_buckets_over_the_limit(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET_SETS", 2)
    frame = spark.createDataFrame(rows, SCHEMA)
    links = plain_links(rows)
    assert sum(r.n_links for r in jaccard_join.jaccard_classes(frame).collect()) == sum(map(len, links.values()))


def test_components_in_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_GRAMS", 150)
    links = plain_links(rows)
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, SCHEMA))
    assert got.agg(F.sum("n_links")).first()[0] == sum(map(len, links.values()))
    plain = list(range(len(rows)))
    for _ in rows:
        plain = [min([plain[i], *(plain[j] for j in links[i])]) for i in range(len(rows))]
    assert got.filter("keeper").count() == len(set(plain))


def test_empty_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert jaccard_join.jaccard_classes(none).count() == 0
    assert jaccard_join.one_of_each(none).columns == none.columns
    assert mixing.mix_documents(none).count() == 0
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(none, benchmark).count() == 0


def test_runs_reach_the_target():
    assert jaccard_join.runs_needed(target=0.9) < jaccard_join.runs_needed(target=0.9999)


def test_components(spark):
    draw = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(draw.randrange(200, 300), draw.randrange(200, 300)) for _ in range(70)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(100):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root


def test_contamination(spark):
    draw = random.Random(3)
    items = [(i, " ".join(sentence(draw, n))) for i, n in enumerate([30, 13, 14, 5, 1, 12, 60])] + [(7, None), (8, ""), (None, " ".join(sentence(draw, 20))), (3, "another text Of the same item")]
    texts = [None, "", "Short", *(t for _, t in items)]
    for _, text in items:
        w = words(text)
        for cut in (12, 13, 14):
            at = draw.randrange(max(1, len(w) - cut + 1))
            texts.append(", ".join([*sentence(draw, 30), *w[at : at + cut], *sentence(draw, 40)]).upper())
    texts += [texts[-1], " ".join(sentence(draw, 300_000)), " ".join([*sentence(draw, 2000), *words(items[6][1])])]
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add("" if item is None else str(item))
    want = []
    for i, text in enumerate(texts):
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    found |= windows[tuple(w[j : j + n])]
        want.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_words", F.lit("clash")).repartition(5)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents, benchmark).orderBy("doc_id").collect()
    assert [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got] == want
    assert decontaminate.contamination(documents, benchmark, filter_bits=6).filter("contaminated").count() == sum(x[-1] for x in want)
    kept = decontaminate.without_contaminated(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [x[0] for x in want if not x[-1]]


def test_flow_is_cheapest():
    draw = random.Random(4)
    for _ in range(40):
        patterns = [(("a",), draw.randint(0, 3)), (("a", "b"), draw.randint(0, 3)), (("b",), draw.randint(0, 2))]
        targets = {"a": draw.randint(0, 5), "b": draw.randint(0, 5)}
        flow = mixing.min_cost_flow(patterns, targets)
        routed = {s: sum(f.get(s, 0) for f in flow.values()) for s in "ab"}
        repeats = sum(sum(f.values()) for (_, use), f in flow.items() if use == 2)
        best = None
        pa, pab, pb = (range(2 * n + 1) for _, n in patterns)
        for a, shared, b in product(pa, pab, pb):
            for to_a in range(shared + 1):
                if a + to_a <= targets["a"] and b + shared - to_a <= targets["b"]:
                    twice = sum(max(0, x - n) for x, (_, n) in zip((a, shared, b), patterns))
                    best = min(best or (99, 0), (-(a + b + shared), twice))
        assert (-sum(routed.values()), repeats) == best


def test_mixture_of_overlapping_sources(spark):
    draw = random.Random(6)
    rows = [(i, draw.randint(0, 50), draw.choice((["a"], ["a", "b"], ["b"], ["c"]))) for i in range(400)]
    sized = spark.createDataFrame(rows, "doc_id long, size long, pattern array<string>")
    targets = spark.createDataFrame([("a", 0, 4000.0), ("b", 0, 1500.0), ("c", 0, 333.0)], "source string, source_size long, target double")
    got = mixing.mixture(sized, targets).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    assert sum(r.taken for r in got if r.pattern == ["c"]) == 333
    assert sum(r.taken for r in got if r.pattern != ["c"]) == 5500
    assert {r.doc_id: r.taken for r in mixing.mixture(sized.repartition(9), targets).collect()} == {r.doc_id: r.taken for r in got}


def test_mixing_awkward_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "x"), (3, "", None), (4, "only one here", None), (None, "no id", "y")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"size": F.lit("clash"), "pattern": F.lit("kept")})
    got = mixing.mix_documents(frame).collect()
    assert {r.pattern for r in got} == {"kept"}
    assert len(got) == 6
    total = {s: (sum(r.taken for r in got if r.source == s), max(r.target for r in got if r.source == s)) for s in ("x", "y", None)}
    assert all(abs(taken - target) <= 0.5 for taken, target in total.values())


def test_every_pattern_goes_through_the_flow(spark):
    patterns = spark.createDataFrame([(["a"], 100), ([None], 10), (["b"], 0), (["c"], 7)], "pattern array<string>, size long")
    targets = spark.createDataFrame([("a", 150.5), (None, 3.0), ("b", 5.0), ("c", 99.0)], "source string, target double")
    got = {tuple(r.pattern): r.words for r in mixing._routes(patterns, targets, 2).collect()}
    assert got == {("a",): 151, (None,): 3, ("b",): 0, ("c",): 14}
    plan = mixing._routes(patterns, targets, 2)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan
