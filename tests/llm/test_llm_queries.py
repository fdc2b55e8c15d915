"""Registered queries against their SQL, and against plain versions where SQL has none."""

import re
import zlib

import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

from tulha.llm import neighbours, personal_data, token_counts
from tulha.llm.oracle import ORACLE_SQL
from tulha.llm.queries import QUERIES
from tulha.llm.tables import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, connection, name):
    assert compare(QUERIES[name](spark, SF), ORACLE_SQL[name], connection) == []


def test_a_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_op3_counts_add_up(spark):
    encoder, _ = token_counts._encoder(token_counts.read_vocabulary())
    texts = {r.doc_id: r for r in table(spark, SF, "documents").select("doc_id", "source", "text").collect()}
    for r in QUERIES["op3_token_counts"](spark, SF).collect():
        whole = f"{texts[r.doc_id].source}\n\n{texts[r.doc_id].text}"
        assert r.n_tokens == len(encoder.encode_ordinary(whole)) == sum(r.field_tokens)
        assert sum(r.line_tokens) <= r.n_tokens
        assert len(r.line_tokens) == max(1, texts[r.doc_id].text.rstrip("\n").count("\n") + 1)


def test_op6_keeps_the_article(spark):
    import html

    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    for r in QUERIES["op6_main_text"](spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1)>", "\0", article.replace("<br>", " ")))
        blocks = [" ".join(html.unescape(b).split()) for b in plain.split("\0")]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_op7_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = QUERIES["op7_toxicity"](spark, sf).join(table(spark, sf, "labels"), "doc_id").collect()
    for r in found[:200]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.97


def test_op9_base_spans(spark):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def base(text):
        found = []
        for place, (kind, pattern) in enumerate(patterns.items()):
            for m in re.finditer(pattern, text):
                digits = re.sub(r"[^0-9]", "", m[0])
                luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
                good = {
                    "email": True,
                    "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn,
                    "phone": 9 <= len(digits) <= 15,
                }
                if good[kind]:
                    found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
        return [s for _, _, s in sorted(found)]

    import hashlib

    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in QUERIES["op9_personal_data"](spark, SF).collect():
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(f"{k}:") for s in want) for k in patterns]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_op10_recall(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    found: dict = {}
    for r in QUERIES["op10_neighbours"](spark, sf).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        products = x @ x[i]
        products[i] = -np.inf
        order = np.lexsort((ids, -products))[:20]
        mine = found[ids[i]]
        assert sorted(mine) == list(range(1, len(order) + 1))
        listed = [(-s, v) for v, s in (mine[k] for k in sorted(mine))]
        assert listed == sorted(listed)
        for vec_id, score in mine.values():
            assert abs(score - products[np.flatnonzero(ids == vec_id)[0]]) < 1e-12
        hits += len({v for v, _ in mine.values()} & set(ids[order].tolist()))
        total += len(order)
    assert hits / total >= 0.9


def test_recall_on_unequal_lengths(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(40, 32))
    x = centres[draw.integers(40, size=6000)] + 0.5 * draw.normal(size=(6000, 32))
    x *= draw.lognormal(0, 1, size=(6000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    got: dict = {}
    for r in neighbours.nearest(frame.filter("vec_id % 20 = 0"), frame).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in range(0, 6000, 20):
        products = x @ x[i]
        products[i] = -np.inf
        hits += len(got[i] & set(np.argsort(-products)[:20].tolist()))
    assert hits / (300 * 20) >= 0.9


def test_neighbours_leave_out_what_has_no_direction(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [nan, 1.0]), (3, None), (4, [1.0, None]), (5, [2.0, 0.0]), (6, [2.0, 0.0]), (7, [-1.0, 3.0]), (None, [9.0, 9.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = neighbours.clean_vectors(frame, "vec_id", "embedding")
    got = neighbours.nearest(vectors.filter("vec_id = 0"), vectors).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 5, 2.0), (0, 2, 6, 2.0), (0, 3, 7, -1.0)]
    assert neighbours.nearest(vectors.limit(0), vectors.limit(0)).count() == 0


def test_equal_vectors_come_by_id(spark, monkeypatch):
    import random

    draw = random.Random(1)
    hot = [draw.gauss(0, 1) for _ in range(64)]
    rows = [(i, hot if i % 3 else [draw.gauss(0, 1) for _ in range(64)]) for i in range(900)]
    vectors = neighbours.clean_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(9), "vec_id", "embedding")
    got = neighbours.nearest(vectors.filter("vec_id in (1, 200)"), vectors, block_rows=50).collect()
    for query in (1, 200):
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])]
        assert mine == [i for i in range(900) if i % 3 and i != query][:20]


def test_queries_come_in_blocks(spark, monkeypatch):
    """However many queries ask a part, no group holds many of them; the result is the same."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(1200, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, vector array<double>")
    known = neighbours.learn(frame)
    sizes = []
    searched = neighbours._searched

    def seen(blocks, k):
        sizes.append(blocks.groupBy("part", "block", "query_block").agg(F.sum(F.col("asks").cast("int")).alias("n"), F.count("*").alias("rows")).agg(F.max("n"), F.max("rows")).first())
        return searched(blocks, k)

    monkeypatch.setattr(neighbours, "_searched", seen)
    rows = lambda **bounds: sorted(tuple(r) for r in neighbours.nearest(frame, frame, 5, known, **bounds).collect())
    assert rows() == rows(block_rows=40, query_rows=50)
    assert sizes[1][0] <= 2 * 50
    assert sizes[1][1] <= 2 * 90
    assert sizes[0][0] > 100


def test_extra_spans_and_redaction(spark):
    rows = [(1, "write joe.doe (at) example (dot) com soon", 41), (2, None, 0), (3, "", 0), (4, "iban DE89 3704 0044 0532 0130 00 ok", 35), (5, "part 123-45-6789", 16), (6, "a@b.co " * 20_000, 140_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("spans", F.lit("clash"))
    got = {r.doc_id: r for r in personal_data.without_personal_data(frame).collect()}
    assert got[1].text == "write [OBFUSCATED_EMAIL] soon"
    assert got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[3].text, got[5].text) == (None, "", "part 123-45-6789")
    assert got[4].text == "iban [IBAN] ok"
    assert got[6].text == "[EMAIL] " * 20_000
    long_part = "a" * 81
    assert (4, 4 + 81 + 23, "obfuscated_email") in personal_data.candidates(f"see {long_part} (at) example (dot) com")
    assert got[1].spans == "clash"
    assert personal_data.without_personal_data(frame.limit(0)).count() == 0


def test_usual_forms_of_each_kind(spark):
    forms = {
        "jane (At) example (Dot) com": "obfuscated_email",
        "jane [at] example.com": "obfuscated_email",
        "555-123-4567": "national_phone",
        "555.123.4567": "national_phone",
        "2001:db8::1": "ipv6",
        "::1": "ipv6",
        "fe80::1ff:fe23:4567:890a": "ipv6",
        "::ffff:192.0.2.1": "ipv6",
    }
    selector = personal_data.learn(spark.createDataFrame([], "text string"))
    for form, kind in forms.items():
        text = f"que para {form} und the"
        span = (9, 9 + len(form), kind)
        assert span in personal_data.candidates(text), form
        base, more = selector.select(text)
        assert span in more, form
        assert personal_data.redact(text, base + more) == f"que para [{kind.upper()}] und the"
    for text in ("std::vector<int> at home", "part 555-123-4567", "add::bad", "meet at noon.Then go", "12:30:45"):
        assert selector.select(text) == ([], []), text
    # An account number stands beside a card number that its digits happen to form.
    made = (f"iban BE{98 - (n * 10**6 + 111400) % 97:02d}{n:012d} ok" for n in range(4 * 10**11, 5 * 10**11))
    text = next(t for t in made if any(personal_data.valid(t, s) for s in personal_data.base_matches(t)))
    assert personal_data.iban_valid(text[5:21])
    base, more = selector.select(text)
    assert base
    assert more == [(5, 21, "iban")]
    assert personal_data.redact(text, base + more) == "iban [IBAN] ok"
