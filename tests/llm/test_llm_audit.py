"""Encoding and decoding, resampling and the filter audit: against plain versions, and on small awkward tables."""

import hashlib
import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tulha.llm import bpe, filter_audit, resampling
from tulha.llm.queries import QUERIES
from tulha.llm.tables import table
from tulha.llm.words import words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_vocabulary())


@pytest.fixture(scope="module")
def library(encoder):
    import tiktoken

    ranks = {token: rank for rank, token in enumerate(encoder.tokens) if token is not None}
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def unpacked(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def merged_by_scans(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min((ranks.get(a + b, math.inf), i) for i, (a, b) in enumerate(itertools.pairwise(parts)))
        if best[0] == math.inf:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return [ranks[p] for p in parts]


def test_segment_tree_merges_as_scans_do():
    draw = random.Random(5)
    for _ in range(300):
        ranks = {bytes([b]): b for b in range(256)}
        tokens = [bytes([b]) for b in b"abc"]
        for rank in range(256, 256 + draw.randint(0, 25)):
            token = draw.choice(tokens) + draw.choice(tokens)
            if token not in ranks:
                ranks[token] = rank
                tokens.append(token)
        for n in (0, 1, 2, 3, 4, 5, 8, 9, 40):
            piece = bytes(draw.choice(b"abcd") for _ in range(n))
            if piece:
                assert bpe.merge_piece(piece, ranks) == ([ranks[piece]] if piece in ranks else merged_by_scans(piece, ranks))


def test_encodes_as_the_library(encoder, library):
    draw = random.Random(6)
    letters = ["a", "B", "é", "ß", "中", "😀", " ", "  ", "\n", "\t", " ", " ", "'s", "'LL", "1", "½", "!", "_", "\0", "\x1c", "﻿", "é", "<|endoftext|>"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(2000)]
    texts += [chr(a) + " " + chr(b) + "'s" for a, b in bpe.NEWER] + [" ".join(map(chr, range(c, c + 64))) for c in range(0x20, 0xD7C0, 64)]
    texts += [" " * 3000 + "x", "ab" * 2000, "\n" * 70_000 + "end of it", ("one two " * 20_000) + "three"]
    for text in texts:
        packed = encoder.encode(text)
        assert unpacked(packed) == library(text), text[:60]
        assert encoder.decode(packed) == text.encode()


def test_long_pieces_and_unknown_ids(encoder):
    for text in (" " * 1_000_000, "x" * 300_000, "日" * 100_000):
        assert encoder.decode(encoder.encode(text)) == text.encode()
    with pytest.raises(ValueError, match="no token"):
        encoder.decode(struct.pack("<I", 4_000_000))
    with pytest.raises(ValueError, match="no rank"):
        bpe.read_ranks(b"YQ== 0")


def test_few_pieces_are_remembered(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT_PIECES", 3)
    small = bpe.Encoder(bpe.read_vocabulary())
    text = "one two three four five six seven eight one two three four " * 3
    assert unpacked(small.encode(text)) == library(text)
    assert len(small.pieces) <= 3 >= len(small.pieces.older)


def test_op11_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op11_byte_bpe"](spark, SF)
    assert got.dtypes[1:] == [("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_encoding_of_awkward_rows(spark, library):
    texts = [None, "", " ", "a b", "a b", "\0", "é" * 100_000, None]
    frame = spark.createDataFrame([(i % 4, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3)
    encoded = bpe.encode(frame)
    got = bpe.unpacked(bpe.decode(encoded)).select("doc_id", "text", "id_list", "decoded").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i % 4, t) for i, t in enumerate(texts))
    for r in got:
        assert r.id_list == library(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.decode(encoded.limit(0)).count() == 0


def features(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def test_checksums_of_runs():
    draw = random.Random(7)
    pool = ["a", "bc", "Ünï", "中文字", "x" * 63, "y" * 64, "z" * 65, "w" * 500, "0", "café" * 30]
    texts = [None, "", "  ", *(" ".join(draw.choices(pool, k=draw.randint(1, 9))) for _ in range(200))]
    got = Counter()
    for words in words_of(pa.array(texts)):
        for first, checksums in resampling.feature_checksums(words):
            got.update(zip((words.row[first] + words.first).tolist(), checksums.tolist(), strict=True))
    assert got == Counter((i, zlib.crc32(f.encode())) for i, t in enumerate(texts) for f in features(t)[1])


def plain_resample(documents, benchmark):
    """(doc_id, n_features, weight, score, rank) of every row, worked out one by one."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(), Counter()
    own = [(i, *features(x)) for i, x in documents]
    for _, _, fs in own:
        s.update(map(bucket, fs))
    for x in benchmark:
        t.update(map(bucket, features(x)[1]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))
    rows = []
    for i, words, fs in own:
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    long_enough = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = len(long_enough) * 5 // 100
    ranked = [(*r[:4], n if n <= drawn else None) for n, r in enumerate(long_enough, 1)]
    return Counter([*ranked, *((*r[:4], None) for r in rows if r[4] < 20)])


def test_op12_equals_plain(spark):
    documents = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    benchmark = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert Counter(map(tuple, QUERIES["op12_resampling"](spark, SF).collect())) == plain_resample(documents, benchmark)


def test_resampling_of_awkward_rows(spark):
    draw = random.Random(8)
    pool = ["alpha", "Beta", "gamma", "δέλτα", "e" * 90]
    text = lambda n: " ".join(draw.choices(pool, k=n))
    rows = [(i, text(draw.randint(0, 40))) for i in range(300)] + [(None, text(30))] * 3 + [(7, "same words " * 15)] * 200 + [(301, None), (302, ""), (303, "w " * 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit("clash"), "weight": F.lit(1), "key": F.lit(2)}).repartition(7)
    target = spark.createDataFrame([("alpha beta gamma",), (None,)], "text string")
    got = resampling.resample(frame, target).select("doc_id", "n_features", "weight", "score", "rank")
    assert Counter(map(tuple, got.collect())) == plain_resample(rows, ["alpha beta gamma", None])
    assert resampling.resample(frame.limit(0), target).count() == 0
    assert resampling.resample(frame, target.limit(0)).count() == len(rows)


def test_segments_are_even_and_ranks_exact(spark):
    n = 20_000
    scored = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(3)).alias("score"), (F.col("id") % 1000).alias("key"), F.lit(1).cast("long").alias("n_features")).repartition(9)
    got = resampling.exact_ranks(scored, 15_000, segment_rows=500, samples=4_000)
    ranks = sorted((r["rank"], -r.score, r.key) for r in got.collect() if r["rank"] is not None)
    assert [r[0] for r in ranks] == list(range(1, 15_001))
    assert [r[1:] for r in ranks] == sorted((-r.score, r.key) for r in scored.collect())[:15_000]
    runs = scored.sortWithinPartitions(F.desc("score"), "key", "n_features").withColumn("_place", F.monotonically_increasing_id())
    dealt, segments = resampling.deal_to_segments(runs, n, 500, 4_000)
    assert dealt.groupBy("_segment").count().agg(F.max("count")).first()[0] <= n // segments + 9 * (n // 4_000)
    assert got.count() == n
    assert resampling.exact_ranks(scored, 0).filter("rank is not null").count() == 0


def test_shapley_weights():
    for n in (1, 2, 3, 5):
        weights = filter_audit.shapley_weights(n)
        draw = random.Random(n)
        value = [0, *(draw.randint(-50, 50) for _ in range(2**n - 1))]
        for i in range(n):
            by_orders = 0
            for order in itertools.permutations(range(n)):
                before = sum(1 << j for j in order[: order.index(i)])
                by_orders += value[before | 1 << i] - value[before]
            assert sum(w * v for w, v in zip(weights[i], value, strict=True)) == by_orders
        assert sum(Fraction(w, math.factorial(n)) for row in weights for w in row[-1:]) == 1


def plain_audit(documents, labels):
    """Every row of the audit, each document through each order."""
    fails = []
    for i, text, source in documents:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in documents)
        tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text)), copy]
        said = [(q, t) for d, q, t in labels if d == i and i is not None]
        fails.append((source or "", {f for f, failed in zip("ABCDE", tests, strict=True) if failed}, any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    rows = {}
    for part in {p for p, *_ in fails}:
        for order in itertools.permutations("ABCDE"):
            left = [f for f in fails if f[0] == part]
            for step, letter in enumerate(order, 1):
                removed = [f for f in left if letter in f[1]]
                left = [f for f in left if letter not in f[1]]
                failing = [f for f in fails if f[0] == part and letter in f[1]]
                rows[part, "".join(order), step] = [len(left), len(removed), len(failing) - len(removed), sum(f[1] == {letter} for f in failing), sum(f[2] for f in removed), sum(f[3] for f in removed)]
    shapley = Counter()
    for (part, order, step), row in rows.items():
        shapley[part, order[step - 1]] += row[1]
    return {k: (*row, shapley[k[0], k[1][k[2] - 1]]) for k, row in rows.items()}


def audited(frame):
    rows = frame.collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(found) == len(rows)
    return found


def test_op13_equals_plain(spark):
    documents = [(r.doc_id, r.text, r.source) for r in table(spark, SF, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in table(spark, SF, "labels").collect()]
    assert audited(QUERIES["op13_filter_audit"](spark, SF)) == plain_audit(documents, labels)


def test_audit_of_awkward_rows(spark):
    long_text = " ".join(f"word{i}" for i in range(60))
    loud = " ".join(f"WORD{i}" for i in range(60)) + " #"
    documents = [(3, long_text, "a"), (2, long_text, "b"), (None, long_text, "a"), (2, long_text, "b"), (5, None, None), (6, "", "a"), (7, loud, None), (8, loud, ""), (9, "same " * 70, "a")]
    documents += [(10, "x\x0b\x0cy z\x1c" * 30, "a"), (11, "é" * 100 + "ABCDE", "b"), (12, "w " * 100_000, "c")] + [(20 + i, "copy of this", "hot") for i in range(50)]
    labels = [(3, 1, 0), (3, 0, 1), (2, None, 1), (None, 1, 1), (7, 1, None), (20, 1, 1), (99, 1, 1), (21, 0, 1)]
    frame = spark.createDataFrame(documents, "doc_id long, text string, source string").withColumns({"part": F.lit(1), "failed": F.lit(0), "_text": F.lit("clash")}).repartition(5)
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("key", F.lit(0))
    assert audited(filter_audit.audit_documents(frame, said)) == plain_audit(documents, labels)
    assert filter_audit.audit_documents(frame.limit(0), said).count() == 0
    assert len(audited(filter_audit.audit_documents(frame, said.limit(0)))) == 600 * len({d[2] or "" for d in documents})
