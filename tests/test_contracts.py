import json

import pytest

from tulha.operators import contracts


def record(*fields):
    return json.dumps({"type": "record", "name": "r", "fields": [dict(zip(("name", "type", "default"), f, strict=False)) if isinstance(f, tuple) else f for f in fields]})


def test_each_promotion():
    order = ["int", "long", "float", "double", "string", "bytes", "boolean"]
    allowed = {("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"), ("float", "double"), ("string", "bytes"), ("bytes", "string")}
    for held in order:
        for asked in order:
            want = contracts.COMPATIBLE if held == asked else contracts.PROMOTED if (held, asked) in allowed else contracts.REFUSED
            assert contracts.resolve(record(("a", held)), record(("a", asked)))[0].verdict == want, (held, asked)


def test_aliases_defaults_and_what_is_left():
    writer = record(("velho", "int"), ("b", ["null", "string"]), ("resto", "int"))
    reader = record({"name": "novo", "type": "long", "aliases": ["outro", "velho"]}, ("b", "string"), ("c", "string", "x"), ("d", ["null", "int"], None), ("e", "int"))
    found = contracts.resolve(writer, reader)
    assert [(v.column, v.verdict, v.source, v.required) for v in found] == [
        ("novo", "promovida", "velho", False), ("b", "compativel", "b", True), ("c", "preenchida", None, False),
        ("d", "preenchida", None, False), ("e", "recusada", None, False), ("resto", "ignorada", "resto", False),
    ]
    with pytest.raises(ValueError, match="e: ausente"):
        contracts.require(found)
    contracts.require(found[:4])


def test_rows_by_contract(spark):
    writer = record(("a", "int"), ("b", ["null", "string"]), ("dia", {"type": "int", "logicalType": "date"}))
    reader = record(("a", "double"), ("b", "string"), ("dia", {"type": "int", "logicalType": "date"}), ("c", "long", 7))
    df = spark.createDataFrame([(1, "x"), (2, None), (None, "z")], "a int, b string").selectExpr("*", "date'2024-01-02' as dia", "1 as sobra")
    verdicts = contracts.resolve(writer, reader)
    rows = contracts.read_as(df, verdicts)
    assert rows.dtypes == [("a", "double"), ("b", "string"), ("dia", "date"), ("c", "bigint")]
    assert sorted((r.a or 0, r.b, r.c) for r in rows.collect()) == [(0, "z", 7), (1.0, "x", 7)]
    assert [tuple(r)[:2] for r in contracts.refused_rows(df, verdicts).collect()] == [(2, None)]


def test_contracts_that_are_none():
    for text in (record(("a", ["int", "string"])), record(("a", "array")), json.dumps({"type": "enum"}), json.dumps(["null"])):
        with pytest.raises(ValueError, match="primitive|record"):
            contracts.resolve(text, text)
