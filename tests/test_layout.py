"""Clustered layout, quantile fences and lineage closure."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tulha.operators import quality
from tulha.session import fresh_database
from tulha.sinks import layout


def location(spark, name):
    return next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location").removeprefix("file:")


def test_bits_by_turns(spark):
    rows = [(a, b) for a in range(4) for b in range(4)]
    frame = spark.createDataFrame(rows, "a int, b int").select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 2).alias("z"))
    for r in frame.collect():
        assert r.z == (r.a >> 1) * 8 + (r.b >> 1) * 4 + (r.a & 1) * 2 + (r.b & 1)


def test_statistics_exclude_most_groups_on_each_column(spark):
    name = f"{fresh_database(spark, 'teste')}.t"
    rows = spark.range(200_000).select(
        "id", (1990 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(32))).cast("int").alias("ano"), F.format_string("UF %02d", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(27))).alias("uf"),
        F.when(F.col("id") % 100 > 0, F.pmod(F.xxhash64("id", F.lit(3)), F.lit(12))).alias("mes"), F.format_string("produto %03d", F.pmod(F.xxhash64("id", F.lit(4)), F.lit(200))).alias("produto"),
    )
    layout.write_clustered(rows, name, ["ano", "uf", "mes", "produto"], files=64, row_group_bytes=1024)
    assert spark.table(name).count() == 200_000
    assert spark.table(name).exceptAll(rows).count() == 0
    wanted = {"ano": 2001, "uf": "UF 13", "mes": 5, "produto": "produto 077"}
    seen, met = 0, dict.fromkeys(wanted, 0)
    for path in glob.glob(f"{location(spark, name)}/*.parquet"):
        footer = pq.ParquetFile(path).metadata
        for g in range(footer.num_row_groups):
            seen += 1
            for i in range(footer.num_columns):
                column = footer.row_group(g).column(i)
                if column.path_in_schema in wanted:
                    met[column.path_in_schema] += column.statistics.min <= wanted[column.path_in_schema] <= column.statistics.max
    assert seen >= 1000
    assert all(0 < n < 0.5 * seen for n in met.values()), (seen, met)


def test_clustering_of_awkward_columns(spark):
    db = fresh_database(spark, "teste")
    rows = spark.createDataFrame([(None, None, 1.0), ("", 5, None), ("é", 5, float("nan")), ("x" * 50, None, -1.0)] * 5, "s string, n int, d double")
    layout.write_clustered(rows, f"{db}.t", ["s", "n", "d"], files=3)
    assert spark.table(f"{db}.t").count() == 20
    layout.write_clustered(rows.limit(0), f"{db}.e", ["s", "n"], files=3)
    assert spark.table(f"{db}.e").count() == 0
    with pytest.raises(ValueError, match="62 bits"):
        layout.with_z_order(rows, ["s", "n"], bits=32)


def test_quartiles_of_long_series_are_near(spark):
    draw = random.Random(4)
    values = [draw.gauss(0, 1) for _ in range(50_000)]
    frame = spark.createDataFrame([(i % 10, v) for i, v in enumerate(values)], "parte long, v double").withColumn("s", F.lit("a"))
    merged = quality.merged_sketches(quality.series_sketches(frame, ["s", "parte"], "v"), ["s"])
    found = quality.fences(merged).first()
    ranked = sorted(values)
    rank = lambda q: sum(v <= q for v in ranked) / len(ranked)
    assert abs(rank(found.q1) - 0.25) < 0.01
    assert abs(rank(found.q3) - 0.75) < 0.01


def test_fences_of_small_series(spark):
    rows = [("a", p, float(v)) for p, v in enumerate([1, 2, 3, 4, 5, 6, 7, 100])] + [("b", 0, None), ("c", 0, 5.0), ("c", 1, None)]
    frame = spark.createDataFrame(rows, "s string, p int, v double")
    known = quality.fences(quality.series_sketches(frame, ["s"], "v"))
    assert {r.s: (r.q1, r.q3, r.cerca_inferior, r.cerca_superior) for r in known.collect()} == {"a": (2.0, 6.0, -4.0, 12.0), "c": (5.0, 5.0, 5.0, 5.0)}
    assert [(r.s, r.p, r.v) for r in quality.outside_fences(frame, known, ["s"], "p", "v").collect()] == [("a", 7, 100.0)]


def test_closure(spark):
    edges = [("a", "b"), ("a", "b"), ("b", "c"), ("c", "d"), ("a", "d"), ("x", "y"), ("y", "x")]
    frame = spark.createDataFrame(edges, "de string, para string")
    found = {(r.de, r.para): r.passos for r in quality.lineage_closure(frame).collect()}
    assert found == {
        ("a", "b"): 1, ("b", "c"): 1, ("c", "d"): 1, ("a", "d"): 1, ("a", "c"): 2, ("b", "d"): 2,
        ("x", "y"): 1, ("y", "x"): 1, ("x", "x"): 2, ("y", "y"): 2,
    }
    assert quality.lineage_closure(frame.limit(0)).count() == 0
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(5)], "de string, para string")
    with pytest.raises(RuntimeError, match="after 2 rounds"):
        quality.lineage_closure(chain, most_rounds=2)
