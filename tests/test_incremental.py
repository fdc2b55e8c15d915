"""Incremental flows: files once, merges of touched buckets, packing of small files, sessions."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tulha.operators import silver
from tulha.plans import incremental
from tulha.session import fresh_database, fresh_path
from tulha.sinks import evolve, layout
from tulha.streaming import hourly


def contents(spark, name, *columns):
    return sorted(tuple(r) for r in spark.table(name).select(*columns).collect())


def test_each_file_lands_once(spark, tmp_path):
    db, checkpoint = fresh_database(spark, "teste"), fresh_path(spark, "checkpoint")
    run = lambda: incremental.ingest_incremental(spark, str(tmp_path), "txt", f"{db}.t", checkpoint, "2024-01-01 00:00:00", files_per_trigger=1)
    (tmp_path / "a[1].txt").write_text("a;b\n1;2\n3;4;5\n")
    (tmp_path / "b.txt").write_text("b;a\n20;10\n")
    assert (run(), run()) == (2, 0)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.txt").write_text("a;c\n100;300\n")
    (tmp_path / "vazio.txt").write_text("a;b\n")
    assert (run(), run()) == (2, 0)
    assert contents(spark, f"{db}.t", F.coalesce("a", F.lit("")), F.coalesce("b", F.lit("")), F.coalesce("c", F.lit(""))) == [("1", "2", ""), ("10", "20", ""), ("100", "", "300")]
    ledger = contents(spark, f"{db}.t_arquivos", "_source_file", "n_bytes", "n_linhas", "n_rejeitadas")
    assert ledger == [("a[1].txt", 14, 1, 1), ("b.txt", 10, 1, 0), ("c.txt", 12, 1, 0), ("vazio.txt", 4, 0, 0)]
    assert spark.table(f"{db}.t").select("_lote").distinct().count() == 3


def test_a_failed_trigger_is_run_again(spark, tmp_path):
    db, checkpoint = fresh_database(spark, "teste"), fresh_path(spark, "checkpoint")
    name, attempts = f"{db}.t", []

    def load(number, files):
        attempts.append((number, len(files)))
        rows = spark.read.text(list(files)).select("value")
        evolve.write_keyed(spark, rows, name, incremental.BATCH, number)
        if len(attempts) == 2:
            raise RuntimeError("lost after the write")

    run = lambda: incremental.run_landed(spark, str(tmp_path), checkpoint, load, "*.txt")
    (tmp_path / "a.txt").write_text("1\n2\n")
    assert run() == 1
    (tmp_path / "b.txt").write_text("3\n")
    with pytest.raises(Exception, match="lost after the write"):
        run()
    assert contents(spark, name, "value") == [("1",), ("2",), ("3",)]
    (tmp_path / "c.txt").write_text("4\n")
    assert run() == 2
    assert contents(spark, name, "value") == [("1",), ("2",), ("3",), ("4",)]
    assert [a[0] for a in attempts] == [0, 1, 1, 2]
    assert run() == 0


def test_keyed_writes_replace_their_own_rows(spark):
    name = f"{fresh_database(spark, 'teste')}.t"
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "a long, b string")
    assert evolve.write_keyed(spark, rows((1, "x")), name, "n", 0, ["b"]).path == "create"
    assert evolve.write_keyed(spark, rows((2, "x"), (3, "y")), name, "n", 1, ["b"]).path == "replace"
    assert evolve.write_keyed(spark, rows((4, "z")), name, "n", 1, ["b"]).path == "replace"
    assert contents(spark, name, "a", "b", "n") == [(1, "x", 0), (4, "z", 1)]
    report = evolve.write_keyed(spark, rows((5, "z")).withColumn("c", F.lit(7)), name, "n", 2, ["b"])
    assert (report.path, report.added) == ("add_columns", ["c"])
    report = evolve.write_keyed(spark, rows((6, "z")).withColumn("a", F.lit("text")), name, "n", 3, ["b"])
    assert (report.path, spark.table(report.backup).count(), spark.table(name).count()) == ("recreate", 3, 1)
    evolve.write_keyed(spark, rows((6, "z")).withColumn("a", F.lit("text")), name, "n", 3, ["b"])
    assert contents(spark, name, "a", "n") == [("text", 3)]


def test_merge_equals_full_refresh_and_leaves_other_buckets(spark):
    name = f"{fresh_database(spark, 'teste')}.t"
    load = lambda n, ids: spark.createDataFrame([(i, f"v{n}", f"2024-01-0{n}", "f") for i in ids], "k long, v string, _ingest_ts string, _source_file string")
    loads = [load(1, range(200)), load(2, [1, 2, 3, 500, None]), load(3, [2, 600, None, None])]
    files = lambda: {r.path: r.modificationTime for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(home).select("path", "modificationTime").collect() if "_balde" in r.path}
    seen = None
    for rows in loads:
        if seen is not None:
            before = files()
        touched = incremental.merge_latest(spark, rows, name, ["k"], buckets=32)
        home = next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r.col_name == "Location")
        seen = rows if seen is None else seen.unionByName(rows)
        if rows is not loads[0]:
            assert 0 < len(touched) < 10
            kept = {p: t for p, t in before.items() if not any(f"_balde={b}/" in p for b in touched)}
            assert kept.items() <= files().items()
            assert incremental.merge_latest(spark, rows, name, ["k"], buckets=32) == touched  # again: the same rows
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = silver.latest_by_key(seen, ["k"])
    assert sorted(map(tuple, spark.table(name).select(*want.columns).collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    incremental.merge_latest(spark, load(4, [9]).withColumn("novo", F.lit(1)), name, ["k"], buckets=32)
    assert spark.table(name).where("novo = 1").count() == 1
    assert incremental.merge_latest(spark, loads[0].limit(0), name, ["k"], buckets=32) == []
    with pytest.raises(ValueError, match="32 buckets"):
        incremental.merge_latest(spark, loads[0], name, ["k"], buckets=8)
    with pytest.raises(ValueError, match="other types"):
        incremental.merge_latest(spark, loads[0].withColumn("v", F.lit(1)), name, ["k"], buckets=32)


def test_first_fit(spark):
    files = spark.createDataFrame([("p", f"f{i}", n) for i, n in enumerate([60, 50, 40, 30, 10, 10, 500])] + [("q", "g", 5)], "pasta string, caminho string, n_bytes long")
    packed = layout.pack_files(files, 100).toPandas()
    groups = packed[packed.pasta == "p"].groupby("grupo")["n_bytes"].apply(list).tolist()
    assert groups == [[500], [60, 40], [50, 30, 10, 10]]
    assert isinstance(packed, pd.DataFrame) and len(packed) == 8


def test_only_partitions_with_small_files_are_rewritten(spark):
    name = f"{fresh_database(spark, 'teste')}.t"
    rows = spark.range(3000).select("id", F.concat(F.lit("é "), (F.col("id") % 3).cast("string")).alias("p"), F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("q"))
    for part in range(4):
        chosen = rows.where((F.col("id") % 4 == part) & (F.col("p") != "é 1")) if part else rows.where((F.col("id") % 4 == 0) | (F.col("p") == "é 1"))
        evolve.write_evolving(spark, chosen, name, partition_by=["p", "q"])
    before = {r.caminho for r in layout.table_files(spark, name).collect()}
    report = {r.pasta: (r.arquivos_antes, r.arquivos_depois, r.reescrita) for r in layout.compact_small_files(spark, name).collect()}
    assert len(report) == 9
    assert all(v == ((1, 1, False) if "é 1/" in k else (v[0], 1, True)) for k, v in report.items()), report
    assert {v[0] for k, v in report.items() if "é 1/" not in k} == {2, 4}
    after = {r.caminho for r in layout.table_files(spark, name).collect()}
    assert len(before & after) == 3
    key = lambda r: r[0]
    assert sorted(map(tuple, spark.table(name).select("id", "p", "q").collect()), key=key) == sorted(map(tuple, rows.collect()), key=key)
    assert not any(r.reescrita for r in layout.compact_small_files(spark, name).collect())
    with pytest.raises(ValueError, match="not a partitioned"):
        rows.write.saveAsTable(f"{name}_plain")
        layout.compact_small_files(spark, f"{name}_plain")


def test_sessions_merge_and_list_late_rows(spark):
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "rows", "checkpoint"))
    at = lambda hour: datetime(2024, 1, 1) + timedelta(hours=hour)
    schema = "ts timestamp_ntz, station string, value double"
    # The third file joins two open sessions of the second; the fourth is long past; the fifth ends the rest.
    loads = [[(0, "a", 1), (1, "a", 2), (0, "b", 3)], [(30, "a", 4), (34.5, "a", 5)], [(33, "a", 6), (1, "b", 7)], [(2, "a", 8)], [(100, "c", 9)], [(200, "c", 10)]]
    dropped = 0
    for load in loads:
        spark.createDataFrame([(at(h), s, float(v)) for h, s, v in load], schema).coalesce(1).write.mode("append").parquet(landed)
        stream = hourly.read_file_stream(spark, landed, spark.read.parquet(landed).schema)
        found, late, n = hourly.run_sessions(stream, "station", "value", out, checkpoint, gap="4 hours")
        dropped += n
    got = sorted((r.station, r.inicio, r.fim, r.n_leituras, float(r.soma)) for r in found.collect())
    assert got == [("a", at(0), at(5), 2, 3.0), ("a", at(30), at(38.5), 3, 15.0), ("b", at(0), at(4), 1, 3.0), ("c", at(100), at(104), 1, 9.0)]
    assert sorted(r.value for r in late.collect()) == [7.0, 8.0]
    assert dropped == 2


def test_late_rows_within_one_run(spark):
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "rows", "checkpoint"))
    schema = "ts timestamp_ntz, station string, value double"
    for n, hour in enumerate((0, 100, 1, 2, 300, 99, 98)):
        spark.createDataFrame([(datetime(2024, 1, 1) + timedelta(hours=hour), "a", float(n))], schema).coalesce(1).write.mode("append").parquet(landed)
    stream = hourly.read_file_stream(spark, landed, spark.read.parquet(landed).schema, files_per_trigger=1)
    _, late, dropped = hourly.run_sessions(stream, "station", "value", out, checkpoint, gap="4 hours")
    assert late.count() == dropped > 0
