import shutil
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tulha.plans.ingest import ingest_file, ingest_listing
from tulha.session import fresh_database, fresh_path
from tulha.sinks import evolve, layout

NOW = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)


@pytest.fixture
def db(spark):
    return fresh_database(spark, "evolucao")


@pytest.fixture
def table(spark):
    return f"{fresh_database(spark, 'evolucao')}.t"


def rows(spark, name):
    return sorted((tuple(r) for r in spark.table(name).collect()), key=str)


def test_compare_schemas(spark):
    old = T.StructType.fromDDL("a int, b string, c int")
    new = T.StructType.fromDDL("a bigint, B string, c int NOT NULL")
    diff = evolve.compare_schemas(old, new, case_sensitive=True)
    assert [f.name for f in diff.added] == ["B"]
    assert [(c.column, c.held.simpleString(), c.brought.simpleString()) for c in diff.conflicts] == [("a", "int", "bigint")]
    assert diff.absent == ["b"]
    folded = evolve.compare_schemas(old, new)
    assert folded.renamed == {"B": "b"} and not folded.added and not folded.absent
    loose, strict = (T.StructType([T.StructField("l", T.ArrayType(T.IntegerType(), n))]) for n in (True, False))
    assert evolve.compare_schemas(loose, strict) == evolve.SchemaDiff()


def test_create_append_add_and_missing(spark, table):
    assert evolve.write_evolving(spark, spark.sql("SELECT 1 AS a, 'x' AS b"), table).path == "create"
    assert evolve.write_evolving(spark, spark.sql("SELECT 'y' AS b, 2 AS a"), table).path == "append"
    report = evolve.write_evolving(spark, spark.sql("SELECT 3 AS a, 'z' AS b, 1.5D AS `2022`, array(1) AS lista"), table)
    assert (report.path, report.added) == ("add_columns", ["2022", "lista"])
    assert evolve.write_evolving(spark, spark.sql("SELECT 4 AS a"), table).path == "append"
    assert rows(spark, table) == [(1, "x", None, None), (2, "y", None, None), (3, "z", 1.5, [1]), (4, None, None, None)]


def test_conflict_keeps_history_and_wins_over_new_columns(spark, table):
    evolve.write_evolving(spark, spark.sql("SELECT 1 AS a"), table)
    first = evolve.write_evolving(spark, spark.sql("SELECT 'dois' AS a, 3 AS novo"), table, now=NOW)
    assert first.path == "recreate" and [(c.column, c.brought.simpleString()) for c in first.conflicts] == [("a", "string")]
    assert first.backup == f"{table}_bkp_20240506_070809"
    second = evolve.write_evolving(spark, spark.sql("SELECT 5.5D AS a"), table, now=NOW)
    assert second.backup == f"{table}_bkp_20240506_070809_2"
    assert rows(spark, table) == [(5.5,)]
    assert rows(spark, first.backup) == [(1,)] and rows(spark, second.backup) == [("dois", 3)]


def test_conflict_on_partitioned_table(spark, table):
    load = lambda value: spark.sql(f"SELECT {value} AS v, p FROM VALUES ('a b'), ('c/d'), ('e''f'), (NULL) AS t(p)")
    evolve.write_evolving(spark, load(1), table, partition_by=["p"])
    report = evolve.write_evolving(spark, load("'x'"), table, partition_by=["p"])
    assert len(rows(spark, table)) == 4 and {r[0] for r in rows(spark, table)} == {"x"}
    assert {r[0] for r in rows(spark, report.backup)} == {1} and len(rows(spark, report.backup)) == 4
    evolve.write_evolving(spark, load("'y'"), table, partition_by=["p"])
    assert spark.table(table).count() == 8 and spark.table(report.backup).count() == 4


def test_widen_casts_up_only(spark, table):
    evolve.write_evolving(spark, spark.sql("SELECT 1.5D AS a, 7L AS b"), table)
    assert evolve.write_evolving(spark, spark.sql("SELECT CAST(2 AS FLOAT) AS a, 8 AS b"), table, widen=True).path == "append"
    assert rows(spark, table) == [(1.5, 7), (2.0, 8)]
    assert evolve.write_evolving(spark, spark.sql("SELECT 't' AS a, 8 AS b"), table, widen=True).path == "recreate"


def test_failing_load_touches_nothing(spark, table):
    evolve.write_evolving(spark, spark.sql("SELECT 1 AS a"), table)
    with pytest.raises(Exception):
        evolve.write_evolving(spark, spark.range(1).select(F.raise_error(F.lit("quebrou")).cast("string").alias("a")), table)
    assert rows(spark, table) == [(1,)]


def test_ghost_table_needs_permission(spark, table):
    df = spark.sql("SELECT 1 AS a")
    evolve.write_evolving(spark, df, table)
    assert not evolve.table_files_missing(spark, table)
    assert evolve.recover_ghost_table(spark, df, table).path == "append"
    shutil.rmtree(spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first().data_type.removeprefix("file:"))
    assert evolve.table_files_missing(spark, table)
    with pytest.raises(RuntimeError, match="allow_drop"):
        evolve.recover_ghost_table(spark, df, table)
    assert evolve.recover_ghost_table(spark, df, table, allow_drop=True).path == "recover"
    assert rows(spark, table) == [(1,)]


def test_replace(spark, table):
    evolve.replace_table(spark.sql("SELECT 1 AS a"), table)
    evolve.replace_table(spark.sql("SELECT 'x' AS b, 2 AS c"), table)
    assert rows(spark, table) == [("x", 2)]


def test_ingest_file_repeated_loads(spark, tmp_path, table):
    (tmp_path / "um.txt").write_bytes("Ano;Preço\n2020;1\n".encode("latin-1"))
    (tmp_path / "dois.txt").write_bytes("Ano;Preço;UF\n2021;2;SP\n".encode("latin-1"))
    (tmp_path / "tres.txt").write_bytes("Ano;Preço\n2022;caro\n".encode("latin-1"))
    paths = [ingest_file(spark, str(tmp_path / f"{n}.txt"), "txt", table, n, "2024-01-01 00:00:00", infer=True).path for n in ("um", "dois", "tres")]
    assert paths == ["create", "add_columns", "recreate"]
    row = spark.table(table).first()
    assert (row.ano, row.preco, row._source_file, row._batch_id) == (2022, "caro", "tres.txt", "tres")


def test_listing_isolates_failures(spark, tmp_path):
    db = fresh_database(spark, "lista")
    (tmp_path / "a.txt").write_text("x;y\n1;2\n")
    (tmp_path / "b.csv").write_text("x,y\n1,2\n3,4\n")
    item = lambda table, name, kind: {"tabela": table, "path": str(tmp_path / name), "extensao": kind}
    items = [item("a", "a.txt", "txt"), item("z", "nada.txt", "txt"), item("p", "a.txt", "pdf"), item("b", "b.csv", "csv"), item("a", "a.txt", "txt")]
    with pytest.raises(RuntimeError, match="2 of 5 files failed") as failure:
        ingest_listing(spark, items, db, "c1", "2024-01-01 00:00:00")
    assert "nada.txt" in str(failure.value) and "unsupported" in str(failure.value)
    assert spark.table(f"{db}.a").count() == 2 and spark.table(f"{db}.b").count() == 2
    reports = ingest_listing(spark, items[:1], db, "c2", "2024-01-02 00:00:00")
    assert [r.path for r in reports] == ["append"]


def test_compaction_keeps_rows_in_fewer_files(spark, table):
    df = spark.range(1000).withColumn("uf", F.concat(F.lit("u"), F.col("id") % 3))
    for part in range(4):
        evolve.write_evolving(spark, df.where(F.col("id") % 4 == part).repartition(8), table, partition_by=["uf"])
    before = len(spark.table(table).inputFiles())
    spark.range(10).withColumn("uf", F.lit("u0")).repartition(10).write.mode("append").insertInto(table)
    old = layout.compact_table(spark, table)
    after = len(spark.table(table).inputFiles())
    assert spark.table(table).count() == 1010 == spark.table(old).count()
    assert after <= 3 < before + 10


def test_layout_prunes_and_compresses(spark):
    path = fresh_path(spark, "layout")
    layout.write_layer(spark.range(100).withColumn("ano", (F.col("id") % 5 + 2000).cast("int")), path, "gold", ["ano"])
    df = spark.read.parquet(path)
    assert all(".zstd" in f for f in df.inputFiles()) and len(df.inputFiles()) == 5
    pruned = df.where("ano >= 2003")
    assert pruned.count() == 40
    assert "PartitionFilters: [isnotnull(ano" in pruned._jdf.queryExecution().executedPlan().toString()


def test_hot_partition_value_is_split(spark):
    """One value with most of the rows must not become one task."""
    path = fresh_path(spark, "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    try:
        df = spark.range(0, 400_000, 1, 8).withColumn("t", F.sha2(F.col("id").cast("string"), 256)).withColumn("k", F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 50).cast("string")))
        layout.write_layer(df, path, "bronze", ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    written = spark.read.parquet(path)
    assert len(written.where("k = 'hot'").inputFiles()) and written.count() == 400_000
    hot_files = [f for f in written.inputFiles() if "k=hot" in f]
    assert len(hot_files) > 1


def test_spelling_in_another_case_is_the_same_column(spark, table):
    evolve.write_evolving(spark, spark.sql("SELECT 1 AS preco"), table)
    report = evolve.write_evolving(spark, spark.sql("SELECT 2 AS Preco"), table)
    assert report.path == "append" and rows(spark, table) == [(1,), (2,)]


def test_compaction_twice_keeps_layout_and_fails_cleanly(spark, table):
    df = spark.range(100).withColumn("uf", F.concat(F.lit("u"), F.col("id") % 3))
    layout.write_layer_table(df.repartition(9), table, "gold", ["uf"])
    kept = layout.table_layout(spark, table)
    olds = {layout.compact_table(spark, table) for _ in range(2)}
    assert len(olds) == 2 and layout.table_layout(spark, table) == kept == ("parquet", ["uf"], {"compression": "zstd"})
    with pytest.raises(ValueError):
        layout.compact_table(spark, table, keep_old=olds.pop())
    assert spark.table(table).count() == 100


def test_folder_of_differing_headers_lands_with_lineage_and_rejects(spark, db, tmp_path):
    (tmp_path / "a.txt").write_text("Ano;UF\n2020;SP\n1;2;3\n", encoding="latin-1")
    (tmp_path / "b.txt").write_text("UF;Ano;Preço\nRJ;2021;9\n", encoding="latin-1")
    ingest_file(spark, str(tmp_path), "txt", f"{db}.misto", "c1", "2024-01-01 00:00:00")
    got = spark.table(f"{db}.misto").orderBy("ano").select("ano", "uf", "preco", "_source_file").collect()
    assert [tuple(r) for r in got] == [("2020", "SP", None, "a.txt"), ("2021", "RJ", "9", "b.txt")]
    lost = spark.table(f"{db}.misto_rejeitadas").collect()
    assert [(r.line, r.motivo, r._source_file) for r in lost] == [("1;2;3", "3 celulas para 2 colunas", "a.txt")]
    with pytest.raises(ValueError):
        ingest_listing(spark, [], db, "c1", "2024-01-01 00:00:00")


def test_binary_workbook_is_refused(spark, db, tmp_path):
    (tmp_path / "w.xlsx").write_bytes(b"PK\x03\x04rest")
    with pytest.raises(ValueError, match="binary"):
        ingest_file(spark, str(tmp_path / "w.xlsx"), "xlsx", f"{db}.w", "c1", "2024-01-01 00:00:00")


def test_a_rename_is_two_statements_however_many_partitions(spark, monkeypatch):
    db = fresh_database(spark, "teste")
    rows = spark.range(200).select("id", F.when(F.col("id") % 51 > 0, F.concat(F.lit("a/b %=é "), (F.col("id") % 51).cast("string"))).alias("p"), (F.col("id") % 2).alias("q"))
    evolve.write_evolving(spark, rows, f"{db}.t", partition_by=["p", "q"])
    said, sql = [], spark.sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or sql(text, *a, **k))
    evolve.rename_table(spark, f"{db}.t", f"{db}.u")
    monkeypatch.undo()
    assert len(said) == 2
    evolve.write_evolving(spark, spark.range(3).withColumns({"p": F.lit("x"), "q": F.lit(0).cast("long")}), f"{db}.t", partition_by=["p", "q"])
    assert sorted(r.id for r in spark.table(f"{db}.u").collect()) == list(range(200))
    assert {(r.p, r.q) for r in spark.table(f"{db}.u").collect()} == {(r.p, r.q) for r in rows.collect()}
    assert spark.table(f"{db}.u").where("p is null").count() == rows.where("p is null").count() > 0


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark):
    name = f"{fresh_database(spark, 'teste')}.t"
    rows = spark.range(1000).selectExpr("id", "id % 40 AS p")
    evolve.write_evolving(spark, rows, name, partition_by=["p"])
    evolve.write_evolving(spark, rows.where("p < 3"), name)
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before, explain = spark.conf.get(setting), f"EXPLAIN INSERT INTO {name} BY NAME SELECT id, p FROM {name}"
    assert " Sort [" in spark.sql(explain).first().plan
    with evolve.open_writers(spark):
        assert " Sort [" not in spark.sql(explain).first().plan
    assert spark.conf.get(setting) == before
    # More values than open files in a task: the rest is sorted, and no row is lost.
    assert spark.table(name).groupBy("p").count().where("count = IF(p < 3, 50, 25)").count() == 40


def test_a_keyed_write_sorts_nothing(spark, monkeypatch):
    asked = []
    kept = evolve.open_writers
    monkeypatch.setattr(evolve, "open_writers", lambda session: asked.append(1) or kept(session))
    name = f"{fresh_database(spark, 'teste')}.t"
    for number in (0, 1, 1):
        evolve.write_keyed(spark, spark.range(10).selectExpr("id", "id % 2 AS p"), name, "lote", number, ["p"])
    assert len(asked) == 3 and spark.table(name).groupBy("lote", "p").count().where("count = 5").count() == 4
