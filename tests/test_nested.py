import json
import os
import random

import pytest
from pyspark.sql import functions as F

from registered import fixtures as fx
from tulha.operators import catalogue, observations as obs, quarantine
from tulha.plans import ingest
from tulha.plans.ingest import ingest_responses, register_catalogue_views, register_dataset_views
from tulha.session import fresh_database
from tulha.sources import responses


def parsed(spark, bodies):
    df = spark.createDataFrame([(str(i), json.dumps(b) if not isinstance(b, str) else b) for i, b in enumerate(bodies)], "agregado_id string, body string")
    return responses.parse_body(df, responses.DATA_SCHEMA)


def result(classifications, series):
    return {
        "classificacoes": [{"id": i, "nome": n, "categoria": c} for i, n, c in classifications],
        "series": [{"localidade": {"id": i, "nome": n}, "serie": s} for i, n, s in series],
    }


def test_round_trip(spark):
    """A flat table nested at random comes back as it was."""
    draw = random.Random(7)
    flat, bodies = [], []
    for dataset in range(30):
        blocks = []
        for v in range(draw.randint(1, 3)):
            results = []
            for c in range(draw.randint(1, 3)):
                series = []
                for place in range(draw.randint(0, 4)):
                    cells = {str(2000 + p): draw.choice(["1.5", "..", "-", "7", "X"]) for p in range(draw.randint(0, 3))}
                    series.append((f"l{place}", f"Lugar {place}", cells))
                    flat += [(str(dataset), f"v{v}", "t", f"l{place}", f"Lugar {place}", p, None if x in "..-X" else float(x), f"c{c}", str(c)) for p, x in cells.items()]
                results.append(result([("80", "Produto", {str(c): f"c{c}"})], series))
            blocks.append({"variavel": f"v{v}", "unidade": "t", "resultados": results})
        bodies.append(blocks)
    df = obs.flatten_observations(parsed(spark, bodies))
    wide = obs.dimension_columns(df, obs.dimension_labels(df))
    assert wide.columns == obs.CORE_COLUMNS + ["produto", "produto_id"]
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(flat, key=str)


def test_missing_parts_and_fallbacks(spark):
    body = [
        {"resultados": [result([("80", "", {"1": "um"}), ("", None, {"2": "dois"}), ("81", "Vazia", {}), ("82", "Ação", {"9": "nove", "8": "oito"})], [("1", "A", {"2022": "3"})])]},
        {"variavel": "v", "unidade": "t"},
        {"variavel": "v", "unidade": "t", "resultados": []},
        {"variavel": "v", "unidade": "t", "resultados": [{"series": [{"serie": {"2022": "4"}}]}]},
    ]
    df = obs.flatten_observations(parsed(spark, [body]))
    wide = obs.dimension_columns(df, obs.dimension_labels(df)).orderBy("valor").collect()
    first, second = (r.asDict() for r in wide)
    assert (first["variavel"], first["unidade"], first["valor"]) == ("", "", 3.0)
    assert first["80"] == "um" and first["classificacao"] == "dois" and first["acao"] == "nove" and first["acao_id"] == "9"
    assert "vazia" not in first
    assert second["localidade_id"] is None and second["valor"] == 4.0 and second["acao"] is None


def test_later_dimension_wins(spark):
    body = [{"variavel": "v", "resultados": [result([("1", "Tipo", {"a": "A"}), ("2", "TIPO", {"b": "B"}), ("3", "Tipo id", {"c": "C"})], [("1", "A", {"2022": "1"})])]}]
    df = obs.flatten_observations(parsed(spark, [body]))
    row = obs.dimension_columns(df, obs.dimension_labels(df)).first()
    assert row["tipo"] == "B" and row["tipo_id"] == "C" and row["tipo_id_id"] == "c"


def test_dimension_over_core_columns(spark):
    body = [{"variavel": "v", "resultados": [result([("1", "Variável", {"a": "outra"})], [("1", "A", {"2022": "1"})])]}]
    df = obs.flatten_observations(parsed(spark, [body]))
    assert obs.dimension_columns(df, ["Variável"]).first().variavel == "outra"
    with pytest.raises(ValueError):
        obs.dimension_columns(df, ["Valor"])


def test_all_values_suppressed_still_load(spark):
    body = [{"variavel": "v", "resultados": [result([], [("1", "A", {"2022": "..", "2023": "X"})])]}]
    df = obs.flatten_observations(parsed(spark, [body]))
    assert dict(df.dtypes)["valor"] == "double" and df.where("valor IS NULL").count() == 2


def test_quarantine_reasons(spark):
    good = [{"variavel": "v", "resultados": []}]
    bodies = [
        ("a", json.dumps(good)), ("b", None), ("c", "  "), ("d", "[]"), ("e", "<html>"), ("f", '{"erro": 1}'), ("g", json.dumps(good)[:-5]),
        ("h", '[{"variavel": 1}]'), ("i", "[1]"), ("j", '[{"variavel": "v", "resultados": "erro"}]'),
    ]
    marked = quarantine.mark_blocks(spark.createDataFrame(bodies, "id string, body string"))
    assert {r.id: r.motivo for r in marked.collect()} == {
        "a": None, "b": "vazio", "c": "vazio", "d": "sem variaveis", "e": "json ilegivel", "f": "estrutura inesperada",
        "g": "json ilegivel", "h": None, "i": "estrutura inesperada", "j": "estrutura inesperada",
    }
    kept, rejects = quarantine.split_marked(marked)
    assert kept.count() == 2 and rejects.count() == 8
    with pytest.raises(RuntimeError, match="vazio=2"):
        quarantine.raise_on_rejects(rejects)
    quarantine.raise_on_rejects(rejects.limit(0))


def test_last_of_equal_keys_counts(spark):
    series = '{"localidade":{"id":"1"},"serie":{"2020":"1","2020":"2"}}'
    body = f'[{{"variavel":"A","variavel":"B","resultados":[{{"series":[{series}]}}]}},{{"variavel":"C","resultados":[{{"series":"x"}}]}}]'
    marked = quarantine.mark_blocks(spark.createDataFrame([("d", body), ("e", None)], "agregado_id string, body string"))
    rows = obs.flatten_observations(quarantine.split_marked(marked)[0]).collect()
    assert [(r.variavel, r.periodo, r.valor) for r in rows] == [("B", "2020", 2.0)]
    counts = {r.agregado_id: tuple(r)[1:] for r in quarantine.reconciled(marked, ["agregado_id"]).collect()}
    assert counts == {"d": (2, 1, 1, True), "e": (1, 0, 1, True)}


def test_ingest_responses_and_views(spark):
    db = fresh_database(spark, "teste")
    one = [{"variavel": "v", "unidade": "t", "resultados": [result([("1", "Produto", {"a": "A"})], [("1", "A", {"2022": "1"})])]}]
    two = [{"variavel": "v", "unidade": "t", "resultados": [result([("1", "Rebanho", {"b": "B"})], [("1", "A", {"2022": "2"})])]}]
    landed = spark.createDataFrame([("10", json.dumps(one), "f1"), ("20", json.dumps(two), "f2"), ("20", "oops", "f3")], "agregado_id string, body string, source_file string")
    report, rejects = ingest_responses(spark, landed, f"{db}.obs", "c1", "2024-01-01 00:00:00", f"{db}.rej")
    assert report.path == "create" and rejects.path == "create"
    empty = spark.createDataFrame([("30", "[]", "f4")], landed.schema)
    report, rejects = ingest_responses(spark, empty, f"{db}.obs", "c2", "2024-01-02 00:00:00", f"{db}.rej")
    assert report is None and rejects.path == "append"
    report, _ = ingest_responses(spark, landed.where("source_file = 'f1'"), f"{db}.obs", "c3", "2024-01-03 00:00:00", f"{db}.rej")
    assert report.path == "append" and spark.table(f"{db}.obs").count() == 3
    assert sorted((r.agregado_id, r.motivo) for r in spark.table(f"{db}.rej").collect()) == [("20", "json ilegivel"), ("30", "sem variaveis")]
    register_dataset_views(spark, f"{db}.obs", {"10": "agregado_10_teste", "20": "agregado_20_teste"})
    assert spark.table("agregado_10_teste").columns[-2:] == ["produto", "produto_id"]
    assert spark.sql("SELECT rebanho, valor FROM agregado_20_teste").first() == ("B", 2.0)
    plan = spark.table("agregado_20_teste")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(agregado_id" in plan


def test_catalogue_rules(spark):
    body = json.dumps(
        [
            {"id": "PP", "nome": "Pesquisa da Pecuária Municipal", "agregados": [{"id": "1", "nome": "Efetivo"}, {"id": "2", "nome": "Antigo (série encerrada)"}]},
            {"id": "CA", "nome": "Censo Agropecuário", "agregados": [{"id": "3", "nome": "Área irrigada"}, {"id": "4", "nome": "Métodos de irrigação, " + "muito " * 40}, {"id": "5", "nome": "Tratores"}]},
            {"id": "XX", "nome": "Outra", "agregados": [{"id": "6", "nome": "Irrigação"}]},
            {"id": "YY", "agregados": [{"id": "7", "nome": "Trator"}]},
            {"id": "ZZ", "nome": "PPM"},
        ]
    )
    df = responses.parse_body(spark.createDataFrame([(body,)], "body string"), responses.CATALOGUE_SCHEMA)
    rows = {r.agregado_id: r for r in catalogue.catalog_topics(df).collect()}
    assert sorted(rows) == ["1", "4", "5"]
    assert rows["1"].tabela == "agregado_1_efetivo" and len(rows["4"].tabela) == 120


def test_levels_and_requests(spark):
    docs = [
        {"id": 1, "variaveis": [{"id": 10}, {"id": 11}], "classificacoes": [{"id": 80}, {"id": 81}], "nivelTerritorial": {"Administrativo": ["N1", "N3", "N6"]}},
        {"id": 2, "variaveis": [{"id": 10}], "classificacoes": [], "nivelTerritorial": {"Administrativo": ["N8", "N2"]}},
        {"id": 3, "variaveis": [], "nivelTerritorial": {"Administrativo": ["N1"]}},
        {"id": 4, "variaveis": [{"id": 1}], "nivelTerritorial": {"Administrativo": []}},
        {"id": 5, "variaveis": [{"id": 1}]},
    ]
    df = spark.createDataFrame([(json.dumps(d), json.dumps([{"id": p} for p in ("2015", "2016", "202206", "2023")])) for d in docs], "body string, p string")
    df = responses.parse_body(responses.parse_body(df, responses.METADATA_SCHEMA), responses.PERIODS_SCHEMA, "p", "periodos")
    specs = catalogue.request_specs(df, keep=["periodos"])
    got = {r.agregado_id: (r.variaveis, r.localidades, r.classificacao, r.motivo) for r in specs.collect()}
    assert got["1"] == ("10|11", "N6[all]", "80[all]|81[all]", None)
    assert got["2"] == ("10", "N8[all]", None, None)
    assert [got[k][3] for k in "345"] == ["sem variaveis", "sem nivel territorial", "sem nivel territorial"]
    wanted = catalogue.requests_by_period(specs, "periodos", 6, 2022, base="http://x")
    assert sorted((r.agregado_id, r.periodo) for r in wanted.collect()) == [("1", "2016"), ("1", "202206"), ("2", "2016"), ("2", "202206")]
    assert wanted.where("agregado_id = 1 AND periodo = 2016").first().caminho == "http://x/agregados/1/periodos/2016/variaveis/10|11"


def test_blocks_are_quarantined_one_by_one(spark):
    good = '{"variavel":"A","resultados":[{"series":[{"localidade":{"id":"1","nome":"x"},"serie":{"2020":"1"}}]}]}'
    bodies = {
        1: f'[{good},{{"resultados":[{{"series":"erro"}}]}},{good}]',
        2: f'[{{"resultados":[{{"series":[{{"serie":["1"]}}]}}]}},{good}]',
        3: f'[{{"variavel":"sem resultados"}},{good}]',
        4: f"[{good},{{",
        5: "[]",
        6: None,
        7: '{"erro":1}',
        8: f'[7,{good},{{"resultados":{{}}}}]',
        9: f'[{{"resultados":null}},{good}]',
    }
    df = spark.createDataFrame(list(bodies.items()), "agregado_id int, body string")
    marked = quarantine.mark_blocks(df).collect()
    assert {(r.agregado_id, r.bloco, r.motivo) for r in marked if r.motivo} == {
        (1, 1, "estrutura inesperada"), (2, 0, "estrutura inesperada"), (4, -1, "json ilegivel"), (5, -1, "sem variaveis"), (6, -1, "vazio"),
        (7, -1, "estrutura inesperada"), (8, 0, "estrutura inesperada"), (8, 2, "estrutura inesperada"),
    }
    rows = obs.flatten_observations(quarantine.split_marked(quarantine.mark_blocks(df))[0])
    assert {r.agregado_id: r["count"] for r in rows.groupBy("agregado_id").count().collect()} == {1: 2, 2: 1, 3: 1, 8: 1, 9: 1}


def test_empty_catalogue_is_an_error(spark):
    with pytest.raises(ValueError):
        register_catalogue_views(spark, "nada", spark.createDataFrame([], "agregado_id string, tabela string"))


def test_catalogue_to_views(spark):
    documents = [("1", [{"id": "s", "nome": "Pesquisa da Pecuária Municipal", "agregados": [{"id": "7", "nome": "Efetivo (ha)"}, {"id": "8", "nome": "Leite"}]}])]
    parsed_documents = responses.parse_body(spark.createDataFrame([(i, json.dumps(d)) for i, d in documents], "i string, body string"), responses.CATALOGUE_SCHEMA)
    found = catalogue.catalog_topics(parsed_documents, metadata_base="https://example.org/api")
    assert {r.url_metadados for r in found.collect()} == {f"https://example.org/api/agregados/{n}/metadados" for n in (7, 8)}
    table = f"{fresh_database(spark, 'estatistica')}.observacoes"
    body = lambda tipo: [{"variavel": "v", "resultados": [result([("1", tipo, {"a": "A"})], [("1", "SP", {"2022": "5"})])]}]
    landed = spark.createDataFrame([("7", json.dumps(body("Tipo")), "a.json"), ("8", json.dumps(body("Raça")), "b.json")], "agregado_id string, body string, source_file string")
    ingest_responses(spark, landed, table, "c1", "2024-01-01 00:00:00", table + "_rej")
    names = register_catalogue_views(spark, table, found)
    assert names == ["agregado_7_efetivo_ha", "agregado_8_leite"]
    assert spark.table(names[0]).first().tipo == "A" and spark.table(names[1]).first().raca == "A"
    assert {(r.agregado_id, r.rotulo) for r in spark.table(table + "_rotulos").collect()} == {("7", "Tipo"), ("8", "Raça")}
    plan = spark.sql(f"SELECT * FROM {table} WHERE ano = 2022")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_only_doubtful_responses_are_taken_apart(spark):
    whole = json.dumps([{"variavel": "A", "resultados": [result([("1", "Tipo", {"a": "A"})], [("1", "SP", {"2022": "5"})])]}])
    absent = '[{"variavel":"B"},{"variavel":"C","resultados":[{"series":[{"serie":null}],"classificacoes":[{"categoria":7}]}]},null]'
    df = spark.createDataFrame([(1, whole), (2, absent), (3, "[{")], "agregado_id int, body string")
    marked = quarantine.mark_blocks(df, size="n_blocos")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "try_variant_get(_variant" in plan and "explode(array(try_variant_get(_variant#" in plan and "explode(array(CASE WHEN coalesce(exists(_blocks" in plan
    rows = sorted((r.agregado_id, r.bloco, r.motivo, r.body, r.n_blocos) for r in marked.collect())
    block = '{"resultados":[{"classificacoes":[{"categoria":7}],"series":[{"serie":null}]}],"variavel":"C"}'
    assert rows == [
        (1, 0, None, None, 1), (2, 0, None, None, 3), (2, 1, "estrutura inesperada", block, 3),
        (2, 2, "estrutura inesperada", "null", 3), (3, -1, "json ilegivel", "[{", 1),
    ]


def test_many_responses_reconciled_as_one_group(spark):
    bodies = [("f", '[{"variavel":"A"},7]'), ("f", "[{"), ("f", '[{"variavel":"A"}]'), ("g", None)]
    marked = quarantine.mark_blocks(spark.createDataFrame(bodies, "source_file string, body string"), size="n_blocos")
    counts = quarantine.reconciled(marked, ["source_file"], "n_blocos")
    assert sorted(tuple(r) for r in counts.collect()) == [("f", 4, 2, 2, 3, True), ("g", 1, 0, 1, 1, True)]
    lost = quarantine.reconciled(marked.where("motivo IS NULL OR bloco <= 0"), ["source_file"], "n_blocos")
    assert {r.source_file: (r.n_esperados, r.n_rejeitados, r.conferido) for r in lost.collect()}["f"] == (4, 1, False)


def test_labels_of_results_that_hold_observations(spark):
    named = [("1", "Tipo", {"a": "A"}), ("2", "", {"b": "B"}), ("3", "Vazia", {})]
    body = [{"variavel": "v", "resultados": [result(named, [("1", "SP", {"2022": "5"})]), result([("4", "Sem linhas", {"c": "C"})], [("1", "SP", {})]), result([("5", "Nada", {"d": "D"})], [])]}]
    marked = quarantine.mark_blocks(spark.createDataFrame([("7", json.dumps(body))] * 2 + [("8", "[]")], "agregado_id string, body string"))
    good, _ = quarantine.split_marked(marked)
    flat = obs.flatten_observations(good).select("agregado_id", F.explode("dimensoes.rotulo").alias("rotulo")).distinct()
    found = obs.published_labels(good)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, flat.collect())) == [("7", "2"), ("7", "Tipo")]
    assert "serie#" not in found._jdf.queryExecution().executedPlan().toString()


def test_landed_and_staged_responses_take_little_disk(spark, tmp_path, monkeypatch):
    """Landed bodies are many times the table they come from, so they lie compressed, in files that several tasks can read."""
    k = F.col("id")
    day = F.date_add(F.lit("1995-01-01"), (k % 2000).cast("int")).cast("timestamp_ntz")
    spark.range(0, 1000, 1, 1).select(
        k.alias("o_orderkey"), F.xxhash64(k).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), (F.pmod(F.xxhash64(k), F.lit(10**7)) / 100).alias("o_totalprice"),
        day.alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(fx, "RESPONSES_PER_FILE", 300)
    landed = fx.land_responses(spark, str(tmp_path), F.lit("d"), F.to_json("parsed"))
    files = [f.removeprefix("file://") for f in landed.inputFiles()]
    assert len(files) == 4 and all(f.endswith(".json.gz") for f in files)
    assert 5 * sum(map(os.path.getsize, files)) < landed.agg(F.sum(F.octet_length("body"))).first()[0]
    bodies = sorted(r.body for r in landed.collect())
    assert bodies == sorted(r.body for r in fx.nested_responses(spark, str(tmp_path)).select(F.to_json("parsed").alias("body")).collect())
    staged, drop = [], ingest.drop_folder
    monkeypatch.setattr(ingest, "drop_folder", lambda spark, path: (staged.extend(spark.read.parquet(path).inputFiles()), drop(spark, path)))
    db = fresh_database(spark, "teste")
    ingest_responses(spark, landed, f"{db}.obs", "c1", "2024-01-01 00:00:00", f"{db}.rej")
    assert staged and all(f.endswith(".zstd.parquet") for f in staged) and spark.table(f"{db}.obs").count() > 1000
