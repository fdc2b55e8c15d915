import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tulha.operators import analyses, geo, gold, quality, silver

OBS = "agregado_id string, variavel string, unidade string, localidade_id string, localidade_nome string, periodo string, valor double"


def observations(spark, rows):
    return spark.createDataFrame([("d", v, "t", l, f"L{l}", p, x) for v, l, p, x in rows], OBS)


def test_location_mean_and_ties(spark):
    df = observations(spark, [("v", "2", "2020", 5.0), ("v", "1", "2020", 5.0), ("v", "1", "2021", None), ("v", "3", "2020", None), ("v", "4", "2020", 9.0)])
    means = {r.localidade_id: r.media_valor for r in analyses.location_mean(df).collect()}
    assert means == {"1": 5.0, "2": 5.0, "3": None, "4": 9.0}
    assert [r.localidade_id for r in analyses.top_locations(df, 3).collect()] == ["4", "1", "2"]
    assert [r.localidade_id for r in analyses.top_locations(df, 10).collect()] == ["4", "1", "2", "3"]
    assert "TakeOrderedAndProject" in analyses.top_locations(df)._jdf.queryExecution().executedPlan().toString()


def test_period_text_groups_apart(spark):
    df = observations(spark, [("v", "1", "2022", 1.0), ("v", "1", "202201", 2.0), ("v", "1", "2022", 3.0), ("v", "1", None, 4.0)])
    assert [tuple(r) for r in analyses.period_total(df).collect()] == [("2022", 4.0), ("202201", 2.0), (None, 4.0)]


def test_annual_cost_is_sum_of_sums(spark):
    df = spark.createDataFrame([(2020, 1.0, None), (2020, None, 5.0), (2021, None, 1.0)], "ano int, vlr_custo_variavel_ha double, vlr_custo_fixo_ha double")
    assert [tuple(r) for r in analyses.annual_cost(df).collect()] == [(2020, 1.0, 5.0, 6.0), (2021, None, 1.0, None)]


def test_typed_and_split(spark):
    df = spark.createDataFrame([("a", "1", "2020-01-01"), ("b", "x", None), ("c", None, "ontem")], "id string, n string, d string")
    good, bad = silver.split_typed(df, {"n": "int", "d": "date"})
    assert good.dtypes == [("id", "string"), ("n", "int"), ("d", "date")] and good.count() == 1
    assert {r.id: (r.n, r.d, r._rejeitadas) for r in bad.collect()} == {"b": ("x", None, ["n"]), "c": (None, "ontem", ["d"])}


def test_latest_by_key_limits_before_the_shuffle(spark):
    rows = [("k", i, f"f{i % 7}") for i in range(500)] + [("j", 1, "a"), ("j", 1, "b"), (None, 3, "c"), (None, None, "d")]
    df = spark.createDataFrame(rows, "k string, _ingest_ts int, _source_file string")
    latest = silver.latest_by_key(df, ["k"])
    assert {r.k: (r._ingest_ts, r._source_file) for r in latest.collect()} == {"k": (499, "f2"), "j": (1, "b"), None: (3, "c")}
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_pseudonyms(spark):
    df = spark.createDataFrame([("Ana", 1), (None, 2)], "nome string, n int")
    got = silver.pseudonymised(df, ["nome"], "s").orderBy("n").collect()
    assert len(got[0].nome) == 64 and got[1].nome is None
    with pytest.raises(ValueError):
        silver.pseudonymised(df, ["nome"], "")


def test_state_year_guards_division(spark):
    df = observations(spark, [("prod", "1", "2020", 10.0), ("area", "1", "202003", 4.0), ("prod", "2", "2020", 3.0), ("area", "2", "2020", 0.0)])
    got = {r.uf: (r.producao, r.area, r.rendimento) for r in gold.state_year(df, "prod", "area").collect()}
    assert got == {"L1": (10.0, 4.0, 2.5), "L2": (3.0, 0.0, None)}


def test_star_schema_keeps_totals(spark):
    df = observations(spark, [("v", str(i % 5), f"20200{i % 3 + 1}", float(i)) for i in range(100)])
    df = df.withColumn("localidade_nome", F.when(F.rand(1) < 0.5, "a").otherwise("b"))
    dims = gold.star_dimensions(df)
    assert {n: d.count() for n, d in dims.items()} == {"localidade": 5, "periodo": 3, "variavel": 1, "fonte": 1}
    joined = gold.star_join(gold.star_fact(df), dims)
    assert joined.count() == 100 and joined.agg(F.sum("valor")).first()[0] == 4950.0
    partial = dims["localidade"].where("localidade_id <> '3'")
    assert gold.orphan_facts(gold.star_fact(df), partial, "sk_localidade").count() == 20


def test_feature_gaps_stay_gaps(spark):
    df = observations(spark, [("v", "1", "202001", 1.0), ("v", "1", "202002", 2.0), ("v", "1", "202002", 3.0), ("v", "1", "202004", 10.0), ("v", "1", "202101", 7.0), ("v", "1", "2020", 99.0)])
    got = {r.periodo: (r.valor_mes, r.mes_anterior, r.ano_anterior, r.media_3_meses) for r in gold.feature_lags(df).collect()}
    assert got == {"202001": (1.0, None, None, 1.0), "202002": (5.0, 1.0, None, 3.0), "202004": (10.0, None, None, 7.5), "202101": (7.0, None, 1.0, 7.0)}


def test_anomalies(spark):
    values = [10.0, 11.0, 9.0, 10.5, 9.5, 10.0, 30.0, 10.2]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)] + [("flat", i, 5.0) for i in range(4)], "s string, t int, v double")
    z = (30.0 - statistics.mean(values)) / statistics.stdev(values)
    rows = quality.series_anomalies(df, ["s"], "t", "v").collect()
    assert [(r.s, r.t) for r in rows] == [("s", 6)] and math.isclose(rows[0].z, z)


def test_completeness_states(spark):
    one = lambda keys: spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r.k: r.situacao for r in quality.completeness(one("aabbcd"), one("aabcce"), ["k"]).collect()}
    assert got == {"a": "completo", "b": "parcial", "c": "excedente", "d": "ausente", "e": "inesperado"}
    assert [r.k for r in quality.missing_items(one("abc"), one("aab"), "k").collect()] == ["c"]


def test_quality_and_contract(spark):
    df = spark.createDataFrame([("1", "x"), ("dois", None), (None, "y")], "n string, t string")
    report = {r.regra: (r.n_linhas, r.n_falhas) for r in quality.quality_report(df, {"n": ("completude", "n", F.col("n").isNotNull()), "t_x": ("validade", "t", F.col("t") == "x")}).collect()}
    assert report == {"n": (3, 1), "t_x": (3, 2)}
    contract = T.StructType.fromDDL("n int NOT NULL, t string, falta date NOT NULL")
    found = {(r.coluna, r.regra): r.n_violacoes for r in quality.contract_violations(df, contract).collect()}
    assert found == {("n", "tipo"): 1, ("n", "obrigatorio"): 1, ("t", "tipo"): 0, ("t", "obrigatorio"): 0, ("falta", "tipo"): 0, ("falta", "obrigatorio"): 3}
    assert quality.schema_violations(df.schema, contract) == [("falta", "ausente"), ("n", "tipo string, esperado int")]


def brute_nearest(points, sites):
    def km(a, b):
        la, lo, lb, lp = map(math.radians, (*a, *b))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
        return 2 * geo.EARTH_KM * math.asin(min(1.0, math.sqrt(h)))

    return {p: min((round(km(c, s), 6), i) for i, s in sites.items()) for p, c in points.items()}


@pytest.mark.parametrize("seed, spread", [(1, "globe"), (2, "city"), (3, "edge")])
def test_nearest_site_against_brute_force(spark, seed, spread):
    draw = random.Random(seed)
    if spread == "globe":
        place = lambda: (round(draw.uniform(-90, 90), 3), round(draw.uniform(-180, 180), 3))
    elif spread == "city":
        place = lambda: (round(-23.5 + draw.gauss(0, 0.01), 4), round(-46.6 + draw.gauss(0, 0.01), 4)) if draw.random() < 0.8 else (round(draw.uniform(-33, 5), 2), round(draw.uniform(-74, -35), 2))
    else:
        place = lambda: (draw.choice([-90.0, 90.0, 0.0, 89.999, -45.0]), draw.choice([-180.0, 180.0, 179.999, 0.0, 90.0]))
    sites = {i: place() for i in range(60)}
    points = {i: place() for i in range(300)} | {300: sites[5], 301: sites[5]}
    as_df = lambda rows, name: spark.createDataFrame([(i, *c) for i, c in rows.items()], f"{name} int, latitude double, longitude double")
    lost = spark.createDataFrame([(999, None, 1.0)], "ponto_id int, latitude double, longitude double")
    got = geo.nearest_site(as_df(points, "ponto_id").union(lost), as_df(sites, "local_id")).collect()
    assert len(got) == len(points) + 1
    want = brute_nearest(points, sites)
    for r in got:
        if r.ponto_id == 999:
            assert r.local_id is None
        else:
            assert abs(r.distancia_km - want[r.ponto_id][0]) < 1e-3
            if spread == "city":
                assert r.local_id == want[r.ponto_id][1]


def test_crowded_sites_do_not_meet_every_point(spark):
    draw = random.Random(4)
    points = [(i, draw.uniform(-25, -21), draw.uniform(-49, -45)) for i in range(500)]
    sites = [(i, -23.5 + draw.uniform(0, 0.1), -46.6 + draw.uniform(0, 0.1)) for i in range(500)]
    as_df = lambda rows, name: spark.createDataFrame(rows, f"{name} int, latitude double, longitude double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = geo.nearest_site(as_df(points, "ponto_id"), as_df(sites, "local_id"))
        got = {r.ponto_id: (round(r.distancia_km, 6), r.local_id) for r in found.collect()}
        plan, made, todo = found._jdf.queryExecution().executedPlan(), [], []
        todo.append(plan)
        while todo:
            node = todo.pop()
            if "Join" in node.nodeName():
                made.append(node.metrics().get("numOutputRows").get().value())
            inner = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
            todo += inner + [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == brute_nearest({i: (a, b) for i, a, b in points}, {i: (a, b) for i, a, b in sites})
    assert made and max(made) < 500 * 500 / 5


def test_star_keeps_facts_without_keys(spark):
    df = spark.createDataFrame([("1", "SP", "2020", "v", "u", "a", 1.0), (None, None, "2020", "v", "u", "a", 2.0), ("1", "SP", None, None, "u", "a", 4.0)],
        "localidade_id string, localidade_nome string, periodo string, variavel string, unidade string, agregado_id string, valor double")
    dimensions = gold.star_dimensions(df)
    joined = gold.star_join(gold.star_fact(df), dimensions)
    assert joined.count() == 3 and joined.agg(F.sum("valor")).first()[0] == 7.0
    assert gold.shared_keys(dimensions) == []
