"""The registered queries: each runs one operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registered import fixtures as fx
from registered.fixtures import AS_OF_YEAR, WINDOW_YEARS
from tulha.functions import html
from tulha.functions.names import slug, spaced
from tulha.functions.values import observation_value, period_year
from tulha.operators import analyses, catalogue, contracts, geo, gold, observations as obs, quality, quarantine, silver
from tulha.plans import incremental, ingest
from tulha.plans.ingest import ingest_file, ingest_responses, register_dataset_views
from tulha.session import fresh_database, fresh_path
from tulha.sinks import evolve, layout
from tulha.sources import delimited, portal, responses, stations, tables, utf16
from tulha.sources.mixed import read_mixed_headers
from tulha.streaming import hourly

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def to_double(*columns: str) -> dict:
    return {c: F.col(c).cast("double") for c in columns}


# Analyses


@query
def top_locations(spark, sf):
    return analyses.top_locations(fx.observations(spark, sf)).withColumn("media_valor", F.round("media_valor", 4))


@query
def location_mean(spark, sf):
    return analyses.location_mean(fx.observations(spark, sf)).withColumn("media_valor", F.round("media_valor", 4))


@query
def period_total(spark, sf):
    return analyses.period_total(fx.observations(spark, sf)).withColumn("total_valor", F.round("total_valor", 2))


@query
def period_window(spark, sf):
    rows = analyses.period_window(fx.observations(spark, sf), WINDOW_YEARS, AS_OF_YEAR)
    return rows.select("o_orderkey", "localidade_id", "variavel", "periodo", "ano", "valor")


@query
def period_window_pruned(spark, sf):
    """The same window over observations laid out by dataset and year: only its years are read."""
    name = f"{fresh_database(spark, 'estatistica')}.observacoes"
    rows = fx.observations(spark, sf).withColumn("ano", period_year(F.col("periodo")))
    layout.write_layer_table(rows, name, "bronze", ["agregado_id", "ano"])
    window = analyses.year_window(spark.table(name), WINDOW_YEARS, AS_OF_YEAR)
    return window.select("o_orderkey", "localidade_id", "variavel", "periodo", "ano", "valor")


@query
def annual_cost(spark, sf):
    totals = ["total_custo_variavel_ha", "total_custo_fixo_ha", "total_custo_ha"]
    return analyses.annual_cost(fx.costs(spark, sf)).withColumns(to_double(*totals))


# Text and values


@query
def slug_text(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", slug(F.col("text")).alias("slug"), spaced(F.col("text")).alias("normalizado")
    )


@query
def parse_observation_value(spark, sf):
    rows = fx.table(spark, sf, "orders").select("o_orderkey", fx.published_value().alias("publicado"))
    return rows.withColumn("valor", observation_value(F.col("publicado")))


@query
def catalog_topics(spark, sf):
    documents = responses.parse_body(fx.catalogue_documents(spark, sf), responses.CATALOGUE_SCHEMA)
    return catalogue.catalog_topics(documents)


# Nested documents


@query
def flatten_observations(spark, sf):
    """Responses landed as text lines, read back, parsed and flattened."""
    path = fresh_path(spark, "responses")
    landed = fx.nested_responses(spark, sf).select(
        F.to_json(F.struct("agregado_id", F.col("parsed").alias("dados"))).alias("value")
    )
    landed.write.text(path)
    body = responses.parse_body(
        responses.read_landed_text(spark, path), f"struct<agregado_id:string, dados:{responses.DATA_SCHEMA}>"
    )
    flat = obs.flatten_observations(body.select("parsed.agregado_id", F.col("parsed.dados").alias("parsed")))
    entries = F.transform("dimensoes", lambda d: F.concat_ws("=", d["rotulo"], d["id"], d["nome"]))
    return flat.withColumn("dimensoes", F.array_join(entries, ";"))


@query
def dimension_columns(spark, sf):
    """Observations flattened into a table once; labels and wide columns both come from it."""
    path = fresh_path(spark, "observacoes")
    obs.flatten_observations(fx.nested_responses(spark, sf)).write.parquet(path)
    flat = spark.read.parquet(path)
    return obs.dimension_columns(flat, obs.dimension_labels(flat))


@query
def preferred_level(spark, sf):
    documents = responses.parse_body(fx.metadata_documents(spark, sf), responses.METADATA_SCHEMA)
    return catalogue.request_specs(documents).select("agregado_id", "nivel", "motivo")


@query
def request_specs(spark, sf):
    documents = responses.parse_body(fx.metadata_documents(spark, sf), responses.METADATA_SCHEMA)
    documents = responses.parse_body(documents, responses.PERIODS_SCHEMA, "period_body", "periodos")
    specs = catalogue.request_specs(documents, keep=["periodos"])
    wanted = catalogue.requests_by_period(specs, "periodos", WINDOW_YEARS, AS_OF_YEAR)
    return wanted.select("agregado_id", "periodo", "variaveis", "nivel", "localidades", "classificacao", "caminho")


@query
def page_link_catalog(spark, sf):
    pages = fx.table(spark, sf, "pages")
    links = portal.page_links(pages, heading_tag="title", path_marker="/", keep=("page_id",))
    return links.select("page_id", F.col("position").cast("bigint").alias("position"), "categoria", "tabela", "nome_original", "url", "extensao")


@query
def quarantine_split(spark, sf):
    """Response bodies, some of them broken, counted by variable and reason."""
    k = F.col("o_orderkey")
    good = F.to_json("parsed")
    body = (
        F.when(k % 23 == 0, F.lit(None).cast("string"))
        .when(k % 23 == 1, "")
        .when(k % 23 == 2, "[]")
        .when(k % 23 == 3, '{"erro": "500"}')
        .when(k % 23 == 4, F.concat(F.lit("<html>"), k.cast("string")))
        .otherwise(good)
    )
    landed = fx.land_responses(spark, sf, F.col("agregado_id"), body)
    path = fresh_path(spark, "marcadas")
    quarantine.mark_blocks(landed).write.parquet(path)
    marked = spark.read.parquet(path)
    good_rows, rejects = quarantine.split_marked(marked)
    flat = obs.flatten_observations(good_rows)
    kept = flat.groupBy("variavel").agg(F.count(F.lit(1)).alias("n_linhas")).withColumn("motivo", F.lit(None).cast("string"))
    lost = quarantine.summary(rejects.withColumn("variavel", F.lit("rejeitada")), "variavel")
    return kept.unionByName(lost)


@query
def quarantine_blocks(spark, sf):
    """Responses whose blocks are broken in several ways: the good blocks are loaded, each bad one is rejected by itself."""
    k = F.col("o_orderkey")
    good = lambda name: F.to_json(F.struct(F.lit(name).alias("variavel"), F.lit("u").alias("unidade"), F.array(F.struct(F.array(F.struct(
        F.struct(k.cast("string").alias("id"), F.lit("x").alias("nome")).alias("localidade"), F.create_map(F.lit("2020"), k.cast("string")).alias("serie"))).alias("series"))).alias("resultados")))
    text = F.lit('{"variavel":"t","resultados":[{"series":"erro"}]}')
    listed = F.lit('{"variavel":"l","resultados":[{"series":[{"localidade":{"id":"1"},"serie":["1"]}]}]}')
    absent = F.lit('{"variavel":"a"}')
    body = (
        F.when(k % 7 == 0, F.concat(F.lit("["), good("A"), F.lit(","), text, F.lit(","), good("B"), F.lit("]")))
        .when(k % 7 == 1, F.concat(F.lit("["), listed, F.lit(","), good("A"), F.lit("]")))
        .when(k % 7 == 2, F.concat(F.lit("["), absent, F.lit(","), good("A"), F.lit("]")))
        .when(k % 7 == 3, F.concat(F.lit("["), good("A"), F.lit(",{")))
        .when(k % 7 == 4, "[]")
        .otherwise(F.concat(F.lit("["), good("A"), F.lit(","), good("B"), F.lit("]")))
    )
    db = fresh_database(spark, "estatistica")
    landed = fx.land_responses(spark, sf, F.lit("pedidos"), body)
    ingest_responses(spark, landed, f"{db}.observacoes", "c1", "2024-01-01 06:00:00", f"{db}.rejeitadas")
    loaded = spark.table(f"{db}.observacoes").groupBy("variavel").agg(F.count(F.lit(1)).alias("n"), F.sum("valor").alias("total"))
    rejected = spark.table(f"{db}.rejeitadas").groupBy(F.concat_ws(" ", "motivo", "bloco").alias("variavel")).agg(F.count(F.lit(1)).alias("n"))
    return loaded.unionByName(rejected.withColumn("total", F.lit(None).cast("double")))


@query
def decode_references(spark, sf):
    """Named, decimal and hexadecimal character references, some doubly written, some unknown."""
    code = F.col("p_partkey") % 1000 + 128512
    text = F.concat(
        F.lit("PRODU&Ccedil;&Atilde;O &amp;lt; "), F.format_string("&#%d;", code), F.format_string("&#x%X;", code),
        F.lit("&#X41;&ordm;&semnome;&#1114112; & "), F.col("p_name"),
    )
    return fx.table(spark, sf, "part").select("p_partkey", html.decode_references(text).alias("texto"))


# Scans


@query
def scan_mixed_headers(spark, sf):
    """Files of one folder whose headers are reordered, longer and shorter; ragged lines and unreadable decimals are rejected."""
    path, k = fresh_path(spark, "misto"), F.col("p_partkey")
    price = F.when(k % 19 == 0, "1.234,56").when(k % 23 == 0, "N/A").otherwise(F.translate(fx.money("p_retailprice"), ".", ","))
    name = F.when(k % 5 == 0, F.concat(F.lit('"'), F.col("p_name"), F.lit('; ""nº"" 1"'))).otherwise(F.col("p_name"))
    cells = {"Código": k.cast("string"), "Descrição": name, "Preço (R$)": price, "Marca": F.col("p_brand")}
    ragged = F.when(k % 17 == 0, ";a mais").otherwise("")
    for turn, header in enumerate((["Código", "Descrição", "Preço (R$)"], ["Preço (R$)", "Código", "Marca", "Descrição"], ["Descrição", "Código"])):
        lines = fx.table(spark, sf, "part").where(k % 3 == turn).select(F.concat(F.concat_ws(";", *[cells[c] for c in header]), ragged).alias(";".join(header)))
        lines.write.mode("append").option("header", True).option("sep", "\x01").option("quote", "\x02").option("encoding", "ISO-8859-1").csv(path)
    good, rejects = read_mixed_headers(spark, path, decimals=["preco_r"])
    loaded = good.select("codigo", "descricao", "preco_r", "marca", F.lit(None).cast("string").alias("motivo"), F.col("_source_file").startswith("part-").alias("com_arquivo"))
    lost = rejects.select(
        F.regexp_extract("line", "(?:^|;)([0-9]+)(?:;|$)", 1).alias("codigo"), F.lit(None).cast("string").alias("descricao"), F.lit(None).cast("double").alias("preco_r"),
        F.lit(None).cast("string").alias("marca"), F.col("_motivo").alias("motivo"), F.col("_source_file").startswith("part-").alias("com_arquivo"),
    )
    return loaded.unionByName(lost)


@query
def scan_semicolon_latin1(spark, sf):
    path = fresh_path(spark, "armazens")
    rows = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("Identificação Armazém"),
        F.concat(F.lit("Armazém nº "), F.col("c_custkey").cast("string")).alias("Nome (armazém)"),
        F.col("c_mktsegment").alias("UF"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("qtd_capacidade_estatica(t)"),
        F.col("c_nationkey").alias("2º código"),
        F.col("c_nationkey").alias("Código"),
        F.col("c_nationkey").alias("CODIGO."),
    )
    rows.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    declared = T.StructType(
        [T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.DecimalType) else f.dataType) for f in rows.schema]
    )
    return delimited.read_semicolon_latin1(spark, path, schema=declared)


@query
def scan_csv(spark, sf):
    path = fresh_path(spark, "partes")
    rows = fx.table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.col("p_name"), F.lit(', "tipo" '), F.col("p_type")).alias("Descrição"),
        F.col("p_size").alias("Tamanho"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("Preço (R$)"),
    )
    rows.write.option("header", True).option("escape", '"').csv(path)
    df = delimited.read_comma_csv(spark, path, infer=True, escape='"')
    return df.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query
def parse_decimal_comma(spark, sf):
    """Line items as `;` Latin-1 text with decimal commas and NA tokens, read back as numbers."""
    path = fresh_path(spark, "precos")
    comma = lambda c: F.translate(fx.money(c), ".", ",")
    n = F.col("l_linenumber")
    fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("Pedido"),
        n.alias("Linha"),
        F.when(n == 7, " ").when(n == 6, "NaN").otherwise(comma("l_extendedprice")).alias("Preço (R$)"),
        F.when(n == 5, "N/A").otherwise(comma("l_discount")).alias("Desconto"),
        F.col("l_returnflag").alias("Situação"),
    ).write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").option(
        "ignoreTrailingWhiteSpace", False
    ).option("ignoreLeadingWhiteSpace", False).csv(path)
    df = delimited.read_decimal_comma(spark, path, ["preco_r", "desconto"])
    return df.withColumns({"pedido": F.col("pedido").cast("bigint"), "linha": F.col("linha").cast("int")})


@query
def scan_utf16_tab(spark, sf):
    path = fresh_path(spark, "capacidade")
    fx.table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("Ano"),
        F.col("o_orderpriority").alias("UF"),
        F.concat(F.lit("nº "), F.col("o_orderkey").cast("string")).alias("Série"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("Quantidade (mil t)"),
    ).write.option("header", True).option("sep", "\t").option("encoding", "UTF-16").csv(path)
    df = delimited.read_utf16_export(spark, path)
    return df.withColumns({"ano": F.col("ano").cast("int"), "quantidade_mil_t": F.col("quantidade_mil_t").cast("double")})


@query
def scan_utf16_split(spark, sf):
    """Line items as little endian UTF-16 exports with quoted cells, read in byte ranges."""
    path = fresh_path(spark, "exportacao")
    fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("\ufeffPedido"),
        F.col("l_linenumber").alias("Linha"),
        F.concat(F.lit("nº\t"), F.col("l_returnflag")).alias("Via"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("Preço (R$)"),
    ).write.option("header", True).option("sep", "\t").option("encoding", "UTF-16LE").option("lineSep", "\r\n").csv(path)
    df = utf16.read_utf16_split(spark, path)
    return df.withColumns({"pedido": F.col("pedido").cast("bigint"), "linha": F.col("linha").cast("int"), "preco_r": F.col("preco_r").cast("double")})


def _stations(spark, sf) -> DataFrame:
    rows = stations.read_station_files(spark, fx.land_station_files(spark, sf), fx.STATION_COLUMNS)
    return rows.withColumn("estacao", F.regexp_extract("path", "estacao=([^/]+)", 1)).drop("path")


@query
def station_files_union(spark, sf):
    return _stations(spark, sf).drop("arquivo_origem")


@query
def archive_members(spark, sf):
    members = stations.expand_archives(fx.station_archives(spark, sf))
    rows = stations.parse_station_files(members.where(F.col("path").rlike(r"(?i)\.csv$")), fx.STATION_COLUMNS)
    return rows.drop("path")


@query
def climate_daily(spark, sf):
    measures = ["precipitacao_total_mm", "temperatura_maxima_c"]
    daily = gold.climate_daily(_stations(spark, sf), measures)
    rounded = {f"{m}_media": F.round(f"{m}_media", 6) for m in measures} | {f"{m}_soma": F.round(f"{m}_soma", 2) for m in measures}
    return daily.withColumns(rounded)


@query
def climate_monthly(spark, sf):
    """Every measure of the stations by month."""
    measures = [c for c, kind in fx.STATION_COLUMNS.items() if kind == "double"]
    monthly = gold.climate_monthly(_stations(spark, sf), measures)
    return monthly.withColumns({f"{m}_media": F.round(f"{m}_media", 4) for m in measures} | {f"{m}_soma": F.round(f"{m}_soma", 2) for m in measures})


@query
def union_by_name(spark, sf):
    """Event types with different columns stacked into one frame."""
    events = fx.table(spark, sf, "events")
    kinds = {
        "click": ["event_id", "user_id", "value"],
        "error": ["event_id", "props"],
        "purchase": ["event_id", "value", "props"],
        "signup": ["event_id", "user_id"],
        "view": ["event_id", "user_id", "props"],
    }
    frames = [
        events.where(F.col("event_type") == kind).select(*columns, F.lit(f"{kind}.csv").alias("arquivo_origem"))
        for kind, columns in kinds.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Evolving tables


def _supplier(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Suppliers as two loads."""
    rows = fx.table(spark, sf, "supplier")
    even = F.col("s_suppkey") % 2 == 0
    first, second = rows.where(even), rows.where(~even)
    return first.withColumn("carga", F.lit("c1")), second.withColumn("carga", F.lit("c2"))


@query
def evolve_create_append(spark, sf):
    first, second = _supplier(spark, sf)
    name = f"{fresh_database(spark, 'cadastro')}.fornecedor"
    evolve.write_evolving(spark, first, name)
    evolve.write_evolving(spark, second, name)
    return spark.table(name)


@query
def evolve_add_column(spark, sf):
    first, second = _supplier(spark, sf)
    name = f"{fresh_database(spark, 'cadastro')}.fornecedor"
    evolve.write_evolving(spark, first, name)
    evolve.write_evolving(
        spark, second.withColumns({"2_nome": F.upper("s_name"), "saldo_mil": F.round(F.col("s_acctbal") / 1000, 3)}), name
    )
    return spark.table(name)


@query
def evolve_missing_column(spark, sf):
    first, second = _supplier(spark, sf)
    name = f"{fresh_database(spark, 'cadastro')}.fornecedor"
    evolve.write_evolving(spark, first, name)
    evolve.write_evolving(spark, second.drop("s_acctbal").select("carga", "s_nationkey", "s_name", "s_suppkey"), name)
    return spark.table(name)


@query
def evolve_type_conflict(spark, sf):
    """The second load turns a number into text: old rows stay in the backup, new rows start anew."""
    first, second = _supplier(spark, sf)
    name = f"{fresh_database(spark, 'cadastro')}.fornecedor"
    evolve.write_evolving(spark, first, name)
    report = evolve.write_evolving(spark, second.withColumn("s_acctbal", fx.money("s_acctbal")), name)
    now, old = spark.table(name), spark.table(report.backup)
    return now.withColumn("origem", F.lit("atual")).unionByName(
        old.withColumn("s_acctbal", fx.money("s_acctbal")).withColumn("origem", F.lit("backup"))
    )


@query
def ingest_landed_files(spark, sf):
    """Two landed portal files of one dataset, the second with a new column, through the whole flow."""
    rows = fx.table(spark, sf, "part")
    name = f"{fresh_database(spark, 'portal')}.custo_de_producao"
    half = F.col("p_partkey") % 2 == 0
    base = [F.col("p_partkey").cast("string").alias("Código"), F.col("p_name").alias("Descrição")]
    loads = [
        ("c1", "2024-01-01 06:00:00", rows.where(half).select(*base)),
        ("c2", "2024-01-02 06:00:00", rows.where(~half).select(*base, F.col("p_brand").alias("Marca/UF"))),
    ]
    for batch, at, load in loads:
        path = fresh_path(spark, "portal")
        load.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
        ingest_file(spark, path, "txt", name, batch, at, source_file=f"{batch}.txt")
    return spark.table(name)


@query
def ingest_listing(spark, sf):
    """A listing of landed files in three formats into three tables, then the profile of what arrived."""
    db = fresh_database(spark, "portal")
    customer, part, orders = (fx.table(spark, sf, n) for n in ("customer", "part", "orders"))
    latin, utf16 = {"sep": ";", "encoding": "ISO-8859-1"}, {"sep": "\t", "encoding": "UTF-16"}
    landed = [
        ("armazens", "txt", latin, customer.select(F.col("c_custkey").alias("Código"), F.col("c_name").alias("Nome"))),
        ("precos", "csv", {}, part.select(F.col("p_partkey").alias("Código"), F.col("p_name").alias("Descrição"), "p_retailprice")),
        ("capacidade", "xls", utf16, orders.select(F.col("o_orderkey").alias("Série"), F.col("o_totalprice").cast("decimal(18,2)").alias("Quantidade (mil t)"))),
    ]
    items = []
    for name, extension, options, rows in landed:
        path = fresh_path(spark, name)
        rows.write.options(header=True, **options).csv(path)
        items.append({"tabela": name, "path": path, "extensao": extension})
    ingest.ingest_listing(spark, items, db, "c1", "2024-01-01 06:00:00")
    return tables.table_inventory(spark, [db])


@query
def observations_by_dataset(spark, sf):
    """Observations laid out by dataset and asked through one SQL view per dataset."""
    db = fresh_database(spark, "estatistica")
    rows = fx.observations(spark, sf).withColumn(
        "dimensoes", F.array(F.struct(F.lit("Segmento").alias("rotulo"), F.lit("s").alias("id"), F.col("segmento").alias("nome")))
    )
    layout.write_layer_table(rows.select(*obs.CORE_COLUMNS, "dimensoes"), f"{db}.observacoes", "bronze", ["agregado_id"])
    views = {dataset: f"{db}_{dataset}" for dataset in fx.STATUS.values()}
    register_dataset_views(spark, f"{db}.observacoes", views)
    per_view = "SELECT agregado_id, segmento, count(*) AS n, round(sum(valor), 2) AS total FROM {} GROUP BY ALL"
    return spark.sql(" UNION ALL ".join(per_view.format(view) for view in views.values()))


@query
def ingest_landed_responses(spark, sf):
    """Landed responses, some unusable, through the whole flow: observations and rejects, counted per dataset."""
    db = fresh_database(spark, "estatistica")
    k = F.col("o_orderkey")
    body = F.when(k % 23 == 4, F.lit("<html>")).when(k % 23 == 2, F.lit("[]")).otherwise(F.to_json("parsed"))
    landed = fx.land_responses(spark, sf, F.concat(F.lit("pedidos_"), (k % 10).cast("string")), body)
    ingest_responses(spark, landed, f"{db}.observacoes", "c1", "2024-01-01 06:00:00", f"{db}.rejeitadas")
    loaded, rejected = spark.table(f"{db}.observacoes"), spark.table(f"{db}.rejeitadas")
    good = loaded.groupBy("agregado_id", F.lit(None).cast("string").alias("motivo")).agg(
        F.count(F.lit(1)).alias("n_linhas"), F.round(F.sum("valor"), 2).alias("total_valor")
    )
    bad = rejected.groupBy("agregado_id", "motivo").agg(
        F.count(F.lit(1)).alias("n_linhas"), F.lit(None).cast("double").alias("total_valor")
    )
    return good.unionByName(bad)


@query
def ingest_incremental(spark, sf):
    """Orders landed as four files, two before each of two runs, and a third run that finds nothing new."""
    db, folder, checkpoint = fresh_database(spark, "portal"), fresh_path(spark, "pedidos"), fresh_path(spark, "checkpoint")
    k = F.col("o_orderkey")
    orders = fx.table(spark, sf, "orders").select(k.alias("Código"), F.col("o_custkey").alias("Cliente"), fx.money("o_totalprice").alias("Preço (R$)"), "o_orderstatus")
    seen = []
    for run in range(3):
        for part in (2 * run, 2 * run + 1) if run < 2 else ():
            rows = orders.where(F.col("Código") % 4 == part)
            # The second run's files bring a new column, and lines of one cell too many.
            rows = rows if run else rows.drop("o_orderstatus")
            extra = F.when((F.col("Código") % 101 == 0) & F.lit(bool(run)), ";a mais").otherwise("")
            rows.select(F.concat(F.concat_ws(";", *rows.columns), extra).alias(";".join(rows.columns))).write.options(header=True, sep="\x01", quote="\x02", encoding="ISO-8859-1").csv(f"{folder}/{part}")
        seen.append(incremental.ingest_incremental(spark, folder, "txt", f"{db}.pedidos", checkpoint, f"2024-01-0{run + 1} 06:00:00", glob="*.csv"))
    ledger = spark.table(f"{db}.pedidos_arquivos").groupBy("_lote").agg(F.sum("n_linhas").alias("n_linhas"), F.sum("n_rejeitadas").alias("n_rejeitadas"))
    rows = spark.table(f"{db}.pedidos").select("codigo", "cliente", "preco_r", "o_orderstatus", "_lote", "_ingest_ts")
    return rows.join(ledger, "_lote").withColumn("corridas", F.lit(",".join("novos" if n else "nada" for n in seen)))


@query
def reconciled_responses(spark, sf):
    """Responses landed in two runs, some broken, some with repeated keys: blocks expected, loaded and rejected per file."""
    db, folder, checkpoint = fresh_database(spark, "estatistica"), fresh_path(spark, "respostas"), fresh_path(spark, "checkpoint")
    k = F.col("o_orderkey")
    good = F.to_json(F.struct(F.lit("A").alias("variavel"), F.array(F.struct(F.array(F.struct(
        F.struct(k.cast("string").alias("id"), F.lit("x").alias("nome")).alias("localidade"), F.create_map(F.lit("2020"), k.cast("string")).alias("serie"))).alias("series"))).alias("resultados")))
    twice = F.concat(F.lit('{"variavel":"Z","unidade":"u",'), F.substr(good, F.lit(2)))
    body = (
        F.when(k % 7 == 0, F.concat(F.lit("["), good, F.lit(',{"variavel":"t","resultados":[{"series":"erro"}]},'), twice, F.lit("]")))
        .when(k % 7 == 1, F.concat(F.lit("["), twice, F.lit("]")))
        .when(k % 7 == 2, F.concat(F.lit("["), good, F.lit(",{")))
        .when(k % 7 == 3, "[]")
        .otherwise(F.concat(F.lit("["), good, F.lit(","), good, F.lit("]")))
    )
    for run in (0, 1):
        landed = fx.table(spark, sf, "orders").where(k % 2 == run).select(F.lit("pedidos").alias("agregado_id"), body.alias("body"))
        landed.write.json(f"{folder}/{run}")
        incremental.ingest_incremental_responses(spark, folder, f"{db}.observacoes", f"{db}.rejeitadas", checkpoint, f"2024-01-0{run + 1} 06:00:00")
    counted = ["n_respostas", "n_esperados", "n_carregados", "n_rejeitados"]
    ledger = spark.table(f"{db}.observacoes_arquivos").groupBy("_lote").agg(*[F.sum(c).alias(c) for c in counted])
    values = spark.table(f"{db}.observacoes").groupBy("_lote").agg(F.count_if(F.col("variavel") == "A").alias("n_linhas"), F.sum("valor").alias("total"))
    lost = spark.table(f"{db}.rejeitadas").groupBy("_lote").agg(F.count(F.lit(1)).alias("n_na_quarentena"))
    return ledger.join(values, "_lote").join(lost, "_lote")


@query
def silver_incremental(spark, sf):
    """Three triggers of reloaded observations, typed and merged one by one into the latest row per key."""
    db = fresh_database(spark, "prata")
    k = F.col("o_orderkey")
    text = fx.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("cliente"), F.when(k % 13 == 0, "n/d").otherwise(fx.money("o_totalprice")).alias("valor"), k.cast("string").alias("pedido")
    )
    for load in range(3):
        rows = quality.with_lineage(text.where(k % 3 == load), f"lote-{load}", f"2024-01-0{load + 1} 06:00:00", F.concat(F.lit("arquivo_"), F.lpad("pedido", 12, "0")))
        evolve.write_keyed(spark, rows, f"{db}.bronze", incremental.BATCH, load)
        merged = incremental.ingest_silver_incremental(spark, f"{db}.bronze", f"{db}.clientes", {"valor": "double", "pedido": "bigint"}, ["cliente"], buckets=16)
        if merged != [load] or incremental.ingest_silver_incremental(spark, f"{db}.bronze", f"{db}.clientes", {"valor": "double", "pedido": "bigint"}, ["cliente"], buckets=16):
            raise RuntimeError(f"run {load} merged {merged}")
    rejected = spark.table(f"{db}.clientes_rejeitadas").count()
    return spark.table(f"{db}.clientes").select("cliente", "pedido", "valor", F.col("_batch_id").alias("lote")).withColumn("n_rejeitadas", F.lit(rejected).cast("long"))


@query
def compact_small_only(spark, sf):
    """Customers by segment; two segments get further small loads, and only their files are packed."""
    name = f"{fresh_database(spark, 'cadastro')}.clientes"
    rows, k = fx.table(spark, sf, "customer"), F.col("c_custkey")
    grown = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    for load in range(3):
        evolve.write_evolving(spark, rows.where(k % 3 == load if load else (k % 3 == 0) | ~grown).where(grown | F.lit(load == 0)), name, partition_by=["c_mktsegment"])
    report = layout.compact_small_files(spark, name)
    counts = spark.table(name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_linhas"), F.sum("c_custkey").alias("soma"))
    return counts.join(report.withColumn("c_mktsegment", F.regexp_extract("pasta", "=(.*)$", 1)), "c_mktsegment").drop("pasta")


@query
def compact_table(spark, sf):
    """A table grown by many small appends, rewritten into few files."""
    name = f"{fresh_database(spark, 'cadastro')}.clientes"
    rows = fx.table(spark, sf, "customer")
    many = rows.repartition(16, "c_custkey")
    evolve.write_evolving(spark, many, name, partition_by=["c_mktsegment"])
    layout.compact_table(spark, name)
    return spark.table(name)


@query
def compact_twice(spark, sf):
    """A partitioned gold table compacted twice in a row: rows, layout, format and codec stay."""
    name = f"{fresh_database(spark, 'cadastro')}.clientes"
    layout.write_layer_table(fx.table(spark, sf, "customer").repartition(16, "c_custkey"), name, "gold", ["c_mktsegment"])
    for _ in range(2):
        layout.compact_table(spark, name)
    using, partition_by, options = layout.table_layout(spark, name)
    kept = f"{using} {','.join(partition_by)} {options.get('compression')}"
    return spark.table(name).withColumn("layout", F.lit(kept))


@query
def reference_refresh(spark, sf):
    """Reference rows replaced as a whole by the second load."""
    name = f"{fresh_database(spark, 'metadados')}.partes"
    rows = fx.table(spark, sf, "part")
    evolve.replace_table(rows.select("p_partkey", "p_name"), name)
    evolve.replace_table(rows.select("p_partkey", F.upper("p_name").alias("nome"), "p_size"), name)
    return spark.table(name)


@query
def table_inventory(spark, sf):
    db = fresh_database(spark, "cadastro")
    loads = {"fornecedor": ("supplier", "2024-01-02 03:00:00"), "cliente": ("customer", "2024-01-03 03:00:00"), "pedido": ("orders", "2024-01-04 03:00:00")}
    for name, (source, at) in loads.items():
        rows = fx.table(spark, sf, source)
        if source == "orders":
            rows = rows.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")))
        evolve.write_evolving(spark, quality.with_lineage(rows, "c1", at, f"{source}.parquet"), f"{db}.{name}")
    return tables.table_inventory(spark, [db])


@query
def ingest_ghost_table(spark, sf):
    """A table whose files went away is recreated, with its partitions, by the next load that allows it."""
    name = f"{fresh_database(spark, 'cadastro')}.clientes"
    rows = fx.table(spark, sf, "customer")
    evolve.write_evolving(spark, rows.limit(10), name, partition_by=["c_mktsegment"])
    ingest.drop_folder(spark, next(r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {evolve.quoted(name)}").collect() if r.col_name == "Location"))
    report = evolve.recover_ghost_table(spark, rows, name, allow_drop=True)
    parts = ",".join(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    return spark.table(name).withColumn("caminho", F.lit(f"{report.path} {parts}"))


# Silver and gold


@query
def silver_flow(spark, sf):
    """Bronze text to a typed silver table with one row per key, its rejects, and the lineage table."""
    db = fresh_database(spark, "prata")
    k = F.col("o_orderkey")
    text = fx.table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("cliente"),
        F.when(k % 13 == 0, "n/d").otherwise(fx.money("o_totalprice")).alias("valor"),
        k.cast("string").alias("pedido"),
    )
    for n in (0, 1):
        rows = text.where(F.col("pedido").cast("bigint") % 2 == n)
        evolve.write_evolving(spark, quality.with_lineage(rows, f"c{n}", f"2024-01-0{n + 1} 06:00:00", f"carga{n}.csv"), f"{db}.pedidos_bronze")
    counts = ingest.ingest_silver(spark, f"{db}.pedidos_bronze", f"{db}.pedidos", {"valor": "double", "pedido": "bigint"}, ["pedido"], f"{db}.linhagem")
    silver_rows, rejected, lineage_table = (spark.table(f"{db}.{n}") for n in ("pedidos", "pedidos_rejeitadas", "linhagem"))
    parts = [
        silver_rows.groupBy(F.col("_source_file").alias("chave")).agg(F.count(F.lit(1)).alias("n")).withColumn("parte", F.lit("prata")),
        rejected.groupBy(F.array_join("_rejeitadas", ",").alias("chave")).agg(F.count(F.lit(1)).alias("n")).withColumn("parte", F.lit("rejeitadas")),
        lineage_table.select(F.concat_ws(" ", "camada", "_source_file", "_batch_id").alias("chave"), F.col("n_linhas").alias("n"), F.lit("linhagem").alias("parte")),
        spark.createDataFrame([(c, n) for c, n in counts.items()], "chave string, n bigint").withColumn("parte", F.lit("observado")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def silver_typed(spark, sf):
    k = F.col("o_orderkey")
    text = fx.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 13 == 0, "n/d").otherwise(fx.money("o_totalprice")).alias("valor"),
        F.when(k % 29 == 0, "jan").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("data"),
        F.when(k % 31 != 0, F.date_format("o_orderdate", "yyyy")).alias("ano"),
    )
    typed = silver.typed(text, {"valor": "double", "data": "date", "ano": "int"})
    return typed.select(
        "o_orderkey", "valor", F.col("data").cast("string").alias("data"), "ano", F.array_join("_rejeitadas", ",").alias("rejeitadas")
    )


OBSERVATION_KEY = ["agregado_id", "variavel", "localidade_id", "periodo", "segmento"]


def _bronze(spark, sf) -> DataFrame:
    """Observations with lineage: orders of one key are reloads of one observation."""
    rows = fx.observations(spark, sf)
    source = F.concat(F.lit("arquivo_"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    return quality.with_lineage(rows, "c1", F.col("o_orderdate"), source)


@query
def silver_dedup(spark, sf):
    latest = silver.latest_by_key(_bronze(spark, sf), OBSERVATION_KEY)
    return latest.select(*OBSERVATION_KEY, "valor", F.col("_source_file").alias("arquivo"))


@query
def gold_state_year(spark, sf):
    totals = gold.state_year(fx.observations(spark, sf), "1-URGENT", "2-HIGH")
    return totals.withColumns(
        {"producao": F.round("producao", 2), "area": F.round("area", 2), "rendimento": F.round("rendimento", 6)}
    )


@query
def gold_partitioned(spark, sf):
    """Gold totals laid out by year with the gold codec; the year filter prunes folders."""
    path = fresh_path(spark, "ouro")
    layout.write_layer(gold_state_year(spark, sf), path, "gold", ["ano"])
    return spark.read.parquet(path).where(F.col("ano") >= 1998)


def _star(spark, rows: DataFrame) -> DataFrame:
    """Facts by dimension attributes. The observations are staged, so facts and dimensions read them and not their joins."""
    path = fresh_path(spark, "fatos")
    rows.select("agregado_id", "variavel", "unidade", "localidade_id", "localidade_nome", "periodo", "valor").write.parquet(path)
    staged = spark.read.parquet(path)
    dimensions = gold.star_dimensions(staged)
    if clashing := gold.shared_keys(dimensions):
        raise RuntimeError(f"surrogate keys clash in {clashing}")
    return gold.star_join(gold.star_fact(staged), dimensions).groupBy("localidade_nome", "ano", "variavel", "unidade", "agregado_id").agg(
        F.count(F.lit(1)).alias("n_fatos"), F.round(F.sum("valor"), 2).alias("total_valor")
    )


@query
def clustered_layout(spark, sf):
    """Observations clustered by year, state, month and product at once; a filter on the product alone reads them back."""
    name = f"{fresh_database(spark, 'prata')}.observacoes"
    rows = fx.observations(spark, sf).withColumns({"ano": period_year(F.col("periodo")), "mes": F.month("o_orderdate")})
    layout.write_clustered(rows, name, ["ano", "localidade_nome", "mes", "variavel"], files=16)
    return spark.table(name).where(F.col("variavel") == "2-HIGH").select("o_orderkey", "ano", "mes", "localidade_nome", "variavel", "valor")


@query
def layer_codecs(spark, sf):
    """Rows per layer and the codec that the layer's files are written with."""
    path = fresh_path(spark, "camadas")
    for layer in layout.CODEC:
        layout.write_layer(fx.table(spark, sf, "supplier"), f"{path}/{layer}", layer)
    rows = [spark.read.parquet(f"{path}/{n}").select(F.lit(n).alias("camada"), F.regexp_extract("_metadata.file_name", r"([a-z]+)\.parquet$", 1).alias("codec")) for n in layout.CODEC]
    return reduce(DataFrame.unionByName, rows).groupBy("camada", "codec").agg(F.count(F.lit(1)).alias("n_linhas"))


@query
def star_fact(spark, sf):
    return _star(spark, fx.observations(spark, sf))


@query
def star_fact_unknown(spark, sf):
    """Facts without location, period or variable stay: each dimension has an unknown member."""
    k = F.col("o_orderkey")
    rows = fx.observations(spark, sf)
    gaps = {"localidade_id": k % 3 == 0, "localidade_nome": k % 3 == 0, "periodo": k % 5 == 0, "variavel": k % 7 == 0}
    return _star(spark, rows.withColumns({c: F.when(~missing, F.col(c)) for c, missing in gaps.items()}))


@query
def orphan_facts(spark, sf):
    """Facts whose location is missing from a dimension that lacks one region."""
    rows = fx.observations(spark, sf)
    nation, region = fx.table(spark, sf, "nation"), fx.table(spark, sf, "region")
    known = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).where("r_name <> 'ASIA'")
    dimension = known.select(F.col("n_nationkey").cast("string").alias("localidade_id")).select(
        gold.surrogate_key("localidade_id").alias("sk_localidade")
    )
    facts = rows.select("o_orderkey", "localidade_id", "periodo", "valor", gold.surrogate_key("localidade_id").alias("sk_localidade"))
    return gold.orphan_facts(facts, dimension, "sk_localidade").drop("sk_localidade")


@query
def feature_lags(spark, sf):
    """Monthly features joined with a monthly climate value per location."""
    rows = fx.observations(spark, sf)
    climate = (
        fx.table(spark, sf, "lineitem")
        .join(fx.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("s_nationkey").cast("string").alias("localidade_id"), F.date_format("l_shipdate", "yyyyMM").alias("periodo"))
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("chuva_mm"))
    )
    features = gold.feature_lags(rows, climate)
    return features.withColumns(
        {"valor_mes": F.round("valor_mes", 2), "mes_anterior": F.round("mes_anterior", 2), "ano_anterior": F.round("ano_anterior", 2), "media_3_meses": F.round("media_3_meses", 4)}
    )


@query
def pseudonymised(spark, sf):
    rows = fx.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return silver.pseudonymised(rows, ["c_name"], fx.PSEUDONYM_SALT)


@query
def nearest_site(spark, sf):
    points = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("ponto_id"), *fx.coordinates("c_custkey", 7919, 104729))
    sites = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("local_id"), *fx.coordinates("s_suppkey", 3571, 6133))
    return geo.nearest_site(points, sites).withColumn("distancia_km", F.round("distancia_km", 3))


@query
def nearest_site_crowded(spark, sf):
    """Sparse points around a town that holds all sites."""
    near = lambda a: (F.col("s_suppkey") * a % 1000) / 10000.0
    points = fx.table(spark, sf, "customer").select(F.col("c_custkey").alias("ponto_id"), *fx.coordinates("c_custkey", 7919, 104729))
    sites = fx.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("local_id"), (near(7919) - 23.5).alias("latitude"), (near(613) - 46.6).alias("longitude"))
    return geo.nearest_site(points, sites).withColumn("distancia_km", F.round("distancia_km", 3))


# Quality


@query
def completeness(spark, sf):
    """Orders per month as expected rows against shipped lines per month as loaded rows."""
    month = lambda c: F.date_format(c, "yyyyMM").alias("periodo")
    expected = fx.table(spark, sf, "orders").select(month("o_orderdate"))
    loaded = fx.table(spark, sf, "lineitem").select(month("l_shipdate"))
    return quality.completeness(expected, loaded, ["periodo"])


@query
def missing_items(spark, sf):
    expected = fx.table(spark, sf, "part").select("p_partkey", "p_brand")
    loaded = fx.table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return quality.missing_items(expected, loaded, "p_partkey")


@query
def missing_items_gaps(spark, sf):
    """Customers without an order in 1997."""
    expected = fx.table(spark, sf, "customer").select("c_custkey", "c_name")
    loaded = fx.table(spark, sf, "orders").where(F.year("o_orderdate") == 1997).select(F.col("o_custkey").alias("c_custkey"))
    return quality.missing_items(expected, loaded, "c_custkey")


@query
def load_kpis(spark, sf):
    log = fx.table(spark, sf, "events").withColumn("dia", F.date_format("ts", "yyyy-MM-dd"))
    as_of = F.lit("2024-02-01 06:00:00").cast("timestamp_ntz")
    return quality.load_kpis(log, F.col("event_type") == "error", "ts", ["dia"], as_of)


@query
def quality_report(spark, sf):
    rows = fx.observations(spark, sf)
    checks = {
        "valor_presente": ("completude", "valor", F.col("valor").isNotNull()),
        "periodo_valido": ("validade", "periodo", F.col("periodo").rlike("^[0-9]{4}(0[1-9]|1[0-2])?$")),
        "periodo_mensal": ("validade", "periodo", F.length("periodo") == 6),
        "valor_plausivel": ("validade", "valor", F.col("valor").between(1000, 400000)),
        "ano_do_pedido": ("consistencia", "periodo", F.substring("periodo", 1, 4) == F.date_format("o_orderdate", "yyyy")),
    }
    return quality.quality_report(rows, checks)


@query
def contract_violations(spark, sf):
    k = F.col("o_orderkey")
    landed = fx.table(spark, sf, "orders").select(
        k.cast("string").alias("pedido"),
        F.when(k % 13 == 0, "n/d").otherwise(fx.money("o_totalprice")).alias("valor"),
        F.when(k % 11 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("data"),
    )
    contract = T.StructType(
        [
            T.StructField("pedido", T.LongType(), False),
            T.StructField("valor", T.DoubleType(), True),
            T.StructField("data", T.DateType(), False),
            T.StructField("uf", T.StringType(), False),
        ]
    )
    return quality.contract_violations(landed, contract)


@query
def contract_resolution(spark, sf):
    """Landed orders, written under one Avro schema, read under another: rows as the reader wants them, and the verdict on each column."""
    k = F.col("o_orderkey")
    landed = fx.table(spark, sf, "orders").select(
        k.cast("int").alias("pedido"), F.when(k % 7 > 0, F.col("o_custkey").cast("int")).alias("cod_cliente"), F.col("o_totalprice").alias("valor"), F.col("o_orderstatus").alias("situacao"), F.col("o_orderpriority").alias("prioridade")
    )
    writer = """{"type": "record", "name": "pedido", "fields": [
        {"name": "pedido", "type": "int"}, {"name": "cod_cliente", "type": ["null", "int"]}, {"name": "valor", "type": "double"},
        {"name": "situacao", "type": "string"}, {"name": "prioridade", "type": "string"}]}"""
    reader = """{"type": "record", "name": "pedido", "fields": [
        {"name": "pedido", "type": "long"}, {"name": "cliente", "aliases": ["cod_cliente"], "type": ["null", "double"], "default": null},
        {"name": "valor", "type": "float"}, {"name": "situacao", "type": "string"}, {"name": "moeda", "type": "string", "default": "BRL"}, {"name": "uf", "type": "string"}]}"""
    verdicts = contracts.resolve(writer, reader)
    rows = contracts.read_as(landed, verdicts)
    told = ",".join(f"{v.column}={v.verdict}" for v in verdicts)
    return rows.withColumn("pareceres", F.lit(told))


@query
def series_anomalies(spark, sf):
    months = gold.monthly_totals(fx.observations(spark, sf))
    found = quality.series_anomalies(months, ["variavel", "localidade_id"], "periodo", "valor_mes")
    return found.withColumns({"valor_mes": F.round("valor_mes", 2), "z": F.round("z", 4)})


@query
def series_fences(spark, sf):
    """Months beyond their series' interquartile fences; the sketches are merged from those of each year."""
    months = gold.monthly_totals(fx.observations(spark, sf))
    series = ["variavel", "localidade_id"]
    path = fresh_path(spark, "meses")
    months.write.parquet(path)
    points = spark.read.parquet(path)
    yearly = quality.series_sketches(points.withColumn("ano", F.floor(F.col("mes_indice") / 12)), [*series, "ano"], "valor_mes")
    found = quality.outside_fences(points, quality.fences(quality.merged_sketches(yearly, series)), series, "periodo", "valor_mes")
    return found.withColumns({c: F.round(c, 4) for c in ("valor_mes", "q1", "q3", "cerca_inferior", "cerca_superior")})


@query
def lineage_closure(spark, sf):
    """From landed files through raw, bronze and silver to gold: every node that each gold table comes from."""
    path = fresh_path(spark, "eventos")
    day, kind = F.date_format("ts", "yyyyMMdd"), F.col("event_type")
    fx.table(spark, sf, "events").select("user_id", "ts", "event_id", kind, day.alias("dia"), F.date_format("ts", "yyyyMM'-'dd").substr(1, 8).alias("lote")).write.parquet(path)
    bronze = spark.read.parquet(path)
    latest = silver.latest_by_key(bronze, ["user_id", "event_type"], ["ts", "event_id"])
    file, raw = F.concat("event_type", F.lit(".json")), F.concat_ws("/", "event_type", "dia")
    parts = [
        quality.lineage_edges(bronze, "fonte", file, "raw", raw),
        quality.lineage_edges(bronze, "raw", raw, "bronze", F.col("lote")),
        quality.lineage_edges(latest, "bronze", F.col("lote"), "silver", F.col("event_type")),
        quality.lineage_edges(latest, "silver", F.col("event_type"), "gold", F.when(F.col("event_type") == "error", "falhas").otherwise("uso")),
    ]
    return quality.lineage_closure(reduce(DataFrame.unionByName, parts)).where(F.col("para").startswith("gold:"))


@query
def lineage(spark, sf):
    """Rows per layer, file and batch, from bronze through silver."""
    bronze = quality.with_lineage(
        fx.table(spark, sf, "events"),
        "",
        F.col("ts"),
        F.concat("event_type", F.lit(".json")),
    ).withColumn("_batch_id", F.date_format("ts", "yyyyMMdd"))
    latest = silver.latest_by_key(bronze, ["user_id", "event_type"], ["_ingest_ts", "event_id"])
    return quality.lineage_rows({"bronze": bronze, "silver": latest})


# Streams


def _event_stream(spark, sf) -> DataFrame:
    schema = fx.table(spark, sf, "events").schema
    return hourly.read_file_stream(spark, sf, schema, glob="events.parquet")


@query
def stream_hourly(spark, sf):
    out = fresh_path(spark, "stream")
    hourly.run_available(hourly.hourly_readings(_event_stream(spark, sf), "event_type", "value"), f"{out}/rows", f"{out}/checkpoint")
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("inicio", "fim")}
    return spark.read.parquet(f"{out}/rows").withColumns({**ntz, **to_double("soma")})


@query
def stream_sliding(spark, sf):
    """Hours that begin every half hour, so that each event counts in two."""
    out = fresh_path(spark, "stream")
    hourly.run_available(hourly.hourly_readings(_event_stream(spark, sf), "event_type", "value", slide="30 minutes"), f"{out}/rows", f"{out}/checkpoint")
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("inicio", "fim")}
    return spark.read.parquet(f"{out}/rows").withColumns({**ntz, **to_double("soma")})


@query
def stream_sessions(spark, sf):
    """Sessions of each user: events less than six hours apart, final by the watermark."""
    out = fresh_path(spark, "stream")
    found, _, _ = hourly.run_sessions(_event_stream(spark, sf), "user_id", "value", f"{out}/rows", f"{out}/checkpoint")
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("inicio", "fim")}
    return found.withColumns({**ntz, **to_double("soma")})


@query
def stream_dedup(spark, sf):
    """Every event delivered twice, kept once."""
    out = fresh_path(spark, "stream")
    twice = _event_stream(spark, sf).union(_event_stream(spark, sf))
    hourly.run_available(hourly.without_redeliveries(twice, "event_id"), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query
def stream_out_of_order(spark, sf):
    """Files landed newest first, with one file per trigger and with all in one: both give the batch totals."""
    landed = fresh_path(spark, "eventos")
    events = fx.table(spark, sf, "events")
    edges = events.select(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [0.25, 0.5, 0.75])).first()[0]
    place = sum((F.unix_micros(F.col("ts").cast("timestamp")) > F.lit(e)).cast("int") for e in edges)
    for part in (3, 2, 1, 0):
        events.where(place == part).coalesce(1).write.mode("append").parquet(landed)
    totals = []
    for at_once in (1, 1000):
        out = fresh_path(spark, "stream")
        stream = hourly.read_file_stream(spark, landed, events.schema, files_per_trigger=at_once)
        found, _ = hourly.run_hourly_totals(stream, "event_type", "value", f"{out}/rows", f"{out}/checkpoint")
        totals.append(found.withColumn("arquivos", F.lit(at_once)))
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("inicio", "fim")}
    return totals[0].unionByName(totals[1]).withColumns({**ntz, **to_double("soma")})
