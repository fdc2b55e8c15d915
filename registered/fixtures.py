"""Inputs in the shapes the operators expect, derived by Spark from the given tables."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tulha.functions.names import computed_once
from tulha.session import fresh_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    """Two-decimal text of a number, the same at every engine."""
    return F.col(column).cast("decimal(18,2)").cast("string")


#: The window that the registered queries ask for.
AS_OF_YEAR, WINDOW_YEARS = 2001, 5

#: The salt of the registered query; a load takes its own from the caller.
PSEUDONYM_SALT = "sal-de-teste"

STATUS = {"F": "fechados", "O": "abertos", "P": "parciais"}


def status_name(column: str) -> Column:
    return F.when(F.col(column) == "F", "fechados").when(F.col(column) == "O", "abertos").otherwise("parciais")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations: location is the customer's nation, the dimension its segment."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        status_name("o_orderstatus").alias("agregado_id"),
        F.col("o_orderpriority").alias("variavel"),
        F.lit("money").alias("unidade"),
        F.col("n_nationkey").cast("string").alias("localidade_id"),
        F.col("n_name").alias("localidade_nome"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyyMM"))
        .alias("periodo"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("valor"),
        F.col("c_mktsegment").alias("segmento"),
        "o_orderkey",
        "o_orderdate",
    )


def costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as production costs."""
    exact = lambda c: c.cast("decimal(18,4)")
    return table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("ano"),
        F.when(F.col("l_linenumber") != 7, exact(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("vlr_custo_variavel_ha"),
        F.when(F.col("l_linenumber") != 6, exact(F.col("l_quantity"))).alias("vlr_custo_fixo_ha"),
    )


def published_value() -> Column:
    """The order total as published text, with markers and unreadable cells."""
    k = F.col("o_orderkey")
    return (
        F.when(k % 19 == 0, "..")
        .when(k % 19 == 1, "...")
        .when(k % 19 == 2, "-")
        .when(k % 19 == 3, "X")
        .when(k % 19 == 4, "")
        .when(k % 19 == 5, "sigilo")
        .when(k % 19 == 6, "12d")
        .when(k % 19 == 7, "NaN")
        .when(k % 19 == 8, F.concat(F.lit(" "), money("o_totalprice"), F.lit(" ")))
        .when(k % 19 == 9, F.concat(F.lit("1_"), F.lpad((k % 1000).cast("string"), 3, "0")))
        .otherwise(money("o_totalprice"))
    )


def nested_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested response per order: two variables, several results, locations and periods."""
    year, month = F.date_format("o_orderdate", "yyyy"), F.date_format("o_orderdate", "yyyyMM")

    def category(code: Column, name: Column) -> Column:
        return F.create_map(code, name)

    def classification(code: str | None, name: str | None, categories: Column) -> Column:
        return F.struct(
            F.lit(code).cast("string").alias("id"), F.lit(name).cast("string").alias("nome"), categories.alias("categoria")
        )

    def series(code: Column, name: Column, cells: Column) -> Column:
        return F.struct(F.struct(code.alias("id"), name.alias("nome")).alias("localidade"), cells.alias("serie"))

    def result(classifications: Column, rows: Column) -> Column:
        return F.struct(classifications.alias("classificacoes"), rows.alias("series"))

    def variable(name: Column, unit: Column, results: Column) -> Column:
        return F.struct(name.alias("variavel"), unit.alias("unidade"), results.alias("resultados"))

    customer = F.col("o_custkey").cast("string")
    nothing = F.create_map().cast("map<string,string>")
    status = category(F.col("o_orderstatus"), status_name("o_orderstatus"))
    by_status = result(
        F.array(
            classification("81", "Situação do pedido", status),
            classification("90", "Sem categorias", nothing),
            classification("82", "", category(F.lit("0"), F.lit("Total"))),
        ),
        F.array(
            series(customer, F.concat(F.lit("Cliente nº "), customer), F.create_map(year, published_value(), month, F.lit("1.5"))),
            series(F.lit("BR"), F.lit("Brasil"), F.create_map(year, F.lit("..."))),
        ),
    )
    by_priority = result(
        F.array(
            classification("", "", category(F.lit("p"), F.col("o_orderpriority"))),
            classification("81", "Situação do pedido", status),
            classification("83", "SITUACAO DO PEDIDO", category(F.lit("z"), F.lit("repetida"))),
        ),
        F.array(series(customer, F.concat(F.lit("Cliente nº "), customer), F.create_map(month, money("o_totalprice")))),
    )
    empty = result(F.array(classification("81", "Situação do pedido", status)), F.array().cast(by_status_series()))
    plain = result(
        F.array().cast("array<struct<id:string,nome:string,categoria:map<string,string>>>"),
        F.array(series(F.lit("BR"), F.lit("Brasil"), F.create_map(month, F.lit("1")))),
    )
    response = F.array(
        variable(F.lit("Valor"), F.lit("money"), F.array(by_status, by_priority, empty)),
        variable(F.lit("Quantidade"), F.lit("unidades"), F.array(plain)),
    )
    return computed_once(table(spark, sf_dir, "orders"), "parsed", response).select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("agregado_id"), "parsed"
    )


#: Responses in a landed file. A compressed file is read by one task, so the files are what spreads the reading.
RESPONSES_PER_FILE = 10_000


def land_responses(spark: SparkSession, sf_dir: str, dataset: Column, body: Column) -> DataFrame:
    """Response bodies landed as compressed JSON lines and read back: `agregado_id`, `body`, `source_file`."""
    path = fresh_path(spark, "landed")
    nested_responses(spark, sf_dir).select(
        dataset.alias("agregado_id"), body.alias("body"), F.lit("respostas.json").alias("source_file")
    ).write.option("maxRecordsPerFile", RESPONSES_PER_FILE).json(path, compression="gzip")
    return spark.read.schema("agregado_id string, body string, source_file string").json(path)


def by_status_series() -> str:
    return "array<struct<localidade:struct<id:string,nome:string>,serie:map<string,string>>>"


def catalogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as survey-catalogue documents: one survey with three aggregates each."""
    survey = (
        F.when(F.col("p_type") == "STANDARD", "Pesquisa da Pecuária Municipal")
        .when(F.col("p_type") == "ECONOMY", "Censo Agropecuário")
        .when(F.col("p_type") == "MEDIUM", "Pesquisa (PPM)")
        .when(F.col("p_type") == "LARGE", "Estudos Apppmx")
        .when(F.col("p_type") == "SMALL", "CENSO  AGROPECUÁRIO, 2017")
        .otherwise("Produção Agrícola Municipal")
    )
    closed = F.when(F.col("p_size") % 2 == 0, " (série encerrada)").otherwise("")
    aggregate = lambda n, name: F.struct((F.col("p_partkey") * 10 + n).cast("string").alias("id"), name.alias("nome"))
    return table(spark, sf_dir, "part").select(
        F.to_json(
            F.array(
                F.struct(
                    F.col("p_brand").alias("id"),
                    survey.alias("nome"),
                    F.array(
                        aggregate(1, F.concat("p_name", F.lit(" – Irrigação (ha)"))),
                        aggregate(2, F.concat("p_name", F.lit(" e Tratores"), closed)),
                        aggregate(3, F.concat("p_brand", F.lit(", área colhida e preço médio de "), "p_name")),
                    ).alias("agregados"),
                )
            )
        ).alias("body")
    )


def metadata_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as metadata and period-list documents."""
    k = F.col("p_partkey")
    levels = (
        F.when(k % 6 == 0, F.array(F.lit("N1"), F.lit("N3"), F.lit("N6")))
        .when(k % 6 == 1, F.array(F.lit("N1"), F.lit("N3")))
        .when(k % 6 == 2, F.array(F.lit("N1")))
        .when(k % 6 == 3, F.array(F.lit("N2"), F.lit("N8")))
        .when(k % 6 == 4, F.array(F.lit("N3"), F.lit("N1")))
        .otherwise(F.array().cast("array<string>"))
    )
    ids = lambda base, n: F.transform(
        F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), n)).otherwise(F.array().cast("array<bigint>")),
        lambda i: F.struct((base + i).alias("id")),
    )
    return table(spark, sf_dir, "part").select(
        F.to_json(
            F.struct(
                k.alias("id"),
                ids(F.lit(100), k % 4).alias("variaveis"),
                ids(F.lit(200), k % 3).alias("classificacoes"),
                F.struct(levels.alias("Administrativo")).alias("nivelTerritorial"),
            )
        ).alias("body"),
        F.to_json(
            F.transform(
                F.array(F.lit(1985), 1995 + (F.col("p_size") % 8), F.lit(200106), F.lit(2002)),
                lambda y: F.struct(y.cast("string").alias("id")),
            )
        ).alias("period_body"),
    )


# Station columns as the files name them, their safe names and types.
STATION_COLUMNS = {
    "data": "string",
    "hora_utc": "string",
    "precipitacao_total_mm": "double",
    "temperatura_maxima_c": "double",
    "umidade": "double",
}
STATION_HEADER = "Data;Hora UTC;PRECIPITAÇÃO TOTAL (mm);TEMPERATURA MÁXIMA (°C);UMIDADE (%);"


def hourly_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly station readings; each event type is a station."""
    hour = F.date_trunc("hour", "ts")
    exact = F.col("value").cast("decimal(18,2)")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("estacao"), F.date_format(hour, "yyyy/MM/dd").alias("data"), F.date_format(hour, "HHmm").alias("hora"))
        .agg(F.sum(exact).alias("chuva"), F.max(exact).alias("maxima"), F.count(F.lit(1)).alias("umidade"))
    )


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines of one file per station and day: eight preamble lines, a header, hourly rows."""
    comma = lambda c: F.translate(F.col(c).cast("string"), ".", ",")
    rows = hourly_stations(spark, sf_dir).select(
        "estacao",
        F.translate("data", "/", "-").alias("dia"),
        (F.col("hora").cast("int") + 100).alias("pos"),
        F.concat_ws(
            ";", "data", F.concat("hora", F.lit(" UTC")), comma("chuva"), F.when(F.col("hora") == "0700", "").otherwise(comma("maxima")), F.col("umidade").cast("string"), F.lit("")
        ).alias("line"),
    )
    names = ["REGIÃO", "UF", "ESTAÇÃO", "CODIGO", "LATITUDE", "LONGITUDE", "ALTITUDE", "DATA DE FUNDAÇÃO"]
    top = F.array(*[F.concat(F.lit(f"{n}:;"), "estacao") for n in names], F.lit(STATION_HEADER))
    preambles = rows.select("estacao", "dia").distinct().select("estacao", "dia", F.posexplode(top).alias("pos", "line"))
    return rows.unionByName(preambles)


def land_station_files(spark: SparkSession, sf_dir: str) -> str:
    """Write those files below a fresh folder and return it.

    A file holds at most one day of hours, so hashing by station and day keeps
    every file in one task without a hot group.
    """
    path = fresh_path(spark, "stations")
    (
        station_lines(spark, sf_dir)
        .repartition("estacao", "dia")
        .sortWithinPartitions("estacao", "dia", "pos")
        .select("estacao", "dia", "line")
        .write.partitionBy("estacao", "dia")
        .option("sep", "\x01")
        .option("quote", "\x02")
        .option("encoding", "ISO-8859-1")
        .csv(path)
    )
    return path


def station_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(path, content)` zip files, one per station and day, with a data and a note member."""
    @F.pandas_udf("binary")
    def zipped(name: pd.Series, body: pd.Series) -> pd.Series:
        def pack(member: str, text: str) -> bytes:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"dados/{member}.CSV", text.encode("iso-8859-1"))
                archive.writestr("dados/leia-me.txt", b"nota")
                archive.writestr("../fora.csv", b"fora")
            return out.getvalue()

        return pd.Series([pack(n, t) for n, t in zip(name, body)])

    # At most nine preamble lines and 24 hours per station and day.
    texts = (
        station_lines(spark, sf_dir)
        .groupBy("estacao", "dia")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\r\n").alias("body"))
    )
    name = F.concat_ws("_", "estacao", "dia")
    return texts.select(F.concat(name, F.lit(".zip")).alias("path"), zipped(name, F.col("body")).alias("content"))


def coordinates(key: str, a: int, b: int) -> list[Column]:
    """A latitude and longitude that depend on a key."""
    k = F.col(key)
    return [
        (F.lit(-33.0) + (k * a % 38000) / 1000.0).alias("latitude"),
        (F.lit(-74.0) + (k * b % 39000) / 1000.0).alias("longitude"),
    ]
