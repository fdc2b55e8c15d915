"""Survey catalogue, metadata and request building."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tulha.functions.names import computed_once, mentions, spaced
from tulha.functions.values import in_calendar_window

# Surveys taken whole, the survey filtered by topic, its topics,
# and the phrase that marks a discontinued series. All in normalised spelling.
WHOLE_SURVEYS = ["pecuaria municipal", "ppm"]
CENSUS_SURVEY = "censo agropecuario"
CENSUS_TOPICS = [
    "irrigacao",
    "maquinas agricolas",
    "trator",
    "implemento agricola",
    "equipamento agricola",
    "pessoal ocupado",
    "mao de obra",
    "trabalhador rural",
    "valor da producao",
]
DISCONTINUED = "serie encerrada"

# Longest table name, and territorial levels from most to least wanted.
TABLE_NAME_LENGTH = 120
LEVEL_PREFERENCE = ["N6", "N3", "N1"]


def catalog_topics(
    surveys: DataFrame,
    parsed: str = "parsed",
    whole: Sequence[str] = WHOLE_SURVEYS,
    census: str = CENSUS_SURVEY,
    topics: Sequence[str] = CENSUS_TOPICS,
    discontinued: str = DISCONTINUED,
    metadata_base: str | None = None,
) -> DataFrame:
    """Catalogue documents to the wanted aggregates, one row each; `metadata_base` adds the address of their metadata.

    Surveys are filtered before their aggregates are exploded, so a survey that
    is not wanted costs one normalised name.
    """
    each = surveys.select(F.explode(parsed).alias("p"))
    survey = computed_once(each, "pesquisa_norm", spaced(F.coalesce("p.nome", F.lit(""))))
    named = survey.select(
        "p",
        mentions(F.col("pesquisa_norm"), whole).alias("inteira"),
        F.col("pesquisa_norm").contains(census).alias("censo"),
    ).where("inteira OR censo")
    each = named.select(
        F.col("p.id").alias("pesquisa_id"),
        F.coalesce("p.nome", F.lit("")).alias("pesquisa"),
        "inteira",
        F.explode("p.agregados").alias("a"),
    )
    aggregates = computed_once(each, "agregado_norm", spaced(F.col("a.nome")))
    wanted = aggregates.where(
        ~F.col("agregado_norm").contains(discontinued)
        & (F.col("inteira") | mentions(F.col("agregado_norm"), topics))
    )
    return wanted.select(
        "pesquisa_id",
        "pesquisa",
        F.col("a.id").alias("agregado_id"),
        F.substring(
            F.concat(F.lit("agregado_"), F.col("a.id"), F.lit("_"), F.translate("agregado_norm", " ", "_")), 1, TABLE_NAME_LENGTH
        ).alias("tabela"),
        F.col("a.nome").alias("nome_original"),
        *([F.concat(F.lit(metadata_base + "/agregados/"), "a.id", F.lit("/metadados")).alias("url_metadados")] if metadata_base else []),
    )


def preferred_level(levels: Column, preference: Sequence[str] = LEVEL_PREFERENCE) -> Column:
    """The most wanted level present, else the first one, else NULL."""
    return F.coalesce(
        *[F.when(F.array_contains(levels, level), F.lit(level)) for level in preference], F.get(levels, F.lit(0))
    )


def request_specs(metadata: DataFrame, parsed: str = "parsed", keep: Sequence[str] = ()) -> DataFrame:
    """Metadata documents to the request that asks for all variables and categories.

    `motivo` is NULL for a usable row and names the reason for a rejected one.
    """
    doc = F.col(parsed)
    every = lambda ids: F.array_join(F.transform(ids, lambda c: F.concat(c["id"].cast("string"), F.lit("[all]"))), "|")
    level = preferred_level(doc["nivelTerritorial"]["Administrativo"])
    return metadata.select(
        *keep,
        doc["id"].alias("agregado_id"),
        F.array_join(doc["variaveis"]["id"], "|").alias("variaveis"),
        level.alias("nivel"),
        F.concat(level, F.lit("[all]")).alias("localidades"),
        F.when(F.size(doc["classificacoes"]) > 0, every(doc["classificacoes"])).alias("classificacao"),
        F.when(doc.isNull(), "documento ilegivel")
        .when(F.coalesce(F.size(doc["variaveis"]), F.lit(0)) <= 0, "sem variaveis")
        .when(level.isNull(), "sem nivel territorial")
        .alias("motivo"),
    )


def requests_by_period(
    specs: DataFrame, periods: str, years: int | None, as_of_year: int, base: str = ""
) -> DataFrame:
    """One request per usable spec and listed period inside the calendar window."""
    each = specs.where("motivo IS NULL").withColumn("periodo", F.explode(F.col(periods)["id"])).drop(periods)
    return each.where(in_calendar_window(F.col("periodo"), years, as_of_year)).withColumn(
        "caminho",
        F.concat(
            F.lit(base), F.lit("/agregados/"), "agregado_id", F.lit("/periodos/"), "periodo", F.lit("/variaveis/"), "variaveis"
        ),
    )
