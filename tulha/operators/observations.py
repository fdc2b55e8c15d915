"""Nested statistical responses to long-format observations and back to wide columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tulha.functions.names import plain_slug
from tulha.functions.values import observation_value

# Core columns of an observation, in order, and the dimension name of last resort.
CORE_COLUMNS = ["agregado_id", "variavel", "unidade", "localidade_id", "localidade_nome", "periodo", "valor"]
UNNAMED_DIMENSION = "classificacao"


def dimension_entries(classifications: Column) -> Column:
    """`array<struct<rotulo, id, nome>>`, one entry per classification, in order.

    The first category counts; a classification without categories is skipped.
    The label is the classification's name, else its id, else a constant. It
    stays as published: it becomes a column name once per table, not per row.
    """

    def entry(c: Column) -> Column:
        first = lambda part: F.get(part(c["categoria"]), F.lit(0))
        label = F.coalesce(F.nullif(c["nome"], F.lit("")), F.nullif(c["id"], F.lit("")), F.lit(UNNAMED_DIMENSION))
        return F.named_struct(F.lit("rotulo"), label, F.lit("id"), first(F.map_keys), F.lit("nome"), first(F.map_values))

    filled = F.filter(classifications, lambda c: F.size(c["categoria"]) > 0)
    return F.coalesce(F.transform(filled, entry), F.array().cast("array<struct<rotulo:string,id:string,nome:string>>"))


def flatten_observations(
    responses: DataFrame, parsed: str = "parsed", dataset_id: str = "agregado_id", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per variable, result, location and period of each response.

    Only narrow steps: three explodes inside the row, no shuffle. Empty or
    missing arrays give no rows. Dimensions stay together in `dimensoes`.
    """
    blocks = responses.select(*keep, F.col(dataset_id).alias("agregado_id"), F.explode(parsed).alias("b"))
    results = blocks.select(
        *keep,
        "agregado_id",
        F.coalesce("b.variavel", F.lit("")).alias("variavel"),
        F.coalesce("b.unidade", F.lit("")).alias("unidade"),
        F.explode("b.resultados").alias("r"),
    )
    series = results.select(
        *keep,
        "agregado_id",
        "variavel",
        "unidade",
        dimension_entries(F.col("r.classificacoes")).alias("dimensoes"),
        F.explode("r.series").alias("s"),
    )
    return series.select(
        *keep,
        "agregado_id",
        "variavel",
        "unidade",
        F.col("s.localidade.id").alias("localidade_id"),
        F.col("s.localidade.nome").alias("localidade_nome"),
        F.explode("s.serie").alias("periodo", "valor_publicado"),
        "dimensoes",
    ).withColumn("valor", observation_value(F.col("valor_publicado")))


def published_labels(responses: DataFrame, parsed: str = "parsed", dataset_id: str = "agregado_id") -> DataFrame:
    """Distinct `(agregado_id, rotulo)` of the results that hold an observation, without flattening their series."""
    results = responses.select(F.col(dataset_id).alias("agregado_id"), F.explode(parsed).alias("b")).select("agregado_id", F.explode("b.resultados").alias("r"))
    held = results.where(F.exists("r.series", lambda s: F.size(s["serie"]) > 0))
    lists = held.select("agregado_id", dimension_entries(F.col("r.classificacoes"))["rotulo"].alias("rotulos")).distinct()
    return lists.select("agregado_id", F.explode("rotulos").alias("rotulo")).distinct()


def dimension_labels(observations: DataFrame) -> list[str]:
    """Distinct dimension labels, in order: the names of classifications, not values."""
    rows = observations.select(F.explode("dimensoes.rotulo").alias("rotulo")).distinct().collect()
    return sorted(r.rotulo for r in rows)


def dimension_columns(observations: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Two columns per dimension, `<slug>` and `<slug>_id`, from its published label.

    Where several entries of a row feed one column, the last one counts. A
    dimension named like a core text column takes that column's place; one
    named `valor` is refused, as text cannot replace the number.
    """
    names_of: dict[str, list[str]] = {}
    ids_of: dict[str, list[str]] = {}
    for label in labels:
        name = plain_slug(label) or UNNAMED_DIMENSION
        names_of.setdefault(name, []).append(label)
        ids_of.setdefault(f"{name}_id", []).append(label)
    columns = sorted({*names_of, *ids_of})
    if "valor" in columns:
        raise ValueError("a dimension named 'valor' would replace the observed value")

    def cell(column: str) -> Column:
        names, ids = names_of.get(column, []), ids_of.get(column, [])
        # The last entry is the first one of the reversed array.
        places = [F.nullif(F.array_position(F.reverse("dimensoes.rotulo"), label), F.lit(0)) for label in names + ids]
        place = F.least(*places) if len(places) > 1 else places[0]
        last = F.get(F.reverse("dimensoes"), (place - 1).cast("int"))
        return F.when(last["rotulo"].isin(names), last["nome"]).otherwise(last["id"]) if names else last["id"]

    core = [F.coalesce(cell(c), F.col(c)).alias(c) if c in columns else F.col(c) for c in CORE_COLUMNS]
    return observations.select(*core, *[cell(c).alias(c) for c in columns if c not in CORE_COLUMNS])


def dataset_view(observations: DataFrame, dataset: str, labels: Sequence[str]) -> DataFrame:
    """Wide rows of one dataset; the filter prunes partitions of a table laid out by dataset."""
    return dimension_columns(observations.where(F.col("agregado_id") == dataset), labels)
