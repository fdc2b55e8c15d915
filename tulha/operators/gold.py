"""Gold layer: state and year totals, star schema, features, climate series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tulha.functions.values import period_month, period_year


def state_year(
    observations: DataFrame, production: str, area: str, state: str = "localidade_nome"
) -> DataFrame:
    """Production, area and yield by state and year, from long rows in one grouping."""
    measure = lambda name: F.sum(F.when(F.col("variavel") == name, F.col("valor")))
    sums = observations.groupBy(F.col(state).alias("uf"), period_year(F.col("periodo")).alias("ano")).agg(
        measure(production).alias("producao"), measure(area).alias("area")
    )
    return sums.withColumn("rendimento", F.col("producao") / F.nullif("area", F.lit(0.0)))


def surrogate_key(*columns: str) -> Column:
    """A stable 64-bit key of the natural key; a NULL part counts by its place, so an unknown member has a key too."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c), F.isnull(c))])


def dimension(observations: DataFrame, key: Sequence[str], attributes: Sequence[str], name: str) -> DataFrame:
    """One row per natural key with its attributes and surrogate key `sk_<name>`.

    Where rows disagree on an attribute the greatest value counts, so the
    dimension does not depend on row order. Distinct combinations are found
    first, which hashes and needs no sort of the observations. Observations
    without the key have a member of their own, so that none is lost in a join.
    """
    rows = observations.select(*key, *attributes).distinct()
    if attributes:
        rows = rows.groupBy(*key).agg(*[F.max(a).alias(a) for a in attributes])
    return rows.select(surrogate_key(*key).alias(f"sk_{name}"), *key, *attributes)


def star_dimensions(observations: DataFrame, source: str = "agregado_id") -> dict[str, DataFrame]:
    """Location, period, variable and source dimensions."""
    periods = dimension(observations, ["periodo"], [], "periodo")
    return {
        "localidade": dimension(observations, ["localidade_id"], ["localidade_nome"], "localidade"),
        "periodo": periods.withColumns(
            {"ano": period_year(F.col("periodo")), "mes": period_month(F.col("periodo"))}
        ),
        "variavel": dimension(observations, ["variavel", "unidade"], [], "variavel"),
        "fonte": dimension(observations, [source], [], "fonte"),
    }


def star_fact(observations: DataFrame, source: str = "agregado_id") -> DataFrame:
    """Fact rows: surrogate keys computed from the natural keys, so no join is needed to load."""
    return observations.select(
        surrogate_key("localidade_id").alias("sk_localidade"),
        surrogate_key("periodo").alias("sk_periodo"),
        surrogate_key("variavel", "unidade").alias("sk_variavel"),
        surrogate_key(source).alias("sk_fonte"),
        "valor",
    )


def shared_keys(dimensions: dict[str, DataFrame]) -> list[str]:
    """Names of the dimensions in which two natural keys share a surrogate key; such a dimension must not be loaded."""
    counts = [d.agg(F.lit(n).alias("name"), (F.count("*") - F.countDistinct(f"sk_{n}")).alias("lost")) for n, d in dimensions.items()]
    return sorted(r["name"] for r in reduce(DataFrame.unionByName, counts).where("lost > 0").collect())


def star_join(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """Fact with its dimension attributes; small dimensions are broadcast by their measured size."""
    for name, rows in dimensions.items():
        fact = fact.join(rows, f"sk_{name}")
    return fact


def orphan_facts(fact: DataFrame, dimension_rows: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key has no dimension row."""
    return fact.join(dimension_rows.select(key), key, "left_anti")


def monthly_totals(observations: DataFrame) -> DataFrame:
    """One row per variable, location and month; `mes_indice` counts months since year 0."""
    period = F.col("periodo")
    return (
        observations.where(period_month(period).isNotNull())
        .groupBy("variavel", "localidade_id", "periodo")
        .agg(F.sum("valor").alias("valor_mes"), F.count("valor").alias("n_valores"))
        .withColumn("mes_indice", period_year(period) * 12 + period_month(period) - 1)
    )


def feature_lags(observations: DataFrame, climate: DataFrame | None = None) -> DataFrame:
    """Previous month, same month a year before and mean of the last three months per series.

    Windows run over monthly totals, so a series holds at most one row per
    calendar month however many observations it has. Gaps stay gaps: frames
    are ranges of months, not of rows.
    """
    months = monthly_totals(observations)
    series = Window.partitionBy("variavel", "localidade_id").orderBy("mes_indice")
    at = lambda back: F.max("valor_mes").over(series.rangeBetween(-back, -back))
    features = months.select(
        "variavel",
        "localidade_id",
        "periodo",
        "valor_mes",
        at(1).alias("mes_anterior"),
        at(12).alias("ano_anterior"),
        F.avg("valor_mes").over(series.rangeBetween(-2, 0)).alias("media_3_meses"),
    )
    if climate is None:
        return features
    return features.join(climate, ["localidade_id", "periodo"], "left")


def climate_monthly(
    readings: DataFrame, measures: Sequence[str], station: str = "estacao", day: str = "data"
) -> DataFrame:
    """The same as `climate_daily` by month; a day is text or a date that starts with year and month."""
    month = F.regexp_replace(F.substring(F.col(day).cast("string"), 1, 7), "[/-]", "")
    return climate_daily(readings.withColumn("_mes", month), measures, station, "_mes").withColumnRenamed("_mes", "mes")


def climate_daily(
    readings: DataFrame, measures: Sequence[str], station: str = "estacao", day: str = "data"
) -> DataFrame:
    """Minimum, maximum, mean and sum of each measure by station and day."""
    steps = [("min", F.min), ("max", F.max), ("media", F.avg), ("soma", F.sum)]
    return readings.groupBy(station, day).agg(
        F.count(F.lit(1)).alias("n_leituras"), *[f(m).alias(f"{m}_{label}") for m in measures for label, f in steps]
    )
