"""Grouped analyses over observations and production costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tulha.functions.values import in_calendar_window, period_year


def location_mean(observations: DataFrame, value: str = "valor") -> DataFrame:
    """Mean value by location; NULL values do not count."""
    return observations.groupBy("localidade_id", "localidade_nome").agg(F.avg(value).alias("media_valor"))


def top_locations(observations: DataFrame, k: int = 10, value: str = "valor") -> DataFrame:
    """The k locations with the highest mean; ties go to the smaller id."""
    means = location_mean(observations, value)
    return means.orderBy(F.desc_nulls_last("media_valor"), "localidade_id", "localidade_nome").limit(k)


def period_total(observations: DataFrame, value: str = "valor") -> DataFrame:
    """Total value by period text, in period order."""
    return observations.groupBy("periodo").agg(F.sum(value).alias("total_valor")).orderBy(F.asc_nulls_last("periodo"))


def period_window(observations: DataFrame, years: int | None, as_of_year: int) -> DataFrame:
    """Observations whose period lies in the calendar window, with its year."""
    return observations.where(in_calendar_window(F.col("periodo"), years, as_of_year)).withColumn(
        "ano", period_year(F.col("periodo"))
    )


def annual_cost(costs: DataFrame) -> DataFrame:
    """Variable, fixed and total cost by year; the total is the sum of the two sums."""
    sums = costs.groupBy("ano").agg(
        F.sum("vlr_custo_variavel_ha").alias("total_custo_variavel_ha"),
        F.sum("vlr_custo_fixo_ha").alias("total_custo_fixo_ha"),
    )
    return sums.withColumn(
        "total_custo_ha", F.col("total_custo_variavel_ha") + F.col("total_custo_fixo_ha")
    ).orderBy(F.asc_nulls_last("ano"))


def year_window(observations: DataFrame, years: int | None, as_of_year: int, year: str = "ano") -> DataFrame:
    """The same window over a table laid out by year: the filter prunes the table's folders."""
    return observations if years is None else observations.where(F.col(year).between(as_of_year - years, as_of_year))
