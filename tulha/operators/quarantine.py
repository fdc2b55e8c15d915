"""Failure isolation at row level: good rows go on, bad rows are kept with a reason."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tulha.functions.names import computed_once
from tulha.sources.responses import BLOCK_SCHEMA, DATA_SCHEMA


def _lost(raw: Column, fitted: Column) -> Column:
    """Whether a member is present, but did not fit."""
    return F.coalesce(raw.isNotNull() & ~F.is_variant_null(raw) & fitted.isNull(), F.lit(False))


def _any_of(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(items, test), F.lit(False))


def _any_pair(raw: Column, fitted: Column, test: Callable[[Column, Column], Column]) -> Column:
    return _any_of(F.zip_with(raw, fitted, test), lambda found: found)


def _incomplete(block: Column) -> Column:
    """Whether a fitted block, or a member of it that might not have fitted, is null."""
    lacks = lambda *names: lambda item: reduce(or_, [item[n].isNull() for n in names])
    in_result = lambda r: lacks("series", "classificacoes")(r) | _any_of(r["series"], lacks("serie", "localidade")) | _any_of(r["classificacoes"], lacks("categoria"))
    return block.isNull() | block["resultados"].isNull() | _any_of(block["resultados"], in_result)


def _misshapen(block: Column, fitted: Column) -> Column:
    """Whether a member of a block that is present has another shape than the contract's.

    A member that is there after fitting had the right shape. Where one is null,
    that member alone is read again from the block, to tell one that is absent or
    null from one that did not fit.
    """
    results = fitted["resultados"]

    def in_results(name: str) -> Column:
        raw = F.try_variant_get(block, "$.resultados", f"array<struct<{name}:variant>>")
        return _any_of(results, lambda r: r[name].isNull()) & _any_pair(raw, results, lambda a, b: _lost(a[name], b[name]))

    def in_items(items: str, name: str) -> Column:
        raw = F.try_variant_get(block, "$.resultados", f"array<struct<{items}:array<struct<{name}:variant>>>>")
        absent = _any_of(results, lambda r: _any_of(r[items], lambda i: i[name].isNull()))
        return absent & _any_pair(raw, results, lambda a, b: _any_pair(a[items], b[items], lambda c, d: _lost(c[name], d[name])))

    wrong = results.isNull() & _lost(F.try_variant_get(block, "$.resultados", "variant"), results)
    for name in ("series", "classificacoes"):
        wrong = wrong | in_results(name)
    for items, name in (("series", "serie"), ("series", "localidade"), ("classificacoes", "categoria")):
        wrong = wrong | in_items(items, name)
    return wrong


def mark_blocks(df: DataFrame, body: str = "body", size: str | None = None) -> DataFrame:
    """One row per block of each response: `bloco` (its position), `parsed` (an array of it) and `motivo`.

    The body is parsed once, into a variant, and fitted to the contract's shape,
    where a part of another shape becomes null and the others stay. Only a
    response with such nulls is taken apart into its raw blocks, so a block of
    another shape is rejected by itself and the others of its response go on. A
    missing member is no error and gives no rows; one that is present in another
    shape is. A body without blocks gives one row, rejected as a whole with
    position -1. `size` names a column for the number of rows of the response.
    Of equal keys the last one counts, which the session is told to accept.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    read = computed_once(df, "_variant", F.try_parse_json(body))
    listed = computed_once(read, "_blocks", F.try_variant_get("_variant", "$", DATA_SCHEMA))
    reason = (
        F.when(F.col(body).isNull() | (F.trim(body) == ""), "vazio")
        .when(F.isnull("_variant"), "json ilegivel")
        .when(F.isnull("_blocks"), "estrutura inesperada")
        .when(F.size("_blocks") == 0, "sem variaveis")
    )
    kept = [c for c in df.columns if c != body]
    whole = listed.select(*kept, "_variant", "_blocks", reason.alias("_whole"), F.when(reason.isNotNull(), F.col(body)).alias(body))
    doubtful = computed_once(whole, "_raw", F.when(_any_of(F.col("_blocks"), _incomplete), F.try_variant_get("_variant", "$", "array<variant>")))
    none = F.array(F.lit(None).cast(BLOCK_SCHEMA))
    blocks = doubtful.select(
        *kept, body, "_whole", "_raw", F.size("_blocks").alias("_size"), F.posexplode(F.when(F.isnull("_whole"), F.col("_blocks")).otherwise(none)).alias("_at", "_fitted")
    )
    raw = computed_once(blocks, "_block", F.when(F.isnull("_whole"), F.get("_raw", "_at")))
    wrong = F.col("_block").isNotNull() & _incomplete(F.col("_fitted")) & (F.isnull("_fitted") | _misshapen(F.col("_block"), F.col("_fitted")))
    motivo = F.coalesce("_whole", F.when(wrong, "estrutura inesperada"))
    place = F.when(F.isnull("_whole"), F.col("_at")).otherwise(-1)
    text = F.coalesce(F.to_json("_block"), F.col(body))
    return raw.select(
        *kept,
        F.when(motivo.isNotNull(), text).alias(body),
        place.alias("bloco"),
        F.array("_fitted").alias("parsed"),
        motivo.alias("motivo"),
        *([F.when(F.isnull("_whole"), F.col("_size")).otherwise(1).cast("long").alias(size)] if size else []),
    )


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with their reason."""
    return marked.where("motivo IS NULL").drop("motivo"), marked.where("motivo IS NOT NULL").drop("parsed")


def reconciled(marked: DataFrame, by: Sequence[str], size: str | None = None) -> DataFrame:
    """Blocks that each response holds against those loaded and rejected: what a load must account for.

    A response without readable blocks counts as one, which is rejected. With
    the column of sizes that `mark_blocks` gave, a group may hold many responses,
    which `n_respostas` counts: what they hold is added up at their first rows,
    so nothing is kept per response.
    """
    good, first = F.col("motivo").isNull(), F.col("bloco") <= 0
    held = F.sum(F.when(first, F.col(size)).otherwise(0)) if size else F.greatest(F.max("bloco") + 1, F.lit(1))
    responses = [F.count_if(first).alias("n_respostas")] if size else []
    counts = marked.groupBy(*by).agg(
        held.cast("long").alias("n_esperados"), F.count_if(good).alias("n_carregados"), F.count_if(~good).alias("n_rejeitados"), *responses
    )
    return counts.withColumn("conferido", F.col("n_esperados") == F.col("n_carregados") + F.col("n_rejeitados"))


def summary(marked: DataFrame, by: str) -> DataFrame:
    """Rows per group and reason; a NULL reason counts the good ones."""
    return marked.groupBy(by, "motivo").agg(F.count(F.lit(1)).alias("n_linhas"))


def raise_on_rejects(rejects: DataFrame) -> None:
    """Fail at the end of a load that left rejects, naming the reasons and counts."""
    reasons = rejects.groupBy("motivo").count().orderBy("motivo").collect()
    if reasons:
        raise RuntimeError("rejected rows: " + ", ".join(f"{r['motivo']}={r['count']}" for r in reasons))
