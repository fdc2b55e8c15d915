"""Completeness, freshness, quality, contracts, anomalies and lineage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tulha.session import fresh_path


def completeness(expected: DataFrame, loaded: DataFrame, key: Sequence[str]) -> DataFrame:
    """Expected against loaded row counts per key.

    Both sides are grouped before they meet, so the join sees one row per key.
    """
    want = expected.groupBy(*key).agg(F.count(F.lit(1)).alias("n_esperado"))
    have = loaded.groupBy(*key).agg(F.count(F.lit(1)).alias("n_carregado"))
    both = want.join(have, list(key), "full_outer").fillna(0, ["n_esperado", "n_carregado"])
    return both.withColumn(
        "situacao",
        F.when(F.col("n_esperado") == 0, "inesperado")
        .when(F.col("n_carregado") == 0, "ausente")
        .when(F.col("n_carregado") < F.col("n_esperado"), "parcial")
        .when(F.col("n_carregado") > F.col("n_esperado"), "excedente")
        .otherwise("completo"),
    )


def missing_items(expected: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Expected items with no loaded row at all; loaded keys are made distinct before the shuffle."""
    return expected.join(loaded.select(key).distinct(), key, "left_anti")


# Fixed value: a run may fail in less than this share of its tasks.
FAILURE_TARGET = 0.05


def load_kpis(log: DataFrame, failed: Column, finished_at: str, by: Sequence[str], as_of: Column) -> DataFrame:
    """Runs, failures, failure rate, last good load and its age in hours, per group."""
    good = F.when(~failed, F.col(finished_at))
    kpis = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_execucoes"),
        F.count_if(failed).alias("n_falhas"),
        F.max(good).alias("ultima_carga"),
    )
    rate = F.col("n_falhas") / F.col("n_execucoes")
    return kpis.withColumns(
        {
            "taxa_falha": F.round(rate, 6),
            "dentro_da_meta": rate < FAILURE_TARGET,
            "atraso_horas": F.timestamp_diff("HOUR", F.col("ultima_carga"), as_of),
        }
    )


def quality_report(df: DataFrame, checks: Mapping[str, tuple[str, str, Column]]) -> DataFrame:
    """Rows checked and failed per rule. `checks`: rule to (kind, column, passes).

    All rules share one pass over the data; a condition that is NULL fails.
    """
    marks = {rule: f"_falhas_{i}" for i, rule in enumerate(checks)}
    totals = df.agg(
        F.count(F.lit(1)).alias("_linhas"),
        *[F.count_if(~F.coalesce(passes, F.lit(False))).alias(marks[rule]) for rule, (_, _, passes) in checks.items()],
    )
    rules = F.array(
        *[
            F.struct(F.lit(rule).alias("regra"), F.lit(kind).alias("tipo"), F.lit(column).alias("coluna"), F.col(marks[rule]).alias("n_falhas"))
            for rule, (kind, column, _) in checks.items()
        ]
    )
    return totals.select(F.col("_linhas").alias("n_linhas"), F.inline(rules)).select(
        "regra",
        "tipo",
        "coluna",
        "n_linhas",
        "n_falhas",
        F.when(F.col("n_linhas") > 0, F.round(1 - F.col("n_falhas") / F.col("n_linhas"), 6)).alias("taxa_aprovacao"),
    )


def schema_violations(incoming: T.StructType, contract: T.StructType) -> list[tuple[str, str]]:
    """Contract columns that are missing or typed otherwise, and columns it does not name."""
    have = {f.name: f.dataType for f in incoming.fields}
    named = {f.name for f in contract.fields}
    found = [(f.name, "ausente") for f in contract.fields if f.name not in have]
    found += [
        (f.name, f"tipo {have[f.name].simpleString()}, esperado {f.dataType.simpleString()}")
        for f in contract.fields
        if f.name in have and have[f.name] != f.dataType
    ]
    return found + [(name, "nao declarada") for name in have if name not in named]


def contract_violations(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Landed text against a declared schema: per column, cells that break each rule.

    Counts cells that do not parse as the declared type and empty cells of
    columns declared not nullable; a missing column breaks both on every row.
    """
    missing = [f for f in contract.fields if f.name not in df.columns]
    whole = df.select("*", *[F.lit(None).cast("string").alias(f.name) for f in missing])
    counts, entries = [], []
    for f in contract.fields:
        cell = F.col(f.name)
        blank = cell.isNull() if f.name in df.columns else F.lit(True)
        unreadable = cell.isNotNull() & cell.try_cast(f.dataType).isNull()
        for rule, broken in [("tipo", unreadable), ("obrigatorio", blank if not f.nullable else F.lit(False))]:
            counts.append(F.count_if(broken).alias(f"{rule}_{f.name}"))
            entries.append(
                F.struct(F.lit(f.name).alias("coluna"), F.lit(rule).alias("regra"), F.col(f"{rule}_{f.name}").alias("n_violacoes"))
            )
    total = whole.agg(F.count(F.lit(1)).alias("n_linhas"), *counts)
    return total.select("n_linhas", F.inline(F.array(*entries)))


def series_anomalies(points: DataFrame, series: Sequence[str], order: str, value: str, threshold: float = 2.0) -> DataFrame:
    """Points whose z-score within their series passes the threshold.

    Expects one row per series and period (see `monthly_totals`), so a series
    window is as long as the calendar, not as the data.
    """
    whole = Window.partitionBy(*series)
    mean, spread = F.avg(value).over(whole), F.stddev_samp(value).over(whole)
    scored = points.withColumn("z", (F.col(value) - mean) / F.nullif(spread, F.lit(0.0)))
    return scored.where(F.abs("z") > threshold).select(*series, order, value, "z")


#: Items that a sketch keeps: series of fewer points are kept whole, so their quantiles are exact.
SKETCH_ITEMS = 400


def series_sketches(points: DataFrame, series: Sequence[str], value: str, items: int = SKETCH_ITEMS) -> DataFrame:
    """A quantile sketch of each series; sketches of parts merge, so a load adds its own to those kept (see `merged_sketches`)."""
    return points.where(F.col(value).isNotNull()).groupBy(*series).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(items)).alias("esboco"))


def merged_sketches(parts: DataFrame, series: Sequence[str], items: int = SKETCH_ITEMS) -> DataFrame:
    """One sketch per series from those of its parts."""
    return parts.groupBy(*series).agg(F.kll_merge_agg_double("esboco", F.lit(items)).alias("esboco"))


def fences(sketches: DataFrame, reach: float = 1.5) -> DataFrame:
    """Each series' quartiles and the fences `reach` interquartile ranges beyond them."""
    quartiles = F.kll_sketch_get_quantile_double("esboco", F.array(F.lit(0.25), F.lit(0.75)))
    known = sketches.withColumn("_q", quartiles).select(*[c for c in sketches.columns if c != "esboco"], F.get("_q", F.lit(0)).alias("q1"), F.get("_q", F.lit(1)).alias("q3"))
    width = reach * (F.col("q3") - F.col("q1"))
    return known.withColumns({"cerca_inferior": F.col("q1") - width, "cerca_superior": F.col("q3") + width})


def outside_fences(points: DataFrame, known: DataFrame, series: Sequence[str], order: str, value: str) -> DataFrame:
    """Points beyond their series' fences; points are joined with one row per series and not sorted within it."""
    beyond = (F.col(value) < F.col("cerca_inferior")) | (F.col(value) > F.col("cerca_superior"))
    return points.join(known, list(series)).where(beyond).select(*series, order, value, "q1", "q3", "cerca_inferior", "cerca_superior")


def with_lineage(df: DataFrame, batch_id: str, ingest_ts: str | Column, source_file: Column | str | None = None) -> DataFrame:
    """Add `_source_file`, `_ingest_ts` and `_batch_id`."""
    at = F.lit(ingest_ts).cast("timestamp_ntz") if isinstance(ingest_ts, str) else ingest_ts
    origin = F.col("_metadata.file_name") if source_file is None else F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.select("*", origin.alias("_source_file"), at.alias("_ingest_ts"), F.lit(batch_id).alias("_batch_id"))


def lineage_rows(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and latest load per layer, source file and batch."""
    parts = [
        df.groupBy("_source_file", "_batch_id")
        .agg(F.count(F.lit(1)).alias("n_linhas"), F.max("_ingest_ts").alias("carregado_em"))
        .withColumn("camada", F.lit(layer))
        for layer, df in layers.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def lineage_edges(frame: DataFrame, from_layer: str, from_node: Column, to_layer: str, to_node: Column) -> DataFrame:
    """`de`, `para`: what of one layer went into what of the next, once each; nodes are `layer:name`."""
    named = lambda layer, node: F.concat(F.lit(f"{layer}:"), F.coalesce(node.cast("string"), F.lit("")))
    return frame.select(named(from_layer, from_node).alias("de"), named(to_layer, to_node).alias("para")).distinct()


def lineage_closure(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """`de`, `para`, `passos`: everything that each node comes from, over however many steps, with the least number of steps.

    Each round joins what the last one found with the edges and keeps what is
    new, so a graph takes as many rounds as it has layers, and cycles end. Rounds
    are written to the shared folder. More than `most_rounds` is an error.
    """
    spark = edges.sparkSession

    def kept(frame: DataFrame) -> DataFrame:
        path = fresh_path(spark, "linhagem")
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    steps = kept(edges.select("de", "para").distinct())
    reached = fresh = kept(steps.withColumn("passos", F.lit(1)))
    for done in range(2, most_rounds + 2):
        further = fresh.select("de", F.col("para").alias("_por")).join(steps.select(F.col("de").alias("_por"), "para"), "_por")
        fresh = kept(further.select("de", "para").distinct().join(reached, ["de", "para"], "left_anti").withColumn("passos", F.lit(done)))
        if fresh.isEmpty():
            return reached
        reached = reached.unionByName(fresh)
    raise RuntimeError(f"the lineage goes on after {most_rounds} rounds")
