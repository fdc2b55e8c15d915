"""Hourly streams from landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    glob: str = "*.parquet",
    files_per_trigger: int = 1000,
    event_time: str = "ts",
) -> DataFrame:
    """Parquet files as they land. The event time becomes an instant, as watermarks need.

    Files land in any order, and a watermark moves between triggers: what
    `hourly_readings` and `without_redeliveries` drop as late depends on
    `files_per_trigger`, and `run_available` returns how much that was. Where
    history is read in, use `run_hourly_totals`, which drops nothing.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp"))


def hourly_readings(
    stream: DataFrame, by: str, value: str, event_time: str = "ts", lateness: str = "1 hour", slide: str | None = None
) -> DataFrame:
    """Count, minimum, maximum and sum per hour, final once the watermark has passed.

    State holds one row per group and open hour. `slide` makes the hours overlap.
    """
    hour = F.window(event_time, "1 hour", slide) if slide else F.window(event_time, "1 hour")
    return (
        stream.withWatermark(event_time, lateness)
        .groupBy(hour.alias("w"), by)
        .agg(
            F.count(F.lit(1)).alias("n_leituras"),
            F.min(value).alias("minimo"),
            F.max(value).alias("maximo"),
            F.sum(F.col(value).cast("decimal(18,4)")).alias("soma"),
        )
        .select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"), by, "n_leituras", "minimo", "maximo", "soma")
    )


def sessions(
    stream: DataFrame, by: str, value: str, event_time: str = "ts", gap: str = "6 hours", lateness: str = "1 hour"
) -> DataFrame:
    """Sessions per group: rows less than `gap` apart belong together; final once the watermark has passed the session's end.

    State holds one row per open session: sessions that a row joins are merged.
    `fim` is the last row's time and the gap.
    """
    return (
        stream.withWatermark(event_time, lateness)
        .groupBy(F.session_window(event_time, gap).alias("w"), by)
        .agg(
            F.count(F.lit(1)).alias("n_leituras"),
            F.min(value).alias("minimo"),
            F.max(value).alias("maximo"),
            F.sum(F.col(value).cast("decimal(18,4)")).alias("soma"),
        )
        .select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"), by, "n_leituras", "minimo", "maximo", "soma")
    )


def run_sessions(
    stream: DataFrame, by: str, value: str, path: str, checkpoint: str, event_time: str = "ts", gap: str = "6 hours", lateness: str = "1 hour"
) -> tuple[DataFrame, DataFrame, int]:
    """Process what has landed; the final sessions so far, the rows that came too late for theirs, and how many this run dropped.

    A row is too late if its own session, the gap long, had ended by the
    watermark: the newest time of the triggers before the last one, or, in a
    run's first trigger, of all earlier runs, less `lateness`. A second query over
    the same files lists those rows; `stream` must deal files to triggers alike
    each time, as the file source does.
    """
    spark = stream.sparkSession
    dropped = run_available(sessions(stream, by, value, event_time, gap, lateness), f"{path}/sessoes", f"{checkpoint}/sessoes")
    before_run: list[int] = []

    def list_late(batch: DataFrame, number: int) -> None:
        first = not before_run
        before_run.append(number)
        newest = None
        if number:
            seen = spark.read.schema("ultima timestamp, lote long").parquet(f"{path}/ultimas")
            newest = seen.where(F.col("lote") < (number if first else number - 1)).agg(F.max("ultima")).first()[0]
        end = F.col(event_time) + F.expr(f"INTERVAL {gap}")
        late = batch.where(end <= F.lit(newest) - F.expr(f"INTERVAL {lateness}")) if newest else batch.limit(0)
        late.write.mode("overwrite").parquet(f"{path}/atrasadas/lote={number}")
        batch.agg(F.max(event_time).alias("ultima")).write.mode("overwrite").parquet(f"{path}/ultimas/lote={number}")

    query = stream.writeStream.foreachBatch(list_late).option("checkpointLocation", f"{checkpoint}/atrasadas").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/sessoes"), spark.read.parquet(f"{path}/atrasadas").drop("lote"), dropped


def without_redeliveries(stream: DataFrame, key: str, event_time: str = "ts", lateness: str = "1 hour") -> DataFrame:
    """First delivery of each key; a key's state ends one lateness after its event time."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Process what has landed, append it to Parquet files and stop; returns the rows dropped as late.

    The file sink and the checkpoint together give each row once, also after
    a restart.
    """
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def run_hourly_totals(
    stream: DataFrame, by: str, value: str, path: str, checkpoint: str, event_time: str = "ts", lateness: str = "1 hour"
) -> tuple[DataFrame, DataFrame]:
    """Process what has landed; the hourly totals so far, and the rows that came late.

    Every trigger writes its own partial totals, in a folder of its number, so a
    trigger that is run again replaces what it wrote. Partial totals merge, so
    the result is that of a batch over the same files, however they are dealt to
    triggers and in whatever order they land. A row is late if it is older, by
    more than `lateness`, than the newest row of the triggers before; late rows
    count in the totals and are listed besides. A trigger's rows are kept while
    it is written, and each trigger leaves its newest time, so no earlier totals
    are read again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, batch = batch.sparkSession, batch.persist()
        hour = F.window(event_time, "1 hour")
        partial = batch.groupBy(hour.alias("w"), by).agg(
            F.count(F.lit(1)).alias("n_leituras"), F.min(value).alias("minimo"), F.max(value).alias("maximo"),
            F.sum(F.col(value).cast("decimal(18,4)")).alias("soma"),
        )
        before = None
        if number:
            seen = spark.read.schema("ultima timestamp, lote long").parquet(f"{path}/ultimas").where(F.col("lote") < number)
            before = seen.agg(F.max("ultima").alias("ultima")).first()["ultima"]
        partial.write.mode("overwrite").parquet(f"{path}/totais/lote={number}")
        late = batch.where(F.lit(before) - F.expr(f"INTERVAL {lateness}") > F.col(event_time)) if before else batch.limit(0)
        late.write.mode("overwrite").parquet(f"{path}/atrasadas/lote={number}")
        batch.agg(F.max(event_time).alias("ultima")).write.mode("overwrite").parquet(f"{path}/ultimas/lote={number}")
        batch.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    spark = stream.sparkSession
    totals = (
        spark.read.parquet(f"{path}/totais")
        .groupBy("w", by)
        .agg(F.sum("n_leituras").alias("n_leituras"), F.min("minimo").alias("minimo"), F.max("maximo").alias("maximo"), F.sum("soma").alias("soma"))
        .select(F.col("w.start").alias("inicio"), F.col("w.end").alias("fim"), by, "n_leituras", "minimo", "maximo", "soma")
    )
    return totals, spark.read.parquet(f"{path}/atrasadas").drop("lote")
