from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tulha.session import fresh_path
from tulha.streaming import hourly

SCHEMA = "event_id bigint, ts timestamp_ntz, station string, value double"


def land(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def events(start, n, step_minutes, first_id=0):
    at = datetime(2024, 1, 1) + timedelta(hours=start)
    return [(first_id + i, at + timedelta(minutes=step_minutes * i), "ab"[i % 2], float(i)) for i in range(n)]


def test_closed_hours_equal_batch_over_restarts(spark):
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "rows", "checkpoint"))
    everything = []
    for start in (0, 3, 6):
        rows = events(start, 18, 10, start * 100)
        everything += rows
        land(spark, landed, rows)
        schema = spark.read.parquet(landed).schema
        stream = hourly.read_file_stream(spark, landed, schema)
        hourly.run_available(hourly.hourly_readings(stream, "station", "value"), out, checkpoint)
    late = max(r[1] for r in everything) - timedelta(hours=1)
    got = {(r.inicio, r.station): (r.n_leituras, r.minimo, r.maximo, float(r.soma)) for r in spark.read.parquet(out).collect()}
    want = {}
    for _, ts, station, value in everything:
        hour = ts.replace(minute=0)
        if hour + timedelta(hours=1) <= late:
            n, low, high, total = want.get((hour, station), (0, value, value, 0.0))
            want[hour, station] = (n + 1, min(low, value), max(high, value), total + value)
    assert got == want


def test_redeliveries_across_batches(spark):
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "rows", "checkpoint"))
    for rows in (events(0, 6, 5), events(0, 6, 5) + events(1, 4, 5, 50)):
        land(spark, landed, rows)
        stream = hourly.read_file_stream(spark, landed, spark.read.parquet(landed).schema)
        hourly.run_available(hourly.without_redeliveries(stream, "event_id", lateness="3 hours"), out, checkpoint)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4, 5, 50, 51, 52, 53]


def test_sliding_hours(spark):
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "rows", "checkpoint"))
    land(spark, landed, events(0, 60, 10))
    stream = hourly.read_file_stream(spark, landed, spark.read.parquet(landed).schema)
    hourly.run_available(hourly.hourly_readings(stream, "station", "value", slide="30 minutes"), out, checkpoint)
    rows = spark.read.parquet(out)
    assert rows.where(F.minute("inicio") == 30).count() > 0
    assert rows.where("inicio >= '2024-01-01 01:00:00'").agg(F.min("n_leituras"), F.max("n_leituras")).first() == (3, 3)


def test_totals_do_not_depend_on_files_per_trigger(spark):
    landed = fresh_path(spark, "landed")
    for start in (48, 24, 0):
        land(spark, landed, events(start, 24, 60, start * 10))
    schema, want = spark.read.parquet(landed).schema, 24 * 3
    for at_once, n_late in ((1, 48), (1000, 0)):
        out, checkpoint = fresh_path(spark, "rows"), fresh_path(spark, "checkpoint")
        for _ in range(2):  # a second run finds nothing new
            stream = hourly.read_file_stream(spark, landed, schema, files_per_trigger=at_once)
            totals, late = hourly.run_hourly_totals(stream, "station", "value", out, checkpoint)
        assert totals.agg(F.sum("n_leituras")).first()[0] == want == totals.count()
        assert late.count() == n_late


def test_dropped_rows_are_counted(spark):
    landed, out, checkpoint = (fresh_path(spark, n) for n in ("landed", "rows", "checkpoint"))
    for start in (48, 24, 0):
        land(spark, landed, events(start, 24, 60, start * 10))
    stream = hourly.read_file_stream(spark, landed, spark.read.parquet(landed).schema, files_per_trigger=1)
    assert hourly.run_available(hourly.hourly_readings(stream, "station", "value"), out, checkpoint) > 0
