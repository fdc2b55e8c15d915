"""Nearest site by descent through a grid, with exact bounds."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EARTH_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


# Cells at level k are 360/2^k degrees wide; the finest is about 38 m. The search
# starts with all cells of the first level, of which the globe has 32, and goes
# down by several levels at a time.
FIRST_LEVEL, STEP, FINEST_LEVEL = 3, 3, 18
SLACK_KM = 1e-6


def _cell_at(level: int, lat: Column, lon: Column) -> Column:
    """One number for the row and column of the cell that holds a coordinate."""
    per_degree = 2.0**level / 360.0
    row = F.least(F.floor((lat + 90.0) * per_degree), F.lit(2 ** (level - 1) - 1))
    return row * 2**level + F.pmod(F.floor((lon + 180.0) * per_degree), F.lit(2**level))


def _bounds(level: int, cell: str, lat: Column, lon: Column) -> Column:
    """A distance that no coordinate of the cell is nearer than.

    From the cell's centre every coordinate of it is reached along a meridian
    and then a parallel, of half a width each at most.
    """
    width = 360.0 / 2**level
    row, col = F.floor(F.col(cell) / 2**level), F.pmod(F.col(cell), F.lit(2**level))
    mid_lat, mid_lon = row * width - 90.0 + width / 2, col * width - 180.0 + width / 2
    flattest = F.when(F.abs(mid_lat) <= width / 2, 1.0).otherwise(F.cos(F.radians(F.abs(mid_lat) - width / 2)))
    reach = F.lit(EARTH_KM * math.radians(width / 2)) * (flattest + 1.0)
    return haversine_km(lat, lon, mid_lat, mid_lon) - reach


def _site_cells(places: DataFrame, level: int, parent_level: int | None) -> DataFrame:
    """Cells that hold sites, with one of their sites and the cell they are in `parent_level`."""
    lat, lon = F.col("s_lat"), F.col("s_lon")
    parent = [] if parent_level is None else [_cell_at(parent_level, lat, lon).alias("parent")]
    return places.groupBy(_cell_at(level, lat, lon).alias("cell"), *parent).agg(F.min(F.struct("s_lat", "s_lon")).alias("one"))


def _nearest_cells(pairs: DataFrame, level: int) -> DataFrame:
    """Of each place's cells those that may hold its nearest site: their bound is within the nearest known site."""
    lat, lon = F.col("latitude"), F.col("longitude")
    seen = pairs.select("latitude", "longitude", "cell", _bounds(level, "cell", lat, lon).alias("bound"), haversine_km(lat, lon, F.col("one.s_lat"), F.col("one.s_lon")).alias("known"))
    best = F.min("known").over(Window.partitionBy("latitude", "longitude"))
    return seen.withColumn("best", best).where(F.col("bound") <= F.col("best") + SLACK_KM).select("latitude", "longitude", "cell")


def nearest_site(points: DataFrame, sites: DataFrame, point_id: str = "ponto_id", site_id: str = "local_id") -> DataFrame:
    """The nearest site of each point by great-circle distance; ties go to the smaller id.

    Both inputs carry `latitude` and `longitude`. Equal coordinates are merged
    first, so a crowd at one place counts once. The search goes down a grid: of
    every cell that holds sites one site is known, whose distance bounds the
    nearest one from above, and the cell's place bounds it from below. At each
    step a place keeps the cells that can still win and meets their children.
    So it meets a strip of cells at its nearest distance, however many sites
    crowd behind it, and all bounds are exact at the poles and the date line too.
    """
    places = points.select("latitude", "longitude").where("latitude IS NOT NULL AND longitude IS NOT NULL").distinct()
    site_places = (
        sites.where("latitude IS NOT NULL AND longitude IS NOT NULL")
        .groupBy(F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon"))
        .agg(F.min(site_id).alias(site_id))
    )
    # At most 32 rows.
    top = [(r["cell"], (r["one"]["s_lat"], r["one"]["s_lon"])) for r in _site_cells(site_places, FIRST_LEVEL, None).collect()]
    whole = F.array(*[F.struct(F.lit(c).cast("long").alias("cell"), F.struct(F.lit(a).alias("s_lat"), F.lit(b).alias("s_lon")).alias("one")) for c, (a, b) in top])
    cells = places.select("latitude", "longitude", F.explode(whole if top else F.array().cast("array<struct<cell:bigint,one:struct<s_lat:double,s_lon:double>>>")).alias("c"))
    cells = _nearest_cells(cells.select("latitude", "longitude", "c.cell", "c.one"), FIRST_LEVEL)
    for level in range(FIRST_LEVEL + STEP, FINEST_LEVEL + 1, STEP):
        children = _site_cells(site_places, level, level - STEP)
        met = cells.withColumnRenamed("cell", "parent").join(children, "parent")
        cells = _nearest_cells(met.select("latitude", "longitude", "cell", "one"), level)
    located = site_places.withColumn("cell", _cell_at(FINEST_LEVEL, F.col("s_lat"), F.col("s_lon")))
    distance = haversine_km(F.col("latitude"), F.col("longitude"), F.col("s_lat"), F.col("s_lon"))
    nearest = (
        cells.join(located, "cell")
        .groupBy("latitude", "longitude")
        .agg(F.min(F.struct(distance.alias("distancia_km"), F.col(site_id))).alias("best"))
    )
    return points.join(nearest, ["latitude", "longitude"], "left").select(
        point_id, F.col(f"best.{site_id}").alias(site_id), F.col("best.distancia_km").alias("distancia_km")
    )
