"""Observations joined to the stations of the same city or nearby."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake.constants import COORDINATE_TOLERANCE
from climate_lake.functions.columns import with_optional
from climate_lake.functions.joins import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    ROWS_PER_SPLIT,
    fits_broadcast,
    key_counts,
    lookup_join,
    salted_join,
)
from climate_lake.schemas import STATION_ATTRIBUTES
from climate_lake.session import materialise

# Cells a little wider than the tolerance: two coordinates closer than the
# tolerance lie in the same or in adjacent cells, rounding included.
CELL = COORDINATE_TOLERANCE * 1.1
# A station is listed in its own cell and the eight around it.
CELL_COPIES = 9
LOCATION = ["city_name", "latitude", "longitude"]
# Stations of one location up to which joined rows are left in the tasks that read the observations.
IN_PLACE_COPIES = 4


def _cell(coordinate: str) -> Column:
    return F.rint(F.col(coordinate) / CELL)


def _nearby_cells(coordinate: str) -> Column:
    cell = _cell(coordinate)
    return F.array_distinct(F.array(cell - 1, cell, cell + 1))


def without_stations(observations: DataFrame) -> DataFrame:
    """The joined layout when no station table can be read."""
    return with_optional(observations, STATION_ATTRIBUTES)


def station_matches(
    locations: DataFrame,
    stations: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Station attributes per distinct location, one row per matching station.

    A station matches by city name, or if both coordinates are closer than the
    tolerance. Both legs are equi-joins: the proximity leg joins grid cells,
    with the exact test on top, and leaves out the pairs the city leg has
    found, so a station that matches both ways appears once and duplicate
    station rows stay apart without any de-duplication.
    """
    slim = stations.select(
        F.col("city").alias("station_city"),
        F.col("latitude").alias("station_latitude"),
        F.col("longitude").alias("station_longitude"),
        *STATION_ATTRIBUTES,
    )

    few = fits_broadcast(slim, broadcast_rows // CELL_COPIES, BROADCAST_BYTES // CELL_COPIES)

    def matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        if few:
            return lookup_join(left, right, keys)
        return salted_join(left, right, keys, rows_per_split=rows_per_split)

    named = locations.withColumn("station_city", F.col("city_name"))
    same_city = matched(named, slim.filter(F.col("station_city").isNotNull()), ["station_city"])
    spread = slim.withColumn("lat_cell", F.explode(_nearby_cells("station_latitude"))).withColumn(
        "lon_cell", F.explode(_nearby_cells("station_longitude"))
    )
    celled = locations.withColumns({"lat_cell": _cell("latitude"), "lon_cell": _cell("longitude")})
    close = (F.abs(F.col("latitude") - F.col("station_latitude")) < COORDINATE_TOLERANCE) & (
        F.abs(F.col("longitude") - F.col("station_longitude")) < COORDINATE_TOLERANCE
    )
    found_by_city = F.coalesce(F.col("city_name") == F.col("station_city"), F.lit(False))
    nearby = matched(celled, spread, ["lat_cell", "lon_cell"]).filter(close & ~found_by_city)

    wanted = [*LOCATION, *STATION_ATTRIBUTES]
    return same_city.select(*wanted).unionByName(nearby.select(*wanted))


def integrate_stations(
    observations: DataFrame,
    stations: DataFrame | None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Left join of observations to stations by city or proximity.

    Every matching station gives a row (duplicate stations included), an
    observation without match keeps one row with NULL attributes.

    Stations are matched to the distinct locations, a narrow scan that mostly
    collapses before its shuffle; it is written out because both legs of the
    match read it. The same scan counts the observations of each location, from
    which a shuffled join knows the hot ones without another pass. The matches
    are written out, too, so that their size is known: usually they are
    broadcast and the observations are not shuffled, too many of them are
    joined by a salted shuffle.
    """
    return integrate_in_place(observations, stations, broadcast_rows, rows_per_split)[0]


def integrate_in_place(
    observations: DataFrame,
    stations: DataFrame | None,
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> tuple[DataFrame, bool]:
    """``integrate_stations``, and whether its rows stay where the observations are.

    They do if the observations are not shuffled and no location has so many
    stations that a task would give many times the rows that it reads.
    """
    if stations is None:
        return without_stations(observations), True
    locations = materialise(key_counts(observations, LOCATION), "locations")
    places = locations.select(*LOCATION)
    matches = materialise(station_matches(places, stations, broadcast_rows, rows_per_split), "station-matches")
    if not fits_broadcast(matches, broadcast_rows):
        joined = salted_join(observations, matches, LOCATION, "left", True, rows_per_split, left_counts=locations)
        return joined, False
    most = key_counts(matches, LOCATION).agg(F.max("rows").alias("rows")).first()["rows"] or 0
    return lookup_join(observations, matches, LOCATION, "left", True), most <= IN_PLACE_COPIES
