"""Nearest-place join on the sphere.

Points and places are laid on nested latitude/longitude grids. A pair of cells, one with points and one with places,
stays if the place cell may hold the nearest place of a point of the other: a bound on that distance
follows from one place per occupied cell. A cell whose points still face more places than one split of a
place cell makes children is heavy: it and the place cells it faces are split on the next grid, it alone, until its points
face few places or cells are down to the width of the rounding. So dense regions are refined as deep as their work
asks for, and the others are done on the first grid. Last, the points meet the places of the cells that are left. A place cell
that many points face is dealt in tiles by a hash of the point, so that no task gets more than its share of pairs.
Every step is an equi-join on cell numbers. The first grid has a fixed number of cells, whatever the data.

Distances are chords of the unit sphere until the last step. Chord and
great-circle distance order places the same way, and chords obey the triangle
inequality, on which the bounds rest.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cantogram.session import checkpoint_dir

EARTH_RADIUS_KM = 6371.0088
GRID_DEGREES = (10.0, 1.0)
# The finest grid that is added: its cell numbers still fit 64 bits, and its cells are about a centimetre wide.
FINEST_DEGREES = 1e-7
# Room in the bounds for rounding and for distances that tie, in chord units (about 6 mm).
_SLACK = 1e-9
# Distances are compared to the millimetre, so equal distances tie.
_KM_DIGITS = 6


def unit_vector(lat: Column, lon: Column) -> list[Column]:
    """Cartesian coordinates on the unit sphere."""
    phi, lam = F.radians(lat), F.radians(lon)
    return [F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)]


def chord(a: Sequence[Column], b: Sequence[Column]) -> Column:
    (ax, ay, az), (bx, by, bz) = a, b
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by) + (az - bz) * (az - bz))


def chord_km(length: Column) -> Column:
    """Great-circle kilometres of a chord."""
    half = F.least(length / 2, F.lit(1.0))
    return F.round(2 * EARTH_RADIUS_KM * F.asin(half), _KM_DIGITS)


def _grid(degrees: float) -> tuple[int, int]:
    rows = round(180 / degrees)
    if abs(rows * degrees - 180) > 1e-9:
        raise ValueError(f"grid step {degrees} does not divide 180")
    return rows, 2 * rows


def _finest(grids: Sequence[float]) -> int:
    """Rows of the finest grid that may follow ``grids``, which all of them nest in."""
    rows = _grid(grids[-1])[0]
    while 180 / (rows * 10) >= FINEST_DEGREES * 0.99:
        rows *= 10
    return rows


def _cell(degrees: float, finest: int) -> Column:
    """Number of the grid cell of (lat, lon), row by row from the south.

    Cells of all grids are made of whole cells of the finest one, so that rounding never puts a coordinate outside the
    cell around its cell.
    """
    rows, columns = _grid(degrees)
    row = F.least(F.floor((F.col("lat") + 90) / 180 * finest), F.lit(finest - 1))
    column = F.pmod(F.floor((F.col("lon") + 180) / 180 * finest), F.lit(2 * finest))
    inside = finest // rows
    return (F.floor(row / inside) * columns + F.floor(column / inside)).cast("long")


def _centre(cell: Column, degrees: float) -> tuple[Column, Column]:
    _, columns = _grid(degrees)
    row, column = F.floor(cell / columns), F.pmod(cell, F.lit(columns))
    return (row + 0.5) * degrees - 90, (column + 0.5) * degrees - 180


def _radius(lat: Column, degrees: float) -> Column:
    """Largest chord from a cell's centre to a point of the cell.

    It is reached at a corner: on the edge nearer the equator, where the cell is
    widest, or on the other one.
    """
    zero, side = F.lit(0.0), F.lit(degrees / 2)
    here = unit_vector(lat, zero)
    corners = [unit_vector(lat + sign * degrees / 2, side) for sign in (-1, 1)]
    return F.greatest(*(chord(here, corner) for corner in corners))


def _cells(df: DataFrame, degrees: float, cell: str) -> DataFrame:
    """Add centre vector and radius of a cell column."""
    lat, lon = _centre(F.col(cell), degrees)
    x, y, z = unit_vector(lat, lon)
    return df.select(
        "*",
        F.struct(x.alias("x"), y.alias("y"), z.alias("z")).alias(f"{cell}_at"),
        _radius(lat, degrees).alias(f"{cell}_radius"),
    )


def _xyz(column: str) -> list[Column]:
    return [F.col(column).getField(axis) for axis in "xyz"]


def _vector(lat: Column, lon: Column) -> Column:
    x, y, z = unit_vector(lat, lon)
    return F.struct(x.alias("x"), y.alias("y"), z.alias("z"))


def _parent(cell: str, fine: float, coarse: float) -> Column:
    """Number of the coarse cell around a fine one."""
    (_, columns), (_, wide) = _grid(fine), _grid(coarse)
    ratio = columns // wide
    row, column = F.floor(F.col(cell) / columns), F.pmod(F.col(cell), F.lit(columns))
    return (F.floor(row / ratio) * wide + F.floor(column / ratio)).cast("long")


def _pruned(pairs: DataFrame) -> DataFrame:
    """Keep, per point cell ``a``, the place cells ``b`` that may hold the nearest place."""
    reach = chord(_xyz("a_at"), _xyz("place_at")) + F.col("a_radius")
    gap = chord(_xyz("a_at"), _xyz("b_at")) - F.col("a_radius") - F.col("b_radius")
    measured = pairs.select("a", "b", "n_a", "n_b", reach.alias("reach"), gap.alias("gap"))
    bounds = measured.groupBy("a").agg(F.min("reach").alias("bound"))
    kept = measured.join(bounds, "a").filter(F.col("gap") <= F.col("bound") + _SLACK)
    return kept.select("a", "b", "n_a", "n_b")


def _level(points: DataFrame, places: DataFrame, degrees: float, finest: int) -> tuple[DataFrame, DataFrame]:
    """The cells of one grid that hold points, and those that hold places, with their counts, centres and radii."""
    cell = _cell(degrees, finest)
    a = points.groupBy(cell.alias("a")).agg(F.count(F.lit(1)).alias("n_a"))
    b = places.groupBy(cell.alias("b")).agg(
        F.min(F.struct("lat", "lon")).alias("sample"), F.count(F.lit(1)).alias("n_b")
    )
    spot = _vector(F.col("sample.lat"), F.col("sample.lon")).alias("place_at")
    return _cells(a, degrees, "a"), _cells(b.select("b", "n_b", spot), degrees, "b")


def _inside(df: DataFrame, cells: DataFrame, at: Column, cell: str) -> DataFrame:
    """The rows of ``df`` whose cell is among ``cells``."""
    return df.withColumn("_cell", at).join(cells.select(F.col(cell).alias("_cell")).distinct(), "_cell", "left_semi").drop("_cell")


def candidate_pairs(
    points: DataFrame, places: DataFrame, grids: Sequence[float] = GRID_DEGREES
) -> list[tuple[float, DataFrame]]:
    """For each grid that has any: its step and the pairs (a, b, n_a, n_b) of point and place cells to be measured.

    ``points`` and ``places`` hold distinct coordinates. Each point lies in a cell ``a`` of one of the grids. Past the
    last of ``grids`` tenfold finer ones follow for cells that are still heavy.
    """
    steps, out, heavy, above, finest = list(grids), [], None, None, _finest(grids)
    while steps:
        degrees = steps.pop(0)
        finer = steps[0] if steps else degrees / 10
        a, b = _level(points, places, degrees, finest)
        if heavy is None:
            # Every cell number of the first grid: a fixed fan-out, then an equi-join.
            rows, columns = _grid(degrees)
            everywhere = F.sequence(F.lit(0), F.lit(rows * columns - 1)).cast("array<long>")
            pairs = a.withColumn("b", F.explode(everywhere)).join(b, "b")
        else:
            a = a.withColumn("a_above", _parent("a", degrees, above))
            b = b.withColumn("b_above", _parent("b", degrees, above))
            wider = heavy.select(F.col("a").alias("a_above"), F.col("b").alias("b_above"))
            pairs = a.join(wider, "a_above").join(b, "b_above")
        kept = _pruned(pairs).checkpoint()
        # A split gives a place cell so many children: no more places than that are met as they are.
        children = round(degrees / finer) ** 2
        loads = kept.groupBy("a").agg(F.sum("n_b").alias("load")).filter(F.col("load") > children)
        if finer < FINEST_DEGREES * 0.99 or loads.isEmpty():
            out.append((degrees, kept))
            break
        heavy = kept.join(loads, "a", "left_semi")
        out.append((degrees, kept.join(loads, "a", "left_anti")))
        cell = _cell(degrees, finest)
        points, places = _inside(points, heavy, cell, "a"), _inside(places, heavy, cell, "b")
        above = degrees
        if not steps:
            steps.append(finer)
    return out


def _met(points: DataFrame, places: DataFrame, cell: Column, pairs: DataFrame, tasks: int) -> DataFrame:
    """Each point beside the places it faces: (lat, lon, to_lat, to_lon, place).

    A place cell whose pairs are more than a task's share of all is dealt in tiles by the point.
    """
    work = pairs.groupBy("b").agg(F.sum(F.col("n_a") * F.col("n_b")).alias("work"))
    share = pairs.agg(F.sum(F.col("n_a") * F.col("n_b")) / tasks).scalar()
    tiles = work.select("b", F.ceil(F.col("work") / share).cast("int").alias("tiles"))
    own = F.pmod(F.xxhash64("lat", "lon"), F.col("tiles")).cast("int")
    spots = points.select(cell.alias("a"), "lat", "lon").join(pairs.select("a", "b").join(tiles, "b"), "a")
    sites = places.select(cell.alias("b"), F.col("lat").alias("to_lat"), F.col("lon").alias("to_lon"), "place").join(tiles, "b")
    dealt = sites.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles")
    return spots.withColumn("tile", own).drop("tiles").join(dealt, ["b", "tile"]).drop("a", "b", "tile")


def _located(df: DataFrame) -> DataFrame:
    """The rows with coordinates, as doubles; impossible ones raise."""
    rows = df.withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})
    known = rows.filter("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    possible = (F.abs("lat") <= 90) & (F.abs("lon") < float("inf"))
    failure = F.raise_error(F.concat_ws(" ", F.lit("no such coordinate:"), "lat", "lon"))
    return known.withColumn("lat", F.when(possible, F.col("lat")).otherwise(failure.cast("double")))


def nearest_join(
    points: DataFrame,
    places: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    grids: Sequence[float] = GRID_DEGREES,
) -> DataFrame:
    """Each point with its nearest place: ``place_id``, ``cc``, ``distance_km``.

    Of places at the same distance the smallest ``place_id`` wins; a point without
    coordinates (null or NaN) gets nulls, and such a place is nobody's nearest. A latitude beyond 90
    degrees and an infinite longitude raise. ``places`` has place_id, lat, lon, cc. Each distinct
    coordinate is looked up once, and places that share a coordinate count once,
    so copies on either side add no pairs. ``grids`` runs from coarse to fine; the later ones, and
    finer ones after them, are used where a cell's points face many places. Distinct coordinates and cell pairs are
    checkpointed, so that the inputs are read once.
    """
    rows = [_grid(degrees)[0] for degrees in grids]
    if any(fine % coarse for coarse, fine in zip(rows, rows[1:])):
        raise ValueError("each grid step must divide the one before it")
    checkpoint_dir(points.sparkSession)
    spots = (
        _located(points.select(F.col(lat).alias("lat"), F.col(lon).alias("lon")))
        .distinct()
        .checkpoint()
    )
    sites = (
        _located(places).groupBy("lat", "lon")
        .agg(F.min(F.struct("place_id", "cc")).alias("place"))
        .checkpoint()
    )
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = [_met(spots, sites, _cell(degrees, _finest(grids)), pairs, tasks) for degrees, pairs in candidate_pairs(spots, sites, grids)]
    length = chord(
        unit_vector(F.col("lat"), F.col("lon")), unit_vector(F.col("to_lat"), F.col("to_lon"))
    )
    best = reduce(DataFrame.unionByName, met).groupBy("lat", "lon").agg(
        F.min(F.struct(chord_km(length).alias("distance_km"), "place")).alias("best")
    )
    answer = best.select(
        F.col("lat").alias("_lat"),
        F.col("lon").alias("_lon"),
        F.col("best.place.place_id").alias("place_id"),
        F.col("best.place.cc").alias("cc"),
        F.col("best.distance_km").alias("distance_km"),
    )
    same = (F.col(lat).cast("double") == F.col("_lat")) & (
        F.col(lon).cast("double") == F.col("_lon")
    )
    return points.join(answer, same, "left").drop("_lat", "_lon")
