import math
import random

import pytest

from cantogram.operators.nearest import EARTH_RADIUS_KM, nearest_join

PLACES = "place_id long, lat double, lon double, cc string"


def km(a, b):
    def vector(lat, lon):
        p, q = math.radians(lat), math.radians(lon)
        return math.cos(p) * math.cos(q), math.cos(p) * math.sin(q), math.sin(p)

    chord = math.dist(vector(*a), vector(*b))
    return round(2 * EARTH_RADIUS_KM * math.asin(min(1.0, chord / 2)), 6)


def brute(points, places):
    return {
        p: min((km(p, (lat, lon)), pid, cc) for pid, lat, lon, cc in places) for p in set(points)
    }


def check(spark, points, places, **grids):
    df = spark.createDataFrame(points, "lat double, lon double")
    got = nearest_join(df, spark.createDataFrame(places, PLACES), **grids).collect()
    assert len(got) == len(points)
    want = brute(points, places)
    for r in got:
        distance, pid, cc = want[r.lat, r.lon]
        assert r.distance_km == pytest.approx(distance, abs=1e-5), (r, distance)
        assert (r.place_id, r.cc) == (pid, cc), (r, want[r.lat, r.lon])


def sphere(rng):
    return math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)


@pytest.mark.parametrize("seed,n_points,n_places", [(1, 300, 200), (2, 200, 3), (3, 50, 1500)])
def test_random_points_equal_brute_force(spark, seed, n_points, n_places):
    rng = random.Random(seed)
    places = [(i, *sphere(rng), f"c{i % 9}") for i in range(n_places)]
    check(spark, [sphere(rng) for _ in range(n_points)], places)


def test_clustered_places_and_far_points(spark):
    rng = random.Random(5)
    places = [(i, 48 + rng.uniform(0, 3), 2 + rng.uniform(0, 3), "FR") for i in range(400)]
    points = [sphere(rng) for _ in range(100)] + [(48.5, 2.5), (-48.5, -177.5)]
    check(spark, points, places)


def test_poles_date_line_and_whole_degrees(spark):
    places = [
        (1, 89.9, 10.0, "N"), (2, -89.9, -170.0, "S"), (3, 0.0, 179.9, "W"), (4, 0.0, -179.9, "E"),
        (5, 90.0, 0.0, "P"),
    ]
    points = [
        (90.0, 0.0), (90.0, 123.0), (89.0, -170.0), (-90.0, 0.0), (0.0, 180.0), (1.0, -180.0),
        (0.0, 179.0), (5.0, -179.95), (45.0, 45.0), (-45.0, 180.0),
    ]
    check(spark, points, places)


@pytest.mark.parametrize("grids", [(30.0,), (45.0, 5.0, 1.0), (10.0, 1.0, 0.25)])
def test_any_grids_give_the_same_answer(spark, grids):
    rng = random.Random(11)
    places = [(i, *sphere(rng), "x") for i in range(120)]
    check(spark, [sphere(rng) for _ in range(80)], places, grids=grids)


def pairs_met(spark, points, places):
    """Steps of the grids that are used, and the point-place pairs that are measured in the end."""
    from cantogram.operators.nearest import candidate_pairs

    found = candidate_pairs(spark.createDataFrame(points, "lat double, lon double"), spark.createDataFrame(places, PLACES))
    return [step for step, _ in found], sum(df.selectExpr("sum(n_a * n_b)").first()[0] or 0 for _, df in found)


def test_dense_cells_are_split_and_others_are_not(spark):
    rng = random.Random(17)

    def near(n):
        return [(48.2 + rng.gauss(0, 0.05), 2.3 + rng.gauss(0, 0.05)) for _ in range(n)]

    places = [(i, *at, "FR") for i, at in enumerate(near(1500))] + [(9999, -40.0, 170.0, "NZ")]
    points = near(800) + [(-40 + rng.random(), 170 + rng.random()) for _ in range(20)]
    steps, met = pairs_met(spark, points, places)
    assert steps[0] == 10.0 and steps[-1] < 1 and met < 40 * len(points)
    check(spark, points, places)
    assert pairs_met(spark, points[-20:], places) == ([10.0], 20)


def test_equal_distances_and_copies_go_to_the_smallest_id(spark):
    places = [(9, 0.0, 1.0, "b"), (4, 0.0, -1.0, "a"), (7, 0.0, 1.0, "c"), (5, 0.0, -1.0, "d")]
    got = nearest_join(
        spark.createDataFrame([(0.0, 0.0), (0.0, 0.5), (0.0, 0.0)], "lat double, lon double"),
        spark.createDataFrame(places, PLACES),
    ).collect()
    assert sorted((r.lon, r.place_id) for r in got) == [(0.0, 4), (0.0, 4), (0.5, 7)]


def test_missing_coordinates_and_empty_places(spark):
    points = spark.createDataFrame([(None, 1.0, "k"), (1.0, 1.0, "l")], "lat double, lon double, k string")
    got = nearest_join(points, spark.createDataFrame([(1, 2.0, 2.0, "x")], PLACES)).collect()
    assert {r.k: r.place_id for r in got} == {"k": None, "l": 1}
    none = nearest_join(points, spark.createDataFrame([], PLACES)).collect()
    assert [r.place_id for r in none] == [None, None]


def test_nan_is_missing_and_impossible_coordinates_raise(spark):
    nan = float("nan")
    points = spark.createDataFrame([(nan, nan, "k"), (1.0, nan, "m"), (1.0, 1.0, "l")], "lat double, lon double, k string")
    places = spark.createDataFrame([(1, nan, 1.0, "x"), (2, None, 1.0, "x"), (3, 2.0, 2.0, "x")], PLACES)
    assert {r.k: r.place_id for r in nearest_join(points, places).collect()} == {"k": None, "m": None, "l": 3}
    with pytest.raises(Exception, match="no such coordinate"):
        nearest_join(spark.createDataFrame([(95.0, 0.0)], "lat double, lon double"), places).collect()


def test_far_points_and_places_in_one_cell(spark):
    """5000 points face 5000 places a quarter of the globe away: 25 million pairs if they met as they are."""
    rng = random.Random(23)
    places = [(i, 40 + rng.random(), 90 + rng.random(), "x") for i in range(5000)]
    points = [(10 + rng.random(), rng.random()) for _ in range(5000)]
    steps, met = pairs_met(spark, points, places)
    assert met <= 40 * len(points), (steps, met / len(points))
    some = points[:60]
    got = nearest_join(spark.createDataFrame(points, "lat double, lon double"), spark.createDataFrame(places, PLACES)).collect()
    found, want = {(r.lat, r.lon): r.place_id for r in got}, brute(some, places)
    assert {p: found[p] for p in some} == {p: want[p][1] for p in some}


def test_points_all_over_meet_few_places_of_one_dense_cell(spark):
    rng = random.Random(23)
    places = [(i, 48 + rng.random(), 2 + rng.random(), "FR") for i in range(400)]
    points = [sphere(rng) for _ in range(200)]
    steps, _ = pairs_met(spark, points, places)
    assert steps[-1] < 1
    check(spark, points, places)


def test_places_that_no_grid_parts(spark):
    """Coordinates within a millimetre of one another stay together on the finest grid and are dealt in tiles."""
    places = [(1000 - i, 10 + i * 1e-13, 20.0, "x") for i in range(300)]
    points = [(10 + i * 1e-13, 20.0) for i in range(0, 300, 2)] + [(11.0, 20.0)]
    check(spark, points, places)


def test_grids_must_nest(spark):
    points = spark.createDataFrame([(1.0, 1.0)], "lat double, lon double")
    places = spark.createDataFrame([(1, 2.0, 2.0, "x")], PLACES)
    for grids in [(10.0, 3.0), (7.0, 1.0)]:
        with pytest.raises(ValueError):
            nearest_join(points, places, grids=grids)
