from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import geo
from pixelfold.functions import geometry as G
from pixelfold.operators import zonal
from pixelfold.operators.grid import Grid, coverage_cells, coverage_runs, join_runs, zone_cells, zone_extent, zone_runs

GRID = Grid(0, 0, 1, 1, 6, 6)
ALL = dict(
    square=geo.SQUARE, shifted=geo.HALF_SHIFTED, triangle=geo.TRIANGLE, hexagon=geo.HEXAGON, ell=geo.L_SHAPE,
    hole=geo.WITH_HOLE, tiny=geo.TINY, outside=geo.OUTSIDE,
)


def test_cells_match_point_in_polygon(spark, rows):
    got = rows(zone_cells(geo.layer(spark, **ALL), GRID, ["zone"]))
    want = sorted((k, r, c) for k, g in ALL.items() for r in range(6) for c in range(6) if geo.inside(g, c + 0.5, r + 0.5))
    assert got == want
    assert not [r for r in got if r[0] in ("tiny", "outside")]


def test_coverage_matches_clipping(spark):
    got = {(z, r, c): v for z, r, c, v in coverage_cells(geo.layer(spark, **ALL), GRID, ["zone"]).collect()}
    for k, g in ALL.items():
        for r in range(6):
            for c in range(6):
                assert got.get((k, r, c), 0.0) == pytest.approx(geo.cell_area(g, r, c), abs=1e-12)


def test_coverage_sums_to_area(spark):
    cov = coverage_cells(geo.layer(spark, **ALL), GRID, ["zone"]).groupBy("zone").agg(F.sum("coverage").alias("a"))
    for z, a in cov.collect():
        assert a == pytest.approx(geo.area(ALL[z]))


def test_north_up_grid(spark, rows):
    north = Grid(0, 6, 1, -1, 6, 6)
    z = geo.layer(spark, **ALL)
    plain = rows(zone_cells(z, GRID, ["zone"]).withColumn("row", 5 - F.col("row")))
    assert rows(zone_cells(z, north, ["zone"])) == plain
    cov = {(a, b, c): v for a, b, c, v in coverage_cells(z, north, ["zone"]).collect()}
    assert cov[("triangle", 5, 0)] == 1.0 and cov[("triangle", 5, 3)] == 0.5


def test_disjoint_tiling_counts_each_cell_once(spark):
    tiles = {f"t{i}{j}": [[(i * 1.7, j * 2.3), ((i + 1) * 1.7, j * 2.3), ((i + 1) * 1.7, (j + 1) * 2.3), (i * 1.7, (j + 1) * 2.3), (i * 1.7, j * 2.3)]] for i in range(4) for j in range(3)}
    cells = zone_cells(geo.layer(spark, **tiles), GRID, ["zone"])
    assert cells.count() == 36 and cells.select("row", "col").distinct().count() == 36


def test_later_zone_wins_and_label_is_one_of_the_overlapping(spark, rows):
    z = geo.layer(spark, a=geo.SQUARE, b=geo.HALF_SHIFTED, c=geo.TRIANGLE)
    both = rows(zonal.rasterize(z, GRID, "zone", overlap=True), "zone", "row", "col")
    one = rows(zonal.rasterize(z, GRID, "zone", "ord"), "zone", "row", "col")
    assert set(one) <= set(both)
    want = {}
    for k, r, c in both:
        want[(r, c)] = max(want.get((r, c), ""), k)
    assert one == sorted((k, r, c) for (r, c), k in want.items())


def test_extent_bounds_the_cells(spark):
    z = geo.layer(spark, **ALL)
    e = zone_extent(z, GRID)
    assert (e.row_min, e.row_max, e.col_min, e.col_max) == (0, 4, 0, 4)
    assert e.max_cells >= coverage_cells(z, GRID, ["zone"]).count()
    assert zone_extent(geo.layer(spark, o=geo.OUTSIDE), GRID).empty


def test_multipolygon_and_hole_text(spark):
    wkt = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0), (0.5 0.5, 1.5 0.5, 1.5 1.5, 0.5 1.5, 0.5 0.5)), ((4 4, 4 5, 5 5, 5 4, 4 4)))"
    df = spark.createDataFrame([(wkt,), ("POLYGON((0 0,4 0,0 4,0 0))",)], "wkt string").select(
        G.wkt_to_geom("wkt").alias("geom")
    )
    assert sorted(r[0] for r in df.select(G.area("geom")).collect()) == [4.0, 8.0]


def test_point_predicates(spark):
    z = geo.layer(spark, hole=geo.WITH_HOLE)
    p = lambda x, y, f: z.select(f(F.lit(x), F.lit(y), F.col("geom"))).first()[0]
    assert p(0.5, 0.5, G.point_in_polygon) and not p(2.5, 2.5, G.point_in_polygon)
    assert p(0.0, 0.0, G.point_in_polygon) and not p(5.0, 1.0, G.point_in_polygon)
    assert p(5.0, 1.0, G.covers_point) and p(1.5, 2.0, G.covers_point) and not p(6.0, 1.0, G.covers_point)


def wide_layer(spark):
    ring = [(round(300 + 250 * math.cos(a / 50 * math.pi), 3), round(40 + 35 * math.sin(a / 50 * math.pi), 3)) for a in range(100)]
    donut = [ring + ring[:1], [(200, 20), (200, 60), (400, 60), (400, 20), (200, 20)]]
    strip = [[(3, 10), (590, 10), (590, 12), (3, 12), (3, 10)]]
    return geo.layer(spark, donut=donut, strip=strip, edge=[[(-50, -50), (700, -50), (700, 5.5), (-50, 5.5), (-50, -50)]])


@pytest.mark.parametrize("shift", [0, 3, 6, 8])
def test_runs_hold_the_same_cells(spark, rows, shift):
    grid = Grid(0, 0, 1, 1, 600, 80)
    z = wide_layer(spark)
    every = spark.range(80).selectExpr("CAST(id AS int) AS row", "explode(sequence(0, 599)) AS col")
    got = join_runs(every, zone_runs(z, grid, ["zone"], shift), shift, ["zone"])
    assert rows(got, "zone", "row", "col") == rows(zone_cells(z, grid, ["zone"]), "zone", "row", "col")
    for window in (False, True):
        got = join_runs(every, coverage_runs(z, grid, ["zone"], shift, window), shift, ["zone", "coverage"])
        want = {r[:3]: r[3] for r in coverage_cells(z, grid, ["zone"], window).collect()}
        found = {r[:3]: r[3] for r in got.select("zone", "row", "col", "coverage").collect()}
        assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], abs=1e-12) for k in want)


def test_runs_follow_the_border_and_stay_below_their_bounds(spark):
    z = wide_layer(spark).where("zone = 'donut'")
    counts = []
    for k in (1, 4):
        grid = Grid(0, 0, 1 / k, 1 / k, 600 * k, 80 * k)
        e = zone_extent(z, grid)
        runs, covers = zone_runs(z, grid, ["zone"], e.shift).count(), coverage_runs(z, grid, ["zone"], e.shift).count()
        assert runs <= e.max_runs < e.max_cells and covers <= e.max_cover_runs <= e.max_cells
        counts.append((runs, covers, zone_cells(z, grid, ["zone"]).count()))
    # Four times finer: sixteen times the cells, hardly more than four times the runs.
    (a, b, c), (d, f, g) = counts
    assert g > 15 * c and d < 6 * a and f < 6 * b


def test_bounds_hold_for_every_shape(spark):
    for grid in (GRID, Grid(0, 6, 0.25, -0.5, 24, 12), Grid(1, 1, 0.5, 0.5, 3, 3)):
        for name, shape in ALL.items():
            z = geo.layer(spark, **{name: shape})
            e = zone_extent(z, grid)
            assert zone_runs(z, grid, ["zone"], e.shift).count() <= e.max_runs
            assert coverage_runs(z, grid, ["zone"], e.shift).count() <= e.max_cover_runs
