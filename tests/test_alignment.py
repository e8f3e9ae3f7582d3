"""How pages lie on their templates, and kernels over crops, on closed cases."""

import numpy as np
from foliant.functions import geometry as g
from foliant.functions import kernels as k
from foliant.operators import alignment, images
from pyspark.sql import functions as F

MATCH = "page int, position int, found boolean, shift_x double, shift_y double, center_x double, center_y double"


def test_transformations(spark):
    rows = [
        (1, 1, True, 2.0, 3.0, 0.0, 0.0), (1, 2, True, 4.0, 3.0, 100.0, 0.0), (1, 3, False, 99.0, 99.0, 500.0, 500.0), (1, 4, True, None, 1.0, 900.0, 1.0),
        (2, 1, True, 5.0, 5.0, 10.0, 10.0), (3, 1, True, 5.0, 5.0, 10.0, 10.0), (3, 2, True, 6.0, 5.0, 10.0, 10.0), (4, 1, None, 1.0, 1.0, 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, MATCH)
    got = {r.page: r for r in alignment.transformations(df, ["page"]).collect()}
    assert (got[1].scale, got[1].shift_x, got[1].shift_y, got[1].degrees, got[1].n_matched) == (1.02, 2.0, 3.0, 0.0, 2)
    assert all((got[p].scale, got[p].shift_x, got[p].degrees) == (1.0, 0.0, 0.0) for p in (2, 3, 4))
    extra = {r.page: r for r in alignment.extra_shifts(df, ["page"], 2).collect()}
    assert (extra[1].aligned, extra[1].most_x, extra[1].least_y) == (True, 4.0, 1.0) and not extra[2].aligned and (extra[4].aligned, extra[4].most_x) == (False, 0.0)
    at = df.limit(1).withColumns({"scale": F.lit(2.0), "degrees": F.lit(0.0), "reference_x": F.lit(0.0), "reference_y": F.lit(0.0)})
    corners = at.select(alignment.moved(g.box(*map(F.lit, (0, 0, 10, 10)))).alias("q")).first().q
    assert [(p.x, p.y) for p in corners] == [(-3.0, -2.0), (17.0, -2.0), (17.0, 18.0), (-3.0, 18.0)]
    assert alignment.transformations(df.limit(0), ["page"]).collect() == []


def test_close_boxes(spark):
    one = spark.range(1)
    b = one.select(alignment.close_box(g.box(*map(F.lit, (0, 0, 10, 10))), F.lit(0.5), [(F.lit(3.0), F.lit(-2.0)), (F.lit(-1.0), F.lit(4.0))]).alias("b")).first().b
    assert tuple(b) == (-1.0, -2.0, 13.0, 14.0)
    quad = lambda *pts: F.array(*(g.point(F.lit(x), F.lit(y)) for x, y in pts))
    q = one.select(alignment.close_quad(quad((0, 0), (10, 0), (10, 10), (0, 10)), F.lit(2.0), F.lit(1.0), F.lit(-1.0)).alias("q")).first().q
    assert [(p.x, p.y) for p in q] == [(-5.0, -6.0), (16.0, -6.0), (16.0, 15.0), (-5.0, 15.0)]
    flat = one.select(alignment.close_quad(quad((1, 1), (1, 1), (1, 1), (1, 1)), F.lit(2.0), F.lit(1.0), F.lit(1.0)).alias("q")).first().q
    assert {(p.x, p.y) for p in flat} == {(1.0, 1.0)}


def test_crops():
    a = np.arange(64, dtype=np.uint8).reshape(8, 8)
    quad = [(1, 2), (5, 2), (5, 6), (1, 6)]
    assert (k.crop_warped(a, quad, (5, 5)) == a[2:7, 1:6]).all()
    turned = k.crop_warped(a, [(5, 2), (5, 6), (1, 6), (1, 2)], (5, 5))
    assert (turned == np.rot90(a[2:7, 1:6])).all()
    assert (k.crop_masked(a, quad) == a[2:6, 1:5]).all() and k.crop_masked(np.ones((8, 8, 3), np.uint8), [(0, 0), (7, 0), (0, 7)])[6, 6].sum() == 0


def test_regions_and_votes(spark):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 256, (16, 16)).astype(np.uint8) for _ in range(2))
    kind = "page int, n int, height int, width int, n_channels int, data binary, t_height int, t_width int, t_data binary"
    same, other = (16, 16, 1, a.tobytes(), 16, 16, a.tobytes()), (16, 16, 1, a.tobytes(), 16, 16, b.tobytes())
    rows = [(1, 1, *same), (1, 2, *same), (1, 3, *same), (1, 4, *other), (2, 1, *other), (2, 2, *same[:4], 16, 16, None), (2, 3, None, None, None, None, 16, 16, a.tobytes()), (2, 4, *same[:4], 8, 32, a.tobytes())]
    df = spark.createDataFrame(rows, kind)
    got = {(r.page, r.n): r for r in images.compared(df, ["page", "n"]).collect()}
    assert got[1, 1].ncc == 1.0 and got[1, 1].decision and got[1, 1].n_passed == 5 and not got[1, 4].decision and all(got[2, n].decision is None for n in (2, 3, 4))
    votes = {r.page: (r.n_regions, r.n_votes, r.accepted) for r in alignment.page_votes(images.compared(df, ["page", "n"]), ["page"]).collect()}
    assert votes == {1: (4, 3, True), 2: (4, 0, False)}
    found = images.located(spark.createDataFrame([(1, 1, *same[:4], 4, 4, a[5:9, 6:10].tobytes()), (1, 2, *same[:4], 99, 1, b"x" * 99)], kind), ["n"]).collect()
    assert (found[0].found, found[0].x, found[0].y) == (True, 6, 5) and found[1].found is False
    assert images.compared(df.limit(0), ["n"]).collect() == []
