import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from stratakit.operators import spatial as S

W = (165.0, -48.0, 179.0, -33.0)


def test_near_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    lat = np.concatenate([-41 + rng.random(300) * 0.01, np.full(20, -41.0), [-33.0, -48.0, -40.0]])
    lon = np.concatenate([174 + rng.random(300) * 0.01, np.full(20, 174.0), [165.0, 179.0, 180.0]])
    ids = np.concatenate([np.arange(310), np.arange(13)])
    df = spark.createDataFrame(pd.DataFrame({"nzgd_id": ids, "latitude": lat, "longitude": lon, "site": 5, "leaf": 6}))
    df = df.unionByName(df.limit(40)).unionByName(spark.createDataFrame([(900, None, 174.0, 1, 1), (None, -41.0, 174.0, 1, 1), (901, float("nan"), 174.0, 1, 1)], df.schema))
    got = {tuple(r) for r in S.near_records(S.usable_positions(df, W), W, 30.0).collect()}
    want = set()
    ok = (lon >= 165) & (lon <= 179)
    for i in np.flatnonzero(ok):
        d = S.great_circle(lon[i], lat[i], lon[ok], lat[ok])
        want |= {(min(ids[i], j), max(ids[i], j)) for j in ids[ok][d <= 30] if j != ids[i]}
    assert got == {(int(a), int(b)) for a, b in want} and len(got) > 200
    counts = S.near_counts(S.usable_positions(df, W), W, 30.0).toPandas()
    assert counts["n_near"].max() >= 20
    none = S.usable_positions(df.limit(0), W)
    assert S.near_records(none, W, 30.0).count() == 0


@given(st.lists(st.tuples(st.floats(0, 10), st.floats(0, 10)), min_size=1, max_size=80))
@settings(max_examples=50, deadline=None)
def test_rtree_finds_all_overlaps(points):
    p = np.array(points)
    boxes = np.column_stack([p, p + 0.5])
    who, entry = S.RTree(boxes).probe(boxes)
    a, b = boxes[:, None, :], boxes[None, :, :]
    hit = (a[..., 0] <= b[..., 2]) & (a[..., 2] >= b[..., 0]) & (a[..., 1] <= b[..., 3]) & (a[..., 3] >= b[..., 1])
    assert set(zip(who, entry)) == set(zip(*np.nonzero(hit)))


def test_quadtree_leaves_tile_the_window():
    rng = np.random.default_rng(1)
    x, y = 170 + rng.random(2000), -41 + rng.random(2000) ** 3
    tree = S.Quadtree(x, y, W, 0.001, 50)
    leaf, boxes = tree.leaf(x, y), tree.boxes()
    assert np.all((boxes[leaf, 0] <= x) & (x <= boxes[leaf, 2]) & (boxes[leaf, 1] <= y) & (y <= boxes[leaf, 3]))
    assert np.isclose(((boxes[:, 2] - boxes[:, 0]) ** 2).sum(), 15.0**2)


def test_regions_with_holes(spark):
    areas = spark.createDataFrame(
        [(1, "POLYGON ((170 -40, 171 -40, 171 -39, 170 -39, 170 -40), (170.4 -39.6, 170.6 -39.6, 170.6 -39.4, 170.4 -39.4, 170.4 -39.6))"), (2, "MULTIPOLYGON (((172 -40, 173 -40, 173 -39, 172 -40)), ((170.45 -39.55, 170.55 -39.55, 170.55 -39.45, 170.45 -39.55)))"), (3, None), (None, "POLYGON ((0 0, 1 0, 1 1, 0 0))"), (4, "POLYGON EMPTY")],
        "region int, wkt string",
    )
    rows = [(1, -39.9, 170.1, 1), (2, -39.58, 170.42, 1), (3, -39.5, 170.52, None), (4, -39.9, 172.9, 9), (5, -45.0, 166.0, None), (5, -45.0, 166.0, None)]
    df = spark.createDataFrame(rows, "nzgd_id int, latitude double, longitude double, district_id int")
    pos = S.usable_positions(df, W)
    got = {tuple(r) for r in S.misplaced(df, pos, S.containing_regions(pos, areas, W)).collect()}
    assert got == {(3, 2), (4, 2)}
    assert S.containing_regions(pos, areas.limit(0), W).count() == 0
