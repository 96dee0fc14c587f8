"""Points near other points, and regions around points.

A bounded sample of the sites shapes a quadtree whose leaves are the partitions. A site goes to the leaf it lies in and
is replicated to every leaf within the search distance. Each leaf bulk-loads an R-tree (sort-tile-recursive) and all
its probes descend together, level by level. Great-circle distances or even-odd tests settle the candidates. A pair is
reported only in the leaf of its reference point, the site with the smaller key, so none comes out twice.

Leaves with many sites are probed in blocks. Sites with equal coordinates are one site; their records are attached
again after the search.

Edge cases: records without a usable position take part in nothing; a record with several positions counts at each;
distances across the 180th meridian are not looked for; a point on a region's border belongs to at most one side.
"""

from __future__ import annotations

import re
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.session import cut

EARTH_RADIUS_M = 6_371_008.8
#: The sample that shapes the quadtree has at most about this many sites, and so many per leaf it aims at.
SAMPLE_SITES, SAMPLE_PER_LEAF = 20_000, 64
#: Fewest leaves the quadtree aims at; with more sites than fill these, a leaf is to hold ``BLOCK_PROBES``. Probes per block of a
#: crowded leaf.
TARGET_LEAVES, BLOCK_PROBES = 256, 50_000
NODE = 16


class Quadtree:
    """Square cells over a lon/lat window, kept as sorted intervals of a Z-order code."""

    def __init__(self, lon: np.ndarray, lat: np.ndarray, window: tuple[float, float, float, float], smallest: float, capacity: int) -> None:
        self.x0, self.y0, x1, y1 = window
        self.side = max(x1 - self.x0, y1 - self.y0)
        self.depth = int(max(0, min(20, np.floor(np.log2(self.side / smallest)))))
        codes = np.sort(self.code(lon, lat))
        starts: list[int] = []
        stack = [(0, self.depth)]
        while stack:
            start, level = stack.pop()
            span = 1 << (2 * level)
            inside = np.searchsorted(codes, start + span) - np.searchsorted(codes, start)
            if level and inside > capacity:
                stack += [(start + k * (span >> 2), level - 1) for k in range(4)]
            else:
                starts.append(start)
        self.starts = np.array(sorted(starts), dtype=np.int64)

    def code(self, lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
        cells = 1 << self.depth
        x = np.clip((np.asarray(lon) - self.x0) / self.side * cells, 0, cells - 1).astype(np.int64)
        y = np.clip((np.asarray(lat) - self.y0) / self.side * cells, 0, cells - 1).astype(np.int64)
        out = np.zeros_like(x)
        for bit in range(self.depth):
            out |= ((x >> bit) & 1) << (2 * bit) | ((y >> bit) & 1) << (2 * bit + 1)
        return out

    def leaf(self, lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, self.code(lon, lat), side="right") - 1

    def boxes(self) -> np.ndarray:
        """(min lon, min lat, max lon, max lat) of every leaf."""
        ends = np.append(self.starts[1:], 1 << (2 * self.depth))
        size = np.sqrt(ends - self.starts) * self.side / (1 << self.depth)
        x = np.zeros(len(self.starts))
        y = np.zeros(len(self.starts))
        for bit in range(self.depth):
            x += ((self.starts >> (2 * bit)) & 1) * (1 << bit)
            y += ((self.starts >> (2 * bit + 1)) & 1) * (1 << bit)
        unit = self.side / (1 << self.depth)
        x, y = self.x0 + x * unit, self.y0 + y * unit
        return np.column_stack([x, y, x + size, y + size])


class RTree:
    """Static R-tree over boxes, packed by sort-tile-recursive."""

    def __init__(self, boxes: np.ndarray) -> None:
        n = len(boxes)
        slabs = max(1, int(np.ceil(np.sqrt(np.ceil(n / NODE)))))
        by_x = np.argsort(boxes[:, 0] + boxes[:, 2], kind="stable")
        slab = np.empty(n, dtype=np.int64)
        slab[by_x] = np.arange(n) * slabs // max(n, 1)
        self.order = np.lexsort((boxes[:, 1] + boxes[:, 3], slab))
        self.levels = [boxes[self.order]]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            first = np.arange(0, len(low), NODE)
            self.levels.append(np.column_stack([
                np.minimum.reduceat(low[:, 0], first), np.minimum.reduceat(low[:, 1], first),
                np.maximum.reduceat(low[:, 2], first), np.maximum.reduceat(low[:, 3], first),
            ]))

    def probe(self, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probe index, entry index) of all overlaps."""
        who = np.arange(len(boxes))
        node = np.zeros(len(boxes), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            b, q = self.levels[level][node], boxes[who]
            hit = (b[:, 0] <= q[:, 2]) & (b[:, 2] >= q[:, 0]) & (b[:, 1] <= q[:, 3]) & (b[:, 3] >= q[:, 1])
            who, node = who[hit], node[hit]
            if level:
                count = np.minimum(NODE, len(self.levels[level - 1]) - node * NODE)
                offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                who, node = np.repeat(who, count), np.repeat(node * NODE, count) + offset
        return who, self.order[node]


def great_circle(lon1: np.ndarray, lat1: np.ndarray, lon2: np.ndarray, lat2: np.ndarray) -> np.ndarray:
    a1, a2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((a2 - a1) / 2) ** 2 + np.cos(a1) * np.cos(a2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_RADIUS_M * np.arcsin(np.sqrt(np.minimum(1.0, h)))


def reach(lat: np.ndarray, metres: float) -> tuple[np.ndarray, np.ndarray]:
    """Half width and half height, in degrees, of a box that surely holds the circle around a point."""
    dy = np.degrees(metres / EARTH_RADIUS_M) * (1 + 1e-6) + 1e-9
    dx = dy / np.maximum(1e-6, np.cos(np.radians(np.minimum(90.0, np.abs(lat) + dy)))) + 1e-9
    return dx, np.full_like(dx, dy)


def site_key(lon: Column, lat: Column) -> Column:
    return F.xxhash64(lon + F.lit(0.0), lat + F.lit(0.0))


def usable_positions(records: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    """Distinct (nzgd_id, lon, lat, site) of the records inside the window (min lon, min lat, max lon, max lat)."""
    lon, lat = F.col("longitude"), F.col("latitude")
    inside = lon.between(window[0], window[2]) & lat.between(window[1], window[3]) & F.col("nzgd_id").isNotNull()
    return records.where(inside).select("nzgd_id", lon.alias("lon"), lat.alias("lat"), site_key(lon, lat).alias("site")).distinct()


def fit_quadtree(sites: DataFrame, window: tuple[float, float, float, float], metres: float) -> Quadtree:
    """The partitioning, shaped by a sample; it decides no result.

    The number of leaves follows the number of sites, so that a leaf holds about ``BLOCK_PROBES`` whatever their number, and the sample has
    ``SAMPLE_PER_LEAF`` sites for each (a billion sites: 20,000 leaves, 1.3 million sampled positions of 16 bytes).
    """
    n = sites.count()
    leaves = max(TARGET_LEAVES, -(-n // BLOCK_PROBES))
    wanted = max(SAMPLE_SITES, leaves * SAMPLE_PER_LEAF)
    sample = sites.select("lon", "lat")
    if n > wanted:
        sample = sample.sample(wanted / n, 11)
    points = sample.toPandas()
    worst = np.array([max(abs(window[1]), abs(window[3]))])
    smallest = 2.5 * float(max(reach(worst, metres)[0][0], reach(worst, metres)[1][0]))
    capacity = max(SAMPLE_PER_LEAF, len(points) // leaves)
    return Quadtree(points["lon"].to_numpy(float), points["lat"].to_numpy(float), window, smallest, capacity)


def _leaves_near(tree: Quadtree, metres: float):
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def near(lon: pd.Series, lat: pd.Series) -> pd.Series:
        x, y = lon.to_numpy(float), lat.to_numpy(float)
        dx, dy = reach(y, metres)
        found = np.column_stack([tree.leaf(x, y), *[tree.leaf(x + i * dx, y + j * dy) for i in (-1, 1) for j in (-1, 1)]])
        home, rest = found[:, 0], np.sort(found, axis=1)
        fresh = np.column_stack([np.ones(len(x), bool), rest[:, 1:] != rest[:, :-1]]) & (rest != home[:, None])
        return pd.Series([[int(h), *map(int, r[k])] for h, r, k in zip(home, rest, fresh)])

    return near


def _blocks(placed: DataFrame) -> DataFrame:
    """(leaf, blocks): in how many blocks a leaf's probes go. One row per leaf, so its size is bounded by the tree."""
    return placed.groupBy("leaf").agg(F.ceil(F.count_if("home") / BLOCK_PROBES).cast("int").alias("blocks")).where("blocks > 0")


def near_sites(sites: DataFrame, window: tuple[float, float, float, float], metres: float) -> DataFrame:
    """(site_a, site_b), site_a < site_b, of all different sites at most ``metres`` apart. ``sites``: site, lon, lat."""
    sites = cut(sites)
    tree = fit_quadtree(sites, window, metres)
    near = _leaves_near(tree, metres)
    placed = sites.select("site", "lon", "lat", F.posexplode(near("lon", "lat")).alias("k", "leaf"))
    placed = placed.select("site", "lon", "lat", "leaf", (F.col("k") == 0).alias("home"))
    blocked = placed.join(F.broadcast(_blocks(placed)), "leaf").select(
        "site", "lon", "lat", "leaf", "home", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod("site", "blocks").cast("int").alias("own"),
    )

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        site, x, y = pdf["site"].to_numpy(), pdf["lon"].to_numpy(), pdf["lat"].to_numpy()
        probes = np.flatnonzero(pdf["home"].to_numpy() & (pdf["own"].to_numpy() == pdf["block"].to_numpy()))
        rtree = RTree(np.column_stack([x, y, x, y]))
        out_a, out_b = [], []
        for at in range(0, len(probes), 4096):
            p = probes[at : at + 4096]
            dx, dy = reach(y[p], metres)
            who, other = rtree.probe(np.column_stack([x[p] - dx, y[p] - dy, x[p] + dx, y[p] + dy]))
            a = p[who]
            keep = site[other] > site[a]
            a, other = a[keep], other[keep]
            keep = great_circle(x[a], y[a], x[other], y[other]) <= metres
            out_a.append(site[a[keep]])
            out_b.append(site[other[keep]])
        empty = np.empty(0, dtype=np.int64)
        return pd.DataFrame({"site_a": np.concatenate(out_a or [empty]), "site_b": np.concatenate(out_b or [empty])})

    return blocked.groupBy("leaf", "block").applyInPandas(search, "site_a long, site_b long")


def near_records(positions: DataFrame, window: tuple[float, float, float, float], metres: float) -> DataFrame:
    """(id_a, id_b), id_a < id_b, of all different records with positions at most ``metres`` apart."""
    sites = positions.select("site", "lon", "lat").distinct()
    members = positions.select("site", "nzgd_id").distinct()
    pairs = near_sites(sites, window, metres)
    a = members.select(F.col("site").alias("site_a"), F.col("nzgd_id").alias("x"))
    b = members.select(F.col("site").alias("site_b"), F.col("nzgd_id").alias("y"))
    apart = pairs.join(a, "site_a").join(b, "site_b").select("x", "y")
    together = a.join(b, F.col("site_a") == F.col("site_b")).where("x < y").select("x", "y")
    both = apart.unionByName(together).where("x <> y")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def near_counts(positions: DataFrame, window: tuple[float, float, float, float], metres: float) -> DataFrame:
    """(site, lon, lat, n_records, n_near): per site its records and the records within ``metres`` of it, itself included.

    The pre-aggregated form for crowded places: no pair of records is written.
    """
    sites = cut(positions.groupBy("site", "lon", "lat").agg(F.countDistinct("nzgd_id").alias("n_records")))
    pairs = near_sites(sites.select("site", "lon", "lat"), window, metres)
    weight = sites.select("site", "n_records")
    both = pairs.select("site_a", "site_b").unionByName(pairs.select(F.col("site_b").alias("site_a"), F.col("site_a").alias("site_b")))
    around = both.join(weight, F.col("site_b") == F.col("site")).groupBy("site_a").agg(F.sum("n_records").alias("others"))
    out = sites.join(around, F.col("site") == F.col("site_a"), "left")
    return out.select("site", "lon", "lat", "n_records", (F.col("n_records") + F.coalesce("others", F.lit(0))).alias("n_near"))


# ---------------------------------------------------------------- regions


def parse_wkt(wkt: str) -> list[np.ndarray]:
    """The rings of a POLYGON or MULTIPOLYGON as (n, 2) arrays; even-odd counting needs no nesting."""
    rings = []
    for ring in re.findall(r"\(([^()]+)\)", wkt or ""):
        rings.append(np.array([[float(v) for v in p.split()[:2]] for p in ring.split(",")]))
    return rings


def inside(rings: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Even-odd test of points against rings, holes included."""
    odd = np.zeros(len(x), dtype=bool)
    for r in rings:
        ax, ay = r[:, 0], r[:, 1]
        bx, by = np.roll(ax, -1), np.roll(ay, -1)
        for x1, y1, x2, y2 in zip(ax, ay, bx, by):
            if y1 != y2:
                crosses = (y1 > y) != (y2 > y)
                odd ^= crosses & (x < (x2 - x1) * (y - y1) / (y2 - y1) + x1)
    return odd


def containing_regions(positions: DataFrame, regions: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    """(site, region): the region around each site. ``regions``: region (int), wkt. Sites outside all have no row."""
    sites = cut(positions.select("site", "lon", "lat").distinct())
    tree = fit_quadtree(sites, window, 1.0)
    boxes = tree.boxes()
    near = _leaves_near(tree, 0.0)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def overlaps(wkt: pd.Series) -> pd.Series:
        out = []
        for w in wkt:
            rings = parse_wkt(w)
            if not rings:
                out.append([])
                continue
            p = np.vstack(rings)
            (x0, y0), (x1, y1) = p.min(axis=0), p.max(axis=0)
            hit = (boxes[:, 0] <= x1) & (boxes[:, 2] >= x0) & (boxes[:, 1] <= y1) & (boxes[:, 3] >= y0)
            out.append([int(i) for i in np.flatnonzero(hit)])
        return pd.Series(out)

    placed = sites.select("site", "lon", "lat", near("lon", "lat")[0].alias("leaf"), F.lit(True).alias("home"))
    blocks = F.broadcast(_blocks(placed))
    probes = placed.join(blocks, "leaf").select("site", "lon", "lat", "leaf", F.pmod("site", "blocks").cast("int").alias("block"))
    areas = regions.where("region is not null and wkt is not null").select("region", "wkt", F.explode(overlaps("wkt")).alias("leaf"))
    areas = areas.join(blocks, "leaf").select("region", "wkt", "leaf", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def locate(points: pd.DataFrame, polygons: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"site": np.empty(0, np.int64), "region": np.empty(0, np.int32)})
        if points.empty or polygons.empty:
            return empty
        x, y, site = points["lon"].to_numpy(), points["lat"].to_numpy(), points["site"].to_numpy()
        shapes = [parse_wkt(w) for w in polygons["wkt"]]
        extent = np.array([[*np.vstack(s).min(axis=0), *np.vstack(s).max(axis=0)] for s in shapes])
        who, entry = RTree(extent).probe(np.column_stack([x, y, x, y]))
        found = [empty]
        for k in np.unique(entry):
            p = who[entry == k]
            p = p[inside(shapes[k], x[p], y[p])]
            found.append(pd.DataFrame({"site": site[p], "region": np.full(len(p), polygons["region"].iloc[k], np.int32)}))
        return pd.concat(found)

    grouped = probes.groupBy("leaf", "block").cogroup(areas.groupBy("leaf", "block"))
    return grouped.applyInPandas(locate, "site long, region int")


def misplaced(records: DataFrame, positions: DataFrame, found: DataFrame) -> DataFrame:
    """(nzgd_id, region): records whose stored district is null or not the one around them."""
    stored = records.where("nzgd_id is not null").select(
        "nzgd_id", "district_id", site_key(F.col("longitude"), F.col("latitude")).alias("site")
    ).distinct()
    here = positions.select("nzgd_id", "site").join(found, "site")
    wrong = here.join(stored, ["nzgd_id", "site"]).where("district_id is null or district_id <> region")
    return wrong.select("nzgd_id", "region").distinct()
