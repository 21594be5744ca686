import math
import random

import numpy as np
import pytest

from tessera.operators import nearest
from tessera.plans import reports


def brute(points, sites, k, ties):
    out = []
    for pid, x, y in points:
        ds = sorted((math.sqrt((sx - x) * (sx - x) + (sy - y) * (sy - y)), sid) for sid, sx, sy in sites)
        if ties:
            kth = ds[min(k, len(ds)) - 1][0]
            out += [(pid, sid) for d, sid in ds if d <= kth]
        else:
            out += [(pid, sid) for d, sid in ds[:k]]
    return sorted(out)


def _frames(spark, points, sites):
    p = spark.createDataFrame(points, "pid int, x double, y double")
    s = spark.createDataFrame(sites, "sid int, sx double, sy double")
    return p, s


@pytest.mark.parametrize("cell", [None, 0.5, 400.0])
def test_nearest_matches_brute_force_clustered_and_far(spark, cell):
    rng = random.Random(5)
    sites = [(i, rng.gauss(50, 3), rng.gauss(50, 3)) for i in range(40)] + [(100 + i, rng.uniform(0, 500), 0.0)
                                                                           for i in range(3)]
    points = [(j, rng.uniform(-100, 600), rng.uniform(-100, 200)) for j in range(800)]
    p, s = _frames(spark, points, sites)
    for k, ties in ((1, True), (3, False), (3, True)):
        got = sorted((r["pid"], r["sid"]) for r in
                     nearest(p, s, "x", "y", "sx", "sy", k=k, ties=ties, site_order="sid",
                             cell_size=cell).collect())
        assert got == brute(points, sites, k, ties), (k, ties)


def test_nearest_ties_duplicates_and_k_beyond_sites(spark):
    sites = [(1, 0.0, 0.0), (2, 2.0, 0.0), (3, 2.0, 0.0)]  # two stations at one place
    points = [(10, 1.0, 0.0), (11, 2.5, 0.0), (12, None, 1.0)]
    p, s = _frames(spark, points, sites)
    for cell in (None, 0.1):
        got = sorted((r["pid"], r["sid"]) for r in nearest(p, s, "x", "y", "sx", "sy", cell_size=cell).collect())
        assert got == [(10, 1), (10, 2), (10, 3), (11, 2), (11, 3)]
    k5 = nearest(p, s, "x", "y", "sx", "sy", k=5, ties=False, site_order="sid", rank_col="rk").collect()
    assert sorted((r["pid"], r["rk"], r["sid"]) for r in k5) == [(10, 1, 1), (10, 2, 2), (10, 3, 3),
                                                                 (11, 1, 2), (11, 2, 3), (11, 3, 1)]


def test_compete_by_duplicate_key(spark):
    sites = [(1, 0.0, 0.0)]
    points = [(7, 1.0, 0.0), (7, 3.0, 0.0), (8, 2.0, 0.0)]
    p, s = _frames(spark, points, sites)
    per_row = nearest(p, s, "x", "y", "sx", "sy")
    assert per_row.count() == 3
    competed = nearest(p, s, "x", "y", "sx", "sy", compete_by="pid")
    assert sorted((r["pid"], r["x"]) for r in competed.collect()) == [(7, 1.0), (8, 2.0)]


def test_nearest_station_report(spark):
    stations = spark.createDataFrame([(0.0, 0.0, "HARBOR"), (10.0, 0.0, "PACIFIC")], "X double, Y double, DIVISION string")
    crimes = spark.createDataFrame([(1, 1.0, 0.0), (2, 2.0, 0.0), (3, 9.0, 0.0), (4, None, None), (5, 0.0, 0.0)],
                                   "DR_NO long, LON double, LAT double")
    out = {r["division"]: (r["crime_count"], r["average_distance"]) for r in
           reports.nearest_station_report(crimes, stations).collect()}
    assert out == {"HARBOR": (3, 1.0), "PACIFIC": (1, 1.0)}


def test_dense_cluster_and_stacked_sites_match_brute_force(spark):
    rng = random.Random(9)
    # a dense cluster far above the per-cell bound, a stack of sites at one spot, scattered rest
    sites = [(i, 50 + rng.uniform(-0.01, 0.01), 50 + rng.uniform(-0.01, 0.01)) for i in range(300)]
    sites += [(1000 + i, 20.0, 80.0) for i in range(60)]
    sites += [(2000 + i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(40)]
    points = [(j, rng.uniform(-50, 150), rng.uniform(-50, 150)) for j in range(300)]
    points += [(5000 + j, 50 + rng.uniform(-0.02, 0.02), 50 + rng.uniform(-0.02, 0.02)) for j in range(100)]
    points += [(6000, 20.0, 80.0), (6001, 20.5, 80.0)]
    p, s = _frames(spark, points, sites)
    for k, ties in ((1, True), (2, False), (3, True)):
        got = sorted((r["pid"], r["sid"]) for r in nearest(p, s, "x", "y", "sx", "sy", k=k, ties=ties,
                                                          site_order="sid", max_cell_sites=8).collect())
        assert got == brute(points, sites, k, ties), (k, ties)


def test_nearest_without_broadcast(spark):
    rng = random.Random(33)
    sites = [(i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(120)]
    points = [(j, rng.uniform(-20, 120), rng.uniform(-20, 120)) for j in range(400)]
    p, s = _frames(spark, points, sites)
    got = sorted((r["pid"], r["sid"]) for r in
                 nearest(p, s, "x", "y", "sx", "sy", k=2, ties=False, site_order="sid", cell_size=3.0,
                         max_broadcast_bytes=0).collect())
    assert got == brute(points, sites, 2, False)


def test_one_far_site_does_not_change_the_answer(spark):
    rng = np.random.default_rng(5)
    spots = rng.random((600, 2)).tolist() + [[1000.0, 1000.0]]
    sites = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spots)], "sid long, sx double, sy double")
    at = rng.random((500, 2))
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(at)], "pid long, x double, y double")
    got = {r["pid"]: r["sid"] for r in nearest(points, sites, "x", "y", "sx", "sy", k=1, ties=False, site_order="sid").collect()}
    want = ((at[:, None, :] - np.array(spots)[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert got == dict(enumerate(want.tolist()))


def great_circle(lon1, lat1, lon2, lat2, radius=6371008.0):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    h = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * radius * np.arcsin(np.sqrt(np.minimum(h, 1.0)))


def globe(n, seed, dense=0):
    """Places all over the sphere, poles and both sides of the date line among them, and a dense group."""
    g = np.random.default_rng(seed)
    lon, lat = g.uniform(-180, 180, n), np.degrees(np.arcsin(g.uniform(-1, 1, n)))
    special = [(0.0, 90.0), (77.0, 90.0), (10.0, -90.0), (180.0, 12.0), (-180.0, 12.5), (179.999, -40.0), (-179.999, -40.1)]
    near = [(179.9 + a, 60 + b) if 179.9 + a <= 180 else (a - 180.1, 60 + b) for a, b in g.uniform(0, .2, (dense, 2)).tolist()]
    return list(zip(lon.tolist(), lat.tolist())) + special + near


@pytest.mark.parametrize("k,ties,dense", [(1, True, 0), (1, False, 150), (4, False, 0), (3, True, 150)])
def test_sphere_nearest_matches_brute_force(spark, k, ties, dense):
    sites, points = globe(120, 3, dense), globe(700, 4, 40)
    p, s = _frames(spark, [(i, *xy) for i, xy in enumerate(points)], [(i, *xy) for i, xy in enumerate(sites)])
    got = nearest(p, s, "x", "y", "sx", "sy", k=k, ties=ties, site_order="sid", use_sphere=True).collect()
    a, b = np.array(points), np.array(sites)
    d = great_circle(a[:, None, 0], a[:, None, 1], b[None, :, 0], b[None, :, 1])
    kth = np.sort(d, axis=1)[:, k - 1]
    per = {}
    for r in got:
        assert abs(r["distance"] - d[r["pid"], r["sid"]]) < 1e-3
        per.setdefault(r["pid"], set()).add(r["sid"])
    for i in range(len(points)):
        sure, possible = set(np.flatnonzero(d[i] < kth[i] - 1e-3)), set(np.flatnonzero(d[i] <= kth[i] + 1e-3))
        assert sure <= per[i] <= possible and len(per[i]) >= k


def test_sphere_ties_at_the_pole_and_unit_of_the_radius(spark):
    sites = [(i, 45.0 * i, 0.0) for i in range(8)]
    p, s = _frames(spark, [(1, 33.0, 90.0), (2, 1.0, 0.0)], sites)
    got = nearest(p, s, "x", "y", "sx", "sy", use_sphere=True, radius=1.0).collect()
    one = [r for r in got if r["pid"] == 2]
    assert len(one) == 1 and abs(one[0]["distance"] - math.radians(1.0)) < 1e-12
    pole = [r for r in got if r["pid"] == 1]
    assert all(abs(r["distance"] - math.pi / 2) < 1e-12 for r in pole) and len(pole) >= 1


def test_several_indexes_give_what_one_gives(spark):
    rng = random.Random(12)
    sites = [(i, rng.gauss(50, 3), rng.gauss(50, 3)) for i in range(150)] + [(200 + i, rng.uniform(0, 500), 7.0) for i in range(30)]
    points = [(j, rng.uniform(-100, 600), rng.uniform(-100, 200)) for j in range(500)]
    p, s = _frames(spark, points, sites)
    for k, ties, limit in ((1, True, 256 << 20), (3, False, 0), (2, True, 0)):
        got = nearest(p, s, "x", "y", "sx", "sy", k=k, ties=ties, site_order="sid", index_sites=50, max_cell_sites=6, max_broadcast_bytes=limit)
        assert sorted((r["pid"], r["sid"]) for r in got.collect()) == brute(points, sites, k, ties)


def test_points_are_not_written_or_shuffled(spark):
    p, s = _frames(spark, [(i, float(i % 37), float(i % 11)) for i in range(400)], [(i, float(i), float(i * i % 17)) for i in range(40)])
    plan = nearest(p, s, "x", "y", "sx", "sy", k=2, ties=False, site_order="sid")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_far_points_stay_cheap(spark):
    """Points far from a dense cluster, a stack and scattered sites are settled by few, large cells."""
    rng = random.Random(9)
    sites = [(i, 50 + rng.uniform(-0.01, 0.01), 50 + rng.uniform(-0.01, 0.01)) for i in range(300)]
    sites += [(1000 + i, 20.0, 80.0) for i in range(60)] + [(2000 + i, rng.uniform(0, 100), rng.uniform(0, 100)) for i in range(40)]
    points = [(j, rng.uniform(-5000, 5000), rng.uniform(-5000, 5000)) for j in range(402)]
    p, s = _frames(spark, points, sites)
    got = sorted((r["pid"], r["sid"]) for r in nearest(p, s, "x", "y", "sx", "sy", k=2, ties=False, site_order="sid").collect())
    assert got == brute(points, sites, 2, False)


def test_coordinates_that_are_no_numbers_and_zero_of_either_sign(spark):
    points = [(1, float("nan"), 0.0), (2, None, 0.0), (3, float("inf"), 1.0), (4, -0.0, 0.0)]
    sites = [(1, 0.0, -0.0), (2, -0.0, 0.0), (3, float("nan"), 0.0), (4, None, None), (5, float("-inf"), 0.0)]
    p, s = _frames(spark, points, sites)
    assert sorted((r["pid"], r["sid"], r["distance"]) for r in nearest(p, s, "x", "y", "sx", "sy").collect()) == [(4, 1, 0.0), (4, 2, 0.0)]
    assert nearest(p, s.where("sid > 2"), "x", "y", "sx", "sy").count() == 0
    assert nearest(p.where("pid < 4"), s, "x", "y", "sx", "sy", use_sphere=True).count() == 0


def test_report_sums_the_incidents_of_a_place_once_for_all_its_stations(spark, monkeypatch):
    # 300 stations on 2 spots (one of them as 0.0 and -0.0), one division on both; a NULL key is averaged, not counted
    st = spark.createDataFrame([(f"d{i % 7}", 0.0 if i % 4 else -0.0, 10.0 * (i % 2)) for i in range(300)] + [("d0", None, 1.0)],
                               "DIVISION string, X double, Y double")
    points = [(i if i % 9 else None, float(i % 5), float(i % 11)) for i in range(60)]
    crimes = spark.createDataFrame(points, "DR_NO int, LON double, LAT double")
    seen = []
    monkeypatch.setattr(reports, "nearest", lambda p, s, *a, **kw: seen.append(s.count()) or nearest(p, s, *a, **kw))
    got = {r["division"]: (r["crime_count"], r["average_distance"]) for r in reports.nearest_station_report(crimes, st).collect()}
    assert seen == [3]  # two places (and one without an x), not 301 stations
    for d in range(7):
        near = [(key, math.hypot(x, y - 10.0 * (i % 2))) for i in range(300) if i % 7 == d for key, x, y in points
                if (y <= 5 and i % 2 == 0) or (y >= 5 and i % 2)]
        assert got[f"d{d}"][0] == sum(key is not None for key, _ in near)
        assert got[f"d{d}"][1] == pytest.approx(sum(v for _, v in near) / len(near))


def test_ring_of_a_far_point_is_one_short_expression(spark):
    from pyspark.sql import functions as F

    from tessera.operators.nearest import _cell_columns

    ring, _ = _cell_columns(F.col("x"), F.col("y"), False, 1.0, (-1.0, 1.0, -1.0, 1.0))
    xs = [0.0, 0.5, 1.0, 1.5, 4.0001, 15.9, 16.1, 300.0, 1e6, 1e40]
    frame = spark.createDataFrame([(x, -x / 2) for x in xs], "x double, y double").select("x", ring.alias("r"))
    assert [r["r"] for r in frame.orderBy("x").collect()] == [min(24, math.ceil(math.log(x, 4))) if x > 1 else 0 for x in xs]
    assert frame._jdf.queryExecution().analyzed().toString().count("abs(") <= 4  # evaluated for every point
