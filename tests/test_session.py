import os

import pytest

from tessera.session import ensure_checkpoint_dir, scratch_path


def test_scratch_lives_under_the_checkpoint_folder(spark):
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()      # the session's setting is used as is
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base.rstrip("/") + "/tessera-scratch/") and a != b   # fresh path per call


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def _files(path):
    path = path.removeprefix("file:")
    return sum(len(names) for _, _, names in os.walk(path))


def test_intermediates_go_when_their_block_ends(spark):
    from tessera.operators import dissolve, nearest
    from tessera.session import _root, intermediates, scratch_path
    from tessera.sources import ingest

    points = spark.range(200).selectExpr("id", "cast(id % 17 as double) AS x", "cast(id % 13 as double) AS y")
    sites = spark.range(9).selectExpr("id AS sid", "cast(id as double) AS sx", "cast(id * id % 7 as double) AS sy")
    square = [[[[0.0, 0.0], [2.0, 0.0], [2.0, 2.0], [0.0, 2.0], [0.0, 0.0]]]]
    shapes = spark.createDataFrame([("a", square)] * 2, "g string, geometry array<array<array<array<double>>>>")
    root, before = _root(spark), _files(_root(spark))
    for _ in range(3):
        with intermediates(spark) as own:
            assert nearest(points, sites, "x", "y", "sx", "sy").count() >= 200
            assert dissolve(shapes, "g", overlapping=True).count() == 1
            ingest.write_parquet(points, scratch_path(spark, "points"))
            assert _files(own.path) > 10
        assert _files(own.path) == 0 and _root(spark) == root
    assert _files(_root(spark)) <= before  # a long session does not grow


def test_a_result_keeps_its_intermediates_until_it_lets_go(spark):
    from tessera.operators import nearest
    from tessera.session import intermediates

    points = spark.range(50).selectExpr("id", "cast(id % 17 as double) AS x", "cast(id % 13 as double) AS y")
    sites = spark.range(5).selectExpr("id AS sid", "cast(id as double) AS sx", "cast(id as double) AS sy")
    with intermediates(spark) as outer:
        with intermediates(spark) as own:
            held = own.retain()
            result = nearest(points, sites, "x", "y", "sx", "sy")
        assert result.count() >= 50 and _files(held.path) > 0
        held.release()
        assert _files(held.path) == 0
        held.release()  # again: nothing
        assert nearest(points, sites, "x", "y", "sx", "sy").count() >= 50 and _files(outer.path) > 0
    assert _files(outer.path) == 0
    with pytest.raises(ValueError):
        held.retain()
