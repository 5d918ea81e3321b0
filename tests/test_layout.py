import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.operators.layout import _key, key_ranges, tile_key, tile_window, write_tile_layout


def test_keys_are_interleaved_bits(spark):
    corners = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1), (5, 3, 6), (70_000, 65_535, 1), ((1 << 31) - 1, 65_535, 65_535)]
    df = spark.createDataFrame(corners, "frame INT, tile_y INT, tile_x INT").withColumn("key", tile_key())
    assert {tuple(r)[:3]: r["key"] for r in df.collect()} == {c: _key(c) for c in corners}
    assert _key((1, 0, 0)) == 4 and _key((0, 1, 0)) == 2 and _key((0, 0, 3)) == 9
    with pytest.raises(PySparkException, match="outside the key"):
        spark.createDataFrame([(0, 65_536, 0)], "frame INT, tile_y INT, tile_x INT").select(tile_key()).collect()


def test_ranges_hold_the_window_and_hardly_more():
    r = random.Random(1)
    for _ in range(40):
        box = [tuple(sorted(r.choices(range(n), k=2))) for n in (70_000, 40, 40)]
        box[0] = (box[0][0], min(box[0][1], box[0][0] + 20))
        for most in (1, 7, 24):
            ranges = key_ranges(*box, most)
            assert len(ranges) <= most and ranges == sorted(ranges)
            keys = [_key((f, y, x)) for f in range(box[0][0], box[0][1] + 1) for y in range(box[1][0], box[1][1] + 1) for x in range(box[2][0], box[2][1] + 1)]
            assert all(any(a <= k <= b for a, b in ranges) for k in keys)
        exact = key_ranges(*box, 100_000)
        assert sum(b - a + 1 for a, b in exact) == len(keys)
    assert key_ranges((2, 1), (0, 0), (0, 0)) == []
    assert len(key_ranges((0, 7), (0, 7), (8, 15))) == 1


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    path = f"file:{tmp_path_factory.mktemp('layout')}/tiles"
    one = spark.range(64 * 32 * 32).selectExpr("'r' AS run_id", "5 AS z", "int(id div 1024) AS frame", "int(id div 32 % 32) AS tile_y", "int(id % 32) AS tile_x")
    tiles = one.selectExpr("*", "explode(sequence(0, 3)) AS at").selectExpr("run_id", "z", "frame", "tile_y", "tile_x", "int(at div 2) AS y", "int(at % 2) AS x", "frame + at AS value")
    other = tiles.filter("frame = 3").withColumn("z", F.lit(4))
    write_tile_layout(tiles.unionByName(other), path, 16_384)
    return path, tiles


def test_windows(spark, layout):
    path, tiles = layout
    for frames, rows, columns in [((3, 9), (4, 6), (10, 20)), ((0, 0), (0, 0), (0, 0)), ((-5, 200), (31, 99), (31, 31)), ((9, 3), (0, 1), (0, 1)), ((70, 80), (0, 1), (0, 1))]:
        got = tile_window(spark, path, "r", 5, frames, rows, columns)
        want = tiles.filter(F.col("frame").between(*frames) & F.col("tile_y").between(*rows) & F.col("tile_x").between(*columns))
        names = ["z", "frame", "tile_y", "tile_x", "y", "x", "value"]
        assert as_set(got, *names) == as_set(want, *names) and got.count() == want.count()


def test_few_row_groups(spark, layout):
    path, _ = layout
    window = tile_window(spark, path, "r", 5, (8, 15), (8, 15), (8, 15))
    assert "GreaterThanOrEqual(key," in window._jdf.queryExecution().toString()
    ranges, touched, total = key_ranges((8, 15), (8, 15), (8, 15)), 0, 0
    assert len(ranges) == 1  # a cube of aligned sides is one stretch of the curve
    for name in glob.glob(path.removeprefix("file:") + "/run_id=r/z=5/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("key")
        for g in range(meta.num_row_groups):
            seen = meta.row_group(g).column(at).statistics
            touched += any(a <= seen.max and b >= seen.min for a, b in ranges)
            total += 1
    assert touched <= total / 4 and total >= 8
