import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import as_set
from gridscale.functions import png
from gridscale.functions.palettes import ember_palette, gray_palette, palette_from_floats
from gridscale.operators import render
from gridscale.operators.compute import compute_frames


@pytest.fixture
def cells(spark):
    def make(array, frame=0):
        rows = [(frame, y, x, int(v)) for (y, x), v in np.ndenumerate(np.asarray(array))]
        return spark.createDataFrame(rows, "frame INT, y INT, x INT, iterations INT")
    return make


def test_global_normalisation_does_not_flicker(cells):
    both = cells([[0, 5]]).union(cells([[10, 3]], frame=1))
    got = {r["iterations"]: r["v"] for r in render.normalise_global(both).collect()}
    assert got == {v: float(np.float32(v) / np.float32(10)) for v in (0, 5, 10, 3)}


def test_global_normalisation_of_zeros(cells):
    assert as_set(render.normalise_global(cells([[0, 0]])), "v") == {(0.0,)}


def test_per_frame_normalisation(cells):
    both = cells([[2, 4, 6]]).union(cells([[7, 7]], frame=1))
    got = as_set(render.normalise_per_frame(both), "frame", "x", "v")
    assert got == {(0, 0, 0.0), (0, 1, 0.5), (0, 2, 1.0), (1, 0, 0.0), (1, 1, 0.0)}


def test_palette_bins(spark):
    v = spark.createDataFrame([(0.0,), (0.24,), (0.25,), (0.999,), (1.0,)], "v DOUBLE")
    palette = spark.createDataFrame([(i, i, 10 * i, 255 - i) for i in range(4)], "bin INT, r INT, g INT, b INT")
    got = {r["v"]: r["r"] for r in render.apply_palette(v, palette).collect()}
    assert got == {0.0: 0, 0.24: 0, 0.25: 1, 0.999: 3, 1.0: 3}
    with pytest.raises(ValueError):
        render.apply_palette(v, palette.limit(0))


def test_every_cell_keeps_its_row_and_odd_palettes_are_refused(spark):
    v = spark.createDataFrame([(0.1,), (0.9,), (-0.6,), (7.0,), (None,), (float("nan"),)], "v DOUBLE")
    palette = spark.createDataFrame([(i, i, i, i) for i in range(4)], "bin INT, r INT, g INT, b INT")
    assert [r["r"] for r in render.apply_palette(v, palette).collect()].count(None) == 2
    got = {r["v"]: r["r"] for r in render.apply_palette(v, palette).filter("v IS NOT NULL AND NOT isnan(v)").collect()}
    assert got == {0.1: 0, 0.9: 3, -0.6: 0, 7.0: 3}
    for bad in (palette.filter("bin <> 1"), palette.filter("bin = 1"), palette.union(palette.limit(1))):
        with pytest.raises(ValueError, match="once each"):
            render.apply_palette(v, bad)


def test_palettes_are_whole_and_8_bit(spark):
    for palette in (gray_palette(spark), ember_palette(spark), ember_palette(spark, 16)):
        rows = palette.collect()
        assert sorted(r["bin"] for r in rows) == list(range(len(rows)))
        assert all(0 <= r[c] <= 255 for r in rows for c in "rgb")
    floats = spark.createDataFrame([(0, 0.0, 0.999, 1.0)], "bin INT, r DOUBLE, g DOUBLE, b DOUBLE")
    assert palette_from_floats(floats).first()[1:] == (0, 254, 255)


@pytest.mark.parametrize("h,w", [(2, 2), (3, 2), (2, 3), (3, 5), (1, 1)])
def test_flip_then_pad_equals_numpy(cells, h, w):
    array = np.arange(h * w).reshape(h, w)
    got = render.pad_even(render.flip_rows(cells(array), h), h, w)
    expected = np.pad(np.flipud(array), ((0, h % 2), (0, w % 2)), mode="edge")
    assert as_set(got, "y", "x", "iterations") == {(y, x, v) for (y, x), v in np.ndenumerate(expected)}
    assert got.count() == expected.size and render.even_size(h, w) == expected.shape


def test_png_bytes():
    rng = np.random.default_rng(3)
    rgb = rng.integers(0, 256, (37, 23, 3), dtype=np.uint8)
    image = png.encode(rgb)
    assert image[:8] == b"\x89PNG\r\n\x1a\n" and struct.unpack(">II", image[16:24]) == (23, 37)
    assert (png.decode(image) == rgb).all()
    with pytest.raises(ValueError):
        png.decode(image[:40] + bytes([image[40] ^ 1]) + image[41:])


def test_frame_images_in_several_bands(spark, view, monkeypatch):
    monkeypatch.setattr(render, "CELLS_PER_TILE", 200)
    counts = compute_frames(view((-0.75, 0, 3.5), (-0.5, 0.5, 0.5)), 33, 21, 32)
    rgb = render.apply_palette(render.normalise_global(counts), ember_palette(spark)).select("frame", "y", "x", "r", "g", "b")
    images = render.frame_images(rgb, 33, 21)
    assert images.count() == 2
    for row in images.collect():
        assert png.decode(bytes(row["png"])).shape == (33, 21, 3)
    columns = ("frame", "y", "x", "r", "g", "b")
    assert as_set(render.image_cells(images), *columns) == as_set(rgb, *columns)


def test_missing_bands_stay_black(spark, monkeypatch):
    monkeypatch.setattr(render, "CELLS_PER_TILE", 10)
    one = spark.createDataFrame([(0, 7, 3, 1, 2, 3)], "frame INT, y INT, x INT, r INT, g INT, b INT")
    image = png.decode(bytes(render.frame_images(one, 9, 5).first()["png"]))
    assert image.shape == (9, 5, 3) and image[7, 3].tolist() == [1, 2, 3] and image.sum() == 6


def test_parts_join_to_the_same_image(spark, monkeypatch):
    monkeypatch.setattr(render, "CELLS_PER_TILE", 10)
    rgb = spark.createDataFrame([(f, y, x, y, x, 9) for f in (0, 4) for y in range(9) for x in range(5) if y != 3],
                                "frame INT, y INT, x INT, r INT, g INT, b INT")
    parts = render.image_parts(rgb, 9, 5).collect()
    whole = {r["frame"]: bytes(r["png"]) for r in render.frame_images(rgb, 9, 5).collect()}
    for frame in (0, 4):
        own = sorted((r["part"], bytes(r["bytes"])) for r in parts if r["frame"] == frame)
        assert [k for k, _ in own] == list(range(7)) and b"".join(b for _, b in own) == whole[frame]
        assert png.decode(whole[frame])[8, 4].tolist() == [8, 4, 9]


def test_pixels_outside_the_image_are_an_error(spark):
    for y, x in ((0, 5), (9, 0), (-1, 0), (0, -1)):
        rgb = spark.createDataFrame([(0, y, x, 1, 2, 3)], "frame INT, y INT, x INT, r INT, g INT, b INT")
        with pytest.raises(Exception, match="outside the image"):
            render.frame_images(rgb, 9, 5).collect()


def test_a_rebuilt_pyramid_has_no_level_of_the_old_one(cells, spark, tmp_path):
    path = f"{tmp_path}/tiles"
    render.build_pyramid(cells(np.ones((16, 16))), path, "r", 16, 16, tile_size=4)
    again = render.build_pyramid(cells(np.ones((4, 4))), path, "r", 4, 4, tile_size=4)
    assert {r["z"]: r["count"] for r in again.groupBy("z").count().collect()} == {0: 16}
    render.build_pyramid(cells(np.ones((4, 4))), path, "s", 4, 4, tile_size=4)
    assert render.read_pyramid(spark, path).count() == 32
    spark.range(1).write.parquet(f"{path}/levels/run_id=r/version=3/z=0")  # a build that died
    assert render.read_pyramid(spark, path, "r").count() == 16


def test_oversized_image_is_refused(spark):
    one = spark.createDataFrame([(0, 0, 0, 1, 2, 3)], "frame INT, y INT, x INT, r INT, g INT, b INT")
    with pytest.raises(ValueError, match="tile_images"):
        render.frame_images(one, 1 << 15, 1 << 15)


def test_pyramid(spark, cells, tmp_path):
    rng = np.random.default_rng(5)
    array = rng.integers(0, 1000, (21, 37))
    tiles = render.build_pyramid(cells(array), f"{tmp_path}/tiles", "r", 21, 37, tile_size=8).cache()
    assert render.pyramid_levels(21, 37, 8) == 3 and as_set(tiles, "z") == {(0,), (1,), (2,), (3,)}
    level = np.flipud(array)
    for z in (3, 2, 1, 0):
        got = {(r["tile_y"] * 8 + r["y"], r["tile_x"] * 8 + r["x"]): r["value"] for r in tiles.filter(F.col("z") == z).collect()}
        assert got == {(y, x): v for (y, x), v in np.ndenumerate(level)}
        h, w = level.shape
        padded = np.pad(level, ((0, h % 2), (0, w % 2)), constant_values=-1)
        level = padded.reshape(padded.shape[0] // 2, 2, padded.shape[1] // 2, 2).max(axis=(1, 3))
    found = render.find_tile(tiles, "r", 3, x=4, y=2)
    assert as_set(found, "y", "x", "value") == {(y - 16, x - 32, v) for (y, x), v in np.ndenumerate(np.flipud(array)) if y >= 16 and x >= 32}


def test_tile_images(spark, cells, tmp_path):
    array = np.arange(100).reshape(10, 10)
    tiles = render.build_pyramid(cells(array), f"{tmp_path}/tiles", "r", 10, 10, tile_size=8)
    lit = tiles.withColumns({c: F.col("value") for c in "rgb"})
    images = {(r["z"], r["tile_y"], r["tile_x"]): png.decode(bytes(r["png"])) for r in render.tile_images(lit, 8).collect()}
    assert set(images) == {(0, 0, 0), (1, 0, 0), (1, 0, 1), (1, 1, 0), (1, 1, 1)}
    assert (images[1, 0, 0][:, :, 0] == np.flipud(array)[:8, :8]).all()
    assert (images[1, 1, 1][:2, :2, 1] == np.flipud(array)[8:, 8:]).all()
    assert images[1, 1, 1][2:].sum() == 0
