"""From cells to colours, images and tiles. All of these read cells and return tables."""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridscale.functions import png
from gridscale.operators.stats import largest_count
from gridscale.schema import CELLS_PER_TILE
from gridscale.session import folder_names, settled

MAX_BINS = 65_536
MAX_IMAGE_CELLS = 1 << 24  # 50 MB of pixels in one value
TILE_SIZE = 256

TILES = T.StructType([
    T.StructField("frame", T.IntegerType()),
    T.StructField("tile_y", T.IntegerType()),
    T.StructField("tile_x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("z", T.IntegerType()),
])


def normalise_global(cells: DataFrame) -> DataFrame:
    """Add ``v``: the cell over the largest cell of all frames, in single precision, so
    colours do not flicker between frames. The maximum is a scalar subquery, not a join."""
    return scaled_by_top(cells, cells.select(largest_count().cast("float").alias("top")).scalar())


def scaled_by_top(cells: DataFrame, top) -> DataFrame:
    return cells.withColumn("v", (F.col("iterations").cast("float") / top).cast("float"))


def normalise_per_frame(cells: DataFrame) -> DataFrame:
    """Add ``v``: the cell between its frame's minimum (0) and maximum (1); 0 if they agree.

    The ranges, one row per frame, are aggregated and joined back rather than taken over a
    window, so a frame need not fit one task. They are settled first: planned from the cells,
    their size would be unknown and the join would shuffle every cell.
    """
    ranges = settled(cells.groupBy("frame").agg(F.min("iterations").alias("lo"), F.max("iterations").alias("hi")))
    return scaled_by_range(cells.join(ranges, "frame"))


def scaled_by_range(cells: DataFrame) -> DataFrame:
    """``v`` of cells that have the range of their frame as ``lo`` and ``hi``."""
    spread = (F.col("hi") - F.col("lo")).cast("double")
    v = F.when(spread > 0, (F.col("iterations") - F.col("lo")) / spread).otherwise(0.0)
    return cells.withColumn("v", v).drop("lo", "hi")


def apply_palette(cells: DataFrame, palette: DataFrame) -> DataFrame:
    """Add ``r, g, b`` for ``v``: bin ``int(v * n)``, the top edge in the last bin.

    Values outside 0..1 take the colour of the nearer end, NULL and NaN have none; every cell keeps its row. The
    palette must hold the bins 0..n-1 once each, at most ``MAX_BINS``, which bounds its broadcast.
    """
    seen = palette.limit(MAX_BINS + 1).agg(
        F.count("*").alias("n"), F.count_distinct("bin").alias("bins"), F.min("bin").alias("low"), F.max("bin").alias("high")).first()
    n_bins = seen["n"]
    if not 1 <= n_bins <= MAX_BINS or (seen["bins"], seen["low"], seen["high"]) != (n_bins, 0, n_bins - 1):
        raise ValueError(f"a palette has the bins 0 to n - 1, once each, and at most {MAX_BINS}")
    v = F.when(F.col("v").isNotNull() & ~F.isnan("v"), F.least(F.greatest("v", F.lit(0.0)), F.lit(1.0)))
    bins = F.when(v.isNotNull(), F.least((v * n_bins).cast("int"), F.lit(n_bins - 1)))
    return (cells.withColumn("bin", bins)
            .join(F.broadcast(palette.select("bin", "r", "g", "b")), "bin", "left").drop("bin"))


def flip_rows(cells: DataFrame, height: int) -> DataFrame:
    """Array order (y upwards) to image order (y downwards), or back."""
    return cells.withColumn("y", F.lit(height - 1) - F.col("y"))


def even_size(height: int, width_px: int) -> tuple[int, int]:
    return height + height % 2, width_px + width_px % 2


def pad_even(cells: DataFrame, height: int, width_px: int) -> DataFrame:
    """Repeat the last row and column where the size is odd. Pad after flipping."""
    for axis, size in (("y", height), ("x", width_px)):
        if size % 2:
            here = F.col(axis)
            cells = cells.withColumn(axis, F.explode(
                F.when(here == size - 1, F.array(here, here + 1)).otherwise(F.array(here))))
    return cells


def image_parts(rgb: DataFrame, height: int, width_px: int) -> DataFrame:
    """``(frame, part, bytes)``: every frame as one PNG in parts that are concatenated in order.

    Part 0 is the header, then comes one part per band of rows, then the trailer. Bands are deflated in separate groups
    of bounded size, and only their checksums and lengths meet for the trailer, so no task holds a
    frame. Cells that are absent stay black; one outside the frame is an error.
    """
    band_rows = max(1, CELLS_PER_TILE // width_px)
    n_bands = -(-height // band_rows)
    band_type = T.StructType([
        T.StructField("frame", T.IntegerType()), T.StructField("band", T.IntegerType()),
        T.StructField("deflated", T.BinaryType()), T.StructField("checksum", T.LongType()),
        T.StructField("raw_length", T.LongType()),
    ])

    def pack_band(key, cells):
        frame, band = (k.as_py() for k in key)
        rows = min(band_rows, height - band * band_rows)
        raw = png.scanlines(_canvas(cells, rows, width_px))
        return pa.table({
            "frame": pa.array([frame], pa.int32()), "band": pa.array([band], pa.int32()),
            "deflated": pa.array([png.chunk(b"IDAT", png.deflate_band(raw))], pa.binary()),
            "checksum": pa.array([zlib.adler32(raw)], pa.int64()),
            "raw_length": pa.array([len(raw)], pa.int64()),
        })

    @F.arrow_udf("binary")
    def trailer(sums: pa.Array) -> pa.Array:
        return pa.array([png.trailer([(b["checksum"], b["raw_length"]) for b in sorted(bands.as_py(), key=lambda b: b["band"])]) for bands in sums],
                        pa.binary())

    inside = F.col("y").between(0, height - 1) & F.col("x").between(0, width_px - 1)
    at = (F.col("y") % band_rows) * width_px + F.col("x")
    given = rgb.select("frame", F.floor(F.col("y") / band_rows).cast("int").alias("band"), *_pixel(at, inside))
    # An empty list of pixels for every band, so that bands without cells come out black.
    bands = rgb.select("frame").distinct().withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(n_bands - 1))))
    given = given.unionByName(bands.select("frame", "band", F.lit(-1).alias("at"), F.lit(0).alias("rgb")))
    packed = settled(given.groupBy("frame", "band").applyInArrow(pack_band, band_type))
    ends = packed.groupBy("frame").agg(F.collect_list(F.struct("band", "checksum", "raw_length")).alias("sums"))
    head = F.lit(png.header(height, width_px) + png.chunk(b"IDAT", b"\x78\x9c"))
    return (packed.select("frame", (F.col("band") + 1).alias("part"), F.col("deflated").alias("bytes"))
            .unionByName(ends.select("frame", F.lit(0).alias("part"), head.alias("bytes")))
            .unionByName(ends.select("frame", F.lit(n_bands + 1).alias("part"), trailer("sums").alias("bytes"))))


def frame_images(rgb: DataFrame, height: int, width_px: int) -> DataFrame:
    """``(frame, png)``: the parts of ``image_parts`` as one value, for frames of up to ``MAX_IMAGE_CELLS``
    cells (at most 50 MB). Larger ones stay in parts, or are cut by ``tile_images``."""
    if height * width_px > MAX_IMAGE_CELLS:
        raise ValueError(f"{height} x {width_px} is too large for one value; use image_parts or tile_images")
    parts = image_parts(rgb, height, width_px).groupBy("frame").agg(F.array_sort(F.collect_list(F.struct("part", "bytes"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["bytes"]))
    return parts.select("frame", joined.alias("png"))


def _pixel(at, inside):
    """Position and colour of a pixel as two integers, to keep the shuffle narrow."""
    colour = F.shiftleft("r", 16).bitwiseOR(F.shiftleft("g", 8)).bitwiseOR(F.col("b"))
    at = F.when(inside, at.cast("int")).otherwise(F.raise_error(F.concat_ws(
        " ", F.lit("pixel outside the image: y, x ="), F.col("y").cast("string"), F.col("x").cast("string"))))
    return at.alias("at"), F.coalesce(colour, F.lit(0)).cast("int").alias("rgb")


def _canvas(pixels, rows, width_px):
    canvas = np.zeros((rows * width_px, 3), dtype=np.uint8)
    at, rgb = pixels["at"].to_numpy(), pixels["rgb"].to_numpy()
    at, rgb = at[at >= 0], rgb[at >= 0]
    for channel, shift in enumerate((16, 8, 0)):
        canvas[at, channel] = rgb >> shift & 0xFF
    return canvas.reshape(rows, width_px, 3)


def pyramid_levels(height: int, width_px: int, tile_size: int = TILE_SIZE) -> int:
    """How many halvings until the picture fits one tile."""
    levels = 0
    while max(height, width_px) > tile_size << levels:
        levels += 1
    return levels


def halve(level: DataFrame) -> DataFrame:
    """Half resolution: every 2 x 2 block becomes its maximum, so in-set cells stay visible."""
    return (level.groupBy("frame", F.shiftright("y", 1).alias("y"), F.shiftright("x", 1).alias("x"))
            .agg(F.max("value").alias("value")))


#: Which version holds which tile of a pyramid; unchanged tiles are named here and not written again.
TILE_INDEX = T.StructType([T.StructField(n, T.IntegerType()) for n in ("z", "frame", "tile_y", "tile_x", "version")])


def build_pyramid(cells: DataFrame, path: str, run_id: str, height: int, width_px: int,
                  tile_size: int = TILE_SIZE) -> DataFrame:
    """Write a tile pyramid in image order and return it as a table.

    Level ``z = 0`` fits one tile, the last one is full resolution. Every level is halved
    from the written level below it, so the work adds up to a third of the base and no
    level recomputes another. All levels go to a new version folder, whose tiles are listed in ``built`` last, so
    a rebuilt run has no level of the old one, and one that failed midway leaves it as it was.
    """
    spark = cells.sparkSession
    top = pyramid_levels(height, width_px, tile_size)
    version = max(_versions(spark, path, run_id), default=0) + 1
    level = flip_rows(cells, height).select("frame", "y", "x", F.col("iterations").alias("value"))
    for z in range(top, -1, -1):
        level = halve(_write_level(level, _level(path, run_id, version, z), tile_size))
    _list_tiles(_level_tiles(spark, path, run_id, version), path, run_id, version)
    return read_pyramid(spark, path, run_id)


def update_pyramid(cells: DataFrame, changed: DataFrame, path: str, run_id: str, height: int, width_px: int,
                   tile_size: int = TILE_SIZE) -> DataFrame:
    """A new version of a pyramid in which only changed tiles and the tiles above them are written.

    ``cells`` is the run as it is now; ``changed`` lists ``frame, first_y, last_y`` (as ``changed_rows`` makes it): the rows of cells that may
    have changed. A changed tile is made anew from all its cells. On each level above, a tile is made from its four tiles below, those
    of this version and those that older versions hold. All other tiles are named in the new version's list with the version
    that has them. A run without a pyramid is built in full.
    """
    spark = cells.sparkSession
    versions = _versions(spark, path, run_id)
    if not versions:
        return build_pyramid(cells, path, run_id, height, width_px, tile_size)
    before, version = max(versions), max(versions) + 1
    top = pyramid_levels(height, width_px, tile_size)
    columns = -(-width_px // tile_size) - 1
    row = lambda y: F.floor((F.lit(height - 1) - F.col(y)) / tile_size).cast("int")
    dirty = settled(changed.select("frame", F.explode(F.sequence(row("last_y"), row("first_y"))).alias("tile_y")).distinct().select(
        "frame", "tile_y", F.explode(F.sequence(F.lit(0), F.lit(columns))).alias("tile_x")))
    known = _tile_list(spark, path, run_id, before)
    named = flip_rows(cells, height).select("frame", "y", "x", F.col("iterations").alias("value"))
    level = _in_tiles(named, dirty, tile_size)
    touched = dirty.withColumn("z", F.lit(top))
    for z in range(top, -1, -1):
        written = _write_level(level, _level(path, run_id, version, z), tile_size)
        if z:
            above = settled(dirty.select("frame", F.shiftright("tile_y", 1).alias("tile_y"), F.shiftright("tile_x", 1).alias("tile_x")).distinct())
            # Of the tiles below, those that stay as they are come from the versions that hold them.
            below = above.select("frame", *(F.explode(F.array(F.col(c) * 2, F.col(c) * 2 + 1)).alias(c) if c == "tile_y" else F.col(c) for c in ("tile_y", "tile_x")))
            below = below.select("frame", "tile_y", F.explode(F.array(F.col("tile_x") * 2, F.col("tile_x") * 2 + 1)).alias("tile_x"))
            kept = known.where(F.col("z") == z).join(below.join(dirty, ["frame", "tile_y", "tile_x"], "left_anti"), ["frame", "tile_y", "tile_x"])
            level = halve(written.unionByName(_whole_cells(_tiles_of(spark, path, run_id, kept, z), tile_size)))
            dirty = above
            touched = touched.unionByName(dirty.withColumn("z", F.lit(z - 1)))
    stays = known.join(touched, ["z", "frame", "tile_y", "tile_x"], "left_anti")
    _list_tiles(stays.unionByName(_level_tiles(spark, path, run_id, version)), path, run_id, version)
    return read_pyramid(spark, path, run_id)


def _level(path: str, run_id: str, version: int, z: int) -> str:
    return f"{path}/levels/run_id={run_id}/version={version}/z={z}"


def _write_level(level: DataFrame, folder: str, tile_size: int) -> DataFrame:
    """Write one level as tiles, sorted so that a tile lies in few row groups; returns its cells as written."""
    (level.select(
        "frame",
        F.floor(F.col("y") / tile_size).cast("int").alias("tile_y"),
        F.floor(F.col("x") / tile_size).cast("int").alias("tile_x"),
        (F.col("y") % tile_size).cast("int").alias("y"),
        (F.col("x") % tile_size).cast("int").alias("x"),
        F.col("value").cast("int").alias("value"))
     .hint("rebalance", "frame", "tile_y", "tile_x")
     .sortWithinPartitions("frame", "tile_y", "tile_x", "y", "x")
     .write.mode("overwrite").parquet(folder))
    return _whole_cells(level.sparkSession.read.schema(T.StructType(TILES.fields[:6])).parquet(folder), tile_size)


def _whole_cells(tiles: DataFrame, tile_size: int) -> DataFrame:
    """Cells of tiles by their place in the level."""
    return tiles.select("frame", (F.col("tile_y") * tile_size + F.col("y")).alias("y"), (F.col("tile_x") * tile_size + F.col("x")).alias("x"), "value")


def _in_tiles(level: DataFrame, tiles: DataFrame, tile_size: int) -> DataFrame:
    at = [F.floor(F.col(c) / tile_size).cast("int").alias(f"tile_{c}") for c in "yx"]
    return level.select("*", *at).join(tiles, ["frame", "tile_y", "tile_x"], "left_semi").select("frame", "y", "x", "value")


def _level_tiles(spark: SparkSession, path: str, run_id: str, version: int) -> DataFrame:
    """The tiles that one version wrote itself."""
    folder = f"{path}/levels/run_id={run_id}/version={version}"
    schema = T.StructType([*TILES.fields[:3], T.StructField("z", T.IntegerType())])
    return spark.read.schema(schema).parquet(folder).distinct().select("z", "frame", "tile_y", "tile_x", F.lit(version).alias("version"))


def _list_tiles(tiles: DataFrame, path: str, run_id: str, version: int) -> None:
    tiles.select(*TILE_INDEX.names).sortWithinPartitions("z", "frame").write.mode("overwrite").parquet(f"{path}/built/run_id={run_id}/version={version}")


def _tile_list(spark: SparkSession, path: str, run_id: str, version: int) -> DataFrame:
    return spark.read.schema(TILE_INDEX).parquet(f"{path}/built/run_id={run_id}/version={version}")


def _tiles_of(spark: SparkSession, path: str, run_id: str, listed: DataFrame, z: int | None = None) -> DataFrame:
    """Cells of the listed tiles, from the version that holds each; versions are partitions, so others are not opened."""
    versions = [r[0] for r in listed.select("version").distinct().collect()]
    folders = [f"{path}/levels/run_id={run_id}/version={v}" + ("" if z is None else f"/z={z}") for v in sorted(versions)]
    schema = T.StructType([*TILES.fields, T.StructField("version", T.IntegerType())])
    if not folders:
        return spark.createDataFrame([], schema).drop("version")
    cells = spark.read.schema(schema).option("basePath", f"{path}/levels").parquet(*folders)
    if len(folders) == 1 and z is None:
        return cells.drop("version")  # a version that was built in full
    return cells.join(listed, ["version", "z", "frame", "tile_y", "tile_x"]).select(*TILES.names)


def _versions(spark: SparkSession, path: str, run_id: str) -> list[int]:
    """Versions of a run's pyramid that are complete."""
    built = f"{path}/built/run_id={run_id}"
    return [int(n.removeprefix("version=")) for n in folder_names(spark, built)
            if any(f.startswith("part-") for f in folder_names(spark, f"{built}/{n}"))]


def read_pyramid(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """The newest pyramid of one run, or of every run."""
    runs = [run_id] if run_id is not None else [n.removeprefix("run_id=") for n in folder_names(spark, f"{path}/built")]
    newest = {r: max(_versions(spark, path, r), default=0) for r in runs}
    found = [_tiles_of(spark, path, r, _tile_list(spark, path, r, v)) for r, v in newest.items() if v]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], TILES)


def find_tile(pyramid: DataFrame, run_id: str, z: int, x: int, y: int, frame: int | None = None) -> DataFrame:
    """The cells of one tile: run and level by partition, the tile by row-group statistics."""
    tile = pyramid.filter((F.col("run_id") == run_id) & (F.col("z") == z)
                          & (F.col("tile_x") == x) & (F.col("tile_y") == y))
    return tile if frame is None else tile.filter(F.col("frame") == frame)


def tile_images(rgb_tiles: DataFrame, tile_size: int = TILE_SIZE) -> DataFrame:
    """``(run_id, frame, z, tile_y, tile_x, png)`` from tile cells with ``r, g, b``; a group is
    one tile, hence at most ``tile_size`` squared rows."""
    keys = ["run_id", "frame", "z", "tile_y", "tile_x"]
    out = T.StructType([TILES[k] for k in keys] + [T.StructField("png", T.BinaryType())])

    def pack(key, cells):
        image = png.encode(_canvas(cells, tile_size, tile_size))
        columns = {name: pa.array([k.as_py()], k.type) for name, k in zip(keys, key)}
        return pa.table({**columns, "png": pa.array([image], pa.binary())})

    inside = F.col("y").between(0, tile_size - 1) & F.col("x").between(0, tile_size - 1)
    pixels = rgb_tiles.select(*keys, *_pixel(F.col("y") * tile_size + F.col("x"), inside))
    return pixels.groupBy(*keys).applyInArrow(pack, out)


def image_cells(images: DataFrame) -> DataFrame:
    """Decode images back into cells, e.g. to check stored ones: ``png`` becomes ``y, x, r, g, b``, the other
    columns stay."""
    keys = [f for f in images.schema.fields if f.name != "png"]
    out = T.StructType(keys + [T.StructField(n, T.IntegerType()) for n in ("y", "x", "r", "g", "b")])
    names = [f.name for f in keys]

    def unpack(batches):
        for batch in batches:
            for row, image in enumerate(batch["png"].to_pylist()):
                pixels = png.decode(image)
                h, w, _ = pixels.shape
                step = max(1, CELLS_PER_TILE // w)
                for top in range(0, h, step):
                    part = pixels[top:top + step]
                    n = part.shape[0] * w
                    flat = part.reshape(n, 3).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        *(pa.repeat(batch[name][row], n) for name in names),
                        pa.array(np.repeat(np.arange(top, top + part.shape[0], dtype=np.int32), w)),
                        pa.array(np.tile(np.arange(w, dtype=np.int32), part.shape[0])),
                        *[pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)],
                    ], names=out.names)

    return images.select(*names, "png").mapInArrow(unpack, out)
