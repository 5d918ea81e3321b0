"""The registered queries: every operator run over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridscale.functions.kernels import (
    escape_count,
    escape_count_native,
    is_cell,
    membership_class,
    to_cell,
)
from gridscale.functions.palettes import ember_palette
from gridscale.operators.bands import compute_bands
from gridscale.operators.compare import compare_frames, compare_runs
from gridscale.operators.compute import compute_frames
from gridscale.operators.deep import deep_frames
from gridscale.operators.layout import tile_window, write_tile_layout
from gridscale.operators.materialise import fan_out, fill_pending, materialise, pending, zoom_run
from gridscale.operators.metrics import (
    compare_metrics,
    ms_per_frame,
    ms_per_frame_by_task,
    read_metrics,
    record_metrics,
)
from gridscale.operators.render import (
    apply_palette,
    build_pyramid,
    even_size,
    find_tile,
    flip_rows,
    frame_images,
    image_cells,
    normalise_global,
    normalise_per_frame,
    pad_even,
    pyramid_levels,
    tile_images,
    update_pyramid,
)
from gridscale.operators.stats import (
    check_views,
    check_widths_decrease,
    check_widths_log_uniform,
    frame_stats,
    global_max,
    mixed_frames,
)
from gridscale.operators.store import GridStore
from gridscale.operators.zones import (
    cells_above,
    changed_rows,
    compare_commits,
    normalise_stored_global,
    normalise_stored_per_frame,
    stored_frame_stats,
    stored_global_max,
    stored_histogram,
    stored_mixed_frames,
)
from gridscale.plans import inputs
from gridscale.session import shared_folder
from gridscale.sources.grid import fill_grid, frame_ranges, pixel_grid, split_frames, tile_grid
from gridscale.sources.runs import register, write_bands
from gridscale.sources.schedule import schedules_from
from gridscale.streaming.fill import fill_from_stream, frame_requests
from gridscale.streaming.requests import fill_orders, frame_events, frame_orders

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SIZE = 8  # cells per axis of a customer view
STORE_SIZE = 16  # and of a supplier view kept in a store
FRAME_STEPS = 50
POINT_STEPS = 128
CYCLE_SIZE, CYCLE_STEPS = 12, 2000  # cells per axis and steps where orbits repeat
DEEP_STEPS = 200
LARGE_SIZE, LARGE_STEPS = 90, 24  # per axis of a supplier view in tiles
TILE = 32


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# -- sources, schedules, grids ---------------------------------------------------------

def _rounded_schedule(params):
    return schedules_from(params).withColumns(
        {c: F.round(c, 8) for c in ("center_re", "center_im", "width")})


@query
def g1_zoom_schedule(spark, d):
    return _rounded_schedule(inputs.run_requests(spark, d))


@query
def g2_schedule_overrides(spark, d):
    return _rounded_schedule(inputs.run_requests_with_overrides(spark, d))


@query
def g3_pixel_grid(spark, d):
    return pixel_grid(inputs.customer_views(spark, d), SIZE, SIZE).select("frame", "y", "x", "re", "im")


@query
def g4_tile_grid(spark, d):
    return tile_grid(inputs.customer_views(spark, d), 50, 70, 6).select(
        "frame", "tile_y", "tile_x", "y0", "y1", "x0", "x1")


@query
def g5_frame_ranges(spark, d):
    views = inputs.customer_views(spark, d)
    return split_frames(views, views.count(), 8).select("frame", "task_index")


@query
def g5_range_bounds(spark, d):
    """The clamped ranges of frames over workers, and the customers' views in each."""
    views = inputs.customer_views(spark, d)
    n_frames = views.count()
    taken = split_frames(views, n_frames, 11).groupBy("task_index").agg(F.count("*").alias("n_views"))
    return frame_ranges(spark, n_frames, 11).join(taken, "task_index", "left").select(
        "task_index", "start", "stop", F.coalesce("n_views", F.lit(0)).alias("n_views"))


@query
def g6_points(spark, d):
    return inputs.orders_points(spark, d).select(
        "o_orderkey", "re", "im", escape_count("re", "im", POINT_STEPS).alias("iterations"))


@query
def g7_grid_from_table(spark, d):
    return inputs.event_cube(spark, d)


@query
def g7_grid_filled(spark, d):
    return fill_grid(inputs.event_cube(spark, d), inputs.event_frames(spark, d), inputs.EVENTS_HEIGHT,
                     inputs.event_width(spark, d))


# -- per cell --------------------------------------------------------------------------

def _lineitem_counts(spark, d, mode):
    return inputs.lineitem_points(spark, d).select(
        "l_orderkey", "l_linenumber", "re", "im",
        escape_count("re", "im", POINT_STEPS, mode).alias("iterations"))


@query
def k1_exact_points(spark, d):
    return _lineitem_counts(spark, d, "exact")


@query
def k1_exact_frames(spark, d):
    return compute_frames(inputs.customer_views(spark, d), SIZE, SIZE, FRAME_STEPS, "exact")


@query
def k1_exact_native(spark, d):
    return inputs.orders_points(spark, d).select(
        "o_orderkey", "re", "im", escape_count_native("re", "im", POINT_STEPS).alias("iterations"))


@query
def k2_early_exit_points(spark, d):
    return _lineitem_counts(spark, d, "early_exit")


@query
def k2_early_exit_frames(spark, d):
    return compute_frames(inputs.customer_views(spark, d), SIZE, SIZE, FRAME_STEPS, "early_exit", n_tiles=3)


@query
def k2_cycles_frames(spark, d):
    """So many steps that orbits in the set are left at their first repetition."""
    return compute_frames(inputs.supplier_views(spark, d), CYCLE_SIZE, CYCLE_SIZE, CYCLE_STEPS)


@query
def k3_membership_class(spark, d):
    return inputs.lineitem_points(spark, d).select(
        "l_orderkey", "l_linenumber", "re", "im", membership_class("re", "im").alias("class"))


@query
def k4_float32_points(spark, d):
    return _lineitem_counts(spark, d, "float32")


@query
def k4_float32_embeddings(spark, d):
    return inputs.embedding_points(spark, d).select(
        "vec_id", "pair", "re", "im", escape_count("re", "im", POINT_STEPS, "float32").alias("iterations"))


@query
def k4_deep_frames(spark, d):
    """A view per supplier of a width of 1e-20 and less, where neighbouring cells are one double."""
    return deep_frames(inputs.deep_views(spark, d), SIZE, SIZE, DEEP_STEPS)


@query
def k5_cell_type(spark, d):
    value = F.floor("o_totalprice")
    return inputs.table(spark, d, "orders").select(
        "o_orderkey", is_cell(value).alias("fits"), F.when(is_cell(value), to_cell(value)).otherwise(-1).alias("cell"))


# -- store -----------------------------------------------------------------------------

def _new_store(spark, layout="bands"):
    return GridStore(spark, shared_folder(spark), layout)


def _event_store(spark, d, restated=False, layout="bands"):
    """A fresh store with the event cube as one commit, and the restated weekends as another."""
    store = _new_store(spark, layout)
    store.create_run("events", inputs.event_frames(spark, d), inputs.EVENTS_HEIGHT, inputs.event_width(spark, d))
    views = inputs.event_views(spark, d)
    store.write_frames("events", inputs.event_cube(spark, d), views, "all events")
    if restated:
        store.write_frames("events", inputs.event_cube_weekends_restated(spark, d), views,
                           "weekends without errors")
    return store


@query
def s1_create_run(spark, d):
    store = _event_store(spark, d)
    store.create_run("events", inputs.event_frames(spark, d), inputs.EVENTS_HEIGHT, inputs.event_width(spark, d))
    return store.frames("events").select("frame", "center_re", "center_im", "width", "n_cells")


@query
def s2_create_if_absent(spark, d):
    store = _event_store(spark, d)
    again = store.create_run_if_absent("events", 1, 1, 1)
    return store.describe("events").withColumn("created_again", F.lit(again))


@query
def s3_write_frames(spark, d):
    return _event_store(spark, d).read("events")


@query
def s4_commit_log(spark, d):
    return (_event_store(spark, d, restated=True).commit_frames("events")
            .select("commit_seq", "frame", "message", "n_cells", "width"))


@query
def s5_read_latest(spark, d):
    return _event_store(spark, d, restated=True).read("events")


@query
def s5_read_values(spark, d):
    """Cells of two to four events: bands without such cells are skipped."""
    return _event_store(spark, d, restated=True).read("events", values=(2, 4))


@query
def s5_read_rows_layout(spark, d):
    """The same cells from a store that keeps one row per cell."""
    return _event_store(spark, d, restated=True, layout="cells").read("events")


@query
def s6_read_as_of(spark, d):
    return _event_store(spark, d, restated=True).read("events", as_of=2)


@query
def s7_history(spark, d):
    return (_event_store(spark, d, restated=True).history("events")
            .select("commit_seq", "message", "n_frames", "n_cells"))


@query
def s8_scan_run(spark, d):
    return _event_store(spark, d, restated=True).describe("events")


@query
def s9_read_frame(spark, d):
    return _event_store(spark, d, restated=True).read_frame("events", 6)


@query
def s10_select_by_width(spark, d):
    return _event_store(spark, d, restated=True).select("events", width_between=(0.5, 1.75))


@query
def s10_select_one_width(spark, d):
    return _event_store(spark, d).select("events", width=0.875)


@query
def s11_list_runs(spark, d):
    store = _event_store(spark, d, restated=True)
    store.create_run("weekends", inputs.event_frames(spark, d), inputs.EVENTS_HEIGHT, inputs.event_width(spark, d))
    store.write_frames("weekends", inputs.event_cube_weekends_restated(spark, d))
    store.create_run("empty", 5, inputs.EVENTS_HEIGHT, inputs.event_width(spark, d))
    return store.list_runs()


@query
def s12_dense_view(spark, d):
    store = _new_store(spark)
    store.create_run("events", inputs.event_frames(spark, d), inputs.EVENTS_HEIGHT, inputs.event_width(spark, d))
    store.write_frames("events", inputs.event_cube_weekends_restated(spark, d),
                       inputs.event_views(spark, d))
    return store.dense("events")


# -- materialisation -------------------------------------------------------------------

def _supplier_store(spark, d):
    """A fresh store with an empty run that has a frame slot per supplier."""
    store = _new_store(spark)
    views = inputs.supplier_views(spark, d)
    n_frames = views.agg(F.max("frame")).first()[0] + 1
    store.create_run("zoom", n_frames, STORE_SIZE, STORE_SIZE, FRAME_STEPS, "exact")
    return store, views


def _zoom_store(spark, d):
    store, views = _supplier_store(spark, d)
    materialise(store, "zoom", views)
    return store


def _requested_views(spark, d, views):
    return views.join(inputs.requested_suppliers(spark, d), "frame", "left_semi")


@query
def m1_materialise_frames(spark, d):
    store, views = _supplier_store(spark, d)
    materialise(store, "zoom", _requested_views(spark, d, views))
    return store.read("zoom")


@query
def m1_materialise_by_cost(spark, d):
    """All suppliers' views, their bands dealt to tasks by predicted cost."""
    store, views = _supplier_store(spark, d)
    materialise(store, "zoom", views, by_cost=True)
    return store.read("zoom")


@query
def m2_zoom_run(spark, d):
    store = _new_store(spark)
    zoom_run(store, "zoom", inputs.supplier_views(spark, d), STORE_SIZE, STORE_SIZE, FRAME_STEPS)
    return store.read("zoom")


@query
def m3_fan_out(spark, d):
    store, views = _supplier_store(spark, d)
    staged = [fan_out(store, "zoom", views, 4, task) for task in range(4)]
    store.commit("zoom", [s for s in staged if s])
    return (store.commit_frames("zoom").groupBy("commit_seq", "message")
            .agg(F.min("frame").alias("first"), F.max("frame").alias("last"), F.sum("n_cells").alias("n_cells")))


@query
def m3_time_per_frame(spark, d):
    """Frames and cells each commit accounts for; times vary, so only their presence is shown."""
    store, views = _supplier_store(spark, d)
    materialise(store, "zoom", views)
    log = store.commit_frames("zoom")
    return ms_per_frame(log, ("run_id", "commit_seq")).select(
        "run_id", "commit_seq", "n_frames", (F.col("ms_per_frame") > 0).alias("timed"))


@query
def m4_pending_frames(spark, d):
    store, views = _supplier_store(spark, d)
    materialise(store, "zoom", _requested_views(spark, d, views))
    return pending(store, "zoom", views)


@query
def m5_fill_pending(spark, d):
    store, views = _supplier_store(spark, d)
    materialise(store, "zoom", _requested_views(spark, d, views))
    fill_pending(store, "zoom", views)
    return store.read("zoom", by_frame=store.live_frames("zoom").select("frame", "commit_seq"))


@query
def m6_fill_from_stream(spark, d):
    store, views = _supplier_store(spark, d)
    requests = f"{store.root}/requests"
    wanted = inputs.requested_suppliers(spark, d)
    wanted.repartition(2, "frame").write.parquet(requests)
    wanted.write.mode("append").parquet(requests)
    stream = frame_requests(spark, requests, files_per_batch=2)
    fill_from_stream(stream, store, "zoom", views, f"{store.root}/checkpoint").awaitTermination()
    return store.read("zoom")


@query
def m6_fill_requests(spark, d):
    """Requested frames by a stream that keeps the state of each; every frame is asked for twice."""
    store, views = _supplier_store(spark, d)
    folder = f"{store.root}/events"
    asked = inputs.requested_suppliers(spark, d).select(F.lit("zoom").alias("run_id"), "frame", F.lit("asked").alias("event"))
    asked.unionAll(asked).write.parquet(folder)
    orders = frame_orders(frame_events(spark, folder))
    fill_orders(orders, store, views.withColumn("run_id", F.lit("zoom")), folder, f"{store.root}/checkpoint").awaitTermination()
    return store.read("zoom")


@query
def s5_read_source(spark, d):
    """Frames of a run by width through the data source, after frames of a later commit took the place of some."""
    register(spark)
    store = _event_store(spark, d, restated=True)
    cells = spark.read.format("gridscale_run").option("path", store.root).option("run", "events").load()
    return cells.filter("width < 1 AND frame >= 10").select("frame", "y", "x", "iterations")


@query
def s3_write_source(spark, d):
    """All suppliers' views written through the data source, as one commit."""
    register(spark)
    store, views = _supplier_store(spark, d)
    n_frames = store.state("zoom").spec["n_frames"]
    bands = compute_bands(views, STORE_SIZE, STORE_SIZE, FRAME_STEPS, "exact", n_frames)
    write_bands(bands.join(views, "frame"), store.root, "zoom")
    return store.read("zoom")


# -- aggregation, validation, comparison -----------------------------------------------

@query
def a1_frame_stats(spark, d):
    cells = compute_frames(inputs.customer_views(spark, d), SIZE, SIZE, FRAME_STEPS)
    return frame_stats(cells, FRAME_STEPS)


@query
def a1_large_frame_stats(spark, d):
    """A larger frame per supplier, each of sixteen tiles over several tasks."""
    cells = compute_frames(inputs.supplier_views(spark, d), LARGE_SIZE, LARGE_SIZE, LARGE_STEPS, "exact", n_tiles=4)
    return frame_stats(cells, LARGE_STEPS)


@query
def a1_stored_frame_stats(spark, d):
    return stored_frame_stats(_zoom_store(spark, d), "zoom")


@query
def a1_stored_histogram(spark, d):
    return stored_histogram(_event_store(spark, d, restated=True), "events")


@query
def a2_stored_global_max(spark, d):
    return stored_global_max(_event_store(spark, d, restated=True), "events")


@query
def a2_cells_above(spark, d):
    """Cells in the bins that the busiest hundredth reaches into."""
    return cells_above(_event_store(spark, d, restated=True), "events", 0.01)


@query
def a2_global_max(spark, d):
    return global_max(_lineitem_counts(spark, d, "early_exit"))


@query
def q1_compare_runs(spark, d):
    return compare_runs(inputs.event_cube_without_errors(spark, d), inputs.event_cube(spark, d))


@query
def q1_compare_modes(spark, d):
    views = inputs.customer_views(spark, d)
    return compare_runs(compute_frames(views, SIZE, SIZE, FRAME_STEPS, "float32"),
                        compute_frames(views, SIZE, SIZE, FRAME_STEPS, "exact"), 5.0, 1)


@query
def q2_compare_frames(spark, d):
    return compare_frames(inputs.event_cube_without_errors(spark, d), inputs.event_cube(spark, d), 1.0, 0)


@query
def q2_compare_commits(spark, d):
    """The restated weekends against the state before them: only their bands are opened."""
    return compare_commits(_event_store(spark, d, restated=True), "events", 2, 3, 1.0, 0)


@query
def v1_mixed_frames(spark, d):
    cells = compute_frames(inputs.customer_views(spark, d), SIZE, SIZE, FRAME_STEPS)
    return mixed_frames(cells, FRAME_STEPS)


@query
def v1_stored_mixed_frames(spark, d):
    return stored_mixed_frames(_zoom_store(spark, d), "zoom")


@query
def v2_views_complete(spark, d):
    return check_views(schedules_from(inputs.run_requests_with_overrides(spark, d)))


@query
def v3_widths_decrease(spark, d):
    return check_widths_decrease(schedules_from(inputs.run_requests_with_overrides(spark, d)))


@query
def v4_widths_log_uniform(spark, d):
    checked = check_widths_log_uniform(schedules_from(inputs.run_requests_with_overrides(spark, d)))
    return checked.withColumn("mean_step", F.round("mean_step", 8))


# -- colour, orientation, tiles --------------------------------------------------------

@query
def r1_normalise_global(spark, d):
    return normalise_global(inputs.event_cube(spark, d)).withColumn("v", F.col("v").cast("double"))


@query
def r2_normalise_per_frame(spark, d):
    return normalise_per_frame(inputs.event_cube(spark, d))


@query
def r1_normalise_stored(spark, d):
    return normalise_stored_global(_event_store(spark, d), "events").withColumn("v", F.col("v").cast("double"))


@query
def r2_normalise_stored(spark, d):
    return normalise_stored_per_frame(_event_store(spark, d), "events")


@query
def r3_apply_palette(spark, d):
    coloured = apply_palette(normalise_global(inputs.event_cube(spark, d)), ember_palette(spark))
    return coloured.select("frame", "y", "x", "r", "g", "b")


@query
def r4_flip_rows(spark, d):
    return flip_rows(inputs.event_cube(spark, d), inputs.EVENTS_HEIGHT)


def _order_pictures(spark, d):
    """The order cube as padded RGB cells in image order, with the size they fill."""
    h, w = inputs.ORDERS_HEIGHT, inputs.ORDERS_WIDTH
    coloured = apply_palette(normalise_per_frame(inputs.order_cube(spark, d)), ember_palette(spark))
    rgb = coloured.select("frame", "y", "x", "r", "g", "b")
    return pad_even(flip_rows(rgb, h), h, w), *even_size(h, w)


@query
def r5_pad_even(spark, d):
    h, w = inputs.ORDERS_HEIGHT, inputs.ORDERS_WIDTH
    return pad_even(flip_rows(inputs.order_cube(spark, d), h), h, w)


@query
def r6_frame_images(spark, d):
    """Images decoded again: lit pixels and channel sums show that every byte arrived."""
    pixels = image_cells(frame_images(*_order_pictures(spark, d)))
    return pixels.groupBy("frame").agg(
        (F.max("y") + 1).alias("height"), (F.max("x") + 1).alias("width_px"),
        *_channel_sums(even_size(inputs.ORDERS_HEIGHT, inputs.ORDERS_WIDTH)[1]))


def _channel_sums(width_px):
    """Per channel its sum and its sum weighted by the place of each pixel."""
    place = F.col("y") * width_px + F.col("x") + 1
    return [*(F.sum(c).alias(c) for c in "rgb"), *(F.sum(F.col(c) * place).alias(f"weighted_{c}") for c in "rgb")]


def _pyramid(spark, d):
    width = inputs.event_width(spark, d)
    path = f"{shared_folder(spark)}/tiles"
    tiles = build_pyramid(inputs.event_cube(spark, d), path, "events", inputs.EVENTS_HEIGHT, width, TILE)
    return tiles, pyramid_levels(inputs.EVENTS_HEIGHT, width, TILE)


@query
def r6_tile_images(spark, d):
    """One PNG per tile of the pyramid, decoded again; each channel holds other bits of the value."""
    tiles, _ = _pyramid(spark, d)
    value = F.col("value")
    lit = tiles.withColumns({"r": value % 256, "g": F.shiftright(value, 2) % 256, "b": 255 - value % 256})
    return image_cells(tile_images(lit, TILE)).groupBy("run_id", "frame", "z", "tile_y", "tile_x").agg(
        F.count("*").alias("n_pixels"), *_channel_sums(TILE))


@query
def r7_tile_pyramid(spark, d):
    tiles, _ = _pyramid(spark, d)
    return tiles.select("run_id", "frame", "z", "tile_y", "tile_x", "y", "x", "value")


@query
def r7_updated_pyramid(spark, d):
    """The pyramid after the weekends were restated: only their tiles and those above are written anew."""
    store, width = _event_store(spark, d, restated=True), inputs.event_width(spark, d)
    path = f"{shared_folder(spark)}/tiles"
    build_pyramid(store.read("events", 2), path, "events", inputs.EVENTS_HEIGHT, width, TILE)
    tiles = update_pyramid(store.read("events"), changed_rows(store, "events", 2), path, "events", inputs.EVENTS_HEIGHT, width, TILE)
    return tiles.select("run_id", "frame", "z", "tile_y", "tile_x", "y", "x", "value")


@query
def r8_find_tile(spark, d):
    tiles, top = _pyramid(spark, d)
    return find_tile(tiles, "events", top, 0, 0).select("frame", "y", "x", "value")


@query
def r8_tile_window(spark, d):
    """A window of tiles of 21 frames, found by ranges of keys along the curve."""
    tiles, top = _pyramid(spark, d)
    path = f"{shared_folder(spark)}/layout"
    write_tile_layout(tiles, path)
    return tile_window(spark, path, "events", top, (5, 25), (0, 1), (1, 3)).select("frame", "tile_y", "tile_x", "y", "x", "value")


# -- run metrics -----------------------------------------------------------------------

def _metrics_of_events(spark, d):
    """Every event as the metrics of a run: its type is the stage, its value the seconds."""
    props = F.from_json("props", "k INT")
    return inputs.table(spark, d, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("stage_id"),
        F.upper("event_type").alias("stage_name"),
        props["k"].alias("max_iter"),
        F.concat(F.lit("day "), F.lpad(inputs.day().cast("string"), 4, "0")).alias("schedule_name"),
        F.lit(None).cast("string").alias("git_sha"),
        F.col("value").alias("wall_time_seconds"),
        F.lit(None).cast("double").alias("peak_memory_mb"))


def _frame_log_of_events(spark, d):
    return inputs.table(spark, d, "events").select(
        F.col("event_type").alias("run_id"), inputs.day().alias("frame"), F.col("value").alias("elapsed_s"))


@query
def b1_record_metrics(spark, d):
    path = f"{shared_folder(spark)}/metrics"
    record_metrics(_metrics_of_events(spark, d), path)
    return read_metrics(spark, path)


@query
def b2_compare_metrics(spark, d):
    return compare_metrics(_metrics_of_events(spark, d), "click").withColumns(
        {c: F.round(c, 8) for c in ("mean_seconds", "speedup")})


@query
def b3_ms_per_frame(spark, d):
    return ms_per_frame(_frame_log_of_events(spark, d)).withColumns(
        {c: F.round(c, 6) for c in ("total_s", "ms_per_frame")})


@query
def b3_ms_per_frame_by_task(spark, d):
    return ms_per_frame_by_task(_frame_log_of_events(spark, d), inputs.event_frames(spark, d), 8).withColumns(
        {c: F.round(c, 6) for c in ("total_s", "ms_per_frame")})
