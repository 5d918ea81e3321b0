"""Fixed schemas, defaults and limits shared by every module."""

from pyspark.sql import types as T

# The default zoom, the cell range of an unsigned 16-bit count and
# the tolerances each kernel mode declares against the exact one.
DEFAULT_CENTER_RE = -0.743643887037151
DEFAULT_CENTER_IM = 0.131825904205330
DEFAULT_INITIAL_WIDTH = 3.5
DEFAULT_FINAL_WIDTH = 1e-3
CELL_MIN = 0
CELL_MAX = 65535
DECLARED_TOLERANCE = {  # mode: (percent of cells, iterations)
    "exact": (0.0, 0),
    "early_exit": (1.0, 1),
    "float32": (5.0, 1),
}

MODES = tuple(DECLARED_TOLERANCE)

# A block of frames that share a folder, a kernel task and a kernel call are each kept near
# these sizes; a task is also kept near so many steps of cells.
CELLS_PER_BLOCK = 4096 * 4096
CELLS_PER_TASK = 262_144
CELLS_PER_TILE = 262_144
STEPS_PER_TASK = 134_217_728
# Cells of a band of rows, which is stored as one value and described by one zone.
CELLS_PER_BAND = 32_768

VIEWS = T.StructType([
    T.StructField("frame", T.IntegerType()),
    T.StructField("center_re", T.DoubleType()),
    T.StructField("center_im", T.DoubleType()),
    T.StructField("width", T.DoubleType()),
])

CELLS = T.StructType([
    T.StructField("frame", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("iterations", T.IntegerType()),
])

# Shape and settings of a run.
RUN_SPEC = T.StructType([
    T.StructField("height", T.IntegerType()),
    T.StructField("width_px", T.IntegerType()),
    T.StructField("n_frames", T.IntegerType()),
    T.StructField("max_iter", T.IntegerType()),
    T.StructField("mode", T.StringType()),
    T.StructField("frames_per_block", T.IntegerType()),
    T.StructField("layout", T.StringType()),
])

LAYOUTS = ("bands", "cells")

PIXELS = T.StructType(CELLS.fields + [
    T.StructField("run_id", T.StringType()),
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("frame_block", T.IntegerType()),
])

ZONES = T.StructType([
    T.StructField("frame", T.IntegerType()),
    T.StructField("band", T.IntegerType()),
    T.StructField("n_cells", T.LongType()),
    T.StructField("again", T.LongType()),
    T.StructField("min_iter", T.IntegerType()),
    T.StructField("max_seen", T.IntegerType()),
    T.StructField("in_set", T.LongType()),
    T.StructField("last_y", T.IntegerType()),
    T.StructField("last_x", T.IntegerType()),
    T.StructField("digest", T.LongType()),
    T.StructField("histogram", T.ArrayType(T.LongType())),
])
ZONE_COLUMNS = ("n_cells", "min_iter", "max_seen", "in_set", "last_y", "last_x", "digest", "histogram")

BANDS = T.StructType(ZONES.fields + [T.StructField("cells", T.BinaryType())])

FRAMES = T.StructType(VIEWS.fields + [
    T.StructField("n_cells", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("snapshot_id", T.StringType()),
])

COMMITS = T.StructType([
    T.StructField("commit_seq", T.LongType()),
    T.StructField("message", T.StringType()),
    T.StructField("n_frames", T.LongType()),
    T.StructField("n_cells", T.LongType()),
    T.StructField("elapsed_s", T.DoubleType()),
    T.StructField("first_frame", T.IntegerType()),
    T.StructField("last_frame", T.IntegerType()),
    T.StructField("spec", RUN_SPEC),
    T.StructField("snapshot_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

METRICS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("stage_id", T.StringType()),
    T.StructField("stage_name", T.StringType()),
    T.StructField("max_iter", T.IntegerType()),
    T.StructField("schedule_name", T.StringType()),
    T.StructField("git_sha", T.StringType()),
    T.StructField("wall_time_seconds", T.DoubleType()),
    T.StructField("peak_memory_mb", T.DoubleType()),
])

PALETTE = T.StructType([
    T.StructField("bin", T.IntegerType()),
    T.StructField("r", T.IntegerType()),
    T.StructField("g", T.IntegerType()),
    T.StructField("b", T.IntegerType()),
])


def check_max_iter(max_iter: int) -> int:
    """The cell type cannot hold a sentinel above ``CELL_MAX``; refuse it up front."""
    if not 1 <= max_iter <= CELL_MAX:
        raise ValueError(f"max_iter must be in 1..{CELL_MAX}, got {max_iter}")
    return int(max_iter)


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown kernel mode {mode!r}; choose one of {', '.join(MODES)}")
    return mode
