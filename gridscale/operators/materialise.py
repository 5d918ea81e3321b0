"""Materialise frames into a store: chosen ones, all of them, or those still missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscale.operators.bands import compute_bands
from gridscale.operators.compute import compute_frames
from gridscale.operators.store import GridStore, Staged
from gridscale.session import settled
from gridscale.sources.grid import frame_range_key


def _checked(store: GridStore, run_id: str, views: DataFrame):
    """The run's settings and state, the views settled, and their number and range."""
    state = store.state(run_id)
    views = settled(views.select("frame", "center_re", "center_im", "width"))
    fits = F.col("frame").between(0, state.spec["n_frames"] - 1)
    seen = views.agg(F.count("*").alias("n"), F.count_distinct("frame").alias("frames"), F.count_if(fits).alias("fitting"),
                     F.min("frame").alias("first"), F.max("frame").alias("last")).first()
    if seen["fitting"] != seen["n"]:
        raise ValueError(f"views list frames outside 0..{state.spec['n_frames'] - 1}")
    if seen["n"] != seen["frames"]:
        raise ValueError("views list the same frame more than once")
    return state.spec, views, seen


def _stage(store: GridStore, run_id: str, spec, views: DataFrame, n: int, message: str | None, by_cost: bool = False) -> Staged:
    if spec["layout"] == "bands":
        bands = compute_bands(views, spec["height"], spec["width_px"], spec["max_iter"], spec["mode"], n, by_cost)
        return store.stage_bands(run_id, bands, views, message, spec)
    cells = compute_frames(views, spec["height"], spec["width_px"], spec["max_iter"], spec["mode"], n_frames=n)
    return store.stage_frames(run_id, cells, views, message, ordered=True, spec=spec)


def materialise(store: GridStore, run_id: str, views: DataFrame, message: str | None = None,
                frames_per_commit: int | None = None, by_cost: bool = False) -> str | None:
    """Compute the given views with the run's settings and commit them; returns the last snapshot id.

    All frames are one job and one commit, or one for each range of ``frames_per_commit`` frame
    numbers: after a crash the finished ranges are kept and ``fill_pending`` does the rest. No views, no commit.
    ``views`` must list a frame once; they are settled first, because the job passes over
    them several times and they must not change meanwhile. ``by_cost`` deals bands of cells to tasks by their predicted cost.
    """
    spec, views, seen = _checked(store, run_id, views)
    if seen["n"] == 0:
        return None
    snapshot = None
    step = frames_per_commit or spec["n_frames"]
    if step < 1:
        raise ValueError(f"frames_per_commit must be at least 1, got {frames_per_commit}")
    for first in range(seen["first"] // step * step, seen["last"] + 1, step):
        part = views if step >= spec["n_frames"] else views.filter(F.col("frame").between(first, first + step - 1))
        n = seen["n"] if part is views else part.count()
        if n:
            staged = _stage(store, run_id, spec, part, n, message, by_cost)
            store.commit(run_id, [staged])
            snapshot = staged.snapshot_id
    return snapshot


def zoom_run(store: GridStore, run_id: str, views: DataFrame, height: int, width_px: int,
             max_iter: int, mode: str = "early_exit", frames_per_commit: int | None = None) -> str | None:
    """A whole run: create it if absent and materialise every view. Frames run from 0.

    A run that exists must have the same shape and settings."""
    n_frames = (views.agg(F.max("frame")).first()[0] or 0) + 1
    if not store.create_run_if_absent(run_id, n_frames, height, width_px, max_iter, mode):
        spec = store.state(run_id).spec
        asked = {"n_frames": n_frames, "height": height, "width_px": width_px, "max_iter": max_iter, "mode": mode}
        differing = {k: (spec[k], v) for k, v in asked.items() if spec[k] != v}
        if differing:
            raise ValueError(f"run {run_id!r} exists with other settings (its own, asked for): {differing}")
    return materialise(store, run_id, views, frames_per_commit=frames_per_commit)


def fan_out(store: GridStore, run_id: str, views: DataFrame, n_tasks: int, task_index: int) -> Staged | None:
    """Stage the share of one of ``n_tasks`` workers: its contiguous range of frames.

    For callers that spread a run over separate applications; inside one application ``materialise``
    already spreads all frames. The run exists before the workers start, and afterwards one
    caller commits what they return with ``store.commit``."""
    if not 0 <= task_index < n_tasks:
        raise ValueError(f"task {task_index} of {n_tasks}")
    key = frame_range_key("frame", store.state(run_id).spec["n_frames"], n_tasks)
    spec, views, seen = _checked(store, run_id, views.filter(key == task_index))
    return _stage(store, run_id, spec, views, seen["n"], f"task {task_index} of {n_tasks}") if seen["n"] else None


def pending(store: GridStore, run_id: str, views: DataFrame) -> DataFrame:
    """The views whose frame has no commit since the run was created."""
    return views.join(store.live_frames(run_id).select("frame"), "frame", "left_anti")


def fill_pending(store: GridStore, run_id: str, views: DataFrame, message: str | None = None,
                 frames_per_commit: int | None = None) -> str | None:
    """Materialise what is pending; after a crash or a partial run, run it again."""
    return materialise(store, run_id, pending(store, run_id, views), message, frames_per_commit)
