"""A run store on plain Parquet: immutable data folders and a log that names them.

Layout below the root::

    pixels/run_id=R/snapshot_id=S/frame_block=B   what one commit wrote: bands of cells, or one row per cell
    zones/run_id=R/snapshot_id=S                  range, sums and digest of each band it wrote
    frames/run_id=R/snapshot_id=S                 view and cell count of each frame it wrote
    commits/run_id=R/version=N.json               the entries of the N-th append to the log

A commit writes its data folders first and one log file last. That file is written under a name of its own and
then published by a rename that fails if its version exists, so it appears whole or not at all: a job that dies midway leaves
files nobody looks at, and of two committers that start from one version the later one fails and changes nothing. Readers
open exactly the folders that the log names, and a folder that is gone is an error.
Workers only *stage* data: they write folders and hand back what a commit needs to name them.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from gridscale.operators.bands import band_of, bands_of_cells, cells_of_bands
from gridscale.schema import (
    BANDS, CELL_MAX, CELLS, CELLS_PER_BLOCK, COMMITS, FRAMES, LAYOUTS, PIXELS, RUN_SPEC, VIEWS, ZONES, check_max_iter, check_mode,
)
from gridscale.session import folder_names, publish_once, read_text
from gridscale.sources.grid import grid_tasks, missing_cells

CREATE_MESSAGE = "create run"

#: Appends after which a log file holds the whole log again; a reader opens no more files than this.
APPENDS_PER_WHOLE_LOG = 64
_VERSION = re.compile(r"version=(\d+)\.json")
_FOLDER = [T.StructField("run_id", T.StringType()), T.StructField("snapshot_id", T.StringType())]
_BAND_FILES = T.StructType([*BANDS.fields, *_FOLDER, T.StructField("frame_block", T.IntegerType())])
_ZONE_FILES = T.StructType([*ZONES.fields, *_FOLDER])


class Staged(NamedTuple):
    """Frames that are written and not yet part of a run."""

    snapshot_id: str
    message: str
    n_frames: int
    n_cells: int
    elapsed_s: float
    first_frame: int | None = None
    last_frame: int | None = None


class RunState(NamedTuple):
    """What the log says about a run at one point of its history."""

    spec: Row
    created_at: int
    head: int
    commits: tuple[Row, ...]  # those since the creation that wrote frames, oldest first


class GridStore:
    """Runs below ``root``. ``layout`` is that of new runs: ``bands`` keeps a band of cells in one row, ``cells`` one row per cell,
    for readers that do not know this library."""

    def __init__(self, spark: SparkSession, root: str, layout: str = "bands"):
        if layout not in LAYOUTS:
            raise ValueError(f"unknown layout {layout!r}; choose one of {', '.join(LAYOUTS)}")
        self.spark = spark
        self.root = root.rstrip("/")
        self.layout = layout
        self._logs: dict[str, tuple[int, list[Row]]] = {}  # by run: a version, which never changes, and its rows

    # -- creating runs ---------------------------------------------------------------

    def create_run(self, run_id: str, n_frames: int, height: int, width_px: int,
                   max_iter: int = CELL_MAX, mode: str = "early_exit") -> str:
        """Start a run with ``n_frames`` unwritten frames; an existing run of that name starts
        afresh (its earlier commits stay readable with ``as_of``). Returns the snapshot id."""
        if not re.fullmatch(r"[\w.-]+", run_id, re.ASCII):
            raise ValueError(f"a run id names a folder: letters, digits, '_', '.' and '-' only, got {run_id!r}")
        if n_frames < 1 or height < 1 or width_px < 1:
            raise ValueError(f"a run needs frames and cells, got {n_frames} x {height} x {width_px}")
        check_max_iter(max_iter)
        check_mode(mode)
        snapshot = uuid.uuid4().hex
        per_block = max(1, CELLS_PER_BLOCK // (height * width_px))
        self._append(run_id, [{
            "snapshot_id": snapshot, "message": CREATE_MESSAGE, "n_frames": 0, "n_cells": 0, "elapsed_s": 0.0,
            "spec": {"height": height, "width_px": width_px, "n_frames": n_frames, "max_iter": max_iter, "mode": mode,
                     "frames_per_block": per_block, "layout": self.layout}}])
        return snapshot

    def create_run_if_absent(self, run_id: str, n_frames: int, height: int, width_px: int,
                             max_iter: int = CELL_MAX, mode: str = "early_exit") -> bool:
        """Create the run unless the log already knows it; True if it was created."""
        if self.exists(run_id):
            return False
        self.create_run(run_id, n_frames, height, width_px, max_iter, mode)
        return True

    def exists(self, run_id: str) -> bool:
        return self._newest(run_id) > 0

    # -- the log ---------------------------------------------------------------------

    def commits(self, run_id: str | None = None) -> DataFrame:
        """The log: ``run_id, commit_seq, snapshot_id, message, n_frames, n_cells, elapsed_s, first_frame, last_frame`` and, for the
        commits that create a run, its ``spec``."""
        whole = f"{self.root}/commits"
        runs = [run_id] if run_id is not None else [n.removeprefix("run_id=") for n in folder_names(self.spark, whole)]
        paths = [self._log_file(r, v) for r in runs for v, _ in self._chain(r)]
        if not paths:
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).option("basePath", whole).json(paths).where("commit_seq IS NOT NULL")

    def history(self, run_id: str) -> DataFrame:
        """The commits of a run, oldest first."""
        return self.commits(run_id).drop("spec").orderBy("commit_seq")

    def commit_frames(self, run_id: str) -> DataFrame:
        """The log by frame: one row per commit and frame it wrote. A commit's time is shared
        out over its frames by their cells."""
        rows = [r for r in self._log(run_id) if r["n_frames"]]
        log = self._commit_table(rows).withColumn("per_cell", F.col("elapsed_s") / F.nullif("n_cells", F.lit(0))).drop("n_frames", "n_cells", "elapsed_s")
        return (self._frame_rows(run_id, rows).join(log, "snapshot_id")
                .withColumn("elapsed_s", F.col("n_cells") * F.col("per_cell")).drop("per_cell"))

    def state(self, run_id: str, as_of: int | str | None = None) -> RunState:
        """The run at its newest commit, or at the commit of that number or snapshot id.

        The driver holds one row per commit of the run, because it has to name their folders."""
        rows = self._log(run_id)
        if isinstance(as_of, str):
            as_of = next((r["commit_seq"] for r in rows if r["snapshot_id"] == as_of), None)
            if as_of is None:
                raise ValueError(f"run {run_id!r} has no such snapshot")
        rows = [r for r in rows if as_of is None or r["commit_seq"] <= as_of]
        created = next((r for r in reversed(rows) if r["message"] == CREATE_MESSAGE), None)
        if created is None:
            raise ValueError(f"no run {run_id!r} in {self.root}")
        since = tuple(r for r in rows if r["commit_seq"] > created["commit_seq"] and r["n_frames"])
        return RunState(created["spec"], created["commit_seq"], rows[-1]["commit_seq"], since)

    def _log(self, run_id: str) -> list[Row]:
        """The newest log, oldest commit first; of a log known in part only the later files are read."""
        newest = self._newest(run_id)
        known, rows = self._logs.get(run_id, (0, []))
        if newest != known:
            chain = self._chain(run_id, newest, known)
            added = [_entry(line) for _, lines in reversed(chain) for line in lines]
            rows = (rows if chain[-1][1] and added[0]["commit_seq"] > 1 else []) + added
            self._logs[run_id] = newest, rows
        return rows if newest else []

    def _chain(self, run_id: str, newest: int | None = None, known: int = 0) -> list[tuple[int, list[dict]]]:
        """Versions of the log, newest first, with their entries, down to one that holds all before it, or to the ``known`` one."""
        version = self._newest(run_id) if newest is None else newest
        chain = []
        while version > known:
            head, *lines = (json.loads(line) for line in read_text(self.spark, self._log_file(run_id, version)).splitlines())
            chain.append((version, lines))
            version = head["since"]
        return chain

    def _append(self, run_id: str, entries: list[dict]) -> None:
        """More entries of the log, as its next version; every so often the version holds the whole log."""
        version = self._newest(run_id)
        rows = self._log(run_id)
        text = log_text(rows, version, entries)
        if not publish_once(self.spark, text, self._log_file(run_id, version + 1)):
            raise RuntimeError(f"run {run_id!r} has another committer; nothing was committed")

    def _log_file(self, run_id: str, version: int) -> str:
        return f"{self.root}/commits/run_id={run_id}/version={version}.json"

    def _newest(self, run_id: str) -> int:
        """The newest version of a run's log; 0 without any."""
        names = (_VERSION.fullmatch(n) for n in folder_names(self.spark, f"{self.root}/commits/run_id={run_id}"))
        return max((int(m[1]) for m in names if m), default=0)

    # -- writing ---------------------------------------------------------------------

    def write_frames(self, run_id: str, cells: DataFrame, views: DataFrame | None = None,
                     message: str | None = None, ordered: bool = False) -> str:
        """Write the frames found in ``cells`` as one commit and return its snapshot id."""
        staged = self.stage_frames(run_id, cells, views, message, ordered)
        self.commit(run_id, [staged])
        return staged.snapshot_id

    def commit(self, run_id: str, staged: list[Staged]) -> None:
        """Make staged frames part of the run, in the order given and all at once."""
        if staged:
            self._append(run_id, [s._asdict() for s in staged])

    def stage_frames(self, run_id: str, cells: DataFrame, views: DataFrame | None = None,
                     message: str | None = None, ordered: bool = False, spec: Row | None = None) -> Staged:
        """Write the frames found in ``cells`` without committing them; any number of workers may.

        Frames not in ``cells`` stay untouched. ``views`` supplies their centre and width. A cell outside
        the run's shape or the cell type fails the job, and so does a cell given twice. Cells are gathered
        by frame and band, so a frame holding much of the data is spread over tasks. Cells that ``compute_frames``
        made for this run from ``views`` are right by construction and already ``ordered``: the layout of rows writes them as they come.
        """
        spec = spec or self.state(run_id).spec
        if _layout(spec) == "bands":
            checked = cells.select("frame", "y", "x", _checked_cell(spec).alias("iterations"))
            return self.stage_bands(run_id, bands_of_cells(checked, spec["width_px"], spec["max_iter"]), views, message, spec)
        value = F.col("iterations") if ordered else _checked_cell(spec)
        rows = cells.select("frame", "y", "x", value.alias("iterations"), _block(spec).alias("frame_block"))
        if not ordered:
            rows = (rows.hint("rebalance", "frame_block", "frame")
                    .sortWithinPartitions("frame_block", "frame", "y", "x"))
        return self._staged(run_id, rows, views, message, spec)

    def stage_bands(self, run_id: str, bands: DataFrame, views: DataFrame | None = None,
                    message: str | None = None, spec: Row | None = None) -> Staged:
        """Write bands of this run, as ``compute_bands`` and ``bands_of_cells`` make them, without committing them."""
        spec = spec or self.state(run_id).spec
        # Packed bands are small: dealing them once more costs little and leaves files of a sensible size, however many tasks made them.
        rows = (bands.withColumn("frame_block", _block(spec)).hint("rebalance", "frame_block")
                .sortWithinPartitions("frame_block", "frame", "band"))
        return self._staged(run_id, rows, views, message, spec)

    def _staged(self, run_id: str, rows: DataFrame, views: DataFrame | None, message: str | None, spec: Row) -> Staged:
        """Data first, then what is known of its bands, then its frames with their views."""
        if message == CREATE_MESSAGE:
            raise ValueError("that message marks the creation of a run")
        snapshot = uuid.uuid4().hex
        folder = {name: f"{self.root}/{name}/run_id={run_id}/snapshot_id={snapshot}" for name in ("pixels", "zones", "frames")}
        started = time.perf_counter()
        rows.write.partitionBy("frame_block").mode("errorifexists").parquet(folder["pixels"])
        elapsed = time.perf_counter() - started
        if _layout(spec) == "bands":
            zones = self._opened([folder["pixels"]], _BAND_FILES)
        else:
            zones = bands_of_cells(self._opened([folder["pixels"]], PIXELS), spec["width_px"], spec["max_iter"], packed=False)
        zones.select(*ZONES.names).sortWithinPartitions("frame", "band").write.mode("errorifexists").parquet(folder["zones"])
        counted = self._opened([folder["zones"]], ZONES).groupBy("frame").agg(F.sum("n_cells").alias("n_cells"), F.sum("again").alias("again"))
        if views is None:
            unknown = F.lit(None).cast("double")
            counted = counted.withColumns({"center_re": unknown, "center_im": unknown, "width": unknown})
        else:
            counted = counted.join(views.select(*VIEWS.names), "frame", "left")
        seen = Observation()
        counted.select(*VIEWS.names, "n_cells", "again").observe(
            seen, F.count(F.lit(1)).alias("frames"), F.coalesce(F.sum("n_cells"), F.lit(0)).alias("cells"),
            F.min("frame").alias("first"), F.max("frame").alias("last"), F.coalesce(F.sum("again"), F.lit(0)).alias("again"),
            F.min(F.when(F.col("again") > 0, F.col("frame"))).alias("bad")).write.mode("errorifexists").parquet(folder["frames"])
        done = seen.get
        if done["again"]:
            raise ValueError(f"cells of run {run_id!r} occur more than once, e.g. in frame {done['bad']}")
        if message is None:
            message = f"wrote frame {done['first']}" if done["frames"] == 1 else f"wrote {done['frames']} frames"
        return Staged(snapshot, message, done["frames"], done["cells"], elapsed, done["first"], done["last"])

    # -- reading ---------------------------------------------------------------------

    def live_frames(self, run_id: str, as_of: int | str | None = None, state: RunState | None = None) -> DataFrame:
        """The newest commit of every materialised frame, with its view."""
        state = state or self.state(run_id, as_of)
        newest = F.max_by(F.struct("snapshot_id", "center_re", "center_im", "width", "n_cells"), "commit_seq")
        log = self._commit_table(state.commits).select("snapshot_id", "commit_seq")
        return (self._frame_rows(run_id, state.commits).join(log, "snapshot_id")
                .groupBy("frame").agg(newest.alias("at"), F.max("commit_seq").alias("commit_seq"))
                .select("frame", "at.*", "commit_seq"))

    def zones(self, run_id: str, as_of: int | str | None = None, state: RunState | None = None) -> DataFrame:
        """What is known of every band of the live frames: ``frame, band, n_cells, min_iter, max_seen, in_set, last_y, last_x, digest,
        histogram`` and the ``snapshot_id`` that wrote it. Zones are written with their cells and found by the same commit, so they are never of
        another state than the cells."""
        state = state or self.state(run_id, as_of)
        names = [c["snapshot_id"] for c in state.commits]
        run = f"{self.root}/zones/run_id={run_id}"
        found = self._opened([f"{run}/snapshot_id={s}" for s in names], _ZONE_FILES, f"{self.root}/zones").drop("again", "run_id")
        if _disjoint(state.commits):
            return found
        return found.join(self.live_frames(run_id, state=state).select("frame", "snapshot_id"), ["frame", "snapshot_id"], "left_semi")

    def read(self, run_id: str, as_of: int | str | None = None, where: Column | None = None,
             with_view: bool = False, values: tuple[int, int] | None = None, by_frame: DataFrame | None = None) -> DataFrame:
        """Cells of the run's newest state, or of its state at the commit ``as_of`` (number or snapshot id).

        ``where`` selects frames by ``frame``, ``center_re``, ``center_im`` or ``width``; then only the
        commits that hold such frames are opened. ``values`` selects cells by their count, both ends included; bands whose range lies
        outside are skipped by the statistics of their files. If no frame was written twice, the folders
        of the commits are the answer; otherwise the list of live frames is joined to them.

        ``by_frame`` is joined on ``frame`` and gives its other columns to the cells. It meets bands, before they become
        cells: Spark takes cells for as small as the packed bands that they come from, and would broadcast them all.
        """
        state = self.state(run_id, as_of)
        names = [c["snapshot_id"] for c in state.commits]
        if where is None and not with_view:
            written = sum(c["n_frames"] for c in state.commits)
            if _disjoint(state.commits) or self.live_frames(run_id, state=state).count() == written:
                return self._as_cells(self._rows(run_id, names, state.spec), state.spec, values=values, by_frame=by_frame)
        live = self.live_frames(run_id, state=state)
        if where is not None:
            live = live.filter(where)
            names = [r[0] for r in live.select("snapshot_id").distinct().collect()]
        return self._cells_of(run_id, live, state, names, with_view, values, by_frame)

    def _cells_of(self, run_id, live, state, names, with_view=False, values=None, by_frame=None):
        """Cells of the given live frames, which are joined on partition columns, so that dynamic
        pruning opens only the folders of their blocks. With a column ``band``, only those bands."""
        more = ["center_re", "center_im", "width"] if with_view else []
        by_band = ["band"] if "band" in live.columns else []
        wanted = live.select("snapshot_id", "frame", _block(state.spec).alias("frame_block"), *by_band, *more)
        rows = self._rows(run_id, names, state.spec)
        if by_band and _layout(state.spec) == "cells":
            rows = rows.withColumn("band", band_of(state.spec["width_px"]))
        return self._as_cells(rows.join(wanted, ["snapshot_id", "frame_block", "frame", *by_band]), state.spec, more, values, by_frame)

    def _as_cells(self, rows: DataFrame, spec: Row, more: list[str] = (), values: tuple[int, int] | None = None,
                  by_frame: DataFrame | None = None) -> DataFrame:
        """Rows of data folders as cells, in whatever layout they are."""
        if by_frame is not None:
            own = ["frame", "cells", "min_iter", "max_seen"] if _layout(spec) == "bands" else CELLS.names
            rows, more = rows.select(*own, *more).join(by_frame, "frame"), [*more, *(c for c in by_frame.columns if c != "frame")]
        if _layout(spec) == "bands":
            if values is not None:
                rows = rows.filter((F.col("max_seen") >= values[0]) & (F.col("min_iter") <= values[1]))
            rows = cells_of_bands(rows.select("frame", "cells", *more), spec["width_px"])
        if values is not None:
            rows = rows.filter(F.col("iterations").between(*values))
        return rows.select(*CELLS.names, *more)

    def read_bands(self, run_id: str, bands: DataFrame, as_of: int | str | None = None) -> DataFrame:
        """Cells of the given bands (``frame, band, snapshot_id``) of the run's state; only the commits that hold some are opened."""
        state = self.state(run_id, as_of)
        names = {r[0] for r in bands.select("snapshot_id").distinct().collect()}
        names = [c["snapshot_id"] for c in state.commits if c["snapshot_id"] in names]  # not more than the log has
        return self._cells_of(run_id, bands, state, names)

    def read_frame(self, run_id: str, frame: int, as_of: int | str | None = None) -> DataFrame:
        """One frame by position. Only commits whose range of frames has it are asked, and one folder of cells is opened."""
        state = self.state(run_id, as_of)
        if not 0 <= frame < state.spec["n_frames"]:
            raise ValueError(f"frame {frame} outside 0..{state.spec['n_frames'] - 1}")
        near = tuple(c for c in state.commits if c["first_frame"] is None or c["first_frame"] <= frame <= c["last_frame"])
        if not near:
            return self.spark.createDataFrame([], CELLS)
        live = self.live_frames(run_id, state=state._replace(commits=near)).filter(F.col("frame") == frame).first()
        if live is None:
            return self.spark.createDataFrame([], CELLS)
        block = frame // state.spec["frames_per_block"]
        rows = self._rows(run_id, [live["snapshot_id"]], state.spec, f"/frame_block={block}")
        return self._as_cells(rows.filter(F.col("frame") == frame), state.spec)

    def select(self, run_id: str, frame: int | None = None, width: float | None = None,
               width_between: tuple[float, float] | None = None) -> DataFrame:
        """Cells by label: an exact frame, an exact width, or a range of widths."""
        where = F.lit(True)
        if frame is not None:
            where = where & (F.col("frame") == frame)
        if width is not None:
            where = where & (F.col("width") == width)
        if width_between is not None:
            where = where & F.col("width").between(*width_between)
        return self.read(run_id, where=where, with_view=True)

    def dense(self, run_id: str, as_of: int | str | None = None) -> DataFrame:
        """The run as a full array: cells never written read as 0, views never written as NULL.

        Frames known to be complete pass straight through; only the others are searched for gaps.
        """
        state = self.state(run_id, as_of)
        spec = state.spec
        plane = spec["height"] * spec["width_px"]
        names = [c["snapshot_id"] for c in state.commits]
        live = self.live_frames(run_id, state=state)
        complete = F.col("n_cells") == plane
        known = self._cells_of(run_id, live, state, names, with_view=True)
        slots = self.spark.range(spec["n_frames"]).select(F.col("id").cast("int").alias("frame"))
        partial = slots.join(live, "frame", "left").filter(~F.coalesce(complete, F.lit(False)))
        lines = partial.select("frame", "center_re", "center_im", "width",
                               F.explode(F.sequence(F.lit(0), F.lit(spec["height"] - 1))).alias("y"))
        given = self._cells_of(run_id, live.filter(~complete), state, names)
        absent = missing_cells(lines, given, spec["width_px"], grid_tasks(self.spark, spec["n_frames"] * plane))
        return known.unionByName(absent.withColumn("iterations", F.lit(0)))

    def frames(self, run_id: str, as_of: int | str | None = None) -> DataFrame:
        """All frame slots of the run in order of position; views are NULL until written."""
        state = self.state(run_id, as_of)
        slots = self.spark.range(state.spec["n_frames"]).select(F.col("id").cast("int").alias("frame"))
        live = self.live_frames(run_id, state=state)
        return slots.join(live, "frame", "left").select(
            "frame", "center_re", "center_im", "width",
            F.coalesce("n_cells", F.lit(0)).alias("n_cells"), "commit_seq")

    def describe(self, run_id: str) -> DataFrame:
        """Sizes, cell type and cell count of a run, as one row."""
        state = self.state(run_id)
        spec = state.spec
        kind = CELLS["iterations"].dataType.simpleString()
        return self.live_frames(run_id, state=state).agg(
            F.lit(run_id).alias("run_id"),
            F.lit(spec["n_frames"]).alias("n_frames"),
            F.lit(spec["height"]).alias("height"),
            F.lit(spec["width_px"]).alias("width_px"),
            F.lit(spec["max_iter"]).alias("max_iter"),
            F.lit(kind).alias("cell_type"),
            F.count("*").alias("frames_written"),
            F.coalesce(F.sum("n_cells"), F.lit(0)).alias("cells_written"),
        )

    def list_runs(self) -> DataFrame:
        """Every run with its frame total and the frames materialised since it was created."""
        log = self.commits()
        is_create = F.col("message") == CREATE_MESSAGE
        runs = (log.filter(is_create).groupBy("run_id")
                .agg(F.max("commit_seq").alias("created_at"), F.max_by("spec", "commit_seq").alias("spec")))
        since = (log.filter("n_frames > 0").join(runs.select("run_id", "created_at"), "run_id")
                 .filter(F.col("commit_seq") > F.col("created_at")).select("run_id", "snapshot_id"))
        written = self._frame_table().join(since, ["run_id", "snapshot_id"])
        done = written.groupBy("run_id").agg(F.count_distinct("frame").alias("frames_done"))
        return runs.join(done, "run_id", "left").select(
            "run_id", "spec.n_frames", "spec.max_iter", F.coalesce("frames_done", F.lit(0)).alias("frames_done"))

    # -- files -----------------------------------------------------------------------

    def _commit_table(self, rows) -> DataFrame:
        """Commits as a table: as many rows as the run has commits."""
        kept = ["commit_seq", "message", "n_frames", "n_cells", "elapsed_s", "snapshot_id"]
        return self.spark.createDataFrame([tuple(r[c] for c in kept) for r in rows], _fields(COMMITS, kept))

    def _rows(self, run_id, snapshots, spec, block="") -> DataFrame:
        """What the data folders hold: bands or cells."""
        run = f"{self.root}/pixels/run_id={run_id}"
        schema = _BAND_FILES if _layout(spec) == "bands" else PIXELS
        return self._opened([f"{run}/snapshot_id={s}{block}" for s in snapshots], schema, f"{self.root}/pixels")

    def _frame_rows(self, run_id, rows) -> DataFrame:
        run = f"{self.root}/frames/run_id={run_id}"
        return self._opened([f"{run}/snapshot_id={r['snapshot_id']}" for r in rows], FRAMES, f"{self.root}/frames")

    def _frame_table(self) -> DataFrame:
        """Rows of all frames ever staged; empty before the first."""
        return self._opened([f"{self.root}/frames"] if folder_names(self.spark, f"{self.root}/frames") else [], FRAMES)

    def _opened(self, paths, schema, base=None) -> DataFrame:
        """Data folders that the log names: one that is gone is an error, never an empty run."""
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema)
        try:
            return (reader.option("basePath", base) if base else reader).parquet(*paths)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(f"the log names data that is gone: {e.getMessageParameters().get('path', paths)}") from e


def log_text(rows: list[Row], version: int, entries: list[dict]) -> str:
    """The log file after ``version``, whose entries are ``rows``: the new entries, every so often the whole log."""
    columns = [f.name for f in COMMITS if f.name not in ("run_id", "commit_seq")]
    last = rows[-1]["commit_seq"] if rows else 0
    lines = [{"commit_seq": last + k + 1, **{c: e.get(c) for c in columns}} for k, e in enumerate(entries)]
    whole = version == 0 or (version + 1) % APPENDS_PER_WHOLE_LOG == 0
    if whole:
        lines = [r.asDict(recursive=True) for r in rows] + lines
    return "\n".join(json.dumps(line) for line in [{"since": 0 if whole else version}, *lines])


def _entry(line: dict) -> Row:
    """One entry of the log, whatever columns it was written with."""
    spec = line.get("spec")
    values = {f.name: line.get(f.name) for f in COMMITS if f.name != "run_id"}
    return Row(**values | {"spec": Row(**{f.name: spec.get(f.name) for f in RUN_SPEC}) if spec else None})


def _layout(spec: Row) -> str:
    return spec["layout"] or "cells"


def _disjoint(commits: tuple[Row, ...]) -> bool:
    """Whether the ranges of frames prove that no frame was written twice."""
    if len(commits) < 2:
        return True
    if any(c["first_frame"] is None for c in commits):
        return False
    ranges = sorted((c["first_frame"], c["last_frame"]) for c in commits)
    return all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def _fields(schema, names):
    return type(schema)([schema[n] for n in names])


def _block(spec) -> Column:
    return F.floor(F.col("frame") / spec["frames_per_block"]).cast("int")


def _checked_cell(spec) -> Column:
    """The cell value, or an error naming what does not fit the run."""
    inside = (F.col("frame").between(0, spec["n_frames"] - 1)
              & F.col("y").between(0, spec["height"] - 1)
              & F.col("x").between(0, spec["width_px"] - 1)
              & F.col("iterations").between(0, CELL_MAX))
    return F.when(inside, F.col("iterations").cast("int")).otherwise(F.raise_error(
        F.concat_ws(" ", F.lit("cell does not fit the run: frame, y, x, value ="),
                    F.col("frame").cast("string"), F.col("y").cast("string"),
                    F.col("x").cast("string"), F.col("iterations").cast("string"))))
