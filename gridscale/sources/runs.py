"""Stored runs as a Spark data source: ``spark.read.format("gridscale_run")``, and bands written by tasks as one commit.

Planning reads the log only. A partition is a block of frames: its task looks up which commit has each frame, drops frames that the
pushed filters exclude, and opens the files of the others. Written files wait in a folder of their own attempt; what
Spark accepts is moved into the run and named by one entry of the log, and nothing else ever is.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from gridscale.functions.bands import decode
from gridscale.operators.store import CREATE_MESSAGE, _entry, _layout, _VERSION, log_text
from gridscale.schema import BANDS, CELLS, VIEWS, ZONES

NAME = "gridscale_run"
#: What is read: cells with the view of their frame.
CELLS_WITH_VIEW = T.StructType([*CELLS.fields, *VIEWS.fields[1:]])
#: What is written: bands with the view of their frame.
BANDS_WITH_VIEW = T.StructType([*BANDS.fields, *VIEWS.fields[1:]])

_FRAME_FILE = pa.schema([("frame", pa.int32()), ("center_re", pa.float64()), ("center_im", pa.float64()), ("width", pa.float64()), ("n_cells", pa.int64())])
_AT_ONCE = 65_536


def register(spark: SparkSession) -> None:
    """Makes the format known to a session and lets Spark push filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GridRunSource)


def write_bands(bands: DataFrame, root: str, run_id: str, message: str | None = None) -> None:
    """One commit of bands (as ``compute_bands`` or ``bands_of_cells`` make them, with or without columns of ``VIEWS``), dealt by ranges of
    frame and band, so that a frame which holds much of the data is written by many tasks."""
    for f in BANDS_WITH_VIEW.fields:
        if f.name not in bands.columns:
            bands = bands.selectExpr("*", f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}")
    writer = (bands.select(*BANDS_WITH_VIEW.names).repartitionByRange("frame", "band").sortWithinPartitions("frame", "band")
              .write.format(NAME).mode("append").option("path", root).option("run", run_id))
    (writer if message is None else writer.option("message", message)).save()


class _Folder:
    """The folder of a store, reached without a session: readers and writers run in Python workers."""

    def __init__(self, root: str, run_id: str):
        local = root.startswith(("file:", "/"))
        self.system, self.root = (fs.LocalFileSystem(), urlparse(root).path) if local else fs.FileSystem.from_uri(root)
        self.root, self.run_id, self.local = self.root.rstrip("/"), run_id, local

    def of(self, kind: str, snapshot: str) -> str:
        return f"{self.root}/{kind}/run_id={self.run_id}/snapshot_id={snapshot}"

    def log_file(self, version: int) -> str:
        return f"{self.root}/commits/run_id={self.run_id}/version={version}.json"

    def log(self) -> tuple[int, list]:
        """The newest version and all entries, oldest first."""
        found = self.system.get_file_info(fs.FileSelector(os.path.dirname(self.log_file(0)), allow_not_found=True))
        newest = version = max((int(m[1]) for m in (_VERSION.fullmatch(f.base_name) for f in found) if m), default=0)
        chain = []
        while version > 0:
            with self.system.open_input_stream(self.log_file(version)) as stream:
                head, *lines = (json.loads(line) for line in stream.read().decode().splitlines())
            chain.append(lines)
            version = head["since"]
        return newest, [_entry(line) for lines in reversed(chain) for line in lines]

    def publish(self, text: str, path: str) -> bool:
        """As ``session.publish_once``: the file appears whole, or there is one of that name already."""
        draft = f"{os.path.dirname(path)}/.draft-{uuid.uuid4().hex}"
        with self.system.open_output_stream(draft) as stream:
            stream.write(text.encode())
        try:
            if self.local:
                try:
                    os.link(draft, path)
                    return True
                except FileExistsError:
                    return False
            if self.system.get_file_info(path).type != fs.FileType.NotFound:
                return False
            self.system.move(draft, path)
            return True
        finally:
            if self.system.get_file_info(draft).type != fs.FileType.NotFound:
                self.system.delete_file(draft)


@dataclass
class _Block(InputPartition):
    """Frames of one block, and the commits that may have some of them, oldest first."""

    spec: dict
    block: int
    first: int
    last: int
    snapshots: list[str]


class RunReader(DataSourceReader):
    def __init__(self, root: str, run_id: str, as_of: int | None):
        self.root, self.run_id, self.as_of = root, run_id, as_of
        self.frames = [0, (1 << 31) - 1]
        self.conditions: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of ``frame`` and ``width`` with constants; the others stay with Spark."""
        names = {EqualTo: "eq", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le", In: "in"}
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in ("frame", "width") and isinstance(f, (*names, IsNotNull)):
                if isinstance(f, IsNotNull):
                    self.conditions.append((column, "known", None))
                else:
                    self.conditions.append((column, names[type(f)], f.value))
                    if column == "frame":
                        self._narrow(names[type(f)], f.value)
            else:
                yield f

    def _narrow(self, how: str, value) -> None:
        low, high = self.frames
        if how == "in":
            known = [v for v in value if v is not None]
            low, high = (max(low, min(known)), min(high, max(known))) if known else (0, -1)
        if how in ("eq", "gt", "ge"):
            low = max(low, value + (how == "gt"))
        if how in ("eq", "lt", "le"):
            high = min(high, value - (how == "lt"))
        self.frames = [low, high]

    def partitions(self) -> list[_Block]:
        _, rows = _Folder(self.root, self.run_id).log()
        rows = [r for r in rows if self.as_of is None or r["commit_seq"] <= self.as_of]
        created = next((r for r in reversed(rows) if r["message"] == CREATE_MESSAGE), None)
        if created is None:
            raise ValueError(f"no run {self.run_id!r} in {self.root}")
        spec = created["spec"].asDict()
        size = spec["frames_per_block"]
        low, high = self.frames[0], min(self.frames[1], spec["n_frames"] - 1)
        by_block: dict[int, list[str]] = {}
        for c in rows:
            if c["commit_seq"] > created["commit_seq"] and c["n_frames"]:
                a = low if c["first_frame"] is None else max(low, c["first_frame"])
                b = high if c["last_frame"] is None else min(high, c["last_frame"])
                for block in range(a // size, b // size + 1) if a <= b else ():
                    by_block.setdefault(block, []).append(c["snapshot_id"])
        return [_Block(spec, k, max(low, k * size), min(high, (k + 1) * size - 1), s) for k, s in sorted(by_block.items())] or [_Block(spec, 0, 0, -1, [])]

    def read(self, partition: _Block) -> Iterator[pa.RecordBatch]:
        folder = _Folder(self.root, self.run_id)
        inside = (ds.field("frame") >= partition.first) & (ds.field("frame") <= partition.last)
        live: dict[int, tuple] = {}
        for snapshot in partition.snapshots:  # a later commit takes the place of an earlier one
            frames = ds.dataset(folder.of("frames", snapshot), filesystem=folder.system, format="parquet").to_table(["frame", "center_re", "center_im", "width"], filter=inside)
            live.update({r["frame"]: (snapshot, r["center_re"], r["center_im"], r["width"]) for r in frames.to_pylist()})
        live = {f: v for f, v in live.items() if all(_holds(f if c == "frame" else v[3], how, value) for c, how, value in self.conditions)}
        for snapshot in partition.snapshots:
            wanted = [f for f, v in live.items() if v[0] == snapshot]
            if wanted:
                files = ds.dataset(f"{folder.of('pixels', snapshot)}/frame_block={partition.block}", filesystem=folder.system, format="parquet")
                columns = ["frame", "cells"] if _layout(partition.spec) == "bands" else CELLS.names
                for one in files.to_batches(columns=columns, filter=ds.field("frame").isin(wanted), batch_size=_AT_ONCE if "y" in columns else 64):
                    yield from self._cells(one, live, partition.spec["width_px"])

    def _cells(self, one: pa.RecordBatch, live: dict[int, tuple], width_px: int) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(CELLS_WITH_VIEW)
        if "cells" not in one.schema.names:
            frames = one["frame"].to_pylist()
            columns = [one[c].cast(pa.int32()) for c in CELLS.names] + [pa.array([live[f][k] for f in frames], pa.float64()) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            return
        for frame, data in zip(one["frame"].to_pylist(), one["cells"].to_pylist()):
            at, counts = decode(data)
            y = at // width_px
            columns = [pa.array(np.full(len(at), frame, np.int32)), pa.array(y.astype(np.int32)), pa.array((at - y * width_px).astype(np.int32)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(np.full(len(at), np.nan if v is None else v), pa.float64(), mask=np.full(len(at), v is None)) for v in live[frame][1:]], schema=schema)


def _holds(seen, how: str, value) -> bool:
    if seen is None or value is None and how != "known":
        return False
    return {"known": lambda: True, "eq": lambda: seen == value, "gt": lambda: seen > value, "ge": lambda: seen >= value,
            "lt": lambda: seen < value, "le": lambda: seen <= value, "in": lambda: seen in value}[how]()


@dataclass
class _Part(WriterCommitMessage):
    """What one task wrote: its files, its first and last band, and the frames at its edges, which other tasks may share."""

    attempt: str
    blocks: list[int]
    first: tuple[int, int] | None
    last: tuple[int, int] | None
    edges: list[tuple]
    n_inner: int
    n_cells: int


class RunWriter(DataSourceArrowWriter):
    def __init__(self, root: str, run_id: str, message: str | None):
        self.root, self.run_id, self.message = root, run_id, message
        _, rows = _Folder(root, run_id).log()
        created = next((r for r in reversed(rows) if r["message"] == CREATE_MESSAGE), None)
        if created is None:
            raise ValueError(f"no run {run_id!r} in {root}")
        if message == CREATE_MESSAGE:
            raise ValueError("that message marks the creation of a run")
        if _layout(created["spec"]) != "bands":
            raise ValueError("only runs of bands are written by this source")
        self.spec, self.snapshot, self.started = created["spec"].asDict(), uuid.uuid4().hex, time.time()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Part:
        folder, attempt = _Folder(self.root, self.run_id), uuid.uuid4().hex
        home = f"{folder.root}/staged/{self.snapshot}/{attempt}"
        folder.system.create_dir(home, recursive=True)
        bands, zones = to_arrow_schema(BANDS), to_arrow_schema(ZONES)
        blocks, pixels, first, last, total = [], None, None, None, 0
        edges, done, open_frame, n_inner = [], [], None, 0
        with pq.ParquetWriter(f"{home}/zones", zones, filesystem=folder.system) as zone_file, pq.ParquetWriter(f"{home}/frames", _FRAME_FILE, filesystem=folder.system) as frame_file:
            for one in iterator:
                self._check(one)
                keys = list(zip(one["frame"].to_pylist(), one["band"].to_pylist()))
                for key in keys:
                    if last is not None and key <= last:
                        raise ValueError(f"band {key[1]} of frame {key[0]} is given twice or out of order")
                    first, last = first or key, key
                zone_file.write_batch(one.select(ZONES.names).cast(zones))
                of = one["frame"].to_numpy() // self.spec["frames_per_block"]
                for block in np.unique(of).tolist():
                    if not blocks or block != blocks[-1]:
                        if pixels is not None:
                            pixels.close()
                        blocks.append(block)
                        pixels = pq.ParquetWriter(f"{home}/block-{block}", bands, filesystem=folder.system)
                    a, b = np.searchsorted(of, [block, block + 1])
                    pixels.write_batch(one.slice(int(a), int(b - a)).select(BANDS.names).cast(bands))
                for row in one.select([*VIEWS.names, "n_cells"]).to_pylist():
                    total += row["n_cells"]
                    if open_frame is not None and open_frame["frame"] == row["frame"]:
                        open_frame["n_cells"] += row["n_cells"]
                        continue
                    if open_frame is not None:
                        if edges:
                            done.append(open_frame)
                        else:
                            edges.append(open_frame)
                    open_frame = row
                    if len(done) >= _AT_ONCE:
                        n_inner += len(done)
                        frame_file.write_table(pa.Table.from_pylist(done, _FRAME_FILE))
                        done = []
            if open_frame is not None:
                edges.append(open_frame)
            n_inner += len(done)
            frame_file.write_table(pa.Table.from_pylist(done, _FRAME_FILE))
            if pixels is not None:
                pixels.close()
        return _Part(attempt, blocks, first, last, [tuple(e[c] for c in _FRAME_FILE.names) for e in edges], n_inner, total)

    def _check(self, one: pa.RecordBatch) -> None:
        highest = {"frame": self.spec["n_frames"] - 1, "last_y": self.spec["height"] - 1, "last_x": self.spec["width_px"] - 1, "again": 0}
        for column, most in highest.items():
            values = one[column].to_numpy(zero_copy_only=False)
            if len(values) and not (0 <= values.min() and values.max() <= most):
                raise ValueError(f"{column} of a band does not fit the run: {values.min()} to {values.max()}, not 0 to {most}")

    def commit(self, messages: list[_Part | None]) -> None:
        """Moves the files of the accepted attempts into the run, then names them by one entry of the log. The driver holds two frames per task."""
        folder = _Folder(self.root, self.run_id)
        try:
            parts = sorted((m for m in messages if m is not None and m.first is not None), key=lambda m: m.first)
            for a, b in zip(parts, parts[1:]):
                if b.first <= a.last:
                    raise ValueError(f"band {b.first[1]} of frame {b.first[0]} was given to two tasks")
            if not parts:
                return
            shared: dict[int, list] = {}
            for frame, *view, n_cells in (e for m in parts for e in m.edges):
                shared.setdefault(frame, [*view, 0])[-1] += n_cells
            for m in parts:
                home = f"{folder.root}/staged/{self.snapshot}/{m.attempt}"
                for source, target in [*((f"block-{b}", f"{folder.of('pixels', self.snapshot)}/frame_block={b}") for b in m.blocks),
                                       ("zones", folder.of("zones", self.snapshot)), ("frames", folder.of("frames", self.snapshot))]:
                    folder.system.create_dir(target, recursive=True)
                    folder.system.move(f"{home}/{source}", f"{target}/part-{m.attempt}.parquet")
            rows = [dict(zip(_FRAME_FILE.names, (frame, *rest))) for frame, rest in sorted(shared.items())]
            pq.write_table(pa.Table.from_pylist(rows, _FRAME_FILE), f"{folder.of('frames', self.snapshot)}/part-edges.parquet", filesystem=folder.system)
            n_frames = len(shared) + sum(m.n_inner for m in parts)
            version, log = folder.log()
            text = log_text(log, version, [{
                "snapshot_id": self.snapshot, "message": self.message or f"wrote {n_frames} frames", "n_frames": n_frames, "n_cells": sum(m.n_cells for m in parts),
                "elapsed_s": time.time() - self.started, "first_frame": parts[0].first[0], "last_frame": parts[-1].last[0]}])
            if not folder.publish(text, folder.log_file(version + 1)):
                raise RuntimeError(f"run {self.run_id!r} has another committer; nothing was committed")
        finally:
            self._clear(folder)

    def abort(self, messages: list[_Part | None]) -> None:
        self._clear(_Folder(self.root, self.run_id))

    def _clear(self, folder: _Folder) -> None:
        staged = f"{folder.root}/staged/{self.snapshot}"
        if folder.system.get_file_info(staged).type != fs.FileType.NotFound:
            folder.system.delete_dir(staged)


class GridRunSource(DataSource):
    """Options: ``path`` (root of the store), ``run``, and for reading ``as_of`` (number of a commit), for writing ``message``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> T.StructType:
        return CELLS_WITH_VIEW

    def reader(self, schema: T.StructType) -> RunReader:
        as_of = self.options.get("as_of")
        return RunReader(self.options["path"], self.options["run"], None if as_of is None else int(as_of))

    def writer(self, schema: T.StructType, overwrite: bool) -> RunWriter:
        if overwrite:
            raise ValueError("a run is written by commits: use mode('append')")
        if set(schema.names) != set(BANDS_WITH_VIEW.names):
            raise ValueError(f"bands with their views are written, columns {', '.join(BANDS_WITH_VIEW.names)}; see write_bands")
        return RunWriter(self.options["path"], self.options["run"], self.options.get("message"))
