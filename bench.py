"""Time the headline queries and zoom runs; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8) and ``BENCH_ONLY``
(comma-separated names) choose what runs; ``BENCH_LONG=0`` leaves the 240-frame run out. Every
result is produced in full and discarded by the sink. Sessions start cold, so each kind of
job runs once unmeasured. Zoom runs of a few seconds are the median of three; ``ms_per_frame`` is what a
frame of a longer run costs beyond those of a shorter one, without the fixed cost of a job.
"""

from __future__ import annotations

import json
import os
import sys
import time

from gridscale.operators.compute import compute_frames
from gridscale.operators.materialise import zoom_run
from gridscale.operators.store import GridStore
from gridscale.plans.catalog import QUERIES
from gridscale.session import local_session, shared_folder
from gridscale.sources.schedule import zoom_schedule

HEADLINE = [
    "g1_zoom_schedule", "g3_pixel_grid", "g6_points", "g7_grid_filled",
    "k1_exact_points", "k2_early_exit_points", "k3_membership_class", "k4_float32_points", "k1_exact_frames",
    "s3_write_frames", "s5_read_latest", "s12_dense_view", "m2_zoom_run", "m5_fill_pending",
    "a1_frame_stats", "a1_stored_frame_stats", "q1_compare_runs", "q2_compare_commits", "k4_deep_frames", "r7_updated_pyramid", "r3_apply_palette", "r6_frame_images", "r7_tile_pyramid",
    "b1_record_metrics", "b2_compare_metrics",
]


def whole_set(spark):
    return spark.createDataFrame([(0, -0.75, 0.0, 3.5)], "frame INT, center_re DOUBLE, center_im DOUBLE, width DOUBLE")


def in_set(spark):
    """A frame with 83 % of its cells in the set, most of them in a part of period 3."""
    return spark.createDataFrame([(0, -1.7548776662466927, 0.0, 0.02)], "frame INT, center_re DOUBLE, center_im DOUBLE, width DOUBLE")


def zooms(spark):
    """Workloads of the sizes published for the single-node runs."""
    runs = {
        "frame_2048_512": lambda: compute_frames(whole_set(spark), 2048, 2048, 512, n_frames=1),
        "frame_2048_512_exact": lambda: compute_frames(whole_set(spark), 2048, 2048, 512, "exact", n_frames=1),
        "frame_512_65535_in_set": lambda: compute_frames(in_set(spark), 512, 512, 65535, n_frames=1),
        "zoom_120x480": lambda: compute_frames(zoom_schedule(spark, 120), 480, 480, 512, n_frames=120),
        "zoom_60x480": lambda: compute_frames(zoom_schedule(spark, 60), 480, 480, 512, n_frames=60),
        "zoom_120x720": lambda: compute_frames(zoom_schedule(spark, 120), 720, 720, 512, n_frames=120),
        "zoom_120x720_stored": lambda: stored(spark, 120, 720, 512),
    }
    runs["zoom_120x720_read"] = lambda: runs_stored(spark)
    if os.environ.get("BENCH_LONG") != "0":
        runs["zoom_240x1080_4096"] = lambda: compute_frames(zoom_schedule(spark, 240), 1080, 1080, 4096, n_frames=240)
    return runs


def stored(spark, n_frames, size, max_iter):
    store = GridStore(spark, shared_folder(spark))
    zoom_run(store, "bench", zoom_schedule(spark, n_frames), size, size, max_iter)
    return store.describe("bench")


_KEPT = {}


def runs_stored(spark):
    """All cells of a stored run; it is stored once, before the first measurement."""
    if "store" not in _KEPT:
        _KEPT["store"] = GridStore(spark, shared_folder(spark))
        zoom_run(_KEPT["store"], "bench", zoom_schedule(spark, 120), 720, 720, 512)
    return _KEPT["store"].read("bench")


def timed(make, times=1):
    seconds = []
    for _ in range(times):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
        if seconds[-1] > 8:
            break
    return round(sorted(seconds)[len(seconds) // 2], 3)


def marginal(seconds):
    if not {"zoom_60x480", "zoom_120x480"} <= set(seconds):
        return {}
    return {"480x480, 512 steps": round(1000 * (seconds["zoom_120x480"] - seconds["zoom_60x480"]) / 60, 1)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = local_session(cpus, "bench", "16g")
    spark.sparkContext.setLogLevel("ERROR")

    jobs = {name: (lambda q=QUERIES[name]: q(spark, folder)) for name in HEADLINE}
    zoom_runs = zooms(spark)
    jobs.update(zoom_runs)
    for warm_up in ("k2_early_exit_points", "s5_read_latest", "a1_frame_stats"):
        QUERIES[warm_up](spark, folder).write.format("noop").mode("overwrite").save()

    if not only or "zoom_120x720_read" in only:
        runs_stored(spark)
    seconds = {}
    for name, make in jobs.items():
        if not only or name in only:
            seconds[name] = timed(make, 3 if name in zoom_runs else 1)
            print(name, seconds[name], file=sys.stderr, flush=True)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds,
        "ms_per_frame": marginal(seconds),
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
