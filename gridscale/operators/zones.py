"""Answers from zones: what a stored run's bands are known to hold, without opening their cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridscale.functions.bands import HISTOGRAM_BINS
from gridscale.operators.bands import band_cells
from gridscale.operators.compare import paired, verdicts
from gridscale.operators.render import scaled_by_range, scaled_by_top
from gridscale.operators.store import GridStore
from gridscale.session import settled

AsOf = int | str | None


def stored_frame_stats(store: GridStore, run_id: str, as_of: AsOf = None) -> DataFrame:
    """``frame_stats`` of a stored run from its zones."""
    return store.zones(run_id, as_of).groupBy("frame").agg(
        F.min("min_iter").alias("min_iter"), F.max("max_seen").alias("max_seen"), F.sum("n_cells").alias("n_cells"),
        (F.max("last_y") + 1).alias("height"), (F.max("last_x") + 1).alias("width_px"), F.sum("in_set").alias("in_set"))


def stored_global_max(store: GridStore, run_id: str, as_of: AsOf = None) -> DataFrame:
    """``global_max`` of a stored run from its zones."""
    return store.zones(run_id, as_of).agg(_top().alias("global_max"))


def stored_mixed_frames(store: GridStore, run_id: str, as_of: AsOf = None) -> DataFrame:
    """``mixed_frames`` of a stored run from its zones: no cell counts more than the run's ``max_iter`` if the kernel made it."""
    max_iter = store.state(run_id, as_of).spec["max_iter"]
    inside, escaped = F.bool_or(F.col("in_set") > 0), F.bool_or(F.col("min_iter") < max_iter)
    return store.zones(run_id, as_of).groupBy("frame").agg(
        inside.alias("has_in_set"), escaped.alias("has_escaped"), (inside & escaped).alias("mixed"))


def stored_histogram(store: GridStore, run_id: str, as_of: AsOf = None) -> DataFrame:
    """``frame, bin, n_cells``: cells by powers of two of their count plus one; bins without cells are absent."""
    bins = F.posexplode("histogram").alias("bin", "n")
    return store.zones(run_id, as_of).select("frame", bins).groupBy("frame", "bin").agg(F.sum("n").alias("n_cells")).where("n_cells > 0")


def cells_above(store: GridStore, run_id: str, share: float, as_of: AsOf = None) -> DataFrame:
    """The cells in the bins that the largest ``share`` of all cells reach into.

    The histogram says where to cut, and bands that lie below the cut are not opened."""
    if not 0 < share <= 1:
        raise ValueError(f"a share is above 0 and at most 1, got {share}")
    counts = {r["bin"]: r["n"] for r in stored_histogram(store, run_id, as_of).groupBy("bin").agg(F.sum("n_cells").alias("n")).collect()}
    wanted, cut = share * sum(counts.values()), 0
    for k in range(HISTOGRAM_BINS - 1, -1, -1):
        wanted -= counts.get(k, 0)
        if wanted <= 0:
            cut = (1 << k) - 1
            break
    return store.read(run_id, as_of, values=(cut, (1 << HISTOGRAM_BINS) - 1))


def normalise_stored_global(store: GridStore, run_id: str, as_of: AsOf = None) -> DataFrame:
    """``normalise_global`` of a stored run: the maximum comes from its zones, so cells are read once."""
    top = store.zones(run_id, as_of).select(_top().cast("float").alias("top")).scalar()
    return scaled_by_top(store.read(run_id, as_of), top)


def normalise_stored_per_frame(store: GridStore, run_id: str, as_of: AsOf = None) -> DataFrame:
    """``normalise_per_frame`` of a stored run: ranges come from its zones, so cells are read once and nothing is aggregated."""
    ranges = store.zones(run_id, as_of).groupBy("frame").agg(F.min("min_iter").alias("lo"), F.max("max_seen").alias("hi"))
    return scaled_by_range(store.read(run_id, as_of, by_frame=ranges))


def _top() -> Column:
    return F.greatest(F.coalesce(F.max("max_seen"), F.lit(1)), F.lit(1))


def changed_bands(store: GridStore, run_id: str, before: AsOf, after: AsOf = None) -> DataFrame:
    """``frame, band`` of all bands that differ between two states of a run, with the snapshots that hold them and their sizes.

    Frames that both states take from one commit are equal. Of the others the digests are compared, which stand for all
    cells of a band; no cell is read. Both states must belong to one creation of the run.
    """
    old, new = store.state(run_id, before), store.state(run_id, after)
    if old.created_at != new.created_at:
        raise ValueError(f"run {run_id!r} was created anew between the two states")
    live = [store.live_frames(run_id, state=s).select("frame", F.col("snapshot_id").alias(n)) for s, n in ((old, "old"), (new, "new"))]
    moved = live[0].join(live[1], "frame", "full_outer").where("NOT old <=> new").select("frame")

    def zones(state, name):
        return (store.zones(run_id, state=state).join(moved, "frame", "left_semi")
                .select("frame", "band", F.struct("snapshot_id", "n_cells", "digest").alias(name)))

    both = zones(old, "before").join(zones(new, "after"), ["frame", "band"], "full_outer")
    differs = ~F.col("before.digest").eqNullSafe(F.col("after.digest")) | ~F.col("before.n_cells").eqNullSafe(F.col("after.n_cells"))
    return both.where(differs)


def changed_rows(store: GridStore, run_id: str, before: AsOf, after: AsOf = None) -> DataFrame:
    """``frame, first_y, last_y``: rows of the bands that differ between two states of a run."""
    spec = store.state(run_id, after).spec
    size, width = band_cells(spec["width_px"]), spec["width_px"]
    first = F.expr(f"int((bigint(band) * {size}) div {width})")
    last = F.expr(f"int(((bigint(band) + 1) * {size} - 1) div {width})")
    return changed_bands(store, run_id, before, after).select(
        "frame", first.alias("first_y"), F.least(last, F.lit(spec["height"] - 1)).alias("last_y"))


def compare_commits(store: GridStore, run_id: str, before: AsOf, after: AsOf = None,
                    max_pixel_diff_pct: float = 1.0, max_iter_delta: int = 1) -> DataFrame:
    """``compare_frames`` of two states of a run; only bands whose digests differ are opened.

    Cells of all other bands are equal and enter with their number."""
    changed = settled(changed_bands(store, run_id, before, after))
    cells = [store.read_bands(run_id, changed.where(f"{n} IS NOT NULL").select("frame", "band", f"{n}.snapshot_id"), as_of)
             for n, as_of in (("before", before), ("after", after))]
    rest = (store.zones(run_id, after).join(changed, ["frame", "band"], "left_anti").groupBy("frame").agg(F.sum("n_cells").alias("times"))
            .select("frame", F.lit(0).cast("long").alias("delta"), "times"))
    both = paired(cells[1], cells[0]).select("frame", "delta", F.lit(1).cast("long").alias("times")).unionByName(rest)
    return both.groupBy("frame").agg(*verdicts(max_pixel_diff_pct, max_iter_delta, "times"))
