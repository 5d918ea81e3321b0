"""SQL that answers each registered query independently, for DuckDB."""

from __future__ import annotations

from gridscale.plans.catalog import CYCLE_SIZE, CYCLE_STEPS, FRAME_STEPS, LARGE_SIZE, LARGE_STEPS, POINT_STEPS, SIZE, STORE_SIZE, TILE
from gridscale.plans.inputs import EVENTS_HEIGHT, ORDERS_HEIGHT, ORDERS_WIDTH

# -- inputs ----------------------------------------------------------------------------

CUSTOMER_VIEWS = """views AS (
  SELECT c_custkey::INT AS frame, -2.0::DOUBLE + 0.1::DOUBLE * c_nationkey AS center_re,
         -0.375::DOUBLE + 0.125::DOUBLE * (c_custkey % 7) AS center_im,
         3.5::DOUBLE / (1 << (c_custkey % 5)::INT) AS width
  FROM customer)"""

SUPPLIER_VIEWS = """views AS (
  SELECT s_suppkey::INT AS frame, -2.0::DOUBLE + 0.1::DOUBLE * s_nationkey AS center_re,
         0.0::DOUBLE AS center_im, 3.5::DOUBLE / (1 << (s_suppkey % 5)::INT) AS width
  FROM supplier)"""

REQUESTED = "(SELECT s_suppkey::INT FROM supplier WHERE s_acctbal > 5000)"

LINEITEM_POINTS = """base AS (
  SELECT l_orderkey, l_linenumber,
         -2.0::DOUBLE + 2.5::DOUBLE * (l_partkey % 1009) / 1009.0::DOUBLE AS re,
         -1.25::DOUBLE + 2.5::DOUBLE * ((l_suppkey * 7 + l_orderkey % 997) % 997) / 997.0::DOUBLE AS im
  FROM lineitem)"""

ORDERS_POINTS = """base AS (
  SELECT o_orderkey,
         -2.0::DOUBLE + 2.5::DOUBLE * (o_orderkey % 1009) / 1009.0::DOUBLE AS re,
         -1.25::DOUBLE + 2.5::DOUBLE * (o_custkey % 997) / 997.0::DOUBLE AS im
  FROM orders)"""

EMBEDDING_POINTS = """base AS (
  SELECT vec_id, pair, embedding[2 * pair + 1]::DOUBLE * 2 AS re, embedding[2 * pair + 2]::DOUBLE * 2 AS im
  FROM (SELECT vec_id, embedding, unnest(range(len(embedding) // 2))::INT AS pair FROM embeddings))"""

DAY = "date_diff('day', DATE '2024-01-01', ts::DATE)"


def _cube(name, condition="true"):
    return f"""{name} AS (
  SELECT ({DAY})::INT AS frame, hour(ts)::INT AS y, user_id::INT AS x, count(*) AS iterations
  FROM events WHERE {condition} GROUP BY ALL)"""


CUBE = _cube("cube")
CUBE_NO_ERRORS = _cube("late", "event_type <> 'error'")
CUBE_WEEKENDS = _cube("weekends", "event_type <> 'error' AND isodow(ts) >= 6")
LATEST = f"""{CUBE}, {CUBE_WEEKENDS}, latest AS (
  SELECT frame, y, x, iterations::INT AS iterations FROM weekends
  UNION ALL
  SELECT frame, y, x, iterations::INT FROM cube WHERE frame NOT IN (SELECT frame FROM weekends))"""
EVENT_VIEWS = f"""views AS (
  SELECT DISTINCT ({DAY})::INT AS frame, -0.75::DOUBLE AS center_re, 0.0::DOUBLE AS center_im,
         3.5::DOUBLE / (1 << (({DAY}) % 5)::INT) AS width FROM events)"""
EVENT_FRAMES = f"(SELECT max({DAY}) + 1 FROM events)"
EVENT_WIDTH = "(SELECT max(user_id) + 1 FROM events)"

ORDER_CUBE = """cube AS (
  SELECT ((year(o_orderdate) - 1990) * 12 + month(o_orderdate) - 1)::INT AS frame,
         (day(o_orderdate) - 1)::INT AS y, c_nationkey::INT AS x, count(*) AS iterations
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""

PALETTE = """palette AS (
  SELECT id::INT AS bin, trunc(t * 255)::INT AS r, trunc(t * t * 255)::INT AS g,
         trunc((1.0::DOUBLE - t) * 0.5::DOUBLE * 255)::INT AS b
  FROM (SELECT range AS id, range / 255.0::DOUBLE AS t FROM range(256)))"""


# -- shared steps ----------------------------------------------------------------------

def _axis(center, index, n):
    lo, hi = f"({center} - width / 2.0::DOUBLE)", f"({center} + width / 2.0::DOUBLE)"
    return f"CASE WHEN {index} = {n - 1} THEN {hi} ELSE {lo} + {index} * (({hi} - {lo}) / {float(n - 1)}::DOUBLE) END"


def _grid(size, name="base"):
    return f"""{name} AS (
  SELECT frame, y::INT AS y, x::INT AS x, {_axis('center_re', 'x', size)} AS re, {_axis('center_im', 'y', size)} AS im
  FROM views, (SELECT range AS y FROM range({size})), (SELECT range AS x FROM range({size})))"""


def _counts(steps, kind="DOUBLE", closed_forms=False, base="base", name="counts"):
    """Escape counts of the distinct points of ``base``."""
    inside = ("false" if not closed_forms else
              f"""(q * (q + (re - 0.25::{kind})) < 0.25::{kind} * im * im
       OR (re + 1.0::{kind}) * (re + 1.0::{kind}) + im * im < 0.0625::{kind})""")
    return f"""{name}_points AS (
  SELECT *, {inside} AS inside FROM (
    SELECT re, im, (re - 0.25::{kind}) * (re - 0.25::{kind}) + im * im AS q
    FROM (SELECT DISTINCT re::{kind} AS re, im::{kind} AS im FROM {base}))),
{name}_orbit(re, im, k, zr, zi) AS (
  SELECT re, im, -1, 0::{kind}, 0::{kind} FROM {name}_points WHERE NOT inside
  UNION ALL
  SELECT re, im, k + 1, (zr * zr - zi * zi + re)::{kind}, (2::{kind} * zr * zi + im)::{kind}
  FROM {name}_orbit WHERE k < {steps - 1} AND zr * zr + zi * zi <= 4::{kind}),
{name} AS (
  SELECT re, im, coalesce(min(k) FILTER (WHERE zr * zr + zi * zi > 4::{kind}), {steps})::INT AS iterations
  FROM {name}_orbit GROUP BY re, im
  UNION ALL SELECT re, im, {steps}::INT FROM {name}_points WHERE inside)"""


def _counted(columns, kind="DOUBLE", base="base", counts="counts"):
    return (f"SELECT {columns}, c.iterations FROM {base} b JOIN {counts} c "
            f"ON b.re::{kind} = c.re AND b.im::{kind} = c.im")


def _frames(views, size, steps, closed_forms=False):
    return (f"{views}, {_grid(size)}, {_counts(steps, closed_forms=closed_forms)}, "
            f"cells AS ({_counted('b.frame, b.y, b.x')})")


def _with(*parts):
    *ctes, select = parts
    return f"WITH RECURSIVE {', '.join(ctes)}\n{select}"


LINEITEM_COLUMNS = "b.l_orderkey, b.l_linenumber, b.re, b.im"


def _schedule(initial, final, re, im):
    return f"""runs AS (
  SELECT c_custkey::VARCHAR AS run_id, (c_custkey % 20 + 1)::INT AS n, {initial} AS initial, {final} AS final,
         {re} AS center_re, {im} AS center_im
  FROM customer),
schedule AS (
  SELECT run_id, frame::INT AS frame, center_re, center_im,
         CASE WHEN n = 1 THEN initial
              ELSE power(10.0::DOUBLE, log10(initial) + frame * ((log10(final) - log10(initial)) / (n - 1))) END AS width
  FROM (SELECT *, unnest(range(n)) AS frame FROM runs))"""


# The default zoom.
DEFAULTS = _schedule("3.5::DOUBLE", "1e-3::DOUBLE", "-0.743643887037151::DOUBLE", "0.131825904205330::DOUBLE")
OVERRIDES = _schedule(
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 10.0::DOUBLE ELSE 3.5::DOUBLE END",
    "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1e-5::DOUBLE ELSE 1e-3::DOUBLE END",
    "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN -1.25066::DOUBLE ELSE -0.743643887037151::DOUBLE END",
    "CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'FURNITURE') THEN 0.0::DOUBLE ELSE 0.131825904205330::DOUBLE END")
SCHEDULE_COLUMNS = """SELECT run_id, frame, round(center_re, 8) AS center_re, round(center_im, 8) AS center_im,
       round(width, 8) AS width FROM schedule"""
STEPS = """steps AS (
  SELECT run_id, frame, width, next_width, ln(next_width) - ln(width) AS step
  FROM (SELECT *, lead(width) OVER (PARTITION BY run_id ORDER BY frame) AS next_width FROM schedule))"""


def _channel_sums(width):
    sums = [f"sum({c})::BIGINT AS {c}" for c in "rgb"]
    return ", ".join(sums + [f"sum({c} * (y * {width} + x + 1))::BIGINT AS weighted_{c}" for c in "rgb"])


def _edge(index, size, parts):
    return f"CASE WHEN {index} = {parts} THEN {size} ELSE trunc(({index}) * ({size}::DOUBLE / {parts}))::INT END"


def _verdict(pct, delta):
    counted = f"100.0::DOUBLE * count(*) FILTER (WHERE delta > {delta}) / count(*)"
    return f"""count(*) AS n_cells, count(*) FILTER (WHERE delta IS NULL) AS unmatched,
       count(*) FILTER (WHERE delta > {delta}) AS differing, coalesce(max(delta), 0)::BIGINT AS max_delta,
       {counted} AS pct,
       CASE WHEN count(*) FILTER (WHERE delta IS NULL) > 0 THEN 'shape mismatch'
            WHEN {counted} > {pct} THEN 'too different' ELSE 'close' END AS verdict"""


PAIRED = """paired AS (
  SELECT coalesce(a.frame, b.frame) AS frame, abs(a.iterations - b.iterations) AS delta
  FROM late a FULL JOIN cube b ON a.frame = b.frame AND a.y = b.y AND a.x = b.x)"""

PER_FRAME = """SELECT *, CASE WHEN hi > lo THEN (iterations - lo) / (hi - lo)::DOUBLE ELSE 0.0::DOUBLE END AS v
  FROM (SELECT *, min(iterations) OVER (PARTITION BY frame) AS lo, max(iterations) OVER (PARTITION BY frame) AS hi
        FROM cube)"""
GLOBAL_V = "(iterations::FLOAT / (SELECT greatest(max(iterations), 1)::FLOAT FROM cube))"


def _padded(source, h, w):
    """Rows of ``source`` in image order with the last row and column repeated."""
    rows = f"SELECT * REPLACE ({h - 1} - y AS y) FROM {source}"
    if h % 2:
        rows = f"(WITH f AS ({rows}) SELECT * FROM f UNION ALL SELECT * REPLACE (y + 1 AS y) FROM f WHERE y = {h - 1})"
        rows = f"SELECT * FROM {rows}"
    if w % 2:
        rows = f"(WITH f AS ({rows}) SELECT * FROM f UNION ALL SELECT * REPLACE (x + 1 AS x) FROM f WHERE x = {w - 1})"
        rows = f"SELECT * FROM {rows}"
    return rows


#: Cells by powers of two of their count plus one.
BIN = "floor(log2(iterations + 1))::INT"


def _stats(cells, steps):
    return f"""SELECT frame, min(iterations) AS min_iter, max(iterations) AS max_seen, count(*) AS n_cells, max(y) + 1 AS height,
       max(x) + 1 AS width_px, count(*) FILTER (WHERE iterations = {steps}) AS in_set FROM {cells} GROUP BY frame"""


def _mixed(cells, steps):
    return f"""SELECT frame, bool_or(iterations = {steps}) AS has_in_set, bool_or(iterations < {steps}) AS has_escaped,
       bool_or(iterations = {steps}) AND bool_or(iterations < {steps}) AS mixed FROM {cells} GROUP BY frame"""


LEVELS = f"(SELECT count(*) FROM range(40) t(k) WHERE ({TILE}::BIGINT << k::INT) < greatest({EVENTS_HEIGHT}, {EVENT_WIDTH}))"
def _pyramid(source):
    return f"""{LATEST}, top AS (SELECT {LEVELS}::INT AS top),
levels AS (
  SELECT frame, (top - l)::INT AS z, ({EVENTS_HEIGHT - 1} - y) >> l AS py, x >> l AS px, max(iterations)::INT AS value
  FROM (SELECT {source}.*, top, unnest(range(top + 1))::INT AS l FROM {source}, top)
  GROUP BY ALL),
pyramid AS (
  SELECT frame, z, (py // {TILE})::INT AS tile_y, (px // {TILE})::INT AS tile_x,
         (py % {TILE})::INT AS y, (px % {TILE})::INT AS x, value FROM levels)"""

PYRAMID = _pyramid("cube")

METRICS = f"""metrics AS (
  SELECT event_id::VARCHAR AS run_id, event_type AS stage_id, upper(event_type) AS stage_name,
         (props::JSON ->> 'k')::INT AS max_iter, 'day ' || lpad(({DAY})::VARCHAR, 4, '0') AS schedule_name,
         NULL::VARCHAR AS git_sha, value AS wall_time_seconds, NULL::DOUBLE AS peak_memory_mb
  FROM events)"""

MS = """count(*) AS n_frames, round(sum(value), 6) AS total_s,
       round(sum(value) * 1000.0::DOUBLE / count(*), 6) AS ms_per_frame"""

SUPPLIER_CELLS = _frames(SUPPLIER_VIEWS, STORE_SIZE, FRAME_STEPS)

ORACLES = {
    "g1_zoom_schedule": _with(DEFAULTS, SCHEDULE_COLUMNS),
    "g2_schedule_overrides": _with(OVERRIDES, SCHEDULE_COLUMNS),
    "g3_pixel_grid": _with(CUSTOMER_VIEWS, _grid(SIZE), "SELECT frame, y, x, re, im FROM base"),
    "g4_tile_grid": _with(CUSTOMER_VIEWS, f"""SELECT frame, ty::INT AS tile_y, tx::INT AS tile_x,
       {_edge('ty', 50, 6)} AS y0, {_edge('ty + 1', 50, 6)} AS y1,
       {_edge('tx', 70, 6)} AS x0, {_edge('tx + 1', 70, 6)} AS x1
FROM views, range(6) a(ty), range(6) b(tx)"""),
    "g5_frame_ranges": """SELECT c_custkey::INT AS frame,
       (c_custkey // (((SELECT count(*) FROM customer) + 7) // 8))::INT AS task_index FROM customer""",
    "g5_range_bounds": """WITH n AS (SELECT count(*) AS n, ((count(*) + 10) // 11) AS per_task FROM customer)
SELECT t::INT AS task_index, least(t * per_task, n)::INT AS start, least((t + 1) * per_task, n)::INT AS stop,
       (SELECT count(*) FROM customer WHERE c_custkey // per_task = t) AS n_views FROM range(11) r(t), n""",
    "g6_points": _with(ORDERS_POINTS, _counts(POINT_STEPS, closed_forms=True), _counted("b.o_orderkey, b.re, b.im")),
    "g7_grid_from_table": _with(CUBE, "SELECT * FROM cube"),
    "g7_grid_filled": _with(CUBE, f"""SELECT f::INT AS frame, h::INT AS y, u::INT AS x, coalesce(iterations, 0) AS iterations
FROM range({EVENT_FRAMES}) a(f), range({EVENTS_HEIGHT}) b(h), range({EVENT_WIDTH}) c(u)
LEFT JOIN cube ON frame = f AND y = h AND x = u"""),

    "k1_exact_points": _with(LINEITEM_POINTS, _counts(POINT_STEPS), _counted(LINEITEM_COLUMNS)),
    "k1_exact_frames": _with(_frames(CUSTOMER_VIEWS, SIZE, FRAME_STEPS), "SELECT * FROM cells"),
    "k1_exact_native": _with(ORDERS_POINTS, _counts(POINT_STEPS), _counted("b.o_orderkey, b.re, b.im")),
    "k2_early_exit_points": _with(LINEITEM_POINTS, _counts(POINT_STEPS, closed_forms=True), _counted(LINEITEM_COLUMNS)),
    "k2_early_exit_frames": _with(_frames(CUSTOMER_VIEWS, SIZE, FRAME_STEPS, closed_forms=True), "SELECT * FROM cells"),
    "k2_cycles_frames": _with(_frames(SUPPLIER_VIEWS, CYCLE_SIZE, CYCLE_STEPS, closed_forms=True), "SELECT * FROM cells"),
    "k3_membership_class": _with(LINEITEM_POINTS, """SELECT l_orderkey, l_linenumber, re, im,
       CASE WHEN q * (q + (re - 0.25::DOUBLE)) < 0.25::DOUBLE * im * im THEN 'cardioid'
            WHEN (re + 1) * (re + 1) + im * im < 0.0625::DOUBLE THEN 'period2' ELSE 'iterate' END AS class
FROM (SELECT *, (re - 0.25::DOUBLE) * (re - 0.25::DOUBLE) + im * im AS q FROM base)"""),
    "k4_float32_points": _with(LINEITEM_POINTS, _counts(POINT_STEPS, "FLOAT", True), _counted(LINEITEM_COLUMNS, "FLOAT")),
    "k4_float32_embeddings": _with(EMBEDDING_POINTS, _counts(POINT_STEPS, "FLOAT", True),
                                   _counted("b.vec_id, b.pair, b.re, b.im", "FLOAT")),
    "k5_cell_type": """SELECT o_orderkey, floor(o_totalprice) BETWEEN 0 AND 65535 AS fits,
       CASE WHEN floor(o_totalprice) BETWEEN 0 AND 65535 THEN floor(o_totalprice)::INT ELSE -1 END AS cell FROM orders""",

    "s1_create_run": f"""SELECT range::INT AS frame, NULL::DOUBLE AS center_re, NULL::DOUBLE AS center_im,
       NULL::DOUBLE AS width, 0::BIGINT AS n_cells FROM range({EVENT_FRAMES})""",
    "s2_create_if_absent": _with(CUBE, f"""SELECT 'events' AS run_id, {EVENT_FRAMES}::INT AS n_frames,
       {EVENTS_HEIGHT} AS height, {EVENT_WIDTH}::INT AS width_px, 65535 AS max_iter, 'int' AS cell_type,
       count(DISTINCT frame) AS frames_written, count(*) AS cells_written, false AS created_again FROM cube"""),
    "s3_write_frames": _with(CUBE, "SELECT frame, y, x, iterations::INT AS iterations FROM cube"),
    "s4_commit_log": _with(CUBE, CUBE_WEEKENDS, EVENT_VIEWS, """SELECT commit_seq, frame, message, n_cells, width FROM (
  SELECT 2::BIGINT AS commit_seq, frame, 'all events' AS message, count(*) AS n_cells FROM cube GROUP BY frame
  UNION ALL
  SELECT 3, frame, 'weekends without errors', count(*) FROM weekends GROUP BY frame) JOIN views USING (frame)"""),
    "s5_read_latest": _with(LATEST, "SELECT * FROM latest"),
    "s5_read_source": _with(LATEST, "SELECT * FROM latest WHERE frame % 5 >= 2 AND frame >= 10"),
    "s5_read_values": _with(LATEST, "SELECT * FROM latest WHERE iterations BETWEEN 2 AND 4"),
    "s5_read_rows_layout": _with(LATEST, "SELECT * FROM latest"),
    "s6_read_as_of": _with(CUBE, "SELECT frame, y, x, iterations::INT AS iterations FROM cube"),
    "s7_history": _with(CUBE, CUBE_WEEKENDS, """SELECT 1::BIGINT AS commit_seq,
       'create run' AS message, 0::BIGINT AS n_frames, 0::BIGINT AS n_cells
UNION ALL SELECT 2, 'all events', count(DISTINCT frame), count(*) FROM cube
UNION ALL SELECT 3, 'weekends without errors', count(DISTINCT frame), count(*) FROM weekends"""),
    "s8_scan_run": _with(LATEST, f"""SELECT 'events' AS run_id, {EVENT_FRAMES}::INT AS n_frames,
       {EVENTS_HEIGHT} AS height, {EVENT_WIDTH}::INT AS width_px, 65535 AS max_iter, 'int' AS cell_type,
       count(DISTINCT frame) AS frames_written, count(*) AS cells_written FROM latest"""),
    "s9_read_frame": _with(LATEST, "SELECT * FROM latest WHERE frame = 6"),
    "s10_select_by_width": _with(LATEST, EVENT_VIEWS, """SELECT frame, y, x, iterations, center_re, center_im, width
FROM latest JOIN views USING (frame) WHERE width BETWEEN 0.5 AND 1.75"""),
    "s10_select_one_width": _with(CUBE, EVENT_VIEWS, """SELECT frame, y, x, iterations::INT AS iterations,
       center_re, center_im, width FROM cube JOIN views USING (frame) WHERE width = 0.875"""),
    "s11_list_runs": _with(CUBE, CUBE_WEEKENDS, f"""SELECT 'events' AS run_id, {EVENT_FRAMES}::INT AS n_frames,
       65535 AS max_iter, count(DISTINCT frame) AS frames_done FROM cube
UNION ALL SELECT 'weekends', {EVENT_FRAMES}::INT, 65535, count(DISTINCT frame) FROM weekends
UNION ALL SELECT 'empty', 5, 65535, 0"""),
    "s12_dense_view": _with(CUBE_WEEKENDS, EVENT_VIEWS, f"""SELECT f::INT AS frame, h::INT AS y, u::INT AS x,
       coalesce(iterations, 0)::INT AS iterations, center_re, center_im, width
FROM range({EVENT_FRAMES}) a(f), range({EVENTS_HEIGHT}) b(h), range({EVENT_WIDTH}) c(u)
LEFT JOIN weekends w ON w.frame = f AND y = h AND x = u
LEFT JOIN (SELECT * FROM views WHERE frame IN (SELECT frame FROM weekends)) v ON v.frame = f"""),

    "m1_materialise_frames": _with(SUPPLIER_CELLS, f"SELECT * FROM cells WHERE frame IN {REQUESTED}"),
    "m1_materialise_by_cost": _with(SUPPLIER_CELLS, "SELECT * FROM cells"),
    "m2_zoom_run": _with(_frames(SUPPLIER_VIEWS, STORE_SIZE, FRAME_STEPS, closed_forms=True), "SELECT * FROM cells"),
    "m3_fan_out": _with(SUPPLIER_VIEWS, f"""SELECT t + 2 AS commit_seq, 'task ' || t || ' of 4' AS message,
       min(frame) AS first, max(frame) AS last, (count(*) * {STORE_SIZE * STORE_SIZE})::BIGINT AS n_cells
FROM (SELECT frame, frame // (((SELECT max(frame) + 1 FROM views) + 3) // 4)::BIGINT AS t FROM views) GROUP BY t"""),
    "m3_time_per_frame": """SELECT 'zoom' AS run_id, 2::BIGINT AS commit_seq, count(*) AS n_frames, true AS timed
FROM supplier""",
    "m4_pending_frames": _with(SUPPLIER_VIEWS, f"SELECT * FROM views WHERE frame NOT IN {REQUESTED}"),
    "m5_fill_pending": _with(SUPPLIER_CELLS, f"""SELECT *,
       CASE WHEN frame IN {REQUESTED} THEN 2 ELSE 3 END::BIGINT AS commit_seq FROM cells"""),
    "m6_fill_requests": _with(SUPPLIER_CELLS, f"SELECT * FROM cells WHERE frame IN {REQUESTED}"),
    "s3_write_source": _with(SUPPLIER_CELLS, "SELECT * FROM cells"),
    "m6_fill_from_stream": _with(SUPPLIER_CELLS, f"SELECT * FROM cells WHERE frame IN {REQUESTED}"),

    "a1_frame_stats": _with(_frames(CUSTOMER_VIEWS, SIZE, FRAME_STEPS), _stats("cells", FRAME_STEPS)),
    "a1_large_frame_stats": _with(_frames(SUPPLIER_VIEWS, LARGE_SIZE, LARGE_STEPS), _stats("cells", LARGE_STEPS)),
    "a1_stored_frame_stats": _with(SUPPLIER_CELLS, _stats("cells", FRAME_STEPS)),
    "a1_stored_histogram": _with(LATEST, f"SELECT frame, {BIN} AS bin, count(*) AS n_cells FROM latest GROUP BY ALL"),
    "a2_stored_global_max": _with(LATEST, "SELECT greatest(max(iterations), 1) AS global_max FROM latest"),
    "a2_cells_above": _with(LATEST, f"""bins AS (SELECT {BIN} AS bin, count(*) AS n FROM latest GROUP BY ALL)""",
                            f"""SELECT * FROM latest WHERE {BIN} >= (
  SELECT max(bin) FROM (SELECT bin, sum(n) OVER (ORDER BY bin DESC) AS n FROM bins) WHERE n >= 0.01::DOUBLE * (SELECT sum(n) FROM bins))"""),
    "a2_global_max": _with(LINEITEM_POINTS, _counts(POINT_STEPS),
                           "SELECT greatest(max(iterations), 1) AS global_max FROM counts"),
    "q1_compare_runs": _with(CUBE, CUBE_NO_ERRORS, PAIRED, f"SELECT {_verdict(1.0, 1)} FROM paired"),
    "q1_compare_modes": _with(
        CUSTOMER_VIEWS, _grid(SIZE), _counts(FRAME_STEPS),
        _counts(FRAME_STEPS, "FLOAT", True, name="single"),
        f"cube AS ({_counted('b.frame, b.y, b.x')})",
        f"late AS ({_counted('b.frame, b.y, b.x', 'FLOAT', counts='single')})",
        PAIRED, f"SELECT {_verdict(5.0, 1)} FROM paired"),
    "q2_compare_frames": _with(CUBE, CUBE_NO_ERRORS, PAIRED, f"SELECT frame, {_verdict(1.0, 0)} FROM paired GROUP BY frame"),
    "q2_compare_commits": _with(LATEST, PAIRED.replace("FROM late a", "FROM latest a"),
                                f"SELECT frame, {_verdict(1.0, 0)} FROM paired GROUP BY frame"),
    "v1_mixed_frames": _with(_frames(CUSTOMER_VIEWS, SIZE, FRAME_STEPS), _mixed("cells", FRAME_STEPS)),
    "v1_stored_mixed_frames": _with(SUPPLIER_CELLS, _mixed("cells", FRAME_STEPS)),
    "v2_views_complete": _with(OVERRIDES, """SELECT run_id, count(*) AS n_frames,
       count(*) FILTER (WHERE center_re IS NULL OR center_im IS NULL OR width IS NULL) AS missing,
       min(center_re) = max(center_re) AND min(center_im) = max(center_im) AS center_constant
FROM schedule GROUP BY run_id"""),
    "v3_widths_decrease": _with(OVERRIDES, STEPS, """SELECT run_id, count(next_width) AS n_steps,
       count(*) FILTER (WHERE next_width >= width) AS not_decreasing, coalesce(bool_and(next_width < width), true) AS decreasing
FROM steps GROUP BY run_id"""),
    "v4_widths_log_uniform": _with(OVERRIDES, STEPS, """SELECT run_id, count(step) AS n_steps,
       round(avg(step), 8) AS mean_step, coalesce(bool_and(abs(step - mean) <= 1e-8 + 1e-10 * abs(mean)), true) AS log_uniform
FROM (SELECT *, avg(step) OVER (PARTITION BY run_id) AS mean FROM steps) GROUP BY run_id"""),

    "r1_normalise_global": _with(CUBE, f"SELECT *, {GLOBAL_V}::DOUBLE AS v FROM cube"),
    "r2_normalise_per_frame": _with(CUBE, f"SELECT frame, y, x, iterations, v FROM ({PER_FRAME})"),
    "r1_normalise_stored": _with(CUBE, f"SELECT frame, y, x, iterations::INT AS iterations, {GLOBAL_V}::DOUBLE AS v FROM cube"),
    "r2_normalise_stored": _with(CUBE, f"SELECT frame, y, x, iterations::INT AS iterations, v FROM ({PER_FRAME})"),
    "r3_apply_palette": _with(CUBE, PALETTE, f"""SELECT frame, y, x, r, g, b FROM cube
JOIN palette ON bin = least(trunc({GLOBAL_V} * 256)::INT, 255)"""),
    "r4_flip_rows": _with(CUBE, f"SELECT frame, {EVENTS_HEIGHT - 1} - y AS y, x, iterations FROM cube"),
    "r5_pad_even": _with(ORDER_CUBE, _padded("cube", ORDERS_HEIGHT, ORDERS_WIDTH)),
    "r6_frame_images": _with(
        ORDER_CUBE, PALETTE,
        f"coloured AS (SELECT frame, y, x, r, g, b FROM ({PER_FRAME}) JOIN palette ON bin = least(trunc(v * 256)::INT, 255))",
        f"""SELECT frame, {ORDERS_HEIGHT + ORDERS_HEIGHT % 2} AS height, {ORDERS_WIDTH + ORDERS_WIDTH % 2} AS width_px,
       {_channel_sums(ORDERS_WIDTH + ORDERS_WIDTH % 2)}
FROM ({_padded('coloured', ORDERS_HEIGHT, ORDERS_WIDTH)}) GROUP BY frame"""),
    "r6_tile_images": _with(PYRAMID, f"""SELECT 'events' AS run_id, frame, z, tile_y, tile_x, {TILE * TILE}::BIGINT AS n_pixels,
       {_channel_sums(TILE)}
FROM (SELECT *, value % 256 AS r, (value >> 2) % 256 AS g, 255 - value % 256 AS b FROM pyramid) GROUP BY frame, z, tile_y, tile_x"""),
    "r7_tile_pyramid": _with(PYRAMID, "SELECT 'events' AS run_id, * FROM pyramid"),
    "r7_updated_pyramid": _with(_pyramid("latest"), "SELECT 'events' AS run_id, * FROM pyramid"),
    "r8_find_tile": _with(PYRAMID, """SELECT frame, y, x, value FROM pyramid
WHERE z = (SELECT top FROM top) AND tile_y = 0 AND tile_x = 0"""),

    "r8_tile_window": _with(PYRAMID, """SELECT frame, tile_y, tile_x, y, x, value FROM pyramid
WHERE z = (SELECT top FROM top) AND frame BETWEEN 5 AND 25 AND tile_y BETWEEN 0 AND 1 AND tile_x BETWEEN 1 AND 3"""),

    "b1_record_metrics": _with(METRICS, "SELECT * FROM metrics"),
    "b2_compare_metrics": _with(METRICS, """SELECT stage_id, count(*) AS n_runs, round(avg(wall_time_seconds), 8) AS mean_seconds,
       round((SELECT avg(wall_time_seconds) FROM metrics WHERE stage_id = 'click') / avg(wall_time_seconds), 8) AS speedup,
       rank() OVER (ORDER BY avg(wall_time_seconds))::INT AS place
FROM metrics GROUP BY stage_id"""),
    "b3_ms_per_frame": f"SELECT event_type AS run_id, {MS} FROM events GROUP BY ALL",
    "b3_ms_per_frame_by_task": f"""SELECT event_type AS run_id,
       ({DAY} // (({EVENT_FRAMES} + 7) // 8))::INT AS task_index, {MS} FROM events GROUP BY ALL""",
}
