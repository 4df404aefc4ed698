"""Queries of the episode operators over the data tables, each with its SQL.

Computed doubles are rounded to six places on both sides; every query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import labels as L
from tracewright.functions.geometry import at, norm
from tracewright.functions.stamps import episode_fps, finite, finite_vector, stamp_seconds
from tracewright.functions.vectors import WRENCH_ORDER, first_valid, max_abs, profile_slice
from tracewright.operators import actions as A
from tracewright.operators import align, cameras, convert, dataset, rollups, rules
from tracewright.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

HORIZON = 5
#: The reference's action horizon, of the queries named _50.
REFERENCE_HORIZON = 50
STAMP_SQL = """coalesce(try_cast(source_stamp as double),
  try_cast(json_extract_string(case when source_stamp like '{%' then source_stamp end, '$.sec') as double)
  + 1e-9 * try_cast(json_extract_string(case when source_stamp like '{%' then source_stamp end, '$.nanosec') as double))"""


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def r9(c: Column) -> Column:
    return F.round(c, 9) + F.lit(0.0)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def fin(c: str) -> str:
    return f"({c} is not null and isfinite({c}))"


def vec_ok(c: str, n: int) -> str:
    return f"coalesce(len({c}) = {n} and len(list_filter({c}, lambda x: x is not null and isfinite(x))) = {n}, false)"


# --- actions ---------------------------------------------------------------------------
def poses(spark: SparkSession, d: str) -> DataFrame:
    """Robot poses in m and rad by the units that record or entry state (mm and degrees where
    neither does), with the gripper's value; poses that cannot be converted are left out."""
    p = convert.poses(table(spark, d, "robot_state_rt"), table(spark, d, "streams_index"), convert.SYNTHETIC_UNITS).where("error is null")
    key = ["episode_id", "record_index"]
    g = table(spark, d, "gripper_state").select(*key, "gripper_row_id", convert.gripper_value(F.col("gripper_position"), F.col("gripper_width_m")).alias("gripper"), F.lit(True).alias("held"))
    j = p.join(align.first_by_index(g, key, "gripper_row_id"), key, "left")
    return j.select(*key, "position", "rotation", F.when(F.col("held"), F.col("gripper")).otherwise(0.0).alias("gripper"))


def _unit_sql(record: str, entry: str, keys: tuple[str, ...], default: str) -> str:
    """The record's label for a key, then its entry's, key by key."""
    one = "case when ltrim({0}) like '{{%' then nullif(replace(lower(trim(json_extract_string({0}, '$.{1}'))), ' ', '_'), '') end"
    return "coalesce(" + ", ".join(one.format(u, k) for k in keys for u in (record, entry)) + f", '{default}')"


def _entry_sql(stream: str) -> str:
    return f"(select episode_id, arg_min(units, entry_id) as e from streams_index where stream_name = '{stream}' and ltrim(units) like '{{%' group by 1)"


def _in(labels: list[str]) -> str:
    return "(" + ", ".join(f"'{x}'" for x in labels) + ")"


_GRIP_SQL = f"""(select episode_id, record_index, arg_min({{'p': gripper_position, 'w': gripper_width_m}}, gripper_row_id) as s from gripper_state where record_index is not null group by all)"""
_GRIP_VALUE = f"case when g.s is null then 0.0e0 when {fin('g.s.p')} then g.s.p when {fin('g.s.w')} then g.s.w end"
_POSED_SQL = f"""
one as (select episode_id, record_index, arg_min({{'v': actual_tcp_position, 'u': units}}, state_row_id) as s from robot_state_rt where record_index is not null group by all),
lab as (select one.episode_id, record_index, s.v as v, {_unit_sql("s.u", "e", ("tcp_position",), "mm")} as pu, {_unit_sql("s.u", "e", ("tcp_orientation",), "deg")} as au
  from one left join {_entry_sql("robot_state_rt")} using (episode_id)),
posed as (select episode_id, record_index, {", ".join(f"case when pu in {_in(convert.MILLIMETRES)} then v[{i}] / 1000.0e0 else v[{i}] end as {n}" for i, n in ((1, "x"), (2, "y"), (3, "z")))},
  {", ".join(f"case when au in {_in(convert.DEGREES)} then radians(v[{i}]) else v[{i}] end as {n}" for i, n in ((4, "a"), (5, "b"), (6, "c")))}
  from lab where {vec_ok("v", 6)} and pu in {_in(convert.MILLIMETRES + convert.METRES)} and au in {_in(convert.DEGREES + convert.RADIANS)})
"""
_POSE_SQL = f"""
{_POSED_SQL},
pose as (select p.*, {_GRIP_VALUE} as grip from posed p left join {_GRIP_SQL} g on p.episode_id = g.episode_id and p.record_index = g.record_index),
ang as (select *, sqrt(a*a+b*b+c*c) as th from pose),
fac as (select *, case when th < 1e-12 then 0.5e0 else sin(th/2)/th end as f, case when th < 1e-12 then 1.0e0 else cos(th/2) end as qw from ang),
raw_q as (select episode_id, record_index, grip, x, y, z, a*f as rx, b*f as ry, c*f as rz, qw as rw from fac),
q as (select episode_id, record_index, grip, x, y, z, rx/n as qx, ry/n as qy, rz/n as qz, rw/n as qw from
  (select *, sqrt(rx*rx+ry*ry+rz*rz+rw*rw) as n from raw_q)),
nx as (select *, lead(record_index) over w as nk, lead(x) over w as x1, lead(y) over w as y1, lead(z) over w as z1,
  lead(qx) over w as ax, lead(qy) over w as ay, lead(qz) over w as az, lead(qw) over w as aw, coalesce(lead(grip) over w - grip, 0.0e0) as d_grip from q
  window w as (partition by episode_id order by record_index)),
rel as (select episode_id, record_index, d_grip, nk, x1-x as dx, y1-y as dy, z1-z as dz,
  qw*ax - qx*aw - qy*az + qz*ay as px, qw*ay + qx*az - qy*aw - qz*ax as py,
  qw*az - qx*ay + qy*ax - qz*aw as pz, qw*aw + qx*ax + qy*ay + qz*az as pw from nx),
sgn as (select *, case when pw < 0 then -1.0e0 else 1.0e0 end as s, sqrt(px*px+py*py+pz*pz) as pn from rel),
act as (select episode_id, record_index, d_grip, nk is null as terminal, dx, dy, dz,
  case when pn < 1e-12 then 2.0e0 else 2*atan2(pn, pw*s)/pn end * s as g, px, py, pz from sgn)
"""


@query(
    f"""with {_POSE_SQL}
select episode_id, record_index, terminal,
  round(case when terminal then 0.0e0 else dx end, 6) + 0.0e0 as dx, round(case when terminal then 0.0e0 else dy end, 6) + 0.0e0 as dy,
  round(case when terminal then 0.0e0 else dz end, 6) + 0.0e0 as dz, round(case when terminal then 0.0e0 else px*g end, 6) + 0.0e0 as d_rx,
  round(case when terminal then 0.0e0 else py*g end, 6) + 0.0e0 as d_ry, round(case when terminal then 0.0e0 else pz*g end, 6) + 0.0e0 as d_rz,
  round(case when terminal then 0.0e0 else d_grip end, 6) + 0.0e0 as d_gripper
from act"""
)
def measured_delta_action(spark: SparkSession, d: str) -> DataFrame:
    a = A.measured_actions(poses(spark, d), "episode_id", "record_index")
    names = ["dx", "dy", "dz", "d_rx", "d_ry", "d_rz", "d_gripper"]
    return a.select("episode_id", "record_index", "terminal", *(r6(at(F.col("action"), i)).alias(n) for i, n in enumerate(names)))


def _real_actions(spark: SparkSession, d: str) -> DataFrame:
    f = dataset.without_padding(table(spark, d, "frames")).where(finite_vector(F.col("measured_action"), 7))
    return align.first_by_index(f.select("episode_id", "frame_index", "frame_row_id", F.col("measured_action").alias("action")), ["episode_id", "frame_index"], "frame_row_id")


def _chunk(spark: SparkSession, d: str, pad: str, horizon: int = HORIZON) -> DataFrame:
    c = A.action_chunks(_real_actions(spark, d), "episode_id", "frame_index", horizon, pad)
    return c.select(
        "episode_id", "frame_index", F.col("valid").cast("long").alias("valid"), F.col("padded").cast("long").alias("padded"),
        *(r9(at(F.get("chunk", F.lit(k)), 0)).alias(f"dx_{k}") for k in range(horizon)), r9(at(F.get("chunk", F.lit(horizon - 1)), 5)).alias("last_rz"),
    )


def _chunks_sql(horizon: int) -> str:
    return f"""
a as (select episode_id, frame_index, arg_min(measured_action, frame_row_id) as v from frames
  where not coalesce(action_is_terminal_padding, false) and {vec_ok("measured_action", 7)} group by all),
c as (select episode_id, frame_index, list(v) over (partition by episode_id order by frame_index rows between current row and {horizon - 1} following) as l from a)
"""


def _chunk_sql(filler: str, horizon: int = HORIZON) -> str:
    cols = ", ".join(f"round(case when len(l) > {k} then l[{k + 1}][1] else {filler.format(1)} end, 9) + 0.0e0 as dx_{k}" for k in range(horizon))
    return f"""with {_chunks_sql(horizon)} select episode_id, frame_index, cast(len(l) as bigint) as valid, cast({horizon} - len(l) as bigint) as padded, {cols},
  round(case when len(l) > {horizon - 1} then l[{horizon}][6] else {filler.format(6)} end, 9) + 0.0e0 as last_rz from c"""


@query(_chunk_sql("l[len(l)][{0}]"))
def action_chunk_repeat_last(spark: SparkSession, d: str) -> DataFrame:
    return _chunk(spark, d, "repeat_last")


@query(_chunk_sql("0.0e0"))
def action_chunk_zero_pad(spark: SparkSession, d: str) -> DataFrame:
    return _chunk(spark, d, "zero")


@query(_chunk_sql("l[len(l)][{0}]", REFERENCE_HORIZON))
def action_chunk_repeat_last_50(spark: SparkSession, d: str) -> DataFrame:
    return _chunk(spark, d, "repeat_last", REFERENCE_HORIZON)


@query(_chunk_sql("0.0e0", REFERENCE_HORIZON))
def action_chunk_zero_pad_50(spark: SparkSession, d: str) -> DataFrame:
    return _chunk(spark, d, "zero", REFERENCE_HORIZON)


def _mask_sql(horizon: int) -> str:
    return f"""with {_chunks_sql(horizon)} select episode_id, count(*) as n, cast(sum(len(l)) as bigint) as valid, cast(sum({horizon} - len(l)) as bigint) as padded from c group by episode_id"""


def _mask_stats(spark: SparkSession, d: str, horizon: int) -> DataFrame:
    c = A.action_chunks(_real_actions(spark, d), "episode_id", "frame_index", horizon)
    m = c.withColumn("mask", A.valid_mask(F.col("valid"), horizon))
    ones = F.size(F.filter("mask", lambda x: x))
    return m.groupBy("episode_id").agg(F.count("*").alias("n"), F.sum(ones).cast("long").alias("valid"), F.sum(F.col("padded")).cast("long").alias("padded"))


@query(_mask_sql(HORIZON))
def chunk_mask_stats(spark: SparkSession, d: str) -> DataFrame:
    return _mask_stats(spark, d, HORIZON)


@query(_mask_sql(REFERENCE_HORIZON))
def chunk_mask_stats_50(spark: SparkSession, d: str) -> DataFrame:
    return _mask_stats(spark, d, REFERENCE_HORIZON)


# --- time ------------------------------------------------------------------------------
@query(
    """with f as (select episode_id, frame_index, min_by("timestamp", frame_row_id) as t from frames where "timestamp" is not null group by all),
l as (select *, lag(t) over (partition by episode_id order by frame_index) as p from f),
g as (select episode_id, min_by(t, frame_index) as t0, bool_and(p is null or t > p) as ok from l group by episode_id)
select f.episode_id, frame_index, round(case when ok then t - t0 end, 6) + 0.0e0 as rel, ok as increasing from f join g using (episode_id)"""
)
def relative_timestamps(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames").where("timestamp is not null")
    one = f.groupBy("episode_id", "frame_index").agg(F.min_by("timestamp", "frame_row_id").alias("t"))
    return A.relative_time(one, "episode_id", "frame_index", "t").select("episode_id", "frame_index", r6("rel").alias("rel"), "increasing")


@query(
    """with f as (select episode_id, frame_index, min_by("timestamp", frame_row_id) as t from frames where "timestamp" is not null group by all),
s as (select *, t - lag(t) over (partition by episode_id order by frame_index, t) as dt from f)
select s.episode_id, count(*) as n, round(min(dt), 6) + 0.0e0 as min_dt, round(max(dt), 6) + 0.0e0 as max_dt, round(avg(dt), 6) + 0.0e0 as mean_dt,
  round(max(t) - min(t), 6) + 0.0e0 as duration, round(1.0e0 / coalesce(max(m.fps), 30.0e0), 6) + 0.0e0 as expected_dt
from s left join (select episode_id, max(fps) as fps from metadata where fps > 0 and isfinite(fps) group by 1) m on s.episode_id = m.episode_id group by s.episode_id"""
)
def dt_stats(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames").where("timestamp is not null")
    one = f.groupBy("episode_id", "frame_index").agg(F.min_by("timestamp", "frame_row_id").alias("t"))
    s = rollups.step_stats(one, "episode_id", "frame_index", "t").join(episode_fps(table(spark, d, "metadata")), "episode_id", "left")
    return s.select("episode_id", "n", *(r6(c).alias(c) for c in ("min_dt", "max_dt", "mean_dt", "duration")), r6(1.0 / F.coalesce("fps", F.lit(30.0))).alias("expected_dt"))


@query(
    """with o as (select episode_id, receipt_stamp as v, last_value(receipt_stamp ignore nulls) over (partition by episode_id order by record_index, state_row_id rows between unbounded preceding and 1 preceding) as p from robot_state_rt)
select episode_id, count(*) as n, count(*) filter (v < p) as n_falls from o group by episode_id"""
)
def monotonic_last_valid(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "robot_state_rt").select("episode_id", "record_index", "state_row_id", F.col("receipt_stamp").alias("v"))
    w = A.with_last_valid(r, "episode_id", "record_index", ["v"], ("state_row_id",))
    f = w.withColumn("falls", F.coalesce(F.col("v") < F.col("last_v"), F.lit(False)))
    return f.groupBy("episode_id").agg(F.count("*").alias("n"), F.count(F.when(F.col("falls"), 1)).alias("n_falls"))


# --- alignment -------------------------------------------------------------------------
@query(
    """select episode_id, cast(count(*) as bigint) as n, count(distinct record_index) as n_distinct, min(record_index) as lo, max(record_index) as hi,
  coalesce(min(record_index) = 0 and max(record_index) = count(*) - 1 and count(*) = count(distinct record_index) and count(*) >= 2, false) as contiguous
from robot_state_rt group by episode_id"""
)
def record_index_contiguity(spark: SparkSession, d: str) -> DataFrame:
    return align.contiguity(table(spark, d, "robot_state_rt"), "episode_id", "record_index")


@query("select episode_id, record_index, count(*) as n from joint_states group by all having count(*) > 1")
def duplicate_record_index(spark: SparkSession, d: str) -> DataFrame:
    return align.duplicates(table(spark, d, "joint_states"), ["episode_id", "record_index"])


@query(
    """with a as (select distinct episode_id, record_index, 1 as in_a from robot_state_rt), b as (select distinct episode_id, record_index, 1 as in_b from joint_states),
j as (select coalesce(a.episode_id, b.episode_id) as episode_id, coalesce(a.record_index, b.record_index) as k, in_a, in_b from a full join b on a.episode_id = b.episode_id and a.record_index = b.record_index)
select episode_id, count(*) filter (in_a = 1 and in_b = 1) as n_common, count(*) filter (in_b is null) as n_missing, count(*) filter (in_a is null) as n_extra,
  array_to_string(list_sort(list(k) filter (in_b is null))[1:10], ',') as first_missing, array_to_string(list_sort(list(k) filter (in_a is null))[1:10], ',') as first_extra,
  count(*) filter (in_b is null) = 0 and count(*) filter (in_a is null) = 0 as aligned
from j group by episode_id"""
)
def stream_alignment(spark: SparkSession, d: str) -> DataFrame:
    return align.alignment(table(spark, d, "robot_state_rt"), table(spark, d, "joint_states"))


@query(
    f"""with r as (select episode_id, record_index, min_by({STAMP_SQL}, state_row_id) as t from robot_state_rt group by all),
j as (select episode_id, record_index, min_by({STAMP_SQL}, joint_row_id) as t from joint_states group by all)
select r.episode_id, r.record_index, round(j.t - r.t, 6) + 0.0e0 as skew from r join j on r.episode_id = j.episode_id and r.record_index = j.record_index"""
)
def aligned_inner_join(spark: SparkSession, d: str) -> DataFrame:
    key = ["episode_id", "record_index"]
    r = table(spark, d, "robot_state_rt").select(*key, "state_row_id", stamp_seconds(F.col("source_stamp")).alias("t"))
    j = table(spark, d, "joint_states").select(*key, "joint_row_id", stamp_seconds(F.col("source_stamp")).alias("u"))
    return align.first_by_index(r, key, "state_row_id").join(align.first_by_index(j, key, "joint_row_id"), key).select(*key, r6(F.col("u") - F.col("t")).alias("skew"))


@query(
    f"""with r as (select distinct episode_id, record_index from robot_state_rt),
g as (select episode_id, record_index, min_by({{'p': gripper_position, 'w': gripper_width_m}}, gripper_row_id) as s from gripper_state group by all)
select r.episode_id, r.record_index, round(case when {fin("s.p")} then s.p when {fin("s.w")} then s.w else 0.0e0 end, 6) + 0.0e0 as gripper,
  case when {fin("s.p")} then 'gripper_position' when {fin("s.w")} then 'gripper_width_m' else 'none' end as source
from r left join g on r.episode_id = g.episode_id and r.record_index = g.record_index"""
)
def gripper_left_join(spark: SparkSession, d: str) -> DataFrame:
    key = ["episode_id", "record_index"]
    g = align.first_by_index(table(spark, d, "gripper_state").select(*key, "gripper_row_id", F.col("gripper_position").alias("p"), F.col("gripper_width_m").alias("w")), key, "gripper_row_id")
    r = table(spark, d, "robot_state_rt").select(*key).distinct().join(g, key, "left")
    p, w = F.when(finite(F.col("p")), F.col("p")), F.when(finite(F.col("w")), F.col("w"))
    return r.select(*key, r6(F.coalesce(p, w, F.lit(0.0))).alias("gripper"), F.when(p.isNotNull(), "gripper_position").when(w.isNotNull(), "gripper_width_m").otherwise("none").alias("source"))


_OFFSET_SQL = f"""
r as (select episode_id, record_index, min_by({STAMP_SQL}, state_row_id) as t from robot_state_rt group by all),
c as (select episode_id, stream_name, record_index, min_by({STAMP_SQL}, camera_row_id) as u from camera_index group by all),
m as (select episode_id, max(fps) as fps from metadata where fps > 0 and isfinite(fps) group by 1),
o as (select c.episode_id, stream_name, c.record_index, u - t as off, coalesce(0.5e0 / fps, 0.02e0) as tol
  from c join r on c.episode_id = r.episode_id and c.record_index = r.record_index left join m on c.episode_id = m.episode_id where t is not null and u is not null)
"""


def _offsets(spark: SparkSession, d: str) -> DataFrame:
    key = ["episode_id", "record_index"]
    r = align.first_by_index(table(spark, d, "robot_state_rt").select(*key, "state_row_id", stamp_seconds(F.col("source_stamp")).alias("t")), key, "state_row_id").drop("state_row_id")
    c = align.first_by_index(
        table(spark, d, "camera_index").select("episode_id", "stream_name", "record_index", "camera_row_id", stamp_seconds(F.col("source_stamp")).alias("u")), ["episode_id", "stream_name", "record_index"], "camera_row_id"
    )
    m = episode_fps(table(spark, d, "metadata"))
    return c.join(r, key).join(m, "episode_id", "left").where("t is not null and u is not null").select("episode_id", "stream_name", "record_index", (F.col("u") - F.col("t")).alias("offset"), align.tolerance(F.col("fps")).alias("tol"))


@query(
    f"""with {_OFFSET_SQL} select episode_id, stream_name, count(*) as n, min(record_index) as record_index, round(min_by(off, record_index), 6) + 0.0e0 as "offset" from o where abs(off) > tol group by all"""
)
def camera_sync_violations(spark: SparkSession, d: str) -> DataFrame:
    return align.sync_violations(_offsets(spark, d), ["episode_id", "stream_name"]).withColumn("offset", r6("offset"))


@query(
    f"""with {_OFFSET_SQL} select episode_id, stream_name, count(*) as n, round(min(off), 6) + 0.0e0 as min_offset, round(max(off), 6) + 0.0e0 as max_offset,
  round(avg(off), 6) + 0.0e0 as mean_offset, round(max(abs(off)), 6) + 0.0e0 as max_abs_offset from o group by all"""
)
def camera_offset_summary(spark: SparkSession, d: str) -> DataFrame:
    s = align.offset_summary(_offsets(spark, d), ["episode_id", "stream_name"])
    return s.select("episode_id", "stream_name", "n", *(r6(c).alias(c) for c in ("min_offset", "max_offset", "mean_offset", "max_abs_offset")))


@query(
    """with a as (select distinct episode_id from frames), b as (select distinct episode_id from raw_meta), j as (select a.episode_id as x, b.episode_id as y from a full join b using (episode_id))
select count(*) filter (x is not null and y is not null) as n_both, count(*) filter (y is null) as n_only_a, count(*) filter (x is null) as n_only_b from j""".replace("raw_meta", "metadata")
)
def episode_set_sizes(spark: SparkSession, d: str) -> DataFrame:
    return align.set_sizes(table(spark, d, "frames"), table(spark, d, "metadata"), ["episode_id"])


# --- vectors ---------------------------------------------------------------------------
@query(
    """select frame_row_id, cast(len(model_state[1:13]) as bigint) as dim, round(sqrt(list_sum([x*x for x in model_state[1:13]])), 6) + 0.0e0 as norm_13
from frames where model_state is not null and len(model_state) = 25 and len(list_filter(model_state, lambda x: x is not null)) = 25"""
)
def profile_slice_13(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames").where((F.size("model_state") == 25) & F.forall("model_state", lambda x: x.isNotNull()))
    s = profile_slice(F.col("model_state"), "compact_13d")
    return f.select("frame_row_id", F.size(s).cast("long").alias("dim"), r6(norm(s)).alias("norm_13"))


@query(
    f"""select episode_id, count(*) as n, count(*) filter ({vec_ok("position", 6)}) as n_position, count(*) filter ({vec_ok("velocity", 6)}) as n_velocity,
  count(*) filter (len(joint_names) = 6 and len(list_distinct(joint_names)) = 6) as n_names from joint_states group by episode_id"""
)
def vector_checks(spark: SparkSession, d: str) -> DataFrame:
    tests = {
        "position": finite_vector(F.col("position"), 6),
        "velocity": finite_vector(F.col("velocity"), 6),
        "names": (F.size("joint_names") == 6) & (F.size(F.array_distinct("joint_names")) == 6),
    }
    return rollups.valid_counts(table(spark, d, "joint_states"), ["episode_id"], tests)


@query(
    """with w as (select episode_id, model_state[8:13] as w from frames where model_state is not null and len(list_filter(model_state, lambda x: x is not null and isfinite(x))) = 25)
select episode_id, """
    + ", ".join(f"round(max(abs(w[{i + 1}])), 6) + 0.0e0 as max_{a}" for i, a in enumerate(("fx", "fy", "fz", "tx", "ty", "tz")))
    + """, round(max(sqrt(w[1]*w[1]+w[2]*w[2]+w[3]*w[3])), 6) + 0.0e0 as max_force, round(max(sqrt(w[4]*w[4]+w[5]*w[5]+w[6]*w[6])), 6) + 0.0e0 as max_torque from w group by episode_id"""
)
def state_wrench_stats(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames").where(finite_vector(F.col("model_state"), 25))
    s = rollups.wrench_stats(f)
    return s.select("episode_id", *(r6(c).alias(c) for c in s.columns[1:]))


@query(
    f"""with s as (select episode_id, sqrt(v[1]*v[1]+v[2]*v[2]+v[3]*v[3]) as t, sqrt(v[4]*v[4]+v[5]*v[5]+v[6]*v[6]) as r from (select episode_id, measured_action as v from frames
  where not coalesce(action_is_terminal_padding, false) and {vec_ok("measured_action", 7)}))
select episode_id, round(avg(t), 6) + 0.0e0 as mean_translation, round(max(t), 6) + 0.0e0 as max_translation, count(*) filter (t > 1e-12) as nonzero_translation,
  round(avg(r), 6) + 0.0e0 as mean_rotation, round(max(r), 6) + 0.0e0 as max_rotation, count(*) filter (r > 1e-12) as nonzero_rotation from s group by episode_id"""
)
def motion_stats(spark: SparkSession, d: str) -> DataFrame:
    s = rollups.motion_stats(table(spark, d, "frames").where(finite_vector(F.col("measured_action"), 7)))
    return s.select("episode_id", *(c if c.startswith("nonzero") else r6(c).alias(c) for c in s.columns[1:]))


@query(
    "select state_row_id, "
    + "round(case "
    + " ".join(f"when {vec_ok(c, 6)} then {c}[3]" for c in WRENCH_ORDER)
    + " end, 6) + 0.0e0 as fz, case "
    + " ".join(f"when {vec_ok(c, 6)} then '{c}'" for c in WRENCH_ORDER)
    + " end as source from robot_state_rt"
)
def wrench_priority(spark: SparkSession, d: str) -> DataFrame:
    v, s = first_valid(list(WRENCH_ORDER), 6)
    return table(spark, d, "robot_state_rt").select("state_row_id", r6(at(v, 2)).alias("fz"), s.alias("source"))


@query(
    f"""with j as (select episode_id, record_index, min_by({{'p': position, 'v': velocity}}, joint_row_id) as s from joint_states group by all),
f as (select episode_id, frame_index, min_by(model_state, frame_row_id) as m from frames group by all)
select f.episode_id, frame_index, case when {vec_ok("m", 25)} then 'state' when {vec_ok("s.p", 6)} then 'joint_states' end as position_source,
  round(case when {vec_ok("m", 25)} then m[14] when {vec_ok("s.p", 6)} then s.p[1] end, 6) + 0.0e0 as first_joint,
  case when {vec_ok("m", 25)} then 'state' when {vec_ok("s.v", 6)} then 'joint_states' end as velocity_source
from f left join j on f.episode_id = j.episode_id and f.frame_index = j.record_index"""
)
def joint_priority(spark: SparkSession, d: str) -> DataFrame:
    f = align.first_by_index(table(spark, d, "frames").select("episode_id", "frame_index", "frame_row_id", F.col("model_state").alias("m")), ["episode_id", "frame_index"], "frame_row_id")
    j = align.first_by_index(table(spark, d, "joint_states").select("episode_id", F.col("record_index").alias("frame_index"), "joint_row_id", "position", "velocity"), ["episode_id", "frame_index"], "joint_row_id")
    x = f.join(j, ["episode_id", "frame_index"], "left")
    st, p, v = finite_vector(F.col("m"), 25), finite_vector(F.col("position"), 6), finite_vector(F.col("velocity"), 6)
    return x.select(
        "episode_id", "frame_index", F.when(st, "state").when(p, "joint_states").alias("position_source"),
        r6(F.when(st, at(F.col("m"), 13)).when(p, at(F.col("position"), 0))).alias("first_joint"), F.when(st, "state").when(v, "joint_states").alias("velocity_source"),
    )


@query(
    """with e as (select vec_id, label, cast(x as double) as x from (select vec_id, label, unnest(embedding) as x from embeddings)),
v as (select vec_id, label, count(*) as size, min(x) as least, max(x) as largest, avg(x) as mean, max(abs(x)) as top from e group by all)
select vec_id, cast(size as bigint) as size, round(least, 6) + 0.0e0 as least, round(largest, 6) + 0.0e0 as largest, round(mean, 6) + 0.0e0 as mean, round(top, 6) + 0.0e0 as max_abs from v"""
)
def array_summary(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    size, lo, hi, mean = rollups.summarize_array(F.col("e"))
    x = e.select("vec_id", size, lo, hi, mean, max_abs(F.col("e")).alias("max_abs"))
    return x.select("vec_id", F.col("size").cast("long").alias("size"), *(r6(c).alias(c) for c in ("least", "largest", "mean", "max_abs")))


# --- dataset ---------------------------------------------------------------------------
@query(
    """select episode_id, count(*) as frames_in, count(*) filter (k) as exported, count(*) filter (not k) as excluded,
  count(*) filter (k and length(trim(external_rgb_path)) > 0) as external_images, count(*) filter (k and length(trim(tcp_rgb_path)) > 0) as tcp_images,
  min(frame_index) filter (k) as first_frame, cast(len(min_by({'v': measured_action}, (frame_index, frame_row_id)) filter (k).v) as bigint) as action_length, cast(13 as bigint) as state_dim,
  round(min_by({'v': "timestamp"}, (frame_index, frame_row_id)) filter (k).v, 6) + 0.0e0 as first_timestamp, cast(len(min_by({'v': model_state[1:13]}, (frame_index, frame_row_id)) filter (k).v) as bigint) as state_length,
  any_value(first_task) as first_task
from (select f.*, first_task, not coalesce(action_is_terminal_padding, false) as k from frames f left join (select episode_id, min_by(task_instruction, meta_row_id) as first_task from metadata group by 1) m on f.episode_id = m.episode_id) group by episode_id"""
)
def export_plan(spark: SparkSession, d: str) -> DataFrame:
    p = dataset.export_plan(table(spark, d, "frames"), "compact_13d", table(spark, d, "metadata"))
    return p.withColumn("first_timestamp", r6("first_timestamp"))


@query(
    """with m as (select episode_id, min_by(task_instruction, meta_row_id) as task from metadata group by 1)
select f.episode_id, count(*) as n, count(task) as n_task, cast(sum(case when f.model_state is not null then 1 else 0 end) as bigint) as n_state from frames f left join m using (episode_id)
where not coalesce(action_is_terminal_padding, false) group by f.episode_id"""
)
def staged_export(spark: SparkSession, d: str) -> DataFrame:
    s = dataset.staged(table(spark, d, "frames"), table(spark, d, "metadata"), "compact_13d")
    return s.groupBy("episode_id").agg(F.count("*").alias("n"), F.count("prompt").alias("n_task"), F.count("`observation.state`").alias("n_state"))


@query(
    """with t as (select task_instruction as task, min(episode_id) as first_at from metadata where length(trim(task_instruction)) > 0 group by 1)
select task, row_number() over (order by first_at, task) - 1 as task_index, first_at from t"""
)
def task_dictionary(spark: SparkSession, d: str) -> DataFrame:
    return dataset.task_dictionary(table(spark, d, "metadata").withColumn("task", F.col("task_instruction")), "episode_id")


_EPISODES_SQL = """
e as (select episode_id, count(*) as length from frames group by 1),
x as (select *, row_number() over (order by episode_id) - 1 as episode_index, coalesce(cast(sum(length) over (order by episode_id rows between unbounded preceding and 1 preceding) as bigint), 0) as "offset" from e)
"""


@query(f"""with {_EPISODES_SQL} select episode_id, episode_index, length, "offset", cast(episode_index // 1000 as bigint) as chunk,
  printf('data/chunk-%03d/episode_%06d.parquet', episode_index // 1000, episode_index) as path from x""")
def episode_layout(spark: SparkSession, d: str) -> DataFrame:
    e = dataset.episode_table(table(spark, d, "frames"))
    return e.withColumn("path", dataset.data_path(F.col("episode_index"))).withColumn("chunk", F.col("chunk").cast("long"))


@query(f"""with {_EPISODES_SQL} select frame_row_id, episode_index, row_number() over w - 1 as ordinal, "offset" + row_number() over w - 1 as global_index
from frames join x using (episode_id) window w as (partition by episode_id order by frame_index, frame_row_id)""")
def global_frame_index(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames")
    g = dataset.global_index(f.select("episode_id", "frame_index", "frame_row_id"), dataset.episode_table(f))
    return g.select("frame_row_id", "episode_index", F.col("ordinal").cast("long").alias("ordinal"), F.col("global_index").cast("long").alias("global_index"))


@query(
    """select (select count(distinct episode_id) from frames) as total_episodes, (select count(*) from frames) as total_frames,
  (select count(distinct task_instruction) from metadata where length(trim(task_instruction)) > 0) as total_tasks,
  cast(ceil((select count(distinct episode_id) from frames) / 1000.0) as bigint) as total_chunks, '0:' || (select count(distinct episode_id) from frames) as split"""
)
def dataset_info(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "frames").groupBy("episode_id").agg(F.count("*").alias("length"))
    t = dataset.task_dictionary(table(spark, d, "metadata").withColumn("task", F.col("task_instruction")), "episode_id")
    return dataset.dataset_info(e, t).withColumn("total_chunks", F.col("total_chunks").cast("long"))


@query(
    """with v as (select distinct episode_id, fps from metadata) select episode_id, count(*) as n_values, count(*) = 1 as consistent from v group by episode_id"""
)
def fps_consistency(spark: SparkSession, d: str) -> DataFrame:
    return rollups.consistent(table(spark, d, "metadata"), ["episode_id"], "fps")


@query(
    """select 'frames' as child, count(*) as n_orphans, count(distinct episode_id) as n_keys from frames where episode_id not in (select episode_id from metadata where episode_id is not null)
union all select 'raw_frames', count(*), count(distinct l_orderkey) from lineitem where l_orderkey not in (select o_orderkey from orders)
union all select 'streams_index', count(*), count(distinct episode_id) from frames where episode_id not in (select episode_id from streams_index where stream_name = 'joint_states')"""
)
def fk_consistency(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames").select("episode_id")
    si = table(spark, d, "streams_index").where("stream_name = 'joint_states'")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"))
    parts = [
        ("frames", f.join(table(spark, d, "metadata").select("episode_id").distinct(), "episode_id", "left_anti").select(F.col("episode_id").alias("k"))),
        ("raw_frames", li.join(table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).distinct(), "k", "left_anti").select(F.col("k").cast("string").alias("k"))),
        ("streams_index", f.join(si.select("episode_id").distinct(), "episode_id", "left_anti").select(F.col("episode_id").alias("k"))),
    ]
    out = None
    for name, x in parts:
        g = x.agg(F.count("*").alias("n_orphans"), F.countDistinct("k").alias("n_keys")).select(F.lit(name).alias("child"), "n_orphans", "n_keys")
        out = g if out is None else out.unionByName(g)
    return out


# --- summaries -------------------------------------------------------------------------
@query(
    f"""with p as (select episode_id, record_index, count(*) as c, min({STAMP_SQL}) as a, max({STAMP_SQL}) as b from joint_states group by all)
select episode_id, cast(sum(c) as bigint) as n, count(record_index) as n_index, min(record_index) as min_index, max(record_index) as max_index,
  round(min_by(a, record_index), 6) + 0.0e0 as first_stamp, round(max_by(b, record_index), 6) + 0.0e0 as last_stamp, sum(c) = count(record_index) as "unique",
  round(max_by(b, record_index) - min_by(a, record_index), 6) + 0.0e0 as duration from p group by episode_id"""
)
def stream_summary(spark: SparkSession, d: str) -> DataFrame:
    j = table(spark, d, "joint_states").withColumn("t", stamp_seconds(F.col("source_stamp")))
    s = rollups.stream_summary(j, ["episode_id"], "record_index", "t")
    return s.select("episode_id", "n", "n_index", "min_index", "max_index", r6("first_stamp").alias("first_stamp"), r6("last_stamp").alias("last_stamp"), "unique", r6("duration").alias("duration"))


@query(
    """with a as (select episode_id, count(*) as actual from gripper_state group by 1)
select entry_id, record_count as declared, coalesce(actual, 0) as actual, coalesce(record_count = coalesce(actual, 0), false) as agrees
from streams_index left join a using (episode_id) where stream_name = 'gripper_state'"""
)
def declared_counts(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "streams_index").where("stream_name = 'gripper_state'").select("entry_id", "episode_id", F.col("record_count").alias("declared"))
    return rollups.declared_against_actual(s, table(spark, d, "gripper_state"), ["episode_id"]).select("entry_id", "declared", "actual", "agrees")


@query(
    """with p as (select episode_id, stream_name, image_path, count(*) as c, min(record_index) as lo, max(record_index) as hi, coalesce(length(trim(image_path)) > 0, false) as h,
  coalesce(length(trim(image_path)) > 0 and not starts_with(trim(image_path), '/') and not list_contains(string_split(trim(image_path), '/'), '..'), false) as safe from camera_index group by all)
select episode_id, stream_name, cast(sum(c) as bigint) as n, coalesce(cast(sum(c) filter (not h) as bigint), 0) as n_missing, coalesce(cast(sum(c) filter (h and not safe) as bigint), 0) as n_unsafe,
  coalesce(cast(sum(c - 1) filter (h) as bigint), 0) as n_repeated, min_by(image_path, (lo, image_path)) filter (h) as first_path, max_by(image_path, (hi, image_path)) filter (h) as last_path
from p group by episode_id, stream_name"""
)
def camera_file_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rollups.camera_rollup(table(spark, d, "camera_index"))


@query(
    """with v as (select distinct episode_id, lower(regexp_extract(gripper_command, '^[A-Za-z]+')) as verb from gripper_state where gripper_command is not null)
select episode_id, count(*) as n_values, array_to_string(list_sort(list(verb)), ',') as labels from v group by episode_id"""
)
def command_sets(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gripper_state").where("gripper_command is not null").withColumn("verb", F.lower(F.regexp_extract("gripper_command", "^[A-Za-z]+", 0)))
    return rollups.distinct_list(g, ["episode_id"], "verb")


@query(
    """select episode_id, count(gripper_command) as n, min_by(gripper_command, (record_index, gripper_row_id)) filter (gripper_command is not null) as first_value,
  max_by(gripper_command, (record_index, gripper_row_id)) filter (gripper_command is not null) as last_value from gripper_state group by episode_id"""
)
def command_first_last(spark: SparkSession, d: str) -> DataFrame:
    return rollups.first_and_last(table(spark, d, "gripper_state"), ["episode_id"], "gripper_command", F.struct("record_index", "gripper_row_id"))


# --- labels, paths, roles --------------------------------------------------------------
_SAFE = "coalesce(length(trim({0})) > 0 and not starts_with(trim({0}), '/') and not list_contains(string_split(trim({0}), '/'), '..'), false)"


@query(
    f"""select frame_row_id, {_SAFE.format("external_rgb_path")} as external_safe, {_SAFE.format("tcp_rgb_path")} as tcp_safe,
  lpad(cast(frame_index as varchar), 6, '0') || '.jpg' as staged_name from frames"""
)
def safe_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "frames").select("frame_row_id", L.safe_path(F.col("external_rgb_path")).alias("external_safe"), L.safe_path(F.col("tcp_rgb_path")).alias("tcp_safe"), L.numbered_name(F.col("frame_index"), ".jpg").alias("staged_name"))


_LABEL = "replace(replace(lower(trim({0})), ' ', '_'), '-', '_')"


@query(
    f"""select doc_id, {_LABEL.format("source")} as label, coalesce({_LABEL.format("source")} in ('', 'unknown', 'unverified', 'unset', 'todo', 'tbd', 'none', 'null', 'n/a', 'na')
  or starts_with({_LABEL.format("source")}, 'unknown') or starts_with({_LABEL.format("source")}, 'todo') or starts_with({_LABEL.format("source")}, 'tbd'), true) as unknown from documents"""
)
def source_labels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", L.label(F.col("source")).alias("label"), L.is_unknown(F.col("source")).alias("unknown"))


@query(
    """select meta_row_id, coalesce(collection_method in ('synthetic_raw_real', 'synthetic_raw_real_fixture', 'pipeline_smoke', 'pipeline_smoke_raw_real'), false)
  or coalesce(recorder_version in ('synthetic_raw_real_generator_v0', 'pipeline_smoke_raw_real_generator_v0'), false) as synthetic,
  regexp_matches(lower(coalesce(failure_reason, '')), 'fail|stop|end|unknown|limit') as mentions_end from metadata"""
)
def synthetic_flags(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "metadata").select("meta_row_id", L.is_synthetic(F.col("collection_method"), F.col("recorder_version")).alias("synthetic"), L.mentions(F.col("failure_reason"), ["fail", "stop", "end", "unknown", "limit"]).alias("mentions_end"))


@query(
    f"""with c as (select distinct episode_id, stream_name, case when stream_name in ('tcp_camera', 'wrist_camera') then 'tcp' when stream_name = 'external_camera' or starts_with(stream_name, 'external_camera_') then 'external' end as "view"
  from streams_index where stream_name in {_in(L.CAMERA_STREAMS)} or replace(replace(lower(trim(kind)), ' ', '_'), '-', '_') in {_in(L.CAMERA_KINDS)}),
i as (select episode_id, "view", count(*) as n, min(stream_name) as s from c where "view" is not null group by all),
w as (select episode_id, v as "view" from (select distinct episode_id from streams_index), (values ('external'), ('tcp')) as t(v))
select w.episode_id, w."view", case when n = 1 then s end as stream_name, case when n = 1 then 'inferred' end as source,
  case when n is null then 'no camera stream' when n > 1 then 'multiple candidates' end as error from w left join i on w.episode_id = i.episode_id and w."view" = i."view" """
)
def camera_views(spark: SparkSession, d: str) -> DataFrame:
    return cameras.select_views(table(spark, d, "streams_index").select("episode_id", "stream_name", "kind"))


@query(
    """select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, coalesce(cast(json_extract_string(props, '$.k') as bigint) % 2 = 0, false) as even,
  json_extract_string(props, '$.missing') is null as lacks_key from events"""
)
def json_props(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("long")
    return table(spark, d, "events").select("event_id", k.alias("k"), F.coalesce(k % 2 == 0, F.lit(False)).alias("even"), F.get_json_object("props", "$.missing").isNull().alias("lacks_key"))


@query(
    """select user_id, count(*) as n, count(*) filter (not coalesce(length(trim(event_type)) > 0, false)) as n_nameless, min_by(event_type, (ts, event_id)) as first_event,
  max_by(event_type, (ts, event_id)) as last_event, coalesce(min_by(event_type, (ts, event_id)) = 'view', false) as starts_right from events group by user_id"""
)
def event_log_validation(spark: SparkSession, d: str) -> DataFrame:
    return rules.event_log_rules(table(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type", "view")


# --- validation ------------------------------------------------------------------------
def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: table(spark, d, n) for n in rules.LAYERS}


_TEXTS = ["schema_version", "episode_id", "task_instruction", "geometry_type", "orientation_type", "collection_method", "action_label_primary", "robot_type", "recorder_version"]


def _ne(c: str) -> str:
    return f"coalesce(length(trim({c})) > 0, false)"


def _unknown(c: str) -> str:
    n = _LABEL.format(c)
    return f"coalesce({n} in ('', 'unknown', 'unverified', 'unset', 'todo', 'tbd', 'none', 'null', 'n/a', 'na') or starts_with({n}, 'unknown') or starts_with({n}, 'todo') or starts_with({n}, 'tbd'), true)"


def _common(stamps=("receipt_stamp",)) -> list[tuple[str, str, str]]:
    return [
        ("record_index_invalid", "error", "not coalesce(record_index >= 0, false)"),
        ("source_stamp_invalid", "error", f"not coalesce({fin(STAMP_SQL)}, false)"),
        *((f"{s}_invalid", "error", f"not {fin(s)}") for s in stamps),
    ]


_RULE_SQL: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "metadata": (
        "meta_row_id",
        [
            *((f"{t}_empty", "error", f"not {_ne(t)}") for t in _TEXTS),
            ("schema_version_unknown", "error", "coalesce(schema_version <> 'raw_real_v0', false)"),
            ("success_missing", "error", "success is null"),
            ("failure_reason_missing", "error", f"coalesce(not success, false) and not {_ne('failure_reason')}"),
            ("failure_reason_blank", "error", f"failure_reason is not null and not {_ne('failure_reason')}"),
            ("fps_invalid", "error", "not coalesce(isfinite(fps) and fps > 0, false)"),
            ("operator_unknown", "warning", _unknown("operator_id")),
        ],
    ),
    "frames": (
        "frame_row_id",
        [
            ("frame_index_invalid", "error", "not coalesce(frame_index >= 0, false)"),
            ("timestamp_invalid", "error", 'not coalesce(isfinite("timestamp"), false)'),
            ("state_invalid", "error", f"not {vec_ok('model_state', 25)}"),
            ("action_invalid", "error", f"not {vec_ok('measured_action', 7)}"),
            ("padding_missing", "error", "action_is_terminal_padding is null"),
            ("padding_not_zero", "error", "coalesce(action_is_terminal_padding, false) and not coalesce(len(list_filter(measured_action, lambda x: abs(x) <= 1e-12)) = len(measured_action), false)"),
            ("external_path_empty", "error", f"not {_ne('external_rgb_path')}"),
            ("tcp_path_empty", "error", f"not {_ne('tcp_rgb_path')}"),
        ],
    ),
    "robot_state_rt": (
        "state_row_id",
        [
            *_common(("receipt_stamp", "monotonic_stamp")),
            ("tcp_position_invalid", "error", f"not {vec_ok('actual_tcp_position', 6)}"),
            ("wrench_missing", "error", "not (" + " or ".join(vec_ok(c, 6) for c in WRENCH_ORDER) + ")"),
        ],
    ),
    "joint_states": (
        "joint_row_id",
        [
            *_common(),
            ("joint_names_invalid", "error", "not coalesce(len(joint_names) = 6 and len(list_distinct(joint_names)) = 6, false)"),
            ("position_invalid", "error", f"not {vec_ok('position', 6)}"),
            ("velocity_invalid", "error", f"not {vec_ok('velocity', 6)}"),
        ],
    ),
    "gripper_state": (
        "gripper_row_id",
        [
            *_common(),
            ("value_missing", "error", f"not ({fin('gripper_position')} or {fin('gripper_width_m')})"),
            ("width_negative", "error", f"{fin('gripper_width_m')} and gripper_width_m < 0"),
            ("placeholder", "warning", "coalesce(placeholder, false)"),
        ],
    ),
    "camera_index": (
        "camera_row_id",
        [
            *_common(),
            ("image_path_empty", "error", f"not {_ne('image_path')}"),
            ("image_path_unsafe", "error", f"{_ne('image_path')} and not {_SAFE.format('image_path')}"),
            ("size_invalid", "error", "not coalesce(width > 0 and height > 0, false)"),
            ("role_missing", "warning", f"not {_ne('camera_role')}"),
        ],
    ),
    "streams_index": (
        "entry_id",
        [
            ("source_name_empty", "error", f"not {_ne('source_name')}"),
            ("source_type_empty", "error", f"not {_ne('source_type')}"),
            ("path_unsafe", "error", f"not {_SAFE.format('path')}"),
            ("required_not_true", "error", "stream_name in ('joint_states', 'robot_state_rt', 'tf', 'tf_static') and not coalesce(required, false)"),
            ("optional_not_false", "error", "stream_name in ('command_context', 'gripper_state') and coalesce(required, false)"),
            ("record_count_invalid", "error", "not coalesce(record_count >= 0, false)"),
            ("unverified", "warning", "not coalesce(verified, true)"),
            ("source_unknown", "warning", _unknown("source_name")),
        ],
    ),
}


def _findings_sql() -> str:
    """Each layer's broken rules as a list, unnested: one scan a layer here as well."""
    parts = []
    for layer, (row_id, rs) in _RULE_SQL.items():
        items = ", ".join(f"case when {cond} then '{sev}:{rule}' end" for rule, sev, cond in rs)
        parts.append(f"select '{layer}' as layer, episode_id, {row_id} as row_id, unnest(list_filter([{items}], lambda h: h is not null)) as h from {layer}")
    return "f as (select layer, episode_id, row_id, split_part(h, ':', 1) as severity, split_part(h, ':', 2) as rule_id from (" + " union all ".join(parts) + "))"


@query(f"with {_findings_sql()} select layer, rule_id, severity, count(*) as n, min(row_id) as first_row from f group by all")
def findings_report(spark: SparkSession, d: str) -> DataFrame:
    return rules.report(rules.all_findings(_tables(spark, d)))


@query(
    f"""with {_findings_sql()}, n as (select episode_id, count(*) filter (severity = 'error') as e, count(*) filter (severity = 'warning') as w from f group by 1)
select s.episode_id, coalesce(e, 0) as errors, coalesce(w, 0) as warnings, case when coalesce(e, 0) > 0 then 'failed' when coalesce(w, 0) > 0 then 'warning' else 'ok' end as status, coalesce(e, 0) = 0 as ready
from (select distinct episode_id from metadata) s left join n on s.episode_id = n.episode_id"""
)
def readiness_rollup(spark: SparkSession, d: str) -> DataFrame:
    return rules.readiness(rules.all_findings(_tables(spark, d)), table(spark, d, "metadata"))


@query(
    """select episode_id, count(*) filter (p) as n_padding, max(frame_index) as last_frame, max(frame_index) filter (p) as padding_frame,
  coalesce(count(*) filter (p) = 1 and max(frame_index) filter (p) = max(frame_index), false) as one_and_last from (select *, coalesce(action_is_terminal_padding, false) as p from frames) group by episode_id"""
)
def padding_check(spark: SparkSession, d: str) -> DataFrame:
    return rules.padding_rules(table(spark, d, "frames"))


@query(
    f"""with {_POSED_SQL} select l.episode_id, l.record_index, {", ".join(f"round({c}, 6) + 0.0e0 as {n}" for c, n in (("x", "x"), ("y", "y"), ("z", "z"), ("a", "rx"), ("b", "ry"), ("c", "rz")))},
  case when greatest(abs(v[1]), abs(v[2]), abs(v[3])) > 10 then 'mm' when greatest(abs(v[1]), abs(v[2]), abs(v[3])) <= 2 then 'm' else 'unknown' end as guess
from lab l join posed p on l.episode_id = p.episode_id and l.record_index = p.record_index"""
)
def pose_units(spark: SparkSession, d: str) -> DataFrame:
    key = ["episode_id", "record_index"]
    r = table(spark, d, "robot_state_rt")
    p = convert.poses(r, table(spark, d, "streams_index"), convert.SYNTHETIC_UNITS).where("error is null")
    top = max_abs(F.slice("actual_tcp_position", 1, 3))
    j = p.join(r.select("state_row_id", top.alias("top")), "state_row_id")
    return j.select(
        *key, *(r6(at(F.col("position"), i)).alias(n) for i, n in enumerate("xyz")), *(r6(at(F.col("rotation"), i)).alias(n) for i, n in enumerate(("rx", "ry", "rz"))),
        F.when(F.col("top") > 10, "mm").when(F.col("top") <= 2, "m").otherwise("unknown").alias("guess"),
    )


_JOINT_CASE = "case when {0} in {1} then list_transform({2}, lambda x: radians(x)) when {0} in {3} then {2} end"
_STATE_SQL = f"""
one as (select episode_id, record_index, arg_min({{'v': actual_tcp_position, 'u': units, {", ".join(f"'{c}': {c}" for c in WRENCH_ORDER)}}}, state_row_id) as o from robot_state_rt where record_index is not null group by all),
jnt as (select episode_id, record_index, arg_min({{'p': position, 'v': velocity, 'u': units}}, joint_row_id) as j from joint_states group by all),
lab as (select one.episode_id, one.record_index, o.v as v, {_unit_sql("o.u", "r.e", ("tcp_position",), "mm")} as pu, {_unit_sql("o.u", "r.e", ("tcp_orientation",), "deg")} as au,
  {_GRIP_VALUE} as grip, case {" ".join(f"when {vec_ok(f'o.{c}', 6)} then o.{c}" for c in WRENCH_ORDER)} end as wr, case {" ".join(f"when {vec_ok(f'o.{c}', 6)} then '{c}'" for c in WRENCH_ORDER)} end as wrench_source,
  {vec_ok("j.p", 6)} as jp_ok, {vec_ok("j.v", 6)} as jv_ok, j.p as jp0, j.v as jv0,
  {_unit_sql("j.u", "q.e", ("joint_position", "position"), "deg")} as ju, {_unit_sql("j.u", "q.e", ("joint_velocity", "velocity"), "deg/s")} as jvu
  from one left join jnt on one.episode_id = jnt.episode_id and one.record_index = jnt.record_index left join {_GRIP_SQL} g on one.episode_id = g.episode_id and one.record_index = g.record_index
  left join {_entry_sql("robot_state_rt")} r on one.episode_id = r.episode_id left join {_entry_sql("joint_states")} q on one.episode_id = q.episode_id),
conv as (select *, case when jp_ok then {_JOINT_CASE.format("ju", _in(convert.DEGREES), "jp0", _in(convert.RADIANS))} end as jp,
  case when jv_ok then {_JOINT_CASE.format("jvu", _in(convert.DEGREE_RATES), "jv0", _in(convert.RADIAN_RATES))} end as jv from lab),
st as (select *, case when not {vec_ok("v", 6)} then 'tcp position is not 6 finite numbers' when pu not in {_in(convert.MILLIMETRES + convert.METRES)} then 'tcp_position unit is missing or unknown'
  when au not in {_in(convert.DEGREES + convert.RADIANS)} then 'tcp_orientation unit is missing or unknown' when grip is null then 'gripper holds no finite value'
  when wr is null then 'no wrench source holds 6 finite numbers' when not jp_ok then 'joint position is not 6 finite numbers' when jp is null then 'joint_position unit is missing or unknown'
  when not jv_ok then 'joint velocity is not 6 finite numbers' when jv is null then 'joint_velocity unit is missing or unknown' end as error,
  list_concat(case when pu in {_in(convert.MILLIMETRES)} then list_transform(v[1:3], lambda x: x / 1000.0e0) else v[1:3] end, case when au in {_in(convert.DEGREES)} then list_transform(v[4:6], lambda x: radians(x)) else v[4:6] end,
    [grip], wr, jp, jv) as state from conv)
"""


@query(
    f"""with {_STATE_SQL} select episode_id, record_index, wrench_source, array_to_string(list_filter([case when jp_ok then 'joint_states.position' end, case when jv_ok then 'joint_states.velocity' end], lambda x: x is not null), '; ') as joint_source, error,
  {", ".join(f"round(case when error is null then state[{i + 1}] end, 6) + 0.0e0 as s_{i}" for i in range(25))} from st"""
)
def model_states(spark: SparkSession, d: str) -> DataFrame:
    s = convert.states(*(table(spark, d, n) for n in ("robot_state_rt", "joint_states", "gripper_state", "streams_index")), convert.SYNTHETIC_UNITS)
    return s.select("episode_id", "record_index", "wrench_source", "joint_source", "error", *(r6(at(F.col("model_state"), i)).alias(f"s_{i}") for i in range(25)))


_SETS_SQL = """
own as (select distinct episode_id, 'joint_states' as stream, record_index from joint_states where record_index is not null union select episode_id, 'gripper_state', record_index from gripper_state where record_index is not null
  union select episode_id, stream_name, record_index from camera_index where record_index is not null),
base as (select distinct episode_id, record_index from robot_state_rt where record_index is not null),
want as (select base.episode_id, stream, record_index, 1 as in_a from base join (select distinct episode_id, stream from own) using (episode_id)),
j as (select coalesce(want.episode_id, own.episode_id) as episode_id, coalesce(want.stream, own.stream) as stream, coalesce(want.record_index, own.record_index) as k, in_a is not null as a, own.stream is not null as b
  from want full join own on want.episode_id = own.episode_id and want.stream = own.stream and want.record_index = own.record_index),
sets as (select episode_id, stream, count(*) filter (a and b) as n_common, count(*) filter (not b) as n_missing, count(*) filter (not a) as n_extra,
  array_to_string(list_sort(list(k) filter (not b))[1:10], ',') as first_missing, array_to_string(list_sort(list(k) filter (not a))[1:10], ',') as first_extra,
  count(*) filter (not b) = 0 and count(*) filter (not a) = 0 as aligned from j group by all)
"""


def _streams_of(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {n: table(spark, d, n) for n in ("joint_states", "gripper_state", "camera_index")}


@query(f"with {_SETS_SQL} select * from sets")
def index_alignment(spark: SparkSession, d: str) -> DataFrame:
    return convert.index_sets(table(spark, d, "robot_state_rt"), _streams_of(spark, d))


@query(
    f"""with {_SETS_SQL}, {_STATE_SQL},
t0 as (select episode_id, record_index, arg_min({{'t': {STAMP_SQL}, 'm': monotonic_stamp}}, state_row_id) as s from robot_state_rt where record_index is not null group by all),
t1 as (select *, lag(s) over (partition by episode_id order by record_index) as p from t0),
t2 as (select episode_id, bool_and(s.t is not null and (p is null or p.t is null or s.t > p.t)) as ok_t, bool_and(s.m is not null and (p is null or p.m is null or s.m > p.m)) as ok_m from t1 group by 1),
views as (select distinct episode_id, case when stream_name in ('tcp_camera', 'wrist_camera') then 'tcp' else 'external' end as v, stream_name from camera_index where stream_name <> 'external_camera_2'),
seen as (select episode_id, count(*) as n from (select episode_id, v from views group by all having count(*) = 1) group by 1),
bad as (
  select episode_id, min(stream) || ': record indexes differ from the robot''s' as reason, 0 as rank from sets where not aligned group by 1
  union all select episode_id, 'record indexes do not run from 0 without a hole', 1 from base group by 1 having not (min(record_index) = 0 and max(record_index) = count(*) - 1 and count(*) >= 2)
  union all select episode_id, arg_min(error, record_index) filter (error is not null), 2 from st group by 1 having count(error) > 0
  union all select e.episode_id, 'a view has no camera stream', 3 from (select distinct episode_id from robot_state_rt) e left join seen using (episode_id) where coalesce(n, 0) < 2
  union all select episode_id, 'stamps do not increase', 4 from t2 where not coalesce(ok_t, false) and not coalesce(ok_m, false))
select episode_id, arg_min(reason, rank) as reason from bad group by 1"""
)
def conversion_refused(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "camera_index")
    views = cameras.select_views(c.where("stream_name <> 'external_camera_2'").select("episode_id", "stream_name", F.lit("camera").alias("kind"), F.lit(None).cast("string").alias("role")))
    return convert.processed_frames(*(table(spark, d, n) for n in ("robot_state_rt", "joint_states", "gripper_state", "camera_index", "streams_index")), views, convert.SYNTHETIC_UNITS)[1]


@query("select 'robot_state_rt' as stream, episode_id, count(*) as n from robot_state_rt group by all union all select 'joint_states', episode_id, count(*) from joint_states group by all union all select 'gripper_state', episode_id, count(*) from gripper_state group by all")
def episodes_union(spark: SparkSession, d: str) -> DataFrame:
    out = None
    for n in ("robot_state_rt", "joint_states", "gripper_state"):
        x = table(spark, d, n).select(F.lit(n).alias("stream"), "episode_id")
        out = x if out is None else out.unionByName(x)
    return out.groupBy("stream", "episode_id").agg(F.count("*").alias("n"))
