"""Queries of the rules that look at several tables: readiness, inspection, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.functions import labels as L
from tracewright.functions.stamps import episode_fps, stamp_seconds
from tracewright.operators import align, cameras, convert, dataset, exportcheck, readiness, rules
from tracewright.plans import core
from tracewright.plans.core import _SETS_SQL, STAMP_SQL, _entry_sql, _findings_sql, _in, _tables, _unit_sql, fin, r6
from tracewright.session import stage, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
KEY = ["episode_id", "record_index"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- stamps ------------------------------------------------------------------------------
def _stamped(df: DataFrame, row: str, stream=None) -> DataFrame:
    s = df.where("record_index is not null")
    key = KEY + (["stream"] if stream is not None else [])
    s = s.select(*KEY, *([stream.alias("stream")] if stream is not None else []), F.col(row).alias("row"), F.col("source_stamp").try_cast("double").alias("source"), F.col("receipt_stamp").alias("receipt"))
    return align.first_by_index(s, key, "row").drop("row")


_FIRST = "arg_min({{'s': try_cast(source_stamp as double), 'r': receipt_stamp}}, {0}) as v"


@query(
    f"""with r as (select episode_id, record_index, {_FIRST.format("state_row_id")} from robot_state_rt where record_index is not null group by all),
s as (select episode_id, record_index, 'joint_states' as stream, {_FIRST.format("joint_row_id")} from joint_states where record_index is not null group by all
  union all select episode_id, record_index, 'gripper_state', {_FIRST.format("gripper_row_id")} from gripper_state where record_index is not null group by all
  union all select episode_id, record_index, stream_name, {_FIRST.format("camera_row_id")} from camera_index where record_index is not null group by all),
m as (select episode_id, max(fps) as fps from metadata where fps > 0 and isfinite(fps) group by 1),
j as (select s.episode_id, s.record_index, stream, abs(s.v.s - r.v.s) as ds, abs(s.v.r - r.v.r) as dr, coalesce(0.5e0 / fps, 0.02e0) as tol,
  {fin("s.v.s")} and {fin("r.v.s")} as fs, {fin("s.v.r")} and {fin("r.v.r")} as fr
  from s join r on s.episode_id = r.episode_id and s.record_index = r.record_index left join m on s.episode_id = m.episode_id)
select episode_id, record_index, stream, case when fs and ds > tol then 'source_stamp' else 'receipt_stamp' end as stamp_key, round(case when fs and ds > tol then ds else dr end, 6) + 0.0e0 as "offset"
from j where (fs and ds > tol) or (fr and dr > tol)"""
)
def stamp_mismatches(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: table(spark, d, n)
    streams = readiness.union([
        _stamped(t("joint_states"), "joint_row_id", F.lit("joint_states")), _stamped(t("gripper_state"), "gripper_row_id", F.lit("gripper_state")), _stamped(t("camera_index"), "camera_row_id", F.col("stream_name")),
    ])
    tol = episode_fps(t("metadata")).select("episode_id", (0.5 / F.col("fps")).alias("tol"))
    m = readiness.stamp_mismatches(_stamped(t("robot_state_rt"), "state_row_id"), streams, tol)
    return m.withColumn("offset", r6("offset"))


# --- readiness ----------------------------------------------------------------------------
def _views(spark: SparkSession, d: str) -> DataFrame:
    return cameras.select_views(table(spark, d, "streams_index").select("episode_id", "stream_name", "kind"))


def readiness_of(spark: SparkSession, d: str) -> DataFrame:
    """Findings of units, gripper, cameras and record order."""
    t = lambda n: table(spark, d, n)
    r = t("robot_state_rt")
    stamps = {"source_stamp": stamp_seconds(F.col("source_stamp")), "receipt_stamp": F.col("receipt_stamp"), "monotonic_stamp": F.col("monotonic_stamp")}
    return readiness.union([
        readiness.unit_findings(r, t("joint_states"), t("streams_index")),
        readiness.gripper_findings(r, t("gripper_state"), t("streams_index")),
        readiness.camera_findings(_views(spark, d), align.sync_violations(core._offsets(spark, d), ["episode_id", "stream_name"])),
        readiness.sequence_findings(r, "sequence", "state_row_id", stamps),
    ])


_TIMES = f"(select *, {STAMP_SQL} as source_s from robot_state_rt)"
_LAST = "last_value({0} ignore nulls) over (partition by episode_id order by state_row_id rows between unbounded preceding and 1 preceding)"
_PLACEHOLDER = "(replace(replace(lower(trim({0})), ' ', '_'), '-', '_') in ('synthetic_constant_pending_gripper_integration', 'pipeline_smoke_constant_gripper', 'synthetic_gripper_state') or (regexp_matches(lower(replace(replace({0}, ' ', '_'), '-', '_')), 'synthetic|pipeline_smoke') and lower({0}) like '%gripper%'))"


def _bad_unit(quantity: str, row: str, stream: str, keys: tuple[str, ...], known: list[str]) -> str:
    return f"""select 'readiness' as layer, '{quantity}_unit' as rule_id, 'error' as severity, x.episode_id, {row} as row_id from {stream} x left join {_entry_sql(stream)} e0 on x.episode_id = e0.episode_id
  where {_unit_sql("x.units", "e0.e", keys, "?")} not in {_in(known)}"""


_READY_SQL = f"""
{_SETS_SQL.replace("union select episode_id, 'gripper_state'", "where false union select episode_id, 'gripper_state'").replace("from joint_states where record_index is not null where false", "from joint_states where false").replace("union select episode_id, stream_name, record_index from camera_index where record_index is not null", "")},
cv as (select distinct episode_id, stream_name, case when stream_name in ('tcp_camera', 'wrist_camera') then 'tcp' when stream_name = 'external_camera' or starts_with(stream_name, 'external_camera_') then 'external' end as v
  from streams_index where stream_name in {_in(L.CAMERA_STREAMS)} or replace(replace(lower(trim(kind)), ' ', '_'), '-', '_') in {_in(L.CAMERA_KINDS)}),
cw as (select episode_id, v from (select distinct episode_id from streams_index), (values ('external'), ('tcp')) as t(v)),
cn as (select cw.episode_id, cw.v, count(stream_name) as n from cw left join cv on cw.episode_id = cv.episode_id and cw.v = cv.v group by all),
{core._OFFSET_SQL.strip()},
tm as (select *, {_LAST.format("source_s")} as p1, {_LAST.format(f"case when {fin('receipt_stamp')} then receipt_stamp end")} as p2, {_LAST.format(f"case when {fin('monotonic_stamp')} then monotonic_stamp end")} as p3,
  row_number() over (partition by episode_id order by state_row_id) - 1 as place from {_TIMES}),
ready as (
  {_bad_unit("tcp_position", "state_row_id", "robot_state_rt", ("tcp_position",), convert.MILLIMETRES + convert.METRES)}
  union all {_bad_unit("tcp_orientation", "state_row_id", "robot_state_rt", ("tcp_orientation",), convert.DEGREES + convert.RADIANS)}
  union all {_bad_unit("joint_position", "joint_row_id", "joint_states", ("joint_position", "position"), convert.DEGREES + convert.RADIANS)}
  union all {_bad_unit("joint_velocity", "joint_row_id", "joint_states", ("joint_velocity", "velocity"), convert.DEGREE_RATES + convert.RADIAN_RATES)}
  union all select 'readiness', 'gripper_missing', 'error', episode_id, null from (select distinct episode_id from robot_state_rt) where episode_id not in (select episode_id from gripper_state)
  union all select 'readiness', 'gripper_placeholder', 'error', episode_id, null from (select episode_id from gripper_state where placeholder union select episode_id from streams_index where stream_name = 'gripper_state' and ({_PLACEHOLDER.format("source_name")} or {_PLACEHOLDER.format("source_type")}))
  union all select 'readiness', 'gripper_indexes', 'error', episode_id, null from sets where stream = 'gripper_state' and not aligned
  union all select 'readiness', 'gripper_value', 'error', episode_id, gripper_row_id from gripper_state where not ({fin("gripper_position")} or {fin("gripper_width_m")})
  union all select 'readiness', 'camera_mapping', 'error', episode_id, null from cn where n <> 1
  union all select 'readiness', 'camera_sync', 'error', episode_id, min(record_index) from o where abs(off) > tol group by episode_id, stream_name
  union all select 'sequence', 'record_index_not_sequential', 'error', episode_id, state_row_id from tm where record_index is distinct from place
  union all select 'sequence', 'source_stamp_falls', 'error', episode_id, state_row_id from tm where source_s < p1
  union all select 'sequence', 'receipt_stamp_falls', 'error', episode_id, state_row_id from tm where {fin("receipt_stamp")} and receipt_stamp < p2
  union all select 'sequence', 'monotonic_stamp_falls', 'error', episode_id, state_row_id from tm where {fin("monotonic_stamp")} and monotonic_stamp < p3)
"""


@query(f"with {_READY_SQL} select layer, rule_id, severity, count(*) as n, coalesce(min(row_id), -1) as first_row from ready group by all")
def readiness_report(spark: SparkSession, d: str) -> DataFrame:
    return rules.report(readiness_of(spark, d)).withColumn("first_row", F.coalesce("first_row", F.lit(-1)))


@query(
    f"""with {_findings_sql()}, {_READY_SQL},
every as (select layer, rule_id, severity, episode_id from f union all select layer, rule_id, severity, episode_id from ready),
per as (select episode_id, layer, rule_id, severity, count(*) as n from every group by all),
g as (select episode_id, sum(n) filter (severity = 'error') as errors, sum(n) filter (severity <> 'error') as warnings, count(*) filter (severity = 'error' and layer <> 'readiness') as bad,
  coalesce(list_sort(list(layer || '.' || rule_id) filter (severity = 'error')), []) as b from per group by 1),
e as (select episode_id, bool_or(coalesce(collection_method in {_in(L.SYNTHETIC_METHODS)}, false) or coalesce(recorder_version in {_in(L.SYNTHETIC_RECORDERS)}, false)) as synthetic from metadata where episode_id is not null group by 1),
jx as (select e.episode_id, synthetic, cast(coalesce(errors, 0) as bigint) as errors, cast(coalesce(warnings, 0) as bigint) as warnings, coalesce(bad, 0) as bad, coalesce(b, []) as b from e left join g on e.episode_id = g.episode_id),
kx as (select *, array_to_string(b, ',') as blockers from jx)
select episode_id, errors, warnings, blockers, array_to_string(list_filter([case when len(b) = 0 then 'run the conversion' else 'fix the blocking findings before conversion' end,
    case when contains(blockers, 'image_path') then 'fix the image paths and files' end, case when contains(blockers, 'camera_sync') or contains(blockers, 'stamp') then 'check the stamps of cameras and robot' end,
    case when contains(blockers, 'orientation') then 'verify the orientation convention' end, case when contains(blockers, 'gripper_missing') then 'add gripper_state if gripper actions matter' end], lambda x: x is not null), '; ') as recommendations,
  bad = 0 as schema_valid, len(b) = 0 as conversion_ready, len(b) = 0 and not synthetic as training_ready, case when len(b) > 0 then 'failed' when warnings > 0 then 'warning' else 'ok' end as status from kx"""
)
def inspection(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "metadata").where("episode_id is not null")
    e = m.groupBy("episode_id").agg(F.bool_or(L.is_synthetic(F.col("collection_method"), F.col("recorder_version"))).alias("synthetic"))
    return readiness.inspection(rules.all_findings(_tables(spark, d)).unionByName(readiness_of(spark, d)), e)


@query(
    f"""with r as (select episode_id, state_row_id, case {" ".join(f"when {core.vec_ok(c, 6)} then '{c}'" for c in core.WRENCH_ORDER)} end as source from robot_state_rt),
s as (select episode_id, source, min(state_row_id) as lo from r where source is not null group by all)
select episode_id, array_to_string(list(source order by lo), ',') as sources from s group by 1"""
)
def wrench_source_order(spark: SparkSession, d: str) -> DataFrame:
    return readiness.ordered_sources(table(spark, d, "robot_state_rt")).select("episode_id", F.array_join("sources", ",").alias("sources"))


# --- exports ------------------------------------------------------------------------------
_PLAN = core.ORACLES["export_plan"]


@query(
    f"""with p as ({_PLAN}), f as (select episode_id, unnest(list_filter([case when not coalesce(exported > 0, false) then 'exported_not_positive' end, case when excluded is distinct from frames_in - exported then 'excluded_wrong' end,
  case when external_images is distinct from exported then 'external_images_missing' end, case when tcp_images is distinct from exported then 'tcp_images_missing' end,
  case when state_length is distinct from state_dim then 'preview_state_wrong' end, case when action_length is distinct from 7 then 'preview_action_wrong' end], lambda x: x is not null)) as rule_id from p)
select rule_id, count(*) as n, min(episode_id) as first_episode from f group by 1"""
)
def plan_report(spark: SparkSession, d: str) -> DataFrame:
    p = dataset.export_plan(table(spark, d, "frames"), "compact_13d")
    return exportcheck.plan_findings(p, "compact_13d").groupBy("rule_id").agg(F.count("*").alias("n"), F.min("episode_id").alias("first_episode"))


_BAD = "not coalesce(len({0}) = {1} and len(list_filter({0}, lambda x: x is not null and isfinite(x))) = {1}, false)"


@query(
    f"""with m as (select episode_id, min_by(task_instruction, meta_row_id) as task from metadata group by 1),
s as (select f.*, task from frames f left join m on f.episode_id = m.episode_id where not coalesce(action_is_terminal_padding, false)),
h as (select unnest(list_filter([case when {_BAD.format("model_state[1:13]", 13)} then 'state_invalid' end, case when {_BAD.format("measured_action", 7)} then 'action_invalid' end,
  case when not coalesce(length(trim(external_rgb_path)) > 0, false) then 'image_empty' end, case when not coalesce(length(trim(tcp_rgb_path)) > 0, false) then 'wrist_image_empty' end,
  case when not coalesce(length(trim(task)) > 0, false) then 'task_empty' end, case when task is null then 'prompt_differs' end], lambda x: x is not null)) as rule_id from s)
select rule_id, count(*) as n from h group by 1"""
)
def staged_report(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "frames")
    s = dataset.staged(f, table(spark, d, "metadata"), "compact_13d")
    return exportcheck.staged_findings(s, dataset.export_plan(f, "compact_13d"), "compact_13d").groupBy("rule_id").agg(F.count("*").alias("n"))


def dataset_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The tables of a dataset made of all frames: frames, episodes, tasks, info."""
    f = dataset.without_padding(table(spark, d, "frames"))
    e = dataset.episode_table(f)
    m = table(spark, d, "metadata").groupBy("episode_id").agg(F.min_by("task_instruction", "meta_row_id").alias("task"))
    named = e.join(m, "episode_id", "left")
    tasks = stage(dataset.task_dictionary(named, "episode_index"), "tasks")
    episodes = stage(named.join(tasks.select("task", "task_index"), "task", "left").select("episode_id", "episode_index", "task_index", "task", "length", "offset"), "dataset-episodes")
    g = dataset.global_index(f.select("episode_id", "frame_index", "frame_row_id", F.slice("model_state", 1, 13).alias("state"), F.col("measured_action").alias("action")), episodes)
    frames = g.join(episodes.select("episode_index", "task_index", "task"), "episode_index", "left").select(
        "episode_index", F.col("ordinal").alias("frame_index"), F.col("global_index").alias("index"), "task_index", "task", F.col("task").alias("prompt"), "state", "action"
    )
    return {"frames": frames, "episodes": episodes.select("episode_index", "task_index", "length"), "tasks": tasks.select("task_index", "task"), "info": dataset.dataset_info(episodes, tasks)}


@query(
    f"""with m as (select episode_id, min_by(task_instruction, meta_row_id) as task from metadata group by 1),
s as (select f.*, nullif(trim(task), '') is null as untold from frames f left join m on f.episode_id = m.episode_id where not coalesce(action_is_terminal_padding, false)),
h as (select unnest(list_filter([case when {_BAD.format("model_state[1:13]", 13)} then 'state_invalid' end, case when {_BAD.format("measured_action", 7)} then 'action_invalid' end, case when untold then 'task_index_differs' end], lambda x: x is not null)) as rule_id from s
  union all select 'task_unknown' from (select distinct episode_id from s where untold))
select rule_id, count(*) as n from h group by 1"""
)
def dataset_report(spark: SparkSession, d: str) -> DataFrame:
    t = dataset_tables(spark, d)
    return exportcheck.dataset_findings(t["frames"], t["episodes"], t["tasks"], None, t["info"], "compact_13d").groupBy("rule_id").agg(F.count("*").alias("n"))
