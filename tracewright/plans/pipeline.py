"""Queries of the general training-data operators (problems 1, 3, 4, 5 and 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.operators import compact, drift, grid, spikes, unitfix
from tracewright.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return grid.found(table(spark, d, "joint_states"), table(spark, d, "frames"), table(spark, d, "metadata"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return spikes.found(table(spark, d, "robot_state_rt"), table(spark, d, "frames"), table(spark, d, "streams_index"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return unitfix.found(*(table(spark, d, n) for n in ("joint_states", "robot_state_rt", "gripper_state", "streams_index")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return drift.found(table(spark, d, "raw_files"))


def p4_joints(spark: SparkSession, d: str) -> DataFrame:
    return unitfix.convert_joints(table(spark, d, "joint_states"), table(spark, d, "streams_index"))


def p4_wrenches(spark: SparkSession, d: str) -> DataFrame:
    return unitfix.convert_wrenches(table(spark, d, "robot_state_rt"), table(spark, d, "streams_index"))


def p4_gripper(spark: SparkSession, d: str) -> DataFrame:
    return unitfix.convert_gripper(table(spark, d, "gripper_state"), table(spark, d, "streams_index"))


def p4_suspicion(spark: SparkSession, d: str) -> DataFrame:
    return unitfix.suspicion(*(table(spark, d, n) for n in ("joint_states", "robot_state_rt", "streams_index")))


def p5_versions(spark: SparkSession, d: str) -> DataFrame:
    return drift.versions(table(spark, d, "raw_files"))


def p5_unified_robot_state(spark: SparkSession, d: str) -> DataFrame:
    return drift.unified(table(spark, d, "raw_files"), "robot_state_rt").withColumn("others", F.to_json("others"))


def p5_unified_gripper(spark: SparkSession, d: str) -> DataFrame:
    return drift.unified(table(spark, d, "raw_files"), "gripper_state").withColumn("others", F.to_json("others"))


def p1_grid(spark: SparkSession, d: str) -> DataFrame:
    return grid.regular(table(spark, d, "joint_states"), table(spark, d, "frames"), table(spark, d, "metadata"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return compact.found(table(spark, d, "raw_files"))


QUERIES = {
    "p1_found": p1_found, "p1_grid": p1_grid, "p3_found": p3_found, "p4_found": p4_found, "p4_joints": p4_joints, "p4_wrenches": p4_wrenches, "p4_gripper": p4_gripper, "p4_suspicion": p4_suspicion,
    "p5_found": p5_found, "p5_versions": p5_versions, "p5_unified_robot_state": p5_unified_robot_state, "p5_unified_gripper": p5_unified_gripper, "p7_found": p7_found,
}
_STAMP = """coalesce(try_cast(source_stamp as double),
  try_cast(json_extract_string(case when source_stamp like '{%' then source_stamp end, '$.sec') as double)
  + 1e-9 * try_cast(json_extract_string(case when source_stamp like '{%' then source_stamp end, '$.nanosec') as double))"""

P1_SQL = f"""
with fps as (select episode_id, max(fps) as fps from metadata where isfinite(fps) and fps > 0 group by episode_id),
readings as (
  select 'joint_states' as table_name, episode_id, {_STAMP} as t from joint_states
  where len(velocity) = 6 and len(list_filter(velocity, lambda x: x is not null and isfinite(x))) = 6
  union all select 'frames', episode_id, "timestamp" from frames where "timestamp" is not null and isfinite("timestamp")),
placed as (
  select table_name, episode_id, t, cast(floor(t * coalesce(fps, 30.0) + 0.5) as bigint) as k
  from readings left join fps using (episode_id) where t is not null and isfinite(t)),
pairs as (
  select *, lag(t) over w as pt, lag(k) over w as pk from placed window w as (partition by table_name, episode_id order by t, k))
select table_name, episode_id, unnest(range(pk + 1, k)) as grid_no from pairs where t - pt <= 20.0 and k - pk > 1
"""

P7_SQL = """
with lines as (
  select file_id, unnest(string_split(content, chr(10))) as line, generate_subscripts(string_split(content, chr(10)), 1) as line_no
  from raw_files where stream_name = 'frames'),
objects as (select file_id, line_no, case when json_valid(line) then line end as j from lines where trim(line) like '{%'),
fields as (
  select file_id, line_no, lower(trim(json_extract_string(j, '$.episode_id'))) as ep,
    cast(try_cast(json_extract_string(j, '$.frame_index') as double) as bigint) as frame,
    '/' || regexp_replace(regexp_replace(trim(json_extract_string(j, '$.external_rgb_path')), '/+(\\./+)*', '/', 'g'), '^(\\.?/)+', '') as a,
    '/' || regexp_replace(regexp_replace(trim(json_extract_string(j, '$.tcp_rgb_path')), '/+(\\./+)*', '/', 'g'), '^(\\.?/)+', '') as b
  from objects where j is not null),
keys as (
  select file_id, line_no, ep, frame,
    case when instr(lower(a), '/' || ep || '/') > 0 then substr(a, instr(lower(a), '/' || ep || '/') + length(ep) + 2) else substr(a, 2) end as a,
    case when instr(lower(b), '/' || ep || '/') > 0 then substr(b, instr(lower(b), '/' || ep || '/') + length(ep) + 2) else substr(b, 2) end as b
  from fields),
ranked as (select file_id, line_no, row_number() over (partition by ep, frame, a, b order by file_id, line_no) as n from keys)
select file_id, cast(line_no as bigint) as line_no from ranked where n > 1
"""

ORACLES: dict[str, str] = {"p1_found": P1_SQL, "p7_found": P7_SQL}
